"""Phrases that are collocations, mined by Toivonen's sampling.

1. A keyed sample of the texts is mined level by level: words, then phrases of two and of
   three words whose shorter parts are frequent there (at a lowered threshold). What it
   finds is proposed.
2. One pass over all texts counts, exactly, every word, every pair of proposed words and
   every triple of proposed pairs: the proposals together with their negative border, the
   phrases that are not proposed although all their parts are.
3. Phrases of the border that turn out frequent are failures of the sample. Their longer
   phrases have not been counted yet; a further pass counts just these, and so on until a
   pass finds no frequent phrase that was not known before.

So the result is exact whatever the sample holds; the sample only decides how much is
counted in vain and how many passes it takes (at most four: one, and one for each length).

Which phrases a pass counts is told to the tasks by bitsets of a fixed largest size, one
bit for the hash of each known phrase. A bit that two phrases share makes a pass count
more than it must, never less, and counts are kept by the phrase itself. The bitsets of
earlier passes tell what has been counted, with the same false positives, so no phrase is
counted twice. Counts are summed in each slice of a task, then in the task, then by key.

Defined results: a null text is empty, a null language is ``und``; repeated rows count
as often as they come; an empty table gives no rows. Columns other than id, text and
language are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulark.llm.batches import Stages, slices

#: share of the texts that the sample holds, and the least count of a proposal there
SAMPLE_ONE_IN, SAMPLE_FREQUENT = 8, 2
FREQUENT, INSIDE_PERCENT, REPORTED = 10, 50, 2_000
SCALE = 1_000_000
#: bits of a bitset: 16 for each phrase it holds, within these bounds (16 MB at most)
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
SLICE = 4 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c
               for c in range(256))


def hashes(lang: str, phrases: pa.Array) -> np.ndarray:
    """64-bit hashes of the phrases of one language, the same in every process."""
    import pandas as pd

    values = np.asarray(phrases.to_numpy(zero_copy_only=False), object)
    key = hashlib.md5(lang.encode()).hexdigest()[:16]
    return pd.util.hash_array(values, hash_key=key, categorize=False)


class Words:
    """The words of the texts of one language in a slice, as codes into a dictionary."""

    def __init__(self, texts: list[str]):
        joined = np.frombuffer("\n".join(texts).encode().translate(_LOWER), np.uint8)
        gap = (joined == 32) | (joined == 10)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined[~gap])]
        )
        coded = words.dictionary_encode()
        self.dictionary = coded.dictionary.cast(pa.string())
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.piece = np.cumsum(joined == 10)[starts] if len(starts) else np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.codes)


def _joined(*parts: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(*parts, " ")


class Known:
    """Bitsets of known words (1) and pairs (2); later ones add to earlier ones."""

    def __init__(self, sets: dict[int, list[np.ndarray]]):
        self.sets = sets

    def any(self, hashed: np.ndarray, size: int, last: int | None = None) -> np.ndarray:
        """Whether one of the first ``last`` bitsets holds each hash."""
        found = np.zeros(len(hashed), bool)
        for bits in self.sets[size][:last]:
            at = hashed % np.uint64(len(bits) * 8)
            found |= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _pairs(words: Words):
    """Positions whose word is followed by another one of its piece."""
    return np.flatnonzero(words.piece[:-1] == words.piece[1:]) if len(words) > 1 else np.zeros(0, np.int64)


def count_slice(lang: str, words: Words, sizes: tuple[int, ...], known: Known, new: bool):
    """(size, phrases, counts) of one language in a slice; size 0 is the number of words. Pairs are counted if both words
    are known, triples if both pairs are; with ``new`` only those which the bitsets before
    the last ones would not have let through."""
    n_words = len(words.dictionary)
    if 1 in sizes:
        yield 0, pa.nulls(1, pa.string()), np.array([len(words)])
        yield 1, words.dictionary, np.bincount(words.codes, minlength=n_words)
    if not {2, 3} & set(sizes):
        return
    word_hash = hashes(lang, words.dictionary)
    word_ok = known.any(word_hash, 1)
    at = _pairs(words)
    at = at[word_ok[words.codes[at]] & word_ok[words.codes[at + 1]]]
    keys, which, counts = np.unique(
        words.codes[at] * n_words + words.codes[at + 1], return_inverse=True, return_counts=True
    )
    left, right = keys // max(n_words, 1), keys % max(n_words, 1)
    pairs = _joined(words.dictionary.take(pa.array(left)), words.dictionary.take(pa.array(right)))
    # pairs that an earlier pass has counted
    before = np.zeros(len(keys), bool)
    if new:
        word_before = known.any(word_hash, 1, -1)
        before = word_before[left] & word_before[right]
    if 2 in sizes:
        yield 2, pairs.filter(pa.array(~before)), counts[~before]
    if 3 not in sizes:
        return
    pair_hash = hashes(lang, pairs)
    pair_ok = known.any(pair_hash, 2)
    number = np.full(len(words), -1, np.int64)
    number[at] = np.where(pair_ok, np.arange(len(keys)), -1)[which]
    both = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0))
    first, second = number[both], number[both + 1]
    if new:
        before &= known.any(pair_hash, 2, -1)
        keep = ~(before[first] & before[second])
        both, first = both[keep], first[keep]
    keys, counts = np.unique(first * n_words + words.codes[both + 2], return_counts=True)
    yield 3, _joined(
        pairs.take(pa.array(keys // max(n_words, 1))),
        words.dictionary.take(pa.array(keys % max(n_words, 1))),
    ), counts


def count_phrases(
    rows: DataFrame, sizes: tuple[int, ...], sets: dict[int, list[bytes]], new: bool = False
) -> DataFrame:
    """``lang, size, phrase, f`` of the phrases that one pass over ``lang, text`` counts."""
    sent = rows.sparkSession.sparkContext.broadcast(sets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known({s: [np.frombuffer(b, np.uint8) for b in bits] for s, bits in sent.value.items()})
        for part in slices(batches, "text", SLICE):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for size, phrases, counts in count_slice(lang, Words(texts), sizes, known, new):
                    n = len(phrases)
                    for start in range(0, n, 50_000):
                        some = phrases.slice(start, 50_000)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(some)), pa.array(np.full(len(some), size, np.int32)),
                             some, pa.array(counts[start:start + 50_000].astype(np.int64))],
                            ["lang", "size", "phrase", "f"],
                        )

    counted = rows.mapInArrow(count, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def bitset(phrases: DataFrame) -> bytes:
    """One bit for each ``lang, phrase``; only set bits, at most ``MOST_BITS``, reach the driver."""
    n = phrases.count()
    bits = LEAST_BITS
    while bits < min(16 * n, MOST_BITS):
        bits *= 2

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for part in batches:
            frame = pd.DataFrame({"lang": part.column("lang").to_pylist(),
                                  "phrase": part.column("phrase").to_pylist()})
            for lang, some in frame.groupby("lang"):
                at = (hashes(lang, pa.array(some["phrase"])) % np.uint64(bits)).astype(np.int64)
                block, bit = at >> 5, np.int64(1) << (at & 31)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bit)], ["block", "bit"])

    found = (
        phrases.mapInArrow(positions, "block long, bit long")
        .groupBy("block").agg(F.bit_or("bit").alias("bit"))
    )
    out = np.zeros(bits // 32, "<u4")
    table = found.toArrow()
    out[table.column("block").to_numpy()] = table.column("bit").to_numpy().astype(np.uint32)
    return out.tobytes()


def _known(counted: DataFrame, size: int, least: int) -> DataFrame:
    return counted.where((F.col("size") == size) & (F.col("f") >= least)).select("lang", "phrase")


def frequent_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    frequent: int = FREQUENT,
    sample_one_in: int = SAMPLE_ONE_IN,
    sample_frequent: int = SAMPLE_FREQUENT,
    seed: int = 0,
) -> DataFrame:
    """``lang, size, phrase, f`` of every word and every phrase of two or three words that
    comes at least ``frequent`` times in a language, and ``lang, 0, null, n`` with the
    number of all words."""
    spark = docs.sparkSession
    stages = Stages(spark)
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    sampled = rows.where(F.pmod(F.xxhash64(F.lit(seed), "lang", "text"), F.lit(sample_one_in)) == 0)
    sets: dict[int, list[bytes]] = {1: [], 2: []}
    # the sample, level by level
    for size in (1, 2):
        found = stages.write(count_phrases(sampled, (size,), sets).where(F.col("f") >= sample_frequent),
                             f"sample{size}")
        sets[size].append(bitset(found.select("lang", "phrase")))
        stages.drop(f"sample{size}")
    # proposals and their border
    enough = (F.col("f") >= frequent) | (F.col("size") == 0)
    fresh = stages.write(count_phrases(rows, (1, 2, 3), sets).where(enough), "counted")
    parts = [fresh]
    # failures: frequent phrases that the bitsets would not have let through
    passes = 1
    while True:
        missed = {
            size: stages.write(_unknown(spark, _known(fresh, size, frequent), sets[size]),
                               f"missed{size}-{passes}")
            for size in (1, 2)
        }
        more = {size: bitset(table) if not table.isEmpty() else bytes(LEAST_BITS // 8)
                for size, table in missed.items()}
        if not any(any(bits) for bits in more.values()):
            break
        sets = {size: [*sets[size], more[size]] for size in (1, 2)}
        passes += 1
        found = count_phrases(rows, (2, 3), sets, new=True).where(F.col("f") >= frequent)
        fresh = stages.write(found, f"expanded{passes}")
        parts.append(fresh)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _unknown(spark: SparkSession, phrases: DataFrame, bitsets: list[bytes]) -> DataFrame:
    """Those of ``lang, phrase`` that none of the bitsets holds."""
    sent = spark.sparkContext.broadcast(bitsets)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known({1: [np.frombuffer(b, np.uint8) for b in sent.value]})
        for part in batches:
            langs = np.array(part.column("lang").to_pylist(), object)
            out = np.zeros(part.num_rows, bool)
            for lang in set(langs):
                at = np.flatnonzero(langs == lang)
                some = part.column("phrase").take(pa.array(at))
                out[at] = ~known.any(hashes(lang, some), 1)
            yield part.filter(pa.array(out))

    return phrases.mapInArrow(keep, phrases.schema)


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = [c.cast("decimal(38,0)") for c in (F.lit(SCALE) * F.lit(1), a, a, left, right)]
    top = (wide[0] * wide[1] * wide[2]).cast("decimal(38,0)")
    return F.call_function("div", top, (wide[3] * wide[4]).cast("decimal(38,0)"))


def mine_collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    frequent: int = FREQUENT,
    inside_percent: int = INSIDE_PERCENT,
    reported: int | None = REPORTED,
    **sampling,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the phrases of two and three words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of the cut that scores lowest
    (floor of 1,000,000 a a / (l r), the first cut on a tie), ``n`` the language's words.
    A phrase inside a longer one with at least ``inside_percent`` of its count is left
    out. Of each language the best ``reported`` come back (None: all).
    """
    stages = Stages(docs.sparkSession)
    found = stages.write(
        frequent_phrases(docs, text_col, lang_col, frequent, **sampling), "frequent"
    )
    totals = found.where("size = 0").select("lang", F.col("f").alias("n"))
    words = found.where("size = 1").select("lang", "phrase", "f")
    pairs = found.where("size = 2").select("lang", "phrase", "f")
    triples = found.where("size = 3").select("lang", "phrase", "f")

    def part(table: DataFrame, name: str) -> DataFrame:
        return table.select("lang", F.col("phrase").alias(name), F.col("f").alias(f"f_{name}"))

    word = [F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)]
    two = pairs.withColumns({"head": word[0], "tail": word[1]})
    two = two.join(part(words, "head"), ["lang", "head"]).join(part(words, "tail"), ["lang", "tail"])
    two = two.select(
        "lang", "phrase", F.col("f").alias("a"), F.col("f_head").alias("l"), F.col("f_tail").alias("r"),
        _score(F.col("f"), F.col("f_head"), F.col("f_tail")).alias("score"),
    )
    three = triples.withColumns({
        "head": word[0], "tail": word[1],
        "start": F.substring_index("phrase", " ", 2), "end": F.substring_index("phrase", " ", -2),
    })
    for name, table in (("head", words), ("end", pairs), ("start", pairs), ("tail", words)):
        three = three.join(part(table, name), ["lang", name])
    cuts = three.withColumns({
        "first_cut": _score(F.col("f"), F.col("f_head"), F.col("f_end")),
        "second_cut": _score(F.col("f"), F.col("f_start"), F.col("f_tail")),
    })
    first = F.col("first_cut") <= F.col("second_cut")
    longer = cuts.select(
        "lang", "phrase", F.col("f").alias("a"),
        F.when(first, F.col("f_head")).otherwise(F.col("f_start")).alias("l"),
        F.when(first, F.col("f_end")).otherwise(F.col("f_tail")).alias("r"),
        F.least("first_cut", "second_cut").alias("score"),
    )
    around = three.select("lang", F.explode(F.array("start", "end")).alias("phrase"), "f")
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("covered"))
    two = two.join(around, ["lang", "phrase"], "left")
    inside = F.col("covered").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * inside_percent
    kept = two.where(~F.coalesce(inside, F.lit(False))).drop("covered").unionByName(longer)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best))
    if reported is not None:
        ranked = ranked.where(F.col("rank") <= reported)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM split),
grams AS (
  SELECT lang, 1 AS size, w[i] AS phrase FROM placed
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, l.f AS l, r.f AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cand c, range(1, 3) g(k), f l, f r
  WHERE k < c.size AND l.lang = c.lang AND r.lang = c.lang
    AND l.phrase = array_to_string(c.w[1:k], ' ') AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, p AS phrase, max(a) AS covered FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS p FROM cand WHERE size = 3)
  GROUP BY lang, p),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN inside i ON s.size = 2 AND i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.phrase IS NULL OR 100 * i.covered < 50 * s.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
    phrase, a, l, r, score FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""
