"""Mined phrases against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tabulark.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, phrase string, n long"


def brute(rows, frequent=10, inside=50, reported=2000):
    counts, total = defaultdict(Counter), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i:i + size])] += 1
    out = []
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= frequent}
        kept = []
        for p, a in some.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= inside * a for q, b in some.items()):
                continue
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:reported], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [rng.choice("abcdeÉß") * rng.randint(1, 3) + rng.choice("xyzÀ") for _ in range(40)]
    phrases = [" ".join(rng.sample(vocabulary, 3)) for _ in range(12)]
    rows = []
    for i in range(n):
        words = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", ",", " "]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", None]), "p", 1))
    return [*rows, (n, None, "en", None, None), (n, "", "xx", None, None), (n, " . ", None, None, None), rows[0]]


@pytest.mark.parametrize("one_in, least", [(2, 2), (50, 1), (1, 1), (10**9, 1)])
def test_equal_to_plain_counts_whatever_the_sample_holds(spark, one_in, least):
    rows = corpus(5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = C.mine_collocations(df, sample_one_in=one_in, sample_frequent=least).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert [*got[0].asDict()] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_full_bitsets_only_count_more(spark, monkeypatch):
    monkeypatch.setattr(C, "LEAST_BITS", 64)
    monkeypatch.setattr(C, "MOST_BITS", 64)
    rows = corpus(6, 150)
    got = C.mine_collocations(spark.createDataFrame(rows, SCHEMA), sample_one_in=20).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_cut_and_report(spark):
    rows = [(i, "New York City. new york", "en", None, None) for i in range(12)]
    rows += [(i, "york city", "en", None, None) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, C.mine_collocations(df).collect())) == brute(rows)
    assert sorted(map(tuple, C.mine_collocations(df, reported=1).collect())) == brute(rows, reported=1)
    # new york (24) is not covered by new york city (12 of 24 is half of it): it is
    assert "new york" not in {r.phrase for r in C.mine_collocations(df).collect()}


def test_products_beyond_64_bits(spark):
    big = 3 * 10**12
    df = spark.createDataFrame([(big, big + 1, big + 7)], "a long, l long, r long")
    got = df.select(C._score(df.a, df.l, df.r).alias("s")).first().s
    assert got == 10**6 * big * big // ((big + 1) * (big + 7))


def test_empty_table(spark):
    assert C.mine_collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_words_of_a_slice():
    words = C.Words(["Ab  cD.e\tf", "", "g"])
    got = [words.dictionary[int(c)].as_py() for c in words.codes]
    assert got == ["ab", "cd", "e", "f", "g"]
    assert [words.piece[i] == words.piece[i + 1] for i in range(4)] == [True, False, True, False]
    assert len(C.Words([""])) == 0
