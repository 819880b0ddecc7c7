"""Repeated passages by a logarithmic family of suffix arrays.

A passage is a string of ``length`` bytes that also starts anywhere else. Suffixes are
sampled: of the k-grams in each window of ``length`` bytes, the one with the least hash
(the leftmost on ties) is the window's anchor. Equal windows have equal anchors at the same
place, so all repeats of a window show as equal k-grams of sampled suffixes, one in about
ninety. Consecutive windows with one anchor are an entry: the hash of its k-gram, which
orders the suffix array (any order does that keeps equal beginnings together), the hash of
the whole stretch that its windows cover, and its place.

Documents come in batches. A batch's entries become a suffix array, cut into buckets of
the order; it is merge-scanned against the arrays of the existing levels, which yields the
entries whose beginning now occurs twice; then levels of equal size merge, geometrically.
Of the entries found, those with equal stretches are settled at once. The others hold
passages that begin or end inside them: their bytes are fetched and the windows compared,
each by its hash. Hashes of 48 bits or more stand for the strings in one bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.llm.batches import Stages, drop_path, released, slices
from tabulark.session import scratch_path

LENGTH, GRAM, BATCHES = 200, 24, 4
# edges of one key that are compared in one place, and of hot keys that are settled at once
HOT_EDGES, HOT_BLOCK = 2_000, 1 << 14
BLOCK_BYTES = 1 << 18
BUCKETS_PER_PARTITION = 8
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACE_BITS = U(20)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


TABLE = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    found = np.ones(max(n, 1), np.uint64)
    have, step = 1, base
    while have < n:
        more = min(have, n - have)
        found[have : have + more] = found[:more] * U(step)
        have += more
        step = step * step % (1 << 64)
    return found


LOW = 1 << 16
#: the first powers; others are one of these times one power of the last
_LOW = {base: powers(base, LOW) for base in (BASE, INVERSE)}


def high_powers(base: int, n: int) -> np.ndarray:
    """Every ``LOW``-th of the first n powers."""
    return powers(pow(base, LOW, 1 << 64), n // LOW + 1)


class Hashes:
    """Hash of any stretch of a byte array, from running sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        for k, high in enumerate(high_powers(BASE, len(data))):
            some = TABLE[data[k * LOW:(k + 1) * LOW]]
            self.sums[k * LOW + 1:k * LOW + 1 + len(some)] = some * (_LOW[BASE][:len(some)] * high)
        np.cumsum(self.sums, out=self.sums)
        self.high = high_powers(INVERSE, len(data))

    def _scaled(self, difference: np.ndarray, start: np.ndarray) -> np.ndarray:
        difference *= _LOW[INVERSE][start & (LOW - 1)]
        if len(self.high) > 1:
            difference *= self.high[start >> 16]
        return mix(difference)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return self._scaled(self.sums[stop] - self.sums[start], start)

    def every(self, length: int) -> np.ndarray:
        """Hash of the stretch of ``length`` bytes at each place."""
        n = len(self.sums) - length
        return self._scaled(self.sums[length:] - self.sums[:n], np.arange(n))


@dataclass
class Entries:
    """Sampled suffixes: order key, stretch hash, document number, first window, windows."""

    key: np.ndarray
    stretch: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray

    FIELDS = (("key", np.uint64), ("stretch", np.uint64), ("doc", np.int64),
              ("start", np.int64), ("count", np.uint8))

    def __len__(self) -> int:
        return len(self.key)

    def take(self, at) -> Entries:
        return Entries(*[getattr(self, f)[at] for f, _ in self.FIELDS])

    @staticmethod
    def join(parts: Sequence[Entries]) -> Entries:
        return Entries(*[
            np.concatenate([np.zeros(0, t), *[getattr(p, f) for p in parts]]).astype(t)
            for f, t in Entries.FIELDS
        ])

    def pack(self) -> bytes:
        """Columns of bytes, the key as differences, compressed."""
        import zstandard

        key = np.diff(self.key, prepend=U(0)) if len(self) else self.key
        columns = [key, *[getattr(self, f) for f, _ in self.FIELDS[1:]]]
        data = b"".join(
            np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns
        )
        return len(self).to_bytes(8, "little") + zstandard.compress(data, 1)

    @staticmethod
    def unpack(block: bytes) -> Entries:
        import zstandard

        n = int.from_bytes(block[:8], "little")
        data = np.frombuffer(zstandard.decompress(block[8:]), np.uint8)
        columns, at = [], 0
        for _, t in Entries.FIELDS:
            width = np.dtype(t).itemsize
            plane = data[at : at + width * n].reshape(width, n)
            columns.append(np.ascontiguousarray(plane.T).view(t).ravel())
            at += width * n
        columns[0] = np.cumsum(columns[0], dtype=np.uint64)
        return Entries(*columns)


def sample_suffixes(texts: list[bytes], docs: np.ndarray, length: int, gram: int) -> Entries:
    """Entries of all windows of the texts, in the order of the texts."""
    parts = []
    block, numbers, size = [], [], 0

    def flush() -> None:
        if block:
            parts.append(_sample(block, np.array(numbers, np.int64), length, gram))

    step = 1 << int(PLACE_BITS) - 1
    for text, doc in zip(texts, docs.tolist()):
        # a very long text comes in pieces that share length - 1 bytes: each window once
        for at in range(0, max(1, len(text) - length + 1), step):
            piece = text[at : at + step + length - 1] if len(text) > step else text
            if len(piece) < length:
                continue
            if block and size + len(piece) > BLOCK_BYTES:
                flush()
                block, numbers, size = [], [], 0
            block.append((piece, at))
            numbers.append(doc)
            size += len(piece)
    flush()
    return Entries.join(parts)


def _sample(block: list[tuple[bytes, int]], docs: np.ndarray, length: int, gram: int) -> Entries:
    data = np.frombuffer(b"".join([b for b, _ in block]), np.uint8)
    sizes = np.array([len(b) for b, _ in block], np.int64)
    ends = np.cumsum(sizes)
    hashes = Hashes(data)
    h = hashes.every(gram)
    packed = (h >> PLACE_BITS << PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    # least over each window of ``span`` grams: doubling, then two that overlap
    span, wide, least = length - gram + 1, 1, packed
    while 2 * wide <= span:
        least = np.minimum(least[: len(least) - wide], least[wide:])
        wide *= 2
    if span > wide:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    anchor = (least & U((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= ends[owner]
    first = np.empty(len(anchor), bool)
    first[0] = True
    first[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(first & inside)
    last = np.empty(len(anchor), bool)
    last[-1] = True
    last[:-1] = first[1:] | ~inside[1:]
    stop = np.flatnonzero(last & inside)
    own = owner[start]
    count = stop - start + 1
    place = anchor[start] - start
    key = mix(h[anchor[start]] ^ U(0xA0761D6478BD642F)) >> U(16)
    whole = hashes.of(start, stop + length)
    stretch = mix(whole ^ (place.astype(np.uint64) << U(32)) ^ count.astype(np.uint64)) >> U(16)
    base = (ends - sizes)[own] - np.array([at for _, at in block], np.int64)[own]
    return Entries(
        key, stretch, docs[own], start - base, count.astype(np.uint8)
    )


class SuffixLevels:
    """The index family: levels of packed suffix arrays, by bucket, in the shared folder."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM):
        if not 1 <= gram <= length or length - gram >= 255:
            raise ValueError("a gram of at most length, and fewer than 256 grams in a passage")
        self.spark, self.length, self.gram = spark, length, gram
        self.partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = self.partitions * BUCKETS_PER_PARTITION
        self.levels: list[tuple[int, str]] = []  # (batches in it, path), the largest first
        self.found: list[str] = []

    def _read(self, path: str, kind: str) -> DataFrame:
        """One kind of blocks of a scan's files, which may have none."""
        files = self.spark.read.schema("kind string, bucket int, block binary").parquet(path)
        return files.where(F.col("kind") == kind)

    def _arrays(self, docs: DataFrame) -> DataFrame:
        """``level, bucket, block`` of new documents (level -1)."""
        length, gram, buckets = self.length, self.gram, self.buckets

        @released
        def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text", 4 << 20):
                texts = [t or b"" for t in part.column("text").to_pylist()]
                e = sample_suffixes(texts, part.column("number").to_numpy(), length, gram)
                # equal parts of the key's range: buckets in the order of the array
                bucket = (e.key >> U(16)) * U(buckets) >> U(32)
                order = np.lexsort((e.key, bucket))
                e, bucket = e.take(order), bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                used = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), -1, np.int32)), pa.array(used.astype(np.int32)),
                     pa.array([e.take(slice(edges[k], edges[k + 1])).pack() for k in used.tolist()],
                              pa.binary())],
                    ["level", "bucket", "block"],
                )

        return docs.mapInArrow(sample, "level int, bucket int, block binary")

    def add(self, docs: DataFrame) -> None:
        """Index a batch: ``number`` (one for each row), ``text`` (binary)."""
        plan, size, merged = self.levels, 1, 0
        while merged < len(plan) and plan[-1 - merged][0] == size:
            size, merged = size * 2, merged + 1
        keep = len(plan) - merged  # levels below this one stay, the rest merge with the batch
        dealt = self._arrays(docs)
        for k, (_, path) in enumerate(plan):
            level = self._read(path, "level").select(F.lit(k).alias("level"), "bucket", "block")
            dealt = dealt.union(level)
        dealt = dealt.repartition(self.partitions, "bucket").sortWithinPartitions("bucket")

        def scan_bucket(bucket: int, blocks: list[tuple[int, bytes]]) -> pa.RecordBatch:
            parts = [(k, Entries.unpack(b)) for k, b in blocks]
            e = Entries.join([p for _, p in parts])
            level = np.repeat([k for k, _ in parts], [len(p) for _, p in parts])
            # merge-scan: the arrays are sorted runs; equal beginnings become neighbours
            order = np.argsort(e.key, kind="stable")
            e, level = e.take(order), level[order]
            first = np.flatnonzero(np.concatenate(([True], e.key[1:] != e.key[:-1])))
            sizes = np.diff(np.append(first, len(e)))
            old = level >= 0
            before = np.repeat(np.add.reduceat(old.astype(np.int64), first), sizes)
            # two old ones have been found when the later of them came
            hit = e.take((np.repeat(sizes > 1, sizes)) & (~old | (before == 1)))
            rows = [("level", e.take((level >= keep) | ~old)), ("found", hit)]
            out = [(k, bucket, x.pack()) for k, x in rows if len(x)]
            return pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.int32()),
                 pa.array([o[2] for o in out], pa.binary())],
                ["kind", "bucket", "block"],
            )

        @released
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, blocks = None, []
            for batch in batches:
                for level, bucket, block in zip(*[c.to_pylist() for c in batch.columns]):
                    if bucket != current and blocks:
                        yield scan_bucket(current, blocks)
                        blocks = []
                    current = bucket
                    blocks.append((level, block))
            if blocks:
                yield scan_bucket(current, blocks)

        path = scratch_path(self.spark, "level")
        scanned = dealt.mapInArrow(scan, "kind string, bucket int, block binary")
        scanned.write.partitionBy("kind").parquet(path)
        self.levels = [*plan[:keep], (size, path)]
        self.found.append(path)

    def drop(self) -> None:
        """Remove the family's files."""
        for path in self.found:
            drop_path(self.spark, path)
        self.levels, self.found = [], []

    def matches(self) -> DataFrame:
        """``key, stretch, number, start, count``: entries whose beginning occurs twice, each
        once, as the scans have found them."""
        @released
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.column("block"):
                    e = Entries.unpack(block.as_buffer().to_pybytes())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(e.key.view(np.int64)), pa.array(e.stretch.view(np.int64)),
                         pa.array(e.doc), pa.array(e.start), pa.array(e.count.astype(np.int64))],
                        ["key", "stretch", "number", "start", "count"],
                    )

        schema = "key long, stretch long, number long, start long, count long"
        found = None
        for path in self.found:
            one = self._read(path, "found").select("block").mapInArrow(rows, schema)
            found = one if found is None else found.union(one)
        return found if found is not None else self.spark.createDataFrame([], schema)


def union_spans(spans: np.ndarray) -> np.ndarray:
    """Sorted disjoint spans (start, stop) that cover the same bytes; touching ones join."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    stop = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > stop[:-1])))
    return np.stack((spans[first, 0], stop[np.append(first[1:], len(spans)) - 1]), axis=1)


def cut_spans(text: bytes, spans: np.ndarray) -> bytes:
    """What is left of a text without the disjoint spans."""
    parts, at = [], 0
    for start, stop in spans.tolist():
        parts.append(text[at:start])
        at = stop
    parts.append(text[at:])
    return b"".join(parts)


def whole_characters(text: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans shrunk to whole UTF-8 characters, so that what is left stays text."""
    found = []
    for start, stop in spans.tolist():
        while start < stop and text[start] & 0xC0 == 0x80:
            start += 1
        while stop > start and stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop -= 1
        if stop > start:
            found.append((start, stop))
    return np.array(found, np.int64).reshape(-1, 2)


def result(text: bytes, spans: np.ndarray, with_text: bool) -> tuple:
    spans = union_spans(spans)
    removed = int((spans[:, 1] - spans[:, 0]).sum())
    kept = cut_spans(text, spans) if removed else text
    row = (len(text), removed, len(spans), hashlib.sha256(kept).hexdigest())
    if with_text:
        clean = cut_spans(text, whole_characters(text, spans)) if removed else text
        row += (clean.decode("utf-8", "replace"),)
    return row


def window_hashes(texts: list[bytes], length: int):
    """Hash of each window of ``length`` bytes of the texts, its text and its place there."""
    sizes = np.array([len(x) for x in texts], np.int64)
    count = np.maximum(sizes - length + 1, 0)
    hashes = Hashes(np.frombuffer(b"".join(texts), np.uint8))
    owner = np.repeat(np.arange(len(texts)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = (np.cumsum(sizes) - sizes)[owner] + within
    return hashes.of(at, at + length), owner, within


def shared_runs(
    hit: np.ndarray, owner: np.ndarray, within: np.ndarray, number: np.ndarray, start: np.ndarray,
    length: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, start, stop) of the runs of neighbouring windows of one text that are hit."""
    same = owner[1:] == owner[:-1]
    begin = hit & ~np.concatenate(([False], hit[:-1] & same))
    end = hit & ~np.concatenate((hit[1:] & same, [False]))
    first, last = np.flatnonzero(begin), np.flatnonzero(end)
    own = owner[first]
    return number[own], start[own] + within[first], start[own] + within[last] + length


DEALT = pa.schema([
    ("key", pa.int64()), ("number", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
    ("alone", pa.bool_()), ("text", pa.binary()),
])


def hot_windows(asked: list[tuple], length: int) -> pa.RecordBatch:
    """Edges of hot keys (number, start, alone, text) as rows of ``DEALT``. A window that comes
    here more than once is settled for the single entries among its places (rows with a stop);
    each window goes on as one row, dealt by its hash, to meet those of other tasks."""
    *known, texts = zip(*asked)
    number, start, alone = (np.array(v) for v in known)
    h, owner, within = window_hashes(texts, length)
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
    sizes = np.diff(np.append(first, len(h)))
    hit = np.zeros(len(h), bool)
    hit[order] = np.repeat(sizes > 1, sizes)
    settled = shared_runs(hit & alone[owner], owner, within, number, start, length)
    lead = order[first]
    own, n = owner[lead], len(settled[0])
    columns = [
        np.concatenate((settled[0], h[lead].view(np.int64))),
        np.concatenate((settled[0], number[own])),
        np.concatenate((settled[1], start[own] + within[lead])),
        pa.array(np.append(settled[2], np.zeros(len(lead), np.int64)), mask=np.arange(n + len(lead)) >= n),
        np.concatenate((np.zeros(n, bool), alone[own] & (sizes == 1))),
        pa.nulls(n + len(lead), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=DEALT)


def pairs_of(column: pa.Array, i: int) -> np.ndarray:
    """A list of (start, stop) structs as an array."""
    v = column[i]
    if not v.is_valid or not len(v.values):
        return np.zeros((0, 2), np.int64)
    return np.stack((v.values.field("start").to_numpy(), v.values.field("stop").to_numpy()), axis=1)


@released
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the texts, the last column, before they are shuffled."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for part in slices(batches, "text", 8 << 20):
        texts = pa.array([press.compress(t) for t in part.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], part.schema.names)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    batches: int = BATCHES, keep: Sequence[str] = (), with_text: bool = False,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; with ``with_text`` also
    ``kept_text`` (only whole characters are cut there), and the columns named in ``keep``.

    Removed is each UTF-8 byte that is covered by a string of ``length`` bytes that also
    starts anywhere else in the input, the same text included. A null text counts as
    empty and keeps a null ``kept_text``. Rows are known by id, or by a hash of id and
    text where ids repeat with other texts or are null; repeated rows are repeats of each
    other. ``batches`` are indexed one after the other; they change the cost, not the result. Keys of more than ``hot_edges`` edges (a passage
    in as many different surroundings) are compared window by window as rows dealt by the
    window, which a task sends once for each block of its edges, others by the bytes of all
    their edges in one place, with the same result.
    """
    spark = docs.sparkSession
    raw = F.col(text_col).cast("binary")
    named = docs.select(
        F.col(id_col).alias("id"), F.coalesce(raw, F.lit(b"")).alias("text"),
        F.col(text_col).isNull().alias("none"),
        *[F.col(c).alias(f"kept{k}") for k, c in enumerate(keep)],
    )
    clashes = (
        named.select("id", F.xxhash64("text").alias("h")).groupBy("id")
        .agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b OR id IS NULL").limit(1)
    )
    integral = docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    plain = integral and not clashes.count()
    number = F.col("id").cast("long") if plain else F.xxhash64("id", "text")
    rows = named.withColumn("number", number).select(
        "number", "id", "none", *[f"kept{k}" for k in range(len(keep))], "text"
    )
    fields = [(f.name, f.dataType.simpleString()) for f in rows.schema]

    index = SuffixLevels(spark, length)
    share = F.pmod(F.xxhash64(F.lit("batch"), "number"), F.lit(batches))
    for k in range(batches):
        index.add(rows.where(share == k).select("number", "text"))
    stages = Stages(spark)
    found = stages.write(index.matches(), "matches")
    index.drop()

    same = stages.write(
        found.groupBy("key", "stretch").agg(
            F.count("*").alias("c"), F.min(F.struct("number", "start", "count")).alias("first")
        ),
        "stretches",
    )
    # edges of one key are compared in one place, unless there are many of them
    kinds = same.groupBy("key").agg(
        F.count("*").alias("edges"), F.max((F.col("c") == 1).cast("int")).alias("single")
    ).where("single = 1").select("key", (F.col("edges") > hot_edges).alias("hot"))
    edges = stages.write(same.join(kinds, "key").select(
        "key", "first.*", (F.col("c") == 1).alias("alone"), "hot"
    ), "edges")
    settled = found.join(same.where("c > 1").select("key", "stretch"), ["key", "stretch"]).select(
        "number", "start", (F.col("start") + F.col("count") + length - 1).alias("stop")
    )
    packed = rows.mapInArrow(_pack, ", ".join(f"{n} {t}" for n, t in fields))
    asked = F.collect_list(F.struct("key", "start", "count", "alone", "hot")).alias("edges")
    wanted = edges.groupBy("number").agg(asked)

    @released
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of each edge; of hot keys its windows, as rows."""
        import zstandard

        for part in slices(batches, "text", 4 << 20):
            cold, hot = [], []
            columns = [part.column(c).to_pylist() for c in ("text", "number", "edges")]
            for packed, number, edges in zip(*columns):
                text = zstandard.decompress(packed) if edges else b""
                for e in edges or ():
                    piece = text[e["start"] : e["start"] + e["count"] + length - 1]
                    if e["hot"]:
                        hot.append((number, e["start"], e["alone"], piece))
                    else:
                        cold.append((e["key"], number, e["start"], None, e["alone"], piece))
            if cold:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(zip(*cold), DEALT)], schema=DEALT
                )
            for k in range(0, len(hot), HOT_BLOCK):
                yield hot_windows(hot[k : k + HOT_BLOCK], length)

    # the same join side as at the end, all columns of it: Spark shuffles the texts once
    edge_rows = packed.join(wanted, "number", "left").mapInArrow(
        fetch, "key long, number long, start long, stop long, alone boolean, text binary"
    )
    dealt = (
        edge_rows.withColumn("bucket", F.pmod("key", F.lit(index.buckets)))
        .repartition(index.partitions, "bucket").sortWithinPartitions("bucket")
    )

    def windows(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        """Runs of windows of single entries that occur in another entry of the bucket, and
        those that are settled."""
        t = pa.Table.from_batches(parts)
        number, start = (t.column(c).to_numpy() for c in ("number", "start"))
        done = t.column("stop").is_valid().to_numpy()
        row = np.flatnonzero(t.column("text").is_null().to_numpy() & ~done)
        h, owner, within = window_hashes([x or b"" for x in t.column("text").to_pylist()], length)
        h = np.concatenate((h, t.column("key").to_numpy()[row].view(np.uint64)))
        owner = np.concatenate((owner, row))
        within = np.concatenate((within, np.zeros(len(row), np.int64)))
        order = np.argsort(h, kind="stable")
        s = h[order]
        same = s[1:] == s[:-1]
        hit = np.zeros(len(h), bool)
        if len(h):
            hit[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
        hit &= t.column("alone").to_numpy()[owner]
        found = shared_runs(hit, owner, within, number, start, length) if len(h) else ([], [], [])
        stop = t.column("stop").filter(pa.array(done)).to_numpy()
        settled = number[done], start[done], stop
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(v).astype(np.int64)) for v in zip(found, settled)],
            ["number", "start", "stop"],
        )

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for a, b in zip(cut, cut[1:]):
                if a == b:
                    continue
                if bucket[a] != current and held:
                    yield windows(held)
                    held = []
                current = bucket[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield windows(held)

    more = dealt.mapInArrow(compare, "number long, start long, stop long")
    spans = settled.union(more).groupBy("number").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    carried = [f for f in fields if f[0] not in ("number", "text")]
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
    types = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", kept_text string" if with_text else ""
    )

    @released
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for part in slices(batches, "text", 4 << 20):
            spans = part.column("spans")
            found = [
                result(zstandard.decompress(t), pairs_of(spans, i), with_text)
                for i, t in enumerate(part.column("text").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c, _ in carried],
                 *[pa.array(v, pa.int64() if j < 3 else pa.string())
                   for j, v in enumerate(zip(*found))]],
                [*[c for c, _ in carried], *names],
            )

    head = ", ".join(f"{n} {t}" for n, t in carried)
    finished = packed.join(spans, "number", "left").mapInArrow(finish, f"{head}, {types}")
    out = [F.col("id").alias(id_col), *[F.col(f"kept{k}").alias(c) for k, c in enumerate(keep)]]
    text = F.when(~F.col("none"), F.col("kept_text")).alias("kept_text") if with_text else None
    return finished.select(*out, *names[:4], *([text] if with_text else []))
