"""N-gram Jaccard join by PartEnum signatures.

A text's set are its distinct five-word shingles, hashed to 64 bits. Sets are put into
size bands, each with its own partitions of the hash range, and a signature is a set's
non-empty projection on a subset of them. Take two sets A, B with |A| <= |B| and Jaccard
similarity >= 3/4, in the band of A; they differ in at most (|A| + |B|) / 7 elements.

- In bands of smaller sets, subsets are single partitions. Each element of A without B
  empties a partition of the intersection at most, and each difference spoils one, so at
  least filled(A) - 2|A without B| - |B without A| >= filled(A) - 3|A|/7 filled partitions
  are the same in both. A and B share a signature if A fills more than 3|A|/7 of them.
- In bands of larger sets each partition has three parts, and subsets are two parts of one
  partition. As A and B differ in |A|/3 elements or fewer, at most |A|/6 partitions hold
  two differences. In any other, two parts avoid the one difference; they are not empty in
  A if at most one of the three is. A and B share a signature if A has more than |A|/6
  such partitions. Texts that only share a passage rarely meet here.

The number of partitions is chosen so that every set of a band meets its condition; that
is checked for each set beforehand, and the least of a few margins that fits all of them
is taken. Sets of up to SMALL shingles have each shingle as a signature. No pair is lost.

A set as large as 4/3 of a band's upper end or less also takes part in the band below.

Sets that share a signature form a run; each distinct member list travels on once. Pairs
are bounded by parity bitmaps before they are compared: each differing element flips one
bit, so the bitmaps' distance never exceeds the sets'. Compared are first the pairs of
each member with the least and with a drawn member of its run and, taking these as links for the time being, pairs
of a run that they leave apart; then, where the exact comparison undid such a link, the
pairs of a component of the time being that are still apart. Pairs within one component are never enumerated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.llm.batches import broadcast_if_small, released, slices
from tabulark.llm.components import connected_components
from tabulark.session import stage_table

WORDS = 5
MARGINS = (0.8, 1.0, 1.5, 2.5)  # partitions beyond the mean need
SMALL = 64  # the largest set whose shingles are its signatures
PAIRED = 700  # upper ends of bands beyond this have subsets of two parts
WORDS_BITS = 8  # short parity bitmap: longs
SIG_BYTES = 4  # of a signature, beside its bucket; a false meeting costs a comparison
MAX_BROADCAST_IDS = 100_000
U = np.uint64
POWERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xA0761D6478BD642F], np.uint64,
)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(text: str | bytes | None) -> np.ndarray:
    """Sorted distinct shingle hashes: of A-Z lower-cased words between ASCII white space;
    a text with fewer words than a shingle has its whole sequence as one."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    data = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    words = data.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(digest, words), np.uint64, n)
    if n < WORDS:
        whole = (h * POWERS[:n]).sum(dtype=np.uint64) + U(n)
        return mix(np.array([whole], np.uint64))
    last = n - WORDS + 1
    total = h[:last] * POWERS[0]
    for k in range(1, WORDS):
        total += h[k : k + last] * POWERS[k]
    found = np.sort(mix(total))
    keep = np.empty(last, bool)
    keep[0] = True
    np.not_equal(found[1:], found[:-1], out=keep[1:])
    return found[keep]


def set_key(found: np.ndarray) -> int:
    """64-bit hash that names a set (signed)."""
    import xxhash

    return xxhash.xxh3_64_intdigest(found.tobytes(), len(found)) - (1 << 63)


def parity(found: np.ndarray, bits: int) -> bytes:
    """Bitmap, of a power of two of bits, in which each element flips one."""
    odd = np.bincount((found & U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((odd & 1).astype(np.uint8)).tobytes()


def long_parity(found: np.ndarray) -> bytes:
    """Bitmap of one to two bits for each element."""
    return parity(found, max(64, 1 << (max(len(found), 1) - 1).bit_length()))


def band_ends() -> list[int]:
    """Upper ends of the size bands; each is 16/9 of the one before."""
    ends, r = [], SMALL
    while r < 1 << 40:
        r = r * 16 // 9
        ends.append(r)
    return ends


ENDS = np.array(band_ends())


def parts_of(end: np.ndarray, margin: float) -> np.ndarray:
    """Parts of the hash range in a band, enough for sets up to its upper end: partitions
    of their own, or three to a partition."""
    one = 0.545 * end + margin * 3.0 * np.sqrt(np.minimum(end, 200))
    three = 3 * np.ceil(0.185 * end + margin * np.sqrt(end))
    return np.ceil(np.where(end > PAIRED, three, one)).astype(np.int64)


def memberships(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, band) for each band a set takes part in; band -1 is that of small sets."""
    rows = np.arange(len(sizes))
    band = np.searchsorted(ENDS, sizes)
    big = sizes > SMALL
    below = np.where(band > 0, ENDS[np.maximum(band - 1, 0)], SMALL)
    # as the larger of a pair: its partner may have 3/4 of its size
    lower = big & (3 * sizes <= 4 * below)
    small = sizes <= SMALL
    parts = [
        (rows[small], np.full(small.sum(), -1)),
        (rows[big], band[big]),
        (rows[lower], band[lower] - 1),
    ]
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(2))


def fitting(found: np.ndarray) -> int:
    """Bit k is set if, with MARGINS[k], the set meets the condition of its own band."""
    n = len(found)
    if n <= SMALL:
        return (1 << len(MARGINS)) - 1
    end = ENDS[np.searchsorted(ENDS, n)]
    fits = 0
    for k, margin in enumerate(MARGINS):
        part = ((found >> U(32)) * U(int(parts_of(end, margin)))) >> U(32)
        part = part[np.concatenate(([True], part[1:] != part[:-1]))]
        if end > PAIRED:
            _, filled = np.unique_counts(part // U(3))
            fits |= (int((filled > 1).sum()) > n // 6) << k
        else:
            fits |= (len(part) > 3 * n // 7) << k
    return fits


def signatures(sets: list[np.ndarray], margin: float):
    """(signature, index of its set) of non-empty sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    row, band = memberships(sizes)
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    count = sizes[row]
    ends = np.cumsum(count)
    at = np.arange(int(ends[-1])) + np.repeat(starts[row] - (ends - count), count)
    which = np.repeat(np.arange(len(row)), count)
    salt = mix((band + 7).astype(np.uint64) * POWERS[4])
    single = (band < 0)[which]
    own = which[single]
    found = [mix(mix(flat[at[single]] + POWERS[1]) ^ salt[own])]
    owner = [row[own]]
    x, which = flat[at[~single]], which[~single]
    if len(x):
        end = ENDS[np.maximum(band, 0)]
        parts = parts_of(end, margin)
        part = ((x >> U(32)) * parts.astype(np.uint64)[which]) >> U(32)  # sorted sets: runs
        first = np.flatnonzero(np.concatenate(
            ([True], (which[1:] != which[:-1]) | (part[1:] != part[:-1]))
        ))
        sums = np.add.reduceat(mix(x + POWERS[1]), first)
        w, part = which[first], part[first].astype(np.int64)
        alone = end[w] <= PAIRED
        place = part[alone].astype(np.uint64) * POWERS[2]
        found.append(mix(mix(sums[alone] + POWERS[0]) ^ salt[w[alone]] ^ place))
        owner.append(row[w[alone]])
        sums, w, part = sums[~alone], w[~alone], part[~alone]
        cell = part // 3
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (cell[1:] != cell[:-1])
        group = np.cumsum(new) - 1
        three = np.zeros((int(new.sum()), 3), np.uint64)
        three[group, part % 3] = sums
        has = np.zeros(three.shape, bool)
        has[group, part % 3] = True
        w, cell = w[new], cell[new].astype(np.uint64)
        for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
            fine = has[:, i] | has[:, j]
            both = mix(three[fine, i] + POWERS[0]) + three[fine, j]
            place = (cell[fine] * U(3) + U(k)) * POWERS[2]
            found.append(mix(both ^ salt[w[fine]] ^ place))
            owner.append(row[w[fine]])
    return np.concatenate(found), np.concatenate(owner)


def describe_sets(docs: DataFrame) -> DataFrame:
    """``id, n, key, fits, bits, b0..`` of every row: set size, set name (null if empty),
    margins that fit, long and short parity bitmap."""

    @released
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            short = b"".join([parity(s, 64 * WORDS_BITS) for s in sets])
            short = np.frombuffer(short, np.int64).reshape(-1, WORDS_BITS)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([fitting(s) for s in sets], pa.int64()),
                 pa.array([np.frombuffer(long_parity(s), np.int64) for s in sets], pa.list_(pa.int64())),
                 *[pa.array(np.ascontiguousarray(short[:, k])) for k in range(WORDS_BITS)]],
                ["id", "n", "key", "fits", "bits", *[f"b{k}" for k in range(WORDS_BITS)]],
            )

    id_type = docs.schema["id"].dataType.simpleString()
    longs = ", ".join(f"b{k} long" for k in range(WORDS_BITS))
    return docs.mapInArrow(
        describe, f"id {id_type}, n long, key long, fits long, bits array<long>, {longs}"
    )


def signature_blocks(docs: DataFrame, buckets: int, margin: float) -> DataFrame:
    """``bucket, block``: the signatures of a stretch of rows by bucket, as arrays. A task
    gives each distinct set once, so copies hardly add to the shuffle."""

    @released
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sets: list[np.ndarray] = []
        keys: list[int] = []
        size = 0

        def block() -> pa.RecordBatch:
            sig, owner = signatures(sets, margin)
            bucket = (sig % U(buckets)).astype(np.int32)
            order = np.lexsort((owner, bucket))
            sig, owner, bucket = sig[order] // U(buckets), owner[order], bucket[order]
            names = np.array(keys, np.int64)
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for k in np.flatnonzero(np.diff(edges)):
                # in the order of their sets: (set, how many) and the signatures' low bytes
                own = owner[edges[k] : edges[k + 1]]
                used = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                many = np.diff(np.append(used, len(own))).astype(np.int32)
                low = sig[edges[k] : edges[k + 1]].view(np.uint8).reshape(-1, 8)[:, :SIG_BYTES]
                rows.append((int(k), b"".join((
                    len(used).to_bytes(4, "little"), names[own[used]].tobytes(), many.tobytes(),
                    low.tobytes(),
                ))))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.binary())],
                ["bucket", "block"],
            )

        for part in slices(batches, "text"):
            for text in part.column("text").to_pylist():
                found = shingles(text)
                if not len(found):
                    continue
                key = set_key(found)
                if key in seen:
                    continue
                seen.add(key)
                sets.append(found)
                keys.append(key)
                size += len(found)
                if size > 1 << 20 or len(sets) == 1 << 16:
                    yield block()
                    sets, keys, size = [], [], 0
        if sets:
            yield block()

    return docs.select("text").mapInArrow(emit, "bucket int, block binary")


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(signature, key) of a block."""
    used = int.from_bytes(block[:4], "little")
    names = np.frombuffer(block, np.int64, used, 4)
    many = np.frombuffer(block, np.int32, used, 4 + 8 * used)
    low = np.frombuffer(block, np.uint8, offset=4 + 12 * used).reshape(-1, SIG_BYTES)
    sig = np.zeros((len(low), 8), np.uint8)
    sig[:, :SIG_BYTES] = low
    return sig.view(np.uint64).ravel(), np.repeat(names, many)


def runs_of(blocks: DataFrame) -> DataFrame:
    """``run, key, pivot``: the sets that share a signature with another one. A run is
    named by its member list and given once by each task; pivot is its least member."""

    def runs(buffers: list[bytes], given: set[int]) -> pa.RecordBatch | None:
        parts = [unpack(b) for b in buffers]
        sig = np.concatenate([p[0] for p in parts])
        key = np.concatenate([p[1] for p in parts])
        # only signatures that occur twice are sorted with their keys
        order = np.argsort(sig, kind="stable")
        s = sig[order]
        same = s[1:] == s[:-1]
        keep = np.concatenate((same, [False])) | np.concatenate(([False], same))
        order, s = order[keep], s[keep]
        if not len(s):
            return None
        k = key[order]
        order = np.lexsort((k, s))
        s, k = s[order], k[order]
        again = np.concatenate(([False], (s[1:] == s[:-1]) & (k[1:] == k[:-1])))
        s, k = s[~again], k[~again]
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        sizes = np.diff(np.append(first, len(s)))
        name = mix(np.add.reduceat(mix(k.view(np.uint64) + POWERS[3]), first))
        pick = []
        for i in np.flatnonzero(sizes > 1).tolist():
            n = int(name[i])
            if n not in given:
                given.add(n)
                pick.append(i)
        if not pick:
            return None
        sizes = sizes[pick]
        stop = np.cumsum(sizes)
        at = np.arange(int(stop[-1])) + np.repeat(first[pick] - (stop - sizes), sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(name[pick], sizes).view(np.int64)), pa.array(k[at]),
             pa.array(np.repeat(k[first[pick]], sizes))],
            ["run", "key", "pivot"],
        )

    @released
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        current, buffers = None, []
        for batch in batches:
            for bucket, block in zip(
                batch.column("bucket").to_pylist(), batch.column("block").to_pylist()
            ):
                if bucket != current and buffers:
                    if (found := runs(buffers, given)) is not None:
                        yield found
                    buffers = []
                current = bucket
                buffers.append(block)
        if buffers and (found := runs(buffers, given)) is not None:
            yield found

    return blocks.mapInArrow(find, "run long, key long, pivot long")


def likely(a: str, b: str) -> Column:
    """Exact bound: false only for pairs below the similarity. Columns x.n, x.b0.., x.bits;
    the long bitmap counts where the short one is not enough."""
    flips = sum(
        (F.bit_count(F.col(f"{a}.b{k}").bitwiseXOR(F.col(f"{b}.b{k}"))) for k in range(WORDS_BITS)),
        F.lit(0),
    )
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    x, y = F.col(f"{a}.bits"), F.col(f"{b}.bits")

    def folded(bits: Column) -> Column:
        """Half as long, by the exclusive or of its halves."""
        half = F.floor(F.size(bits) / 2).cast("int")
        return F.zip_with(
            F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda p, q: p.bitwiseXOR(q)
        )

    def distance(p: Column, q: Column) -> Column:
        both = F.zip_with(p, q, lambda v, w: F.bit_count(v.bitwiseXOR(w)))
        return F.aggregate(both, F.lit(0), lambda total, v: total + v)

    # sizes within 4/3 of each other: widths are equal or one is twice the other
    far = (
        F.when(F.size(x) == F.size(y), distance(x, y))
        .when(F.size(x) > F.size(y), distance(folded(x), y))
        .otherwise(distance(x, folded(y)))
    )
    sizes = (3 * n <= 4 * m) & (3 * m <= 4 * n)
    return sizes & (7 * flips <= n + m) & (7 * far <= n + m)


def described(classes: DataFrame) -> DataFrame:
    return classes.select("key", "n", "bits", *[f"b{k}" for k in range(WORDS_BITS)])


def bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of set names that their bitmaps leave possible."""
    a, b = described(classes).alias("x"), described(classes).alias("y")
    both = pairs.join(a, F.col("a") == F.col("x.key")).join(b, F.col("b") == F.col("y.key"))
    return both.where(likely("x", "y")).select("a", "b")


def packed_texts(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, packed``: one compressed text of each of the named sets. That of a class
    without any id is found by its name among the rows without one."""
    import zstandard

    wanted = stage_table(classes.join(keys, "key", "left_semi").select("rep").distinct(), "wanted")
    nameless = wanted.where("rep IS NULL").count()
    wanted = broadcast_if_small(wanted.where("rep IS NOT NULL"), MAX_BROADCAST_IDS)

    @released
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for part in slices(batches, "text"):
            texts = [(t or "").encode("utf-8", "replace") for t in part.column("text").to_pylist()]
            found = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) if len(s) else None for s in found], pa.int64()),
                 pa.array([press.compress(t) for t in texts], pa.binary())],
                ["key", "packed"],
            )

    schema = "key long, packed binary"
    few = docs.join(wanted, docs["id"] == wanted["rep"], "left_semi").select("text")
    packed = few.mapInArrow(pack, schema)
    if nameless:
        open_ = classes.where("rep IS NULL").join(keys, "key", "left_semi").select("key")
        others = docs.where("id IS NULL").select("text").mapInArrow(pack, schema)
        packed = packed.union(others.join(open_, "key", "left_semi"))
    return packed.dropDuplicates(["key"])


def exact_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of set names whose sets link: 100 * intersection >= 75 * union."""

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            keep, last, a = [], None, None
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                if x != last:
                    last, a = x, shingles(zstandard.decompress(x))
                b = shingles(zstandard.decompress(y))
                small, large = (a, b) if len(a) <= len(b) else (b, a)
                place = np.searchsorted(large, small)
                place[place == len(large)] = 0
                both = int((large[place] == small).sum())
                keep.append(100 * both >= 75 * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("key").alias("a"), F.col("packed").alias("x"))
    right = texts.select(F.col("key").alias("b"), F.col("packed").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        compare, "a long, b long"
    )


def unsettled(members: DataFrame, classes: DataFrame, group: str) -> DataFrame:
    """The members, described, of groups that hold several components."""
    spread = members.groupBy(group).agg(
        F.min("component").alias("p"), F.max("component").alias("q")
    )
    return members.join(spread.where("p <> q").select(group), group).join(
        described(classes), "key"
    )


def apart(members: DataFrame, classes: DataFrame, group: str) -> DataFrame:
    """Pairs (a, b) of one ``group`` whose ``component`` differs and which the bitmaps leave
    possible. Groups of one component are left out before the join."""
    open_ = unsettled(members, classes, group)
    x, y = open_.alias("x"), open_.alias("y")
    on = (
        (F.col(f"x.{group}") == F.col(f"y.{group}")) & (F.col("x.key") < F.col("y.key"))
        & (F.col("x.component") != F.col("y.component")) & likely("x", "y")
    )
    return x.join(y, on).select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()


def drawn_stars(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member with one drawn member of its run, in another component,
    which the bitmaps leave possible: a member of a large group of near copies meets many
    of them, one in each run, and so nearly always finds the group."""
    open_ = unsettled(members, classes, "run")
    columns = [c for c in open_.columns if c != "run"]
    drawn = open_.groupBy("run").agg(
        F.min_by(F.struct(*columns), F.xxhash64("run", "key")).alias("one")
    )
    x, y = open_.alias("x"), drawn.select("run", "one.*").alias("y")
    on = (
        (F.col("x.run") == F.col("y.run")) & (F.col("x.component") != F.col("y.component"))
        & likely("x", "y")
    )
    return x.join(y, on).select(
        F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")
    ).distinct()


def joined_components(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members with the components that further links (a, b) between them join."""
    place = members.select("key", "component").distinct()
    ends = links.join(place.toDF("a", "ca"), "a").join(place.toDF("b", "cb"), "b")
    roots = connected_components(ends, "ca", "cb").toDF("component", "_root")
    return members.join(roots, "component", "left").withColumn(
        "component", F.coalesce("_root", "component")
    ).drop("_root")


def with_component(runs: DataFrame, links: DataFrame, name: str) -> DataFrame:
    parts = connected_components(links).select(F.col("id").alias("key"), F.col("component").alias(name))
    return runs.join(parts, "key", "left").withColumn(name, F.coalesce(name, "key"))


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` of every row.

    Rows link when 100 * intersection >= 75 * union of their shingle sets; component_id
    is the least id reachable by links, itself included. Equal sets are one class with
    its least id, and only classes are compared. A null or empty text, or one of white
    space, has an empty set and its own id. Ids are taken as unique. A row without id links
    like any other, so components are joined through it; it gets the component's least id,
    a null one if no row of the component has an id. Sets are named
    by 64-bit hashes. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    info = stage_table(describe_sets(rows), "sets")
    first = [F.first(c).alias(c) for c in ("n", "bits", *[f"b{k}" for k in range(WORDS_BITS)])]
    classes = stage_table(
        info.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), *first),
        "classes",
    )
    fits = info.agg(F.bit_and("fits")).collect()[0][0]
    margin = next((m for k, m in enumerate(MARGINS) if fits is None or fits >> k & 1), None)
    if margin is None:
        raise ValueError("no partition fits every set; add to MARGINS")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = signature_blocks(rows, partitions, margin)
    dealt = blocks.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    runs = stage_table(runs_of(dealt), "runs")

    stars = runs.where("key <> pivot").select(
        F.col("pivot").alias("a"), F.col("key").alias("b")
    ).distinct()
    stars = stage_table(bounded(stars, classes), "pairs")
    members = stage_table(
        with_component(runs.select("run", "key").distinct(), stars, "component"), "members"
    )
    drawn = stage_table(drawn_stars(members, classes), "pairs")
    members = stage_table(joined_components(members, drawn), "members")
    stars = stars.union(drawn)
    pairs = stage_table(stars.union(apart(members, classes, "run")), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    texts = stage_table(packed_texts(rows, classes, ends), "texts")
    links = stage_table(exact_links(pairs, texts), "links")
    # whom a star pair has joined that is no link: their texts are all at hand, and a pair
    # of them comes once, however many runs they share
    joined = members.select("key", F.col("component").alias("joined")).distinct()
    again = stage_table(with_component(joined, links, "component"), "joined")
    undone = apart(again, classes, "joined").join(pairs, ["a", "b"], "left_anti")
    more = exact_links(undone, texts)
    # few links are new: they only join components that are known by now
    place = joined_components(again.select("key", "component"), more)
    placed = classes.select("key", "rep").join(place, "key", "left").withColumn(
        "root", F.coalesce("component", "key")
    )
    least = placed.groupBy("root").agg(F.min("rep").alias("component"))
    final = placed.select("key", "root").join(least, "root").select("key", "component")
    return info.select("id", "n", "key").join(final, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )
