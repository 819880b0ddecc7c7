"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is then put into a leaf. A query
walks the tree best bin first: a priority queue holds nodes by the inner product of the
query with their centre, the best is taken next, and leaves are visited until a number
of them has been seen. That number is calibrated: for a sample of queries the exact
neighbours are found in blocks, and visits widen until the wanted share of them lies in
visited leaves. Queries and the vectors of neighbouring leaves meet in cells of bounded
size, where scores are exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulark.session import stage_table

SAMPLE, BRANCHING, LEAF_ROWS, MAX_LEAVES = 16_384, 8, 128, 4_096
BUCKET_ROWS, QUERY_ROWS = 4_096, 4_096
TRIED, RECALL = 96, 0.95


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, not zero."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


@dataclass
class Tree:
    """Nodes in order of their making; node 0 is the root."""

    centers: np.ndarray
    children: list[np.ndarray] = field(default_factory=list)
    leaf: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    leaves: int = 0

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: down the nearest centres."""
        found = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not len(kids):
                found[rows] = self.leaf[node]
                continue
            c = self.centers[kids]
            near = (x[rows] @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
            todo += [(kids[k], rows[near == k]) for k in np.unique(near)]
        return found

    def visits(self, queries: np.ndarray, limit: int) -> Iterator[list[int]]:
        """Leaves of each query in best-bin-first order, ``limit`` of them at most."""
        for scores in queries @ self.centers.T:
            line, seen = [(0.0, 0)], []
            while line and len(seen) < limit:
                _, node = heapq.heappop(line)
                kids = self.children[node]
                if not len(kids):
                    seen.append(int(self.leaf[node]))
                for k in kids:
                    heapq.heappush(line, (-scores[k], int(k)))
            yield seen

    def nearest_leaves(self, x: np.ndarray, limit: int) -> np.ndarray:
        """The ``limit`` leaves (all, if fewer) whose centres are nearest to each row, nearest
        first. No branch is left out: rows beside each other get nearly the same ones, also
        where an upper split parts them."""
        nodes = np.flatnonzero(self.leaf >= 0)
        centers = np.empty((self.leaves, self.centers.shape[1]), np.float32)
        centers[self.leaf[nodes]] = self.centers[nodes]
        edge = 0.5 * (centers * centers).sum(axis=1)
        limit = min(limit, self.leaves)
        out = np.empty((len(x), limit), np.int64)
        step = max(1, (1 << 22) // self.leaves)  # bounds the table of scores
        for start in range(0, len(x), step):
            far = edge - x[start : start + step].astype(np.float32) @ centers.T
            top = np.argpartition(far, limit - 1, axis=1)[:, :limit]
            order = np.lexsort((top, np.take_along_axis(far, top, 1)), axis=1)
            out[start : start + step] = np.take_along_axis(top, order, 1)
        return out


def cluster(x: np.ndarray, k: int, draw: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Cluster number of each row, by Lloyd's rounds from k distinct rows."""
    centers = x[draw.choice(len(x), k, replace=False)]
    near = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        near = (x @ centers.T - 0.5 * (centers * centers).sum(axis=1)).argmax(axis=1)
        used = np.unique(near)
        centers = np.array([x[near == c].mean(axis=0) for c in used])
    return near


def build_tree(sample: np.ndarray, leaf_rows: int, branching: int = BRANCHING, seed: int = 5) -> Tree:
    """Split until a node has at most ``leaf_rows`` rows of the sample, or no spread."""
    draw = np.random.default_rng(seed)
    dim = sample.shape[1] if sample.ndim == 2 else 0
    centers = [sample.mean(axis=0) if len(sample) else np.zeros(dim)]
    children: list[np.ndarray] = [np.zeros(0, np.int64)]
    leaf = {}

    def split(node: int, rows: np.ndarray) -> None:
        if len(rows) > max(leaf_rows, branching):
            near = cluster(sample[rows], branching, draw)
            used = np.unique(near)
            if len(used) > 1:
                kids = []
                for c in used:
                    kids.append(len(centers))
                    centers.append(sample[rows[near == c]].mean(axis=0))
                    children.append(np.zeros(0, np.int64))
                children[node] = np.array(kids, np.int64)
                for c, kid in zip(used, kids):
                    split(kid, rows[near == c])
                return
        leaf[node] = len(leaf)

    split(0, np.arange(len(sample)))
    numbers = np.array([leaf.get(i, -1) for i in range(len(centers))], np.int64)
    return Tree(np.array(centers), children, numbers, len(leaf))


def fit_tree(
    vectors: DataFrame, rows: int, leaf_rows: int, sample: int = SAMPLE,
    scaled: Callable[[np.ndarray], np.ndarray] | None = None,
) -> Tree:
    """Tree of ``id, vec`` fitted on about ``sample`` rows drawn by a hash of the id, with
    leaves of about ``leaf_rows`` of all rows and at most MAX_LEAVES leaves; of the vectors
    as ``scaled`` gives them."""
    part = min(1.0, sample / max(rows, 1))
    unit = F.pmod(F.xxhash64(F.lit("tree"), "id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = vectors.where(unit < part).select("id", "vec").limit(2 * sample).toArrow()
    if not drawn.num_rows:
        return Tree(np.zeros((1, 0)), [np.zeros(0, np.int64)], np.zeros(1, np.int64), 1)
    order = np.argsort(drawn.column("id").to_numpy(), kind="stable")
    x = matrix(drawn.column("vec"))[order]
    x = scaled(x) if scaled else x
    least = max(2, int(leaf_rows * len(x) / max(rows, 1)), 2 * len(x) // MAX_LEAVES)
    return build_tree(x, least)


def with_dimension(vectors: DataFrame) -> DataFrame:
    """The usable rows of the most frequent dimension (the larger on a tie)."""
    fine = vectors.where(usable(F.col("vec")))
    most = fine.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    top = most.limit(1).collect()
    return fine.where(F.size("vec") == (top[0]["d"] if top else 0))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def exact_scores(query: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products summed alike for every row, so that equal vectors tie exactly."""
    return (x * query).sum(axis=1)


def block_neighbours(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """``query_id, id, score, leaf``: each task's best of a bounded set of queries."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}
        for batch in batches:
            x = matrix(batch.column("vec"))
            own = batch.column("id").to_numpy()
            leaf = batch.column("leaf").to_numpy()
            for i, q in enumerate(queries):
                a, s, b = kept.get(i, (own[:0], np.zeros(0), leaf[:0]))
                other = own != ids[i]
                a = np.concatenate((a, own[other]))
                s = np.concatenate((s, exact_scores(q, x[other])))
                b = np.concatenate((b, leaf[other]))
                at = best(a, s, k)
                kept[i] = a[at], s[at], b[at]
        if kept:
            parts = list(kept.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.full(len(p[0]), ids[i]) for i, p in parts])),
                 *[pa.array(np.concatenate([p[j] for _, p in parts])) for j in range(3)]],
                ["query_id", "id", "score", "leaf"],
            )

    return vectors.mapInArrow(scan, "query_id long, id long, score double, leaf long")


def top_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def leaf_visits(vectors: DataFrame, tree: Tree, rows: int, k: int, recall: float, tried: int) -> int:
    """Leaves to visit so that ``recall`` of the exact neighbours of a sample of queries
    lie in them."""
    part = min(1.0, 1.5 * tried / max(rows, 1))
    unit = F.pmod(F.xxhash64(F.lit("tried"), "id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = vectors.where(unit < part).select("id", "vec").limit(tried).toArrow()
    if not drawn.num_rows:
        return tree.leaves
    ids, queries = drawn.column("id").to_numpy(), matrix(drawn.column("vec"))
    truth = top_rows(block_neighbours(vectors, ids, queries, k), k).toArrow()
    if not truth.num_rows:
        return tree.leaves
    order = {
        int(i): {leaf: r for r, leaf in enumerate(seen)}
        for i, seen in zip(ids, tree.visits(queries, tree.leaves))
    }
    ranks = [
        order[q][leaf]
        for q, leaf in zip(truth.column("query_id").to_pylist(), truth.column("leaf").to_pylist())
    ]
    visits = 1
    while np.mean(np.array(ranks) < visits) < recall:
        visits += 1
    return visits


@dataclass
class Cells:
    """Neighbouring leaves make a bucket; a leaf beyond BUCKET_ROWS is cut in slices."""

    bucket: np.ndarray  # of each leaf
    slices: np.ndarray  # of each bucket


def cells_of(counts: dict[int, int], leaves: int, bucket_rows: int) -> Cells:
    bucket, size, sizes = np.zeros(leaves, np.int64), 0, [0]
    for leaf in range(leaves):
        n = counts.get(leaf, 0)
        if sizes[-1] and sizes[-1] + n > bucket_rows:
            sizes.append(0)
        bucket[leaf] = len(sizes) - 1
        sizes[-1] += n
    return Cells(bucket, np.maximum(1, -(-np.array(sizes) // (2 * bucket_rows))))


def search(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id",
    vec_col: str = "embedding", recall: float = RECALL, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found by inner product.

    ``queries`` is a condition on ``id``; every other row is a candidate. Scores are in
    double precision on the vectors as they are, ties go to the smaller id. Vectors that
    are null, zero, hold null or non-finite components or are not of the most frequent
    dimension take no part, nor do null ids. An id that repeats is searched and found
    once for each row. Fewer candidates than k: all that are found.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    rows = stage_table(with_dimension(rows.where("id IS NOT NULL")), "vectors")
    n = rows.count()
    context = vectors.sparkSession.sparkContext
    shared = context.broadcast(fit_tree(rows, n, leaf_rows))  # at most MAX_LEAVES leaves

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.assign(matrix(batch.column("vec")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vec"), pa.array(leaf)],
                    ["id", "vec", "leaf"],
                )

    kind = rows.schema["vec"].dataType.simpleString()
    placed = stage_table(rows.mapInArrow(place, f"id long, vec {kind}, leaf long"), "placed")
    tree = shared.value
    counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    cells = cells_of(counts, tree.leaves, BUCKET_ROWS)
    visits = leaf_visits(placed, tree, n, k, recall, TRIED)
    plan = context.broadcast(cells)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            row, bucket, leaves = [], [], []
            for i, seen in enumerate(shared.value.visits(matrix(batch.column("vec")), visits)):
                seen = np.array(sorted(seen))
                at = c.bucket[seen]
                for b in np.unique(at):
                    row.append(i)
                    bucket.append(b)
                    leaves.append(seen[at == b].tolist())
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("vec").take(take),
                 pa.array(bucket, pa.int64()), pa.array(leaves, pa.list_(pa.int64())),
                 pa.array(c.slices[bucket], pa.int64())],
                ["id", "vec", "bucket", "leaves", "slices"],
            )

    asked = stage_table(
        placed.where(queries).select("id", "vec")
        .mapInArrow(walk, f"id long, vec {kind}, bucket long, leaves array<long>, slices long"),
        "asked",
    )
    # one row for each bucket, of which there are no more than leaves
    load = {r["bucket"]: r["count"] for r in asked.groupBy("bucket").count().collect()}
    lines = np.array([-(-load.get(b, 0) // QUERY_ROWS) for b in range(len(cells.slices))])
    width = context.broadcast((cells, lines))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, many = width.value
        for batch in batches:
            bucket = c.bucket[batch.column("leaf").to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bucket), pa.array(c.slices[bucket]),
                 pa.array(many[bucket].astype(np.int64))],
                [*batch.schema.names, "bucket", "slices", "lines"],
            )

    def number(of: str, salt: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(of))

    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("lines") - 1))
    left = (
        placed.mapInArrow(
            deal, f"id long, vec {kind}, leaf long, bucket long, slices long, lines long"
        )
        .where("lines > 0")
        .select("id", "vec", "leaf", "bucket", number("slices", "s").alias("slice"), each.alias("line"))
    )
    line_of = F.create_map(
        *[F.lit(x) for b, m in enumerate(lines.tolist()) for x in (b, max(1, m))]
    )
    right = asked.withColumn("lines", line_of[F.col("bucket").cast("int")].cast("long")).select(
        "id", "vec", "leaves", "bucket", number("lines", "l").alias("line"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
    )

    def meet(found: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "id": [], "score": []}
        if found.num_rows and asked.num_rows:
            ids, leaf = found.column("id").to_numpy(), found.column("leaf").to_numpy()
            x, q = matrix(found.column("vec")), matrix(asked.column("vec"))
            names = asked.column("id").to_numpy()
            scores = q @ x.T
            for i, seen in enumerate(asked.column("leaves").to_pylist()):
                at = np.flatnonzero(np.isin(leaf, seen) & (ids != names[i]))
                s = scores[i, at]
                if len(at) > k:
                    edge = np.partition(s, len(s) - k)[len(s) - k]
                    at = at[s >= edge - 1e-9 * (1 + abs(edge))]
                s = exact_scores(q[i], x[at])
                pick = best(ids[at], s, k)
                out["query_id"].append(np.full(len(pick), names[i]))
                out["id"].append(ids[at][pick])
                out["score"].append(s[pick])
        kinds = {"query_id": np.int64, "id": np.int64, "score": np.float64}
        return pa.table(
            {c: np.concatenate(v) if v else np.zeros(0, kinds[c]) for c, v in out.items()}
        )

    cell = ["bucket", "slice", "line"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        meet, "query_id long, id long, score double"
    )
    return top_rows(found, k).select(
        "query_id", "rank", F.col("id").alias(id_col if id_col != "query_id" else "id"), "score"
    )
