"""Near duplicates among vectors by a robust-pruned flat graph.

Equal vectors of a label are one class with a count. Classes are unit-scaled and put into
overlapping shards: those of one label in the same leaves of a k-means tree, each in the
``overlap`` leaves with the nearest centres. How many that must be is settled before anything is built: for a
drawn set of vectors the true links are found, and the overlap is the least at which enough
of them share a leaf. Each shard builds a
flat graph: points come in batches, meet all points of the shard in a block product, and keep
the robust-pruned ones of the nearest (one is dropped if a kept one is nearer to it, by a
factor, than the point is), in the whole shard and in ever thinner draws of it, which join
close groups. The adjacency lists of a vector are united over its shards and handed back to
them, without edges too long for two points in reach of one search; then each member searches
its shard from its own place in it, and while it finds points in range it goes on from them,
however many there are. Only pairs whose cosine in double
precision reaches the bound are links. A draw of fixed size is audited against all rows:
one vector each of some groups, as many linked ones, and vectors without a link. If too many
links are missing, shards overlap more and all is done again, and where shards would hold
most of the rows, all pairs of a label are compared instead.

A shard of more than ``SHARD_ROWS`` rows is cut into slices, and every pair of slices is a
shard: no link is lost and no task holds a hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulark.llm.components import connected_components
from tabulark.llm.kmeans_tree import fit_tree, matrix, with_dimension
from tabulark.session import stage_table

RANGE, DEGREE, BEAM, ALPHA = 0.93, 24, 32, 1.2
THINNER, FAR_DEGREE = 4, 6  # share of each thinner draw of a shard's points, neighbours in it
SLACK = 0.06  # how far below the range a point is still gone on from
OVERLAP, AUDITED, AUDIT_RECALL = 3, 256, 0.97
# vectors whose links settle the overlap; vectors without a link that are audited; rows for each
# group that the audit takes for granted where fewer are found
PROBED, AUDIT_LONELY, GROUP_ROWS = 4_096, 4_096, 1_000
# partners of a vector that are looked at; leaves of a vector tried as overlap; how much more
# than the goal must share a leaf
PARTNERS, MOST_OVERLAP, MARGIN = 8, 32, 0.01
LEAF_ROWS, SHARD_ROWS, BATCH = 2_048, 4_096, 128
BLUR = 1e-5  # how far single precision may be off


def beam_search(x, near, start, queries, beam: int):
    """(expanded points as a boolean matrix, similarities seen so far, NaN: not seen), by a
    greedy search of all queries in step from ``start``, one point or one for each query."""
    b, n = len(queries), len(x)
    seen = np.full((b, n), np.nan, np.float32)
    expanded = np.zeros((b, n), bool)
    start = np.broadcast_to(start, b)
    ids = np.full((b, beam), -1)
    ids[:, 0] = start
    top = np.full((b, beam), -np.inf, np.float32)
    top[:, 0] = np.einsum("ij,ij->i", queries, x[start])
    seen[np.arange(b), start] = top[:, 0]
    rows = np.arange(b)[:, None]
    width = 4
    while True:
        fresh = np.where((ids >= 0) & ~expanded[rows, ids], top, -np.inf)
        pick = np.argpartition(-fresh, width - 1, axis=1)[:, :width]
        going = np.isfinite(fresh[rows, pick])
        if not going.any():
            return expanded, seen
        r, c = np.nonzero(going)
        node = ids[r, pick[r, c]]
        expanded[r, node] = True
        q, other, s = look(x, near, queries, r, node, seen)
        # the new points of each query, side by side
        count = np.bincount(q, minlength=b)
        wide = int(count.max()) if len(q) else 0
        if not wide:
            continue
        place = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
        more = np.full((b, wide), -np.inf, np.float32)
        more_ids = np.full((b, wide), -1)
        more[q, place], more_ids[q, place] = s, other
        all_top, all_ids = np.hstack((top, more)), np.hstack((ids, more_ids))
        keep = np.argpartition(-all_top, beam - 1, axis=1)[:, :beam]
        top, ids = all_top[rows, keep], all_ids[rows, keep]


def look(x, near, queries, r, node, seen):
    """(query places, points, similarities) of the points beside ``node`` that query ``r`` has
    not seen yet, each once and in order; they are seen now."""
    fresh = np.zeros(seen.shape, bool)
    for at in range(0, len(r), 1 << 14):
        q = np.repeat(r[at : at + (1 << 14)], near.shape[1])
        other = near[node[at : at + (1 << 14)]].ravel()
        ok = other >= 0
        fresh[q[ok], other[ok]] = True
    q, other = np.nonzero(fresh & np.isnan(seen))
    s = np.empty(len(q), np.float32)
    for at in range(0, len(q), 1 << 14):
        part = slice(at, at + (1 << 14))
        s[part] = np.einsum("ij,ij->i", queries[q[part]], x[other[part]])
    seen[q, other] = s
    return q, other, s


def robust_prune(x, found: np.ndarray, far: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Which neighbours each point keeps, as a boolean matrix: nearest first, dropping those a
    kept one covers.

    found: a row for each point, nearest first, padded with -1; far: their distances.
    """
    # where the nearest do not cover each other, they are the ones to keep
    keep = np.zeros(found.shape, bool)
    keep[:, :degree] = found[:, :degree] >= 0
    v = x[found[:, :degree]]
    covers = alpha * (1 - v @ v.transpose(0, 2, 1)) <= far[:, None, :degree]
    covers &= keep[:, None, :degree] & np.triu(np.ones(covers.shape[1:], bool), 1)
    todo = np.flatnonzero(covers.any(axis=(1, 2)))
    # most points are done within the first few; only the others look at all of them
    for wide in dict.fromkeys((min(degree + degree // 3, found.shape[1]), found.shape[1])):
        if not len(todo):
            break
        near, d = found[todo, :wide], far[todo, :wide]
        v = x[near]
        between = 1 - v @ v.transpose(0, 2, 1)
        live, kept = near >= 0, np.zeros(near.shape, bool)
        rows = np.arange(len(todo))
        for _ in range(degree):
            first = live.argmax(axis=1)
            some = live[rows, first]
            if not some.any():
                break
            kept[rows[some], first[some]] = True
            live &= alpha * between[rows, first] > d
            live[rows, first] = False
        keep[todo, :wide] = kept
        if wide < found.shape[1]:
            todo = todo[(kept.sum(axis=1) < degree) & (found[todo, wide] >= 0)]
    return keep


def build_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, seed: int = 3):
    """(neighbours padded with -1, medoid) of unit vectors.

    A point's candidates are the nearest of all points, by block products: a shard is small
    enough, and a search for them would look at most of it one by one. So that close groups are
    no islands, a point also has neighbours among one in ``THINNER`` of all points, one in so many
    of these, and so on.
    """
    n = len(x)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    if n <= degree + 1:
        every = np.tile(np.arange(n), (n, 1))
        return every[~np.eye(n, dtype=bool)].reshape(n, n - 1) if n > 1 else np.full((1, 1), -1), medoid
    order = np.random.default_rng(seed).permutation(n)
    levels = [(np.arange(n), degree)]
    while (size := len(levels[-1][0]) // THINNER) > FAR_DEGREE:
        levels.append((np.sort(order[:size]), FAR_DEGREE))
    edges: list[list] = [[] for _ in levels]
    for start in range(0, n, BATCH):
        s = x[start : start + BATCH] @ x.T
        own = np.arange(len(s))
        s[own, start + own] = -np.inf
        for (points, most), kept in zip(levels, edges):
            part = s[:, points] if len(points) < n else s
            c = min(4 * most, len(points) - 1)
            found = np.argpartition(part, len(points) - c, axis=1)[:, len(points) - c :]
            d = 1 - np.take_along_axis(part, found, 1)
            nearest = np.argsort(d, axis=1, kind="stable")
            found, d = points[np.take_along_axis(found, nearest, 1)], np.take_along_axis(d, nearest, 1)
            r, k = np.nonzero(robust_prune(x, found, d, most, alpha))
            kept.append((start + r, found[r, k], d[r, k]))
    lists = [
        with_back_links(x, *map(np.concatenate, zip(*kept)), most, alpha)
        for (_, most), kept in zip(levels, edges)
    ]
    return np.hstack(lists), medoid


def with_back_links(x, a, b, far, degree: int, alpha: float) -> np.ndarray:
    """Lists of the edges a to b and of those back, pruned where they are more than ``degree``."""
    n = len(x)
    code, at = np.unique(np.concatenate((a * n + b, b * n + a)), return_index=True)
    far = np.concatenate((far, far))[at]
    a, b = code // n, code % n
    order = np.lexsort((far, a))
    a, b, far = a[order], b[order], far[order]
    count = np.bincount(a, minlength=n)
    place = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    ok = place < 4 * degree
    found = np.full((n, 4 * degree), -1)
    found[a[ok], place[ok]] = b[ok]
    away = np.full((n, 4 * degree), np.inf, np.float32)
    away[a[ok], place[ok]] = far[ok]
    near = found[:, :degree].copy()
    full = np.flatnonzero(count > degree)
    for start in range(0, len(full), BATCH):
        some = full[start : start + BATCH]
        keep = robust_prune(x, found[some], away[some], degree, alpha)
        r, c = np.nonzero(keep)
        near[some] = -1
        near[some[r], (np.cumsum(keep, axis=1) - 1)[r, c]] = found[some[r], c]
    return near


def walks(x, near, start, queries, bound: float, beam: int = BEAM):
    """Similarities that each query has seen (NaN: not seen) by a greedy search from ``start``,
    going on from every point within ``SLACK`` of the bound."""
    expanded, seen = beam_search(x, near, start, queries, beam)
    while True:
        r, node = np.nonzero((np.nan_to_num(seen, nan=-2) >= bound - SLACK) & ~expanded)
        if not len(r):
            return seen
        expanded[r, node] = True
        look(x, near, queries, r, node, seen)


def range_search(x, near, medoid: int, queries, bound: float, beam: int = BEAM):
    """Yields (query place, points seen at ``bound`` or above), by walks from the medoid."""
    for start in range(0, len(queries), BATCH):
        seen = walks(x, near, medoid, queries[start : start + BATCH], bound, beam)
        for i, row in enumerate(seen):
            yield start + i, np.flatnonzero(np.nan_to_num(row, nan=-2) >= bound - BLUR)


def member_links(x, near, exact, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) with a < b, each once: places of linked points. A member is a point of the graph,
    so its walk starts where a search from the medoid would have to get first."""
    linked = np.zeros((len(x), len(x)), bool)
    for start in range(0, len(x), BATCH):
        own = np.arange(start, min(start + BATCH, len(x)))
        seen = walks(x, near, own, x[own], bound)
        i, j = np.nonzero(np.nan_to_num(seen, nan=-2) >= bound - BLUR)
        ok = own[i] != j
        i, j = i[ok], j[ok]
        ok = reaches(exact, own[i], exact, j, seen[i, j], bound)
        linked[np.minimum(own[i[ok]], j[ok]), np.maximum(own[i[ok]], j[ok])] = True
    return np.nonzero(linked)


def reaches(x, i, y, j, s, bound: float) -> np.ndarray:
    """Whether the cosine of x[i] and y[j] is ``bound`` or more. s: it in single precision,
    which decides where it is not near the bound."""
    ok = s >= bound
    for at in np.array_split(close := np.flatnonzero(np.abs(s - bound) < BLUR), len(close) // (1 << 14) + 1):
        ok[at] = (x[i[at]] * y[j[at]]).sum(axis=1) >= bound
    return ok


def unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def placed_rows(rows: DataFrame, overlap: int, tree) -> DataFrame:
    """``id, label, vec, leaves``: each row once, with the numbers of its leaves."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = shared.value.nearest_leaves(unit(matrix(batch.column("vec"))), overlap)
                ends = np.arange(len(leaves) + 1, dtype=np.int32) * leaves.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(leaves.ravel()))],
                    [*batch.schema.names, "leaves"],
                )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(place, f"{fields}, leaves array<long>")


def leaf_members(placed: DataFrame) -> DataFrame:
    """A row for each leaf of a row of ``placed_rows``, its other columns as they are."""
    return placed.withColumn("leaf", F.explode("leaves")).drop("leaves")


def slice_counts(members: DataFrame) -> DataFrame:
    """``label, leaf, cuts``: slices of each leaf."""
    return members.groupBy("label", "leaf").agg(
        F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("cuts")
    )


def sliced(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Cut leaves of many rows: every pair of their slices is a shard."""
    own = F.pmod(F.xxhash64(F.lit("slice"), "id"), F.col("cuts")).cast("int")
    cut = members.join(counts, ["label", "leaf"]).withColumn("own", own)
    # with one slice the only pair is (0, 0); with more, those of different slices
    pairs = F.when(F.col("cuts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: k != F.col("own"))
    )
    return cut.withColumn("other", F.explode(pairs)).withColumns(
        {"one": F.least("own", "other"), "two": F.greatest("own", "other")}
    ).drop("cuts", "own", "other")


SHARD = ["label", "leaf", "one", "two"]


def found_links(rows: DataFrame, bound: float, overlap: int, tree=None) -> DataFrame:
    """``a, b`` with a < b: the linked pairs that the graph finds, each once."""
    tree = tree or fit_tree(rows, rows.count(), LEAF_ROWS, scaled=unit)
    placed = stage_table(placed_rows(rows, overlap, tree), "placed")
    counts = stage_table(slice_counts(leaf_members(placed.select("label", "leaves"))), "counts")
    # two points that a walk goes on from are at most twice as far apart as it goes
    reach = 2 * np.arccos(np.clip(bound - SLACK, -1, 1))
    least = np.cos(reach) - BLUR if reach < np.pi else -2.0

    def build(shard: pa.Table) -> pa.Table:
        ids = shard.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        x = unit(matrix(shard.column("vec")))[order].astype(np.float32)
        near, _ = build_graph(x)
        far = np.concatenate([
            np.einsum("ij,ikj->ik", x[at : at + BATCH], x[near[at : at + BATCH]]) < least
            for at in range(0, len(x), BATCH)
        ])
        near[far] = -1
        some = np.flatnonzero((near >= 0).any(axis=1))
        lists = near[some]
        ends = np.concatenate(([0], np.cumsum((lists >= 0).sum(axis=1)))).astype(np.int32)
        return pa.table({
            "id": ids[some], "near": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[lists[lists >= 0]])),
        })

    graph = sliced(leaf_members(placed), counts).groupBy(*SHARD).applyInArrow(build, "id long, near array<long>")
    # one list of DEGREE for each shard of a vector; without any, it links with nothing
    united = stage_table(graph.groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    ), "graph")

    def scan(shard: pa.Table) -> pa.Table:
        ids = shard.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        exact = unit(matrix(shard.column("vec")))[order]
        lists = shard.column("near").combine_chunks().take(pa.array(order))
        counts = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy()
        place = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        inside = ids[place] == flat
        owner = np.repeat(np.arange(len(ids)), counts)[inside]
        place = place[inside]
        wide = np.bincount(owner, minlength=len(ids))
        near = np.full((len(ids), max(1, int(wide.max(initial=0)))), -1)
        near[owner, np.arange(len(owner)) - np.repeat(np.cumsum(wide) - wide, wide)] = place
        a, b = member_links(exact.astype(np.float32), near, exact, bound)
        return pa.table({"a": ids[a], "b": ids[b]})

    listed = leaf_members(placed.join(united, "id"))
    return sliced(listed, counts).groupBy(*SHARD).applyInArrow(scan, "a long, b long").distinct()


def all_links(rows: DataFrame, bound: float) -> DataFrame:
    """``a, b`` with a < b: all linked pairs, by comparing every two rows of a label."""
    members = rows.select("label", F.lit(0).cast("long").alias("leaf"), "id", "vec")
    members = sliced(members, slice_counts(members))

    def scan(shard: pa.Table) -> pa.Table:
        ids, x = shard.column("id").to_numpy(), unit(matrix(shard.column("vec")))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(x), 512):
            s = x[start : start + 512] @ x.T
            i, j = np.nonzero(s >= bound - 1e-9)
            near = np.flatnonzero(s[i, j] < bound + 1e-9)
            ok = ids[start + i] < ids[j]
            ok[near] &= (x[start + i[near]] * x[j[near]]).sum(axis=1) >= bound
            a.append(ids[start + i[ok]])
            b.append(ids[j[ok]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return members.groupBy(*SHARD).applyInArrow(scan, "a long, b long").distinct()


def true_links(rows: DataFrame, drawn: pa.Table, bound: float, most: int | None = None) -> DataFrame:
    """``q, a, b``: the links of each drawn vector q (id, label, vec) among all rows; with
    ``most`` only so many of each, drawn by hash."""
    ids = drawn.column("id").to_numpy()
    names = {k: i for i, k in enumerate(dict.fromkeys(drawn.column("label").to_pylist()))}
    labels = np.array([names[k] for k in drawn.column("label").to_pylist()], np.int64)
    exact = unit(matrix(drawn.column("vec")))
    x = exact.astype(np.float32)
    asked = [np.flatnonzero(labels == k) for k in range(len(names))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("id").to_numpy()
            like = np.array([names.get(k, -1) for k in batch.column("label").to_pylist()], np.int64)
            every = unit(matrix(batch.column("vec")))
            for k in np.unique(like[like >= 0]):
                at = np.flatnonzero(like == k)
                y = every[at].astype(np.float32).T
                for start in range(0, len(asked[k]), 256):
                    some = asked[k][start : start + 256]
                    s = x[some] @ y
                    i, j = np.nonzero(s >= bound - BLUR)
                    s, i, j = s[i, j], some[i], at[j]
                    ok = (ids[i] != own[j]) & reaches(exact, i, every, j, s, bound)
                    i, j = i[ok], j[ok]
                    if most is not None:  # those of the least hash, in each batch and then of all
                        order = np.lexsort((spread(own[j]), i))
                        i, j = i[order], j[order]
                        first = np.searchsorted(i, i)
                        keep = np.arange(len(i)) - first < most
                        i, j = i[keep], j[keep]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[i]), pa.array(np.minimum(ids[i], own[j])),
                         pa.array(np.maximum(ids[i], own[j]))],
                        ["q", "a", "b"],
                    )

    found = rows.select("id", "label", "vec").mapInArrow(scan, "q long, a long, b long")
    if most is None:
        return found
    other = F.when(F.col("a") == F.col("q"), F.col("b")).otherwise(F.col("a"))
    best = Window.partitionBy("q").orderBy(F.xxhash64(F.lit("partner"), other), other)
    return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= most).drop("n")


def spread(ids: np.ndarray) -> np.ndarray:
    """A hash of ids, to draw by."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def drawn_rows(rows: DataFrame, of: int, n: int, name: str) -> pa.Table:
    """About ``n`` of ``of`` rows by a hash of the id, at most twice as many."""
    unit_ = F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(unit_ < min(1.0, n / max(of, 1))).select("id", "label", "vec").limit(2 * n).toArrow()


def needed_overlap(rows: DataFrame, tree, n: int, bound: float, goal: float) -> int:
    """The least overlap, ``OVERLAP`` or more, at which ``goal`` and ``MARGIN`` of the true
    links of drawn vectors share a leaf: on the mean of the vectors and on the mean weighted
    against those of many links, so that neither small groups nor large ones hide."""
    if tree.leaves <= 2 * OVERLAP:
        return OVERLAP
    drawn = drawn_rows(rows, n, PROBED, "probe")
    if not drawn.num_rows:
        return OVERLAP
    pairs = true_links(rows, drawn, bound, PARTNERS).toArrow()
    if not pairs.num_rows:
        return OVERLAP
    q, a, b = (pairs.column(c).to_numpy() for c in ("q", "a", "b"))
    other = np.where(a == q, b, a)
    some = rows.sparkSession.createDataFrame([(int(i),) for i in np.unique(np.concatenate((q, other)))], "id long")
    ends = rows.join(F.broadcast(some), "id", "left_semi").select("id", "vec").toArrow()
    order = np.argsort(ends.column("id").to_numpy())
    ids = ends.column("id").to_numpy()[order]
    limit = min(tree.leaves, MOST_OVERLAP)
    rank = np.full((len(ids), tree.leaves), limit, np.int16)
    leaves = tree.nearest_leaves(unit(matrix(ends.column("vec"))[order]), limit)
    np.put_along_axis(rank, leaves, np.arange(limit, dtype=np.int16)[None, :], 1)
    least = np.maximum(rank[np.searchsorted(ids, q)], rank[np.searchsorted(ids, other)]).min(axis=1) + 1
    _, owner, count = np.unique(q, return_inverse=True, return_counts=True)
    weight = 1 / (1 + count)
    for overlap in range(OVERLAP, limit):
        share = np.bincount(owner, least <= overlap) / count
        if min(share.mean(), np.average(share, weights=weight)) >= min(1.0, goal + MARGIN):
            return overlap
    return limit


def audit(
    rows: DataFrame, links: DataFrame, parts: DataFrame, bound: float, goal: float = AUDIT_RECALL
) -> float:
    """Estimated share of the true links that were found (1 without any): the lesser of the
    means over groups and over vectors, so that neither small groups nor large ones hide.

    parts: id, component. Up to ``AUDITED`` found groups, by one vector each, and as many linked
    vectors give the means, on ``PARTNERS`` links of each. Of the vectors without a found link,
    which have lost all that they have, up to ``AUDIT_LONELY`` are drawn; two of them count as
    a lost group.
    """
    n = rows.count()
    place = F.xxhash64(F.lit("audit"), "id")
    each = parts.groupBy("component").agg(F.min_by("id", place).alias("id"))
    linked, groups = parts.count(), each.count()
    by_group = by_vector = 1.0
    if groups:
        one = [r.id for r in each.orderBy(place).limit(AUDITED).select("id").collect()]
        any_ = [r.id for r in parts.orderBy(place).limit(AUDITED).select("id").collect()]
        some = rows.sparkSession.createDataFrame([(i,) for i in {*one, *any_}], "id long")
        drawn = rows.join(F.broadcast(some), "id", "left_semi").select("id", "label", "vec").toArrow()
        hits = true_links(rows, drawn, bound, PARTNERS).join(
            links.withColumn("hit", F.lit(1)), ["a", "b"], "left"
        ).groupBy("q").agg((F.count("hit") / F.count("*")).alias("recall"))
        recall = {r.q: r.recall for r in hits.collect()}
        by_group = float(np.mean([recall.get(i, 1.0) for i in one]))
        by_vector = float(np.mean([recall.get(i, 1.0) for i in any_]))
    alone = n - linked
    lonely = rows.join(parts.select("id"), "id", "left_anti")
    block = drawn_rows(lonely, alone, AUDIT_LONELY, "lonely") if alone else None
    seen = block.num_rows if block is not None else 0
    lost = true_links(rows, block, bound, 1).select("q").distinct().count() if seen else 0
    missing = lost / seen * alone if seen else 0.0
    if not groups:
        return 0.0 if missing else 1.0
    groups = max(groups, n / GROUP_ROWS)
    return min(by_group * groups / (groups + missing / 2), by_vector * linked / (linked + missing))


def links_at_goal(
    rows: DataFrame, bound: float, goal: float = AUDIT_RECALL
) -> tuple[DataFrame, DataFrame, float, int | None]:
    """(links, their components, audited recall, overlap): shards overlap more until the goal
    is met; from half of the leaves on all pairs are compared (recall 1, no overlap)."""
    n = rows.count()
    tree = fit_tree(rows, n, LEAF_ROWS, scaled=unit)
    overlap = needed_overlap(rows, tree, n, bound, goal)
    while 2 * overlap <= tree.leaves or overlap == OVERLAP:
        links = stage_table(found_links(rows, bound, overlap, tree), "links")
        parts = stage_table(connected_components(links), "parts")
        recall = audit(rows, links, parts, bound, goal)
        if recall >= goal:
            return links, parts, recall, overlap
        overlap *= 2
    links = stage_table(all_links(rows, bound), "links")
    return links, stage_table(connected_components(links), "parts"), 1.0, None


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
    label_col: str = "label", bound: float = RANGE,
) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row.

    Rows link when their labels are equal and not null and their cosine is ``bound`` or
    more. A vector that is null, zero, holds null or non-finite components or is not of
    the most frequent dimension links with nothing; its component is its own id. kept is
    whether a row is the least id of its component. Rows of one id and one vector are one
    vector; rows of one id with different vectors are linked each by its own. Null ids link
    with nothing. Other columns are not read.
    """
    named = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.col(vec_col).alias("vec"),
    )
    fine = with_dimension(named.where("id IS NOT NULL AND label IS NOT NULL"))
    # equal vectors of a label are one class, named by its least id
    rows = stage_table(fine.distinct(), "vectors")
    classes = stage_table(
        rows.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("n")), "classes"
    )
    # an id with several vectors may be the least of several classes
    numbered = classes.withColumn("k", F.row_number().over(Window.partitionBy("least").orderBy("label", "vec")))
    classes = stage_table(
        numbered.withColumn("id", F.when(F.col("k") == 1, F.col("least")).otherwise(
            # hashes name the others; an id of the table is one of them by chance only
            F.xxhash64("least", "label", "vec"))), "named"
    )
    links, parts, _, _ = links_at_goal(classes.select("id", "label", "vec"), bound)
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a link counts for each vector of the other class; most classes have one
    more = classes.where("n > 1").select(F.col("id").alias("b"), (F.col("n") - 1).alias("others"))
    ends = ends.groupBy("a").agg(F.count("*").alias("others")).union(
        ends.join(more, "b").groupBy("a").agg(F.sum("others").alias("others"))
    ).groupBy(F.col("a").alias("id")).agg(F.sum("others").alias("others"))
    least = classes.select("id", "least").join(parts, "id", "left")
    roots = least.groupBy(F.coalesce("component", "id").alias("root")).agg(F.min("least").alias("component_id"))
    found = least.select("id", F.coalesce("component", "id").alias("root")).join(roots, "root")
    found = classes.join(found, "id").join(ends, "id", "left").select(
        "label", "vec", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id",
    )
    # an id in several classes joins them, so components of classes that share one are one
    shared = rows.join(found, ["label", "vec"]).select("id", "label", "vec", "n_links", "component_id")
    joined = stage_table(shared, "joined")
    several = joined.groupBy("id").agg(
        F.min("component_id").alias("a"), F.max("component_id").alias("b")
    ).where("a <> b")
    if not several.isEmpty():
        pairs = joined.join(several.select("id"), "id").groupBy("id").agg(
            F.min("component_id").alias("a"), F.collect_set("component_id").alias("all")
        ).select("a", F.explode("all").alias("b"))
        merged = connected_components(pairs).select(F.col("id").alias("component_id"), "component")
        joined = joined.join(merged, "component_id", "left").withColumn(
            "component_id", F.coalesce("component", "component_id")
        ).drop("component")
    result = joined.select(F.col("id").alias("of"), "label", "vec", "n_links", "component_id")
    own = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("own_label"), F.col(vec_col).alias("own_vec"))
    same = (F.col("id") == F.col("of")) & (F.col("own_label") == F.col("label")) & (F.col("own_vec") == F.col("vec"))
    return (
        own.join(result, same, "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", F.col("id").cast("long")).alias("component_id"),
            F.coalesce(F.coalesce("component_id", F.col("id")) == F.col("id"), F.lit(False)).alias("kept"),
        )
    )
