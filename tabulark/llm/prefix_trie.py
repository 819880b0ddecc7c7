"""Conversations as a trie of their turns, with counts of every node.

A turn is known by a digest of its role and text. The digest of a prefix is the exclusive
or of its turns' digests, each hashed with its place, so it is a running value that long
conversations compute in chunks (``CHUNK_TURNS`` places), and no conversation is ever in
one task. Distinct prefix digests are the nodes; each node's last turn and parent are
checked to be the same in all its members, which proves by induction that no two different
prefixes share a digest (else all digests are drawn anew).

Sums over subtrees run in shards. A node's load, the members' turns from it on, only falls
on the way down. Nodes are dealt into tiers by load (``PIECE`` and then ``FANOUT`` times as
much for each tier), and within a tier into pieces, the subtrees that hang on a node of a
higher tier. A shard holds many whole pieces: a minimal perfect hash gives every digest a
slot, verified by the digest stored there; counts are scattered into flat arrays, parents
become slots, and levels are added to their parents' slots from the deepest up. What the
tops of pieces sum up goes to their parents in the next tier. Nodes with a single member
are chains with nothing to sum and stay outside.

Defined results: rows without a conversation id belong to none and are left out; a null
role or text is empty; turns are ordered by turn (null first), equal ones by role and text;
repeated rows are turns of their own; an empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulark.llm.batches import Stages

CHUNK_TURNS = 65_536
PIECE, FANOUT, SHARD_NODES = 4_096, 64, 65_536
ENDS_A_ROW = 65_536
#: a rebuilt conversation starts with up to five turns of the first one of its hundred
FAMILY, MOST_HEAD = 100, 5
NO_ENDS = hashlib.sha256(b"").hexdigest()
KEY = ["k1", "k2"]


class SlotTable:
    """Minimal perfect hash of distinct 128-bit keys. Each round puts the remaining keys
    into one and a half times as many places; those alone in their place get the next
    slots in order of places, the others go on to the next round. The keys stand in their
    slots, so a lookup is verified and a strange key finds none."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.k1, self.k2 = np.zeros_like(k1), np.zeros_like(k2)
        self.rounds: list[np.ndarray] = []
        rest, taken = np.arange(len(k1)), 0
        while len(rest):
            at = self._place(k1[rest], k2[rest], len(self.rounds), places := len(rest) * 3 // 2 + 1)
            alone = np.bincount(at, minlength=places) == 1
            slots = np.where(alone, taken + np.cumsum(alone) - 1, -1)
            self.rounds.append(slots)
            done = alone[at]
            self.k1[slots[at[done]]], self.k2[slots[at[done]]] = k1[rest[done]], k2[rest[done]]
            taken += int(done.sum())
            rest = rest[~done]

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, round_no: int, places: int) -> np.ndarray:
        mixed = k1.astype(np.uint64) + np.uint64((round_no * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)) * k2.astype(np.uint64)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        return (mixed % np.uint64(places)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for one that is not here."""
        found = np.full(len(k1), -1, np.int64)
        rest = np.arange(len(k1))
        for round_no, slots in enumerate(self.rounds):
            got = slots[self._place(k1[rest], k2[rest], round_no, len(slots))]
            # a place that one key has alone ends the search: a strange key, or this one
            hit = got >= 0
            same = (self.k1[got] == k1[rest]) & (self.k2[got] == k2[rest]) & hit
            found[rest[same]] = got[same]
            rest = rest[~hit]
        return found


def sum_shard(nodes: pa.Table) -> pa.Table:
    """Leaves and saved tokens of the subtrees of one shard; ``top`` marks nodes whose
    parent is not here."""
    column = {c: nodes.column(c).to_numpy(zero_copy_only=False) for c in nodes.column_names}
    table = SlotTable(column["k1"], column["k2"])
    slot = table.find(column["k1"], column["k2"])
    if len(np.unique(slot)) != len(slot) or (slot < 0).any():
        raise ValueError("two nodes of one digest in a shard")

    def flat(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(slot), np.int64)
        out[slot] = values
        return out

    leaves, saved, depth = flat(column["leaves"]), flat(column["saved"]), flat(column["depth"])
    parent = flat(np.where(column["root"], -1, table.find(column["p1"], column["p2"])))
    order = np.argsort(-depth, kind="stable")
    levels = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, levels):
        inner = level[parent[level] >= 0]
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])
    return pa.table({
        "k1": column["k1"], "k2": column["k2"], "p1": column["p1"], "p2": column["p2"],
        "leaves": leaves[slot], "saved": saved[slot], "top": parent[slot] < 0,
    })


def turn_rows(conversations: DataFrame, stages: Stages) -> DataFrame:
    """``conv_id, p, d, chars``: every turn's place from 0, digest and length."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        text["role"].alias("role"), text["text"].alias("text"),
        F.unhex(F.md5(F.concat(F.length(text["role"]), F.lit(":"), text["role"], text["text"]))).alias("d"),
    )
    digests = stages.write(
        rows.select("conv_id", "turn", "d", F.char_length("text").cast("long").alias("chars")), "turns"
    )
    same = [F.col("conv_id") == F.col("tied_conv"), F.col("turn").eqNullSafe(F.col("tied_turn"))]
    tied = digests.groupBy(F.col("conv_id").alias("tied_conv"), F.col("turn").alias("tied_turn")).agg(
        F.min("d").alias("low"), F.max("d").alias("high")
    ).where("low <> high").drop("low", "high")
    tied = stages.write(tied, "tied")
    if tied.isEmpty():
        digests = digests.withColumn("tie", F.lit(0))
    else:  # only the texts of equal turns are needed to order them
        by_text = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
        ties = rows.join(tied, same, "left_semi").withColumn("tie", F.dense_rank().over(by_text))
        ties = ties.groupBy("conv_id", "turn", "d").agg(F.min("tie").alias("tie")).select(
            F.col("conv_id").alias("tied_conv"), F.col("turn").alias("tied_turn"),
            F.col("d").alias("tied_d"), "tie",
        )
        digests = digests.join(ties, [*same, F.col("d") == F.col("tied_d")], "left").drop(
            "tied_conv", "tied_turn", "tied_d"
        )
    chunked = digests.withColumn("chunk", F.floor(F.col("turn") / CHUNK_TURNS))
    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy("turn", "tie", "d")
    numbered = chunked.withColumn("n", F.row_number().over(in_chunk))
    sizes = chunked.groupBy("conv_id", "chunk").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("conv_id").alias("of"), F.col("chunk").alias("of_chunk"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"),
    )
    at = [F.col("conv_id") == F.col("of"), F.col("chunk").eqNullSafe(F.col("of_chunk"))]
    placed = numbered.join(offsets, at)
    return placed.select("conv_id", (F.col("n") + F.col("offset") - 1).alias("p"), "d", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, size`` of every rebuilt conversation, and its turns ``conv_id, q, d, chars``.

    A conversation begins with the first turns of the conversation whose number ends in
    00 before it; how many, from 0 to 5, its id decides. Its own turns after as many follow.
    """
    head = (F.crc32(F.col("conv_id").cast("string")) % (MOST_HEAD + 1)).cast("long")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    sizes = sizes.withColumns({"head": head, "base": base})
    firsts = turns.where((F.col("p") < MOST_HEAD) & (F.col("conv_id") % FAMILY == 0))
    firsts = firsts.groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("p", "d", "chars"))).alias("firsts")
    )
    convs = sizes.join(firsts, "base", "left").withColumn(
        "taken", F.least("head", F.coalesce(F.size("firsts"), F.lit(0))).cast("long")
    )
    convs = convs.withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    heads = convs.where("taken > 0").select(
        "conv_id", "size", F.posexplode(F.slice("firsts", F.lit(1), F.col("taken").cast("int"))).alias("q", "t")
    ).select("conv_id", "size", F.col("q").cast("long").alias("q"), "t.d", "t.chars")
    own = turns.where(F.col("p") >= head).join(convs.select("conv_id", "size", "head", "taken"), "conv_id")
    own = own.select("conv_id", "size", (F.col("p") - F.col("head") + F.col("taken")).alias("q"), "d", "chars")
    return convs.select("conv_id", "size"), heads.unionByName(own)


def prefix_rows(convs: DataFrame, turns: DataFrame, seed: int) -> DataFrame:
    """``conv_id, size, depth, k1, k2, p1, p2, d, chars``: every prefix of every rebuilt
    conversation, the empty one (key 0, 0) included, with its parent's key."""
    drawn = turns.withColumns({
        "chunk": F.floor(F.col("q") / CHUNK_TURNS),
        "e1": F.xxhash64(F.lit(2 * seed), "q", "d"),
        "e2": F.xxhash64("d", F.lit(2 * seed + 1), "q"),
    })
    here = Window.partitionBy("conv_id", "chunk").orderBy("q")
    running = drawn.withColumns({f"r{i}": F.bit_xor(f"e{i}").over(here) for i in (1, 2)})
    chunks = drawn.groupBy("conv_id", "chunk").agg(*[F.bit_xor(f"e{i}").alias(f"x{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # only conversations of more than one chunk have anything to carry
    carried = chunks.select(
        "conv_id", "chunk", *[F.bit_xor(f"x{i}").over(earlier).alias(f"c{i}") for i in (1, 2)]
    ).where("chunk > 0")
    rows = running.join(carried, ["conv_id", "chunk"], "left")
    key = {i: F.col(f"r{i}").bitwiseXOR(F.coalesce(F.col(f"c{i}"), F.lit(0))) for i in (1, 2)}
    rows = rows.select(
        "conv_id", "size", (F.col("q") + 1).alias("depth"), key[1].alias("k1"), key[2].alias("k2"),
        key[1].bitwiseXOR(F.col("e1")).alias("p1"), key[2].bitwiseXOR(F.col("e2")).alias("p2"), "d", "chars",
    )
    none = F.lit(None)
    roots = convs.select(
        "conv_id", "size", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"),
        F.lit(0).cast("long").alias("k2"), none.cast("long").alias("p1"), none.cast("long").alias("p2"),
        none.cast("binary").alias("d"), F.lit(0).cast("long").alias("chars"),
    )
    return rows.unionByName(roots)


def node_table(rows: DataFrame) -> DataFrame:
    """One row a node; ``doubt`` where members disagree on its last turn, parent or depth."""
    load = F.col("size") - F.col("depth") + 1
    checked = ["p1", "p2", "d", "depth"]
    nodes = rows.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(load).alias("load"),
        F.max("chars").alias("chars"), F.sum((F.col("depth") == F.col("size")).cast("long")).alias("ends"),
        *[F.min(c).alias(c) for c in checked], *[F.max(c).alias(f"{c}_high") for c in checked],
    )
    doubt = F.lit(False)
    for c in checked:
        doubt = doubt | ~F.col(c).eqNullSafe(F.col(f"{c}_high"))
    return nodes.withColumn("doubt", doubt).drop("d", *[f"{c}_high" for c in checked])


def _tier(load: Column) -> Column:
    """0 up to ``PIECE``, one more for each factor ``FANOUT``."""
    steps = F.ceil(F.log(F.greatest(load, F.lit(1)) / F.lit(float(PIECE))) / F.log(F.lit(float(FANOUT))))
    return F.greatest(steps, F.lit(0)).cast("int")


def subtree_sums(stages: Stages, rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``k1, k2, n_leaves, saved_tokens`` of the nodes with more than one member."""
    tiers = shared.select(*KEY, "tier")
    # the top of a node's piece lies on the path of each of its members
    on_path = rows.select("conv_id", "depth", *KEY).join(tiers, KEY)
    tops = on_path.groupBy("conv_id", "tier").agg(F.min_by(F.struct(*KEY), "depth").alias("piece"))
    placed = stages.write(shared.join(tops, ["conv_id", "tier"]), "pieces")
    sums, adds = None, None
    per_tier = {r.tier: r["count"] for r in placed.groupBy("tier").count().collect()}
    for tier in sorted(per_tier):
        level = placed.where(F.col("tier") == tier)
        if adds is not None:
            level = level.join(adds, KEY, "left")
            for c in ("leaves", "saved"):
                level = level.withColumn(c, F.col(c) + F.coalesce(f"add_{c}", F.lit(0)))
        shards = max(1, -(-per_tier[tier] // SHARD_NODES) * 4)
        missing = [F.coalesce(c, F.lit(0)).alias(c) for c in ("p1", "p2")]
        level = level.select(
            F.pmod(F.xxhash64("piece"), F.lit(shards)).alias("shard"), *KEY, *missing,
            "depth", "leaves", "saved", F.col("p1").isNull().alias("root"),
        )

        def shard(nodes):
            return sum_shard(nodes.combine_chunks())

        schema = "k1 long, k2 long, p1 long, p2 long, leaves long, saved long, top boolean"
        done = stages.write(level.groupBy("shard").applyInArrow(shard, schema), f"tier{tier}")
        up = done.where("top AND (k1 <> 0 OR k2 <> 0)").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
            F.sum("leaves").alias("add_leaves"), F.sum("saved").alias("add_saved")
        )
        adds = up if adds is None else adds.unionByName(up).groupBy(*KEY).agg(
            F.sum("add_leaves").alias("add_leaves"), F.sum("add_saved").alias("add_saved")
        )
        part = done.select(*KEY, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
        sums = part if sums is None else sums.unionByName(part)
    return sums


def end_digests(stages: Stages, ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` from ``k1, k2, conv_id``: the SHA-256 of the ids of a node in
    order. The rows are sorted into even ranges, where runs of a node become joined texts;
    then a task reads the few texts of a node one after the other."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, ids = (batch.column(i).to_numpy() for i in range(3))
            if not len(ids):
                continue
            new = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
            starts = np.concatenate([[0], new])
            texts = [",".join(map(str, run)) for run in (x.tolist() for x in np.split(ids, new))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[starts]), pa.array(k2[starts]), pa.array(ids[starts]), pa.array(texts)],
                ["k1", "k2", "first", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) != key:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield rows(out)
            out = []
        if key:
            yield rows([(*key, state.hexdigest())])

    def rows(out) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*out)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["k1", "k2", "ends_sha256"]
        )

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even = ends.select(*KEY, "conv_id").repartitionByRange(parts, *KEY, "conv_id")
    joined = even.sortWithinPartitions(*KEY, "conv_id").mapInArrow(
        join, "k1 long, k2 long, first long, ids string"
    )
    joined = stages.write(joined, "ends")
    dealt = joined.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
    return dealt.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` of every node, named by its smallest member and its depth."""
    stages = Stages(conversations.sparkSession)
    convs, turns = rebuilt(stages.write(turn_rows(conversations, stages), "placed"))
    convs, turns = stages.write(convs, "convs"), stages.write(turns, "rebuilt")
    seed = 0
    while True:
        rows = stages.write(prefix_rows(convs, turns, seed), f"prefixes{seed}")
        nodes = stages.write(node_table(rows), f"nodes{seed}")
        if nodes.where("doubt").isEmpty():
            break
        seed += 1
    children = nodes.where("p1 IS NOT NULL").groupBy(
        F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("chains"))
    nodes = nodes.join(children, KEY, "left").fillna(0, ["n_children", "chains"])
    # a chain below has one leaf and saves nothing
    shared = nodes.where("n_convs > 1").withColumns({
        "leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("chains")).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("chars"), "tier": _tier(F.col("load")),
    }).select(*KEY, "p1", "p2", "conv_id", "depth", "leaves", "saved", "tier")
    sums = subtree_sums(stages, rows, stages.write(shared, "shared"))
    ends = end_digests(stages, rows.where("depth = size"))
    out = nodes.join(ends, KEY, "left")
    if sums is not None:
        out = out.join(sums, KEY, "left")
    else:
        out = out.withColumns({c: F.lit(None).cast("long") for c in ("n_leaves", "saved_tokens")})
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = out.join(above, ["p1", "p2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


SQL = """
WITH convs AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT c, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS b FROM convs),
sums AS (
  SELECT c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    flatten(list_transform(b, lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x)
      WHEN s & 1 = 1 THEN xor(s >> 1, CAST(3988292384 AS BIGINT)) ELSE s >> 1 END),
    CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM bits),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(coalesce(role, '')),
      encode(coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
parts AS (
  SELECT s.c, 0 AS own, t.p, t.role, t.text FROM sums s JOIN turns t ON t.c = s.c - s.c % 100 AND t.p < s.h
  UNION ALL SELECT s.c, 1, t.p, t.role, t.text FROM sums s JOIN turns t ON t.c = s.c AND t.p >= s.h),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d,
    sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS e FROM parts),
paths AS (
  SELECT c, d, length(text) AS chars,
    sha256(string_agg(e, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k FROM placed
  UNION ALL SELECT c, 0, 0, '' FROM convs),
ups AS (SELECT *, lag(k) OVER w AS up, lead(d) OVER w IS NULL AS last FROM paths WINDOW w AS (PARTITION BY c ORDER BY d)),
nodes AS (
  SELECT k, d, min(c) AS conv_id, any_value(up) AS up, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM ups GROUP BY k, d),
children AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (k)),
above AS (
  SELECT a.k, x.k AS below FROM ups a JOIN ups x ON x.c = a.c AND x.d >= a.d
  JOIN nodes n ON n.k = x.k AND n.conv_id = x.c),
totals AS (
  SELECT a.k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM above a JOIN full_nodes n ON n.k = a.below GROUP BY a.k)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  t.n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN totals t ON t.k = n.k LEFT JOIN nodes p ON n.d > 0 AND p.k = n.up
"""
