import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.llm.mixing import mix_sources, mixed_rows, source_targets
from tabulark.llm.sharding import jump, shard_rows


def reference_jump(key, shards):
    """The published loop, on one mixed key."""
    top = (1 << 64) - 1
    key = (key ^ key >> 30) * 0xBF58476D1CE4E5B9 & top
    key = (key ^ key >> 27) * 0x94D049BB133111EB & top
    key ^= key >> 31
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & top
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_against_the_loop_and_the_law():
    keys = np.array([*range(3000), (1 << 64) - 1, 1 << 63], np.uint64)
    for n in (1, 2, 16, 17, 100):
        assert jump(keys, n).tolist() == [reference_jump(int(k), n) for k in keys]
    for n in range(1, 40):
        now, grown = jump(keys, n), jump(keys, n + 1)
        moved = now != grown
        assert (grown[moved] == n).all()
        assert moved.mean() < 2 / (n + 1)
    assert np.bincount(jump(keys, 16)).min() > 130
    with pytest.raises(ValueError):
        jump(keys, 0)


def test_rows_of_shards(docs_of, documents):
    got = shard_rows(documents).toPandas()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(got) == len(texts)
    for r in got.itertuples():
        data = texts[r.doc_id].encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data) and r.law == "key"
        assert (r.shard, r.grown_shard) == (reference_jump(r.doc_id, 16), reference_jump(r.doc_id, 17))
    for _, shard in got.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    odd = docs_of([(1, None), (1, None), (1, "é"), (None, "a"), (None, "b"), (-5, "")])
    got = shard_rows(odd).toPandas()
    assert sorted(got["size"]) == [1, 1, 1, 2, 2, 3]
    for _, shard in got.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    assert shard_rows(odd.limit(0)).count() == 0
    clash = odd.withColumns({"shard": F.lit("x"), "slot": F.lit("y"), "size": F.lit("z")})
    assert shard_rows(clash).count() == 6


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Rounds of capping and sharing again."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        open_ = [s for s in order if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= cap * sizes[s]]
        if not over or len(over) == len(open_):
            return capped | (share if not over else {s: cap * sizes[s] for s in open_})
        capped |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 0, None: 40},
    {"z": 7}, {"a": 3, "B": 900, "é": 20, "": 8, "𝔘": 50, "～": 60, None: 1}, {"a": 0, "b": 0},
])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(table).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in sizes:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def test_mix_comes_near_its_targets_and_repeats(documents):
    one = mix_sources(documents).toPandas().set_index("doc_id").sort_index()
    two = mix_sources(documents.repartition(7)).toPandas().set_index("doc_id").sort_index()
    assert (one["taken"] == two["taken"]).all()
    rows = documents.toPandas().set_index("doc_id").sort_index()
    words = rows["text"].str.count(r"[^\x20\x09-\x0D]+")
    assert (one["size"] == words).all()
    assert ((one["taken"] == 0) | (one["taken"] % one["size"].clip(1) == 0)).all()
    assert (one["taken"] <= 3 * one["size"]).all()
    for _, part in one.groupby(rows["source"]):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= part["size"].max() / 2 + 1
    many = mixed_rows(documents).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    times = (one["taken"] // one["size"].clip(1))[lambda x: x > 0]
    assert many.sort_index().to_dict() == times.to_dict()


def test_mix_of_odd_rows(docs_of, spark):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (None, "x y", None, None), (None, "z", None, None),
            (3, "one two three", None, "b"), (3, "one two three", None, "b"), (4, "w " * 200_000, None, "c")]
    table = docs_of(rows)
    got = mix_sources(table).collect()
    assert len(got) == 7 and all(r.taken <= 3 * r.size and r.taken >= 0 for r in got)
    assert {r.target for r in got if r.source_size == 0} == {0.0}
    same = [r.taken for r in got if r.doc_id == 3]
    assert same[0] == same[1]
    assert mix_sources(table.limit(0)).count() == 0 and mixed_rows(table.limit(0)).count() == 0
    clash = table.withColumns({c: F.lit("x") for c in ("s", "hash", "below", "copies", "target")})
    assert mixed_rows(clash).columns == clash.columns
    assert mix_sources(clash).count() == 7
    assert mix_sources(docs_of([(1, " ", None, "a")])).collect()[0].taken == 0
