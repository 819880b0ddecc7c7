"""The trie against a plain one, with chunks, pieces and shards of a few rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tabulark.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, d string, chunk long"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        first = own.get(c - int(np.fmod(c, 100)), [])[:h]
        path = tuple(t[2:] for t in first + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        text = len(p[-1][1]) if p else 0
        saved[p] = (len(members[p]) - 1) * text + sum(saved[c] for c in children[p])
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def found(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in T.prefix_trie(df).collect())


def conversations(seed, n=150):
    rng = random.Random(seed)
    texts = [None, "", "a", "bb", "ccc", "é😀"]
    rows = []
    for _ in range(n):
        conv = rng.choice([rng.randrange(-150, 320), rng.randrange(3) * 100])
        turns = rng.sample([None, *range(9)], rng.randint(1, 7))
        rows += [(conv, t, rng.choice(["user", "assistant", None]), rng.choice(texts), "x", 1) for t in turns]
    # a long conversation, copies of it, and one turn that many share
    for conv in (400, 500, 501, 502, 700):
        rows += [(conv, t, "user", f"turn {t % 5}", None, None) for t in range(40)]
    rows += [(1000 + i, 0, "user", "hello", None, None) for i in range(60)]
    return [*rows, (None, 1, "user", "nobody", None, None), rows[0], rows[-1]]


@pytest.mark.parametrize("chunk, piece, fanout, shard", [(65_536, 4_096, 64, 65_536), (4, 3, 4, 10)])
def test_equal_to_a_plain_trie(spark, monkeypatch, chunk, piece, fanout, shard):
    for name, value in (("CHUNK_TURNS", chunk), ("PIECE", piece), ("FANOUT", fanout), ("SHARD_NODES", shard)):
        monkeypatch.setattr(T, name, value)
    rows = conversations(1)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_equal_turns_are_ordered_by_role_and_text(spark):
    rows = [(7, 1, "b", "x"), (7, 1, "a", "y"), (7, 1, "a", None), (8, None, None, None), (8, None, "z", "q")]
    rows = [(*r, None, None) for r in rows]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_single_conversation_and_an_empty_table(spark):
    rows = [(5, t, "user", "x" * t, None, None) for t in range(8)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b", None, None)], SCHEMA)) == []


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(-2**63, 2**63 - 1, (3000, 2)), axis=0)
    k1, k2 = keys[:2000].T
    table = T.SlotTable(k1.copy(), k2.copy())
    assert sorted(table.find(k1, k2)) == list(range(2000))
    assert (table.find(*keys[2000:].T) == -1).all()
    assert len(T.SlotTable(k1[:0], k2[:0]).find(k1, k2)) == 2000


def test_ends_of_a_node_over_many_ranges(spark, tmp_path):
    rows = [(1, 2, i * 7 % 10_000) for i in range(10_000)] + [(0, 5, 3), (1, 1, 9)]
    ends = spark.createDataFrame(rows, "k1 long, k2 long, conv_id long")
    got = {(r.k1, r.k2): r.ends_sha256 for r in T.end_digests(T.Stages(spark), ends).collect()}
    want = defaultdict(list)
    for k1, k2, c in rows:
        want[k1, k2].append(c)
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
