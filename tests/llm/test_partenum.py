import random
import re

import numpy as np
import pytest

from tabulark.llm import partenum as P
from tabulark.llm.components import connected_components


def brute_sets(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """{id: (size, component)} by comparing all pairs."""
    sets = {i: brute_sets(t) for i, t in rows}
    part = {i: i for i in sets}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                part[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(docs_of, rows):
    got = P.similar_sets(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def edited(words, share, draw):
    return [draw.choice("pqrstuvw") + str(draw.random()) if draw.random() < share else w for w in words]


def test_against_all_pairs(docs_of):
    """Sizes around every band border, similarities around the bound, shared passages."""
    draw = random.Random(7)
    rows, shared = [], [f"s{i}" for i in range(60)]
    for size in (1, 3, 5, 6, 8, 12, 24, 28, 30, 36, 44, 46, 60, 79, 84, 100, 140, 250, 420):
        base = [f"w{draw.randrange(400)}" for _ in range(size)]
        for share in (0, 0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06):
            rows.append(edited(base, share, draw))
        rows += [base + base[:3], base[: size - size // 5], shared + base[: size // 2]]
    check(docs_of, [(i, " ".join(r)) for i, r in enumerate(rows)])


def test_shared_tables(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in P.similar_sets(documents).collect()}
    assert got == brute(rows)


def test_a_large_group_of_near_copies(docs_of):
    draw = random.Random(3)
    base = [f"w{draw.randrange(900)}" for _ in range(120)]
    rows = [(i, " ".join(edited(base, 0.02, draw))) for i in range(120)]
    rows += [(1000 + i, " ".join(base)) for i in range(60)]
    check(docs_of, rows)


def test_words_and_case(docs_of):
    check(docs_of, [
        (1, "A\tb\nC\rd\x0be\x0cf"), (2, "a b c d e f"), (3, "Ä b c d e f"), (4, "ä b c d e f"),
        (5, None), (6, ""), (7, " \n"), (8, "short"), (9, "SHORT"), (10, "short\xa0"), (11, "a b c d"),
        (12, "a b c  D "), (13, None),
    ])


def test_repeated_rows_null_ids_clashing_columns_and_empty(spark):
    schema = "doc_id long, text string, key string, n string, run string, component string"
    rows = [(4, "one two three four five six", *"abcd"), (4, "one two three four five six", *"abcd"),
            (None, "one two three four five six", *"abcd"), (None, "other", *"abcd"), (9, "x", *"abcd")]
    table = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, P.similar_sets(table).collect()), key=str)
    assert got == sorted([(4, 2, 4), (4, 2, 4), (None, 2, 4), (None, 1, None), (9, 1, 9)], key=str)
    assert P.similar_sets(table.limit(0)).collect() == []


def test_links_through_rows_without_id(spark):
    """The middle of a chain has no id, as have its copy and a pair that no id reaches."""
    w = [f"w{i}" for i in range(104)]
    other = " ".join(f"z{i}" for i in range(90))
    rows = [(9, " ".join(w)), (None, " ".join(w[12:] + [f"x{i}" for i in range(12)])),
            (None, " ".join(w[12:] + [f"x{i}" for i in range(12)])),
            (1, " ".join(w[24:] + [f"x{i}" for i in range(24)])),
            (None, other), (None, other + " end"), (3, "a text of its own here")]
    assert brute([(i, t) for i, t in rows if i])[9][1] == 9
    told = [(i if i is not None else 100 + k, t) for k, (i, t) in enumerate(rows)]
    want = [c if c < 100 else None for _, (_, c) in sorted(brute(told).items())]
    assert want == [1, 3, 1, 1, 1, None, None]
    got = P.similar_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == sorted(
        (i or 0, len(brute_sets(t)), c or 0) for (i, t), c in zip(
            [rows[3], rows[6], rows[0], rows[1], rows[2], rows[4], rows[5]], want))


@pytest.mark.parametrize("size", [25, 42, 43, 57, 75, 133, 236, 400, 1000])
def test_linked_pairs_share_a_signature(size):
    draw = np.random.default_rng(size)
    for _ in range(20):
        pool = np.unique(draw.integers(0, 1 << 63, 4 * size).astype(np.uint64) * np.uint64(2))
        pool = draw.permutation(pool)
        both = size * 6 // 7 + 1  # the least intersection of equal sizes at the bound
        a = np.sort(np.concatenate((pool[:both], pool[both:size])))
        b = np.sort(np.concatenate((pool[:both], pool[2 * size : 3 * size - both])))
        if not P.fitting(a) & 1:
            continue
        sig, owner = P.signatures([a, b], P.MARGINS[0])
        assert set(sig[owner == 0]) & set(sig[owner == 1])


def test_blocks_come_back():
    sets = [np.unique(np.random.default_rng(k).integers(0, 1 << 63, 90).astype(np.uint64) * np.uint64(2)) for k in range(4)]
    sig, owner = P.signatures(sets, 2.6)
    assert set(owner) == {0, 1, 2, 3}
    assert sum(P.fitting(s) & 1 for s in sets) == 4


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    links = spark.createDataFrame(chain + star + [(7, 7), (41, 3), (None, 5), (200, 199)], "a long, b long")
    got = {r.id: r.component for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(42)} | {i: 100 for i in range(100, 130)} | {199: 199, 200: 199}
    assert connected_components(links.limit(0)).count() == 0
