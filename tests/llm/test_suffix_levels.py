import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tabulark.llm import suffix_levels as S
from tabulark.llm.suffix_levels import remove_repeats


def brute(rows, length):
    """{(id, text): (bytes, removed, spans, sha256)} from all windows."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    found = []
    for i, b in texts:
        hit = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                hit[k : k + length] = b"\x01" * length
        kept = bytes(c for c, h in zip(b, hit) if not h)
        spans = sum(1 for k, h in enumerate(hit) if h and (k == 0 or not hit[k - 1]))
        found.append((i, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def check(docs_of, rows, length=200, **more):
    got = [tuple(r) for r in remove_repeats(docs_of(rows), length=length, **more).collect()]
    assert sorted(got, key=str) == brute(rows, length)


def prose(draw, n):
    return "".join(draw.choice("abcdefghij klmé") for _ in range(n))


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_against_all_windows(docs_of, batches):
    draw = random.Random(5)
    passages = [prose(draw, n) for n in (199, 200, 201, 260, 500, 900)]
    rows = []
    for i in range(40):
        parts = [prose(draw, draw.randrange(0, 400)) for _ in range(3)]
        for _ in range(draw.randrange(0, 3)):
            p = draw.choice(passages)
            cut = draw.randrange(0, 60)
            parts.insert(draw.randrange(0, 3), p[cut:] if draw.random() < 0.5 else p[: len(p) - cut])
        rows.append((i, "".join(parts)))
    rows += [(90, rows[0][1]), (91, passages[4] + passages[4]), (92, passages[4][:300] + "é" + passages[4][300:])]
    check(docs_of, rows, batches=batches)


@pytest.mark.parametrize("hot_edges", [0, 5])
def test_edges_of_hot_keys_as_rows(docs_of, hot_edges):
    draw = random.Random(8)
    passage, other = prose(draw, 320), prose(draw, 260)
    rows = [(i, prose(draw, draw.randrange(0, 120)) + passage[draw.randrange(0, 90):] + prose(draw, 60))
            for i in range(30)]
    rows += [(40 + i, prose(draw, 80) + other + prose(draw, 80)) for i in range(3)]
    rows += [(50, passage + prose(draw, 40) + passage), (51, None), (52, passage[:150]), (50, "twice")]
    check(docs_of, rows, hot_edges=hot_edges)


def test_hot_keys_need_no_further_pass_over_the_texts(docs_of, monkeypatch):
    """Edges of hot keys come with the others: nothing else is staged, no text moves again."""
    draw = random.Random(18)
    passage = prose(draw, 320)
    rows = [(i, prose(draw, 70) + passage[draw.randrange(0, 90):] + prose(draw, 60)) for i in range(20)]
    staged, write = [], S.Stages.write
    monkeypatch.setattr(S.Stages, "write", lambda self, df, name: (staged.append(name), write(self, df, name))[1])
    plans = [remove_repeats(docs_of(rows), hot_edges=n) for n in (0, 10_000)]
    assert staged == 2 * ["matches", "stretches", "edges"]
    for plan in plans:
        assert sorted(map(tuple, plan.collect()), key=str) == brute(rows, 200)


def test_a_common_window_leaves_a_block_once():
    draw = random.Random(19)
    same = prose(draw, 230).encode()
    asked = [(n, 5, n > 0, same) for n in range(50)] + [(60, 7, True, b"-" + same[:200])]
    out = S.hot_windows(asked, 200).to_pylist()
    windows = len(same) - 199
    going = [r for r in out if r["stop"] is None]
    assert len(going) == len({r["key"] for r in going}) == windows + 1
    assert [r["number"] for r in going if r["alone"]] == [60]  # the rest is settled here
    spans = sorted((r["number"], r["start"], r["stop"]) for r in out if r["stop"] is not None)
    assert spans == [(n, 5, 5 + len(same)) for n in range(1, 50)] + [(60, 8, 208)]


def test_runs_of_one_character_ties_and_short_texts(docs_of):
    rows = [(1, "a" * 500), (2, "b" * 200), (3, "c" * 201), (4, "b" * 199), (5, None), (6, ""), (7, "a" * 150),
            (8, "ab" * 300), (9, "x" + "ab" * 200)]
    check(docs_of, rows)


def test_repeated_rows_and_ids_of_several_texts(docs_of):
    draw = random.Random(9)
    one, two = prose(draw, 700), prose(draw, 700)
    rows = [(1, one), (1, one), (2, two), (2, one[:350] + two[:300]), (None, two), (None, prose(draw, 300))]
    check(docs_of, rows)


def test_a_text_of_many_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(S, "PLACE_BITS", np.uint64(11))  # pieces of 1,024 bytes, also in the tasks
    draw = random.Random(2)
    same = prose(draw, 2600)
    texts = [prose(draw, 300) + same + prose(draw, 2500), same[:2200] + prose(draw, 900)]
    parts = S.sample_suffixes([t.encode() for t in texts], np.array([0, 1]), 200, 24)
    for doc, t in enumerate(texts):
        own = parts.take(parts.doc == doc)
        places = np.concatenate([np.arange(s, s + c) for s, c in zip(own.start, own.count.astype(int))])
        assert sorted(places.tolist()) == list(range(len(t.encode()) - 199))


def test_shared_tables(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = [tuple(r) for r in remove_repeats(documents).collect()]
    assert sorted(got, key=str) == brute(rows, 200)


def test_kept_text_has_whole_characters_and_other_columns(docs_of, spark):
    draw = random.Random(4)
    same = "é" * 20 + prose(draw, 300) + "日本" * 10
    rows = [(1, "A" + same + "ü1", "en", "s"), (2, "è" + same + "û2", None, "t"), (3, None, "x", "y"), (4, "clean", "x", "y")]
    got = {r.doc_id: r for r in remove_repeats(docs_of(rows), keep=["lang", "source"], with_text=True).collect()}
    assert got[1].kept_text == "Aü1" and got[2].kept_text == "èû2"
    assert got[3].kept_text is None and got[4].kept_text == "clean" and got[2].source == "t"
    clash = spark.createDataFrame([(1, "t", "n", "s")], "doc_id long, text string, number string, spans string")
    assert remove_repeats(clash).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert remove_repeats(clash.limit(0)).count() == 0


def test_levels_merge_geometrically(spark, docs_of):
    rows = docs_of([(i, prose(random.Random(i), 400)) for i in range(12)]).selectExpr(
        "doc_id AS number", "CAST(text AS binary) AS text"
    )
    index = S.SuffixLevels(spark)
    sizes = []
    for k in range(6):
        index.add(rows.where(f"number % 6 = {k}"))
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2]]
    assert index.matches().count() == 0


def test_packed_entries_come_back():
    e = S.sample_suffixes([b"some text " * 90, bytes(range(256)) * 3], np.array([5, -6]), 200, 24)
    e = e.take(np.argsort(e.key))
    back = S.Entries.unpack(e.pack())
    for f, _ in S.Entries.FIELDS:
        assert (getattr(e, f) == getattr(back, f)).all()
