import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.llm import kmeans_tree
from tabulark.llm.flat_graph import build_graph, found_links, near_duplicates, range_search, unit
from tabulark.llm.kmeans_tree import build_tree, cells_of, search

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def make(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def grouped(n, seed=1, dim=16):
    """Tight groups around random centres, labels in turn."""
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(n // 6, dim))
    x = centers[draw.integers(0, len(centers), n)] + draw.normal(size=(n, dim)) * 0.12
    return x.astype(np.float32), draw.integers(0, 3, n)


def brute_top(x, q, k):
    x = x.astype(np.float64)
    s = (x * x[q]).sum(axis=1)
    return [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:k], s


def test_search_against_brute_force(spark):
    x, labels = grouped(1200)
    rows = make(spark, [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels))])
    got = search(rows, F.col("id") % 20 == 0, leaf_rows=32).toPandas()
    hit = 0
    for q, found in got.groupby("query_id"):
        found = found.sort_values("rank")
        want, s = brute_top(x, q, 20)
        assert found["rank"].tolist() == list(range(1, 21))
        assert np.allclose(found["score"], s[found["vec_id"]], rtol=0, atol=1e-12)
        assert (np.diff(found["score"]) <= 0).all()
        hit += len(set(want) & set(found["vec_id"]))
    assert got["query_id"].nunique() == 60 and hit / (60 * 20) >= 0.9


def test_search_is_exact_when_all_leaves_are_visited(spark):
    x, labels = grouped(300, 2)
    x[150:] = x[:150]  # ties between equal vectors go to the smaller id
    rows = make(spark, [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels))])
    got = search(rows, F.col("id") % 20 == 0, k=7, recall=1.0, leaf_rows=32).toPandas()
    for q, found in got.groupby("query_id"):
        assert found.sort_values("rank")["vec_id"].tolist() == brute_top(x, q, 7)[0]


def test_search_leaves_out_what_is_no_vector(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [NAN, 1.0], 1),
        (5, [INF, 1.0], 1), (6, [1.0, None], 1), (20, [0.9, 0.1], None), (7, [1.0, 2.0, 3.0], 1),
        (None, [1.0, 1.0], 1), (40, None, 1),
    ]
    got = search(make(spark, rows), F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    assert search(make(spark, []), F.col("id") % 20 == 0).count() == 0
    assert search(make(spark, [(0, [1.0], 1)]), F.col("id") % 20 == 0).count() == 0


def test_search_in_slices_of_a_hot_leaf(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "BUCKET_ROWS", 16)
    monkeypatch.setattr(kmeans_tree, "QUERY_ROWS", 4)
    x = np.tile(np.array([[1.0, 2.0, 3.0, 4.0]], np.float32), (200, 1))
    extra = "vec_id long, embedding array<float>, leaf string, bucket string, score string"
    rows = make(spark, [(i, v.tolist(), "l", "b", "s") for i, v in enumerate(x)], extra)
    got = search(rows, F.col("id") % 20 == 0, k=5).toPandas()
    for q, found in got.groupby("query_id"):
        want = [i for i in range(200) if i != q][:5]
        assert found.sort_values("rank")["vec_id"].tolist() == want


def test_best_bin_first_order():
    x, _ = grouped(400, 3)
    tree = build_tree(x.astype(float), 20)
    assert set(tree.assign(x.astype(float))) == set(range(tree.leaves))
    for seen in tree.visits(x[:5].astype(float), tree.leaves):
        assert sorted(seen) == list(range(tree.leaves))
    cells = cells_of({0: 100, 1: 1, 2: 1}, 3, 10)
    assert cells.bucket.tolist() == [0, 1, 1] and cells.slices.tolist() == [5, 1]


def brute_links(x, labels, bound=0.93):
    u = unit(x.astype(np.float64))
    s = (u[:, None, :] * u[None, :, :]).sum(axis=2)
    ok = (s >= bound) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(ok, False)
    parent = np.arange(len(x))
    for _ in range(len(x)):
        low = np.where(ok, parent[None, :], len(x)).min(axis=1)
        new = np.minimum(parent, low)
        if (new == parent).all():
            break
        parent = new
    return ok.sum(axis=1), parent


def test_near_duplicates_against_brute_force(spark):
    x, labels = grouped(900, 5)
    rows = make(spark, [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels))])
    got = near_duplicates(rows).toPandas().set_index("vec_id").sort_index()
    links, parts = brute_links(x, labels)
    assert links.sum() > 500
    assert (got["n_links"].to_numpy() <= links).all()
    assert got["n_links"].sum() >= 0.97 * links.sum()
    assert (got["component_id"].to_numpy() == parts).mean() > 0.99
    assert (got["kept"].to_numpy() == (got.index == got["component_id"])).all()


def test_rare_links_over_many_leaves_beside_a_large_group(spark, monkeypatch):
    from tabulark.llm import flat_graph

    monkeypatch.setattr(flat_graph, "LEAF_ROWS", 128)
    monkeypatch.setattr(flat_graph, "OVERLAP", 1)
    draw = np.random.default_rng(6)
    x = unit(draw.normal(size=(1200, 16)))
    for i in range(0, 80, 2):  # pairs at a cosine of 0.94
        aside = draw.normal(size=16)
        aside -= (aside @ x[i]) * x[i]
        x[i + 1] = 0.94 * x[i] + np.sqrt(1 - 0.94**2) * aside / np.linalg.norm(aside)
    x[800:] = x[800]
    x = x.astype(np.float32)
    labels = np.ones(len(x), int)
    rows = make(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)])
    got = near_duplicates(rows).toPandas().set_index("vec_id").sort_index()["n_links"].to_numpy()
    links, _ = brute_links(x, labels)
    assert links[:80].sum() >= 76 and got[800:].sum() >= 0.97 * links[800:].sum()
    assert got[:800].sum() >= 0.95 * links[:800].sum()
    # the audit sees that small groups are lost, beside the large one and alone
    named = rows.withColumnsRenamed({"vec_id": "id", "embedding": "vec"}).cache()
    large = spark.createDataFrame([(800, i) for i in range(801, 1200)], "a long, b long")
    chain = spark.createDataFrame([(i, 800) for i in range(800, 1200)], "id long, component long")
    assert flat_graph.audit(named, large, chain, 0.93) < 0.1
    assert flat_graph.audit(named.where("id < 800"), large.limit(0), chain.limit(0), 0.93) == 0


def test_all_pairs_of_a_label(spark, monkeypatch):
    from tabulark.llm import flat_graph

    monkeypatch.setattr(flat_graph, "SHARD_ROWS", 100)
    x, labels = grouped(600, 9)
    rows = make(spark, [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels))])
    named = rows.withColumnsRenamed({"vec_id": "id", "embedding": "vec"})
    links, _ = brute_links(x, labels)
    assert 2 * flat_graph.all_links(named, 0.93).count() == links.sum()


def test_near_duplicates_of_odd_rows(spark):
    v = [1.0, 2.0]
    rows = [
        (5, v, 1), (3, v, 1), (9, v, 2), (4, v, None), (6, None, 1), (7, [0.0, 0.0], 1), (8, [NAN, 1.0], 1),
        (2, [1.0, None], 1), (10, [-1.0, -2.0], 1), (3, v, 1), (None, v, 1), (11, [1e-30, 2e-30], 1),
    ]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(make(spark, rows)).collect()}
    assert got[3] == (2, 3, True) and got[5] == (2, 3, False) and got[11] == (2, 3, False)
    for alone in (9, 4, 6, 7, 8, 2, 10):
        assert got[alone] == (0, alone, True)
    assert got[None] == (0, None, False)
    assert near_duplicates(make(spark, [])).count() == 0


def test_one_id_with_different_vectors_and_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1), (4, [1.0, 1.0], 1)]
    df = make(spark, rows)
    for name in ("id", "vec", "n", "component", "least"):
        df = df.withColumn(name, F.lit("x"))
    got = sorted(map(tuple, near_duplicates(df).collect()))
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_overlap_is_settled_on_drawn_links(spark, monkeypatch):
    """6,000 rows in many leaves: counts and components against brute force."""
    from tabulark.llm import flat_graph

    monkeypatch.setattr(flat_graph, "LEAF_ROWS", 256)
    draw = np.random.default_rng(12)
    centers = unit(draw.normal(size=(300, 24)))
    near = centers[draw.integers(0, 300, 2500)] + draw.normal(size=(2500, 24)) * 0.035
    x = np.concatenate((near, draw.normal(size=(3000, 24)), np.repeat(near[:10], 50, axis=0))).astype(np.float32)
    labels = np.zeros(len(x), int)
    rows = make(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = near_duplicates(rows).toPandas().set_index("vec_id").sort_index()
    links, parts = brute_links(x, labels)
    assert got["n_links"].sum() >= 0.97 * links.sum() and (got["n_links"].to_numpy() <= links).all()
    assert (got["component_id"].to_numpy() == parts).mean() > 0.99


def test_hot_shard_in_slices(spark, monkeypatch):
    from tabulark.llm import flat_graph

    monkeypatch.setattr(flat_graph, "SHARD_ROWS", 40)
    draw = np.random.default_rng(8)
    x = (np.ones((150, 8)) + draw.normal(size=(150, 8)) * 0.02).astype(np.float32)
    rows = make(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)]).withColumnsRenamed(
        {"vec_id": "id", "embedding": "vec"}
    )
    assert found_links(rows, 0.93, 1).count() == 150 * 149 // 2


def test_graph_reaches_every_point_in_range():
    draw = np.random.default_rng(4)
    x = unit(np.ones((300, 12)) + draw.normal(size=(300, 12)) * 0.05).astype(np.float32)
    near, medoid = build_graph(x)
    for _, points in range_search(x, near, medoid, x[:40], 0.9):
        assert len(points) == 300


@pytest.mark.parametrize("n", [1, 2, 5])
def test_tiny_graphs(n):
    x = unit(np.random.default_rng(n).normal(size=(n, 4)) + 3).astype(np.float32)
    near, medoid = build_graph(x)
    assert sum(len(p) for _, p in range_search(x, near, medoid, x, -1.0)) == n * n


def near_copies(draw, n, dim, cosine):
    """n random unit vectors and, behind them, a vector at that cosine of each."""
    x = unit(draw.normal(size=(n, dim)))
    aside = draw.normal(size=(n, dim))
    aside = unit(aside - (aside * x).sum(axis=1, keepdims=True) * x)
    return np.concatenate((x, cosine * x + np.sqrt(1 - cosine**2) * aside))


def test_three_leaves_are_enough_over_many(spark):
    """Vectors beside an upper split, and copies of another length, share one of few leaves."""
    from tabulark.llm import flat_graph

    x = near_copies(np.random.default_rng(21), 2000, 64, 0.98)
    tree = build_tree(x, 8)
    assert tree.leaves > 300
    x[2000:] *= 1000
    rows = make(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)], "id long, vec array<double>, label int")
    assert flat_graph.needed_overlap(rows, tree, len(x), 0.93, 0.97) == flat_graph.OVERLAP
    leaves = tree.nearest_leaves(unit(x), 3)
    assert (leaves[:2000, :, None] == leaves[2000:, None, :]).any(axis=(1, 2)).mean() > 0.98
    every = tree.nearest_leaves(unit(x[:50]), 2 * tree.leaves)
    assert (np.sort(every, axis=1) == np.arange(tree.leaves)).all()


def test_graph_holds_the_nearest_and_joins_close_groups():
    from tabulark.llm.flat_graph import member_links

    draw = np.random.default_rng(22)
    centers = unit(unit(draw.normal(size=(1, 32))) + draw.normal(size=(5, 32)) * 0.03)
    groups = np.repeat(centers, 150, axis=0) + draw.normal(size=(750, 32)) * 0.004
    exact = unit(np.concatenate((groups, draw.normal(size=(850, 32)))))
    x = exact.astype(np.float32)
    near, medoid = build_graph(x)
    s = exact @ exact.T
    np.fill_diagonal(s, -1)
    assert (near == s.argmax(axis=1)[:, None]).any(axis=1).mean() > 0.999
    assert not (near == np.arange(len(x))[:, None]).any()
    a, b = member_links(x, near, exact, 0.93)
    found = np.zeros(s.shape, bool)
    found[a, b] = True
    assert (a < b).all() and not (found & (s < 0.93)).any()
    assert found.sum() >= 0.99 * np.triu(s >= 0.93).sum()
    seen = sum(len(p) - 1 for _, p in range_search(x, near, medoid, x[:750], 0.93))
    assert seen >= 0.97 * (s[:750] >= 0.93).sum()


def test_robust_prune_against_the_rule():
    from tabulark.llm.flat_graph import robust_prune

    draw = np.random.default_rng(23)
    x = unit(draw.normal(size=(60, 3))).astype(np.float32)
    s = x @ x.T
    np.fill_diagonal(s, -1)
    found = np.argsort(-s, axis=1, kind="stable")[:, :-1]
    found[:, 40:] = -1
    far = 1 - np.take_along_axis(s, np.maximum(found, 0), 1)
    for degree in (2, 5, 40):
        got = robust_prune(x, found, far, degree, 1.2)
        for i, row in enumerate(found):
            kept: list[int] = []
            for j in row[row >= 0]:
                if len(kept) < degree and all(1.2 * (1 - x[k] @ x[j]) > 1 - s[i, j] for k in kept):
                    kept.append(j)
            assert row[got[i]].tolist() == kept


def test_true_links_keep_to_their_label(spark):
    from tabulark.llm import flat_graph

    x, labels = grouped(300, 24)
    rows = make(spark, [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels))])
    named = rows.withColumnsRenamed({"vec_id": "id", "embedding": "vec"})
    got = flat_graph.true_links(named, named.where("id < 60 AND label < 2").toArrow(), 0.93).toPandas()
    links, _ = brute_links(x, labels)
    asked = [i for i in range(60) if labels[i] < 2]
    assert got.groupby("q").size().reindex(asked, fill_value=0).tolist() == links[asked].tolist()
    assert (labels[got["a"]] == labels[got["b"]]).all() and set(got["q"]) <= set(asked)
