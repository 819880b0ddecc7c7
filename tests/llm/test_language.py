import zlib
from pathlib import Path

import numpy as np
import pytest

from tabulark.llm.language import (
    Model,
    accepted_rows,
    fit,
    gram_ids,
    held_out,
    padded,
    predict_language,
    train_language_model,
)


def test_held_out_accuracy_and_training_rows(documents):
    model = train_language_model(documents.where(~held_out()))
    got = {r.doc_id: r for r in predict_language(documents, model).collect()}
    rows = documents.withColumn("held", held_out()).collect()
    assert len(got) == len(rows)
    for r in rows:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert got[r.doc_id].lang_pred in [*model.langs, "und"] and 0 <= got[r.doc_id].score <= 1
    held = [r for r in rows if r.held and len(r.text) > 20]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.97
    assert model.langs == sorted(model.langs) and 0 <= model.threshold <= 0.5


def test_training_repeats(documents):
    one, two = (train_language_model(documents) for _ in range(2))
    assert (one.logits == two.logits).all() and one.threshold == two.threshold


def test_rejection(docs_of):
    english = ["the house and the garden of that man were with this one"] * 30
    german = ["das Haus und der Garten von dem Mann waren mit diesem hier"] * 30
    model = fit(english + german, ["en"] * 30 + ["de"] * 30)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the house of that man"), (5, "der Garten von dem Mann"),
            (None, "the"), (7, "und " * 100_000), (4, "the house of that man")]
    table = docs_of(rows)
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in predict_language(table, model).collect()]
    assert got[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert [x[1] for x in got[3:5]] == ["en", "de"] and got[6][1] == "de" and got[3] == got[7]
    kept = accepted_rows(table, model)
    assert kept.columns == table.columns and {1, 2, 3}.isdisjoint({r.doc_id for r in kept.collect()})
    model.threshold = 1.1
    assert accepted_rows(table, model).count() == 0
    assert [r.lang_pred for r in predict_language(table, model).collect()][3] == "en"


def test_nothing_to_learn(docs_of):
    table = docs_of([(1, "some text", None), (2, None, "en")])
    model = train_language_model(table)
    assert model.langs == [] and isinstance(model, Model)
    assert [r.lang_pred for r in predict_language(table, model).collect()] == ["und", "und"]
    assert train_language_model(table.limit(0)).langs == []
    one = train_language_model(docs_of([(1, "some text", "en")]))
    assert [r.lang_pred for r in predict_language(table, one).collect()] == ["en", "und"]


def test_a_text_scores_alike_in_any_batch():
    model = fit(["abc def ghi"] * 12 + ["xyz uvw rst"] * 12, ["a"] * 12 + ["b"] * 12)
    texts = ["abc", "rst xyz", "a" * 1000, "ghi é"]
    alone = np.vstack([model.scores([t]) for t in texts])
    assert np.allclose(alone, model.scores(texts), atol=1e-5)


def test_texts_of_a_language_that_was_not_learned_go(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    if not Path(path).exists():
        pytest.skip("shared tables not present")
    docs = spark.read.parquet(path).where("length(text) > 100")
    langs = sorted(r.lang for r in docs.select("lang").distinct().collect() if r.lang)
    kept_of = {}
    for lang in langs:
        model = train_language_model(docs.where(~held_out()).where(f"lang <> '{lang}'"))
        judged = predict_language(docs.where(held_out()), model)
        rows = judged.join(docs.select("doc_id", "lang"), "doc_id").collect()
        out = [r.rejected for r in rows if r.lang == lang]
        kept_of[lang] = (np.mean(out), np.mean([r.rejected for r in rows if r.lang != lang]))
    assert all(gone >= 0.9 and lost <= 0.02 for gone, lost in kept_of.values()), kept_of


def test_scores_and_familiarity_against_loops():
    texts = ["abc def ghi", "xyz uvw rst", "abd dee gh"] * 8
    model = fit(texts, ["a", "b", "a"] * 8)
    for text in ("abc xyz", "ghi é"):
        raw, sums, count = padded(text), np.zeros((2, 2)), 0
        for n in (2, 3, 4):
            ids = gram_ids(np.frombuffer(raw, np.uint8), model.bits)[n - 2]
            for i in ids[: len(raw) - n + 1]:
                sums += (model.logits[i], model.familiar[i])
                count += 1
        z = np.exp((sums[0] / count + model.bias) / model.temperature)
        assert np.allclose(model.scores([text])[0], z / z.sum(), atol=1e-5)
        assert np.allclose(model.means([text])[1][0], sums[1] / count, atol=1e-4)


def test_many_languages_and_repeated_rows(docs_of):
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{k}" for k in range(600)]
    rows = [(k, f"{w} {w} {w}", f"l{k:03}") for k, w in enumerate(words)]
    model = train_language_model(docs_of(rows + [rows[0]] * 50))
    assert len(model.langs) == 600
    got = predict_language(docs_of([(1, words[5] + " " + words[5], None), (2, None, None)]).limit(2), model)
    assert [r.lang_pred for r in got.orderBy("doc_id").collect()][1] == "und"
    empty = predict_language(docs_of([(1, "a", "x")]).limit(0), model)
    assert empty.count() == 0
