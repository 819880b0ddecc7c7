"""The pipeline against what each stage's operator says of its own input."""

import pytest

import check
import corpus_pipeline as P
from __spark_entry__ import oracle_sql, queries
from tabulark.llm import language, mixing, partenum, piece_dropout, suffix_levels

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark, documents):
    columns = documents.columns
    docs = documents.cache()
    kept = P.language_id(spark, docs, SF).cache()
    model = language.train_language_model(docs.where(~language.held_out()))
    bad = {r.doc_id for r in language.predict_language(docs, model).where("rejected").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad
    single = P.jaccard_join(spark, kept, SF).cache()
    groups = partenum.similar_sets(kept).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})
    cut = P.suffix_dedup(spark, single, SF).cache()
    assert cut.count() == single.count()
    again = suffix_levels.remove_repeats(single, with_text=True).collect()
    assert {r.doc_id: r.kept_text for r in again} == {r.doc_id: r.text for r in cut.collect()}
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = P.source_mix(spark, cut, SF).cache()
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(cut).where("taken > 0").collect()}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words.keys() == taken.keys()
    for stage in (kept, single, cut, mixed):
        assert stage.columns == columns
    done = P.piece_encoding(spark, mixed, SF)
    assert done.where("NOT lossless").count() == 0 and done.count() == mixed.count()
    back = {(r.doc_id, r.text) for r in piece_dropout.decode_pieces(done).collect()}
    assert back == {(r.doc_id, r.text) for r in mixed.collect()}
    whole = P.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, done.collect()))


def test_odd_documents(spark, docs_of):
    text = "the house and the garden of that man were with this one"
    docs = docs_of([(1, None), (2, ""), (3, text, "en", "a"), (3, text, "en", "a"), (None, text, "en", None),
                    (4, "Der Garten von dem Mann war hier", "de", None), (5, "?!")])
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == P.COLUMNS
    assert {r.doc_id for r in docs.collect()} <= {3, 4, None}
    for _, stage in P.STAGES:
        assert stage(spark, docs_of([(1, "x")]).limit(0), SF).count() == 0


def test_repeated_rows_and_copies_without_id_stay_once_and_whole(spark, docs_of):
    def prose(k):
        return " ".join(f"w{k}x{i}" for i in range(60))

    rows = [(1, prose(1), "en", "a")] * 2 + [(None, prose(2), "en", "a")] * 3
    rows += [(None, prose(3) + end, "en", "b") for end in (" one", " two", " three")]
    rows += [(None, prose(4), "en", "b"), (9, prose(4), "en", "b"), (5, prose(5), "en", "a"), (5, prose(6), "en", "a")]
    single = P.jaccard_join(spark, docs_of(rows), SF).cache()
    cut = P.suffix_dedup(spark, single, SF).collect()
    texts = sorted(r.text for r in cut)
    assert [t[:5] for t in texts] == ["w1x0 ", "w2x0 ", "w3x0 ", "w4x0 ", "w5x0 ", "w6x0 "]
    assert all(t in {r[1] for r in rows} for t in texts)
    assert [r.doc_id for r in sorted(cut, key=lambda r: r.text)][3] == 9


def test_stage_names():
    assert [n for n, _ in P.STAGES] == [
        "language_id", "jaccard_join", "suffix_dedup", "source_mix", "piece_encoding",
    ]


@pytest.mark.parametrize("number", range(1, 11))
def test_query(spark, documents, number):
    name = next(n for n in queries() if n.startswith(f"op{number}_"))
    got = queries()[name](spark, SF)
    frame = got.toPandas()
    assert len(frame) > 0
    if name in oracle_sql():
        assert check.compare(frame, check.connect(SF).execute(oracle_sql()[name]).df()) is None
