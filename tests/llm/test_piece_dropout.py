import numpy as np
import pytest

from tabulark.llm import piece_dropout as D

TEXTS = [
    "", " ", "\n", "  two  blanks ", "hello world\n\nline", "日本語 テキスト 𝔘", "tab\tand ▁ sign", "x" * 400,
    "ab " * 200, "é é  ", "<s> <0x0A> </s>", "\x00 \x1f",
]


@pytest.fixture(scope="module")
def model():
    return D.Pieces()


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(D.MODEL))


def lists(model, texts, rate, seed=1, streams=8):
    ids, at = D.encode_texts(model, texts, list(range(len(texts))), rate, seed, streams)
    return [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


def test_without_dropout_the_pieces_are_the_library_s(model, library, documents):
    texts = [r.text for r in documents.collect()] + [t for t in TEXTS if "▁" not in t and "<" not in t]
    assert lists(model, texts, 0.0) == [library.encode(t) for t in texts]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.6, 1.0])
def test_lossless_at_any_rate(model, rate, documents):
    texts = TEXTS + [r.text for r in documents.limit(40).collect()]
    assert [D.decode_ids(model, x) for x in lists(model, texts, rate)] == texts


@pytest.mark.parametrize("rate", [0.0, 0.3])
def test_in_step_equals_the_heap(model, rate, documents):
    parts = sorted({p for r in documents.limit(30).collect() for p in D.PARTS.findall(" " + r.text)})
    keys = np.arange(len(parts), dtype=np.uint64) * np.uint64(0x12345)
    ids, at = D.segment(model, parts, keys, rate)
    for i, part in enumerate(parts):
        assert D.agenda(model, part, int(keys[i]), rate) == ids[at[i] : at[i + 1]].tolist()


def test_dropout_varies_by_place_document_and_seed_and_repeats(model):
    text = "information " * 60
    one = lists(model, [text, text], 0.3)
    assert one == lists(model, [text, text], 0.3)
    assert one[0] != one[1] and one != lists(model, [text, text], 0.3, seed=2)
    part = len(lists(model, ["information"], 0.0)[0])
    assert len(one[0]) > 60 * part


def test_rows(spark):
    rows = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (None, "a b", 5), (3, "▁x", 5), (3, "▁x", 5)],
        "doc_id long, text string, ids int",
    )
    out = D.encode_pieces(rows)
    assert out.columns == ["doc_id", "ids", "n_pieces", "lossless"]
    got = out.collect()
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in got) and len(got) == 5
    back = {(r.doc_id, r.text) for r in D.decode_pieces(out).collect()}
    assert back == {(1, ""), (2, ""), (None, "a b"), (3, "▁x")}
    assert D.encode_pieces(rows.limit(0)).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert D.decode_pieces(nulls).collect()[0].text is None


def test_each_occurrence_draws_for_itself(model, spark):
    rows = spark.createDataFrame([(k, "information " * 200) for k in range(5)], "doc_id long, text string")
    found = set()
    for r in D.encode_pieces(rows, rate=0.3).collect():
        text = D.decode_ids(model, r.ids)
        assert text == "information " * 200
        word, words = [], []
        for i in r.ids:
            if model.bytes[i].startswith(b" ") and word:
                words.append(tuple(word))
                word = []
            word.append(i)
        found |= set(words)
    assert len(found) > 40


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_shared_work_equals_each_occurrence_alone(model, documents, rate):
    texts = [r.text for r in documents.limit(12).collect()] + ["ab " * 50, "x" * 60 + " y", "internationalisation " * 9]
    ids, at = D.encode_texts(model, texts, list(range(len(texts))), rate, 7)
    for k, text in enumerate(texts):
        parts = D.PARTS.findall(" " + text)
        hashes = np.array([D.part_key(x) for x in parts], np.uint64)
        keys = D.place_keys(hashes, np.full(len(parts), k), np.arange(len(parts)), 7)
        want = [i for x, key in zip(parts, keys.tolist()) for i in D.agenda(model, x, key, rate)]
        assert ids[at[k] : at[k + 1]].tolist() == want
