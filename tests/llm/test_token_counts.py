import pytest

from tabulark.llm.token_counts import Counter, count_tokens

ODD = [
    "", " ", "word", "a b c", "é" * 300, "x" * 5000, "日本語 テキスト " * 400, "é à " * 500,
    "<|endoftext|> and <|startoftext|>" * 60, "it's  a\n\ntest\t1234 !!! " * 200, "é " * 300,
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda x: len(t.encode(x or "", add_special_tokens=False).ids)


def test_whole_texts(spark, documents, library):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(documents).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        n = library(r.text)
        assert got[r.doc_id] == (len(r.text.encode()), n, n > 2048)


@pytest.mark.parametrize("chunk, overlap", [(64, 8), (50, 2), (300, 40), (1000, 1)])
def test_spliced_chunks_equal_the_whole(library, chunk, overlap):
    c = Counter("word_bpe_49k.json", chunk, overlap)
    for text in ODD:
        if len(text) > chunk:
            assert c.spliced(text) == library(text)
    assert c.widened > 0  # texts without white space force wider overlaps


def test_nulls_repeats_and_clashing_columns(spark):
    rows = spark.createDataFrame(
        [(1, None, "x"), (None, "two words", "x"), (3, "", "x"), (3, "", "x")],
        "doc_id long, text string, n_tokens string",
    )
    got = sorted(map(tuple, count_tokens(rows).collect()), key=str)
    assert got == sorted([(1, 0, 0, False), (None, 9, 2, False), (3, 0, 0, False), (3, 0, 0, False)], key=str)
    empty = count_tokens(rows.limit(0))
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and empty.count() == 0
