"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of more than ``chunk`` characters is encoded as chunks that overlap. Two
neighbouring chunks are spliced at a boundary that is proven stable: a letter or
digit right after a blank, tab or line break. The tokenizer splits words there
whatever stands on either side (no rule of its normaliser, of its word pattern or of
its special strings reaches across white space), so the tokens before the boundary
depend on the left chunk only and those after it on the right one. Both encodings
must also show a token that starts exactly there. Without such a boundary the overlap
is doubled, up to the whole of both chunks, which then become one.

Shorter texts are counted word by word: the same facts let a bounded table hold the ids
of the words that come again (see ``word_table``), so each distinct word is encoded once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.llm.batches import slices
from tabulark.llm.word_table import word_table

STABLE = re.compile(r"(?<=[ \t\r\n])[^\W_]")
CHUNK, OVERLAP, LIMIT = 16_384, 256, 2_048


class Counter:
    """Counts tokens with one tokenizer file; lives in a Python worker."""

    def __init__(self, name: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.table = word_table(name)
        self.tokenizer = self.table.tokenizer
        self.chunk, self.overlap = chunk, overlap
        self.widened = 0

    def counts(self, texts: list[bytes | None]) -> list[int]:
        """Tokens of each UTF-8 text."""
        huge = {
            i: self.spliced(whole) for i, text in enumerate(texts)
            if text and len(text) > self.chunk and len(whole := text.decode()) > self.chunk
        }
        rest = self.table.ids([None if i in huge else text for i, text in enumerate(texts)])
        return [huge.get(i, len(ids) // 4) for i, ids in enumerate(rest)]

    def _encode(self, text: str, start: int, end: int):
        return self.tokenizer.encode(text[start:end], add_special_tokens=False)

    def _splice(self, text, left, left_start, left_end, right, right_start, least):
        """(tokens of left before, tokens of right before) a common stable boundary."""
        for m in STABLE.finditer(text, max(right_start, least) + 1, left_end):
            p = m.start()
            a = left.char_to_token(p - left_start)
            b = right.char_to_token(p - right_start)
            if a is None or b is None:
                continue
            if left.token_to_chars(a)[0] == p - left_start and (
                right.token_to_chars(b)[0] == p - right_start
            ):
                return a, b, p
        return None

    def spliced(self, text: str) -> int:
        n, step = len(text), self.chunk
        start, end = 0, min(len(text), step + self.overlap)
        left = self._encode(text, start, end)
        taken, total, cut = 0, 0, 0
        while end < n:
            right_start = end - self.overlap
            right_end = min(n, right_start + step + self.overlap)
            right = self._encode(text, right_start, right_end)
            overlap, left_end = self.overlap, end
            hit = self._splice(text, left, start, left_end, right, right_start, cut)
            while hit is None and left_end < right_end:
                overlap *= 2
                self.widened += 1
                left_end = min(right_end, right_start + overlap)
                left = self._encode(text, start, left_end)
                hit = self._splice(text, left, start, left_end, right, right_start, cut)
            if hit is None:  # left now covers right as well
                end = left_end
                continue
            a, b, cut = hit
            total += a - taken
            left, start, end, taken = right, right_start, right_end, b
        return total + len(left) - taken


_counters: dict[tuple, Counter] = {}


def counter(name: str, chunk: int, overlap: int) -> Counter:
    key = (name, chunk, overlap)
    if key not in _counters:
        _counters[key] = Counter(*key)
    return _counters[key]


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row, in one pass without a shuffle.

    A null text counts as empty: no bytes, no tokens. Repeated rows and null ids stay
    as they are; other columns are not read. ``tokenizer`` names a file of
    public_tokenizers whose words end at white space.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), size.alias("n"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer, chunk, overlap)
        for part in slices(batches, "text"):
            tokens = c.counts(part.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("n"), pa.array(tokens, pa.int64())],
                ["id", "n", "tokens"],
            )

    counted = rows.mapInArrow(count, f"id {id_type}, n long, tokens long")
    return counted.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_bytes"),
        F.col("tokens").alias("n_tokens"),
        (F.col("tokens") > limit).alias("over_limit"),
    )
