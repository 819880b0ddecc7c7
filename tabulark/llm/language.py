"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text becomes the average of the embeddings of its hashed byte n-grams (lengths 2 to
4 of the lower-cased UTF-8 text, blanks included), and a linear softmax names the
language. Embeddings and weights are trained by stochastic gradient descent in numpy
on a bounded sample; scores are calibrated by a temperature on a held-back part of it.

A softmax shares out certainty among the languages it knows, so rejection asks another
question: how familiar the text's n-grams are, by their frequency in the training part of
the language that knows them best. The threshold is set on the held-back part, between
texts judged with their language and the same texts judged as if it had not been learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.llm.batches import broadcast_if_small, released, slices

GRAMS = (2, 3, 4)
BITS, DIM = 15, 16
SAMPLE_PER_LANG, SAMPLE_CHARS = 600, 4_096
# n-grams that count as familiar beforehand, so that a word or two are hardly rejected
PRIOR_GRAMS = 60
COLUMNS = 16
UNKNOWN = "und"
SLICE_BYTES = 1 << 19


def padded(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace") + b"    "


def gram_ids(buffer: np.ndarray, bits: int) -> list[np.ndarray]:
    """Hash bucket of the n-gram that starts at each byte, one array for each length."""
    b = buffer.astype(np.uint32)
    h, found = b, []
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint32(0x01000193) + b[n - 1 :]
        if n in GRAMS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n * 0x7F4A7C15 & 0xFFFFFFFF)
            found.append((mixed >> np.uint32(32 - bits)).astype(np.int32))
    return found


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray  # bucket x language: embedding times softmax weights
    familiar: np.ndarray  # bucket x language: log frequency less that of the language's texts
    bias: np.ndarray
    temperature: float
    edge: float  # familiarity at which a text is as likely of a language not learned
    threshold: float
    bits: int

    def means(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Average logits and familiarities, text by language, and n-grams of whole texts."""
        parts = [padded(t) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        buffer = np.frombuffer(b"".join(parts) + b"    ", np.uint8)
        totals = np.zeros((2, len(parts), len(self.langs)))
        grams = np.zeros(len(parts))
        for n, ids in zip(GRAMS, gram_ids(buffer, self.bits)):
            ends = starts + sizes - n + 1
            edges = np.column_stack((starts, ends)).ravel()
            for total, table in zip(totals, (self.logits, self.familiar)):
                for k in range(0, len(self.langs), COLUMNS):
                    some = table[:, k : k + COLUMNS][ids]
                    total[:, k : k + COLUMNS] += np.add.reduceat(some, edges, axis=0)[::2]
            grams += ends - starts
        totals /= grams[:, None]
        return totals[0], totals[1], grams

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Calibrated probabilities, text by language, over whole texts."""
        return self.probabilities(self.means(texts)[0])

    def confidence(self, familiar: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """From 0 to 1, one half at the edge: that a text is of a learned language."""
        return 1 / (1 + np.exp(np.clip(self.edge - known(familiar, grams), -50, 50)))


def known(familiar: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Familiarity in the language that knows the text best; short texts are drawn to 0."""
    return familiar.max(axis=1) * grams / (grams + PRIOR_GRAMS)


def text_ids(text: str, bits: int) -> np.ndarray:
    buffer = np.frombuffer(padded(text), np.uint8)
    return np.concatenate(gram_ids(buffer, bits))


def fit(
    texts: list[str], langs: list[str], seed: int = 11, epochs: int = 6, rate: float = 0.5,
    bits: int = BITS, dim: int = DIM, rejected: float = 0.0005,
) -> Model:
    """Train on texts and random windows of them, so that short texts are learned too."""
    names = sorted(set(langs))
    if not names:
        none = np.zeros((1, 0), np.float32)
        return Model([], none, none, np.zeros(0), 1.0, 0.0, 0.0, bits)
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(texts))
    held = order[: max(1, len(order) // 5)] if len(order) >= 10 else order
    train = order[len(order) // 5 :] if len(order) >= 10 else order
    target = np.array([names.index(x) for x in langs])
    emb = draw.uniform(-1 / dim, 1 / dim, (1 << bits, dim))
    weights, bias = np.zeros((dim, len(names))), np.zeros(len(names))
    steps, total = 0, epochs * len(train)

    def window(text: str) -> str:
        size = int(draw.choice([30, 80, 250, len(text) or 1]))
        at = int(draw.integers(0, max(1, len(text) - size + 1)))
        return text[at : at + size]

    for _ in range(epochs):
        for i in draw.permutation(train):
            now = rate * (1 - steps / total)
            steps += 1
            ids, counts = np.unique(text_ids(window(texts[i]), bits), return_counts=True)
            share = counts / counts.sum()
            mean = share @ emb[ids]
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            back = weights @ p
            weights -= now * np.outer(mean, p)
            bias -= now * 0.1 * p
            # the gradient is spread over the n-grams; their number restores its size
            emb[ids] -= now * len(ids) * 0.25 * np.outer(share, back)
    table = (emb @ weights).astype(np.float32)
    familiar = np.full((1 << bits, len(names)), 0.5)
    for i in train:
        ids, counts = np.unique(text_ids(texts[i], bits), return_counts=True)
        familiar[ids, target[i]] += counts
    familiar = np.log(familiar / familiar.sum(axis=0)).astype(np.float32)
    model = Model(names, table, familiar, bias, 1.0, 0.0, 0.5, bits)
    pieces = [texts[i] for i in held] + [window(texts[i]) for i in held]
    truth = np.concatenate((target[held], target[held]))
    rows = np.arange(len(pieces))
    logits, usual, grams = (
        np.concatenate(x) for x in
        zip(*[model.means(pieces[k : k + 64]) for k in range(0, len(pieces), 64)])
    )
    own = usual[rows, truth]
    middle = np.array([
        np.median(own[truth == k]) if (truth == k).any() else np.median(own)
        for k in range(len(names))
    ])
    model.familiar = (familiar - middle).astype(np.float32)
    usual -= middle
    logs = np.log(model.probabilities(logits) + 1e-12)

    def loss(t: float) -> float:
        z = logs / t
        z = z - z.max(axis=1, keepdims=True)
        return float(-(z[rows, truth] - np.log(np.exp(z).sum(axis=1))).mean())

    model.temperature = float(min(np.geomspace(0.25, 4, 25), key=loss))
    least = np.sort(known(usual, grams))[int(len(pieces) * rejected)]
    if len(names) > 1:
        usual[rows, truth] = -np.inf  # as if the language had not been learned
        # losing a text of a learned language is the worse error, so the edge lies near what
        # 99 % of the left-out texts of some length stay below
        strange = known(usual, grams)
        long = strange[grams >= min(8 * PRIOR_GRAMS, np.median(grams))]
        left_out = np.quantile(long, 0.99)
        model.edge = float(min(least, left_out + max(least - left_out, 0) / 4))
    else:
        model.edge = float(least) - 1.0
    return model


def train_language_model(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_lang: int = SAMPLE_PER_LANG, chars: int = SAMPLE_CHARS,
) -> Model:
    """Fit on about ``per_lang`` rows of each language, drawn by a hash of id and length, of
    each at most ``chars`` characters from a place drawn by the same hash. Rows of one draw
    (repeated rows) are one row of the sample, the one whose stretch is least. Rows without
    text or language are not used. Bounds what reaches the driver: about per_lang * chars
    characters for each language there is.
    """
    draw = F.xxhash64(F.lit("lang"), F.col(id_col), F.length(text_col))
    unit = F.pmod(draw, F.lit(1 << 30)) / float(1 << 30)
    room = F.greatest(F.length(text_col) - chars, F.lit(0)) + 1
    place = F.pmod(F.xxhash64(F.lit("at"), draw), room.cast("long")).cast("int") + 1
    known = labelled.where(
        F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)
    ).select(
        draw.alias("d"), unit.alias("unit"), F.col(lang_col).alias("lang"),
        F.substring(F.col(text_col), place, F.lit(chars)).alias("text"),
    )
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("d").alias("rows"))
    share = sizes.select("lang", (F.lit(float(per_lang)) / F.col("rows")).alias("share"))
    sample = (
        known.join(broadcast_if_small(share, 100_000), "lang").where("unit < share")
        .groupBy("lang", "d").agg(F.min("text").alias("text"))
        .toPandas().sort_values(["d", "text", "lang"])
    )
    return fit(list(sample["text"]), list(sample["lang"]))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def judge(m: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of each text."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    sure = np.zeros(len(texts))
    at = [i for i, t in enumerate(texts) if t and m.langs and has_letter(t)]
    if at:
        logits, familiar, grams = m.means([texts[i] for i in at])
        p = m.probabilities(logits)
        scores[at] = p.max(axis=1)
        sure[at] = m.confidence(familiar, grams)
        for i, k in zip(at, p.argmax(axis=1)):
            langs[i] = m.langs[k]
    named = np.zeros(len(texts), bool)
    named[at] = True
    return langs, scores, ~named | (sure < m.threshold)


def predict_language(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, lang_pred, score, rejected`` of every row, over whole texts, in one pass.

    A null text, one without a letter, and any text under a model that has learned no
    language give ``und`` with score 0 and are rejected; so is a text whose n-grams are
    less familiar than the calibrated edge, which keeps its ``lang_pred`` and score. Other
    columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @released
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            langs, scores, rejected = judge(shared.value, part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(langs), pa.array(scores), pa.array(rejected)],
                ["id", "lang", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(
        predict, f"id {id_type}, lang string, score double, rejected boolean"
    )
    return found.toDF(id_col, "lang_pred", "score", "rejected")


def accepted_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose language is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @released
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, SLICE_BYTES):
            _, _, rejected = judge(shared.value, part.column(text_col).to_pylist())
            yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id"):
    """The quarter of the ids that training never sees."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2
