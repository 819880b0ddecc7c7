"""Corpus pipeline over documents, each stage written and read again by the next:

1. language ID: rejected documents go
2. n-gram Jaccard join: of each group of near copies one row stays, that of the least id
3. suffix-array dedup: passages that repeat are cut out of the texts
4. mixing sources to target weights: documents come as often as the mix takes them
5. SentencePiece encoding: the pieces of every text

Stages 1 to 4 return the columns of documents. Stage 2 tells rows apart by id (rows without
one come last), a hash of the row and a number, so repeated rows and rows without an id are
in the groups like any other. A text that loses all its bytes in stage 3 stays as an empty
one, which stage 4 does not take, as it takes no text without a word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.llm import language, mixing, partenum, piece_dropout, suffix_levels
from tabulark.session import stage_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# models, draws and hashes of texts have no counterpart in SQL
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train_language_model(docs.where(~language.held_out()))
    return language.accepted_rows(docs.select(*COLUMNS), model)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = F.col("doc_id").isNotNull()
    numbered = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("number"))
    place = F.struct(
        (~known).alias("unnamed"), F.col("doc_id").alias("id"),
        F.xxhash64(*COLUMNS).alias("hash"), F.col("number"),
    )
    rows = stage_table(numbered.select(*COLUMNS, place.alias("place")), "numbered")
    groups = partenum.similar_sets(rows, "place")
    kept = groups.where("place <=> component_id").select("place.number")
    return rows.join(kept, F.col("place.number") == F.col("number"), "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_levels.remove_repeats(docs, keep=["lang", "source"], with_text=True)
    return cut.withColumns(
        {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    ).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs.select(*COLUMNS))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_dropout.encode_pieces(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("source_mix", source_mix),
    ("piece_encoding", piece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
