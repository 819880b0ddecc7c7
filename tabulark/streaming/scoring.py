"""Scoring of arriving requests, and keeping bad records apart."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabulark.functions.requests import json_request_decode, json_response_encode, request_defaults


def score_requests(
    requests: DataFrame, model: PipelineModel, keep: list[str], body: str = "body"
) -> DataFrame:
    """JSON requests to JSON answers, batch or stream. A request that cannot be
    read has a null response and its reason in ``error``."""
    rows = request_defaults(json_request_decode(requests.select(*keep, body), body))
    scored = model.transform(rows.drop(body))
    probability = vector_to_array("probability")[1]
    return scored.select(
        *keep,
        F.when(F.col("error").isNull(),
               json_response_encode(F.col("prediction"), probability)).alias("response"),
        "error",
    )


def decode_frames(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """Typed fields of a JSON payload. A payload that is broken or lacks the right
    types only marks its own row as ``bad``."""
    typed = F.from_json(
        payload, f"{schema}, _corrupt STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    return (
        df.withColumn("_f", typed)
        .withColumn("bad", F.col("_f").isNull() | F.col("_f._corrupt").isNotNull())
        .select(*df.columns, "bad", "_f.*")
        .drop("_corrupt")
    )


def write_isolated(
    rows: DataFrame, bad: Column, good_path: str, bad_path: str, checkpoint: str
) -> StreamingQuery:
    """Run a stream to the end of its available data with bad rows set aside. Each
    micro-batch owns a folder, so a repeated batch replaces itself."""

    def split(batch: DataFrame, number: int) -> None:
        kept = batch.withColumn("_bad", bad).persist()
        for path, side in ((good_path, ~F.col("_bad")), (bad_path, F.col("_bad"))):
            kept.where(side).drop("_bad").write.mode("overwrite").parquet(f"{path}/batch={number}")
        kept.unpersist()

    return (
        rows.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def run_to_files(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Drain the available input of a stream into Parquet files."""
    query = (
        rows.writeStream.outputMode(mode).format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
