"""A keyed table that a stream keeps up to date: the newest row of each key.

Rows live in buckets of the key's hash. A micro-batch rewrites only the buckets it
touches, below a folder of its own number, and then writes a manifest that names the
folder of every bucket. The base of batch n is the newest manifest below n, so a batch
that is run again writes the same files again and changes nothing, and readers see a
batch as a whole or not at all. What neither of the two newest manifests names is removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BUCKETS = 64


@dataclass
class LatestTable:
    """``keys`` name a row, the greatest ``order`` wins; ``schema`` are all its columns."""

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    schema: str
    buckets: int = BUCKETS

    def _folder(self, spark: SparkSession, name: str):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches whose manifest is complete."""
        path, system = self._folder(spark, "manifest")
        if not system.exists(path):
            return []
        names = [s.getPath().getName() for s in system.listStatus(path)]
        return sorted(
            int(n) for n in names if n.isdigit() and system.exists(self._folder(spark, f"manifest/{n}/_SUCCESS")[0])
        )

    def _manifest(self, spark: SparkSession, version: int) -> dict[int, int]:
        text = spark.read.text(f"{self.path}/manifest/{version}").first()[0]
        return {int(b): v for b, v in json.loads(text).items()}

    def _rows(self, spark: SparkSession, places: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/{v}/bucket={b}" for b, v in sorted(places.items())]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def _newest(self, rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in self.keys]
        best = F.max_by(F.struct(*others), F.struct(*self.order)).alias("_row")
        return rows.groupBy(*self.keys).agg(best).select(*self.keys, "_row.*")

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the newest complete batch."""
        versions = self._versions(spark)
        return self._rows(spark, self._manifest(spark, versions[-1]) if versions else {})

    def upsert(self, batch: DataFrame, number: int) -> None:
        """Merge micro-batch ``number``; doing it again changes nothing."""
        spark = batch.sparkSession
        versions = [v for v in self._versions(spark) if v < number]
        base = self._manifest(spark, versions[-1]) if versions else {}
        columns = spark.createDataFrame([], self.schema).columns
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")
        new = self._newest(batch.select(*columns)).persist()
        try:
            touched = {r[0] for r in new.select(bucket).distinct().collect()}  # at most all buckets
            old = self._rows(spark, {b: v for b, v in base.items() if b in touched})
            merged = self._newest(old.unionByName(new.select(*columns)))
            merged.select("*", bucket).write.mode("overwrite").partitionBy("bucket").parquet(
                f"{self.path}/data/{number}"
            )
        finally:
            new.unpersist()
        places = base | dict.fromkeys(touched, number)
        spark.createDataFrame([(json.dumps(places),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{self.path}/manifest/{number}")
        self._forget(spark, base, places, versions[:-1])

    def _forget(self, spark: SparkSession, base: dict, places: dict, older: list[int]) -> None:
        for version in older:
            for b, v in self._manifest(spark, version).items():
                if v not in (base.get(b), places.get(b)):
                    path, system = self._folder(spark, f"data/{v}/bucket={b}")
                    system.delete(path, True)
            path, system = self._folder(spark, f"manifest/{version}")
            system.delete(path, True)

    def keep(self, changes: DataFrame, checkpoint: str, mode: str = "append") -> StreamingQuery:
        """Run a stream of changes to the end of its available data into this table."""
        return (
            changes.writeStream.outputMode(mode).foreachBatch(self.upsert)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
