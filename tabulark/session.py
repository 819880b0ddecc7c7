"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def local_session(cores: str = "*", app: str = "tabulark") -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else (local
    sessions only) a fresh temporary one that this session then keeps using."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(named)
        system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return system.makeQualified(folder).toString().rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tabulark-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application, so that functions
    that run there find it wherever the driver was started."""
    context = spark.sparkContext
    name = f"tabulark-{context.applicationId}.zip"
    if any(f.endswith(name) for f in context._python_includes):
        return
    top = Path(__file__).resolve().parents[1]
    sources = sorted(top.glob("tabulark/**/*.py")) + sorted(top.glob("corpus_pipeline.py"))
    packed = Path(tempfile.mkdtemp(prefix="tabulark-")) / name
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sources:
            archive.write(source, source.relative_to(top))
    context.addPyFile(str(packed))


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tabulark-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def named_path(spark: SparkSession, name: str) -> str:
    """The path of that name among the intermediates of this application."""
    return f"{_application_folder(spark)}/{name}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediates of this application once its results are written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_table(df: DataFrame, name: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write an intermediate to the shared folder and read it back: computed once
    for all its uses, column-pruned, and safe against the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def session_cache(df: DataFrame):
    """Keep a table for several uses and release it afterwards."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
