"""CSV in and out, staged intermediates, saved models, frame streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tabulark import constants as K

PASSENGER_SCHEMA = (
    "PassengerId INT, Pclass INT, Name STRING, Sex STRING, Age DOUBLE, SibSp INT, Parch INT, "
    "Ticket STRING, Fare DOUBLE, Cabin STRING, Embarked STRING"
)
TRAINING_SCHEMA = PASSENGER_SCHEMA.replace("PassengerId INT,", "PassengerId INT, Survived INT,")


def pixel_schema(side: int) -> T.StructType:
    """Label and numbered pixel columns of a square image table."""
    schema = T.StructType().add("label", "int")
    for i in range(1, side * side + 1):
        schema = schema.add(f"pixel{i}", "int")
    return schema


def _path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(hadoop)


def csv_scan(
    spark: SparkSession, path: str, schema: str | T.StructType, quoted_lines: bool = True
) -> DataFrame:
    """Headered CSV with doubled quotes, typed by the given schema.

    Quoted line breaks belong to their value (without any in the file, turn
    ``quoted_lines`` off: a large file is then read in pieces). The usual tokens for a
    missing value are null; anything else that does not fit its type is an error.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.schema(texts).option("header", True).option("escape", '"')
    try:
        rows = reader.option("enforceSchema", False).option("multiLine", quoted_lines).csv(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise FileNotFoundError(f"no table at {path}") from problem
        raise

    def typed(field: T.StructField):
        text = F.when(~F.col(field.name).isin(K.MISSING_TOKENS), F.col(field.name))
        value = text.try_cast(field.dataType)
        wrong = F.raise_error(F.concat(F.lit(f"{field.name} cannot be "), text))
        return F.when(text.isNotNull() & value.isNull(), wrong.cast(field.dataType)).otherwise(value)

    return rows.select(*[typed(f).alias(f.name) for f in schema])


def csv_sink(df: DataFrame, path: str, id_column: str, prediction: str) -> None:
    """Id and whole-number prediction, with a header."""
    out = df.select(id_column, F.col(prediction).cast("int").alias(prediction))
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def stage_cache(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], use_cache: bool = True
) -> DataFrame:
    """An expensive intermediate written once and read back afterwards."""
    if not (use_cache and _path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not _path_exists(spark, path):
        raise FileNotFoundError(f"no saved model at {path}; train and save one first")
    return PipelineModel.load(path)


def frame_stream_source(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Stream of frame records from a folder of Parquet files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
