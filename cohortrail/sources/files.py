"""File sources: raw messages as parquet or JSON-lines folders, and typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RAW_SCHEMA = "kind string, value string"
# With what the message queue adds.
DELIVERED_SCHEMA = f"{RAW_SCHEMA}, arrival timestamp_ntz, position bigint"


def stream_parquet(
    spark: SparkSession, folder: str, schema: StructType | str = RAW_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a folder and its sub-folders as a stream, oldest first."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def stream_text(spark: SparkSession, folder: str, kind: str, files_per_trigger: int | None = None) -> DataFrame:
    """One JSON message per line, all of one topic."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder).selectExpr(f"'{kind}' AS kind", "value")


def read_text(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(folder).selectExpr(f"'{kind}' AS kind", "value")


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet table with a declared schema: no inference, columns pruned and filters pushed to the scan."""
    return spark.read.schema(schema).parquet(path)
