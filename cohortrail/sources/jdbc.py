"""Relational source and sink over JDBC, for click tables, logs and statistics kept in a database.

Addresses and credentials come from the caller; the driver must be on the class path of the session.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; with a partition column and its bounds the table is read by parallel range queries."""
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        out |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return {**out, **(extra or {})}


def read(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """Filters and column choice are pushed into the database by Spark."""
    return spark.read.format("jdbc").options(**read_options(url, table, **settings)).load()


def write_options(url: str, table: str, batch_size: int = 5_000, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **(extra or {})}


def append_deltas(deltas: DataFrame, url: str, table: str, batch_id: int, writers: int = 16, **settings) -> None:
    """Append one micro-batch of additive deltas, marked with `batch_id`; `writers` bounds the connections.

    Current values are a `GROUP BY key` view over the table, so no row is ever updated in place. A batch that runs
    again appends to a table from which `delete_batch(table, batch_id)` has removed its first try: run that first.
    """
    options = write_options(url, table, **settings)
    marked = deltas.selectExpr("*", f"CAST({int(batch_id)} AS bigint) AS batch_id")
    marked.repartition(writers).write.format("jdbc").options(**options).mode("append").save()


def delete_batch(table: str, batch_id: int) -> str:
    """The statement to run before a batch is appended, so that a re-run leaves its rows once."""
    return f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}"
