"""Run a bounded table through a stream in time order, in a few separate runs of the same query."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from cohortrail.session import shared_dir
from cohortrail.sources import files


def replay(raw: DataFrame, runs: int, make: Callable[[str], object], redelivery: str | None = None) -> object:
    """`raw` has `ts, kind, value`, with `redelivery` also `arrival, position`. Each run finds one more stretch of time in the source folder and continues from
    the checkpoint of the run before. `make` builds the stream for a root folder; it is returned."""
    spark = raw.sparkSession
    root = f"{shared_dir(spark)}/replay-{uuid.uuid4().hex}"
    stream = make(f"{root}/tables")
    low, high = raw.selectExpr("min(ts)", "max(ts)").first()
    for i in range(runs):
        start, end = (low + (high - low) * j / runs for j in (i, i + 1))
        upper = "true" if i == runs - 1 else f"ts < TIMESTAMP_NTZ '{end}'"
        part = raw.where(f"ts >= TIMESTAMP_NTZ '{start}' AND {upper}")
        messages = part.select("kind", "value", *(["arrival", "position"] if redelivery else []))
        # Dealt evenly, however few or uneven the pieces of the source are: a batch is parsed in the pieces it finds here.
        messages.repartition("value").write.parquet(f"{root}/inbox/{i}")
        source = files.stream_parquet(spark, f"{root}/inbox", files.DELIVERED_SCHEMA if redelivery else files.RAW_SCHEMA)
        stream.start(source, f"{root}/checkpoint", available_now=True, redelivery=redelivery).awaitTermination()
    return stream
