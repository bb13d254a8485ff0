"""Message-queue source: one stream of `kind, value, arrival, position` per topic.

The connector package must be on the class path of the session; nothing here needs it until a stream is loaded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortrail.schemas import LAUNCH, PAY, REG

APP_TOPICS = (LAUNCH, REG, PAY)
WEB_TOPIC = "webLaunch"

# Columns every raw source delivers. The position orders messages that carry no id of their own: 2^40 offsets
# per queue partition.
RAW_COLUMNS = [
    "topic AS kind",
    "CAST(value AS string) AS value",
    "CAST(timestamp AS timestamp_ntz) AS arrival",
    "CAST(partition AS bigint) * 1099511627776 + offset AS position",
]


def options(
    servers: str,
    topics: Sequence[str],
    starting_offsets: str = "latest",
    receive_buffer_bytes: int = 65536,
    max_offsets_per_trigger: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. Offsets live in the checkpoint of the query, so nothing is committed to the queue and the
    consumer group is Spark's own."""
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "kafka.receive.buffer.bytes": str(receive_buffer_bytes),
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**out, **(extra or {})}


def read_stream(spark: SparkSession, servers: str, topics: Sequence[str] = APP_TOPICS, **settings) -> DataFrame:
    """The topics as one stream: within a micro-batch launches are applied before registrations and payments."""
    reader = spark.readStream.format("kafka").options(**options(servers, topics, **settings))
    return reader.load().selectExpr(*RAW_COLUMNS)


def read_batch(spark: SparkSession, servers: str, topics: Sequence[str] = APP_TOPICS, **settings) -> DataFrame:
    """The same topics as a bounded table, for replay."""
    settings.setdefault("starting_offsets", "earliest")
    reader = spark.read.format("kafka").options(**options(servers, topics, **settings))
    return reader.load().selectExpr(*RAW_COLUMNS)
