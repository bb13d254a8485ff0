"""What a batch reads and writes: whole, once, and in even pieces."""

import json
import os

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cohortrail.operators import timeline
from cohortrail.plans.replay import replay
from cohortrail.streaming.batched import latest_per_key
from cohortrail.streaming.bucketed import BucketedTable, ClickIndex
from cohortrail.streaming.corrected import CorrectedStream
from cohortrail.streaming.streams import AppStream
from tests.build import at, click, clicks_frame, event, events_frame
from tests.compare import spark_rows


def parts_in(folder):
    return [f for _, _, files in os.walk(folder) for f in files if f.startswith("part-")]


def message(device, when, **more):
    text = {"appid": "49", "os": "1", "oaid": device, "ts": f"{at(when)}.000000"} | more
    return at(when), "launch", json.dumps(text), at(when), 0


def messages(spark, rows):
    rows = [(*row[:4], i) for i, row in enumerate(rows)]
    schema = "ts timestamp_ntz, kind string, value string, arrival timestamp_ntz, position bigint"
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_a_redelivering_stream_runs_no_batch_without_messages(spark):
    rows = [message("a", "1 10:00"), message("a", "1 10:00"), message("b", "2 10:00"), message("a", "8 10:00")]
    before = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    stream = replay(
        messages(spark, rows), 2, lambda root: AppStream(spark, root, lambda: clicks_frame(spark), buckets=2), redelivery="1 day"
    )
    assert stream.next_batch() == 2
    assert stream.current(stream.daily).selectExpr("sum(launch_count)").first()[0] == 3
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == before


def test_messages_of_one_piece_are_dealt_evenly_and_texts_kept_for_rejects_alone(spark):
    rows = [message(f"d{i}", "1 10:00") for i in range(200)] + [message("x", "1 11:00", os="9")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stream = replay(
            messages(spark, rows).drop("arrival", "position").selectExpr("ts", "kind", "replace(value, '}', ', \"event_id\":\"1\"}') AS value"),
            1, lambda root: AppStream(spark, root, lambda: clicks_frame(spark), buckets=2),
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    base = os.path.dirname(stream.root)
    assert len(parts_in(f"{base}/inbox/0")) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = spark.read.parquet(f"{stream.root}/scratch/0/parsed").groupBy("reason").agg({"raw": "count", "*": "count"})
    assert {tuple(r) for r in kept.collect()} == {(None, 0, 200), ("platform", 1, 1)}
    assert [r.reason for r in stream.current(stream.rejects).collect()] == ["platform"]


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    schema = StructType([StructField("key", IntegerType()), StructField("text", StringType())])
    table = BucketedTable(spark, str(tmp_path), schema, latest_per_key(["key"], schema), ["key"], 1, 1)
    rows = spark.range(20_000, numPartitions=8).selectExpr("CAST(id AS int) AS key", "sha2(CAST(id AS string), 256) AS text")
    # The fold in several tasks, as in a large table, whose output can then be cut between them.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.write(rows, 0)
        table.compact(0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts_in(tmp_path / "base/before=1/bucket=0")) > 1
    assert table.read(1).count() == 20_000


def test_state_from_written_facts_is_that_of_the_step(spark):
    events = [
        event("pay", "d", "1 07:00", amount="2.00"), event("launch", "d", "1 08:00", external_ip="x"), event("reg", "d", "1 09:00"),
        event("pay", "d", "2 09:00", amount="1.00"), event("reg", "none", "1 09:00"), event("launch", "e", "3 08:00"),
    ]
    first = timeline.step(events_frame(spark, events), clicks_frame(spark, [click("P", "1 07:30", external_ip="x")]))
    assert spark_rows(timeline.state_after(first.facts, first.devices)) == spark_rows(first.state)
    later = [event("pay", "d", "1 12:00", amount="4.00"), event("launch", "e", "2 08:00"), event("reg", "e", "3 09:00")]
    second = timeline.step(events_frame(spark, later), clicks_frame(spark), first.state.persist())
    assert spark_rows(timeline.state_after(second.facts, second.devices)) == spark_rows(second.state)


def test_facts_of_a_day_are_folded_once_and_only_in_the_columns_asked_for(spark, tmp_path):
    index = ClickIndex(spark, f"{tmp_path}/clicks", buckets=2)
    stream = CorrectedStream(spark, f"{tmp_path}/t", index, buckets=2)
    for batch, device in enumerate(("a", "b")):
        rows = [message(device, when, event_id=str(i)) for i, when in enumerate(("1 10:00", "2 10:00", "3 10:00"))]
        stream.process(messages(spark, rows).select("kind", "value"), batch)
    whole = stream.facts_of(2)
    asked = ["ts", "new_today"]
    narrow = stream.facts_of(2, columns=asked)
    assert set(narrow.columns) == {"app_id", "device_id", "kind", "event_id", *asked}
    assert spark_rows(narrow) == spark_rows(whole.select(*narrow.columns))
    of = stream._facts_by_day(2)
    days = whole.select("stat_date").distinct().orderBy("stat_date")
    first, again = of(days.limit(2)), of(days)
    assert spark_rows(first) == spark_rows(whole.where("stat_date < DATE'2024-01-03'").select(*first.columns))
    assert spark_rows(again) == spark_rows(whole.select(*again.columns))
    assert set(first.inputFiles()) <= set(again.inputFiles())
