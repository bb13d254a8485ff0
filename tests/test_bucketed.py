"""Keyed tables in buckets, and the index of earliest clicks."""

import os
import random

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from cohortrail.operators import attribution, timeline
from cohortrail.schemas import DEVICE_KEYS, DEVICE_STATE
from cohortrail.sources import given_tables
from cohortrail.streaming.batched import latest_per_key
from cohortrail.streaming.bucketed import BucketedTable, ClickIndex
from tests.compare import spark_rows
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"
ROW = StructType([StructField("k", StringType()), StructField("part", IntegerType()), StructField("v", LongType())])


def table(spark, root, **options):
    return BucketedTable(spark, str(root), ROW, latest_per_key(["k", "part"], ROW), ["k", "part"], **options)


def rows(spark, content):
    return spark.createDataFrame([(*k, v) for k, v in content.items()], ROW)


def content(df):
    found = [((r.k, r.part), r.v) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


@pytest.mark.parametrize("seeded", [False, True])
def test_batches_bases_and_runs_again(spark, tmp_path, seeded):
    pick, model = random.Random(7), {}
    t = table(spark, tmp_path / "t", buckets=6, compact_every=2)
    if seeded:
        model = {(f"s{i}", 0): -i for i in range(20)}
        t.seed(rows(spark, model))
        t.seed(rows(spark, {("other", 0): 1}))  # what is there stays
    for batch in range(7):
        before = dict(model)
        change = {(f"k{pick.randrange(30)}", pick.randrange(2)): 100 * batch + i for i in range(pick.randrange(1, 9))}
        if batch == 4:
            change = {}
        for _ in range(2 if batch in (1, 3) else 1):  # batches that write a base run twice
            assert content(t.read(batch)) == before
            t.write(rows(spark, change), batch)
            t.compact(batch)
            t.tidy(batch)
        model |= change
        asked = pick.sample(sorted(model), min(3, len(model))) + [("absent", 0)]
        only = spark.createDataFrame(asked, "k string, part int")
        assert content(t.read(batch + 1, only, t.keys)) == {k: model[k] for k in asked if k in model}
    assert content(t.read(7)) == model
    # Only what the last two bases and the batches since need is left.
    assert sorted(os.listdir(tmp_path / "t" / "delta")) == [f"batch_id={b}" for b in range(4, 7)]
    places = {(r.bucket, r.since) for b in (4, 6) for r in t.places(b).collect()}
    stored = {
        (int(bucket[7:]), int(base[7:]))
        for base in os.listdir(tmp_path / "t" / "base")
        for bucket in os.listdir(tmp_path / "t" / "base" / base)
        if bucket.startswith("bucket=")
    }
    assert places == stored


def _bytes_read(spark, root, devices):
    """Of the state of so many devices, for a batch of twenty, with a hundred devices a bucket."""
    state = spark.range(devices).selectExpr(
        "'1' AS app_id", "md5(CAST(id AS string)) AS device_id", "CAST(id % 10 AS string) AS plan_id", "'0' AS channel_id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS active_time", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS last_launch_time",
        "false AS registered", "CAST(NULL AS timestamp_ntz) AS first_pay_time", "CAST(NULL AS date) AS last_pay_date",
    )
    fold = latest_per_key(DEVICE_KEYS, DEVICE_STATE)
    t = BucketedTable(spark, str(root), DEVICE_STATE, fold, DEVICE_KEYS, buckets=devices // 100)
    t.seed(state)
    batch = state.where("app_id = '1'").limit(20).select(*DEVICE_KEYS)
    wanted = t.touched(batch)
    read = t.stored(0, wanted)
    assert len(wanted) <= 20 and t.read(0, batch, DEVICE_KEYS).count() == 20
    files = [f.removeprefix("file://") for f in read.inputFiles()]
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files} <= set(wanted)
    return sum(map(os.path.getsize, files))


def test_bytes_read_stay_level_as_devices_grow_tenfold(spark, tmp_path):
    few, many = (_bytes_read(spark, tmp_path / str(n), n) for n in (3_000, 30_000))
    assert many < 1.5 * few


def test_a_base_writes_touched_buckets_alone(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=50, compact_every=1)
    t.seed(rows(spark, {(f"s{i}", 0): i for i in range(500)}))
    t.write(rows(spark, {("s1", 0): -1, ("s2", 0): -2}), 0)
    t.compact(0)
    written = [d for d in os.listdir(tmp_path / "t" / "base" / "before=1") if d.startswith("bucket=")]
    assert len(written) <= 2
    assert content(t.read(1)) == {(f"s{i}", 0): i for i in range(500)} | {("s1", 0): -1, ("s2", 0): -2}


def test_index_of_clicks_in_any_order_is_that_of_all_clicks(spark, tmp_path):
    clicks = given_tables.clicks(spark, SF)
    on = attribution.KEY
    want = spark_rows(
        attribution.earliest_click(attribution.unpivot_keys(clicks, attribution.LEVELS, attribution.CLICK_COLUMNS), on)
    )
    index = ClickIndex(spark, str(tmp_path / "i"), buckets=4, compact_every=2)
    assert index.next_batch() == 0 and index.current().count() == 0
    undated = clicks.selectExpr(*["CAST(NULL AS timestamp_ntz) AS click_ts" if c == "click_ts" else c for c in clicks.columns])
    for batch, part in enumerate([2, 0, None, 1]):  # not in the order of time, one batch of clicks without a time
        found = undated if part is None else clicks.where(f"click_id % 3 = {part}")
        index.add(found, batch)
        index.add(found, batch)
    assert spark_rows(index.current()) == want


def test_a_late_click_is_found_for_later_launches_only_where_it_is_earlier(spark, tmp_path):
    times = ["2024-01-01 10:00:00", "2024-01-01 08:00:00", "2024-01-01 09:00:00"]
    index = ClickIndex(spark, str(tmp_path / "i"))
    device = spark.createDataFrame(
        [("1", "d", 1, "2024-01-01 08:30:00", None, "o", None, None, None)],
        "app_id string, device_id string, os int, ts string, imei string, oaid string, androidid string, idfa string, external_ip string",
    ).selectExpr("app_id", "device_id", "os", "CAST(ts AS timestamp_ntz) AS ts", *attribution.MATCH_COLUMNS)
    found = []
    for batch, time in enumerate(times):
        click = spark.sql(
            f"SELECT 1 AS os, {batch}L AS click_id, TIMESTAMP_NTZ '{time}' AS click_ts, '' AS imei, 'o' AS oaid,"
            " '' AS androidid, '' AS mac, '' AS idfa, '' AS external_ip, 'p' AS plan_id, 'c' AS channel_id"
        )
        index.add(click, batch)
        found.append([r.click_id for r in attribution.match_clicks(device, index.lookup()).collect()])
    assert found == [[], [1], [1]]
    with pytest.raises(ValueError):
        attribution.match_clicks(device, index.lookup(), lookback_days=2)


def test_index_kept_by_a_stream(spark, tmp_path):
    clicks = given_tables.clicks(spark, SF)
    for i in range(2):
        clicks.where(f"click_id % 2 = {i}").write.parquet(str(tmp_path / f"in/{i}"))
    source = spark.readStream.schema(clicks.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    index = ClickIndex(spark, str(tmp_path / "i"), buckets=4)
    index.start(source.parquet(str(tmp_path / "in")), str(tmp_path / "c"), available_now=True).awaitTermination()
    assert index.next_batch() >= 2
    launches = given_tables.app_events(spark, SF).where("kind = 'launch'")
    firsts = timeline.first_launches(launches, launches_only=True).persist()
    assert spark_rows(attribution.match_clicks(firsts, index.lookup())) == spark_rows(attribution.match_clicks(firsts, clicks))
