"""Distinct devices by bitmaps, and the log fallback's scan."""

from cohortrail.operators import distinct, timeline
from cohortrail.schemas import DEVICE_KEYS
from cohortrail.sources import given_tables as given
from cohortrail.sources import stored
from tests.build import at, clicks_frame, event, events_frame, md5
from tests.compare import spark_rows
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"


def devices(spark, names):
    return spark.createDataFrame([("49", n) for n in names], "app_id string, device_id string")


def numbers(df):
    return {r.device_id: r.device_nr for r in df.collect()}


def test_numbers_are_dense_within_buckets_and_stay(spark):
    first = distinct.numbered(devices(spark, [f"d{i}" for i in range(500)] * 2), buckets=4).persist()
    found = numbers(first)
    assert len(found) == 500 == len(set(found.values()))
    for bucket in range(4):
        own = sorted(n // 4 for n in found.values() if n % 4 == bucket)
        assert own == list(range(len(own)))
    again = distinct.numbered(devices(spark, [f"d{i}" for i in range(400, 600)]), first, buckets=4)
    more = numbers(again)
    assert set(more) == {f"d{i}" for i in range(500, 600)} and not set(more.values()) & set(found.values())
    assert max(more.values()) < 4 * 250
    assert distinct.numbered(devices(spark, []), first, buckets=4).count() == 0


def test_counting_a_batch_twice_changes_nothing(spark):
    facts = timeline.step(given.app_events(spark, SF), given.clicks(spark, SF)).facts.persist()
    nr = distinct.numbered(facts).persist()
    parts = [distinct.active(facts.where(f"pmod(event_id, 3) = {i}"), nr) for i in range(3)]
    once = parts[0].unionByName(parts[1]).unionByName(parts[2])
    twice = once.unionByName(parts[1]).unionByName(parts[1])
    keys = distinct.ACTIVE_KEYS
    want = facts.where("kind = 'launch'").groupBy(*keys).agg({"device_id": "count"}).count()
    a, b = (distinct.counted(distinct.union(x, keys), keys) for x in (once, twice))
    assert spark_rows(a) == spark_rows(b) and a.count() == want
    exact = facts.where("kind = 'launch'").selectExpr(*keys, "device_id").distinct().groupBy(*keys).count()
    assert spark_rows(a) == spark_rows(exact.withColumnRenamed("count", "device_count"))
    # A stored set folds with itself.
    merged = distinct.union(once, keys).persist()
    assert spark_rows(distinct.counted(distinct.union(merged.unionByName(merged), keys), keys)) == spark_rows(a)


def test_many_devices_span_several_ranges(spark):
    rows = spark.range(100_000).selectExpr("'1' AS app_id", "CAST(id AS string) AS device_id", "'p' AS plan_id",
                                           "DATE '2024-01-01' AS stat_date")
    nr = distinct.numbered(rows).persist()
    found = distinct.sets(rows.where("CAST(device_id AS bigint) % 2 = 0"), nr, distinct.ACTIVE_KEYS)
    assert found.count() > 1
    assert [r.device_count for r in distinct.counted(found, distinct.ACTIVE_KEYS).collect()] == [50_000]
    assert distinct.sets(rows.where("false"), nr, distinct.ACTIVE_KEYS).count() == 0


def test_fallback_names_devices_in_the_scan_of_the_logs(spark, tmp_path):
    events = [event("launch", f"d{i}", f"{1 + i % 9} 08:00") for i in range(200)]
    events += [event("launch", f"d{i}", "9 09:00") for i in range(200)] + [event("pay", "d3", "9 10:00", amount="1")]
    step = timeline.step(events_frame(spark, events), clicks_frame(spark))
    facts = step.facts.persist()
    for name, where in (("active", "is_new = 1"), ("launch", "kind = 'launch'"), ("reg", "new_reg = 1"), ("pay", "kind = 'pay'")):
        rows = facts.where(where).select(*DEVICE_KEYS, "ts", "event_id", "plan_id", "channel_id")
        rows.repartitionByRange(4, "device_id").sortWithinPartitions("device_id").write.parquet(str(tmp_path / name))
    logs = [spark.read.parquet(str(tmp_path / n)) for n in ("active", "launch", "reg", "pay")]
    asked = devices(spark, [md5("d3"), md5("d7"), md5("unknown")])
    found = stored.state_of(asked, *logs)
    want = step.state.join(asked, DEVICE_KEYS, "left_semi").select(*found.columns)
    assert spark_rows(found) == spark_rows(want) and found.count() == 2
    assert [r.last_launch_time for r in found.collect()] == [at("9 09:00")] * 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("In(device_id, [") >= 4
    many = stored.state_of(step.state.select(*DEVICE_KEYS), *logs)
    assert spark_rows(many.select(*found.columns)) == spark_rows(step.state.select(*found.columns))
    stored.NAMED_IDS, kept = 1, stored.NAMED_IDS
    try:
        assert spark_rows(stored.state_of(asked, *logs)) == spark_rows(want)
    finally:
        stored.NAMED_IDS = kept
