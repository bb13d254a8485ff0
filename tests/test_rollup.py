import pytest

from cohortrail.functions import scalars as S
from cohortrail.operators import rollup, stats, timeline
from cohortrail.sources import given_tables as given
from tests.build import clicks_frame, event, events_frame
from tests.compare import spark_rows
from tests.conftest import DATA


# A low hot limit also makes the recount of cut days and the click match take their hot branches.
@pytest.mark.parametrize("hot_rows", [2_000_000, 2])
def test_device_days_give_the_same_tables_as_events(spark, hot_rows):
    sf_dir = f"{DATA}/sf0.001"
    events, clicks = given.app_events(spark, sf_dir), given.clicks(spark, sf_dir)
    facts = timeline.step(events, clicks).facts.persist()
    days = rollup.settled_days(events, clicks, hot_rows).persist()
    assert spark_rows(rollup.daily(days)) == spark_rows(stats.daily(facts))
    assert spark_rows(rollup.retention(days)) == spark_rows(stats.retention(facts))
    assert spark_rows(rollup.pay_cohort(days)) == spark_rows(stats.pay_cohort(facts))
    for kind, table in (("launch", rollup.daily_launches), ("reg", rollup.daily_regs), ("pay", rollup.daily_pays)):
        assert spark_rows(table(days)) == spark_rows(stats.daily(facts.where(f"kind = '{kind}'")))
    launches = rollup.launch_days(events, clicks, hot_rows)
    assert spark_rows(rollup.retention(launches)) == spark_rows(stats.retention(facts))
    assert days.where("launches = 0 AND regs = 0 AND pays = 0").count() == 0


def test_day_cut_by_the_activation(spark):
    events = [
        event("pay", "d", "1 07:00", amount="9"),
        event("reg", "d", "1 07:30"),
        event("launch", "d", "1 08:00"),
        event("pay", "d", "1 08:00", amount="2"),
        event("pay", "d", "1 09:00", amount="3"),
        event("pay", "e", "1 07:00", amount="9"),
        event("launch", "e", "1 08:00"),
        event("reg", "e", "2 08:00"),
        event("pay", "x", "1 07:00", amount="9"),
    ]
    frame, clicks = events_frame(spark, events), clicks_frame(spark)
    days = rollup.settled_days(frame, clicks).persist()
    facts = timeline.step(frame, clicks).facts
    assert spark_rows(rollup.daily(days)) == spark_rows(stats.daily(facts))
    assert spark_rows(rollup.pay_cohort(days)) == spark_rows(stats.pay_cohort(facts))
    row = rollup.pay_cohort(days).first()
    assert (row["pay_count"], row["pay_new_amount"], row["pay_total_devices"]) == (2, 2, 1)


def test_order_key_orders_like_the_pair(spark):
    big = 2**63 - 1
    rows = [("1969-12-31 23:59:59.999999", big), ("1970-01-01 00:00:00", -big), ("1970-01-01 00:00:00", 0),
            ("2024-01-01 00:00:00.000001", 5), ("2024-01-01 00:00:00.000001", big), ("2024-01-01 00:00:00.000002", -5),
            ("9999-12-31 23:59:59.999999", big)]
    frame = spark.createDataFrame(rows, "t string, event_id bigint").selectExpr("CAST(t AS timestamp_ntz) AS ts", "event_id")
    keyed = frame.selectExpr("*", f"{S.order_key('ts', 'event_id')} AS k").orderBy("k")
    back = keyed.selectExpr("ts", "event_id", f"{S.order_id('k', 'ts')} AS id").collect()
    assert [(r["ts"], r["event_id"]) for r in back] == sorted((r["ts"], r["event_id"]) for r in back)
    assert all(r["id"] == r["event_id"] for r in back)


def test_statistics_use_hash_aggregation_only(spark):
    sf_dir = f"{DATA}/sf0.001"
    events, clicks = given.app_events(spark, sf_dir), given.clicks(spark, sf_dir)
    facts = timeline.step(events, clicks).facts
    written = spark.createDataFrame([], facts.schema)
    for table in (stats.daily(written), stats.retention(written), stats.pay_cohort(written)):
        parts = table._jdf.queryExecution().sparkPlan().toString()
        # The second level folds the few rows per key and may sort them; the level over facts must not.
        assert parts.count("HashAggregate") >= 2


def test_events_are_shuffled_and_sorted_once(spark):
    """One exchange and one sort of the events serve the device join and all windows."""
    sf_dir = f"{DATA}/sf0.001"
    step = timeline.step(given.app_events(spark, sf_dir), given.clicks(spark, sf_dir))
    plan = step.facts._jdf.queryExecution().executedPlan().toString()
    above_join = plan[: plan.index("ShuffledHashJoin")]
    assert above_join.count("Exchange") == 0
    assert above_join.count("Sort [") == 1
    assert "PushedFilters: [In(event_type, [" in plan.replace("IsNotNull(event_type), ", "")
