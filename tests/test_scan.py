"""Hot devices cut into even ranges of their time line, and statistics from one pass."""

import pytest

from cohortrail.operators import registry, stats, timeline
from cohortrail.operators.skew import heaviest
from cohortrail.schemas import DEVICE_KEYS
from cohortrail.sources import given_tables as given
from tests.build import clicks_frame, event, events_frame
from tests.compare import spark_rows
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"


def one_minute(spark):
    """A device with 600 events in one minute, most of them at the same second, and a few others."""
    kinds = ["launch", "reg", "pay"]
    rows = [event("launch", "d", "1 08:00")]
    rows += [event(kinds[i % 3], "d", "1 08:00", **({"amount": "1"} if i % 3 == 2 else {})) for i in range(600)]
    rows += [event("launch", "e", f"{d} 09:00") for d in (1, 2, 4)] + [event("pay", "f", "1 10:00", amount="2")]
    return events_frame(spark, rows)


def test_a_device_of_one_minute_is_cut_evenly(spark):
    events = one_minute(spark)
    hot = heaviest(timeline.first_launches(events), DEVICE_KEYS, 100)
    line = timeline.cut_hot(events, hot, DEVICE_KEYS)
    sizes = [r["count"] for r in line.cut.groupBy(timeline.SLICE).count().collect()]
    assert sum(sizes) == 601 and len(sizes) >= 4 and max(sizes) < 2 * 601 / len(sizes)
    assert line.events.count() == events.count()
    # Slices follow one another in time.
    spans = line.cut.groupBy(timeline.SLICE).agg({"event_id": "min", "ts": "max"}).orderBy(timeline.SLICE).collect()
    assert [s["max(ts)"] for s in spans] == sorted(s["max(ts)"] for s in spans)


@pytest.mark.parametrize("hot_rows", [1, 100])
def test_cut_devices_give_the_same_facts(spark, hot_rows):
    events, clicks = one_minute(spark), clicks_frame(spark)
    whole, cut = timeline.step(events, clicks), timeline.step(events, clicks, hot_rows=hot_rows)
    for a, b in zip(whole, cut):
        assert spark_rows(a) == spark_rows(b)


def test_cut_web_devices_give_the_same_facts(spark):
    events = given.web_events(spark, SF)
    for a, b in zip(timeline.web_step(events), timeline.web_step(events, hot_rows=5)):
        assert spark_rows(a) == spark_rows(b)


def test_parts_are_the_statistics_in_one_scan_and_one_exchange(spark, tmp_path):
    timeline.step(given.app_events(spark, SF), given.clicks(spark, SF)).facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    parts = stats.parts(facts)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and "SortAggregate" not in plan
    for name, table, alone in (("daily", stats.DAILY, stats.daily), ("retention", stats.RETENTION, stats.retention),
                               ("pay", stats.PAY_COHORT, stats.pay_cohort)):
        assert spark_rows(stats.merge_deltas(stats.of_parts(parts, name), table)) == spark_rows(alone(facts))
    assert spark_rows(registry.signals_of_parts(parts)) == spark_rows(registry.signals(facts))
    nothing = stats.parts(facts.where("false"))
    assert nothing.count() == 0 and stats.of_parts(nothing, "pay").count() == 0


def test_what_is_taken_back_counts_nothing(spark):
    facts = timeline.step(given.app_events(spark, SF), given.clicks(spark, SF)).facts
    deltas = stats.of_parts(stats.parts(facts), "daily").persist()
    first = deltas.where("app_id = '1'")
    left = stats.merge_deltas(deltas.unionByName(stats.taken_back(first, stats.DAILY)), stats.DAILY)
    assert left.where("app_id = '1' AND launch_count + reg_count + pay_count <> 0").count() == 0
    rest = left.where("app_id <> '1'")
    assert spark_rows(rest) == spark_rows(stats.daily(facts.where("app_id <> '1'")))
