"""The stream that corrects itself: any cut and any order of arrival give the tables of one batch."""

import datetime
import os
import random

import pytest

from cohortrail.operators import stats, timeline
from cohortrail.schemas import APP_EVENT
from cohortrail.sources import files, given_tables
from cohortrail.streaming.bucketed import ClickIndex
from cohortrail.streaming.corrected import CorrectedStream
from tests.compare import spark_rows
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"


def stream_of(spark, root, **options):
    index = ClickIndex(spark, f"{root}/clicks", buckets=3, compact_every=2)
    return index, CorrectedStream(spark, f"{root}/t", index, buckets=3, compact_every=2, **options)


def tables(stream):
    return {
        "daily": spark_rows(stream.current(stream.daily)),
        "retention": spark_rows(stream.current(stream.retention)),
        "pay": spark_rows(stream.current(stream.pay_cohort)),
    }


def by_batch(facts):
    return {
        "daily": spark_rows(stats.daily(facts)),
        "retention": spark_rows(stats.retention(facts)),
        "pay": spark_rows(stats.pay_cohort(facts)),
    }


@pytest.mark.parametrize("seed", [2])
def test_any_order_gives_the_tables_of_one_batch(spark, tmp_path, seed):
    pick = random.Random(seed)
    n = pick.choice([3, 4])
    raw, clicks = given_tables.raw_payloads(spark, SF), given_tables.clicks(spark, SF)
    index, stream = stream_of(spark, tmp_path)
    again = pick.randrange(n)
    for nr in range(n):
        index.add(clicks.where(f"pmod(xxhash64(click_id, {seed}), {n}) = {nr}"), nr)
        part = raw.where(f"pmod(xxhash64(value, {seed}), {n}) = {nr}").select("kind", "value")
        for _ in range(2 if nr == again else 1):
            stream.process(part, nr)
    step = timeline.step(given_tables.app_events(spark, SF), clicks)
    assert tables(stream) == by_batch(step.facts)
    facts = step.facts.select(*stream.facts_of(n).columns)
    assert spark_rows(stream.facts_of(n)) == spark_rows(facts)
    state = stream.seen.read(n).where("active_time IS NOT NULL").select(*step.state.columns)
    assert spark_rows(state) == spark_rows(step.state)


LINE = '{{"appid":"1","os":"1","oaid":"{}","imei":"{}","ts":"2024-01-{} 08:00:00","event_id":"{}"{}}}'


def message(kind, device, day, event_id, amount=None, imei=""):
    more = "" if amount is None else f',"amount":"{amount}"'
    return kind, LINE.format(device, imei, f"{day:02}", event_id, more)


def click(spark, click_id, day, imei, plan):
    return spark.sql(
        f"SELECT 1 AS os, {click_id}L AS click_id, TIMESTAMP_NTZ '2024-01-{day:02} 07:00:00' AS click_ts, md5('{imei}') AS imei,"
        f" '' AS oaid, '' AS androidid, '' AS mac, '' AS idfa, '' AS external_ip, '{plan}' AS plan_id, 'c{plan}' AS channel_id"
    )


def counts(stream, table, *columns):
    return sorted(tuple(r[c] for c in columns) for r in stream.current(table).collect())


def test_a_late_launch_opens_its_day_and_moves_the_activation(spark, tmp_path):
    index, stream = stream_of(spark, tmp_path)
    for nr, batch in enumerate([
        [message("launch", "a", 5, 1), message("launch", "b", 5, 2), message("pay", "a", 3, 3, "2.00")],
        [message("launch", "a", 7, 4)],
        [message("launch", "a", 6, 5)],  # late: a day between two others
        [message("launch", "a", 2, 6)],  # later still: the activation, to which the payment of day 3 belongs
    ]):
        stream.process(spark.createDataFrame(batch, files.RAW_SCHEMA), nr)
    day = lambda n: datetime.date(2024, 1, n)
    assert counts(stream, stream.daily, "stat_date", "launch_count", "active_count", "vibrant_count", "pay_count") == [
        (day(2), 1, 1, 1, 0), (day(3), 0, 0, 0, 1), (day(5), 2, 1, 2, 0), (day(6), 1, 0, 1, 0), (day(7), 1, 0, 1, 0),
    ]
    assert counts(stream, stream.retention, "active_date", "retention_days", "retention_count") == [
        (day(2), 4, 1), (day(2), 5, 1), (day(2), 6, 1),
    ]
    assert counts(stream, stream.pay_cohort, "active_date", "pay_days", "pay_count") == [(day(2), 2, 1)]
    rejects = [r.kind for r in stream.current(stream.rejects).collect()]
    assert rejects == ["pay"]  # told once, when it came


def test_a_click_that_arrives_after_its_launch_is_credited(spark, tmp_path):
    index, stream = stream_of(spark, tmp_path)
    stream.process(spark.createDataFrame([message("launch", "a", 5, 1, imei="i"), message("launch", "b", 5, 2)], files.RAW_SCHEMA), 0)
    assert counts(stream, stream.daily, "plan_id", "active_count") == [("0", 2)]
    nothing = spark.createDataFrame([], files.RAW_SCHEMA)
    index.add(click(spark, 1, 6, "i", "9"), 0)  # after the launch: no credit
    stream.process(nothing, 1)
    assert counts(stream, stream.daily, "plan_id", "active_count") == [("0", 2)]
    index.add(click(spark, 2, 4, "i", "3"), 1)
    stream.process(nothing, 2)
    assert counts(stream, stream.daily, "plan_id", "channel_id", "active_count") == [("0", "0", 1), ("3", "c3", 1)]
    index.add(click(spark, 3, 2, "i", "7"), 2)  # an earlier one of the same key
    stream.process(spark.createDataFrame([message("launch", "a", 8, 3, imei="i")], files.RAW_SCHEMA), 3)
    assert counts(stream, stream.daily, "plan_id", "active_count", "launch_count") == [("0", 1, 1), ("7", 0, 1), ("7", 1, 1)]
    assert counts(stream, stream.retention, "plan_id", "retention_days") == [("7", 4)]


def test_a_description_whose_first_event_leaves_is_that_of_the_next(spark, tmp_path):
    """Two devices of one plan by two channels; the first of them moves to another plan."""
    index, stream = stream_of(spark, tmp_path)
    for nr, (plan, imei) in enumerate([("3", "i"), ("3", "j")]):
        made = click(spark, nr, 4, imei, plan)
        index.add(made.selectExpr(*[f"'ch{imei}' AS channel_id" if c == "channel_id" else c for c in made.columns]), nr)
    batch = [message("launch", "a", 5, 1, imei="i"), message("launch", "b", 5, 2, imei="j")]
    stream.process(spark.createDataFrame(batch, files.RAW_SCHEMA), 0)
    assert counts(stream, stream.daily, "plan_id", "channel_id", "launch_count") == [("3", "chi", 2)]
    # A change of channel within the plan: to one that sorts behind the first.
    same = click(spark, 5, 3, "i", "3")
    index.add(same.selectExpr(*["'zz' AS channel_id" if c == "channel_id" else c for c in same.columns]), 2)
    stream.process(spark.createDataFrame([], files.RAW_SCHEMA), 1)
    assert counts(stream, stream.daily, "plan_id", "channel_id", "launch_count") == [("3", "zz", 2)]
    index.add(click(spark, 9, 1, "i", "8"), 3)
    stream.process(spark.createDataFrame([], files.RAW_SCHEMA), 2)
    assert counts(stream, stream.daily, "plan_id", "channel_id", "launch_count") == [("3", "chj", 1), ("8", "c8", 1)]


def test_a_day_is_read_from_one_folder_and_a_rerun_leaves_the_same(spark, tmp_path):
    index, stream = stream_of(spark, tmp_path)
    first = spark.createDataFrame([message("launch", "a", d, d) for d in (5, 6, 7)], files.RAW_SCHEMA)
    second = spark.createDataFrame([message("launch", "a", 8, 8), message("launch", "b", 7, 9)], files.RAW_SCHEMA)
    stream.process(first, 0)
    stream.process(second, 1)
    once = tables(stream)
    stream.process(second, 1)
    assert tables(stream) == once
    rows = stream.daily.read_days(2, [datetime.date(2024, 1, 7)])
    assert [(str(r.stat_date), r.launch_count) for r in rows.collect()] == [("2024-01-07", 2)]
    day = (datetime.date(2024, 1, 7) - datetime.date(1970, 1, 1)).days
    assert {os.path.dirname(f).rsplit("/", 2)[-2:][1] for f in rows.inputFiles()} == {f"bucket={day}"}
    # Days that the second batch did not touch were not written again.
    assert sorted(os.listdir(tmp_path / "t/stat_daily/base/before=2"))[-2:] == [f"bucket={day}", f"bucket={day + 1}"]
    assert stream.daily.read_days(2, [datetime.date(2024, 2, 1)]).count() == 0


def test_unusable_events_are_told_and_empty_batches_do_no_harm(spark, tmp_path):
    index, stream = stream_of(spark, tmp_path)
    stream.process(spark.createDataFrame([], files.RAW_SCHEMA), 0)
    stream.process(spark.createDataFrame([("launch", "{"), message("launch", "a", 1, 1), message("reg", "b", 1, 2)], files.RAW_SCHEMA), 1)
    assert sorted(r.reason for r in stream.current(stream.rejects).collect()) == ["json", "no_activation"]
    assert counts(stream, stream.daily, "launch_count") == [(1,)]
    assert set(APP_EVENT.fieldNames()) < set(stream.facts_of(2).columns)
