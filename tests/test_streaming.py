import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortrail.operators import registry, stats, timeline
from cohortrail.schemas import APP_REGISTRY, DEVICE_KEYS, DEVICE_STATE
from cohortrail.sources import files, given_tables, payload
from cohortrail.streaming import streams
from cohortrail.streaming.batched import BatchedTable, latest_per_key
from tests.build import at
from tests.compare import spark_rows
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    events = given_tables.app_events(spark, SF).persist()
    clicks = given_tables.clicks(spark, SF).persist()
    times = sorted(r["ts"] for r in events.select("ts").collect())
    return events, clicks, times


def _tables(facts):
    return {
        "daily": spark_rows(stats.daily(facts)),
        "retention": spark_rows(stats.retention(facts)),
        "pay": spark_rows(stats.pay_cohort(facts)),
    }


@pytest.fixture(scope="module")
def whole(inputs):
    events, clicks, _ = inputs
    step = timeline.step(events, clicks)
    return _tables(step.facts), spark_rows(step.state)


# 24: cut the time-ordered input anywhere, fold the pieces, compare with one batch.
@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_any_cut_folds_to_the_same_tables(spark, inputs, whole, data):
    events, clicks, times = inputs
    cuts = sorted(data.draw(st.sets(st.integers(1, len(times) - 1), min_size=1, max_size=2)))
    bounds = [times[0], *[times[c] for c in cuts], None]
    state, facts = None, None
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = events.where(F.col("ts") >= F.lit(low))
        part = part if high is None else part.where(F.col("ts") < F.lit(high))
        step = timeline.step(part, clicks, state, hot_rows=data.draw(st.sampled_from([20, 2_000_000])))
        kept = step.facts.persist()
        facts = kept if facts is None else facts.unionByName(kept)
        changed = step.state.selectExpr("*", f"CAST({i} AS bigint) AS batch_id")
        versions = changed if state is None else changed.unionByName(state.selectExpr("*", "CAST(-1 AS bigint) AS batch_id"))
        state = latest_per_key(DEVICE_KEYS, DEVICE_STATE)(versions).persist()
    assert _tables(facts) == whole[0]
    assert spark_rows(state) == whole[1]


def _batches(spark, raw, n):
    """Raw messages in `n` stretches of time."""
    cut = raw.selectExpr("*", f"ntile({n}) OVER (ORDER BY ts, value) AS part").persist()
    return [cut.where(f"part = {i + 1}").select("kind", "value") for i in range(n)]


def test_stream_replay_compaction_and_registry(spark, inputs, whole, tmp_path):  # 23
    _, clicks, _ = inputs
    known = spark.createDataFrame([(a, 1, (0, 0, 0)) for a in "012"], APP_REGISTRY)
    stream = streams.AppStream(spark, str(tmp_path / "t"), lambda: clicks, lambda: known, compact_every=2)
    parts = _batches(spark, given_tables.raw_payloads(spark, SF), 3)
    for batch_id, part in enumerate(parts):
        stream.process(part, batch_id)
        if batch_id == 1:
            stream.process(part, batch_id)  # the batch that also writes a base runs twice
    stream.process(parts[2], 2)
    assert stream.next_batch() == 3
    assert (tmp_path / "t" / "state" / "base" / "before=2").exists()

    def read(table):
        return spark_rows(stream.current(table))

    assert {"daily": read(stream.daily), "retention": read(stream.retention), "pay": read(stream.pay_cohort)} == whole[0]
    assert read(stream.state) == whole[1]
    events = given_tables.table(spark, SF, "events")
    damaged = events.where("event_type = 'error'").count()
    reasons = {r["reason"]: r["count"] for r in stream.current(stream.rejects).groupBy("reason").count().collect()}
    assert reasons["json"] + reasons["platform"] == damaged
    step = timeline.step(*inputs[:2])
    assert reasons["no_activation"] == step.rejects.count()
    logs = {r["log"]: r["count"] for r in stream.logs().groupBy("log").count().collect()}
    assert logs["launch"] == events.where("event_type = 'view'").count()
    assert logs["active"] == step.state.count()
    final = {r["app_id"]: r["app_step"] for r in stream.app_registry(known).collect()}
    assert final == {r["app_id"]: r["app_step"] for r in registry.funnel(step.facts).collect()}
    written = registry.from_text(stream.write_registry(known))
    assert spark_rows(written) == spark_rows(stream.app_registry(known))


def test_an_early_payment_counts_once_its_launch_comes(spark, inputs, tmp_path):
    stream = streams.AppStream(spark, str(tmp_path / "t"), lambda: inputs[1])
    line = '{{"appid":"1","os":"1","oaid":"{}","ts":"2024-01-01 {}:00:00","event_id":"{}"{}}}'
    pay = ("pay", line.format("o", "09", 2, ',"amount":"5.00"'))
    for batch_id, messages in enumerate([
        [pay, ("reg", line.format("o", "07", 1, "")), ("pay", line.format("p", "09", 3, ',"amount":"1.00"'))],
        [("launch", line.format("o", "08", 4, ""))],
        [("launch", line.format("o", "10", 5, ""))],
    ]):
        stream.process(spark.createDataFrame(messages, files.RAW_SCHEMA), batch_id)
    facts = sorted((r["kind"], r["event_id"]) for r in stream.current(stream.facts).collect())
    assert facts == [("launch", 4), ("launch", 5), ("pay", 2)]
    row = stream.current(stream.daily).first()
    assert (row["pay_count"], float(row["pay_amount"]), row["launch_count"]) == (1, 5.0, 2)
    assert sorted(r["kind"] for r in stream.current(stream.rejects).collect()) == ["pay", "pay", "reg"]


def test_unregistered_app_goes_to_rejects_in_the_stream(spark, inputs, tmp_path):
    _, clicks, _ = inputs
    known = spark.createDataFrame([(a, 1, (0, 0, 0)) for a in "01"], APP_REGISTRY)
    stream = streams.AppStream(spark, str(tmp_path / "t"), lambda: clicks, lambda: known)
    stream.process(given_tables.raw_payloads(spark, SF).select("kind", "value"), 0)
    reasons = {r["reason"] for r in stream.current(stream.rejects).select("reason").distinct().collect()}
    assert reasons == {"json", "platform", "app", "no_activation"}
    assert {r["app_id"] for r in stream.current(stream.daily).select("app_id").distinct().collect()} == {"0", "1"}


def test_web_stream_with_late_state(spark, tmp_path):
    raw = given_tables.raw_web_payloads(spark, SF)
    stream = streams.WebStream(spark, str(tmp_path / "w"), compact_every=2)
    for batch_id, part in enumerate(_batches(spark, raw, 3)):
        stream.process(part, batch_id)
    step = timeline.web_step(given_tables.web_events(spark, SF))
    assert spark_rows(stream.current(stream.daily)) == spark_rows(stats.web_daily(step.facts))
    assert spark_rows(stream.current(stream.retention)) == spark_rows(stats.web_retention(step.facts))
    assert spark_rows(stream.current(stream.state)) == spark_rows(step.state)
    assert stream.logs().where("log = 'launch'").count() == raw.count()


def test_text_files_feed_a_query_and_restart_from_its_checkpoint(spark, inputs, tmp_path):
    _, clicks, _ = inputs
    stream = streams.AppStream(spark, str(tmp_path / "t"), lambda: clicks)
    parts = _batches(spark, given_tables.raw_payloads(spark, SF).where("kind = 'launch'"), 2)
    for i, part in enumerate(parts):
        part.select("value").coalesce(1).write.text(str(tmp_path / "in" / str(i)))
        source = files.stream_text(spark, str(tmp_path / "in"), "launch")
        stream.start(source, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert stream.next_batch() == 2
    facts = timeline.step(inputs[0].where("kind = 'launch'"), clicks).facts
    assert spark_rows(stream.current(stream.daily)) == spark_rows(stats.daily(facts))
    read = files.read_text(spark, str(tmp_path / "in"), "launch")
    assert payload.app_events(read).count() == sum(p.count() for p in parts)


def test_redelivered_messages_are_dropped(spark, inputs, tmp_path):
    # The event time of message 1 is far ahead of the others: it must not make them late.
    days = {0: "2024-01-01", 1: "2034-01-01", 2: "2024-01-01"}
    good = [f'{{"appid":"1","os":"1","oaid":"o{i}","ts":"{d} 08:00:00","event_id":"{i}"}}' for i, d in days.items()]
    raw = "kind string, value string, arrival timestamp_ntz"
    folder = tmp_path / "in"
    stream = streams.AppStream(spark, str(tmp_path / "t"), lambda: inputs[1])
    for i, lines in enumerate(([good[0], good[1], good[1], "broken"], [good[1], good[2], "other"])):
        rows = [("launch", v, at(f"{2 + i} 08:00")) for v in lines]
        spark.createDataFrame(rows, raw).coalesce(1).write.parquet(str(folder / str(i)))
        source = files.stream_parquet(spark, str(folder), raw)
        stream.start(source, str(tmp_path / "cp"), True, redelivery="2 days").awaitTermination()
    assert sorted(r["event_id"] for r in stream.current(stream.facts).collect()) == [0, 1, 2]
    assert sorted(r["raw"] for r in stream.current(stream.rejects).collect()) == ["broken", "other"]


def test_daily_windows_append_once_closed(spark, tmp_path):
    lines = [f'{{"appid":"1","os":"1","oaid":"o","ts":"2024-01-0{d} 08:00:00","event_id":"{d}"}}' for d in (1, 1, 2, 5)]
    folder = tmp_path / "in"
    spark.createDataFrame([("launch", v) for v in lines], files.RAW_SCHEMA).write.parquet(str(folder / "a"))
    tagged = payload.app_events(files.stream_parquet(spark, str(folder)))
    query = streams.daily_event_counts(tagged).writeStream.option("checkpointLocation", str(tmp_path / "cp"))
    query.trigger(availableNow=True).format("parquet").start(str(tmp_path / "out")).awaitTermination()
    got = {r["stat_date"].day: r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: 2, 2: 1}


def test_batches_behind_the_last_but_one_base_go(spark, tmp_path):
    def fold(rows):
        return rows.groupBy().agg(F.expr("sum(id) AS id"))

    table = BatchedTable(spark, str(tmp_path), spark.range(1).schema, fold, compact_every=2)
    table.seed(spark.range(100, 101))
    for b in range(9):
        table.write(spark.range(b, b + 1), b)
        table.compact(b)
        table.tidy(b)
        assert table.read(b + 1).first()["id"] == 100 + sum(range(b + 1))
        assert table.read(b).first()["id"] == 100 + sum(range(b))
    left = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "delta").iterdir())
    assert left[0] >= 4 and left[-1] == 8


def test_batched_table_without_fold(spark, tmp_path):
    table = BatchedTable(spark, str(tmp_path), spark.range(1).schema)
    assert table.read(0).count() == 0
    for b in range(3):
        table.write(spark.range(b * 10, b * 10 + 2), b)
    table.write(spark.range(10, 13), 1)
    assert sorted(r["id"] for r in table.read(2).collect()) == [0, 1, 10, 11, 12]
