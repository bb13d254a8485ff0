"""The registered queries: each takes `(spark, sf_dir)`, reads whole tables, and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrail.operators import attribution, distinct, registry, rollup, stats, timeline
from cohortrail.operators.skew import materialize
from cohortrail.plans import tables
from cohortrail.plans.replay import replay
from cohortrail.schemas import FIRST, LAUNCH, PAY, REG
from cohortrail.session import shared_dir
from cohortrail.sources import given_tables as given
from cohortrail.sources import files, payload, stored
from cohortrail.streaming.bucketed import ClickIndex
from cohortrail.streaming.corrected import CorrectedStream
from cohortrail.streaming.streams import AppStream, WebStream

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Plain result types: dates and times as text, counts and flags as bigint, money as double."""
    df = df.selectExpr(*columns) if columns else df
    forms = {
        "date": "date_format({c}, 'yyyy-MM-dd')",
        "timestamp_ntz": "date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
        "int": "CAST({c} AS bigint)",
        "boolean": "CAST({c} AS bigint)",
        "decimal(18,2)": "CAST({c} AS double)",
    }
    return df.selectExpr(*[forms.get(t, "{c}").format(c=c) + f" AS {c}" for c, t in df.dtypes])


def _step(spark: SparkSession, sf_dir: str, **options) -> timeline.Step:
    return timeline.step(given.app_events(spark, sf_dir), given.clicks(spark, sf_dir), **options)


def _web(spark: SparkSession, sf_dir: str) -> timeline.Step:
    return timeline.web_step(given.web_events(spark, sf_dir))


LAUNCH_COUNTS = ["launch_count", "active_count", "vibrant_count"]
REG_COUNTS = ["reg_count", "onlyreg_count"]
PAY_COUNTS = ["pay_count", "pay_amount"]
_DAILY_KEY = [*stats.DAILY.keys, "channel_id"]


def daily_base_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: attribution, then every daily measure per app, plan and day."""
    return present(stats.daily(_step(spark, sf_dir).facts).drop(*FIRST))


def _daily_of(kind: str, counts: list[str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        facts = _step(spark, sf_dir).facts.where(f"kind = '{kind}'")
        return present(stats.daily(facts), *_DAILY_KEY, *counts)

    return query


def launch_daily_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = rollup.launch_days(given.app_events(spark, sf_dir), given.clicks(spark, sf_dir))
    return present(rollup.daily_launches(days), *_DAILY_KEY, *LAUNCH_COUNTS)


def retention_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = rollup.launch_days(given.app_events(spark, sf_dir), given.clicks(spark, sf_dir))
    return present(rollup.retention(days).drop(*FIRST))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.settled_days(given.app_events(spark, sf_dir), given.clicks(spark, sf_dir))


def daily_base_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship by way of device-days."""
    return present(rollup.daily(_days(spark, sf_dir)).drop(*FIRST))


def pay_cohort_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(rollup.pay_cohort(_days(spark, sf_dir)).drop(*FIRST))


def statistics_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily, retention and payment statistics from one pass over the facts."""
    parts = materialize(stats.parts(_step(spark, sf_dir).facts), "parts")
    out = None
    for name, table in (("daily", stats.DAILY), ("retention", stats.RETENTION), ("pay", stats.PAY_COHORT)):
        merged = stats.merge_deltas(stats.of_parts(parts, name), table).drop(*FIRST)
        merged = merged.withColumn("stat", F.lit(name))
        out = merged if out is None else out.unionByName(merged, allowMissingColumns=True)
    return present(out)


def app_signals_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Onboarding from the same pass."""
    parts = materialize(stats.parts(_step(spark, sf_dir).facts), "parts")
    merged = registry.merge(given.app_registry(spark, sf_dir), registry.signals_of_parts(parts))
    return present(merged, "app_id", "app_step", f"{registry.EVENT_TEXT} AS app_event")


def _device_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The facts and the numbers of their devices, both written; devices are numbered in two steps."""
    facts = materialize(_step(spark, sf_dir).facts, "facts")
    first = materialize(distinct.numbered(facts.where("os = 1")), "numbers")
    return facts, materialize(first.unionByName(distinct.numbered(facts, first)), "numbers")


def distinct_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active and paying devices per app, plan and day, by bitmaps; the sets of one batch are merged twice."""
    facts, numbers = _device_sets(spark, sf_dir)
    out = None
    for kind, made in (("active", distinct.active), ("paying", distinct.paying)):
        halves = [made(facts.where(f"pmod(event_id, 2) = {i}"), numbers) for i in (0, 1, 1)]
        merged = distinct.union(halves[0].unionByName(halves[1]).unionByName(halves[2]), distinct.ACTIVE_KEYS)
        rows = distinct.counted(merged, distinct.ACTIVE_KEYS).withColumn("kind", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return present(out)


def distinct_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices of a cohort that came back, by bitmaps."""
    facts, numbers = _device_sets(spark, sf_dir)
    return present(distinct.counted(distinct.returning(facts, numbers), distinct.RETENTION_KEYS, "retention_count"))


def distinct_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices active within the last 1, 7 and 30 days."""
    facts, numbers = _device_sets(spark, sf_dir)
    return present(distinct.over_days(distinct.active(facts, numbers), (1, 7, 30)))


def pay_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(stats.pay_cohort(_step(spark, sf_dir).facts).drop(*FIRST))


def _attribution(where: str, dated: str = "true", **match) -> Query:
    """Every device of the platform with the level that matched it, 0 for none. Clicks for which `dated` doesn't hold
    lose their time."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        launches = given.app_events(spark, sf_dir).where(f"kind = '{LAUNCH}' AND {where}")
        firsts = materialize(timeline.first_launches(launches, launches_only=True), "firsts")
        clicks = given.clicks(spark, sf_dir).withColumn("click_ts", F.expr(f"CASE WHEN {dated} THEN click_ts END"))
        matched = attribution.match_clicks(firsts, clicks, **match)
        joined = firsts.join(matched.drop("os"), ["app_id", "device_id"], "left")
        return present(
            joined, "app_id", "device_id", "os", "ts AS active_time", "coalesce(level, 0) AS level", "click_id",
            "coalesce(plan_id, '0') AS plan_id", "coalesce(channel_id, '0') AS channel_id",
        )

    return query


CLICK_BATCHES = 5


def _click_index(spark: SparkSession, sf_dir: str, dated: str = "true") -> ClickIndex:
    """All given clicks, in batches that don't follow time, some clicks twice; small buckets and frequent bases."""
    index = ClickIndex(spark, f"{shared_dir(spark)}/clicks-{uuid.uuid4().hex}", buckets=8, compact_every=2)
    clicks = given.clicks(spark, sf_dir).withColumn("click_ts", F.expr(f"CASE WHEN {dated} THEN click_ts END"))
    for nr in range(CLICK_BATCHES):
        index.add(clicks.where(f"pmod(xxhash64(click_id), {CLICK_BATCHES}) IN ({nr}, {nr} DIV 2)"), nr)
    return index


def _indexed(dated: str) -> Query:
    """Every device with the level that matched it, from an index of clicks that came late and out of order."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        launches = given.app_events(spark, sf_dir).where(f"kind = '{LAUNCH}'")
        firsts = materialize(timeline.first_launches(launches, launches_only=True), "firsts")
        matched = attribution.match_clicks(firsts, _click_index(spark, sf_dir, dated).lookup())
        joined = firsts.join(matched.drop("os"), ["app_id", "device_id"], "left")
        return present(
            joined, "app_id", "device_id", "os", "ts AS active_time", "coalesce(level, 0) AS level", "click_id",
            "coalesce(plan_id, '0') AS plan_id", "coalesce(channel_id, '0') AS channel_id",
        )

    return query


def app_tables_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship, streamed, with the index in place of the click table, and device state in eight buckets."""
    index = _click_index(spark, sf_dir)
    raw = given.raw_payloads(spark, sf_dir)
    stream = replay(
        raw, STREAM_RUNS, lambda root: AppStream(spark, root, index.lookup, buckets=8, compact_every=2)
    )
    return present(stream.current(stream.daily).drop(*FIRST))


def _corrected(spark: SparkSession, sf_dir: str) -> CorrectedStream:
    """All messages and clicks in batches that don't follow time: launches, registrations, payments and clicks may each
    come before or after what they belong to."""
    root = f"{shared_dir(spark)}/corrected-{uuid.uuid4().hex}"
    index = ClickIndex(spark, f"{root}/clicks", buckets=4, compact_every=2)
    stream = CorrectedStream(spark, f"{root}/tables", index, buckets=4, compact_every=2)
    clicks = given.clicks(spark, sf_dir)
    # Dealt once: each text is made and hashed once, and a batch reads its own messages alone, in even pieces.
    dealt = given.raw_payloads(spark, sf_dir).selectExpr("kind", "value", f"pmod(xxhash64(value), {STREAM_RUNS}) AS nr")
    dealt.repartition("value").write.partitionBy("nr").parquet(f"{root}/inbox")
    for nr in range(STREAM_RUNS):
        index.add(clicks.where(f"pmod(xxhash64(click_id), {STREAM_RUNS}) = {nr}"), nr)
        messages = files.read_table(spark, f"{root}/inbox", f"{files.RAW_SCHEMA}, nr bigint").where(f"nr = {nr}")
        stream.process(messages.select("kind", "value"), nr)
    return stream


def _corrected_of(read: Callable[[CorrectedStream], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(read(_corrected(spark, sf_dir)))


def late_launch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of launches as they are after events and clicks have come in any order."""
    stream = _corrected(spark, sf_dir)
    wanted = ["event_id", "app_id", "device_id", "plan_id", "channel_id", "ts", "active_time", "prev_launch_time",
              "is_new", "new_today"]
    facts = stream.facts_of(stream.next_batch(), columns=wanted).where(f"kind = '{LAUNCH}'")
    return present(facts, *wanted)


def device_identity_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = payload.accepted(payload.app_events(given.raw_payloads(spark, sf_dir)))
    return present(events, "event_id", "kind", "app_id", "os", "device_id", "imei", "oaid", "androidid", "mac", "uuid", "idfa")


def device_identity_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with hashing switched off."""
    events = payload.accepted(payload.app_events(given.raw_payloads(spark, sf_dir), hash_ids=False))
    return present(events, "event_id", "kind", "app_id", "os", "device_id")


def payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = payload.accepted(payload.app_events(given.raw_payloads(spark, sf_dir)))
    return present(events, "event_id", "kind", "app_id", "os", "device_id", "ts", "ip", "external_ip", "amount")


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.rejected(payload.app_events(given.raw_payloads(spark, sf_dir)))


def platform_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.routes(payload.app_events(given.raw_payloads(spark, sf_dir)))


def launch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _step(spark, sf_dir).facts.where(f"kind = '{LAUNCH}'")
    return present(facts, "event_id", "app_id", "device_id", "plan_id", "channel_id", "ts", "active_time",
                   "prev_launch_time", "is_new", "new_today")


def reg_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _step(spark, sf_dir).facts.where(f"kind = '{REG}'")
    return present(facts, "event_id", "app_id", "device_id", "plan_id", "channel_id", "ts", "new_reg")


def pay_status_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _step(spark, sf_dir).facts.where(f"kind = '{PAY}'")
    return present(facts, "event_id", "app_id", "device_id", "plan_id", "ts", "pay_status", "amount")


def reg_pay_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_step(spark, sf_dir).rejects, "reason", "event_id", "kind", "app_id", "device_id", "ts")


def device_state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_step(spark, sf_dir).state)


def device_state_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.state_to_text(_step(spark, sf_dir).state).select("state_key", "state_value")


def app_onboarding_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(registry.funnel(_step(spark, sf_dir).facts))


def app_registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = registry.signals(_step(spark, sf_dir).facts)
    merged = registry.merge(given.app_registry(spark, sf_dir), seen)
    return present(merged, "app_id", "app_step", f"{registry.EVENT_TEXT} AS app_event")


def unknown_app_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of apps missing from the registry. Dealt to seven apps, some of the given events have none there."""
    tagged = given.app_events(spark, sf_dir, apps=7).selectExpr("*", "CAST(NULL AS string) AS reason")
    flagged = registry.flag_unknown_apps(tagged, given.app_registry(spark, sf_dir)).where("reason IS NOT NULL")
    return present(flagged, "reason", "event_id", "kind", "app_id", "device_id")


def event_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and rejects of events of which some lack device or time: together they are all events."""
    events = (
        given.app_events(spark, sf_dir)
        .withColumn("device_id", F.expr("CASE WHEN event_id % 7 <> 0 THEN device_id END"))
        .withColumn("ts", F.expr("CASE WHEN event_id % 11 <> 0 THEN ts END"))
    )
    step = timeline.step(events, given.clicks(spark, sf_dir))
    outcomes = step.facts.selectExpr("kind", "'fact' AS outcome").unionByName(
        step.rejects.selectExpr("kind", "reason AS outcome")
    )
    return outcomes.groupBy("kind", "outcome").agg(F.expr("count(1) AS n"))


def state_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device state to text and back, with dashes in the device ids."""
    dashed = "concat_ws('-', 'u', left(device_id, 8), substr(device_id, 9))"
    state = _step(spark, sf_dir).state.withColumn("device_id", F.expr(dashed))
    return present(timeline.state_from_text(timeline.state_to_text(state).select("state_key", "state_value")))


def log_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(tables.app_logs(_step(spark, sf_dir).facts))


def web_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_web(spark, sf_dir).facts, "event_id", "app_id", "media_clickid", "media_creativeid", "ts",
                   "active_time", "prev_launch_time", "is_new", "new_today")


def web_daily_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(stats.web_daily(_web(spark, sf_dir).facts).drop(*FIRST))


def web_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(stats.web_retention(_web(spark, sf_dir).facts).drop(*FIRST))


def web_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(tables.web_logs(_web(spark, sf_dir).facts))


def web_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_web(spark, sf_dir).state)


def web_payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = payload.web_events(given.raw_web_payloads(spark, sf_dir)).where("reason IS NULL")
    return present(tagged, "event_id", "app_id", "media_clickid", "media_creativeid", "plan_id", "channel_id", "ts")


STREAM_RUNS = 3


def _app_stream(raw: DataFrame, sf_dir: str) -> AppStream:
    spark = raw.sparkSession
    return replay(raw, STREAM_RUNS, lambda root: AppStream(spark, root, lambda: given.clicks(spark, sf_dir)))


def launch_daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Launch statistics of the launch topic, damaged messages included, streamed in three runs."""
    stream = _app_stream(given.raw_payloads(spark, sf_dir).where(f"kind = '{LAUNCH}'"), sf_dir)
    return present(stream.current(stream.daily), *_DAILY_KEY, *LAUNCH_COUNTS)


def app_tables_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship from all three topics, streamed in three runs."""
    stream = _app_stream(given.raw_payloads(spark, sf_dir), sf_dir)
    return present(stream.current(stream.daily).drop(*FIRST))


def retention_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _app_stream(given.raw_payloads(spark, sf_dir), sf_dir)
    return present(stream.current(stream.retention).drop(*FIRST))


def pay_cohort_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _app_stream(given.raw_payloads(spark, sf_dir), sf_dir)
    return present(stream.current(stream.pay_cohort).drop(*FIRST))


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _app_stream(given.raw_payloads(spark, sf_dir), sf_dir)
    return present(stream.current(stream.state))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages and events without an activation, by the event id in their text."""
    stream = _app_stream(given.raw_payloads(spark, sf_dir), sf_dir)
    event_id = """regexp_extract(raw, '"event_id":"?([0-9]+)', 1) AS event_id"""
    return stream.current(stream.rejects).selectExpr("reason", "kind", event_id)


def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship from messages without ids of their own, each delivered twice, an hour apart."""
    bare = given.raw_payloads(spark, sf_dir).selectExpr(
        "ts", "kind", """regexp_replace(value, ',"event_id":"[0-9]+"?', '') AS value""",
        """CAST(regexp_extract(value, '"event_id":"([0-9]+)', 1) AS bigint) AS position""",
    )
    twice = bare.selectExpr("*", "explode(array(0, 1)) AS nr").selectExpr(
        "ts + nr * INTERVAL 1 HOUR AS ts", "kind", "value", "2 * position + nr AS position",
    ).withColumn("arrival", F.col("ts"))
    stream = replay(
        twice, STREAM_RUNS, lambda root: AppStream(spark, root, lambda: given.clicks(spark, sf_dir)), redelivery="1 day"
    )
    return present(stream.current(stream.daily).drop(*FIRST))


def rejects_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with launches that arrive two days after registrations and payments of their time."""
    late = f"CASE WHEN kind = '{LAUNCH}' THEN ts + INTERVAL 2 DAYS ELSE ts END AS ts"
    stream = _app_stream(given.raw_payloads(spark, sf_dir).selectExpr(late, "kind", "value"), sf_dir)
    return present(stream.current(stream.daily).drop(*FIRST))


def _app_logs(events: DataFrame, clicks: DataFrame) -> dict[str, DataFrame]:
    """The app logs of some events, with the columns of the stored tables."""
    logs = materialize(tables.app_logs(timeline.step(events, clicks).facts), "logs")
    out = {}
    for name in stored.LOG_TIMES:
        sides = {
            os: logs.where(f"log = '{name}' AND os = {os}").selectExpr(
                "app_id AS appid", f"device_id AS {column}", f"ts AS {stored.LOG_TIMES[name]}", "plan_id", "channel_id",
                "event_id",
            )
            for os, column in stored.LOG_DEVICES.items()
        }
        out[name] = stored.app_log(name, *sides.values())
    return out


def _two_halves(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The logs of the earlier half of the days, and the messages of the later half."""
    events, clicks = given.app_events(spark, sf_dir), given.clicks(spark, sf_dir)
    half = "timestampadd(MICROSECOND, timestampdiff(MICROSECOND, min(ts), max(ts)) DIV 2, min(ts))"
    cut = given.table(spark, sf_dir, "events").selectExpr(f"CAST(to_date({half}) AS string)").first()[0]
    logs = _app_logs(events.where(f"ts < TIMESTAMP_NTZ '{cut} 00:00:00'"), clicks)
    return logs, given.raw_payloads(spark, sf_dir).where(f"ts >= TIMESTAMP_NTZ '{cut} 00:00:00'")


def stream_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics of the later half of the days, streamed on state rebuilt from the logs of the earlier half."""
    logs, later = _two_halves(spark, sf_dir)
    initial = stored.split_incomplete(stored.state_from_logs(*logs.values()))[0]
    stream = replay(later, 2, lambda root: AppStream(spark, root, lambda: given.clicks(spark, sf_dir), initial=initial))
    return present(stream.current(stream.daily).drop(*FIRST))


def stream_log_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a seed: devices that state lacks are looked up in the logs, batch by batch."""
    logs, later = _two_halves(spark, sf_dir)
    history = lambda devices: stored.state_of(devices, *logs.values())
    stream = replay(later, 2, lambda root: AppStream(spark, root, lambda: given.clicks(spark, sf_dir), history=history))
    return present(stream.current(stream.daily).drop(*FIRST))


def log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activations without a launch in the logs, here those of organic devices, whose launches are left out."""
    logs = _app_logs(given.app_events(spark, sf_dir), given.clicks(spark, sf_dir))
    logs["launch"] = logs["launch"].where("plan_id <> '0'")
    rejects = stored.split_incomplete(stored.state_from_logs(*logs.values()))[1]
    return present(rejects, "reason", "app_id", "device_id", "active_time")


def web_retention_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = replay(given.raw_web_payloads(spark, sf_dir), STREAM_RUNS, lambda root: WebStream(spark, root))
    return present(stream.current(stream.retention).drop(*FIRST))


def web_daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = replay(given.raw_web_payloads(spark, sf_dir), STREAM_RUNS, lambda root: WebStream(spark, root))
    return present(stream.current(stream.daily).drop(*FIRST))


def state_from_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device state rebuilt from the log tables alone."""
    logs = materialize(tables.app_logs(_step(spark, sf_dir).facts), "logs")
    parts = {name: logs.where(f"log = '{name}'") for name in tables.APP_LOGS}
    state = stored.state_from_logs(parts["active"], parts["launch"], parts["reg_first"], parts["pay"])
    return present(stored.split_incomplete(state)[0])


def registered() -> dict[str, Query]:
    return {
        "daily_base_full": daily_base_full,
        "launch_daily_base": launch_daily_base,
        "retention_cohort": retention_cohort,
        "reg_daily": _daily_of(REG, REG_COUNTS),
        "pay_daily_base": _daily_of(PAY, PAY_COUNTS),
        "pay_cohort": pay_cohort,
        "statistics_at_once": statistics_at_once,
        "distinct_devices": distinct_devices,
        "distinct_retention": distinct_retention,
        "distinct_over_days": distinct_over_days,
        "app_signals_at_once": app_signals_at_once,
        "daily_base_rollup": daily_base_rollup,
        "pay_cohort_rollup": pay_cohort_rollup,
        "attribution_android": _attribution("os = 1"),
        "attribution_ios": _attribution("os = 2"),
        "attribution_lookback": _attribution("true", lookback_days=2),
        "attribution_dirty_clicks": _attribution("true", "click_id % 3 <> 0"),
        "attribution_indexed": _indexed("true"),
        "attribution_indexed_dirty": _indexed("click_id % 3 <> 0"),
        "app_tables_indexed": app_tables_indexed,
        "daily_any_order": _corrected_of(lambda s: s.current(s.daily).drop(*FIRST)),
        "retention_any_order": _corrected_of(lambda s: s.current(s.retention).drop(*FIRST)),
        "pay_cohort_any_order": _corrected_of(lambda s: s.current(s.pay_cohort).drop(*FIRST)),
        "late_launch_facts": late_launch_facts,
        "event_accounting": event_accounting,
        "state_text_round_trip": state_text_round_trip,
        "retention_stream": retention_stream,
        "pay_cohort_stream": pay_cohort_stream,
        "stream_state": stream_state,
        "stream_rejects": stream_rejects,
        "stream_redelivered": stream_redelivered,
        "stream_from_history": stream_from_history,
        "stream_log_fallback": stream_log_fallback,
        "log_rejects": log_rejects,
        "rejects_recovered": rejects_recovered,
        "web_retention_stream": web_retention_stream,
        "payload_parse": payload_parse,
        "payload_rejects": payload_rejects,
        "platform_route": platform_route,
        "device_identity_md5": device_identity_md5,
        "device_identity_clear": device_identity_clear,
        "launch_facts": launch_facts,
        "reg_first": reg_first,
        "pay_status_bits": pay_status_bits,
        "reg_pay_rejects": reg_pay_rejects,
        "device_state_snapshot": device_state_snapshot,
        "device_state_text": device_state_text,
        "app_onboarding_funnel": app_onboarding_funnel,
        "app_registry_merge": app_registry_merge,
        "unknown_app_rejects": unknown_app_rejects,
        "log_union": log_union,
        "web_payload_parse": web_payload_parse,
        "web_facts": web_facts,
        "web_daily_base": web_daily_base,
        "web_retention": web_retention,
        "web_logs": web_logs,
        "web_state": web_state,
        "state_from_logs": state_from_logs,
        "launch_daily_stream": launch_daily_stream,
        "app_tables_stream": app_tables_stream,
        "web_daily_stream": web_daily_stream,
    }
