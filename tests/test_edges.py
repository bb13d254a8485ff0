"""The numbered edge cases of FIXTURES.md."""

from decimal import Decimal

import pytest

from cohortrail.functions.scalars import EMPTY_MD5, ZERO_IDFA_MD5
from cohortrail.operators import attribution, registry, stats, timeline
from cohortrail.schemas import APP_REGISTRY, LAUNCH_PAYLOAD
from cohortrail.sources import payload
from tests.build import at, click, clicks_frame, event, events_frame, md5, web, web_frame


def step(spark, events, clicks=(), state=None, **options):
    return timeline.step(events_frame(spark, events), clicks_frame(spark, clicks), state, **options)


def daily(facts):
    return {r["stat_date"].day: r.asDict() for r in stats.daily(facts).collect()}


def counts(row):
    return row["launch_count"], row["active_count"], row["vibrant_count"]


def plans(step_result):
    return {r["device_id"]: r["plan_id"] for r in step_result.state.collect()}


def test_launches_over_days(spark):  # 1-4
    events = [event("launch", "d", w) for w in ("1 08:00", "1 09:00", "2 08:00", "2 09:00", "7 08:00")]
    facts = step(spark, events).facts.persist()
    got = daily(facts)
    assert counts(got[1]) == (2, 1, 1)
    assert counts(got[2]) == (2, 0, 1)
    assert counts(got[7]) == (1, 0, 1)
    kept = {r["retention_days"]: r["retention_count"] for r in stats.retention(facts).collect()}
    assert kept == {2: 1, 7: 1}


def test_attribution_levels(spark):  # 5-12
    events = [
        event("launch", "a", "2 08:00", imei=md5("i-a"), external_ip="9.9.9.1"),
        event("launch", "b", "2 08:00", os=2, idfa=md5("f-b"), external_ip="9.9.9.2"),
        event("launch", "c", "2 08:00", os=2, idfa=ZERO_IDFA_MD5, external_ip="9.9.9.30"),
        event("launch", "m", "2 08:00", mac=md5("02:00"), external_ip="9.9.9.31"),
        event("launch", "n", "2 08:00", external_ip="9.9.9.32"),
        event("launch", "t", "2 08:00", external_ip="9.9.9.4"),
        event("launch", "l", "2 08:00", external_ip="9.9.9.5"),
        event("launch", "e", "2 08:00", imei=EMPTY_MD5, androidid="", external_ip=""),
    ]
    clicks = [
        click("A", "1 08:00", imei=md5("i-a")),
        click("B", "1 07:00", external_ip="9.9.9.1"),
        click("A", "1 08:00", os=2, external_ip="9.9.9.2"),
        click("B", "1 07:00", os=2, idfa=md5("f-b")),
        click("Z", "1 08:00", os=2, idfa=ZERO_IDFA_MD5),
        click("M", "1 08:00", mac=md5("02:00")),
        click("late tie", "1 08:00", click_id=900_000_002, external_ip="9.9.9.4"),
        click("early tie", "1 08:00", click_id=900_000_001, external_ip="9.9.9.4"),
        click("after", "2 08:01", external_ip="9.9.9.5"),
        click("E", "1 08:00", imei=EMPTY_MD5, androidid="", external_ip=""),
        click("N", "1 08:00"),
    ]
    want = {"a": "A", "b": "A", "c": "0", "m": "0", "n": "0", "t": "early tie", "l": "0", "e": "0"}
    for options in ({}, {"hot_rows": 1, "few_keys": 0}, {"lookback_days": 7}, {"lookback_days": 7, "few_keys": 0}):
        assert plans(step(spark, events, clicks, **options)) == {md5(k): v for k, v in want.items()}


def test_lookback_bound_is_inclusive(spark):
    events = [event("launch", d, "9 08:00", external_ip=f"ip-{d}") for d in ("in", "out", "next")]
    clicks = [
        click("P", "2 08:00", external_ip="ip-in"),
        click("P", "2 07:59", external_ip="ip-out"),
        click("old", "1 08:00", external_ip="ip-next"),
        click("new", "5 08:00", external_ip="ip-next"),
    ]
    assert plans(step(spark, events, clicks, lookback_days=7)) == {md5("in"): "P", md5("out"): "0", md5("next"): "new"}


def test_same_app_clicks_only_on_request(spark):
    events = [event("launch", "d", "2 08:00", external_ip="x")]
    clicks = clicks_frame(spark, [click("P", "1 08:00", external_ip="x")]).selectExpr("*", "'50' AS app_id")
    frame = events_frame(spark, events)
    assert plans(timeline.step(frame, clicks)) == {md5("d"): "P"}
    assert plans(timeline.step(frame, clicks, click_keys=("app_id",))) == {md5("d"): "0"}
    assert plans(timeline.step(frame, clicks, click_keys=("app_id",), lookback_days=7)) == {md5("d"): "0"}


def test_known_device_keeps_its_plan(spark):  # 13
    first = step(spark, [event("launch", "d", "1 08:00", external_ip="x")]).state.persist()
    later = step(spark, [event("launch", "d", "3 08:00", external_ip="x")],
                 [click("new", "2 08:00", external_ip="x")], first)
    assert plans(later) == {md5("d"): "0"}
    assert counts(daily(later.facts)[3]) == (1, 0, 1)


def test_registrations_and_rejects(spark):  # 14-16
    events = [
        event("launch", "d", "1 08:00"),
        event("reg", "d", "1 09:00"),
        event("reg", "d", "1 10:00"),
        event("reg", "x", "1 09:00", event_id=501),
        event("pay", "x", "1 09:00", amount="1.00", event_id=502),
        event("pay", "d", "1 07:59", amount="1.00", event_id=503),
        event("pay", "d", "1 08:00", amount="2.00"),
    ]
    result = step(spark, events)
    row = daily(result.facts)[1]
    assert (row["reg_count"], row["onlyreg_count"], row["pay_count"], row["pay_amount"]) == (2, 1, 1, Decimal("2.00"))
    assert {(r["reason"], r["event_id"]) for r in result.rejects.collect()} == {("no_activation", i) for i in (501, 502, 503)}
    cohort = stats.pay_cohort(result.facts).collect()
    assert [(r["pay_days"], r["pay_active_count"], r["pay_new_devices"]) for r in cohort] == [(1, 1, 1)]


def test_payment_status(spark):  # 17, 18
    events = [event("launch", "d", "1 08:00")] + [
        event("pay", "d", w, amount="1.50") for w in ("1 09:00", "1 10:00", "2 09:00")
    ]
    facts = step(spark, events).facts.persist()
    pays = facts.where("kind = 'pay'").orderBy("ts").collect()
    assert [r["pay_status"] for r in pays] == [4, 7, 1]
    rows = {r["pay_days"]: r for r in stats.pay_cohort(facts).collect()}
    assert sum(r["pay_new_devices"] for r in rows.values()) == 1
    assert sum(r["pay_total_devices"] for r in rows.values()) == 2
    assert sum(r["pay_active_count"] for r in rows.values()) == 2
    assert rows[1]["pay_active_amount"] == Decimal("3.00")
    day_two = daily(facts)[2]
    assert counts(day_two) == (0, 0, 0) and day_two["pay_count"] == 1


def test_damaged_messages_cost_only_themselves(spark):  # 19
    good = '{"appid":"49","os":"1","imei":"i","oaid":"o","ts":"2024-01-01 08:00:00","event_id":"1","future":"x"}'
    bad = {
        "json": ['{"appid":"49"', "not json", None],
        "platform": [good.replace('"os":"1"', '"os":"3"'), good.replace('"os":"1"', '"os":"one"')],
        "identity": [good.replace('"oaid"', '"other"')],
        "app": [good.replace('"appid":"49",', "")],
        "time": [good.replace("2024-01-01", "never")],
        "event_id": [good.replace('"event_id":"1"', '"event_id":"one"')],
    }
    rows = [("launch", good)] + [("launch", t) for texts in bad.values() for t in texts]
    rows.append(("pay", good.replace('"os"', '"amount":"much","os"')))
    tagged = payload.app_events(spark.createDataFrame(rows, "kind string, value string"), keep_extra=True)
    got = {}
    for r in tagged.collect():
        got[r["reason"]] = got.get(r["reason"], 0) + 1
    assert got == {None: 1, "amount": 1, **{reason: len(texts) for reason, texts in bad.items()}}
    kept = payload.accepted(tagged).first()
    assert (kept["device_id"], kept["imei"], kept["os"], kept["ts"]) == (md5("o"), md5("i"), 1, at("1 08:00"))
    assert tagged.where("reason IS NULL").first()["extra"] == {"future": "x"}
    assert payload.rejected(tagged).columns == ["reason", "kind", "raw"]


def test_numbers_as_json_numbers(spark):
    text = '{"appid":49,"os":1,"oaid":"o","amount":6.5,"ts":"2024-01-01 08:00:00","event_id":1}'
    row = payload.accepted(payload.app_events(spark.createDataFrame([("pay", text)], "kind string, value string"))).first()
    assert (row["app_id"], row["os"], row["amount"], row["event_id"]) == ("49", 1, Decimal("6.50"), 1)


def test_queue_fills_missing_time_and_id(spark):
    raw = spark.sql(
        "SELECT 'launch' AS kind, '{\"appid\":\"49\",\"os\":\"1\",\"oaid\":\"o\"}' AS value,"
        " TIMESTAMP_NTZ '2024-01-05 06:00:00' AS arrival, 77L AS position"
    )
    row = payload.accepted(payload.app_events(raw)).first()
    assert (row["ts"], row["event_id"]) == (at("5 06:00"), 77)


def test_unknown_app_is_rejected(spark):  # 19
    rows = [event("launch", "d", "1 08:00", app=a) for a in ("49", "50")]
    tagged = events_frame(spark, rows).selectExpr("*", "CAST(NULL AS string) AS reason")
    known = spark.createDataFrame([("49", 1, (0, 0, 0))], APP_REGISTRY)
    for hot_rows in (2_000_000, 1):
        got = registry.flag_unknown_apps(tagged, known, hot_rows)
        assert {(r["app_id"], r["reason"]) for r in got.collect()} == {("49", None), ("50", "app")}


def test_same_id_in_two_apps(spark):  # 20
    result = step(spark, [event("launch", "d", "1 08:00", app=a) for a in ("49", "50")])
    assert result.state.count() == 2
    assert all(counts(r) == (1, 1, 1) for r in (x.asDict() for x in stats.daily(result.facts).collect()))


def test_onboarding(spark):  # 21
    events = [event("launch", "d", "1 08:00", app=a) for a in ("only", "all", "done", "half")]
    events += [event("reg", "d", "1 09:00", app=a) for a in ("all", "half")]
    events += [event("pay", "d", "1 09:00", amount="1", app="all")]
    facts = step(spark, events).facts
    initial = spark.createDataFrame(
        [("only", 0, (0, 0, 0)), ("all", 1, (0, 0, 0)), ("done", 3, (1, 0, 1)), ("half", 2, (0, 0, 1)), ("idle", 1, (0, 1, 0))],
        APP_REGISTRY,
    )
    merged = registry.merge(initial, registry.signals(facts))
    got = {r["app_id"]: (r["app_step"], tuple(r["app_event"])) for r in merged.collect()}
    assert got == {"only": (2, (1, 0, 0)), "all": (3, (1, 1, 1)), "done": (3, (1, 0, 1)), "half": (3, (1, 1, 1)),
                   "idle": (1, (0, 1, 0))}
    funnel = {r["app_id"]: r["app_step"] for r in registry.funnel(facts).collect()}
    assert funnel == {"only": 2, "all": 3, "done": 2, "half": 2}


def test_web_cohorts_stay_apart(spark):  # 22
    rows = [
        web("c1", "cr", "1 08:00"), web("c1", "cr", "2 08:00"), web("c1", "cr", "2 09:00"),
        web("c2", "cr", "2 08:00", plan="8"), web("c2", "cr", "3 08:00"),
    ]
    for hot_rows in (2_000_000, 2):
        facts = timeline.web_step(web_frame(spark, rows), hot_rows=hot_rows).facts.persist()
        kept = {(r["active_date"].day, r["retention_days"]): r["retention_count"] for r in stats.web_retention(facts).collect()}
        assert kept == {(1, 2): 1, (2, 2): 1}
        got = {r["stat_date"].day: counts(r) for r in stats.web_daily(facts).collect()}
        assert got == {1: (1, 1, 1), 2: (3, 1, 2), 3: (1, 0, 1)}
        assert {r["plan_id"] for r in stats.web_daily(facts).where("day(stat_date) = 2").collect()} == {"7"}


@pytest.mark.parametrize("hot_rows", [2_000_000, 1])
def test_equal_times_follow_event_id(spark, hot_rows):  # 25
    events = [
        event("launch", "d", "1 08:00", event_id=12, external_ip="late"),
        event("launch", "d", "1 08:00", event_id=11, external_ip="x"),
    ]
    result = step(spark, events, [click("P", "1 07:00", external_ip="x")], hot_rows=hot_rows)
    assert plans(result) == {md5("d"): "P"}
    assert {r["event_id"]: r["is_new"] for r in result.facts.collect()} == {11: 1, 12: 0}


def test_late_launch_counts_as_launch_only(spark):  # 26
    state = step(spark, [event("launch", "d", "1 08:00"), event("launch", "d", "5 08:00")]).state.persist()
    result = step(spark, [event("launch", "d", "3 08:00"), event("launch", "d", "5 09:00")], state=state)
    facts = result.facts.persist()
    got = daily(facts)
    assert counts(got[3]) == (1, 0, 0) and counts(got[5]) == (1, 0, 0)
    assert {r["stat_date"].day: r["late"] for r in facts.collect()} == {3: 1, 5: 0}
    assert stats.retention(facts).count() == 0
    assert result.state.first()["last_launch_time"] == at("5 09:00")


def test_state_text_round_trip(spark):
    state = step(spark, [event("launch", "d", "1 08:00", app="a-b"), event("launch", "d", "2 09:00", app="a-b")]).state
    text = timeline.state_to_text(state).first()
    assert text["state_key"] == f"a-b-{md5('d')}"
    assert text["state_value"] == ('{"activetime":"2024-01-01 08:00:00","launchtime":"2024-01-02 09:00:00",'
                                   '"planid":"0","channelid":"0"}')
    back = timeline.state_from_text(timeline.state_to_text(state)).first()
    assert (back["app_id"], back["device_id"], back["active_time"], back["last_launch_time"]) == (
        "a-b", md5("d"), at("1 08:00"), at("2 09:00"))


def test_dashed_device_ids_survive_the_text(spark):
    state = step(spark, [event("launch", "d", "1 08:00", device_id="u-1-2")]).state
    text = timeline.state_to_text(state)
    for exported in (text, text.select("state_key", "state_value")):
        back = timeline.state_from_text(exported).first()
        assert (back["app_id"], back["device_id"]) == ("49", "u-1-2")


def test_a_click_without_time_hides_no_other(spark):
    undated = click("A", "1 06:00", imei="i") | {"click_ts": None}
    clicks = clicks_frame(spark, [undated, click("B", "1 07:00", imei="i")])
    launch = events_frame(spark, [event("launch", "d", "1 08:00", imei="i")])
    assert timeline.step(launch, clicks).facts.first()["plan_id"] == "B"
    assert attribution.undated_clicks(clicks).count() == 1


def test_events_without_device_or_time_are_rejects(spark):
    rows = [event("launch", "d", "1 08:00"), event("launch", "e", "1 08:00") | {"device_id": None},
            event("pay", "d", "1 09:00", amount="1") | {"ts": None}, event("reg", "d", "1 09:00") | {"app_id": None}]
    done = timeline.step(events_frame(spark, rows), clicks_frame(spark))
    assert done.facts.count() == 1
    assert sorted(r["reason"] for r in done.rejects.collect()) == ["app", "identity", "time"]
    rows = [web("c", "x", "1 08:00"), web(None, "x", "1 08:00"), web("c", "x", "1 09:00") | {"ts": None}]
    done = timeline.web_step(web_frame(spark, rows))
    assert done.facts.count() == 1
    assert sorted(r["reason"] for r in done.rejects.collect()) == ["identity", "time"]


def test_look_back_frames_start_with_the_partition(spark):
    launch = events_frame(spark, [event("launch", "d", "1 08:00", imei="i")])
    firsts = timeline.first_launches(launch)
    matched = attribution.match_clicks(firsts, clicks_frame(spark, [click("A", "1 07:00", imei="i")]), lookback_days=2)
    plan = matched._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe" in plan and "unboundedfollowing" not in plan.lower().replace(" ", "").replace("$()", "")


def test_schema_covers_declared_payloads():
    assert {"appid", "os", "imei", "oaid", "uuid", "idfa", "externalip"} <= set(LAUNCH_PAYLOAD.fieldNames())
