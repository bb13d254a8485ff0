import pytest

from cohortrail.operators import skew, timeline
from cohortrail.plans import tables
from cohortrail.schemas import CLICK, WEB_EVENT
from cohortrail.session import shared_dir
from cohortrail.sources import files, jdbc, kafka, payload, stored
from tests.build import at, click, clicks_frame, event, events_frame


def test_queue_options():
    got = kafka.options("h1:1,h2:2", ["launch", "reg"], max_offsets_per_trigger=10, extra={"kafka.security.protocol": "SSL"})
    assert got == {
        "kafka.bootstrap.servers": "h1:1,h2:2",
        "subscribe": "launch,reg",
        "startingOffsets": "latest",
        "kafka.receive.buffer.bytes": "65536",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "10",
        "kafka.security.protocol": "SSL",
    }


def test_queue_rows_have_the_raw_columns(spark):
    message = spark.sql(
        "SELECT 'reg' AS topic, CAST('{}' AS binary) AS value, TIMESTAMP '2024-01-01 08:00:00' AS timestamp, 2 AS partition,"
        " 5L AS offset"
    ).selectExpr(*kafka.RAW_COLUMNS)
    row = message.first()
    assert (row["kind"], row["value"], row["arrival"], row["position"]) == ("reg", "{}", at("1 08:00"), 2 * 2**40 + 5)


def test_jdbc_options():
    assert jdbc.read_options("u", "t", "id", (0, 100), 4)["numPartitions"] == "4"
    assert jdbc.write_options("u", "t")["batchsize"] == "5000"
    with pytest.raises(ValueError):
        jdbc.read_options("u", "t", "id")


def test_stored_click_tables(spark):
    android = spark.sql("SELECT 1L AS click_id, TIMESTAMP_NTZ '2024-01-01 08:00:00' AS click_ts, 'i' AS imei_md5,"
                        " 'o' AS oaid_md5, 'a' AS androidid_md5, 'm' AS mac_md5, '1.1' AS ip, 7 AS plan_id, 1 AS channel_id")
    ios = spark.sql("SELECT 2L AS click_id, TIMESTAMP_NTZ '2024-01-01 09:00:00' AS click_ts, 'f' AS idfa_md5,"
                    " '2.2' AS external_ip, 8 AS plan_id, 2 AS channel_id")
    both = stored.clicks(android, ios)
    assert both.columns == CLICK.fieldNames()
    got = {r["os"]: (r["imei"], r["mac"], r["idfa"], r["external_ip"], r["plan_id"]) for r in both.collect()}
    assert got == {1: ("i", "m", None, "1.1", "7"), 2: (None, None, "f", "2.2", "8")}
    assert stored.clicks(ios=ios).count() == 1
    with pytest.raises(ValueError):
        stored.clicks(android.drop("click_ts"))
    assert stored.clicks(android.drop("click_ts"), undated=True).first()["click_ts"].year == 1


def test_jdbc_deletes_a_batch_before_it_is_appended():
    assert jdbc.delete_batch("t", 7) == "DELETE FROM t WHERE batch_id = 7"


def test_activation_without_launch_is_set_apart(spark):
    facts = timeline.step(events_frame(spark, [event("launch", "d", "1 08:00"), event("launch", "e", "1 08:00")]),
                          clicks_frame(spark)).facts
    logs = tables.app_logs(facts).persist()
    parts = {n: logs.where(f"log = '{n}'") for n in tables.APP_LOGS}
    first = logs.where("log = 'launch'").orderBy("device_id").first()["device_id"]
    state = stored.state_from_logs(parts["active"], parts["launch"].where(f"device_id <> '{first}'"),
                                   parts["reg_first"], parts["pay"])
    good, bad = stored.split_incomplete(state)
    assert good.count() == 1
    assert [(r["reason"], r["device_id"]) for r in bad.collect()] == [("no_launch", first)]


def test_declared_schema_prunes_the_scan(spark, tmp_path):
    clicks_frame(spark, [click("P", "1 08:00", external_ip="x")]).write.parquet(str(tmp_path / "c"))
    read = files.read_table(spark, str(tmp_path / "c"), CLICK).where("os = 1").select("plan_id")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<os:int,plan_id:string>" in plan and "EqualTo(os,1)" in plan


def test_hot_keys(spark, monkeypatch):
    rows = spark.range(100).selectExpr("CAST(CASE WHEN id < 60 THEN 0 WHEN id < 90 THEN 1 ELSE id END AS string) AS k")
    hot = skew.hot_keys(rows, ["k"], 30)
    assert hot.few and sorted(r["k"] for r in hot.rows.collect()) == ["0", "1"]
    assert skew.hot_keys(rows, ["k"], 61) is None
    monkeypatch.setattr(skew, "MAX_HOT", 1)
    hot = skew.hot_keys(rows, ["k"], 30)
    assert not hot.few and sorted(r["k"] for r in hot.rows.collect()) == ["0", "1"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_unique_equals_plain_join(spark, how):
    rows = spark.range(200).selectExpr("CASE WHEN id < 120 THEN 0 ELSE id % 7 END AS k", "id")
    rows = rows.unionByName(spark.range(50).selectExpr("99 AS k", "id + 1000 AS id"))
    unique = spark.range(5).selectExpr("id AS k", "id * 10 AS v")
    want = sorted(rows.join(unique, "k", how).collect())
    hot = skew.hot_keys(rows, ["k"], 40)
    assert {r["k"] for r in hot.rows.collect()} == {0, 99}
    assert sorted(skew.join_unique(rows, unique, ["k"], how, hot).collect()) == want


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_messages_are_parsed_once(spark):
    raw = spark.createDataFrame([("launch", "{}")], files.RAW_SCHEMA)
    for kept in (payload.accepted(payload.app_events(raw)), payload.rejected(payload.app_events(raw)),
                 payload.accepted(payload.web_events(raw), WEB_EVENT)):
        assert kept._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
