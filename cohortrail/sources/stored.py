"""Stored click and log tables in their original column names, read into the engine's schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.schemas import ANDROID, CLICK, DEVICE_KEYS, DEVICE_STATE, IOS


# The time of clicks that precede every launch.
BEFORE_ALL = "TIMESTAMP_NTZ '0001-01-01 00:00:00'"


def clicks(android: DataFrame | None = None, ios: DataFrame | None = None, undated: bool = False) -> DataFrame:
    """Click tables of both platforms as one. `click_id` and `click_ts` order the clicks of a key.

    A table must have the column `click_ts`, unless `undated` says that all clicks of such a table precede all
    launches.
    """
    sides = {
        ANDROID: (android, {"imei": "imei_md5", "oaid": "oaid_md5", "androidid": "androidid_md5",
                            "mac": "mac_md5", "external_ip": "ip"}),
        IOS: (ios, {"idfa": "idfa_md5", "external_ip": "external_ip"}),
    }
    out = None
    for os, (rows, renamed) in sides.items():
        if rows is None:
            continue
        values = {"os": str(os), **renamed}
        if "click_ts" not in rows.columns:
            if not undated:
                raise ValueError("a click table without click_ts needs undated=True")
            values["click_ts"] = BEFORE_ALL
        part = rows.selectExpr(
            *[
                f"CAST({values.get(f.name, f.name if f.name in rows.columns else 'NULL')}"
                f" AS {f.dataType.simpleString()}) AS {f.name}"
                for f in CLICK
            ]
        )
        out = part if out is None else out.unionByName(part)
    return out


# Columns of the stored log tables: the device per platform, and the time per log (fixed values).
LOG_DEVICES = {ANDROID: "oaid_md5", IOS: "uuid_md5"}
LOG_TIMES = {"active": "active_time", "launch": "launch_time", "reg_first": "reg_time", "pay": "pay_time"}


def app_log(name: str, android: DataFrame | None = None, ios: DataFrame | None = None) -> DataFrame:
    """One of the app logs as stored, both platforms as one: `app_id, device_id, ts, event_id, plan_id, channel_id`.

    The stored tables have no event id; activations of one device at the same time are ordered by plan and channel.
    """
    out = None
    for os, rows in ((ANDROID, android), (IOS, ios)):
        if rows is not None:
            part = rows.selectExpr(
                "CAST(appid AS string) AS app_id",
                f"{LOG_DEVICES[os]} AS device_id",
                f"CAST({LOG_TIMES[name]} AS timestamp_ntz) AS ts",
                f"{'event_id' if 'event_id' in rows.columns else 'CAST(NULL AS bigint)'} AS event_id",
                *[c if c in rows.columns else f"CAST(NULL AS string) AS {c}" for c in ("plan_id", "channel_id")],
            )
            out = part if out is None else out.unionByName(part)
    return out


def web_state_from_logs(active: DataFrame, launch: DataFrame) -> DataFrame:
    """State of the web clicks from the stored web logs: first activation and last launch per click id."""
    first = active.groupBy("media_clickid").agg(F.expr("min(CAST(log_time AS timestamp_ntz)) AS active_time"))
    last = launch.groupBy("media_clickid").agg(F.expr("max(CAST(log_time AS timestamp_ntz)) AS last_launch_time"))
    return first.join(last, "media_clickid", "left")


def state_from_logs(active: DataFrame, launch: DataFrame, reg_first: DataFrame, pay: DataFrame) -> DataFrame:
    """Rebuild device state from the log tables: earliest activation with its plan, latest launch, payments.

    The four logs are tagged and aggregated together, one shuffle in all. A device with an activation but no launch
    comes out with a null `last_launch_time`; `split_incomplete` sets such rows apart.
    """
    ts = "CAST({} AS timestamp_ntz) AS {}"

    def part(rows: DataFrame, column: str, time: str, *more: str) -> DataFrame:
        return rows.selectExpr(*DEVICE_KEYS, ts.format(time, column), *more)

    parts = [
        part(active, "a", "ts", "event_id", "plan_id", "channel_id"),
        part(launch, "l", "ts"),
        part(reg_first, "r", "ts"),
        part(pay, "p", "ts"),
    ]
    line = parts[0]
    for p in parts[1:]:
        line = line.unionByName(p, allowMissingColumns=True)
    rebuilt = (
        line.groupBy(*DEVICE_KEYS)
        .agg(
            F.expr("min(struct(a, event_id, plan_id, channel_id)) FILTER (WHERE a IS NOT NULL) AS first"),
            F.expr("max(l) AS last_launch_time"),
            F.expr("count(r) > 0 AS registered"),
            F.expr("min(p) AS first_pay_time"),
            F.expr("to_date(max(p)) AS last_pay_date"),
        )
        .where("first IS NOT NULL")
        .selectExpr("*", "first.a AS active_time", "first.plan_id AS plan_id", "first.channel_id AS channel_id")
    )
    return rebuilt.select(*DEVICE_STATE.fieldNames())


# Device ids up to this number are named in the scan of a log; more of them only by a join.
NAMED_IDS = 1_000


def state_of(
    devices: DataFrame, active: DataFrame, launch: DataFrame, reg_first: DataFrame, pay: DataFrame
) -> DataFrame:
    """`state_from_logs` for some devices alone (`app_id, device_id`, at most a row each), without reading all logs.

    The ids of few devices become a filter of the scan: of log files sorted by device id, the reader skips whatever lies
    outside. Of the rest, rows of other devices are dropped before anything is shuffled. Devices without an activation in
    the logs are not in the result, nor are those without a launch.
    """
    ids = [r.device_id for r in devices.select("device_id").distinct().limit(NAMED_IDS + 1).collect()]
    keys = devices.select(*DEVICE_KEYS)
    if len(ids) <= NAMED_IDS:
        keys = F.broadcast(keys)

    def of_devices(log: DataFrame) -> DataFrame:
        if len(ids) <= NAMED_IDS:
            log = log.where(F.col("device_id").isin(ids))
        return log.join(keys, DEVICE_KEYS, "left_semi")

    rebuilt = state_from_logs(*map(of_devices, (active, launch, reg_first, pay)))
    return split_incomplete(rebuilt)[0]


def split_incomplete(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable state, and rejects with reason `no_launch`."""
    bad = state.where("last_launch_time IS NULL").selectExpr("'no_launch' AS reason", "*")
    return state.where("last_launch_time IS NOT NULL"), bad
