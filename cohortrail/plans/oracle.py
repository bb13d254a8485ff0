"""DuckDB statements that give the expected rows of the registered queries.

They follow the per-event rules with windows over single events, a different route from the one the operators take.
"""

from __future__ import annotations

ZERO_IDFA = "00000000-0000-0000-0000-000000000000"

# The given events as app events, clicks and raw fields.
BASE = f"""
src AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(user_id AS VARCHAR) AS usr, CAST(user_id % 3 AS VARCHAR) AS app_id,
         CASE WHEN user_id % 5 = 0 THEN 2 ELSE 1 END AS os,
         CASE WHEN user_id % 4 = 3 THEN '{ZERO_IDFA}' ELSE CAST(user_id AS VARCHAR) END AS idfa_raw
  FROM events),
ev AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS d, app_id, os, md5(usr) AS device_id, k,
         CASE event_type WHEN 'view' THEN 'launch' WHEN 'signup' THEN 'reg' ELSE 'pay' END AS kind,
         CASE WHEN os = 1 THEN md5(usr) END AS imei, CASE WHEN os = 1 THEN md5(usr) END AS oaid,
         CASE WHEN os = 1 THEN md5(usr) END AS androidid, CASE WHEN os = 1 THEN md5('02:00') END AS mac,
         CASE WHEN os = 2 THEN md5(usr) END AS uuid, CASE WHEN os = 2 THEN md5(idfa_raw) END AS idfa,
         '10.0.0.' || k AS ip, '9.9.9.' || k AS external_ip, CASE WHEN os = 2 THEN 'm' END AS model,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS amount
  FROM src WHERE event_type IN ('view', 'signup', 'purchase')),
clk AS (
  SELECT event_id AS click_id, ts AS click_ts, os,
         CASE WHEN os = 1 AND user_id % 4 = 0 THEN md5(usr) END AS imei,
         CASE WHEN os = 1 AND user_id % 4 = 1 THEN md5(usr) END AS oaid,
         CASE WHEN os = 1 AND user_id % 4 = 2 THEN md5(usr) END AS androidid,
         CASE WHEN os = 2 THEN md5(idfa_raw) END AS idfa, '9.9.9.' || k AS external_ip,
         CAST(k % 10 AS VARCHAR) AS plan_id, CAST(k % 4 AS VARCHAR) AS channel_id
  FROM src WHERE event_type = 'click')"""

# First launch per device, its candidate clicks in match order, and what it is credited to.
DEVICES = f"""
dev AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY app_id, device_id ORDER BY ts, event_id) AS rn
                 FROM ev WHERE kind = 'launch') WHERE rn = 1),
dev_key AS (
  SELECT app_id, device_id, os, ts, 1 AS level, imei AS key FROM dev WHERE os = 1
  UNION ALL SELECT app_id, device_id, os, ts, 2, oaid FROM dev WHERE os = 1
  UNION ALL SELECT app_id, device_id, os, ts, 3, androidid FROM dev WHERE os = 1
  UNION ALL SELECT app_id, device_id, os, ts, 4, external_ip FROM dev WHERE os = 1
  UNION ALL SELECT app_id, device_id, os, ts, 1, external_ip FROM dev WHERE os = 2
  UNION ALL SELECT app_id, device_id, os, ts, 2, idfa FROM dev WHERE os = 2 AND idfa <> md5('{ZERO_IDFA}')),
clk_key AS (
  SELECT os, 1 AS level, imei AS key, click_ts, click_id, plan_id, channel_id FROM clk WHERE os = 1
  UNION ALL SELECT os, 2, oaid, click_ts, click_id, plan_id, channel_id FROM clk WHERE os = 1
  UNION ALL SELECT os, 3, androidid, click_ts, click_id, plan_id, channel_id FROM clk WHERE os = 1
  UNION ALL SELECT os, 4, external_ip, click_ts, click_id, plan_id, channel_id FROM clk WHERE os = 1
  UNION ALL SELECT os, 1, external_ip, click_ts, click_id, plan_id, channel_id FROM clk WHERE os = 2
  UNION ALL SELECT os, 2, idfa, click_ts, click_id, plan_id, channel_id FROM clk WHERE os = 2),
cand AS (
  SELECT app_id, device_id, level, click_ts, click_id, plan_id, channel_id,
         row_number() OVER (PARTITION BY app_id, device_id ORDER BY level, click_ts, click_id) AS rn
  FROM dev_key JOIN clk_key USING (os, level, key) WHERE click_ts <= ts /*LOOKBACK*/),
credit AS (
  SELECT dev.app_id, dev.device_id, dev.os, dev.ts AS active_time, CAST(dev.ts AS DATE) AS active_date,
         coalesce(level, 0) AS level, click_id,
         coalesce(plan_id, '0') AS plan_id, coalesce(channel_id, '0') AS channel_id
  FROM dev LEFT JOIN (SELECT * FROM cand WHERE rn = 1) c USING (app_id, device_id))"""

# Every accepted event with its flags.
FACTS = """
okev AS (
  SELECT ev.*, active_time, active_date, plan_id, channel_id
  FROM ev JOIN credit USING (app_id, device_id) WHERE ev.kind = 'launch' OR active_time <= ev.ts),
f AS (
  SELECT *,
    row_number() OVER (PARTITION BY app_id, device_id, kind ORDER BY ts, event_id) AS rn,
    row_number() OVER (PARTITION BY app_id, device_id, kind, d ORDER BY ts, event_id) AS rn_day,
    max(CASE WHEN kind = 'launch' THEN ts END) OVER (PARTITION BY app_id, device_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_launch_time
  FROM okev),
facts AS (
  SELECT *, CAST(kind = 'launch' AND rn = 1 AS INT) AS is_new,
    CAST(kind = 'launch' AND rn_day = 1 AS INT) AS new_today,
    CAST(kind = 'reg' AND rn = 1 AS INT) AS new_reg,
    CASE WHEN kind = 'pay' THEN CASE WHEN rn > 1 THEN 1 ELSE 0 END + CASE WHEN rn_day > 1 THEN 2 ELSE 0 END
         + CASE WHEN active_date = d THEN 4 ELSE 0 END END AS pay_status,
    date_diff('day', active_date, d) + 1 AS age
  FROM f)"""

WEB = """
wsrc AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS d, CAST(user_id % 3 AS VARCHAR) AS app_id, 'c-' || user_id AS media_clickid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events WHERE event_type = 'view'),
web AS (
  SELECT event_id, ts, d, app_id, media_clickid, 'acc' || k % 2 AS media_accountid, 'cmp' || k % 5 AS media_campaignid,
         'grp' || k % 3 AS media_advgroupid, 'cr' || k % 7 AS media_creativeid, '9.9.9.' || k AS external_ip,
         CAST(k % 10 AS VARCHAR) AS plan_id, CAST(k % 4 AS VARCHAR) AS channel_id,
         row_number() OVER (PARTITION BY media_clickid ORDER BY ts, event_id) AS rn,
         row_number() OVER (PARTITION BY media_clickid, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn_day,
         lag(ts) OVER (PARTITION BY media_clickid ORDER BY ts, event_id) AS prev_launch_time,
         min(ts) OVER (PARTITION BY media_clickid) AS active_time
  FROM wsrc)"""

# The raw payload text, rebuilt field by field; absent fields are left out.
RAW = f"""
src AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(user_id AS VARCHAR) AS usr, CAST(user_id % 3 AS VARCHAR) AS app_id,
         CASE WHEN user_id % 5 = 0 THEN 2 ELSE 1 END AS os,
         CASE WHEN user_id % 4 = 3 THEN '{ZERO_IDFA}' ELSE CAST(user_id AS VARCHAR) END AS idfa_raw
  FROM events WHERE event_type <> 'click'),
raw AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'reg' WHEN 'purchase' THEN 'pay' ELSE 'launch' END AS kind,
    event_type = 'error' AND k % 3 = 0 AS cut,
    '{{"appid":"' || app_id || '"'
    || CASE WHEN event_type = 'error' AND k % 3 = 1 THEN ',"os":"9"' WHEN event_type = 'error' AND k % 3 = 2 THEN ''
            ELSE ',"os":"' || os || '"' END
    || CASE WHEN os = 1 THEN ',"imei":"' || usr || '","oaid":"' || usr || '","androidid":"' || usr || '","mac":"02:00"'
            ELSE ',"uuid":"' || usr || '","idfa":"' || idfa_raw || '"' END
    || CASE WHEN os = 1 THEN ',"ip":"10.0.0.' || k || '"' ELSE ',"ipAddress":"10.0.0.' || k || '"' END
    || ',"externalip":"9.9.9.' || k || '"'
    || CASE WHEN os = 2 THEN ',"deviceModel":"m"' ELSE '' END
    || CASE WHEN event_type = 'purchase' THEN ',"amount":"' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '"'
            ELSE '' END
    || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '","event_id":"' || event_id || '"}}' AS text
  FROM src),
msg AS (
  SELECT *, CASE WHEN cut THEN text[:length(text) - 2] ELSE text END AS value_text,
    CASE WHEN cut THEN 'json' WHEN event_type = 'error' THEN 'platform' END AS reason
  FROM raw)"""

REGISTRY = """
reg AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS app_id,
         CASE r_regionkey WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS app_step,
         CASE WHEN r_regionkey = 1 THEN 1 ELSE 0 END AS active, CASE WHEN r_regionkey IN (1, 2) THEN 1 ELSE 0 END AS reg,
         CASE WHEN r_regionkey = 1 THEN 1 ELSE 0 END AS pay
  FROM region)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_FACTS = _with(BASE, DEVICES, FACTS)


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def micros(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def money(expression: str, name: str) -> str:
    return f"CAST(coalesce({expression}, 0) AS DOUBLE) AS {name}"


def first_of(columns: list[str]) -> str:
    return ", ".join(f"arg_min({c}, (ts, event_id)) AS {c}" for c in columns)


_LAUNCH_COUNTS = ", ".join(
    [
        big("count(*) FILTER (WHERE kind = 'launch')", "launch_count"),
        big("sum(is_new)", "active_count"),
        big("sum(new_today)", "vibrant_count"),
    ]
)
_REG_COUNTS = ", ".join([big("count(*) FILTER (WHERE kind = 'reg')", "reg_count"), big("sum(new_reg)", "onlyreg_count")])
_PAY_COUNTS = ", ".join(
    [big("count(*) FILTER (WHERE kind = 'pay')", "pay_count"), money("sum(amount) FILTER (WHERE kind = 'pay')", "pay_amount")]
)


def _daily(counts: str, where: str) -> str:
    return (
        f"{_FACTS} SELECT app_id, plan_id, {day('d')} AS stat_date, {counts}, {first_of(['channel_id'])}"
        f" FROM facts WHERE {where} GROUP BY app_id, plan_id, d"
    )


_PAY_COHORT = (
    f"{_FACTS} SELECT app_id, plan_id, {day('active_date')} AS active_date, {big('age', 'pay_days')},"
    f" {big('count(*)', 'pay_count')}, {big('count(*) FILTER (WHERE pay_status & 1 = 0)', 'pay_new_devices')},"
    f" {big('count(*) FILTER (WHERE pay_status & 2 = 0)', 'pay_total_devices')},"
    f" {big('count(*) FILTER (WHERE pay_status & 4 = 4)', 'pay_active_count')},"
    f" {money('sum(amount)', 'pay_amount')}, {money('sum(amount) FILTER (WHERE pay_status & 1 = 0)', 'pay_new_amount')},"
    f" {money('sum(amount) FILTER (WHERE pay_status & 4 = 4)', 'pay_active_amount')}, {first_of(['channel_id'])},"
    f" {day('min(d)')} AS pay_date"
    " FROM facts WHERE kind = 'pay' GROUP BY app_id, plan_id, active_date, age"
)

_IDS = "imei, oaid, androidid, mac, uuid, idfa, ip, external_ip, model"


def _log(name: str, where: str) -> str:
    return (
        f"SELECT '{name}' AS log, app_id, device_id, {big('os', 'os')}, {_IDS}, plan_id, channel_id, {micros('ts')} AS ts,"
        f" {micros('active_time')} AS active_time, event_id, CAST(amount AS DOUBLE) AS pay_amount FROM facts WHERE {where}"
    )


_LOGS = {
    "active": "is_new = 1",
    "launch": "kind = 'launch'",
    "reg": "kind = 'reg'",
    "reg_first": "new_reg = 1",
    "pay": "kind = 'pay'",
}

_MEDIA = ["media_accountid", "media_campaignid", "media_advgroupid", "plan_id", "channel_id"]


def _attribution(os: int, lookback_days: int | None = None, dated: str = "true") -> str:
    devices = DEVICES.replace("WHERE click_ts <= ts", f"WHERE {dated} AND click_ts <= ts")
    if lookback_days is not None:
        devices = devices.replace("/*LOOKBACK*/", f"AND click_ts >= ts - INTERVAL {lookback_days} DAY")
    where = f"WHERE os = {os}" if os else ""
    return (
        f"{_with(BASE, devices)} SELECT app_id, device_id, {big('os', 'os')}, {micros('active_time')} AS active_time,"
        f" {big('level', 'level')}, click_id, plan_id, channel_id FROM credit {where}"
    )


def _seen() -> str:
    return ", ".join(
        big(f"max(CASE WHEN kind = '{k}' THEN 1 ELSE 0 END)", n) for n, k in (("active", "launch"), ("reg", "reg"), ("pay", "pay"))
    )


_STATE = f"""{_with(BASE, DEVICES, FACTS)},
st AS (SELECT app_id, device_id, plan_id, channel_id, active_time,
         max(ts) FILTER (WHERE kind = 'launch') AS last_launch_time,
         count(*) FILTER (WHERE kind = 'reg') > 0 AS registered,
         min(ts) FILTER (WHERE kind = 'pay') AS first_pay_time,
         max(d) FILTER (WHERE kind = 'pay') AS last_pay_date
       FROM facts GROUP BY ALL)"""

_WEB_AGE = "date_diff('day', CAST(active_time AS DATE), d) + 1"
SECONDS = "'%Y-%m-%d %H:%M:%S'"


def statements() -> dict[str, str]:
    any_kind = "true"
    out = {
        "daily_base_full": _daily(f"{_LAUNCH_COUNTS}, {_REG_COUNTS}, {_PAY_COUNTS}", any_kind),
        "launch_daily_base": _daily(_LAUNCH_COUNTS, "kind = 'launch'"),
        "reg_daily": _daily(_REG_COUNTS, "kind = 'reg'"),
        "pay_daily_base": _daily(_PAY_COUNTS, "kind = 'pay'"),
        "retention_cohort": (
            f"{_FACTS} SELECT app_id, plan_id, {day('active_date')} AS active_date, {big('age', 'retention_days')},"
            f" {big('count(*)', 'retention_count')}, {first_of(['channel_id'])} FROM facts"
            " WHERE kind = 'launch' AND rn_day = 1 AND age > 1 GROUP BY app_id, plan_id, active_date, age"
        ),
        "pay_cohort": _PAY_COHORT,
        "attribution_android": _attribution(1),
        "attribution_ios": _attribution(2),
        "attribution_lookback": _attribution(0, 2),
        "device_identity_md5": (
            f"{_with(BASE)} SELECT event_id, kind, app_id, {big('os', 'os')}, device_id, imei, oaid, androidid, mac,"
            " uuid, idfa FROM ev"
        ),
        "payload_parse": (
            f"{_with(RAW)} SELECT event_id, kind, app_id, {big('os', 'os')}, md5(usr) AS device_id,"
            f" {micros('ts')} AS ts, '10.0.0.' || k AS ip, '9.9.9.' || k AS external_ip,"
            " CASE WHEN kind = 'pay' THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS amount"
            " FROM msg WHERE reason IS NULL"
        ),
        "payload_rejects": f"{_with(RAW)} SELECT reason, kind, value_text AS raw FROM msg WHERE reason IS NOT NULL",
        "platform_route": (
            f"{_with(RAW)} SELECT kind, CASE WHEN reason = 'json' THEN 'json' WHEN reason = 'platform' THEN 'platform'"
            f" WHEN os = 1 THEN 'android' ELSE 'ios' END AS route, {big('count(*)', 'n')} FROM msg GROUP BY ALL"
        ),
        "launch_facts": (
            f"{_FACTS} SELECT event_id, app_id, device_id, plan_id, channel_id, {micros('ts')} AS ts,"
            f" {micros('active_time')} AS active_time, {micros('prev_launch_time')} AS prev_launch_time,"
            f" {big('is_new', 'is_new')}, {big('new_today', 'new_today')} FROM facts WHERE kind = 'launch'"
        ),
        "reg_first": (
            f"{_FACTS} SELECT event_id, app_id, device_id, plan_id, channel_id, {micros('ts')} AS ts,"
            f" {big('new_reg', 'new_reg')} FROM facts WHERE kind = 'reg'"
        ),
        "pay_status_bits": (
            f"{_FACTS} SELECT event_id, app_id, device_id, plan_id, {micros('ts')} AS ts,"
            f" {big('pay_status', 'pay_status')}, CAST(amount AS DOUBLE) AS amount FROM facts WHERE kind = 'pay'"
        ),
        "reg_pay_rejects": (
            f"{_with(BASE)} SELECT 'no_activation' AS reason, event_id, kind, app_id, device_id, {micros('ts')} AS ts FROM ev e"
            " WHERE kind <> 'launch' AND NOT EXISTS (SELECT 1 FROM ev l WHERE l.kind = 'launch' AND l.app_id = e.app_id"
            " AND l.device_id = e.device_id AND l.ts <= e.ts)"
        ),
        "device_state_snapshot": (
            f"{_STATE} SELECT app_id, device_id, plan_id, channel_id, {micros('active_time')} AS active_time,"
            f" {micros('last_launch_time')} AS last_launch_time, {big('registered', 'registered')},"
            f" {micros('first_pay_time')} AS first_pay_time, {day('last_pay_date')} AS last_pay_date FROM st"
        ),
        "device_state_text": (
            f"{_STATE} SELECT app_id || '-' || device_id AS state_key, '{{\"activetime\":\"' || strftime(active_time, {SECONDS})"
            f" || '\",\"launchtime\":\"' || strftime(last_launch_time, {SECONDS}) || '\",\"planid\":\"' || plan_id"
            " || '\",\"channelid\":\"' || channel_id || '\"}' AS state_value FROM st"
        ),
        "app_onboarding_funnel": (
            f"{_FACTS} SELECT app_id, {_seen()},"
            f" {big('CASE WHEN count(DISTINCT kind) = 3 THEN 3 ELSE 2 END', 'app_step')} FROM facts GROUP BY app_id"
        ),
        "app_registry_merge": (
            f"{_with(BASE, DEVICES, FACTS, REGISTRY)}, seen AS (SELECT app_id, {_seen()} FROM facts GROUP BY app_id),"
            " j AS (SELECT reg.app_id, reg.app_step, seen.app_id IS NOT NULL AND app_step < 3 AS changes,"
            " reg.active AS a0, reg.reg AS r0, reg.pay AS p0,"
            " greatest(reg.active, coalesce(seen.active, 0)) AS a1, greatest(reg.reg, coalesce(seen.reg, 0)) AS r1,"
            " greatest(reg.pay, coalesce(seen.pay, 0)) AS p1 FROM reg LEFT JOIN seen USING (app_id))"
            f" SELECT app_id, {big('CASE WHEN NOT changes THEN app_step WHEN a1 + r1 + p1 = 3 THEN 3 ELSE 2 END', 'app_step')},"
            " '{\"active\":' || CASE WHEN changes THEN a1 ELSE a0 END || ',\"reg\":' || CASE WHEN changes THEN r1 ELSE r0 END"
            " || ',\"pay\":' || CASE WHEN changes THEN p1 ELSE p0 END || '}' AS app_event FROM j"
        ),
        "unknown_app_rejects": (
            f"{_with(BASE, REGISTRY)}, dealt AS (SELECT event_id, CAST(user_id % 7 AS VARCHAR) AS app FROM src)"
            " SELECT 'app' AS reason, event_id, kind, app AS app_id, device_id FROM ev JOIN dealt USING (event_id)"
            " WHERE app NOT IN (SELECT app_id FROM reg)"
        ),
        "attribution_dirty_clicks": _attribution(0, None, "click_id % 3 <> 0"),
        "event_accounting": (
            f"{_with(BASE)}, e AS (SELECT * REPLACE (CASE WHEN event_id % 7 <> 0 THEN device_id END AS device_id,"
            " CASE WHEN event_id % 11 <> 0 THEN ts END AS ts) FROM ev),"
            " l AS (SELECT app_id, device_id, min(ts) AS first FROM e WHERE kind = 'launch' GROUP BY ALL)"
            " SELECT kind, CASE WHEN device_id IS NULL THEN 'identity' WHEN ts IS NULL THEN 'time'"
            " WHEN kind = 'launch' OR first <= ts THEN 'fact' ELSE 'no_activation' END AS outcome,"
            f" {big('count(*)', 'n')} FROM e LEFT JOIN l USING (app_id, device_id) GROUP BY ALL"
        ),
        "state_text_round_trip": (
            f"{_STATE} SELECT app_id, 'u-' || device_id[:8] || '-' || device_id[9:] AS device_id, plan_id, channel_id,"
            f" strftime(active_time, {SECONDS}) || '.000000' AS active_time,"
            f" strftime(last_launch_time, {SECONDS}) || '.000000' AS last_launch_time FROM st"
        ),
        "stream_rejects": (
            f"SELECT * FROM ({_with(RAW)} SELECT reason, kind, CAST(event_id AS VARCHAR) AS event_id FROM msg"
            " WHERE reason IS NOT NULL)"
            f" UNION ALL SELECT * FROM ({_with(BASE)} SELECT 'no_activation' AS reason, kind,"
            " CAST(event_id AS VARCHAR) AS event_id FROM ev e"
            " WHERE kind <> 'launch' AND NOT EXISTS (SELECT 1 FROM ev l WHERE l.kind = 'launch' AND l.app_id = e.app_id"
            " AND l.device_id = e.device_id AND l.ts <= e.ts))"
        ),
        "log_rejects": (
            f"{_with(BASE, DEVICES)} SELECT 'no_launch' AS reason, app_id, device_id, {micros('active_time')} AS active_time"
            " FROM credit WHERE plan_id = '0'"
        ),
        "log_union": f"{_FACTS} " + " UNION ALL ".join(_log(n, w) for n, w in _LOGS.items()),
        "web_facts": (
            f"{_with(WEB)} SELECT event_id, app_id, media_clickid, media_creativeid, {micros('ts')} AS ts,"
            f" {micros('active_time')} AS active_time, {micros('prev_launch_time')} AS prev_launch_time,"
            f" {big('rn = 1', 'is_new')}, {big('rn_day = 1', 'new_today')} FROM web"
        ),
        "web_daily_base": (
            f"{_with(WEB)} SELECT app_id, media_creativeid, {day('d')} AS stat_date, {big('count(*)', 'launch_count')},"
            f" {big('count(*) FILTER (WHERE rn = 1)', 'active_count')},"
            f" {big('count(*) FILTER (WHERE rn_day = 1)', 'vibrant_count')}, {first_of(_MEDIA)}"
            " FROM web GROUP BY app_id, media_creativeid, d"
        ),
        "web_retention": (
            f"{_with(WEB)} SELECT app_id, media_creativeid, {day('CAST(active_time AS DATE)')} AS active_date,"
            f" {big(_WEB_AGE, 'retention_days')},"
            f" {big('count(*)', 'retention_count')}, {first_of(_MEDIA)} FROM web"
            " WHERE rn_day = 1 AND d > CAST(active_time AS DATE)"
            " GROUP BY app_id, media_creativeid, CAST(active_time AS DATE), d"
        ),
        "web_logs": (
            f"{_with(WEB)} SELECT log, app_id, media_accountid, media_campaignid, media_advgroupid, media_creativeid,"
            f" media_clickid, external_ip, plan_id, channel_id, {day('d')} AS log_date, {micros('ts')} AS log_time, event_id"
            " FROM (SELECT 'active' AS log, * FROM web WHERE rn = 1 UNION ALL SELECT 'launch' AS log, * FROM web)"
        ),
        "web_state": (
            f"{_with(WEB)} SELECT media_clickid, {micros('min(ts)')} AS active_time, {micros('max(ts)')} AS last_launch_time"
            " FROM web GROUP BY media_clickid"
        ),
        "web_payload_parse": (
            f"{_with(WEB)} SELECT event_id, app_id, media_clickid, media_creativeid, plan_id, channel_id,"
            f" {micros('ts')} AS ts FROM web"
        ),
    }
    out["attribution_indexed"] = _attribution(0)
    out["attribution_indexed_dirty"] = out["attribution_dirty_clicks"]
    out["app_tables_indexed"] = out["daily_base_full"]
    out["daily_any_order"] = out["daily_base_full"]
    out["retention_any_order"] = out["retention_cohort"]
    out["pay_cohort_any_order"] = out["pay_cohort"]
    out["late_launch_facts"] = out["launch_facts"]
    devices = big("count(DISTINCT device_id)", "device_count")
    out["distinct_devices"] = " UNION ALL ".join(
        f"SELECT * FROM ({_FACTS} SELECT app_id, plan_id, {day('d')} AS stat_date, {devices}, '{name}' AS kind FROM facts"
        f" WHERE kind = '{kind}' GROUP BY app_id, plan_id, d)"
        for name, kind in (("active", "launch"), ("paying", "pay"))
    )
    out["distinct_retention"] = (
        f"{_FACTS} SELECT app_id, plan_id, {day('active_date')} AS active_date, {big('age', 'retention_days')},"
        f" {big('count(DISTINCT device_id)', 'retention_count')} FROM facts"
        " WHERE kind = 'launch' AND age > 1 GROUP BY app_id, plan_id, active_date, age"
    )
    out["distinct_over_days"] = (
        f"{_FACTS}, days AS (SELECT DISTINCT app_id, plan_id, d, device_id FROM facts WHERE kind = 'launch')"
        f" SELECT e.app_id, e.plan_id, {big('n', 'days')}, {day('e.d')} AS stat_date,"
        f" {big('count(DISTINCT x.device_id)', 'device_count')}"
        " FROM (SELECT DISTINCT app_id, plan_id, d FROM days) e, (VALUES (1), (7), (30)) t(n), days x"
        " WHERE x.app_id = e.app_id AND x.plan_id = e.plan_id AND x.d <= e.d AND x.d > e.d - n"
        " GROUP BY e.app_id, e.plan_id, n, e.d"
    )
    out["statistics_at_once"] = " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS stat, * FROM ({out[key]})"
        for name, key in (("daily", "daily_base_full"), ("retention", "retention_cohort"), ("pay", "pay_cohort"))
    )
    out["app_signals_at_once"] = out["app_registry_merge"]
    out["daily_base_rollup"] = out["daily_base_full"]
    out["pay_cohort_rollup"] = out["pay_cohort"]
    out["state_from_logs"] = out["device_state_snapshot"]
    out["launch_daily_stream"] = out["launch_daily_base"]
    out["app_tables_stream"] = out["daily_base_full"]
    out["web_daily_stream"] = out["web_daily_base"]
    out["retention_stream"] = out["retention_cohort"]
    out["pay_cohort_stream"] = out["pay_cohort"]
    out["stream_state"] = out["device_state_snapshot"]
    out["web_retention_stream"] = out["web_retention"]
    out["rejects_recovered"] = out["daily_base_full"]
    out["stream_redelivered"] = out["daily_base_full"]
    half = "min(ts) + to_microseconds(date_diff('microsecond', min(ts), max(ts)) // 2)"
    out["stream_from_history"] = (
        f"SELECT * FROM ({out['daily_base_full']}) WHERE stat_date >="
        f" (SELECT strftime(CAST({half} AS DATE), '%Y-%m-%d') FROM events)"
    )
    out["stream_log_fallback"] = out["stream_from_history"]
    out["device_identity_clear"] = (
        f"{_with(RAW)} SELECT event_id, kind, app_id, {big('os', 'os')}, usr AS device_id FROM msg WHERE reason IS NULL"
    )
    return out
