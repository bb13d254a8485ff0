"""The given test tables read as domain streams.

`events.user_id` is a device of app `user_id % 3`; one device in five runs platform 2. Views are launches, signups are
registrations, purchases are payments, clicks are ad clicks, errors stand for damaged input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortrail.functions import scalars as S
from cohortrail.operators.registry import from_text
from cohortrail.schemas import APP_EVENT, CLICK, LAUNCH, PAY, REG, WEB_EVENT

KINDS = {"view": LAUNCH, "signup": REG, "purchase": PAY}

_K = "CAST(get_json_object(props, '$.k') AS int)"
_USER = "CAST(user_id AS string)"
_APP = "CAST(user_id % 3 AS string)"
_OS = "CASE WHEN user_id % 5 = 0 THEN 2 ELSE 1 END"
# One platform-2 device in four has tracking switched off.
_IDFA = f"CASE WHEN user_id % 4 = 3 THEN '{S.ZERO_IDFA}' ELSE {_USER} END"
_KIND = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{k}'" for t, k in KINDS.items()) + " END"
_MICROS = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"


def _android(value: str) -> str:
    return f"CASE WHEN user_id % 5 <> 0 THEN {value} END"


def _ios(value: str) -> str:
    return f"CASE WHEN user_id % 5 = 0 THEN {value} END"


def _address(net: str) -> str:
    return f"concat('{net}', CAST({_K} AS string))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _typed(rows: DataFrame, columns: dict[str, str], schema) -> DataFrame:
    return rows.selectExpr(*[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema])


def app_events(spark: SparkSession, sf_dir: str, apps: int = 3) -> DataFrame:
    """Typed app events; equal to parsing `raw_payloads` and keeping the accepted rows."""
    return typed_app_events(table(spark, sf_dir, "events"), apps)


def typed_app_events(events: DataFrame, apps: int = 3) -> DataFrame:
    user_md5 = S.pseudonym(_USER)
    kinds = ", ".join(f"'{t}'" for t in KINDS)
    return _typed(
        events.where(f"event_type IN ({kinds})"),
        {
            "app_id": f"user_id % {apps}",
            "device_id": user_md5,
            "os": _OS,
            "kind": _KIND,
            "ts": "ts",
            "event_id": "event_id",
            "imei": _android(user_md5),
            "oaid": _android(user_md5),
            "androidid": _android(user_md5),
            "mac": _android(S.pseudonym("'02:00'")),
            "uuid": _ios(user_md5),
            "idfa": _ios(S.pseudonym(_IDFA)),
            "ip": _address("10.0.0."),
            "external_ip": _address("9.9.9."),
            "model": _ios("'m'"),
            "amount": "CASE WHEN event_type = 'purchase' THEN value END",
        },
        APP_EVENT,
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A click carries one id of its device, by `user_id % 4` (none when 3), and its address."""
    return typed_clicks(table(spark, sf_dir, "events"))


def typed_clicks(events: DataFrame) -> DataFrame:
    def carried(remainder: int) -> str:
        return f"CASE WHEN user_id % 5 <> 0 AND user_id % 4 = {remainder} THEN {S.pseudonym(_USER)} END"

    return _typed(
        events.where("event_type = 'click'"),
        {
            "os": _OS,
            "click_id": "event_id",
            "click_ts": "ts",
            "imei": carried(0),
            "oaid": carried(1),
            "androidid": carried(2),
            "mac": _android(S.pseudonym("'02:00'")),
            "idfa": _ios(S.pseudonym(_IDFA)),
            "external_ip": _address("9.9.9."),
            "plan_id": f"{_K} % 10",
            "channel_id": f"{_K} % 4",
        },
        CLICK,
    )


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app topics as JSON text, `ts, kind, value`. Errors become damaged launches: cut text, a platform that does
    not exist, or no platform at all."""
    return raw_app_payloads(table(spark, sf_dir, "events"))


def raw_app_payloads(events: DataFrame) -> DataFrame:
    error = "event_type = 'error'"
    fields = {
        "appid": _APP,
        "os": f"CASE WHEN {error} AND {_K} % 3 = 1 THEN '9' WHEN {error} AND {_K} % 3 = 2 THEN NULL"
        f" ELSE CAST({_OS} AS string) END",
        "imei": _android(_USER),
        "oaid": _android(_USER),
        "androidid": _android(_USER),
        "mac": _android("'02:00'"),
        "uuid": _ios(_USER),
        "idfa": _ios(_IDFA),
        "ip": _android(_address("10.0.0.")),
        "ipAddress": _ios(_address("10.0.0.")),
        "externalip": _address("9.9.9."),
        "deviceModel": _ios("'m'"),
        "amount": f"CASE WHEN event_type = 'purchase' THEN CAST(CAST(value AS {S.MONEY_TYPE}) AS string) END",
        "ts": _MICROS,
        "event_id": "CAST(event_id AS string)",
    }
    struct = ", ".join(f"'{n}', {e}" for n, e in fields.items())
    return (
        events.where("event_type <> 'click'")
        .selectExpr(
            "ts",
            f"coalesce({_KIND}, '{LAUNCH}') AS kind",
            f"to_json(named_struct({struct})) AS text",
            f"({error} AND {_K} % 3 = 0) AS cut",
        )
        .selectExpr("ts", "kind", "CASE WHEN cut THEN left(text, length(text) - 2) ELSE text END AS value")
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views read as web launches: the click id is the user, the creative is `k % 7`."""
    return typed_web_events(table(spark, sf_dir, "events"))


def typed_web_events(events: DataFrame) -> DataFrame:
    def tagged(prefix: str, modulus: int) -> str:
        return f"concat('{prefix}', CAST({_K} % {modulus} AS string))"

    return _typed(
        events.where("event_type = 'view'"),
        {
            "media_accountid": tagged("acc", 2),
            "media_campaignid": tagged("cmp", 5),
            "media_advgroupid": tagged("grp", 3),
            "media_creativeid": tagged("cr", 7),
            "media_clickid": f"concat('c-', {_USER})",
            "external_ip": _address("9.9.9."),
            "app_id": _APP,
            "plan_id": f"{_K} % 10",
            "channel_id": f"{_K} % 4",
            "ts": "ts",
            "event_id": "event_id",
        },
        WEB_EVENT,
    )


def raw_web_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = [f"'{c}', {c}" for c in WEB_EVENT.fieldNames() if c not in ("ts", "event_id")]
    fields = ", ".join([*text, f"'active_time', {_MICROS}", "'event_id', CAST(event_id AS string)"])
    return web_events(spark, sf_dir).selectExpr("ts", "'webLaunch' AS kind", f"to_json(named_struct({fields})) AS value")


def app_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions read as registered apps: 1 is done, 2 has sent registrations, the others start with nothing."""
    return from_text(
        table(spark, sf_dir, "region").selectExpr(
            "r_regionkey AS id",
            "CASE r_regionkey WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS app_step",
            """CASE r_regionkey WHEN 1 THEN '{"active":1,"reg":1,"pay":1}'
               WHEN 2 THEN '{"active":0,"reg":1,"pay":0}' ELSE '{"active":0,"reg":0,"pay":0}' END AS app_event""",
        )
    )
