"""Batch plans: from events and clicks to logs, state and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.functions import scalars as S
from cohortrail.schemas import LAUNCH, PAY, REG

# Log tables: which facts each one keeps.
APP_LOGS = {
    "active": "is_new = 1",
    "launch": f"kind = '{LAUNCH}'",
    "reg": f"kind = '{REG}'",
    "reg_first": "new_reg = 1",
    "pay": f"kind = '{PAY}'",
}
_LOG_COLUMNS = [
    "app_id", "device_id", "os", "imei", "oaid", "androidid", "mac", "uuid", "idfa", "ip", "external_ip", "model",
    "plan_id", "channel_id", "ts", "active_time", "event_id", "amount AS pay_amount",
]

WEB_LOGS = {"active": "is_new = 1", "launch": "true"}
_WEB_LOG_COLUMNS = [
    "app_id", "media_accountid", "media_campaignid", "media_advgroupid", "media_creativeid", "media_clickid",
    "external_ip", "plan_id", "channel_id", "stat_date AS log_date", "ts AS log_time", "event_id",
]


def _logs(facts: DataFrame, logs: dict[str, str], columns: list[str]) -> DataFrame:
    """All log tables in one pass: each fact names the logs it belongs to."""
    names = ", ".join(f"CASE WHEN {where} THEN '{name}' END" for name, where in logs.items())
    return facts.selectExpr(f"explode(filter(array({names}), l -> l IS NOT NULL)) AS log", *columns)


def app_logs(facts: DataFrame) -> DataFrame:
    return _logs(facts, APP_LOGS, _LOG_COLUMNS)


def web_logs(facts: DataFrame) -> DataFrame:
    return _logs(facts, WEB_LOGS, _WEB_LOG_COLUMNS)


def routes(tagged: DataFrame) -> DataFrame:
    """Messages per topic and platform, or per reason where no platform takes them."""
    route = f"coalesce(reason, {S.by_platform('os', chr(39) + 'android' + chr(39), chr(39) + 'ios' + chr(39))}) AS route"
    return tagged.selectExpr("kind", route).groupBy("kind", "route").agg(F.expr("count(1) AS n"))
