"""Column types of payloads, events, state and statistics."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)
CORRUPT = "_corrupt"

LAUNCH, REG, PAY = "launch", "reg", "pay"
ANDROID, IOS = 1, 2

# Plan and channel of a device no click explains.
ORGANIC = "0"


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


# Raw payloads carry every value as text; typing happens after the parse so that a bad number
# rejects one row and not the batch.
LAUNCH_PAYLOAD = StructType(
    _strings(
        "appid", "os", "imei", "oaid", "androidid", "mac", "uuid", "idfa", "ip", "externalip",
        "ipAddress", "deviceModel", "appName", "applicationId", "channel", "model", "planid",
        "sys", "time", "ua", "versionCode", "versionName", "ts", "event_id",
    )
)
REG_PAYLOAD = LAUNCH_PAYLOAD
PAY_PAYLOAD = StructType(LAUNCH_PAYLOAD.fields + _strings("amount"))
WEB_PAYLOAD = StructType(
    _strings(
        "media_accountid", "media_campaignid", "media_advgroupid", "media_creativeid",
        "media_clickid", "external_ip", "app_id", "plan_id", "channel_id", "active_time", "event_id",
    )
)

# Normalised app event: ids pseudonymised, platform and identity resolved.
ID_COLUMNS = ["imei", "oaid", "androidid", "mac", "uuid", "idfa"]
APP_EVENT = StructType(
    [
        StructField("app_id", StringType()),
        StructField("device_id", StringType()),
        StructField("os", IntegerType()),
        StructField("kind", StringType()),
        StructField("ts", TimestampNTZType()),
        StructField("event_id", LongType()),
        *_strings(*ID_COLUMNS, "ip", "external_ip", "model"),
        StructField("amount", MONEY),
    ]
)

WEB_MEDIA = ["media_accountid", "media_campaignid", "media_advgroupid"]
WEB_EVENT = StructType(
    [
        *_strings(*WEB_MEDIA, "media_creativeid", "media_clickid", "external_ip", "app_id", "plan_id", "channel_id"),
        StructField("ts", TimestampNTZType()),
        StructField("event_id", LongType()),
    ]
)

CLICK = StructType(
    [
        StructField("os", IntegerType()),
        StructField("click_id", LongType()),
        StructField("click_ts", TimestampNTZType()),
        *_strings("imei", "oaid", "androidid", "mac", "idfa", "external_ip", "plan_id", "channel_id"),
    ]
)

DEVICE_KEYS = ["app_id", "device_id"]
DEVICE_STATE = StructType(
    [
        *_strings("app_id", "device_id", "plan_id", "channel_id"),
        StructField("active_time", TimestampNTZType()),
        StructField("last_launch_time", TimestampNTZType()),
        StructField("registered", BooleanType()),
        StructField("first_pay_time", TimestampNTZType()),
        StructField("last_pay_date", DateType()),
    ]
)

WEB_KEYS = ["media_clickid"]
WEB_STATE = StructType(
    [
        *_strings("media_clickid"),
        StructField("active_time", TimestampNTZType()),
        StructField("last_launch_time", TimestampNTZType()),
    ]
)

REGISTRY_FLAGS = StructType([StructField(n, IntegerType()) for n in ("active", "reg", "pay")])
APP_REGISTRY = StructType(
    [
        StructField("app_id", StringType()),
        StructField("app_step", IntegerType()),
        StructField("app_event", REGISTRY_FLAGS),
    ]
)

REJECT = StructType(_strings("reason", "kind", "raw"))

# Statistics: key columns, then additive measures. Every delta row also carries the order of its
# first event, which decides the descriptive columns that only the creating row sets.
FIRST = ["first_ts", "first_event_id"]
