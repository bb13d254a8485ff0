"""JSON payloads of the four topics to typed rows, each tagged with the reason it is unusable, if any.

A bad row never costs its neighbours: it carries a `reason`, `rejected` collects it, everything else goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from cohortrail.functions import scalars as S
from cohortrail.schemas import (
    ANDROID,
    APP_EVENT,
    CORRUPT,
    ID_COLUMNS,
    IOS,
    LAUNCH,
    LAUNCH_PAYLOAD,
    PAY,
    PAY_PAYLOAD,
    REG,
    REG_PAYLOAD,
    WEB_EVENT,
    WEB_PAYLOAD,
)

TOPIC_PAYLOADS = {LAUNCH: LAUNCH_PAYLOAD, REG: REG_PAYLOAD, PAY: PAY_PAYLOAD}
# One schema covers the three app topics, so their union is parsed in a single pass.
APP_PAYLOAD = PAY_PAYLOAD


def parse_json(raw: DataFrame, schema: StructType, keep_extra: bool = False) -> DataFrame:
    """Parse column `value` into struct `p`; malformed text sets `p._corrupt`.

    The struct leaves a one-element generator, so that a filter on parsed fields is not pushed below the parse, where
    every field it names would parse the text again. With `keep_extra`, fields outside the schema stay available as a text map `extra`.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = (
        f"explode(array(from_json(value, '{fields}, {CORRUPT} string', "
        f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{CORRUPT}')))) AS p"
    )
    out = raw.selectExpr("*", parsed)
    if not keep_extra:
        return out
    known = ", ".join(map(S.text, schema.fieldNames()))
    extra = f"map_filter(from_json(value, 'map<string,string>'), (k, v) -> k NOT IN ({known})) AS extra"
    return out.selectExpr("*", extra)


def _first_reason(rules: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {condition} THEN '{reason}'" for reason, condition in rules.items())
    return f"CASE {cases} END AS reason"


_BROKEN = f"p IS NULL OR p.{CORRUPT} IS NOT NULL"


def _order_columns(raw: DataFrame, ts: str) -> tuple[str, str]:
    """Event time and tie-break: from the payload, else as the message queue supplies them."""
    ts, event_id = S.parse_time(ts), "try_cast(p.event_id AS bigint)"
    if "arrival" in raw.columns:
        ts = f"coalesce({ts}, CAST(arrival AS timestamp_ntz))"
    if "position" in raw.columns:
        event_id = f"coalesce({event_id}, position)"
    return ts, event_id


def _passed(raw: DataFrame) -> list[str]:
    """For streams: arrival, and the message's own id, which unlike `event_id` is never filled from the position."""
    return ["arrival", "CAST(p.event_id AS string) AS own_id"] if "arrival" in raw.columns else []


def app_events(raw: DataFrame, hash_ids: bool = True, keep_extra: bool = False) -> DataFrame:
    """Rows of `kind, value` to app events plus `reason` and the raw text.

    Optional input columns: `arrival` (time stamp used when the payload has no `ts`) and `position`
    (tie-break used when it has no `event_id`).
    """

    def hashed(column: str) -> str:
        return S.pseudonym(column) if hash_ids else column

    os = "try_cast(p.os AS int)"
    ts, event_id = _order_columns(raw, "p.ts")
    amount = S.money("p.amount")
    # Rules look at the clear values: hashing is left to the rows that pass.
    reason = _first_reason(
        {
            "json": _BROKEN,
            "platform": f"{os} IS NULL OR {os} NOT IN ({ANDROID}, {IOS})",
            "app": "p.appid IS NULL",
            "identity": f"{S.by_platform(os, 'p.oaid', 'p.uuid')} IS NULL",
            "time": f"{ts} IS NULL",
            "event_id": f"{event_id} IS NULL",
            "amount": f"kind = '{PAY}' AND {amount} IS NULL",
        }
    )
    return parse_json(raw, APP_PAYLOAD, keep_extra).selectExpr(
        "p.appid AS app_id",
        f"{S.by_platform(os, hashed('p.oaid'), hashed('p.uuid'))} AS device_id",
        f"{os} AS os",
        "kind",
        f"{ts} AS ts",
        f"{event_id} AS event_id",
        *[f"{hashed('p.' + name)} AS {name}" for name in ID_COLUMNS],
        f"{S.by_platform(os, 'p.ip', 'p.ipAddress')} AS ip",
        "p.externalip AS external_ip",
        "p.deviceModel AS model",
        f"{amount} AS amount",
        "value AS raw",
        *(["extra"] if keep_extra else []),
        *_passed(raw),
        reason,
    )


def web_events(raw: DataFrame) -> DataFrame:
    """Rows of `value` to web launches plus `reason` and the raw text."""
    ts, event_id = _order_columns(raw, "p.active_time")
    reason = _first_reason(
        {
            "json": _BROKEN,
            "app": "p.app_id IS NULL",
            "creative": "p.media_creativeid IS NULL",
            "identity": "p.media_clickid IS NULL",
            "time": f"{ts} IS NULL",
            "event_id": f"{event_id} IS NULL",
        }
    )
    return parse_json(raw, WEB_PAYLOAD).selectExpr(
        *[f"p.{c} AS {c}" for c in WEB_EVENT.fieldNames() if c not in ("ts", "event_id")],
        f"{ts} AS ts",
        f"{event_id} AS event_id",
        "'webLaunch' AS kind",
        "value AS raw",
        *_passed(raw),
        reason,
    )


def accepted(tagged: DataFrame, schema: StructType = APP_EVENT) -> DataFrame:
    return tagged.where("reason IS NULL").select(*schema.fieldNames())


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where("reason IS NOT NULL").select("reason", "kind", "raw")
