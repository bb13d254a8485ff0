"""Scalar expressions shared by the operators, as SQL text over built-in functions.

Text keeps the Python side thin (one call parses a whole projection) and reads like the query it becomes.
"""

from __future__ import annotations

from collections.abc import Iterable

from cohortrail.schemas import ANDROID, IOS

# An advertising id of zeros is what a device reports when tracking is off, and an
# empty text is an id that was never read. Both are listed in clear and hashed form.
ZERO_IDFA = "00000000-0000-0000-0000-000000000000"
ZERO_IDFA_MD5 = "9f89c84a559f573636a47ff8daed0d33"
EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"
SENTINEL_IDS = (ZERO_IDFA, ZERO_IDFA_MD5, "", EMPTY_MD5)

# Text formats of dates and times.
DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Payment status bits.
PAID_BEFORE, PAID_TODAY, ACTIVE_TODAY = 1, 2, 4

_ID_ROOM = "20000000000000000000BD"

MONEY_TYPE = "decimal(18,2)"


def text(value: str) -> str:
    """SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def day(ts: str) -> str:
    return f"to_date({ts})"


def day_number(start: str, end: str) -> str:
    """Calendar days from `start` to `end`, counting both: the first day is 1, the next day is 2."""
    return f"(datediff({end}, {start}) + 1)"


def parse_time(value: str) -> str:
    return f"try_cast({value} AS timestamp_ntz)"


def time_text(ts: str) -> str:
    return f"date_format({ts}, '{SECOND_FORMAT}')"


def money(value: str) -> str:
    return f"try_cast({value} AS {MONEY_TYPE})"


def pseudonym(value: str) -> str:
    """Lower-case MD5 hex of the id; null stays null."""
    return f"md5(CAST({value} AS string))"


def usable_id(value: str, sentinels: Iterable[str] = SENTINEL_IDS) -> str:
    """The id itself, or null where it is missing or a known placeholder, so that it never matches."""
    return f"CASE WHEN {value} NOT IN ({', '.join(map(text, sentinels))}) THEN {value} END"


def by_platform(os: str, android: str, ios: str) -> str:
    return f"CASE {os} WHEN {ANDROID} THEN {android} WHEN {IOS} THEN {ios} END"


def pay_status(paid_before: str, paid_today: str, active_today: str) -> str:
    """Three flags folded into one integer with bitwise OR; an unknown flag is off."""
    return (
        f"(if({paid_before}, {PAID_BEFORE}, 0) | if({paid_today}, {PAID_TODAY}, 0)"
        f" | if({active_today}, {ACTIVE_TODAY}, 0))"
    )


def has_bit(status: str, value: int) -> str:
    return f"({status} & {value}) = {value}"


def order_key(ts: str, event_id: str) -> str:
    """`(ts, event_id)` as one number, in the same order.

    A minimum over a number is kept in place by hash aggregation, whereas a minimum over a struct makes Spark sort
    all rows first. Microseconds leave room for any 64-bit id below them.
    """
    seconds = f"CAST(CAST({ts} - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS interval second) AS decimal(18,6))"
    return f"(CAST({seconds} * 1000000 AS decimal(38,0)) * {_ID_ROOM} + CAST({event_id} AS decimal(38,0)))"


def order_id(order: str, ts: str) -> str:
    """The event id in an order key, given its time."""
    return f"CAST({order} - {order_key(ts, '0')} AS bigint)"


def count_if(condition: str) -> str:
    return f"count_if({condition})"


def sum_if(condition: str, value: str) -> str:
    """Additive sum, 0 instead of null for an empty group."""
    return f"CAST(coalesce(sum({value}) FILTER (WHERE {condition}), 0) AS {MONEY_TYPE})"
