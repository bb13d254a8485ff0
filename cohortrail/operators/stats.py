"""Statistics tables from per-event facts, as additive deltas.

Each function is one `groupBy` with map-side combine on a key of low cardinality. Descriptive columns outside the key
are those of the row that creates the statistics row: the first event in `(ts, event_id)` order. Deltas of
several batches fold with `merge_deltas`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.functions import scalars as S
from cohortrail.schemas import FIRST, LAUNCH, PAY, REG, WEB_MEDIA


class StatTable(NamedTuple):
    keys: list[str]
    counts: list[str]
    money: list[str]
    described: list[str]  # set by the first row, never updated


DAILY = StatTable(
    ["app_id", "plan_id", "stat_date"],
    ["launch_count", "active_count", "vibrant_count", "reg_count", "onlyreg_count", "pay_count"],
    ["pay_amount"],
    ["channel_id"],
)
RETENTION = StatTable(
    ["app_id", "plan_id", "active_date", "retention_days"], ["retention_count"], [], ["channel_id"]
)
PAY_COHORT = StatTable(
    ["app_id", "plan_id", "active_date", "pay_days"],
    ["pay_count", "pay_new_devices", "pay_total_devices", "pay_active_count"],
    ["pay_amount", "pay_new_amount", "pay_active_amount"],
    ["channel_id", "pay_date"],
)
_WEB_DESCRIBED = [*WEB_MEDIA, "plan_id", "channel_id"]
WEB_DAILY = StatTable(
    ["app_id", "media_creativeid", "stat_date"],
    ["launch_count", "active_count", "vibrant_count"],
    [],
    _WEB_DESCRIBED,
)
WEB_RETENTION = StatTable(
    ["app_id", "media_creativeid", "active_date", "retention_days"], ["retention_count"], [], _WEB_DESCRIBED
)


_ORDER = S.order_key("ts", "event_id")


def aggregate(
    rows: DataFrame, table: StatTable, measures: dict[str, str], ts: str = "ts", order: str = _ORDER
) -> DataFrame:
    """Group by the table's key; `measures` are SQL aggregates by column name, each folding by sum. `ts` and `order` give
    the time and order key of a row.

    First by key and described columns, where all buffers are plain numbers and hash aggregation combines on the map
    side; then the few rows per key are added up and the earliest supplies the description.
    """
    parts = rows.groupBy(*table.keys, *table.described).agg(
        *[F.expr(f"{e} AS {m}") for m, e in measures.items()], F.expr(f"min({order}) AS first_order"), F.expr(f"min({ts}) AS first_ts")
    )
    # Rows that take back what others counted have no first event.
    earliest = f"min(struct(first_order, first_ts, {', '.join(table.described)})) FILTER (WHERE first_ts IS NOT NULL) AS first"
    added = parts.groupBy(*table.keys).agg(*[F.expr(f"sum({m}) AS {m}") for m in measures], F.expr(earliest))
    return added.selectExpr(
        *table.keys,
        *[f"CAST({c} AS bigint) AS {c}" for c in table.counts],
        *[f"CAST({c} AS {S.MONEY_TYPE}) AS {c}" for c in table.money],
        *[f"first.{c} AS {c}" for c in table.described],
        f"first.first_ts AS {FIRST[0]}",
        f"{S.order_id('first.first_order', 'first.first_ts')} AS {FIRST[1]}",
    )


def merge_deltas(deltas: DataFrame, table: StatTable) -> DataFrame:
    """Fold deltas of any number of batches into one row per key."""
    sums = {c: f"sum({c})" for c in (*table.counts, *table.money)}
    return aggregate(deltas, table, sums, FIRST[0], S.order_key(*FIRST))


def taken_back(deltas: DataFrame, table: StatTable) -> DataFrame:
    """Deltas that undo `deltas`: negative counts, and no claim to be the first of a row."""
    kinds = dict(deltas.dtypes)
    measures = [f"CAST(-{c} AS {kinds[c]}) AS {c}" for c in (*table.counts, *table.money)]
    nothing = [f"CAST(NULL AS {kinds[c]}) AS {c}" for c in FIRST]
    return deltas.selectExpr(*table.keys, *measures, *table.described, *nothing).select(*deltas.columns)


def firsts(rows: DataFrame, table: StatTable) -> DataFrame:
    """Per key the first row's description and place in order, as in `aggregate`."""
    earliest = f"min(struct({_ORDER} AS first_order, ts, event_id, {', '.join(table.described)})) AS first"
    found = rows.groupBy(*table.keys).agg(F.expr(earliest))
    return found.selectExpr(
        *table.keys, *[f"first.{c} AS {c}" for c in table.described], f"first.ts AS {FIRST[0]}", f"first.event_id AS {FIRST[1]}"
    )


def daily(facts: DataFrame) -> DataFrame:
    """Launches, activations, active devices, registrations and payments per app, plan and day."""
    return aggregate(
        facts,
        DAILY,
        {
            "launch_count": S.count_if(f"kind = '{LAUNCH}'"),
            "active_count": "sum(is_new)",
            "vibrant_count": "sum(new_today)",
            "reg_count": S.count_if(f"kind = '{REG}'"),
            "onlyreg_count": "sum(new_reg)",
            "pay_count": S.count_if(f"kind = '{PAY}'"),
            "pay_amount": S.sum_if(f"kind = '{PAY}'", "amount"),
        },
    )


# Age of the device's cohort on the day of a fact; the facts and payments that count.
_AGE = S.day_number("active_date", "stat_date")
_RETAINED = f"new_today = 1 AND is_new = 0 AND {_AGE} > 1"
_NEW_PAYER = f"NOT {S.has_bit('pay_status', S.PAID_BEFORE)}"
_FIRST_TODAY = f"NOT {S.has_bit('pay_status', S.PAID_TODAY)}"
_ACTIVE_TODAY = S.has_bit("pay_status", S.ACTIVE_TODAY)


def retained(facts: DataFrame) -> DataFrame:
    """First launches of a day by devices activated on an earlier day."""
    return facts.where(_RETAINED).selectExpr("*", f"{_AGE} AS retention_days")


def retention(facts: DataFrame) -> DataFrame:
    return aggregate(retained(facts), RETENTION, {"retention_count": "count(1)"})


def payments(facts: DataFrame) -> DataFrame:
    return facts.where(f"kind = '{PAY}'").selectExpr("*", f"{_AGE} AS pay_days", "stat_date AS pay_date")


def pay_cohort(facts: DataFrame) -> DataFrame:
    """Payments per app, plan, activation day and age of the cohort."""
    return aggregate(
        payments(facts),
        PAY_COHORT,
        {
            "pay_count": "count(1)",
            "pay_amount": "sum(amount)",
            "pay_new_devices": S.count_if(_NEW_PAYER),
            "pay_new_amount": S.sum_if(_NEW_PAYER, "amount"),
            "pay_total_devices": S.count_if(_FIRST_TODAY),
            "pay_active_count": S.count_if(_ACTIVE_TODAY),
            "pay_active_amount": S.sum_if(_ACTIVE_TODAY, "amount"),
        },
    )


# Places of each statistic's measures in a part, and the SQL of each over facts.
_PARTS = {
    "daily": (
        DAILY,
        "stat_date",
        "CAST(NULL AS int)",
        "true",
        {
            "launch_count": f"kind = '{LAUNCH}'",
            "active_count": "is_new = 1",
            "vibrant_count": "new_today = 1",
            "reg_count": f"kind = '{REG}'",
            "onlyreg_count": "new_reg = 1",
            "pay_count": f"kind = '{PAY}'",
        },
        {"pay_amount": f"kind = '{PAY}'"},
    ),
    "retention": (RETENTION, "active_date", _AGE, _RETAINED, {"retention_count": "true"}, {}),
    "pay": (
        PAY_COHORT,
        "active_date",
        _AGE,
        f"kind = '{PAY}'",
        {
            "pay_count": "true",
            "pay_new_devices": _NEW_PAYER,
            "pay_total_devices": _FIRST_TODAY,
            "pay_active_count": _ACTIVE_TODAY,
        },
        {"pay_amount": "true", "pay_new_amount": _NEW_PAYER, "pay_active_amount": _ACTIVE_TODAY},
    ),
}
_COUNTS, _MONEY = (max(len(p[i]) for p in _PARTS.values()) for i in (4, 5))


def parts(facts: DataFrame) -> DataFrame:
    """Daily, retention and payment statistics of facts in one pass: each fact becomes a row for each statistic that
    counts it, and one aggregation adds all of them up. One scan, one exchange, and numbers only, so that hash
    aggregation combines on the map side.

    There may be several rows per key, one for each description; `of_parts` gives them as deltas of a statistic.
    """
    rows = []
    for name, (_, day, age, where, counts, money) in _PARTS.items():
        fields = [f"'{name}' AS stat", f"{day} AS day", f"{age} AS age"]
        each = list(counts.values()) + ["false"] * (_COUNTS - len(counts))
        fields += [f"if({c}, 1L, 0L) AS c{i}" for i, c in enumerate(each)]
        each = list(money.values()) + ["false"] * (_MONEY - len(money))
        fields += [f"CAST(if({c}, amount, 0) AS {S.MONEY_TYPE}) AS m{i}" for i, c in enumerate(each)]
        rows.append(f"if({where}, struct({', '.join(fields)}), NULL)")
    tagged = facts.selectExpr(
        "app_id", "plan_id", "channel_id", "ts", f"{_ORDER} AS place", f"inline(array_compact(array({', '.join(rows)})))"
    )
    sums = [F.expr(f"sum({c}) AS {c}") for c in [*(f"c{i}" for i in range(_COUNTS)), *(f"m{i}" for i in range(_MONEY))]]
    grouped = tagged.groupBy("stat", "app_id", "plan_id", "day", "age", "channel_id")
    return grouped.agg(*sums, F.expr("min(place) AS first_order"), F.expr("min(ts) AS first_ts"))


def of_parts(found: DataFrame, name: str) -> DataFrame:
    """Deltas of one of the statistics of `parts`: daily, retention or pay."""
    table, _, _, _, counts, money = _PARTS[name]
    columns = {"stat_date": "day", "active_date": "day", "retention_days": "age", "pay_days": "age"}
    columns |= {"pay_date": "date_add(day, age - 1)"}
    columns |= {c: f"c{i}" for i, c in enumerate(counts)} | {c: f"CAST(m{i} AS {S.MONEY_TYPE})" for i, c in enumerate(money)}
    wanted = [*table.keys, *table.counts, *table.money, *table.described]
    return found.where(f"stat = '{name}'").selectExpr(
        *[f"{columns.get(c, c)} AS {c}" for c in wanted],
        f"first_ts AS {FIRST[0]}",
        f"{S.order_id('first_order', 'first_ts')} AS {FIRST[1]}",
    )


def web_daily(facts: DataFrame) -> DataFrame:
    return aggregate(
        facts,
        WEB_DAILY,
        {"launch_count": "count(1)", "active_count": "sum(is_new)", "vibrant_count": "sum(new_today)"},
    )


def web_retention(facts: DataFrame) -> DataFrame:
    return aggregate(retained(facts), WEB_RETENTION, {"retention_count": "count(1)"})
