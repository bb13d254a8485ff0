"""Statistics from device-days: one row per device and calendar day instead of one per event.

All statistics follow from device-days. A day counts a device once, so "first of the day" is the row itself, and "first
ever" is the first row of the device; windows run over days, never over events. The rollup combines on the map side, so a
device with very many events leaves each task as one row per day, and no group of events is ever gathered.

Registrations and payments count from the activation on. For all days but the one of the activation that is
decided by the day alone; `settle` recounts from events only those days that the activation instant really cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.functions import scalars as S
from cohortrail.operators.skew import HOT_ROWS, heaviest, join_unique, materialize
from cohortrail.operators.stats import DAILY, PAY_COHORT, RETENTION, aggregate
from cohortrail.operators.timeline import first_launches, resolve_devices
from cohortrail.schemas import DEVICE_KEYS, LAUNCH, PAY, REG

DAY_KEYS = [*DEVICE_KEYS, "stat_date"]

_LAUNCH, _REG, _PAY = (f"kind = '{k}'" for k in (LAUNCH, REG, PAY))


def _first(name: str, kind: str) -> dict[str, str]:
    """Time and order key of the first event of a kind."""
    return {f"{name}_ts": f"min(ts) FILTER (WHERE {kind})", f"{name}_order": f"min(ord) FILTER (WHERE {kind})"}


# All of these are numbers, so hash aggregation combines them on the map side without a sort.
_LAUNCH_MEASURES = {"launches": f"count_if({_LAUNCH})", **_first("launch", _LAUNCH)}
_LATER_MEASURES = {
    "regs": f"count_if({_REG})",
    "pays": f"count_if({_PAY})",
    "pay_amount": S.sum_if(_PAY, "amount"),
    **_first("reg", _REG),
    **_first("pay", _PAY),
}
_FIRST_AMOUNT = {"first_amount": "min(struct(ts, event_id, amount)).amount"}


def _dated(events: DataFrame) -> DataFrame:
    order = f"{S.order_key('ts', 'event_id')} AS ord"
    return events.selectExpr(*DEVICE_KEYS, "to_date(ts) AS stat_date", "kind", "ts", "event_id", "amount", order)


def _measures(rows: DataFrame, measures: dict[str, str]) -> DataFrame:
    return rows.groupBy(*DAY_KEYS).agg(*[F.expr(f"{e} AS {m}") for m, e in measures.items()])


def _with_first_amount(measured: DataFrame, rows: DataFrame) -> DataFrame:
    """The amount of the day's first payment is no plain minimum; only payments are sorted for it."""
    return measured.join(_measures(rows.where(_PAY), _FIRST_AMOUNT), DAY_KEYS, "left")


def device_days(events: DataFrame) -> DataFrame:
    """Counts, amounts and first events per device and day, before any validity rule."""
    rows = _dated(events)
    return _with_first_amount(_measures(rows, {"n": "count(1)", **_LAUNCH_MEASURES, **_LATER_MEASURES}), rows)


def resolved(events: DataFrame, clicks: DataFrame, hot_rows: int = HOT_ROWS, **match) -> DataFrame:
    """Activated devices with their plan and activation day."""
    firsts = materialize(first_launches(events.where(_LAUNCH), launches_only=True), "firsts")
    return resolve_devices(firsts, clicks, None, hot_rows, **match).selectExpr(
        *DEVICE_KEYS, "plan_id", "channel_id", "active_time", "to_date(active_time) AS active_date"
    )


def settled_days(events: DataFrame, clicks: DataFrame, hot_rows: int = HOT_ROWS, **match) -> DataFrame:
    """Device-days with the plan of the device and valid measures only, and the first days of the device.

    `match` goes to `attribution.match_clicks`.
    """
    devices = resolved(events, clicks, hot_rows, **match)
    days = device_days(events).join(devices, DEVICE_KEYS).where("stat_date >= active_date")
    return _first_days(settle(materialize(days, "device-days"), events, hot_rows))


def settle(days: DataFrame, events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace the registration and payment measures of days cut by the activation with those from it on.

    Only a day whose earliest registration or payment lies before the activation is cut. The list of such days is
    written; its size decides whether Spark broadcasts it, and hot days in it are joined in place.
    """
    is_cut = "coalesce(least(reg_ts, pay_ts) < active_time, false)"
    cut = materialize(days.where(is_cut).select(*DAY_KEYS, "active_time", "n"), "cut-days")
    later = _dated(events.where(f"kind IN ('{REG}', '{PAY}')"))
    hot = heaviest(cut, DAY_KEYS, hot_rows)
    kept = join_unique(later, cut.drop("n"), DAY_KEYS, "inner", hot).where("active_time <= ts").drop("active_time")
    recount = _with_first_amount(_measures(kept, _LATER_MEASURES), kept)
    replaced = [*_LATER_MEASURES, *_FIRST_AMOUNT]
    renamed = recount.selectExpr(*DAY_KEYS, *[f"{m} AS new_{m}" for m in replaced])
    zero = {"regs": "0L", "pays": "0L", "pay_amount": f"CAST(0 AS {S.MONEY_TYPE})"}
    return days.join(renamed, DAY_KEYS, "left").selectExpr(
        *[c for c in days.columns if c not in replaced],
        *[
            f"CASE WHEN {is_cut} THEN {f'coalesce(new_{m}, {zero[m]})' if m in zero else f'new_{m}'} ELSE {m} END AS {m}"
            for m in replaced
        ],
    )


def _first_days(days: DataFrame) -> DataFrame:
    def first_day(measure: str) -> str:
        return f"min(CASE WHEN {measure} > 0 THEN stat_date END) OVER (PARTITION BY {', '.join(DEVICE_KEYS)})"

    return days.selectExpr(
        "*", f"{first_day('regs')} AS first_reg_date", f"{first_day('pays')} AS first_pay_date"
    ).where("launches + regs + pays > 0")


def launch_days(events: DataFrame, clicks: DataFrame, hot_rows: int = HOT_ROWS, **match) -> DataFrame:
    """Device-days of launches alone, with the plan of the device. Launches are always valid."""
    days = _measures(_dated(events.where(_LAUNCH)), _LAUNCH_MEASURES)
    return days.join(resolved(events, clicks, hot_rows, **match), DEVICE_KEYS)


_LAUNCHED = "launches > 0"
DAILY_LAUNCH = {
    "launch_count": "sum(launches)",
    "active_count": S.count_if(f"{_LAUNCHED} AND stat_date = active_date"),
    "vibrant_count": S.count_if(_LAUNCHED),
}
DAILY_REG = {"reg_count": "sum(regs)", "onlyreg_count": S.count_if("regs > 0 AND stat_date = first_reg_date")}
DAILY_PAY = {"pay_count": "sum(pays)", "pay_amount": "sum(pay_amount)"}
_NOTHING = {m: "max(0)" for m in (*DAILY.counts, *DAILY.money)}


def _earliest(part: str) -> str:
    return f"least(launch_{part}, reg_{part}, pay_{part})"


def daily(days: DataFrame) -> DataFrame:
    measures = {**DAILY_LAUNCH, **DAILY_REG, **DAILY_PAY}
    return aggregate(days, DAILY, measures, _earliest("ts"), _earliest("order"))


def daily_launches(days: DataFrame) -> DataFrame:
    """Launch measures, from `settled_days` or `launch_days`; the other measures are 0."""
    return aggregate(days.where(_LAUNCHED), DAILY, {**_NOTHING, **DAILY_LAUNCH}, "launch_ts", "launch_order")


def daily_regs(days: DataFrame) -> DataFrame:
    return aggregate(days.where("regs > 0"), DAILY, {**_NOTHING, **DAILY_REG}, "reg_ts", "reg_order")


def daily_pays(days: DataFrame) -> DataFrame:
    return aggregate(days.where("pays > 0"), DAILY, {**_NOTHING, **DAILY_PAY}, "pay_ts", "pay_order")


def retention(days: DataFrame) -> DataFrame:
    """Device-days with launches after the activation day, from `settled_days` or `launch_days`."""
    age = S.day_number("active_date", "stat_date")
    later = days.where(f"{_LAUNCHED} AND {age} > 1").selectExpr("*", f"{age} AS retention_days")
    return aggregate(later, RETENTION, {"retention_count": "count(1)"}, "launch_ts", "launch_order")


def pay_cohort(days: DataFrame) -> DataFrame:
    paid = days.where("pays > 0").selectExpr(
        "*", f"{S.day_number('active_date', 'stat_date')} AS pay_days", "stat_date AS pay_date"
    )
    new_payer, active_today = "stat_date = first_pay_date", "stat_date = active_date"
    measures = {
        "pay_count": "sum(pays)",
        "pay_amount": "sum(pay_amount)",
        "pay_new_devices": S.count_if(new_payer),
        "pay_new_amount": S.sum_if(new_payer, "first_amount"),
        "pay_total_devices": "count(1)",
        "pay_active_count": f"coalesce(sum(pays) FILTER (WHERE {active_today}), 0)",
        "pay_active_amount": S.sum_if(active_today, "pay_amount"),
    }
    return aggregate(paid, PAY_COHORT, measures, "pay_ts", "pay_order")
