"""Per-event facts from the ordered history of each device, with state carried between batches.

`step(events, clicks, state)` is the one function behind batch replay and micro-batches: it resolves when each device
was activated and by which click, then derives for every event whether it opens something (device, day, registration,
payer). Events are ordered by `(ts, event_id)`; a registration or payment counts from the activation time on.

One shuffle of the events serves all windows. Devices with very many events are cut into even ranges of their time line,
whatever the times are: windows run per `(device, slice)`, and what earlier slices contribute comes from one summary a
slice, added up along the line.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortrail.functions import scalars as S
from cohortrail.operators import attribution as A
from cohortrail.operators.skew import HOT_ROWS, HotKeys, heaviest, materialize
from cohortrail.schemas import DEVICE_KEYS, DEVICE_STATE, LAUNCH, ORGANIC, PAY, REG, WEB_KEYS, WEB_STATE

SLICE = "slice"
# Devices per shuffle partition up to which their side of a join is hashed in memory; beyond, both sides are sorted.
HASHED_ROWS = 2_000_000
_WHOLE = "-1"  # the slice of devices that are not cut

_LAUNCH, _REG, _PAY = (f"kind = '{k}'" for k in (LAUNCH, REG, PAY))
# A launch that does not lie before the last one already in state.
_ON_TIME = "coalesce(ts >= s_last_launch_time, true)"
_SINCE_ACTIVE = "coalesce(active_time <= ts, false)"

# What earlier events of the device contribute to a row: the latest of each.
APP_MEASURES = {
    "launch": f"CASE WHEN {_LAUNCH} AND {_ON_TIME} THEN ts END",
    "reg": f"CASE WHEN {_REG} AND {_SINCE_ACTIVE} THEN ts END",
    "pay": f"CASE WHEN {_PAY} AND {_SINCE_ACTIVE} THEN ts END",
}
WEB_MEASURES = {"launch": f"CASE WHEN {_ON_TIME} THEN ts END"}


class Step(NamedTuple):
    """Every event of the batch is in `facts` or in `rejects`."""

    facts: DataFrame
    rejects: DataFrame
    state: DataFrame  # complete rows of the devices this batch touched
    devices: DataFrame  # the resolved devices, a row each


def _unusable(rules: dict[str, str]) -> str:
    """The reason why an event can't be placed in the history of a device, or null."""
    return "CASE " + " ".join(f"WHEN {column} IS NULL THEN '{reason}'" for column, reason in rules.items()) + " END"


APP_UNUSABLE = _unusable({"app_id": "app", "device_id": "identity", "ts": "time"})
WEB_UNUSABLE = _unusable({"media_clickid": "identity", "ts": "time"})


def _hashed(devices: DataFrame, n: int) -> DataFrame:
    """A hash join leaves the one sort of the events to the windows, which use the same partitioning. It can't spill,
    so it is asked for only while the devices of a partition are known to be few."""
    partitions = int(devices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return devices.hint("shuffle_hash") if n <= HASHED_ROWS * partitions else devices


def first_launches(events: DataFrame, launches_only: bool = False) -> DataFrame:
    """One row per device: number of events and the first launch with the ids it was reported under.

    Counting all events needs no more than the keys and hash aggregation; only launches bring their ids along. With
    `launches_only`, where all events are launches, one pass does both.
    """
    first = f"min(struct(ts, event_id, os, {', '.join(A.MATCH_COLUMNS)})) AS first"
    if launches_only:
        both = events.groupBy(*DEVICE_KEYS).agg(F.expr("count(1) AS n"), F.expr(first))
        return both.select(*DEVICE_KEYS, "n", "first.*")
    counted = events.groupBy(*DEVICE_KEYS).agg(F.expr("count(1) AS n"))
    launched = events.where(_LAUNCH).groupBy(*DEVICE_KEYS).agg(F.expr(first)).select(*DEVICE_KEYS, "first.*")
    return counted.join(launched, DEVICE_KEYS, "left")


def _with_state(firsts: DataFrame, state: DataFrame | None, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """Devices of the batch with their state columns, prefixed `s_`; all null where there is none."""
    fields = [f for f in schema if f.name not in keys]
    if state is None:
        return firsts.selectExpr("*", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS s_{f.name}" for f in fields])
    return firsts.join(state.selectExpr(*keys, *[f"{f.name} AS s_{f.name}" for f in fields]), list(keys), "left")


def resolve_devices(
    firsts: DataFrame,
    clicks: DataFrame,
    state: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
    **match,
) -> DataFrame:
    """Activation time and credited plan of every device in `firsts`, a written table.

    A device known from `state` keeps what it has; only new ones are matched to clicks. Devices without any launch
    have a null `active_time`.
    """
    known = _with_state(firsts, state, DEVICE_STATE, DEVICE_KEYS)
    if state is not None:
        # Read once; the devices to be matched are counted, not those already known.
        known = materialize(known, "known", scratch)
    fresh = known.where("ts IS NOT NULL AND s_active_time IS NULL")
    credited = A.match_clicks(
        fresh.select(*DEVICE_KEYS, "os", "ts", *A.MATCH_COLUMNS), clicks, hot_rows=hot_rows, at_most=fresh.count(), **match
    ).selectExpr(*DEVICE_KEYS, "plan_id AS c_plan", "channel_id AS c_channel")
    return known.join(credited, DEVICE_KEYS, "left").selectExpr(
        *DEVICE_KEYS,
        "n",
        "coalesce(s_active_time, ts) AS active_time",
        f"coalesce(s_plan_id, c_plan, '{ORGANIC}') AS plan_id",
        f"coalesce(s_channel_id, c_channel, '{ORGANIC}') AS channel_id",
        "s_last_launch_time",
        "coalesce(s_registered, false) AS s_registered",
        "s_first_pay_time",
        "s_last_pay_date",
    )


class Line(NamedTuple):
    """Events with their slice; those of hot keys apart, as a written table that is cut by range."""

    events: DataFrame
    cut: DataFrame | None


def cut_hot(
    events: DataFrame, hot: HotKeys | None, keys: Sequence[str], name: str = "line", scratch: str | None = None
) -> Line:
    """Lay the events of hot keys on one line in the order of key, time and id, and cut it into even ranges.

    The number of a range is the slice of its events. All others have one slice. A range may hold several keys and a key
    any number of ranges, so a key's events spread evenly, also those of one minute or of the same time.
    """
    if hot is None:
        return Line(events.selectExpr("*", f"{_WHOLE} AS {SLICE}"), None)
    few = hot.spread(hot.rows)
    apart = events.join(few, list(keys), "left_semi")
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Events of the same time and id are told apart by a hash, so that even they can be cut.
    ties = f"xxhash64({', '.join(events.columns)})"
    ranged = apart.withColumn("tie", F.expr(ties)).repartitionByRange(n, *keys, "ts", "event_id", "tie").drop("tie")
    cut = materialize(ranged.withColumn(SLICE, F.expr("spark_partition_id()")), name, scratch)
    rest = events.join(few, list(keys), "left_anti").selectExpr("*", f"{_WHOLE} AS {SLICE}")
    return Line(rest.unionByName(cut), cut)


def carry(
    line: Line, devices: DataFrame, keys: Sequence[str], measures: dict[str, str], needs: Sequence[str]
) -> DataFrame:
    """Devices, spread over the slices of their events, with `carry_*`: each measure's maximum over earlier slices.

    A parallel prefix scan: one summary of each slice and key, and a running maximum over these few. A device that is not
    hot has one slice and nothing before it. `needs` are the device columns the measures use.
    """
    if line.cut is None:
        nothing = [f"CAST(NULL AS timestamp_ntz) AS carry_{m}" for m in measures]
        return devices.selectExpr("*", f"{_WHOLE} AS {SLICE}", *nothing)
    summaries = (
        line.cut.join(devices.select(*keys, *needs), list(keys))
        .groupBy(*keys, SLICE)
        .agg(*[F.expr(f"max({c}) AS {m}") for m, c in measures.items()])
    )
    earlier = f"PARTITION BY {', '.join(keys)} ORDER BY {SLICE} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    carried = summaries.selectExpr(*keys, SLICE, *[f"max({m}) OVER ({earlier}) AS carry_{m}" for m in measures])
    return devices.join(carried, list(keys), "left").withColumn(SLICE, F.expr(f"coalesce({SLICE}, {_WHOLE})"))


def _latest_before(keys: Sequence[str], measure: str) -> str:
    """Latest `measure` among the events before the current one in `(ts, event_id)` order."""
    return (
        f"max({measure}) OVER (PARTITION BY {', '.join(keys)}, {SLICE} ORDER BY ts, event_id"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )


_LATE = "coalesce(ts < s_last_launch_time, false)"
_NEW = "prev_launch_time IS NULL"
_NEW_TODAY = f"NOT {_LATE} AND ({_NEW} OR to_date(prev_launch_time) < to_date(ts))"


def step(
    events: DataFrame,
    clicks: DataFrame,
    state: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
    **match,
) -> Step:
    """Facts, rejects and the new state of the devices touched.

    Events without app, device or time are rejects (`app`, `identity`, `time`), as are registrations and payments
    without an activation. `state` may be a function of the devices of the batch (a written table of their keys).

    A launch older than the device's last one in state is `late`: it is a launch and nothing else. A payment on a day
    not after the last pay day in state opens no payer-day. State never moves back. `match` goes to
    `attribution.match_clicks`; `scratch` is a folder for the intermediate device tables, overwritten. With it, the
    resolved devices are written too, so that state and clicks are read once for all three results.
    """
    unusable = events.selectExpr(f"{APP_UNUSABLE} AS reason", *events.columns).where("reason IS NOT NULL")
    events = events.where(f"{APP_UNUSABLE} IS NULL")
    firsts = materialize(first_launches(events), "firsts", scratch)
    hot = heaviest(firsts, DEVICE_KEYS, hot_rows)
    if callable(state):
        state = state(firsts.select(*DEVICE_KEYS))
    devices = resolve_devices(firsts, clicks, state, hot_rows, scratch, **match)
    if scratch is not None:
        devices = materialize(devices, "devices", scratch)
    line = cut_hot(events, hot, DEVICE_KEYS, "line", scratch)
    spread = carry(line, devices, DEVICE_KEYS, APP_MEASURES, ["active_time", "s_last_launch_time"])
    joined = (
        line.events
        .join(_hashed(spread.drop("n"), firsts.count()), [*DEVICE_KEYS, SLICE])
        .selectExpr("*", f"({_LAUNCH} OR {_SINCE_ACTIVE}) AS valid")
    )
    windowed = joined.where("valid").selectExpr(
        "*",
        f"coalesce({_latest_before(DEVICE_KEYS, APP_MEASURES['launch'])}, carry_launch, s_last_launch_time)"
        " AS prev_launch_time",
        f"coalesce({_latest_before(DEVICE_KEYS, APP_MEASURES['reg'])}, carry_reg) AS prev_reg",
        f"coalesce({_latest_before(DEVICE_KEYS, APP_MEASURES['pay'])}, carry_pay) AS prev_pay",
    )
    status = S.pay_status(
        "prev_pay IS NOT NULL OR s_first_pay_time IS NOT NULL",
        "greatest(to_date(prev_pay), s_last_pay_date) >= to_date(ts)",
        "to_date(active_time) = to_date(ts)",
    )
    passed = [c for c in events.columns if c not in (*DEVICE_KEYS, "kind", "ts", "event_id", "amount")]
    facts = windowed.selectExpr(
        *DEVICE_KEYS,
        "kind",
        "ts",
        "event_id",
        "to_date(ts) AS stat_date",
        "plan_id",
        "channel_id",
        "active_time",
        "to_date(active_time) AS active_date",
        "prev_launch_time",
        f"CAST({_LAUNCH} AND {_NEW} AS int) AS is_new",
        f"CAST({_LAUNCH} AND {_NEW_TODAY} AS int) AS new_today",
        f"CAST({_LAUNCH} AND {_LATE} AS int) AS late",
        f"CAST({_REG} AND prev_reg IS NULL AND NOT s_registered AS int) AS new_reg",
        f"CASE WHEN {_PAY} THEN {status} END AS pay_status",
        "amount",
        *passed,
    )
    rejects = joined.where("NOT valid").selectExpr("'no_activation' AS reason", *events.columns)
    return Step(facts, rejects.unionByName(unusable), _next_state(joined), devices)


_CARRIED_OVER = ["plan_id", "channel_id", "active_time", "s_last_launch_time", "s_registered", "s_first_pay_time", "s_last_pay_date"]


def _next_state(joined: DataFrame) -> DataFrame:
    """State after the batch; needs no order, only minima and maxima."""
    return _moved_on(joined.where("active_time IS NOT NULL AND valid"), [*DEVICE_KEYS, *_CARRIED_OVER])


def state_after(facts: DataFrame, devices: DataFrame) -> DataFrame:
    """The state of a step from its facts and devices, where both are written: few columns are read, and no event is
    shuffled and joined again."""
    kept = devices.where("active_time IS NOT NULL").select(*DEVICE_KEYS, *_CARRIED_OVER)
    return _moved_on(facts.select(*DEVICE_KEYS, "kind", "ts"), DEVICE_KEYS, kept)


def _moved_on(counted: DataFrame, by: Sequence[str], devices: DataFrame | None = None) -> DataFrame:
    seen = counted.groupBy(*by).agg(
        F.expr(f"max(CASE WHEN {_LAUNCH} THEN ts END) AS launch"),
        F.expr(f"count_if({_REG}) AS regs"),
        F.expr(f"min(CASE WHEN {_PAY} THEN ts END) AS pay"),
        F.expr(f"max(CASE WHEN {_PAY} THEN to_date(ts) END) AS pay_day"),
    )
    return (seen if devices is None else seen.join(devices, DEVICE_KEYS)).selectExpr(
        *DEVICE_KEYS,
        "plan_id",
        "channel_id",
        "active_time",
        "greatest(s_last_launch_time, launch) AS last_launch_time",
        "s_registered OR regs > 0 AS registered",
        "coalesce(s_first_pay_time, pay) AS first_pay_time",
        "greatest(s_last_pay_date, pay_day) AS last_pay_date",
    )


def state_to_text(state: DataFrame) -> DataFrame:
    """Export form of the device state: key `app-device`, value a JSON object of four texts, and the key's two parts."""
    return state.selectExpr(
        *DEVICE_KEYS,
        "concat_ws('-', app_id, device_id) AS state_key",
        f"to_json(named_struct('activetime', {S.time_text('active_time')},"
        f" 'launchtime', {S.time_text('last_launch_time')},"
        " 'planid', plan_id, 'channelid', channel_id)) AS state_value",
    )


def state_from_text(exported: DataFrame) -> DataFrame:
    """Inverse of `state_to_text`, to second precision; registration and payment history are not in the text.

    Where only the key is there, not its parts, it is cut before a hashed device id, else at its first dash, as device
    ids may hold dashes.
    """
    parts = DEVICE_KEYS
    if not set(DEVICE_KEYS) <= set(exported.columns):
        hashed = "state_key RLIKE '-[0-9a-f]{32}$'"
        app = f"IF({hashed}, left(state_key, length(state_key) - 33), substring_index(state_key, '-', 1))"
        parts = [f"{app} AS app_id", f"substr(state_key, length({app}) + 2) AS device_id"]
    return exported.selectExpr(
        *parts,
        "from_json(state_value, 'activetime string, launchtime string, planid string, channelid string') AS v",
    ).selectExpr(
        *DEVICE_KEYS,
        "v.planid AS plan_id",
        "v.channelid AS channel_id",
        f"{S.parse_time('v.activetime')} AS active_time",
        f"{S.parse_time('v.launchtime')} AS last_launch_time",
    )


def web_step(
    events: DataFrame,
    state: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
) -> Step:
    """Web launches: the click id is the device, plan and creative come with the event. Events without click id or time
    are rejects (`identity`, `time`)."""
    unusable = events.selectExpr(f"{WEB_UNUSABLE} AS reason", *events.columns).where("reason IS NOT NULL")
    events = events.where(f"{WEB_UNUSABLE} IS NULL")
    firsts = events.groupBy(*WEB_KEYS).agg(F.expr("count(1) AS n"), F.expr("min(ts) AS first_ts"))
    firsts = materialize(firsts, "web-firsts", scratch)
    hot = heaviest(firsts, WEB_KEYS, hot_rows)
    if callable(state):
        state = state(firsts.select(*WEB_KEYS))
    devices = _with_state(firsts, state, WEB_STATE, WEB_KEYS).selectExpr(
        *WEB_KEYS, "coalesce(s_active_time, first_ts) AS active_time", "s_last_launch_time"
    )
    if scratch is not None:
        devices = materialize(devices, "web-devices", scratch)
    line = cut_hot(events, hot, WEB_KEYS, "web-line", scratch)
    spread = carry(line, devices, WEB_KEYS, WEB_MEASURES, ["s_last_launch_time"])
    joined = line.events.join(_hashed(spread, firsts.count()), [*WEB_KEYS, SLICE])
    facts = joined.selectExpr(
        "*",
        f"coalesce({_latest_before(WEB_KEYS, WEB_MEASURES['launch'])}, carry_launch, s_last_launch_time)"
        " AS prev_launch_time",
    ).selectExpr(
        *events.columns,
        "to_date(ts) AS stat_date",
        "active_time",
        "to_date(active_time) AS active_date",
        "prev_launch_time",
        f"CAST({_NEW} AS int) AS is_new",
        f"CAST({_NEW_TODAY} AS int) AS new_today",
        f"CAST({_LATE} AS int) AS late",
    )
    new_state = (
        joined.groupBy(*WEB_KEYS, "active_time", "s_last_launch_time")
        .agg(F.expr("max(ts) AS launch"))
        .selectExpr(*WEB_KEYS, "active_time", "greatest(s_last_launch_time, launch) AS last_launch_time")
    )
    return Step(facts, unusable, new_state, devices)
