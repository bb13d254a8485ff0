"""Credit a new device to the ad click that brought it.

Each platform has an ordered list of match levels: ids that device and click may share. The first level with a click
not later than the launch wins, and within a level the earliest `(click_ts, click_id)` wins, so the choice is
defined where the original rule left it to storage order. Missing and placeholder ids never match.

Set-wise this is one equi-join: both sides are unpivoted to `(os, level, key)`, clicks are reduced to the earliest
per key first (a shared address costs one row, however many clicks it has), and the best level is a minimum.
If the earliest click of a key is later than the launch, so are all others of that key.

A click without a time can't be put before or after a launch: it takes no part (`undated_clicks` sets such rows apart)
and never hides a dated one. Of clicks at the same time, one without an id comes first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.functions import scalars as S
from cohortrail.operators.skew import HOT_ROWS, hot_keys, join_unique
from cohortrail.schemas import ANDROID, DEVICE_KEYS, IOS

# Match order per platform. The network address is the last resort on one platform and
# the first choice on the other. `mac` is deliberately absent: clients report shared defaults.
LEVELS: dict[int, list[str]] = {
    ANDROID: ["imei", "oaid", "androidid", "external_ip"],
    IOS: ["external_ip", "idfa"],
}
MATCH_COLUMNS = ["imei", "oaid", "androidid", "idfa", "external_ip"]

# Up to this many device keys are broadcast to the click scan; the number is checked before.
FEW_KEYS = 200_000

KEY = ["os", "level", "key"]
CLICK_COLUMNS = ["click_ts", "click_id", "plan_id", "channel_id"]


def unpivot_keys(df: DataFrame, levels: Mapping[int, Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """One row per usable key of each row: `os, <keep>, level, key`."""

    def pairs(names: Sequence[str]) -> str:
        each = [f"named_struct('level', {i}, 'key', {S.usable_id(n)})" for i, n in enumerate(names, start=1)]
        return f"array({', '.join(each)})"

    cases = " ".join(f"WHEN {os} THEN {pairs(names)}" for os, names in levels.items())
    return df.selectExpr("os", *keep, f"inline(filter(CASE os {cases} END, p -> p.key IS NOT NULL))")


def undated_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks that `match_clicks` can't use, with the reason."""
    return clicks.where("click_ts IS NULL").selectExpr("'time' AS reason", "*")


def earliest_click(offers: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per key: the first click that carries it."""
    first = F.expr(f"min(struct({', '.join(CLICK_COLUMNS)})) AS click")
    return offers.groupBy(*on).agg(first).select(*on, "click.*")


def _best_level(matched: DataFrame) -> DataFrame:
    """Per device, the click of the lowest level."""
    best = F.expr(f"min(struct(level, {', '.join(CLICK_COLUMNS)})) AS best")
    return matched.groupBy(*DEVICE_KEYS).agg(best).select(*DEVICE_KEYS, "best.*")


def match_clicks(
    devices: DataFrame,
    clicks: DataFrame | Callable[[DataFrame], DataFrame],
    levels: Mapping[int, Sequence[str]] = LEVELS,
    click_keys: Sequence[str] = (),
    lookback_days: int | None = None,
    hot_rows: int = HOT_ROWS,
    few_keys: int = FEW_KEYS,
    at_most: int | None = None,
) -> DataFrame:
    """Matched devices only: `app_id, device_id, level, click_ts, click_id, plan_id, channel_id`.

    `devices` has one row per device with its first launch (`ts` and the id columns); `at_most` bounds their number
    and is counted if not given. `click_keys=("app_id",)` also asks for the same app; clicks carry none by default.
    `lookback_days` bounds the age of a click; there is no bound by default.

    `clicks` may be a kept index instead of the clicks: a function that returns the earliest click of the keys it is
    given.
    """
    on = [*KEY, *click_keys]
    keys = unpivot_keys(devices, levels, [*DEVICE_KEYS, "ts"])
    if callable(clicks):
        if lookback_days is not None:
            raise ValueError("an index of earliest clicks can't bound their age")
        return _best_level(keys.join(clicks(keys.select(*on).distinct()), on).where("click_ts <= ts"))
    offers = unpivot_keys(clicks.where("click_ts IS NOT NULL"), levels, [*CLICK_COLUMNS, *click_keys])
    most_keys = (devices.count() if at_most is None else at_most) * max(map(len, levels.values()))
    if most_keys <= few_keys:
        # A small batch of devices against all clicks: only clicks that share a key leave the scan.
        offers = offers.join(F.broadcast(keys.select(*on).distinct()), on, "left_semi")
    if lookback_days is not None:
        keys = keys.where("ts IS NOT NULL")
        return _best_level(_first_click_since(keys, offers, on, lookback_days))
    # A shared address can be the key of very many devices; fewer devices than the limit need no look.
    hot = hot_keys(keys, on, hot_rows) if most_keys >= hot_rows else None
    return _best_level(join_unique(keys, earliest_click(offers, on), on, "inner", hot).where("click_ts <= ts"))


def _first_click_since(keys: DataFrame, offers: DataFrame, on: Sequence[str], lookback_days: int) -> DataFrame:
    """As-of join: per device key, the first click in `[launch - lookback, launch]`.

    Devices and clicks of one key are laid on one time line and cut into minutes. Inside a minute a window looks
    ahead to the next click; the first click of later minutes comes from a table with one row per minute. No pairs
    are built, and a key with very many rows is spread over its minutes.
    """
    by, cut = ", ".join(on), "date_trunc('minute', at) AS cut"
    probes = keys.selectExpr(
        *on, f"ts - INTERVAL {int(lookback_days)} DAYS AS at", "0 AS side",
        f"struct({', '.join(DEVICE_KEYS)}, ts) AS device",
    ).selectExpr("*", cut)
    offers = offers.selectExpr(
        *on, "click_ts AS at", "1 AS side", f"struct({', '.join(CLICK_COLUMNS)}) AS click"
    ).selectExpr("*", cut)
    line = probes.unionByName(offers, allowMissingColumns=True)

    minutes = line.groupBy(*on, "cut").agg(F.expr("min(click) AS first_click"))
    later = minutes.selectExpr(
        *on, "cut",
        f"min(first_click) OVER (PARTITION BY {by} ORDER BY cut DESC"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS later_click",
    )
    # Windows run backwards in time, since only frames that start with the partition are computed in one pass.
    # At equal times the probe (side 0) comes last, so a click at the very bound still counts.
    ahead = line.selectExpr(
        "*",
        f"min(click) OVER (PARTITION BY {by}, cut ORDER BY at DESC, side DESC"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS same_minute",
    )
    found = (
        ahead.where("side = 0")
        .join(later, [*on, "cut"], "left")
        .selectExpr("level", "device", "coalesce(same_minute, later_click) AS click")
    )
    return found.select("level", "device.*", "click.*").where("click_ts <= ts")
