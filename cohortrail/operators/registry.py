"""Onboarding state of apps: which of the three signals each has sent, and the step that follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.operators.skew import HOT_ROWS, hot_keys, join_unique
from cohortrail.operators.stats import of_parts
from cohortrail.schemas import LAUNCH, PAY, REG

# Fixed value: an app at this step or beyond is fully onboarded and no longer changes.
DONE = 3
SIGNALS = {"active": LAUNCH, "reg": REG, "pay": PAY}


def signals(facts: DataFrame) -> DataFrame:
    """Per app, which signals occurred: flags 0/1 by maximum, combined on the map side."""
    return facts.groupBy("app_id").agg(
        *[F.expr(f"CAST(max(if(kind = '{kind}', 1, 0)) AS int) AS {flag}") for flag, kind in SIGNALS.items()]
    )


def signals_of_parts(parts: DataFrame) -> DataFrame:
    """The same from the statistics that `stats.parts` made of the facts."""
    daily = parts.where("stat = 'daily'")
    counts = dict(zip(SIGNALS, ("launch_count", "reg_count", "pay_count"), strict=True))
    rows = of_parts(daily, "daily")
    return rows.groupBy("app_id").agg(
        *[F.expr(f"CAST(max(if({count} > 0, 1, 0)) AS int) AS {flag}") for flag, count in counts.items()]
    )


def _step_of(flags: dict[str, str]) -> str:
    all_set = " AND ".join(f"{f} > 0" for f in flags.values())
    return f"CASE WHEN {all_set} THEN {DONE} ELSE {DONE - 1} END"


def funnel(facts: DataFrame) -> DataFrame:
    """Signals and step of apps that start with nothing."""
    return signals(facts).selectExpr("*", f"{_step_of({n: n for n in SIGNALS})} AS app_step")


def merge(registry: DataFrame, seen: DataFrame) -> DataFrame:
    """New registry snapshot. Flags only rise; apps already done and apps without events stay as they are."""
    changes = f"seen_app IS NOT NULL AND app_step < {DONE}"
    new = {n: f"greatest(coalesce(app_event.{n}, 0), coalesce({n}, 0))" for n in SIGNALS}
    struct = ", ".join(f"'{n}', CAST({e} AS int)" for n, e in new.items())
    return registry.join(seen.selectExpr("*", "app_id AS seen_app"), "app_id", "left").selectExpr(
        "app_id",
        f"CAST(CASE WHEN {changes} THEN {_step_of(new)} ELSE app_step END AS int) AS app_step",
        f"CASE WHEN {changes} THEN named_struct({struct}) ELSE app_event END AS app_event",
    )


def flag_unknown_apps(tagged: DataFrame, registry: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Give rows of an unregistered app the reason `app`, keeping any earlier reason.

    Few apps hold most of the events, so their rows are joined in place and only the tail is shuffled.
    """
    known = registry.selectExpr("app_id", "true AS registered_app")
    joined = join_unique(tagged, known, ["app_id"], "left", hot_keys(tagged, ["app_id"], hot_rows))
    reason = "coalesce(reason, CASE WHEN registered_app IS NULL THEN 'app' END) AS reason"
    return joined.selectExpr(*[reason if c == "reason" else c for c in tagged.columns])


# Stored text form of the flags.
EVENT_TEXT = "to_json(app_event)"


def from_text(rows: DataFrame) -> DataFrame:
    """Registry rows `id, app_step, app_event JSON text` to the typed registry."""
    return rows.selectExpr(
        "CAST(id AS string) AS app_id",
        "CAST(app_step AS int) AS app_step",
        "from_json(app_event, 'active int, reg int, pay int') AS app_event",
    )
