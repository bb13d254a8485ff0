"""Exact distinct counts of devices that can be added up over batches: bitmaps of device numbers.

Devices get dense numbers, bucket by bucket: the n-th device of bucket b has the number n * buckets + b, so that new ones
are numbered within their buckets and no task sees all of them. A group of devices is a set of bitmaps, one for each
range of numbers that occurs; the union of two sets is a bitwise or. A union changes nothing when it is made twice, so a
batch that is counted again, a device that comes twice and a set that is merged late all leave a count as it is, where a
sum of first-of flags would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from cohortrail.operators.stats import retained
from cohortrail.schemas import DEVICE_KEYS, PAY

NUMBER = "device_nr"
RANGE, BITS = "device_range", "devices"
BUCKETS = 256

ACTIVE_KEYS = ["app_id", "plan_id", "stat_date"]
RETENTION_KEYS = ["app_id", "plan_id", "active_date", "retention_days"]


def bitmap_schema(keys: StructType) -> StructType:
    return StructType([*keys.fields, StructField(RANGE, LongType()), StructField(BITS, BinaryType())])


def numbered(devices: DataFrame, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Numbers of those `devices` (`app_id, device_id`) that have none in `known`, which has `device_nr`.

    `known` must hold all numbers given out so far in the buckets of `devices`. Devices of one batch are numbered by their
    ids, so that a re-run on the same `known` gives the same numbers.
    """
    bucket = f"pmod(xxhash64({', '.join(DEVICE_KEYS)}), {buckets}) AS bucket"
    new = devices.select(*DEVICE_KEYS).distinct().selectExpr("*", bucket)
    last = "-1L"
    if known is not None:
        new = new.join(known.select(*DEVICE_KEYS), DEVICE_KEYS, "left_anti")
        taken = known.groupBy(F.expr(f"pmod({NUMBER}, {buckets}) AS bucket")).agg(F.expr(f"max({NUMBER} DIV {buckets}) AS last"))
        new = new.join(taken, "bucket", "left")
        last = "coalesce(last, -1L)"
    nr = f"row_number() OVER (PARTITION BY bucket ORDER BY {', '.join(DEVICE_KEYS)})"
    return new.selectExpr(*DEVICE_KEYS, f"CAST(({last} + {nr}) * {buckets} + bucket AS bigint) AS {NUMBER}")


def sets(rows: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and range of numbers, the devices of `rows` as a bitmap. `numbers` has every device of `rows`."""
    placed = rows.select(*keys, *[c for c in DEVICE_KEYS if c not in keys]).distinct().join(numbers, DEVICE_KEYS)
    placed = placed.selectExpr(
        *keys, f"bitmap_bucket_number({NUMBER}) AS {RANGE}", f"bitmap_bit_position({NUMBER}) AS at"
    )
    return placed.groupBy(*keys, RANGE).agg(F.expr(f"bitmap_construct_agg(at) AS {BITS}"))


def union(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and range, whatever rows hold it: the fold of sets from any number of batches."""
    return parts.groupBy(*keys, RANGE).agg(F.expr(f"bitmap_or_agg({BITS}) AS {BITS}"))


def counted(merged: DataFrame, keys: Sequence[str], name: str = "device_count") -> DataFrame:
    """Number of devices per key, of rows that `union` made or that are one per key and range anyway.

    `keys` may be fewer than those of `union` only if a device is in no two of the sets that fall together.
    """
    return merged.groupBy(*keys).agg(F.expr(f"CAST(sum(bitmap_count({BITS})) AS bigint) AS {name}"))


def active(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """Devices that launched, per app, plan and day."""
    return sets(facts.where("kind = 'launch'"), numbers, ACTIVE_KEYS)


def paying(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """Devices that paid, per app, plan and day."""
    return sets(facts.where(f"kind = '{PAY}'"), numbers, ACTIVE_KEYS)


def returning(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """Devices of a cohort that came back, per app, plan, activation day and age."""
    return sets(retained(facts), numbers, RETENTION_KEYS)


def over_days(days: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """Devices active within the last n days up to each day that occurs, for each n of `lengths`: the union of its days'
    sets, which no sum of daily counts could give. `days` has one row per app, plan, day and range."""
    spans = ", ".join(f"{int(n)}" for n in lengths)
    ends = days.select("app_id", "plan_id", "stat_date").distinct()
    # Each day's set goes to the days it counts for, as many as the spans have.
    each = days.selectExpr("app_id", "plan_id", "stat_date AS own", RANGE, BITS, f"explode(array({spans})) AS days")
    sent = each.selectExpr(
        "app_id", "plan_id", "days", RANGE, BITS, "explode(sequence(own, date_add(own, days - 1))) AS stat_date"
    )
    kept = sent.join(ends, ["app_id", "plan_id", "stat_date"], "left_semi")
    return counted(union(kept, ["app_id", "plan_id", "stat_date", "days"]), ["app_id", "plan_id", "stat_date", "days"])
