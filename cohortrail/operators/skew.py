"""Joins and groupings that stay balanced when one key holds a large share of the rows.

Finding hot keys is an action of its own: a count per key with map-side combine, whose hot keys are written as a table
and counted. Knowing them before the main job is planned keeps the common case, no hot key at all, free of branches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrail.session import shared_dir

# A key is worth special care only from this many rows on; below, one task copes with it.
HOT_ROWS = 2_000_000
# Hot keys up to this number are broadcast; more of them are joined by shuffle, where adaptive skew joins split them.
MAX_HOT = 1000


class HotKeys(NamedTuple):
    """A written table of all hot keys, and whether they are few."""

    rows: DataFrame
    few: bool

    def spread(self, df: DataFrame) -> DataFrame:
        """`df`, which has at most a row per hot key, with a broadcast hint while they are few."""
        return F.broadcast(df) if self.few else df


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage of a table that several later plans use, survives lost executors, and gives the optimizer
    its true size for choosing joins. Each call takes a folder of its own; a caller that runs for ever names one
    and has it overwritten.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}" if folder is None else f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *writes: Callable[[], object]) -> None:
    """Run writes that do not need each other's results side by side: one fills the cores that another's last tasks leave
    free. The first fault is raised after all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()


def heaviest(
    counted: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, count: str = "n"
) -> HotKeys | None:
    """All keys of `counted` (one row per key) that hold `hot_rows` rows or more; None if there are none.

    The first MAX_HOT + 1 of them tell nearly always what there is to know; only more are written as a table.
    """
    hot = counted.where(f"{count} >= {hot_rows}").select(*keys)
    rows = hot.limit(MAX_HOT + 1).collect()
    if not rows:
        return None
    if len(rows) <= MAX_HOT:
        return HotKeys(counted.sparkSession.createDataFrame(rows, hot.schema), True)
    return HotKeys(materialize(hot, "hot-keys"), False)


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> HotKeys | None:
    return heaviest(rows.groupBy(*keys).agg(F.expr("count(1) AS n")), keys, hot_rows)


def join_unique(
    rows: DataFrame, unique: DataFrame, keys: Sequence[str], how: str = "inner", hot: HotKeys | None = None
) -> DataFrame:
    """Join `rows` (any number per key) to `unique` (at most one row per key).

    Rows of the keys in `hot` are joined where they lie, against a broadcast, while these are at most MAX_HOT; only the
    rest is shuffled by key.
    """
    keys = list(keys)
    if how not in ("inner", "left"):
        raise ValueError(how)
    if hot is None:
        return rows.join(unique, keys, how)
    if not hot.few:
        # Too many to broadcast: a plain join, in which large partitions are split at run time.
        return rows.join(unique, keys, how)
    few = F.broadcast(hot.rows)
    hot_side = unique.join(few, keys, "left_semi")
    if how == "left":
        hot_side = hot.rows.join(hot_side, keys, "left")
    in_place = rows.join(F.broadcast(hot_side), keys, "inner")
    shuffled = rows.join(few, keys, "left_anti").join(unique, keys, how)
    return in_place.unionByName(shuffled)
