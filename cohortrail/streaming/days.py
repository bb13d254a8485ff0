"""Statistics kept current by day: each batch replaces the days it touches, and reading a day reads one folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortrail.operators import stats
from cohortrail.operators.skew import materialize
from cohortrail.operators.stats import StatTable
from cohortrail.schemas import FIRST
from cohortrail.streaming.bucketed import BucketedTable

_EPOCH = date(1970, 1, 1)


class DayTable(BucketedTable):
    """`day` is the day of the events that a row counts, as SQL over the key; `rows` turns facts into the rows that the
    statistic counts; `name` is its name in `stats.parts`.

    Facts can be taken back: their statistics are subtracted, and a row that counts nothing any more goes. The
    description of a row is that of its first event. Where that event was taken back, the facts of that day tell the next.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        table: StatTable,
        day: str,
        rows: Callable[[DataFrame], DataFrame],
        name: str,
    ):
        super().__init__(
            spark, root, schema, lambda found: found, table.keys, compact_every=1, bucket=f"unix_date({day})"
        )
        self.stat, self.day, self.counted, self.name = table, day, rows, name

    def read(self, before: int, only: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
        if only is not None:
            raise ValueError("read by day")
        return self._of(before, None)

    def read_days(self, before: int, days: Sequence[date]) -> DataFrame:
        """The rows of some days; no other folder is read."""
        return self._of(before, [(d - _EPOCH).days for d in days])

    def _of(self, before: int, wanted: Sequence[int] | None) -> DataFrame:
        found = self.stored(before, wanted)
        return self.spark.createDataFrame([], self.schema) if found is None else found

    def update(
        self,
        batch_id: int,
        parts: DataFrame,
        old_parts: DataFrame | None = None,
        facts: tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]] | None = None,
        scratch: str | None = None,
    ) -> None:
        """Count what `parts` holds of the new facts, and take back `old_parts`, of facts that were counted before.

        With old ones, `facts` gives the new facts, the old facts, and a function for all facts as of this batch on the
        days of a table with the column `stat_date`.
        """
        deltas = stats.of_parts(parts, self.name)
        if old_parts is not None:
            deltas = deltas.unionByName(stats.taken_back(stats.of_parts(old_parts, self.name), self.stat))
        name = self.root.rsplit("/", 1)[-1]
        deltas = materialize(self._typed(deltas), f"{name}-deltas", scratch)
        days = self.touched(deltas)
        folded = stats.merge_deltas(deltas.unionByName(self._of(batch_id, days)), self.stat)
        folded = folded.where(" + ".join(self.stat.counts) + " > 0")
        if old_parts is not None:
            folded = self._mended(folded, *facts, scratch)
        self._write_base(self._typed(folded), batch_id + 1)
        filled = self._filled(batch_id + 1)
        kept = self.places(batch_id).where(~F.col("bucket").isin(days))
        self._write_places(kept.unionByName(filled), batch_id + 1)

    def _mended(self, folded: DataFrame, new: DataFrame, old: DataFrame, facts_of, scratch: str | None) -> DataFrame:
        """Rows whose first event was taken back get the description of the next one."""
        name, keys = self.root.rsplit("/", 1)[-1], self.stat.keys
        folded = materialize(self._typed(folded), f"{name}-folded", scratch)
        # Only the first events of rows matter, which are few.
        first = [*keys, "ts", "event_id"]
        heads = folded.selectExpr(*keys, f"{FIRST[0]} AS ts", f"{FIRST[1]} AS event_id")
        # An event whose description changed is one that left, too.
        place = list(dict.fromkeys([*first, *self.stat.described]))
        gone, stays = (self.counted(f).select(*place).join(heads, first, "left_semi") for f in (old, new))
        lost = gone.join(stays, place, "left_anti").selectExpr(*keys, f"ts AS {FIRST[0]}", f"event_id AS {FIRST[1]}")
        broken = folded.join(lost, [*keys, *FIRST], "left_semi").selectExpr(*keys, f"{self.day} AS event_day")
        broken = materialize(broken, f"{name}-broken", scratch)
        if broken.isEmpty():
            return folded
        rows = self.counted(facts_of(broken.selectExpr("event_day AS stat_date").distinct()))
        named = stats.firsts(rows.join(broken.select(*keys), keys, "left_semi"), self.stat)
        described = [*self.stat.described, *FIRST]
        named = named.selectExpr(*keys, *[f"{c} AS next_{c}" for c in described], "true AS mended")
        return folded.join(named, keys, "left").selectExpr(
            *[
                f"CASE WHEN mended THEN next_{c} ELSE {c} END AS {c}" if c in described else c
                for c in self.schema.fieldNames()
            ]
        )
