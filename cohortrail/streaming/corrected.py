"""A stream whose tables do not depend on the order in which events and clicks arrive, nor on how it is cut.

Device state tells up to which time a device has been seen. Events after that are worked through on the state alone. A
device of which an earlier event arrives, or an earlier click of one of its keys, is worked through again from its whole
history, which is kept by device in buckets; what its facts counted before is subtracted from the statistics, and what
they count now is added. So a launch that arrives late opens its day, closes no other by mistake, moves the activation
with its plan, and brings registrations and payments to count that came before it.

After each batch, facts and statistics are those of one batch over all events and clicks that have arrived.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Collection, Sequence
from datetime import date
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from cohortrail.operators import attribution, stats, timeline
from cohortrail.operators import registry as onboarding
from cohortrail.operators.skew import HOT_ROWS, at_once, materialize
from cohortrail.schemas import APP_EVENT, DEVICE_KEYS, DEVICE_STATE, LAUNCH
from cohortrail.sources import payload
from cohortrail.streaming.batched import BATCH, latest_per_key
from cohortrail.streaming.bucketed import BUCKETS, BucketedTable, ClickIndex
from cohortrail.streaming.days import DayTable
from cohortrail.streaming.streams import _EVENT_KEYS, APP_FACT, SIGNALS, Stream, fold_signals, stat_schema

# Rows of devices seen without an activation have nothing but the time.
SEEN = StructType([*DEVICE_STATE.fields, StructField("last_event_time", TimestampNTZType())])
# All events of a device; `fact` 0 for those that do not count (yet).
HISTORY = StructType([*APP_FACT.fields, StructField("fact", IntegerType())])
KEYED = StructType(
    [
        StructField("os", IntegerType()),
        StructField("level", IntegerType()),
        *[StructField(c, StringType()) for c in ("key", *DEVICE_KEYS)],
        StructField("active_time", TimestampNTZType()),
    ]
)
# Columns of facts that say which row of a statistic they count in, and how it is described.
DESCRIBING = ["ts", "stat_date", "plan_id", "channel_id", "active_date", "is_new", "new_today"]
DONE = StructType([StructField("done", LongType()), StructField("clicks", LongType())])


class CorrectedStream(Stream):
    """`clicks` is kept by a stream of its own; each batch reads what it has taken in by then."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        clicks: ClickIndex,
        registry: Callable[[], DataFrame] | None = None,
        hash_ids: bool = True,
        compact_every: int = 50,
        hot_rows: int = HOT_ROWS,
        buckets: int = BUCKETS,
    ):
        super().__init__(spark, root, compact_every, hot_rows)
        self.clicks, self.registry, self.hash_ids = clicks, registry, hash_ids
        self.commits = self._table("commits", DONE)
        self.facts = self._table("facts", APP_FACT, partition_by=("stat_date",))
        self.seen = self._keyed("seen", SEEN, DEVICE_KEYS, buckets)
        self.history = self._keyed("history", HISTORY, DEVICE_KEYS, buckets, _EVENT_KEYS)
        by_key = latest_per_key([*attribution.KEY, *DEVICE_KEYS], KEYED)
        self.by_key = BucketedTable(spark, f"{self.root}/by_key", KEYED, by_key, attribution.KEY, buckets, compact_every)
        self.signals = self._table("signals", SIGNALS, fold_signals)
        cohort_day = "date_add(active_date, {} - 1)"
        self.daily = self._days("stat_daily", stats.DAILY, "stat_date", lambda facts: facts, "daily")
        self.retention = self._days(
            "stat_retention", stats.RETENTION, cohort_day.format("retention_days"), stats.retained, "retention"
        )
        self.pay_cohort = self._days(
            "stat_pay", stats.PAY_COHORT, cohort_day.format("pay_days"), stats.payments, "pay"
        )

    def _days(self, folder: str, table: stats.StatTable, day: str, rows, name: str) -> DayTable:
        return DayTable(self.spark, f"{self.root}/{folder}", stat_schema(table), table, day, rows, name)

    def parse(self, raw: DataFrame) -> DataFrame:
        return payload.app_events(raw, self.hash_ids)

    def _clicks_before(self, batch_id: int) -> int:
        """Up to where the batch before had read the clicks."""
        return self.commits.read_batch(batch_id - 1).first()["clicks"] if batch_id else 0

    def _recredited(self, batch_id: int, known: int) -> DataFrame:
        """Devices with a key of which a click not later than their activation has come since the batch before."""
        keys = [*DEVICE_KEYS]
        new = self.clicks.changes(self._clicks_before(batch_id), known)
        if new is None:
            return self.spark.createDataFrame([], KEYED).select(*keys)
        new = materialize(new, "clicks", self._scratch(batch_id))
        asked = new.select(*attribution.KEY).distinct()
        held = self.by_key.read(batch_id, asked, attribution.KEY)
        return held.join(new, attribution.KEY).where("click_ts <= active_time").select(*keys).distinct()

    def apply(self, tagged: DataFrame, batch_id: int) -> None:
        tagged = self._parsed(tagged, batch_id, self.registry is not None)
        if self.registry is not None:
            tagged = onboarding.flag_unknown_apps(tagged, self.registry(), self.hot_rows)
        known_clicks = self.clicks.next_batch()
        self._count(tagged, batch_id, known_clicks)
        kept = (self.seen, self.history, self.by_key, self.signals)
        at_once(self.spark, *[lambda table=table: (table.compact(batch_id), table.tidy(batch_id)) for table in kept])
        for table in (self.daily, self.retention, self.pay_cohort):
            table.tidy(batch_id)
        done = f"CAST({batch_id} AS bigint) AS done", f"CAST({known_clicks} AS bigint) AS clicks"
        self.commits.write(self.spark.range(1).selectExpr(*done), batch_id)

    def _count(self, tagged: DataFrame, batch_id: int, known_clicks: int) -> None:
        scratch = self._scratch(batch_id)
        fresh = payload.accepted(tagged)
        usable = fresh.where(f"{timeline.APP_UNUSABLE} IS NULL")
        arrived = usable.groupBy(*DEVICE_KEYS).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        recredited = self._recredited(batch_id, known_clicks).withColumn("recredited", F.lit(True))
        touched = materialize(arrived.join(recredited, DEVICE_KEYS, "full"), "touched", scratch)
        seen = self.seen.read(batch_id, touched.select(*DEVICE_KEYS), DEVICE_KEYS)
        known = materialize(touched.join(seen, DEVICE_KEYS, "left"), "known", scratch)

        again = "last_event_time IS NOT NULL AND (active_time IS NULL OR coalesce(recredited, false) OR first_ts <= last_event_time)"
        late = materialize(known.where(again).select(*DEVICE_KEYS), "late", scratch)
        earlier = materialize(self.history.read(batch_id, late, DEVICE_KEYS), "earlier", scratch)
        replayed = earlier.select(*APP_EVENT.fieldNames()).join(fresh.select(*_EVENT_KEYS), _EVENT_KEYS, "left_anti")
        replayed = materialize(replayed, "replayed", scratch)
        on_time = known.where(f"active_time IS NOT NULL AND NOT ({again})").select(*DEVICE_STATE.fieldNames())

        before = known_clicks
        step = timeline.step(
            fresh.unionByName(replayed),
            lambda keys: self.clicks.table.read(before, keys, self.clicks.on),
            lambda devices: on_time,
            self.hot_rows,
            f"{scratch}/step",
            levels=self.clicks.levels,
        )
        at_once(
            self.spark,
            lambda: self.facts.write(step.facts, batch_id),
            lambda: materialize(step.rejects, "rejects", scratch),
        )
        facts = self.facts.read_batch(batch_id)
        rejects = self.spark.read.schema(step.rejects.schema).parquet(f"{scratch}/rejects")
        recent = self._facts_by_day(batch_id + 1)

        def keep() -> None:
            waiting = rejects.where("reason = 'no_activation'").select(*APP_EVENT.fieldNames())
            every = facts.withColumn("fact", F.lit(1)).unionByName(waiting.withColumn("fact", F.lit(0)), allowMissingColumns=True)
            told = rejects.join(earlier.select(*_EVENT_KEYS), _EVENT_KEYS, "left_anti")
            texts = told.selectExpr("reason", "kind", f"to_json(struct({', '.join(APP_EVENT.fieldNames())})) AS raw")
            at_once(
                self.spark,
                lambda: self.history.write(every, batch_id),
                lambda: self.rejects.write(payload.rejected(tagged).unionByName(texts), batch_id),
            )

        def count() -> None:
            counted = earlier.where("fact = 1").select(*APP_FACT.fieldNames())
            parts = materialize(stats.parts(facts), "parts", scratch)
            old_parts = None if counted.isEmpty() else materialize(stats.parts(counted), "old-parts", scratch)
            both = facts, counted, recent
            at_once(
                self.spark,
                *[
                    lambda table=table: table.update(batch_id, parts, old_parts, both, scratch)
                    for table in (self.daily, self.retention, self.pay_cohort)
                ],
                lambda: self.signals.write(onboarding.signals_of_parts(parts), batch_id),
            )

        launches = facts.where(f"kind = '{LAUNCH}' AND is_new = 1")
        keys = attribution.unpivot_keys(launches, self.clicks.levels, [*DEVICE_KEYS, "active_time"])
        last = known.selectExpr(*DEVICE_KEYS, "greatest(last_event_time, last_ts) AS last_event_time")
        state = timeline.state_after(facts, step.devices)
        at_once(
            self.spark,
            keep,
            count,
            lambda: self.by_key.write(keys, batch_id),
            lambda: self.seen.write(last.join(state, DEVICE_KEYS, "left"), batch_id),
        )

    def _facts_by_day(self, before: int) -> Callable[[DataFrame], DataFrame]:
        """Facts of some days, as far as statistics describe their rows by them. Days asked for again are not read again."""
        lock, found = Lock(), {}

        def of(days: DataFrame) -> DataFrame:
            with lock:
                wanted = {r.stat_date for r in days.collect()}
                if wanted - found.keys():
                    missing = self._facts_on(before, wanted - found.keys(), DESCRIBING)
                    made = materialize(missing, f"facts-{len(found)}", self._scratch(before - 1))
                    found.update(dict.fromkeys(wanted - found.keys(), made))
                tables = list({id(found[d]): found[d] for d in wanted}.values())
            return functools.reduce(DataFrame.unionByName, tables).where(F.col("stat_date").isin(list(wanted)))

        return of

    def facts_of(self, before: int, days: DataFrame | None = None, columns: Sequence[str] = APP_FACT.fieldNames()) -> DataFrame:
        """Facts as they are after all batches below `before`; with `days`, those of some `stat_date` alone.

        Facts of a device that was worked through again replace those of the same events. `columns` names those that are
        needed besides the keys of an event; no others are read.
        """
        return self._facts_on(before, None if days is None else {r.stat_date for r in days.collect()}, columns)

    def _facts_on(self, before: int, days: Collection[date] | None, columns: Sequence[str]) -> DataFrame:
        schema = StructType([f for f in APP_FACT if f.name in _EVENT_KEYS or f.name in columns])
        rows = self.facts.rows(before)
        if days is not None:
            # Named one by one, so that the scan leaves out the other days' folders.
            rows = rows.where(F.col("stat_date").isin(list(days)))
        return latest_per_key(_EVENT_KEYS, schema)(rows.select(*schema.fieldNames(), BATCH))
