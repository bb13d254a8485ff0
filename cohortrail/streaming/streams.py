"""Structured Streaming jobs: `foreachBatch` over the same operators that batch plans use.

State lives in a table of its own, read as of the batch before and written for the batch; a re-run of a batch id
therefore sees the same state and replaces what it wrote. The last write of a batch is its commit row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from cohortrail.operators import registry as onboarding
from cohortrail.operators import stats, timeline
from cohortrail.operators.skew import HOT_ROWS, at_once, materialize
from cohortrail.operators.stats import StatTable
from cohortrail.plans import tables
from cohortrail.schemas import (
    APP_EVENT,
    DEVICE_KEYS,
    DEVICE_STATE,
    FIRST,
    MONEY,
    REJECT,
    WEB_EVENT,
    WEB_KEYS,
    WEB_STATE,
)
from cohortrail.sources import payload
from cohortrail.streaming.batched import BatchedTable, latest_per_key
from cohortrail.streaming.bucketed import BUCKETS, COMMIT, BucketedTable

TRIGGER_SECONDS = 5
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"

_DATES = ("stat_date", "active_date", "pay_date")
_DAYS = ("retention_days", "pay_days")


def stat_schema(table: StatTable) -> StructType:
    def field(name: str) -> StructField:
        if name in _DATES:
            return StructField(name, DateType())
        return StructField(name, IntegerType() if name in _DAYS else StringType())

    return StructType(
        [field(c) for c in table.keys]
        + [StructField(c, LongType()) for c in table.counts]
        + [StructField(c, MONEY) for c in table.money]
        + [field(c) for c in table.described]
        + [StructField(FIRST[0], TimestampNTZType()), StructField(FIRST[1], LongType())]
    )


def _flags(*names: str) -> list[StructField]:
    return [StructField(n, IntegerType()) for n in names]


_OUTCOME = [
    StructField("stat_date", DateType()),
    StructField("active_time", TimestampNTZType()),
    StructField("active_date", DateType()),
    StructField("prev_launch_time", TimestampNTZType()),
    *_flags("is_new", "new_today", "late"),
]
APP_FACT = StructType(
    [
        *APP_EVENT.fields,
        StructField("plan_id", StringType()),
        StructField("channel_id", StringType()),
        *_OUTCOME,
        *_flags("new_reg", "pay_status"),
    ]
)
WEB_FACT = StructType([*WEB_EVENT.fields, *_OUTCOME])
# Registrations and payments that came before their device's launch did; `open` until they count.
WAITING = StructType([*APP_EVENT.fields, *_flags("open")])
_EVENT_KEYS = [*DEVICE_KEYS, "kind", "event_id"]
SIGNALS = StructType([StructField("app_id", StringType()), *_flags(*onboarding.SIGNALS)])

class Stream:
    """Common part: tables under one root, the order of writes, and reading them back."""

    def __init__(self, spark: SparkSession, root: str, compact_every: int, hot_rows: int):
        self.spark, self.root = spark, root.rstrip("/")
        self.compact_every, self.hot_rows = compact_every, hot_rows
        self.rejects = self._table("rejects", REJECT)
        self.commits = self._table("commits", COMMIT)

    def _table(self, name: str, schema: StructType, fold=None, partition_by=()) -> BatchedTable:
        return BatchedTable(self.spark, f"{self.root}/{name}", schema, fold, self.compact_every, partition_by)

    def _keyed(self, name: str, schema: StructType, keys: list[str], buckets: int, fold_keys: list[str] | None = None):
        fold = latest_per_key(fold_keys or keys, schema)
        return BucketedTable(self.spark, f"{self.root}/{name}", schema, fold, keys, buckets, self.compact_every)

    def _stat(self, name: str, table: StatTable) -> BatchedTable:
        return self._table(name, stat_schema(table), lambda rows: stats.merge_deltas(rows, table))

    def _scratch(self, batch_id: int) -> str:
        """Two folders in turn, so that intermediate tables do not pile up."""
        return f"{self.root}/scratch/{batch_id % 2}"

    def parse(self, raw: DataFrame) -> DataFrame:
        """Raw messages to typed rows with a `reason` where unusable."""
        raise NotImplementedError

    def _parsed(self, tagged: DataFrame, batch_id: int, all_texts: bool = False) -> DataFrame:
        """The parsed messages of the batch, written: what comes before, stream state included, runs once. The text of a
        message goes along where a reject shows it, or with `all_texts`."""
        raw = "raw" if all_texts else "CASE WHEN reason IS NOT NULL THEN raw END AS raw"
        columns = [raw if c == "raw" else f"`{c}`" for c in tagged.columns]
        return materialize(tagged.selectExpr(*columns), "parsed", self._scratch(batch_id))

    def apply(self, tagged: DataFrame, batch_id: int) -> None:
        """Work through one batch of parsed messages and write all its tables."""
        raise NotImplementedError

    def process(self, raw: DataFrame, batch_id: int) -> None:
        self.apply(self.parse(raw), batch_id)

    def _finish(self, batch_id: int, *folded: BatchedTable) -> None:
        at_once(self.spark, *[lambda table=table: (table.compact(batch_id), table.tidy(batch_id)) for table in folded])
        self.commits.write(self.spark.range(1).selectExpr(f"CAST({batch_id} AS bigint) AS done"), batch_id)

    def next_batch(self) -> int:
        """Number of committed batches; tables are read up to here."""
        done = self.spark.read.schema(COMMIT).parquet(f"{self.commits.root}/delta")
        return done.selectExpr("coalesce(max(done), -1) + 1 AS n").first()["n"]

    def current(self, table: BatchedTable) -> DataFrame:
        return table.read(self.next_batch())

    def start(
        self, source: DataFrame, checkpoint: str, available_now: bool = False, redelivery: str | None = None
    ) -> StreamingQuery:
        """Run over a stream of raw messages: every five seconds, or over what is there and then stop.

        With `redelivery`, a length of time, messages that arrive again within it are dropped. No batch runs for the move of
        the watermark alone: it would hold no message, and ids that are out of date can go with the next one.
        """
        trigger = {"availableNow": True} if available_now else {"processingTime": f"{TRIGGER_SECONDS} seconds"}
        if redelivery is None:
            writer = source.writeStream.foreachBatch(self.process)
            return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
        writer = drop_redelivered(self.parse(source), redelivery).writeStream.foreachBatch(self.apply)
        conf = source.sparkSession.conf
        before = conf.get(_EMPTY_BATCHES)
        conf.set(_EMPTY_BATCHES, "false")  # read when a query starts
        try:
            return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
        finally:
            conf.set(_EMPTY_BATCHES, before)


class AppStream(Stream):
    """Launches, registrations and payments to facts, device state, statistics, app signals and rejects.

    A registration or payment without an activation is a reject when it comes. It waits, and counts once if its
    device's launch comes later and lies before it.

    `clicks` and `registry` are called once per batch, so that each batch sees their current content. `clicks` gives a
    click table, or the `lookup` of a `ClickIndex`, of which a batch reads the keys of its new devices alone.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        clicks: Callable[[], DataFrame | Callable[[DataFrame], DataFrame]],
        registry: Callable[[], DataFrame] | None = None,
        hash_ids: bool = True,
        compact_every: int = 50,
        hot_rows: int = HOT_ROWS,
        initial: DataFrame | None = None,
        buckets: int = BUCKETS,
        history: Callable[[DataFrame], DataFrame] | None = None,
        **match,
    ):
        """`initial` is the device state to start from (`stored.state_from_logs`), written before the first batch.

        `history` stands in for it where the logs are many: a function that gives the state of some devices
        (`stored.state_of`). A batch asks it for the devices that the stream's own state lacks.

        `buckets` belongs to the stored layout of the device state: choose it for some ten thousand devices each.
        """
        super().__init__(spark, root, compact_every, hot_rows)
        self.clicks, self.registry, self.hash_ids, self.match = clicks, registry, hash_ids, match
        self.history = history
        self.facts = self._table("facts", APP_FACT, partition_by=("stat_date", "os"))
        self.state = self._keyed("state", DEVICE_STATE, DEVICE_KEYS, buckets)
        self.waiting = self._keyed("waiting", WAITING, DEVICE_KEYS, buckets, _EVENT_KEYS)
        self.signals = self._table("signals", SIGNALS, fold_signals)
        self.daily = self._stat("stat_daily", stats.DAILY)
        self.retention = self._stat("stat_retention", stats.RETENTION)
        self.pay_cohort = self._stat("stat_pay", stats.PAY_COHORT)
        if initial is not None:
            self.state.seed(initial)

    def parse(self, raw: DataFrame) -> DataFrame:
        return payload.app_events(raw, self.hash_ids)

    def _state_of(self, devices: DataFrame, batch_id: int) -> DataFrame:
        own = self.state.read(batch_id, devices, DEVICE_KEYS)
        if self.history is None:
            return own
        scratch = self._scratch(batch_id)
        own = materialize(own, "own-state", scratch)
        missing = materialize(devices.join(own.select(*DEVICE_KEYS), DEVICE_KEYS, "left_anti"), "missing", scratch)
        return own.unionByName(self.history(missing).select(*DEVICE_STATE.fieldNames()))

    def apply(self, tagged: DataFrame, batch_id: int) -> None:
        tagged = self._parsed(tagged, batch_id, self.registry is not None)
        if self.registry is not None:
            tagged = onboarding.flag_unknown_apps(tagged, self.registry(), self.hot_rows)
        # Events without an activation wait for their device to come up again, with its launch perhaps.
        scratch, fresh = self._scratch(batch_id), payload.accepted(tagged)
        touched = materialize(fresh.select(*DEVICE_KEYS).distinct(), "touched", scratch)
        earlier = self.waiting.read(batch_id, touched, DEVICE_KEYS).where("open = 1").drop("open")
        earlier = materialize(earlier, "earlier", scratch)
        step = timeline.step(
            fresh.unionByName(earlier), self.clicks(),
            lambda devices: self._state_of(devices, batch_id), self.hot_rows,
            scratch, **self.match,
        )
        known = earlier.select(*_EVENT_KEYS)
        left = step.rejects.join(known, _EVENT_KEYS, "left_anti")
        # Statistics and state come from the written facts; state and clicks went into the written devices.
        at_once(
            self.spark,
            lambda: self.facts.write(step.facts, batch_id),
            lambda: materialize(left, "unmatched", scratch),
        )
        facts = self.facts.read_batch(batch_id)
        unmatched = self.spark.read.schema(left.schema).parquet(f"{scratch}/unmatched")

        def count() -> None:
            parts = materialize(stats.parts(facts), "parts", scratch)
            at_once(
                self.spark,
                lambda: self.daily.write(stats.of_parts(parts, "daily"), batch_id),
                lambda: self.retention.write(stats.of_parts(parts, "retention"), batch_id),
                lambda: self.pay_cohort.write(stats.of_parts(parts, "pay"), batch_id),
                lambda: self.signals.write(onboarding.signals_of_parts(parts), batch_id),
            )

        event = APP_EVENT.fieldNames()
        recovered = facts.join(known, _EVENT_KEYS, "left_semi").select(*event).withColumn("open", F.lit(0))
        waiting = unmatched.select(*event).withColumn("open", F.lit(1)).unionByName(recovered)
        texts = unmatched.selectExpr("reason", "kind", f"to_json(struct({', '.join(event)})) AS raw")
        at_once(
            self.spark,
            count,
            lambda: self.waiting.write(waiting, batch_id),
            lambda: self.rejects.write(payload.rejected(tagged).unionByName(texts), batch_id),
            lambda: self.state.write(timeline.state_after(facts, step.devices), batch_id),
        )
        self._finish(batch_id, self.state, self.waiting, self.signals, self.daily, self.retention, self.pay_cohort)

    def logs(self) -> DataFrame:
        """The five log tables, as views of the facts."""
        return tables.app_logs(self.current(self.facts))

    def app_registry(self, initial: DataFrame) -> DataFrame:
        """The registry after all batches."""
        return onboarding.merge(initial, self.current(self.signals))

    def write_registry(self, initial: DataFrame) -> DataFrame:
        """Write the registry as of the last batch, in its stored form, to a folder of that batch; read back."""
        stored = f"app_id AS id, app_step, {onboarding.EVENT_TEXT} AS app_event".split(", ", 2)
        path = f"{self.root}/registry/before={self.next_batch()}"
        self.app_registry(initial).selectExpr(*stored).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def fold_signals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("app_id").agg(*[F.expr(f"max({n}) AS {n}") for n in onboarding.SIGNALS])


class WebStream(Stream):
    """Web launches to facts, click state, statistics and rejects."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        compact_every: int = 50,
        hot_rows: int = HOT_ROWS,
        initial: DataFrame | None = None,
        buckets: int = BUCKETS,
    ):
        super().__init__(spark, root, compact_every, hot_rows)
        self.facts = self._table("facts", WEB_FACT, partition_by=("stat_date",))
        self.state = self._keyed("state", WEB_STATE, WEB_KEYS, buckets)
        self.daily = self._stat("stat_daily", stats.WEB_DAILY)
        self.retention = self._stat("stat_retention", stats.WEB_RETENTION)
        if initial is not None:
            self.state.seed(initial)

    def parse(self, raw: DataFrame) -> DataFrame:
        return payload.web_events(raw)

    def apply(self, tagged: DataFrame, batch_id: int) -> None:
        tagged = self._parsed(tagged, batch_id)
        step = timeline.web_step(
            payload.accepted(tagged, WEB_EVENT), lambda devices: self.state.read(batch_id, devices, WEB_KEYS),
            self.hot_rows, self._scratch(batch_id),
        )
        self.facts.write(step.facts, batch_id)
        facts = self.facts.read_batch(batch_id)
        unplaced = step.rejects.selectExpr(
            "reason", "'webLaunch' AS kind", f"to_json(struct({', '.join(WEB_EVENT.fieldNames())})) AS raw"
        )
        at_once(
            self.spark,
            lambda: self.daily.write(stats.web_daily(facts), batch_id),
            lambda: self.retention.write(stats.web_retention(facts), batch_id),
            lambda: self.rejects.write(payload.rejected(tagged).unionByName(unplaced), batch_id),
            lambda: self.state.write(step.state, batch_id),
        )
        self._finish(batch_id, self.state, self.daily, self.retention)

    def logs(self) -> DataFrame:
        return tables.web_logs(self.current(self.facts))


def drop_redelivered(tagged: DataFrame, delay: str) -> DataFrame:
    """Messages delivered again within `delay` are dropped, by topic and the id they carry, in stream state.

    The watermark runs on the arrival time of the queue, which no client clock can push ahead; the source must supply
    `arrival`. Messages without an id of their own are told apart by their text, never by their place in the queue,
    which each delivery has anew.
    """
    keyed = tagged.selectExpr(
        "*",
        "coalesce(own_id, md5(raw)) AS delivery",
        "CAST(arrival AS timestamp) AS arrival_time",
    )
    unique = keyed.withWatermark("arrival_time", delay).dropDuplicatesWithinWatermark(["kind", "delivery"])
    return unique.drop("delivery", "arrival_time", "own_id")


def daily_event_counts(tagged: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events per app, topic and calendar day as tumbling windows with a watermark, for append-mode sinks."""
    timed = tagged.where("reason IS NULL").selectExpr("app_id", "kind", "CAST(ts AS timestamp) AS event_time")
    windows = timed.withWatermark("event_time", delay).groupBy("app_id", "kind", F.window("event_time", "1 day")).count()
    return windows.selectExpr("app_id", "kind", "to_date(window.start) AS stat_date", "count AS n")
