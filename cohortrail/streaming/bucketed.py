"""Keyed tables of streams that are read for the keys of a batch alone, whatever the number of all keys.

A base is cut into buckets by the hash of the key, one folder each, and a base writes only the buckets that the batches
since the last one touched; for all others the older folder stays the newest. A map, one row per bucket, says which. So
a batch reads the buckets of its keys, named one by one, and the batches since the base, whose number and size do not
grow with the table. With some ten thousand rows a bucket, that is little more than the keys asked for.

Nothing is replaced in place. What a batch reads is fixed by its number, so that a re-run sees the same content and
writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from cohortrail.operators import attribution
from cohortrail.schemas import CLICK
from cohortrail.streaming.batched import BATCH, FEW_KEYS, BatchedTable

BUCKETS = 256
# A row per bucket that has rows: the base that holds them.
PLACES = StructType([StructField("bucket", IntegerType()), StructField("since", LongType())])


class BucketedTable(BatchedTable):
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        fold: Callable[[DataFrame], DataFrame],
        keys: Sequence[str],
        buckets: int = BUCKETS,
        compact_every: int = 50,
        bucket: str | None = None,
    ):
        """`bucket` is an SQL expression of a small integer, by default the hash of `keys` over `buckets`.

        `keys` and `buckets` belong to the stored layout, as `compact_every` does: keep them for the table's life.

        Choose `buckets` for some ten thousand rows each.
        """
        super().__init__(spark, root, schema, fold, compact_every)
        self.keys, self.buckets = list(keys), buckets
        self.bucket = bucket or f"pmod(xxhash64({', '.join(keys)}), {buckets})"

    def _bucket(self) -> str:
        return f"CAST({self.bucket} AS int) AS bucket"

    def seed(self, rows: DataFrame) -> None:
        # The map is written last, so a seed that was cut short is written again.
        if not self._has_seed():
            self._write_base(self._typed(rows), 0)
            self._write_places(self._filled(0), 0)

    def _has_seed(self) -> bool:
        return self._exists(f"{self.root}/places/before=0/_SUCCESS")

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _write_base(self, rows: DataFrame, before: int) -> None:
        bucketed = rows.selectExpr("*", self._bucket())
        # One file a bucket, several where a bucket is large: adaptive execution cuts it, so no task writes more than another.
        dealt = bucketed.hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/base/before={before}")

    def _filled(self, before: int) -> DataFrame:
        """The buckets of one base, in the form of a map."""
        stored = self.spark.read.schema(StructType([*self.schema.fields, PLACES["bucket"]]))
        filled = stored.parquet(f"{self.root}/base/before={before}").select("bucket").distinct()
        return filled.selectExpr("bucket", f"CAST({before} AS bigint) AS since")

    def _write_places(self, places: DataFrame, before: int) -> None:
        places.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/places/before={before}")

    def places(self, before: int) -> DataFrame:
        """The map as of batch `before`: at most a row per bucket."""
        base = self._base(before)
        if not base and not self._has_seed():
            return self.spark.createDataFrame([], PLACES)
        return self.spark.read.schema(PLACES).parquet(f"{self.root}/places/before={base}")

    def stored(self, before: int, wanted: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of the base of those buckets; None if there are none."""
        places = self.places(before)
        if wanted is not None:
            places = places.where(F.col("bucket").isin(list(wanted)))
        folders = [f"{self.root}/base/before={r.since}/bucket={r.bucket}" for r in places.collect()]
        if not folders:
            return None
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders)

    def recent(self, before: int) -> DataFrame | None:
        """Rows of the batches after the base, with their `batch_id`."""
        base = self._base(before)
        if before <= base:
            return None
        full = StructType([*self.schema.fields, StructField(BATCH, LongType())])
        folders = [f"{self.root}/delta/{BATCH}={b}" for b in range(base, before)]
        return self.spark.read.schema(full).option("basePath", f"{self.root}/delta").parquet(*folders).select(*full.fieldNames())

    def rows(self, before: int, wanted: Sequence[int] | None = None) -> DataFrame:
        stored, recent = self.stored(before, wanted), self.recent(before)
        if stored is not None:
            stored = stored.selectExpr("*", f"CAST(-1 AS bigint) AS {BATCH}")
        if stored is None or recent is None:
            full = StructType([*self.schema.fields, StructField(BATCH, LongType())])
            both = stored if recent is None else recent
            return self.spark.createDataFrame([], full) if both is None else both
        return stored.unionByName(recent)

    def touched(self, only: DataFrame) -> list[int]:
        """The buckets of some keys: numbers below `buckets`, whatever the keys."""
        return sorted(r.bucket for r in only.selectExpr(self._bucket()).distinct().collect())

    def read(self, before: int, only: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
        if only is None:
            return self.fold(self.rows(before))
        if keys is not None and list(keys) != self.keys:
            raise ValueError(f"this table is read by {self.keys}")
        rows = self.rows(before, self.touched(only))
        few = F.broadcast(only) if only.count() <= FEW_KEYS else only
        return self.fold(rows.join(few, self.keys, "left_semi"))

    def compact(self, batch_id: int) -> None:
        after = batch_id + 1
        if after % self.compact_every:
            return
        # As of the batch before, with its own rows added: the base about to be written is not read.
        last = self.read_batch(batch_id).selectExpr("*", f"CAST({batch_id} AS bigint) AS {BATCH}")
        recent = self.recent(batch_id)
        recent = last if recent is None else recent.unionByName(last)
        stored = self.stored(batch_id, self.touched(recent))
        if stored is not None:
            recent = recent.unionByName(stored.selectExpr("*", f"CAST(-1 AS bigint) AS {BATCH}"))
        self._write_base(self.fold(recent).select(*self.schema.fieldNames()), after)
        new = self._filled(after)
        # A fold drops no key, so a bucket that had rows still has.
        kept = self.places(batch_id).join(F.broadcast(new.select("bucket")), "bucket", "left_anti")
        self._write_places(kept.unionByName(new), after)

    def tidy(self, batch_id: int) -> None:
        """Drop the batches that lie behind the last but one base, and folders of buckets that it has newer ones of."""
        behind = self._base(batch_id) - self.compact_every
        if batch_id % self.compact_every or behind < 0:
            return
        older = max(0, behind - self.compact_every)
        gone = [f"delta/{BATCH}={b}" for b in range(older, behind)]
        if behind and (older or self._has_seed()):
            old, new = (self.spark.read.schema(PLACES).parquet(f"{self.root}/places/before={b}") for b in (older, behind))
            replaced = old.join(F.broadcast(new), ["bucket", "since"], "left_anti").collect()  # at most one a bucket
            gone += [f"base/before={r.since}/bucket={r.bucket}" for r in replaced]
        for name in gone:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


COMMIT = StructType([StructField("done", LongType())])


class ClickIndex:
    """The earliest click of each key, kept up as clicks come: as attribution asks for, and never built anew.

    Clicks may come in any order and again. A key's row is a minimum, so the order does not matter, and neither do
    clicks that come twice. Clicks without a time are left out, as in `attribution.match_clicks`. A bound on the age of
    clicks (`lookback_days`) needs all of them and can't use the index.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        levels=attribution.LEVELS,
        click_keys: Sequence[str] = (),
        buckets: int = BUCKETS,
        compact_every: int = 50,
    ):
        self.spark, self.levels, self.click_keys = spark, levels, list(click_keys)
        self.on = [*attribution.KEY, *click_keys]
        own = [StructField("os", IntegerType()), StructField("level", IntegerType()), StructField("key", StringType())]
        own += [StructField(c, StringType()) for c in click_keys]
        schema = StructType([*own, *[CLICK[c] for c in attribution.CLICK_COLUMNS]])
        root = root.rstrip("/")
        self.table = BucketedTable(spark, f"{root}/clicks", schema, self._fold, self.on, buckets, compact_every)
        self.commits = BatchedTable(spark, f"{root}/commits", COMMIT)

    def _fold(self, rows: DataFrame) -> DataFrame:
        return attribution.earliest_click(rows, self.on)

    def add(self, clicks: DataFrame, batch_id: int) -> None:
        """Take in a batch of clicks; the same batch again replaces what it wrote."""
        dated = clicks.where("click_ts IS NOT NULL")
        offers = attribution.unpivot_keys(dated, self.levels, [*attribution.CLICK_COLUMNS, *self.click_keys])
        self.table.write(self._fold(offers), batch_id)
        self.table.compact(batch_id)
        self.table.tidy(batch_id)
        self.commits.write(self.spark.range(1).selectExpr(f"CAST({batch_id} AS bigint) AS done"), batch_id)

    def start(self, clicks: DataFrame, checkpoint: str, available_now: bool = False):
        """Keep the index up from a stream of clicks."""
        writer = clicks.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint)
        trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
        return writer.trigger(**trigger).start()

    def next_batch(self) -> int:
        if not self.table._exists(f"{self.commits.root}/delta"):
            return 0
        done = self.spark.read.schema(COMMIT).parquet(f"{self.commits.root}/delta")
        return done.selectExpr("coalesce(max(done), -1) + 1 AS n").first()["n"]

    def lookup(self) -> Callable[[DataFrame], DataFrame]:
        """The index as of now, for `match_clicks`: a function of a table of keys."""
        before = self.next_batch()
        return lambda keys: self.table.read(before, keys, self.on)

    def changes(self, since: int, before: int) -> DataFrame | None:
        """The earliest click of each key among those taken in by the batches from `since` on; None if there were none.

        Where batches that far back are gone, the whole index, which holds all of them.
        """
        if since >= before:
            return None
        if since < self.table._base(before) - self.table.compact_every:
            return self.table.read(before)
        folders = [f"{self.table.root}/delta/{BATCH}={b}" for b in range(since, before)]
        return self._fold(self.spark.read.schema(self.table.schema).parquet(*folders))

    def current(self) -> DataFrame:
        return self.table.read(self.next_batch())
