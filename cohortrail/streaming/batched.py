"""Tables written by micro-batches: one folder per batch, folded on reading.

Writing a batch again replaces its folder, so a replay leaves the same content. Nothing is updated in place. Every
`compact_every` batches the fold of all earlier ones is written as a base, and reads start from the newest base.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

BATCH = "batch_id"
# Keys up to this number are broadcast to the scan of a table that is read for them alone; they are counted first.
FEW_KEYS = 200_000


class BatchedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        fold: Callable[[DataFrame], DataFrame] | None = None,
        compact_every: int = 50,
        partition_by: tuple[str, ...] = (),
    ):
        """`fold` maps rows of several batches (they carry `batch_id`) to current rows; None keeps all rows.

        `compact_every` belongs to the stored layout: keep it for the life of the table.
        """
        self.spark, self.root, self.schema, self.fold = spark, root, schema, fold
        self.compact_every, self.partition_by = compact_every, partition_by

    def write(self, rows: DataFrame, batch_id: int) -> None:
        writer = self._typed(rows).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/delta/{BATCH}={batch_id}")

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in self.schema])

    def read_batch(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/delta/{BATCH}={batch_id}")

    def seed(self, rows: DataFrame) -> None:
        """Rows to start from, as a base below batch 0. What is there already stays."""
        if not self._has_seed():
            self._typed(rows).write.mode("overwrite").parquet(f"{self.root}/base/before=0")

    def _has_seed(self) -> bool:
        """Whether a base below batch 0 was written completely."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/base/before=0/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _base(self, before: int) -> int:
        """Batches below this number are in a base. Batch `before` runs only after all earlier ones are complete."""
        return before // self.compact_every * self.compact_every if self.fold else 0

    def rows(self, before: int) -> DataFrame:
        """Unfolded rows of the base and of the batches after it; those of a base carry `batch_id` -1."""
        full = StructType([*self.schema.fields, StructField(BATCH, LongType())])
        if not self.fold and before:
            # Never folded, so there may be very many folders: let the scan prune them.
            return self.spark.read.schema(full).parquet(f"{self.root}/delta").where(f"{BATCH} < {before}")
        base = self._base(before)
        out = None
        if base or (self.fold and self._has_seed()):
            stored = self.spark.read.schema(self.schema).parquet(f"{self.root}/base/before={base}")
            out = stored.selectExpr("*", f"CAST(-1 AS bigint) AS {BATCH}")
        if before > base:
            folders = [f"{self.root}/delta/{BATCH}={b}" for b in range(base, before)]
            read = self.spark.read.schema(full).option("basePath", f"{self.root}/delta")
            recent = read.parquet(*folders).select(*full.fieldNames())
            out = recent if out is None else out.unionByName(recent)
        return self.spark.createDataFrame([], full) if out is None else out

    def read(self, before: int, only: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
        """Current rows after all batches below `before`; with `only`, a written table of some keys, those of them.

        Rows of other keys are dropped before the fold.
        """
        rows = self.rows(before)
        if only is not None:
            rows = rows.join(F.broadcast(only) if only.count() <= FEW_KEYS else only, keys, "left_semi")
        return self.fold(rows) if self.fold else rows

    def compact(self, batch_id: int) -> None:
        """To be called at the end of every batch; writes a base when one is due."""
        after = batch_id + 1
        if not self.fold or after % self.compact_every:
            return
        previous = self.rows_since_previous_base(after)
        self.fold(previous).select(*self.schema.fieldNames()).write.mode("overwrite").parquet(
            f"{self.root}/base/before={after}"
        )

    def tidy(self, batch_id: int) -> None:
        """Drop the batches and the base that lie behind the last but one base.

        A replay of batch `batch_id` or of the one before reads from the last base or the one before that.
        """
        behind = self._base(batch_id) - self.compact_every
        if not self.fold or batch_id % self.compact_every or behind <= 0:
            return
        gone = [f"delta/{BATCH}={b}" for b in range(behind - self.compact_every, behind)]
        for name in [*gone, f"base/before={behind - self.compact_every}"]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def rows_since_previous_base(self, after: int) -> DataFrame:
        """Rows a new base folds: the previous base and the batches since, not the base about to be written."""
        older = self.rows(after - 1)
        last = self.read_batch(after - 1).selectExpr("*", f"CAST({after - 1} AS bigint) AS {BATCH}")
        return older.unionByName(last)


def latest_per_key(keys: list[str], schema: StructType) -> Callable[[DataFrame], DataFrame]:
    """Fold of complete rows: the one of the highest batch per key."""
    rest = ", ".join(f.name for f in schema if f.name not in keys)

    def fold(rows: DataFrame) -> DataFrame:
        newest = rows.groupBy(*keys).agg(F.expr(f"max_by(struct({rest}), {BATCH}) AS row"))
        return newest.select(*keys, "row.*").select(*schema.fieldNames())

    return fold
