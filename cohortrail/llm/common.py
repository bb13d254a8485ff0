"""Helpers that several operators share: table access, written tables, text splitting, clashing names."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortrail.session import shared_dir

# Text bytes that one vectorised step inside a task works on; bounds memory, not results.
STEP_BYTES = 16 << 20
# Rows that a function of add_columns gets at once.
SLICE_ROWS = 1024


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, in case it isn't installed there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp(prefix="cohortrail-")) / "cohortrail.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))  # the driver serves it; no executor reads the driver's folder
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`df` written to a new folder of the shared folder and read back, and that folder, for `discard`."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove folders made by `stored` that no plan reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without the columns that an operator is about to add (names compare as Spark compares them)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind it as it takes to be no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Spark keeps its Python workers for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)


def add_columns(
    df: DataFrame,
    inputs: dict[str, str],
    outputs: str,
    work: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
) -> DataFrame:
    """`df` with the columns `outputs` (a DDL list) that a function computes from each Arrow batch of `inputs`.

    `inputs` maps a name to an SQL expression over `df`. `work` runs once per task and returns the function.
    All columns of `df` stay as they are; one with the name of an output is replaced.
    """
    spark = df.sparkSession
    new = spark.createDataFrame([], outputs).schema
    kept = without(df, *new.names)
    carried = [(f"_c{i}", c) for i, c in enumerate(kept.columns)]
    shaped = df.select(
        *[F.col(f"`{c}`").alias(a) for a, c in carried], *[F.expr(e).alias(f"_in_{n}") for n, e in inputs.items()]
    )
    schema = shaped.select(*[a for a, _ in carried]).schema
    for field in new:
        schema = schema.add(field)
    n, names = len(carried), list(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = work()
        for whole in batches:
            # In slices, so that inputs and results of few rows are in memory together.
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                given = pa.RecordBatch.from_arrays(batch.columns[n:], names=names)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:n], *function(given)], names=[*batch.schema.names[:n], *new.names]
                )
        del function
        give_back()

    out = shaped.mapInArrow(run, schema)
    return out.select(*[F.col(a).alias(c) for a, c in carried], *new.names)


def runs_by_bytes(lengths: list[int], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows 0..n into runs of at most `limit` bytes; a longer row is a run of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total + n > limit and i > start:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


# Characters for which the standard library's classes and those of the tokenizer libraries may differ. Texts without
# them, nearly all in Latin script, take the faster engine.
_ODD = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeƀ-\U0010ffff]")
# Both tokenizer libraries know letters and numbers of an older Unicode version than `regex`; what it knows in
# addition is unassigned for them. U+0378 is unassigned in every version.
_UNASSIGNED = "͸"


class Splitter:
    """All matches of a pattern with the classes \\p{L}, \\p{N} and \\s, as the tokenizer libraries find them.

    `known(cls)` returns, for `L` or `N`, the characters the library counts to that class.
    """

    def __init__(self, pattern: str, known: Callable[[str], set[str]]):
        self._pattern = regex.compile(pattern)
        fast = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"[\p{L}]", r"[^\W\d_]")
        self._fast = re.compile(fast.replace(r"[\p{N}]", r"\d").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d"))
        self._known = known
        self._newer: dict[int, str] | None = None

    def newer(self) -> dict[int, str]:
        if self._newer is None:
            self._newer = {}
            everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
            for cls in "LN":
                ours = set(regex.findall(rf"\p{{{cls}}}", everything))
                self._newer |= {ord(c): _UNASSIGNED for c in ours - self._known(cls)}
        return self._newer

    def split(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return self._fast.findall(text)
        plain = text.translate(self.newer())
        if plain == text:
            return self._pattern.findall(text)
        return [text[m.start() : m.end()] for m in self._pattern.finditer(plain)]


def is_odd(text: str) -> bool:
    return _ODD.search(text) is not None
