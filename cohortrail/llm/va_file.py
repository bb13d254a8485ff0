"""Centroid clustering over a vector-approximation file.

Each vector is kept twice: whole, in a table bucketed by a row key, and as one small cell number per dimension (BITS
bits), in a table that every round reads. Edges of the cells follow the mean and deviation of a dimension; the outermost
reach to its least and greatest value, all taken over every vector. For the centroids of a round, lookup tables hold
between which values the distance to each centroid lies for a vector of a cell, dimension by dimension; their sums are
intervals. Distances are taken relative to that of one common point, which changes no comparison and leaves intervals
of a width that depends on how far centroids lie apart, not on how long vectors are. Where the interval of one centroid
lies below all others, that centroid is the nearest. Only vectors whose intervals overlap, or whose cluster changes,
have their whole form fetched, by a join on the bucketed key, which does not shuffle the whole vectors.

Sums per cluster are kept between rounds: a round adds the vectors that came and subtracts those that left. They are
made of one row per task and cluster, added up by Spark; only centroids and their sums reach the driver. All arithmetic
is in integers, so results do not depend on partitions. A round that moves no vector ends the search, as the ones
after it would find the same.

Rows whose vector is null, of another length, or holds a null or non-finite component take no part, nor do those with
an integer component of LARGEST or more, whose squared distances a long could not hold. Repeated rows and ids: each
row is a vector of its own. Null id: a vector like the others, but no first centroid. Fewer usable ids than centroids:
so many centroids. Empty table, or no id: no rows. Ties: the centroid of the smaller number. Further columns play no
part, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common
from cohortrail.session import shared_dir

DIMENSIONS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
BITS = 8  # at most 8: a cell is a byte
LARGEST = 1 << 27
STEP_CELLS = 1 << 18  # vectors times centroids that one vectorised step works on

STATE = "key bigint, cells binary, cluster int, sums array<bigint>"


def integers(vectors: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the usable rows, and floor(scale * x) of their components."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = np.flatnonzero(np.equal(pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(), dimensions))
    flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dimensions)  # nulls become not-a-number
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * scale)
        fine = (np.abs(x) < LARGEST).all(axis=1)
    return rows[fine], x[fine].astype(np.int64)


def whole(column: pa.Array) -> np.ndarray:
    """The vectors of a binary column of 32-bit integers."""
    return np.array([np.frombuffer(v.as_buffer(), "<i4") for v in column], np.int64).reshape(len(column), -1)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


class Cells:
    """Cells of each dimension: integer intervals, by the edges between them and the outermost values."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int):
        normal, n = NormalDist(), 1 << bits
        steps = np.array([normal.inv_cdf(i / n) for i in range(1, n)])
        self.edges = np.floor(mean[:, None] + deviation[:, None] * steps).astype(np.int64)
        # What a cell may hold, both included.
        self.low = np.concatenate([least[:, None], self.edges], axis=1)
        self.high = np.concatenate([self.edges - 1, greatest[:, None]], axis=1)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(e, x, side="right") for e, x in zip(self.edges, vectors.T, strict=True)]
        return np.stack(found, axis=1).astype(np.uint8)


class Lookup:
    """Per dimension and cell, the bounds of what the distance to each centroid exceeds that to a common point by."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        self.centroids = centroids
        point = centroids.sum(axis=0) // len(centroids)
        ends = []
        for x in (cells.low, cells.high):
            x = x[:, :, None]
            # Linear in x, so the extremes lie at the ends of the cell.
            ends.append((x - centroids.T[:, None, :]) ** 2 - (x - point[:, None, None]) ** 2)
        self.bounds = np.concatenate([np.minimum(*ends), np.maximum(*ends)], axis=2)

    def near(self, cells: np.ndarray) -> np.ndarray:
        """Per vector, which centroids may be the nearest: those whose interval begins below where another ends."""
        k = len(self.centroids)
        out = np.zeros((len(cells), k), bool)
        step = max(1, STEP_CELLS // k)
        for at in range(0, len(cells), step):
            part = cells[at : at + step]
            total = np.zeros((len(part), 2 * k), np.int64)
            for bounds, cell in zip(self.bounds, part.T, strict=True):
                total += bounds[cell]
            out[at : at + step] = total[:, :k] <= total[:, k:].min(axis=1, keepdims=True)
        return out

    def nearest(self, vectors: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance, among the centroids of `near`."""
        best, cluster = np.full(len(vectors), np.iinfo(np.int64).max), np.zeros(len(vectors), np.int32)
        for k, centroid in enumerate(self.centroids):
            rows = np.flatnonzero(near[:, k])
            distance = ((vectors[rows] - centroid) ** 2).sum(axis=1)
            closer = distance < best[rows]
            best[rows[closer]], cluster[rows[closer]] = distance[closer], k
        return cluster, best


class Sums:
    """Count and sum of the vectors that came to a cluster, less those that left it."""

    def __init__(self, clusters: int, dimensions: int):
        self.total = np.zeros((clusters, dimensions + 1), np.int64)

    def add(self, cluster: np.ndarray, vectors: np.ndarray, sign: int = 1) -> None:
        for k in np.unique(cluster):
            own = vectors[cluster == k]
            self.total[k, 0] += sign * len(own)
            self.total[k, 1:] += sign * own.sum(axis=0)

    def rows(self) -> pa.RecordBatch:
        """A row without key for each cluster."""
        n = len(self.total)
        columns = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(range(n), pa.int32())]
        sums = pa.array(self.total.tolist(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*columns, sums], ["key", "cells", "cluster", "sums"])


def _state(key: pa.Array, cells: pa.Array, cluster: np.ndarray) -> pa.RecordBatch:
    columns = [key, cells, pa.array(cluster, pa.int32()), pa.nulls(len(key), pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["key", "cells", "cluster", "sums"])


def _moments(vectors: DataFrame, dimensions: int, bits: int) -> Cells:
    """Cells from statistics of all vectors: a row per task and dimension is added up."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, least, greatest = 0, np.full(dimensions, LARGEST), np.full(dimensions, -LARGEST)
        sums, squares = np.zeros(dimensions), np.zeros(dimensions)
        for batch in batches:
            x = whole(batch.column("whole"))
            if len(x):
                n += len(x)
                sums += x.sum(axis=0)
                squares += (x.astype(float) ** 2).sum(axis=0)
                least, greatest = np.minimum(least, x.min(axis=0)), np.maximum(greatest, x.max(axis=0))
        if n:
            columns = [np.arange(dimensions, dtype=np.int32), np.full(dimensions, float(n)), sums, squares, least, greatest]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["d", "n", "s", "q", "low", "high"])

    found = vectors.select("whole").mapInArrow(partial, "d int, n double, s double, q double, low bigint, high bigint")
    added = found.groupBy("d").agg(*[F.sum(c).alias(c) for c in "nsq"], F.min("low").alias("low"), F.max("high").alias("high"))
    rows = sorted(added.collect())  # one per dimension
    n, s, q = (np.array([r[c] for r in rows]) for c in "nsq")
    mean = s / n
    deviation = np.sqrt(np.maximum(q / n - mean**2, 0))
    low, high = (np.array([r[c] for r in rows], np.int64) for c in ("low", "high"))
    return Cells(mean, deviation, low, high, bits)


def _moved(state: DataFrame) -> dict[int, list[int]]:
    """Count and sums by cluster, over the partial rows of all tasks."""
    parts = state.where("key IS NULL").selectExpr("cluster", "posexplode(sums) AS (d, x)")
    added = parts.groupBy("cluster", "d").agg(F.expr("sum(CAST(x AS decimal(38, 0))) AS x"))
    out: dict[int, list[int]] = {}
    for cluster, _, x in sorted(added.collect()):  # clusters times dimensions
        out.setdefault(cluster, []).append(int(x))
    return out


class VaFile:
    """The two tables of a clustering, in the shared folder. `close` removes them."""

    def __init__(self, rows: DataFrame, id: str, vector: str, dimensions: int, scale: int, bits: int):
        self.spark, self.dimensions, self.bits = rows.sparkSession, dimensions, bits
        given = rows.selectExpr(f"`{id}` AS id", f"`{vector}` AS vector")
        schema = given.select("id").schema.add("whole", "binary")

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, x = integers(batch.column("vector"), dimensions, scale)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)), _bytes(x.astype("<i4"))], ["id", "whole"]
                )

        n = common.shuffle_partitions(self.spark)
        keyed = given.mapInArrow(keep, schema).withColumn("key", F.monotonically_increasing_id())
        self.table = f"va_file_{uuid.uuid4().hex}"
        self.path = f"{shared_dir(self.spark)}/{self.table}"
        # The key does not repeat, so buckets are even, whatever the vectors.
        writer = keyed.repartition(n, "key").write.bucketBy(n, "key").sortBy("key").option("path", self.path)
        writer.format("parquet").saveAsTable(self.table)
        self.vectors = self.spark.table(self.table)
        self.cells: Cells | None = None
        self.spent: list[str] = []

    def first_centroids(self, k: int, seed: int) -> np.ndarray:
        """The vectors whose ids have the smallest hashes; of a repeated id, the smallest vectors by their bytes."""
        hashed = self.vectors.where("id IS NOT NULL").selectExpr(f"sha2(concat('{seed}:', id), 256) AS h", "whole")
        rows = hashed.orderBy("h", "whole").limit(k).collect()
        return np.array([np.frombuffer(r.whole, "<i4") for r in rows], np.int64).reshape(len(rows), self.dimensions)

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        df, path = common.stored(df, name)
        self.spent.append(path)
        return df

    def compress(self, centroids: np.ndarray) -> DataFrame:
        """State after the first assignment, made in the one pass that has each vector at hand anyway."""
        self.cells = cells = _moments(self.vectors, self.dimensions, self.bits)
        lookup, n, k = Lookup(cells, centroids), self.dimensions, len(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = Sums(k, n)
            for batch in batches:
                x = whole(batch.column("whole"))
                if len(x):
                    own = cells.of(x)
                    cluster, _ = lookup.nearest(x, lookup.near(own))
                    sums.add(cluster, x)
                    yield _state(batch.column("key"), _bytes(own), cluster)
            yield sums.rows()

        return self._write(self.vectors.select("key", "whole").mapInArrow(run, STATE), "va-cells")

    def sift(self, state: DataFrame, centroids: np.ndarray) -> DataFrame:
        """key, cells, cluster so far, `found` (the only centroid that may be nearest, else null) and `near` (a bit for
        each that may be)."""
        lookup = Lookup(self.cells, centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                cells = np.array([np.frombuffer(c.as_buffer(), np.uint8) for c in batch.column("cells")])
                near = lookup.near(cells)
                sure = near.sum(axis=1) == 1
                found = pa.array(near.argmax(axis=1).astype(np.int32), mask=~sure)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, found, _bytes(np.packbits(near, axis=1))],
                    ["key", "cells", "cluster", "found", "near"],
                )

        rows = state.where("key IS NOT NULL").select("key", "cells", "cluster")
        sifted = rows.mapInArrow(run, "key bigint, cells binary, cluster int, found int, near binary")
        return self._write(sifted, "va-sifted")

    def fetch(self, rows: DataFrame, schema: str, work: Callable, *columns: str) -> DataFrame:
        """`work` on the rows of a `sift` with the whole vectors that belong to them."""
        return rows.join(self.vectors.select("key", "whole", *columns), "key").mapInArrow(work, schema)

    def settle(self, sifted: DataFrame, centroids: np.ndarray) -> tuple[DataFrame, DataFrame]:
        """State after the round, and the part of it that was fetched, with the sums of what moved."""
        lookup, n, k = Lookup(self.cells, centroids), self.dimensions, len(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = Sums(k, n)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, old = whole(batch.column("whole")), batch.column("cluster").to_numpy()
                cluster, _ = lookup.nearest(x, _near(batch.column("near"), k))
                moved = cluster != old
                sums.add(cluster[moved], x[moved])
                sums.add(old[moved], x[moved], -1)
                yield _state(batch.column("key"), batch.column("cells"), cluster)
            if sums.total.any():
                yield sums.rows()

        fetched = self._write(self.fetch(sifted.where("NOT found <=> cluster"), STATE, run), "va-fetched")
        kept = sifted.where("found = cluster").select("key", "cells", "cluster")
        return kept.unionByName(fetched.where("key IS NOT NULL").select("key", "cells", "cluster")), fetched

    def assign(self, sifted: DataFrame, centroids: np.ndarray) -> DataFrame:
        """id, cluster and distance of every vector, written."""
        lookup, k = Lookup(self.cells, centroids), len(centroids)
        schema = self.vectors.select("id").schema.add("cluster", "integer").add("distance", "long")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = whole(batch.column("whole"))
                cluster, distance = lookup.nearest(x, _near(batch.column("near"), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"]
                )

        return common.stored(self.fetch(sifted, schema, run, "id"), "va-assigned")[0]

    def forget(self, keep: int = 0) -> None:
        """Remove the tables of former rounds, but the last `keep`."""
        gone, self.spent = self.spent[: len(self.spent) - keep], self.spent[len(self.spent) - keep :]
        common.discard(self.spark, *gone)

    def close(self) -> None:
        self.forget()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        common.discard(self.spark, self.path)


def _near(column: pa.Array, k: int) -> np.ndarray:
    packed = np.array([np.frombuffer(v.as_buffer(), np.uint8) for v in column], np.uint8).reshape(len(column), -1)
    return np.unpackbits(packed, axis=1, count=k).astype(bool)


def clusters(
    rows: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
    bits: int = BITS,
) -> tuple[DataFrame, np.ndarray]:
    """id, cluster and squared distance of every usable row, as a written table, and the final centroids."""
    file = VaFile(rows, id, vector, dimensions, scale, bits)
    centroids = file.first_centroids(k, seed)
    if not len(centroids):
        schema = file.vectors.select("id").schema.add("cluster", "integer").add("distance", "long")
        file.close()
        return rows.sparkSession.createDataFrame([], schema), centroids
    state = file.compress(centroids)
    moved, total = _moved(state), np.zeros((len(centroids), dimensions + 1), object)
    for done in range(rounds):
        if done:
            state, fetched = file.settle(file.sift(state, centroids), centroids)
            moved = _moved(fetched)
            file.forget(keep=2)
            if not moved:
                break
        for cluster, sums in moved.items():
            total[cluster] += np.array(sums, object)
        # Python's integers divide downwards.
        centroids = np.array(
            [[x // t[0] for x in t[1:]] if t[0] else c for c, t in zip(centroids.tolist(), total.tolist(), strict=True)],
            np.int64,
        )
    found = file.assign(file.sift(state, centroids), centroids)
    file.close()
    return found, centroids


def audited(rows: DataFrame) -> DataFrame:
    """Per vector: its cluster, distance, the distances added up over its cluster and over all, and its centroid's hash."""
    spark = rows.sparkSession
    found, centroids = clusters(rows)
    texts = [",".join(map(str, c)) for c in centroids.tolist()]
    hashes = [(k, hashlib.sha256(t.encode()).hexdigest()) for k, t in enumerate(texts)]
    named = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(named, "cluster")
    # A row per centroid.
    few = sums.selectExpr("*", "sum(cluster_inertia) OVER () AS inertia")
    joined = found.join(F.broadcast(few), "cluster")
    return joined.selectExpr("id AS vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
