"""Exact top-k by inner product, pruned by segment statistics from coarse to fine.

A vector is cut into 1, 4 and 16 segments. From means and deviations of the segments (n their length, m mean, s
deviation) follows a lower bound of the distance, |a - b|^2 >= sum n ((ma - mb)^2 + (sa - sb)^2), and with the norms
an upper bound of the inner product, a.b <= sum n (ma mb + sa sb). Bounds are products of small matrices. A candidate
whose bound stays below a query's k-th best so far is out; the coarse level decides most cheaply, survivors go to the
next one. What is left of a tile is scored exactly: by a product of matrices where all sums fit into the 53 bits of a
double, else pair by pair in integers.

Queries are a stated part of the rows. They are dealt into blocks of about BLOCK, candidates into slices; each slice
meets each block in a task, which holds one block and one tile of candidates at a time. Partial top-k lists of the
slices are merged by a ranking.

Vectors that are null or hold null or non-finite components take no part, nor do rows without id. Rows with the same
id are each a query and a candidate of their own: a query meets all rows but its own. Missing components of a shorter vector count as 0. Ties go to the smaller id. An
empty table gives no rows. Scores must fit into 64 bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common
from cohortrail.operators.skew import materialize

K = 20
LEVELS = (1, 4, 16)
BLOCK = 8192
TILE = 256
EXACT = 2**53
STEP = 1 << 16
# A relative margin for rounding in the bounds.
MARGIN = 1e-9


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of the length: their product bounds the score."""
    cuts = np.unique(np.linspace(0, vectors.shape[1], segments + 1).astype(int))
    parts = [vectors[:, a:b] for a, b in itertools.pairwise(cuts.tolist())]
    if not parts:
        return np.zeros((len(vectors), 1))
    means = [p.mean(axis=1) * np.sqrt(p.shape[1]) for p in parts]
    return np.stack(means + [p.std(axis=1) * np.sqrt(p.shape[1]) for p in parts], axis=1)


class Best:
    """The k best candidates so far of each query of a block. `nrs` tell rows apart, `ids` name them."""

    def __init__(self, nrs: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.nrs, self.ids, self.k = nrs, ids, k
        self.vectors = vectors
        self.levels = [statistics(vectors.astype(np.float64), n) for n in LEVELS]
        self.rows, self.scores, self.found = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(ids), -np.inf)
        self.met = self.left = 0  # pairs, and those that no bound ruled out

    def add(self, nrs: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        width = max(vectors.shape[1], self.vectors.shape[1])
        if vectors.shape[1] < width:
            vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        if self.vectors.shape[1] < width:
            self.vectors = np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1])))
            self.levels = [statistics(self.vectors.astype(np.float64), n) for n in LEVELS]
        q, c = np.arange(len(self.ids)), np.arange(len(ids))
        alive = self.nrs[:, None] != nrs[None, :]
        self.met += alive.size
        real = vectors.astype(np.float64)
        for n, own in zip(LEVELS, self.levels, strict=True):
            theirs = statistics(real[c], n)
            bound = own[q] @ theirs.T
            margin = MARGIN * np.sqrt((own[q] ** 2).sum(axis=1).max(initial=0) * (theirs**2).sum(axis=1).max(initial=0))
            alive &= bound + margin >= self.least[q][:, None]
            rows, columns = alive.any(axis=1), alive.any(axis=0)
            q, c, alive = q[rows], c[columns], alive[rows][:, columns]
        self.left += int(alive.sum())
        if not alive.size:
            return
        largest = [int(np.abs(x).max(initial=0)) for x in (self.vectors, vectors)]
        if largest[0] * largest[1] * width < EXACT:
            scores = np.where(alive, self.vectors[q].astype(np.float64) @ real[c].T, -np.inf)
            least = self.least[q]
            if len(c) > self.k:
                # The k-th best of the tile, with all that equal it.
                least = np.maximum(least, np.partition(scores, len(c) - self.k, axis=1)[:, len(c) - self.k])
            i, j = np.nonzero(alive & (scores >= least[:, None]))
            self._merge(q[i], scores[i, j].astype(np.int64), ids[c[j]])
            return
        i, j = np.nonzero(alive)
        i, j = q[i], c[j]
        scores = np.concatenate(
            [np.zeros(0, np.int64)]
            + [(self.vectors[i[a : a + STEP]] * vectors[j[a : a + STEP]]).sum(axis=1) for a in range(0, len(i), STEP)]
        )
        keep = scores >= self.least[i]
        self._merge(i[keep], scores[keep], ids[j[keep]])

    def _merge(self, rows: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        rows = np.concatenate((self.rows, rows))
        scores, found = np.concatenate((self.scores, scores)), np.concatenate((self.found, found))
        order = np.lexsort((found, -scores, rows))
        rows, scores, found = rows[order], scores[order], found[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = rank < self.k
        self.rows, self.scores, self.found = rows[keep], scores[keep], found[keep]
        last = rank[keep] == self.k - 1
        self.least[self.rows[last]] = self.scores[last]

    def batch(self) -> pa.RecordBatch:
        arrays = [self.nrs[self.rows], self.ids[self.rows], self.found, self.scores]
        return pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["query_nr", "query_id", "vec_id", "score"])


def _matrix(column: pa.ListArray) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def search(vectors: DataFrame, is_query: str, k: int = K) -> DataFrame:
    """query_nr, query_id, vec_id, score: the k best other rows for each row where the SQL condition `is_query` holds, in
    each slice of the rows.

    `vectors`, a written table, has `nr` (unique), `vec_id` and `v` (array<bigint>, no nulls).
    """
    spark = vectors.sparkSession
    n = common.shuffle_partitions(spark)
    blocks = -(-vectors.where(is_query).count() // BLOCK) or 1
    slices = max(1, -(-n // blocks))
    query = vectors.where(is_query).selectExpr(
        f"CAST(pmod(xxhash64(nr), {blocks}) AS int) AS block",
        f"explode(sequence(0, {slices - 1})) AS slice",
        "false AS candidate",
        "nr",
        "vec_id",
        "v",
    )
    candidates = vectors.selectExpr(
        f"explode(sequence(0, {blocks - 1})) AS block",
        f"CAST(pmod(xxhash64(nr, 'slice'), {slices}) AS int) AS slice",
        "true AS candidate",
        "nr",
        "vec_id",
        "v",
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block and slice, the queries of each first."""
        key, best, held = None, None, []
        for batch in batches:
            block, part, candidate, nrs, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            keys = block.astype(np.int64) << 32 | part
            matrix = _matrix(batch.column(5))
            kinds = keys * 2 + candidate
            cuts = np.flatnonzero(np.concatenate(([True], kinds[1:] != kinds[:-1], [True])))
            for i, j in itertools.pairwise(cuts.tolist()):
                if keys[i] != key:
                    if best:
                        yield best.batch()
                    key, best, held = keys[i], None, []
                if not candidate[i]:
                    held.append((nrs[i:j], ids[i:j], matrix[i:j]))
                    continue
                if held:
                    width = max(m.shape[1] for *_, m in held)
                    whole = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) for *_, m in held]
                    own = (np.concatenate([h[x] for h in held]) for x in (0, 1))
                    best, held = Best(*own, np.concatenate(whole), k), []
                if best:
                    for at in range(i, j, TILE):
                        part = slice(at, min(at + TILE, j))
                        best.add(nrs[part], ids[part], matrix[part])
        if best:
            yield best.batch()

    return (
        query.unionByName(candidates)
        .repartitionById(blocks * slices, F.expr(f"block * {slices} + slice"))
        .sortWithinPartitions("block", "slice", "candidate")
        .mapInArrow(score, "query_nr bigint, query_id bigint, vec_id bigint, score bigint")
    )


def scaled(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and v: the floors of the scaled components, of the vectors that take part."""
    x = "CAST(x AS double)"
    usable = f"vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND abs({x}) < double('inf'))"
    floors = f"transform(embedding, x -> CAST(floor({scale} * {x}) AS bigint)) AS v"
    return embeddings.where(usable).selectExpr("vec_id", floors)


def neighbours(embeddings: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best for the rows whose id is divisible by `every`."""
    vectors = materialize(scaled(embeddings).withColumn("nr", F.monotonically_increasing_id()), "vectors")
    found = search(vectors, f"vec_id % {every} = 0", k)
    ranked = "CAST(row_number() OVER (PARTITION BY query_nr ORDER BY score DESC, vec_id) AS int) AS rank"
    return found.selectExpr("query_id", ranked, "vec_id", "score").where(f"rank <= {k}")
