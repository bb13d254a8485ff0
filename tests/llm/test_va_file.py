"""Centroid clustering against plain k-means in integers, and what the intervals rule out."""

import hashlib

import numpy as np
import pytest

from cohortrail.llm import va_file


def plain(rows, k=8, rounds=10):
    """vec_id and vector rows to (vec_id, cluster, distance) and centroids, by the contract's words."""
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    started = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [list(v) for _, v in started[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = [nearest(v)[0] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [(i, *nearest(v)) for i, v in kept], centroids


def vectors(n, seed, spread=0.1):
    random = np.random.default_rng(seed)
    return random.normal(0, spread, (n, 64)).astype(np.float32).astype(float).tolist()


@pytest.mark.parametrize("bits", [2, 8])
def test_clusters_are_those_of_plain_k_means(spark, bits):
    rows = list(enumerate(vectors(160, 1)))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    found, centroids = va_file.clusters(df, bits=bits, rounds=4)
    want, last = plain(rows, rounds=4)
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert centroids.tolist() == last


def test_unusable_repeated_and_tied_rows(spark):
    given = vectors(6, 2)
    rows = [(i, v) for i, v in enumerate(given)] + [(1, given[1]), (1, given[4]), (None, given[3])]
    bad = [(90, None), (91, given[0][:63]), (92, [*given[0][:63], None]), (93, [*given[0][:63], float("nan")]),
           (94, [*given[0][:63], float("-inf")]), (95, given[0] + [0.0]), (96, [1e30] * 64)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>")
    clashing = df.selectExpr("*", "1 AS key", "2 AS cells", "3 AS cluster", "4 AS whole", "5 AS id", "6 AS vector")
    out = va_file.audited(clashing).collect()
    want, last = plain(rows)
    key = lambda r: (r[0] is None, r)
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in out], key=key) == sorted(want, key=key)
    for r in out:
        assert r.inertia == sum(d for *_, d in want)
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, last[r.cluster])).encode()).hexdigest()


def test_equal_vectors_take_the_first_centroid(spark):
    rows = [(i, [0.5] * 64) for i in range(20)]
    out = va_file.audited(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert len(out) == 20 and {(r.cluster, r.distance, r.inertia) for r in out} == {(0, 0, 0)}


def test_empty_table(spark):
    out = va_file.audited(spark.createDataFrame([], "vec_id bigint, embedding array<float>"))
    assert out.count() == 0
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_intervals_hold_the_distances_and_rule_centroids_out():
    random = np.random.default_rng(4)
    x = random.integers(-600, 600, (2000, 64))
    x[:, 0] = 7  # a dimension without deviation
    cells = va_file.Cells(x.mean(axis=0), x.std(axis=0), x.min(axis=0), x.max(axis=0), 8)
    centroids = np.array([x[i::8].sum(axis=0) // len(x[i::8]) for i in range(8)])
    lookup, own = va_file.Lookup(cells, centroids), cells.of(x)
    assert all((cells.low[d][own[:, d]] <= x[:, d]).all() and (x[:, d] <= cells.high[d][own[:, d]]).all() for d in range(64))
    near = lookup.near(own)
    exact = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert near[np.arange(len(x)), exact.argmin(axis=1)].all()
    cluster, distance = lookup.nearest(x, near)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    # Most centroids are ruled out without the vector.
    assert near.mean() < 0.4
