"""Near-duplicates by SimHash, compared exactly in tiles.

A fingerprint's tile is given by the bit counts of its four 16-bit segments. Fingerprints that differ in r bits lie in
tiles whose counts differ by at most r in all, so that other pairs of tiles are skipped; the rest is compared by numpy
exclusive-or and bit counts. A tile of many fingerprints is cut into chunks of about CHUNK. There are at most 17^4
tiles, which bounds the table of their sizes that is broadcast. Equal fingerprints are compared once.

Null or empty text, or white space only: fingerprint zero, linked like any other. Null doc_id: the row is linked, and
its id is no candidate for the component's smallest; a component without any id has component_id null. Repeated rows:
each gets its row. Very long texts: whole, in steps.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common
from cohortrail.llm.components import components
from cohortrail.operators.skew import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
CHUNK = 4096
SEGMENTS = 4
SIDE = 64 // SEGMENTS + 1  # bit counts of a segment: 0 to 16
STEP_WORDS = 1 << 17
STEP_CELLS = 1 << 21


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """As an unsigned number. Words are cut at ASCII white space, A-Z are lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle + 1, 1)
    bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, last, STEP_WORDS):
        a = starts[at : min(at + STEP_WORDS, last)].tolist()
        b = ends[at + shingle - 1 : at + shingle - 1 + len(a)].tolist() if len(words) >= shingle else [len(joined)]
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b, strict=True)], "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * bits > last, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with `fp`, the fingerprint as a signed 64-bit number."""

    def work():
        def each(batch: pa.RecordBatch) -> list[pa.Array]:
            found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            return [pa.array(found.view(np.int64))]

        return each

    return common.add_columns(df, {"text": f"`{text}`"}, "fp bigint", work)


def _tile(counts: list[str]) -> str:
    return " + ".join(f"{c} * {SIDE**i}" for i, c in enumerate(counts))


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of tiles within the radius of which one of each opposite two is taken, and none."""
    near = [d for d in itertools.product(range(-radius, radius + 1), repeat=SEGMENTS) if sum(map(abs, d)) <= radius]
    return [d for d in near if d <= (0,) * SEGMENTS]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs a, b of the distinct numbers in the column `fp` that differ in 1 to `radius` bits, each pair once."""
    width = 64 // SEGMENTS
    counts = [f"bit_count(shiftrightunsigned(fp, {i * width}) & {2**width - 1}L)" for i in range(SEGMENTS)]
    placed = prints.selectExpr("fp", *[f"CAST({c} AS int) AS c{i}" for i, c in enumerate(counts)])
    own = _tile([f"c{i}" for i in range(SEGMENTS)])
    sizes = F.broadcast(
        placed.groupBy(F.expr(own).alias("tile")).agg(F.expr(f"CAST(ceil(count(1) / {CHUNK}) AS int)").alias("chunks"))
    )
    home = placed.withColumn("tile", F.expr(own)).join(sizes, "tile").selectExpr(
        "fp", "tile AS own", *[f"c{i}" for i in range(SEGMENTS)], "pmod(xxhash64(fp), chunks) AS chunk"
    )
    tiles = []
    for step in _steps(radius):
        moved = [f"(c{i} + {d})" for i, d in enumerate(step)]
        inside = " AND ".join(f"{m} BETWEEN 0 AND {SIDE - 1}" for m, d in zip(moved, step, strict=True) if d) or "true"
        tiles.append(f"CASE WHEN {inside} THEN {_tile(moved)} END")
    visits = (
        home.selectExpr("fp", "own", "chunk", f"explode(filter(array({', '.join(tiles)}), t -> t IS NOT NULL)) AS tile")
        .join(sizes, "tile")
        .selectExpr(
            "fp",
            "tile",
            "tile = own AS same",
            "chunk AS own_chunk",
            "explode(sequence(0, CASE WHEN tile = own THEN CAST(chunk AS int) ELSE chunks - 1 END)) AS chunk",
        )
        .selectExpr("tile", "chunk", "NOT (same AND chunk = own_chunk) AS visitor", "fp")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile and chunk, those at home first: each meets those at home before it."""
        key, there = None, np.zeros(0, np.uint64)
        for batch in batches:
            tile, chunk, visitor, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fp, keys = fp.view(np.uint64), tile.astype(np.int64) << 32 | chunk
            cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
            pairs = []
            for i, j in itertools.pairwise(cuts.tolist()):
                if keys[i] != key:
                    key, there = keys[i], there[:0]
                known = len(there)
                new = fp[i:j][~visitor[i:j]]
                there = np.concatenate((there, new))
                rows, first = fp[i:j], np.where(visitor[i:j], len(there), known + np.arange(j - i))
                step = max(1, STEP_CELLS // max(1, len(there)))
                for at in range(0, len(rows), step):
                    part = rows[at : at + step]
                    near = np.bitwise_count(part[:, None] ^ there[None, :]) <= radius
                    r, c = np.nonzero(near)
                    keep = c < first[at : at + step][r]
                    pairs.append((part[r[keep]], there[c[keep]]))
            if pairs:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*pairs, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    n = common.shuffle_partitions(prints.sparkSession)
    return (
        visits.repartition(n, "tile", "chunk")
        .sortWithinPartitions("tile", "chunk", "visitor")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def clusters(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, h (hash of id and text), fp, root (its component's smallest fp) and component_id of each row."""
    prints = fingerprints(documents.select("doc_id", "text")).selectExpr("doc_id", "xxhash64(doc_id, text) AS h", "fp")
    return _clusters(materialize(prints, "prints"), radius)


def _clusters(prints: DataFrame, radius: int) -> DataFrame:
    groups = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "groups")
    roots = components(links(groups, radius))
    rooted = groups.join(roots, groups.fp == roots.node, "left").selectExpr("fp", "coalesce(root, fp) AS root", "first")
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return prints.join(named, "fp")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id: the smallest doc_id reachable over links."""
    return clusters(documents).selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")


def one_per_group(documents: DataFrame, grouped: DataFrame | None = None) -> DataFrame:
    """The rows of `documents` of which one stays per component: that of the smallest id, then of the smallest hash.

    `grouped` has doc_id, h and root of each row, by default those of `clusters`.
    """
    key, first, nr = (common.fresh(documents, c) for c in ("keep_h", "keep_id", "keep_nr"))
    keep = (
        (clusters(documents) if grouped is None else grouped)
        .groupBy("root")
        .agg(F.expr("min(struct(doc_id IS NULL AS no_id, doc_id, h)) AS first"))
        .selectExpr(f"first.doc_id AS {first}", f"first.h AS {key}")
    )
    hashed = documents.withColumn(key, F.expr("xxhash64(doc_id, text)"))
    joined = hashed.join(keep, [key]).where(f"doc_id <=> {first}")
    # A row that is there several times stays once.
    order = f"row_number() OVER (PARTITION BY {key}, {first} ORDER BY {key})"
    kept = joined.withColumn(nr, F.expr(order)).where(f"{nr} = 1")
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])
