"""Near-duplicates by Jaccard similarity of word shingles, found by prefix filtering: no similar pair is missed.

Texts are sets of hashes of SHINGLE words, cut as for fingerprints. In any order of all shingles, two sets of a
similarity of at least 4/5 share one of the first n - ceil(4n/5) + 1 of each (n its size). These prefixes are grouped by
shingle, pairs that meet are verified on whole sets in integers. The order puts shingles last that a sample of documents
holds often, so that common lines bring few pairs together; it decides on speed alone. A bound on differing bits of
fingerprints would miss pairs: at a similarity of 0.8 they differ in 9.7 of 64 bits on average, by chance in any number.

Equal sets are one node. Large groups don't make all their pairs: first each node is verified against two of the nodes
that stand for its shingles, then only pairs of different components are.

Null or empty text, or white space only: the empty set, similar to no other. Fewer words than SHINGLE: one shingle.
Repeated rows and null doc_id: as in `simhash`. Very long texts: whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common, simhash
from cohortrail.llm.components import components
from cohortrail.operators.skew import materialize

SHINGLE = 5
# Documents, and shingles of them, that the order of shingles is taken from.
ORDER_DOCUMENTS = 5_000
ORDER_SHINGLES = 100_000
STEP_PAIRS = 1 << 20


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles, as signed numbers."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    a = starts[: max(len(words) - SHINGLE + 1, 1)].tolist()
    b = ends[SHINGLE - 1 :].tolist() if len(words) >= SHINGLE else [len(joined)]
    hashes = np.fromiter((digest(joined[i:j], simhash.SEED) for i, j in zip(a, b, strict=True)), np.uint64, len(a))
    return np.unique(hashes.view(np.int64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sets is at least 4/5."""
    common_ones = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * common_ones >= 4 * (len(a) + len(b))


def _frequent(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of the sampled documents hold, sorted, and in how many."""
    every = max(1, documents.count() // ORDER_DOCUMENTS)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py()))], ["s"])

    sample = documents.where(f"pmod(xxhash64(doc_id, text), {every}) = 0").select("text")
    counted = sample.mapInArrow(held, "s bigint").groupBy("s").agg(F.expr("count(1) AS n")).where("n > 2")
    rows = counted.orderBy(F.desc("n"), "s").limit(ORDER_SHINGLES).collect()
    known = np.array(sorted((r.s, r.n) for r in rows), np.int64).reshape(-1, 2)
    return known[:, 0].copy(), known[:, 1].copy()


def _prints(documents: DataFrame) -> DataFrame:
    """doc_id, h (hash of id and text), node (hash of the set), n (its size) and `prefix` of each row, written.

    Of equal sets in a task only the first has a prefix.
    """
    sent = documents.sparkSession.sparkContext.broadcast(_frequent(documents))
    rows = documents.selectExpr("doc_id", "xxhash64(doc_id, text) AS h", "text")

    def work():
        known, times = sent.value
        seen: set[int] = set()

        def each(batch: pa.RecordBatch) -> list[pa.Array]:
            nodes, sizes, prefixes = [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py())
                node = int(np.uint64(xxhash.xxh64_intdigest(own.tobytes())).view(np.int64))
                first = min(len(own), len(own) + (-4 * len(own)) // 5 + 1)
                nodes.append(node)
                sizes.append(len(own))
                prefixes.append(None)
                if node not in seen and len(own):
                    seen.add(node)
                    weight = np.zeros(len(own), np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                        weight = np.where(known[at] == own, times[at], 0)
                    prefixes[-1] = own[np.argsort(weight, kind="stable")[:first]]
            kind = pa.list_(pa.int64())
            return [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prefixes, kind)]

        return each

    found = common.add_columns(rows, {"text": "text"}, "node bigint, n int, prefix array<bigint>", work)
    return materialize(found.select("doc_id", "h", "node", "n", "prefix"), "prints")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b of nodes whose sets are similar, written."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = batch.column("own"), batch.column("other")
            keep = [
                similar(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64))
                for x, y in zip(own, other, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.selectExpr(f"node AS {k}", f"grams AS {c}") for k, c in (("a", "own"), ("b", "other")))
    return materialize(pairs.join(left, "a").join(right, "b").mapInArrow(check, "a bigint, b bigint"), "verified")


def _meetings(rows: DataFrame) -> DataFrame:
    """Pairs a, b of nodes of different roots that meet in a shingle and have enough shingles from there on.

    `rows` come with shingle, node, root, n and pos (place in the order). Two sets of which a shingle is the first
    common one have at most as many more as the shorter rest holds.
    """

    def pairs(key_rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        node, root, n, pos = np.concatenate(key_rows, axis=1)
        order = np.argsort(root, kind="stable")
        node, root, n, pos = node[order], root[order], n[order], pos[order]
        later = np.searchsorted(root, root, side="right")
        step = max(1, STEP_PAIRS // max(1, len(node)))
        for at in range(0, len(node), step):
            i, j = np.arange(at, min(at + step, len(node)))[:, None], np.arange(len(node))[None, :]
            most = np.minimum(n[i] - pos[i], n[j] - pos[j])
            r, c = np.nonzero((j >= later[i]) & (9 * most >= 4 * (n[i] + n[j])))
            x, y = node[r + at], node[c]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shingle."""
        key, held = None, []
        for batch in batches:
            columns = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            keys = columns[0]
            cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))).tolist()
            for i, j in zip(cuts, cuts[1:], strict=False):
                if keys[i] != key:
                    if held:
                        yield from pairs(held)
                    key, held = keys[i], []
                held.append(columns[1:, i:j])
        if held:
            yield from pairs(held)

    n = common.shuffle_partitions(rows.sparkSession)
    dealt = rows.select("shingle", "node", "root", "n", "pos").repartition(n, "shingle").sortWithinPartitions("shingle")
    return dealt.mapInArrow(met, "a bigint, b bigint")


def clusters(documents: DataFrame) -> DataFrame:
    """doc_id, h (hash of id and text) and root (its component's smallest node) of each row."""
    prints = _prints(documents.select("doc_id", "text"))
    placed = prints.where("prefix IS NOT NULL").selectExpr("node", "n", "posexplode(prefix) AS (pos, shingle)")
    alone = "OVER (PARTITION BY shingle)"
    # Sets of similar sizes only; in the order of sizes, a row has a partner if and only if its neighbour is one.
    by_size = "OVER (PARTITION BY shingle ORDER BY n, node)"
    sized = placed.distinct().selectExpr("*", f"lag(n) {by_size} AS below", f"lead(n) {by_size} AS above")
    sized = sized.where("5 * below >= 4 * n OR 5 * n >= 4 * above").drop("below", "above")
    pivot = f"min_by(struct(node, n, pos), xxhash64(node, shingle)) {alone} AS pivot"
    shared = materialize(sized.selectExpr("*", pivot), "shared")

    two = "struct(xxhash64(node, pivot.node) AS at, pivot.node AS pivot)"
    enough = "node <> pivot.node AND 9 * least(n - pos, pivot.n - pivot.pos) >= 4 * (n + pivot.n)"
    stars = shared.where(enough).groupBy("node").agg(F.expr(f"array(min({two}).pivot, max({two}).pivot) AS near"))
    stars = stars.selectExpr("node", "explode(near) AS near").selectExpr("least(node, near) AS a", "greatest(node, near) AS b")

    chosen = prints.join(shared.select("node").distinct(), "node", "left_semi")
    chosen = chosen.where("prefix IS NOT NULL").groupBy("node").agg(F.min("h").alias("h"))
    texts = documents.selectExpr("xxhash64(doc_id, text) AS h", "text").join(chosen, "h")

    def work():
        return lambda batch: [pa.array([shingles(t.as_py()).tobytes() for t in batch.column("text")], pa.binary())]

    sets = common.add_columns(texts, {"text": "text"}, "grams binary", work)
    # A row that is there several times gives its set once.
    sets = materialize(sets.select("node", "grams").dropDuplicates(["node"]), "sets")

    edges = _verified(stars.distinct(), sets)
    roots = components(edges)
    rooted = shared.join(roots, "node", "left").selectExpr("shingle", "node", "coalesce(root, node) AS root", "n", "pos")
    apart = rooted.selectExpr("*", f"min(root) {alone} < max(root) {alone} AS apart").where("apart")
    more = _verified(_meetings(apart).distinct(), sets)
    roots = components(edges.unionByName(more))
    return prints.join(roots, "node", "left").selectExpr("doc_id", "h", "coalesce(root, node) AS root")


def one_per_group(documents: DataFrame) -> DataFrame:
    """The rows of `documents` of which one stays per group of near-duplicates, chosen as in `simhash`."""
    return simhash.one_per_group(documents, clusters(documents))
