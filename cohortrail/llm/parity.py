"""Jaccard join of shingle sets by parity sketches: no similar pair is missed.

A set's sketch has a bit for each of many slots, the exclusive-or of the elements that hash to it. An element that only
one of two sets has flips one bit, so the Hamming distance of two sketches is at most the size of their symmetric
difference; and two sets of a and b elements that are similar enough differ in at most (100 - t)(a + b) / (100 + t)
elements for a similarity of t percent.

Sets are joined within bands of sizes, a set near the upper end of its band in the next one too. A band's sketch is cut
into pieces of several 64-bit words, so many that some piece has at most `errors` of the differing bits; of that piece's
words, all but `errors` are equal, and each choice of so many words gives a signature. Sets that share a signature meet.
The more documents there are, the more words a signature covers (`choice`), so that chance meetings stay a few a set; this
decides on speed alone. Signatures leave a task packed by target partition, six bytes each. Of equal sets (128 bits of
their hash), which are linked directly, only the first node's signatures are dealt.

Where several sets meet, each is first compared with one of them, by a sketch of its own and then by the whole sets
in integers. That one is the set that meets others most often. What is linked needs no further pair. Only groups that still hold sets of different components are compared
within, in tiles of bounded size, and only pairs whose sketches are near enough leave the task.

Words are cut at ASCII white space, A-Z are lower-cased, shingles are compared by 64-bit hashes. Fewer words than SHINGLE:
the whole sequence is one. Null text, no words: the empty set, linked with nothing. Null doc_id: linked, but no
candidate for the smallest id; a component without any has component_id null, a row linked with nothing its own id.
Repeated rows: each gets its row. Very long texts: whole; their own sketch is folded to LARGEST_SKETCH bits, a weaker
but true bound. Empty table: no rows. Further columns play no part, whatever their names.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common
from cohortrail.llm.components import components
from cohortrail.operators.skew import heaviest, join_unique

SHINGLE = 4
PERCENT = 85
# Words of a piece and bits in which it may differ, in the order of growing cover and number of signatures.
CHOICES = ((2, 1), (4, 1), (5, 2), (7, 3), (10, 5), (12, 6))
MEETINGS = 0.25  # chance meetings of a set that are put up with
BANDS = 8  # over which sets are thought to spread when meetings are estimated
LEAST_SKETCH, LARGEST_SKETCH = 64, 1 << 16
SEEN = 250_000  # distinct sets that a task remembers
WORDS = 250_000  # hashes of words that a task remembers
WINDOW = 1 << 16  # sets whose signatures are packed together, as a place in the pack has two bytes
PACKED = 1_000_000  # signatures held before they are packed
BROADCAST_PLACES = 1 << 22  # of four bytes
TILE = 1024
TOLD = 500_000  # pairs that a task remembers
STEP_BYTES = 16 << 20
LARGE = 1_000  # rows of a large component
BROADCAST_NODES = 500_000  # rows of 24 bytes

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles(dict):
    """Sets of shingle hashes of texts; remembers hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Sorted and distinct."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        if len(words) < SHINGLE:
            whole = xxhash.xxh64_intdigest(b" ".join(words), len(words))
            return np.array([whole], np.uint64)
        n = len(words) - SHINGLE + 1
        total = np.zeros(n, np.uint64)
        for i in range(SHINGLE):
            total += hashes[i : i + n] * _ODD[i]
        return np.unique(_mix(total))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return bool((100 + PERCENT) * both >= PERCENT * (len(a) + len(b)))


def difference(a, b):
    """Elements in which similar sets of these sizes differ at most."""
    return (100 - PERCENT) * (a + b) // (100 + PERCENT)


def reach(n: int) -> int:
    """The largest size of a set similar to one of n elements."""
    return 100 * n // PERCENT


def bands(most: int) -> list[int]:
    """Smallest sizes of the bands, one more than needed for sets of `most` elements. A similar set of a larger size lies
    in the same band or the next."""
    edges = [1]
    while edges[-1] <= most or len(edges) < 3:
        edges.append(reach(reach(edges[-1])) + 1)
    return [*edges, reach(reach(edges[-1])) + 1]


def choice(documents: int) -> tuple[int, int]:
    """The first of CHOICES by which a set meets MEETINGS others by chance at most, by a rough estimate."""
    per_error = (100 + PERCENT) / (2 * (100 - PERCENT))  # elements of a set for each differing one
    for words, errors in CHOICES:
        cover = per_error * (errors + 1) * (words - errors) / words
        signatures = 64 / (errors + 1) * math.comb(words, errors)
        if documents / BANDS * signatures * math.exp(-1.6 * cover) <= MEETINGS:
            break
    return words, errors


def parity(elements: np.ndarray, words: int) -> np.ndarray:
    """The sketch of a set: 64 bits in each of `words` words."""
    place = (elements >> np.uint64(32)) % np.uint64(words) * np.uint64(64) + (elements & np.uint64(63))
    slots, times = np.unique(place, return_counts=True)
    slots = slots[times % 2 == 1]
    out = np.zeros(words, np.uint64)
    if len(slots):
        word = (slots >> np.uint64(6)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[cuts]] = np.bitwise_or.reduceat(np.uint64(1) << (slots & np.uint64(63)), cuts)
    return out


@cache
def _chosen(words: int, errors: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(words), words - errors)))


def signatures(elements: np.ndarray, band: int, top: int, words: int, errors: int) -> np.ndarray:
    """Of a set in a band of sizes up to `top`."""
    pieces, chosen = difference(top, top) // (errors + 1) + 1, _chosen(words, errors)
    sketch = parity(elements, pieces * words).reshape(pieces, words)
    start = _mix(np.arange(pieces, dtype=np.uint64) * _ODD[0] + np.uint64(band))
    key = start[:, None] + np.arange(len(chosen), dtype=np.uint64) * _ODD[1]
    for words_of in chosen.T:
        key = _mix(key ^ sketch[:, words_of])
    return key.ravel()


def sketch(elements: np.ndarray) -> bytes:
    """The set's own sketch: at least two bits for each element, by powers of two, so that two can be folded to one size."""
    bits = LEAST_SKETCH
    while bits < 2 * len(elements) and bits < LARGEST_SKETCH:
        bits *= 2
    slots, times = np.unique((elements >> np.uint64(13)) & np.uint64(bits - 1), return_counts=True)
    out = np.zeros(bits, bool)
    out[slots[times % 2 == 1].astype(np.int64)] = True
    return np.packbits(out).tobytes()


def folded(sketches: np.ndarray, size: int) -> np.ndarray:
    """Rows of bytes, halved until they have `size`."""
    while sketches.shape[1] > size:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def near(a: bytes, b: bytes, most: int) -> bool:
    x, y = (np.frombuffer(s, np.uint8)[None, :] for s in (a, b))
    size = min(x.shape[1], y.shape[1])
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()) <= most


def _prints(documents: DataFrame) -> tuple[DataFrame, str]:
    """Written: a row per document (doc_id, h, node, n; digest, sketch and base where the task has not met the set before),
    and rows with `part` that hold the signatures of many sets, by their places behind `base`."""
    spark = documents.sparkSession
    parts = common.shuffle_partitions(spark)
    words, errors = choice(documents.count())
    rows = documents.selectExpr("doc_id", "xxhash64(doc_id, text) AS h", "text")
    schema = rows.select("doc_id").schema.add("h", "long")  # null in rows of signatures
    schema["doc_id"].nullable = True
    for name, kind in [
        ("node", "long"), ("n", "long"), ("digest", "binary"), ("sketch", "binary"),
        ("part", "integer"), ("base", "long"), ("signatures", "binary"), ("places", "binary"),
    ]:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, known, seen = bands(1), Shingles(), {}
        base = at = TaskContext.get().partitionId() << 33
        keys: list[np.ndarray] = []
        places: list[np.ndarray] = []
        held = 0

        def packs(kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
            key, place = np.concatenate(keys), np.concatenate(places)
            part = (key >> np.uint64(32)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            key, place, part = key[order].astype("<u4"), place[order], part[order]
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))).tolist()
            spans = list(itertools.pairwise(cuts))
            columns = [pa.nulls(len(spans), k) for k in kinds] + [
                pa.array([int(part[i]) for i, _ in spans], pa.int32()),
                pa.array([base] * len(spans), pa.int64()),
                pa.array([key[i:j].tobytes() for i, j in spans], pa.binary()),
                pa.array([place[i:j].tobytes() for i, j in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            nodes, sizes, digests, sketches, bases = [], [], [], [], []
            kinds = [*(c.type for c in batch.columns[:2]), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            for text in batch.column("text"):
                own = known.of(text.as_py())
                digest = xxhash.xxh3_128_digest(own.tobytes())
                sizes.append(len(own))
                if len(own) and digest in seen:
                    nodes.append(seen[digest])
                    digests.append(None)
                    sketches.append(None)
                    bases.append(None)
                    continue
                nodes.append(at)
                digests.append(digest if len(own) else None)
                sketches.append(sketch(own) if len(own) else None)
                bases.append(base if len(own) else None)
                if len(own):
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[digest] = at
                    if len(own) >= edges[-2]:
                        edges = bands(len(own))
                    band = int(np.searchsorted(edges, len(own), side="right")) - 1
                    inside = [band, band + 1] if reach(len(own)) >= edges[band + 1] else [band]
                    for b in inside:
                        found = signatures(own, b, edges[b + 1] - 1, words, errors)
                        keys.append(found)
                        places.append(np.full(len(found), at - base, np.uint16))
                        held += len(found)
                at += 1
                if held >= PACKED or at - base >= WINDOW:
                    if keys:
                        yield from packs(kinds)
                    keys.clear()
                    places.clear()
                    base, held = at, 0
            n = batch.num_rows
            columns = [
                *batch.columns[:2], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()), pa.nulls(n, pa.int32()),
                pa.array(bases, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)
        if keys:
            yield from packs(kinds)
        del known, seen
        common.give_back()

    return common.stored(rows.mapInArrow(run, schema), "prints")


def _equal(sets: DataFrame) -> tuple[DataFrame, str]:
    """a, b: a node and the first one of the same set; and the node's base. Written."""
    first = sets.groupBy("digest").agg(F.min("node").alias("b"), F.expr("count(1) AS times")).where("times > 1")
    same = sets.select("node", "digest", "base").join(first, "digest").where("node <> b")
    return common.stored(same.selectExpr("node AS a", "b", "base"), "equal")


def _of_first(packs: DataFrame, equal: DataFrame) -> DataFrame:
    """The packs without the signatures of nodes `a`. Few such nodes are sent to the packs, where these lie."""
    gone = equal.groupBy("base").agg(F.expr("collect_set(CAST(a - base AS int)) AS gone"))
    if equal.count() <= BROADCAST_PLACES:
        gone = F.broadcast(gone)
    rows = packs.select("part", "base", "signatures", "places").join(gone, "base", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places = [], []
            for key, place, out in zip(*batch.columns[2:], strict=True):
                key, place = np.frombuffer(key.as_buffer(), "<u4"), np.frombuffer(place.as_buffer(), "<u2")
                if out.is_valid:
                    stays = np.ones(WINDOW, bool)
                    stays[out.values.to_numpy()] = False
                    kept = stays[place]
                    key, place = key[kept], place[kept]
                keys.append(key.tobytes())
                places.append(place.tobytes())
            columns = [*batch.columns[:2], pa.array(keys, pa.binary()), pa.array(places, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "base", "signatures", "places"])
            del batch, keys, places, columns
        common.give_back()

    narrow = rows.select("part", "base", "signatures", "places", "gone")
    return narrow.mapInArrow(run, "part int, base bigint, signatures binary, places binary")


def _meetings(packs: DataFrame) -> DataFrame:
    """The groups of two or more nodes that share a signature: `nodes` and a hash of these. Groups of the same nodes are
    one in each task."""
    spark = packs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes = [], []
        for batch in batches:
            for base, key, place in zip(*batch.columns, strict=True):
                keys.append(np.frombuffer(key.as_buffer(), "<u4"))
                nodes.append(np.frombuffer(place.as_buffer(), "<u2").astype(np.int64) + base.as_py())
        if not keys:
            return
        key, node = np.concatenate(keys), np.concatenate(nodes)
        del keys, nodes
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        keep = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node = key[keep], node[keep]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        mixed = node.view(np.uint64)
        sums = [np.add.reduceat(_mix(mixed * _ODD[i] + _ODD[i + 1]), first) for i in (0, 2)]
        several = np.flatnonzero(size > 1)
        hashes = np.stack([*(x[several] for x in sums), size[several].astype(np.uint64)], axis=1)
        _, chosen = np.unique(hashes, axis=0, return_index=True)
        for at in range(0, len(chosen), 4096):
            part = several[chosen[at : at + 4096]]
            ends = np.concatenate(([0], np.cumsum(size[part])))
            where = np.arange(ends[-1]) - np.repeat(ends[:-1], size[part]) + np.repeat(first[part], size[part])
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(node[where]))
            names = [hashes[c].tobytes() for c in chosen[at : at + 4096]]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), column], ["hash", "nodes"])
        common.give_back()

    dealt = packs.repartitionById(common.shuffle_partitions(spark), F.col("part"))
    return dealt.select("base", "signatures", "places").mapInArrow(run, "hash binary, nodes array<bigint>")


def _stars(groups: DataFrame) -> DataFrame:
    """a, b: the centre of a group and another node. The centre is the node that meets others most often over all groups:
    of the copies of one text, each with changes of its own, that is the text itself, with which all of them are linked."""
    pairs = groups.where("size(nodes) = 2").selectExpr("nodes[0] AS a", "nodes[1] AS b")
    large = groups.where("size(nodes) > 2").dropDuplicates(["hash"])
    # Two groups that a short hash takes for one have one centre; `_apart` compares within groups.
    held = large.selectExpr("xxhash64(hash) AS hash", "size(nodes) AS n", "explode(nodes) AS node")
    meets = held.groupBy("node").agg(F.expr("sum(n) AS meets"))
    centres = held.join(meets, "node").groupBy("hash").agg(F.expr("max(struct(meets, node)).node AS a"))
    stars = held.join(centres, "hash").where("node <> a").selectExpr("a", "node AS b")
    both = pairs.unionByName(stars)
    return both.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()


def _likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of different sets whose own sketches are near enough."""
    left, right = (
        sets.selectExpr(f"node AS {c}", f"n AS n_{c}", f"digest AS digest_{c}", f"sketch AS sketch_{c}") for c in "ab"
    )
    joined = pairs.join(left, "a").join(right, "b").where("digest_a <> digest_b")
    sized = joined.where(f"{PERCENT} * greatest(n_a, n_b) <= 100 * least(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, x, y = (c.to_pylist() for c in batch.columns)
            keep = [near(s, t, difference(n, m)) for n, m, s, t in zip(n_a, n_b, x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            del a, b

    return sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a bigint, b bigint")


def _texts(documents: DataFrame, prints: DataFrame, pairs: DataFrame) -> tuple[DataFrame, str]:
    """node and its compressed text, for the nodes of `pairs`, written."""
    nodes = pairs.selectExpr("inline(array(struct(a AS node), struct(b AS node)))").distinct()
    chosen = prints.where("digest IS NOT NULL").select("node", "doc_id", "h").join(nodes, "node")
    chosen, path = common.stored(chosen.withColumnRenamed("doc_id", "id"), "chosen")
    if chosen.count() <= BROADCAST_NODES:
        chosen = F.broadcast(chosen)
    rows = documents.selectExpr("doc_id", "xxhash64(doc_id, text) AS h", "text")
    found = rows.join(chosen, "h").where("id <=> doc_id").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [zlib.compress(t.as_py().encode(), 1) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(texts, pa.binary())], ["node", "packed"])

    # A row that is there several times gives its text once.
    packed = found.mapInArrow(run, "node bigint, packed binary").dropDuplicates(["node"])
    stored = common.stored(packed, "texts")
    common.discard(documents.sparkSession, path)
    return stored


def _verified(documents: DataFrame, prints: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of written pairs a, b those that are similar, written."""
    texts, path = _texts(documents, prints, pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in "ab")
            kept: dict[int, np.ndarray] = {}

            def own(node: int, packed: pa.Scalar, kept=kept) -> np.ndarray:
                if node not in kept:
                    if len(kept) >= 64:
                        kept.clear()
                    kept[node] = shingles.of(zlib.decompress(packed.as_py()).decode())
                return kept[node]

            rows = zip(a, b, batch.column("x"), batch.column("y"), strict=True)
            keep = [similar(own(i, x), own(j, y)) for i, j, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (texts.selectExpr(f"node AS {c}", f"packed AS {p}") for c, p in (("a", "x"), ("b", "y")))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    edges = common.stored(joined.mapInArrow(run, "a bigint, b bigint"), "links")[0]
    common.discard(documents.sparkSession, path)
    return edges


def _apart(groups: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs a, b within the groups that belong to different components and have near sketches.

    A group of more than TILE nodes is cut into chunks, and each pair of chunks is a tile. Two groups that a short hash
    takes for one only compare more.
    """
    spark = groups.sparkSession
    chunked = groups.dropDuplicates(["hash"]).selectExpr(
        "xxhash64(hash) AS hash", f"CAST(ceil(size(nodes) / {TILE}) AS int) AS chunks", "posexplode(nodes) AS (at, node)"
    )
    rooted = chunked.join(roots, "node", "left").selectExpr("*", "coalesce(root, node) AS own").drop("root")
    mixed = rooted.groupBy("hash").agg(F.expr("min(own) < max(own) AS apart")).where("apart").select("hash")
    rooted = rooted.join(mixed, "hash").join(sets.select("node", "n", "sketch"), "node")
    # Chunk c is the first of the tiles (c, j) with j >= c and the second of those (i, c) with i < c.
    placed = rooted.selectExpr("*", f"CAST(at DIV {TILE} AS int) AS c").selectExpr(
        "hash", "node", "own", "n", "sketch", "c", "explode(sequence(0, chunks - 1)) AS other"
    )
    tiles = placed.selectExpr(
        "hash", "least(c, other) AS i", "greatest(c, other) AS j", "c > other AS second", "node", "own", "n", "sketch"
    )

    def compare(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        second, node, own, n = (np.array(c) for c in list(zip(*rows, strict=True))[:4])
        sketches = [r[4] for r in rows]
        lengths = np.array([len(s) for s in sketches])
        cross = second.any()
        for size in np.unique(lengths):
            # Similar sets have sketches of the same size, or of neighbouring sizes.
            left = np.flatnonzero(lengths == size)
            x = np.frombuffer(b"".join(sketches[i] for i in left), np.uint8).reshape(len(left), -1)
            for wide in (size, 2 * size):
                right = np.flatnonzero(lengths == wide)
                if not len(right):
                    continue
                y = np.frombuffer(b"".join(sketches[i] for i in right), np.uint8).reshape(len(right), -1)
                y = folded(y, int(size))
                step = max(1, STEP_BYTES // (len(right) * int(size)))
                for at in range(0, len(left), step):
                    i, j = left[at : at + step, None], right[None, :]
                    ok = (own[i] != own[j]) & (PERCENT * np.maximum(n[i], n[j]) <= 100 * np.minimum(n[i], n[j]))
                    ok &= (second[i] != second[j]) if cross else (i < j if wide == size else True)
                    if cross and wide == size:
                        ok &= i < j
                    if not ok.any():
                        continue
                    far = np.bitwise_count(x[at : at + step, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)
                    r, c = np.nonzero(ok & (far <= difference(n[i], n[j])))
                    a, b = node[left[at + r]], node[right[c]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        told: set[tuple[int, int]] = set()  # pairs meet in several groups

        def new(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for found in compare(rows):
                if len(told) >= TOLD:
                    told.clear()
                pairs = set(zip(found.column("a").to_pylist(), found.column("b").to_pylist(), strict=True)) - told
                told.update(pairs)
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in pairs], schema=found.schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if rows:
                        yield from new(rows)
                    key, rows = row[:3], []
                rows.append(row[3:])
        if rows:
            yield from new(rows)

    dealt = tiles.repartition(common.shuffle_partitions(spark), "hash", "i", "j").sortWithinPartitions("hash", "i", "j")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def clusters(documents: DataFrame) -> DataFrame:
    """doc_id, n (size of its set), node (of its set) and root (its component's smallest node) of each row."""
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    stored, path = _prints(documents)
    prints = stored.where("part IS NULL").select("doc_id", "h", "node", "n", "digest", "sketch", "base")
    sets = prints.where("digest IS NOT NULL")

    equal, equal_path = _equal(sets)
    met, met_path = common.stored(_meetings(_of_first(stored.where("part IS NOT NULL"), equal)), "meetings")

    pairs, pairs_path = common.stored(_likely(_stars(met), sets), "likely")
    links, _ = common.stored(_verified(documents, prints, pairs).unionByName(equal.select("a", "b")), "links")
    roots = components(links)
    more, more_path = common.stored(
        _apart(met.where("size(nodes) > 2"), roots, sets), "likely"
    )
    found = _verified(documents, prints, more)
    roots = components(links.unionByName(found))
    named = prints.join(roots, "node", "left").selectExpr("doc_id", "n", "node", "coalesce(root, node) AS root")
    out, _ = common.stored(named, "named")
    common.discard(spark, path, equal_path, met_path, pairs_path, more_path)
    return out


def linked(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row."""
    named = clusters(documents)
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.expr("count(1) AS n_rows"))
    least, _ = common.stored(least, "least")
    # Rows of large components are joined where they lie.
    hot = heaviest(least, ["root"], LARGE, "n_rows")
    joined = join_unique(named, least.drop("n_rows"), ["root"], "inner", hot)
    return joined.selectExpr("doc_id", "n AS n_shingles", "component_id")
