"""How far the sources of a language differ in their words, from counts by single-pass in-memory indexing.

Each task reads its documents once and posts terms to a block in memory: per language and source, occurrences and
holding documents of each term. A block of BLOCK postings is spilled as a run: terms in order with their postings, cut by
the hash of the term into shards and into chunks of CHUNK terms. Runs of a shard meet in one task and are merged with
a heap. Chunks come sorted by their first term, so a term leaves the heap once it lies before the first term of the
next chunk, and a task holds the chunks that overlap at one term, not the shard. Beyond FAN_IN runs, groups of runs are
merged to longer runs first. A posting per run and group is all that a frequent term costs.

The merge gives each kept term of a language its counts by source. A term's rate in a group is smoothed, so that every
group has a rate for every term, and the divergence of two sources is a sum over all kept terms. Most of them are
absent from most sources: the sum starts as if all were absent from both, and kept terms stream by with corrections, for
a term that one source has and for one that both have. No table of all terms by all pairs is made.

Null text, lang and source are ''. A group without terms has rates too. A language without kept terms: value 0 between
its sources, no terms. A language of one source has no pairs. Empty and null texts: no terms. Very long texts are read
in steps, and of one document the distinct terms are held. Repeated rows: each is a document. Ties are ranked by item.
Empty table: no rows. Further columns play no part, whatever their names.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common

HOLDERS = 10  # documents of a language that must hold a kept term
TOP = 10  # ranks of terms
UNIT = 1_000_000_000
BLOCK = 500_000  # postings that a task holds before it spills
CHUNK = 512  # terms
GATHERED = 4096  # terms whose postings are added up at a time
FAN_IN = 1_000
STEP_BYTES = 4 << 20
MAX_GROUPS = 200_000  # groups whose totals are sent to tasks at a time
MAX_CELLS = 4 << 20  # pairs of sources whose sums a task holds; beyond, it passes them on after each batch

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_OTHER = re.compile(rb"[^A-Za-z\x80-\xff]")

RUN = (
    "run bigint, shard bigint, first binary, terms binary, langs array<string>, sources array<string>,"
    " ends binary, groups binary, counts binary, holders binary"
)
_RUN_NAMES = ["run", "shard", "first", "terms", "langs", "sources", "ends", "groups", "counts", "holders"]


def steps(text: bytes) -> Iterator[bytes]:
    """The text in pieces that cut no term."""
    at = 0
    while at < len(text):
        end = at + STEP_BYTES
        if end < len(text):
            found = _OTHER.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end]
        at = end


class Postings(NamedTuple):
    """Terms in order, and of each the groups that have it: those of term i end at ends[i]."""

    terms: list[bytes]
    ends: np.ndarray
    groups: np.ndarray  # places in a list of groups
    counts: np.ndarray
    holders: np.ndarray

    def chunks(self, run: int, shard: int, names: list[tuple[str, str]]) -> Iterator[tuple]:
        """The rows of a run."""
        langs, sources = zip(*names, strict=True)
        for at in range(0, len(self.terms), CHUNK):
            terms, ends = self.terms[at : at + CHUNK], self.ends[at : at + CHUNK]
            low, high = int(self.ends[at - 1]) if at else 0, int(ends[-1])
            numbers = [(ends - low).astype("<i4"), self.groups[low:high].astype("<u4")]
            numbers += [self.counts[low:high].astype("<i8"), self.holders[low:high].astype("<i8")]
            # No term holds the byte 0.
            yield (run, shard, terms[0], b"\0".join(terms), langs, sources, *(x.tobytes() for x in numbers))


class Block:
    """Postings of some documents: per language and source, occurrences and holding documents of each term."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: str | None) -> None:
        counts, holders = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before, held = len(counts), set()
        for piece in steps((text or "").encode().lower()):  # of bytes, only A-Z are lower-cased
            terms = _TERM.findall(piece)
            counts.update(terms)
            held.update(terms)
        holders.update(held)
        self.size += len(counts) - before

    def spill(self, run: int, shards: int) -> Iterator[pa.RecordBatch]:
        """The run: terms by shard and in order."""
        if not self.size:
            return
        terms = sorted(set().union(*(c for c, _ in self.groups.values())))
        shard = np.fromiter((zlib.crc32(t) % shards for t in terms), np.int64, len(terms))
        order = np.argsort(shard, kind="stable")
        place = dict(zip((terms[i] for i in order.tolist()), range(len(terms)), strict=True))
        columns = []
        for g, (counts, holders) in enumerate(self.groups.values()):
            n = len(counts)
            own = [map(place.__getitem__, counts), counts.values(), map(holders.__getitem__, counts)]
            columns.append([np.full(n, g), *(np.fromiter(x, np.int64, n) for x in own)])
        group, at, n, h = (np.concatenate(c) for c in zip(*columns, strict=True))
        by_term = np.argsort(at, kind="stable")
        group, at, n, h = group[by_term], at[by_term], n[by_term], h[by_term]
        ends = np.searchsorted(at, np.arange(len(terms)), side="right")
        del place, columns, by_term, at
        cuts = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
        names, rows = list(self.groups), []
        for s in range(shards):
            i, j = cuts[s : s + 2]
            if i < j:
                low, high = int(ends[i - 1]) if i else 0, int(ends[j - 1])
                own = [terms[k] for k in order[i:j].tolist()]
                part = Postings(own, ends[i:j] - low, group[low:high], n[low:high], h[low:high])
                rows.extend(part.chunks(run, s, names))
            if len(rows) >= 64:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    number, data, names = pa.int64(), pa.binary(), pa.list_(pa.string())
    kinds = [number, number, data, data, names, names, data, data, data, data]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, _RUN_NAMES)


def runs(documents: DataFrame) -> DataFrame:
    """The spilled runs of all tasks."""
    shards = common.shuffle_partitions(documents.sparkSession)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                block.add(lang.as_py(), source.as_py(), text.as_py())
                if block.size >= BLOCK:
                    yield from block.spill(run, shards)
                    run, block = run + 1, Block()
        yield from block.spill(run, shards)
        del block
        common.give_back()

    return documents.selectExpr("coalesce(lang, '') AS lang", "coalesce(source, '') AS source", "text").mapInArrow(index, RUN)


class Merge:
    """Runs merged with a heap. Chunks come sorted by shard and first term, those of any number of runs."""

    def __init__(self):
        self.places: dict[tuple[str, str], int] = {}  # groups of all runs
        self.heap: list[tuple] = []  # the next term of each chunk that was begun
        self.terms: list[bytes] = []
        self.parts: list[tuple] = []  # of each term: its place, and what one chunk has of it
        self.begun = 0

    def push(self, row: dict) -> None:
        names = zip(row["langs"], row["sources"], strict=True)
        own = np.array([self.places.setdefault(name, len(self.places)) for name in names], np.int64)
        groups = own[np.frombuffer(row["groups"], "<u4")]
        counts, holders = (np.frombuffer(row[c], "<i8") for c in ("counts", "holders"))
        chunk = row["terms"].split(b"\0"), [0, *np.frombuffer(row["ends"], "<i4").tolist()], groups, counts, holders
        self.begun += 1
        heapq.heappush(self.heap, (chunk[0][0], self.begun, 0, chunk))

    def pop(self, until: bytes | None) -> Iterator[Postings]:
        """Terms before `until`, some thousands at a time; None: all there are."""
        heap, terms, parts = self.heap, self.terms, self.parts
        while heap and (until is None or heap[0][0] < until):
            term, number, at, chunk = heap[0]
            if not terms or terms[-1] != term:
                if len(terms) >= GATHERED:
                    yield self._gathered()
                terms.append(term)
            ends = chunk[1]
            parts.append((len(terms) - 1, chunk, ends[at], ends[at + 1]))
            if at + 1 < len(chunk[0]):
                heapq.heapreplace(heap, (chunk[0][at + 1], number, at + 1, chunk))
            else:
                heapq.heappop(heap)
        if until is None and terms:
            yield self._gathered()

    def _gathered(self) -> Postings:
        """What the chunks have of the terms popped so far, added up by term and group."""
        sizes = np.array([j - i for *_, i, j in self.parts])
        term = np.repeat(np.array([t for t, *_ in self.parts]), sizes)
        group, n, h = (np.concatenate([c[k][i:j] for _, c, i, j in self.parts]) for k in (2, 3, 4))
        order = np.lexsort((group, term))
        term, group, n, h = term[order], group[order], n[order], h[order]
        first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (group[1:] != group[:-1]))))
        terms = list(self.terms)
        ends = np.searchsorted(term[first], np.arange(len(terms)), side="right")
        self.terms.clear()
        self.parts.clear()
        return Postings(terms, ends, group[first], np.add.reduceat(n, first), np.add.reduceat(h, first))


def merging(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Postings, list[tuple[str, str]]]]:
    """(shard, postings, names of the groups), each term of a shard once."""
    merge, shard = Merge(), None
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i].as_py() for k, name in enumerate(names)}
            for found in merge.pop(row["first"] if row["shard"] == shard else None):
                yield shard, found, list(merge.places)
            shard = row["shard"]
            merge.push(row)
    for found in merge.pop(None):
        yield shard, found, list(merge.places)


def merged(runs: DataFrame) -> DataFrame:
    """Fewer, longer runs: about FAN_IN of them become one."""
    shards = common.shuffle_partitions(runs.sparkSession)
    parts = runs.select("run").distinct().count() // FAN_IN + 1

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, found, names in merging(batches):
            part, shard = divmod(place, shards)
            yield _batch(list(found.chunks(part, shard, names)))

    # A part of the runs and a shard make one place, in which runs are merged.
    place = runs.withColumn("shard", F.expr(f"pmod(xxhash64(run), {parts}) * {shards} + shard"))
    return place.repartition(shards, "shard").sortWithinPartitions("shard", "first").mapInArrow(merge, RUN)


def frequencies(documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """lang, term, sources and counts of each kept term, written; and the folders that were made."""
    spark = documents.sparkSession
    shards = common.shuffle_partitions(spark)
    spilled, path = common.stored(runs(documents), "runs")
    made = [path]
    while spilled.select("run").distinct().count() > FAN_IN:
        spilled, path = common.stored(merged(spilled), "runs")
        made.append(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found, names in merging(batches):
            kept = _kept(found, names)
            if kept.num_rows:
                yield kept
        common.give_back()

    dealt = spilled.repartitionById(shards, F.expr("CAST(shard AS int)")).sortWithinPartitions("shard", "first")
    found = dealt.mapInArrow(count, "lang string, term string, sources array<string>, counts array<bigint>")
    kept, path = common.stored(found, "frequencies")
    return kept, [*made, path]


def _kept(found: Postings, names: list[tuple[str, str]]) -> pa.RecordBatch:
    """A row for each term and language with enough holders, its sources in order."""
    langs = sorted({lang for lang, _ in names})
    lang_of = np.searchsorted(np.array(langs, object), np.array([lang for lang, _ in names], object))
    in_order = np.empty(len(names), np.int64)
    in_order[sorted(range(len(names)), key=lambda g: names[g][1])] = np.arange(len(names))
    sizes = np.diff(found.ends, prepend=0)
    term, lang = np.repeat(np.arange(len(found.terms)), sizes), lang_of[found.groups]
    order = np.lexsort((in_order[found.groups], lang, term))
    term, lang, group, n = term[order], lang[order], found.groups[order], found.counts[order]
    first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (lang[1:] != lang[:-1]))))
    enough = np.add.reduceat(found.holders[order], first) >= HOLDERS
    size = np.diff(np.append(first, len(term)))
    own, first, size = np.repeat(enough, size), first[enough], size[enough]
    ends = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
    sources = pa.array([s for _, s in names], pa.string()).take(pa.array(group[own]))
    columns = [
        pa.array(langs, pa.string()).take(pa.array(lang[first])),
        pa.array([found.terms[i].decode() for i in term[first].tolist()], pa.string()),
        pa.ListArray.from_arrays(ends, sources),
        pa.ListArray.from_arrays(ends, pa.array(n[own])),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "term", "sources", "counts"])


def totals(documents: DataFrame, kept: DataFrame) -> tuple[DataFrame, str]:
    """lang, source, n (occurrences of kept terms), v (kept terms of the language) and all_n of each group, written."""
    each = kept.selectExpr("lang", "inline(arrays_zip(sources, counts))")
    own = each.groupBy("lang", "sources").agg(F.sum("counts").alias("n")).withColumnRenamed("sources", "source")
    whole = kept.groupBy("lang").agg(
        F.expr("count(1) AS v"), F.expr("sum(aggregate(counts, 0L, (a, x) -> a + x)) AS all_n")
    )
    groups = documents.selectExpr("coalesce(lang, '') AS lang", "coalesce(source, '') AS source").distinct()
    joined = groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left")
    return common.stored(
        joined.selectExpr(
            "lang", "source", "coalesce(n, 0L) AS n", "coalesce(v, 0L) AS v", "coalesce(all_n, 0L) AS all_n"
        ),
        "groups",
    )


def rate(count: str, n: str, v: str) -> str:
    """The smoothed rate in UNIT parts, exact; null where the language keeps no term."""
    return f"CASE WHEN {v} > 0 THEN 1 + ({UNIT} * CAST({count} + 2 AS decimal(38, 0))) div ({n} + 2 * {v}) END"


def gap(p: str, q: str) -> str:
    return f"((({p} - {q}) * ({p} - {q})) div ({p} + {q}))"


def rates(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """As `rate`, by long division in steps of a thousand, which fit 64 bits."""
    left, out = counts + 2, np.zeros(np.broadcast(counts, totals).shape, np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // totals
        left = left % totals
    return out + 1


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Language:
    """Sums of corrections over the pairs of a language's sources."""

    def __init__(self, sources: list[str], n: list[int], v: int):
        self.sources, self.place = sources, {s: i for i, s in enumerate(sources)}
        self.totals = np.array(n, np.int64) + 2 * v
        self.absent = rates(np.zeros(len(n), np.int64), self.totals)
        self.sums = np.zeros((len(n), len(n)), np.int64)

    def add(self, sources: list[list[str]], counts: list[list[int]]) -> None:
        """The corrections of some terms."""
        place = np.array([self.place[s] for own in sources for s in own], np.int64)
        ends = np.cumsum([len(own) for own in sources])
        starts = np.concatenate(([0], ends[:-1]))
        term = np.repeat(np.arange(len(sources)), ends - starts)
        p = rates(np.array([n for own in counts for n in own], np.int64), self.totals[place])
        none = self.absent
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(len(self.sources) + 1))
        for a in range(len(self.sources)):
            own = order[cuts[a] : cuts[a + 1]]
            if not len(own):
                continue
            # Terms of `a`, as if no other source had them.
            values, times = np.unique(p[own], return_counts=True)
            base = _gap(none[a], none)
            step = max(1, MAX_CELLS // len(none))
            for at in range(0, len(values), step):
                part = _gap(values[at : at + step, None], none)
                self.sums[a] += ((part - base) * times[at : at + step, None]).sum(axis=0)
            # Terms of `a` that later sources have too. A term's sources are sorted, as the places are.
            ends_here = ends[term[own]]
            lengths = ends_here - own - 1
            mine = np.repeat(own, lengths)
            theirs = np.arange(len(mine)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + mine + 1
            b = place[theirs]
            both = _gap(p[mine], p[theirs]) - _gap(p[mine], none[b]) - _gap(none[a], p[theirs]) + base[b]
            np.add.at(self.sums[a], b, both)
        np.fill_diagonal(self.sums, 0)

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        """The sums of unordered pairs, the smaller source first, and none kept behind."""
        sums = np.triu(self.sums + self.sums.T)
        for a in np.flatnonzero(sums.any(axis=1)).tolist():
            b = np.flatnonzero(sums[a])
            columns = [
                pa.array([lang] * len(b), pa.string()),
                pa.array([self.sources[a]] * len(b), pa.string()),
                pa.array([self.sources[i] for i in b], pa.string()),
                pa.array(sums[a][b]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])
        self.sums[:] = 0


def corrections(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b and value for pairs of sources a < b: what kept terms add to the sum for terms that both lack.

    Totals of the groups are sent to tasks in blocks of whole languages of at most MAX_GROUPS groups; only a language
    of more sources is a larger block, and its result has the square of them.
    """
    spark, out = kept.sparkSession, None
    sizes = groups.groupBy("lang").agg(F.expr("count(1) AS n")).orderBy("lang").collect()  # a row per language
    blocks: list[list[str]] = [[]]
    held = 0
    for lang, n in sizes:
        if held + n > MAX_GROUPS and blocks[-1]:
            blocks.append([])
            held = 0
        blocks[-1].append(lang)
        held += n
    for block in blocks:
        inside = F.lit(True) if len(blocks) == 1 else F.col("lang").isin(block)
        known: dict[str, list] = {}
        for lang, source, n, v in groups.where(inside).select("lang", "source", "n", "v").collect():
            known.setdefault(lang, []).append((source, n, v))
        sent = spark.sparkContext.broadcast({k: sorted(x) for k, x in known.items()})

        def stream(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            langs: dict[str, Language] = {}
            for batch in batches:
                own: dict[str, tuple[list, list]] = {}
                for lang, sources, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    pair = own.setdefault(lang, ([], []))
                    pair[0].append(sources)
                    pair[1].append(counts)
                for lang, (sources, counts) in own.items():
                    if lang not in langs:
                        names, n, v = zip(*sent.value[lang], strict=True)
                        langs[lang] = Language(list(names), list(n), v[0])
                    langs[lang].add(sources, counts)
                if sum(x.sums.size for x in langs.values()) > MAX_CELLS:
                    for lang, x in langs.items():
                        yield from x.rows(lang)
                    langs = {}
            for lang, x in langs.items():
                yield from x.rows(lang)

        found = kept.where(inside).select("lang", "sources", "counts")
        found = found.mapInArrow(stream, "lang string, a string, b string, value bigint")
        out = found if out is None else out.unionByName(found)
    return out.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _ranked(values: DataFrame, part: str, top: int | None = None) -> DataFrame:
    over = "OVER (PARTITION BY lang, source ORDER BY value DESC, item)"
    ranked = values.selectExpr("lang", "source", f"'{part}' AS part", "item", "value", f"row_number() {over} AS rank")
    return ranked if top is None else ranked.where(f"rank <= {top}")


def audit(documents: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank: `pair` for the other sources of the language, `term` for the terms
    that set the source apart from its language."""
    spark = documents.sparkSession
    kept, made = frequencies(documents)
    groups, path = totals(documents, kept)
    few = groups.count() <= MAX_GROUPS
    sent = F.broadcast(groups) if few else groups

    each = kept.selectExpr(
        "lang", "term AS item", "aggregate(counts, 0L, (a, x) -> a + x) AS all_count", "inline(arrays_zip(sources, counts))"
    ).withColumnRenamed("sources", "source")
    scored = each.join(sent, ["lang", "source"]).selectExpr(
        "lang", "source", "item", f"{rate('counts', 'n', 'v')} AS p", f"{rate('all_count', 'all_n', 'v')} AS q"
    )
    terms = scored.where("p > q").selectExpr("lang", "source", "item", f"{gap('p', 'q')} AS value")

    rated = groups.selectExpr("lang", "source", "v", f"{rate('0', 'n', 'v')} AS p")
    left, right = (rated.selectExpr("lang", f"source AS {c}", "v", f"p AS p_{c}") for c in "ab")
    right = right.drop("v")
    # The result has a row for each pair; few groups are sent to where their partners lie, so that no language is a task.
    pairs = left.join(F.broadcast(right) if few else right, "lang").where("a < b")
    pairs = pairs.join(corrections(kept, groups), ["lang", "a", "b"], "left").selectExpr(
        "lang", "a", "b", f"CASE WHEN v > 0 THEN v * {gap('p_a', 'p_b')} + coalesce(value, 0L) ELSE 0L END AS value"
    )
    both = pairs.selectExpr(
        "lang", "inline(array(struct(a AS source, b AS item), struct(b AS source, a AS item)))", "value"
    )
    found, _ = common.stored(_ranked(both, "pair").unionByName(_ranked(terms, "term", TOP)), "divergence")
    common.discard(spark, *made, path)
    return found
