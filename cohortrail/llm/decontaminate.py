"""Benchmark decontamination by pigeonhole edit matching.

Items and documents are compared as lower-case letters and digits, all else one space. An item of m characters may be
found with k = floor(RATE * m) edits. It is cut into k + 1 pieces: a passage within k edits of the item holds at least
one piece unchanged. All pieces are searched at once (Aho-Corasick); where one is found, the window it implies is
verified by Myers' bit-parallel edit distance. The same argument holds for each half of the pieces, a quarter and so
on: some piece found unchanged lies in a pair of pieces with 1 edit at most, the pair in four with 3 at most, and so
on up to the item. So short parts are verified first, and chance finds seldom get further.

The benchmark is the stated query set: it is searched in blocks of at most BLOCK_CHARACTERS characters, each block
broadcast and met by all documents, so that what is sent is bounded however long the benchmark is.

Null or empty text: no match. Items without letters or digits, or null: match nothing. Items shorter than
MIN_CHARACTERS, which any text might hold: only if found at word bounds. Repeated items: each is reported. Repeated documents: each has its rows. Very long texts: whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.llm import common

RATE = 0.08
MIN_CHARACTERS = 40
BLOCK_CHARACTERS = 4_000_000


def normal(column: str) -> str:
    return f"trim(regexp_replace(lower(`{column}`), '[^\\\\p{{L}}\\\\p{{N}}]+', ' '))"


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def budget_of(item: str, rate: float = RATE) -> int:
    return int(len(item) * rate)


class Myers:
    """Least edit distance between a pattern and any substring that ends at each place of a text."""

    def __init__(self, pattern: str):
        self.m = len(pattern)
        self.peq: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.peq[c] = self.peq.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """The smallest distance and the first place after such a substring."""
        mask, top = (1 << self.m) - 1, 1 << self.m - 1
        vp, vn, score, best, end = mask, 0, self.m, self.m, 0
        get = self.peq.get
        for at, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | vn
            xh = ((eq & vp) + vp ^ vp) | eq
            hp = vn | ~(xh | vp) & mask
            hn = vp & xh
            if hp & top:
                score += 1
            elif hn & top:
                score -= 1
                if score < best:
                    best, end = score, at
            hp <<= 1
            vp = (hn << 1 | ~(xv | hp)) & mask
            vn = hp & xv & mask
        return best, end


class Matcher:
    """Finds a block of items in normalised texts."""

    def __init__(self, items: list[tuple[object, str]], rate: float = RATE):
        import ahocorasick

        self.items = [(key, text, budget_of(text, rate)) for key, text in items]
        self.myers: dict[str, Myers] = {}
        places: dict[str, list[tuple[int, int, list]]] = {}
        for nr, (_, text, budget) in enumerate(self.items):
            cut = pieces(text, budget)
            for i, (at, piece) in enumerate(cut):
                places.setdefault(piece, []).append((nr, at, self._path(text, cut, i)))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()

    @staticmethod
    def _path(item: str, cut: list[tuple[int, str]], i: int) -> list[tuple[int, str, int]]:
        """From the pair that holds piece i up to the half: place in the item, part, edits it may have."""
        low, high, path = 0, len(cut), []
        while high - low > 2:
            middle = (low + high) // 2
            low, high = (low, middle) if i < middle else (middle, high)
            end = cut[high][0] if high < len(cut) else len(item)
            path.append((cut[low][0], item[cut[low][0] : end], high - low - 1))
        return [p for p in reversed(path) if p[2]]

    def _distance(self, part: str, window: str) -> tuple[int, int]:
        if part not in self.myers:
            self.myers[part] = Myers(part)
        return self.myers[part].best(window)

    def find(self, text: str) -> list[tuple[object, int, int, int]]:
        """Item, first and next place in `text`, distance: the best match in each window."""
        windows: dict[int, list[list[int]]] = {}
        for last, (length, places) in self.automaton.iter(text):
            start = last - length + 1
            for nr, at, path in places:
                _, item, budget = self.items[nr]
                zero = start - at  # where the item would start without edits before the piece
                old = windows.get(nr)
                if old and zero - budget >= old[-1][0] and zero + len(item) + budget <= old[-1][1]:
                    continue  # inside a window that is to be verified anyway
                for place, part, edits in path:
                    low = max(0, zero + place - edits)
                    window = text[low : zero + place + len(part) + edits]
                    if part not in window and self._distance(part, window)[0] > edits:
                        break
                else:
                    low, high = zero - 2 * budget, zero + len(item) + 2 * budget
                    if old and low <= old[-1][1] - len(item):
                        # A later find may imply an earlier start, as with phrases that an item repeats.
                        old[-1] = [min(old[-1][0], low), max(old[-1][1], high)]
                    else:
                        windows.setdefault(nr, []).append([low, high])
        found = []
        for nr, spans in windows.items():
            key, item, budget = self.items[nr]
            for low, high in spans:
                low = max(0, low)
                hit = self._verify(item, budget, text[low:high])
                if hit and (len(item) >= MIN_CHARACTERS or self._whole_words(text, low + hit[0], low + hit[1])):
                    found.append((key, low + hit[0], low + hit[1], hit[2]))
        return found

    def _verify(self, item: str, budget: int, window: str) -> tuple[int, int, int] | None:
        at = window.find(item)
        if at >= 0:
            return at, at + len(item), 0
        if not budget:
            return None
        distance, end = self._distance(item, window)
        if distance > budget:
            return None
        # The same distance, read backwards from the end, gives the start.
        _, length = self._distance(item[::-1], window[:end][::-1])
        return end - length, end, distance

    @staticmethod
    def _whole_words(text: str, start: int, end: int) -> bool:
        return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """Items in normal form, in blocks; the driver holds one block at a time."""
    block, size = [], 0
    items = benchmark.selectExpr("item_id", f"{normal('text')} AS text").where("text <> ''")
    for row in items.orderBy("item_id", "text").toLocalIterator():
        text = row.text
        if size + len(text) > BLOCK_CHARACTERS and block:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    if block:
        yield block


def matches(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """A row for each passage found: doc_id, h (hash of id and text), item_id, start, end, distance.

    start and end are places in the normalised text.
    """
    spark = documents.sparkSession
    rows = documents.selectExpr("doc_id", "xxhash64(doc_id, text) AS h", f"{normal('text')} AS text")
    kind = benchmark.schema["item_id"].dataType
    schema = rows.drop("text").schema
    for field in spark.createDataFrame([], "start int, end int, distance int").schema:
        schema = schema.add(field)
    schema = schema.add("item_id", kind)
    out = None
    for block in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, rate)
            for batch in batches:
                at, found = [], []
                for i, text in enumerate(batch.column("text")):
                    if text.is_valid:
                        hits = matcher.find(text.as_py())
                        found += hits
                        at += [i] * len(hits)
                if found:
                    taken = batch.select(["doc_id", "h"]).take(pa.array(at))
                    items, starts, ends, distances = zip(*found, strict=True)
                    arrays = [pa.array(x, pa.int32()) for x in (starts, ends, distances)]
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, *arrays, pa.array(items)],
                        ["doc_id", "h", "start", "end", "distance", "item_id"],
                    )

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_at, end_at and distance of each benchmark passage that a document holds."""
    found = matches(documents, benchmark)
    return found.selectExpr("doc_id", "item_id", "start AS start_at", "end AS end_at", "distance")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `documents` that hold no benchmark passage."""
    key = common.fresh(documents, "h")
    found = matches(documents, benchmark).select(F.col("h").alias(key)).distinct()
    hashed = documents.withColumn(key, F.expr("xxhash64(doc_id, text)"))
    return hashed.join(found, key, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
