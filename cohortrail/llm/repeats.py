"""Repeated passages by suffix arrays: every byte of a LENGTH-byte string that also starts in an earlier document.

1. Each window of LENGTH bytes belongs to its minimizer, the 8-byte string in it of the smallest hash. Windows in a row
   that have the same minimizer form a fragment; so every window lies in one fragment, and equal windows of any
   documents in fragments of equal minimizers. Fragments are dealt to tasks by the minimizer.
2. Before the shuffle, equal fragments of a batch are reduced to those of the first document; the others are removed
   windows already. So a passage that very many documents share reaches a task once per batch.
3. A task works on its fragments in steps, by their minimizers. A step of more than STEP_WINDOWS windows, as a frequent
   minimizer makes it, is cut again, by the least string of 24 bytes in a window, and where that is frequent too by the
   window itself. So no step grows with the table.
4. In a step, equal fragments are taken once, and those are left out of which neither side next to the minimizer is
   shared between documents; of the rest, suffixes whose first LENGTH bytes are those of no other document. Enhanced
   suffix arrays of what is left (order of the suffixes, common prefixes of neighbours; suffixes that begin with the same
   LENGTH bytes in the same one) are scanned with a stack: each interval of suffixes with a common prefix of LENGTH bytes
   or more, whose left neighbours differ or are unknown, is a maximal repeat with all its occurrences. An occurrence in
   another document than the first of its group is removed.
5. Removed stretches meet their texts, which travel in compressed batches, in the task of their document.

Null doc_id: comes after all others. Rows of the same doc_id never remove anything of each other. Null text: empty.
Texts shorter than LENGTH bytes keep everything. Repeated rows: each has its row. Very long texts: whole, in memory
one at a time.
"""

from __future__ import annotations

import itertools
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from cohortrail.llm import common

LENGTH = 50
ANCHOR = 8
WINDOWS = LENGTH - ANCHOR + 1  # anchors of a window
SIDE = (WINDOWS - 1) // 2  # one side of the anchor has so many bytes of a window at least
MOST = WINDOWS  # windows of a fragment
# Bytes of the strings that windows are dealt by: the minimizers, and those that steps of too many windows are cut by.
ANCHORS = (ANCHOR, 24, LENGTH)
STEPS = 16  # steps in which a task works on its share
FINER_STEPS = 64  # of a step that is cut again
STEP_WINDOWS = 1 << 21
NONE = (1 << 63) - 1  # stands for a null doc_id
BATCH_BYTES = 12 << 20
STEP_BYTES = 1 << 20
# Suffixes that one array holds; those that begin with the same LENGTH bytes stay together.
ARRAY_SUFFIXES = 1 << 19
HELD_SPANS = 1 << 21
PILED_BYTES = 2 << 20  # of blobs that are dealt to steps together
HELD_BYTES = 64 << 20  # of a task's compressed fragments; more lie in a temporary file
SENT_BYTES = 4 << 20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64(63)
_EMPTY = np.zeros(0, np.int64)


def _words(data: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """8 bytes from each place, or from the places `at`, as a little-endian number."""
    every = np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))
    return every.copy() if at is None else every[at]


def _mix(x: np.ndarray) -> np.ndarray:
    """Different numbers stay different."""
    x = x * _M1
    x ^= x >> np.uint64(32)
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def _hashes(data: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """A hash of `size` bytes from each place, or from the places `at`; different 8 bytes have different ones."""
    words = _words(data) if at is None else None
    n = len(data) - size + 1
    out = None
    for k in (*range(0, size - 8, 8), size - 8):
        word = words[k : k + n] if at is None else _words(data, at + k)
        out = _mix(word if out is None else out + word)
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, x
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def fragments(data: np.ndarray, ends: np.ndarray, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length, and place of the minimizer, `anchor` bytes long, of all fragments of texts laid end to end in `data`.

    Windows that cross the end of a text belong to none.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return _EMPTY, _EMPTY, _EMPTY
    out = []
    # In steps, since each byte takes many while its windows are worked out.
    for at in range(0, n, STEP_BYTES):
        out.append(_fragments(data[at : at + STEP_BYTES + LENGTH - 1], ends - at, at, anchor))
    starts, lengths, where = (np.concatenate(x) for x in zip(*out, strict=True))
    return starts, lengths, where


def _fragments(
    data: np.ndarray, ends: np.ndarray, base: int, anchor: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) - LENGTH + 1
    # The last bits of a hash give way to the place, which so comes with the minimum.
    places = np.arange(len(data) - anchor + 1, dtype=np.uint64) & _PLACE
    low = _sliding_min(_hashes(data, anchor) & ~_PLACE | places, LENGTH - anchor + 1)
    inside = np.ones(n, bool)
    for end in ends[(ends > 0) & (ends < len(data))].tolist():
        inside[max(0, end - LENGTH + 1) : end] = False
    same = (low[1:] == low[:-1]) & inside[1:] & inside[:-1]
    starts = np.flatnonzero(np.concatenate(([True], ~same)) & inside)
    stops = np.flatnonzero(np.concatenate((~same, [True])) & inside) + 1
    where = starts + ((low[starts] & _PLACE).astype(np.int64) - starts & int(_PLACE))
    return starts + base, stops - starts + LENGTH - 1, where + base


def _runs(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches that have some STEP_BYTES together, as ranges."""
    total = np.cumsum(lengths)
    cuts = np.searchsorted(total, np.arange(STEP_BYTES, int(total[-1]), STEP_BYTES)) if len(total) else []
    return itertools.pairwise(np.unique([0, *cuts, len(lengths)]).tolist())


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of `data`, none of them empty, end to end."""
    out = [data[:0]]
    for a, b in _runs(lengths):
        steps = np.ones(int(lengths[a:b].sum()), np.int64)
        steps[0] = starts[a]
        steps[np.cumsum(lengths[a:b])[:-1]] = starts[a + 1 : b] - (starts[a : b - 1] + lengths[a : b - 1] - 1)
        out.append(data[np.cumsum(steps)])
    return np.concatenate(out) if len(out) > 2 else out[-1]


def _padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate((data, np.zeros(MOST + LENGTH + 16, np.uint8)))


def equal_stretches(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number per stretch of at most MOST + LENGTH - 1 bytes; equal stretches have equal numbers, and only those."""
    padded = _padded(data)
    hashes = _mix(lengths.astype(np.uint64) + _M2)
    words, whole = [], int(lengths.min(initial=0)) - 8
    for k in range(0, int(lengths.max(initial=0)), 8):
        word = _words(padded, starts + k)
        if k > whole:
            spare = np.clip(8 - (lengths - k), 0, 8)
            shift = (np.minimum(spare, 7) * 8).astype(np.uint64)
            word = np.where(spare == 8, np.uint64(0), word << shift >> shift)
        words.append(word)
        hashes = _mix(hashes ^ word) + _M1
    order = np.argsort(hashes)
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    # Equal hashes of different bytes would be told apart here.
    for column in (lengths, *words):
        new[1:] |= column[order[1:]] != column[order[:-1]]
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return numbers


def _suffixes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretch and offset of the suffixes of LENGTH bytes or more."""
    counts = lengths - LENGTH + 1
    stretch = np.repeat(np.arange(len(lengths)), counts)
    return stretch, np.arange(len(stretch)) - np.repeat(np.cumsum(counts) - counts, counts)


def suffix_array(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, kept: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """Of the suffixes of LENGTH bytes or more of the stretches, or of those `kept`, in order: stretch, offset in it, and
    the common prefix with the suffix before (0 for the first)."""
    stretch, offset = _suffixes(lengths)
    if kept is not None:
        stretch, offset = stretch[kept], offset[kept]
    places, sizes = starts[stretch] + offset, lengths[stretch] - offset
    padded = _padded(data)
    # Big-endian words compare as their bytes do. Bytes behind the end of a suffix are cleared; ties go by size.
    columns, whole = [], int(sizes.min(initial=0)) - 8
    for k in range(0, int(sizes.max(initial=0)), 8):
        word = _words(padded, places + k).byteswap()
        if k > whole:
            spare = np.clip(8 - (sizes - k), 0, 8)
            shift = (np.minimum(spare, 7) * 8).astype(np.uint64)
            word = np.where(spare == 8, np.uint64(0), word >> shift << shift)
        columns.append(word)
    order = np.argsort(columns[0]) if columns else _EMPTY
    breaks = np.ones(len(order), bool)
    breaks[1:] = columns[0][order[1:]] != columns[0][order[:-1]] if columns else False
    # Each further word sorts only what is still equal.
    for c in (*columns[1:], sizes):
        tied = ~breaks
        tied[:-1] |= ~breaks[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        group = np.cumsum(breaks)[rows]
        part = order[rows]
        order[rows] = part[np.lexsort((c[part], group))]
        breaks[1:] |= c[order[1:]] != c[order[:-1]]
    prefixes = np.zeros(len(order), np.int64)
    rows = np.arange(1, len(order))
    for c in columns:
        x = c[order[rows]] ^ c[order[rows - 1]]
        for k in range(8):
            prefixes[rows] += x < np.uint64(1 << 8 * k) if k else x == 0
        rows = rows[x == 0]
        if not len(rows):
            break
    prefixes[1:] = np.minimum(prefixes[1:], np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    return stretch[order], offset[order], prefixes


def maximal_repeats(prefixes: np.ndarray, left: np.ndarray, least: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """Intervals (first, last, length) of the suffix array with a common prefix of `least` or more, innermost first,
    whose suffixes have different left neighbours or unknown ones (negative numbers)."""
    runs = np.flatnonzero(prefixes >= least)
    if not len(runs):
        return
    # The left neighbour that a run of suffixes shares: how far back it is the same.
    changed = np.concatenate(([True], (left[1:] != left[:-1]) | (left[1:] < 0)))
    since = np.maximum.accumulate(np.where(changed, np.arange(len(left)), 0)).tolist()
    heights = prefixes.tolist()
    gaps = np.diff(runs) > 1
    starts, stops = runs[np.concatenate(([True], gaps))], runs[np.concatenate((gaps, [True]))] + 1
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        stack: list[tuple[int, int]] = []
        for i in range(start, stop + 1):
            height = heights[i] if i < stop else 0
            first = i - 1
            while stack and stack[-1][1] > height:
                first, length = stack.pop()
                if since[i - 1] > first or left[first] < 0:
                    yield first, i - 1, length
            if height >= least and (not stack or stack[-1][1] < height):
                stack.append((first, height))


def _shared(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether a row has its key from several rows, and these are of several documents; low, high: the row's first and last
    document."""
    order = np.argsort(keys)
    cuts = np.flatnonzero(np.concatenate(([True], keys[order[1:]] != keys[order[:-1]])))
    spread = np.minimum.reduceat(low[order], cuts) < np.maximum.reduceat(high[order], cuts)
    counts = np.diff(np.concatenate((cuts, [len(keys)])))
    out = np.empty(len(keys), bool)
    out[order] = np.repeat(spread & (counts > 1), counts)
    return out


def _candidates(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, anchors: np.ndarray, low, high) -> np.ndarray:
    """Stretches that may share a window with another: one side next to the minimizer is shared.

    Where a minimizer repeats within a stretch, all stretches with that minimizer stay.
    """
    padded = _padded(data)
    kmers = _words(padded, starts + anchors)
    times = np.zeros(len(starts), np.int8)
    for k in range(int(lengths.max(initial=ANCHOR)) - ANCHOR + 1):
        times += (_words(padded, starts + k) == kmers) & (k <= lengths - ANCHOR)
    keep = np.isin(kmers, np.unique(kmers[times > 1]))
    for side in (-SIDE, 0):
        usable = np.flatnonzero((anchors + side >= 0) & (anchors + side + SIDE + ANCHOR <= lengths))
        if len(usable):
            first = starts[usable] + anchors[usable] + side
            key = kmers[usable]
            for k in range(0, SIDE, 8):
                key = _mix(key ^ _words(padded, first + k)) + _M1
            key = _mix(key ^ _words(padded, first + SIDE + ANCHOR - 8))
            keep[usable] |= _shared(key, low[usable], high[usable])
    return np.flatnonzero(keep)


def _windows(data: np.ndarray) -> np.ndarray:
    """A hash of LENGTH bytes from each place that has so many."""
    out, size = _words(data), 8
    while size * 2 <= LENGTH:
        out, size = _mix(out[:-size]) + out[size:], size * 2
    # Two that overlap cover the rest.
    rest = LENGTH - size
    return _mix(out[: len(out) - rest]) + out[rest:] if rest else out


def _meeting(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[np.ndarray]:
    """The suffixes, by number, whose first LENGTH bytes another suffix has too, in several documents; those of an array.

    No other suffix is in an interval with a common prefix of LENGTH bytes that holds several documents.
    """
    keys = []
    for a, b in _runs(lengths):
        stretch, offset = _suffixes(lengths[a:b])
        inside = (np.cumsum(lengths[a:b]) - lengths[a:b])[stretch] + offset
        keys.append(_windows(_gather(data, starts[a:b], lengths[a:b]))[inside])
    keys, stretch = np.concatenate(keys), np.repeat(np.arange(len(lengths)), lengths - LENGTH + 1)
    kept = np.flatnonzero(_shared(keys, low[stretch], high[stretch]))
    if len(kept) <= ARRAY_SUFFIXES:
        if len(kept):
            yield kept
        return
    kept = kept[np.argsort(keys[kept])]
    ends = np.flatnonzero(np.diff(keys[kept], append=~keys[kept[-1:]])) + 1
    begin = 0
    while begin < len(kept):
        last = int(np.searchsorted(ends, begin + ARRAY_SUFFIXES, "right"))
        stop = int(ends[max(last - 1, int(np.searchsorted(ends, begin, "right")))])
        yield np.sort(kept[begin:stop])
        begin = stop


def removed_stretches(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, anchors: np.ndarray, docs: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of fragments with their documents: number of the fragment, offset in it and length of all that is removed."""
    if not len(starts):
        return _EMPTY, _EMPTY, _EMPTY
    numbers = equal_stretches(data, starts, lengths)
    owners = np.argsort(numbers)
    cuts = np.flatnonzero(np.concatenate(([True], numbers[owners[1:]] != numbers[owners[:-1]])))
    counts = np.diff(np.concatenate((cuts, [len(owners)])))
    low, high = np.minimum.reduceat(docs[owners], cuts), np.maximum.reduceat(docs[owners], cuts)
    one = owners[cuts]
    # Equal fragments of several documents are repeats as they are.
    later = np.flatnonzero(docs > low[numbers])
    found = [(later, np.zeros(len(later), np.int64), lengths[later])]
    rows = _candidates(data, starts[one], lengths[one], anchors[one], low, high)
    kmers = _words(_padded(data), starts[one[rows]] + anchors[one[rows]])
    order = np.argsort(kmers)
    rows, kmers = rows[order], kmers[order]
    # Some suffixes at a time; equal minimizers stay together.
    total = np.cumsum(lengths[one[rows]] - LENGTH + 1)
    ends = np.flatnonzero(np.concatenate((kmers[1:] != kmers[:-1], [True]))) + 1 if len(rows) else _EMPTY
    begin = 0
    while begin < len(rows):
        done = total[begin - 1] if begin else 0
        fit = ends[(ends > begin) & (total[ends - 1] - done <= ARRAY_SUFFIXES)]
        stop = int(fit[-1]) if len(fit) else int(ends[ends > begin][0])
        part = rows[begin:stop]
        begin = stop
        s = one[part]
        for kept in _meeting(data, starts[s], lengths[s], low[part], high[part]):
            stretch, offset, prefixes = suffix_array(data, starts[s], lengths[s], kept)
            left = np.where(offset > 0, data[np.maximum(starts[s][stretch] + offset - 1, 0)].astype(np.int64), -1)
            groups = np.array(list(maximal_repeats(prefixes, left)), np.int64).reshape(-1, 3)
            if not len(groups):
                continue
            sizes = groups[:, 1] - groups[:, 0] + 1
            inside = np.repeat(groups[:, 0] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            which, at = part[stretch[inside]], offset[inside]
            first = np.minimum.reduceat(low[which], np.cumsum(sizes) - sizes)
            # Only stretches with a later document than the first of the group.
            use = np.flatnonzero(high[which] > np.repeat(first, sizes))
            which, at = which[use], at[use]
            length, first = np.repeat(groups[:, 2], sizes)[use], np.repeat(first, sizes)[use]
            n = counts[which]
            occurrence = owners[np.repeat(cuts[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            later = docs[occurrence] > np.repeat(first, n)
            found.append((occurrence[later], np.repeat(at, n)[later], np.repeat(length, n)[later]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _numbered(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different documents (id, mark) in order, and the number in it of each given one."""
    order = np.lexsort((marks, ids))
    keys = np.stack((ids[order], marks[order]), axis=1)
    new = np.ones(len(order), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return keys[new], numbers


def union(rows: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge stretches of the same row that overlap or touch."""
    if not len(rows):
        return rows, starts, stops
    order = np.lexsort((starts, rows))
    rows, starts, stops = rows[order], starts[order], stops[order]
    base = rows * (int(stops.max()) + 2)
    reach = np.maximum.accumulate(base + stops)
    new = np.concatenate(([True], base[1:] + starts[1:] > reach[:-1]))
    cuts = np.flatnonzero(new)
    return rows[cuts], starts[cuts], np.maximum.reduceat(stops, cuts)


def _pack(arrays: list[np.ndarray], text: np.ndarray | None = None, level: int = 6) -> bytes:
    """Arrays of integers, as little-endian columns, and bytes, compressed."""
    sizes = np.array([len(arrays), *map(len, arrays)], "<i8").tobytes()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    kinds = bytes(a.dtype.itemsize for a in arrays)
    return zstandard.ZstdCompressor(level=level).compress(
        sizes + kinds + body + (b"" if text is None else text.tobytes())
    )


def _unpack(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", n, 8)
    kinds, at, out = raw[8 * (n + 1) : 8 * (n + 1) + n], 8 * (n + 1) + n, []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, f"<i{kind}" if kind > 1 else "<u1", size, at))
        at += size * kind
    return out, np.frombuffer(raw, np.uint8, len(raw) - at, at)


def _target(ids: np.ndarray, marks: np.ndarray, parts: int) -> np.ndarray:
    """The part in which a document and its stretches meet."""
    return (_mix(ids.view(np.uint64) ^ _mix(marks.view(np.uint64))) >> np.uint64(33)) % np.uint64(parts)


def _span_blobs(parts: int, ids: np.ndarray, marks: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """Merged stretches of documents (id, mark), a blob for each part that has some."""
    keys, rows = _numbered(ids, marks)
    rows, starts, stops = union(rows, starts, stops)
    target = _target(keys[:, 0].copy(), keys[:, 1].copy(), parts)
    order = np.argsort(target[rows], kind="stable")
    cuts = np.flatnonzero(np.diff(target[rows][order], prepend=np.uint64(parts)))
    for a, b in itertools.pairwise([*cuts.tolist(), len(order)]):
        own = order[a:b]
        key = keys[rows[own]]
        # Differences of ids in order compress well.
        columns = [np.diff(key[:, 0], prepend=0), key[:, 1].astype("<i4"), starts[own], stops[own] - starts[own]]
        yield int(target[rows[own[0]]]), _pack(columns)


def _read_spans(blob: bytes) -> tuple[np.ndarray, ...]:
    (ids, marks, starts, lengths), _ = _unpack(blob)
    return np.cumsum(ids), marks.astype(np.int64), starts, starts + lengths


def _text_blobs(texts: list[bytes], ids: np.ndarray, marks: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """The texts of some documents, a blob for each part."""
    lengths = np.array([len(t) for t in texts], np.int64)
    target = _target(ids, marks, parts)
    order = np.argsort(target, kind="stable")
    cuts = np.flatnonzero(np.diff(target[order], prepend=np.uint64(parts)))
    for a, b in itertools.pairwise([*cuts.tolist(), len(order)]):
        own = order[a:b]
        data = np.frombuffer(b"".join(texts[i] for i in own.tolist()), np.uint8)
        yield int(target[own[0]]), _pack([np.diff(ids[own], prepend=0), marks[own].astype("<i4"), lengths[own]], data)


def _later(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether an earlier document has a stretch equal to this one."""
    numbers = equal_stretches(data, starts, sizes)
    first = np.full(int(numbers.max()) + 1, NONE, np.int64)
    np.minimum.at(first, numbers, docs)
    return docs > first[numbers]


def _blobs(
    data: np.ndarray, starts, sizes, where, offset, row, ids: np.ndarray, marks: np.ndarray, share: np.ndarray, steps: int
) -> Iterator[tuple[int, bytes]]:
    """Fragments in the order of their shares, a blob for `steps` shares in a row, that is for a part."""
    order = np.argsort(share, kind="stable")
    share = share[order]
    part = share // steps
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in itertools.pairwise([*cuts.tolist(), len(order)]):
        own = order[a:b]
        used, local = np.unique(row[own], return_inverse=True)
        columns = [
            np.bincount(share[a:b] - part[a] * steps, minlength=steps).astype("<i4"),
            ids[used],
            marks[used].astype("<i4"),
            np.diff(local, prepend=0).astype("<i4"),
            offset[own].astype("<i4") if offset[own].max() < 1 << 31 else offset[own],
            sizes[own].astype(np.uint8),
            (where[own] - starts[own]).astype(np.uint8),
        ]
        yield int(part[a]), _pack(columns, _gather(data, starts[own], sizes[own]))


def _deal(texts: list[bytes], ids: np.ndarray, marks: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """The fragments of some texts: part, 0, blob; stretches that are known to be removed have -1."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, sizes, where = fragments(data, ends)
    if not len(starts):
        return
    row = np.searchsorted(ends, starts, "right")
    offset = starts - (ends - lengths)[row]
    # Of equal fragments those of the first document stand for all; the others are removed.
    later = _later(data, starts, sizes, ids[row])
    if later.any():
        gone = np.flatnonzero(later)
        spans = _span_blobs(parts, ids[row[gone]], marks[row[gone]], offset[gone], offset[gone] + sizes[gone])
        yield from ((part, -1, blob) for part, blob in spans)
    kept = np.flatnonzero(~later)
    share = (_mix(_words(_padded(data), where[kept]) ^ _M2) >> np.uint64(20)) % np.uint64(parts * STEPS)
    dealt = (x[kept] for x in (starts, sizes, where, offset, row))
    yield from ((part, 0, blob) for part, blob in _blobs(data, *dealt, ids, marks, share.astype(np.int64), STEPS))


class _Pile:
    """Fragments by step, of which one step at a time is read."""

    def __init__(self, steps: int):
        self.steps, self.blobs, self.size = steps, [], 0
        self.pieces: list[list[tuple[int, int]]] = [[] for _ in range(steps)]  # where the fragments of a step lie
        self.file = tempfile.SpooledTemporaryFile(HELD_BYTES)

    def append(self, blob: bytes) -> None:
        """Take a blob of `_deal`."""
        self.blobs.append(blob)
        self.size += len(blob)
        if self.size > PILED_BYTES:
            self.settle()

    def settle(self) -> None:
        columns, texts, steps = [], [[] for _ in range(self.steps)], []
        for blob in self.blobs:
            (counts, ids, marks, local, offset, sizes, anchors), text = _unpack(blob)
            local = np.cumsum(local, dtype=np.int64)
            columns.append((ids[local], marks[local], offset, sizes, anchors))
            steps.append(np.repeat(np.arange(self.steps), counts))
            ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))[np.cumsum(counts)].tolist()
            for number, (a, b) in enumerate(itertools.pairwise([0, *ends])):
                if a < b:
                    texts[number].append(text[a:b])
        if columns:
            steps = np.concatenate(steps)
            order = np.argsort(steps, kind="stable")
            ends = np.cumsum(np.bincount(steps, minlength=self.steps)).tolist()
            columns = [np.concatenate(x)[order] for x in zip(*columns, strict=True)]
            for number, (a, b) in enumerate(itertools.pairwise([0, *ends])):
                if a < b:
                    self.put(number, [c[a:b] for c in columns], np.concatenate(texts[number]))
        self.blobs, self.size = [], 0

    def put(self, number: int, columns: list[np.ndarray], data: np.ndarray) -> None:
        """Fragments of a step: id, mark, offset, length, place of the minimizer, and bytes."""
        blob = _pack(columns, data, 1)
        self.pieces[number].append((self.file.seek(0, 2), len(blob)))
        self.file.write(blob)

    def step(self, number: int) -> Iterator[tuple[np.ndarray, ...]]:
        for at, size in self.pieces[number]:
            self.file.seek(at)
            columns, data = _unpack(self.file.read(size))
            yield *(c.astype(np.int64) for c in columns), data


class _Share:
    """What a task finds in its share of the fragments, step by step."""

    def __init__(self, parts: int):
        self.parts, self.step, self.blobs = parts, None, _Pile(STEPS)
        self.spans: list[tuple[np.ndarray, ...]] = []
        self.held, self.packed = 0, []

    def add_spans(self, spans: tuple[np.ndarray, ...]) -> None:
        self.spans.append(spans)
        self.held += len(spans[0])
        if self.held > HELD_SPANS:
            self._pack_spans()

    def _pack_spans(self) -> None:
        if self.held:
            self.packed += _span_blobs(self.parts, *(np.concatenate(x) for x in zip(*self.spans, strict=True)))
        self.spans, self.held = [], 0

    def finish_step(self) -> None:
        """Work on the fragments that have come, in their steps."""
        self.blobs.settle()
        self._work(self.blobs, 0)
        self.blobs = _Pile(STEPS)

    def _work(self, pile: _Pile, level: int) -> None:
        with pile.file:
            for number in range(pile.steps):
                held, windows, finer = [], 0, None
                for part in pile.step(number):
                    held.append(part)
                    windows += int((part[3] - LENGTH + 1).sum())
                    if windows > STEP_WINDOWS and level + 1 < len(ANCHORS):
                        finer = finer or _Pile(FINER_STEPS)
                        self._cut(held, finer, ANCHORS[level + 1])
                        held, windows = [], 0
                if finer:
                    if held:
                        self._cut(held, finer, ANCHORS[level + 1])
                    self._work(finer, level + 1)
                elif held:
                    self._find(held)

    def _cut(self, held: list[tuple[np.ndarray, ...]], pile: _Pile, anchor: int) -> None:
        """Put the windows of fragments into fragments by longer strings."""
        ids, marks, offset, sizes, _, data = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        ends = np.cumsum(sizes)
        starts, lengths, where = fragments(data, ends, anchor)
        row = np.searchsorted(ends, starts, "right")
        offset = offset[row] + starts - (ends - sizes)[row]
        ids, marks = ids[row], marks[row]
        later = _later(data, starts, lengths, ids)
        gone = np.flatnonzero(later)
        self.add_spans((ids[gone], marks[gone], offset[gone], offset[gone] + lengths[gone]))
        kept = np.flatnonzero(~later)
        share = (_mix(_hashes(_padded(data), anchor, where[kept]) ^ _M2) >> np.uint64(20)) % np.uint64(pile.steps)
        order = kept[np.argsort(share, kind="stable")]
        ends = np.cumsum(np.bincount(share.astype(np.int64), minlength=pile.steps)).tolist()
        for number, (a, b) in enumerate(itertools.pairwise([0, *ends])):
            if a < b:
                own = order[a:b]
                columns = [ids[own], marks[own].astype("<i4"), offset[own], lengths[own].astype(np.uint8)]
                columns.append((where[own] - starts[own]).astype(np.uint8))
                pile.put(number, columns, _gather(data, starts[own], lengths[own]))

    def _find(self, held: list[tuple[np.ndarray, ...]]) -> None:
        ids, marks, offset, sizes, anchors, data = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        which, at, length = removed_stretches(data, np.cumsum(sizes) - sizes, sizes, anchors, ids)
        keys, row = _numbered(ids[which], marks[which])
        row, start, stop = union(row, offset[which] + at, offset[which] + at + length)
        self.add_spans((keys[row, 0], keys[row, 1], start, stop))

    def flush(self) -> Iterator[tuple[int, bytes]]:
        self._pack_spans()
        yield from self.packed
        self.packed = []


def without_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, `spans` (pairs of 64-bit start and stop of what is removed, in order; null if nothing is) and
    `kept`, the bytes that are left, of each row."""
    spark = documents.sparkSession
    parts = common.shuffle_partitions(spark)
    rows = documents.selectExpr(f"coalesce(doc_id, {NONE}) AS id", "hash(text) AS mark", "text")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column("text").to_pylist()]
            ids, marks = (batch.column(c).to_numpy().astype(np.int64) for c in ("id", "mark"))
            for a, b in common.runs_by_bytes(list(map(len, texts)), BATCH_BYTES):
                yield texts[a:b], ids[a:b], marks[a:b]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            yield from _batches(_deal(*run, parts), ["part", "step", "blob"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            yield from _batches(_text_blobs(*run, parts), ["part", "blob"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = _Share(parts)
        for batch in batches:
            for step, blob in zip(batch.column("step").to_pylist(), batch.column("blob"), strict=True):
                if step < 0:
                    share.add_spans(_read_spans(blob.as_py()))
                else:
                    share.blobs.append(blob.as_py())
        share.finish_step()
        yield from _batches(share.flush(), ["part", "blob"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted: first the removed stretches of the part, then its texts, a blob at a time."""
        held, found = [], None
        for batch in batches:
            for is_text, blob in zip(batch.column("is_text").to_pylist(), batch.column("blob"), strict=True):
                if not is_text:
                    held.append(_read_spans(blob.as_py()))
                    continue
                if found is None:
                    found, held = _by_document(held), []
                yield _cut(blob.as_py(), found)

    removed = (
        rows.mapInArrow(deal, "part int, step int, blob binary")
        .repartitionById(parts, "part")
        .select("step", "blob")
        .mapInArrow(scan, "part int, blob binary")
    )
    sent = rows.mapInArrow(send, "part int, blob binary")
    both = removed.selectExpr("part", "false AS is_text", "blob").unionByName(
        sent.selectExpr("part", "true AS is_text", "blob")
    )
    done = (
        both.repartitionById(parts, "part")
        .sortWithinPartitions("is_text")
        .select("is_text", "blob")
        .mapInArrow(cut, "id bigint, n_bytes bigint, spans binary, kept binary")
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    return done.selectExpr(f"CAST(nullif(id, {NONE}) AS {kind}) AS doc_id", "n_bytes", "spans", "kept")


def _batches(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Some blobs at a time."""
    kinds = [pa.binary() if n == "blob" else pa.int32() for n in names]
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[-1])
        if len(some) == 64 or size > SENT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds, strict=True)], names)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds, strict=True)], names)


def _by_document(spans: list[tuple[np.ndarray, ...]]) -> dict[tuple[int, int], np.ndarray]:
    """Merged stretches, start and stop, of each document (id, mark)."""
    if not spans:
        return {}
    ids, marks, starts, stops = (np.concatenate(x) for x in zip(*spans, strict=True))
    keys, row = _numbered(ids, marks)
    row, starts, stops = union(row, starts, stops)
    cuts = np.flatnonzero(np.diff(row, prepend=-1)).tolist()
    pairs = np.stack((starts, stops), axis=1)
    whole = itertools.pairwise([*cuts, len(row)])
    return {tuple(key): pairs[a:b] for key, (a, b) in zip(keys.tolist(), whole, strict=True)}


def _cut(blob: bytes, found: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    (ids, marks, lengths), data = _unpack(blob)
    ids, at, text = np.cumsum(ids), 0, data.tobytes()
    spans, kept = [], []
    for key, n in zip(zip(ids.tolist(), marks.tolist(), strict=True), lengths.tolist(), strict=True):
        own, last, parts = found.get(key), 0, []
        for start, stop in own.tolist() if own is not None else ():
            parts.append(text[at + last : at + start])
            last = stop
        kept.append(b"".join([*parts, text[at + last : at + n]]))
        spans.append(None if own is None else own.tobytes())
        at += n
    arrays = [pa.array(ids), pa.array(lengths), pa.array(spans, pa.binary()), pa.array(kept, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "spans", "kept"])


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row."""
    return without_repeats(documents.select("doc_id", "text")).selectExpr(
        "doc_id",
        "n_bytes",
        "n_bytes - octet_length(kept) AS n_removed",
        "CAST(coalesce(octet_length(spans), 0) / 16 AS bigint) AS n_spans",
        "sha2(kept, 256) AS kept_sha256",
    )
