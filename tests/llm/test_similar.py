"""Near-duplicates by five-word shingles against brute-force Jaccard similarity."""

import itertools

import pytest

from cohortrail.llm import similar



def _sets(rows):
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    return {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}


def kept_by_brute_force(rows):
    sets = _sets(rows)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i for i in root if find(i) == i}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_groups_equal_brute_force_jaccard(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    want = kept_by_brute_force([(r.doc_id, r.text) for r in docs.collect()])
    rows = similar.one_per_group(docs).collect()
    assert {r.doc_id for r in rows} == want and len(rows) == len(want)


def test_chains_and_common_lines(spark, monkeypatch):
    """Groups whose ends are unlike, a line that all hold, and pairs just at and just below the bound."""
    monkeypatch.setattr(similar, "STEP_PAIRS", 8)
    line = "all rights are reserved by the owners of this text"
    base = [f"w{i}" for i in range(80)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "One  two"), (4, line)]
    for k in range(30):  # a chain: each differs from the next in one word more
        rows.append((10 + k, " ".join([f"x{i}" if i < k else w for i, w in enumerate(base)])))
    for k in range(40):  # near copies of one text, each with a word of its own
        rows.append((100 + k, " ".join(["y" + w if i != 2 * k else f"z{k}" for i, w in enumerate(base)] + line.split())))
    for k in range(1, 12):
        own = [f"v{k}_{i}" for i in range(40)]
        rows += [(200 + k, " ".join([*own, *line.split()])), (300 + k, " ".join([*own, *[f"u{k}_{i}" for i in range(k)]]))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in similar.one_per_group(frame).collect()} == kept_by_brute_force(rows)
