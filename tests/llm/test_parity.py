"""Jaccard join against all pairs, and the bounds it rests on."""

import random
import re

import numpy as np
import pytest

from cohortrail.llm import parity


def plain(docs):
    """(doc_id, text) rows to doc_id: (size, component), over all pairs."""
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def families(seed=5, n=25):
    pick = random.Random(seed)
    words, out = [f"w{i}" for i in range(300)], []
    for _ in range(n):
        base = pick.choices(words, k=pick.choice([3, 8, 20, 60, 150, 400]))
        for _ in range(pick.choice([1, 4, 15])):
            own = list(base)
            for _ in range(pick.randrange(1 + len(own) // 20)):
                at = pick.randrange(len(own))
                own[at : at + pick.randrange(2)] = pick.choices(words, k=pick.randrange(2))
            out.append((len(out), " ".join(own)))
    n = len(out)
    return out + [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "A b"), (n + 4, "a\nB"), (n + 5, "É b"), (n + 6, "é b")]


def found(spark, docs, parts=3):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    clashing = df.selectExpr("*", "1 AS n", "2 AS node", "3 AS h", "4 AS part", "5 AS sketch", "6 AS digest")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in parity.linked(clashing).collect()}


@pytest.mark.parametrize("limits", [{}, {"TILE": 5, "PACKED": 50, "SEEN": 4}, {"MEETINGS": 1e9, "WINDOW": 3, "BROADCAST_NODES": 0, "LARGE": 3}])
def test_links_are_those_of_all_pairs(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(parity, name, value)
    docs = families()
    assert found(spark, docs) == plain(docs)


@pytest.mark.parametrize("places", [1 << 22, 0])
def test_equal_sets_of_several_tasks_meet_others_once(spark, monkeypatch, places):
    """Copies are linked by their hash: none but the first forms groups with others, however many tasks hold them."""
    monkeypatch.setattr(parity, "BROADCAST_PLACES", places, raising=False)
    pick, groups, stars = random.Random(3), [], parity._stars
    base = [pick.choices([f"w{i}" for i in range(900)], k=120) for _ in range(3)]
    near = [*base[2][:60], "other", *base[2][61:]]
    docs = [(i, " ".join(w)) for i, w in enumerate([base[0]] * 9 + [base[1]] * 2 + [base[2]] * 4 + [near] * 3)]

    def counted(met):
        groups.extend(len(r.nodes) for r in met.collect())
        return stars(met)

    monkeypatch.setattr(parity, "_stars", counted)
    assert found(spark, docs, 6) == plain(docs)
    assert set(groups) == {2}  # the first nodes of the last two texts


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six"
    rows = [(5, text), (5, text), (None, text), (None, "alone with no id here"), (9, "ONE two three four five six")]
    out = parity.linked(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in out) == [
        (0, 2, 0), (0, 3, 5), (5, 3, 5), (5, 3, 5), (9, 3, 5),
    ]
    assert parity.linked(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_distance_of_sketches_never_exceeds_the_difference():
    random = np.random.default_rng(1)
    for n in (1, 7, 64, 500, 3000):
        a = random.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 9], random.integers(0, 1 << 63, n // 12 + 1).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        apart = len(np.setxor1d(a, b))
        assert parity.near(parity.sketch(a), parity.sketch(b), apart)
        for words in (1, 5, 40):
            assert np.bitwise_count(parity.parity(a, words) ^ parity.parity(b, words)).sum() <= apart


def test_similar_sets_share_a_signature_in_a_common_band():
    random = np.random.default_rng(2)
    for n in (3, 7, 20, 55, 300, 2000):
        for _ in range(20):
            a = np.unique(random.integers(0, 1 << 63, n).astype(np.uint64))
            gone = random.integers(0, 15 * n // 100 + 1)
            b = np.unique(np.concatenate([a[gone:], random.integers(0, 1 << 63, random.integers(0, 3)).astype(np.uint64)]))
            if not parity.similar(a, b):
                continue
            edges, keys = parity.bands(n + 3), []
            for own in (a, b):
                band = int(np.searchsorted(edges, len(own), side="right")) - 1
                inside = [band, band + 1] if parity.reach(len(own)) >= edges[band + 1] else [band]
                keys.append([set(parity.signatures(own, x, edges[x + 1] - 1, w, e).tolist())
                             for w, e in parity.CHOICES[:4] for x in [*inside, *[-1] * (2 - len(inside))] if x >= 0])
            assert set.union(*keys[0]) & set.union(*keys[1])


def test_more_documents_take_longer_signatures():
    chosen = [parity.choice(n) for n in (100, 10**6, 10**9)]
    assert chosen == sorted(chosen, key=parity.CHOICES.index) and chosen[0] != chosen[-1]
