"""Source divergence against the contract in plain Python, and runs of any number."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cohortrail.llm import divergence


def plain(docs, holders=10):
    """(lang, source, text) rows to result rows."""
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang in held:
        kept = sorted(t for t, n in held[lang].items() if n >= holders)
        groups = {s: {t: c[t] for t in kept} for (x, s), c in counts.items() if x == lang}
        whole = {t: sum(g[t] for g in groups.values()) for t in kept}

        def rates(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: rates(c) for s, c in groups.items()}, rates(whole)
        for s in groups:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(-gap(p[s][t], q[t]), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))[:top]
                out += [(lang, s, part, item, -v, i) for i, (v, item) in enumerate(ranked, 1)]
    return out


def documents(seed=1):
    pick = random.Random(seed)
    words = [f"{a}{b}" for a in "abcXYZéñ中" for b in ("", "on", "É", "ß", "Q")]
    out = []
    for _ in range(300):
        lang, source = pick.choice(["en", "de", None, ""]), pick.choice(["s", "t", "u", "U", None])
        own = words[: 12 if source == "s" else None]
        out.append((lang, source, " ,\x00_9".join(pick.choices(own, k=pick.randrange(30)))))
    out += [("xx", "only", "a few words"), ("yy", "a", ""), ("yy", "b", None), (None, None, None)]
    return out


def found(spark, docs, parts=4):
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(parts)
    clashing = df.selectExpr("*", "1 AS run", "2 AS shard", "3 AS n", "4 AS term", "5 AS doc_id")
    return sorted(map(tuple, divergence.audit(clashing).collect()))


def test_audit_is_that_of_the_contract(spark):
    docs = documents()
    assert found(spark, docs) == sorted(plain(docs))


@pytest.mark.parametrize("limits", [{"BLOCK": 30, "CHUNK": 3, "FAN_IN": 5}, {"MAX_GROUPS": 3, "MAX_CELLS": 10}])
def test_limits_change_nothing(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(divergence, name, value)
    docs = documents(2)
    assert found(spark, docs) == sorted(plain(docs))


def test_empty_table_and_repeated_rows(spark):
    assert found(spark, []) == []
    docs = [("en", "a", "hot word")] * 10 + [("en", "b", "word cold")] * 10 + [("en", "c", "rare")]
    assert found(spark, docs) == sorted(plain(docs))


def test_steps_cut_no_term(monkeypatch):
    monkeypatch.setattr(divergence, "STEP_BYTES", 5)
    text = "été abcdefghijkl, x y; zzzz".encode()
    pieces = list(divergence.steps(text))
    assert b"".join(pieces) == text
    assert [t for p in pieces for t in divergence._TERM.findall(p)] == divergence._TERM.findall(text)


def test_rates_are_exact_for_large_counts():
    import numpy as np

    counts = np.array([0, 5, 10**12, 4 * 10**15], np.int64)
    total = np.full(4, 9 * 10**15, np.int64)
    assert divergence.rates(counts, total).tolist() == [1 + 10**9 * (c + 2) // (9 * 10**15) for c in counts.tolist()]
