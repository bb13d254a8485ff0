"""Operators over pairs of rows against brute force."""

import random

import numpy as np
import pytest

from cohortrail.llm import components, decontaminate, repeats, simhash, topk


def removed_by_brute_force(docs):
    first = {}
    for d, t in docs:
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(first.get(t[i : i + 50], 1 << 62), d)
    out = []
    for d, t in docs:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < d:
                gone[i : i + 50] = True
        out.append(gone)
    return out


def removed_in_shares(docs, parts, batch):
    blobs, spans = [], []
    for k in range(0, len(docs), batch):
        some = docs[k : k + batch]
        ids = np.array([d for d, _ in some])
        blobs += list(repeats._deal([t for _, t in some], ids, np.zeros(len(some), np.int64), parts))
    for part in range(parts):
        share = repeats._Share(parts)
        for _, step, blob in sorted((b for b in blobs if b[0] == part), key=lambda b: b[1]):
            if step != share.step:
                share.finish_step()
                share.step = step
            if step < 0:
                share.add_spans(repeats._read_spans(blob))
            else:
                share.blobs.append(blob)
        share.finish_step()
        spans += [repeats._read_spans(b) for _, b in share.flush()]
    gone = {d: np.zeros(len(t), bool) for d, t in docs}
    for ids, _, starts, stops in spans:
        for d, a, b in zip(ids.tolist(), starts.tolist(), stops.tolist(), strict=True):
            gone[d][a:b] = True
    return [gone[d] for d, _ in docs]


@pytest.mark.parametrize("seed", range(12))
def test_repeats_by_brute_force(seed, monkeypatch):
    random.seed(seed)
    monkeypatch.setattr(repeats, "ARRAY_SUFFIXES", random.choice([50, 1 << 19]))
    monkeypatch.setattr(repeats, "STEP_BYTES", random.choice([64, 1 << 20]))
    words = [bytes(random.choice(b"abcd e") for _ in range(random.randrange(1, 9))) for _ in range(random.choice([3, 30, 300]))]
    base = [b" ".join(random.choice(words) for _ in range(random.randrange(120))) for _ in range(12)]
    base += [b"a" * 300, b"ab" * 200, b"\x00" * 130, b""]
    docs = []
    for d in random.sample(range(1000), 30):
        text = b""
        for _ in range(random.randrange(3)):
            s = random.choice(base)
            at = random.randrange(len(s) + 1)
            text += s[at : at + random.randrange(300)]
        docs.append((d, text + b" ".join(random.choice(words) for _ in range(random.randrange(40)))))
    got = removed_in_shares(docs, 3, random.choice([1, 5, 30]))
    assert all((a == b).all() for a, b in zip(removed_by_brute_force(docs), got, strict=True))


def test_suffixes_that_meet_no_other_document_are_not_sorted(monkeypatch):
    """A phrase of 45 bytes that all hold makes no repeat of 50; one text is repeated within itself, one in another."""
    random.seed(1)

    def noise(n):
        return bytes(random.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    phrase, own, shared = noise(45), noise(80), noise(52)
    docs = [(d, noise(90) + phrase + noise(90)) for d in range(40)]
    docs += [(50, own + noise(9) + own), (60, noise(60) + shared + noise(60)), (61, noise(60) + shared + noise(60))]
    sorted_suffixes, plain = [], repeats.suffix_array

    def counted(*given):
        out = plain(*given)
        sorted_suffixes.extend(out[0].tolist())
        return out

    monkeypatch.setattr(repeats, "suffix_array", counted)
    got = removed_in_shares(docs, 2, 5)
    assert all((a == b).all() for a, b in zip(removed_by_brute_force(docs), got, strict=True))
    assert sum(g.sum() for g in got) == 52 and len(sorted_suffixes) == 6


@pytest.mark.parametrize("seed", range(6))
def test_steps_of_a_frequent_minimizer_are_cut(seed, monkeypatch):
    """Texts around one string that is the minimizer of nearly all their windows, and passages that all share."""
    random.seed(seed)
    for name, value in (("STEP_WINDOWS", 400), ("FINER_STEPS", 5), ("HELD_BYTES", 1000), ("PILED_BYTES", 2000)):
        monkeypatch.setattr(repeats, name, value)
    monkeypatch.setattr(repeats, "ARRAY_SUFFIXES", random.choice([50, 1 << 19]))
    strings = np.array([random.randbytes(8) for _ in range(100_000)])
    least = strings[np.argmin(repeats._mix(strings.view("<u8")))].tobytes()
    base = [least.join(random.randbytes(random.randrange(10, 40)) for _ in range(6)) for _ in range(60)]
    base += [random.randbytes(20) + least + b"a passage that very many documents hold, " + random.randbytes(30) for _ in range(90)]
    docs = []
    for d in random.sample(range(1000), 150):
        text = random.choice(base)
        at = random.randrange(30)
        docs.append((d, text[at:] + random.choice(base)[: random.randrange(200)]))
    most, plain = [], repeats.removed_stretches

    def counted(data, starts, lengths, *rest):
        if len(set(lengths.tolist())) > 1:  # else single windows, which nothing cuts
            most.append(int((lengths - 49).sum()))
        return plain(data, starts, lengths, *rest)

    monkeypatch.setattr(repeats, "removed_stretches", counted)
    got = removed_in_shares(docs, 2, random.choice([1, 20]))
    assert all((a == b).all() for a, b in zip(removed_by_brute_force(docs), got, strict=True))
    assert max(most) <= 400 and sum(g.sum() for g in got) > 1000


def test_suffix_array_and_maximal_repeats():
    data = np.frombuffer(b"xabcabcabcy", np.uint8)
    stretch, offset, prefixes = repeats.suffix_array(
        np.tile(data, 9), np.array([0, 20]), np.array([70, 75])
    )
    suffixes = [np.tile(data, 9).tobytes()[s * 20 + o : (70, 95)[s]] for s, o in zip(stretch, offset, strict=True)]
    assert suffixes == sorted(suffixes) and len(suffixes) == 21 + 26
    for a, b, n in zip(suffixes, suffixes[1:], prefixes[1:], strict=False):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


def test_links_and_components_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {0, (1 << 64) - 1}
    for s in seeds.tolist():
        for _ in range(12):
            prints.add(s ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 4)).tolist())))
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = sorted(tuple(sorted(r)) for r in simhash.links(frame).collect())
    want = sorted(
        tuple(sorted((signed[i], signed[j])))
        for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2
    )
    assert got == want
    root = {x: x for x in signed}
    for _ in range(len(signed)):
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    edges = spark.createDataFrame(want, "a bigint, b bigint")
    found = {r.node: r.root for r in components.components(edges).collect()}
    assert {x: found.get(x, x) for x in signed} == root


def test_a_long_chain_is_one_component(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components.components(edges).collect()} == {0}


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    random.seed(1)
    for _ in range(300):
        pattern = "".join(random.choice("abc") for _ in range(random.randrange(1, 20)))
        text = "".join(random.choice("abc") for _ in range(random.randrange(40)))
        assert decontaminate.Myers(pattern).best(text)[0] == distance(pattern, text)


def test_edited_passages_are_found_as_by_brute_force():
    random.seed(4)
    letters = "abcdefgh "
    items = [(i, "".join(random.choice(letters) for _ in range(random.randrange(60, 200)))) for i in range(8)]
    matcher = decontaminate.Matcher(items)
    for _ in range(60):
        key, item = random.choice(items)
        edited = list(item)
        for _ in range(random.randrange(2 * decontaminate.budget_of(item) + 1)):
            at = random.randrange(len(edited))
            edited[at : at + 1] = random.choice([[], ["x"], [edited[at], "y"]])
        text = "".join(random.choice(letters) for _ in range(100)) + "".join(edited) + "".join(random.choice(letters) for _ in range(50))
        found = {k: d for k, _, _, d in matcher.find(text)}
        least = distance(item, text)
        assert (found.get(key) == least) if least <= decontaminate.budget_of(item) else key not in found
    assert matcher.find("quite another text, of which no item has a piece " * 20) == []


def test_contaminated_documents_go(spark):
    item = "the quick brown fox jumps over the lazy dog and runs into the deep dark wood"
    edited = item.replace("lazy", "lzy").upper().replace(" ", "!!\n")
    docs = spark.createDataFrame(
        [(1, f"before {item} after"), (2, edited), (3, "the quick brown fox is another story"), (4, None), (4, None), (5, "")],
        "doc_id bigint, text string",
    ).selectExpr("*", "'x' AS h")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {(1, 7, 0), (2, 7, 1)}
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 4, 5]
    assert decontaminate.clean(docs, bench.limit(0)).count() == 6


def test_top_k_with_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(90)] + [(200, [1.0] * 16), (300, [1.0] * 16), (20, None)]
    rows += [(None, [1.0] * 16), (400, [float("nan")] * 16), (500, [None] * 16), (600, [float("inf")] * 16), (700, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").unionByName(
        spark.createDataFrame(rows[:3], "vec_id bigint, embedding array<double>")
    )
    usable = [(i, v) for i, v in rows + rows[:3] if i is not None and v and None not in v and np.isfinite(v).all()]
    ints = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in usable]
    want = []
    for q, (own, v) in enumerate(ints):
        if own % 20 == 0:
            # Every row but the query's own, also one of the same id.
            score = [(-int(sum(a * b for a, b in zip(v, w, strict=False))), i) for c, (i, w) in enumerate(ints) if c != q]
            want += [(own, n, i, -x) for n, (x, i) in enumerate(sorted(score)[:20], 1)]
    assert sorted(map(tuple, topk.neighbours(frame).collect())) == sorted(want)
    assert topk.neighbours(frame.limit(0)).count() == 0


def test_bounds_lie_above_the_scores():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(20, 64)), rng.normal(size=(30, 64))
    for n in topk.LEVELS:
        assert (topk.statistics(a, n) @ topk.statistics(b, n).T >= a @ b.T - 1e-9).all()


def test_bounds_rule_out_most_pairs_where_segments_tell_vectors_apart():
    """Vectors that change slowly from one component to the next."""
    rng = np.random.default_rng(4)
    v = np.floor(64 * np.cumsum(rng.normal(size=(3000, 64)), axis=1)).astype(np.int64)
    nrs = np.arange(len(v))
    best = topk.Best(nrs[:100], nrs[:100], v[:100], 20)
    for at in range(0, len(v), topk.TILE):
        best.add(nrs[at : at + topk.TILE], nrs[at : at + topk.TILE], v[at : at + topk.TILE])
    assert best.left < 0.3 * best.met
    scores = v[:100] @ v.T
    scores[nrs[:100], nrs[:100]] = np.iinfo(np.int64).min
    want = [sorted((-x, j) for j, x in enumerate(row.tolist()))[:20] for row in scores]
    found = list(zip(best.rows.tolist(), (-best.scores).tolist(), best.found.tolist(), strict=True))
    assert found == [(i, x, j) for i, row in enumerate(want) for x, j in row]


def test_scores_beyond_a_double_are_exact():
    rng = np.random.default_rng(5)
    v = rng.integers(-(2**28), 2**28, (400, 8))
    nrs = np.arange(len(v))
    best = topk.Best(nrs[:5], nrs[:5], v[:5], 7)
    best.add(nrs, nrs, v)
    for q in range(5):
        want = sorted((-int(x), j) for j, x in enumerate((v[q] * v).sum(axis=1)) if j != q)[:7]
        mine = best.rows == q
        assert list(zip((-best.scores[mine]).tolist(), best.found[mine].tolist(), strict=True)) == want
