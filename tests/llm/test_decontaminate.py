"""Benchmark items that repeat phrases, and short ones, against brute-force edit distance."""

import random

from cohortrail.llm.decontaminate import MIN_CHARACTERS, RATE, Matcher


def least_distance(item, text):
    """Of the item to any substring."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row, best = new, min(best, new[-1])
    return best


def edited(rng, item, n):
    out = list(item)
    for _ in range(n):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice(["", "q", out[at] + "q"])
    return "".join(out)


def test_items_of_repeated_phrases():
    rng = random.Random(5)
    for trial in range(300):
        phrase = "".join(rng.choice("ab cd") for _ in range(rng.randrange(3, 12))).strip() or "ab"
        item = " ".join((" ".join([phrase] * rng.randrange(6, 16))).split())
        if len(item) < MIN_CHARACTERS:
            continue
        budget = int(RATE * len(item))
        text = "zz " * rng.randrange(3) + phrase * rng.randrange(2) + edited(rng, item, budget) + " zz" * rng.randrange(4)
        want = least_distance(item, text)
        found = Matcher([(1, item)]).find(text)
        assert (min((f[3] for f in found), default=None) == want) if want <= budget else not found, (trial, want, found)


def test_short_items_may_have_edits_too():
    item = "the quick brown fox jumps over the dog"
    assert len(item) < MIN_CHARACTERS
    assert Matcher([(1, item)]).find(f"so {item.replace('quick', 'quack')} ran")[0][3] == 1
    assert not Matcher([(1, item)]).find(f"so x{item} ran".replace("dog", "dogs x"))
