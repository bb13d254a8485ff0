"""Languages of scripts that few texts have, and of labelled texts that are all short or all long."""

import random

from cohortrail.llm import language


def _words(letters, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(n))


def _range(first, n):
    return [c for c in map(chr, range(first, first + 4 * n)) if c.isalpha()][:n]


SCRIPTS = {
    "latin": _range(0x61, 26), "cyrillic": _range(0x430, 32), "greek": _range(0x3B1, 24), "armenian": _range(0x561, 38),
    "chinese": _range(0x4E00, 900), "korean": _range(0xAC00, 900), "japanese": _range(0x3041, 80),
    "gothic": _range(0x10330, 20), "deseret": _range(0x10428, 30),
}


def test_every_script_has_features_of_its_own():
    rows = [(_words(a, f"{name}{i}"), name) for name, a in SCRIPTS.items() for i in range(60 if name in ("latin", "cyrillic") else 8)]
    model = language.fit([t for t, _ in rows], [x for _, x in rows])
    for name, letters in SCRIPTS.items():
        texts = [_words(letters, f"new {name}{i}") for i in range(10)]
        assert (model.spectrum.presence(texts).sum(axis=1) > 0).all()
        assert [model.languages[k] for k in model.scores(texts).argmax(axis=1)] == [name] * 10


def test_labelled_texts_of_any_length_are_learned(spark):
    """One language has only titles, one only books; with neither in the preferred lengths there is a model too."""
    title = [(i, _words(SCRIPTS["greek"], f"t{i}", 3)[:19], "greek") for i in range(40)]
    book = [(100, _words(SCRIPTS["cyrillic"], "book", 8_000), "cyrillic")]
    usual = [(200 + i, _words(SCRIPTS["latin"], f"u{i}"), "latin") for i in range(20)]
    for rows in (title + book + usual, title + book):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        sample = language.training_rows(frame, "true").collect()
        longest = language.TRAINING_LENGTH[1]
        assert {r.lang for r in sample} == {x for _, _, x in rows} and all(len(r.text) <= longest for r in sample)
        assert len([r for r in sample if r.lang == "cyrillic"]) == -(-len(book[0][1]) // language.PIECE)
        model = language.train(frame)
        for name in {x for _, _, x in rows}:
            scores = model.scores([_words(SCRIPTS[name], f"new{i}") for i in range(5)])
            assert [model.languages[k] for k in scores.argmax(axis=1)] == [name] * 5
        assert language.accepted(frame).count() == len(rows)
