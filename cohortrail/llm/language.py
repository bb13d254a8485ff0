"""Language identification by a string kernel, Nyström landmarks and kernel ridge regression.

Features are the blended spectrum of a text: which n-grams of 1 to 3 characters it holds (presence, not counts), of
lower-case text with white space and other non-letters as one separator. N-grams of all letters are hashed to 2^22
numbers; FEATURES of those of the training texts are used, each language's most frequent ones in turn.
The kernel of two texts is their number of common n-grams over the root of the product of their own numbers. A ridge
regression, one versus the rest, is fitted in the space that the landmarks span (Nyström); a text is scored by two
batched matrix products, presence by landmarks and landmarks by classes.

Training uses a bounded sample: PER_LANGUAGE texts for each language, chosen by a hash of the id, and SAMPLE in all, as
many of each language as fit. Texts of TRAINING_LENGTH characters are preferred; where a language has too few, pieces of
longer texts and shorter texts are used. Prediction sees nothing but the text, and the whole of it.

Null text, or no letter: `und`, score 0. No training text at all: `und` for every text. A text that shares no n-gram
with the landmarks gets the language of the largest intercept, with its low score. Equal scores: the language that
comes first by name. Repeated rows: the same answer for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortrail.llm import common

UNDETERMINED = "und"
PER_LANGUAGE = 150
SAMPLE = 4_000
TRAINING_LENGTH = (20, 10_000)
PIECE = 1_000  # characters of the pieces of longer texts
LANDMARKS = 40  # of each language, at most MAX_LANDMARKS in all
MAX_LANDMARKS = 2_000
FEATURES = 12_000
SLOT_BITS = 22
SLOTS = 1 << SLOT_BITS
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)
RIDGE = 1e-2
BATCH_ROWS = 256
STEP_CHARACTERS = 2 << 20


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@dataclass
class Spectrum:
    """Numbers of the n-grams by the SLOTS hashes that an n-gram may have; `n` for those that are no feature."""

    table: np.ndarray
    n: int

    @classmethod
    def learn(cls, texts: list[str], languages: list[str]) -> Spectrum:
        """The FEATURES n-grams that stand highest in any language's order by the number of its texts that hold them."""
        slots, ranks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for name in sorted(set(languages)):
            held = [cls.distinct(t) for t, x in zip(texts, languages, strict=True) if x == name]
            own, times = np.unique(np.concatenate(held), return_counts=True)
            slots.append(own[np.argsort(-times, kind="stable")][:FEATURES])
            ranks.append(np.arange(len(slots[-1])))
        slots, ranks = np.concatenate(slots), np.concatenate(ranks)
        order = slots[np.lexsort((slots, ranks))]
        first = np.sort(np.unique(order, return_index=True)[1])[:FEATURES]
        table = np.full(SLOTS, len(first), np.int32)
        table[order[first]] = np.arange(len(first))
        return cls(table, len(first))

    @staticmethod
    def sequence(text: str) -> np.ndarray:
        """A code point per letter; runs of non-letters become one separator (0), also at both ends."""
        text = f" {text.lower()} "
        parts = []
        for at in range(0, len(text), STEP_CHARACTERS):
            codes = np.frombuffer(text[at : at + STEP_CHARACTERS].encode("utf-32-le"), "<u4")
            parts.append(np.where(_letters()[codes], codes, 0).astype(np.uint32))
        s = np.concatenate(parts)
        return s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]

    @staticmethod
    def grams(sequence: np.ndarray) -> np.ndarray:
        """Slots of all 1-, 2- and 3-grams but the separator alone."""
        one = sequence.astype(np.uint64)
        two = one[:-1] << np.uint64(21) | one[1:]
        three = two[:-1] << np.uint64(21) | one[2:]
        # A factor for each length, as the number of an n-gram that begins with a separator is that of the rest.
        found = [(one[one > 0] + 1) * FACTORS[0], (two + 1) * FACTORS[1], (three + 1) * FACTORS[2]]
        return (np.concatenate(found) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    @classmethod
    def steps(cls, text: str) -> Iterator[np.ndarray]:
        """The n-grams of a whole text, in steps that overlap by two characters."""
        sequence = cls.sequence(text)
        for at in range(0, len(sequence), STEP_CHARACTERS):
            yield cls.grams(sequence[max(0, at - 2) : at + STEP_CHARACTERS])

    @classmethod
    def distinct(cls, text: str) -> np.ndarray:
        return np.unique(np.concatenate([np.unique(g) for g in cls.steps(text)]))

    def presence(self, texts: list[str]) -> np.ndarray:
        """A row of 0 and 1 for each text."""
        out = np.zeros((len(texts), self.n + 1), np.float32)
        for i, text in enumerate(texts):
            for grams in self.steps(text):
                out[i, self.table[grams]] = 1
        return out[:, : self.n]


@dataclass
class Model:
    languages: list[str]
    spectrum: Spectrum
    landmarks: np.ndarray  # presence, over the root of their number
    weights: np.ndarray  # landmarks x languages
    intercepts: np.ndarray

    def kernel(self, presence: np.ndarray) -> np.ndarray:
        return (presence @ self.landmarks.T) / np.sqrt(np.maximum(presence.sum(axis=1), 1))[:, None]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Regression values, one column per language; targets are 1 and 0."""
        return self.kernel(self.spectrum.presence(texts)) @ self.weights + self.intercepts


def fit(texts: list[str], languages: list[str]) -> Model | None:
    """Nyström ridge regression: features K(x, Z) K(Z, Z)^(-1/2), one ridge problem per language."""
    if not texts:
        return None
    spectrum = Spectrum.learn(texts, languages)
    names = sorted(set(languages))
    presence = np.concatenate([spectrum.presence(texts[i : i + BATCH_ROWS]) for i in range(0, len(texts), BATCH_ROWS)])
    roots = np.sqrt(np.maximum(presence.sum(axis=1), 1))[:, None]
    each = max(1, min(LANDMARKS, MAX_LANDMARKS // len(names)))
    own = {name: [i for i, x in enumerate(languages) if x == name] for name in names}
    landmarks = (presence / roots)[[i for name in names for i in own[name][:each]]]
    model = Model(names, spectrum, landmarks, np.zeros((len(landmarks), len(names))), np.zeros(len(names)))
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    mapped = model.kernel(presence).astype(np.float64) @ half
    targets = np.array([[float(x == name) for name in names] for x in languages])
    # Each language has the same weight, however many texts it has.
    weight = np.array([1 / len(own[x]) for x in languages])
    weight /= weight.sum()
    centre, level = weight @ mapped, weight @ targets
    x = mapped - centre
    beta = np.linalg.solve((x.T * weight) @ x + RIDGE * np.eye(x.shape[1]) / len(names), (x.T * weight) @ (targets - level))
    model.weights = (half @ beta).astype(np.float32)
    model.intercepts = (level - centre @ beta).astype(np.float32)
    return model


def training_rows(documents: DataFrame, labelled: str) -> DataFrame:
    """nr, lang and text of the sample: for each language the rows of the smallest hashes of their ids.

    Texts of the lengths in TRAINING_LENGTH come first, then longer ones, then shorter ones. A longer text gives pieces:
    the first of each text, then the second of each and so on, while the language has too few.
    """
    low, high = TRAINING_LENGTH
    usable = documents.where(f"({labelled}) AND lang IS NOT NULL AND text RLIKE '\\\\p{{L}}'")
    length = f"CASE WHEN char_length(text) > {high} THEN 1 WHEN char_length(text) < {low} THEN 2 ELSE 0 END AS class"
    ids = usable.selectExpr("doc_id", "lang", length, "xxhash64(doc_id, 'sample') AS at", "xxhash64(text) AS h")
    first = ids.withColumn("nr", F.row_number().over(W.partitionBy("lang").orderBy("class", "at", "doc_id", "h")))
    chosen = first.where(f"nr <= {PER_LANGUAGE}").orderBy("nr", "lang").limit(SAMPLE)
    few = chosen.select("doc_id", "lang", "h", "nr").distinct().collect()
    if not few:
        return usable.selectExpr("1 AS nr", "lang", "text").limit(0)
    # At most SAMPLE rows.
    sample = documents.sparkSession.createDataFrame(few, "doc_id bigint, lang string, h bigint, nr int")
    found = usable.withColumn("h", F.expr("xxhash64(text)"))
    same = found.doc_id.eqNullSafe(sample.doc_id) & (found.lang == sample.lang) & (found.h == sample.h)
    found = found.join(F.broadcast(sample), same)
    # No more pieces of a text than a language may have rows.
    pieces = f"CASE WHEN char_length(text) > {high} THEN least(ceil(char_length(text) / {PIECE}), {PER_LANGUAGE}) ELSE 1 END"
    cut = found.select(sample.nr, sample.lang, "text").selectExpr(
        "nr", "lang", "text", f"explode(sequence(0, CAST({pieces} AS int) - 1)) AS piece"
    )
    own = f"CASE WHEN char_length(text) > {high} THEN substring(text, piece * {PIECE} + 1, {PIECE}) ELSE text END AS text"
    cut = cut.selectExpr("nr", "lang", "piece", own).where("text RLIKE '\\\\p{L}'")
    cut = cut.groupBy("nr", "lang", "piece").agg(F.min("text").alias("text"))
    ranked = cut.withColumn("nr", F.row_number().over(W.partitionBy("lang").orderBy("piece", "nr")))
    return ranked.where(f"nr <= {PER_LANGUAGE}").orderBy("nr", "lang").limit(SAMPLE).select("nr", "lang", "text")


def train(documents: DataFrame, labelled: str = "true") -> Model | None:
    """Fit on rows where the SQL condition `labelled` holds."""
    rows = sorted(training_rows(documents, labelled).collect(), key=lambda r: (r.lang, r.nr))
    return fit([r.text for r in rows], [r.lang for r in rows])


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`df` with `lang_pred` and `score`: the softmax share of the best language, 0 to 1."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def work():
        model = sent.value

        def predicted(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column("text").to_pylist()
            names, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
            for at in range(0, len(known), BATCH_ROWS):
                rows = known[at : at + BATCH_ROWS]
                scores = model.scores([texts[i] for i in rows]).astype(np.float64)
                share = np.exp(8 * (scores - scores.max(axis=1, keepdims=True)))
                best[rows] = 1 / share.sum(axis=1)
                for i, k in zip(rows, scores.argmax(axis=1), strict=True):
                    names[i] = model.languages[k]
            return [pa.array(names, pa.string()), pa.array(best, pa.float64())]

        return predicted

    return common.add_columns(df, {"text": f"`{text}`"}, "lang_pred string, score double", work)


# Times an equal share of all languages, which is what a text gets that resembles none of them.
LEAST_SCORE = 1.2


def accepted(documents: DataFrame) -> DataFrame:
    """The rows of `documents` in a language of those that have a `lang`, with the columns they have."""
    model = train(documents.select("doc_id", "text", "lang"))
    kept = documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns)])
    kept = predict(kept, model, f"c{documents.columns.index('text')}")
    least = LEAST_SCORE / len(model.languages) if model and len(model.languages) > 1 else 0
    kept = kept.where(f"lang_pred <> '{UNDETERMINED}' AND score >= {least}")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)])


HELD_OUT = "crc32(CAST(doc_id AS string)) % 4 = 2"


def identify(documents: DataFrame) -> DataFrame:
    """Predictions for all rows by a model of those that are not held out."""
    model = train(documents.select("doc_id", "text", "lang"), f"NOT coalesce({HELD_OUT}, false)")
    rows = documents.selectExpr("doc_id", f"coalesce({HELD_OUT}, false) AS held_out", "text")
    return predict(rows, model).drop("text")
