"""Token counts without token ids: pieces are counted once per distinct pre-token.

1. A scan counts the pre-tokens of all texts, pre-aggregated per batch, and the tokenizer's model cuts each distinct
   one once: a written table (pre-token, pieces, frequency).
2. A second scan counts the pre-tokens of each document. The HEAD most frequent ones, which would be the hot keys of a
   join, are looked up where the document lies, in a broadcast of at most HEAD rows; the rest is joined by shuffle.
3. Sums per document.

Normalisation and pre-tokens are the library's own. Texts in plain Latin script take a shortcut with the same result
if the tokenizer has the set-up of FAST; tests compare both with the library's own counts.

Null text: as the empty text, 0 tokens. Repeated rows: each keeps its row. Very long texts: whole.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortrail.llm import common
from cohortrail.llm.bpe import byte_characters
from cohortrail.operators.skew import materialize

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
# Pre-tokens that are looked up by broadcast at most, the most frequent ones.
HEAD = 1 << 17
# Words that a task remembers; emptied when full.
REMEMBERED = 300_000
# Stands for each special token of a text. Pre-tokens contain no space.
SPECIAL = " special"

# The set-up of normalisation and pre-tokens for which the shortcut holds (fixed values).
FAST = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "split": {
        "type": "Split",
        "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
}
_FAST_MATCHES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class Tokens:
    """Pre-tokens of texts, and the number of pieces of a pre-token."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        setup = json.loads(tokenizer)
        self._library = Tokenizer.from_str(tokenizer)
        self._normalizer, self._pre = self._library.normalizer, self._library.pre_tokenizer
        added = [t["content"] for t in setup.get("added_tokens", [])]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in setup.get("added_tokens", [])):
            raise ValueError("added tokens with conditions are not supported")
        self._special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        parts = (setup.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self._fast = (
            setup.get("normalizer") == FAST["normalizer"]
            and len(parts) == 2
            and parts[0] == FAST["split"]
            and parts[1]["type"] == "ByteLevel"
            and not parts[1]["add_prefix_space"]
            and not parts[1]["use_regex"]
        )
        self._mapped = dict(enumerate(byte_characters()))

    def _of_word(self, word: str) -> list[str]:
        found = _FAST_MATCHES.findall(word.lower())
        # Printable ASCII stands for itself; control characters do not.
        return [
            p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self._mapped) for p in found
        ]

    def _slowly(self, text: str) -> list[str]:
        plain = self._normalizer.normalize_str(text) if self._normalizer else text
        return [p for p, _ in self._pre.pre_tokenize_str(plain)] if self._pre else [plain]

    def words(self, text: str) -> list[str]:
        """`text` in parts whose pre-tokens don't depend on each other, to be counted before they are cut further."""
        if self._special and self._special.search(text):
            parts = self._special.split(text)
            found = [SPECIAL] * (len(parts) - 1)
            return [w for part in parts for w in self.words(part)] + found
        # No pre-token contains white space.
        return text.split() if self._fast and not common.is_odd(text) else [text] if text else []

    def of(self, word: str) -> list[str]:
        """The pre-tokens of one of the `words`."""
        if word == SPECIAL:
            return [SPECIAL]
        return self._of_word(word) if self._fast and not common.is_odd(word) else self._slowly(word)

    def pieces(self, pre_token: str) -> int:
        return 1 if pre_token == SPECIAL else len(self._library.model.tokenize(pre_token))


def _read(path: str | None) -> str:
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return file.read()


def pieces(texts: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Each distinct pre-token of the column `text` with its pieces and its frequency, as a written table."""
    tokenizer = texts.sparkSession.sparkContext.broadcast(_read(tokenizer_path))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer.value)

        def batch_of(words: Counter) -> pa.RecordBatch:
            counts: Counter = Counter()
            for word, n in words.items():
                for p in tokens.of(word):
                    counts[p] += n
            return pa.RecordBatch.from_pydict(
                {"pre_token": pa.array(counts, pa.string()), "frequency": pa.array(counts.values(), pa.int64())}
            )

        for batch in batches:
            words: Counter = Counter()
            for text in batch.column(0):
                words.update(tokens.words(text.as_py() or ""))
                if len(words) >= REMEMBERED:
                    yield batch_of(words)
                    words = Counter()
            yield batch_of(words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer.value)
        for batch in batches:
            n = [tokens.pieces(p) for p in batch.column("pre_token").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], ["pre_token", "frequency", "pieces"])

    counted = (
        texts.select("text")
        .mapInArrow(distinct, "pre_token string, frequency bigint")
        .groupBy("pre_token")
        .agg(F.sum("frequency").alias("frequency"))
    )
    return materialize(counted.mapInArrow(cut, "pre_token string, frequency bigint, pieces bigint"), "pieces")


def _least_of_head(table: DataFrame) -> int:
    """The smallest frequency of the head: all pre-tokens of at least that frequency are HEAD at most.

    It comes from counts per power of the eighth root of two, a few hundred rows, so that no task sends its own HEAD.
    """
    step = F.expr("CAST(floor(8 * log2(frequency)) AS int) AS step")
    steps = table.groupBy(step).agg(F.expr("count(1) AS n"), F.expr("min(frequency) AS least")).orderBy(F.desc("step"))
    least, total = (1 << 63) - 1, 0
    for row in steps.collect():
        total += row.n
        if total > HEAD:
            break
        least = row.least
    return least


def counts(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row."""
    spark = documents.sparkSession
    table = pieces(documents, tokenizer_path)
    top = table.where(f"frequency >= {_least_of_head(table)}").select("pre_token", "pieces")
    head = spark.sparkContext.broadcast({r.pre_token: r.pieces for r in top.collect()})
    tokenizer = spark.sparkContext.broadcast(_read(tokenizer_path))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document: what the head accounts for, under a key that no pre-token has, and the other pre-tokens."""
        tokens, in_head = Tokens(tokenizer.value), head.value
        known: dict[str, int] = {}  # what the head accounts for in a word
        rest: dict[str, list[str]] = {}  # the other pre-tokens of words that have some
        for batch in batches:
            ends, keys, ns = [0], [], []
            for i, text in enumerate(batch.column("text")):
                words = tokens.words(text.as_py() or "")
                distinct = set(words)
                if len(known) + len(distinct) > REMEMBERED:
                    known, rest = {}, {}
                # Not `distinct - known.keys()`, which walks through all that is known.
                for word in [w for w in distinct if w not in known]:
                    found = tokens.of(word)
                    known[word] = sum(in_head.get(p, 0) for p in found)
                    if others := [p for p in found if p not in in_head]:
                        rest[word] = others
                keys.append(f" {i % 997}")
                ns.append(sum(map(known.__getitem__, words)))
                if rare := {w for w in distinct if w in rest}:
                    counts: Counter = Counter()
                    for word, n in Counter(w for w in words if w in rare).items():
                        for p in rest[word]:
                            counts[p] += n
                    keys.extend(counts)
                    ns.extend(counts.values())
                ends.append(len(keys))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("h"),
                    batch.column("n_bytes"),
                    pa.ListArray.from_arrays(offsets, pa.array(keys, pa.string())),
                    pa.ListArray.from_arrays(offsets, pa.array(ns, pa.int64())),
                ],
                ["doc_id", "h", "n_bytes", "pre_tokens", "ns"],
            )

    per_document = (
        documents.selectExpr(
            "doc_id",
            "xxhash64(text) AS h",
            "CAST(coalesce(octet_length(text), 0) AS bigint) AS n_bytes",
            "text",
        )
        .mapInArrow(
            frequencies,
            documents.select("doc_id").schema.add("h", T.LongType()).add("n_bytes", T.LongType())
            .add("pre_tokens", T.ArrayType(T.StringType())).add("ns", T.ArrayType(T.LongType())),
        )
        .selectExpr("doc_id", "h", "n_bytes", "inline(arrays_zip(pre_tokens, ns))")
        .withColumnRenamed("pre_tokens", "pre_token")
    )
    # Rows of no pre-token hold the sum of the head; the sum over a row that is there r times counts r times.
    return (
        per_document.join(table.select("pre_token", "pieces"), "pre_token", "left")
        .groupBy("doc_id", "h", "n_bytes")
        .agg(
            F.expr("sum(ns * coalesce(pieces, 1))").alias("total"),
            F.expr("count_if(startswith(pre_token, ' ') AND pieces IS NULL)").alias("r"),
        )
        .selectExpr("doc_id", "n_bytes", "total DIV r AS n_tokens", "explode(array_repeat(1, CAST(r AS int))) AS one")
        .drop("one")
    )


def over_limit(documents: DataFrame, tokenizer_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    return counts(documents.select("doc_id", "text"), tokenizer_path).withColumn("over_limit", F.col("n_tokens") > limit)
