"""Byte-level BPE by a sentencepiece model that is written from the ranks of a vocabulary.

The ranks (one line per token: base64 of its bytes, rank) become a BPE model: each token is a piece, its bytes mapped
to 256 printable characters, its score the negative rank, so that the library merges the pair of lowest rank first,
the leftmost among equals. Normalisation is the identity. Texts are cut into pre-tokens by a pattern, each is encoded
by the library, and decoding maps pieces back to bytes.

Null text: as the empty text, no ids. Repeated rows: each gets its ids. Very long texts and pre-tokens: whole.
"""

from __future__ import annotations

import array
import base64
import itertools
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from cohortrail.llm import common

RANKS = "byte_bpe_multi_50k.tiktoken"
# Pre-tokens whose ids a task remembers; emptied when full.
REMEMBERED = 250_000
# Characters of the texts that are encoded together.
RUN_CHARACTERS = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    """A field of a protocol buffer: bytes with their length, or a number."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model: piece r is the token of rank r, the last piece stands for what is unknown."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0 to n - 1")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must be a token")
    characters = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, _field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _field(3, kind))

    tokens = sorted(ranks, key=ranks.__getitem__)
    pieces = [piece("".join(characters[b] for b in token), -float(rank), 1) for rank, token in enumerate(tokens)]
    pieces.append(piece(" unknown ", 0.0, 2))
    trainer = _field(2, _field(3, 2) + _field(4, len(pieces)))
    normalizer = _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return b"".join(pieces) + trainer + normalizer


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes, pattern: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._mapped = dict(enumerate(byte_characters()))
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size() - 1)]
        # A pre-token that is a token is that token, whether or not merges lead to it.
        self._whole = {name: rank for rank, name in enumerate(names)}
        self._splitter = common.Splitter(pattern, _letters_or_numbers)
        self._ids: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        mapped = [word.encode().decode("latin-1").translate(self._mapped) for word in words]
        hard = [i for i, name in enumerate(mapped) if name not in self._whole]
        found = self._model.encode([mapped[i] for i in hard], out_type=int, num_threads=1) if hard else []
        ids = {words[i]: array.array("I", x).tobytes() for i, x in zip(hard, found, strict=True)}
        ids |= {w: struct.pack("<I", self._whole[n]) for w, n in zip(words, mapped, strict=True) if n in self._whole}
        self._ids.update(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._splitter.split(text) for text in texts]
        # New pre-tokens of all texts at once; what is learned here is kept until the texts are done.
        new = [w for w in dict.fromkeys(itertools.chain.from_iterable(split)) if w not in self._ids]
        if len(self._ids) + len(new) > REMEMBERED:
            self._ids, new = {}, list(dict.fromkeys(itertools.chain.from_iterable(split)))
        self._learn(new)
        return [b"".join(map(self._ids.__getitem__, words)) for words in split]


def piece_bytes(model: bytes) -> list[bytes]:
    """The bytes of each piece, its characters mapped back."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    back = {c: b for b, c in enumerate(byte_characters())}
    return [bytes(map(back.__getitem__, pieces.id_to_piece(i))) for i in range(pieces.get_piece_size() - 1)]


def joined(ids: bytes, pieces: list[bytes]) -> bytes:
    """The bytes that ids stand for."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _letters_or_numbers(cls: str) -> set[str]:
    """The characters of a class as tiktoken knows it."""
    import tiktoken

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = tiktoken.Encoding(
        "classes", pat_str=rf"\p{{{cls}}}", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={}
    )
    return set(single.decode(single.encode_ordinary(everything)))


def _model(ranks_path: str | None) -> bytes:
    return serialise(read_ranks(ranks_path or public_tokenizers.path(RANKS)))


def encode(df: DataFrame, text: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`df` with `ids`, the ids of the whole column `text` as little-endian unsigned 32-bit integers.

    The vocabulary is read on the driver and sent to tasks: it has the size of the file, whatever the data.
    """
    pattern = pattern or public_tokenizers.PATTERN
    model = df.sparkSession.sparkContext.broadcast(_model(ranks_path))

    def work():
        encoder = Encoder(model.value, pattern)

        def coded(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            runs = common.runs_by_bytes(list(map(len, texts)), RUN_CHARACTERS)
            return [pa.array([ids for a, b in runs for ids in encoder.encode(texts[a:b])], pa.binary())]

        return coded

    return common.add_columns(df, {"text": f"`{text}`"}, "ids binary", work)


def decode(df: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """`df` with `decoded`, the bytes of its column `ids`. Null ids: no bytes."""
    pieces = df.sparkSession.sparkContext.broadcast(piece_bytes(_model(ranks_path)))

    def work():
        known = pieces.value
        return lambda batch: [pa.array([joined(i or b"", known) for i in batch.column("ids").to_pylist()], pa.binary())]

    return common.add_columns(df, {"ids": "ids"}, "decoded binary", work)


def digests(documents: DataFrame) -> DataFrame:
    """Per document: number of ids, and SHA-256 of the ids and of what they decode to."""
    coded = encode(documents.select("doc_id", "text")).drop("text")
    return decode(coded).selectExpr(
        "doc_id",
        "CAST(octet_length(ids) / 4 AS bigint) AS n_tokens",
        "sha2(ids, 256) AS ids_sha256",
        "sha2(decoded, 256) AS decoded_sha256",
    )
