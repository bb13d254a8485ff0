"""Chat formatting with a grammar round trip.

A turn is rendered as OPEN role newline body CLOSE newline. A deterministic parser reads it back; a text that comes
back different, because it holds control strings or what looks like an escaped one, is escaped until the recovered
turn is identical. Escaping puts a backslash after the first character of a control string, and one more where there
are some, so that it can be undone. All RESERVED strings count as control strings, so that no tokenizer that knows
them meets one inside a text.

The loss mask covers the bodies of assistant turns. Rendering is per row; only the digests, which are chains of
hashes, need the turns of a conversation in order: they stream through a task, one row at a time.

Null text or role: empty. Turns are ordered by turn (nulls first), then role, then text; repeated rows stay. Rows with
null conv_id form a conversation of their own. Very long texts and conversations: whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cohortrail.llm import common

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
# Control strings of common chat templates (fixed values).
RESERVED = (OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(rf"{re.escape(r[0])}\\*{re.escape(r[1:])}" for r in RESERVED))
_BARE = re.compile("|".join(map(re.escape, RESERVED)))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Malformed(ValueError):
    """The text does not follow the grammar."""


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Role, text and the span of the body of each turn."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(OPEN, at):
            raise Malformed(f"no turn starts at {at}")
        line = rendered.find("\n", at)
        if line < 0:
            raise Malformed(f"no role at {at}")
        role = rendered[at + len(OPEN) : line]
        if _BARE.search(role):
            raise Malformed(f"control string in the role at {at}")
        end = _BARE.search(rendered, line + 1)
        if end is None or end[0] != CLOSE or not rendered.startswith("\n", end.end()):
            raise Malformed(f"the turn at {at} does not end")
        turns.append((_unescape_role(role), unescape(rendered[line + 1 : end.start()]), line + 1, end.start()))
        at = end.end() + 1
    return turns


def render(role: str, text: str) -> str:
    """The turn, escaped no more than it takes to read it back."""
    body = text
    for _ in range(3):
        rendered = f"{OPEN}{_escape_role(role)}\n{body}{CLOSE}\n"
        try:
            if [t[:2] for t in parse(rendered)] == [(role, text)]:
                return rendered
        except Malformed:
            pass
        body = escape(body)
    raise Malformed("the turn can't be read back")


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `rendered` of each row."""
    rows = conversations.selectExpr("conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text")

    def work():
        def each(batch: pa.RecordBatch) -> list[pa.Array]:
            pairs = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)
            return [pa.array([render(role, text) for role, text in pairs], pa.string())]

        return each

    return common.add_columns(rows, {"role": "role", "text": "text"}, "rendered string", work)


class _Digest:
    """What is read back of a conversation so far."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, rendered: str) -> None:
        for role, text, _, _ in parse(rendered):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == ASSISTANT:
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.chars += len(rendered)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


FIELDS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, from the rendered turns alone."""
    schema = turns.select("conv_id").schema
    for field in turns.sparkSession.createDataFrame(
        [], "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    ).schema:
        schema = schema.add(field)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by conversation and turn."""
        current, digest = None, None
        kinds = None
        for batch in batches:
            done = []
            kinds = batch.schema.field("conv_id").type
            for conv, rendered in zip(batch.column("conv_id").to_pylist(), batch.column("rendered"), strict=True):
                if digest is None or conv != current:
                    if digest:
                        done.append((current, *digest.row()))
                    current, digest = conv, _Digest()
                digest.add(rendered.as_py())
            if done:
                yield _batch(done, kinds)
        if digest:
            yield _batch([(current, *digest.row())], kinds)

    n = common.shuffle_partitions(turns.sparkSession)
    return (
        turns.repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "rendered")
        .mapInArrow(fold, schema)
    )


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, n, turns, loss_n, loss, chars = zip(*rows, strict=True)
    arrays = [pa.array(conv, kind), pa.array(n, pa.int64()), pa.array(turns), pa.array(loss_n, pa.int64())]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(loss), pa.array(chars, pa.int64())], ["conv_id", *FIELDS])
