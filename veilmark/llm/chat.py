"""Chat formatting with a grammar round trip.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Each rendered turn is parsed
again by the grammar; if it does not give back the same role and text, the content is
escaped and the turn is rendered anew. Escaping puts a backslash into every control
string (``<|im_end|>`` becomes ``<\\|im_end|>``, and so on for strings that already hold
backslashes), so it is reversible for all texts.

NULL role or text is empty; a NULL turn comes first; repeated turn numbers are ordered by
their rendered text; a NULL conv_id is a conversation of its own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.llm.arrow import batch

START, END = "<|im_start|>", "<|im_end|>"
_MARK = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")


class Conflict(ValueError):
    """The string does not follow the grammar."""


def escape(text: str) -> str:
    return _MARK.sub(lambda m: f"<\\{m[1]}|{m[2]}|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}|{m[2]}|>", text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the text as rendered) of each turn."""
    at = 0
    while at < len(rendered):
        line = rendered.find("\n", at)
        if not rendered.startswith(START, at) or line < 0:
            raise Conflict("a turn must start with its mark and role")
        end = rendered.find(END, line + 1)
        if end < 0 or not rendered.startswith("\n", end + len(END)):
            raise Conflict("a turn must end with its mark and a line feed")
        body = rendered[line + 1 : end]
        if START in body:
            raise Conflict("a turn inside a turn")
        yield _role_of(rendered[at + len(START) : line]), unescape(body), line + 1, end
        at = end + len(END) + 1


def render(role: str, text: str) -> str:
    """One turn whose parse is exactly (role, text)."""
    for head, body in ((role, text), (_role_line(role), escape(text))):
        out = f"{START}{head}\n{body}{END}\n"
        try:
            if [t[:2] for t in parse(out)] == [(role, text)]:
                return out
        except Conflict:
            continue
    raise AssertionError("escaping is reversible for every text")


@F.pandas_udf(T.StringType())
def _rendered(role: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([render(r, t) for r, t in zip(role, text, strict=True)], dtype=object)


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, formatted: the rendered turns. Their texts in the order (turn,
    formatted), put end to end, are the conversation."""
    return turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).select(
        "conv_id", "turn", _rendered("role", "text").alias("formatted")
    )


class _Reading:
    """What is read back from the formatted text of one conversation, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str) -> None:
        self.chars += len(formatted)
        for role, text, start, end in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == "assistant":  # the loss mask covers formatted[start:end]
                under = unescape(formatted[start:end])
                self.loss_chars += len(under)
                self.loss.update(under.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted turns and digest each conversation.

    A digest needs its conversation in order, so its turns go through one task, one
    after the other: memory does not depend on the length of a conversation.
    """
    ids = formatted.schema["conv_id"].dataType.simpleString()
    kind = pa.int64() if ids in ("bigint", "int") else pa.string()
    schema = pa.schema(
        [("conv_id", kind), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for part in batches:
            for conv_id, text in zip(part["conv_id"].to_pylist(), part["formatted"].to_pylist(), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now:
                        done.append(now.row())
                    now = _Reading(conv_id)
                now.add(text)
            if done:
                yield batch(schema, *zip(*done, strict=True))
                done = []
        if now:
            yield batch(schema, *zip(now.row(), strict=True))

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.select("conv_id", "formatted").mapInArrow(
        digest, f"conv_id {ids}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: n_turns, digest of all turns, size and digest of the
    text under the loss mask, and size of the formatted text, all read back from it."""
    return read_back(format_turns(turns))
