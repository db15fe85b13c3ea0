"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are
its context, and only that reply is trainable. Turns after the last reply
stay in one more example that trains nothing, so no text is lost.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.words import in_batches, rows_within

# The template's control strings. A text never holds one unescaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile(r"\\([\\.])")
_TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|<s>\[ROLE\](?P<role>.*?)\[/ROLE\](?P<other>.*?)</s>"
    r"|(?P<assistant>.*?)</s>",
    re.DOTALL,
)
ASSISTANT = "assistant"


def escape(text: str) -> str:
    """Backslashes doubled, and a backslash and dot after the first character of a control string."""
    return _CONTROL.sub(r"\\.", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else "", text)


def format_turn(role: str, text: str) -> str:
    """One turn; system, user and assistant have marks of their own, other roles a named one."""
    body = escape(text)
    if role == "user":
        return f"<s>[INST] {body} [/INST]"
    if role == ASSISTANT:
        return f"{body}</s>"
    if role == "system":
        return f"<<SYS>>{body}<</SYS>>"
    return f"<s>[ROLE]{escape(role)}[/ROLE]{body}</s>"


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted text: the inverse of formatting."""
    turns, at = [], 0
    while at < len(formatted):
        match = _TURN.match(formatted, at)
        if match is None:
            raise ValueError(f"no turn at {at}")
        kind = match.lastgroup
        role = unescape(match["role"]) if kind == "other" else kind
        turns.append((role, unescape(match[kind])))
        at = match.end()
    return turns


EXAMPLE = "conv_id long, example int, n_turns int, text string, loss_start int, loss_end int"
_EXAMPLE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("example", pa.int32()),
        ("n_turns", pa.int32()),
        ("text", pa.string()),
        ("loss_start", pa.int32()),
        ("loss_end", pa.int32()),
    ]
)


def _expand(turns: Iterator[tuple]) -> Iterator[tuple]:
    """Examples of turns that come conversation by conversation, in order."""
    conversation, prefix, example, count, open_turns = object(), "", 0, 0, False
    for conv_id, role, text in turns:
        if conv_id != conversation:
            if open_turns:
                yield conversation, example, count, prefix, len(prefix), len(prefix)
            conversation, prefix, example, count = conv_id, "", 0, 0
        start = len(prefix)
        prefix += format_turn(role, text)
        count += 1
        open_turns = role != ASSISTANT
        if not open_turns:
            yield conv_id, example, count, prefix, start, len(prefix) - len("</s>")
            example += 1
    if open_turns:
        yield conversation, example, count, prefix, len(prefix), len(prefix)


def expand_conversations(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per example: ``conv_id``, ``example``, ``n_turns``, ``text``, ``loss_start``, ``loss_end``.

    Only the characters from ``loss_start`` to ``loss_end`` of the text train.
    A null text or role is empty, turns with equal numbers are ordered by role
    and text, a null turn number comes first, rows of a null conversation form
    one, an empty table gives no rows, other columns are not read. Rows are
    hashed by conversation and sorted; a task streams through them and holds
    one conversation's prefix, the text of one example.
    """
    turns = rows.select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _expand((c, r, t) for c, _, r, t in rows_within(batches))
        yield from in_batches(rows, _EXAMPLE, weigh=lambda row: len(row[3]))

    return ordered.mapInArrow(expand, EXAMPLE)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, examples long"
_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("examples", pa.int64()),
    ]
)


def _digests(examples: Iterator[tuple]) -> Iterator[tuple]:
    conversation, last = object(), ""
    losses, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0

    def finish() -> tuple:
        turns = parse(last)
        digest = hashlib.sha256()
        for role, text in turns:
            digest.update(f"{role}\n{text}\n".encode())
        return conversation, len(turns), digest.hexdigest(), loss_chars, losses.hexdigest(), chars, count

    for conv_id, _, _, text, start, end in examples:
        if conv_id != conversation:
            if count:
                yield finish()
            conversation, losses, loss_chars, chars, count = conv_id, hashlib.sha256(), 0, 0, 0
        reply = unescape(text[start:end])
        losses.update(reply.encode())
        loss_chars += len(reply)
        chars += len(text)
        count += 1
        last = text
    if count:
        yield finish()


def digest_examples(examples: DataFrame) -> DataFrame:
    """Per conversation, what its examples hold when read back: turns parsed from the last, replies under the masks."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(_digests(rows_within(batches)), _DIGEST)

    return examples.mapInArrow(digest, DIGEST)
