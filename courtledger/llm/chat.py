r"""Chat formatting that reads back: render, parse by a grammar, compare, escape, repeat.

Template, one turn after the other::

    <|im_start|>role
    text<|im_end|>

The grammar is deterministic: a turn begins with its mark, its role ends with the line, its
text with the next end mark. In roles and texts every ``<\|`` with any number of backslashes
stands for the same with one backslash less. Turns are first rendered as they are; whatever
does not parse back to its source has one backslash added to each such string, until all
turns come back identical. A line feed in a role is written as ``<|n|>`` after that. No mark
of the template is left inside a role or text: ``<|`` begins nothing but marks.

Turns stream through a task in order, so a conversation of any length needs the memory of a
few turns. A conversation is stored as numbered parts of whole turns, with its loss mask as
ranges of characters: the texts of assistant turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.llm.common import NO_ID, ship

START, END = "<|im_start|>", "<|im_end|>"
#: Stands for a line feed in a role.
BREAK = "<|n|>"
_CONTROL = re.compile(r"<(\\*)\|")
#: Characters after which a part of a conversation is closed.
PART_CHARS = 1 << 16

_PARTS = (
    "conv_id bigint, part int, n_turns bigint, formatted string, "
    "loss array<struct<start:bigint,stop:bigint>>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"<{m[1][1:]}|" if m[1] else m[0], text)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text and range of the text of each turn; an error where the grammar is left."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        if not formatted.startswith(START, at) or line < 0:
            raise ValueError(f"no turn begins at {at}")
        role = formatted[at + len(START) : line].replace(BREAK, "\n")
        end = formatted.find("<|", line + 1)
        if "<|" in role or end < 0 or not formatted.startswith(END + "\n", end):
            raise ValueError(f"the turn at {at} does not end")
        turns.append((unescape(role), unescape(formatted[line + 1 : end]), line + 1, end))
        at = end + len(END) + 1
    return turns


def render_turn(role: str, text: str) -> str:
    """The turn as it stands if that parses back to itself, else escaped as often as needed."""
    shown_role, shown_text = role, text
    while True:
        formatted = f"{START}{shown_role}\n{shown_text}{END}\n"
        try:
            if [turn[:2] for turn in parse(formatted)] == [(role, text)]:
                return formatted
        except ValueError:
            pass
        # One round mends every turn: afterwards no mark of the template is left in it.
        shown_role, shown_text = escape(role).replace("\n", BREAK), escape(text)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, part = None, 0
    turns: list[str] = []
    loss: list[dict[str, int]] = []
    size = 0
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def close() -> pa.RecordBatch:
        values = [[current[1]], [part], [len(turns)], ["".join(turns)], [loss]]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), kind]
        names = ["conv_id", "part", "n_turns", "formatted", "loss"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("key", "conv_id", "role", "text")]
        for key, conv_id, role, text in zip(*columns):
            if current is not None and (current[0] != key or size >= PART_CHARS):
                yield close()
                part = part + 1 if current[0] == key else 0
                turns, loss, size = [], [], 0
            current = (key, conv_id)
            turn = render_turn(role, text)
            if role == "assistant":
                _, _, start, stop = parse(turn)[0]
                loss.append({"start": size + start, "stop": size + stop})
            turns.append(turn)
            size += len(turn)
    if current is not None:
        yield close()


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, n_turns, formatted, loss``: all conversations in the template.

    Turns go by ``turn``, nulls first, and where that ties by role and text; repeated rows
    are turns of their own. Null texts and roles are empty. Rows without ``conv_id`` are one
    conversation. Other columns are not read; an empty table gives no rows.
    """
    ship(conversations.sparkSession)
    c = conversations
    rows = c.select(
        F.coalesce(c["conv_id"].cast("bigint"), F.lit(NO_ID)).alias("key"),
        c["conv_id"].cast("bigint").alias("conv_id"),
        c["turn"].alias("turn"),
        F.coalesce(c["role"], F.lit("")).alias("role"),
        F.coalesce(c["text"], F.lit("")).alias("text"),
    )
    rows = rows.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    return rows.select("key", "conv_id", "role", "text").mapInArrow(_render, _PARTS)


_DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    current, open_ = None, False
    n = chars = total = 0
    turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()

    def close() -> pa.RecordBatch:
        values = [current[1], n, turns_sha.hexdigest(), chars, loss_sha.hexdigest(), total]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("key", "conv_id", "formatted", "loss")]
        for key, conv_id, formatted, loss in zip(*columns):
            if open_ and current[0] != key:
                yield close()
                n = chars = total = 0
                turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
            current, open_ = (key, conv_id), True
            for role, text, _, _ in parse(formatted):
                turns_sha.update(f"{role}\n{text}\n".encode())
                n += 1
            for span in loss:
                text = unescape(formatted[span["start"] : span["stop"]])
                loss_sha.update(text.encode())
                chars += len(text)
            total += len(formatted)
    if open_:
        yield close()


def read_conversations(parts: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed from stored parts in order."""
    ship(parts.sparkSession)
    rows = parts.withColumn("key", F.coalesce("conv_id", F.lit(NO_ID)))
    rows = rows.repartition("key").sortWithinPartitions("key", "part")
    return rows.select("key", "conv_id", "formatted", "loss").mapInArrow(_read_back, _DIGESTS)
