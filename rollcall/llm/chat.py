"""Chat formatting from event logs.

A conversation is a log of events, each with a sequence number and the message
it belongs to. Replaying the log in order gives the final messages, which are
rendered with a template whose control strings cannot occur inside a text.

Event kinds:

* ``message``: a whole message; it always starts a message of its own
* ``delta``: a streamed piece, added to the end of the message
* ``edit``: new text in place of what the message had
* ``regenerate``: the message starts over with this text (often empty), and all
  that later messages had got until then is void
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the template.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

EVENT_COLUMNS = ["conv_id", "message", "seq", "kind", "role", "text"]

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
PIECE_SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("loss_start", T.LongType()),
        T.StructField("loss_end", T.LongType()),
    ]
)
DIGEST_SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_PIECE = re.compile(
    re.escape(TURN_START) + r"([^\n]*)\n(.*)" + re.escape(TURN_END) + r"\n", re.DOTALL
)
_ROLE_ESCAPES = {"\\": "\\\\", "\n": "\\n", "<": "\\l"}
_ROLE_VALUES = {"\\": "\\", "n": "\n", "l": "<"}


def escape(text: str) -> str:
    """Put one more backslash into each ``<|``, so that no text opens a control string."""
    return _OPEN.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n<]", lambda m: _ROLE_ESCAPES[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ROLE_VALUES[m[1]], role)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One formatted turn, and the span of its text in it."""
    head = f"{TURN_START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{TURN_END}\n", len(head), len(head) + len(body)


def read_back(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = _PIECE.fullmatch(formatted)
    if found is None:
        raise ValueError("not a formatted turn")
    return unescape_role(found[1]), unescape(found[2])


def events_of(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a log of whole messages; a null role or text is empty."""
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("message"),
        F.col("turn").cast("bigint").alias("seq"),
        F.lit("message").alias("kind"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def _rows(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    """Rows as Python values: whole numbers stay what they are beside nulls."""
    return zip(*(batch.column(x).to_pylist() for x in names))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    types = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    columns = zip(*rows) if rows else [[]] * len(schema)
    arrays = [pa.array(list(x), types[f.dataType]) for x, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema.names)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages from events sorted by conversation, message, sequence.

    What is kept is one message, and per conversation the last regeneration of
    an earlier message: events of later messages up to it are void.
    """
    start = object()
    conv = message = start
    turn, void, void_next = 0, None, None
    role, parts, alive = "", [], False
    out: list[tuple] = []

    def close():
        nonlocal turn, alive
        if alive:
            out.append((conv, turn, role, "".join(parts)))
            turn += 1
        alive = False

    for batch in batches:
        for c, m, s, kind, r, text in _rows(batch, EVENT_COLUMNS):
            r, text = r or "", text or ""
            if c != conv or conv is start:
                close()
                conv, message, turn, void, void_next = c, start, 0, None, None
            if m != message or message is start:
                close()
                message, void = m, void_next
                parts, role = [], ""
            if void is not None and (s is None or s <= void):
                continue
            if kind == "message":
                close()
                role, parts, alive = r, [text], True
            elif kind == "delta":
                role, alive = role or r, True
                parts.append(text)
            elif kind == "edit":
                role, parts, alive = r or role, [text], True
            elif kind == "regenerate":
                role, parts, alive = r or role, [text], True
                if s is not None and (void_next is None or s > void_next):
                    void_next = s
            else:
                raise ValueError(f"unknown event kind: {kind}")
        # Only closed messages are given out; the open one may go on.
        if out:
            yield _batch(out, MESSAGE_SCHEMA)
            out = []
    if conv is not start:
        close()
    if out:
        yield _batch(out, MESSAGE_SCHEMA)


def messages(events: DataFrame) -> DataFrame:
    """Final messages of each conversation, in order within their partition.

    Events are dealt by conversation and sorted by Spark, so a task streams over
    them whatever their number. Ties of sequence go by kind, role and text;
    repeated rows are events of their own. A null conversation is a group of
    its own, a null sequence comes first. An empty log has no messages.
    """
    ordered = (
        events.select(*EVENT_COLUMNS)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "message", "seq", "kind", "role", "text")
    )
    return ordered.mapInArrow(_fold, MESSAGE_SCHEMA)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for c, turn, role, text in _rows(batch, MESSAGE_SCHEMA.names):
            formatted, a, b = render(role, text)
            loss = role == LOSS_ROLE
            out.append((c, turn, formatted, a if loss else None, b if loss else None))
        yield _batch(out, PIECE_SCHEMA)


def format_conversations(events: DataFrame) -> DataFrame:
    """One formatted piece per final message; a conversation is its pieces in order.

    ``loss_start`` and ``loss_end`` span the text under the loss mask within the
    piece, in code points; they are null outside the loss. Pieces rather than
    whole conversations keep rows small however long a conversation is.
    """
    return messages(events).mapInArrow(_render, PIECE_SCHEMA)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start = object()
    conv = start
    state: list = []

    def row():
        turns, all_turns, loss_chars, loss, chars = state
        return (conv, turns, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

    for batch in batches:
        out = []
        for c, formatted, a, b in _rows(batch, ["conv_id", "formatted", "loss_start", "loss_end"]):
            if c != conv or conv is start:
                if conv is not start:
                    out.append(row())
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_back(formatted)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[4] += len(formatted)
            if a is not None:
                inside = unescape(formatted[a:b])
                state[2] += len(inside)
                state[3].update(inside.encode("utf-8", "surrogatepass"))
        yield _batch(out, DIGEST_SCHEMA)
    if conv is not start:
        yield _batch([row()], DIGEST_SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """Per conversation, what reading the formatted pieces back gives.

    Takes the frame of :func:`format_conversations` as it is: its pieces come in
    order, so both steps run in one task without another shuffle.
    """
    return pieces.mapInArrow(_digest, DIGEST_SCHEMA)
