"""Chat formatting from event logs.

A log holds events of conversations; a turn is a message's slot. Events of a turn, by sequence:
`message` opens a message, `delta` adds to the open one, `edit` replaces its text and drops what later
turns had before it, `regenerate` starts the turn's message anew, `delete` takes it away. A log is
dealt by conversation and read in order of turn and sequence, so that folding holds one message at a
time, however long a conversation is. Messages are rendered into parts of bounded length.

The template: `<turn "ROLE">\\nTEXT\\n</turn>\\n`; in ROLE and TEXT the characters of ESCAPED have a
backslash before them, so no control string of the template occurs in them, and unescaping restores
the text whatever it is. The loss mask covers the texts (as rendered) of assistant messages.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.common import partitions

ESCAPED = {ord(c): "\\" + c for c in '\\<>#"[]|'}
UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
OPEN, BETWEEN, CLOSE = '<turn "', '">\n', "\n</turn>\n"
#: Characters after which a conversation's rendering goes on in another row.
PART = 1 << 22
#: Characters of a text that are unescaped and hashed at a time.
PIECE = 1 << 20


def escape(text: str) -> str:
    return text.translate(ESCAPED)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def unescaped(formatted: str, lo: int, hi: int) -> Iterator[str]:
    """unescape(formatted[lo:hi]) in pieces; none ends between a backslash and its character."""
    while lo < hi:
        piece = formatted[lo : min(hi, lo + PIECE)]
        if (len(piece) - len(piece.rstrip("\\"))) % 2:
            piece = formatted[lo : min(hi, lo + len(piece) + 1)]
        yield unescape(piece)
        lo += len(piece)


def in_order(events: DataFrame) -> DataFrame:
    """Events dealt by conversation, by turn and sequence. Ties: by kind, role and text; nulls first."""
    return events.select("conv_id", "turn", "seq", "kind", "role", "text").repartition(partitions(events.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "seq", "kind", "role", "text")


def _fold(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, role, text) of the final messages, in order; the events in order."""
    conv, turn, text, role, since, until = object(), None, None, None, None, None
    for c, t, seq, kind, r, x in rows:
        if c != conv or t != turn:
            if text is not None:
                yield conv, role, "".join(text)
            text, role = None, None
            if c != conv:
                conv, since = c, None
            else:
                since = until
            turn, until = t, since
        if since is not None and seq is not None and seq < since:
            continue  # before an earlier turn was edited
        if kind in (None, "message"):
            if text is not None:
                yield conv, role, "".join(text)
            text, role = [x or ""], r or ""
        elif kind == "delta":
            if text is None:
                text, role = [], r or ""
            text.append(x or "")
        elif kind in ("edit", "regenerate"):
            text, role = [x or ""], role if role is not None and not r else r or ""
            if kind == "edit" and seq is not None:
                until = seq if until is None else max(until, seq)
        elif kind == "delete":
            text, role = None, None
        else:
            raise ValueError(f"unknown kind of event: {kind}")
    if text is not None:
        yield conv, role, "".join(text)


def render(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, part, formatted, loss (array of start and end in formatted): conversations in the template.

    A null role or text is an empty one, a null conv_id a conversation of its own; one without messages
    has no row. Only a conversation of more than PART characters has more than one part; parts are
    consecutive rows of one partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                kind[:] = [b.column(0).type]
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        def batch(out: list) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["conv_id", "part", "formatted", "loss"])

        out, held, conv, part, pieces, size, loss = [], 0, object(), 0, [], 0, []
        for c, role, text in _fold(rows()):
            if pieces and (c != conv or size >= PART):
                out.append((conv, part, "".join(pieces), loss))
                held += size
                part, pieces, size, loss = part + 1, [], 0, []
                if held >= PART or len(out) >= 2000:
                    yield batch(out)
                    out, held = [], 0
            if c != conv:
                conv, part = c, 0
            head, body = OPEN + escape(role) + BETWEEN, escape(text)
            if role in loss_roles:
                loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
            pieces += [head, body, CLOSE]
            size += len(head) + len(body) + len(CLOSE)
        if pieces:
            out.append((conv, part, "".join(pieces), loss))
        if out:
            yield batch(out)

    kind = events.schema["conv_id"].dataType.simpleString()
    return in_order(events).mapInArrow(run, f"conv_id {kind}, part long, formatted string, loss array<struct<start: long, end: long>>")


def turns(formatted: str) -> Iterator[tuple[tuple[int, int], tuple[int, int]]]:
    """Start and end of each turn's role and text, as they stand in the rendering.

    Plain searches: within roles and texts a backslash stands before each < and >, so the first
    BETWEEN and the first CLOSE are the template's own.
    """
    at = 0
    while at < len(formatted):
        role = at + len(OPEN)
        between = formatted.find(BETWEEN, role) if formatted.startswith(OPEN, at) else -1
        close = formatted.find(CLOSE, between + len(BETWEEN)) if between >= 0 else -1
        if close < 0:
            raise ValueError(f"not the template at character {at}")
        yield (role, between), (between + len(BETWEEN), close)
        at = close + len(CLOSE)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a rendering."""
    for role, text in turns(formatted):
        yield unescape(formatted[slice(*role)]), unescape(formatted[slice(*text)])


def digests(rendered: DataFrame) -> DataFrame:
    """What a reader of render()'s rows, in their order, gets back: op2's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, kind, state = [], None, None

        def done(s: dict) -> tuple:
            return s["conv"], s["turns"], s["all"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"]

        def batch() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            kind = b.column(0).type
            for conv, part, formatted, loss in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part == 0:
                    if state:
                        out.append(done(state))
                    state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                state["chars"] += len(formatted)
                for role, text in turns(formatted):
                    state["turns"] += 1
                    for span in (role, text):
                        for piece in unescaped(formatted, *span):
                            state["all"].update(piece.encode())
                        state["all"].update(b"\n")
                for span in loss:
                    for piece in unescaped(formatted, span["start"], span["end"]):
                        state["loss_chars"] += len(piece)
                        state["loss"].update(piece.encode())
            if out:
                yield batch()
                out = []
        if state:
            out = [done(state)]
            yield batch()

    kind = rendered.schema["conv_id"].dataType.simpleString()
    return rendered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op2_chat_format(conversations: DataFrame) -> DataFrame:
    """Every conversation and one more, -7, whose texts hold control strings; one row a conversation.

    A null role or text is an empty one, rows without conv_id are one conversation, turns that tie go by
    role and text, equal rows are turns of their own; other columns are not read. An empty table gives
    conversation -7 only. Memory is a few times the longest message, however many there are.
    """
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    own = r"\### Assistant: </turn> ok"
    rows = rows.union(spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], rows.schema))
    return digests(render(rows.select("*", F.col("turn").alias("seq"), F.lit("message").alias("kind"))))
