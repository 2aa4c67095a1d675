"""Chat formatting from event logs.

A log has one row per event of a conversation, numbered by ``seq``: ``open``
(a message begins, with its role), ``delta`` (streamed text), ``edit`` (the
text so far is replaced), ``regenerate`` (the text so far is discarded and
streamed anew) and ``delete``. Logs are partitioned by conversation and
message and sorted by sequence; each message is folded as its events pass, so
a task holds one message, and a conversation with a third of all events is
spread by its messages. The final messages are then partitioned by
conversation, sorted by the sequence of their first event, and rendered, again
as they pass, into pieces of a bounded number of characters.

The template is ``<turn ROLE>``, newline, text, ``</turn>``, newline. In texts a
backslash is doubled and one more is put behind the ``<`` of ``<turn`` and
``</turn``, so neither control string occurs inside a text, and ``unescape``
restores it. The loss mask is a list of spans, in characters, that cover the
texts of assistant turns.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simpairs.llm.common import arrow_schema, in_slices, sql_type
from simpairs.session import ship_package

TRAINED = "assistant"
PIECE = 1 << 22
HEAD, TAIL = "<turn ", "</turn>\n"
_CONTROL = re.compile(r"\\|<(?=/?turn)")
_ESCAPED = re.compile(r"\\(\\?)")
_ROLE = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_ROLE_BACK = {v: k for k, v in _ROLE.items()}


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    """A doubled backslash is one, a single one goes."""
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and start and length of its text in it."""
    head = HEAD + "".join(_ROLE.get(c, c) for c in role) + ">\n"
    body = escape(text)
    return head + body + TAIL, len(head), len(body)


def parse(piece: str) -> list[tuple[str, str]]:
    """``(role, text)`` of the turns of a formatted piece."""
    turns = []
    for part in piece.split(TAIL)[:-1]:
        head, body = part.split(">\n", 1)
        role = re.sub(r"\\[\\lg]", lambda m: _ROLE_BACK[m.group()], head.removeprefix(HEAD))
        turns.append((role, unescape(body)))
    return turns


# ------------------------------------------------------------------ folding

class Message:
    """State of one message while its events pass."""

    def __init__(self, seq):
        self.seq, self.role, self.parts, self.there = seq, "", [], True

    def apply(self, kind: str, role: str | None, text: str | None) -> None:
        if kind == "open":
            self.role = role or ""
        elif kind == "edit":
            self.parts = []
        elif kind == "regenerate":
            self.parts, self.there = [], True
        elif kind == "delete":
            self.parts, self.there = [], False
        elif kind != "delta":
            raise ValueError(f"unknown kind of event: {kind!r}")
        if text:
            self.parts.append(text)


def _fold(schema: pa.Schema):
    def fold(batches):
        def rows():
            now, message, last = None, None, None
            for batch in batches:
                for conv, name, seq, kind, role, text in zip(*(batch.column(c).to_pylist() for c in (
                        "conv_id", "message", "seq", "kind", "role", "text"))):
                    if message is None or (conv, name) != now:
                        if message is not None and message.there:
                            yield now[0], message.seq, message.role, "".join(message.parts)
                        now, message, last = (conv, name), Message(seq), None
                    if seq != last:  # a redelivered event counts once
                        message.apply(kind, role, text)
                    last = seq
            if message is not None and message.there:
                yield now[0], message.seq, message.role, "".join(message.parts)

        yield from in_slices(rows(), schema, weigh=lambda r: len(r[3]))

    return fold


def messages(events: DataFrame) -> DataFrame:
    """``(conv_id, seq, role, text)``: the final messages of event logs.

    ``events`` is ``(conv_id, message, seq, kind, role, text)``, ``seq`` of any
    type that sorts and unique in a conversation; of several events with one number the first in the order
    of kind, role and text counts, nulls first, so a redelivered one counts
    once. ``message`` is any value that names the message. Null texts are
    empty, a message without ``open`` has an empty role, deleted messages have
    no row unless they are regenerated. An unknown kind fails the job.
    """
    ship_package(events.sparkSession)
    ddl = f"conv_id {sql_type(events, 'conv_id')}, seq {sql_type(events, 'seq')}, role string, text string"
    e = events.select("conv_id", F.col("message").cast("string").alias("message"), "seq", "kind", "role", "text")
    dealt = e.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", "seq", "kind", "role", "text")
    return dealt.mapInArrow(_fold(arrow_schema(ddl, events.sparkSession)), ddl)


# ------------------------------------------------------------------ rendering

_FORMATTED = "piece int, formatted string, loss array<struct<start:int,length:int>>"


def _render(schema: pa.Schema, size: int):
    def run(batches):
        def rows():
            now, number, parts, loss, n = None, 0, [], [], 0
            started = False
            for batch in batches:
                for conv, role, text in zip(*(batch.column(c) for c in ("conv_id", "role", "text"))):
                    conv = conv.as_py()
                    if started and (conv != now or n >= size):
                        yield now, number, "".join(parts), loss
                        number, parts, loss, n = number + 1, [], [], 0
                    if not started or conv != now:
                        now, number, started = conv, 0, True
                    role = role.as_py()
                    turn, start, length = render(role, text.as_py())
                    if role == TRAINED:
                        loss.append({"start": n + start, "length": length})
                    parts.append(turn)
                    n += len(turn)
            if started:
                yield now, number, "".join(parts), loss

        yield from in_slices(rows(), schema, weigh=lambda r: len(r[2]))

    return run


def format_chats(events: DataFrame, piece: int = PIECE) -> DataFrame:
    """``(conv_id, piece, formatted, loss)``: conversations as text, with the spans of the loss mask.

    Pieces of a conversation are numbered from 0 and end after the turn with
    which they reach ``piece`` characters; nearly all conversations are one
    piece. Spans count characters of their piece. Null ids are one
    conversation; messages of one sequence number go by role and text. An empty
    log gives no rows. Extra columns are ignored.
    """
    ddl = f"conv_id {sql_type(events, 'conv_id')}, {_FORMATTED}"
    dealt = messages(events).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "role", "text")
    return dealt.mapInArrow(_render(arrow_schema(ddl, events.sparkSession), piece), ddl)


# ------------------------------------------------------------------ reading back

_READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(schema: pa.Schema):
    def run(batches):
        def rows():
            now, state = None, None

            def done():
                n, turns, chars, loss, size = state
                return now, n, turns.hexdigest(), chars, loss.hexdigest(), size

            for batch in batches:
                for conv, formatted, spans in zip(*(batch.column(c) for c in ("conv_id", "formatted", "loss"))):
                    conv, formatted = conv.as_py(), formatted.as_py()
                    if state is None or conv != now:
                        if state is not None:
                            yield done()
                        now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for role, text in parse(formatted):
                        state[0] += 1
                        state[1].update(f"{role}\n{text}\n".encode())
                    for span in spans.as_py():
                        text = unescape(formatted[span["start"]:span["start"] + span["length"]])
                        state[2] += len(text)
                        state[3].update(text.encode())
                    state[4] += len(formatted)
            if state is not None:
                yield done()

        yield from in_slices(rows(), schema)

    return run


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of masked text of each conversation, from the formatted pieces alone.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``.
    Pieces pass in their order, one held at a time.
    """
    ddl = f"conv_id {sql_type(formatted, 'conv_id')}, {_READ}"
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return dealt.mapInArrow(_read(arrow_schema(ddl, formatted.sparkSession)), ddl)


# ------------------------------------------------------------------ a log from a table of turns

def as_events(rows: DataFrame, step: int = 200) -> DataFrame:
    """An event log that ends in the given turns ``(conv_id, turn, role, text)``.

    Each turn is opened and streamed in deltas of ``step`` characters. By a
    hash of the turn some first stream a draft that is regenerated, some are
    edited into their text, some are deleted and regenerated. Turns go by
    number (nulls first), then role and text; repeated rows are messages each.
    Null roles and texts are empty.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    r = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"))
    same = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    event = lambda kind, text=F.lit(None).cast("string"): F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    n = F.greatest(F.lit(1), F.ceil(F.length("text") / F.lit(step))).cast("int")
    deltas = F.transform(F.sequence(F.lit(0), n - 1),
                         lambda i: event("delta", F.substring(F.col("text"), i * step + 1, F.lit(step))))
    draft = event("delta", F.reverse(F.substring(F.col("text"), 1, 2 * step)))
    way = F.pmod(F.xxhash64("conv_id", "turn", "role"), F.lit(4))
    log = (F.when(way == 1, F.concat(F.array(event("open"), draft, event("regenerate")), deltas))
           .when(way == 2, F.array(event("open"), draft, draft, event("edit", F.col("text"))))
           .when(way == 3, F.concat(F.array(event("open"), draft, event("delete"), event("regenerate")), deltas))
           .otherwise(F.concat(F.array(event("open")), deltas)))
    return (r.withColumn("n", same).select("conv_id", "turn", "n", "role", F.posexplode(log).alias("i", "e"))
            .select("conv_id", F.concat_ws(":", "turn", "n").alias("message"), F.struct("turn", "n", "i").alias("seq"),
                    "e.kind", "role", "e.text"))
