"""Repair of conversation structure by weighted interval parsing.

A repaired conversation has role initials of the form ``(s?(ua)+)?``. The
grammar, in Chomsky normal form, has a symbol ``[pq]`` for each pair of places
of that form (``b`` before anything, ``s`` after a system turn, ``u`` after a
user turn, ``f`` after a full exchange), binary rules ``[pq] -> [pr][rq]``, and
terminal rules for keeping, re-roling and deleting a row. Inserted turns are
symbols over empty spans; the insertion closure puts them beside every
terminal. A cell holds for each symbol the least (cost, audit) over its span,
and cells are combined bottom-up by span length.

Audits of one span and cost are never prefixes of each other (a longer one has
more insertions, which cost more), so the least audit of a span is made of the
least audits of its parts. Every derivation passes each boundary between rows
at some place, so the cell of a span is the same from any one of its splits.
That lets a chart of all spans cover ``CHART`` rows, and longer stretches be
combined from cells of doubling length.

Rows are range-partitioned and sorted by conversation and turn. A task parses
each stretch of a conversation that it reads to one cell, and a conversation's
few cells, one per partition, meet in a second step. So a conversation with
a third of all rows is cut over many tasks; one task then joins its audit,
which is one string of the result. Rows equal in everything are counted
before they are dealt: their repeats are duplicates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import arrow_schema, in_slices, sql_type
from simpairs.session import materialize, ship_package

DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5
CHART = 8
WORD = r"[^\x20\x09-\x0D]"

#: Places of ``(s?(ua)+)?`` and the turns between them.
STEPS = {("b", "s"): "s", ("b", "u"): "u", ("s", "u"): "u", ("f", "u"): "u", ("u", "f"): "a"}
ROLES = {"u": "user", "a": "assistant"}
SYMBOLS = ("bb", "bs", "bu", "bf", "ss", "su", "sf", "uu", "uf", "fu", "ff")
RULES = tuple((x, x[0] + r, r + x[1]) for x in SYMBOLS for r in "bsuf" if x[0] + r in SYMBOLS and r + x[1] in SYMBOLS)
LEGAL = ("su", "ua", "au")

Cell = dict[str, tuple[int, str]]


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of a span from the cells of its two parts."""
    out: Cell = {}
    for x, a, b in RULES:
        if a in left and b in right:
            found = (left[a][0] + right[b][0], left[a][1] + right[b][1])
            if x not in out or found < out[x]:
                out[x] = found
    return out


def _empty() -> Cell:
    """Insertions over an empty span: the closure of one inserted turn under the binary rules."""
    cell = {p + p: (0, "") for p in "bsuf"}
    one = cell | {p + q: (INSERT, "I") for (p, q), turn in STEPS.items() if turn in ROLES}
    while one != cell:
        cell, one = one, combined(one, one)
    return cell


EMPTY = _empty()


def leaf(initial: str, must_go: bool, unfinished: bool) -> Cell:
    """The cell of one row, closed under insertions on both sides."""
    cell = {p + p: (DELETE, "D") for p in "bsuf"}
    if not must_go:
        more = UNFINISHED if unfinished else 0
        for (p, q), turn in STEPS.items():
            if turn == initial:
                cell[p + q] = (more, "K")
            elif turn in ROLES:
                cell[p + q] = (REROLE + more, "R")
    return combined(combined(EMPTY, cell), EMPTY)


def deleted(n: int) -> Cell:
    """The cell of ``n`` rows that all must go: deletions come first in the least audit."""
    return combined({p + p: (DELETE * n, "D" * n) for p in "bsuf"}, EMPTY)


def parsed(leaves: list[Cell]) -> Cell:
    """Chart over all spans of a few rows, shortest first; each span from all its splits."""
    n = len(leaves)
    chart = {(i, i + 1): leaves[i] for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best: Cell = {}
            for k in range(i + 1, i + length):
                for x, found in combined(chart[i, k], chart[k, i + length]).items():
                    if x not in best or found < best[x]:
                        best[x] = found
            chart[i, i + length] = best
    return chart[0, n]


class Stretch:
    """Counts and cell of consecutive rows of a conversation."""

    FIELDS = ("rows", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")

    def __init__(self, values=(0, 0, 0, 0, 0, None, None, None, None, 0)):
        self.rows, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.low, self.high, self.turns = values
        self.leaves: list[Cell] = []
        self.spans: list[tuple[int, Cell]] = []  # cells of falling size

    def add(self, turn, role: str, fault: str, copies: int) -> None:
        initial = role[:1]
        self.join(Stretch((copies, copies if fault == "blank" else 0, copies - 1 if fault != "blank" else 0, 0,
                           0 if initial + initial in LEGAL else copies - 1, initial, initial, turn, turn, 0 if turn is None else 1)))
        if fault == "duplicate":
            self.duplicate += 1
        if fault == "truncated":
            self.truncated += 1
        if fault in ("blank", "duplicate"):
            self._span(deleted(copies))
        else:
            self._leaf(leaf(initial, False, fault == "truncated"))
            if copies > 1:
                self._span(deleted(copies - 1))

    def join(self, after: Stretch) -> None:
        """Counts of this stretch and the one after it."""
        if self.rows and after.rows:
            self.illegal += self.last + after.first not in LEGAL
        self.first = self.first if self.rows else after.first
        self.last = after.last if after.rows else self.last
        self.turns += after.turns - (self.high is not None and self.high == after.low)
        self.low = after.low if self.low is None else self.low
        self.high = self.high if after.high is None else after.high
        for f in ("rows", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, f, getattr(self, f) + getattr(after, f))

    def _leaf(self, cell: Cell) -> None:
        self.leaves.append(cell)
        if len(self.leaves) == CHART:
            self._chart()

    def _chart(self) -> None:
        if self.leaves:
            self._push(parsed(self.leaves))
            self.leaves = []

    def _span(self, cell: Cell) -> None:
        if len(cell["bb"][1]) == 1:
            self._leaf(cell)
        else:
            self._chart()
            self._push(cell)

    def _push(self, cell: Cell) -> None:
        self.spans.append((len(cell["bb"][1]), cell))
        while len(self.spans) > 1 and self.spans[-2][0] <= 2 * self.spans[-1][0]:
            (m, left), (n, right) = self.spans[-2:]
            self.spans[-2:] = [(m + n, combined(left, right))]

    def cell(self) -> Cell:
        self._chart()
        out = EMPTY
        for _, cell in reversed(self.spans):
            out = combined(cell, out)
        return out

    def values(self) -> tuple:
        return tuple(getattr(self, f) for f in self.FIELDS)


# ------------------------------------------------------------------ rows and their faults

def faults(rows: DataFrame) -> DataFrame:
    """Distinct ``(conv_id, turn, role, text, copies, fault)``; null roles and texts are one space.

    The first fault of blank, duplicate (the conversation has the role and text
    in an earlier row), truncated (no full stop at the end); none is ''.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    r = (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
         .groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")))
    digest = F.unhex(F.sha2(F.col("text"), 256))
    r = materialize(r.withColumn("digest", digest).withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), "turn")))
    firsts = (r.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first"))
              .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    end = F.regexp_extract("text", rf"({WORD})[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(~F.col("text").rlike(WORD), "blank").when(F.col("at") != F.col("first"), "duplicate")
             .when(~end.isin(".", "!", "?"), "truncated").otherwise(""))
    return r.join(firsts, same).select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


_STRETCH = ("rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
            "low long, high long, turns long")
_PARSED = ("part int, at long, role string, text string, " + _STRETCH
           + ", costs array<long>, audits array<string>")


def _parse(schema: pa.Schema):
    """Rows with their place in the stretch that this task reads, and one row with the cell of each stretch."""
    def parse(batches):
        from pyspark import TaskContext

        part, now, stretch = TaskContext.get().partitionId(), None, None
        none = (None,) * 12

        def rows():
            nonlocal now, stretch
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "fault")]
                for conv, turn, role, text, copies, fault in zip(*columns):
                    if stretch is None or conv != now:
                        if stretch is not None:
                            yield done()
                        now, stretch = conv, Stretch()
                    if fault not in ("blank", "duplicate"):  # others are never kept
                        yield (conv, part, stretch.rows, role, text, *none)
                    stretch.add(turn, role, fault, copies)
            if stretch is not None:
                yield done()

        def done():
            cell = stretch.cell()
            return (now, part, None, None, None, *stretch.values(), [cell.get(x, (None,))[0] for x in SYMBOLS],
                    [cell.get(x, (None, None))[1] for x in SYMBOLS])

        yield from in_slices(rows(), schema, weigh=lambda r: len(r[4] or "") + sum(len(a or "") for a in r[-1] or ()))

    return parse


_FINISHED = ("part int, at long, sub int, role string, inserted boolean, gaps long, blank long, duplicate long, truncated long, "
             "illegal long, cost long, audit string")


def _turns(start: str, stop: str, audit: str) -> Iterator[tuple[int, int, str | None, bool]]:
    """``(at, sub, role, inserted)`` of the turns an audit leaves between two places; a None role is the row's own.

    Turns alternate, so their number tells whether the first one is a system turn.
    """
    n = len(audit) - audit.count("D")
    system = start == "b" and (stop == "s" or n % 2 == (stop == "f"))
    user, at, sub = start != "u", 0, 0
    for e in audit:
        if e != "D":
            yield at, sub, None if e == "K" else ROLES["u" if user else "a"], e == "I"
            user, system, sub = system or not user, False, sub + 1
        if e != "I":
            at, sub = at + 1, 0


def _finish(schema: pa.Schema):
    """The report of each conversation and the turns that stay, from its cells in order."""
    def conversation(conv, cells):
        whole, ends, came = Stretch(), {"b": (0, "")}, []
        for _, stretch, cell in cells:
            whole.join(stretch)
            ways: dict[str, tuple] = {}
            for x, (cost, audit) in cell.items():
                if x[0] in ends:
                    way = (ends[x[0]][0] + cost, ends[x[0]][1] + audit, x[0])
                    ways[x[1]] = min(way, ways.get(x[1], way))
            came.append({q: way[2] for q, way in ways.items()})
            ends = {q: way[:2] for q, way in ways.items()}
        cost, audit, stop = min((*ends[q], q) for q in "bf" if q in ends)
        gaps = 0 if whole.high is None else whole.high - whole.low + 1 - whole.turns
        yield (conv, None, None, None, None, None, gaps, whole.blank, whole.duplicate, whole.truncated, whole.illegal, cost, audit)
        places = [stop]
        for way in reversed(came):
            places.append(way[places[-1]])
        places.reverse()
        for (part, _, cell), start, stop in zip(cells, places, places[1:]):
            for at, sub, role, inserted in _turns(start, stop, cell[start + stop][1]):
                yield (conv, part, at, sub, role, inserted, *(None,) * 7)

    def finish(batches):
        def rows():
            now, cells = None, []
            for batch in batches:
                for row in batch.to_pylist():
                    if cells and row["conv_id"] != now:
                        yield from conversation(now, cells)
                        cells = []
                    now = row["conv_id"]
                    cell = {x: (c, a) for x, c, a in zip(SYMBOLS, row["costs"], row["audits"]) if c is not None}
                    cells.append((row["part"], Stretch(tuple(row[f] for f in Stretch.FIELDS)), cell))
            if cells:
                yield from conversation(now, cells)

        yield from in_slices(rows(), schema, weigh=lambda r: len(r[-1] or ""))

    return finish


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(report, turns)`` of conversations ``(conv_id, turn, role, text)``.

    ``report`` has a row per conversation: ``gaps`` (missing turn numbers
    between the least and greatest), rows by first fault ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` (neighbours whose role initials
    are not su, ua or au), and the ``cost`` and ``audit`` of the cheapest
    edits, ties to the least audit. ``turns`` holds the repaired conversations,
    ``(conv_id, part, at, sub, role, text)``, in the order of ``part, at, sub``.

    Rows are ordered by turn (nulls first), then role and text. Null roles and
    texts are one space; null ids are one conversation; an initial other than
    s, u and a, and an empty role, can only be re-roled or deleted. Repeated
    rows are duplicates. A null turn counts for no gap. An empty table gives
    two empty tables. Extra columns are ignored.
    """
    spark = rows.sparkSession
    ship_package(spark)
    key = f"conv_id {sql_type(rows, 'conv_id')}, "
    order = ("conv_id", "turn", "role", "text")
    dealt = materialize(faults(rows)).repartitionByRange(*order).sortWithinPartitions(*order)
    done = materialize(dealt.mapInArrow(_parse(arrow_schema(key + _PARSED, spark)), key + _PARSED))
    cells = (done.filter("costs IS NOT NULL").drop("at", "role", "text")
             .repartition("conv_id").sortWithinPartitions("conv_id", "part"))
    out = materialize(cells.mapInArrow(_finish(arrow_schema(key + _FINISHED, spark)), key + _FINISHED))
    report = out.filter("audit IS NOT NULL").select("conv_id", *REPORT)
    kept = done.filter("at IS NOT NULL").select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("at").alias("_a"),
                                                F.col("role").alias("own"), "text")
    edits = out.filter("audit IS NULL").select("conv_id", "part", "at", "sub", "role", "inserted")
    same = (F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")) & (F.col("at") == F.col("_a")) & ~F.col("inserted"))
    turns = edits.join(kept, same, "left").select(
        "conv_id", "part", "at", "sub", F.coalesce("role", "own").alias("role"),
        F.when(F.col("inserted"), "").otherwise(F.col("text")).alias("text"))
    return report, turns


def _line_digests(schema: pa.Schema):
    def digests(batches):
        def rows():
            now, digest = None, None
            for batch in batches:
                for conv, role, text in zip(*(batch.column(c) for c in ("conv_id", "role", "text"))):
                    conv = conv.as_py()
                    if digest is None or conv != now:
                        if digest is not None:
                            yield now, digest.hexdigest()
                        now, digest = conv, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{role.as_py()}:{text.as_py()}".encode())
            if digest is not None:
                yield now, digest.hexdigest()

        yield from in_slices(rows(), schema)

    return digests


def line_digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: SHA-256 of the ``role:text`` lines of each conversation, read as a stream."""
    ddl = f"conv_id {sql_type(turns, 'conv_id')}, repaired_sha256 string"
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at", "sub")
    return dealt.select("conv_id", "role", "text").mapInArrow(_line_digests(arrow_schema(ddl, turns.sparkSession)), ddl)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` with every 20th each dropped, emptied, stripped of full stops, repeated, made a user's.

    The CRC-32 of ``conv_id:turn`` decides; nulls are one space, in it and in roles and texts.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    r = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_kind")).filter("_kind != 0")
    text = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    times = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return (r.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                     text.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("_n")).drop("_n"))
