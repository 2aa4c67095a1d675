"""Packing of tokenised documents into fixed windows by best-fit decreasing.

A document is its token ids and one separator id. Overlong documents are cut
into full windows first; the rest of each document is one piece. Pieces are
placed longest first, each into the open window with the least remaining
capacity that holds it, or into a new one. A segment tree over the remaining
capacities answers that in logarithmic time.

Best fit leaves gaps where many pieces are a little longer than half a window.
The least filled windows are then dissolved, as many as the gaps of the others
hold, and their pieces are cut into those gaps, so most documents stay whole
and no window has more than ``SCRAP`` tokens of padding. What is left, less
than a window, joins the next pieces.

Each scan task packs the documents it reads: pieces never leave their task, so
nothing is shuffled. It packs some ``HELD`` tokens at a time and holds no more.
What is left at its end goes into sequences whose lengths are powers of two,
which need no padding, so the padding share stays below 1 % in any number of
tasks. Sequences are numbered by partition.
"""

from __future__ import annotations

import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame

from simpairs.llm import common, tokens
from simpairs.session import ship_package

WINDOW = 1024
#: tokens of rest pieces that a task packs at a time
HELD = 1 << 22
#: ids that a held piece counts for beside its own (its tuples take some 500 bytes), so very many short texts stay bounded
PIECE = 128
#: a gap of so many tokens, below 1 % of a window, is left: filling it would cut a document for a scrap
SCRAP = 8
COLUMNS = ("start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long")


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree of counts."""

    def __init__(self, window: int = WINDOW):
        self.size = 1 << window.bit_length()  # leaves for capacities 0 … window
        self.count = [0] * (2 * self.size)
        self.held: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, number: int) -> None:
        self.held[capacity].append(number)
        at = self.size + capacity
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """``(capacity, window)`` of the tightest window with ``need`` left; it is taken out."""
        at = self.size + need
        while not self.count[at]:
            while at & 1:  # a right child, or the root: nothing to the right below its parent
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.size:
            at *= 2
            at += not self.count[at]
        capacity = at - self.size
        number = self.held[capacity].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return capacity, number


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int], int]:
    """Window number and offset of pieces given longest first, and the number of windows."""
    tree, where, offsets, n = OpenWindows(window), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, n = (window, n), n + 1
        capacity, number = found
        where.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            tree.add(capacity - length, number)
    return where, offsets, n


def fill(pieces: list[tuple], window: int = WINDOW) -> tuple[list[list[tuple]], list[tuple]]:
    """Windows of ``(document, start, end)`` pieces, full but for a scrap, and the pieces that are left, less than a window."""
    pieces = sorted(pieces, key=lambda p: (p[1] - p[2], p[0], p[1]))
    where, _, n = best_fit_decreasing([end - start for _, start, end in pieces], window)
    windows: list[list[tuple]] = [[] for _ in range(n)]
    used = [0] * n
    for piece, w in zip(pieces, where):
        windows[w].append(piece)
        used[w] += piece[2] - piece[1]
    order = sorted(range(n), key=lambda w: (-used[w], w))
    done = sum(u >= window - SCRAP for u in used)
    full = done + sum(used[w] for w in order[done:]) // window
    loose = [piece for w in order[full:] for piece in windows[w]]
    loose.reverse()
    for w in order[done:full]:
        while used[w] < window:
            document, start, end = loose.pop()
            cut = min(end, start + window - used[w])
            windows[w].append((document, start, cut))
            used[w] += cut - start
            if cut < end:
                loose.append((document, cut, end))
    return [windows[w] for w in order[:full]], loose[::-1]


def tail(pieces: list[tuple], window: int = WINDOW) -> list[list[tuple]]:
    """Pieces of less than a window in sequences whose lengths are falling powers of two."""
    loose, out = pieces[::-1], []
    size = sum(end - start for _, start, end in pieces)
    while size:
        room = 1 << size.bit_length() - 1
        size -= room
        out.append([])
        while room:
            document, start, end = loose.pop()
            cut = min(end, start + room)
            out[-1].append((document, start, cut))
            room -= cut - start
            if cut < end:
                loose.append((document, cut, end))
    return out


def _packer(path: str, window: int, separator: int, schema: pa.Schema):
    def pack(batches):
        from pyspark import TaskContext

        encode = tokens.encoder(path).ids
        number = TaskContext.get().partitionId() << 36

        def rows(sequences, held):
            nonlocal number
            for sequence in sequences:
                offset = 0
                for document, start, end in sequence:
                    doc_id, before, ids, n = held[document]
                    crc = zlib.crc32(memoryview(ids).cast("B")[4 * start:4 * end])
                    yield doc_id, before + start, end - start, crc, n, number, offset
                    offset += end - start
                number += 1

        def pieces():
            nonlocal number
            held: list[tuple] = []  # (doc_id, ids before the rest, ids of the rest, ids of the document)
            loose: list[tuple] = []
            size = 0
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                    ids = array("I", encode(text.as_py() or ""))
                    ids.append(separator)
                    n, doc = len(ids), doc_id.as_py()
                    cut = n - n % window
                    data = memoryview(ids).cast("B")
                    for start in range(0, cut, window):
                        yield doc, start, window, zlib.crc32(data[4 * start:4 * (start + window)]), n, number, 0
                        number += 1
                    if cut < n:
                        held.append((doc, cut, ids[cut:], n))
                        loose.append((len(held) - 1, 0, n - cut))
                        size += n - cut + PIECE
                    if size >= HELD:
                        full, loose = fill(loose, window)
                        yield from rows(full, held)
                        # what is left begins the next list
                        held = [held[d] for d, _, _ in loose]
                        loose = [(i, start, end) for i, (_, start, end) in enumerate(loose)]
                        size = sum(end - start + PIECE for _, start, end in loose)
            full, loose = fill(loose, window)
            yield from rows(full, held)
            yield from rows(tail(loose, window), held)

        yield from common.in_slices(pieces(), schema)

    return pack


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, separator: int = 0) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    ``start`` counts the document's ids before the piece, ``offset`` the ids
    before it in its sequence (gapless from 0). ``sequence_id`` is unique, not
    dense. All sequences have ``window`` ids or up to ``SCRAP`` fewer, but for at
    most ten a task whose lengths are powers of two. A null or empty text is the separator alone; a null id is kept;
    repeated rows are packed each; a text of exactly ``window`` ids fills one
    window. An empty table gives no rows. Extra columns are ignored.
    """
    ship_package(docs.sparkSession)
    rows = common.documents(docs)
    ddl = f"doc_id {common.sql_type(rows, 'doc_id')}, {COLUMNS}"
    schema = common.arrow_schema(ddl, docs.sparkSession)
    return rows.mapInArrow(_packer(tokenizer or tokens.default_tokenizer(), window, separator, schema), ddl)
