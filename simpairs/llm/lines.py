"""Line dedup: later repeats of line runs are deleted, found by winnowing.

A document is the sequence of its non-blank lines, hashed after trimming. A
run of lines is worth deleting from ``min_words`` words or ``min_lines`` lines
on; a line goes if any such run that holds it occurs earlier. It is enough to
look at runs of at most ``min_lines`` lines: a longer one is covered by them.

A window starts at every line and is the shortest run from there that is worth
deleting. Each window selects the place of its least line hash, and a document
emits one position per selected place, however many windows select it. Equal
windows select equal places, so whatever repeats shares a fingerprint, the hash
of the selected line, with its earlier occurrence.

Positions of fingerprints that occur once go first. The others are extended
both ways: each carries the runs whose window selected it, and positions meet
only where fingerprint and run agree, each run with its first occurrence (a
partial ``min``), never with each other. So every distinct continuation of a
fingerprint is compared, a very common line is spread by what stands around
it, and a passage in a third of all documents gives one match per document.
Overlapping runs make up the maximal ones.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm import common
from simpairs.session import materialize, ship_package

MIN_WORDS, MIN_LINES = 50, 3
POSITIONS = ("array<struct<fingerprint: long, place: int, runs: array<struct<start: int, x: long, y: long, lines: array<int>>>>>")


def _long(value: int) -> int:
    return value - (value >> 63 << 64)


def winnowed(hashes: list[int], words: list[int], min_words: int, min_lines: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(selected place, runs)`` of a document's lines; runs are ``(start, end)``, of at most ``min_lines`` lines.

    A run belongs to the place that the window at its start selects, the last
    of the least hashes.
    """
    out: list[tuple[int, list[tuple[int, int]]]] = []
    at: dict[int, int] = {}
    for start in range(len(hashes)):
        held, selected = 0, -1
        for end in range(start + 1, min(start + min_lines, len(hashes)) + 1):
            held += words[end - 1]
            if held < min_words and end - start < min_lines:
                continue
            if selected < 0:
                selected = min(range(start, end), key=lambda i: (hashes[i], -i))
                if selected not in at:
                    at[selected] = len(out)
                    out.append((selected, []))
            out[at[selected]][1].append((start, end))
    return out


def _parse(min_words: int, min_lines: int, schema: pa.Schema):
    def run(batches):
        from xxhash import xxh3_128_digest, xxh64_intdigest

        def rows(batch):
            for a, b, doc_id, text in zip(batch.column("a"), batch.column("b"), batch.column("doc_id"),
                                          common.byte_texts(batch.column("text"))):
                places, hashes, digests, words = [], [], [], []
                for place, line in enumerate((text or b"").split(b"\n")):
                    line = line.strip()
                    if line:
                        places.append(place)
                        hashes.append(xxh64_intdigest(line))
                        digests.append(xxh3_128_digest(line))
                        words.append(len(line.split()))
                found = []
                for selected, runs in winnowed(hashes, words, min_words, min_lines):
                    held = []
                    for start, end in runs:
                        d = xxh3_128_digest(b"".join(digests[start:end]))
                        held.append({"start": start, "x": int.from_bytes(d[:8], "big", signed=True),
                                     "y": int.from_bytes(d[8:], "big", signed=True), "lines": places[start:end]})
                    found.append({"fingerprint": _long(hashes[selected]), "place": selected, "runs": held})
                if found:
                    yield a.as_py(), b.as_py(), doc_id.as_py(), found

        for batch in batches:
            yield from common.in_slices(rows(batch), schema, 2000, weigh=lambda r: 100 * len(r[3]))

    return run


def repeated_lines(keyed: DataFrame, min_words: int = MIN_WORDS, min_lines: int = MIN_LINES) -> DataFrame:
    """``(a, b, removed array<int>)``: line numbers (from 0) to delete, of documents ``(a, b, doc_id, text)``."""
    spark = keyed.sparkSession
    ship_package(spark)
    ddl = f"a long, b long, doc_id {common.sql_type(keyed, 'doc_id')}, positions {POSITIONS}"
    parsed = materialize(keyed.select("a", "b", "doc_id", "text").mapInArrow(
        _parse(min_words, min_lines, common.arrow_schema(ddl, spark)), ddl))
    document = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "a", "b")
    positions = parsed.select(document.alias("document"), F.explode("positions").alias("p")).select(
        "document", "p.fingerprint", "p.place", "p.runs")
    spot = F.struct("document", "place")
    repeated = (positions.groupBy("fingerprint").agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
                .filter("first != last").select("fingerprint"))
    runs = materialize(positions.join(repeated, "fingerprint").select("document", "fingerprint", F.explode("runs").alias("r"))
                       .select("fingerprint", "r.x", "r.y", F.struct("document", "r.start").alias("spot"), "r.lines"))
    run = ["fingerprint", "x", "y"]
    # stored, so that the join is a plain one of two scans and a run with very many rows can be split
    firsts = materialize(runs.groupBy(*run).agg(F.min("spot").alias("first"), F.max("spot").alias("last"))
                         .filter("first != last").select(*run, "first"))
    later = runs.join(firsts, run).filter("spot != first")
    lines = F.array_sort(F.array_distinct(F.flatten(F.collect_set("lines"))))
    return materialize(later.groupBy(F.col("spot.document.a").alias("a"), F.col("spot.document.b").alias("b"))
                       .agg(lines.alias("removed")))


def _delete(batches):
    for batch in batches:
        kept, lines, gone = [], [], []
        for text, removed in zip(batch.column("text"), batch.column("removed")):
            text, removed = text.as_py(), set(removed.as_py() or ())
            split = [] if text is None else text.split("\n")
            lines.append(len(split))
            gone.append(len(removed))
            kept.append(text if not removed else "\n".join(l for n, l in enumerate(split) if n not in removed))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string()),
                                          pa.array(lines, pa.int64()), pa.array(gone, pa.int64())],
                                         names=["row", "kept", "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, min_lines: int = MIN_LINES,
                keep: tuple | None = None) -> DataFrame:
    """``(row, kept, n_lines, n_removed)``, one row per input row; ``row`` has the columns ``keep`` (default: all but text).

    ``kept`` is the text without its later repeats: every run of lines with at
    least ``min_words`` words or ``min_lines`` lines (blank ones do not count)
    that occurs earlier, in the same or any other document, goes whole.
    Earlier means by ``doc_id`` (null last, then by
    content) and line. The first occurrence of a line is never deleted. Rows
    equal in id and text are one document: all keep their lines or lose the
    same ones. Null texts stay null with 0 lines, empty ones stay empty. An
    empty table gives no rows.
    """
    columns = tuple(c for c in docs.columns if c != "text") if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "doc_id",
                       F.col("text").cast("string").alias("text"))
    key = common.row_key(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    keyed = rows.select("*", key.alias("key")).select("row", "doc_id", "text", "key.a", "key.b")
    removed = repeated_lines(keyed, min_words, min_lines)
    # a table of removed lines grows with the input: never broadcast, the same plan at every size
    joined = (keyed.select("row", "text", "a", "b").join(removed.hint("merge"), ["a", "b"], "left")
              .select("row", "text", "removed"))
    row = docs.select(*[F.col(f"`{c}`") for c in columns]).schema.simpleString()
    return joined.mapInArrow(_delete, f"row {row}, kept string, n_lines long, n_removed long")


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, min_lines: int = MIN_LINES) -> DataFrame:
    """The documents with their columns, later repeats of line runs deleted from the text.

    A column ``n_chars``, if there is one, follows the texts that lost lines.
    """
    out = dedup_lines(docs, min_words, min_lines)

    def column(c):
        if c == "text":
            return F.col("kept").alias(c)
        if c == "n_chars":
            kind = docs.schema[c].dataType
            return F.when(F.col("n_removed") > 0, F.char_length("kept").cast(kind)).otherwise(F.col("row")[c]).alias(c)
        return F.col("row")[c].alias(c)

    return out.select(*[column(c) for c in docs.columns])
