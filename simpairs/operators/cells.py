"""Pairs that are scored where they meet: what scores a key travels with its buckets.

The rows of a bucket are dealt into blocks and cells of two blocks meet, as in
``pairs.bucket_pairs``. But a key's row brings its payload along (a signature, a
vector) and digests of its other buckets, a pair is scored inside its cell, in
NumPy, and leaves it only if it passes, and only from the first bucket that
both keys share. So nothing is shuffled by pair or by pair and feature: what is
sent grows with the keys and their buckets. A task holds one cell's rows and
the pairs of two tiles of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.session import materialize, ship_package

#: Rows of a block, and of the tiles in which a cell is worked off.
MAX_BLOCK, TILE = 1024, 256
#: Pairs that leave a task at a time, and columns of a dense tile.
AT_ONCE, COLUMNS = 1 << 16, 1024
#: A longer vector does not travel: pairs of such keys are met here and scored by joins.
MAX_FEATURES = 4096


# ------------------------------------------------------------------ in a task

class _Rows:
    """Whole cells of sorted rows: keys, place of each row, digests of its buckets, payload."""

    def __init__(self, table: pa.Table, starts: np.ndarray, tables: int):
        self.table, n = table, table.num_rows
        self.key = table.column("key")
        self.cell = np.cumsum(starts)
        self.side = table.column("side").to_numpy()
        self.split = table.column("split").to_numpy(zero_copy_only=False)
        self.tbl = table.column("tbl").to_numpy()
        self.plain = table.column("plain").to_numpy(zero_copy_only=False)
        at, codes = table.column("tables").combine_chunks(), table.column("codes").combine_chunks()
        # a bucket of one row is left out; no two rows are alike there
        self.codes = np.repeat(-1 - np.arange(n, dtype=np.int64)[:, None], tables, axis=1)
        self.codes[np.repeat(np.arange(n), at.value_lengths().to_numpy(zero_copy_only=False)),
                   at.flatten().to_numpy(zero_copy_only=False)] = codes.flatten().to_numpy(zero_copy_only=False)

    def lists(self, name: str) -> tuple[np.ndarray, pa.Array]:
        """Row numbers and values of a list column; nulls are empty."""
        column = self.table.column(name).combine_chunks()
        n = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(len(column)), n), column.flatten()

    def first_shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.codes[a] == self.codes[b]).argmax(axis=1) == self.tbl[a]


def _whole_cells(batches, tables: int, at_least: int):
    """The stream cut between cells into ``_Rows`` of ``at_least`` rows or one cell."""
    held: list[pa.RecordBatch] = []

    def cut(last: bool):
        table = pa.Table.from_batches(held).combine_chunks()
        starts = np.zeros(table.num_rows, bool)
        starts[0] = True
        for name in ("tbl", "bucket", "i", "j"):
            c = table.column(name).combine_chunks()
            starts[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        end = table.num_rows if last else int(np.flatnonzero(starts)[-1])
        held[:] = table.slice(end).to_batches()
        return _Rows(table.slice(0, end), starts[:end], tables) if end else None

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= at_least:
            rows = cut(False)
            if rows is not None:
                yield rows
    if held:
        yield cut(True)


def _meeting(rows: _Rows):
    """Tiles ``(p, q, mask)`` of rows whose pairs meet: every pair of a cell in one tile, left row first."""
    n = len(rows.cell)
    for p in range(0, n, TILE):
        a = slice(p, min(p + TILE, n))
        for q in range(p, n, TILE):
            if rows.cell[q] > rows.cell[a.stop - 1]:
                break
            b = slice(q, min(q + TILE, n))
            mask = rows.cell[a][:, None] == rows.cell[b][None, :]
            mask &= ~rows.split[a][:, None] | (rows.side[a][:, None] != rows.side[b][None, :])
            if p == q:
                mask = np.triu(mask, 1)
            yield a, b, mask


def _cells(tables: int, prepare: Callable | None, names: list[str], types: list, once: bool):
    def run(batches):
        out, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.concat_arrays([o[i] for o in out]) for i in range(len(out[0]))],
                                              names=["x", "y", "plain", *names])

        for rows in _whole_cells(batches, tables, 2 * TILE):
            score = prepare(rows) if prepare else None
            keys = rows.key.combine_chunks()
            for p, q, mask in _meeting(rows):
                both = rows.plain[p][:, None] & rows.plain[q][None, :]
                for plain in (True, False):
                    met = mask & both if plain else mask & ~both
                    if not met.any():
                        continue
                    if plain and score:
                        a, b, columns = score(p, q, met)
                    else:
                        a, b = np.nonzero(met)
                        a, b, columns = a + p.start, b + q.start, None
                    for lo in range(0, len(a), AT_ONCE):
                        x, y = a[lo:lo + AT_ONCE], b[lo:lo + AT_ONCE]
                        keep = rows.first_shared(x, y) if once and plain else np.ones(len(x), bool)
                        x, y = x[keep], y[keep]
                        if not len(x):
                            continue
                        scores = [pa.array(c[lo:lo + AT_ONCE][keep], t) for c, t in zip(columns, types, strict=True)] if columns is not None \
                            else [pa.nulls(len(x), t) for t in types]
                        out.append([keys.take(pa.array(x)), keys.take(pa.array(y)), pa.array(np.full(len(x), plain)), *scores])
                        size += len(x)
                        if size >= AT_ONCE:
                            yield flush()
                            out, size = [], 0
        if out:
            yield flush()

    return run


# ------------------------------------------------------------------ scores

def _pair_list(measure: Callable):
    """A score of row pairs as a score of tiles: ``measure(a, b)`` gets row numbers."""
    def score(p, q, met):
        a, b = np.nonzero(met)
        a, b = a + p.start, b + q.start
        parts = [measure(a[lo:lo + AT_ONCE], b[lo:lo + AT_ONCE]) for lo in range(0, len(a), AT_ONCE)]
        return a, b, [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0)]

    return score


def list_measure(name: str, dim: int, measure: Callable, dtype):
    """Score of two matrices of the list column ``name`` (``dim`` values a row); ``measure`` returns a list of columns."""
    def prepare(rows: _Rows):
        at, values = rows.lists(name)
        x = np.zeros((len(rows.cell), dim), dtype)
        # rows without a payload are not plain and never scored
        x[np.unique(at)] = values.to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dim)
        return _pair_list(lambda a, b: measure(x[a], x[b]))

    return prepare


def sparse_measure(score: Callable, least: float):
    """Score ``score(dot, n_a, nn_a, n_b, nn_b)`` of sparse vectors, from ``least`` on; columns ``dot`` and the score."""
    def prepare(rows: _Rows):
        at, items = rows.lists("items")
        weights = rows.lists("weights")[1].to_numpy(zero_copy_only=False)
        coded = items.dictionary_encode()
        dims, code = len(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        n = rows.table.column("n").to_numpy(zero_copy_only=False).astype(np.float64)
        nn = rows.table.column("nn").to_numpy(zero_copy_only=False).astype(np.float64)

        def dense(s: slice, lo: int) -> np.ndarray:
            first, last = np.searchsorted(at, [s.start, s.stop])
            r, c, w = at[first:last] - s.start, code[first:last] - lo, weights[first:last]
            if dims > COLUMNS:
                inside = (c >= 0) & (c < COLUMNS)
                r, c, w = r[inside], c[inside], w[inside]
            x = np.zeros((s.stop - s.start, min(COLUMNS, dims)))
            x[r, c] = w
            return x

        whole = dense(slice(0, len(rows.cell)), 0) if dims <= COLUMNS else None

        def of(p, q, met):
            if whole is not None:
                dot = whole[p] @ whole[q].T
            else:
                dot = np.zeros(met.shape)
                for lo in range(0, dims, COLUMNS):
                    dot += dense(p, lo) @ dense(q, lo).T
            with np.errstate(invalid="ignore", divide="ignore"):
                s = score(dot, n[p][:, None], nn[p][:, None], n[q][None, :], nn[q][None, :])
                a, b = np.nonzero(met & (s >= least))
            return a + p.start, b + q.start, [dot[a, b], s[a, b]]

        return of

    return prepare


def cosine_of(dot, n_a, nn_a, n_b, nn_b):
    return dot / np.sqrt(nn_a * nn_b)


def jaccard_of(dot, n_a, nn_a, n_b, nn_b):
    return dot / (n_a + n_b - dot)


def bincos_of(dot, n_a, nn_a, n_b, nn_b):
    return dot / np.sqrt(n_a * n_b)


# ------------------------------------------------------------------ Spark side

def sparse_payload(vec: DataFrame, feature: str = "item", weight: str | None = "w") -> DataFrame:
    """``(key, n, nn, items, weights)``: one row per key; no lists for keys of more than ``MAX_FEATURES`` rows."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = vec.filter("key IS NOT NULL").select("key", F.col(feature).alias("_f"), w.alias("_w"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("_w") * F.col("_w")).alias("nn"))
    small = sizes.filter(F.col("n") <= F.lit(MAX_FEATURES)).select("key")
    lists = (rows.filter("_f IS NOT NULL").join(small, "key", "left_semi").groupBy("key")
             .agg(F.collect_list(F.struct("_f", "_w")).alias("_l")))
    return sizes.join(lists, "key", "left").select("key", "n", "nn", F.col("_l._f").alias("items"), F.col("_l._w").alias("weights"))


def _placed(rows: DataFrame, sizes: DataFrame, payload: DataFrame | None, fits, once: bool) -> DataFrame:
    """One row per key: its buckets with the blocks of both sides, digests of them, and its payload."""
    place = F.struct("tbl", "bucket", "blocks", "others", F.xxhash64("bucket").alias("h"))
    keyed = (rows.join(sizes, ["tbl", "bucket"]).groupBy("key").agg(F.sort_array(F.collect_list(place)).alias("_p")))
    if once:
        plain = F.size(F.array_distinct(F.col("_p.tbl"))) == F.size("_p")
        keyed = keyed.select("key", "_p", F.col("_p.tbl").alias("tables"), F.col("_p.h").alias("codes"), plain.alias("plain"))
    else:
        none = F.array().cast("array<int>"), F.array().cast("array<bigint>")
        keyed = keyed.select("key", "_p", none[0].alias("tables"), none[1].alias("codes"), F.lit(True).alias("plain"))
    if payload is None:
        return keyed
    fit = F.lit(True) if fits is None else F.coalesce(fits, F.lit(False))
    return keyed.join(payload, "key").withColumn("plain", F.col("plain") & fit)


def _in_cells(placed: DataFrame, side: int, split: bool, columns: list[str]) -> DataFrame:
    """The rows of each key in the cells of its buckets."""
    # the payload is exploded with the buckets, and sent once to each of its cells
    at = placed.select("*", F.explode("_p").alias("_b")).select(
        "key", "tables", "codes", "plain", *columns, F.col("_b.tbl").alias("tbl"), F.col("_b.bucket").alias("bucket"),
        F.col("_b.others").alias("_n"), F.pmod(F.xxhash64("key"), F.col("_b.blocks")).cast("int").alias("_own"))
    last = F.col("_n") - 1
    if split:  # two tables: the left block is i, the right one j
        own, other = ("i", "j") if side == 0 else ("j", "i")
        return at.select("*", F.col("_own").alias(own), F.explode(F.sequence(F.lit(0), last)).alias(other),
                         F.lit(side).alias("side"), F.lit(True).alias("split")).drop("_own", "_n")
    cell = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(F.least("_own", k).alias("i"), F.greatest("_own", k).alias("j")))
    return at.select("*", F.explode(cell).alias("_c")).select(
        "*", F.col("_c.i").alias("i"), F.col("_c.j").alias("j"), F.when(F.col("_own") == F.col("_c.i"), 0).otherwise(1).alias("side"),
        (F.col("_c.i") != F.col("_c.j")).alias("split")).drop("_own", "_n", "_c")


def _run(cells: DataFrame, tables: int, prepare, scores: dict[str, str], once: bool) -> DataFrame:
    ship_package(cells.sparkSession)
    kinds = {"double": pa.float64(), "long": pa.int64()}
    kind = cells.schema["key"].dataType.simpleString()
    ddl = f"x {kind}, y {kind}, plain boolean" + "".join(f", {c} {t}" for c, t in scores.items())
    place = ["tbl", "bucket", "i", "j"]
    return (cells.repartition(*place).sortWithinPartitions(*place, "side")
            .mapInArrow(_cells(tables, prepare, list(scores), [kinds[t] for t in scores.values()], once), ddl))


def met_pairs(rows: DataFrame, tables: int, payload: DataFrame | None = None, fits=None, prepare=None,
              scores: dict[str, str] | None = None, max_block: int = MAX_BLOCK) -> DataFrame:
    """``(x, y, plain, *scores)``: each pair of keys that share a bucket, once, in one order, with its scores.

    ``rows`` is ``(key, tbl, bucket)`` with ``tbl`` below ``tables``. ``payload``
    is ``(key, …)``; ``prepare`` makes the score of a cell's rows of it, which
    may drop pairs. Pairs with a key that has two buckets in a table, or whose
    payload does not satisfy ``fits``, are not ``plain``: they come unscored,
    once for each bucket that they share.
    """
    rows = materialize(rows.select("key", F.col("tbl").cast("int").alias("tbl"), "bucket").filter("key IS NOT NULL"))
    blocks = F.ceil(F.col("_n") / F.lit(max_block)).cast("int")
    sizes = (rows.groupBy("tbl", "bucket").agg(F.count("*").alias("_n")).filter("_n > 1")
             .select("tbl", "bucket", blocks.alias("blocks"), blocks.alias("others")))
    columns = [] if payload is None else [c for c in payload.columns if c != "key"]
    placed = _placed(rows, sizes, payload, fits, True)
    return _run(_in_cells(placed, 0, False, columns), tables, prepare, scores or {}, True).filter("x != y")


def crossed_pairs(left: DataFrame, right: DataFrame, tables: int, payload: DataFrame | None = None, fits=None, prepare=None,
                  scores: dict[str, str] | None = None, once: bool = True, max_block: int = MAX_BLOCK) -> DataFrame:
    """As ``met_pairs`` for two tables of rows: ``x`` is a key of ``left``, ``y`` one of ``right``.

    Without ``once`` a pair comes from each bucket that it shares; several
    buckets of a key in one table are plain then.
    """
    left, right = (materialize(s.select("key", F.col("tbl").cast("int").alias("tbl"), "bucket").filter("key IS NOT NULL"))
                   for s in (left, right))
    count = lambda df, name: (df.groupBy("tbl", "bucket").agg(F.ceil(F.count("*") / F.lit(max_block)).cast("int").alias(name)))
    sizes = materialize(count(left, "_m").join(count(right, "_n"), ["tbl", "bucket"]))
    columns = [] if payload is None else [c for c in payload.columns if c != "key"]
    sides = []
    for k, (rows, own, other) in enumerate(((left, "_m", "_n"), (right, "_n", "_m"))):
        sides.append(_in_cells(_placed(rows, sizes.select("tbl", "bucket", F.col(own).alias("blocks"), F.col(other).alias("others")),
                                       payload, fits, once), k, True, columns))
    return _run(sides[0].unionByName(sides[1]), tables, prepare, scores or {}, once)


def canonical(met: DataFrame) -> DataFrame:
    """``x, y`` as ``u, v`` with the smaller key first; further columns stay."""
    more = [c for c in met.columns if c not in ("x", "y")]
    return met.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"), *more)


def sparse_pairs(rows: DataFrame, tables: int, vec: DataFrame, measure: Callable, joined: Callable, threshold: float | None = None,
                 feature: str = "item", weight: str | None = "w", probe: DataFrame | None = None,
                 max_block: int = MAX_BLOCK) -> DataFrame:
    """``(u, v, dot, score)`` of the keys of sparse vectors that share a bucket, from ``threshold`` on.

    ``vec`` is ``(key, feature[, weight])``, one row per key and feature;
    ``rows`` is ``(key, tbl, bucket)``, and ``probe`` rows of several buckets a
    table that look into those. Pairs with a key of more than ``MAX_FEATURES``
    features are scored by ``joined(pairs)``, which returns ``u, v, dot, score``.
    """
    payload = materialize(sparse_payload(vec, feature, weight))
    fits = F.col("n") <= F.lit(MAX_FEATURES)
    least = -np.inf if threshold is None else threshold - 1e-9
    more = (payload, fits, sparse_measure(measure, least), {"dot": "double", "score": "double"})
    met = canonical(met_pairs(rows, tables, *more, max_block=max_block) if probe is None else
                    crossed_pairs(probe, rows, tables, *more, once=False, max_block=max_block).filter("x != y"))
    met = met if probe is None else met.distinct()
    if payload.filter(~fits).first() is not None:
        met = materialize(met)
        rest = joined(materialize(met.filter("NOT plain").select("u", "v").distinct()))
        met = met.filter("plain").select("u", "v", "dot", "score").unionByName(rest.select("u", "v", "dot", "score"))
    met = met.select("u", "v", "dot", "score")
    return met if threshold is None else met.filter(F.col("score") >= F.lit(threshold))
