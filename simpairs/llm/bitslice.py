"""Exact top-k by inner product over a bit-sliced index.

The components of a vector, quantised to integers, are attributes of its row.
An index block keeps one bitmap per attribute and binary digit (attributes
are shifted by their least value in the block, so no digit is negative). The
inner products of one query with all rows of a block come out bit-sliced too:
each digit of a query component adds the slices of that attribute, moved up by
the digit's place; slices of one place are added by carry-save adders, three
bitmaps to a sum and a carry. Negative digits add complements and correct by
a constant.

Top rows are then selected from the most significant slice downward: rows
with the bit set win while at most ``k`` of them are left, the others stay
candidates. What is left at the boundary are exact ties, resolved by id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm import cells
from simpairs.session import materialize, ship_package

FOUND = "query_id long, query long, vec_id long, score long"


class BitSlicedIndex:
    """Bitmaps of a block of integer rows, sorted by id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.n = len(ids)
        self.least = values.min(axis=0)
        shifted = values - self.least
        width = [int(x).bit_length() for x in shifted.max(axis=0)]
        self.attribute = np.repeat(np.arange(values.shape[1]), width)
        self.place = np.concatenate([np.arange(w) for w in width]) if width else np.zeros(0, np.int64)
        self.place = self.place.astype(np.int64)
        self.all = self._bitmap(np.ones(self.n, bool))
        slices = [self._bitmap(shifted[:, a] >> p & 1) for a, p in zip(self.attribute, self.place)]
        slices = np.array(slices, np.uint64).reshape(len(slices), len(self.all))
        # complements follow, so that a negative digit is an index further on
        self.slices = np.concatenate([slices, ~slices & self.all])

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits.astype(np.uint8), bitorder="little")
        return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of all inner products, least significant first, and the constant to add to them."""
        constant = int(sum(int(q) * int(x) for q, x in zip(query, self.least)))
        size, picked, places = np.abs(query), [], []
        negative = query < 0
        for digit in range(int(size.max()).bit_length() if len(query) else 0):
            at = np.flatnonzero((size >> digit & 1)[self.attribute])
            minus = negative[self.attribute[at]]
            place = self.place[at] + digit
            constant -= int((np.int64(1) << place[minus]).sum())
            picked.append(at + minus * len(self.attribute))
            places.append(place)
        if not picked:
            return [], constant
        index, place = np.concatenate(picked), np.concatenate(places)
        columns: list[list[np.ndarray]] = [[self.slices[index[place == p]]] for p in range(int(place.max()) + 1 if len(place) else 0)]
        out = []
        at = 0
        while at < len(columns):
            rows = np.concatenate(columns[at]) if len(columns[at]) > 1 else columns[at][0]
            carries = []
            while len(rows) > 1:
                third = len(rows) // 3
                if third:
                    a, b, c = rows[:third], rows[third:2 * third], rows[2 * third:3 * third]
                    half = a ^ b
                    carries.append((a & b) | (half & c))
                    rows = np.concatenate([half ^ c, rows[3 * third:]])
                else:
                    carries.append(rows[:1] & rows[1:])
                    rows = rows[:1] ^ rows[1:]
            out.append(rows[0] if len(rows) else np.zeros_like(self.all))
            if carries:
                if at + 1 == len(columns):
                    columns.append([])
                columns[at + 1] += carries
            at += 1
            if at < len(columns) and not columns[at]:
                columns[at] = [np.zeros((0, len(self.all)), np.uint64)]
        return out, constant

    def top(self, slices: list[np.ndarray], k: int, candidates: np.ndarray) -> np.ndarray:
        """Row numbers of the ``k`` largest sums among the candidates (a bitmap)."""
        sure, open_ = np.zeros_like(candidates), candidates
        for one in reversed(slices):
            won = sure | (open_ & one)
            n = int(np.bitwise_count(won).sum())
            if n > k:
                open_ = open_ & one
            else:
                sure, open_ = won, open_ & ~one
                if n == k:
                    return self._rows(sure, k)
        # all bits are equal at the boundary: rows are sorted by id, so the first ones are the smaller ids
        first = self._rows(sure, k)
        return np.concatenate([first, self._rows(open_, k - len(first))])

    def _rows(self, bitmap: np.ndarray, most: int) -> np.ndarray:
        words = np.flatnonzero(bitmap)[:most]  # each has at least one row
        bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(len(words), 8), axis=1, bitorder="little")
        word, bit = np.nonzero(bits)
        return (words[word] * 64 + bit)[:most]

    def sums(self, slices: list[np.ndarray], constant: int, rows: np.ndarray) -> list[int]:
        out = [constant] * len(rows)
        for p, one in enumerate(slices):
            bits = one[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)
            out = [x + (int(b) << p) for x, b in zip(out, bits)]
        return out


def _search(dim: int, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if rows.num_rows and queries.num_rows:
            index = BitSlicedIndex(rows["vec_id"].to_numpy(), cells.matrix(rows["x"], dim, np.int64))
            vectors = cells.matrix(queries["x"], dim, np.int64)
            for query_id, query, vector in zip(queries["query_id"].to_pylist(), queries["query"].to_pylist(), vectors):
                slices, constant = index.scores(vector)
                others = index.all & ~index._bitmap(index.ids == query_id)
                top = index.top(slices, k, others)
                out[0] += [query_id] * len(top)
                out[1] += [query] * len(top)
                out[2] += index.ids[top].tolist()
                out[3] += index.sums(slices, constant, top)
        return pa.table(out, schema=schema)

    return run


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, x array<long>)``: each component times ``scale``, rounded down."""
    return vectors.select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("x"))


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, block: int = 16_384, chunk: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the exact ``k`` highest integer inner products of each query.

    ``vectors`` is ``(vec_id, embedding)``, ``is_query`` a condition on
    ``vec_id``. Candidates are all rows but those of the query's id; ties go to
    the smaller id. Rows without an id, null vectors and vectors with null or
    non-finite components take no part; rows equal in id and vector are one;
    shorter vectors count as ended by zeros. Scores are longs: where the number
    of components times the square of the largest quantised one reaches 2^62,
    a ``ValueError`` says so before the search. Fewer candidates give fewer
    ranks; without rows or queries the result is empty.
    """
    ship_package(vectors.sparkSession)
    rows = materialize(quantised(cells.valid_vectors(vectors), scale))
    largest = F.aggregate("x", F.lit(0.0), lambda most, v: F.greatest(most, F.abs(v.cast("double"))))
    n, dim, most = rows.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0)), F.coalesce(F.max(largest), F.lit(0.0))).first()
    if dim * most * most >= 2.0 ** 62:
        raise ValueError(f"{dim} components of up to {most:.3g} steps may have inner products beyond a long; take a smaller scale than {scale}")
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("vec_id", "x").alias("query"), "x")
    n_blocks = max(1, math.ceil(n / block))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.lit(n_blocks)).cast("int"))
    found = cells.in_cells(dealt, n_blocks, queries, queries.count(), chunk, _search(dim, k), FOUND)
    return cells.best(found, k, "query_id", "query").select("query_id", "rank", "vec_id", "score")
