"""A stated query set against all rows, in cells of bounded size.

Rows are dealt into blocks, queries into chunks, and every (block, chunk) cell
is one cogrouped task over both. Rows are copied once per chunk and queries
once per block, or once per block they are routed to; the numbers of blocks and chunks follow from counts of all
rows, so a cell stays the same size however large the tables are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", nonzero: bool = False) -> DataFrame:
    """Distinct ``(vec_id, x array<double>)`` of rows with an id and a vector of finite components.

    ``nonzero`` also leaves out vectors of zeros only. Rows equal in id and
    vector are one row. Extra columns are left behind.
    """
    x = F.col(vector).cast("array<double>")
    rows = table.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).filter("vec_id IS NOT NULL AND x IS NOT NULL")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    rows = rows.filter(~F.exists("x", bad))
    if nonzero:
        rows = rows.filter(F.exists("x", lambda v: v != 0))
    return rows.distinct()


def in_cells(rows: DataFrame, n_blocks: int, queries: DataFrame, n_queries: int, chunk: int, function, schema: str) -> DataFrame:
    """``function(rows, queries)`` over Arrow tables of each cell.

    ``rows`` carries its ``block`` (0 … n_blocks − 1); queries are dealt into
    ``ceil(n_queries / chunk)`` chunks by ``query_id`` and ``query``. Queries
    that carry ``block`` too, one row per block, go nowhere else.
    """
    n_chunks = max(1, math.ceil(n_queries / chunk))
    # a cell is small in bytes and large in work: cells are not packed together by their bytes
    shuffled = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(1, n_blocks) * n_chunks, 8 * shuffled)
    left = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    right = queries.withColumn("chunk", F.pmod(F.xxhash64("query_id", "query"), F.lit(n_chunks)).cast("int"))
    if "block" not in queries.columns:
        right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(1, n_blocks) - 1))))
    left, right = (side.repartition(parts, "block", "chunk") for side in (left, right))
    return (left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
            .applyInArrow(lambda a, b: function(a, b), schema))


def matrix(column: pa.ChunkedArray, dim: int, dtype) -> np.ndarray:
    """Rows of a list column as a matrix of ``dim`` columns; shorter vectors end in zeros."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dim), dtype)
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def best(found: DataFrame, k: int, *query: str) -> DataFrame:
    """The ``k`` highest scores of each query, ties to the smaller ``vec_id``, with ``rank`` from 1."""
    order = Window.partitionBy(*query).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
