"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of a documents table; every other column is left behind.

    Operators take only the columns they need, so extra columns of the input,
    whatever their names, cannot clash with their own.
    """
    return docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))


def sql_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def no_nulls(text: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def row_key(df: DataFrame) -> Column:
    """128-bit key of a row by all its columns (maps aside), as a struct of two longs.

    Equal rows share it; a null differs from any value.
    """
    columns = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() != "map"]
    flags = [c.isNull() for c in columns]
    return F.struct(F.xxhash64(F.lit(1), *columns, *flags).alias("a"),
                    F.xxhash64(F.lit(2), *reversed(columns), *flags).alias("b"))


def drawn(share: float, *columns: str) -> Column:
    """True for a share of all rows, by a hash of the columns; fine enough for one row in 10^18."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2) < F.lit(int(min(1.0, share) * (1 << 62)))


def byte_texts(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, one by one (a batch is never copied whole)."""
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py()


def in_slices(rows: Iterable[dict], schema: pa.Schema, size: int = 20_000, weigh: Callable | None = None,
              most: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    """Record batches from an iterator of tuples.

    A batch has at most ``size`` rows, and no further row once ``weigh`` (its
    bytes, say) sums to ``most``.
    """
    held: list = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += weigh(row) if weigh else 0
        if len(held) >= size or weight >= most:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_schema(sql: str, spark: SparkSession) -> pa.Schema:
    """Arrow schema of a Spark DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(sql))
