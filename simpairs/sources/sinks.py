"""Sinks and saved parameters.

Result pairs are written as ``u, v`` text lines (one file set per method)
or as parquet; hash parameters and index tables are parquet tables that can
be written once and read back (``mode='ignore'`` keeps an existing copy,
``overwrite=True`` replaces it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from simpairs.operators.pairs import pair_lines


def write_pairs(pairs: DataFrame, path: str, fmt: str = "text") -> None:
    """Write canonical pairs: ``text`` gives ``u, v`` lines, other formats keep columns."""
    if fmt == "text":
        pair_lines(pairs).write.mode("overwrite").text(path)
    else:
        pairs.write.mode("overwrite").format(fmt).save(path)


def save_table(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Persist parameters / an index; an existing table is kept unless ``overwrite``."""
    df.write.mode("overwrite" if overwrite else "ignore").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_or_load(df: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Write ``df`` unless a saved copy exists (or ``overwrite``), then read it back."""
    save_table(df, path, overwrite)
    return load_table(df.sparkSession, path)
