"""Key → many-values views of a table: ordered list versus set semantics.

A list keeps repeats and insertion order (``order`` column), a set keeps one
copy of each value. Both are expressed as aggregates and anti-joins, so no
key's values are gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_vs_set(df: DataFrame, key: str, val: str, order: str) -> DataFrame:
    """Per key: list length, set size, and the first value in list order."""
    return df.groupBy(F.col(key).alias("key")).agg(
        F.count(val).alias("list_len"),
        F.countDistinct(val).alias("set_size"),
        F.min_by(val, order).alias("first_value"))


def remove_values(df: DataFrame, gone: DataFrame, key: str, val: str, order: str) -> DataFrame:
    """List ``remove_val``: drop only the first occurrence of each (key, val) in ``gone``.

    The first occurrence is ``min(order)`` per (key, val) – a partial
    aggregate – and is removed with an anti-join.
    """
    targets = gone.select(key, val).distinct()
    firsts = (df.join(targets, [key, val], "left_semi")
              .groupBy(key, val).agg(F.min(order).alias(order)))
    return (df.select(key, val, order)
            .join(firsts, [key, val, order], "left_anti"))


def remove_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``remove(*keys)``: every value under the given keys goes."""
    return df.join(keys.select(key).distinct(), key, "left_anti")
