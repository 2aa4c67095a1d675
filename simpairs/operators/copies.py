"""Groups of copies: keys whose element sets are identical.

Copies share every bucket, so a group of copies holding a third of the keys
would turn the bucket self-join quadratic. They are collapsed first: each
key gets a multiset fingerprint (element count and sums of two independent
64-bit hashes, a partial aggregate – no element shuffle), keys with equal
fingerprints map to one representative (the smallest key), and LSH plus
verification run on representatives only.

The result of a pair job is then the pairs of representatives plus the
membership table ``(key, rep)``: linear in a group of copies, and no link is
lost. ``expand_pairs`` writes out all member pairs – quadratic in a group, so
only on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.operators.pairs import MAX_BLOCK, bucket_pairs, cross_pairs
from simpairs.session import materialize

_PIECES = [f"_p{i}{j}" for i in range(2) for j in range(4)]


def fingerprints(sets: DataFrame, key: str = "key", element: str = "element") -> DataFrame:
    """``(key, _n, _p00 … _p13)``: order-free fingerprint of each key's element multiset.

    Two independent 64-bit hashes per element, each cut into four 16-bit
    pieces, summed per key as ``long`` (no overflow below 2**47 elements per
    key, and codegen-friendly, unlike 38-digit decimals).
    """
    e = F.col(element).cast("string")
    aggs = [F.count("*").alias("_n")]
    for i, h in enumerate((F.xxhash64(e), F.xxhash64(F.lit("simpairs"), e))):
        for j in range(4):
            piece = F.shiftrightunsigned(h, 16 * j).bitwiseAND(F.lit(0xFFFF))
            aggs.append(F.sum(piece).alias(f"_p{i}{j}"))
    return sets.groupBy(F.col(key).alias("key")).agg(*aggs)


def copy_groups(sets: DataFrame, key: str = "key", element: str = "element") -> DataFrame:
    """``(key, rep)`` for every key; ``rep`` is the smallest key with the same multiset."""
    return groups_from_fingerprints(fingerprints(sets, key, element), ["_n"] + _PIECES)


def groups_from_fingerprints(fp: DataFrame, cols) -> DataFrame:
    """``(key, rep)`` from any ``(key, *cols)`` fingerprint: equal fingerprints share a rep.

    The fingerprint must imply equal element sets (e.g. a digest of the source
    a set is derived from); unequal fingerprints only forgo collapsing.
    """
    cols = list(cols)
    reps = fp.groupBy(*cols).agg(F.min("key").alias("rep"))
    return materialize(fp.join(reps, cols).select("key", "rep"))


def representatives(members: DataFrame) -> DataFrame:
    return members.filter(F.col("key") == F.col("rep")).select("key")


def expand_pairs(rep_pairs: DataFrame, members: DataFrame, within_value: dict | None = None,
                 max_block: int = MAX_BLOCK) -> DataFrame:
    """Member pairs of representative pairs, plus all pairs inside each group.

    ``rep_pairs`` is ``(u, v, *cols)``; expanded rows keep ``cols``; pairs inside a
    group get the literal values of ``within_value`` for those columns. The
    output is quadratic in a group of copies, dealt into cells of blocks.
    """
    extra = tuple(c for c in rep_pairs.columns if c not in ("u", "v"))
    grp = members.select(F.col("rep").alias("_g"), "key")
    first = cross_pairs(rep_pairs.select(F.col("u").alias("_g"), "v", *extra), grp, ("_g",), "v", "key",
                        extra, max_block).select(F.col("_x").alias("_g"), F.col("_y").alias("_m"), *extra)
    second = cross_pairs(first, grp, ("_g",), "_m", "key", extra, max_block)
    cross = second.select(F.least("_x", "_y").alias("u"), F.greatest("_x", "_y").alias("v"), *extra)
    # members is stored already and the pairs are read once: no extra copies
    within = bucket_pairs(grp, ("_g",), "key", max_block=max_block, materialize_input=False,
                          materialize_output=False)
    values = within_value or {}
    within = within.select("u", "v", *[F.lit(values[c]).alias(c) if c in values else
                                       F.lit(None).cast(rep_pairs.schema[c].dataType).alias(c)
                                       for c in extra])
    return cross.unionByName(within)
