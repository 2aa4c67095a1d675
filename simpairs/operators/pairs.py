"""Candidate pairs from shared buckets, exact scoring, and result shaping.

``bucket_pairs`` and ``cross_pairs`` are the places where pairs are generated.
Buckets are sized first (a partial aggregate, stored), and every bucket's rows
are dealt into blocks of about ``max_block`` rows. Cells of two blocks then
meet, not whole buckets, so a task sees at most ``max_block``² pairs of a
bucket, whatever its size and whichever side is large; every pair is met in
exactly one cell. Block counts reach the rows by a shuffle join, nothing is
broadcast or capped.

Exact scores use long-form joins keyed by ``(key, element)`` – never a
collected set – so a key with a huge set is spread by element.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.session import materialize

MAX_BLOCK = 4096


def _blocks(n, max_block: int):
    return F.ceil(n / F.lit(max_block)).cast("int")


def _dealt(key, n_blocks):
    return F.pmod(F.xxhash64(key), n_blocks).cast("int")


def bucket_pairs(buckets: DataFrame, group_cols=("band", "bucket"), key: str = "key",
                 max_block: int = MAX_BLOCK, materialize_input: bool = True,
                 materialize_output: bool = True) -> DataFrame:
    """Distinct canonical pairs ``(u, v)``, u < v, of keys sharing any bucket.

    Cell (i, j), i ≤ j, of a bucket pairs its block i with its block j. The
    bucket rows are read twice (sizes and cells), so they are materialized
    once; the pairs are as well, because scoring reads them several times.
    Callers whose input is already a cheap scan, or who read the pairs once,
    can switch either off. Buckets of one row have no pair and go early.
    """
    gc = list(group_cols)
    rows = buckets.select(*gc, F.col(key).alias("_k"))
    if materialize_input:
        rows = materialize(rows)
    sizes = materialize(rows.groupBy(*gc).agg(F.count("*").alias("_n")).filter("_n > 1")
                        .select(*gc, _blocks(F.col("_n"), max_block).alias("_b")))
    dealt = rows.join(sizes, gc).select(*gc, "_k", "_b", _dealt("_k", F.col("_b")).alias("_own"))
    upper = dealt.select(*gc, F.col("_k").alias("_x"), F.col("_own").alias("_i"),
                         F.explode(F.sequence("_own", F.col("_b") - 1)).alias("_j"))
    lower = dealt.select(*gc, F.col("_k").alias("_y"), F.col("_own").alias("_j"),
                         F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_i"))
    met = upper.join(lower, [*gc, "_i", "_j"]).filter((F.col("_i") < F.col("_j")) | (F.col("_x") < F.col("_y")))
    out = met.filter("_x != _y").select(F.least("_x", "_y").alias("u"), F.greatest("_x", "_y").alias("v")).distinct()
    return materialize(out) if materialize_output else out


def cross_pairs(left: DataFrame, right: DataFrame, group_cols, left_key: str, right_key: str,
                left_cols: tuple = (), max_block: int = MAX_BLOCK) -> DataFrame:
    """``(*group_cols, _x, *left_cols, _y)`` for every left and right row sharing a group.

    Both sides are dealt into blocks, and each left block meets each right
    block of its group in a cell of its own. Groups on one side only go early.
    """
    gc = list(group_cols)
    count = lambda df, name: df.groupBy(*gc).agg(_blocks(F.count("*"), max_block).alias(name))
    sizes = materialize(count(left, "_m").join(count(right, "_n"), gc))
    a = (left.select(*gc, F.col(left_key).alias("_x"), *left_cols).join(sizes, gc)
         .select(*gc, "_x", *left_cols, _dealt("_x", F.col("_m")).alias("_i"),
                 F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_j")))
    b = (right.select(*gc, F.col(right_key).alias("_y")).join(sizes, gc)
         .select(*gc, "_y", _dealt("_y", F.col("_n")).alias("_j"),
                 F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias("_i")))
    return a.join(b, [*gc, "_i", "_j"]).select(*gc, "_x", *left_cols, "_y")


# ---------------------------------------------------------------- shaping

def canonical_pairs(hits: DataFrame, q: str = "q", k: str = "key") -> DataFrame:
    """Directed hits → (u, v) with the smaller id first; self hits dropped."""
    return (hits.filter(F.col(q) != F.col(k))
            .select(F.least(q, k).alias("u"), F.greatest(q, k).alias("v")))


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("u", "v").distinct()


def hit_count(hits: DataFrame, q: str = "q", k: str = "key") -> DataFrame:
    """Number of directed hits that are not self hits (before dedup)."""
    return hits.filter(F.col(q) != F.col(k)).agg(F.count("*").alias("n_hits"))


def users_with_matches(hits: DataFrame, q: str = "q", k: str = "key") -> DataFrame:
    """Query keys with at least one hit other than themselves."""
    return hits.filter(F.col(q) != F.col(k)).select(F.col(q).alias("q")).distinct()


def sample_pairs(pairs: DataFrame, rate: float, seed: int = 2020) -> DataFrame:
    """Seeded sample of pairs at a rate: each pair stays or goes by a digest of itself.

    No cap and no order: the sample of a union is the union of the samples.
    """
    if not 0.0 <= rate <= 1.0:
        raise ValueError(f"rate = {rate} lies outside 0 … 1")
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("u").cast("string"), F.col("v").cast("string")))
    return pairs.select("u", "v").filter(
        F.conv(F.substring(draw, 1, 8), 16, 10).cast("long") < F.lit(int(rate * (1 << 32))))


def pair_lines(pairs: DataFrame) -> DataFrame:
    """Pairs as ``"u, v"`` text lines (one column ``value``), deduplicated."""
    return (pairs.select("u", "v").distinct()
            .select(F.concat_ws(", ", F.col("u").cast("string"),
                                F.col("v").cast("string")).alias("value")))


# ---------------------------------------------------------------- exact scores

def _products(pairs: DataFrame, v: DataFrame) -> DataFrame:
    """Sizes, norms and Σ w_u·w_v over common features of each pair.

    ``v`` is ``(key, _f, _w)``, one row per key and feature. Each pair is
    expanded with the features of its *smaller* side, then joined with the
    other side on ``(key, feature)`` – a unique key, so a key with a huge
    vector is spread by feature. One path for all sizes.
    """
    stats = materialize(v.groupBy("key").agg(F.count("*").alias("_n"), F.sum(F.col("_w") * F.col("_w")).alias("_nn")))
    side = lambda k, n, nn: stats.select(F.col("key").alias(k), F.col("_n").alias(n), F.col("_nn").alias(nn))
    sized = pairs.select("u", "v").join(side("u", "_nu", "_nnu"), "u").join(side("v", "_nv", "_nnv"), "v")
    small_is_u = F.col("_nu") <= F.col("_nv")
    p = sized.select("u", "v",
                     F.when(small_is_u, F.col("u")).otherwise(F.col("v")).alias("_small"),
                     F.when(small_is_u, F.col("v")).otherwise(F.col("u")).alias("_big"))
    small = v.select(F.col("key").alias("_small"), "_f", F.col("_w").alias("_ws"))
    big = v.select(F.col("key").alias("_big"), "_f", F.col("_w").alias("_wb"))
    dots = (p.join(small, "_small").join(big, ["_big", "_f"])
            .groupBy("u", "v").agg(F.sum(F.col("_ws") * F.col("_wb")).alias("dot"),
                                   F.count("*").alias("overlap")))
    return (sized.join(dots, ["u", "v"], "left")
            .withColumn("dot", F.coalesce("dot", F.lit(0.0)))
            .withColumn("overlap", F.coalesce("overlap", F.lit(0)).cast("long")))


def sparse_products(pairs: DataFrame, vec: DataFrame, feature: str = "element",
                    weight: str | None = None) -> DataFrame:
    """``(u, v, dot, overlap)`` over common features of each pair (only pairs that overlap).

    ``vec`` is ``(key, feature[, weight])`` with one row per key and feature.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    v = vec.select(F.col("key"), F.col(feature).alias("_f"), w.alias("_w"))
    return _products(pairs, v).filter("overlap > 0").select("u", "v", "dot", "overlap")


def set_similarity(pairs: DataFrame, sets: DataFrame, element: str = "element") -> DataFrame:
    """Exact overlap, Jaccard and binary cosine of set pairs.

    ``sets`` holds one row per distinct (key, element). Returns
    ``(u, v, n_u, n_v, overlap, jaccard, bincos)``; pairs without a common
    element get overlap 0.
    """
    s = sets.select("key", F.col(element).alias("_f"), F.lit(1.0).alias("_w"))
    n_u, n_v, o = F.col("_nu"), F.col("_nv"), F.col("overlap")
    return _products(pairs, s).select(
        "u", "v", n_u.alias("n_u"), n_v.alias("n_v"), o.alias("overlap"),
        (o.cast("double") / (n_u + n_v - o)).alias("jaccard"),
        (o.cast("double") / F.sqrt((n_u * n_v).cast("double"))).alias("bincos"))


def vector_cosine(pairs: DataFrame, vec: DataFrame, feature: str = "item",
                  weight: str = "w") -> DataFrame:
    """Exact cosine of sparse weighted vectors ``(key, feature, weight)``.

    Zero norms give null (never NaN), so a threshold filter drops them.
    """
    v = vec.select("key", F.col(feature).alias("_f"), F.col(weight).cast("double").alias("_w"))
    denom = F.sqrt(F.col("_nnu") * F.col("_nnv"))
    return _products(pairs, v).select("u", "v", "dot", F.when(denom > 0, F.col("dot") / denom).alias("cosine"))
