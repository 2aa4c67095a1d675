"""Per-user projections of ratings: item sets, counts, feature samples, vectors.

All inputs are ``(user, item, rating)`` triples. Vectors are sparse long form
``(key, item, w)``: a row per non-zero coordinate, never a dense array, so a
user's vector is spread over rows and no row grows with the item domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.functions.hashing import md5_order_key


def user_items(ratings: DataFrame) -> DataFrame:
    """Projection to ``(user, item)`` (column pruning reaches the scan)."""
    return ratings.select("user", "item")


def item_sets(ratings: DataFrame) -> DataFrame:
    """Set elements per user: ``(key, element)`` with element = text of the item id."""
    return (ratings.select(F.col("user").cast("long").alias("key"),
                           F.col("item").cast("string").alias("element"))
            .distinct())


def item_set_sizes(ratings: DataFrame) -> DataFrame:
    """``(user, element, set_size)``: the item set in long form with its size."""
    s = item_sets(ratings)
    n = s.groupBy("key").agg(F.count("*").alias("set_size"))
    return s.join(n, "key").select(F.col("key").alias("user"), "element", "set_size")


def ratings_per_user(ratings: DataFrame) -> DataFrame:
    """Number of rating rows per user (``bincount``); users without rows are absent."""
    return ratings.groupBy("user").agg(F.count("*").alias("n_ratings"))


def item_domain(ratings: DataFrame) -> DataFrame:
    return ratings.select("item").distinct()


def feature_sample(items: DataFrame, n: int, seed: int = 2020) -> DataFrame:
    """Seeded sample of ``n`` item ids (md5 order of ``seed:item``, ties by id)."""
    if n < 1:
        raise ValueError("feature sample size must be positive")
    return (items.select("item").distinct()
            .orderBy(md5_order_key(seed, F.col("item")), "item").limit(n))


def feature_sample_ratings(ratings: DataFrame, n: int, seed: int = 2020) -> DataFrame:
    """Ratings restricted to a seeded sample of ``n`` items (semi-join; the optimizer picks its side by size)."""
    sample = feature_sample(item_domain(ratings), n, seed)
    return ratings.join(sample, "item", "left_semi")


def rating_vectors(ratings: DataFrame, order: str | None = None) -> DataFrame:
    """Sparse integer rating vectors ``(key, item, w)``.

    Of several rows of one (user, item) the latest by ``order`` counts (the
    reference overwrites in row order). Without an order column there must be
    one row of each; a second one fails the job. Weights are truncated toward
    zero to ``long``; zero weights are absent (missing coordinates are 0).
    """
    r = ratings.select("user", "item", "rating", *([order] if order else []))
    if order:
        val = F.max_by("rating", order)
    else:
        val = F.when(F.count("*") == 1, F.max("rating")).otherwise(
            F.raise_error(F.lit("several ratings of one user and item: name the order column")))
    w = F.col("rating").cast("long")
    return (r.groupBy("user", "item").agg(val.alias("rating"))
            .select(F.col("user").alias("key"), "item", w.alias("w"))
            .filter(F.col("w") != 0))


def binary_vectors(ratings: DataFrame) -> DataFrame:
    """Sparse presence vectors ``(key, item, w=1)`` (one row per distinct item)."""
    return (ratings.select(F.col("user").alias("key"), "item").distinct()
            .withColumn("w", F.lit(1).cast("long")))


def domain_filter(ratings: DataFrame, lo: int = 1, hi: int = 17770) -> DataFrame:
    """Keep items inside the declared item domain [lo, hi]; others are dropped."""
    return ratings.filter(F.col("item").between(lo, hi))


def parse_points(df: DataFrame, col: str = "point", key: str = "key") -> DataFrame:
    """JSON text points → ``(key, vec array<double>, extra string)``.

    Accepts ``[x, ...]`` and ``[[x, ...], extra]`` forms.
    """
    plain = F.from_json(F.col(col), "array<double>")
    nested = F.from_json(F.col(col), "array<string>")
    with_extra = F.from_json(nested.getItem(0), "array<double>")
    is_nested = F.trim(F.col(col)).startswith("[[")
    return df.select(
        F.col(key).alias("key"),
        F.when(is_nested, with_extra).otherwise(plain).alias("vec"),
        F.when(is_nested, nested.getItem(1)).alias("extra"))
