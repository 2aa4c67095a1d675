"""Table scans and the derived inputs used by the similarity jobs.

Every function returns a lazy DataFrame; projections and filters are written
so that Catalyst pushes them into the parquet scan (``ReadSchema`` holds only
the columns used).

Standard shapes:

* ratings  ``(user long, item long, rating double)``
* sets     ``(key long, element string)``  — one row per distinct element
* vectors  ``(key long, vec array<float>, label int)``
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simpairs.functions.text import shingles_of_tokens, word_tokens
from simpairs.session import materialize, widened

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one table; ``base`` is a directory of ``<name>.parquet`` files/dirs."""
    return spark.read.parquet(os.path.join(base, f"{name}.parquet"))


def read_ratings(spark: SparkSession, path: str, fmt: str = "parquet",
                 user: str = "user", item: str = "item", rating: str = "rating",
                 order: str | None = None, **options) -> DataFrame:
    """Ratings scan (any ``spark.read`` format) renamed/cast to the triple shape.

    ``order`` names a column to keep that tells which of several ratings of
    one user and item is the last.
    """
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(F.col(user).cast("long").alias("user"),
                     F.col(item).cast("long").alias("item"),
                     F.col(rating).cast("double").alias("rating"), *([F.col(order)] if order else []))


# ---------------------------------------------------------------- events

def event_item(props_col="props"):
    """Item id of an event: integer ``k`` of its JSON ``props``."""
    return F.get_json_object(F.col(props_col), "$.k").cast("long")


def event_triples(spark: SparkSession, base: str) -> DataFrame:
    """Raw event ratings, one row per event: (user, item, rating, event_id)."""
    ev = table(spark, base, "events")
    return ev.select(F.col("user_id").alias("user"), event_item().alias("item"),
                     F.col("value").alias("rating"), F.col("event_id"))


def ev_ratings(spark: SparkSession, base: str) -> DataFrame:
    """Fixture ``ev_ratings``: max(value) per (user, item) of the events."""
    return (event_triples(spark, base)
            .groupBy("user", "item").agg(F.max("rating").alias("rating")))


def ev_sets(spark: SparkSession, base: str) -> DataFrame:
    """Item sets of the event users, elements as text (``str(item)``)."""
    return (event_triples(spark, base)
            .select(F.col("user").alias("key"), F.col("item").cast("string").alias("element"))
            .distinct())


# ---------------------------------------------------------------- orders

def baskets(spark: SparkSession, base: str) -> DataFrame:
    """Fixture ``baskets``: customer × part with max(l_quantity)."""
    li = table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.max("l_quantity").alias("rating")))


def basket_sets(spark: SparkSession, base: str) -> DataFrame:
    """Part sets per customer, elements as text."""
    return baskets(spark, base).select(
        F.col("user").alias("key"), F.col("item").cast("string").alias("element"))


# ---------------------------------------------------------------- documents

def doc_elements(spark: SparkSession, base: str, k: int = 3,
                 docs: DataFrame | None = None, positions: bool = False) -> DataFrame:
    """Lower-cased k-word shingles per document, repeats kept (``(key, element)``, or with ``pos``).

    Enough for sketching (MinHash ignores repeats); use ``doc_shingles`` where
    set semantics matter.
    """
    d = docs if docs is not None else table(spark, base, "documents")
    d = widened(d.select("doc_id", "text"))
    toks = d.select(F.col("doc_id").alias("key"), word_tokens("text").alias("_tok"))
    grams = shingles_of_tokens("_tok", k)
    if positions:
        return toks.select("key", F.posexplode(grams).alias("pos", "element"))
    return toks.select("key", F.explode(grams).alias("element"))


def doc_copy_groups(docs: DataFrame) -> DataFrame:
    """Copy groups of documents with at least one word: equal text ⇒ equal shingle set.

    One SHA-256 per document instead of a hash per shingle.
    """
    from simpairs.functions.text import WHITESPACE
    from simpairs.operators.copies import groups_from_fingerprints

    has_words = F.col("text").rlike("[^" + WHITESPACE[1:-2] + "]")
    fp = (docs.filter(F.col("text").isNotNull() & has_words)
          .select(F.col("doc_id").alias("key"), F.sha2(F.col("text"), 256).alias("_h"),
                  F.length("text").alias("_l")))
    return groups_from_fingerprints(fp, ["_h", "_l"])


def doc_shingles(spark: SparkSession, base: str, k: int = 3,
                 docs: DataFrame | None = None) -> DataFrame:
    """Fixture ``doc_shingles``: distinct lower-cased k-word shingles per document."""
    return doc_elements(spark, base, k, docs).distinct()


def doc_digests(spark: SparkSession, base: str, k: int = 3,
                docs: DataFrame | None = None) -> DataFrame:
    """``doc_shingles`` with 64-bit digests for the shingles: ``(key, element long)``, distinct.

    A document's own repeats go inside its row; only ids of several documents
    meet in a shuffle.
    """
    d = (docs if docs is not None else table(spark, base, "documents")).select("doc_id", "text")
    grams = F.transform(shingles_of_tokens("_tok", k), lambda g: F.xxhash64(g))
    rows = lambda part: (widened(part).select(F.col("doc_id").alias("key"), word_tokens("text").alias("_tok"))
                         .select("key", F.explode(F.array_distinct(grams)).alias("element")))
    twice = materialize(d.groupBy("doc_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id"))
    if twice.first() is None:
        return rows(d)
    alone = d.join(twice, d["doc_id"].eqNullSafe(twice["doc_id"]), "left_anti")
    return rows(alone).unionByName(rows(d.join(twice, d["doc_id"].eqNullSafe(twice["doc_id"]), "left_semi")).distinct())


# ---------------------------------------------------------------- vectors

def vectors(spark: SparkSession, base: str) -> DataFrame:
    """Fixture ``vectors``: the embeddings as (key, vec, label)."""
    e = widened(table(spark, base, "embeddings").select("vec_id", "embedding", "label"))
    return e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vec"), "label")
