"""A MinHash or projection index as a stored table that is probed where it lies.

Rows ``(key, band, bucket)`` are written once, bucketed and sorted by band,
bucket and block, so a probe is joined by shuffling the probe alone: the index
side of the plan is a scan without an exchange. Buckets of more than
``max_block`` rows are dealt into blocks, which lie in different files; a
small table beside the index says how many, and probes of such a bucket visit
all its blocks. Keys are found by a second table of the same rows, bucketed by
key (``getmany`` of the reference, removal, containment).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simpairs.operators.pairs import MAX_BLOCK
from simpairs.session import materialize, own_tables

PLACE = ("band", "bucket", "block")


@dataclass(frozen=True)
class StoredIndex:
    """Names of an index's tables in the session's warehouse."""

    name: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_buckets")

    def crowds(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_crowds")

    def keys(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_keys")

    def drop(self, spark: SparkSession) -> None:
        for part in ("buckets", "crowds", "keys"):
            spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")


def store_index(index: DataFrame, name: str | None = None, n_files: int | None = None, max_block: int = MAX_BLOCK) -> StoredIndex:
    """Write ``(key, band, bucket)`` as a stored index of ``n_files`` buckets (default: the shuffle partitions).

    An index without a ``name`` lives until ``session.drop_materialized``.
    """
    spark = index.sparkSession
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if name is None:
        name = f"simpairs_index_{uuid.uuid4().hex}"
        own_tables(spark, *(f"{name}_{part}" for part in ("buckets", "crowds", "keys")))
    index = materialize(index.select("key", "band", "bucket"))
    crowds = (index.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter(F.col("n") > F.lit(max_block))
              .select("band", "bucket", F.ceil(F.col("n") / F.lit(max_block)).cast("int").alias("blocks")))
    crowds.write.format("parquet").saveAsTable(f"{name}_crowds")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (index.join(spark.table(f"{name}_crowds"), ["band", "bucket"], "left")
             .select("key", "band", "bucket", F.pmod(F.xxhash64("key"), blocks).cast("int").alias("block")))
    # dealt like the buckets, so each file of the table is written by one task
    (dealt.repartition(n, *PLACE).write.format("parquet").bucketBy(n, *PLACE).sortBy(*PLACE)
     .option("parquet.bloom.filter.enabled#bucket", "true").saveAsTable(f"{name}_buckets"))
    (index.repartition(n, "key").write.format("parquet").bucketBy(n, "key").sortBy("key", "band").saveAsTable(f"{name}_keys"))
    return StoredIndex(name)


def query_stored(stored: StoredIndex, probe: DataFrame) -> DataFrame:
    """Keys that share a bucket with each probe key: ``(q, key)`` distinct, as ``banding.index_query``.

    ``probe`` is ``(key, band, bucket)``. Only probe rows are shuffled. A task
    joins one block of a bucket with all probes of it: hand in probes that are
    few beside the index, and pair whole indexes with ``pairs.bucket_pairs``.
    """
    spark = probe.sparkSession
    blocks = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    sent = (probe.select(F.col("key").alias("q"), "band", "bucket").join(stored.crowds(spark), ["band", "bucket"], "left")
            .select("q", "band", "bucket", blocks.alias("block")))
    return sent.hint("shuffle_hash").join(stored.rows(spark), list(PLACE)).select("q", "key").distinct()


def lookup_stored(stored: StoredIndex, keys: DataFrame, key: str = "key") -> DataFrame:
    """``(key, buckets)``: the buckets of each requested key in the order of bands; '' for a key that is not there."""
    spark = keys.sparkSession
    wanted = keys.select(F.col(key).alias("key")).distinct()
    found = (stored.keys(spark).join(wanted, "key", "left_semi").groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct("band", "bucket"))).alias("b")))
    return wanted.join(found, "key", "left").select(
        "key", F.coalesce(F.array_join(F.transform("b", lambda x: x["bucket"]), ","), F.lit("")).alias("buckets"))
