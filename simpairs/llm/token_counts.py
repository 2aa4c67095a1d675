"""Token counts through a digest cache.

Texts are looked up by ``(content digest, tokenizer-version digest)`` in a
stored table of counts; only distinct contents that it lacks are encoded, and
their counts are appended to it. The content is normalised no further than
null to empty: any other change could change the count.

Plan: documents give ``(doc_id, digest, n_bytes)`` without their text. The
texts meet once, in a shuffle by digest that carries one text of each digest
and task (partial ``first``), so a content shared by a third of all rows
leaves each task once. Misses are encoded in Arrow batches, written to the
cache, and counts join back by digest.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm import common, tokens
from simpairs.session import materialize, ship_package

CACHE = "digest binary, tokenizer string, n_tokens long"


def _counter(path: str):
    def count(batches):
        encode = tokens.encoder(path).ids
        for batch in batches:
            n = [len(encode(text.as_py())) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())],
                                             names=["digest", "n_tokens"])

    return count


def read_cache(spark, cache: str) -> DataFrame | None:
    """The stored counts, or None before the first write."""
    try:
        return spark.read.parquet(cache).select("digest", "tokenizer", "n_tokens")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def token_counts(docs: DataFrame, tokenizer: str | None = None, cache: str | None = None,
                 limit: int = 1024) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row.

    ``tokenizer`` is the place of a tokenizer file (default: the public 50k
    byte-level BPE), ``cache`` a Parquet table in a shared folder that keeps
    counts between runs; without one, counts live for this result only.
    Null and empty texts have 0 bytes and 0 tokens. Repeated rows each get
    their row. An entry that two runs appended twice counts once. An empty
    table gives no rows. Extra columns of the input are ignored.
    """
    path = tokenizer or tokens.default_tokenizer()
    spark = docs.sparkSession
    ship_package(spark)
    name = tokens.version(path)
    texts = common.documents(docs).select("doc_id", common.no_nulls().alias("text"))
    digest = F.unhex(F.sha2(F.col("text"), 256)).alias("digest")
    rows = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest)
    contents = texts.select(digest, "text").groupBy("digest").agg(F.first("text").alias("text"))
    stored = read_cache(spark, cache) if cache else None
    if stored is not None:
        stored = stored.filter(F.col("tokenizer") == F.lit(name)).select("digest", "n_tokens")
        contents = contents.join(stored.select("digest"), "digest", "left_anti")
    counts = contents.mapInArrow(_counter(path), "digest binary, n_tokens long")
    if cache:
        (counts.select("digest", F.lit(name).alias("tokenizer"), "n_tokens")
         .write.mode("append").parquet(cache))
        counts = read_cache(spark, cache).filter(F.col("tokenizer") == F.lit(name)).select("digest", "n_tokens")
    # one row per digest, stored: a join of two plain shuffles lets a digest with very many rows be split
    counts = materialize(counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return (rows.join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit")))
