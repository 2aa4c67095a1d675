"""Registered queries ``opN_<name>``: each operator over its whole table.

The queries are thin: they call the operator with production parameters and
derive the columns of their contract from its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simpairs.llm import (ann, bitslice, chat, divergence, langid, lines, mixing, packing, repair, secret_scan, simhash, suffix,
                          token_counts)
from simpairs.llm.common import table
from simpairs.session import shared_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on format-labelled findings outside the held-out quarter of ids; judges all candidates."""
    out = secret_scan.secrets(table(spark, sf_dir, "documents"), learn_from=~langid.held_out())
    return out.select("doc_id", "start", "length", F.sha2("finding", 256).alias("finding_sha256"),
                      F.round("score", 6).alias("score"), "is_secret")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.by_position(mixing.mix(table(spark, sf_dir, "documents")))
    time = lambda i: F.round(F.col("positions")[i], 9)
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken",
                        time(0).alias("position"), time(1).alias("repeat_position"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return out.select("row.doc_id", "n_lines", "n_removed",
                      F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.repeated_spans(table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(langid.learning_rows(docs)))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cold cache for each call: every distinct content is encoded."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     cache=shared_path(spark, "token-cache"))


#: Conversation -7 of ``op11``: control strings of common templates in both texts.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's turns and conversation -7 as event logs, folded, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                 "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(chat.as_events(rows.unionByName(more))))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's conversations after damage, repaired; conversations without rows have zeros."""
    rows = table(spark, sf_dir, "conversations")
    report, turns = repair.repair(repair.damaged(rows))
    every = rows.select("conv_id").distinct()
    out = every
    for found in (report, repair.line_digests(turns)):
        found = found.withColumnRenamed("conv_id", "_c")
        out = out.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in repair.REPORT if c != "audit"]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_source_mix": op2_source_mix,
    "op3_line_dedup": op3_line_dedup,
    "op4_exact_topk": op4_exact_topk,
    "op5_packing": op5_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_simhash_groups": op7_simhash_groups,
    "op8_language_id": op8_language_id,
    "op9_ann_search": op9_ann_search,
    "op10_token_counts": op10_token_counts,
    "op11_chat_format": op11_chat_format,
    "op12_structure_repair": op12_structure_repair,
    "op13_source_divergence": op13_source_divergence,
}
from simpairs.llm.oracle import ORACLE  # noqa: E402,F401
