"""Corpus pipeline: ``documents`` through five operators of ``simpairs.llm``, to packed sequences.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows
its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from simpairs.llm import langid, lines, mixing, packing, simhash
from simpairs.session import materialize


def language_id(spark, docs, sf_dir):
    """Drops documents without a language (null texts, texts without a letter)."""
    return langid.known_only(docs, langid.learn(langid.learning_rows(docs)))


def line_dedup(spark, docs, sf_dir):
    """Deletes later repeats of line runs from the texts."""
    return lines.deduplicated(docs)


def near_duplicates(spark, docs, sf_dir):
    """Keeps one document of each SimHash group (3-word shingles, at most 3 bits)."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def source_mix(spark, docs, sf_dir):
    """The documents that the mix takes, repeated as often as it takes them, in training order."""
    return mixing.mixed_documents(docs)


def pack(spark, docs, sf_dir):
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("source mix", source_mix),
    ("packing", pack),
]

#: SQL cannot express the trained classifier and the tokenizer
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each stage's rows are stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
