"""Overlaps of listed pairs: sets travel by cell, not by pair."""

from pyspark.sql import functions as F

from simpairs.operators import listed
from simpairs.sources import tables as tb


def _sets():
    """Two clusters of 24 near copies, a chain between them and a lone pair."""
    out = {c * 100 + i: {c * 1000 + e for e in range(40)} | {-(c * 100 + i)} for c in (1, 2) for i in range(24)}
    out |= {900: {1000, 1001, 2000}, 901: {5}, 902: {5, 6}}
    pairs = [(u, v) for u in out for v in out if u < v and u // 100 == v // 100 and u < 900]
    return out, pairs + [(100, 900), (200, 900), (901, 902), (100, 200)]


def _frames(spark):
    sets, pairs = _sets()
    return (sets, pairs, spark.createDataFrame([(k, e) for k, s in sets.items() for e in s], "key long, element long"),
            spark.createDataFrame(pairs, "u long, v long"))


def test_overlaps_of_listed_pairs(spark, monkeypatch):
    sets, pairs, rows, found = _frames(spark)
    want = {(u, v): len(sets[u] & sets[v]) for u, v in pairs}
    for block, together in ((2048, 2048), (5, 4)):
        monkeypatch.setattr(listed, "BLOCK", block)
        monkeypatch.setattr(listed, "TOGETHER", together)
        got = listed.overlaps(found, rows).collect()
        assert len(got) == len(pairs)
        assert {(r["u"], r["v"]): r["overlap"] for r in got} == want


def test_a_cluster_is_one_group(spark):
    """Its pairs agree at once, so a member is sent to one group and not with every pair."""
    _, pairs, _, found = _frames(spark)
    grouped = listed._grouped(found)
    assert grouped.count() == len(pairs)
    ends = grouped.select("g", F.explode(F.array("u", "v")).alias("key")).distinct()
    assert ends.groupBy("key").count().agg(F.max("count")).first()[0] <= 4


def test_document_digests_are_its_shingles(spark):
    """Also where an id has several documents, or none."""
    docs = spark.createDataFrame([(1, "a b c d a b c d"), (2, "A b C"), (1, "b c d e"), (3, None), (4, " "), (None, "a b c")],
                                 "doc_id long, text string")
    want = tb.doc_shingles(spark, "", 3, docs=docs).select("key", F.xxhash64("element").alias("element"))
    rows = lambda df: sorted((r["key"] is None, r["key"] or 0, r["element"]) for r in df.collect())
    assert rows(tb.doc_digests(spark, "", 3, docs=docs)) == rows(want)
