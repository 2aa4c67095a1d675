import numpy as np
import pytest

from pyspark.sql import functions as F

from simpairs.operators import banding, cells, exact, minhash, pairs, projection
from simpairs.plans import jobs
from simpairs.streaming import sketches as st


def _rows(spark, n=60, tables=4, buckets=5, seed=3):
    rnd = np.random.RandomState(seed)
    rows = [(k, t, f"b{rnd.randint(buckets)}") for k in range(n) for t in range(tables)]
    return spark.createDataFrame(rows + [(None, 0, "b1")], "key long, tbl int, bucket string")


@pytest.mark.parametrize("max_block", [3, 1024])
def test_each_pair_once_from_its_first_bucket(spark, max_block):
    rows = _rows(spark)
    got = sorted((r.u, r.v) for r in cells.canonical(cells.met_pairs(rows, 4, max_block=max_block)).collect())
    want = sorted((r.u, r.v) for r in pairs.bucket_pairs(rows, ("tbl", "bucket")).collect())
    assert got == want and len(set(got)) == len(got)
    left = rows.filter("key < 7")
    crossed = cells.crossed_pairs(left, rows, 4, max_block=max_block).select("x", "y")
    hits = banding.index_query(*(s.withColumnRenamed("tbl", "band") for s in (rows, left)))
    # a key beside itself is a hit like any other
    assert sorted(map(tuple, crossed.collect())) == sorted(map(tuple, hits.collect()))


def test_an_index_probing_itself_equals_a_probe(spark):
    index = _rows(spark).withColumnRenamed("tbl", "band")
    index = index.unionByName(spark.createDataFrame([(3, 0, "b0"), (3, 0, "b1"), (99, 1, "alone")], "key long, band int, bucket string"))
    for rows in (index.filter("key IS NOT NULL"), index):
        own = sorted(map(str, banding.index_query(rows, rows).collect()))
        assert own == sorted(map(str, banding.index_query(rows, rows.select("*")).collect()))


@pytest.mark.parametrize("limit", [3, 4096])
def test_sparse_scores_equal_joined_ones(spark, monkeypatch, limit):
    monkeypatch.setattr(cells, "MAX_FEATURES", limit)
    rnd = np.random.RandomState(5)
    rows = [(k, int(i), int(rnd.randint(1, 5))) for k in range(40) for i in rnd.choice(30, rnd.randint(1, 9), replace=False)]
    vec = spark.createDataFrame(rows + [(1, None, 2)], "key long, item long, w long")
    sig = projection.sparse_signatures(vec, 3, 4, 1)
    cand = projection.rp_candidates(sig)
    got = {(r.u, r.v): r.score for r in jobs.sparse_scores(sig, 4, vec, 0.3).collect()}
    want = {(r.u, r.v): r.cosine for r in pairs.vector_cosine(cand, vec).filter("cosine >= 0.3").collect()}
    assert got == pytest.approx(want) and len(got) > 5
    binary = {(r.u, r.v): r.score for r in jobs.sparse_scores(sig, 4, vec, 0.3, binary=True).collect()}
    s = vec.select("key", F.col("item").alias("element"))
    assert binary == pytest.approx({(r.u, r.v): r.bincos for r in pairs.set_similarity(cand, s).filter("bincos >= 0.3").collect()})


def test_signature_scores_equal_joined_ones(spark):
    rnd = np.random.RandomState(2)
    sets = spark.createDataFrame([(k, str(e)) for k in range(25) for e in rnd.choice(20, 12, replace=False)], "key long, element string")
    sig = minhash.minhash_signatures(sets, gather=True)
    assert sorted(map(tuple, sig.collect())) == sorted(map(tuple, minhash.minhash_signatures(sets).collect()))
    buckets = banding.band_buckets(sig, 22, 3)
    cand = pairs.bucket_pairs(buckets)
    assert sorted(map(tuple, minhash.met_jaccard_estimate(buckets, sig).collect())) == sorted(
        map(tuple, minhash.jaccard_estimate(cand, sig).collect()))
    assert sorted(map(tuple, minhash.met_pair_cardinality(buckets, sig).collect())) == sorted(
        map(tuple, minhash.merged_pair_cardinality(cand, sig).collect()))


def test_scattered_elements_make_one_partial_sketch_a_key(spark):
    hashes = spark.range(40_000).select((F.col("id") % 50).alias("key"), F.col("id").alias("hv")).repartition(16, "hv")
    count = lambda h: h.mapInPandas(lambda it: ({"n": [x]} and __import__("pandas").DataFrame({"n": [x]})
                                                for x in [len(set().union(*(set(b["key"]) for b in it)))]), "n long").agg(F.sum("n")).first()[0]
    assert count(hashes) == 16 * 50
    assert count(minhash.gathered(hashes)) < 100


def test_dense_scores_of_keys_with_several_vectors(spark):
    rnd = np.random.RandomState(4)
    rows = [(k % 25, [float(x) for x in rnd.randn(6)]) for k in range(28)] + [(50, None)]
    vec = spark.createDataFrame(rows, "key long, vec array<float>")
    sig = projection.dense_signatures(vec, 6, 3, 4, 1)
    got = sorted((r.u, r.v, round(r.cosine, 9)) for r in projection.scored_candidates(sig, 4, vec, 6).collect())
    want = projection.dense_cosine(projection.rp_candidates(sig), vec, 6)
    assert got == sorted((r.u, r.v, round(r.cosine, 9)) for r in want.collect())


def test_all_pairs_where_few_dimensions_are_shared_by_most(spark):
    rnd = np.random.RandomState(7)
    sets = spark.createDataFrame([(k, str(e)) for k in range(30) for e in rnd.choice(10, 6, replace=False)], "key long, element string")
    assert exact._crowded(sets, "element")
    members = exact.copies.copy_groups(sets)
    own = sets.join(exact.copies.representatives(members), "key", "left_semi")
    found = pairs.set_similarity(exact.jaccard_prefix_candidates(own, 0.6), own).filter("jaccard >= 0.6")
    assert sorted(map(tuple, exact.jaccard_pairs(sets, 0.6).select("u", "v").collect())) == sorted(
        map(tuple, found.select("u", "v").collect()))


def test_a_folder_of_the_table_name_is_streamed(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    stream = st.file_stream(spark, str(tmp_path), "events.parquet")
    seen = []
    stream.writeStream.foreachBatch(lambda b, i: seen.append(b.count())).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start().awaitTermination(120)
    assert sum(seen) == 100


def test_signatures_travel_to_pairs_in_four_bytes_a_value(spark, monkeypatch):
    """Values of the whole range score as the joined ones do; a bucket of up to 4,096 keys gets each of them once."""
    sent, met_pairs = [], cells.met_pairs

    def seen(rows, tables, payload, fits=None, prepare=None, scores=None, max_block=cells.MAX_BLOCK):
        sent.append((payload.schema["hashvalues"].dataType.simpleString(), max_block))
        return met_pairs(rows, tables, payload, fits, prepare, scores, max_block)

    monkeypatch.setattr(cells, "met_pairs", seen)
    rnd = np.random.RandomState(4)
    ends = [0, 1, (1 << 31) - 1, 1 << 31, (1 << 31) + 1, (1 << 32) - 1]
    rows = [(k, p, int(rnd.choice(ends))) for k in range(12) for p in range(8)]
    sig = spark.createDataFrame(rows, "key long, perm int, v long")
    buckets = spark.createDataFrame([(k, b, "x") for k in range(12) for b in range(2)], "key long, band int, bucket string")
    cand = pairs.bucket_pairs(buckets)
    for met, joined in ((minhash.met_jaccard_estimate, minhash.jaccard_estimate), (minhash.met_pair_cardinality, minhash.merged_pair_cardinality)):
        assert sorted(map(tuple, met(buckets, sig).collect())) == sorted(map(tuple, joined(cand, sig).collect()))
    assert sent == [("array<int>", 4096)] * 2
