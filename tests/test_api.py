import numpy as np

from simpairs.operators import minhash as mh
from simpairs.operators import multimap, pairs
from simpairs.operators import projection as pj
from simpairs.sources import tables as tb


def test_permutation_table_matches_array(spark):
    rows = sorted(tuple(r) for r in mh.permutation_table(spark, mh.SketchSpec(seed=5, num_perm=16)).collect())
    ab = mh.permutations(5, 16)
    assert rows == [(i, int(a), int(b)) for i, (a, b) in enumerate(ab)]


def test_read_ratings_any_format(spark, tmp_path):
    src = spark.createDataFrame([(1, 10, 4), (2, 11, 3)], "u int, i int, r int")
    src.write.mode("overwrite").option("header", True).csv(str(tmp_path / "r"))
    got = tb.read_ratings(spark, str(tmp_path / "r"), fmt="csv", user="u", item="i", rating="r",
                          header="true")
    assert got.schema.simpleString() == "struct<user:bigint,item:bigint,rating:double>"
    assert sorted(tuple(r) for r in got.collect()) == [(1, 10, 4.0), (2, 11, 3.0)]
    dated = tb.read_ratings(spark, str(tmp_path / "r"), fmt="csv", user="u", item="i", rating="r", order="i", header="true")
    assert dated.columns == ["user", "item", "rating", "i"]


def test_remove_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    keys = spark.createDataFrame([(1,)], "k long")
    assert [tuple(r) for r in multimap.remove_keys(df, keys, "k").collect()] == [(2, "c")]


def test_rp_query_equals_shared_buckets(spark):
    rnd = np.random.RandomState(1)
    x = rnd.randn(40, 8).astype(np.float32)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(40)], "key long, vec array<float>")
    sig = pj.dense_signatures(df, 8, 3, 3, 2).cache()
    probe = sig.filter("key < 5")
    got = {(r.q, r.key) for r in pj.rp_query(sig, probe).collect()}
    rows = sig.collect()
    expected = {(a.key, b.key) for a in rows if a.key < 5 for b in rows
                if a.tbl == b.tbl and a.bucket == b.bucket}
    assert got == expected


def test_sparse_products(spark):
    vec = spark.createDataFrame([(1, 5, 2.0), (1, 6, 1.0), (2, 5, 3.0), (3, 7, 1.0)],
                                "key long, f long, w double")
    p = spark.createDataFrame([(1, 2), (1, 3)], "u long, v long")
    got = {(r.u, r.v): (r.dot, r.overlap) for r in pairs.sparse_products(p, vec, "f", "w").collect()}
    assert got == {(1, 2): (6.0, 1)}
