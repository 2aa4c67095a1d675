import itertools

import numpy as np
import pytest

from simpairs.operators import multimap, pairs


def test_canonical_and_counts(spark):
    hits = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 2), (4, 4)], "q long, key long")
    assert sorted((r.u, r.v) for r in pairs.canonical_pairs(hits).collect()) == [(1, 2), (1, 2), (2, 3)]
    assert sorted((r.u, r.v) for r in pairs.distinct_pairs(pairs.canonical_pairs(hits)).collect()) == [(1, 2), (2, 3)]
    assert pairs.hit_count(hits).first().n_hits == 3
    assert sorted(r.q for r in pairs.users_with_matches(hits).collect()) == [1, 2, 3]
    lines = sorted(r.value for r in pairs.pair_lines(pairs.canonical_pairs(hits)).collect())
    assert lines == ["1, 2", "2, 3"]


def test_sample_pairs_by_rate(spark):
    p = spark.createDataFrame([(i, i + 1) for i in range(2000)], "u long, v long")
    a = {tuple(r) for r in pairs.sample_pairs(p, 0.25, 7).collect()}
    assert a == {tuple(r) for r in pairs.sample_pairs(p.repartition(5), 0.25, 7).collect()}
    assert 400 < len(a) < 600 and a != {tuple(r) for r in pairs.sample_pairs(p, 0.25, 8).collect()}
    # a part's sample is the part of the sample: nothing is capped
    assert {tuple(r) for r in pairs.sample_pairs(p.filter("u < 700"), 0.25, 7).collect()} == {x for x in a if x[0] < 700}
    assert pairs.sample_pairs(p, 0.0).count() == 0 and pairs.sample_pairs(p, 1.0).count() == 2000
    with pytest.raises(ValueError):
        pairs.sample_pairs(p, 1.5)


@pytest.mark.parametrize("max_block", [1, 2, 7, 4096])
def test_blocks_of_any_size_give_each_pair_once(spark, max_block):
    rows = [("hot", k) for k in range(23)] + [("b", 5), ("b", 6), ("alone", 1)] + [("t", k % 3) for k in range(5)]
    df = spark.createDataFrame(rows, "bucket string, key long")
    got = sorted(tuple(r) for r in pairs.bucket_pairs(df, ("bucket",), max_block=max_block).collect())
    want = set(itertools.combinations(range(23), 2)) | {(5, 6)} | {(0, 1), (0, 2), (1, 2)}
    assert got == sorted(want)
    left = spark.createDataFrame([("hot", 100 + k, k * 0.5) for k in range(9)] + [("none", 1, 0.0)], "bucket string, q long, w double")
    met = pairs.cross_pairs(left, df, ("bucket",), "q", "key", ("w",), max_block)
    assert sorted(tuple(r) for r in met.collect()) == sorted(
        ("hot", 100 + q, q * 0.5, k) for q in range(9) for k in range(23))


def test_no_cell_of_a_hot_bucket_exceeds_its_block(spark):
    from pyspark.sql import functions as F

    block, n = 500, 20_000
    rows = spark.range(n).select(F.lit("hot").alias("bucket"), F.col("id").alias("key"))
    cells = (rows.select(F.pmod(F.xxhash64("key"), F.lit(-(-n // block))).alias("own")).groupBy("own").count()
             .agg(F.max("count"), F.count("*")).first())
    # blocks are hashed, so they vary a little around their size; a cell meets two of them
    assert cells[1] == n // block and cells[0] < 1.3 * block
    small = pairs.bucket_pairs(rows.filter("key < 3000"), ("bucket",), max_block=block)
    assert small.count() == 3000 * 2999 // 2


def test_set_similarity_bruteforce(spark):
    rnd = np.random.RandomState(1)
    sets = {k: set(rnd.choice(30, rnd.randint(1, 20), replace=False).tolist()) for k in range(12)}
    df = spark.createDataFrame([(k, str(e)) for k, es in sets.items() for e in es], "key long, element string")
    allp = spark.createDataFrame(list(itertools.combinations(range(12), 2)), "u long, v long")
    got = {(r.u, r.v): r for r in pairs.set_similarity(allp, df).collect()}
    assert len(got) == 66
    for (u, v), r in got.items():
        a, b = sets[u], sets[v]
        assert (r.n_u, r.n_v, r.overlap) == (len(a), len(b), len(a & b))
        assert abs(r.jaccard - len(a & b) / len(a | b)) < 1e-12
        assert abs(r.bincos - len(a & b) / np.sqrt(len(a) * len(b))) < 1e-12
    products = {(r.u, r.v): r.overlap for r in pairs.sparse_products(allp, df).collect()}
    assert products == {k: r.overlap for k, r in got.items() if r.overlap}


def test_vector_cosine_bruteforce_and_zero(spark):
    rnd = np.random.RandomState(9)
    dense = rnd.randint(-3, 4, size=(12, 9)) * (rnd.rand(12, 9) < 0.5)
    dense[7] = 0
    items = [10 ** 12 + 5, 3, 77, 2 ** 40, 0, 1, 9, 123456789, 42]  # arbitrary item ids
    rows = [(k, items[j], int(dense[k, j])) for k in range(12) for j in range(9) if dense[k, j] != 0]
    vec = spark.createDataFrame(rows, "key long, item long, w long")
    allp = spark.createDataFrame(list(itertools.combinations(range(12), 2)), "u long, v long")
    got = {(r.u, r.v): (r.dot, r.cosine) for r in pairs.vector_cosine(allp, vec).collect()}
    for (u, v), (dot, c) in got.items():
        x, y = dense[u].astype(float), dense[v].astype(float)
        assert 7 not in (u, v) and abs(dot - x @ y) < 1e-9
        assert abs(c - x @ y / np.sqrt((x @ x) * (y @ y))) < 1e-12


def test_multimap(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "c", 4)], "k long, val string, o long")
    lv = {r.key: (r.list_len, r.set_size, r.first_value) for r in multimap.list_vs_set(df, "k", "val", "o").collect()}
    assert lv == {1: (3, 2, "a"), 2: (1, 1, "c")}
    gone = spark.createDataFrame([(1, "a")], "k long, val string")
    left = sorted(tuple(r) for r in multimap.remove_values(df, gone, "k", "val", "o").collect())
    assert left == [(1, "a", 2), (1, "b", 3), (2, "c", 4)]
