import pytest

from simpairs.operators import banding
from simpairs.operators import minhash as mh
from simpairs.operators.pairs import bucket_pairs
from simpairs.sources import tables as tb

SPEC = mh.SketchSpec(seed=2020)


@pytest.fixture(scope="module")
def ev_index(spark, sf_small):
    return banding.band_buckets(mh.minhash_signatures(tb.ev_sets(spark, sf_small), SPEC), 22, 5).cache()


def test_bucket_shape(ev_index):
    rows = ev_index.collect()
    n_keys = len({r.key for r in rows})
    assert len(rows) == 22 * n_keys
    assert all(len(r.bucket) == 40 for r in rows)


def test_query_bands_monotone(ev_index):
    prev = set()
    for b in (1, 5, 11, 22):
        got = {(r.q, r.key) for r in banding.index_query(ev_index, ev_index, bands=b, total_bands=22).collect()}
        assert prev <= got
        prev = got
    with pytest.raises(ValueError):
        banding.index_query(ev_index, ev_index, bands=23, total_bands=22)


def test_insert_remove_identity(spark, ev_index):
    keys = ev_index.select("key").distinct().filter("key < 50")
    rest = banding.index_remove(ev_index, keys)
    back = banding.index_insert(rest, ev_index.join(keys, "key", "left_semi"))
    assert sorted(back.collect()) == sorted(ev_index.collect())
    with pytest.raises(ValueError):
        banding.index_insert(ev_index, ev_index.filter("key = 1"))
    missing = spark.createDataFrame([(10 ** 9,)], "key long")
    with pytest.raises(ValueError):
        banding.index_remove(ev_index, missing, must_exist=True)


def test_lookup_and_stats(spark, ev_index):
    keys = spark.createDataFrame([(1,), (10 ** 9,)], "key long")
    got = {r.key: r.buckets for r in banding.index_lookup(ev_index, keys).collect()}
    assert got[10 ** 9] == ""
    assert len(got[1].split(",")) == 22
    st = banding.index_stats(ev_index).first()
    assert st.n_rows == 22 * st.n_keys
    assert banding.index_is_empty(ev_index, 22).first().is_empty is False
    assert banding.index_is_empty(ev_index.filter("band < 3"), 22).first().is_empty is True


def test_candidates_equal_self_query(ev_index):
    hits = banding.index_query(ev_index, ev_index)
    expected = {(min(r.q, r.key), max(r.q, r.key)) for r in hits.collect() if r.q != r.key}
    got = {(r.u, r.v) for r in bucket_pairs(ev_index).collect()}
    assert got == expected


def test_salted_pairs_equal_plain(spark):
    # one hot bucket of 40 keys, split in blocks of 4: every pair exactly once
    rows = [(0, "hot", k) for k in range(40)] + [(1, "b", 1), (1, "b", 2), (2, "c", 3)]
    df = spark.createDataFrame(rows, "band int, bucket string, key long")
    got = [(r.u, r.v) for r in bucket_pairs(df, max_block=4).collect()]
    expected = {(a, b) for a in range(40) for b in range(a + 1, 40)} | {(1, 2)}
    assert len(got) == len(set(got)) == len(expected)
    assert set(got) == expected


def test_index_query_in_blocks_equals_plain_join(spark):
    from pyspark.sql import functions as F

    from simpairs.operators.pairs import cross_pairs

    index = spark.createDataFrame([(k, 0, "h") for k in range(40)] + [(50, 0, "x"), (50, 1, "h")],
                                  "key long, band int, bucket string")
    probe = spark.createDataFrame([(k, 0, "h") for k in range(100, 117)] + [(200, 1, "h"), (201, 3, "h")],
                                  "key long, band int, bucket string")
    plain = (probe.select(F.col("key").alias("q"), "band", "bucket").join(index, ["band", "bucket"])
             .select("q", "key").distinct())
    want = sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, banding.index_query(index, probe).collect())) == want
    for block in (1, 6):
        met = cross_pairs(probe, index, ("band", "bucket"), "key", "key", max_block=block)
        assert sorted((r._x, r._y) for r in met.collect()) == want


def test_a_key_given_twice_or_known_is_a_duplicate(spark, ev_index):
    keys = sorted({r.key for r in ev_index.select("key").distinct().collect()})
    none = ev_index.filter("false")
    new = ev_index.filter(f"key = {keys[0]}")
    assert banding.duplicate_keys(none, new).count() == 0
    assert [r.key for r in banding.duplicate_keys(none, new.union(new)).collect()] == [keys[0]]
    with pytest.raises(ValueError, match=str(keys[0])):
        banding.index_insert(none, new.union(new))
    arrivals = spark.createDataFrame([(keys[1],), (-7,), (-8,), (-8,)], "key long")
    assert sorted(r.key for r in banding.duplicate_keys(ev_index, arrivals).collect()) == [-8, keys[1]]


def test_fewer_bands_find_less(spark):
    """The registered setting of the band-limited query differs from the whole query."""
    from simpairs.plans import queries as q

    sf = "/root/testdata/sf0.01"
    whole, few = (q.QUERIES[n](spark, sf).count() for n in ("index_query", "index_query_bands"))
    assert 0 < few < whole


def test_grouped_query_expands_to_the_plain_one(spark, ev_index):
    from pyspark.sql import functions as F

    # copies of users 1 to 5 under other keys, on both sides
    twins = ev_index.filter("key <= 5").select((F.col("key") + 10 ** 6).alias("key"), "band", "bucket")
    index = ev_index.unionByName(twins).unionByName(twins.withColumn("key", F.col("key") + 10 ** 6))
    probe = index.filter("key % 3 = 1")
    for bands in (None, 3):
        hits, probes, members = banding.grouped_query(index, probe, bands, 22)
        plain = sorted(map(tuple, banding.index_query(index, probe, bands, 22).collect()))
        assert sorted(map(tuple, banding.expand_hits(hits, probes, members).collect())) == plain
        assert hits.count() < len(plain)
        rep = {r.key: r.rep for r in members.collect()}
        assert len(rep) == index.select("key").distinct().count()
        assert all(rep[k + 10 ** 6] == rep[k + 2 * 10 ** 6] == rep[k] <= k for k in range(1, 6) if k in rep)
    with pytest.raises(ValueError):
        banding.grouped_query(index, probe, 23, 22)
    hits, probes, members = banding.grouped_query(index, probe.limit(0))
    assert hits.count() == probes.count() == 0 < members.count()
