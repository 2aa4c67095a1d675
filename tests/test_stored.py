import random

import pytest

from simpairs.operators import banding, stored


def exchanges_above_scan(df, table):
    """Exchanges between the scan of a table and the join that reads it, in the physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()  # not run yet: no final plan beside it
    lines = plan.split("\n")
    at = next(i for i, l in enumerate(lines) if f"{table}[" in l)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789")), 0
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if own < depth:
            depth = own
            if "Join" in line:
                return out
            out += "Exchange" in line
    raise AssertionError("no join above the scan")


@pytest.mark.parametrize("block", [4096, 3])
def test_stored_index(spark, block):
    r = random.Random(3)
    rows = [(k, b, f"x{r.randint(0, 30)}" if r.random() < 0.7 else "crowd") for k in range(120) for b in range(3)]
    index = spark.createDataFrame(rows, "key long, band int, bucket string")
    probe = spark.createDataFrame([(1000 + k, b, x) for k, b, x in rows[:30]] + [(2000, 0, "nowhere")], "key long, band int, bucket string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    saved = stored.store_index(index, n_files=4, max_block=block)
    try:
        got = stored.query_stored(saved, probe)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, banding.index_query(index, probe).collect()))
        assert exchanges_above_scan(stored.query_stored(saved, probe), f"{saved.name}_buckets") == 0
        assert (saved.crowds(spark).count() > 0) == (block == 3)
        keys = spark.createDataFrame([(k,) for k in (3, 4, 4, 999)], "id long")
        want = banding.index_lookup(index, keys, "id")
        found = stored.lookup_stored(saved, keys, "id")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        assert exchanges_above_scan(stored.lookup_stored(saved, keys, "id"), f"{saved.name}_keys") == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        saved.drop(spark)


def test_stored_index_empty(spark):
    none = spark.createDataFrame([], "key long, band int, bucket string")
    saved = stored.store_index(none, n_files=2)
    assert stored.query_stored(saved, none).count() == 0
    assert stored.lookup_stored(saved, spark.createDataFrame([(1,)], "key long")).collect()[0].buckets == ""
    saved.drop(spark)
