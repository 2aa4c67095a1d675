import pytest

from pyspark.sql import functions as F

from simpairs.operators import banding
from simpairs.operators import minhash as mh
from simpairs.sources import tables as tb
from simpairs.streaming import sketches as st

SPEC = mh.SketchSpec(seed=2020)


def test_signature_stream_equals_batch(spark, sf_small, tmp_path):
    src = tmp_path / "src"
    for part in range(3):
        (tb.table(spark, sf_small, "events").filter(F.col("event_id") % 3 == part).coalesce(1)
         .write.mode("append").parquet(str(src)))
    ev = st.file_stream(spark, str(src), "*.parquet", max_files_per_trigger=1)
    sets = ev.select(F.col("user_id").alias("key"), tb.event_item().cast("string").alias("element"))
    st.start_signature_stream(sets, str(tmp_path / "sig"), SPEC).awaitTermination(300)
    streamed = st.read_signatures(spark, str(tmp_path / "sig"))
    batch = mh.minhash_signatures(tb.ev_sets(spark, sf_small), SPEC)
    assert sorted(tuple(r) for r in streamed.collect()) == sorted(tuple(r) for r in batch.collect())


def test_signatures_compacted_while_the_stream_goes_on(spark, sf_small, tmp_path):
    src, path = tmp_path / "src", str(tmp_path / "sig")
    sets_of = lambda ev: ev.select(F.col("user_id").alias("key"), tb.event_item().cast("string").alias("element"))
    rows = tb.table(spark, sf_small, "events")
    removed = []
    for part in range(5):
        rows.filter(F.col("event_id") % 5 == part).coalesce(1).write.mode("append").parquet(str(src))
        ev = st.file_stream(spark, str(src), "*.parquet", max_files_per_trigger=1)
        st.start_signature_stream(sets_of(ev), path, SPEC).awaitTermination(300)
        if part in (1, 3):
            removed.append(st.compact_signatures(spark, path))
    assert removed == [2, 3]  # two batches; one compaction and two batches
    stored = spark.read.parquet(path + "/updates")
    assert sorted(r.batch_id for r in stored.select("batch_id").distinct().collect()) == [-2, 4]
    batch = mh.minhash_signatures(tb.ev_sets(spark, sf_small), SPEC)
    expected = sorted(tuple(r) for r in batch.collect())
    assert sorted(tuple(r) for r in st.read_signatures(spark, path).collect()) == expected
    assert st.compact_signatures(spark, path) == 2 and st.compact_signatures(spark, path) == 0
    assert sorted(tuple(r) for r in st.read_signatures(spark, path).collect()) == expected


def test_index_upkeep_multi_batch(spark, sf_small, tmp_path):
    # split the documents into three files so the stream sees three batches
    src = tmp_path / "src"
    docs = tb.table(spark, sf_small, "documents").select("doc_id", "text", "lang")
    for lang_set in (["en"], ["fr"], ["de", "es"]):
        docs.filter(F.col("lang").isin(lang_set)).coalesce(1).write.mode("append").parquet(str(src))
    stream = st.file_stream(spark, str(src), "*.parquet", max_files_per_trigger=1)
    sets = tb.doc_elements(spark, "", 3, docs=stream, positions=True)
    path = str(tmp_path / "index")
    st.index_upkeep(sets, path, SPEC, shards=4).awaitTermination(600)
    index = st.read_index(spark, path)
    batch_index = banding.band_buckets(
        mh.minhash_signatures(tb.doc_elements(spark, sf_small, 3), SPEC), 22, 5)
    assert sorted(tuple(r) for r in index.collect()) == sorted(tuple(r) for r in batch_index.collect())
    assert spark.read.parquet(path + "/index").select("batch_id").distinct().count() == 3
    # every pair found by the all-pairs batch query is recorded from the later key's side
    hits = {(r.q, r.key) for r in st.read_hits(spark, path).collect()}
    full = {(r.q, r.key) for r in banding.index_query(batch_index, batch_index).collect()}
    assert hits <= full
    undirected = {(min(a, b), max(a, b)) for a, b in hits if a != b}
    assert undirected == {(min(a, b), max(a, b)) for a, b in full if a != b}
    # compacted: the same rows, one file per shard, and upkeep goes on from there
    target = str(tmp_path / "compact")
    st.compact_index(spark, path, target)
    assert sorted(map(tuple, st.read_index(spark, target).collect())) == sorted(map(tuple, index.collect()))
    again = spark.createDataFrame([(0, "x")], "key long, element string")
    with pytest.raises(ValueError, match="not new"):
        st.upkeep_batch(again, 9, target, SPEC, 22, 5, shards=4)


def test_upkeep_rejects_known_and_repeated_keys_and_replay_is_idempotent(spark, tmp_path):
    rows = [(1, "a b c"), (2, "a b d")]
    first = spark.createDataFrame([(k, e) for k, t in rows for e in t.split()], "key long, element string")
    path = str(tmp_path / "i")
    st.upkeep_batch(first, 0, path, SPEC, 22, 5)
    # replaying batch 0 overwrites its own partitions instead of failing or duplicating
    st.upkeep_batch(first, 0, path, SPEC, 22, 5)
    assert st.read_index(spark, path).count() == 2 * 22
    again = spark.createDataFrame([(2, "x")], "key long, element string")
    with pytest.raises(ValueError, match="not new"):
        st.upkeep_batch(again, 1, path, SPEC, 22, 5)
    twice = spark.createDataFrame([(5, "x", 0), (5, "y", 1), (5, "z", 0)], "key long, element string, pos int")
    with pytest.raises(ValueError, match="not new"):
        st.upkeep_batch(twice, 2, path, SPEC, 22, 5)


def test_a_batch_reads_only_its_shards(spark, tmp_path):
    path = str(tmp_path / "i")
    for k in range(3):
        sets = spark.createDataFrame([(k, f"e{k}{i}") for i in range(4)], "key long, element string")
        st.upkeep_batch(sets, k, path, SPEC, 2, 5, shards=512)
    touched = spark.createDataFrame([(7,)], "shard int")
    plan = st._stored(spark, path + "/index", 99, touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "shard" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_signature_state_lies_in_the_disk_store(spark, tmp_path):
    """And the session's own setting stays."""
    import glob

    spark.createDataFrame([(1, "a"), (2, "b")], "key long, element string").write.parquet(str(tmp_path / "in"))
    before = spark.conf.get(st.STORE, None)
    stream = spark.readStream.schema("key long, element string").parquet(str(tmp_path / "in"))
    st.start_signature_stream(stream, str(tmp_path / "out"), mh.SketchSpec(3)).awaitTermination()
    assert spark.conf.get(st.STORE, None) == before
    assert all(st.ON_DISK in open(f).read() for f in glob.glob(f"{tmp_path}/out/checkpoint/offsets/[0-9]*"))
    assert {r["key"] for r in st.read_signatures(spark, str(tmp_path / "out")).collect()} == {1, 2}
