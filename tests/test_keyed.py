import random

from pyspark.sql import functions as F

from simpairs.operators import banding
from simpairs.operators import minhash as mh
from simpairs.streaming import keyed
from simpairs.streaming import sketches as st

SPEC = mh.SketchSpec(seed=4, num_perm=16)
SCHEMA = "key long, seq long, op string, elements array<string>"


def test_inserts_repeats_and_removals(spark, tmp_path):
    r = random.Random(7)
    sets = {k: [f"e{r.randint(0, 40)}" for _ in range(r.randint(1, 9))] for k in range(12)}
    events, live, rejects, seq = [], {}, [], 0
    for _ in range(120):
        k, op = r.randrange(12), r.choice(["insert", "insert", "remove"])
        elements = [*sets[k], *([f"x{seq}"] if r.random() < 0.3 else [])] if op == "insert" else None
        events.append((k, seq, op, elements))
        if (op == "insert") == (k in live):
            rejects.append((k, seq, "key is there" if op == "insert" else "no such key"))
        elif op == "insert":
            live[k] = elements
        else:
            del live[k]
        seq += 1
    events += [(100, seq, "insert", []), (101, seq, "insert", None), (102, seq, "insert", [None]), (103, seq, "rename", ["a"]),
               (None, seq, "insert", ["a"]), (104, seq, "insert", ["a", None, "a"])]
    rejects += [(100, seq, "no elements"), (101, seq, "no elements"), (102, seq, "no elements"), (103, seq, "unknown event")]
    live[104] = ["a"]
    src, path = str(tmp_path / "src"), str(tmp_path / "index")
    # three batches; within a batch events come in any order
    for part in range(3):
        rows = events[part * 40:(part + 1) * 40] if part < 2 else events[80:]
        r.shuffle(rows)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    files = sorted((tmp_path / "src").glob("*.parquet"), key=lambda f: f.stat().st_mtime)
    assert len(files) == 3
    stream = lambda: st.file_stream(spark, src, "*.parquet", max_files_per_trigger=1)
    keyed.start_keyed_index(stream(), path, SPEC, 4, 3).awaitTermination(300)
    got = sorted(map(tuple, keyed.read_keyed_index(spark, path).collect()))
    batch = spark.createDataFrame([(k, e) for k, s in live.items() for e in s], "key long, element string")
    assert got == sorted(map(tuple, banding.index_rows(batch, 4, 3, SPEC).collect()))
    assert sorted(map(tuple, keyed.read_rejects(spark, path).collect())) == sorted(rejects)
    # the stream goes on from its state: a live key is known, a removed one can come back
    more = [(104, 500, "insert", ["b"]), (104, 501, "remove", None), (104, 502, "insert", ["c"])]
    spark.createDataFrame(more, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    keyed.start_keyed_index(stream(), path, SPEC, 4, 3).awaitTermination(300)
    mine = keyed.read_keyed_index(spark, path).filter(F.col("key") == 104)
    want = banding.index_rows(spark.createDataFrame([(104, "c")], "key long, element string"), 4, 3, SPEC)
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, want.collect()))
    assert keyed.read_rejects(spark, path).filter("key = 104").count() == 1


def test_long_sets_in_chunks(monkeypatch):
    import numpy as np

    ab = mh.permutations(3, 6)
    hashes = np.random.RandomState(1).randint(0, 1 << 32, 1000).astype(np.int64)
    whole = keyed.bucket_texts(hashes, ab, 2, 3)
    monkeypatch.setattr(keyed, "CHUNK", 7)
    assert keyed.bucket_texts(hashes, ab, 2, 3) == whole
