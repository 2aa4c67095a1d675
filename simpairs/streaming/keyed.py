"""A live MinHash index with keyed state: inserts, repeated keys and removals in one stream.

Events are ``(key, seq, op, elements)``: ``op`` is ``insert`` or ``remove``, and a
key's events take effect in the order of ``seq``. A stateless step sketches each
insert into its band buckets; ``transformWithState`` keeps the buckets of every
live key in the state store and turns events into changes:

* an insert of a key that is not live adds its band rows;
* a removal of a live key takes the rows away that were added for it;
* any other event is rejected with its reason, and the stream goes on.

Changes are appended to parquet by the file sink, exactly once. The index is
what they sum up to, so it needs neither an order of files nor a join; state
and work of a batch follow its keys, not the size of the index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from simpairs.functions.hashing import sha1_hash32
from simpairs.operators import minhash
from simpairs.operators.tuning import check_bands
from simpairs.session import ship_package

STORE = "spark.sql.streaming.stateStore.providerClass"
#: Hashes permuted at a time, so a key with very many elements needs bounded memory.
CHUNK = 1 << 14


def bucket_texts(hashes: np.ndarray, ab: np.ndarray, bands: int, rows: int) -> list[str]:
    """The buckets of one set of element hashes, as ``banding.index_rows`` writes them."""
    least = np.full(bands * rows, minhash.MAX_HASH, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        least = np.minimum(least, minhash.permuted_hash_np(hashes[at:at + CHUNK], ab).min(axis=0))
    return ["".join(f"{v:08X}" for v in band) for band in least.reshape(bands, rows).tolist()]


def _sketcher(ab: np.ndarray, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            out = [None if h.as_py() is None else bucket_texts(h.values.to_numpy(zero_copy_only=False), ab, bands, rows)
                   for h in batch.column("hashes")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "seq", "op")), pa.array(out, pa.list_(pa.string()))],
                                             names=["key", "seq", "op", "buckets"])

    return run


def sketched_events(events: DataFrame, spec: minhash.SketchSpec, bands: int, rows: int) -> DataFrame:
    """``(key, seq, op, buckets)``; buckets are null but for inserts of a set that is not empty."""
    check_bands(bands, rows, spec.num_perm)
    ship_package(events.sparkSession)
    present = F.filter("elements", lambda e: e.isNotNull())
    hashes = F.when((F.col("op") == "insert") & (F.size(present) > 0), F.transform(present, sha1_hash32))
    # as ``session.widened``, for a stream of files that Spark cannot split
    n = events.sparkSession.conf.get("spark.simpairs.scanPartitions", None)
    events = events.repartition(int(n)) if n else events
    kind = events.schema["key"].dataType.simpleString()
    ab = minhash.permutations(spec.seed, spec.num_perm)[:bands * rows]
    return (events.filter("key IS NOT NULL").select("key", F.col("seq").cast("long").alias("seq"), "op", hashes.alias("hashes"))
            .mapInArrow(_sketcher(ab, bands, rows), f"key {kind}, seq long, op string, buckets array<string>"))


class LiveKeys(StatefulProcessor):
    """State of a key: its buckets while it is live. A batch's events of one key are held to sort them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.live = handle.getValueState("buckets", "buckets array<string>")

    def handleInputRows(self, key, rows, timerValues):
        state = list(self.live.get()[0]) if self.live.exists() else None
        before = state
        for row in sorted(rows, key=lambda r: (r.seq is not None, r.seq, r.op)):
            reason = ("no elements" if row.op == "insert" and row.buckets is None else
                      "key is there" if row.op == "insert" and state is not None else
                      "no such key" if row.op == "remove" and state is None else
                      None if row.op in ("insert", "remove") else "unknown event")
            if reason:
                yield Row(key=key[0], seq=row.seq, change="reject", band=None, bucket=None, reason=reason)
                continue
            gone, state = state, list(row.buckets) if row.op == "insert" else None
            for band, bucket in enumerate(state or gone):
                yield Row(key=key[0], seq=row.seq, change=row.op, band=band, bucket=bucket, reason=None)
        if state is None and before is not None:
            self.live.clear()
        elif state is not None and state != before:
            self.live.update((state,))

    def close(self) -> None:
        pass


def start_keyed_index(events: DataFrame, path: str, spec: minhash.SketchSpec = minhash.SketchSpec(), bands: int = 22, rows: int = 5,
                      available_now: bool = True) -> StreamingQuery:
    """Apply a stream of events to the index below ``path`` (a folder that driver and executors share).

    Null keys are left out. Repeated events of one ``seq`` take effect one
    after the other, removals last. State lives in the RocksDB store.
    """
    spark = events.sparkSession
    kind = events.schema["key"].dataType.simpleString()
    changes = sketched_events(events, spec, bands, rows).groupBy("key").transformWithState(
        LiveKeys(), f"key {kind}, seq long, change string, band int, bucket string, reason string", "Append", "None")
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        w = (changes.writeStream.format("parquet").outputMode("append").partitionBy("change")
             .option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/changes"))
        return (w.trigger(availableNow=True) if available_now else w).start()
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def _changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/changes")


def read_keyed_index(spark: SparkSession, path: str) -> DataFrame:
    """``(key, band, bucket)`` of the live keys: rows inserted once more than removed."""
    net = F.sum(F.when(F.col("change") == "insert", 1).otherwise(-1))
    return (_changes(spark, path).filter(F.col("change").isin("insert", "remove"))
            .groupBy("key", "band", "bucket").agg(net.alias("n")).filter("n > 0").select("key", "band", "bucket"))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``(key, seq, reason)`` of the events that had no effect."""
    return _changes(spark, path).filter(F.col("change") == "reject").select("key", "seq", "reason")
