"""Structured Streaming: keep MinHash signatures and the banding index current.

* ``start_signature_stream`` – element-at-a-time ``update`` of the reference as
  a stateful streaming aggregate: each micro-batch is pre-aggregated (Arrow
  partial sketch) and merged into the state store with ``min`` per
  ``(key, perm)``. Changed positions go to a parquet table, partitioned by
  batch; ``read_signatures`` takes the minimum per position, which equals the
  batch signature of all rows seen. ``compact_signatures`` keeps that table
  at one row per position, also while the stream runs.
* ``index_upkeep`` – ``insert`` / ``query`` for keys arriving in batches:
  ``foreachBatch`` sketches the new keys, rejects keys already indexed or
  arriving twice, probes the new band rows against index ∪ new, and appends
  band rows, keys and hits to parquet tables. Batches are idempotent per
  ``batch_id`` (a replayed batch overwrites its own partitions).

Index and keys are partitioned by ``shard``, a part of the hash of the bucket
(or key), below ``batch_id``: a batch reads only the shards its own buckets
and keys fall into, so the cost of a small batch does not follow the size of
the index. ``compact_index`` merges the files of many small batches.

File sources need a directory; pick the files with ``pathGlobFilter``. Every
stream writes below an explicit path in a shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from simpairs.operators import banding, minhash
from simpairs.session import materialize, shared_folder, widened

SHARDS = 64
#: Where the positions of the signatures are kept: on disk behind a bounded cache, as their number grows with the keys.
STORE, ON_DISK = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_folder(spark: SparkSession, name: str) -> str:
    """A folder for one stream below ``spark.checkpoint.dir``, else below the warehouse (both are shared)."""
    root = shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/streams/{name}"


def file_stream(spark: SparkSession, directory: str, glob: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of ``directory`` matching ``glob`` (schema from a static read).

    A glob that names a folder of ``directory`` streams the files of that folder.
    """
    if _is_folder(spark, f"{directory.rstrip('/')}/{glob}"):
        directory, glob = f"{directory.rstrip('/')}/{glob}", f"*.{fmt}"
    schema = spark.read.format(fmt).option("pathGlobFilter", glob).load(directory).schema
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def signature_stream(stream_sets: DataFrame, spec: minhash.SketchSpec = minhash.SketchSpec(),
                     key: str = "key", element: str = "element", method: str = "arrow") -> DataFrame:
    """Streaming long-form signatures ``(key, perm, v)`` (stateful ``min``)."""
    return minhash.minhash_signatures(stream_sets, spec, key, element, method)


def _write_batch(df: DataFrame, path: str, *by: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", *by).parquet(path))


def _tag(batch_id: int):
    return F.lit(batch_id).cast("long").alias("batch_id")


def start_signature_stream(stream_sets: DataFrame, path: str,
                           spec: minhash.SketchSpec = minhash.SketchSpec(),
                           available_now: bool = True, method: str = "arrow") -> StreamingQuery:
    """Run ``signature_stream`` in update mode into parquet below ``path``; its state lives in the RocksDB store."""
    spark = stream_sets.sparkSession

    def write(batch, batch_id):
        _write_batch(batch.select("key", "perm", "v", _tag(batch_id)), f"{path}/updates")

    w = (signature_stream(stream_sets, spec, method=method).writeStream.outputMode("update")
         .option("checkpointLocation", f"{path}/checkpoint").foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w
    # a query keeps the settings that it starts with
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ON_DISK)
    try:
        return w.start()
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def read_signatures(spark: SparkSession, path: str) -> DataFrame:
    """Current signatures of a signature stream: a value only ever falls, so the least is the latest."""
    return spark.read.parquet(f"{path}/updates").groupBy("key", "perm").agg(F.min("v").alias("v"))


def compact_signatures(spark: SparkSession, path: str) -> int:
    """Replace the updates of all batches written so far by one row per position; returns their number.

    The stream may be running: its later batches are not touched. The least
    values are written first, under a batch number below zero that no earlier
    compaction had, and only then the folders they replace are deleted, so a
    reader or a lost driver finds each value at least once, at any moment.
    """
    folder = f"{path}/updates"
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = {int(s.getPath().getName()[len("batch_id="):]): s.getPath() for s in fs.listStatus(root)
             if s.getPath().getName().startswith("batch_id=")}
    if len(parts) < 2:
        return 0
    rows = spark.read.option("basePath", folder).parquet(*[p.toString() for p in parts.values()])
    least = rows.groupBy("key", "perm").agg(F.min("v").alias("v"))
    # below every number in use: batches count from 0, compactions from -1 downward
    _write_batch(least.select("*", _tag(min(0, *parts) - 1)), folder)
    for part in parts.values():
        fs.delete(part, True)
    return len(parts)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def _is_folder(spark: SparkSession, path: str) -> bool:
    if any(c in path.rsplit("/", 1)[-1] for c in "*?[{"):
        return False
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def _shard(shards: int, *columns: str):
    return F.pmod(F.xxhash64(*columns), F.lit(shards)).cast("int").alias("shard")


def _stored(spark: SparkSession, path: str, batch_id: int, touched: DataFrame) -> DataFrame | None:
    """Rows of earlier batches in the shards that ``touched`` has (at most as many numbers as shards)."""
    if not _exists(spark, path):
        return None
    shards = [r["shard"] for r in touched.select("shard").distinct().collect()]
    return (spark.read.parquet(path)
            .filter(F.col("shard").isin(shards) & (F.col("batch_id") != F.lit(batch_id))))  # replay-safe


def upkeep_batch(batch: DataFrame, batch_id: int, path: str, spec: minhash.SketchSpec, bands: int, rows: int,
                 check_duplication: bool = True, shards: int = SHARDS) -> None:
    """One micro-batch of ``index_upkeep`` (also callable on a static DataFrame).

    ``batch`` is ``(key, element)``, optionally with ``pos``, the place of the
    element in its arrival (0 for one element of each): with it, a key that
    arrives twice in one batch is rejected like one that is indexed already.
    """
    spark = batch.sparkSession
    # read by the probe and the writes: sketch the batch once
    new_rows = materialize(banding.index_rows(batch.select("key", "element"), bands, rows, spec)
                           .select("key", "band", "bucket", _shard(shards, "band", "bucket")))
    keys = materialize(new_rows.select("key").distinct().select("key", _shard(shards, "key")))
    if check_duplication:
        known = _stored(spark, f"{path}/keys", batch_id, keys)
        found = None if known is None else keys.join(known.select("key"), "key", "left_semi").first()
        if found is None and "pos" in batch.columns:
            found = (batch.filter("pos = 0 AND key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
                     .filter("n > 1").first())
        if found is not None:
            raise ValueError(f"batch {batch_id} brings a key that is not new: {found['key']!r}")
    old = _stored(spark, f"{path}/index", batch_id, new_rows)
    fresh = new_rows.select("key", "band", "bucket")
    pool = fresh if old is None else old.select("key", "band", "bucket").unionByName(fresh)
    hits = banding.index_query(pool, fresh)
    _write_batch(hits.select("q", "key", _tag(batch_id)), f"{path}/hits")
    _write_batch(keys.select("key", _tag(batch_id), "shard").repartition("shard"), f"{path}/keys", "shard")
    _write_batch(new_rows.select("key", "band", "bucket", _tag(batch_id), "shard").repartition("shard"),
                 f"{path}/index", "shard")


def index_upkeep(stream_sets: DataFrame, path: str, spec: minhash.SketchSpec = minhash.SketchSpec(), bands: int = 22,
                 rows: int = 5, available_now: bool = True, shards: int = SHARDS) -> StreamingQuery:
    """Insert arriving keys into the index below ``path`` and record their hits."""

    def run(batch, batch_id):
        upkeep_batch(widened(batch), batch_id, path, spec, bands, rows, shards=shards)

    w = stream_sets.writeStream.foreachBatch(run).option("checkpointLocation", f"{path}/checkpoint")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def compact_index(spark: SparkSession, path: str, target: str) -> None:
    """Write the index and keys below ``path`` to ``target`` with one file per shard, as batch −1.

    Streams may go on from ``target``; its hits start anew.
    """
    for part in ("index", "keys"):
        rows = spark.read.parquet(f"{path}/{part}").drop("batch_id")
        rows = rows.withColumn("batch_id", F.lit(-1).cast("long"))
        _write_batch(rows.repartition("shard"), f"{target}/{part}", "shard")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index").select("key", "band", "bucket")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/hits").select("q", "key")


__all__ = ["file_stream", "signature_stream", "start_signature_stream", "read_signatures", "compact_signatures", "index_upkeep",
           "upkeep_batch", "compact_index", "read_index", "read_hits", "stream_folder"]
