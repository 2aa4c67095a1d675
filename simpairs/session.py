"""Session helpers: a local session for tests/bench and lineage cutting.

Library code never creates a session; it works on whatever session the
DataFrames belong to. ``local_session`` is for tests, ``bench.py`` and the
driver contract only.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "simpairs", checkpoint_dir: str | None = None) -> SparkSession:
    """A local[N] session configured like the cluster one (AQE on, UI off).

    ``checkpoint_dir`` is set where the configuration names none; without
    one, intermediates are persisted.
    """
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.simpairs.scanPartitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not shared_folder(spark):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    None when the session names none. A context whose checkpoint folder was
    set by its owner (``sc.setCheckpointDir``, as the tests do) counts too.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    return named or sc.getCheckpointDir()


def shared_path(spark: SparkSession, kind: str) -> str | None:
    """A new path for one table below the shared folder; None without such a folder."""
    import uuid

    root = shared_folder(spark)
    if root is None:
        return None
    path = f"{root.rstrip('/')}/simpairs-{kind}/{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for several later uses, cutting its lineage.

    The rows are written as a parquet table below the shared folder of
    ``spark.checkpoint.dir`` and read back, so later stages scan files that
    outlive any executor. A session without such a folder keeps the rows by
    ``persist`` instead (recomputed from their lineage if lost).
    """
    from pyspark import StorageLevel

    path = shared_path(df.sparkSession, "tables")
    if path is None:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        _KEPT.setdefault(df.sparkSession.sparkContext.applicationId, []).append(kept)
        return kept
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, *columns: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once as a table bucketed by ``columns``, and read it.

    Later joins and groupings by exactly these columns read its buckets as
    they are, without another shuffle of its rows. The table lies in the
    session's warehouse and has as many buckets as there are shuffle
    partitions, the number other sides of such joins are dealt into.
    """
    import uuid

    spark = df.sparkSession
    name = f"simpairs_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.mode("error").option("compression", compression).bucketBy(n, *columns)
     .format("parquet").saveAsTable(name))
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)


def own_tables(spark: SparkSession, *names: str) -> None:
    """Let ``drop_materialized`` drop these tables of the warehouse too."""
    _TABLES.setdefault(spark.sparkContext.applicationId, []).extend(names)


_KEPT: dict[str, list[DataFrame]] = {}
_TABLES: dict[str, list[str]] = {}
_WRITTEN: dict[str, list[str]] = {}


def drop_materialized(spark: SparkSession) -> int:
    """Delete (and unpersist) the intermediate tables of this application; returns how many tables.

    Call once the results that depend on them have been written or collected:
    DataFrames built on a dropped table can no longer be evaluated.
    """
    sc = spark.sparkContext
    for kept in _KEPT.pop(sc.applicationId, []):
        kept.unpersist()
    for name in _TABLES.pop(sc.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _WRITTEN.pop(sc.applicationId, [])
    jvm = sc._jvm
    for path in paths:
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)
    return len(paths)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``simpairs`` importable in Python workers (once per application).

    Operators that run Arrow UDFs call this; it zips the package and hands it
    to ``addPyFile`` which distributes it to every executor.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="simpairs-pyfiles-")
    zpath = os.path.join(out_dir, "simpairs.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    arc = os.path.join("simpairs", os.path.relpath(full, pkg_dir))
                    zf.write(full, arc)
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def widened(df: DataFrame) -> DataFrame:
    """Deal a scan into the number of partitions that ``spark.simpairs.scanPartitions`` names.

    For inputs of one large row group, which Spark cannot split, on a session
    that runs them in local mode. Unset, as on a cluster, the scan stays as
    it is; the number of rows or partitions plays no part.
    """
    n = df.sparkSession.conf.get("spark.simpairs.scanPartitions", None)
    return df.repartition(int(n)) if n and not df.isStreaming else df
