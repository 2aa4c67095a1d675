from simpairs.session import bucketed, materialize, shared_folder, widened


def test_scan_partitions_are_the_callers_choice(spark):
    narrow = spark.range(100).coalesce(1)
    named = spark.conf.get("spark.simpairs.scanPartitions")
    assert widened(narrow).rdd.getNumPartitions() == int(named)
    spark.conf.unset("spark.simpairs.scanPartitions")
    try:
        assert widened(narrow) is narrow
    finally:
        spark.conf.set("spark.simpairs.scanPartitions", named)


def test_without_a_shared_folder_rows_are_persisted(spark, monkeypatch):
    from simpairs import session

    monkeypatch.setattr(session, "shared_folder", lambda s: None)
    kept = materialize(spark.range(7))
    assert kept.is_cached and kept.count() == 7 and session.shared_path(spark, "x") is None
    session.drop_materialized(spark)
    assert not kept.is_cached
    monkeypatch.undo()
    assert shared_folder(spark)


def test_bucketed_table_joins_without_another_shuffle_of_it(spark):
    t = bucketed(spark.range(1000).selectExpr("id % 50 AS a", "id % 7 AS b", "id"), "a", "b")
    other = spark.range(350).selectExpr("id % 50 AS a", "id % 7 AS b", "id AS x").hint("merge")
    joined = t.join(other, ["a", "b"])
    assert joined.count() == sum(1 for i in range(1000) for j in range(350) if i % 50 == j % 50 and i % 7 == j % 7)
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_materialize_reads_back_same_rows(spark):
    df = spark.range(50).selectExpr("id", "id * 2 AS y")
    m = materialize(df)
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())
    assert "Scan parquet" in m._jdf.queryExecution().simpleString() or m.is_cached


def test_drop_materialized(spark):
    import os

    from simpairs.session import drop_materialized
    m = materialize(spark.range(5))
    path = m.inputFiles()[0]
    assert drop_materialized(spark) >= 1
    assert not os.path.exists(path.replace("file:", ""))
    assert drop_materialized(spark) == 0
