import importlib


def test_entry_and_registry(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["u", "v", "jaccard"]
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 50


def test_sinks_roundtrip(spark, tmp_path):
    from simpairs.sources import sinks
    from simpairs.operators.projection import hyperplanes

    items = spark.range(5).selectExpr("id as item")
    planes = hyperplanes(items, 1, 3, 2)
    path = str(tmp_path / "planes")
    first = sorted(tuple(r) for r in sinks.save_or_load(planes, path).collect())
    # a second save without overwrite keeps the stored copy
    other = hyperplanes(items, 2, 3, 2)
    again = sorted(tuple(r) for r in sinks.save_or_load(other, path).collect())
    assert first == again
    replaced = sorted(tuple(r) for r in sinks.save_or_load(other, path, overwrite=True).collect())
    assert replaced != first
    out = str(tmp_path / "pairs")
    p = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "u long, v long")
    sinks.write_pairs(p, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["1, 2", "3, 4"]
