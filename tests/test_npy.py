import numpy as np
import pytest

from simpairs.sources import npy
from simpairs.sources import tables as tb


def test_array_is_read_in_ranges(spark, tmp_path):
    a = np.random.RandomState(1).randint(0, 10 ** 6, (1000, 3))
    np.save(tmp_path / "user_movie_rating.npy", a)
    path = str(tmp_path / "user_movie_rating.npy")
    npy.with_npy(spark)
    df = spark.read.format("npy").option("columns", "user, item,rating").option("rangeBytes", 24 * 130).load(path)
    assert df.schema.simpleString() == "struct<user:bigint,item:bigint,rating:bigint>"
    assert df.rdd.getNumPartitions() == 8  # 1000 rows by 130
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, a.tolist()))
    r = tb.read_ratings(spark, f"file://{path}", "npy", columns="user,item,rating")
    assert r.schema["rating"].dataType.simpleString() == "double" and r.count() == 1000


@pytest.mark.parametrize("dtype,kind", [("<i4", "int"), (">f8", "double"), ("<f4", "float"), ("<u4", "bigint"), ("|i1", "tinyint")])
def test_types(spark, tmp_path, dtype, kind):
    a = np.arange(12).reshape(6, 2).astype(dtype)
    np.save(tmp_path / "a.npy", a)
    npy.with_npy(spark)
    df = spark.read.format("npy").load(str(tmp_path))
    assert df.dtypes == [("c0", kind), ("c1", kind)] and sorted(map(tuple, df.collect())) == sorted(map(tuple, a.tolist()))


def test_other_shapes(spark, tmp_path):
    npy.with_npy(spark)
    read = lambda name, **o: spark.read.format("npy").options(**o).load(str(tmp_path / name))
    np.save(tmp_path / "one.npy", np.arange(5))
    assert [r[0] for r in read("one.npy").orderBy("c0").collect()] == [0, 1, 2, 3, 4]
    np.save(tmp_path / "none.npy", np.zeros((0, 3)))
    assert read("none.npy").count() == 0
    np.save(tmp_path / "columns.npy", np.asfortranarray(np.ones((3, 2))))
    np.save(tmp_path / "cube.npy", np.ones((2, 2, 2)))
    np.save(tmp_path / "text.npy", np.array([["a", "b"]]))
    (tmp_path / "other.npy").write_bytes(b"something else")
    for bad in ("columns.npy", "cube.npy", "text.npy", "other.npy", "missing.npy"):
        with pytest.raises(Exception):
            read(bad).collect()
    with pytest.raises(Exception):
        read("one.npy", columns="a,b").collect()
    # a file that ends early is an error, not fewer rows
    data = (tmp_path / "one.npy").read_bytes()
    (tmp_path / "short.npy").write_bytes(data[:-4])
    with pytest.raises(Exception, match="ends before"):
        read("short.npy").collect()


def test_written_arrays(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS user", "id % 7 AS item", "CASE WHEN id = 5 THEN NULL ELSE id / 2 END AS rating").repartition(3)
    path = str(tmp_path / "out")
    npy.write_npy(df, path)
    files = sorted((tmp_path / "out").iterdir())
    assert [f.name for f in files] == ["part-00000.npy", "part-00001.npy", "part-00002.npy"]
    whole = np.concatenate([np.load(f) for f in files])
    assert whole.shape == (100, 3) and np.isnan(whole[whole[:, 0] == 5, 2]).all()
    back = spark.read.format("npy").load(path)
    assert back.filter("c0 != 5").selectExpr("sum(c0)", "sum(c1)", "sum(c2)").first()[:] == \
        df.filter("user != 5").selectExpr("sum(user)", "sum(item)", "sum(rating)").first()[:]
    npy.write_npy(df.select("user", "item"), str(tmp_path / "whole"), "<i8")
    assert np.load(tmp_path / "whole" / "part-00000.npy").dtype == np.int64
    with pytest.raises(Exception, match="nulls"):
        npy.write_npy(df, str(tmp_path / "bad"), "<i8")
