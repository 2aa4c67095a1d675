import hashlib
import random

from simpairs.functions.hashing import seeded_gaussian, seeded_gaussian_py, sha1_hash32, sha1_hash32_py
from pyspark.sql import functions as F

from simpairs.functions.text import word_shingles


def test_sha1_hash32_matches_hashlib(spark):
    rnd = random.Random(7)
    words = ["", "a", "ü", "héllo wörld", "12345"] + [
        "".join(rnd.choice("abcdéß ") for _ in range(rnd.randint(1, 30))) for _ in range(200)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.h for r in df.select("w", sha1_hash32("w").alias("h")).collect()}
    for w in words:
        assert got[w] == int.from_bytes(hashlib.sha1(w.encode("utf8")).digest()[:4], "little")
        assert got[w] == sha1_hash32_py(w.encode("utf8"))


def test_integer_elements_hash_as_text(spark):
    df = spark.createDataFrame([(17,)], "x long")
    assert df.select(sha1_hash32("x").alias("h")).first().h == sha1_hash32_py(b"17")


def test_seeded_gaussian_jvm_equals_python(spark):
    df = spark.range(50).selectExpr("id as item")
    rows = df.select("item", seeded_gaussian(2020, 1, 2, F.col("item")).alias("g")).collect()
    for r in rows:
        assert abs(r.g - seeded_gaussian_py(2020, 1, 2, r.item)) < 1e-12


def test_shingles(spark):
    df = spark.createDataFrame([(1, "A b  C\nd"), (2, "one two"), (3, "   "), (4, None)], "k int, t string")
    got = {r.k: r.s for r in df.select("k", word_shingles("t", 3).alias("s")).collect()}
    assert got[1] == ["a b c", "b c d"]
    assert got[2] == ["one two"]
    assert got[3] is None
    assert got[4] is None
