from simpairs.operators import elements


def test_rating_vectors_later_row_wins_and_truncates(spark):
    r = spark.createDataFrame(
        [(1, 5, 3.9, 1), (1, 5, -2.7, 2), (1, 6, 0.4, 3), (2, 5, 4.0, 4)],
        "user long, item long, rating double, ev long")
    got = sorted(tuple(x) for x in elements.rating_vectors(r, order="ev").collect())
    assert got == [(1, 5, -2), (2, 5, 4)]  # 0.4 truncates to 0 → absent
    assert sorted(tuple(x) for x in elements.binary_vectors(r).collect()) == [(1, 5, 1), (1, 6, 1), (2, 5, 1)]


def test_domain_filter_and_sample(spark):
    r = spark.createDataFrame([(1, i, 1.0) for i in range(0, 30)], "user long, item long, rating double")
    assert [x.item for x in elements.domain_filter(r, 1, 5).orderBy("item").collect()] == [1, 2, 3, 4, 5]
    s1 = [x.item for x in elements.feature_sample(r, 7, 3).collect()]
    s2 = [x.item for x in elements.feature_sample(r, 7, 3).collect()]
    assert s1 == s2 and len(set(s1)) == 7
    assert elements.feature_sample_ratings(r, 7, 3).count() == 7


def test_parse_points_forms(spark):
    df = spark.createDataFrame([(1, "[1.5, 2, -3]"), (2, '[[0.5, 1], "x"]')], "key long, point string")
    got = {x.key: (x.vec, x.extra) for x in elements.parse_points(df).collect()}
    assert got[1] == ([1.5, 2.0, -3.0], None)
    assert got[2] == ([0.5, 1.0], "x")


def test_sets_and_counts(spark):
    r = spark.createDataFrame([(1, 7, 1.0), (1, 7, 2.0), (1, 8, 1.0), (0, 9, 1.0)], "user long, item long, rating double")
    assert sorted(tuple(x) for x in elements.item_set_sizes(r).collect()) == [(0, "9", 1), (1, "7", 2), (1, "8", 2)]
    assert sorted(tuple(x) for x in elements.ratings_per_user(r).collect()) == [(0, 1), (1, 3)]
