"""Vector searches against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, block int, query string, score int"


def awkward_vectors(n=150, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim)).astype(np.float32)
    v[40:60] = v[40]  # copies: ties
    rows = [(i, [float(c) for c in x], 1, "x", 0, None, 5) for i, x in enumerate(v)]
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1, "x", 0, "q", 5), (250, [1.0, None] + [0.0] * 10, 1, "x", 0, "q", 5), (300, [nan] * dim, None, None, None, None, None),
             (350, [inf] + [0.0] * 11, 1, "x", 0, "q", 5), (None, [1.0] * dim, 1, "x", 0, "q", 5), (400, [0.0] * dim, 1, "x", 0, "q", 5),
             (450, [0.5] * 5, 1, "x", 0, "q", 5), (-50, [float(c) for c in -v[40]], 1, "x", 0, "q", 5), rows[3], rows[3], rows[100]]
    return rows


def usable(rows, nonzero):
    out = {}
    for r in rows:
        if r[0] is None or r[1] is None or any(c is None or not np.isfinite(c) for c in r[1]):
            continue
        if nonzero and not any(r[1]):
            continue
        x = np.zeros(12)
        x[:len(r[1])] = np.array(r[1], np.float32)
        out[r[0]] = x
    return out


def ranked(scores: dict, k: int):
    return sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(awkward_vectors(), SCHEMA).repartition(3)


@pytest.mark.parametrize("block,chunk", [(16_384, 256), (20, 3)])
def test_exact_top_k(spark, vectors, block, chunk):
    from pyspark.sql import functions as F

    from simpairs.llm import bitslice

    x = {i: np.floor(256 * v).astype(np.int64) for i, v in usable(awkward_vectors(), False).items()}
    got = defaultdict(list)
    for r in bitslice.top_k(vectors, F.col("vec_id") % 10 == 0, k=5, block=block, chunk=chunk).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = {q: ranked({i: int(v @ x[q]) for i, v in x.items() if i != q}, 5) for q in x if q % 10 == 0}
    assert got == want


def test_few_candidates_and_empty_tables(spark):
    from pyspark.sql import functions as F

    from simpairs.llm import ann, bitslice

    every = F.col("vec_id") % 50 == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, -1.0]), (50, [-3.0, 0.25])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in bitslice.top_k(few, every).orderBy("query_id", "rank").collect()] == [
        (0, 1, 1, -131072), (0, 2, 50, 256 * -768 + 512 * 64), (50, 1, 1, 64 * -256), (50, 2, 0, 256 * -768 + 512 * 64)]
    assert [tuple(r) for r in ann.search(few, every).orderBy("query_id", "rank").collect()] == [
        (0, 1, 1, -2.0), (0, 2, 50, -2.5), (50, 1, 1, -0.25), (50, 2, 0, -2.5)]
    for none in (few.limit(0), few.filter("vec_id = 1"), few.selectExpr("vec_id", "cast(null as array<float>) AS embedding")):
        assert bitslice.top_k(none, every).count() == 0 and ann.search(none, every).count() == 0


def test_bit_sliced_sums():
    from simpairs.llm.bitslice import BitSlicedIndex

    rng = np.random.default_rng(8)
    values = rng.integers(-300, 300, (130, 9))
    index = BitSlicedIndex(np.arange(130), values)
    for query in (*rng.integers(-300, 300, (20, 9)), np.zeros(9, np.int64)):
        slices, constant = index.scores(query)
        assert index.sums(slices, constant, np.arange(130)) == (values @ query).tolist()


def test_nearest_neighbours_with_ties(spark, vectors):
    from pyspark.sql import functions as F

    from simpairs.llm import ann

    x = usable(awkward_vectors(), True)
    for block in (16_384, 16):
        got = defaultdict(list)
        for r in ann.search(vectors, F.col("vec_id") % 10 == 0, k=20, probe=1.0, block=block, chunk=4).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.vec_id)
            assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-12
        want = {q: [i for i, _ in ranked({i: float((v * x[q]).sum()) for i, v in x.items() if i != q}, 20)] for q in x if q % 10 == 0}
        hits = [len(set(want[q]) & set(got[q])) / len(want[q]) for q in want]
        assert set(got) == set(want) and np.mean(hits) > 0.97
        # the copies tie exactly, so they come by id
        assert [i for i in got[40] if 40 <= i < 60] == sorted(i for i in got[40] if 40 <= i < 60)


def test_recall_beside_a_very_common_vector(spark):
    from pyspark.sql import functions as F

    from simpairs.llm import ann

    rng = np.random.default_rng(6)
    v = rng.standard_normal((1500, 24)).astype(np.float32)
    v[::3] = v[0]
    table = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.search(table.repartition(4), F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    x, hits = v.astype(np.float64), []
    for q in range(0, 1500, 20):
        want = [i for i, _ in ranked({i: float((x[i] * x[q]).sum()) for i in range(1500) if i != q}, 20)]
        hits.append(len(set(want) & set(got[q])) / 20)
    assert np.mean(hits) >= 0.9
    assert got[0] == [i for i in range(3, 63, 3)]  # of 499 copies the smallest ids


@pytest.mark.parametrize("n, times", [(4000, 1e3), (4000, 1e6), (4000, 1e200), (80, 1e6)])
def test_recall_beside_a_very_long_vector(spark, n, times):
    from pyspark.sql import functions as F

    from simpairs.llm import ann

    x = np.random.default_rng(7).standard_normal((n, 64))
    x[n // 2] *= times  # also one of the queries
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(table.repartition(4), F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    hits = []
    for q in range(0, n, 20):
        want = [i for i, _ in ranked({i: s for i, s in enumerate((x @ (x[q] / np.abs(x[q]).max())).tolist()) if i != q}, 20)]
        hits.append(len(set(want) & set(got[q])) / 20)
        assert (n // 2 in want) == (n // 2 in got[q])
    assert np.mean(hits) >= 0.9
    assert hits[n // 40] >= 0.75


@pytest.mark.parametrize("n", [9, 15, 16, 24, 25, 40])
def test_small_tables_give_all_rows_due(spark, n):
    from pyspark.sql import functions as F

    from simpairs.llm import ann

    x = np.random.default_rng(n).standard_normal((n, 8)).tolist()
    x.append([5.0] * 8)
    ids = [*range(n), 0]  # one id with two vectors
    table = spark.createDataFrame(list(zip(ids, x)), "vec_id long, embedding array<double>")
    for block in (16_384, 4):
        got = Counter(r.query_id for r in ann.search(table, F.lit(True), k=20, block=block).collect())
        assert got == {q: min(20, sum(i != q for i in ids)) * ids.count(q) for q in ids}


def test_recall_with_production_parameters(spark):
    from simpairs.llm.queries import op9_ann_search

    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = {r.vec_id: np.array(r.embedding, np.float32).astype(np.float64) for r in rows}
    got = defaultdict(set)
    for r in op9_ann_search(spark, SF).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for q in (i for i in x if i % 20 == 0):
        want = {i for i, _ in ranked({i: float((v * x[q]).sum()) for i, v in x.items() if i != q}, 20)}
        assert len(got[q]) == 20
        hits.append(len(want & got[q]) / 20)
    assert np.mean(hits) >= 0.9


def test_lists_are_dealt_into_blocks_of_bounded_size():
    from simpairs.llm.ann import deal

    sizes = {0: 5, 1: 50, 2: 8, 3: 9, 4: 1}
    n, first, parts = deal(sizes, 10)
    load = Counter()
    for l, size in sizes.items():
        for p in range(parts[l]):
            load[first[l] + p] += size / parts[l]
    assert max(load.values()) <= 10 and max(load) < n and parts[1] == 5


def test_topk_of_components_beyond_a_long(spark):
    from pyspark.sql import functions as F

    from simpairs.llm import bitslice

    search = lambda rows, **kw: bitslice.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, **kw)
    for huge in (1e17, -1e17, 1e300, 2.0 ** 23):
        with pytest.raises(ValueError, match="beyond a long"):
            search([(0, [1.0, huge]), (1, [1.0, 2.0])])
    # just inside the bound, and outside it by a smaller scale
    big = 2.0 ** 22
    rows = search([(0, [big, big]), (1, [-big, -big]), (2, [big, 0.0])]).collect()
    assert [(r.vec_id, r.score) for r in sorted(rows, key=lambda r: r.rank)] == [(2, 2 ** 60), (1, -2 ** 61)]
    assert search([(0, [1.0, 1e8]), (1, [1.0, 1e8])], scale=1).first().score == 10 ** 16 + 1


def test_queries_go_only_to_blocks_that_they_probe(spark):
    """Clustered rows: a few probed lists find the neighbours, and most blocks do not see a query."""
    from pyspark.sql import functions as F

    from simpairs.llm import ann, cells

    rng = np.random.default_rng(8)
    centers = rng.standard_normal((40, 16)) * 4
    points = centers[np.arange(2000) % 40] + rng.standard_normal((2000, 16)) * 0.2
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    seen = []
    plain = cells.in_cells

    def watched(left, n_blocks, right, *rest):
        seen.append((n_blocks, right.groupBy("query_id").count().agg(F.avg("count")).first()[0]))
        return plain(left, n_blocks, right, *rest)

    cells.in_cells = watched
    try:
        found = ann.search(rows, F.col("vec_id") % 20 == 0, k=10, probe=0.1, block=50, chunk=16).collect()
    finally:
        cells.in_cells = plain
    n_blocks, met = seen[0]
    assert n_blocks > 30 and met < n_blocks / 4
    scores = points[::20] @ points.T
    scores[np.arange(100), np.arange(0, 2000, 20)] = -np.inf
    best = {(20 * i, int(v)) for i, row in enumerate(np.argsort(-scores, axis=1)[:, :10]) for v in row}
    got = {(r.query_id, r.vec_id) for r in found}
    assert len(got) == 1000 and len(got & best) >= 900
