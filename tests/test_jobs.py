import itertools

import numpy as np

from simpairs.plans import jobs
from simpairs.sources import tables as tb


def test_planted_documents_found(spark):
    base = " ".join(f"word{i}" for i in range(300))
    near = base.replace("word10 ", "other ")
    docs = spark.createDataFrame(
        [(1, base), (2, base), (3, near), (4, "completely different text here"), (5, "")],
        "doc_id long, text string")
    got = {(r.u, r.v): r.jaccard for r in jobs.near_duplicate_documents(docs, 0.8, seed=2020).collect()}
    assert set(got) == {(1, 3)}  # 2 is a copy of 1
    assert sorted(tuple(r) for r in tb.doc_copy_groups(docs).collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    got = {(r.u, r.v): r.jaccard for r in jobs.near_duplicate_documents(docs, 0.8, seed=2020, expand=True).collect()}
    assert got[(1, 2)] == 1.0 and set(got) == {(1, 2), (1, 3), (2, 3)}


def test_js_pairs_subset_of_bruteforce(spark, sf_small):
    r = tb.ev_ratings(spark, sf_small)
    sets = {}
    for row in r.select("user", "item").collect():
        sets.setdefault(row.user, set()).add(row.item)
    exact = {(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.3}
    got = {(row.u, row.v) for row in jobs.similar_pairs(r, "js", 0.3, seed=2020).collect()}
    assert got <= exact
    cand = {(row.u, row.v) for row in jobs.similar_pairs(r, "js", 0.3, seed=2020, verify=False).collect()}
    assert got == cand & exact


def test_cosine_pairs_vs_bruteforce(spark, sf_small):
    r = tb.ev_ratings(spark, sf_small)
    rows = r.collect()
    users = sorted({x.user for x in rows})
    items = sorted({x.item for x in rows})
    ui, ii = {u: i for i, u in enumerate(users)}, {t: i for i, t in enumerate(items)}
    m = np.zeros((len(users), len(items)))
    b = np.zeros_like(m)
    for x in rows:
        m[ui[x.user], ii[x.item]] = int(x.rating)
        b[ui[x.user], ii[x.item]] = 1
    for binary, mat, t in ((True, b, 0.5), (False, m, 0.4)):
        got = {(row.u, row.v): row.cosine for row in
               jobs.cosine_pairs(r, t, hash_size=4, num_tables=16, binary=binary).collect()}
        for (u, v), c in got.items():
            x, y = mat[ui[u]], mat[ui[v]]
            assert abs(c - round(x @ y / np.sqrt((x @ x) * (y @ y)), 6)) < 1e-9
            assert c >= t
        assert len(got) > 0


def test_group_of_copies_stays_linear_and_expands(spark):
    # a third of the keys are copies of one set
    base = [f"e{i}" for i in range(40)]
    rows = [(k, e) for k in range(30) for e in base]
    rows += [(100 + k, e) for k in range(30) for e in base[k % 10: 30 + k % 10]]
    rows += [(200 + k, f"z{k}_{i}") for k in range(30) for i in range(10)]
    sets = spark.createDataFrame(rows, "key long, element string")
    of = {}
    for k, e in rows:
        of.setdefault(k, set()).add(e)
    rep = {k: min(j for j in of if of[j] == of[k]) for k in of}
    short = {(r.u, r.v): r.jaccard for r in jobs.jaccard_pairs(sets, 0.5, 7).collect()}
    assert set(x for p in short for x in p) <= set(rep.values())
    full = {(r.u, r.v): r.jaccard for r in jobs.jaccard_pairs(sets, 0.5, 7, expand=True).collect()}
    want = {}
    for u, v in itertools.combinations(sorted(of), 2):
        if rep[u] == rep[v]:
            want[(u, v)] = 1.0
        else:
            pair = tuple(sorted((rep[u], rep[v])))
            if pair in short:
                want[(u, v)] = short[pair]
    assert full == want and len(short) < 100 < len(full)
    for (u, v), j in short.items():
        assert j == round(len(of[u] & of[v]) / len(of[u] | of[v]), 6) >= 0.5


def test_expand_pairs_salted_equals_unsalted(spark):
    from simpairs.operators import copies
    # group 0 has 25 members, group 100 has 6, group 200 has 1
    members = spark.createDataFrame([(k, 0) for k in range(25)] + [(100 + k, 100) for k in range(6)]
                                    + [(200, 200)], "key long, rep long")
    reps = spark.createDataFrame([(0, 100, 0.7), (0, 200, 0.6), (100, 200, 0.55)],
                                 "u long, v long, jaccard double")
    a = sorted(tuple(r) for r in copies.expand_pairs(reps, members, {"jaccard": 1.0}).collect())
    b = sorted(tuple(r) for r in copies.expand_pairs(reps, members, {"jaccard": 1.0}, max_block=3).collect())
    assert a == b
    assert len(a) == 25 * 6 + 25 + 6 + 25 * 24 // 2 + 6 * 5 // 2
    assert all(u < v for u, v, _ in a)


def test_doc_copy_groups_skip_wordless_texts(spark):
    from simpairs.sources.tables import doc_copy_groups
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "  \n "), (4, "  \n "), (5, None), (6, "x")],
                                 "doc_id long, text string")
    got = sorted(tuple(r) for r in doc_copy_groups(docs).collect())
    assert got == [(1, 1), (2, 1), (6, 6)]
    pairs = {(r.u, r.v) for r in jobs.near_duplicate_documents(docs, 0.5, seed=3).collect()}
    assert pairs == set()
    pairs = {(r.u, r.v) for r in jobs.near_duplicate_documents(docs, 0.5, seed=3, expand=True).collect()}
    assert pairs == {(1, 2)}


def test_last_rating_counts_and_unordered_repeats_fail(spark):
    import pytest

    rows = [(1, 5, 9.0, 1), (1, 5, 2.0, 2), (1, 6, 3.0, 3), (2, 5, 2.0, 4), (2, 6, 3.0, 5), (3, 7, 1.0, 6)]
    r = spark.createDataFrame(rows, "user long, item long, rating double, at long")
    got = [tuple(x) for x in jobs.cosine_pairs(r, 0.99, 2, 20, order="at").collect()]
    assert got == [(1, 2, 1.0)]
    with pytest.raises(Exception, match="order column"):
        jobs.cosine_pairs(r, 0.99, 2, 20)
