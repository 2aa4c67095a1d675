"""Operators on texts against their plain versions, over awkward documents."""

import math
from collections import Counter, defaultdict

import llm_brute as brute
import pytest


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.awkward_documents(), brute.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def by_id_and_text(rows):
    """Order of op3: id (null last), then content; equal rows are one document."""
    from collections import OrderedDict

    distinct = OrderedDict(((r[0], r[1]), None) for r in rows)
    return list(distinct)


# ------------------------------------------------------------------ tokens

def test_encoder_twin_equals_library():
    from simpairs.llm import tokens

    path = tokens.default_tokenizer()
    fast, library = tokens.Encoder(path), tokens.Encoder(path, twin=False)
    assert fast.plain is not None and library.plain is None
    texts = ["", " ", "a b", "it's we'll don't I'd 'tis", "x  y\n\nz \n", "é è ß ñ Ü1²", "tab\there\x0b\x0cx", "<|endoftext|>",
             "a<|endoftext|>b", "日本語 text", "n b\u0085s", "a\x1cb \x1f", "emoji 😀 ok", "ÿþ ª º µ ¼½ 2³", "'", "''s", "x'S"]
    texts += ["".join(chr(c) for c in (32, 97, i, 98, i, 49, i)) for i in range(1, 256)]
    for t in texts:
        assert fast.ids(t) == library.ids(t), repr(t)


def test_token_counts(spark, docs, empty, tmp_path):
    from simpairs.llm import token_counts, tokens

    library = tokens.Encoder(tokens.default_tokenizer(), twin=False)
    want = Counter((r[0], len((r[1] or "").encode()), len(library.ids(r[1] or "")), len(library.ids(r[1] or "")) > 1024)
                   for r in brute.awkward_documents())
    cache = str(tmp_path / "cache")
    for stored in (None, cache, cache):
        assert Counter(map(tuple, token_counts.token_counts(docs, cache=stored).collect())) == want
    assert token_counts.token_counts(empty, cache=str(tmp_path / "none")).count() == 0
    # a warm cache is looked up, not recomputed: a wrong stored count comes back
    rows = token_counts.read_cache(spark, cache)
    assert rows.count() == len({r[1] or "" for r in brute.awkward_documents()})
    path = str(tmp_path / "wrong")
    rows.withColumn("n_tokens", rows.n_tokens + 7).write.parquet(path)
    got = token_counts.token_counts(docs.union(docs.limit(1).selectExpr("1000", "'brand new'", *docs.columns[2:])), cache=path)
    got = {r.doc_id: r.n_tokens for r in got.collect()}
    assert got[1000] == len(library.ids("brand new"))
    assert got[1] == len(library.ids(brute.awkward_documents()[1][1])) + 7
    # another tokenizer has entries of its own
    import public_tokenizers
    other = token_counts.token_counts(docs, tokenizer=public_tokenizers.path("piece_bpe_32k.model"), cache=cache)
    assert other.count() == docs.count()


def test_packing(spark, docs, empty, monkeypatch):
    from simpairs.llm import packing, tokens

    library = tokens.Encoder(tokens.default_tokenizer(), twin=False)
    ids = defaultdict(list)
    for r in brute.awkward_documents():
        ids[r[0]].append(library.ids(r[1] or ""))
    for parts in (1, 3, 40):
        assert brute.check_pieces([tuple(r) for r in packing.pack(docs.repartition(parts)).collect()], ids) < 0.01
    monkeypatch.setattr(packing, "HELD", 3000)
    assert brute.check_pieces(packed_here(packing, brute.awkward_documents()), ids) < 0.01
    assert packing.pack(empty).count() == 0


def packed_here(packing, rows):
    """The pieces of one task, in this process."""
    from unittest import mock

    import pyarrow as pa
    from simpairs.llm import common, tokens

    schema = common.arrow_schema(f"doc_id long, {packing.COLUMNS}", None)
    task = mock.Mock()
    task.get.return_value.partitionId.return_value = 3
    batch = pa.RecordBatch.from_pylist([{"doc_id": r[0], "text": r[1]} for r in rows])
    with mock.patch("pyspark.TaskContext", task):
        out = packing._packer(tokens.default_tokenizer(), packing.WINDOW, 0, schema)(iter([batch]))
        return [tuple(x.values()) for b in out for x in b.to_pylist()]


def test_packing_padding(spark, sf_small):
    """Under 1 % padding on the given tables in 1 to 211 tasks, and where every piece is longer than half a window."""
    from simpairs.llm import packing, tokens

    library = tokens.Encoder(tokens.default_tokenizer(), twin=False)
    given = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    text = "one two three " * 200
    copies = spark.range(500).selectExpr("id AS doc_id", f"'{text}' AS text")
    assert 513 < len(library.ids(text)) < 700
    for docs in (given, copies):
        ids = {r.doc_id: [library.ids(r.text)] for r in docs.collect()}
        for parts in (1, 32, 211):
            pieces = [tuple(r) for r in packing.pack(docs.repartition(parts)).collect()]
            assert brute.check_pieces(pieces, ids) < 0.01
    # whole documents are the rule: cuts only fill gaps
    pieces = [tuple(r) for r in packing.pack(given.repartition(1)).collect()]
    cut = sum(start % 1024 != 0 for _, start, *_ in pieces)
    assert cut < 0.1 * len(pieces)


def test_fill_cuts_only_into_gaps():
    import random

    from simpairs.llm.packing import fill, tail

    r = random.Random(8)
    for _ in range(50):
        pieces = [(d, 0, r.choice([r.randint(1, 63), 40])) for d in range(r.randint(0, 80))]
        full, loose = fill(pieces, 64)
        rest = tail(loose, 64)
        covered = Counter((d, i) for w in [*full, *rest] for d, s, e in w for i in range(s, e))
        assert covered == Counter((d, i) for d, s, e in pieces for i in range(s, e))
        assert all(sum(e - s for _, s, e in w) >= 56 for w in full)
        sizes = [sum(e - s for _, s, e in w) for w in rest]
        assert all(n & (n - 1) == 0 and n < 64 for n in sizes) and sizes == sorted(set(sizes), reverse=True)


def test_best_fit_decreasing_equals_a_linear_search():
    import random

    from simpairs.llm.packing import best_fit_decreasing

    r = random.Random(3)
    for _ in range(30):
        lengths = sorted((r.randint(1, 63) for _ in range(r.randint(0, 200))), reverse=True)
        where, offsets, n = best_fit_decreasing(lengths, 64)
        room = []
        for length, w, o in zip(lengths, where, offsets):
            fits = [c for c in room if c >= length]
            if fits:
                assert room[w] == min(fits)
            else:
                assert w == len(room)
                room.append(64)
            assert o == 64 - room[w]
            room[w] -= length
        assert n == len(room)


# ------------------------------------------------------------------ mixing

def test_mix(spark, docs, empty):
    from simpairs.llm import mixing

    rows = brute.awkward_documents()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += brute.n_words(r[1])
    targets = brute.source_targets(sizes)
    got = mixing.mix(docs, keep=("doc_id", "source", "text")).collect()
    assert Counter((r.row.doc_id, r.row.source, r["size"]) for r in got) == Counter((r[0], r[3], brute.n_words(r[1])) for r in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.row.source]
        assert math.isclose(r.target, targets[r.row.source], rel_tol=1e-12)
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == sum(r.parts)
        assert all((t is None) == (p == 0) and (t is None or 0 <= t <= 1) for t, p in zip(r.positions, r.parts))
        taken[r.row.source] += r.taken
    assert all(taken[s] == int(targets[s]) for s in sizes)
    again = mixing.mix(docs.repartition(7), keep=("doc_id", "source", "text")).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))
    assert mixing.by_position(mixing.mix(empty)).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mix_follows_the_schedule(spark):
    from simpairs.llm import mixing

    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b c d e' AS text", "if(id % 2 = 0, 'x', 'y') AS source")
    schedules = spark.createDataFrame([("x", [(0.0, 1.0), (0.5, 1.0), (1.0, 0.0)]), ("y", [(0.0, 0.0), (1.0, 1.5)])],
                                      "source string, knots array<struct<t: double, w: double>>")
    rows = mixing.mix(docs, schedules, share=0.8, keep=("source",)).collect()
    area = {"x": lambda t: t if t < .5 else .5 + (t - .5) - (t - .5) ** 2, "y": lambda t: .75 * t * t}
    for s in ("x", "y"):
        times = sorted(t for r in rows if r.row.source == s for t in r.positions if t is not None)
        assert len(times) == 1600
        for i, t in enumerate(times):
            assert math.isclose(area[s](t) / .75, i / 1600, abs_tol=1e-9)


def test_mixed_documents_keep_columns_and_order(docs):
    from simpairs.llm import mixing

    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs, keep=("doc_id", "text")).collect():
        want[(r.row.doc_id, r.row.text)] += sum(2 * p >= r["size"] and p > 0 for p in r.parts)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +want


# ------------------------------------------------------------------ line dedup

def test_line_dedup(spark, docs, empty):
    from simpairs.llm import lines

    rows = brute.awkward_documents()
    got = lines.dedup_lines(docs).collect()
    assert len(got) == len(rows)
    # no two rows of one id differ in text unless listed; order by id with null last, then by content
    order = sorted(by_id_and_text(rows), key=lambda p: (p[0] is None, p[0] or 0))
    kept = brute.dedup_lines([t for _, t in order])
    want = {p: k for p, k in zip(order, kept)}
    same_id = {p[0] for p, n in Counter(p[0] for p in order).items() for p in [(p,)] if n > 1}
    lookup = defaultdict(list)
    for r in got:
        lookup[r.row.doc_id].append((r.kept, r.n_removed))
    for (doc_id, text), result in want.items():
        if doc_id not in same_id:
            assert set(lookup[doc_id]) == {result}
    assert sum(n for _, n in kept) > 5
    assert lines.dedup_lines(empty).count() == 0
    out = lines.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == len(rows)


def test_line_dedup_random_lines(spark):
    import random

    from simpairs.llm import lines

    r = random.Random(5)
    pool = [" ".join(r.choice(brute.WORDS) for _ in range(k)) for k in (1, 2, 3, 5, 8, 20, 30, 55, 60) for _ in range(3)]
    texts = ["\n".join(r.choice(pool + ["", " "]) for _ in range(r.randint(0, 14))) for _ in range(250)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x.row.doc_id: (x.kept, x.n_removed) for x in lines.dedup_lines(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute.dedup_lines(texts)


# ------------------------------------------------------------------ suffix dedup

def _spans(frame):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in frame.collect())


def test_suffix_dedup(spark, docs, empty):
    from simpairs.llm import suffix

    rows = brute.awkward_documents()
    for length in (200, 40):
        want = Counter((r[0], *s) for r, s in zip(rows, brute.repeated_spans([r[1] for r in rows], length)))
        assert _spans(suffix.repeated_spans(docs, length)) == want
    assert suffix.repeated_spans(empty).count() == 0


@pytest.mark.parametrize("part, chunk", [(7, 20), (1, 5_000)])
def test_suffix_dedup_cuts_large_groups_into_bands(spark, monkeypatch, part, chunk):
    import random

    from simpairs.llm import suffix

    # parts of one run: every mixed group is cut down to bands of one window
    monkeypatch.setattr(suffix, "PART", part)
    monkeypatch.setattr(suffix, "CHUNK", chunk)
    r = random.Random(11)
    noise = lambda k: "".join(r.choice("abcde ") for _ in range(k))
    hot = noise(70)
    texts = [noise(r.randint(0, 60)) + hot[r.randint(0, 30):r.randint(40, 70)] + noise(r.randint(0, 60)) for _ in range(150)]
    texts += ["ab" * 100, "ab" * 90, "a" * 150, texts[3][10:60] + texts[9][20:70], "ü" * 80]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter((i, *s) for i, s in enumerate(brute.repeated_spans(texts, 30)))
    assert _spans(suffix.repeated_spans(docs, 30)) == want


def test_suffix_order_is_the_order_of_suffixes(monkeypatch):
    import numpy as np

    from simpairs.llm import suffix

    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    place = rng.integers(0, 400, 120)
    size = np.minimum(rng.integers(0, 40, 120), 400 - place)
    group = np.sort(rng.integers(0, 5, 120))
    texts = [data[p:p + s].tobytes() for p, s in zip(place, size)]

    def check(order, same):
        assert [(group[i], texts[i]) for i in order] == sorted(zip(group, texts))
        for k in range(1, 120):
            s, t = texts[order[k - 1]], texts[order[k]]
            if group[order[k - 1]] == group[order[k]]:
                assert same[k] == next((i for i in range(min(len(s), len(t))) if s[i] != t[i]), min(len(s), len(t)))

    check(*suffix.suffix_order(data, place, size, group))
    # hashes that always agree are found out by the byte check
    monkeypatch.setattr(suffix.PrefixHashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    check(*suffix.suffix_order(data, place, size, group))


# ------------------------------------------------------------------ SimHash

def test_close_words_share_a_codeword():
    import numpy as np

    from simpairs.llm import simhash

    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    keys = simhash.codeword_keys(words)
    assert ((keys >= 0).sum(axis=1) >= 1).all() and keys.max() < 1 << 12
    for bit in range(23):
        near = simhash.codeword_keys(words ^ (1 << bit))
        shared = (keys[:, :, None] == near[:, None, :]) & (keys >= 0)[:, :, None]
        assert shared.any(axis=(1, 2)).all()


def test_all_links_within_three_bits_are_found(spark):
    import random

    from simpairs.llm import simhash

    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(60)]
    values = set(base)
    for b in base:
        for k in (1, 2, 3, 3, 3, 4, 4):
            values.add(b ^ sum(1 << i for i in r.sample(range(64), k)))
    # one error in each segment
    values |= {b ^ (1 << 50) ^ (1 << 30) ^ (1 << 5) for b in base}
    values = sorted(v - (v >> 63 << 64) for v in values)
    found = {tuple(x) for x in simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()}
    want = {(u, v) for i, u in enumerate(values) for v in values[i + 1:] if ((u ^ v) & (1 << 64) - 1).bit_count() <= 3}
    assert found == want and len(want) > 200


def test_simhash_groups(spark, docs, empty):
    from simpairs.llm import simhash

    rows = brute.awkward_documents()
    prints = [brute.fingerprint(r[1]) for r in rows]
    groups = brute.link_groups(prints)
    least = {}
    for r, g in zip(rows, groups):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = Counter((r[0], p - (p >> 63 << 64), least.get(g)) for r, p, g in zip(rows, prints, groups))
    assert Counter((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()) == want
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns
    kept = [brute.fingerprint(r.text) for r in one.collect()]
    assert len(kept) == len(set(groups)) and set(kept) <= set(prints)
    ids = [r.doc_id for r in one.collect()]
    assert Counter(ids) == Counter(least.get(g) for g in set(groups))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_components_of_long_paths(spark):
    from simpairs.llm.graph import components

    edges = [(i, i + 1) for i in range(40)] + [(i, 100) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


@pytest.mark.parametrize("crowd,cell", [(1024, 8192), (4, 6)])
def test_simhash_crowded_keys(spark, monkeypatch, crowd, cell):
    """Families that agree in two segments: the same components, in cells of any size, with few links."""
    import random

    from simpairs.llm import simhash
    from simpairs.llm.graph import components

    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "CELL", cell)
    r = random.Random(11)
    signed = lambda x: x - (x >> 63 << 64)
    values = {r.getrandbits(64) for _ in range(40)}
    for _ in range(3):
        base = r.getrandbits(64) >> 18 << 18
        values |= {base | r.getrandbits(18) for _ in range(60)}
        values |= {base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(20)}
    values = sorted(signed(v) for v in values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.links(df, 3)
    roots = {x.node: x.root for x in components(found).collect()}
    groups = brute.link_groups([v & (1 << 64) - 1 for v in values], 3)
    assert [roots.get(v, v) for v in values] == [values[g] for g in groups]


def test_simhash_large_family_has_linear_links(spark):
    import random

    from simpairs.llm import simhash

    r = random.Random(2)
    base = r.getrandbits(46) << 18
    values = sorted({base | r.getrandbits(18) for _ in range(20000)})
    df = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fp long")
    found = [tuple(x) for x in simhash.links(df, 3).collect()]
    assert len(found) < 8 * len(values)
    assert all((u ^ v).bit_count() <= 3 for u, v in found)


def test_line_dedup_compares_every_continuation(spark):
    """A run that repeats goes whole, whichever earlier document holds it; fingerprints are window minima."""
    from simpairs.llm import lines

    a, b = " ".join(["alpha beta gamma"] * 20), " ".join(["delta echo fox"] * 20)
    texts = [f"{a}\nfoo", f"{a}\nX", f"{a}\nX", f"Y\n{a}\nX", f"Y\n{b}\nZ", f"Y\n{a}\nZ", f"one\n{b}\nZ", "s\ns\ns\ns\ns", f"Z\n{a}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.row.doc_id: x.kept for x in lines.dedup_lines(docs).collect()}
    assert got == {0: texts[0], 1: "X", 2: "", 3: "Y", 4: texts[4], 5: "Z", 6: "one", 7: "s", 8: "Z"}
    assert [got[i] for i in range(9)] == [k for k, _ in brute.dedup_lines(texts)]
    # one position per selected place, each run held by the place its window selects
    hashes, words = [5, 3, 9, 7, 1, 8], [10] * 6
    assert lines.winnowed(hashes, words, 50, 3) == [(1, [(0, 3), (1, 4)]), (4, [(2, 5), (3, 6)])]
    assert lines.winnowed([4, 4], [60, 1], 50, 3) == [(0, [(0, 1), (0, 2)])]


def test_simhash_keyed_rows_are_never_broadcast(spark, tmp_path):
    """Dozens of keyed rows come of one fingerprint, more than Spark's estimate says: their self-join is a merge join."""
    from simpairs.llm import simhash

    path = str(tmp_path / "fingerprints")
    spark.range(50).selectExpr("xxhash64(id) AS fp").write.parquet(path)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("-1", "0")
    plan = simhash.links(spark.read.parquet(path), 3)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
