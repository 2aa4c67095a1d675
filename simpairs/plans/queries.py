"""Registered queries: one per operator of the survey inventory.

Every query reads the given tables (whole tables, no id subsets) and returns
a DataFrame whose column names equal those of its DuckDB oracle
(``simpairs.plans.oracle``). Intermediates that several steps read, duplicate
checks and streams run while a query is built; the rest is lazy. Settings
shared with the oracle are constants of this module.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simpairs.operators import banding, copies, elements, exact, minhash, multimap, pairs, probing, projection, quality, stored
from simpairs.plans import jobs
from simpairs.session import materialize
from simpairs.sources import tables as tb

# Fixed settings of the registered queries (the oracle uses the same ones).
SEED = 2020
BANDS, ROWS = 22, 5
SHINGLE = 3
DOC_THRESHOLD = 0.5
JS_THRESHOLD = 0.5
CS_THRESHOLD = 0.5
DCS_THRESHOLD = 0.66
# Bits and tables of random projection. Candidates, as a share of all pairs at sf0.01 and sf0.1:
# vectors 0.35 % and 0.34 %, ratings 1.8 % and 1.8 %, binary vectors (alike: all are positive) 1.8 % and 2.0 %.
VEC_BITS, CS_BITS, DCS_BITS, RP_TABLES = 14, 14, 18, 32
VEC_DIM = 64
VEC_THRESHOLD = 0.3
TOP_K = 5
FEATURES = 40
DOMAIN = (1, 50)
PROBE_LABEL, PROBE_THRESHOLD = 0, 0.2
# Multi-probe: bits, tables and probes beside the own bucket. Forest: trees, bits of their strings, keys that a query meets.
CS_PROBE, DCS_PROBE = (18, 8, 15), (22, 8, 15)
TREES, TREE_BITS, FOREST_CANDIDATES = 8, 20, 400
QUERY_BANDS = 2
SAMPLE_RATE = 0.25

SPEC = minhash.SketchSpec(seed=SEED)


# ---------------------------------------------------------------- shared inputs

def _doc_sets(spark, base):
    return tb.doc_shingles(spark, base, SHINGLE)


def _doc_sig(spark, base):
    return minhash.minhash_signatures(tb.doc_elements(spark, base, SHINGLE), SPEC)


def _doc_index(spark, base, docs=None):
    sets = tb.doc_elements(spark, base, SHINGLE, docs=docs)
    return banding.index_rows(sets, BANDS, ROWS, SPEC)


def _docs_where(spark, base, cond):
    return tb.table(spark, base, "documents").filter(cond)


def _ev_sig(spark, base):
    return minhash.minhash_signatures(tb.ev_sets(spark, base), SPEC, gather=True)


def _ev_index(spark, base):
    return banding.index_rows(tb.ev_sets(spark, base), BANDS, ROWS, SPEC, gather=True)


def _basket_sig(spark, base):
    return minhash.minhash_signatures(tb.basket_sets(spark, base), SPEC, gather=True)


def _customer_keys(spark, base):
    return tb.table(spark, base, "customer").select(F.col("c_custkey").alias("key"))


def _doc_candidates(spark, base):
    docs = tb.table(spark, base, "documents")
    return jobs.jaccard_candidates(tb.doc_elements(spark, base, SHINGLE, docs=docs), SEED,
                                   (BANDS, ROWS), DOC_THRESHOLD,
                                   copy_members=tb.doc_copy_groups(docs))


def _ev_hits(spark, base):
    idx = materialize(_ev_index(spark, base))
    return banding.index_query(idx, idx)


def _vec_sig(spark, base):
    return projection.dense_signatures(tb.vectors(spark, base), VEC_DIM, VEC_BITS, RP_TABLES, SEED,
                                       extra=("label",))


def _vec_scores(spark, base):
    return projection.scored_candidates(_vec_sig(spark, base), RP_TABLES, tb.vectors(spark, base), VEC_DIM)


def _round(df, col, nd=6):
    return df.withColumn(col, F.round(col, nd))


# ---------------------------------------------------------------- queries

def q_ratings_scan(spark, base):
    return tb.event_triples(spark, base).select("user", "item", "rating")


def q_user_item_projection(spark, base):
    li = tb.table(spark, base, "lineitem")
    od = tb.table(spark, base, "orders")
    r = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("rating"))
    return elements.user_items(r)


def q_sha1_hash32(spark, base):
    e = _doc_sets(spark, base).select("element").distinct()
    return e.select("element", minhash.sha1_hash32("element").alias("hv"))


def q_user_item_sets(spark, base):
    return elements.item_set_sizes(tb.ev_ratings(spark, base))


def q_ratings_per_user(spark, base):
    return elements.ratings_per_user(tb.event_triples(spark, base))


def q_feature_sample(spark, base):
    return elements.feature_sample_ratings(tb.ev_ratings(spark, base), FEATURES, SEED) \
        .select("user", "item", "rating")


def q_rating_vectors(spark, base):
    return elements.rating_vectors(tb.event_triples(spark, base), order="event_id")


def q_binary_vectors(spark, base):
    return elements.binary_vectors(tb.event_triples(spark, base))


def q_domain_filter(spark, base):
    return elements.domain_filter(q_ratings_scan(spark, base), *DOMAIN)


def q_parse_points(spark, base):
    e = tb.table(spark, base, "embeddings")
    text = F.concat(F.lit("[["), F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ","),
                    F.lit("],\""), F.col("label").cast("string"), F.lit("\"]"))
    parsed = elements.parse_points(e.select(F.col("vec_id").alias("key"), text.alias("point")))
    return parsed.select("key", F.size("vec").alias("dims"),
                         F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("vsum"),
                         "extra")


def q_minhash_signature(spark, base):
    return _doc_sig(spark, base)


def q_minhash_signature_limbs(spark, base):
    """The same signatures in generated code on longs, without Python."""
    return minhash.minhash_signatures(tb.doc_elements(spark, base, SHINGLE), SPEC, method="limbs")


def q_minhash_rollup(spark, base):
    """Unions of the customers' sketches by nation and region, beside their own, in one pass."""
    c, n = tb.table(spark, base, "customer"), tb.table(spark, base, "nation")
    r = tb.table(spark, base, "region")
    levels = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
              .select(F.col("c_custkey").alias("key"), F.col("r_name").alias("region"), F.col("n_name").alias("nation")))
    out = minhash.union_rollup(_basket_sig(spark, base), levels, "region", "nation")
    return out.select("level", "region", F.coalesce("nation", F.lit("")).alias("nation"),
                      F.coalesce("key", F.lit(-1)).cast("long").alias("key"), "perm", "v")


def q_npy_ratings(spark, base):
    """Ratings written as an array of rows, the reference's file format, and read back in byte ranges."""
    from simpairs.session import shared_path
    from simpairs.sources import npy

    path = shared_path(spark, "arrays") or f"{spark.conf.get('spark.sql.warehouse.dir')}/arrays-{uuid.uuid4().hex}"
    npy.write_npy(q_ratings_scan(spark, base), path)
    return tb.read_ratings(npy.with_npy(spark), path, "npy", columns="user,item,rating")


def q_empty_signature(spark, base):
    return minhash.with_empty_signatures(_customer_keys(spark, base), _basket_sig(spark, base), SPEC)


def _ev_sketched(spark, base):
    """Signatures of the event users and the buckets of their bands, both stored."""
    sig = materialize(_ev_sig(spark, base))
    return materialize(banding.band_buckets(sig, BANDS, ROWS)), sig


def q_minhash_jaccard(spark, base):
    return _round(minhash.met_jaccard_estimate(*_ev_sketched(spark, base)), "jaccard_est")


def q_minhash_cardinality(spark, base):
    return minhash.cardinality(_doc_sig(spark, base))


def q_minhash_merge(spark, base):
    return minhash.met_pair_cardinality(*_ev_sketched(spark, base))


def q_minhash_union(spark, base):
    groups = tb.table(spark, base, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("group"))
    return minhash.union(_basket_sig(spark, base), groups)


def q_minhash_digest(spark, base):
    d = minhash.digest(_doc_sig(spark, base))
    return d.select("key", F.array_join("hashvalues", ",").alias("hashvalues"))


def q_minhash_is_empty(spark, base):
    sig = minhash.with_empty_signatures(_customer_keys(spark, base), _basket_sig(spark, base), SPEC)
    return minhash.is_empty(sig)


def q_identical_signatures(spark, base):
    return minhash.identical_groups(_doc_sig(spark, base))


def q_band_buckets(spark, base):
    return _doc_index(spark, base)


def q_index_insert(spark, base):
    """English documents are indexed, all others (null languages too) inserted."""
    english = F.col("lang").eqNullSafe(F.lit("en"))
    first = _doc_index(spark, base, _docs_where(spark, base, english))
    rest = _doc_index(spark, base, _docs_where(spark, base, ~english))
    return banding.index_insert(first, rest, check_duplication=True)


def q_index_duplicates(spark, base):
    """All documents are indexed; the labelled ones arrive again."""
    labels = tb.table(spark, base, "labels").select(F.col("doc_id").alias("key"))
    return banding.duplicate_keys(_doc_index(spark, base), labels)


def _doc_probe(spark, base):
    """The document index and its rows of German documents as the probe, both stored."""
    idx = materialize(_doc_index(spark, base))
    german = _docs_where(spark, base, F.col("lang") == "de").select(F.col("doc_id").alias("key"))
    return idx, materialize(idx.join(german, "key", "left_semi"))


def q_index_query(spark, base):
    return banding.index_query(*_doc_probe(spark, base))


def q_index_query_bands(spark, base):
    return banding.index_query(*_doc_probe(spark, base), bands=QUERY_BANDS, total_bands=BANDS)


def q_index_query_groups(spark, base):
    """As ``index_query``, between representatives of keys alike in all bands."""
    return banding.grouped_query(*_doc_probe(spark, base))[0]


def q_index_query_members(spark, base):
    """Membership that goes with ``index_query_groups``: ``(side, key, rep)``."""
    _, probe, index = banding.grouped_query(*_doc_probe(spark, base))
    return probe.withColumn("side", F.lit("probe")).unionByName(index.withColumn("side", F.lit("index")))


def _stored_doc_index(spark, base):
    """The document index written once, and its rows of German documents as the probe."""
    idx, probe = _doc_probe(spark, base)
    return stored.store_index(idx), probe


def q_stored_index_query(spark, base):
    """As ``index_query``, but the index lies bucketed and only the probe is shuffled."""
    return stored.query_stored(*_stored_doc_index(spark, base))


def q_stored_index_lookup(spark, base):
    """Buckets of the labelled documents from the stored index."""
    index = _stored_doc_index(spark, base)[0]
    return stored.lookup_stored(index, tb.table(spark, base, "labels"), "doc_id")


def q_index_contains(spark, base):
    idx = banding.index_rows(tb.basket_sets(spark, base), BANDS, ROWS, SPEC, gather=True)
    return banding.index_contains(idx, _customer_keys(spark, base))


def q_index_remove(spark, base):
    idx = _doc_index(spark, base)
    gone = _docs_where(spark, base, F.col("lang") == "en").select(F.col("doc_id").alias("key"))
    return banding.index_remove(idx, gone)


def q_index_is_empty(spark, base):
    return banding.index_is_empty(_doc_index(spark, base), BANDS)


def q_bucket_counts(spark, base):
    return banding.bucket_counts(_doc_index(spark, base))


def q_bucket_subset_counts(spark, base):
    keys = _docs_where(spark, base, F.col("lang") == "de").select(F.col("doc_id").alias("key"))
    return banding.bucket_subset_counts(_doc_index(spark, base), keys)


def q_js_candidate_pairs(spark, base):
    return _doc_candidates(spark, base)


def q_copy_groups(spark, base):
    """Membership that goes with the pairs of representatives: ``(key, rep)`` of documents."""
    return tb.doc_copy_groups(tb.table(spark, base, "documents"))


def q_set_copy_groups(spark, base):
    """Membership by equal item sets of event users."""
    return copies.copy_groups(tb.ev_sets(spark, base))


def q_index_lookup(spark, base):
    idx = banding.index_rows(tb.basket_sets(spark, base), BANDS, ROWS, SPEC, gather=True)
    return banding.index_lookup(idx, _customer_keys(spark, base))


def q_index_stats(spark, base):
    return banding.index_stats(_doc_index(spark, base))


def q_multimap_list_vs_set(spark, base):
    ev = tb.table(spark, base, "events")
    return multimap.list_vs_set(ev, "user_id", "event_type", "event_id")


def q_multimap_remove(spark, base):
    ev = tb.table(spark, base, "events")
    gone = ev.filter(F.col("value") > 40).select("user_id", "event_type")
    return multimap.remove_values(ev, gone, "user_id", "event_type", "event_id")


def q_hyperplanes(spark, base):
    items = tb.event_triples(spark, base).select("item")
    return _round(projection.hyperplanes(items, DCS_BITS, RP_TABLES, SEED), "w")


def q_saved_planes(spark, base):
    """Hash parameters written once and read back; a second save keeps the stored ones."""
    from simpairs.session import shared_path
    from simpairs.sources import sinks

    items = tb.event_triples(spark, base).select("item")
    path = shared_path(spark, "parameters") or f"{spark.conf.get('spark.sql.warehouse.dir')}/parameters-{uuid.uuid4().hex}"
    sinks.save_or_load(projection.hyperplanes(items, CS_BITS, 2, SEED), path)
    return _round(sinks.save_or_load(projection.hyperplanes(items, CS_BITS, 2, SEED + 1), path), "w")


def q_rp_signature(spark, base):
    vec = elements.binary_vectors(tb.event_triples(spark, base))
    return projection.sparse_signatures(vec, DCS_BITS, RP_TABLES, SEED)


def q_rp_index(spark, base):
    return _vec_sig(spark, base)


def q_rp_candidates(spark, base):
    return projection.rp_candidates(_vec_sig(spark, base))


def q_cosine_score(spark, base):
    return _round(_vec_scores(spark, base), "cosine")


def q_cosine_threshold(spark, base):
    return _round(projection.threshold_filter(_vec_scores(spark, base), VEC_THRESHOLD), "cosine")


def q_cosine_topk(spark, base):
    return _round(projection.top_k(_vec_scores(spark, base), TOP_K), "cosine")


def q_rp_probe_topk(spark, base):
    """Points of one label probe the index of all vectors: candidates, score, threshold, top k."""
    index, vec = materialize(_vec_sig(spark, base)), tb.vectors(spark, base)
    probes = vec.filter(F.col("label") == PROBE_LABEL)
    sig = materialize(projection.dense_signatures(probes, VEC_DIM, VEC_BITS, RP_TABLES, SEED))
    return _round(projection.probe_top_k(index, vec, sig, probes, VEC_DIM, PROBE_THRESHOLD, TOP_K), "cosine")


def q_cs_pairs(spark, base):
    """Ratings as they came: the last one of a user and item counts."""
    return jobs.similar_pairs(tb.event_triples(spark, base), "cs", CS_THRESHOLD, SEED, hash_size=CS_BITS,
                              num_tables=RP_TABLES, order="event_id")


def q_dcs_pairs(spark, base):
    return jobs.similar_pairs(tb.event_triples(spark, base), "dcs", DCS_THRESHOLD, SEED, hash_size=DCS_BITS,
                              num_tables=RP_TABLES)


def q_pair_lines(spark, base):
    return pairs.pair_lines(q_dcs_pairs(spark, base))


def q_canonical_pairs(spark, base):
    return pairs.canonical_pairs(_ev_hits(spark, base))


def q_distinct_pairs(spark, base):
    return pairs.distinct_pairs(pairs.canonical_pairs(_ev_hits(spark, base)))


def q_sampled_pairs(spark, base):
    return pairs.sample_pairs(_doc_candidates(spark, base), SAMPLE_RATE, SEED)


def q_hit_count(spark, base):
    return pairs.hit_count(_ev_hits(spark, base))


def q_users_with_matches(spark, base):
    return pairs.users_with_matches(_ev_hits(spark, base))


def q_stream_signature(spark, base):
    """X4: events streamed from the table directory; state = batch signatures."""
    from simpairs.streaming import sketches as st

    path = st.stream_folder(spark, "signature-" + uuid.uuid4().hex)
    ev = st.file_stream(spark, base, "events.parquet")
    sets = ev.select(F.col("user_id").alias("key"), tb.event_item().cast("string").alias("element"))
    st.start_signature_stream(sets, path, SPEC).awaitTermination()
    return st.read_signatures(spark, path)


def q_stream_index(spark, base):
    """X5: documents streamed into the banding index with foreachBatch insert/probe."""
    from simpairs.streaming import sketches as st

    path = st.stream_folder(spark, "index-" + uuid.uuid4().hex)
    docs = st.file_stream(spark, base, "documents.parquet")
    sets = tb.doc_elements(spark, base, SHINGLE, docs=docs, positions=True)
    st.index_upkeep(sets, path, SPEC, BANDS, ROWS).awaitTermination()
    return st.read_index(spark, path)


def _keyed_stream(spark, base):
    """A log of the documents by language, streamed into an index with keyed state; returns its folder.

    All are inserted; French ones are removed again, German ones inserted
    twice, Spanish ones removed before they are there and inserted twice with
    a removal between.
    """
    from simpairs.functions.text import shingles_of_tokens, word_tokens
    from simpairs.streaming import keyed
    from simpairs.streaming import sketches as st

    path = st.stream_folder(spark, "keyed-" + uuid.uuid4().hex)
    ops = lambda *names: F.array(*map(F.lit, names))
    lang = F.coalesce("lang", F.lit(""))
    log = (F.when(lang == "fr", ops("insert", "remove")).when(lang == "de", ops("insert", "insert"))
           .when(lang == "es", ops("remove", "insert", "remove", "insert")).otherwise(ops("insert")))
    docs = st.file_stream(spark, base, "documents.parquet").select(
        F.col("doc_id").alias("key"), word_tokens("text").alias("tokens"), F.posexplode(log).alias("seq", "op"))
    keyed.start_keyed_index(docs.select("key", "seq", "op", shingles_of_tokens("tokens", SHINGLE).alias("elements")),
                            path, SPEC, BANDS, ROWS).awaitTermination()
    return path


def q_stream_keyed_index(spark, base):
    """X5 with keyed state: the live keys' band rows after inserts, repeats and removals."""
    from simpairs.streaming import keyed

    return keyed.read_keyed_index(spark, _keyed_stream(spark, base))


def q_stream_rejects(spark, base):
    """Events of the same stream that had no effect, with their reason."""
    from simpairs.streaming import keyed

    return keyed.read_rejects(spark, _keyed_stream(spark, base))


def q_js_pairs(spark, base):
    return jobs.similar_pairs(tb.ev_ratings(spark, base), "js", JS_THRESHOLD, SEED)


def q_doc_near_duplicates(spark, base):
    docs = tb.table(spark, base, "documents")
    return jobs.near_duplicate_documents(docs, DOC_THRESHOLD, SHINGLE, SEED, (BANDS, ROWS))


# ---------------------------------------------------------------- exact pairs

def q_exact_js_pairs(spark, base):
    """All pairs of event users' item sets at the threshold, without hashing."""
    return jobs.exact_pairs(tb.event_triples(spark, base), "js", JS_THRESHOLD)


def q_exact_doc_pairs(spark, base):
    """All pairs of different texts at the threshold, without hashing."""
    docs = tb.table(spark, base, "documents")
    return exact.jaccard_pairs(tb.doc_digests(spark, base, SHINGLE, docs=docs), DOC_THRESHOLD,
                               copy_members=tb.doc_copy_groups(docs))


def q_exact_cs_pairs(spark, base):
    """All pairs of last ratings' vectors at the threshold, without hashing."""
    return jobs.exact_pairs(tb.event_triples(spark, base), "cs", CS_THRESHOLD, order="event_id")


def q_exact_dcs_pairs(spark, base):
    """All pairs of 0/1 vectors at the threshold, without hashing."""
    return jobs.exact_pairs(tb.event_triples(spark, base), "dcs", DCS_THRESHOLD)


# ---------------------------------------------------------------- multi-probe, forest, quality

def q_hadamard_signature(spark, base):
    """Own bucket and probes of each table, by the structured rotation of 0/1 vectors."""
    sig = probing.hadamard_signatures(q_binary_vectors(spark, base), *DCS_PROBE[:2], SEED, DCS_PROBE[2])
    return sig.select("key", "tbl", F.posexplode("buckets").alias("probe", "bucket"))


def q_multiprobe_cs_pairs(spark, base):
    return jobs.multiprobe_pairs(q_rating_vectors(spark, base), CS_THRESHOLD, *CS_PROBE, SEED)


def q_multiprobe_dcs_pairs(spark, base):
    return jobs.multiprobe_pairs(q_binary_vectors(spark, base), DCS_THRESHOLD, *DCS_PROBE, SEED)


def q_forest_topk(spark, base):
    """The nearest of every vector by sorted sign strings: k rows for each, whatever the bits."""
    vec = tb.vectors(spark, base).select("key", "vec")
    sig = materialize(projection.dense_signatures(vec, VEC_DIM, TREE_BITS, TREES, SEED))
    return _round(probing.forest_top_k(sig, vec, sig, vec, VEC_DIM, TREE_BITS, TOP_K, FOREST_CANDIDATES), "cosine")


def q_lsh_quality(spark, base):
    """Recall, precision and predicted chance of the registered settings by band of similarity."""
    score = lambda df, c: df.select("u", "v", F.round(c, 6).alias("score"))
    out = []

    def report(method, exact_pairs, scored, chance):
        bands = quality.band_report(exact_pairs, materialize(scored), chance)
        out.append(bands.select(F.lit(method).alias("method"), *bands.columns))

    docs = tb.table(spark, base, "documents")
    ev_sets = materialize(tb.ev_sets(spark, base))
    # the sketch hashes the shingles' text, the exact join takes their digests
    minhash_sets = {"js": (ev_sets, ev_sets, JS_THRESHOLD, copies.copy_groups(ev_sets)),
                    "documents": (tb.doc_elements(spark, base, SHINGLE, docs=docs),
                                  materialize(tb.doc_digests(spark, base, SHINGLE, docs=docs)), DOC_THRESHOLD, tb.doc_copy_groups(docs))}
    for method, (sets, members_of, t, members) in minhash_sets.items():
        report(method, score(exact.jaccard_pairs(members_of, t, copy_members=members), "jaccard"),
               score(jobs.scored_sets(sets, members, SEED, (BANDS, ROWS), t, sparse=method == "documents"), "score"), quality.minhash_chance(BANDS, ROWS))
    for method, vec, t, bits, probe in (("cs", q_rating_vectors(spark, base), CS_THRESHOLD, CS_BITS, CS_PROBE),
                                        ("dcs", q_binary_vectors(spark, base), DCS_THRESHOLD, DCS_BITS, DCS_PROBE)):
        vec = materialize(vec)
        members = exact.vector_copies(vec)
        vec = materialize(vec.join(copies.representatives(members), "key", "left_semi"))
        truth = materialize(score(exact.cosine_pairs(vec, t, copy_members=members), "cosine"))
        plain = jobs.sparse_scores(projection.sparse_signatures(vec, bits, RP_TABLES, SEED), RP_TABLES, vec)
        own, looked = probing.own_and_probes(probing.hadamard_signatures(vec, *probe[:2], SEED, probe[2]))
        probed = jobs.sparse_scores(own, probe[1], vec, probe=looked)
        report(method, truth, score(plain, "score"), quality.projection_chance(bits, RP_TABLES))
        report(method + " multi-probe", truth, score(probed, "score"), None)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
