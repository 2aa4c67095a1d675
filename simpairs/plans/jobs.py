"""End-to-end similar-pair jobs (the three methods and document near-duplicates).

Each job is a composition of operators and returns canonical pairs
``(u, v, score)`` with u < v. Intermediates that several steps read are stored
when the job is built. Plan shape of the Jaccard job:

    scan → elements → sha1 hv → [Arrow partial sketch] → shuffle (key, band) min
         → cells of bucket blocks, to which a key's elements travel
         → exact overlap, filter and first shared bucket inside the cell

Copies are collapsed: pairs are pairs of representatives, and ``copy_groups``
gives the membership ``(key, rep)``; ``expand=True`` writes out all member pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.operators import banding, cells, copies, elements, exact, listed, minhash, pairs, probing, projection
from simpairs.operators.tuning import check_bands, optimal_bands, projection_tables, validate
from simpairs.session import materialize

METHOD_THRESHOLDS = {"js": 0.5, "cs": 0.67, "dcs": 0.66}


def _representative_sets(sets: DataFrame, members: DataFrame) -> DataFrame:
    return sets.join(copies.representatives(members), "key", "left_semi")


def _index(sets: DataFrame, seed: int, bands, threshold: float, num_perm: int, gather: bool) -> tuple[DataFrame, int]:
    """Band rows ``(key, band, bucket)`` of the sets, and the number of bands."""
    validate(threshold, num_perm)
    b, r = bands if bands is not None else optimal_bands(threshold, num_perm)
    check_bands(b, r, num_perm)
    spec = minhash.SketchSpec(seed=seed, num_perm=num_perm)
    return banding.index_rows(sets, b, r, spec, gather=gather), b


def _candidates(sets: DataFrame, seed: int, bands, threshold: float, num_perm: int, gather: bool = False) -> DataFrame:
    return pairs.bucket_pairs(_index(sets, seed, bands, threshold, num_perm, gather)[0], ("band", "bucket"), "key")


def jaccard_candidates(sets: DataFrame, seed: int = 1, bands: tuple[int, int] | None = (22, 5),
                       threshold: float = 0.5, num_perm: int = 128, expand: bool = False,
                       copy_members: DataFrame | None = None) -> DataFrame:
    """Unverified MinHash-LSH candidate pairs ``(u, v)`` of representatives of equal sets.

    ``bands=None`` picks (b, r) by the false-positive/negative tuner.
    ``copy_members`` may supply the copy groups ``(key, rep)`` (covering exactly
    the keys that have elements) when the caller knows a cheaper fingerprint.
    """
    members = copies.copy_groups(sets) if copy_members is None else copy_members
    found = _candidates(_representative_sets(sets, members), seed, bands, threshold, num_perm)
    return copies.expand_pairs(found, members) if expand else found


def scored_sets(sets: DataFrame, members: DataFrame, seed: int, bands, threshold: float, num_perm: int = 128,
                least: float | None = None, gather: bool = False, sparse: bool = False) -> DataFrame:
    """``(u, v, dot, score)`` of the LSH candidates by exact Jaccard, from ``least`` on, scored where they meet.

    Elements travel as 64-bit digests; sets of very many elements are joined by
    their text. ``sparse`` is for large sets that meet few others: the pairs
    are listed first, and a set is sent to groups of its pairs (``listed``)
    instead of all its buckets, most of which it shares by chance.
    """
    index, b = _index(_representative_sets(sets, members), seed, bands, threshold, num_perm, gather)
    rows = materialize(index.select("key", F.col("band").alias("tbl"), "bucket"))
    if sparse:
        met = materialize(cells.canonical(cells.met_pairs(rows, b)))
        found = met.filter("plain").select("u", "v").unionByName(met.filter("NOT plain").select("u", "v").distinct())
        ends = materialize(found.select(F.explode(F.array("u", "v")).alias("key")).distinct())
        own = (sets.join(ends, "key", "left_semi")
               .select("key", F.when(F.col("element").isNotNull(), F.xxhash64("element")).alias("element")).distinct())
        lists = materialize(own.groupBy("key").agg(F.count("*").alias("n"), F.collect_list("element").alias("items")))
        scored = listed.jaccard(found, lists.select("key", F.explode("items").alias("element")), lists.select("key", "n"))
        scored = scored.select("u", "v", F.col("overlap").cast("double").alias("dot"), F.col("jaccard").alias("score"))
        return scored if least is None else scored.filter(F.col("score") >= F.lit(least))
    crowded = rows.groupBy("tbl", "bucket").agg(F.count("*").alias("_n")).filter("_n > 1").select("tbl", "bucket")
    keys = materialize(rows.join(crowded, ["tbl", "bucket"], "left_semi").select("key").distinct())
    mine = sets.join(keys, "key", "left_semi")
    digests = mine.select("key", F.when(F.col("element").isNotNull(), F.xxhash64("element")).alias("element")).distinct()

    def joined(cand):
        both = cand.select(F.explode(F.array("u", "v")).alias("key")).distinct()
        texts = materialize(sets.join(both, "key", "left_semi").distinct())
        return pairs.set_similarity(cand, texts).select("u", "v", F.col("overlap").cast("double").alias("dot"), F.col("jaccard").alias("score"))

    return cells.sparse_pairs(rows, b, digests, cells.jaccard_of, joined, least, "element", None)


def jaccard_pairs(sets: DataFrame, threshold: float = 0.5, seed: int = 1,
                  bands: tuple[int, int] | None = (22, 5), num_perm: int = 128,
                  ndigits: int = 6, expand: bool = False,
                  copy_members: DataFrame | None = None, gather: bool = False, sparse: bool = False) -> DataFrame:
    """Verified pairs of representatives: LSH candidates whose exact Jaccard is ≥ ``threshold``.

    ``sets`` may repeat an element within a key: the sketch ignores repeats,
    and set semantics are restored (``distinct``) only for candidate keys. The
    members of a copy group, Jaccard 1, follow from ``copies.copy_groups``.
    ``gather`` tells that the elements of a key lie scattered over the tasks,
    ``sparse`` that sets are large and meet few others (see ``scored_sets``).
    """
    members = copies.copy_groups(sets) if copy_members is None else copy_members
    out = scored_sets(sets, members, seed, bands, threshold, num_perm, threshold, gather, sparse).select(
        "u", "v", F.round("score", ndigits).alias("jaccard"))
    return copies.expand_pairs(out, members, {"jaccard": 1.0}) if expand else out


def cosine_pairs(ratings: DataFrame, threshold: float, hash_size: int, num_tables: int | None = None,
                 recall: float = 0.9, seed: int = 2020, order: str | None = None,
                 feature_dims: int | None = None, binary: bool = False, ndigits: int = 6) -> DataFrame:
    """Random-projection candidates verified by exact cosine ≥ ``threshold``.

    ``binary=False`` scores truncated rating vectors (cs), the last rating by
    ``order`` where a user rated an item twice; ``binary=True`` scores item
    presence, i.e. |A∩B| / sqrt(|A|·|B|) (dcs). ``hash_size`` is the caller's:
    about log2(rows) − 4 bits at least, more for vectors that are alike, as
    the share of all pairs that meet falls by bits only. Without ``num_tables``
    there are as many tables as a pair at the threshold needs to be found with
    chance ``recall``; fewer tables cost recall (``projection_recall``), which
    pairs found never show.
    """
    if feature_dims is not None:
        ratings = elements.feature_sample_ratings(ratings, feature_dims, seed)
    tables = projection_tables(threshold, recall, hash_size) if num_tables is None else num_tables
    # the vectors are read by the signature, the sizes/norms and the scorer:
    # aggregate the raw ratings once instead of once per reader
    vec = materialize(elements.binary_vectors(ratings) if binary
                      else elements.rating_vectors(ratings, order))
    scored = sparse_scores(projection.sparse_signatures(vec, hash_size, tables, seed), tables, vec, threshold, binary=binary)
    return scored.select("u", "v", F.round("score", ndigits).alias("cosine"))


def sparse_scores(sig: DataFrame, tables: int, vec: DataFrame, threshold: float | None = None, binary: bool = False,
                  probe: DataFrame | None = None) -> DataFrame:
    """``(u, v, dot, score)`` of the pairs that share a bucket, by exact cosine, scored where they meet."""
    if binary:
        s = vec.select("key", F.col("item").alias("element"))
        joined = lambda p: pairs.set_similarity(p, s).select("u", "v", F.col("overlap").cast("double").alias("dot"),
                                                             F.col("bincos").alias("score"))
        return cells.sparse_pairs(sig, tables, s, cells.bincos_of, joined, threshold, "element", None, probe)
    joined = lambda p: pairs.vector_cosine(p, vec, "item", "w").withColumnRenamed("cosine", "score")
    return cells.sparse_pairs(sig, tables, vec, cells.cosine_of, joined, threshold, "item", "w", probe)


def multiprobe_pairs(vec: DataFrame, threshold: float, hash_size: int, num_tables: int, probes: int, seed: int = 2020,
                     ndigits: int = 6) -> DataFrame:
    """Multi-probe candidates of integer vectors ``(key, item, w)``, verified by exact cosine ≥ ``threshold``.

    Few tables do the work of many: each key looks into ``probes`` buckets
    beside its own in every table.
    """
    vec = materialize(vec)
    own, probe = probing.own_and_probes(probing.hadamard_signatures(vec, hash_size, num_tables, seed, probes))
    return (sparse_scores(own, num_tables, vec, threshold, probe=probe)
            .select("u", "v", F.round("score", ndigits).alias("cosine")))


def exact_pairs(ratings: DataFrame, method: str = "js", threshold: float | None = None, order: str | None = None,
                ndigits: int = 6) -> DataFrame:
    """Every pair of ``(user, item, rating)`` triples at the threshold, by js, cs or dcs, without hashing.

    Pairs of smallest keys of equal sets or vectors; their members follow from
    ``copies.copy_groups`` and ``exact.vector_copies``.
    """
    if method not in METHOD_THRESHOLDS:
        raise ValueError(f"unknown method {method!r}; use js, cs or dcs")
    t = METHOD_THRESHOLDS[method] if threshold is None else threshold
    if method == "js":
        return exact.jaccard_pairs(materialize(elements.item_sets(ratings)), t, ndigits)
    vec = elements.binary_vectors(ratings) if method == "dcs" else elements.rating_vectors(ratings, order)
    return exact.cosine_pairs(materialize(vec), t, ndigits)


def similar_pairs(ratings: DataFrame, method: str = "js", threshold: float | None = None,
                  seed: int = 2020, verify: bool = True, **kw) -> DataFrame:
    """Method dispatch over ``(user, item, rating)`` triples: js / cs / dcs (cs and dcs need ``hash_size``)."""
    if method not in METHOD_THRESHOLDS:
        raise ValueError(f"unknown method {method!r}; use js, cs or dcs")
    t = METHOD_THRESHOLDS[method] if threshold is None else threshold
    if method == "js":
        # read by the copy fingerprint, the sketch and the verification
        sets = materialize(elements.item_sets(ratings))
        if not verify:
            return jaccard_candidates(sets, seed=seed, threshold=t, **kw)
        return jaccard_pairs(sets, t, seed=seed, gather=True, **kw)
    return cosine_pairs(ratings, t, seed=seed, binary=(method == "dcs"), **kw)


def near_duplicate_documents(docs: DataFrame, threshold: float = 0.5, k: int = 3,
                             seed: int = 1, bands: tuple[int, int] | None = (22, 5),
                             num_perm: int = 128, expand: bool = False) -> DataFrame:
    """Pairs of distinct texts whose k-word-shingle sets have Jaccard ≥ ``threshold``.

    A text is named by the least id of its documents (``tables.doc_copy_groups``).
    """
    from simpairs.sources.tables import doc_copy_groups, doc_elements

    sets = doc_elements(docs.sparkSession, "", k, docs=docs)
    return jaccard_pairs(sets, threshold, seed, bands, num_perm, expand=expand,
                         copy_members=doc_copy_groups(docs), sparse=True)
