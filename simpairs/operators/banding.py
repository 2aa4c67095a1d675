"""MinHash banding index as one DataFrame ``(key, band, bucket)``.

The index is an ordinary table: inserting is a union/append, probing is an
equi-join on ``(band, bucket)``, removing is an anti-join, and every
"storage view" (keys, sizes, item counts) is a group-by of the same rows.
Buckets are the hex text of the band's ``rows`` values in permutation order
(8 digits each – every value is below 2**32), so equal bands ⇔ equal buckets,
with no hash collisions and half the join-key bytes of a 64-bit layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.functions.hashing import sha1_hash32
from simpairs.operators import cells, copies, minhash
from simpairs.operators.pairs import cross_pairs
from simpairs.operators.tuning import check_bands
from simpairs.session import materialize

DEFAULT_BANDS = (22, 5)


def _hex8(v):
    return F.lpad(F.hex(v), 8, "0")


def index_rows(sets: DataFrame, bands: int = DEFAULT_BANDS[0], rows: int = DEFAULT_BANDS[1],
               spec: minhash.SketchSpec = minhash.SketchSpec(), key: str = "key", element: str = "element",
               hashfunc=sha1_hash32, gather: bool = False) -> DataFrame:
    """Element sets → ``(key, band, bucket)`` in one shuffle; ``bands`` rows per key.

    The same rows as ``band_buckets`` of the signature, which stays the way
    from a stored signature. ``gather`` as in ``minhash.minhash_signatures``.
    """
    check_bands(bands, rows, spec.num_perm)
    hashes = minhash.element_hashes(sets, key, element, hashfunc)
    hashes = minhash.gathered(hashes) if gather else hashes
    bucket = F.concat(*[_hex8(f"m{j}") for j in range(rows)])
    return minhash.band_minimums(hashes, bands, rows, spec).select("key", "band", bucket.alias("bucket"))


def band_buckets(sig: DataFrame, bands: int = DEFAULT_BANDS[0], rows: int = DEFAULT_BANDS[1],
                 num_perm: int = 128) -> DataFrame:
    """Long-form signatures → ``(key, band, bucket)``; ``bands`` rows per key.

    Only the first ``bands * rows`` permutations are used. The group-by is on
    (key, band), so each group holds exactly ``rows`` values.
    """
    check_bands(bands, rows, num_perm)
    used = sig.filter(F.col("perm") < F.lit(bands * rows))
    grouped = (used.groupBy("key", (F.col("perm") / F.lit(rows)).cast("int").alias("band"))
               .agg(F.array_sort(F.collect_list(F.struct("perm", "v"))).alias("_pv")))
    bucket = F.array_join(F.transform("_pv", lambda x: _hex8(x["v"])), "")
    return grouped.select("key", "band", bucket.alias("bucket"))


def duplicate_keys(index: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Keys of ``new_rows`` that the index has already, or that the new rows hold twice (distinct).

    ``new_rows`` are band rows (a repeated (key, band) is a repeated key) or
    just keys, one row per arrival.
    """
    by = ["key", "band"] if "band" in new_rows.columns else ["key"]
    twice = new_rows.groupBy(*by).agg(F.count("*").alias("_n")).filter("_n > 1").select("key")
    # a semi-join ignores repeats on the index side: no distinct over the whole index
    known = new_rows.select("key").distinct().join(index.select("key"), "key", "left_semi")
    return known.unionByName(twice).distinct()


def index_insert(index: DataFrame, new_rows: DataFrame, check_duplication: bool = True) -> DataFrame:
    """Append band rows of new keys; with ``check_duplication`` a key indexed or given twice fails.

    The new rows are read by the check and by the result, so they are computed once.
    """
    new_rows = new_rows.select("key", "band", "bucket")
    if check_duplication:
        new_rows = materialize(new_rows)
        found = duplicate_keys(index, new_rows).first()
        if found is not None:
            raise ValueError(f"insert of a key that is not new: {found['key']!r}")
    return index.unionByName(new_rows)


def index_query(index: DataFrame, probe: DataFrame, bands: int | None = None,
                total_bands: int | None = None) -> DataFrame:
    """Keys sharing at least one bucket with each probe key: ``(q, key)`` distinct.

    ``probe`` holds band rows ``(key, band, bucket)`` of the query sketches.
    ``bands`` restricts the lookup to the first ``bands`` bands (``_query_b``).
    Both sides of a bucket are dealt into blocks, so neither a hot bucket of
    the index nor very many equal probes land in one task. Index and probe are
    read twice (sizes, cells); hand in stored ones. An index that probes itself
    has each pair of keys once from its cells, and no pair is shuffled.
    """
    itself = probe is index
    if bands is not None:
        if total_bands is not None and bands > total_bands:
            raise ValueError(f"{bands} bands asked for; the index has {total_bands}")
        probe = probe.filter(F.col("band") < F.lit(bands))
        index = index.filter(F.col("band") < F.lit(bands))
    if itself and index.filter("key IS NULL").first() is None:
        return _own_hits(index)
    hits = cross_pairs(probe, index, ("band", "bucket"), "key", "key")
    return hits.select(F.col("_x").alias("q"), F.col("_y").alias("key")).distinct()


def _own_hits(index: DataFrame) -> DataFrame:
    rows = index.select("key", F.col("band").alias("tbl"), "bucket")
    bands = rows.agg(F.max("tbl")).first()[0]
    keys = rows.select("key").distinct().select(F.col("key").alias("q"), "key")
    if bands is None:
        return keys
    met = cells.met_pairs(rows, bands + 1)
    ways = F.explode(F.array(F.struct(F.col("x").alias("q"), F.col("y").alias("key")),
                             F.struct(F.col("y").alias("q"), F.col("x").alias("key")))).alias("_h")
    hits = lambda m: m.select(ways).select("_h.q", "_h.key")
    several = rows.groupBy("key", "tbl").agg(F.count("*").alias("_n")).filter("_n > 1").first()
    if several is None:
        return hits(met).unionByName(keys)
    # keys with two rows in a band: a pair may come from each bucket
    met = materialize(met)
    return hits(met.filter("plain")).unionByName(hits(met.filter("NOT plain")).distinct()).unionByName(keys)


def grouped_query(index: DataFrame, probe: DataFrame, bands: int | None = None,
                  total_bands: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``index_query`` between representatives: ``(q, key)`` hits, and the members of both sides.

    Keys with the same bucket in every band that is looked up have the same
    hits, so each side is met through the smallest key of such a group.
    Members are ``(key, rep)`` of the probe and of the index: rows stay linear
    in a group of copies and no hit is lost. ``expand_hits`` writes them out.
    """
    if bands is not None:
        if total_bands is not None and bands > total_bands:
            raise ValueError(f"{bands} bands asked for; the index has {total_bands}")
        index, probe = (side.filter(F.col("band") < F.lit(bands)) for side in (index, probe))
    members, reps = [], []
    for side in (probe, index):
        placed = side.select("key", F.concat_ws(":", "band", "bucket").alias("element"))
        members.append(copies.copy_groups(placed))
        reps.append(materialize(side.join(copies.representatives(members[-1]), "key", "left_semi")))
    return index_query(reps[1], reps[0]), members[0], members[1]


def expand_hits(hits: DataFrame, probe_members: DataFrame, index_members: DataFrame) -> DataFrame:
    """All ``(q, key)`` of hits between representatives; groups are dealt into cells of blocks."""
    groups = [m.select(F.col("rep").alias("_g"), "key") for m in (probe_members, index_members)]
    first = cross_pairs(hits.select(F.col("q").alias("_g"), "key"), groups[0], ("_g",), "key", "key")
    first = first.select(F.col("_x").alias("_g"), F.col("_y").alias("q"))
    second = cross_pairs(first, groups[1], ("_g",), "q", "key")
    return second.select(F.col("_x").alias("q"), F.col("_y").alias("key"))


def index_contains(index: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Keys of ``keys`` present in the index."""
    k = keys.select(F.col(key).alias("key")).distinct()
    return k.join(index.select("key"), "key", "left_semi")


def index_remove(index: DataFrame, keys: DataFrame, key: str = "key",
                 must_exist: bool = False) -> DataFrame:
    """Index without the given keys; buckets left empty simply have no rows."""
    k = keys.select(F.col(key).alias("key")).distinct()
    missing = k.join(index.select("key"), "key", "left_anti").first() if must_exist else None
    if missing is not None:
        raise ValueError(f"remove of a key that the index lacks: {missing['key']!r}")
    return index.join(k, "key", "left_anti")


def index_is_empty(index: DataFrame, bands: int) -> DataFrame:
    """One row: true when any band has no bucket (the reference's ``any`` rule)."""
    return index.agg((F.countDistinct("band") < F.lit(bands)).alias("is_empty"))


def bucket_counts(index: DataFrame) -> DataFrame:
    """Keys per bucket per band ``(band, bucket, n_keys)``."""
    return index.groupBy("band", "bucket").agg(F.count("*").alias("n_keys"))


def bucket_subset_counts(index: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """``bucket_counts`` restricted to the given keys."""
    return bucket_counts(index_contains_rows(index, keys, key))


def index_contains_rows(index: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    k = keys.select(F.col(key).alias("key")).distinct()
    return index.join(k, "key", "left_semi")


def index_lookup(index: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Bucket list per requested key, ordered by band; missing keys get ''.

    Lists are bounded by the number of bands.
    """
    k = keys.select(F.col(key).alias("key")).distinct()
    found = (index.join(k, "key", "left_semi").groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct("band", "bucket"))).alias("_bb")))
    return (k.join(found, "key", "left")
            .select("key", F.coalesce(F.array_join(F.transform("_bb", lambda x: x["bucket"]), ","),
                                      F.lit("")).alias("buckets")))


def index_stats(index: DataFrame) -> DataFrame:
    """One row: number of keys, of (band, bucket) pairs and of index rows."""
    return index.agg(F.countDistinct("key").alias("n_keys"),
                     F.countDistinct("band", "bucket").alias("n_buckets"),
                     F.count("*").alias("n_rows"))
