"""MinHash sketches as a mergeable, distributed aggregate.

A signature is kept in *long form* ``(key, perm, v)``: one row per key and
permutation, ``v`` the minimum permuted 32-bit hash over the key's elements.
Long form is what makes the sketch a plain ``min`` aggregate:

* building it is ``groupBy(key, perm).agg(min)`` — Spark combines map-side
  (partial aggregation), so a key holding a third of all rows still reaches
  the shuffle as at most ``num_perm`` rows per map task, spread over
  ``num_perm`` reducers;
* merge / union of sketches is the same ``min`` over more rows;
* arrays (``digest``) are only built per key, bounded by ``num_perm``.

On the way there a sketch travels in rows of ``PACK`` positions, to the task
of its key: what joins or groups signatures by key needs no further shuffle,
and no aggregate or sort holds a row per position.

Where only band buckets are wanted, ``band_minimums`` emits one row of ``rows``
minimums per key and band instead, and one shuffle gives the bands.

The permuted hash is ``((a * hv + b) mod 2**64) mod p) & (2**32 - 1)``; the
``mod 2**64`` wrap is reproduced exactly. The default plan evaluates it in
Arrow batches with NumPy ``uint64`` (wraps natively) and keeps running
minimums per key across all batches of a task (a bounded map-side combine,
flushed every 32k keys); the streaming sketch runs the same plan.
``method="limbs"`` evaluates it in generated code on longs, in limbs of 32 and
16 bits that never overflow (no Python, no decimal, also under ANSI rules; it
serves streams as well); ``method="jvm"`` does it with decimals, as a check. A null key or a null element is no member of any set:
such rows are left out by both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simpairs.functions.hashing import MAX_HASH, MERSENNE_PRIME, NUM_PERM, sha1_hash32
from simpairs.operators import cells
from simpairs.session import materialize, ship_package

#: Positions of a signature that one row holds until its partial sketches are merged.
PACK = 16
#: What a value loses on its way to pairs; keys of a block there (a key is sent once to each block of its bucket).
ZERO, MET_BLOCK = 1 << 31, 4096


@dataclass(frozen=True)
class SketchSpec:
    """Seed and length of a family of sketches; only equal specs combine."""

    seed: int = 1
    num_perm: int = NUM_PERM

    def __post_init__(self):
        if not 2 <= self.num_perm <= 1 << 32:
            raise ValueError(f"num_perm must lie between 2 and 2**32; {self.num_perm} does not")

    def check_compatible(self, other: "SketchSpec") -> None:
        for field in ("seed", "num_perm"):
            mine, theirs = getattr(self, field), getattr(other, field)
            if mine != theirs:
                raise ValueError(f"sketches of different {field} do not combine: {mine} and {theirs}")


def permutations(seed: int = 1, num_perm: int = NUM_PERM) -> np.ndarray:
    """(num_perm, 2) uint64 array of (a, b): a ∈ [1, p), b ∈ [0, p), drawn a then b."""
    gen = np.random.RandomState(seed)
    out = np.empty((num_perm, 2), dtype=np.uint64)
    for i in range(num_perm):
        out[i, 0] = gen.randint(1, MERSENNE_PRIME, dtype=np.uint64)
        out[i, 1] = gen.randint(0, MERSENNE_PRIME, dtype=np.uint64)
    return out


def permutation_table(spark, spec: SketchSpec = SketchSpec()) -> DataFrame:
    """The permutations as a tiny DataFrame ``(perm, a, b)`` (num_perm rows)."""
    ab = permutations(spec.seed, spec.num_perm)
    rows = [(i, int(a), int(b)) for i, (a, b) in enumerate(ab)]
    return spark.createDataFrame(rows, "perm int, a long, b long")


def permuted_hash_np(hv: np.ndarray, ab: np.ndarray) -> np.ndarray:
    """(n, num_perm) permuted values of hashes ``hv`` (uint64 arithmetic wraps)."""
    hv = hv.astype(np.uint64)
    a = ab[:, 0]
    b = ab[:, 1]
    with np.errstate(over="ignore"):
        x = hv[:, None] * a[None, :] + b[None, :]
    # the remainder by 2**61 - 1 without a division: the three bits above bit 61 are added to the rest
    high = x >> np.uint64(61)
    x &= np.uint64(MERSENNE_PRIME)
    x += high
    x -= (x >= np.uint64(MERSENNE_PRIME)) * np.uint64(MERSENNE_PRIME)
    x &= np.uint64(MAX_HASH)
    return x


def permuted_hash_col(hv: Column, a: int, b: int) -> Column:
    """JVM form of one permuted hash; decimal arithmetic keeps the 2**64 wrap exact."""
    dec = "decimal(38,0)"
    x = F.lit(a).cast(dec) * hv.cast(dec) + F.lit(b).cast(dec)
    x = F.pmod(x, F.lit(str(1 << 64)).cast(dec))
    x = F.pmod(x, F.lit(str(MERSENNE_PRIME)).cast(dec))
    return x.cast("long").bitwiseAND(F.lit(MAX_HASH))


def permuted_hash_limbs(hv: Column, a: Column, b: Column) -> Column:
    """One permuted hash on longs: the product in 32-bit limbs, no step beyond 2**62.

    ``a`` and ``b`` are below 2**61, ``hv`` below 2**32. With ``a = a1·2^32 + a0``
    the high half of ``a·hv + b`` only needs ``a1·hv`` and the carry of
    ``a0·hv``, which is added up in halves of ``hv``. The remainder by
    2**61 − 1 adds the three bits above bit 61 to the rest.
    """
    m32, m16 = F.lit(MAX_HASH), F.lit(0xFFFF)
    a1, a0 = F.shiftright(a, 32), a.bitwiseAND(m32)
    b1, b0 = F.shiftright(b, 32), b.bitwiseAND(m32)
    upper = a0 * F.shiftright(hv, 16)
    low = a0 * hv.bitwiseAND(m16) + F.shiftleft(upper.bitwiseAND(m16), 16) + b0
    high = (a1 * hv + F.shiftright(upper, 16) + F.shiftright(low, 32) + b1).bitwiseAND(m32)
    below = F.shiftleft(high.bitwiseAND(F.lit((1 << 29) - 1)), 32) + low.bitwiseAND(m32)
    x = below + F.shiftright(high, 29)
    return F.when(x >= F.lit(MERSENNE_PRIME), x - F.lit(MERSENNE_PRIME)).otherwise(x).bitwiseAND(m32)


def element_hashes(sets: DataFrame, key: str = "key", element: str = "element",
                   hashfunc: Callable[[Column], Column] = sha1_hash32) -> DataFrame:
    """(key, hv): the 32-bit hash of every element of every set; the key keeps its type.

    ``hashfunc`` maps an element column to a long in 0 … 2**32 − 1. Rows with
    a null key or element are left out.
    """
    return (sets.filter(F.col(key).isNotNull() & F.col(element).isNotNull())
            .select(F.col(key).alias("key"), hashfunc(F.col(element)).alias("hv")))


def gathered(hashes: DataFrame) -> DataFrame:
    """The rows ``(key, hv)`` of each key side by side: for keys whose elements lie scattered over the tasks.

    A task then makes one partial sketch per key instead of one for every few
    elements, however many keys it has: they come in order. Ranges also cut a
    key that holds very many rows.
    """
    return hashes.select("key", "hv").repartitionByRange("key", "hv").sortWithinPartitions("key")


def _batch_mins(codes: np.ndarray, hv: np.ndarray, ab: np.ndarray, chunk: int):
    """(distinct codes, their (n_codes, num_perm) minimum permuted hashes) of one batch."""
    order = np.argsort(codes, kind="stable")
    codes, hv = codes[order], hv[order]
    uniq, starts = np.unique(codes, return_index=True)
    mins = np.full((len(uniq), ab.shape[0]), MAX_HASH, dtype=np.uint64)
    # rows are hashed in chunks; a group cut by a chunk edge takes the minimum of its parts
    for lo in range(0, len(codes), chunk):
        hi = min(lo + chunk, len(codes))
        first = np.searchsorted(starts, lo, side="right") - 1
        last = np.searchsorted(starts, hi, side="left")
        cuts = np.maximum(starts[first:last], lo) - lo
        part = np.minimum.reduceat(permuted_hash_np(hv[lo:hi], ab), cuts, axis=0)
        mins[first:last] = np.minimum(mins[first:last], part)
    return uniq, mins


class _TaskCombiner:
    """Running minimums per key over all batches of one task, bounded by ``max_keys``."""

    def __init__(self, num_perm: int, max_keys: int):
        self.num_perm = num_perm
        self.max_keys = max_keys
        self.reset()

    def reset(self):
        self.index: dict = {}
        self.mins = np.full((1024, self.num_perm), MAX_HASH, dtype=np.uint64)

    def add(self, keys: list, mins: np.ndarray) -> None:
        index = self.index
        rows = np.fromiter((index.setdefault(k, len(index)) for k in keys),
                           dtype=np.int64, count=len(keys))
        if len(index) > self.mins.shape[0]:
            grown = np.full((max(len(index), 2 * self.mins.shape[0]), self.num_perm), MAX_HASH,
                            dtype=np.uint64)
            grown[:self.mins.shape[0]] = self.mins
            self.mins = grown
        self.mins[rows] = np.minimum(self.mins[rows], mins)

    def full(self) -> bool:
        return len(self.index) >= self.max_keys

    def parts(self, keys_per_batch: int = 4096):
        """(keys, minimums) in slices; the combiner starts anew afterwards."""
        keys = list(self.index)
        for lo in range(0, len(keys), keys_per_batch):
            hi = min(lo + keys_per_batch, len(keys))
            yield keys[lo:hi], self.mins[lo:hi].astype(np.int64)
        self.reset()


def _partial_sketch(ab: np.ndarray, emit, max_keys: int = 32768):
    """mapInArrow function: per-task partial sketches, flushed every ``max_keys`` keys.

    Memory stays near ``max_keys × num_perm × 8`` bytes plus one batch, however
    many keys or rows a task sees. ``emit(key array, minimums)`` makes the
    output batch of some keys.
    """
    # keep the (n, num_perm) matrix near 16 MB however large an Arrow batch is
    chunk = max(1, (1 << 21) // ab.shape[0])

    def run(batches):
        comb = _TaskCombiner(ab.shape[0], max_keys)
        kind = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            kind = batch.column("key").type
            keys = batch.column("key").dictionary_encode()
            uniq, mins = _batch_mins(keys.indices.to_numpy(zero_copy_only=False),
                                     batch.column("hv").to_numpy(zero_copy_only=False), ab, chunk)
            comb.add(keys.dictionary.take(pa.array(uniq)).to_pylist(), mins)
            if comb.full():
                yield from (emit(pa.array(k, kind), m) for k, m in comb.parts())
        yield from (emit(pa.array(k, kind), m) for k, m in comb.parts())

    return run


def _packed_rows(num_perm: int):
    """Rows of ``PACK`` positions; the last one of a key is filled up."""
    parts = -(-num_perm // PACK)
    emit = _band_rows(parts, PACK)
    return lambda keys, mins: emit(keys, np.pad(mins, ((0, 0), (0, parts * PACK - num_perm)), constant_values=MAX_HASH))


def _unpacked(packed: DataFrame, num_perm: int) -> DataFrame:
    """``(key, perm, v)`` from merged rows of ``PACK`` positions."""
    values = F.posexplode(F.array(*[f"m{j}" for j in range(PACK)])).alias("_j", "v")
    sig = packed.select("key", "band", values).select("key", (F.col("band") * F.lit(PACK) + F.col("_j")).alias("perm"), "v")
    return sig if num_perm % PACK == 0 else sig.filter(F.col("perm") < F.lit(num_perm))


def _long_rows(keys: pa.Array, mins: np.ndarray) -> pa.RecordBatch:
    n, num_perm = mins.shape
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(np.repeat(np.arange(n), num_perm))),
         pa.array(np.tile(np.arange(num_perm, dtype=np.int32), n)), pa.array(mins.reshape(-1))],
        names=["key", "perm", "v"])


def _band_rows(bands: int, rows: int):
    def emit(keys: pa.Array, mins: np.ndarray) -> pa.RecordBatch:
        n = len(mins)
        grid = mins[:, :bands * rows].reshape(n * bands, rows)
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(np.repeat(np.arange(n), bands))),
             pa.array(np.tile(np.arange(bands, dtype=np.int32), n)),
             *[pa.array(np.ascontiguousarray(grid[:, j])) for j in range(rows)]],
            names=["key", "band", *[f"m{j}" for j in range(rows)]])

    return emit


def _key_type(hashes: DataFrame) -> str:
    return hashes.schema["key"].dataType.simpleString()


def signatures_from_hashes(hashes: DataFrame, spec: SketchSpec = SketchSpec(),
                           method: str = "arrow") -> DataFrame:
    """Long-form signatures ``(key, perm, v)`` from ``(key, hv)`` rows.

    A batch plan leaves all positions of a key in one task (``arrow``) or
    merges them in rows of ``PACK`` (``limbs``); a stream keeps its state by
    (key, perm).
    """
    ab = permutations(spec.seed, spec.num_perm)
    if method not in ("arrow", "jvm", "limbs"):
        raise ValueError(f"unknown sketch method {method!r}")
    packed = not hashes.isStreaming and method != "jvm"
    names = [f"m{j}" for j in range(PACK)]
    if method == "arrow":
        ship_package(hashes.sparkSession)
        values = f"band int, {', '.join(f'{m} long' for m in names)}" if packed else "perm int, v long"
        partial = hashes.select("key", "hv").mapInArrow(
            _partial_sketch(ab, _packed_rows(spec.num_perm) if packed else _long_rows), f"key {_key_type(hashes)}, {values}")
        if packed:
            partial = partial.repartition("key")
    elif method == "jvm":
        vals = F.array(*[F.struct(F.lit(i).alias("perm"),
                                  permuted_hash_col(F.col("hv"), int(a), int(b)).alias("v"))
                         for i, (a, b) in enumerate(ab)])
        partial = hashes.select("key", F.inline(vals))
    elif packed:
        return _unpacked(_packed_limbs(hashes, ab), spec.num_perm)
    else:
        at = lambda column: F.element_at(F.array(*[F.lit(int(x)) for x in column]), F.col("perm") + 1)
        partial = (hashes.select("key", "hv", F.explode(F.sequence(F.lit(0), F.lit(spec.num_perm - 1))).alias("perm"))
                   .select("key", "perm", permuted_hash_limbs(F.col("hv"), at(ab[:, 0]), at(ab[:, 1])).alias("v")))
    if packed:
        return _unpacked(partial.groupBy("key", "band").agg(*[F.min(m).alias(m) for m in names]), spec.num_perm)
    return partial.groupBy("key", "perm").agg(F.min("v").alias("v"))


def _packed_limbs(hashes: DataFrame, ab: np.ndarray) -> DataFrame:
    """``(key, band, m0 … m<PACK−1>)`` by ``permuted_hash_limbs``: a row of the hashes updates ``PACK`` minimums at a time."""
    parts = -(-len(ab) // PACK)
    at = lambda column, j: F.element_at(F.array(*[F.lit(int(x)) for x in np.resize(column, parts * PACK)[j::PACK]]), F.col("band") + 1)
    rows = hashes.select("key", "hv", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("band"))
    return rows.groupBy("key", "band").agg(*[
        F.min(permuted_hash_limbs(F.col("hv"), at(ab[:, 0], j), at(ab[:, 1], j))).alias(f"m{j}") for j in range(PACK)])


def band_minimums(hashes: DataFrame, bands: int, rows: int, spec: SketchSpec = SketchSpec()) -> DataFrame:
    """``(key, band, m0 … m<rows−1>)``: the signature cut into bands, in one shuffle by (key, band)."""
    ship_package(hashes.sparkSession)
    ab = permutations(spec.seed, spec.num_perm)[:bands * rows]
    names = [f"m{j}" for j in range(rows)]
    ddl = f"key {_key_type(hashes)}, band int, " + ", ".join(f"{m} long" for m in names)
    partial = hashes.select("key", "hv").mapInArrow(_partial_sketch(ab, _band_rows(bands, rows)), ddl)
    return partial.groupBy("key", "band").agg(*[F.min(m).alias(m) for m in names])


def minhash_signatures(sets: DataFrame, spec: SketchSpec = SketchSpec(), key: str = "key",
                       element: str = "element", method: str = "arrow",
                       hashfunc: Callable[[Column], Column] = sha1_hash32, gather: bool = False) -> DataFrame:
    """Long-form MinHash signatures of the element sets (one row per key, perm).

    ``gather`` brings the elements of a key together first; use it where they
    come from a join or an aggregate and lie scattered.
    """
    hashes = element_hashes(sets, key, element, hashfunc)
    return signatures_from_hashes(gathered(hashes) if gather else hashes, spec, method)


def with_empty_signatures(keys: DataFrame, sig: DataFrame, spec: SketchSpec = SketchSpec(),
                          key: str = "key") -> DataFrame:
    """Signatures for every key of ``keys``; keys without elements get the empty sketch.

    A key is in ``sig`` with all its positions or not at all. The keys are
    looked up, the signatures stream past them: a task sorts or holds no row per position.
    """
    wanted = keys.select(F.col(key).alias("key")).distinct()
    own = sig.filter(F.col("perm") < F.lit(spec.num_perm)).select("key", "perm", "v")
    every = F.sequence(F.lit(0), F.lit(spec.num_perm - 1))
    return (wanted.hint("shuffle_hash").join(own, "key", "left")
            .select("key", F.explode(F.when(F.col("perm").isNull(), every).otherwise(F.array("perm"))).alias("perm"),
                    F.coalesce("v", F.lit(MAX_HASH).cast("long")).alias("v")))


def digest(sig: DataFrame) -> DataFrame:
    """(key, hashvalues array<long>) ordered by permutation (array size = num_perm)."""
    return (sig.groupBy("key")
            .agg(F.array_sort(F.collect_list(F.struct("perm", "v"))).alias("_pv"))
            .select("key", F.transform("_pv", lambda x: x["v"]).alias("hashvalues")))


def from_digest(arrays: DataFrame, key: str = "key", values: str = "hashvalues") -> DataFrame:
    """Long form from exported hash values (``_parse_hashvalues``)."""
    return arrays.select(F.col(key).alias("key"), F.posexplode(values).alias("perm", "v")) \
        .select("key", F.col("perm").cast("int").alias("perm"), F.col("v").cast("long").alias("v"))


def jaccard_estimate(pairs: DataFrame, sig: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Share of equal positions of the two signatures, for each (u, v) pair."""
    arr = digest(sig)
    a = arr.select(F.col("key").alias(u), F.col("hashvalues").alias("_a"))
    b = arr.select(F.col("key").alias(v), F.col("hashvalues").alias("_b"))
    eq = F.zip_with("_a", "_b", lambda x, y: F.when(x == y, 1).otherwise(0))
    n_eq = F.aggregate(eq, F.lit(0), lambda acc, x: acc + x)
    return (pairs.join(a, u).join(b, v)
            .select(u, v, (n_eq.cast("double") / F.size("_a")).alias("jaccard_est")))


def _met(buckets: DataFrame, sig: DataFrame, measure: Callable, name: str) -> DataFrame:
    """A score of the signatures of each pair of keys that share a bucket, made where the pair meets: ``(u, v, name)``."""
    bands = buckets.agg(F.max("band")).first()[0]
    sig = sig.filter("key IS NOT NULL")
    last = sig.agg(F.max("perm")).first()[0]
    # half the bytes: values below 2**32 as ints around zero, in whose order and equality nothing changes
    payload = digest(sig).select("key", F.transform("hashvalues", lambda v: (v - F.lit(ZERO)).cast("int")).alias("hashvalues"))
    rows = buckets.select("key", F.col("band").alias("tbl"), "bucket")
    score = cells.list_measure("hashvalues", (last or 0) + 1, measure, np.int32)
    met = cells.met_pairs(rows, (bands or 0) + 1, payload, None, score, {name: "double"}, MET_BLOCK)
    return cells.canonical(met).select("u", "v", name)


def met_jaccard_estimate(buckets: DataFrame, sig: DataFrame) -> DataFrame:
    """``jaccard_estimate`` of all pairs of ``pairs.bucket_pairs(buckets)``, without a row per pair before it is scored."""
    return _met(buckets, sig, lambda x, y: [(x == y).sum(axis=1) / x.shape[1]], "jaccard_est")


def met_pair_cardinality(buckets: DataFrame, sig: DataFrame, ndigits: int = 6) -> DataFrame:
    """``merged_pair_cardinality`` of all pairs of ``pairs.bucket_pairs(buckets)``, scored where they meet."""
    def merged(x, y):
        least = np.minimum(x, y)
        total = np.zeros(len(x))
        for j in range(x.shape[1]):  # in the order of the positions
            total += (least[:, j] + float(ZERO)) / float(MAX_HASH)
        with np.errstate(divide="ignore"):
            return [x.shape[1] / total - 1.0]

    return _met(buckets, sig, merged, "union_card").withColumn("union_card", F.round("union_card", ndigits))


def cardinality(sig: DataFrame, ndigits: int = 6) -> DataFrame:
    """Estimated distinct count per key: k / Σ(v / (2**32-1)) − 1."""
    return sig.groupBy("key").agg(
        F.round(F.count("*") / F.sum(F.col("v") / F.lit(float(MAX_HASH))) - F.lit(1.0),
                ndigits).alias("card_est"))


def merge(sig_a: DataFrame, sig_b: DataFrame, spec_a: SketchSpec = SketchSpec(),
          spec_b: SketchSpec = SketchSpec()) -> DataFrame:
    """Pairwise min of two signature tables with the same keys (``merge``)."""
    spec_a.check_compatible(spec_b)
    return (sig_a.unionByName(sig_b)
            .groupBy("key", "perm").agg(F.min("v").alias("v")))


def union(sig: DataFrame, groups: DataFrame, key: str = "key",
          group: str = "group") -> DataFrame:
    """N-way union: the sketch of each group is the min over its members' sketches."""
    g = groups.select(F.col(key).alias("key"), F.col(group).alias("group"))
    # the groups are looked up by the signatures as they stream past, which are not sorted
    return (sig.join(g.hint("shuffle_hash"), "key")
            .groupBy("group", "perm").agg(F.min("v").alias("v")))


def union_rollup(sig: DataFrame, levels: DataFrame, *names: str, key: str = "key") -> DataFrame:
    """Unions of sketches at every level of a hierarchy: ``(level, *names, key, perm, v)``.

    ``levels`` names for each key its group on each level of ``names``, the
    widest first. Level 0 is the widest union, the last one the key itself;
    columns below a row's level are null. A task combines the unions before
    the shuffle, and each level comes of the one below; ``sig`` has one row
    per key and position, so the last level needs no grouping. Keys without a
    row in ``levels`` are left out; a null name is a group like any other,
    told from a rolled-up one by ``level``.
    """
    g = levels.select(F.col(key).alias("key"), *names).distinct()
    rows = sig.join(g.hint("shuffle_hash"), "key").select(*names, "key", "perm", "v")
    out = rows.select(F.lit(len(names)).alias("level"), *names, "key", "perm", "v")
    if not names:
        return out
    lowest = rows.groupBy(*names, "perm").agg(F.min("v").alias("v"))
    sets = [[*[F.col(c) for c in names[:i + 1]], F.col("perm")] for i in range(len(names))]
    below = [F.grouping(F.col(c)).alias(f"_below_{i}") for i, c in enumerate(names)]
    grouped = lowest.groupingSets(sets, *[F.col(c) for c in (*names, "perm")]).agg(F.min("v").alias("v"), *below)
    level = F.lit(len(names) - 1) - sum((F.col(f"_below_{i}").cast("int") for i in range(len(names))), F.lit(0))
    unions = grouped.select(level.cast("int").alias("level"), *names,
                            F.lit(None).cast(rows.schema["key"].dataType).alias("key"), "perm", "v")
    return unions.unionByName(out)


def is_empty(sig: DataFrame) -> DataFrame:
    """(key, is_empty): every value still at the 32-bit maximum."""
    return sig.groupBy("key").agg(F.bool_and(F.col("v") == F.lit(MAX_HASH)).alias("is_empty"))


def identical_groups(sig: DataFrame) -> DataFrame:
    """Keys whose whole signature equals another key's.

    Returns ``(key, rep, group_size)`` where ``rep`` is the smallest key of the
    group; groups of one are left out. Work is a grouping on the digest, never
    a pairing inside a group, so a group of copies holding a third of all keys
    stays linear.
    """
    # read by the groups and by their members: each signature is made once, and a short digest of it is kept
    arr = materialize(digest(sig).select("key", F.sha2(F.array_join("hashvalues", ","), 256).alias("_d")))
    groups = arr.groupBy("_d").agg(F.min("key").alias("rep"), F.count("*").alias("group_size"))
    return (arr.join(groups.filter(F.col("group_size") > 1), "_d")
            .select("key", "rep", "group_size"))


def signature_length(sig: DataFrame) -> DataFrame:
    """``__len__`` per key."""
    return sig.groupBy("key").agg(F.count("*").alias("num_perm"))


def dim_guard(sig: DataFrame, num_perm: int) -> DataFrame:
    """Fail the job if a signature does not have ``num_perm`` values."""
    n = signature_length(sig)
    return n.select("key", F.when(F.col("num_perm") == num_perm, F.col("num_perm"))
                    .otherwise(F.raise_error(F.concat(
                        F.lit(f"a sketch has other than {num_perm} values: "),
                        F.col("num_perm").cast("string")))).alias("num_perm"))


def merged_pair_cardinality(pairs: DataFrame, sig: DataFrame, u: str = "u", v: str = "v",
                            ndigits: int = 6) -> DataFrame:
    """Cardinality estimate of the merged (pairwise min) sketch of each pair.

    One array of values per key meets the pair, not one row per value.
    """
    arr = digest(sig)
    a = arr.select(F.col("key").alias(u), F.col("hashvalues").alias("_a"))
    b = arr.select(F.col("key").alias(v), F.col("hashvalues").alias("_b"))
    merged = F.zip_with("_a", "_b", lambda x, y: F.least(x, y) / F.lit(float(MAX_HASH)))
    total = F.aggregate(merged, F.lit(0.0), lambda s, x: s + x)
    return (pairs.select(u, v).join(a, u).join(b, v)
            .select(u, v, F.round(F.size("_a") / total - F.lit(1.0), ndigits).alias("union_card")))
