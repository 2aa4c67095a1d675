"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last
padded to 23). The binary Golay code [23, 12, 7] decodes every 23-bit word to
its one codeword within 3 bits; a word exactly 3 bits away has five more
codewords at 4 bits. Taking all codewords within 4 bits of a word (one or
six) as its keys, two words that differ in at most one bit share a key: the
codeword nearest to one of them is at most 4 bits from the other.

Of at most three differing bits, segments get either one each, or some
segment gets none while another gets at most one. So two fingerprints link
only if they share

* a whole segment and a key of another one (six ordered pairs of segments), or
* keys of the first and the last segment and one half of the middle one.

Those keys are joined, and a candidate pair must differ in at most three bits
(inside the join condition, so only links leave the join). Copies share a
fingerprint and enter the join once. A key that more than ``CROWD`` distinct
fingerprints share, as a family of near copies that agree in two segments, is
dealt into blocks; a cell compares two blocks and hands on a spanning forest
of its links, which has the same components and fewer links than rows.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm import common
from simpairs.llm.graph import components
from simpairs.session import materialize, ship_package

# Fixed value: generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011
BITS = 23
#: shingles hashed before their bits are summed, so a long text needs bounded memory
BLOCK = 1 << 16
#: fingerprints of one key beyond which it is compared in cells, of two blocks of about so many
CROWD, CELL = 1024, 8192


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits, and for each remainder the error words of weight ≤ 4."""
    upper = np.array([_remainder(i << 11) for i in range(1 << 12)], np.int64)
    single = [_remainder(1 << i) for i in range(BITS)]
    errors: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            at, word = 0, 0
            for p in places:
                at ^= single[p]
                word |= 1 << p
            # weight 4 only beside an error word of weight 3: words nearer to a codeword have no second one in reach
            errors[at].append(word)
    table = np.full((1 << 11, 6), -1, np.int64)
    for at, words in enumerate(errors):
        table[at, :len(words)] = words
    return upper, table


_TABLES: list = []


def codeword_keys(words: np.ndarray) -> np.ndarray:
    """Indices (upper 12 bits) of the codewords within 4 bits of each word; −1 fills the rest."""
    if not _TABLES:
        _TABLES.extend(golay_tables())
    upper, table = _TABLES
    words = words.astype(np.int64)
    errors = table[upper[words >> 11] ^ (words & 0x7FF)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of the lower-cased word shingles of a UTF-8 text; no word: 0."""
    from xxhash import xxh64_digest

    words = text.lower().split() if text else []  # on bytes: A-Z and the six ASCII white-space bytes
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + shingle - 1]
        grams = zip(*[part[i:] for i in range(shingle)]) if len(words) >= shingle else [part]
        digests = b"".join(map(xxh64_digest, map(b" ".join, grams), repeat(42)))
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            values = [fingerprint(t, shingle) for t in common.byte_texts(batch.columns[-1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.int64())],
                                             names=[*batch.schema.names[:-1], "fp"])

    return run


def fingerprints(docs: DataFrame, keep: tuple = ("doc_id",), shingle: int = 3) -> DataFrame:
    """``(*keep, fp)`` for each row; ``fp`` is the fingerprint as a signed long."""
    ship_package(docs.sparkSession)
    rows = docs.select(*keep, F.col("text").cast("string").alias("text to hash"))
    ddl = ", ".join(f"`{c}` {common.sql_type(docs, c)}" for c in keep) + ", fp long"
    return rows.mapInArrow(_fingerprints(shingle), ddl)


def _keyed(batches):
    """(key, fp, family) rows: kind in the upper bits, then segment values and codeword indices."""
    def rows(key, at):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at]), batch.column("family").take(pa.array(at))],
                                          names=["key", "fp", "family"])

    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        u = fp.view(np.uint64)
        low23, low18 = np.uint64((1 << 23) - 1), np.uint64((1 << 18) - 1)
        exact = [(u >> np.uint64(41)).astype(np.int64), (u >> np.uint64(18) & low23).astype(np.int64),
                 (u & low18).astype(np.int64)]
        golay = [codeword_keys(exact[0]), codeword_keys(exact[1]), codeword_keys(exact[2] << 5)]
        kind = 0
        for i in range(3):
            for j in range(3):
                if i == j:
                    continue
                for k in range(6):
                    at = np.flatnonzero(golay[j][:, k] >= 0)
                    if len(at):
                        key = (np.int64(kind) << 40) | (exact[i][at] << 12) | golay[j][at, k]
                        yield rows(key, at)
                kind += 1
        halves = (exact[1] >> 11, exact[1] & 0x7FF)
        for half in halves:
            for k in range(6):
                for m in range(6):
                    at = np.flatnonzero((golay[0][:, k] >= 0) & (golay[2][:, m] >= 0))
                    if len(at):
                        key = ((np.int64(kind) << 40) | (half[at] << 24) | (golay[0][at, k] << 12) | golay[2][at, m])
                        yield rows(key, at)
            kind += 1


def spanning_links(a: np.ndarray, b: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between fingerprints of ``a`` and ``b`` (which may be the same)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out, left, right = [], at[:len(a)], at[len(a):]
    step = max(1, (1 << 21) // max(1, len(b)))
    for lo in range(0, len(a), step):
        near = np.bitwise_count(a[lo:lo + step, None].view(np.uint64) ^ b[None, :].view(np.uint64)) <= max_bits
        rows, columns = np.nonzero(near)
        for i, j in zip(left[lo + rows].tolist(), right[columns].tolist()):
            x, y = find(i), find(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(nodes[min(i, j)]), int(nodes[max(i, j)])))
    return out


def _cell_links(max_bits: int):
    def run(a, b):
        found = spanning_links(*(t.column("fp").to_numpy() for t in (a, b)), max_bits) if a.num_rows and b.num_rows else []
        u, v = zip(*found) if found else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _crowd_links(rows: DataFrame, crowds: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links of the keys in ``crowds``, ``(key, n)``, cell by cell of blocks.

    No join may broadcast ``rows``, dozens for each fingerprint (see ``_thin_links``).
    """
    rows = rows.join(crowds.select("key"), "key", "left_semi").join(crowds.hint("merge"), "key")
    dealt = (rows.withColumn("blocks", F.ceil(F.col("n") / F.lit(CELL)).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    upper = dealt.select("key", "fp", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"))
    lower = dealt.select(F.col("key").alias("k"), F.col("fp").alias("f"), F.col("own").alias("q"),
                         F.explode(F.sequence(F.lit(0), F.col("own"))).alias("p")).toDF("key", "fp", "j", "i")
    return (upper.groupBy("key", "i", "j").cogroup(lower.groupBy("key", "i", "j"))
            .applyInArrow(_cell_links(max_bits), "u long, v long"))


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs ``(u, v)``, u < v, of distinct fingerprints ``fp`` that differ in at most ``max_bits`` ≤ 3 bits.

    All such pairs of keys that up to ``CROWD`` fingerprints share, and links
    that connect the same fingerprints for keys of more.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the segment keys find pairs up to 3 differing bits")
    spark = distinct.sparkSession
    ship_package(spark)
    # a few bytes a row would be read by few tasks, each of which makes dozens of rows from one
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keyed(rows):
        dealt = rows.repartition(parts, F.xxhash64("fp"))
        return dealt.mapInArrow(_keyed, "key long, fp long, family long")

    alone = keyed(distinct.select("fp", F.lit(None).cast("long").alias("family")))
    crowds = materialize(alone.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > F.lit(CROWD)))
    if crowds.first() is None:
        return _thin_links(alone, max_bits).distinct()
    # fingerprints of one crowded key are connected by its forest: other keys need not link them again
    family = alone.join(crowds.select("key"), "key", "left_semi").groupBy("fp").agg(F.min("key").alias("family"))
    told = keyed(distinct.select("fp").join(family, "fp", "left"))
    return (_thin_links(told.join(crowds, "key", "left_anti"), max_bits)
            .unionByName(_crowd_links(alone, crowds, max_bits)).distinct())


def _thin_links(keyed: DataFrame, max_bits: int) -> DataFrame:
    # Spark sizes the keyed rows by the fingerprints they come from, at a sixtieth of their bytes: never broadcast
    a, b = keyed.select("key", F.col("fp").alias("u"), F.col("family").alias("f")), keyed.select("key", F.col("fp").alias("v"), F.col("family").alias("g"))
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= F.lit(max_bits))
    return a.join(b.hint("merge"), (a["key"] == b["key"]) & near & ~(F.col("f").isNotNull() & F.col("f").eqNullSafe(F.col("g")))).select("u", "v")


def near_duplicates(docs: DataFrame, keep: tuple = ("doc_id",), shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``(*keep, fp, component_id, component)``, one row per input row.

    ``component`` is the least fingerprint (as a signed long) reachable over
    links, ``component_id`` the least ``doc_id`` of its rows (null ids do not
    count; null if there is no other). Null and empty texts and texts of white
    space have fingerprint zero and link like any other; repeated rows and
    copies share a component. An empty table gives no rows.
    """
    rows = materialize(fingerprints(docs, tuple(dict.fromkeys(("doc_id", *keep))), shingle))
    found = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(found, max_bits))
    rooted = (found.join(roots, found["fp"] == roots["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("component")))
    ids = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "component").join(ids, "component")
    return rows.join(named, "fp").select(*keep, "fp", "component_id", "component")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near-duplicates.

    The row of the least ``doc_id`` stays (null ids last, then by content);
    of rows equal in all columns, one.
    """
    keyed = docs.select(common.row_key(docs).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    slim = docs.select(common.row_key(docs).alias("key"), "doc_id", F.col("text"))
    groups = near_duplicates(slim, keep=("doc_id", "key"), shingle=shingle, max_bits=max_bits)
    stay = (groups.groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
            .select("first.key"))
    rows = keyed.groupBy("key").agg(F.first("row").alias("row"))
    return rows.join(stay, "key", "left_semi").select("row.*")
