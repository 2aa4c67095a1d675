"""Divergence of the sources of each language by term shares, counted in two passes with perfect hashes.

Pass one counts documents per (language, term) exactly and keeps the terms of
enough documents. The kept terms of a language are dealt into shards, and each
shard gets a minimal perfect hash: levels of bit arrays, in which a term sits
on the first level where it falls on a place of its own; its slot is the
number of bits before it. Beside the hash the shard stores its terms in the
order of their slots.

Pass two reads the texts again. Tasks hold the broadcast shards, find the slot
of each term, compare it with the stored one, and increment the dense slots of
its (language, source) group, in numpy arrays. A broadcast holds shards of at
most ``ROUND_BYTES`` measured bytes; larger vocabularies take several rounds,
each with a scan of its own. Counts of tasks are merged in a sorted stream,
one slot array at a time, so a source with any share of the rows is split by
shard and no group is collected.

Pairs of sources are compared shard by shard, in cells of ``BLOCK`` by
``BLOCK`` sources, and summed.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simpairs.llm.common import in_slices
from simpairs.session import materialize, ship_package

SHARE = 1_000_000_000
SHARD_TERMS = 16384
ROUND_BYTES = 32 << 20
BLOCK = 32
#: A level has a place and a half for each term left; so many levels leave next to none to the list of the rest.
SPACE, LEVELS = 1.5, 24
#: Terms held before they are looked up, and slots held before they are handed on, in one task.
HELD_TERMS, HELD_SLOTS, HELD_TOKENS = 1 << 19, 1 << 24, 1 << 30
TEXT_BLOCK = 1 << 20

#: Letters A-Z become small, other ASCII characters than letters become spaces; bytes from 0x80 on stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists from blocks of about ``TEXT_BLOCK`` bytes."""
    data = (text or "").encode().translate(FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + TEXT_BLOCK)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


# ------------------------------------------------------------------ perfect hash of one shard

def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash for each level (a multiply-and-shift finaliser)."""
    x = h + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))


class PerfectHash:
    """Slots 0 … n − 1 of n distinct terms, with the terms stored by slot.

    ``words`` are the bits of all levels, ``sizes`` the places of each level,
    ``ends`` where each stored term ends.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray, ends: np.ndarray, stored: bytes):
        self.words, self.sizes, self.ends, self.stored = words, sizes, ends, stored
        self.n = len(ends) - 1

    @classmethod
    def build(cls, terms: list[bytes]) -> PerfectHash:
        h = term_hashes(terms)
        left, words, sizes, order = np.arange(len(terms)), [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, int(len(left) * SPACE))
            place = (_mixed(h[left], level) % np.uint64(size)).astype(np.int64)
            own = (np.bincount(place, minlength=size) == 1)[place]
            bits = np.zeros((size + 63) // 64 * 64, bool)
            bits[place[own]] = True
            words.append(np.packbits(bits, bitorder="little").view(np.uint64))
            sizes.append(size)
            order.extend(left[own][np.argsort(place[own])].tolist())
            left = left[~own]
        order.extend(sorted(left.tolist(), key=terms.__getitem__))
        ends = np.concatenate([[0], np.cumsum([len(terms[i]) for i in order])]).astype(np.int64)
        return cls(np.concatenate(words) if words else np.zeros(0, np.uint64), np.array(sizes, np.int64), ends,
                   b"".join(terms[i] for i in order))

    def packed(self) -> tuple:
        return self.words.tobytes(), self.sizes.tobytes(), self.ends.tobytes(), self.stored

    @classmethod
    def unpacked(cls, words: bytes, sizes: bytes, ends: bytes, stored: bytes) -> PerfectHash:
        return cls(np.frombuffer(words, np.uint64), np.frombuffer(sizes, np.int64), np.frombuffer(ends, np.int64), stored)


class Lookup:
    """Slots in some shards of a language at once; ``first[shard]`` is where a shard's slots begin, −1 if it is not here."""

    def __init__(self, shards: dict[int, PerfectHash], n_shards: int):
        self.n_shards, self.shards = n_shards, dict(sorted(shards.items()))
        self.first = np.full(n_shards, -1, np.int64)
        self.sizes = np.zeros((n_shards, LEVELS), np.uint64)
        self.starts = np.zeros((n_shards, LEVELS), np.int64)
        self.rest: dict[bytes, int] = {}
        before, ends, at, slot, byte = [], [], 0, 0, 0
        for shard, made in self.shards.items():
            k = len(made.sizes)
            self.first[shard], self.sizes[shard, :k] = slot, made.sizes
            self.starts[shard, :k] = at + np.concatenate([[0], np.cumsum((made.sizes + 63) // 64)])[:-1]
            ones = np.bitwise_count(made.words).astype(np.int64)
            before.append(slot + np.cumsum(ones) - ones)
            for i in range(int(ones.sum()), made.n):
                self.rest[made.stored[made.ends[i]:made.ends[i + 1]]] = slot + i
            ends.append(byte + made.ends[:-1])
            at, slot, byte = at + len(made.words), slot + made.n, byte + len(made.stored)
        self.n = slot
        self.words = np.concatenate([m.words for m in self.shards.values()])
        self.before, self.ends = np.concatenate(before), np.append(np.concatenate(ends), byte)
        self.stored = b"".join(m.stored for m in self.shards.values())

    def slots(self, terms: list[bytes]) -> np.ndarray:
        """The slot of each term, −1 for a term that is not the one stored at its slot."""
        h = term_hashes(terms)
        shard = shard_of(h, self.n_shards).astype(np.int64)
        out = np.full(len(terms), -1, np.int64)
        todo = np.flatnonzero(self.first[shard] >= 0)
        for level in range(LEVELS):
            size = self.sizes[shard[todo], level]
            out_of = size == 0
            if out_of.any():  # a shard of fewer levels
                for i in todo[out_of].tolist():
                    out[i] = self.rest.get(terms[i], -1)
                todo, size = todo[~out_of], size[~out_of]
            if not len(todo):
                break
            place = _mixed(h[todo], level) % size
            at = self.starts[shard[todo], level] + (place >> np.uint64(6)).astype(np.int64)
            bit = np.uint64(1) << (place & np.uint64(63))
            word = self.words[at]
            hit = (word & bit) != 0
            out[todo[hit]] = self.before[at[hit]] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            todo = todo[~hit]
        for i in todo.tolist():
            out[i] = self.rest.get(terms[i], -1)
        found = np.flatnonzero(out >= 0)
        a, b, stored = self.ends[out[found]].tolist(), self.ends[out[found] + 1].tolist(), self.stored
        same = [stored[s:e] == terms[i] for s, e, i in zip(a, b, found.tolist())]
        out[found[~np.array(same, bool)]] = -1
        return out


def shard_of(h, n):
    """Shard of a term by the high half of its hash (a numpy array here, the same in ``_shard``)."""
    return (h >> np.uint64(33)) % np.uint64(n)


def _shard(term: str, n: str):
    return (F.shiftrightunsigned(F.xxhash64(F.col(term)), 33) % F.col(n)).cast("int")


# ------------------------------------------------------------------ pass one: terms of enough documents

def _document_counts(batches):
    """Partial document counts per (language, term); a task holds a bounded number of terms."""
    held: dict[str, Counter] = defaultdict(Counter)
    schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])
    entries = 0

    def rows():
        for lang, counts in held.items():
            for term, n in counts.items():
                yield lang, term, n

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            distinct: set[bytes] = set()
            for terms in term_blocks(text.as_py()):
                distinct.update(terms)
            counter = held[lang]
            before = len(counter)
            counter.update(distinct)
            entries += len(counter) - before
            if entries > HELD_TERMS:
                yield from in_slices(rows(), schema, weigh=lambda r: len(r[1]))
                held.clear()
                entries = 0
    yield from in_slices(rows(), schema, weigh=lambda r: len(r[1]))


def kept_terms(texts: DataFrame, min_docs: int) -> DataFrame:
    """``(lang, term)`` of at least ``min_docs`` documents of the language."""
    partial = texts.mapInArrow(_document_counts, "lang string, term binary, n long")
    return (partial.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= F.lit(min_docs))
            .select("lang", F.col("term").cast("string").alias("term")))


_SHARDS = "lang string, shard int, n long, words binary, sizes binary, ends binary, stored binary"


def _build(key, table):
    made = PerfectHash.build([t.encode() for t in table.column("term").to_pylist()])
    return pa.table({"lang": [key[0].as_py()], "shard": pa.array([key[1].as_py()], pa.int32()), "n": pa.array([made.n], pa.int64()),
                     **{k: pa.array([v], pa.binary()) for k, v in zip(("words", "sizes", "ends", "stored"), made.packed())}})


def perfect_hashes(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> tuple[DataFrame, DataFrame]:
    """Shards ``(lang, shard, n, words, sizes, ends, stored)`` and languages ``(lang, v, n_shards)``; both stored.

    Terms go to shards by their hash, so a shard has ``shard_terms`` terms or a little more or less.
    """
    langs = materialize(terms.groupBy("lang").agg(F.count("*").alias("v"))
                        .withColumn("n_shards", F.ceil(F.col("v") / F.lit(shard_terms)).cast("long")))
    dealt = terms.join(langs, "lang").select("lang", "term", _shard("term", "n_shards").alias("shard"))
    return materialize(dealt.groupBy("lang", "shard").applyInArrow(_build, _SHARDS)), langs


# ------------------------------------------------------------------ pass two: dense slots per group

_COUNTS = "lang string, source string, shard int, n long, slots array<int>, counts array<long>"


def _slot_counter(broadcast):
    def count(batches):
        shards: dict[str, dict] = defaultdict(dict)
        n_shards = {}
        for lang, n_shards[lang], shard, packed in broadcast.value:
            shards[lang][shard] = PerfectHash.unpacked(*packed)
        lookups = {lang: Lookup(found, n_shards[lang]) for lang, found in shards.items()}
        held: dict[str, dict[str, Counter]] = {lang: defaultdict(Counter) for lang in lookups}
        dense: dict[tuple, np.ndarray] = {}
        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("shard", pa.int32()), ("n", pa.int64()),
                            ("slots", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
        tokens = slots = entries = 0

        def look_up():
            """Increments of the terms held; slots are handed on whenever a task has enough of them."""
            nonlocal slots
            for lang, groups in held.items():
                lookup = lookups[lang]
                terms = [t for counter in groups.values() for t in counter]
                at, start = lookup.slots(terms) if terms else None, 0
                for source, counter in groups.items():
                    own = at[start:start + len(counter)] if counter else []
                    start += len(counter)
                    if not counter:
                        continue
                    if slots > HELD_SLOTS:
                        yield from hand_on()
                    if (lang, source) not in dense:
                        dense[lang, source] = np.zeros(lookup.n, np.int32)
                        slots += lookup.n
                    n, good = np.fromiter(counter.values(), np.int64, len(counter)), own >= 0
                    dense[lang, source][own[good]] += n[good].astype(np.int32)  # distinct terms have distinct slots
                groups.clear()

        def hand_on():
            nonlocal slots, tokens
            yield from in_slices(rows(), schema, weigh=lambda r: 12 * len(r[4]))
            dense.clear()
            slots = tokens = 0

        def rows():
            for (lang, source), counts in dense.items():
                for shard, made in lookups[lang].shards.items():
                    first = lookups[lang].first[shard]
                    own = counts[first:first + made.n]
                    at = np.flatnonzero(own)
                    if len(at):
                        yield lang, source, shard, made.n, at.astype(np.int32), own[at].astype(np.int64)

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                if lang not in held:
                    continue
                for terms in term_blocks(text.as_py()):
                    counter = held[lang][source]
                    before = len(counter)
                    counter.update(terms)
                    entries += len(counter) - before
                    tokens += len(terms)
                    if entries > HELD_TERMS or tokens > HELD_TOKENS:
                        yield from look_up()
                        entries = 0
                        if tokens > HELD_TOKENS:
                            yield from hand_on()
        yield from look_up()
        yield from hand_on()

    return count


def _merged(keys: tuple[str, ...]):
    """Sum of sorted runs of slot counts; one dense array at a time."""
    def merge(batches):
        schema = pa.schema([*((k, pa.int32() if k == "shard" else pa.string()) for k in keys), ("n", pa.int64()),
                            ("total", pa.int64()), ("counts", pa.list_(pa.int64()))])

        def rows():
            last, counts = None, None
            for batch in batches:
                columns = [batch.column(k).to_pylist() for k in (*keys, "n")]
                for i, (*key, n) in enumerate(zip(*columns)):
                    if key != last:
                        if last is not None:
                            yield (*last, len(counts), int(counts.sum()), counts)
                        last, counts = key, np.zeros(n, np.int64)
                    more = batch.column("counts")[i].values.to_numpy(zero_copy_only=False)
                    if "slots" in batch.schema.names:
                        counts[batch.column("slots")[i].values.to_numpy(zero_copy_only=False)] += more
                    else:
                        counts += more
            if last is not None:
                yield (*last, len(counts), int(counts.sum()), counts)

        yield from in_slices(rows(), schema, weigh=lambda r: 8 * len(r[-1]))

    return merge


def _merge(parts: DataFrame, *keys: str) -> DataFrame:
    ddl = ", ".join(f"{k} {'int' if k == 'shard' else 'string'}" for k in keys) + ", n long, total long, counts array<long>"
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merged(keys), ddl)


def _rounds(shards: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Shards with their round; the rounds' bytes are measured, and their number raised until none has more than ``most``.

    A single shard beyond ``most`` is a round of its own.
    """
    weight = F.octet_length("words") + F.octet_length("sizes") + F.octet_length("ends") + F.octet_length("stored")
    total, largest = shards.agg(F.sum(weight), F.max(weight)).first()
    n = max(1, -(-(total or 0) // most))
    while True:
        dealt = shards.withColumn("round", F.pmod(F.xxhash64("lang", "shard"), F.lit(n)).cast("int"))
        worst = dealt.groupBy("round").agg(F.sum(weight).alias("b")).agg(F.max("b")).first()[0] or 0
        if worst <= max(most, largest or 0):
            return dealt, n
        n += max(1, n // 4)


def slot_counts(texts: DataFrame, shards: DataFrame, langs: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``(lang, source, shard, n, total, counts)``: dense counts of a shard's terms in each group that has one; stored."""
    spark = texts.sparkSession
    dealt, n_rounds = _rounds(shards.join(langs.select("lang", "n_shards"), "lang"), round_bytes)
    parts = None
    for k in range(n_rounds):
        held = [(r.lang, r.n_shards, r.shard, tuple(map(bytes, (r.words, r.sizes, r.ends, r.stored))))
                for r in dealt.filter(F.col("round") == F.lit(k)).toLocalIterator()]
        part = texts.mapInArrow(_slot_counter(spark.sparkContext.broadcast(held)), _COUNTS)
        parts = part if parts is None else parts.unionByName(part)
    return materialize(_merge(parts, "lang", "source", "shard"))


# ------------------------------------------------------------------ shares and divergence

def shares(counts: np.ndarray, denominator: int) -> np.ndarray:
    """``1 + floor(SHARE · (count + 1) / denominator)``, exact: long division by three digits at a time."""
    x, out = counts.astype(np.int64) + 1, np.zeros(counts.shape, np.int64)
    whole, rest = np.divmod(x, denominator)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, denominator)
        out = out * 1000 + digit
    return 1 + whole * SHARE + out


def _matrix(table: pa.Table) -> tuple[list[str], np.ndarray]:
    """Sources and their shares in this shard; a source without a count there has zeros."""
    names, rows = table.column("source").to_pylist(), []
    for n, total, v, counts in zip(*(table.column(c).to_pylist() for c in ("n", "total", "v")), table.column("counts")):
        c = np.zeros(n, np.int64) if counts.as_py() is None else counts.values.to_numpy(zero_copy_only=False)
        rows.append(shares(c, total + v))
    return names, np.array(rows)


_PAIRS = "lang string, source string, item string, value long"


def _compare(key, left, right):
    out: list[tuple] = []
    if left.num_rows and right.num_rows:
        (names, p), (others, q) = _matrix(left), _matrix(right)
        for name, mine in zip(names, p):
            d = mine - q
            value = (d * d // q).sum(axis=1)
            out += [(key[0].as_py(), name, other, int(x)) for other, x in zip(others, value) if other != name]
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table(dict(zip(("lang", "source", "item", "value"),
                             (pa.array(c, t) for c, t in zip(columns, (pa.string(),) * 3 + (pa.int64(),))))))


def _pair_values(groups: DataFrame, shards: DataFrame, counts: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for the ordered pairs of sources of a language with terms.

    Every group has a row in every shard of its language. Sources are dealt
    into blocks and cells of two blocks compare their rows, so a cell holds a
    bounded number of slot arrays whatever the number of sources.
    """
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    grid = (groups.join(blocks, "lang").join(shards.select("lang", "shard", "n"), "lang")
            .join(counts.select("lang", "source", "shard", "counts"), ["lang", "source", "shard"], "left")
            .withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ("lang", "shard", "i", "j", "source", "n", "total", "v", "counts")
    left = grid.withColumn("i", F.col("own")).withColumn("j", every).select(*columns)
    right = grid.withColumn("j", F.col("own")).withColumn("i", every).select(*columns).toDF(*(f"{c}_" for c in columns)).toDF(*columns)
    cell = ("lang", "shard", "i", "j")
    met = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_compare, _PAIRS)
    return met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _leading(top: int):
    """Per group and shard the ``top`` terms that lead there most."""
    def lead(batches):
        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    lang, source, n_group, n_lang, v = (batch.column(c)[i].as_py() for c in ("lang", "source", "total", "lang_total", "v"))
                    counts, all_counts = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("counts", "lang_counts"))
                    p, q = shares(counts, n_group + v), shares(all_counts, n_lang + v)
                    at = np.flatnonzero((counts > 0) & (p > q))
                    if not len(at):
                        continue
                    value = (p[at] - q[at]) ** 2 // q[at]
                    if len(at) > top:  # all terms tied with the last one stay
                        least = np.partition(value, len(at) - top)[len(at) - top]
                        at, value = at[value >= least], value[value >= least]
                    stored, ends = batch.column("stored")[i].as_py(), np.frombuffer(batch.column("ends")[i].as_py(), np.int64)
                    for slot, x in zip(at.tolist(), value.tolist()):
                        yield lang, source, stored[ends[slot]:ends[slot + 1]].decode(), x

        yield from in_slices(rows(), schema, weigh=lambda r: len(r[2]))

    return lead


def _leading_terms(groups: DataFrame, shards: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    sums = _merge(counts.select("lang", "shard", "n", "counts"), "lang", "shard")
    n_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    whole = (sums.select("lang", "shard", F.col("counts").alias("lang_counts"))
             .join(shards.select("lang", "shard", "stored", "ends"), ["lang", "shard"]).join(n_lang, "lang"))
    rows = (counts.drop("total").join(groups, ["lang", "source"]).join(whole, ["lang", "shard"])
            .select("lang", "source", "total", "lang_total", "v", "counts", "lang_counts", "stored", "ends"))
    return rows.mapInArrow(_leading(top), _PAIRS)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, round_bytes: int = ROUND_BYTES,
          shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far the sources of each language differ.

    A term is a run of ASCII letters and characters beyond ASCII, A-Z
    lower-cased. A language keeps its terms of at least ``min_docs`` rows
    (repeated rows are documents each). A group's share of a kept term is
    ``p = 1 + floor(10^9 (count + 1) / (N + V))``, and ``floor((p − q)² / q)``
    its distance from share ``q``. Part ``pair`` sums the distances of a group
    from each other source of its language, part ``term`` lists the ``top``
    terms whose share in the group exceeds the language's, value descending,
    ties by term.

    Null ``lang``, ``source`` and ``text`` count as empty. A language without
    kept terms gives pairs of value 0, one with a single source no pairs; an
    empty table gives no rows. Long texts are read in blocks. Extra columns
    are ignored.
    """
    ship_package(docs.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    texts = docs.select(blank("lang"), blank("source"), blank("text"))
    shards, langs = perfect_hashes(materialize(kept_terms(texts, min_docs)), shard_terms)
    counts = slot_counts(texts, shards, langs, round_bytes)
    totals = counts.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    groups = materialize(texts.select("lang", "source").distinct().join(langs.select("lang", "v"), "lang", "left")
                         .join(totals, ["lang", "source"], "left").na.fill(0, ["v", "total"]))
    bare = groups.filter("v = 0").select("lang", "source")
    nothing = (bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source != item")
               .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    found = groups.filter("v > 0")
    pairs = _pair_values(found, shards, counts).unionByName(nothing)
    terms = _ranked(_leading_terms(found, shards, counts, top), "term").filter(F.col("rank") <= F.lit(top))
    return _ranked(pairs, "pair").unionByName(terms)
