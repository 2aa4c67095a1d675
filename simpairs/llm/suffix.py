"""Removal of repeated substrings by a hash-compared suffix sort.

Every byte covered by a ``length``-byte string (window) that also starts
anywhere else goes. All windows of a corpus are too many to sort, so:

1. Each window chooses an anchor, the leftmost of its k-grams with the least
   hash. Windows next to each other with one anchor form a run of at most
   ``length − k + 1`` starts. Equal windows have equal anchors, and only runs
   leave the scan task: anchor hash, and a digest of the run's bytes.
2. Partial aggregates per anchor hash tell runs apart: an anchor seen once
   has no repeat; one whose runs are all equal repeats as a whole; the rest
   (edges of copied passages, edits) are mixed.
3. The distinct byte strings of mixed runs are sorted, anchor by anchor:
   suffixes from the anchor, and reversed prefixes before it, each by a
   mergesort whose comparisons find the common extension of two suffixes by
   binary search over prefix polynomial hashes. Neighbours in the order are
   then verified byte by byte. The window with ``l`` bytes before its anchor
   repeats if another run agrees on ``l`` bytes to the left and the rest to
   the right: both orders cut at those lengths give classes, and a class of
   two or more is a repeat.

An anchor may have very many distinct runs. Windows with ``lo`` to ``hi``
bytes before their anchor all hold the ``lo`` bytes before it and the
``length − hi`` bytes from it on, so such a group is cut into narrower bands
of ``lo … hi`` and each band by a hash of that longer core: equal windows stay
together, others part. The new groups are judged like anchors (seen once, all
equal, mixed), and those still too large are cut again, down to bands of one
window, where a group is one class. No task sorts more than ``PART`` runs of a
group, and no classes are exchanged. Texts are shuffled once, into a bucketed
table of distinct contents with their number of copies; later steps join on it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm import common
from simpairs.session import bucketed, materialize, ship_package

LENGTH, GRAM = 200, 32
#: window starts hashed at once, so a long text needs bounded memory
BLOCK = 1 << 18
#: runs of one group sorted by one task, runs sorted at once, and bands that a larger group is cut into
PART, CHUNK, BANDS = 1_000, 5_000, 4
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 … n − 1 of a base and of its inverse, modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << (n - 1).bit_length()
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t, k = np.ones(size, np.uint64), 1
            while k < size:
                m = min(k, size - k)
                t[k:k + m] = t[:m] * t[k - 1] * np.uint64(b)
                k += m
            tables.append(t)
        have = _POWERS[base] = tuple(tables)
    return have


class PrefixHashes:
    """Polynomial hashes of any substring of some bytes, from the hashes of its prefixes."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        up, self.down = _powers(len(data) + 1, base)
        self.h = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.h[1:])

    def of(self, start, length):
        return (self.h[start + length] - self.h[start]) * self.down[start]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(BASES[1])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(BASES[0])
    return x ^ (x >> np.uint64(32))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row: block-wise minima from both sides."""
    rows = -(-len(x) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def runs(data: bytes, length: int, gram: int):
    """Arrays (start, number of windows, bytes before the anchor, anchor hash) of a text's runs."""
    d, width = np.frombuffer(data, np.uint8), length - gram + 1
    low = np.uint64((1 << 32) - 1)
    for at in range(0, len(d) - length + 1, BLOCK):
        part = d[at:at + BLOCK + length - 1]
        n = len(part) - length + 1
        h = PrefixHashes(part)
        grams = _mix(h.of(np.arange(len(part) - gram + 1), gram))
        # the place decides between equal values: the leftmost is least
        least = _sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        start = np.concatenate([[0], cut])
        anchor = (least[start] & low).astype(np.int64)
        yield at + start, np.diff(np.append(start, n)), anchor - start, grams[anchor].view(np.int64)


def _signed(x: int) -> int:
    return x - (x >> 63 << 64)


def _run_rows(length: int, gram: int):
    def run(batches):
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            held, n = [], 0
            for a, b, copies, text in zip(batch.column("a"), batch.column("b"), batch.column("copies"),
                                          common.byte_texts(batch.column("text"))):
                a, b, copies = a.as_py(), b.as_py(), copies.as_py()
                view = memoryview(text)
                for start, count, off, anchor in runs(text, length, gram):
                    digest = np.fromiter((_signed(xxh3_64_intdigest(view[s:s + c + length - 1], seed=int(o)))
                                          for s, c, o in zip(start.tolist(), count.tolist(), off.tolist())),
                                         np.int64, len(start))
                    held.append((anchor, digest, np.full(len(start), a), np.full(len(start), b),
                                 start << 32 | count << 16 | off, np.full(len(start), copies)))
                    n += len(start)
                if n >= 50_000:
                    yield _columns(held)
                    held, n = [], 0
            if held:
                yield _columns(held)

    return run


RUNS = "anchor long, digest long, a long, b long, place long, copies long"


def _columns(held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*held)],
                                      names=[c.split()[0] for c in RUNS.split(", ")])


def _unpack(place: str = "place"):
    p = F.col(place)
    return (F.shiftright(p, 32).cast("int").alias("start"), F.shiftright(p, 16).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("count"),
            p.bitwiseAND(F.lit(0xFFFF)).cast("int").alias("off"))


# ---------------------------------------------------------------- the sort

def _extensions(h: PrefixHashes, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common extension of the suffixes at ``i`` and ``j``, up to ``most``, by binary search."""
    low, high = np.zeros(len(i), np.int64), most.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) >> 1
        equal = h.of(i, mid) == h.of(j, mid)
        low = np.where(open_ & equal, mid, low)
        high = np.where(open_ & ~equal, mid - 1, high)


def suffix_order(data: np.ndarray, place: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items by group (given ascending) and suffix, and each one's extension in common with the item before it.

    Item ``i`` is ``data[place[i]: place[i] + size[i]]``. All merges of one
    level run together: every item finds its rank in the neighbouring run by
    binary search, each step one comparison by common extension.
    """
    n, h = len(place), PrefixHashes(data)
    padded = np.append(data, np.uint8(0))

    def less(x, y):
        same = _extensions(h, place[x], place[y], np.minimum(size[x], size[y]))
        ends = (same == size[x]) | (same == size[y])
        at = lambda z: padded[np.minimum(place[z] + same, len(data))]
        return np.where(ends, size[x] < size[y], at(x) < at(y))

    first = np.searchsorted(group, group)
    last = np.searchsorted(group, group, side="right")
    order, within, width = np.arange(n), np.arange(n) - first, 1
    while n and width < int((last - first).max()):
        pair = first + within // (2 * width) * 2 * width
        middle = np.minimum(pair + width, last)
        end = np.minimum(pair + 2 * width, last)
        left = np.arange(n) < middle
        low, high = np.where(left, middle, pair), np.where(left, end, middle)
        base = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            me, other, is_left = order[open_], order[mid], left[open_]
            # ranks among smaller ones; of equal ones the left run comes first
            one = less(np.where(is_left, other, me), np.where(is_left, me, other))
            up = np.where(is_left, one, ~one)
            low[open_] = np.where(up, mid + 1, low[open_])
            high[open_] = np.where(up, high[open_], mid)
        target = pair + (np.arange(n) - np.where(left, pair, middle)) + (low - base)
        merged = np.empty(n, np.int64)
        merged[target] = order
        order, width = merged, width * 2
    common_ = np.zeros(n, np.int64)
    inner = np.flatnonzero(group[1:] == group[:-1]) + 1
    if len(inner):
        x, y = order[inner - 1], order[inner]
        common_[inner] = _extensions(h, place[x], place[y], np.minimum(size[x], size[y]))
        if not _verified(padded, place, size, x, y, common_[inner]):
            return _plain_order(data, place, size, group)
    return order, common_


def _verified(data, place, size, x, y, same) -> bool:
    """True if neighbours agree on their common extension byte by byte and are in order behind it."""
    total = np.cumsum(same)
    for cut in np.split(np.arange(len(x)), np.searchsorted(total, np.arange(1 << 22, int(total[-1]) + 1, 1 << 22))):
        step = np.repeat(np.arange(len(cut)), same[cut])
        inside = np.arange(len(step)) - np.repeat(np.cumsum(same[cut]) - same[cut], same[cut])
        if (data[place[x[cut]][step] + inside] != data[place[y[cut]][step] + inside]).any():
            return False
    both = (same < size[x]) & (same < size[y])
    ordered = data[place[x[both]] + same[both]] < data[place[y[both]] + same[both]]
    return bool(ordered.all() and (size[x[~both]] <= size[y[~both]]).all())


def _plain_order(data, place, size, group):
    """The same order without hashes, for the case that two of them collided."""
    texts = [data[p:p + s].tobytes() for p, s in zip(place, size)]
    order = np.array(sorted(range(len(texts)), key=lambda i: (group[i], texts[i])), np.int64)
    common_ = np.zeros(len(texts), np.int64)
    for k in range(1, len(order)):
        s, t = texts[order[k - 1]], texts[order[k]]
        if group[order[k - 1]] == group[order[k]]:
            most = min(len(s), len(t))
            common_[k] = next((i for i in range(most) if s[i] != t[i]), most)
    return order, common_


def repeated_windows(group: np.ndarray, texts: list[bytes], off: np.ndarray, copies: np.ndarray, length: int):
    """Arrays (item, window start, class weight) of all windows of a chunk of runs.

    ``group`` ascends; ``off`` is the place of the anchor in each text.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    anchor = np.cumsum(sizes) - sizes + off
    n, count = len(texts), sizes - length + 1
    right, right_same = suffix_order(data, anchor, sizes - off, group)
    left, left_same = suffix_order(data[::-1].copy(), len(data) - anchor, off, group)
    change = np.append(True, group[1:] != group[:-1])
    items, starts, weights = [], [], []
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(int(off.max()) + 1):
        members = np.flatnonzero((off >= l) & (off - l < count))
        if not len(members):
            continue
        right_class[right] = np.cumsum(change | (right_same < length - l))
        left_class[left] = np.cumsum(change | (left_same < l))
        _, which = np.unique(right_class[members] * (n + 1) + left_class[members], return_inverse=True)
        items.append(members)
        starts.append(off[members] - l)
        weights.append(np.bincount(which, weights=copies[members]).astype(np.int64)[which])
    return tuple(np.concatenate(c) for c in (items, starts, weights))


SOLVED = "anchor long, digest long, bounds array<int>"


def _solve(length: int, schema: pa.Schema):
    """Sorts chunks of whole (core, lo) groups; rows arrive sorted by both."""

    def chunks(batches):
        held, size = [], 0
        for batch in batches:
            at = 0
            key = list(zip(batch.column("core").to_pylist(), batch.column("lo").to_pylist()))
            for i in range(1, len(key) + 1):
                if i == len(key) or key[i] != key[i - 1]:
                    if held and size >= CHUNK and held[-1][0] != key[at]:
                        yield pa.Table.from_batches([h[1] for h in held])
                        held, size = [], 0
                    held.append((key[at], batch.slice(at, i - at)))
                    size += i - at
                    at = i
        if held:
            yield pa.Table.from_batches([h[1] for h in held])

    def run(batches):
        for chunk in chunks(batches):
            core, lo = chunk["core"].to_numpy(), chunk["lo"].to_numpy()
            group = np.cumsum(np.append(0, (core[1:] != core[:-1]) | (lo[1:] != lo[:-1])))
            off, copies = chunk["off"].to_numpy().astype(np.int64), chunk["copies"].to_numpy()
            item, start, weight = repeated_windows(group, chunk["bytes"].to_pylist(), off, copies, length)
            yield from common.in_slices(_solved(chunk["anchor"].to_numpy(), chunk["digest"].to_numpy(), chunk["at"].to_numpy(),
                                                item, start, weight), schema)

    return run


def _solved(anchor, digest, at, item, start, weight):
    """Starts of repeated windows of each run, as bounds of intervals."""
    twice = np.flatnonzero(weight > 1)
    order = twice[np.lexsort((start[twice], item[twice]))]
    i, s = item[order], start[order]
    if not len(order):
        return
    new = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (s[1:] != s[:-1] + 1)))
    ends = s[np.append(new[1:], len(s)) - 1] + 1
    owner = i[new]
    cut = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    for a, b in zip(cut, np.append(cut[1:], len(owner))):
        bounds = np.stack([s[new[a:b]], ends[a:b]], axis=1).ravel() + at[owner[a]]
        yield int(anchor[owner[a]]), int(digest[owner[a]]), bounds.tolist()


#: a run, or the part of it (``at`` bytes on) whose windows have ``lo`` to ``hi`` bytes before the anchor; ``own`` tells
#: such parts apart, (``core``, ``lo``) names the group within which windows can be equal
PARTS = ("anchor long, digest long, core long, lo int, hi int, at int, own long, "
         "bytes binary, off int, copies long")


def _narrowed(length: int, schema: pa.Schema):
    """Cuts the band of each row into ``BANDS`` narrower ones, each under the hash of its core."""

    def run(batches):
        from xxhash import xxh3_64_intdigest

        def rows(batch):
            for r in batch.to_pylist():
                text, off = r["bytes"], r["off"]
                least = off - (len(text) - length)
                width = -(-(r["hi"] - r["lo"] + 1) // BANDS)
                for lo in range(r["lo"], r["hi"] + 1, width):
                    hi = min(lo + width - 1, r["hi"])
                    first, last = max(lo, least), min(hi, off)
                    if first <= last:
                        part = text[off - last:off - first + length]
                        core = xxh3_64_intdigest(text[off - lo:off + length - hi], seed=r["anchor"] % (1 << 64))
                        yield (r["anchor"], r["digest"], _signed(core), lo, hi, r["at"] + off - last,
                               _signed(xxh3_64_intdigest(part, seed=last)), part, last, r["copies"])

        for batch in batches:
            yield from common.in_slices(rows(batch), schema, 5000)

    return run


def _repeated_starts(strings: DataFrame, length: int, gram: int) -> DataFrame:
    """``(anchor, digest, bounds)``: starts of repeated windows of distinct runs, as intervals; a run may have several rows."""
    spark, key = strings.sparkSession, ["core", "lo"]
    solve, narrow = _solve(length, common.arrow_schema(SOLVED, spark)), _narrowed(length, common.arrow_schema(PARTS, spark))
    level = strings.select("anchor", "digest", F.col("anchor").alias("core"), F.lit(0).alias("lo"),
                           F.lit(length - gram).alias("hi"), F.lit(0).alias("at"), F.col("digest").alias("own"),
                           "bytes", "off", "copies")
    found = []
    while True:  # each round divides the width of bands by BANDS; those of one window are never mixed
        judged = (level.groupBy(*key).agg(F.count("*").alias("n"), F.sum("copies").alias("all"),
                                          F.min("own").alias("least"), F.max("own").alias("most"))
                  .select(*key, F.when(F.col("all") == 1, "once").when(F.col("least") == F.col("most"), "equal")
                          .when(F.col("n") > PART, "large").alias("kind")))
        judged = materialize(judged.filter("kind IS NOT NULL"))
        found.append(materialize(level.join(judged, key, "left_anti").repartition(*key).sortWithinPartitions(*key)
                                 .mapInArrow(solve, SOLVED)))
        whole = F.array("at", F.col("at") + F.octet_length("bytes") - F.lit(length - 1))
        found.append(level.join(judged.filter("kind = 'equal'"), key).select("anchor", "digest", whole.alias("bounds")))
        large = judged.filter("kind = 'large'")
        if large.isEmpty():
            break
        level = materialize(level.join(large, key).drop("kind").mapInArrow(narrow, PARTS))
    bounds = found[0]
    for more in found[1:]:
        bounds = bounds.unionByName(more)
    return materialize(bounds)


# ---------------------------------------------------------------- the corpus

STRINGS = "anchor long, digest long, off int, copies long, bytes binary"


def _strings(length: int, schema: pa.Schema):
    """Bytes of the runs that a text stands for."""

    def run(batches):
        def rows(batch):
            for mixed, text in zip(batch.column("mixed"), common.byte_texts(batch.column("text"))):
                for m in mixed.as_py():
                    start, count = m["place"] >> 32, m["place"] >> 16 & 0xFFFF
                    yield m["anchor"], m["digest"], m["place"] & 0xFFFF, m["copies"], text[start:start + count + length - 1]

        for batch in batches:
            yield from common.in_slices(rows(batch), schema, 5000)

    return run


def _finish(length: int, schema: pa.Schema):
    def rows(batch):
        for a, b, copies, covers, text in zip(batch.column("a"), batch.column("b"), batch.column("copies"),
                                              batch.column("covers"), common.byte_texts(batch.column("text"))):
            n = len(text)
            found = covers.as_py() or []
            if copies.as_py() > 1 and n >= length:
                found = [{"start": 0, "count": n - length + 1}]
            spans: list[list[int]] = []
            for c in sorted(found, key=lambda c: c["start"]):
                start, end = c["start"], c["start"] + c["count"] + length - 1
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
            kept, at, digest = n, 0, hashlib.sha256()
            for start, end in spans:
                digest.update(text[at:start])
                kept, at = kept - (end - start), end
            digest.update(text[at:])
            yield a.as_py(), b.as_py(), n, n - kept, spans, digest.hexdigest()

    def run(batches):
        for batch in batches:
            yield from common.in_slices(rows(batch), schema, 5000)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept_sha256)``, one row per input row.

    ``spans`` are the maximal byte runs ``[start, end)`` of the UTF-8 text to
    remove: all bytes of every ``length``-byte string that starts at two or
    more places of the input, in any documents, overlaps included. Matches do
    not cross documents. ``kept_sha256`` is over the remaining bytes. Texts
    shorter than ``length`` (null ones count as empty) lose nothing. A text
    that occurs twice, as do repeated rows, goes whole. An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    gram = min(GRAM, max(1, length // 2))
    if length - gram + 1 > 0xFFFF:
        raise ValueError("windows of more than 65,000 bytes are not supported")
    rows = common.documents(docs).select("doc_id", common.no_nulls().alias("text"))
    key = common.row_key(rows.select("text"))
    keyed = rows.select("doc_id", "text", key.alias("k")).select("doc_id", "text", "k.a", "k.b")
    contents = bucketed(keyed.groupBy("a", "b").agg(F.first("text").alias("text"), F.count("*").alias("copies")), "a", "b")
    found = materialize(contents.mapInArrow(_run_rows(length, gram), RUNS))
    anchors = (found.groupBy("anchor").agg(F.sum("copies").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
               .filter("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")))
    repeats = materialize(found.join(materialize(anchors), "anchor"))
    whole = repeats.filter("NOT mixed").select("a", "b", *_unpack()[:2])
    # mixed runs: one text gives the bytes of all runs that are equal
    mixed = repeats.filter("mixed")
    wanted = (mixed.groupBy("anchor", "digest").agg(F.min(F.struct("a", "b", "place")).alias("one"), F.sum("copies").alias("copies"))
              .groupBy("one.a", "one.b").agg(F.collect_list(F.struct("anchor", "digest", "one.place", "copies")).alias("mixed")))
    strings = materialize(contents.join(wanted, ["a", "b"]).select("mixed", "text")
                          .mapInArrow(_strings(length, common.arrow_schema(STRINGS, spark)), STRINGS))
    bounds = _repeated_starts(strings, length, gram)
    pieces = (mixed.select("anchor", "digest", "a", "b", "place").join(bounds, ["anchor", "digest"])
              .select("a", "b", "bounds", _unpack()[0].alias("at"),
                      F.explode(F.sequence(F.lit(0), F.size("bounds") - 2, F.lit(2))).alias("i"))
              .select("a", "b", (F.col("at") + F.col("bounds")[F.col("i")]).alias("start"),
                      (F.col("bounds")[F.col("i") + 1] - F.col("bounds")[F.col("i")]).alias("count")))
    covers = whole.unionByName(pieces).groupBy("a", "b").agg(F.collect_list(F.struct("start", "count")).alias("covers"))
    done = "a long, b long, n_bytes long, n_removed long, spans array<array<long>>, kept_sha256 string"
    results = materialize(contents.join(covers, ["a", "b"], "left").select("a", "b", "copies", "covers", "text")
                          .mapInArrow(_finish(length, common.arrow_schema(done, spark)), done))
    return (keyed.select("doc_id", "a", "b").join(results, ["a", "b"])
            .select("doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"))
