"""Approximate nearest neighbours by adaptive dimension scan inside inverted lists.

Largest inner product becomes least distance: vectors get one more component
that raises all to the greatest norm (queries get zero there). Rows of
outlying norm are left out of this: they form a list of their own that every
query scans, so they do not set the scale of all others. Lists and the order
of probes are found in double precision, with the added component counted
from the greatest norm, where no large numbers cancel. A random
rotation spreads each vector's length evenly over its columns, so a distance
over the first columns estimates the whole one. Vectors are dealt into lists
by their nearest centroid; a query probes its nearest lists, nearest first.
Inside them, distances grow by column blocks, and after each block a
hypothesis test drops candidates whose partial distance is already too large
to end below the query's current k-th distance. Survivors are scored exactly
on the original vectors.

Centroids are fitted on a bounded sample on the driver; every row is indexed.
"""

from __future__ import annotations

import math
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm import cells, common
from simpairs.session import materialize, ship_package

FOUND = "query_id long, query long, vec_id long, score double"
#: expected number of rows the centroids are fitted on; at most twice as many
SAMPLE = 20_000
#: share of the lists a query probes; random vectors need many (measured recall: README)
PROBE = 0.65
#: outlying: above this many times the norm that 99 % of the sampled rows do not exceed
OUTLYING = 2.0
COLUMNS = 16


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fit_centroids(sample: np.ndarray, lists: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's iterations from a seeded choice of rows; an empty list keeps its centroid."""
    centers = sample[np.random.default_rng(seed).choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(sample, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=lists)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def nearest(x: np.ndarray, centers: np.ndarray, at_once: int = 4096) -> np.ndarray:
    half = (centers * centers).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i:i + at_once] @ centers.T - half, axis=1)
                           for i in range(0, len(x), at_once)] or [np.zeros(0, np.int64)])


def norms2(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x * x).sum(axis=1)


def norm_bound(sample: np.ndarray) -> float:
    """Squared norm above which a row is outlying; finite."""
    n2 = np.sort(norms2(sample))
    return min(OUTLYING ** 2 * float(n2[math.ceil(0.99 * len(n2)) - 1]), 1e300) if len(n2) else 0.0


class Index:
    """Rotation and centroids, shared with all tasks (lists × dimensions numbers).

    Vectors are scaled so that the greatest norm not outlying is 1 (squared
    ``top``). ``centers`` are in the coordinates of ``flat``.
    """

    def __init__(self, dim: int, bound: float, top: float, turn: np.ndarray):
        self.dim, self.bound, self.scale, self.turn = dim, bound, math.sqrt(top) or 1.0, turn
        self.centers = np.zeros((0, dim + 1))
        self.sizes = np.zeros(1, np.int64)  # rows of each list in the whole table, the outlying ones last

    def usual(self, x: np.ndarray) -> np.ndarray:
        """True for rows that are not outlying."""
        return norms2(x) <= self.bound

    def flat(self, x: np.ndarray) -> np.ndarray:
        """Rows with what the added component lacks of the greatest norm: distances stay, small numbers keep their digits."""
        x = x / self.scale
        n2 = np.minimum(1.0, norms2(x))[:, None]
        return np.hstack([x, n2 / (1 + np.sqrt(1 - n2))])

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each row; the one after the last centroid's is that of outlying rows."""
        found, usual = np.full(len(x), len(self.centers)), self.usual(x)
        if len(self.centers) and usual.any():
            found[usual] = nearest(self.flat(x[usual]), self.centers)
        return found

    def rows(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        lift = np.sqrt(np.maximum(0.0, 1 - norms2(x)))[:, None]
        return (np.hstack([x, lift]) @ self.turn).astype(np.float32)

    def scaled_queries(self, x: np.ndarray) -> np.ndarray:
        """A query's length does not change the order of inner products: none is longer than the rows."""
        largest = np.abs(x).max(axis=1, keepdims=True)  # not 0; divided by it, no square overflows
        x = x / largest
        with np.errstate(over="ignore"):
            return x * np.minimum(largest / self.scale, 1 / np.sqrt(norms2(x))[:, None])

    def queries(self, scaled: np.ndarray) -> np.ndarray:
        return (np.hstack([scaled, np.zeros((len(scaled), 1))]) @ self.turn).astype(np.float32)

    def order(self, scaled: np.ndarray) -> np.ndarray:
        """Lists by their centroid's distance from each query, nearest first."""
        at = np.hstack([scaled, np.ones((len(scaled), 1))])
        near = at @ self.centers.T - (self.centers * self.centers).sum(axis=1) / 2
        return np.argsort(-near, axis=1, kind="stable")


    def probes(self, order: np.ndarray, least: int, wanted: np.ndarray) -> list[np.ndarray]:
        """The first ``least`` lists of each query's order, and further ones until they hold the wanted number of rows.

        Sizes are those of the whole table, so every block takes the same lists.
        """
        held = self.sizes[-1] + np.cumsum(self.sizes[order], axis=1)
        enough = (held < wanted[:, None]).sum(axis=1) + 1
        return [o[:max(least, e)] for o, e in zip(order, enough)]


def _lists(shared, dim: int):
    def run(batches):
        index = shared.value
        for batch in batches:
            x = cells.matrix(pa.chunked_array([batch.column("x")]), dim, np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(index.lists(x), pa.int32())],
                                             names=["vec_id", "x", "list"])

    return run


def _routes(shared, dim: int, k: int, probe: float, at_once: int = 256):
    """Each query once per block that holds a list it probes, with these ``lists``, nearest first.

    Blocks of outlying rows get every query.
    """

    def run(batches):
        index = shared.value
        probes = max(1, math.ceil(probe * len(index.centers)))
        outlying = index.blocks.get(len(index.centers), range(0))

        def rows(part):
            scaled = index.scaled_queries(cells.matrix(pa.chunked_array([part.column("x")]), dim, np.float64))
            # a query's own rows are no candidates
            chosen = index.probes(index.order(scaled), probes, k + part.column("own").to_numpy())
            for i, lists in enumerate(chosen):
                to = {block: [] for block in outlying}
                for l in lists.tolist():
                    for block in index.blocks.get(l, ()):  # an empty list lies in none
                        to.setdefault(block, []).append(l)
                yield from ((i, block, held) for block, held in to.items())

        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                for some in batched(rows(part), 4096):
                    i, block, lists = zip(*some)
                    copied = part.select(["query_id", "query", "x"]).take(pa.array(i, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*copied.columns, pa.array(block, pa.int32()), pa.array(lists, pa.list_(pa.int32()))],
                                                     names=["query_id", "query", "x", "block", "lists"])

    return run


def scan(turned: np.ndarray, starts: np.ndarray, query: np.ndarray, probe: np.ndarray, own: np.ndarray,
         k: int, columns: int = COLUMNS, doubt: float = 2.1) -> tuple[np.ndarray, np.ndarray]:
    """Candidates left after the adaptive scan of the probed lists, and their squared distances.

    ``starts[l]`` … ``starts[l + 1]`` are the rows of list ``l``; ``own`` marks
    the query's own rows. Lists are taken nearest first, in batches that double.
    """
    dim, limit = turned.shape[1], np.inf
    rows, found = np.zeros(0, np.int64), np.zeros(0, np.float32)
    at, step = 0, 1
    while at < len(probe):
        part = probe[at:at + step]
        at, step = at + step, step * 2
        left = np.concatenate([np.arange(starts[l], starts[l + 1]) for l in part])
        left = left[~own[left]]
        total = np.zeros(len(left), np.float32)
        for c in range(0, dim, columns):
            gap = turned[left, c:c + columns] - query[c:c + columns]
            total = total + (gap * gap).sum(axis=1)
            seen = min(dim, c + columns)
            if seen < dim and limit < np.inf:
                keep = total * (dim / seen) <= limit * (1 + doubt / math.sqrt(seen)) ** 2
                left, total = left[keep], total[keep]
        rows, found = np.concatenate([rows, left]), np.concatenate([found, total])
        if len(found) >= k:
            limit = np.partition(found, k - 1)[k - 1] * 1.00001 + 1e-6  # ties stay
            keep = found <= limit
            rows, found = rows[keep], found[keep]
    return rows, found


def _search(shared, dim: int, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if rows.num_rows and queries.num_rows:
            index = shared.value
            rows = rows.sort_by([("list", "ascending"), ("vec_id", "ascending")])
            ids, lists = rows["vec_id"].to_numpy(), rows["list"].to_numpy()
            x = cells.matrix(rows["x"], dim, np.float64)
            starts = np.searchsorted(lists, np.arange(len(index.centers) + 1))
            turned = np.ascontiguousarray(index.rows(x[:starts[-1]]))
            outlying = np.arange(starts[-1], len(x))  # scored by all queries
            q = cells.matrix(queries["x"], dim, np.float64)
            turned_q = index.queries(index.scaled_queries(q))
            probed = queries["lists"].to_pylist()
            keys = zip(queries["query_id"].to_pylist(), queries["query"].to_pylist())
            for i, (query_id, query) in enumerate(keys):
                own = ids == query_id
                got, _ = scan(turned, starts, turned_q[i], probed[i], own, k)
                got = np.concatenate([got, outlying[~own[outlying]]])
                score = (x[got] * q[i]).sum(axis=1)
                first = np.lexsort((ids[got], -score))[:k]
                out += [(query_id, query, v, s) for v, s in zip(ids[got][first].tolist(), score[first].tolist())]
        return pa.table([list(c) for c in zip(*out)] or [[], [], [], []], schema=schema)

    return run


def search(vectors: DataFrame, is_query, k: int = 20, probe: float = PROBE, sample: int = SAMPLE, block: int = 16_384,
           chunk: int = 512, seed: int = 2020) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products found for each query.

    ``vectors`` is ``(vec_id, embedding)``, ``is_query`` a condition on
    ``vec_id``; candidates are all rows but those of the query's id. ``score``
    is the inner product of the original vectors in double precision; ties go
    to the smaller id. Null or zero vectors, vectors with null or non-finite
    components and rows without an id take no part; rows equal in id and
    vector are one; shorter vectors count as ended by zeros. A query probes
    its share of the lists, and further ones until they hold ``k`` candidates,
    so it returns all candidates if there are fewer. Without rows the result
    is empty.

    There are √n lists, none above the sample, and one of outlying rows. Queries
    go to the blocks that hold a list they probe. A list larger than ``block``
    is split over blocks by row, so one hot list does not make one task.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = materialize(cells.valid_vectors(vectors, nonzero=True))
    n, dim = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    dim = dim or 0
    turn = rotation(dim + 1, seed)
    drawn = rows.filter(common.drawn(sample / max(1, n), "vec_id", "x")).limit(2 * sample).select("x").toArrow()
    x = cells.matrix(drawn["x"], dim, np.float64) if drawn.num_rows else np.zeros((0, dim))
    bound = norm_bound(x)
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    top = rows.select(norm.alias("norm")).filter(F.col("norm") <= F.lit(bound)).agg(F.max("norm")).first()[0] or 0.0
    index = Index(dim, bound, top, turn)
    # sorted, so centroids do not depend on the order of arrival; without copies, so that a vector
    # very many rows share does not take many equal centroids
    usual = x[index.usual(x)]
    if len(usual):
        distinct = np.unique(usual, axis=0)
        index.centers = fit_centroids(index.flat(distinct), min(len(distinct), max(1, math.isqrt(n))), seed)
    shared = spark.sparkContext.broadcast(index)
    listed = materialize(rows.mapInArrow(_lists(shared, dim), "vec_id long, x array<double>, list int"))
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # one row per list
    index.sizes = np.array([sizes.get(l, 0) for l in range(len(index.centers) + 1)], np.int64)
    n_blocks, first, parts = deal(sizes, block)
    index.blocks = {l: range(first[l], first[l] + parts[l]) for l in sizes}
    sized = spark.sparkContext.broadcast(index)
    # one row per list, so at most 2 · sample + 1
    table = spark.createDataFrame([(l, first[l], parts[l]) for l in sizes], "list int, first int, parts int")
    placed = (listed.join(F.broadcast(table), "list")
              .select("vec_id", "x", "list", (F.col("first") + F.pmod(F.xxhash64("vec_id", "x"), "parts")).cast("int").alias("block")))
    asked = rows.filter(is_query)
    queries = (asked.join(asked.groupBy("vec_id").agg(F.count("*").alias("own")), "vec_id")
               .select(F.col("vec_id").alias("query_id"), F.xxhash64("vec_id", "x").alias("query"), "x", "own"))
    routed = queries.mapInArrow(_routes(sized, dim, k, probe), "query_id long, query long, x array<double>, block int, lists array<int>")
    found = cells.in_cells(placed, n_blocks, routed, queries.count(), chunk, _search(sized, dim, k), FOUND)
    return cells.best(found, k, "query_id", "query").select("query_id", "rank", "vec_id", "score")


def deal(sizes: dict[int, int], block: int) -> tuple[int, dict[int, int], dict[int, int]]:
    """Blocks of about ``block`` rows: number of blocks, first block and number of blocks of each list."""
    first, parts, at, room = {}, {}, 0, block
    for l, size in sorted(sizes.items()):
        if size > room and room < block:
            at, room = at + 1, block
        first[l], parts[l] = at, max(1, math.ceil(size / block))
        if parts[l] > 1:
            at, room = at + parts[l], block
        else:
            room -= size
    return at + 1, first, parts
