"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule: a piecewise-linear density over training
time 0 … 1. Its integral is the source's weight; weights share the word
budget, no source above ``max_repeat`` times its size, the excess reshared by
weight. The documents of a source, in a seeded order and again from the start
for each repeat, consume its demand; the position of a document is the time
at which the source's cumulative demand reaches the words before it, found by
inverting the integrated schedule. Rows come out range-sorted by position.

DataFrame functions only. Cumulative words need an order inside each source,
and one source may hold most rows, so the order key (a digest) is cut into
``buckets``: totals per (source, bucket) are a partial aggregate, their
running sums give each bucket its offset, and rows are summed up inside one
(source, bucket) each. Only tables of one row per source or per bucket of a
source pass through a window without further splitting.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simpairs.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (3, 1, 2)
SHARE, MAX_REPEAT, SEED = 1.5, 2.0, 2020
#: hex digits of the order digest that name a bucket: 4096 buckets for each source
BUCKET_DIGITS = 3


def cycled_schedules(sources: DataFrame, cycle=CYCLE) -> DataFrame:
    """``(source, knots)``: weights of ``cycle`` by code point of the source, null last.

    The heaviest weight falls over time, the lightest rises, others stay even;
    each schedule integrates to its weight.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (rank % len(cycle) + 1).cast("int"))
    slope = F.when(w == max(cycle), F.lit(-0.5)).when(w == min(cycle), F.lit(0.5)).otherwise(F.lit(0.0))
    knot = lambda t, x: F.struct(F.lit(t).alias("t"), x.alias("w"))
    return sources.select("source", F.array(knot(0.0, w * (1 - slope)), knot(1.0, w * (1 + slope))).alias("knots"))


def _segments(schedules: DataFrame) -> DataFrame:
    """``(source, weight, segments)``; a segment is (t, w, slope, area before it)."""
    parts = F.expr("zip_with(slice(knots, 1, size(knots) - 1), slice(knots, 2, size(knots) - 1), (a, b) -> "
                   "struct(a.t AS t, a.w AS w, (b.w - a.w) / (b.t - a.t) AS m, (b.t - a.t) * (a.w + b.w) / 2 AS area))")
    return (schedules.select("source", parts.alias("p"))
            .select("source", F.expr("aggregate(p, 0D, (s, x) -> s + x.area)").alias("weight"),
                    F.expr("transform(p, (x, i) -> struct(x.t AS t, x.w AS w, x.m AS m, "
                           "aggregate(slice(p, 1, i), 0D, (s, y) -> s + y.area) AS before))").alias("segments")))


def source_targets(sizes: DataFrame, schedules: DataFrame, share: float = SHARE,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``(source, source_size, target, weight, segments)`` from ``(source, source_size)``.

    Sources ordered by the ratio of their cap to their weight reach the cap
    first; with the caps of those before it and the weights from it on, each
    source can tell whether the level reaches its own cap.
    """
    s = sizes.join(_segments(schedules).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    s = s.select("source", "source_size", "weight", "segments",
                 (F.col("source_size") * F.lit(max_repeat)).alias("cap"))
    everything = Window.partitionBy()
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum(F.col("source_size")).over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    over = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left / over).withColumn("place", F.row_number().over(order))
    s = s.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    # the first source that its level leaves below its cap; later ones were counted down with it
    level = F.min(F.when(~F.col("full"), F.struct("place", "level"))).over(everything)
    s = s.withColumn("full", F.col("full") & (level.isNull() | (F.col("place") < level["place"])))
    return s.select("source", "source_size", "weight", "segments",
                    F.when(F.col("full"), F.col("cap")).otherwise(level["level"] * F.col("weight")).alias("target"))


def _time(words, target):
    """Time at which the integrated schedule reaches the share ``words / target``."""
    area = words / target * F.col("weight")
    seg = F.element_at(F.filter("segments", lambda s: s["before"] <= area), -1)
    rest = area - seg["before"]
    # root of w·x + m·x²/2 = rest, in the form that stays exact for m = 0
    step = 2 * rest / (seg["w"] + F.sqrt(F.greatest(seg["w"] * seg["w"] + 2 * seg["m"] * rest, F.lit(0.0))))
    return F.when(rest > 0, seg["t"] + step).otherwise(seg["t"])


def mix(docs: DataFrame, schedules: DataFrame | None = None, share: float = SHARE,
        max_repeat: float = MAX_REPEAT, keep: tuple = ("doc_id",), seed: int = SEED) -> DataFrame:
    """``(row, size, source_size, target, taken, parts, positions)``, one row per input row.

    ``row`` holds the columns ``keep`` of the input. ``size`` counts the words
    of the text, ``taken`` the words the mix takes of it over all repeats;
    ``parts`` and ``positions`` are arrays with one entry per repeat: words
    taken (0: none) and time in 0 … 1 (null: not taken). The last document of
    a source's target is taken in part, so a source's ``taken`` sum to its
    target without the fraction.

    ``schedules`` is ``(source, knots array<struct<t, w>>)`` from time 0 to 1,
    positive in between; default: ``cycled_schedules``. Null texts have size
    0 and, like empty ones, are never taken; a null source is a source of its
    own; documents of the same id are ordered by size and text, and equal
    rows share the outcome of their places in any order. A source of size 0
    has target 0. An empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("doc_id").alias("id"),
                       # one key that is never null: sources by code point, null last
                       F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t")).alias("key"),
                       size.alias("size"), digest.alias("digest"), F.xxhash64("text").alias("text_hash"))
    rows = rows.withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    if "text" not in keep:
        rows = materialize(rows)  # slim: the text is read and counted once
    totals = rows.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    totals = materialize(totals)
    name = F.when(F.col("key") != "t", F.substring("key", 2, 1 << 30))
    sizes = totals.groupBy("key").agg(F.sum("words").alias("source_size")).select(name.alias("source"), "source_size")
    targets = source_targets(sizes, schedules if schedules is not None else cycled_schedules(sizes), share, max_repeat)
    targets = targets.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t"))).drop("source")
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = (totals.select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
              .join(targets, "key"))
    inside = (Window.partitionBy("key", "bucket")
              .orderBy("digest", F.col("id").asc_nulls_first(), "size", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(places, ["key", "bucket"]))
    starts = [F.lit(e) * F.col("source_size") + F.col("offset") + F.col("inside") for e in range(math.ceil(max_repeat))]
    whole = F.floor("target").cast("long")
    parts = [F.greatest(F.least(whole - s, F.col("size")), F.lit(0)) for s in starts]
    times = [F.when(p > 0, _time(s.cast("double"), F.col("target"))) for s, p in zip(starts, parts)]
    out = rows.select("row", "size", "source_size", "target", F.array(*parts).alias("parts"),
                      F.array(*times).alias("positions"))
    return out.withColumn("taken", F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x))


def by_position(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix`` range-sorted by their first position; those not taken come last, spread by their content."""
    return mixed.orderBy(F.col("positions")[0].asc_nulls_last(), F.xxhash64("row", "size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the input's columns, one row per copy taken, range-sorted by position.

    Copies are whole: of the one document of a source that its target cuts, a
    copy stays if at least half of its words are taken.
    """
    mixed = mix(docs, keep=tuple(docs.columns), **options)
    taken = F.filter(F.arrays_zip("parts", "positions"), lambda c: (c["parts"] > 0) & (2 * c["parts"] >= F.col("size")))
    copies = mixed.select("row", F.explode(taken).alias("copy"))
    return (copies.select(F.col("copy.positions").alias("position"), "row").orderBy("position")
            .select("row.*"))
