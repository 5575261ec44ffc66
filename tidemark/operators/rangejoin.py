"""Range joins against the small per-week as-of frame.

A join on ``date BETWEEN as_of - 30 AND as_of + 30`` has no equality key, so
Spark would plan a nested loop costing rows × weeks. Both joins here add an
equi key: the index of a fixed-size day bucket. The point side is exploded to
the buckets its window touches (window join), or the interval side to the
buckets it covers (interval join); the join is then a hash join on the bucket
followed by the exact range test, and the work is proportional to the matches.

The point side is broadcast only when the caller says it is bounded
(``broadcast_points=True``): the blocks do so for the per-week as-of frame,
one row per week of the calendar. Otherwise the bucket equi-join is left to
Spark and AQE (sort-merge, or a broadcast chosen from measured size).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPOCH = dt.date(1970, 1, 1)
_B = "__bucket"
SEGMENT, POINTS, BELOW, LO, HI = "__segment", "__points", "__below", "__lo", "__hi"


def bucket_index(d: Column, days: int = 7) -> Column:
    """Index of the fixed ``days``-wide bucket holding day ``d``."""
    return F.floor(F.datediff(d, F.lit(_EPOCH)) / F.lit(days)).cast("int")


_bucket = bucket_index


def window_join(
    events: DataFrame,
    date_col: str,
    points: DataFrame,
    point_col: str,
    before: int,
    after: int,
    bucket_days: int = 7,
    broadcast_points: bool = False,
) -> DataFrame:
    """Rows of ``events`` paired with every point p where
    ``p - before <= date <= p + after`` (inclusive both ends)."""
    lo = _bucket(F.date_sub(F.col(point_col), before), bucket_days)
    hi = _bucket(F.date_add(F.col(point_col), after), bucket_days)
    pts = points.withColumn(_B, F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    if broadcast_points:
        pts = F.broadcast(pts)
    ev = events.withColumn(_B, _bucket(F.col(date_col), bucket_days))
    cond = (
        (ev[_B] == pts[_B])
        & (ev[date_col] >= F.date_sub(pts[point_col], before))
        & (ev[date_col] <= F.date_add(pts[point_col], after))
    )
    return ev.join(pts, cond, "inner").drop(ev[_B]).drop(pts[_B])


def _clipped(start_col: str, end_col: str, clip: tuple[dt.date, dt.date] | None) -> tuple[Column, Column]:
    s, e = F.col(start_col), F.col(end_col)
    if clip is None:
        return s, e
    # ``greatest`` and ``least`` skip NULLs, but a NULL bound must stay one.
    return F.when(s.isNotNull(), F.greatest(s, F.lit(clip[0]))), F.when(e.isNotNull(), F.least(e, F.lit(clip[1])))


def dyadic_cover(first: Column, last: Column, levels: int) -> Column:
    """Array of (level, node): the fewest aligned blocks ``[node * 2^level, (node + 1) * 2^level)`` whose union is ``first..last``.

    At each level the cover has at most the block that starts the rest and the one that ends it, so a range has at most two blocks a level.
    ``levels`` must reach the largest block: 2^(levels - 1) is at most the length of the longest range.
    """
    parts = []
    for k in range(levels):
        lo = -F.shiftright(-first, k)  # ceil(first / 2^k)
        hi = F.shiftright(last + 1, k)  # blocks from here on end after the range
        for node, odd in ((lo, lo), (hi - 1, hi)):
            wanted = (lo < hi) & (odd.bitwiseAND(F.lit(1)) == 1)
            parts.append(F.when(wanted, F.struct(F.lit(k).alias("level"), node.cast("int").alias("node"))))
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def inner_minimum(
    intervals: DataFrame,
    start_col: str,
    end_col: str,
    points: DataFrame,
    point_col: str,
    keys: list[str],
    value: Column,
    clip: tuple[dt.date, dt.date],
    from_buckets: int,
    bucket_days: int = 7,
) -> DataFrame:
    """Per ``keys`` and point, the smallest ``value`` (as ``value``) among long intervals that hold the point in a bucket between
    their first and last one: the rest of an ``interval_join`` with ``ends_from=from_buckets``.

    Those buckets lie wholly inside the interval, so no date is tested. Each interval is cut into the dyadic blocks of its
    buckets, two a level at most, and the minimum is taken per block (partial before the exchange, so a hot key sends one row per block
    and task). Only these minima are expanded to points: rows before the aggregate grow with intervals × log(points),
    and a key has at most points × log(points) after it.
    """
    s, e = _clipped(start_col, end_col, clip)
    first, last = _bucket(s, bucket_days), _bucket(e, bucket_days)
    span = (clip[1] - clip[0]).days // bucket_days + 2
    long = intervals.where((s <= e) & (last - first + 1 >= max(from_buckets, 2)))
    cover = F.explode(dyadic_cover(first + 1, last - 1, span.bit_length()))
    blocks = long.select(*keys, value.alias("value"), cover.alias("b")).groupBy(*keys, "b.level", "b.node").agg(F.min("value").alias("value"))
    size = F.expr("shiftleft(1, level)")
    buckets = blocks.select(*keys, "value", F.explode(F.sequence(F.col("node") * size, (F.col("node") + 1) * size - 1)).alias(_B))
    return buckets.join(points.withColumn(_B, _bucket(F.col(point_col), bucket_days)), _B).drop(_B)


def interval_join(
    intervals: DataFrame,
    start_col: str,
    end_col: str,
    points: DataFrame,
    point_col: str,
    bucket_days: int = 7,
    broadcast_points: bool = False,
    clip: tuple[dt.date, dt.date] | None = None,
    ends_from: int | None = None,
) -> DataFrame:
    """Rows of ``intervals`` paired with every point p where
    ``start <= p <= end``. A NULL bound never matches (B4).

    With ``ends_from``, an interval of at least that many buckets meets only the points of its first and last bucket;
    ``inner_minimum`` has the buckets between.

    Each interval is exploded to the buckets it covers (about one per matched
    weekly point); ``clip`` limits that to the range of requested points when
    only a few weeks are built from long intervals.
    """
    s, e = _clipped(start_col, end_col, clip)
    first, last = _bucket(s, bucket_days), _bucket(e, bucket_days)
    buckets = F.sequence(first, last)
    if ends_from is not None:
        buckets = F.when(last - first + 1 >= max(ends_from, 2), F.array(first, last)).otherwise(buckets)
    # An empty (or inverted) interval yields no buckets; ``sequence`` would
    # otherwise count downwards from start to end.
    buckets = F.when(s <= e, buckets)
    iv = intervals.withColumn(_B, F.explode(buckets))
    pts = points.withColumn(_B, _bucket(F.col(point_col), bucket_days))
    if broadcast_points:
        pts = F.broadcast(pts)
    cond = (iv[_B] == pts[_B]) & (pts[point_col] >= iv[start_col]) & (pts[point_col] <= iv[end_col])
    return iv.join(pts, cond, "inner").drop(iv[_B]).drop(pts[_B])


def points_below(points: DataFrame, point_col: str, first: dt.date, days: int) -> Column:
    """A scalar: array of the number of points before each day from ``first`` on, for ``days`` days and the day after.

    The days and the points are bounded by the calendar, so one task adds them up.
    """
    spark = points.sparkSession
    at = spark.range(days + 1).select(F.col("id").cast("int").alias("__i"), F.lit(0).alias("__n"))
    held = points.where(F.col(point_col).isNotNull()).select((F.datediff(F.col(point_col), F.lit(first)) + 1).alias("__i"), F.lit(1).alias("__n"))
    counts = at.unionByName(held).groupBy("__i").agg(F.sum("__n").cast("int").alias("__n"))
    below = counts.select("__i", F.sum("__n").over(Window.orderBy("__i")).cast("int").alias("__n"))
    found = below.agg(F.sort_array(F.collect_list(F.struct("__i", "__n"))).alias("__a"))
    return found.select(F.col("__a")["__n"].alias("__below")).scalar()


def point_ranges(start_col: str, end_col: str, below: Column, first: dt.date, days: int) -> tuple[Column, Column]:
    """(low, high): the interval holds the points at the places ``low`` to ``high`` - 1 in their order; none if low >= high.

    ``below`` of ``points_below`` covers the ``days`` from ``first`` to the last point. A NULL bound gives NULL, which matches nothing.
    """
    day = lambda c: F.datediff(F.col(c), F.lit(first))
    inside = lambda x: F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0)), F.lit(days)))
    after_midnight = (F.col(start_col) > F.to_date(start_col)).cast("int")
    return F.get(below, inside(day(start_col) + after_midnight)), F.get(below, inside(day(end_col) + 1))


def point_segments(points: DataFrame, point_col: str, cols: list[str], days: int) -> DataFrame:
    """One row per ``days``-wide segment of time that holds a point: (``SEGMENT``, ``POINTS``, ``BELOW``), the array of its points as
    structs of ``point_col`` and ``cols``, ascending, and for each of its days and the day after the number of points before it."""
    held = points.where(F.col(point_col).isNotNull())
    found = held.groupBy(_bucket(F.col(point_col), days).alias(SEGMENT)).agg(F.sort_array(F.collect_list(F.struct(point_col, *cols))).alias(POINTS))
    offset = lambda p: F.datediff(p[point_col], F.lit(_EPOCH)) - F.col(SEGMENT) * days
    below = F.transform(F.sequence(F.lit(0), F.lit(days)), lambda i: F.size(F.filter(POINTS, lambda p: offset(p) < i)))
    return found.withColumn(BELOW, below)


def segment_join(
    intervals: DataFrame, start_col: str, end_col: str, segments: DataFrame, point_col: str, clip: tuple[dt.date, dt.date], days: int
) -> DataFrame:
    """``intervals`` per segment of ``point_segments`` in which they hold points: those at the places ``LO`` to ``HI`` - 1 of its array.

    The same pairs as ``interval_join``, kept as ranges: an interval gives a row per segment, not per point. A NULL bound never matches.
    A segment of n points has at most n * (n + 1) / 2 ranges, so a reduction per key, segment and range is bounded by the
    calendar, however many intervals a key has.
    """
    s, e = _clipped(start_col, end_col, clip)
    first, last = _bucket(s, days), _bucket(e, days)
    iv = intervals.withColumn(SEGMENT, F.explode(F.when(s <= e, F.sequence(first, last)))).join(segments, SEGMENT)
    day = lambda c: F.datediff(F.col(c), F.lit(_EPOCH)) - F.col(SEGMENT) * days
    # Bounds beyond the segment hold none or all of its points; the clip leaves no point out.
    after_midnight = (F.col(start_col) > F.to_date(start_col)).cast("int")
    before = F.get(BELOW, F.greatest(day(start_col) + after_midnight, F.lit(0)))
    until = F.get(BELOW, F.least(day(end_col) + 1, F.lit(days)))
    lo = F.when(F.col(SEGMENT) > first, 0).otherwise(before)
    hi = F.when(F.col(SEGMENT) < last, F.size(POINTS)).otherwise(until)
    return iv.select(*intervals.columns, SEGMENT, F.struct(lo.alias("lo"), hi.alias("hi")).alias("r")).select(
        *intervals.columns, SEGMENT, F.col("r.lo").alias(LO), F.col("r.hi").alias(HI)
    ).where(F.col(LO) < F.col(HI))
