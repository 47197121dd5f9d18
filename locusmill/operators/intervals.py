"""Interval operators by bins: no nested-loop joins, no sort of all points in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.operators.ranges import carried


def merge(intervals: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Half-open intervals per key, united where they overlap or touch. Empty ones go."""
    rows = intervals.where(F.col(end) > F.col(start)).select(*keys, start, end).distinct()
    by = Window.partitionBy(*keys).orderBy(start, end)
    rows = rows.withColumn("_reach", F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("_island", F.sum(F.when(F.col("_reach") >= F.col(start), 0).otherwise(1)).over(by))
    return rows.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def covered(merged: DataFrame, start: str = "start", end: str = "end") -> Column:
    """Aggregate: covered length of merged intervals. (A4)"""
    return F.coalesce(F.sum(F.col(end) - F.col(start)), F.lit(0))


def _bin(value: Column, width: float) -> Column:
    return F.floor(value / width).cast("long")


def _binned(intervals: DataFrame, start: str, end: str, width: float) -> DataFrame:
    last = F.greatest(_bin(F.col(start), width), F.ceil(F.col(end) / width).cast("long") - 1)
    return intervals.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), width), last)))


def contained(points: DataFrame, intervals: DataFrame, at: Column, keys: dict[str, str], width: float, start: str = "start", end: str = "end", how: str = "left_semi") -> DataFrame:
    """Points that lie in some half-open interval of the same key (or in none: ``left_anti``).

    Both sides meet by key and bin; ``keys`` maps the points' columns to the intervals', and may be empty. Bins of about an
    interval's length keep the copies of intervals few.
    """
    cols = list(keys.values())
    side = _binned(intervals.select(*cols, F.col(start).alias("_s"), F.col(end).alias("_e")).where("_e > _s").distinct(), "_s", "_e", width)
    side = side.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], "_s", "_e", F.col("_bin").alias("_b"))
    rows = points.withColumn("_at", at).withColumn("_bin", _bin(at, width))
    same = (F.col("_bin") == F.col("_b")) & (F.col("_at") >= F.col("_s")) & (F.col("_at") < F.col("_e"))
    for i, c in enumerate(keys):
        same = same & (F.col(c) == F.col(f"_k{i}"))
    return rows.join(side, same, how).drop("_at", "_bin")


def nearest(points: DataFrame, merged: DataFrame, lo: Column, hi: Column, keys: dict[str, str], width: float, start: str = "start", end: str = "end") -> DataFrame:
    """``points`` with inside (boolean) and distance to the nearest edge of a merged interval.

    A point is [lo, hi), or the place lo where they are equal; inside (distance 0) if it overlaps an interval, else the distance between edges, so that touching
    is 0 too; null where the key has no interval. Each bin that has points gets its own intervals and the nearest on
    either side, by an as-of join of bins and intervals in sorted ranges that hand their last and first interval on; points
    are never sorted.
    """
    cols = list(keys.values())
    names = [f"_k{i}" for i in range(len(cols))]
    side = merged.select(*[F.col(c).alias(n) for c, n in zip(cols, names)], F.col(start).cast("double").alias("_s"), F.col(end).cast("double").alias("_e"))
    rows = points.withColumn("_lo", lo.cast("double")).withColumn("_hi", hi.cast("double")).withColumn("_bin", _bin(F.col("_lo"), width))
    for c, n in zip(keys, names):
        rows = rows.withColumn(n, F.col(c))
    inside = _binned(side, "_s", "_e", width).groupBy(*names, "_bin").agg(F.collect_list(F.struct("_s", "_e")).alias("_in"))
    bins = rows.select(*names, "_bin").distinct()
    # Each bin asks twice: for the last interval that begins before it, and for the first that begins beyond it; its own are in _in.
    asked = F.explode(F.array(F.struct(F.lit(0).alias("_ask"), (F.col("_bin") * F.lit(width)).cast("double").alias("_at")), F.struct(F.lit(1).alias("_ask"), ((F.col("_bin") + 1) * F.lit(width)).cast("double").alias("_at"))))
    marks = bins.select(*names, "_bin", asked.alias("_x")).select(*names, "_bin", "_x.*", F.lit(None).cast("struct<_s:double,_e:double>").alias("_iv"))
    begun = side.select(*names, F.lit(None).cast("long").alias("_bin"), F.lit(2).alias("_ask"), F.col("_s").alias("_at"), F.struct("_s", "_e").alias("_iv"))
    found = carried(marks.unionByName(begun), names, [F.col("_at"), F.col("_ask"), F.col("_bin")], "_iv").where("_bin is not null")
    edges = found.groupBy(*names, "_bin").agg(F.max(F.when(F.col("_ask") == 0, F.col("_last"))).alias("_before"), F.max(F.when(F.col("_ask") == 1, F.col("_next"))).alias("_after"))
    where = edges.join(inside, [*names, "_bin"], "left")
    near = F.filter(F.concat(F.coalesce("_in", F.array().cast("array<struct<_s:double,_e:double>>")), F.array("_before", "_after")), lambda x: x.isNotNull())
    hit = F.exists(near, lambda x: ((x["_s"] < F.col("_hi")) | (x["_s"] == F.col("_lo"))) & (x["_e"] > F.col("_lo")))
    far = F.array_min(F.transform(near, lambda x: F.least(F.abs(F.col("_lo") - x["_e"]), F.abs(x["_s"] - F.col("_hi")))))
    out = rows.join(where, [*names, "_bin"], "left") if names else rows.join(where, "_bin", "left")
    out = out.withColumn("inside", F.coalesce(hit, F.lit(False))).withColumn("distance", F.when(hit, F.lit(0.0)).otherwise(far))
    return out.drop(*names, "_lo", "_hi", "_bin", "_in", "_before", "_after")


def intersect(a: DataFrame, b: DataFrame, keys: list[str], width: float, start: str = "start", end: str = "end") -> DataFrame:
    """Parts that two interval sets share, one row per overlapping pair."""
    x = _binned(a.select(*keys, start, end), start, end, width).alias("x")
    y = _binned(b.select(*keys, start, end), start, end, width).alias("y")
    on = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in keys] + [F.col("x._bin") == F.col("y._bin")]
    lo, hi = F.greatest(f"x.{start}", f"y.{start}"), F.least(f"x.{end}", f"y.{end}")
    both = x.join(y, on).where(lo < hi).where(F.col("x._bin") == _bin(lo, width))
    return both.select(*[F.col(f"x.{k}").alias(k) for k in keys], lo.alias(start), hi.alias(end))


def padded(intervals: DataFrame, by: int = 100, start: str = "start", end: str = "end") -> DataFrame:
    """(J18)"""
    return intervals.withColumn(start, F.greatest(F.lit(0), F.col(start) - by)).withColumn(end, F.col(end) + by)
