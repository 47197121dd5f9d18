"""How many intervals cover each place: a sweep line in bins, so that no task walks a whole contig."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Places of a bin: a task sorts the places of one bin at most, and a contig's bins.
BIN = 16_384


def depth_segments(intervals: DataFrame, keys: list[str], start: str = "start", end: str = "end", width: int = BIN) -> DataFrame:
    """``keys, start, end, depth``: the longest stretches that equally many half-open intervals cover, where any does. (step 11)

    Beginnings (+1) and ends (-1) are summed up by place before any shuffle, so a place where very many intervals begin is one
    row, and a bin never has more rows than places. Depth at a bin's beginning is the sum over the bins before it;
    inside the bin a running sum goes on from there. Empty intervals and null bounds cover nothing.
    """
    real = intervals.where(F.col(end) > F.col(start))
    ends = F.array(F.struct(F.col(start).cast("long").alias("_pos"), F.lit(1).cast("long").alias("_d")), F.struct(F.col(end).cast("long").alias("_pos"), F.lit(-1).cast("long").alias("_d")))
    steps = real.select(*keys, F.explode(ends).alias("_x")).select(*keys, "_x.*").groupBy(*keys, "_pos").agg(F.sum("_d").alias("_d")).where("_d <> 0")
    steps = steps.withColumn("_bin", F.floor(F.col("_pos") / width).cast("long"))
    bins = steps.groupBy(*keys, "_bin").agg(F.sum("_d").alias("_sum"), F.min("_pos").alias("_first"))
    along = Window.partitionBy(*keys).orderBy("_bin")
    names = [f"_k{i}" for i in range(len(keys))]
    bins = bins.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_bin").alias("_b"), (F.sum("_sum").over(along) - F.col("_sum")).alias("_before"), F.lead("_first").over(along).alias("_beyond"))
    on = F.col("_bin") == F.col("_b")
    for k, n in zip(keys, names):
        on = on & F.col(k).eqNullSafe(F.col(n))
    rows = steps.join(bins, on).drop("_b", *names)
    inside = Window.partitionBy(*keys, "_bin").orderBy("_pos")
    depth = F.col("_before") + F.sum("_d").over(inside)
    rows = rows.select(*keys, F.col("_pos").alias("start"), F.coalesce(F.lead("_pos").over(inside), "_beyond").alias("end"), depth.alias("depth"))
    return rows.where("depth > 0")


def depth_over(segments: DataFrame, regions: DataFrame, keys: list[str], thresholds: list[int], width: int = BIN) -> DataFrame:
    """``regions`` (keys, start, end and more) with ``bases`` (length), ``covered``, ``depth_sum``, ``mean_depth`` and for each threshold t ``share_t``, the share of places of at least that depth. (A4, A12, step 4, step 11)

    Regions and segments meet by key and bin; a segment counts in the bin where the shared part begins. Regions without a key
    or length, or where nothing lies, have depth 0. Equal regions are reckoned once and stay apart.
    """
    named = [c for c in regions.columns]
    one = regions.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("start").cast("long").alias("_rs"), F.col("end").cast("long").alias("_re")).distinct()
    ids = [f"_k{i}" for i in range(len(keys))] + ["_rs", "_re"]
    spread = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width).cast("long"), F.floor((F.col(b) - 1) / width).cast("long")))
    wide = one.where("_re > _rs").withColumn("_bin", spread("_rs", "_re"))
    side = segments.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.col("start").alias("_ss"), F.col("end").alias("_se"), "depth").withColumn("_b", spread("_ss", "_se"))
    on = F.col("_bin") == F.col("_b")
    for i in range(len(keys)):
        on = on & (F.col(f"_k{i}") == F.col(f"_s{i}"))
    lo, hi = F.greatest("_rs", "_ss"), F.least("_re", "_se")
    parts = wide.join(side, on).where(lo < hi).where(F.floor(lo / width).cast("long") == F.col("_bin")).select(*ids, (hi - lo).alias("_n"), "depth")
    at_least = [F.sum(F.when(F.col("depth") >= t, F.col("_n")).otherwise(0)).alias(f"_t{t}") for t in thresholds]
    sums = parts.groupBy(*ids).agg(F.sum("_n").alias("_covered"), F.sum(F.col("_n") * F.col("depth")).alias("_sum"), *at_least)
    on = (F.col("start").cast("long") == F.col("_rs")) & (F.col("end").cast("long") == F.col("_re"))
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_k{i}"))
    out = regions.join(sums, on, "left")
    bases = F.greatest(F.coalesce((F.col("end") - F.col("start")).cast("long"), F.lit(0)), F.lit(0).cast("long"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    share = lambda c: F.when(bases > 0, zero(c) / bases).otherwise(F.lit(0.0))
    return out.select(*named, bases.alias("bases"), zero("_covered").alias("covered"), zero("_sum").alias("depth_sum"), share("_sum").alias("mean_depth"), *[share(f"_t{t}").alias(f"share_{t}") for t in thresholds])
