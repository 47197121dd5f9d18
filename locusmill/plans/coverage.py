"""Depth of coverage from alignments: by stretch, by region and by contig."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.operators import intervals as iv
from locusmill.operators.sweep import BIN, depth_over, depth_segments

#: Depths whose share of places is told (fixed values), and the mapping quality that a read needs.
THRESHOLDS, LEAST_MAPQ = (1, 10, 20, 30, 100), 20
#: Unmapped, secondary, failed and duplicate reads do not count.
NO_COVERAGE = 0x704


def cigar_blocks(cigar: Column, start: Column) -> Column:
    """``start, end`` (0-based, half-open) of the stretches that a read lies on base by base; ``start`` is 1-based.

    Deletions and skips part blocks, insertions do not; blocks that touch are one.
    """
    steps = F.regexp_extract_all(cigar, F.lit(r"\d+[MIDNSHP=X]"), F.lit(0))
    block = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    none = F.filter(F.array(block), lambda b: F.lit(False))
    zero = F.struct((start - 1).cast("long").alias("at"), none.alias("blocks"))

    def step(s: Column, op: Column) -> Column:
        n, kind = F.left(op, F.length(op) - 1).cast("long"), F.right(op, F.lit(1))
        on = kind.isin("M", "=", "X")
        end = s["at"] + F.when(on | kind.isin("D", "N"), n).otherwise(0)
        last = F.get(s["blocks"], F.size(s["blocks"]) - 1)
        joined = F.concat(F.slice(s["blocks"], 1, F.greatest(F.size(s["blocks"]) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
        added = F.concat(s["blocks"], F.array(F.struct(s["at"].alias("start"), end.alias("end"))))
        blocks = F.when(~on | (n == 0), s["blocks"]).when(last["end"] == s["at"], joined).otherwise(added)
        return F.struct(end.alias("at"), blocks.alias("blocks"))

    return F.aggregate(steps, zero, step, lambda s: s["blocks"])


def covering_blocks(reads: DataFrame, least_mapq: int = LEAST_MAPQ, once: bool = True) -> DataFrame:
    """``chrom, start, end`` of what reads cover. Where both reads of a fragment (``qname``) overlap, they count ``once``. (step 11)"""
    good = reads.where((F.col("flag").bitwiseAND(F.lit(NO_COVERAGE)) == 0) & (F.col("mapq") >= least_mapq))
    blocks = good.select("qname", "chrom", F.inline(cigar_blocks(F.col("cigar"), F.col("start"))))
    return iv.merge(blocks, ["chrom", "qname"]).drop("qname") if once else blocks.drop("qname")


def coverage(reads: DataFrame, regions: DataFrame, thresholds=THRESHOLDS, least_mapq: int = LEAST_MAPQ) -> DataFrame:
    """``regions`` (chrom, start, end and more) with bases, covered, depth_sum, mean_depth and share_t. (step 11)"""
    return depth_over(depth_segments(covering_blocks(reads, least_mapq), ["chrom"]), regions, ["chrom"], list(thresholds))


def bed_coverage(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """``regions`` with ``depth_sum``: the depths of a region's places added up, every read counted. (step 4)"""
    skip = F.col("flag").bitwiseAND(F.lit(NO_COVERAGE)) == 0
    sums = depth_over(depth_segments(covering_blocks(reads.where(skip), 0, once=False), ["chrom"]), regions, ["chrom"], [])
    return sums.select(*regions.columns, "depth_sum")


def coverage_summary(segments: DataFrame, contigs: DataFrame, regions: DataFrame | None = None, width: int = BIN) -> DataFrame:
    """``chrom, length, bases, mean, min, max`` of each contig (chrom, length), of its regions as ``<chrom>_region``, and of all as total and total_region. (S17, F17, step 11)

    ``bases`` is the sum of depths; ``min`` is 0 unless every place is covered.
    """

    def told(where: DataFrame, suffix: str) -> DataFrame:
        inside = iv.merge(where, ["chrom"])
        spread = lambda d, a, b: d.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(a) / width).cast("long"), F.floor((F.col(b) - 1) / width).cast("long"))))
        x, y = spread(segments, "start", "end").alias("x"), spread(inside, "start", "end").alias("y")
        lo, hi = F.greatest("x.start", "y.start"), F.least("x.end", "y.end")
        parts = x.join(y, (F.col("x.chrom") == F.col("y.chrom")) & (F.col("x._bin") == F.col("y._bin"))).where((lo < hi) & (F.floor(lo / width).cast("long") == F.col("x._bin")))
        parts = parts.select(F.col("x.chrom").alias("_c"), (hi - lo).alias("n"), "depth")
        sums = parts.groupBy("_c").agg(F.sum("n").alias("covered"), F.sum(F.col("n") * F.col("depth")).alias("bases"), F.min("depth").alias("least"), F.max("depth").alias("most"))
        size = inside.groupBy("chrom").agg(F.sum(F.col("end") - F.col("start")).alias("length"))
        rows = size.join(sums, F.col("chrom") == F.col("_c"), "left").na.fill(0, ["covered", "bases", "least", "most"])
        rows = rows.select("chrom", "length", "covered", "bases", "least", "most")
        total = rows.agg(F.lit("total").alias("chrom"), F.sum("length").alias("length"), F.sum("covered").alias("covered"), F.sum("bases").alias("bases"), F.min(F.when(F.col("covered") == F.col("length"), F.col("least")).otherwise(0)).alias("least"), F.max("most").alias("most")).where("length is not null")
        both = rows.unionByName(total)
        return both.select(F.concat("chrom", F.lit(suffix)).alias("chrom"), "length", "bases", F.round(F.col("bases") / F.col("length"), 2).alias("mean"), F.when(F.col("covered") == F.col("length"), F.col("least")).otherwise(0).alias("min"), F.col("most").alias("max"))

    out = told(contigs.select("chrom", F.lit(0).cast("long").alias("start"), F.col("length").alias("end")), "")
    return out if regions is None else out.unionByName(told(regions.select("chrom", "start", "end"), "_region"))
