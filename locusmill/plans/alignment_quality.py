"""Metrics of alignments by exact histograms, which any number of tasks can add up."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.plans.duplicates import _bit, covered_length

#: Least share of pairs that an orientation needs, how many deviations a size may lie above the median to count for the mean, and the shares whose width is told (fixed values).
MINIMUM_PCT, DEVIATIONS, WIDTHS = 0.05, 10.0, (10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 99)


def pair_orientation(flag: Column, start: Column, cigar: Column, next_start: Column, insert_size: Column) -> Column:
    """FR, RF or TANDEM: how the two reads of a pair face each other."""
    bit = lambda b: flag.bitwiseAND(F.lit(b)) != 0
    plus = F.when(bit(0x10), next_start).otherwise(start)
    minus = F.when(bit(0x10), start + covered_length(cigar, "MDN=X") - 1).otherwise(start + insert_size)
    return F.when(bit(0x10) == bit(0x20), "TANDEM").when(plus < minus, "FR").otherwise("RF")


def insert_sizes(reads: DataFrame) -> DataFrame:
    """``orientation, size, n``: second reads of mapped pairs that are no duplicates, by distance. (step 5b)"""
    seconds = reads.where(_bit(0x1) & (F.col("flag").bitwiseAND(F.lit(0x4 | 0x8 | 0x40 | 0x100 | 0x400 | 0x800)) == 0) & (F.col("insert_size") != 0))
    way = pair_orientation(F.col("flag"), F.col("start"), F.col("cigar"), F.col("next_start"), F.col("insert_size"))
    return seconds.groupBy(way.alias("orientation"), F.abs("insert_size").alias("size")).agg(F.count(F.lit(1)).alias("n"))


def _median(hist: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``keys, name``: the middle of a histogram with counts ``n``, or the mean of both middles."""
    by = Window.partitionBy(*keys)
    rows = hist.withColumn("_upto", F.sum("n").over(by.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("n").over(by))
    at = lambda place: F.min(F.when(F.col("_upto") >= place, F.col(value)))
    return rows.groupBy(*keys).agg(((at(F.floor((F.col("_all") + 1) / 2)) + at(F.floor(F.col("_all") / 2) + 1)) / 2).alias(name))


def insert_size_metrics(hist: DataFrame, minimum_pct: float = MINIMUM_PCT, deviations: float = DEVIATIONS) -> DataFrame:
    """A row for each orientation of ``insert_sizes`` that holds its share of the pairs: median, mode, median absolute deviation, extremes, trimmed mean and standard deviation, and the widths around the median that hold 10 to 99 % of them. (step 5b)

    All from counts: sizes far above the median count for neither mean nor deviation. No pairs, no rows.
    """
    key = ["orientation"]
    whole = hist.groupBy(*key).agg(F.sum("n").alias("read_pairs"), F.min("size").alias("min_insert_size"), F.max("size").alias("max_insert_size"), F.max_by("size", F.struct("n", -F.col("size"))).alias("mode_insert_size"))
    whole = whole.withColumn("_every", F.sum("read_pairs").over(Window.partitionBy(F.lit(0))))  # three orientations
    whole = whole.where(F.col("read_pairs") >= F.col("_every") * minimum_pct).drop("_every")
    median = _median(hist, key, "size", "median_insert_size")
    off = hist.join(F.broadcast(median), key).withColumn("_off", F.abs(F.col("size") - F.col("median_insert_size")))
    spread = _median(off.groupBy(*key, "_off").agg(F.sum("n").alias("n")), key, "_off", "median_absolute_deviation")
    near = off.join(F.broadcast(spread), key).where(F.col("size") <= F.col("median_insert_size") + F.lit(deviations) * F.col("median_absolute_deviation"))
    n, x = F.sum("n"), F.sum(F.col("n") * F.col("size"))
    mean = near.groupBy(*key).agg(n.alias("_n"), (x / n).alias("mean_insert_size"))
    square = F.sum(F.col("n") * F.pow(F.col("size") - F.col("mean_insert_size"), F.lit(2)))
    deviation = near.join(F.broadcast(mean), key).groupBy(*key, "_n").agg(square.alias("_square")).select(*key, F.when(F.col("_n") > 1, F.sqrt(F.col("_square") / (F.col("_n") - 1))).otherwise(0.0).alias("standard_deviation"))
    steps = off.groupBy(*key, F.abs(F.col("size") - F.floor("median_insert_size")).alias("_d")).agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*key)
    steps = steps.withColumn("_share", F.sum("n").over(by.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(by))
    wide = [(F.min(F.when(F.col("_share") >= p / 100, F.col("_d"))) * 2 + 1).alias(f"width_of_{p}_percent") for p in WIDTHS]
    out = whole
    for part in (median, spread, mean.drop("_n"), deviation, steps.groupBy(*key).agg(*wide)):
        out = out.join(F.broadcast(part), key)
    return out


def alignment_summary(reads: DataFrame) -> DataFrame:
    """``category`` (FIRST_OF_PAIR, SECOND_OF_PAIR, PAIR, UNPAIRED) with counts of reads, aligned and well aligned reads and bases, mean length, strand balance and pairs whose mates are aligned. Secondary and supplementary alignments do not count. (step 5b)"""
    rows = reads.where(F.col("flag").bitwiseAND(F.lit(0x900)) == 0)
    own = F.when(~_bit(0x1), "UNPAIRED").when(_bit(0x40), "FIRST_OF_PAIR").otherwise("SECOND_OF_PAIR")
    rows = rows.withColumn("category", F.explode(F.when(_bit(0x1), F.array(own, F.lit("PAIR"))).otherwise(F.array(own))))
    good, aligned = ~_bit(0x200), ~_bit(0x200) & ~_bit(0x4)
    n, length = F.count_if, F.when(F.col("seq") == "*", 0).otherwise(F.length("seq"))
    sums = rows.groupBy("category").agg(F.count(F.lit(1)).alias("total_reads"), n(good).alias("pf_reads"), n(aligned).alias("pf_reads_aligned"), n(aligned & (F.col("mapq") >= 20)).alias("pf_hq_aligned_reads"), F.coalesce(F.sum(F.when(aligned, covered_length(F.col("cigar"), "M=X"))), F.lit(0)).alias("pf_aligned_bases"), F.round(F.avg(length), 6).alias("mean_read_length"), n(aligned & _bit(0x1) & ~_bit(0x8)).alias("reads_aligned_in_pairs"), n(aligned & ~_bit(0x10)).alias("_forward"), n(aligned & _bit(0x1) & ~_bit(0x8) & ~_bit(0x2)).alias("_improper"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 6)).otherwise(0.0)
    return sums.withColumns({"pct_pf_reads_aligned": ratio("pf_reads_aligned", "pf_reads"), "strand_balance": ratio("_forward", "pf_reads_aligned"), "pct_pf_reads_improper_pairs": ratio("_improper", "pf_reads_aligned")}).drop("_forward", "_improper")


def by_cycle(reads: DataFrame) -> DataFrame:
    """``read, cycle, mean_quality`` and the share of each base, in the order in which the bases were read: reversed reads from their end. (step 5b)"""
    rows = reads.where((F.col("flag").bitwiseAND(F.lit(0x904)) == 0) & (F.col("seq") != "*") & (F.length("seq") == F.length("quality")))
    turned = F.when(_bit(0x10), F.struct(F.reverse(F.translate(F.upper("seq"), "ACGT", "TGCA")).alias("s"), F.reverse("quality").alias("q"))).otherwise(F.struct(F.upper("seq").alias("s"), F.col("quality").alias("q")))
    bases = rows.select(F.when(_bit(0x80), 2).otherwise(1).alias("read"), turned.alias("t")).select("read", F.posexplode(F.arrays_zip(F.split("t.s", "").alias("base"), F.split("t.q", "").alias("mark"))).alias("cycle", "x"))
    counts = bases.groupBy("read", (F.col("cycle") + 1).alias("cycle")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.ascii("x.mark") - 33).alias("q"), *[F.count_if(F.col("x.base") == b).alias(f"n_{b}") for b in "ACGT"])
    share = lambda b: F.round(F.col(f"n_{b}") / F.col("n"), 6).alias(f"pct_{b.lower()}")
    return counts.select("read", "cycle", F.round(F.col("q") / F.col("n"), 6).alias("mean_quality"), *[share(b) for b in "ACGT"])


def quality_distribution(reads: DataFrame) -> DataFrame:
    """``quality, n``: bases by quality. (step 5b)"""
    rows = reads.where((F.col("flag").bitwiseAND(F.lit(0x904)) == 0) & (F.col("quality") != "*"))
    marks = rows.select(F.explode(F.split("quality", "")).alias("mark")).where("mark <> ''")
    return marks.groupBy((F.ascii("mark") - 33).alias("quality")).agg(F.count(F.lit(1)).alias("n"))


#: Bases of a window whose content of G and C is told, unknown bases that it may have (fixed values).
GC_WINDOW, MOST_UNKNOWN = 100, 4


def gc_windows(chunks: DataFrame, window: int = GC_WINDOW, unknown: int = MOST_UNKNOWN) -> DataFrame:
    """``chrom, chunk, gc``: for each place of a genome chunk the percentage of G and C in the window that begins there, -1 where the contig ends before or too many bases are unknown. (step 5b)

    A chunk looks into those that follow it for its last windows; chunks are the unit of work.
    """
    after = Window.partitionBy("chrom").orderBy("chunk")
    rows = chunks.select("chrom", "chunk", "bases", F.lead(F.left("bases", F.lit(window - 1))).over(after).alias("more"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strong, known = (np.isin(np.arange(256), [ord(c) for c in letters]).astype(np.int64) for letters in ("GCgc", "ACGTacgt"))
        for batch in batches:
            out = []
            for bases, more in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                n = len(bases)
                x = np.frombuffer((bases + (more or "")).encode(), dtype=np.uint8)
                gc = np.full(n, -1, dtype=np.int32)
                m = min(n, len(x) - window + 1)
                if m > 0:
                    sums = [np.concatenate(([0], np.cumsum(table[x]))) for table in (strong, known)]
                    s, k = (c[window : window + m] - c[:m] for c in sums)
                    # Halves go up.
                    gc[:m] = np.where(window - k > unknown, -1, (200 * s + k) // np.maximum(2 * k, 1))
                out.append(gc.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["chrom", "chunk", "gc"])

    return rows.mapInArrow(told, "chrom string, chunk long, gc array<int>")


def gc_bias(reads: DataFrame, chunks: DataFrame, window: int = GC_WINDOW, chunk: int = 10_000) -> DataFrame:
    """``gc, windows, read_starts, normalized_coverage, error_bar_width``: how reads are spread over windows by their content of G and C. (step 5b)

    A read counts in the window that begins where it does, or, if it is reversed, ends where it does. Starts are counted by place
    before they meet the genome's chunks, one row each.
    """
    plain = lambda c: F.regexp_replace(c, "^chr", "")
    cut = gc_windows(chunks, window).select(plain(F.col("chrom")).alias("contig"), "chunk", "gc")
    end = F.col("start") - 1 + covered_length(F.col("cigar"), "MDN=X")
    place = F.when(_bit(0x10), end - window).otherwise(F.col("start") - 1)
    good = reads.where(F.col("flag").bitwiseAND(F.lit(0xB04)) == 0).select(plain(F.col("chrom")).alias("contig"), place.alias("place")).where("place >= 0")
    starts = good.groupBy("contig", "place").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.groupBy("contig", F.floor(F.col("place") / chunk).cast("long").alias("chunk")).agg(F.collect_list(F.struct(F.pmod("place", F.lit(chunk)).cast("int").alias("i"), "n")).alias("starts"))
    both = cut.join(starts, ["contig", "chunk"], "left")
    windows = both.select(F.explode("gc").alias("gc"), F.lit(1).cast("long").alias("w"), F.lit(0).cast("long").alias("n"))
    hits = both.select(F.explode(F.transform("starts", lambda x: F.struct(F.coalesce(F.get("gc", x["i"]), F.lit(-1)).alias("gc"), F.lit(0).cast("long").alias("w"), x["n"].alias("n")))).alias("x")).select("x.*")
    sums = windows.unionByName(hits).where("gc >= 0").groupBy("gc").agg(F.sum("w").alias("windows"), F.sum("n").alias("read_starts"))
    every = sums.agg((F.sum("read_starts") / F.sum("windows")).alias("mean"))  # a row of at most 101
    rows = sums.crossJoin(F.broadcast(every))
    share = lambda x: F.when(F.col("mean") > 0, x / F.col("windows") / F.col("mean")).otherwise(0.0)
    return rows.select("gc", "windows", "read_starts", share(F.col("read_starts")).alias("normalized_coverage"), share(F.sqrt("read_starts")).alias("error_bar_width"))
