"""Duplicate fragments: read pairs whose ends lie at the same places, and single reads that begin where others do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Qualities below this do not count for the choice of the best (fixed value).
LEAST_QUALITY = 15


def _bit(b: int) -> Column:
    return F.col("flag").bitwiseAND(F.lit(b)) != 0


def covered_length(cigar: Column, kinds: str) -> Column:
    """Bases of a CIGAR's steps of the given kinds."""
    steps = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{kinds}]"), F.lit(1))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def five_prime(cigar: Column, start: Column, reverse: Column) -> Column:
    """Where a read's first base would lie if none had been clipped: before its start, or after its end where it is reversed."""
    clipped = lambda pattern: covered_length(F.regexp_extract(cigar, pattern, 1), "SH")
    ends = start + covered_length(cigar, "MDN=X") - 1 + clipped(r"((?:\d+[SH])+)$")
    return F.when(reverse, ends).otherwise(start - clipped(r"^((?:\d+[SH])+)"))


def quality_sum(quality: Column) -> Column:
    """Sum of the base qualities of at least 15; a read without qualities ("*") has none."""
    found = F.split(F.when(quality != "*", quality).otherwise(""), "")
    worth = lambda c: F.when(F.ascii(c) - 33 >= LEAST_QUALITY, F.ascii(c) - 33).otherwise(0)
    return F.aggregate(found, F.lit(0).cast("long"), lambda a, c: a + worth(c))


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """``reads`` (at, qname, flag, chrom, start, cigar, quality, library) with ``duplicate``; none is removed. (step 5)

    Two mates that are both mapped are a pair, known by library and by place and strand of both unclipped 5' ends. Of equal pairs that of the
    highest quality sum stays, the first (least ``at``) among equals. Other mapped reads are known by their own end: they are
    duplicates wherever the end of a pair lies, else all but the best. Unmapped, secondary and supplementary alignments are
    never duplicates. ``at`` tells rows apart; of rows that repeat a name and mate, the first is the mate and the others stand alone.

    Groups are decided by partial maxima, so that a place with very many reads is one row of each task; rows then meet the
    chosen by ``at``, which no two share. Null libraries are one library; empty tables give no rows.
    """
    rows = reads.select("at", "qname", "flag", "chrom", "start", "cigar", "quality", F.coalesce("library", F.lit("")).alias("library")).where(~_bit(0x904))
    ends = rows.select("at", "qname", "library", "flag", "chrom", five_prime(F.col("cigar"), F.col("start"), _bit(0x10)).alias("five"), _bit(0x10).alias("back"), quality_sum(F.col("quality")).alias("score"))
    mate = F.struct("chrom", "five", "back", "at", "score")
    of = lambda b: F.min_by(F.when(_bit(b), mate), F.when(_bit(b), F.col("at")))
    named = ends.where(_bit(0x1) & ~_bit(0x8) & F.col("qname").isNotNull()).groupBy("library", "qname").agg(of(0x40).alias("a"), of(0x80).alias("b")).where("a is not null and b is not null and a.at <> b.at")
    place = lambda x: F.struct(x["chrom"], x["five"], x["back"])
    a, b = place(F.col("a")), place(F.col("b"))
    pairs = named.select("library", F.when(a <= b, a).otherwise(b).alias("low"), F.when(a <= b, b).otherwise(a).alias("high"), F.least("a.at", "b.at").alias("id"), F.greatest("a.at", "b.at").alias("other"), (F.col("a.score") + F.col("b.score")).alias("score"))
    first = F.max_by(F.col("id"), F.struct(F.col("score"), -F.col("id")))
    chosen = pairs.groupBy("library", "low", "high").agg(first.alias("id")).select("id")
    lost = pairs.join(chosen, "id", "left_anti").select(F.explode(F.array("id", "other")).alias("_at"))
    mates = pairs.select(F.explode(F.array("id", "other")).alias("_mate"))
    single = ends.join(mates, F.col("at") == F.col("_mate"), "left").withColumn("paired", F.col("_mate").isNotNull())
    best = F.max_by(F.col("at"), F.when(~F.col("paired"), F.struct(F.col("score"), -F.col("at"))))
    kept = single.groupBy("library", "chrom", "five", "back").agg(F.max("paired").alias("beside"), best.alias("at")).where("not beside").select("at")
    alone = single.where("not paired").join(kept, "at", "left_anti").select(F.col("at").alias("_at"))
    gone = lost.unionByName(alone).withColumn("_gone", F.lit(True))
    return reads.join(gone, F.col("at") == F.col("_at"), "left").withColumn("duplicate", F.coalesce("_gone", F.lit(False))).drop("_at", "_gone")


def library_size(pairs: Column, unique: Column) -> Column:
    """How many different fragments a library holds, if ``unique`` of ``pairs`` drawn at random were different: c / x = 1 - exp(-n / x).

    Null where no pair repeats. Found by halving an interval forty times.
    """
    over = lambda x: unique / x - 1 + F.exp(-pairs / x)  # noqa: E731  positive where x is too small
    tens = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(100.0), lambda m, _: F.when(over(m * unique) > 0, m * 10).otherwise(m))
    start = F.struct(F.lit(1.0).alias("low"), tens.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = (s["low"] + s["high"]) / 2
        up = over(middle * unique) > 0
        return F.struct(F.when(up, middle).otherwise(s["low"]).alias("low"), F.when(up, s["high"]).otherwise(middle).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, halve, lambda s: (s["low"] + s["high"]) / 2)
    return F.when((unique > 0) & (unique < pairs), F.floor(unique * found).cast("long"))


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    """A row for each library: reads and pairs looked at, duplicates among them, their share, and the library's estimated size. (step 5)"""
    mapped = ~_bit(0x904)
    pair = mapped & _bit(0x1) & ~_bit(0x8)
    n = lambda c: F.count_if(c).cast("long")
    sums = marked.groupBy(F.coalesce("library", F.lit("")).alias("library")).agg(n(mapped & ~pair).alias("unpaired_reads_examined"), F.floor(n(pair) / 2).alias("read_pairs_examined"), n(_bit(0x900)).alias("secondary_or_supplementary_reads"), n(_bit(0x4) & ~_bit(0x900)).alias("unmapped_reads"), n(mapped & ~pair & F.col("duplicate")).alias("unpaired_read_duplicates"), F.floor(n(pair & F.col("duplicate")) / 2).alias("read_pair_duplicates"))
    seen = F.col("unpaired_reads_examined") + 2 * F.col("read_pairs_examined")
    share = (F.col("unpaired_read_duplicates") + 2 * F.col("read_pair_duplicates")) / seen
    size = library_size(F.col("read_pairs_examined").cast("double"), (F.col("read_pairs_examined") - F.col("read_pair_duplicates")).cast("double"))
    return sums.withColumns({"percent_duplication": F.when(seen > 0, F.round(share, 6)).otherwise(0.0), "estimated_library_size": size})
