"""Plans over coverage, microsatellites and HLA calls, and the counts of a summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields as fd
from locusmill.operators import intervals as iv
from locusmill.operators import relational as rel
from locusmill.plans.duplicates import covered_length
from locusmill.sources.readers import column_of

#: Names of metrics in result files of microsatellite tools (fixed values).
MSI_KEYS = {
    "total_sites": ("total_number_of_sites", "total_sites", "totalsites", "total"),
    "unstable_sites": ("number_of_somatic_sites", "number_of_unstable_sites", "somatic_sites", "unstable_sites", "unstable", "somatic"),
    "msi_score": ("msi", "msi_score", "msi_score_percent", "score", "percentage", "percent", "msi_percent"),
}


def read_metrics(reads: DataFrame) -> DataFrame:
    """Counts by flag bits, of all alignments of a SAM. (step 4)"""
    bit = lambda b: F.col("flag").bitwiseAND(F.lit(b)) != 0
    return reads.agg(F.count(F.lit(1)).alias("total"), F.count_if(bit(0x400)).alias("duplicates"), F.count_if(bit(0x1)).alias("paired"), F.count_if(bit(0x2)).alias("proper_pairs"))


def depth_qc(bins: DataFrame) -> DataFrame:
    """Coverage bins (chromosome, start, end, region, depth) against their weighted mean."""
    rows = bins.withColumn("length", F.col("end") - F.col("start"))
    return rel.depth_ratio(rows, "depth", "length").drop("length")


def copy_number_counts(segments: DataFrame) -> DataFrame:
    """(A13)"""
    cn = F.col(column_of(segments, ["cn"])).try_cast("double")
    return segments.agg(F.count(F.lit(1)).alias("total"), F.count_if(cn < 2).alias("loss"), F.count_if(cn == 2).alias("neutral"), F.count_if(cn > 2).alias("gain"))


def _key(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def _metric(key: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, keys in MSI_KEYS.items():
        out = F.when(key.isin(*keys), name).otherwise(out)
    return out


def msi_call(lines: DataFrame, sample: str, low: float = 3.0, high: float = 20.0) -> DataFrame:
    """One row from result lines (file, line, value): in each file headers with values below them, then ``key: value``; the
    first of a metric counts. (S13, W11, W12, A20, F14, P26)"""
    cells = F.split("value", r"\t", -1)
    below = F.lead("value").over(Window.partitionBy("file").orderBy("line"))
    wide = lines.withColumn("below", below).where("below is not null").withColumn("a", cells).withColumn("b", F.split("below", r"\t", -1)).where("size(a) > 1 and size(a) = size(b)")
    head = wide.select("file", F.lit(0).alias("phase"), "line", F.posexplode(F.arrays_zip("a", "b")).alias("col", "x")).select("file", "phase", "line", "col", _metric(_key(F.col("x.a"))).alias("metric"), fd.first_number(F.col("x.b")).alias("v"))
    pair = r"^\s*([^:=\t]+?)\s*[:=\t]\s*(.+)$"
    said = lines.select("file", F.lit(1).alias("phase"), "line", F.lit(0).alias("col"), _metric(_key(F.regexp_extract("value", pair, 1))).alias("metric"), fd.first_number(F.regexp_extract("value", pair, 2)).alias("v"))
    found = head.union(said).where("metric is not null and v is not null")
    first = lambda m: F.min_by(F.when(F.col("metric") == m, F.col("v")), F.when(F.col("metric") == m, F.struct("file", "phase", "line", "col")))
    row = found.agg(*[first(m).alias(m) for m in MSI_KEYS])
    score = F.coalesce("msi_score", F.when(F.col("total_sites") > 0, F.col("unstable_sites") / F.col("total_sites") * 100))
    row = row.withColumn("msi_score_percent", F.when(score.between(0, 100), score)).withColumn("sample", F.lit(sample))
    return row.withColumn("msi_status", bio.msi_class(F.col("msi_score_percent"), low, high))


def hla_calls(table: DataFrame, sample: str) -> DataFrame:
    """Normalised alleles of a typing table."""
    locus, allele, copy = (column_of(table, n) for n in (["Locus", "Gene"], ["Allele", "AlleleFull", "HLAType"], ["Chromosome", "Copy", "Haplotype"]))
    if not locus or not allele:
        raise ValueError(f"no locus or allele among {', '.join(table.columns)}")
    text = F.trim(F.coalesce(F.col(allele), F.lit("")))
    rows = table.withColumn("at", F.monotonically_increasing_id()).where(~text.isin("", "NA", "-"))
    full = bio.hla_full(F.col(locus), text)
    n = bio.hla_fields(full)
    return rows.select("at", F.lit(sample).alias("sample"), F.col(locus).alias("locus"), (F.col(copy) if copy else F.lit("")).alias("copy"), text.alias("hla_la_call"), full.alias("full_allele"), n.alias("field_count"), F.concat((n * 2).cast("string"), F.lit("-digit")).alias("legacy_resolution"), bio.hla_binding(full).alias("binding_allele"))


def hla_classes(calls: DataFrame) -> DataFrame:
    """(A16)"""
    one, two = F.col("locus").isin("A", "B", "C"), F.col("locus").rlike("^D")
    return calls.agg(F.count_if(one).alias("class_i"), F.count_if(two).alias("class_ii"), F.count_if(~one & ~two).alias("other"))


def regions_depth(summary: DataFrame) -> DataFrame:
    """Rows of a depth summary for target regions or the total."""
    return summary.where(F.col("chrom").rlike("^chr([1-9]|1[0-9]|2[0-2]|X|Y|M)_region$") | F.col("chrom").startswith("total"))


def mix_fractions(ratios: DataFrame, total: float = 1.0) -> DataFrame:
    """(P44)"""
    r = F.col("ratio_a_percent") / 100
    return ratios.withColumn("actual_fraction_a", r * total).withColumn("actual_fraction_b", (1 - r) * total)


def mixed_reads(a: DataFrame, b: DataFrame, fraction_a: float, fraction_b: float, key: str = "name", seed: int = 100) -> DataFrame:
    """A sample of both, by a hash of the read's name, so that mates stay together."""
    take = lambda df, f: df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) < int(f * 1_000_000))
    return take(a, fraction_a).unionByName(take(b, fraction_b))


def sliced_reads(reads: DataFrame, loci: DataFrame, flank: int = 300) -> DataFrame:
    """Reads that overlap the surroundings of a locus, wherever they begin."""
    width = 2 * flank + 1
    near = iv.merge(loci.select("chrom", F.greatest(F.lit(0), F.col("pos") - 1 - flank).alias("start"), (F.col("pos") + flank).alias("end")), ["chrom"])
    spread = lambda a, b: F.explode(F.sequence(F.floor(a / width).cast("long"), F.floor((b - 1) / width).cast("long")))
    side = near.select(F.col("chrom").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e")).withColumn("_b", spread(F.col("_s"), F.col("_e")))
    first = F.col("start") - 1
    last = first + F.greatest(F.lit(1).cast("long"), covered_length(F.col("cigar"), "MDN=X"))
    spots = reads.select("at", "chrom", first.alias("_first"), last.alias("_last")).withColumn("_bin", spread(F.col("_first"), F.col("_last")))
    on = (F.col("chrom") == F.col("_c")) & (F.col("_bin") == F.col("_b")) & (F.col("_first") < F.col("_e")) & (F.col("_last") > F.col("_s"))
    return reads.join(spots.join(side, on, "left_semi").select("at").distinct(), "at", "left_semi")
