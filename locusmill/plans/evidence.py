"""What reads say of loci: 33 counts for each, tumor beside normal, and a first judgement in words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields as fd
from locusmill.operators import relational as rel
from locusmill.sources.alignment_file import bam

LOCUS = ["chrom", "pos", "ref", "alt"]
#: Least mapping and base quality of a good read, least base quality of the pool that is thinned out, reads kept of a start (fixed values).
GOOD_MAPQ, GOOD_BASE, POOL_BASE, KEPT = 30, 20, 10, 5

#: Texts of the judgement (fixed values); {} is filled in.
BADLY_MAPPED = "覆盖与ALT均存在，但ALT全部MAPQ<30，被Mutect2映射质量过滤"
NO_DEPTH = "肿瘤无Mutect2可用的高质量覆盖"
NO_ALT = "肿瘤无高质量ALT片段"
FEW_ALT = "肿瘤仅{}个高质量ALT片段"
LOW_FRACTION = "肿瘤ALT VAF低({})"
ONE_WAY = "ALT仅见于一种paired-read orientation"
AT_ENDS = "ALT集中在读段末端"
COMPLEX = "ALT经常与soft-clip/indel复杂CIGAR共现"
IN_NORMAL = "正常样本也有ALT支持"
SOME_EVIDENCE = "存在一定ALT证据，需结合Mutect2局部组装/下采样进一步判断"


def observations(loci: DataFrame, reads: DataFrame, width: int = 500) -> DataFrame:
    """A row for each locus (``locus`` tells them apart) and read that holds its place, with the base there.

    Reads meet loci by bins over what they cover, so the join is by key. Reads whose sequence does not reach the place are left out.
    """
    covered = F.aggregate(F.regexp_extract_all("cigar", F.lit(r"\d+(?=[MDN=X])"), F.lit(0)), F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))
    side = reads.withColumn("read_end", F.col("start") + F.greatest(F.lit(1), covered) - 1)
    side = side.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("read_end") / width))))
    spots = loci.select(*LOCUS).distinct().withColumn("_bin", F.floor(F.col("pos") / width))
    rows = spots.join(side, ["chrom", "_bin"]).where((F.col("pos") >= F.col("start")) & (F.col("pos") <= F.col("read_end"))).drop("_bin")
    rows = rows.withColumn("index", bio.query_index(F.col("cigar"), F.col("start"), F.col("pos"))).where("index < length(seq)")
    n, bit = F.length("seq"), lambda b: F.col("flag").bitwiseAND(F.lit(b)) != 0
    at = (F.col("index") + 1).cast("int")
    return rows.withColumns({
        "base": F.upper(F.substring("seq", at, F.lit(1))),
        "base_quality": F.when(F.col("quality") == "*", 0).otherwise(F.ascii(F.substring("quality", at, F.lit(1))) - 33),
        "reverse": bit(0x10),
        "read_number": F.when(bit(0x40), 1).when(bit(0x80), 2).otherwise(0),
        "duplicate": bit(0x400),
        "proper_pair": bit(0x2),
        "orientation": bio.orientation(F.col("flag")),
        "query_pos": F.col("index") + 1,
        "end_distance": F.least(F.col("index"), n - F.col("index") - 1),
        "read_length": n,
        "soft_clip": F.col("cigar").contains("S"),
        "indel": F.col("cigar").rlike("[ID]"),
    })


def reads_over(path: str, loci: DataFrame) -> DataFrame:
    """Alignments of an indexed .bam file that lie over a list of loci: only blocks near them are read.

    The loci go to the driver as regions; with more than some thousands, reading the file whole is the better way.
    """
    asked = [f"{r['chrom']}:{r['pos']}-{r['pos']}" for r in loci.select("chrom", "pos").distinct().collect()]
    rows = bam(loci.sparkSession, path, asked)
    return rows if asked else rows.limit(0)


def _read_counts() -> dict[str, Column]:
    """Which reads each count of reads takes."""
    alt, ref = F.col("base") == F.col("alt"), F.col("base") == F.col("ref")
    usable = ~F.col("duplicate")
    good = usable & (F.col("mapq") >= GOOD_MAPQ) & (F.col("base_quality") >= GOOD_BASE)
    clip, indel = F.col("soft_clip"), F.col("indel")
    return {
        "raw_read_depth": F.lit(True),
        "raw_ref_reads": ref,
        "raw_alt_reads": alt,
        "raw_alt_mapq0_reads": alt & (F.col("mapq") == 0),
        "raw_alt_low_mapq_reads": alt & (F.col("mapq") < GOOD_MAPQ),
        "raw_alt_low_bq_reads": alt & (F.col("base_quality") < GOOD_BASE),
        "raw_alt_softclipped_reads": alt & clip,
        "raw_alt_indel_cigar_reads": alt & indel,
        "raw_alt_complex_cigar_reads": alt & (clip | indel),
        "raw_ref_softclipped_reads": ref & clip,
        "nonduplicate_reads": usable,
        "hq_read_depth": good,
        "hq_ref_reads": good & ref,
        "hq_alt_reads": good & alt,
        "hq_other_reads": good & ~ref & ~alt,
        "alt_softclipped_reads": good & alt & clip,
        "duplicate_reads": ~usable,
    }


#: Columns of ``evidence`` behind the locus, in their order (fixed values).
METRICS = (
    "raw_read_depth", "raw_ref_reads", "raw_alt_reads", "raw_alt_mapq0_reads", "raw_alt_low_mapq_reads", "raw_alt_low_bq_reads",
    "raw_alt_softclipped_reads", "raw_alt_indel_cigar_reads", "raw_alt_complex_cigar_reads", "raw_ref_softclipped_reads",
    "nonduplicate_reads", "hq_read_depth", "hq_ref_reads", "hq_alt_reads", "hq_other_reads", "hq_fragment_depth", "hq_ref_fragments",
    "hq_alt_fragments", "hq_alt_vaf", "alt_forward_fragments", "alt_reverse_fragments", "alt_f1r2_fragments", "alt_f2r1_fragments",
    "alt_read1_fragments", "alt_read2_fragments", "alt_mean_bq", "alt_mean_mapq", "alt_median_end_distance", "alt_softclipped_reads",
    "alt_unique_alignment_starts", "duplicate_reads", "cap5_retained_reads_estimate", "cap5_alt_reads_estimate",
)


def evidence(seen: DataFrame, loci: DataFrame | None = None) -> DataFrame:
    """The 33 ``METRICS`` of each locus that was seen, or of all ``loci``: reads, fragments that agree, fractions, strands, ends.

    A fragment counts where its good reads agree on the base; its best read by base and mapping quality (the first among equals)
    tells strand, orientation and number. Means and the median are over good reads with the ALT base.
    """
    alt, ref = F.col("base") == F.col("alt"), F.col("base") == F.col("ref")
    counts = _read_counts()
    mine = counts["hq_alt_reads"]
    of = lambda c: F.when(mine, F.col(c))
    reads = seen.groupBy(*LOCUS).agg(*[F.count_if(c).alias(n) for n, c in counts.items()], fd.rounded(F.coalesce(F.avg(of("base_quality")), F.lit(0.0)), 2).alias("alt_mean_bq"), fd.rounded(F.coalesce(F.avg(of("mapq")), F.lit(0.0)), 2).alias("alt_mean_mapq"), F.coalesce(F.median(of("end_distance")), F.lit(0.0)).alias("alt_median_end_distance"), F.size(F.collect_set(of("start"))).cast("long").alias("alt_unique_alignment_starts"))
    best = F.max_by(F.struct("reverse", "orientation", "read_number"), F.struct("base_quality", "mapq", -F.col("at")))
    good = seen.where(counts["hq_read_depth"]).groupBy(*LOCUS, "qname")
    one = good.agg(F.min("base").alias("base"), F.max("base").alias("_most"), best.alias("r")).where("base = _most").select(*LOCUS, "base", "r.*")
    fragments = {
        "hq_fragment_depth": F.lit(True),
        "hq_ref_fragments": ref,
        "hq_alt_fragments": alt,
        "alt_forward_fragments": alt & ~F.col("reverse"),
        "alt_reverse_fragments": alt & F.col("reverse"),
        "alt_f1r2_fragments": alt & (F.col("orientation") == "F1R2"),
        "alt_f2r1_fragments": alt & (F.col("orientation") == "F2R1"),
        "alt_read1_fragments": alt & (F.col("read_number") == 1),
        "alt_read2_fragments": alt & (F.col("read_number") == 2),
    }
    fragments = one.groupBy(*LOCUS).agg(*[F.count_if(c).alias(n) for n, c in fragments.items()])
    pool = seen.where(~F.col("duplicate") & (F.col("mapq") >= GOOD_MAPQ) & (F.col("base_quality") >= POOL_BASE))
    thin = rel.best(pool, [*LOCUS, "start"], [F.col("at")], KEPT).groupBy(*LOCUS).agg(F.count(F.lit(1)).alias("cap5_retained_reads_estimate"), F.count_if(alt).alias("cap5_alt_reads_estimate"))
    out = reads.join(fragments, LOCUS, "left").join(thin, LOCUS, "left")
    if loci is not None:
        out = loci.select(*LOCUS).distinct().join(out, LOCUS, "left")
    out = out.na.fill(0)
    share = F.when(F.col("hq_fragment_depth") > 0, fd.rounded(F.col("hq_alt_fragments") / F.col("hq_fragment_depth"), 5)).otherwise(0.0)
    return out.withColumn("hq_alt_vaf", share).select(*LOCUS, *METRICS)


def judgement() -> Column:
    """Of tumor_ and normal_ metrics, the first reason why nothing can be said, else all findings in order."""
    t = lambda c: F.col(f"tumor_{c}")
    alt, share = t("hq_alt_fragments"), t("hq_alt_vaf")
    filled = lambda text, value: F.concat(*[F.lit(text.split("{}")[0]), value, F.lit(text.split("{}")[1])])
    percent = F.concat(F.format_number(fd.rounded(share * 100, 2), 2), F.lit("%"))
    mapped_badly = (t("raw_alt_reads") > 0) & (t("raw_alt_low_mapq_reads") == t("raw_alt_reads"))
    findings = (
        (alt == 0, F.lit(NO_ALT)),
        (alt.between(1, 2), filled(FEW_ALT, alt.cast("string"))),
        ((share > 0) & (share < 0.02), filled(LOW_FRACTION, percent)),
        ((alt >= 3) & (F.least(t("alt_f1r2_fragments"), t("alt_f2r1_fragments")) == 0), F.lit(ONE_WAY)),
        ((alt >= 2) & (t("alt_median_end_distance") <= 5), F.lit(AT_ENDS)),
        (t("raw_alt_complex_cigar_reads") / F.nullif(t("raw_alt_reads"), F.lit(0)) >= 0.4, F.lit(COMPLEX)),
        ((F.col("normal_hq_alt_fragments") >= 2) | (F.col("normal_hq_alt_vaf") >= 0.02), F.lit(IN_NORMAL)),
    )
    said = F.concat_ws("；", *[F.when(holds, text) for holds, text in findings])
    silent = F.when(mapped_badly, BADLY_MAPPED).otherwise(NO_DEPTH)
    return F.when(t("hq_fragment_depth") == 0, silent).otherwise(F.coalesce(F.nullif(said, F.lit("")), F.lit(SOME_EVIDENCE)))


def paired_evidence(loci: DataFrame, tumor: DataFrame, normal: DataFrame) -> DataFrame:
    """``gene, variant``, the locus's columns, tumor_ and normal_ metrics of all loci, and ``preliminary_reason``.

    ``tumor`` and ``normal`` are what ``observations`` gave. A locus that no read covers has zeros.
    """
    put = lambda seen, p: evidence(seen, loci).select(*LOCUS, *[F.col(c).alias(f"{p}_{c}") for c in METRICS])
    rows = loci.join(put(tumor, "tumor"), LOCUS, "left").join(put(normal, "normal"), LOCUS, "left")
    gene = F.coalesce(F.col("gene"), F.lit("")) if "gene" in loci.columns else F.lit("")
    rest = [c for c in loci.columns if c not in LOCUS and c != "gene"]
    metrics = [f"{p}_{c}" for p in ("tumor", "normal") for c in METRICS]
    return rows.select(gene.alias("gene"), F.concat_ws(":", *LOCUS).alias("variant"), *LOCUS, *rest, *metrics, judgement().alias("preliminary_reason"))
