"""Plans over annotated variants: audited filter, mutation burden, hard filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields as fd
from locusmill.operators import intervals as iv
from locusmill.operators import relational as rel
from locusmill.sources.readers import VariantFile


@dataclass(frozen=True)
class Thresholds:
    min_tlod: float = 6.3
    min_tumor_dp: int = 20
    min_tumor_alt_reads: int = 5
    min_tumor_af: float = 0.02
    min_normal_dp: int = 20
    max_normal_alt_reads: int = 2
    max_normal_af: float = 0.02
    max_population_af: float = 0.001
    min_qual: float = 0.0
    population_fields: tuple[str, ...] = ("MAX_AF", "gnomADe_AF", "gnomADg_AF", "AF")


def matched_annotations(alleles: DataFrame, minimal: bool) -> Column:
    """Entries of an allele: by its name or minimal form, all if none fits (J1a); or by name, all only if it is alone."""
    names = F.array("alt", fd.minimal_allele(F.col("ref"), F.col("alt"))) if minimal else F.array("alt")
    own = F.filter("csq", lambda e: F.array_contains(names, e["Allele"]))
    rest = F.col("csq") if minimal else F.when(F.size("alts") == 1, F.col("csq")).otherwise(F.slice("csq", 1, 0))
    return F.when(F.size(own) > 0, own).otherwise(rest)


def _first(entries: Column, rank) -> Column:
    """The entry of least rank; the first of equals."""
    keyed = F.transform(entries, lambda e, i: F.struct(rank(e).alias("rank"), i.alias("i"), e.alias("e")))
    return F.get(F.array_sort(F.transform(keyed, lambda k: F.struct(k["rank"], k["i"], k["e"]))), F.lit(0))["e"]


def _lacks(e: Column, field: str, have: list[str]) -> Column:
    return F.when(F.coalesce(e[field], F.lit("")) == "", 1).otherwise(0) if field in have else F.lit(1)


def _is_mane(e: Column, have: list[str]) -> Column:
    return ~F.coalesce(e["MANE_SELECT"], F.lit("")).isin("", "-") if "MANE_SELECT" in have else F.lit(False)


def best_for_filter(entries: Column, have: list[str]) -> Column:
    """MANE (a dash is none) first, then canonical."""
    canonical = lambda e: F.upper(F.coalesce(e["CANONICAL"], F.lit(""))) == "YES" if "CANONICAL" in have else F.lit(False)
    return _first(entries, lambda e: F.struct(F.when(_is_mane(e, have), 0).otherwise(1).alias("a"), F.when(canonical(e), 0).otherwise(1).alias("b")))


def best_for_burden(entries: Column, have: list[str], terms: tuple[str, ...]) -> Column:
    """Among entries with a term that counts: MANE (a dash is none), canonical, others."""
    fit = F.filter(entries, lambda e: F.arrays_overlap(F.split(e["Consequence"], "&"), F.array(*map(F.lit, terms))))
    canonical = lambda e: F.when(F.upper(e["CANONICAL"]) == "YES", 1).otherwise(2) if "CANONICAL" in have else F.lit(2)
    return _first(fit, lambda e: F.when(_is_mane(e, have), 0).otherwise(canonical(e)))


def best_for_report(entries: Column, have: list[str]) -> Column:
    """MANE, canonical, protein coding, impact, c. name, p. name."""
    impact = lambda e: F.when(e["IMPACT"] == "HIGH", 0).when(e["IMPACT"] == "MODERATE", 1).when(e["IMPACT"] == "LOW", 2).when(e["IMPACT"] == "MODIFIER", 3).otherwise(4)
    is_ = lambda e, f, v: F.when(e[f] == v, 0).otherwise(1) if f in have else F.lit(1)
    return _first(entries, lambda e: F.struct(_lacks(e, "MANE_SELECT", have).alias("a"), is_(e, "CANONICAL", "YES").alias("b"), is_(e, "BIOTYPE", "protein_coding").alias("c"), (impact(e) if "IMPACT" in have else F.lit(4)).alias("d"), _lacks(e, "HGVSc", have).alias("e"), _lacks(e, "HGVSp", have).alias("f")))


def _measured(vcf: VariantFile, tumor: str, normal: str | None, least_fields: int) -> DataFrame:
    rows = vcf.alleles(tumor, normal, least_fields)
    rows = rows.withColumns({"t": fd.sample_metrics(F.col("tumor"), F.col("i")), "n": fd.sample_metrics(F.col("normal"), F.col("i")), "tlod": fd.number(fd.per_allele(F.element_at("info", "TLOD"), F.col("i")))})
    return rows.withColumns({"tumor_dp": F.col("t.dp"), "tumor_alt_reads": F.col("t.alt_reads"), "tumor_af": F.col("t.af"), "normal_dp": F.col("n.dp"), "normal_alt_reads": F.col("n.alt_reads"), "normal_af": F.col("n.af")})


def manual_filter(vcf: VariantFile, tumor: str, normal: str | None = None, limits: Thresholds = Thresholds()) -> DataFrame:
    """Each allele with its nine checks and the reasons why it fails; a check on a normal that is not there holds."""
    have = vcf.annotation_fields or []
    rows = _measured(vcf, tumor, normal, 10).withColumn("matched", matched_annotations(vcf.alleles(), True))
    rows = rows.withColumn("max_population_af", fd.max_population_af(F.col("matched"), [f for f in limits.population_fields if f in have])).withColumn("best", best_for_filter(F.col("matched"), have))
    no_normal = F.lit(normal is None)
    m = fd.meets
    pop = F.col("max_population_af")
    checks = [
        ("mutect_filter", F.col("filter").isin("PASS", ".")),
        ("tlod", m(F.col("tlod"), limits.min_tlod)),
        ("tumor_dp", m(F.col("tumor_dp"), limits.min_tumor_dp)),
        ("tumor_alt_reads", m(F.col("tumor_alt_reads"), limits.min_tumor_alt_reads)),
        ("tumor_af", m(F.col("tumor_af"), limits.min_tumor_af)),
        ("population_af", pop.isNull() | (pop <= limits.max_population_af)),
        ("normal_dp", no_normal | m(F.col("normal_dp"), limits.min_normal_dp)),
        ("normal_alt_reads", no_normal | m(F.col("normal_alt_reads"), most=limits.max_normal_alt_reads)),
        ("normal_af", no_normal | m(F.col("normal_af"), most=limits.max_normal_af)),
    ]
    out = rel.audit(rows, checks)
    told = [F.col(f"best.{f}").alias(n) if f in have else F.lit("").alias(n) for f, n in (("SYMBOL", "gene"), ("Consequence", "consequence"), ("HGVSc", "hgvsc"), ("HGVSp", "hgvsp"))]
    passes = [f"pass_{n}" for n in ("mutect_filter", "tlod", "tumor_dp", "tumor_alt_reads", "tumor_af", "normal_dp", "normal_alt_reads", "normal_af", "population_af")]
    return out.select("at", "raw_line", "chrom", "pos", "ref", "alt", *told, "tlod", "tumor_dp", "tumor_alt_reads", "tumor_af", "normal_dp", "normal_alt_reads", "normal_af", "max_population_af", *passes, "overall_pass", "failure_reasons")


#: Columns of the audit table and of the tables of accepted and rejected variants, in their order (fixed values).
AUDIT = ("chrom", "pos", "ref", "alt", "gene", "consequence", "hgvsc", "hgvsp", "tlod", "tumor_dp", "tumor_alt_reads", "tumor_af", "normal_dp", "normal_alt_reads", "normal_af", "max_population_af", "pass_mutect_filter", "pass_tlod", "pass_tumor_dp", "pass_tumor_alt_reads", "pass_tumor_af", "pass_normal_dp", "pass_normal_alt_reads", "pass_normal_af", "pass_population_af", "overall_pass", "failure_reasons")
BURDEN = ("chrom", "pos", "ref", "alt", "gene", "consequence", "feature", "hgvsc", "hgvsp", "qual", "tlod", "tumor_dp", "tumor_alt_reads", "tumor_af", "normal_dp", "normal_alt_reads", "normal_af", "max_population_af", "status", "reasons")
_SHARES = ("tumor_af", "normal_af", "max_population_af")


def as_text(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns as the tables print them: fractions with six digits, other numbers by their shortest, True and False, "" for nothing."""

    def said(name: str, kind: str) -> Column:
        c = F.col(name)
        text = fd.shown(c, 6) if name in _SHARES else fd.shown_whole(c) if kind == "double" else F.initcap(c.cast("string")) if kind == "boolean" else c.cast("string")
        return F.coalesce(text, F.lit("")).alias(name)

    kinds = dict(rows.dtypes)
    return rows.select(*[said(c, kinds[c]) for c in columns])


def filter_summary(rows: DataFrame, tumor: str, normal: str | None, limits: Thresholds = Thresholds()) -> DataFrame:
    """One row on ``manual_filter``'s: samples, counts, how often each reason was given, and the thresholds. (A1, A2, K3)"""
    sums = rows.agg(F.count(F.lit(1)).alias("input_variants"), F.count_if("overall_pass").alias("passed_variants"), F.count_if(~F.col("overall_pass")).alias("failed_variants"))
    why = rel.tag_histogram(rows.where("not overall_pass"), F.split("failure_reasons", ";"), "reason").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("failure_reason_counts"))
    used = F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, (tuple, list)) else F.lit(v)).alias(k) for k, v in vars(limits).items()])
    out = sums.crossJoin(F.broadcast(why))  # one row each
    return out.select(F.lit(tumor).alias("tumor_sample"), F.lit(normal or "").alias("normal_sample"), "*", used.alias("thresholds"))


def burden_rows(vcf: VariantFile, tumor: str, normal: str | None = None, regions: DataFrame | None = None, limits: Thresholds = Thresholds(), terms: tuple[str, ...] = bio.BURDEN_CONSEQUENCES) -> DataFrame:
    """Distinct alleles with status and reasons. ``regions``: merged intervals; none, or a table without rows: everywhere.

    Where no annotation has a consequence that counts, the first one of the allele is told, and its population frequency tested.
    """
    have = vcf.annotation_fields or []
    rows = _measured(vcf, tumor, normal, 8).withColumn("matched", matched_annotations(vcf.alleles(), False))
    rows = rel.best(rows, ["chrom", "pos", "ref", "alt"], [F.col("at"), F.col("i")])
    rows = rows.withColumn("eligible", best_for_burden(F.col("matched"), have, terms)).withColumn("best", F.coalesce("eligible", F.get("matched", F.lit(0))))
    if regions is None or regions.isEmpty():
        rows = rows.withColumn("in_bed", F.lit(True))
    else:
        inside = iv.contained(rows.select("chrom", "pos").distinct(), regions, F.col("pos") - 1, {"chrom": "chrom"}, 1000.0).withColumn("in_bed", F.lit(True))
        rows = rows.join(inside, ["chrom", "pos"], "left").withColumn("in_bed", F.coalesce("in_bed", F.lit(False)))
    pop = fd.max_population_af(F.array("best"), [f for f in limits.population_fields if f in have], "&")
    rows = rows.withColumn("max_population_af", F.when(F.col("best").isNotNull(), pop)).withColumn("quality", fd.number(F.col("qual")))
    no_normal = F.lit(normal is None)
    m = fd.meets
    checks = [
        ("FILTER_not_PASS", F.col("filter").isin("PASS", ".")),
        ("outside_effective_coding_bed", F.col("in_bed")),
        ("low_or_missing_QUAL", F.lit(limits.min_qual <= 0) | m(F.col("quality"), limits.min_qual)),
        ("low_or_missing_TLOD", F.lit(limits.min_tlod <= 0) | m(F.col("tlod"), limits.min_tlod)),
        ("low_tumor_DP", m(F.col("tumor_dp"), limits.min_tumor_dp)),
        ("low_tumor_ALT_reads", m(F.col("tumor_alt_reads"), limits.min_tumor_alt_reads)),
        ("low_tumor_AF", m(F.col("tumor_af"), limits.min_tumor_af)),
        ("low_normal_DP", no_normal | m(F.col("normal_dp"), limits.min_normal_dp)),
        ("high_normal_ALT_reads", no_normal | m(F.col("normal_alt_reads"), most=limits.max_normal_alt_reads)),
        ("high_normal_AF", no_normal | m(F.col("normal_af"), most=limits.max_normal_af)),
        ("non_eligible_VEP_consequence", F.col("eligible").isNotNull()),
        ("population_AF_above_threshold", F.col("max_population_af").isNull() | (F.col("max_population_af") <= limits.max_population_af)),
    ]
    counted = F.array_join(F.array_sort(F.array_intersect(F.split("best.Consequence", "&"), F.array(*map(F.lit, terms)))), "&")
    kept = F.when(F.col("eligible").isNotNull(), counted).otherwise(F.coalesce("best.Consequence", F.lit("")))
    told = [(F.coalesce(f"best.{f}", F.lit("")) if f in have else F.lit("")).alias(n) for f, n in (("SYMBOL", "gene"), ("Feature", "feature"), ("HGVSc", "hgvsc"), ("HGVSp", "hgvsp"))]
    why = fd.reasons(checks)
    return rows.select("chrom", "pos", "ref", "alt", *told, kept.alias("consequence"), "qual", "tlod", "tumor_dp", "tumor_alt_reads", "tumor_af", "normal_dp", "normal_alt_reads", "normal_af", "max_population_af", F.when(why == "", "accepted").otherwise("rejected").alias("status"), why.alias("reasons"))


def burden(rows: DataFrame, regions: DataFrame | None = None, megabases: float = 0.0) -> DataFrame:
    """One row: accepted, rejected, covered_bp, per_mb and tier."""
    n = rows.agg(F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "rejected").alias("rejected"))
    if regions is None:
        if megabases <= 0:
            raise ValueError("neither regions nor a size in megabases is given")
        size = rows.sparkSession.range(1).select(F.lit(int(megabases * 1e6)).cast("long").alias("covered_bp"))
    else:
        size = regions.agg(iv.covered(regions).cast("long").alias("covered_bp"))
    out = n.crossJoin(F.broadcast(size))  # one row each
    bp = F.when(F.col("covered_bp") > 0, F.col("covered_bp")).otherwise(F.raise_error(F.lit("the regions cover no base")).cast("long"))
    return out.withColumn("per_mb", F.col("accepted") / (bp / 1e6)).withColumn("tier", bio.burden_tier(F.col("per_mb")))


def hard_filter(records: DataFrame) -> DataFrame:
    """Germline records with ``hard_pass``: limits by kind; a key that is not there fails nothing."""
    v = lambda k: fd.number(F.element_at("info", k))
    hit = lambda c: F.coalesce(c, F.lit(False))
    snp = (F.length("ref") == 1) & F.forall("alts", lambda a: F.length(a) == 1)
    bad_snp = hit(v("QD") < 2) | hit(v("FS") > 60) | hit(v("MQ") < 40) | hit(v("MQRankSum") < -12.5) | hit(v("ReadPosRankSum") < -8)
    bad_indel = hit(v("QD") < 2) | hit(v("FS") > 200) | hit(v("ReadPosRankSum") < -20)
    return records.withColumn("kind", F.when(snp, "SNP").otherwise("INDEL")).withColumn("hard_pass", ~F.when(snp, bad_snp).otherwise(bad_indel))


def tag_counts(records: DataFrame, top: int = 8) -> DataFrame:
    """The most common FILTER tags, ties in the order of the file where records have ``at``. (A5, O1)"""
    return rel.tag_histogram(records, F.split("filter", ";"), "tag", top, F.col("at") if "at" in records.columns else None)


def effect_counts(records: DataFrame, top: int = 20) -> DataFrame:
    """Effects of an ANN field."""
    effects = F.transform(F.split(F.coalesce(F.element_at("info", "ANN"), F.lit("")), ","), lambda a: F.get(F.split(a, r"\|"), F.lit(1)))
    return rel.tag_histogram(records, F.filter(effects, lambda e: e.isNotNull()), "effect", top)


def structural_counts(records: DataFrame) -> DataFrame:
    """(A14)"""
    return records.groupBy(F.coalesce(F.element_at("info", "SVTYPE"), F.lit("")).alias("svtype")).agg(F.count(F.lit(1)).alias("n")).where("svtype <> ''")
