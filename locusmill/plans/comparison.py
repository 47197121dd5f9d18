"""Plans that compare our variants with an external report, and map coding names to the genome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields as fd
from locusmill.operators import intervals as iv
from locusmill.operators import relational as rel
from locusmill.plans import variants
from locusmill.sources.readers import VariantFile, aliased, with_base

#: Header names of external reports (fixed values).
REPORT_ALIASES = {
    "gene": ["基因", "gene", "symbol"],
    "region": ["外显子/内含子", "区域", "region", "exon"],
    "hgvsc_other": ["核苷酸变异", "hgvsc", "cdna", "c.hgvs"],
    "hgvsp_other": ["氨基酸变异", "hgvsp", "protein", "p.hgvs"],
    "other_vaf": ["丰度/拷贝数", "丰度", "vaf", "af", "frequency"],
    "other_type": ["变异类型", "类型", "type", "consequence"],
    "chrom": ["chrom", "chr", "染色体"],
    "pos": ["pos", "position", "位置"],
    "ref": ["ref", "参考碱基"],
    "alt": ["alt", "突变碱基"],
}
#: Values of comparison_status (fixed values).
BOTH, LIKELY, EXTERNAL = "两流程共同检出", "疑似共同检出（转录本差异）", "仅外部流程检出"
#: Values of match_method, what is added for several candidates, and whether a gene is seen (fixed values); {} is filled in.
BY_BOTH, BY_CODING, BY_PROTEIN, BY_SHARE, NO_MATCH = "基因+cDNA+蛋白HGVS", "基因+cDNA HGVS", "基因+蛋白HGVS", "同基因唯一候选且AF差≤{}；HGVS转录本不同，需坐标确认", "未匹配"
SEVERAL, SEEN, UNSEEN = "（多候选）", "是", "否"


def external_report(table: DataFrame) -> DataFrame:
    """Columns by alias with row numbers and normalised names."""
    rows = aliased(table, REPORT_ALIASES).withColumn("_at", F.monotonically_increasing_id())
    rows = rows.withColumn("other_row", F.row_number().over(Window.orderBy("_at")).cast("long")).drop("_at")  # a report of tens of rows
    return rows.withColumns({"gene": F.trim("gene"), "hgvsc_norm": bio.cdna_name(F.col("hgvsc_other")), "hgvsp_norm": bio.protein_name(F.col("hgvsp_other")), "other_vaf_numeric": fd.percent(F.col("other_vaf"))})


def compare(ours: DataFrame, other: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """``other`` with comparison_status, match_method and matched_key.

    ``ours``: key, gene, hgvsc, hgvsp, af, a row per annotation. Candidates by c. name and by p. name: both together where
    they share some, else those by c., else those by p.; the least key counts. Rows without any can still match the only
    variant of their gene by its fraction.

    Candidates are summed up to their least and largest key before they are joined, so rows never carry lists of them. Both
    names together: every c. with every p. of a key in a gene, whichever of its annotations they are from.
    """
    usable = ~F.col("hgvsp").isin("", "p.?", "?")
    ours = ours.withColumn("gene", F.upper("gene"))
    pairs = ours.groupBy("gene", "key").agg(F.collect_set(F.when(F.col("hgvsc") != "", F.col("hgvsc"))).alias("c"), F.collect_set(F.when(usable, F.col("hgvsp"))).alias("p"))
    pairs = pairs.withColumn("hgvsc", F.explode("c")).withColumn("hgvsp", F.explode("p"))
    levels = {
        "both": (pairs, ["gene", "hgvsc", "hgvsp"], []),
        "c": (ours.where("hgvsc <> ''"), ["gene", "hgvsc"], []),
        "p": (ours.where(usable), ["gene", "hgvsp"], []),
        "any": (ours, ["gene"], [F.min_by("af", "key").alias("_any_af")]),
    }
    mine = {"gene": F.upper("gene"), "hgvsc": F.col("hgvsc_norm"), "hgvsp": F.col("hgvsp_norm")}
    rows = other
    for level, (side, names, more) in levels.items():
        found = side.groupBy(*[F.col(c).alias(f"_{level}_{c}") for c in names]).agg(F.min("key").alias(f"_{level}_lo"), F.max("key").alias(f"_{level}_hi"), *more)
        rows = rows.join(found, [mine[c] == F.col(f"_{level}_{c}") for c in names], "left")
    named = ["both", "c", "p"]
    least, most = (F.coalesce(*[F.col(f"_{level}_{end}") for level in named]) for end in ("lo", "hi"))
    method = F.coalesce(*[F.when(F.col(f"_{level}_lo").isNotNull(), said) for level, said in zip(named, (BY_BOTH, BY_CODING, BY_PROTEIN))])
    near = F.coalesce((F.col("_any_lo") == F.col("_any_hi")) & (F.abs(F.col("_any_af") - F.col("other_vaf_numeric")) <= tolerance), F.lit(False))
    exact = least.isNotNull()
    out = rows.withColumns({
        "comparison_status": F.when(exact, BOTH).when(near, LIKELY).otherwise(EXTERNAL),
        "match_method": F.when(exact, F.concat(method, F.when(least != most, SEVERAL).otherwise(""))).when(near, BY_SHARE.format(f"{tolerance:.1%}")).otherwise(NO_MATCH),
        "matched_key": F.when(exact, least).when(near, F.col("_any_lo")).otherwise(""),
        "gene_in_ours": F.when(F.col("_any_gene").isNotNull(), SEEN).otherwise(UNSEEN),
    })
    return out.drop(*[f"_{level}_{c}" for level, (_, names, _) in levels.items() for c in (*names, "lo", "hi")], "_any_af")


def our_variants(vcf: VariantFile, tumor: str, normal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Details of each allele of our calls (key, place, filter, metrics, best annotation), and ``key, gene, hgvsc, hgvsp, af`` of all its annotations.

    The first record of a key counts, as do all its annotations.
    """
    have = vcf.annotation_fields or []
    rows = vcf.alleles(tumor, normal)
    rows = rows.withColumns({"entries": variants.matched_annotations(rows, False), "_t": fd.sample_metrics(F.col("tumor"), F.col("i")), "_n": fd.sample_metrics(F.col("normal"), F.col("i"))})
    rows = rows.withColumns({"chrom": bio.with_chr(F.col("chrom")), "best": variants.best_for_report(F.col("entries"), have)})
    rows = rows.withColumn("key", F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt"))
    rows = rel.best(rows, ["key"], [F.col("at"), F.col("i")])
    of = lambda f: F.coalesce(F.col(f"best.{f}"), F.lit("")) if f in have else F.lit("")
    every = lambda f: F.transform("entries", lambda e: F.coalesce(e[f], F.lit(""))) if f in have else F.array().cast("array<string>")
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(F.filter(names, lambda x: x != ""))), ";")
    terms = F.flatten(F.transform(every("Consequence"), lambda c: F.split(c, "&")))
    metrics = [F.col(f"_{p}.{m}").alias(f"{n}_{m}") for p, n in (("t", "tumor"), ("n", "normal")) for m in ("dp", "alt_reads", "af")]
    details = rows.select("key", "chrom", "pos", "id", "ref", "alt", "qual", "filter", fd.number(fd.per_allele(F.element_at("info", "TLOD"), F.col("i"))).alias("tlod"), joined(every("SYMBOL")).alias("genes"), *[of(f).alias(n) for f, n in (("SYMBOL", "gene"), ("Consequence", "consequence"), ("IMPACT", "impact"), ("Feature", "transcript"), ("HGVSc", "hgvsc"), ("HGVSp", "hgvsp"))], joined(terms).alias("all_consequences"), *metrics)
    each = rows.select("key", F.col("_t.af").alias("af"), F.explode("entries").alias("e"))
    text = lambda f: F.coalesce(F.col(f"e.{f}"), F.lit("")) if f in have else F.lit("")
    return details, each.select("key", text("SYMBOL").alias("gene"), bio.cdna_name(text("HGVSc")).alias("hgvsc"), bio.protein_name(text("HGVSp")).alias("hgvsp"), "af")


#: What the comparison tells of a matched variant of ours, in its order (fixed values).
OURS = ("chrom", "pos", "ref", "alt", "filter", "tlod", "tumor_dp", "tumor_alt_reads", "tumor_af", "normal_dp", "normal_alt_reads", "normal_af", "consequence")


def with_ours(compared: DataFrame, details: DataFrame) -> DataFrame:
    """``compared`` with our_ columns of the matched variant, and matched_variant_key and same_gene_seen_in_our_vcf by those names."""
    side = details.select(F.col("key").alias("matched_variant_key"), *[F.col(c).alias(f"our_{c}") for c in OURS])
    out = compared.join(side, F.col("matched_key") == F.col("matched_variant_key"), "left")
    return out.withColumns({"matched_variant_key": F.coalesce("matched_variant_key", F.lit("")), "same_gene_seen_in_our_vcf": F.col("gene_in_ours")})


def only_ours(ours: DataFrame, compared: DataFrame) -> DataFrame:
    """(U2)"""
    return rel.only_left(ours, compared.where("matched_key <> ''"), "key", "matched_key")


def traced(compared: DataFrame, filtered: DataFrame) -> DataFrame:
    """With what the unfiltered calls say of the candidate, as filtered_ columns: by matched key, else by mapped key.

    ``filtered`` (key, at and details) as ``filtered_details`` gives it; the last record of a key counts.
    """
    details = [c for c in filtered.columns if c not in ("key", "at")]
    side = filtered.groupBy(F.col("key").alias("filtered_variant_key")).agg(F.max_by(F.struct(*details), "at").alias("_d"))
    side = side.select("filtered_variant_key", *[F.col(f"_d.{c}").alias(f"filtered_{c}") for c in details])
    known = [F.nullif(F.col(c), F.lit("")) for c in ("matched_key", "gtf_variant") if c in compared.columns]
    out = compared.join(side, F.coalesce(*known, F.lit("")) == F.col("filtered_variant_key"), "left")
    return out.withColumn("filtered_filter", F.coalesce("filtered_filter", F.lit("")))


def filtered_details(vcf: VariantFile, tumor: str, normal: str | None = None) -> DataFrame:
    """``key, at`` and the details that ``traced`` tells, a row for each allele of the unfiltered calls."""
    of = lambda name: F.lit(None).cast("map<string,string>") if not name or name not in vcf.samples else fd.format_map(F.col("format"), F.get("sample_values", F.lit(vcf.sample(name))))
    rows = vcf.records().withColumns({"_t": of(tumor), "_n": of(normal)}).select("*", F.posexplode("alts").alias("_i", "alt"))
    t, n = fd.sample_metrics(F.col("_t"), F.col("_i")), fd.sample_metrics(F.col("_n"), F.col("_i"))
    said = lambda k: F.coalesce(F.element_at("_t", k), F.lit("")).alias(f"tumor_{k.lower()}")
    numbers = [t["dp"].alias("tumor_dp"), t["alt_reads"].alias("tumor_alt_reads"), t["af"].alias("tumor_af"), *map(said, ("F1R2", "F2R1", "SB")), n["dp"].alias("normal_dp"), n["alt_reads"].alias("normal_alt_reads"), n["af"].alias("normal_af")]
    key = F.concat_ws(":", bio.with_chr(F.col("chrom")), F.col("pos").cast("string"), "ref", "alt")
    info = lambda k: F.element_at("info", k)
    return rows.select(key.alias("key"), "at", "filter", fd.number(fd.per_allele(info("TLOD"), F.col("_i"))).alias("tlod"), F.coalesce(info("ROQ"), F.lit("")).alias("roq"), *numbers)


def in_regions(rows: DataFrame, merged: DataFrame, pos: str = "pos", ref: str = "ref") -> DataFrame:
    """Whether the bases that REF covers lie in a region, and how far the nearest is."""
    lo = F.col(pos) - 1
    return iv.nearest(rows, merged, lo, lo + F.greatest(F.lit(1), F.length(ref)), {"chrom": "chrom"}, 10_000.0)


#: Labels and explanations of where a row lies (fixed values); {} is filled in.
INSIDE, OUTSIDE, NEAR_INSIDE, NEAR_OUTSIDE, UNKNOWN = "BED内", "BED外", "BED内（近似）", "BED外（近似）", "无法判定"
BY_MATCH, BY_REPORT = "使用本流程匹配位点的基因组坐标判定", "使用外部表提供的基因组坐标判定"
BY_MAP, UNMAPPED, NO_PLACE, DISTANCE = "Ensembl115 {} canonical/MANE近似映射，参考碱基{}", "Ensembl115 GTF: {}", "外部表缺少CHROM/POS/REF/ALT", "；距最近BED约{} bp"
#: Why a row is not among ours (fixed values).
PASSED, FILTERED, BEYOND, NOT_CALLED = "本流程PASS", "Mutect2已检出，但被过滤: {}", "近似位点在BED外，原Mutect2 -L不会检测", "BED内，但filtered VCF无该候选"
NOT_TRACED, NO_COORDINATE = "未提供filtered VCF，暂不能追踪", "坐标无法确定，暂不能追踪"


def _filled(text: str, *values: Column) -> Column:
    pieces = text.split("{}")
    return F.concat(*[x for piece, v in zip(pieces, values) for x in (F.lit(piece), v)], F.lit(pieces[-1]))


def with_bed_status(compared: DataFrame, ours: DataFrame, merged: DataFrame) -> DataFrame:
    """``compared`` with bed_status and bed_explanation, by the first place that is known: ours, the report's, the mapped one.

    ``ours``: key, in_bed, a row for each key; ``merged``: regions. Columns chrom, pos and ref are the report's texts, "" where
    it has none; gtf_ columns may be absent. A contig without regions is outside, at no distance.
    """
    have = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(None).cast("string")) if c in compared.columns else F.lit(None).cast("string")
    text = lambda c: have(c) if c not in compared.columns or dict(compared.dtypes)[c] == "string" else F.col(c).cast("string")
    mapped = text("gtf_pos").try_cast("double").cast("long")
    given = text("chrom").isNotNull() & text("pos").isNotNull() & text("ref").isNotNull()
    rows = compared.withColumns({
        "_row": F.monotonically_increasing_id(),
        "_chrom": bio.with_chr(F.when(given, text("chrom")).otherwise(text("gtf_chrom"))),
        "_pos": F.when(given, text("pos").try_cast("long")).otherwise(mapped),
        "_ref": F.when(given, text("ref")).otherwise(F.coalesce(text("gtf_ref"), F.lit("N"))),
    })
    mine = ours.select(F.col("key").alias("_key"), F.col("in_bed").alias("_in")).distinct()
    lo = F.col("_pos") - 1
    side = merged.select(F.col("chrom").alias("_c"), "start", "end")
    rows = iv.nearest(rows, side, lo, lo + F.greatest(F.lit(1), F.length("_ref")), {"_chrom": "_c"}, 10_000.0)
    rows = rows.join(mine, F.col("matched_key") == F.col("_key"), "left")
    far = F.when(~F.col("inside"), F.col("distance").cast("long").cast("string"))
    away = F.coalesce(_filled(DISTANCE, far), F.lit(""))
    by_map = _filled(BY_MAP, F.coalesce(text("gtf_transcript"), F.lit("")), F.coalesce(text("gtf_reference_check"), F.lit("未检查")))
    cases = (
        (F.col("matched_key") != "", F.when(F.col("_in"), INSIDE).otherwise(OUTSIDE), F.lit(BY_MATCH)),
        (given, F.when(F.col("inside"), INSIDE).otherwise(OUTSIDE), F.concat(F.lit(BY_REPORT), F.when(far == "0", "").otherwise(away))),
        (mapped.isNotNull(), F.when(F.col("inside"), NEAR_INSIDE).otherwise(NEAR_OUTSIDE), F.concat(by_map, away)),
        (text("gtf_mapping_status").isNotNull(), F.lit(UNKNOWN), _filled(UNMAPPED, text("gtf_mapping_status"))),
        (F.lit(True), F.lit(UNKNOWN), F.lit(NO_PLACE)),
    )
    first = lambda i: F.coalesce(*[F.when(F.coalesce(case[0], F.lit(False)), case[i]) for case in cases])
    out = rows.withColumns({"bed_status": first(1), "bed_explanation": first(2)})
    return out.drop("_row", "_chrom", "_pos", "_ref", "_key", "_in", "inside", "distance")


def diagnosis(with_filtered: bool) -> Column:
    """Why a row is not among ours, by the first rule that holds."""
    status, tags = F.coalesce("bed_status", F.lit("")), F.coalesce("filtered_filter", F.lit(""))
    rules = [(F.col("comparison_status") != EXTERNAL, F.lit(PASSED)), (tags != "", _filled(FILTERED, tags)), (status.startswith(OUTSIDE), F.lit(BEYOND))]
    rules += [(status.startswith(INSIDE), F.lit(NOT_CALLED)), (F.lit(True), F.lit(NO_COORDINATE))] if with_filtered else [(F.lit(True), F.lit(NOT_TRACED))]
    return F.coalesce(*[F.when(holds, said) for holds, said in rules])


def comparison_summary(compared: DataFrame, ours: DataFrame, filtered: DataFrame | None = None) -> DataFrame:
    """One row of 19 counts.

    ``compared`` has bed_status and difference_diagnosis, and where they were made, gtf_pos and filtered_filter; ``ours``: key,
    in_bed; ``filtered``: filter, a row for each record.
    """
    has = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != "" if c in compared.columns else F.lit(False)
    alone = F.col("comparison_status") == EXTERNAL
    status = F.coalesce("bed_status", F.lit(""))
    counts = {
        "other_report_variants": F.lit(True),
        "shared_variants": ~alone,
        "exact_shared_variants": F.col("comparison_status") == BOTH,
        "likely_shared_variants": F.col("comparison_status") == LIKELY,
        "only_other_variants": alone,
        "gtf_approx_mapped": alone & has("gtf_pos"),
        "gtf_approx_in_bed": alone & status.startswith(INSIDE),
        "gtf_approx_outside_bed": alone & status.startswith(OUTSIDE),
        "gtf_unresolved": alone & ~has("gtf_pos"),
        "external_detected_but_filtered": alone & has("filtered_filter"),
        "external_inside_bed_not_emitted": alone & (F.col("difference_diagnosis") == NOT_CALLED),
        "external_outside_bed": alone & status.startswith(OUTSIDE),
        "external_unresolved": alone & (status == UNKNOWN),
    }
    n = lambda c: F.coalesce(F.count_if(c), F.lit(0)).cast("long")
    theirs = compared.agg(*[n(c).alias(name) for name, c in counts.items()])
    mine = ours.agg(F.count(F.lit(1)).alias("our_pass_variants"), n(F.col("in_bed")).alias("our_in_bed"), n(~F.col("in_bed")).alias("our_outside_bed"))
    missed = only_ours(ours, compared).agg(F.count(F.lit(1)).alias("only_our_variants"))
    records = filtered if filtered is not None else ours.limit(0).select(F.lit("").alias("filter"))
    passed = F.array_contains(F.split("filter", ";"), "PASS")
    seen = records.agg(F.count(F.lit(1)).alias("filtered_total_records"), n(passed).alias("filtered_pass_records"))
    out = theirs
    for one in (mine, missed, seen):  # one row each
        out = out.crossJoin(F.broadcast(one))
    order = ["our_pass_variants", "other_report_variants", "shared_variants", "exact_shared_variants", "likely_shared_variants", "only_our_variants", "only_other_variants", "our_in_bed", "our_outside_bed", "gtf_approx_mapped", "gtf_approx_in_bed", "gtf_approx_outside_bed", "gtf_unresolved", "filtered_total_records", "filtered_pass_records", "external_detected_but_filtered", "external_inside_bed_not_emitted", "external_outside_bed", "external_unresolved"]
    return out.select(*order)


def gene_map(ours: DataFrame) -> DataFrame:
    """(A6, A7)"""
    return ours.groupBy("gene").agg(F.array_sort(F.collect_set("key")).alias("keys"), F.array_sort(F.collect_set("consequence")).alias("consequences"))


def best_transcripts(transcripts: DataFrame) -> DataFrame:
    """One per gene: canonical, MANE, primary, protein coding, longest coding sequence, first in the file."""
    has = lambda t: F.array_contains("tags", t)
    size = F.aggregate("cds", F.lit(0).cast("long"), lambda a, c: a + c["end"] - c["start"] + 1)
    order = [F.desc(has("Ensembl_canonical")), F.desc(has("MANE_Select")), F.desc(has("gencode_primary")), F.desc(has("type:protein_coding")), F.desc(size), F.col("ord")]
    return rel.best(transcripts, ["gene"], order)


_SNV = r"(?i)^c\.(\d+)([+-]\d+)?([ACGT])>([ACGT])$"
#: Values of gtf_mapping_status and gtf_reference_check (fixed values).
NOT_SUPPORTED, NO_TRANSCRIPT, TOO_SHORT, CHECKED, UNCHECKED = "不支持的HGVS写法", "GTF未找到编码转录本", "canonical CDS长度不足，无法映射", "近似映射成功", "近似映射需复核"
SAME, OTHER, NOT_LOOKED_UP = "通过", "不一致(FASTA={})", "未检查"


def reference_check(base: Column, ref: Column) -> Column:
    """Whether the genome has the base that a name says; "" where the genome is not at hand."""
    known = F.coalesce(F.upper(base), F.lit(""))
    return F.when(known == ref, SAME).when(known == "", NOT_LOOKED_UP).otherwise(_filled(OTHER, known))


def map_coding(names: DataFrame, transcripts: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """``names`` (gene, and hgvsc_other or hgvsc_norm) with gtf_chrom, gtf_pos, gtf_ref, gtf_alt, gtf_transcript, gtf_tags, gtf_reference_check, gtf_mapping_status and gtf_variant.

    A place in the coding sequence lies in the first exon, in transcript order, whose running length reaches it; introns'
    offsets count along the strand. ``chunks`` of the genome (``genome_chunks``) check the base. Columns are null where
    a name could not be mapped; gtf_mapping_status says why.
    """
    named = "hgvsc_other" if "hgvsc_other" in names.columns else "hgvsc_norm"
    best = best_transcripts(transcripts.where(F.size("cds") > 0)).select(F.col("gene").alias("_gene"), F.col("chrom").alias("_contig"), "strand", "cds", F.col("transcript").alias("_transcript"), (F.col("version") if "version" in transcripts.columns else F.lit("")).alias("_version"), F.col("tags").alias("_tags"))
    rows = names.join(best, F.trim("gene") == F.col("_gene"), "left")
    part = lambda i: F.upper(F.regexp_extract(F.trim(named), _SNV, i))
    at, offset = part(1).try_cast("long"), F.coalesce(part(2).try_cast("long"), F.lit(0))
    exons = F.when(F.col("strand") < 0, F.reverse(F.array_sort("cds"))).otherwise(F.array_sort("cds"))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("pos"))

    def step(s: Column, e: Column) -> Column:
        n = e["end"] - e["start"] + 1
        here = (at > s["sum"]) & (at <= s["sum"] + n)
        pos = F.when(F.col("strand") < 0, e["end"] - (at - s["sum"] - 1)).otherwise(e["start"] + at - s["sum"] - 1)
        return F.struct((s["sum"] + n).alias("sum"), F.coalesce(s["pos"], F.when(here, pos)).alias("pos"))

    pos = F.aggregate(exons, zero, step, lambda s: s["pos"]) + offset * F.col("strand")
    base = lambda i: F.when(F.col("strand") < 0, F.translate(part(i), "ACGT", "TGCA")).otherwise(part(i))
    rows = rows.withColumns({"_pos": F.when(part(1) != "", pos), "_ref": base(3), "_alt": base(4)})
    rows = with_base(rows, chunks, "_contig", "_pos", "_base") if chunks is not None else rows.withColumn("_base", F.lit(""))
    check = F.when(F.col("_pos").isNotNull(), reference_check(F.col("_base"), F.col("_ref")))
    status = F.when(F.coalesce(part(1), F.lit("")) == "", NOT_SUPPORTED).when(F.col("_gene").isNull(), NO_TRANSCRIPT).when(F.col("_pos").isNull(), TOO_SHORT).when(check == SAME, CHECKED).otherwise(UNCHECKED)
    ok = F.col("_pos").isNotNull() & F.col("_gene").isNotNull()
    chrom = bio.with_chr(F.col("_contig"))
    version = F.when(ok & (F.col("_version") != ""), F.concat(F.lit("."), "_version")).otherwise("")
    tags = F.array_join(F.array_sort(F.filter("_tags", lambda t: ~t.startswith("type:"))), ";")
    told = {"gtf_chrom": chrom, "gtf_pos": F.col("_pos"), "gtf_ref": F.col("_ref"), "gtf_alt": F.col("_alt")}
    transcript = F.when(status.isin(TOO_SHORT, CHECKED, UNCHECKED), F.concat("_transcript", version))
    variant = F.concat_ws(":", chrom, F.col("_pos").cast("string"), "_ref", "_alt")
    return rows.select(*[names[c] for c in names.columns], *[F.when(ok, v).alias(n) for n, v in told.items()], transcript.alias("gtf_transcript"), F.when(ok, tags).alias("gtf_tags"), check.alias("gtf_reference_check"), status.alias("gtf_mapping_status"), F.when(ok, variant).otherwise("").alias("gtf_variant"))
