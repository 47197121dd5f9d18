"""Queries that apply the variant, read and report plans to records made of the driver's tables, each with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusmill.bindings import _CIGARS, Tables, query
from locusmill.functions import biology as bio
from locusmill.functions import fields
from locusmill.operators import intervals as iv
from locusmill.operators import ranges as rg
from locusmill.operators import relational as rel
from locusmill.plans import annotation, comparison, evidence, peptides, reports, variants
from locusmill.sources import writers


# ---------------------------------------------------------------- fields of records


@query("SELECT event_id, round(value / 7.0, 12) AS x, printf('%.6g', value / 7.0) AS six, printf('%.4g', value * 1000.0) AS four FROM events")
def shown_numbers(t):
    value = F.col("value")
    return t.events.select("event_id", F.round(value / 7.0, 12).alias("x"), fields.shown(value / 7.0, 6).alias("six"), fields.shown(value * 1000.0, 4).alias("four"))


@query("""SELECT p_partkey, CAST(p_size * 10 AS BIGINT) AS dp, CAST(p_size % 7 AS BIGINT) AS alt_reads, CASE WHEN p_partkey % 3 = 0 THEN (p_size % 7) / (p_size * 10.0) ELSE p_size / 100.0 END AS af,
p_size / 1000.0 AS second, 'true' AS flagged, 'last' AS repeated FROM part""")
def sample_fields(t):
    size = F.col("p_size")
    text = lambda c: c.cast("string")
    info = fields.info_map(F.concat(F.lit("TLOD=1,"), text(size / 1000.0), F.lit(";SOMATIC;k=first;k=last")))
    share = F.when(F.col("p_partkey") % 3 == 0, ".").otherwise(text(size / 100.0))
    sample = fields.format_map(F.lit("GT:DP:AD:AF"), F.concat_ws(":", F.lit("0/1"), text(size * 10), F.concat_ws(",", F.lit("9"), text(size % 7)), share))
    m = fields.sample_metrics(sample, F.lit(0))
    return t.part.select("p_partkey", m["dp"].alias("dp"), m["alt_reads"].alias("alt_reads"), m["af"].alias("af"), fields.number(fields.per_allele(F.element_at(info, "TLOD"), F.lit(1))).alias("second"), F.element_at(info, "SOMATIC").alias("flagged"), F.element_at(info, "k").alias("repeated"))


@query("SELECT p_partkey, 'c.' || p_partkey || 'A>' || ['C', 'G', 'T'][p_size % 3 + 1] AS c, 'p.' || ['K', 'A', 'W'][p_size % 3 + 1] || p_size || '*' AS p FROM part")
def coding_names(t):
    c = F.concat(F.lit("NM_1.2%3Ac."), F.col("p_partkey"), F.lit(" A > "), F.element_at(F.array(*map(F.lit, "CGT")), F.col("p_size") % 3 + 1))
    p = F.concat(F.lit("NP_1:p."), F.element_at(F.array(*map(F.lit, ("Lys", "Ala", "Trp"))), F.col("p_size") % 3 + 1), F.col("p_size"), F.lit("Ter"))
    return t.part.select("p_partkey", bio.cdna_name(c).alias("c"), bio.protein_name(p).alias("p"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 3 THEN 'DRB1' ELSE ['A', 'B', 'C'][s_suppkey % 4 + 1] END || '*' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || ':01:02' AS full_allele, CAST(3 AS BIGINT) AS fields,
CASE WHEN s_suppkey % 4 = 3 THEN '' ELSE 'HLA-' || ['A', 'B', 'C'][s_suppkey % 4 + 1] || '*' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || ':01' END AS binding_allele FROM supplier""")
def typed_alleles(t):
    locus = F.element_at(F.array(*map(F.lit, ("A", "B", "C", "DRB1"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    plain = F.concat(F.lpad(F.col("s_nationkey").cast("string"), 2, "0"), F.lit(":01:02G"))
    full = bio.hla_full(locus, F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("HLA-"), locus, F.lit("*"), plain)).otherwise(plain))
    return t.supplier.select("s_suppkey", full.alias("full_allele"), bio.hla_fields(full).cast("long").alias("fields"), bio.hla_binding(full).alias("binding_allele"))


# ---------------------------------------------------------------- records


def _records(t: Tables) -> DataFrame:
    """Variant records made of parts: every third is an insertion, every fifth lacks a quality."""
    kind = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("AT"))).otherwise(F.array(F.lit("T")))
    said = {"QD": F.col("p_size") / 10.0, "FS": F.col("p_retailprice") / 10.0, "ReadPosRankSum": -F.col("p_size") / 2.0, "MQ": F.when(F.col("p_partkey") % 5 == 0, None).otherwise(F.col("p_size") + 20.0)}
    pairs = [x for k, v in said.items() for x in (F.lit(k), v.cast("string"))]
    more = F.create_map(F.lit("SVTYPE"), F.when(F.col("p_size") % 4 == 0, "").otherwise(F.substring("p_brand", 1, 8)), F.lit("ANN"), F.concat(F.lit("T|"), F.replace("p_type", F.lit(" "), F.lit("_")), F.lit("|x,T|second|")))
    return t.part.select("p_partkey", F.lit("A").alias("ref"), kind.alias("alts"), F.map_concat(F.create_map(*pairs), more).alias("info"), F.replace("p_type", F.lit(" "), F.lit(";")).alias("filter"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'INDEL' ELSE 'SNP' END AS kind,
NOT (p_size / 10.0 < 2 OR p_retailprice / 10.0 > CASE WHEN p_partkey % 3 = 0 THEN 200 ELSE 60 END OR -p_size / 2.0 < CASE WHEN p_partkey % 3 = 0 THEN -20 ELSE -8 END OR (p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 AND p_size + 20 < 40)) AS hard_pass FROM part""")
def hard_filter(t):
    return variants.hard_filter(_records(t)).select("p_partkey", "kind", "hard_pass")


@query("SELECT substr(p_brand, 1, 8) AS svtype, count(*) AS n FROM part WHERE p_size % 4 <> 0 GROUP BY 1")
def structural_counts(t):
    return variants.structural_counts(_records(t))


@query("SELECT effect, count(*) AS n FROM (SELECT unnest([replace(p_type, ' ', '_'), 'second']) AS effect FROM part) GROUP BY effect ORDER BY n DESC, effect LIMIT 20")
def effect_counts(t):
    return variants.effect_counts(_records(t))


@query("SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS tag FROM part) GROUP BY tag ORDER BY n DESC, tag LIMIT 8")
def filter_tags(t):
    return variants.tag_counts(_records(t))


@query("SELECT count(*) AS total, count(*) FILTER (p_size % 5 < 2) AS loss, count(*) FILTER (p_size % 5 = 2) AS neutral, count(*) FILTER (p_size % 5 > 2) AS gain FROM part")
def copy_number_counts(t):
    return reports.copy_number_counts(t.part.select((F.col("p_size") % 5).cast("string").alias("CN")))


@query("SELECT count(*) FILTER (s_suppkey % 4 < 3) AS class_i, count(*) FILTER (s_suppkey % 4 = 3 AND s_nationkey < 12) AS class_ii, count(*) FILTER (s_suppkey % 4 = 3 AND s_nationkey >= 12) AS other FROM supplier")
def hla_classes(t):
    locus = F.when(F.col("s_suppkey") % 4 < 3, F.element_at(F.array(*map(F.lit, "ABC")), F.least(F.col("s_suppkey") % 4, F.lit(2)).cast("int") + 1)).when(F.col("s_nationkey") < 12, "DQB1").otherwise("MICA")
    return reports.hla_classes(t.supplier.select(locus.alias("locus")))


_ENTRIES = """SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k, l_partkey, l_linenumber,
CASE WHEN l_returnflag = 'R' THEN 'NM' WHEN l_returnflag = 'A' THEN '-' ELSE '' END AS mane, l_linestatus = 'F' AS canonical, l_quantity >= 25 AS counts FROM lineitem"""


@query(f"""WITH e AS ({_ENTRIES}), a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY mane IN ('', '-'), NOT canonical, k) AS r FROM e),
b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN mane NOT IN ('', '-') THEN 0 WHEN canonical THEN 1 ELSE 2 END, k) AS r FROM e WHERE counts),
c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY mane = '', NOT canonical, NOT counts, k) AS r FROM e)
SELECT a.l_orderkey, a.k AS for_filter, b.k AS for_burden, c.k AS for_report FROM a LEFT JOIN (SELECT * FROM b WHERE r = 1) b USING (l_orderkey) JOIN c USING (l_orderkey) WHERE a.r = 1 AND c.r = 1""")
def best_annotations(t):
    mane = F.when(F.col("l_returnflag") == "R", "NM").when(F.col("l_returnflag") == "A", "-").otherwise("")
    counts = F.col("l_quantity") >= 25
    entry = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", mane.alias("MANE_SELECT"), F.when(F.col("l_linestatus") == "F", "YES").otherwise("").alias("CANONICAL"), F.when(counts, "missense_variant&x").otherwise("intron_variant").alias("Consequence"), F.when(counts, "protein_coding").otherwise("other").alias("BIOTYPE"))
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(entry)).alias("entries"))  # an order's lines
    rows = rows.withColumn("entries", F.transform("entries", lambda e, i: F.struct(e["MANE_SELECT"].alias("MANE_SELECT"), e["CANONICAL"].alias("CANONICAL"), e["Consequence"].alias("Consequence"), e["BIOTYPE"].alias("BIOTYPE"), (i + 1).cast("long").alias("k"))))
    have = ["MANE_SELECT", "CANONICAL", "Consequence"]
    e = F.col("entries")
    return rows.select("l_orderkey", variants.best_for_filter(e, have)["k"].alias("for_filter"), variants.best_for_burden(e, have, bio.BURDEN_CONSEQUENCES)["k"].alias("for_burden"), variants.best_for_report(e, ["MANE_SELECT", "CANONICAL", "BIOTYPE"])["k"].alias("for_report"))


# ---------------------------------------------------------------- intervals and places


@query("""WITH a AS (SELECT p_partkey % 20 AS chrom, p_partkey AS s, p_partkey + p_size AS e FROM part), b AS (SELECT s_suppkey % 20 AS chrom, greatest(0, s_suppkey * 10 - 3) AS s, s_suppkey * 10 + 7 + 3 AS e FROM supplier)
SELECT a.chrom, CAST(greatest(a.s, b.s) AS BIGINT) AS start, CAST(least(a.e, b.e) AS BIGINT) AS "end" FROM a JOIN b ON a.chrom = b.chrom AND a.s < b.e AND b.s < a.e""")
def interval_intersection(t):
    a = t.part.select((F.col("p_partkey") % 20).alias("chrom"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end"))
    b = t.supplier.select((F.col("s_suppkey") % 20).alias("chrom"), (F.col("s_suppkey") * 10).alias("start"), (F.col("s_suppkey") * 10 + 7).alias("end"))
    out = iv.intersect(a, iv.padded(b, 3), ["chrom"], 16.0)
    return out.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


#: Two transcripts a gene, of two exons each; the longer one is canonical for every other gene.
_TRANSCRIPTS = """SELECT s_suppkey AS gene, k, CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE 1 END AS strand, s_suppkey * 100 + 11 + 5 * k AS a, s_suppkey * 100 + 20 + 5 * k AS b, s_suppkey * 100 + 41 AS c, s_suppkey * 100 + 44 + 3 * k AS d FROM supplier, range(0, 2) r(k)"""


@query(f"""WITH t AS ({_TRANSCRIPTS}), best AS (SELECT * FROM t WHERE k = CASE WHEN gene % 2 = 0 THEN 0 ELSE 1 END),
n AS (SELECT c_custkey, c_custkey % 40 + 1 AS gene, c_custkey % 23 + 1 AS place, c_custkey % 4 - 2 AS off FROM customer),
m AS (SELECT *, b - a + 1 AS n1, d - c + 1 AS n2 FROM n JOIN best USING (gene)),
p AS (SELECT *, CASE WHEN strand > 0 THEN CASE WHEN place <= n1 THEN a + place - 1 WHEN place <= n1 + n2 THEN c + place - n1 - 1 END ELSE CASE WHEN place <= n2 THEN d - place + 1 WHEN place <= n1 + n2 THEN b - (place - n2) + 1 END END + off * strand AS pos FROM m)
SELECT c_custkey, 'chr' || gene AS gtf_chrom, CAST(pos AS BIGINT) AS gtf_pos, CASE WHEN strand > 0 THEN 'A' ELSE 'T' END AS gtf_ref, CASE WHEN strand > 0 THEN 'C' ELSE 'G' END AS gtf_alt, '近似映射需复核' AS gtf_mapping_status FROM p WHERE pos IS NOT NULL
UNION ALL SELECT c_custkey, NULL, NULL, NULL, NULL, 'canonical CDS长度不足，无法映射' FROM p WHERE pos IS NULL
UNION ALL SELECT c_custkey, NULL, NULL, NULL, NULL, 'GTF未找到编码转录本' FROM n WHERE gene NOT IN (SELECT gene FROM best)""")
def coding_to_genome(t):
    gene = F.col("s_suppkey")
    rows = t.supplier.select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("k"))
    exon = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    k = F.col("k")
    cds = F.array(exon(gene * 100 + 11 + k * 5, gene * 100 + 20 + k * 5), exon(gene * 100 + 41, gene * 100 + 44 + k * 3))
    tags = F.when((gene % 2 == 0) & (k == 0), F.array(F.lit("Ensembl_canonical"))).otherwise(F.array(F.lit("basic")))
    transcripts = rows.select(gene.cast("string").alias("gene"), F.concat(F.lit("T"), k).alias("transcript"), k.cast("long").alias("ord"), gene.cast("string").alias("chrom"), F.when(gene % 3 == 0, -1).otherwise(1).alias("strand"), tags.alias("tags"), cds.alias("cds"))
    off = F.col("c_custkey") % 4 - 2
    name = F.concat(F.lit("c."), F.col("c_custkey") % 23 + 1, F.when(off == 0, "").otherwise(F.concat(F.when(off > 0, "+").otherwise(""), off)), F.lit("A>C"))
    names = t.customer.select("c_custkey", (F.col("c_custkey") % 40 + 1).cast("string").alias("gene"), name.alias("hgvsc_other"))
    return comparison.map_coding(names, transcripts).select("c_custkey", "gtf_chrom", "gtf_pos", "gtf_ref", "gtf_alt", "gtf_mapping_status")


@query("""SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 2 THEN p_size ELSE p_size + 1 END AS BIGINT) AS start, CASE p_partkey % 4 WHEN 0 THEN 'T' WHEN 1 THEN 'GG' WHEN 2 THEN '-' ELSE 'C' END AS ref, CASE p_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN '-' WHEN 2 THEN 'GA' ELSE 'A' END AS alt FROM part""")
def table_alleles(t):
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), (F.col("p_partkey") % 4 + 1).cast("int"))
    x = annotation.table_alleles(F.col("p_size"), pick("ATG", "AGG", "A", "TC"), pick("ACG", "A", "AGA", "TA"))
    return t.part.select("p_partkey", x["start"].alias("start"), x["ref"].alias("ref"), x["alt"].alias("alt"))


# ---------------------------------------------------------------- proteins


_WILD = "upper(regexp_replace(p_name || p_type, '[^A-Za-z]', '', 'g'))"


@query(f"""WITH w AS (SELECT p_partkey, {_WILD} AS wild, p_size % 12 + 1 AS pos FROM part),
m AS (SELECT *, CASE WHEN pos <= length(wild) THEN left(wild, pos - 1) || 'W' || substr(wild, pos + 1) END AS mutant FROM w),
p AS (SELECT p_partkey, mer, s, substr(mutant, s, mer) AS peptide, substr(wild, s, mer) AS wildtype FROM m, (SELECT unnest([8, 9]) AS mer), range(1, 13) r(s) WHERE mutant IS NOT NULL AND s >= pos - mer + 1 AND s <= pos AND s + mer - 1 <= length(mutant) AND NOT contains(wild, substr(mutant, s, mer)) AND regexp_full_match(substr(mutant, s, mer), '[ACDEFGHIKLMNPQRSTVWY]+'))
SELECT p_partkey, CAST(mer AS INTEGER) AS mer, CAST(s AS INTEGER) AS start, peptide, wildtype, row_number() OVER (PARTITION BY p_partkey ORDER BY mer, s) AS place FROM p""")
def new_peptides(t):
    wild = F.upper(F.regexp_replace(F.concat("p_name", "p_type"), "[^A-Za-z]", ""))
    rows = t.part.select("p_partkey", wild.alias("wild"), (F.col("p_size") % 12 + 1).cast("int").alias("position"))
    m = bio.mutant_protein(F.lit(None).cast("string"), F.col("wild"), F.array(F.lit("missense_variant")), F.col("position"), F.lit("X/W"))
    proteins = rows.withColumn("m", m).select(F.col("p_partkey").cast("string").alias("variant_id"), F.lit("s").alias("sample"), F.col("wild").alias("wildtype_protein"), F.col("m.protein").alias("mutant_protein"), F.col("m.change_start").alias("change_start"), F.col("m.change_end").alias("change_end"), *[F.lit("").alias(c) for c in ("gene", "feature", "protein_id", "hgvsc", "hgvsp", "amino_acids")])
    out = peptides.new_peptides(proteins, [8, 9])
    return out.select(F.col("variant_id").cast("long").alias("p_partkey"), "mer", F.col("mutant_peptide_start").cast("int").alias("start"), F.col("mutant_peptide").alias("peptide"), F.col("wildtype_peptide").alias("wildtype"), F.col("place").cast("long").alias("place"))


# ---------------------------------------------------------------- reads over loci


_SPOTS = "SELECT n_nationkey % 3 AS chrom, 1000 + n_nationkey * 2 AS pos FROM nation"
_SEEN = f"""SELECT l.chrom, l.pos, event_id AS id, event_id // 2 AS name, r.start, substr(repeat('ACGT', 20), CAST(event_id % 4 + 1 + l.pos - r.start + r.lead AS BIGINT), 1) AS base, 10 + event_id % 30 AS bq, event_id % 70 AS mapq, r.flag, r.clip, least(l.pos - r.start + r.lead, r.n - 1 - (l.pos - r.start + r.lead)) AS ends
FROM ({_SPOTS}) l JOIN (SELECT *, 1000 + CAST(floor(value) AS BIGINT) AS start, user_id % 3 AS chrom, [0, 5, 0, 0][event_id % 4 + 1] AS lead, [50, 45, 40, 47][event_id % 4 + 1] AS m, [50, 50, 50, 49][event_id % 4 + 1] AS n, event_id % 4 <> 0 AS clip,
CASE WHEN event_id // 2 % 5 = 0 THEN 0 WHEN event_id % 2 = 0 THEN 65 ELSE 129 END + CASE WHEN event_type = 'click' THEN 16 ELSE 0 END + CASE WHEN event_id % 11 = 0 THEN 1024 ELSE 0 END AS flag FROM events) r ON l.chrom = r.chrom AND l.pos >= r.start AND l.pos < r.start + r.m"""
_GOOD = "flag & 1024 = 0 AND mapq >= 30 AND bq >= 20"


@query(f"""WITH s AS ({_SEEN}), f AS (SELECT chrom, pos, name, min(base) AS base, arg_max(flag, bq * 1000000000000.0 + mapq * 1000000000.0 - id) AS flag FROM s WHERE {_GOOD} GROUP BY chrom, pos, name HAVING min(base) = max(base)),
g AS (SELECT chrom, pos, count(*) AS depth, count(*) FILTER (base = 'A') AS ref, count(*) FILTER (base = 'C') AS alt, count(*) FILTER (base = 'C' AND flag & 16 <> 0) AS rev, count(*) FILTER (base = 'C' AND flag & 192 <> 0 AND (flag & 64 <> 0) <> (flag & 16 <> 0)) AS f1r2, count(*) FILTER (base = 'C' AND flag & 128 <> 0) AS read2 FROM f GROUP BY chrom, pos),
c AS (SELECT chrom, pos, count(*) AS kept, count(*) FILTER (base = 'C') AS kept_alt FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos, start ORDER BY id) AS k FROM s WHERE flag & 1024 = 0 AND mapq >= 30 AND bq >= 10) WHERE k <= 5 GROUP BY chrom, pos),
r AS (SELECT chrom, pos, count(*) AS n, count(*) FILTER (base = 'C') AS n_alt, count(*) FILTER (base = 'C' AND mapq = 0) AS mapq0, count(*) FILTER (base = 'C' AND bq < 20) AS low_bq, count(*) FILTER (base = 'A' AND clip) AS ref_clip, count(*) FILTER ({_GOOD} AND base NOT IN ('A', 'C')) AS other, count(*) FILTER (flag & 1024 <> 0) AS dup,
coalesce(round(avg(mapq) FILTER ({_GOOD} AND base = 'C'), 2), 0) AS mean_mapq, coalesce(median(ends) FILTER ({_GOOD} AND base = 'C'), 0) AS mid, count(DISTINCT CASE WHEN {_GOOD} AND base = 'C' THEN start END) AS starts FROM s GROUP BY chrom, pos)
SELECT 'chr' || l.chrom AS chrom, CAST(l.pos AS BIGINT) AS pos, coalesce(n, 0) AS raw_read_depth, coalesce(n_alt, 0) AS raw_alt_reads, coalesce(mapq0, 0) AS raw_alt_mapq0_reads, coalesce(low_bq, 0) AS raw_alt_low_bq_reads, coalesce(ref_clip, 0) AS raw_ref_softclipped_reads, coalesce(other, 0) AS hq_other_reads, coalesce(dup, 0) AS duplicate_reads,
coalesce(depth, 0) AS hq_fragment_depth, coalesce(ref, 0) AS hq_ref_fragments, coalesce(alt, 0) AS hq_alt_fragments, coalesce(round(alt / depth, 5), 0.0) AS hq_alt_vaf, coalesce(rev, 0) AS alt_reverse_fragments, coalesce(f1r2, 0) AS alt_f1r2_fragments, coalesce(read2, 0) AS alt_read2_fragments,
coalesce(mean_mapq, 0) AS alt_mean_mapq, coalesce(mid, 0) AS alt_median_end_distance, coalesce(starts, 0) AS alt_unique_alignment_starts, coalesce(kept, 0) AS cap5_retained_reads_estimate, coalesce(kept_alt, 0) AS cap5_alt_reads_estimate
FROM ({_SPOTS}) l LEFT JOIN r USING (chrom, pos) LEFT JOIN g USING (chrom, pos) LEFT JOIN c USING (chrom, pos)""")
def read_evidence(t):
    loci = t.nation.select(F.concat(F.lit("chr"), F.col("n_nationkey") % 3).alias("chrom"), (F.lit(1000) + F.col("n_nationkey") * 2).cast("long").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    four = (F.col("event_id") % 4 + 1).cast("int")
    alone = F.floor(F.col("event_id") / 2) % 5 == 0
    flag = F.when(alone, 0).when(F.col("event_id") % 2 == 0, 65).otherwise(129) + F.when(F.col("event_type") == "click", 16).otherwise(0) + F.when(F.col("event_id") % 11 == 0, 1024).otherwise(0)
    length = F.element_at(F.array(*map(F.lit, (50, 50, 50, 49))), four)
    reads = t.events.select(F.col("event_id").alias("at"), F.concat(F.lit("q"), F.floor(F.col("event_id") / 2)).alias("qname"), flag.cast("long").alias("flag"), F.concat(F.lit("chr"), F.col("user_id") % 3).alias("chrom"), (F.lit(1000) + F.floor("value")).cast("long").alias("start"), (F.col("event_id") % 70).cast("int").alias("mapq"), F.element_at(F.array(*map(F.lit, _CIGARS)), four).alias("cigar"), F.substring(F.repeat(F.lit("ACGT"), F.lit(20)), four, length).alias("seq"), F.expr("repeat(char(43 + event_id % 30), 50)").alias("quality"))
    out = evidence.evidence(evidence.observations(loci, reads), loci)
    keep = ["raw_read_depth", "raw_alt_reads", "raw_alt_mapq0_reads", "raw_alt_low_bq_reads", "raw_ref_softclipped_reads", "hq_other_reads", "duplicate_reads", "hq_fragment_depth", "hq_ref_fragments", "hq_alt_fragments", "hq_alt_vaf", "alt_reverse_fragments", "alt_f1r2_fragments", "alt_read2_fragments", "alt_mean_mapq", "alt_median_end_distance", "alt_unique_alignment_starts", "cap5_retained_reads_estimate", "cap5_alt_reads_estimate"]
    return out.select("chrom", "pos", *keep)


@query("SELECT name, row_number() OVER (ORDER BY left(name, 9), CAST(substr(name, 10) AS BIGINT)) AS place FROM (SELECT 'Customer#' || c_custkey AS name FROM customer)")
def natural_order(t):
    names = t.customer.select(F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string")).alias("name"))
    return rg.placed(names.withColumn("key", rg.natural_key(F.col("name"))), [F.col("key")]).select("name", "place")


@query("SELECT c_nationkey, count(*) AS n, count(DISTINCT c_mktsegment) AS segments FROM customer WHERE c_acctbal >= 0 GROUP BY c_nationkey")
def gene_sets(t):
    rows = t.customer.where("c_acctbal >= 0").select(F.col("c_nationkey").alias("gene"), F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("consequence"))
    out = comparison.gene_map(rows)
    return out.select(F.col("gene").alias("c_nationkey"), F.size("keys").cast("long").alias("n"), F.size("consequences").cast("long").alias("segments"))


@query("""SELECT metric, value FROM (SELECT unnest(['total_sites', 'unstable_sites', 'percent']) AS metric, unnest([CAST((SELECT p_size FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part)) * 100 AS DOUBLE), (SELECT CAST(p_size AS DOUBLE) FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part)), 1.0]) AS value)""")
def msi_lines(t):
    at = F.col("p_partkey")
    said = F.when(at % 2 == 0, F.concat(F.lit("Total sites: "), F.col("p_size") * 100)).otherwise(F.concat(F.lit("total_sites="), F.col("p_size") * 100))
    lines = t.part.select(F.lit("a").alias("file"), (at * 2).alias("line"), said.alias("value")).unionByName(t.part.select(F.lit("a").alias("file"), (at * 2 + 1).alias("line"), F.concat(F.lit("unstable: "), F.col("p_size")).alias("value")))
    row = reports.msi_call(lines, "s").select(F.col("total_sites").cast("double").alias("total_sites"), F.col("unstable_sites").cast("double").alias("unstable_sites"), F.round("msi_score_percent", 6).alias("percent"))
    return row.unpivot([], row.columns, "metric", "value")


# ---------------------------------------------------------------- reports


@query("""WITH ours AS (SELECT 'k' || p_partkey AS key, 'G' || p_partkey % 300 AS gene, 'c.' || p_size AS c, 'p.' || p_size % 7 AS p, p_size / 100.0 AS af FROM part),
other AS (SELECT c_custkey, 'G' || c_custkey % 400 AS gene, 'c.' || c_custkey % 50 AS c, 'p.' || c_custkey % 7 AS p, c_custkey % 100 / 100.0 AS vaf FROM customer),
bc AS (SELECT gene, c, list(DISTINCT key) AS ks FROM ours GROUP BY 1, 2), bp AS (SELECT gene, p, list(DISTINCT key) AS ks FROM ours GROUP BY 1, 2), bg AS (SELECT gene, min(key) AS lo, max(key) AS hi, arg_min(af, key) AS af FROM ours GROUP BY 1),
f AS (SELECT o.*, coalesce(bc.ks, []) AS sc, coalesce(bp.ks, []) AS sp, list_intersect(coalesce(bc.ks, []), coalesce(bp.ks, [])) AS joint, lo, hi, bg.af FROM other o LEFT JOIN bc ON bc.gene = o.gene AND bc.c = o.c LEFT JOIN bp ON bp.gene = o.gene AND bp.p = o.p LEFT JOIN bg ON bg.gene = o.gene),
h AS (SELECT *, CASE WHEN len(joint) > 0 THEN joint WHEN len(sc) > 0 THEN sc ELSE sp END AS found, CASE WHEN len(joint) > 0 THEN '基因+cDNA+蛋白HGVS' WHEN len(sc) > 0 THEN '基因+cDNA HGVS' ELSE '基因+蛋白HGVS' END AS how, coalesce(lo = hi AND abs(af - vaf) <= 0.1, false) AS near FROM f)
SELECT c_custkey, CASE WHEN len(found) > 0 THEN '两流程共同检出' WHEN near THEN '疑似共同检出（转录本差异）' ELSE '仅外部流程检出' END AS comparison_status, CASE WHEN len(found) > 0 THEN how || CASE WHEN len(found) > 1 THEN '（多候选）' ELSE '' END WHEN near THEN '同基因唯一候选且AF差≤10.0%；HGVS转录本不同，需坐标确认' ELSE '未匹配' END AS match_method,
CASE WHEN len(found) > 0 THEN list_min(found) WHEN near THEN lo ELSE '' END AS matched_key, CASE WHEN lo IS NULL THEN '否' ELSE '是' END AS gene_in_ours, CASE WHEN len(found) > 0 OR near THEN '本流程PASS' ELSE '未提供filtered VCF，暂不能追踪' END AS difference_diagnosis FROM h""")
def report_comparison(t):
    said = lambda text, c: F.concat(F.lit(text), c)
    ours = t.part.select(said("k", F.col("p_partkey")).alias("key"), said("G", F.col("p_partkey") % 300).alias("gene"), said("c.", F.col("p_size")).alias("hgvsc"), said("p.", F.col("p_size") % 7).alias("hgvsp"), (F.col("p_size") / 100.0).alias("af"))
    k = F.col("c_custkey")
    other = t.customer.select("c_custkey", said("G", k % 400).alias("gene"), said("c.", k % 50).alias("hgvsc_norm"), said("p.", k % 7).alias("hgvsp_norm"), (k % 100 / 100.0).alias("other_vaf_numeric"))
    out = comparison.compare(ours, other, 0.1).withColumns({"bed_status": F.lit(""), "filtered_filter": F.lit("")})
    return out.select("c_custkey", "comparison_status", "match_method", "matched_key", "gene_in_ours", comparison.diagnosis(False).alias("difference_diagnosis"))


@query("""WITH r AS (SELECT CASE WHEN l_quantity >= 10 THEN 'accepted' ELSE 'rejected' END AS status FROM lineitem), d AS (SELECT DISTINCT s_nationkey AS c, unnest(range(s_suppkey * 50, s_suppkey * 50 + 40 + s_suppkey % 30)) AS p FROM supplier)
SELECT count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'rejected') AS rejected, (SELECT count(*) FROM d) AS covered_bp, round(count(*) FILTER (status = 'accepted') / ((SELECT count(*) FROM d) / 1000000.0), 3) AS per_mb,
CASE WHEN count(*) FILTER (status = 'accepted') / ((SELECT count(*) FROM d) / 1000000.0) >= 10 THEN 'high' ELSE 'other' END AS tier FROM r""")
def accepted_burden(t):
    rows = t.lineitem.select(F.when(F.col("l_quantity") >= 10, "accepted").otherwise("rejected").alias("status"))
    at = F.col("s_suppkey")
    regions = iv.merge(t.supplier.select(F.col("s_nationkey").alias("chrom"), (at * 50).alias("start"), (at * 50 + 40 + at % 30).alias("end")), ["chrom"])
    out = variants.burden(rows, regions)
    return out.select("accepted", "rejected", "covered_bp", F.round("per_mb", 3).alias("per_mb"), F.when(F.col("tier") == "high", "high").otherwise("other").alias("tier"))


@query("""SELECT p_partkey, CAST(p_size AS BIGINT) AS first_int, p_size / 100.0 AS share, regexp_replace(p_name, '[^A-Za-z0-9_.-]', '_', 'g') AS label, '&lt;' || p_brand || '&gt;' AS shown, CASE WHEN p_size % 2 = 0 THEN 'Gene=' || p_brand ELSE 'Other=' || p_type || ';Place=' || p_size END AS told,
CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS filled, 'chr' || p_size AS chrom FROM part""")
def text_fields(t):
    even = F.col("p_size") % 2 == 0
    size = F.col("p_size").cast("string")
    told = fields.key_values({"Other": F.when(~even, F.col("p_type")).otherwise(""), "Gene": F.when(even, F.col("p_brand")).otherwise(""), "Place": F.when(~even, size).otherwise("")}, ["Gene"])
    return t.part.select("p_partkey", fields.first_int(F.concat(F.lit("at "), size, F.lit("-9"))).alias("first_int"), fields.percent(F.concat(F.lit(" "), size, F.lit("%"))).alias("share"), fields.safe_label(F.col("p_name")).alias("label"), fields.html_escape(F.concat(F.lit("<"), "p_brand", F.lit(">"))).alias("shown"), told.alias("told"), fields.first_non_empty(F.when(even, F.col("p_brand")).otherwise(""), F.col("p_type")).alias("filled"), bio.with_chr(F.when(even, F.concat(F.lit("chr"), size)).otherwise(size)).alias("chrom"))


@query("SELECT string_agg(p_brand, ',' ORDER BY first) AS value FROM (SELECT p_brand, min(p_partkey) AS first FROM part GROUP BY p_brand)")
def brands_line(t):
    return writers.single_line(t.part.select("p_brand", "p_partkey"), "p_brand", "p_partkey")


@query("""WITH o AS (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS k, min(o_totalprice) AS v FROM orders GROUP BY o_custkey)
SELECT c_custkey, k AS match_key FROM customer JOIN o ON c_custkey = o_custkey WHERE n = 1 AND abs(c_acctbal - v) <= 200000
UNION ALL SELECT p_partkey + 1000000000, s_suppkey FROM part JOIN (SELECT s_suppkey % 7919 AS g, count(*) AS n, min(s_suppkey) AS s_suppkey, min(s_acctbal) AS v FROM supplier GROUP BY 1) s ON p_partkey % 7919 = g WHERE n = 1 AND abs(p_retailprice - v) <= 2000""")
def unique_matches(t):
    one = rel.unique_band_match(t.customer, t.orders, F.col("c_custkey"), F.col("o_custkey"), F.col("c_acctbal"), F.col("o_totalprice"), 200000, F.col("o_orderkey"))
    two = rel.unique_band_match(t.part, t.supplier, F.col("p_partkey") % 7919, F.col("s_suppkey") % 7919, F.col("p_retailprice"), F.col("s_acctbal"), 2000, F.col("s_suppkey"))
    return one.select("c_custkey", "match_key").unionByName(two.select((F.col("p_partkey") + 1000000000).alias("c_custkey"), "match_key"))


@query("""WITH r AS (SELECT s_nationkey AS chrom, s_suppkey * 50 AS s, s_suppkey * 50 + 20 AS e FROM supplier), p AS (SELECT c_custkey, c_nationkey AS chrom, c_custkey * 3 AS pos, c_custkey % 4 AS n FROM customer),
d AS (SELECT c_custkey, min(CASE WHEN pos - 1 < e AND pos - 1 + greatest(1, n) > s THEN 0 ELSE least(abs(pos - 1 - e), abs(s - (pos - 1 + greatest(1, n)))) END) AS distance, bool_or(pos - 1 < e AND pos - 1 + greatest(1, n) > s) AS inside FROM p JOIN r USING (chrom) GROUP BY c_custkey)
SELECT c_custkey, coalesce(inside, false) AS inside, CAST(distance AS DOUBLE) AS distance FROM p LEFT JOIN d USING (c_custkey)""")
def region_distance(t):
    merged = iv.merge(t.supplier.select(F.col("s_nationkey").alias("chrom"), (F.col("s_suppkey") * 50).alias("start"), (F.col("s_suppkey") * 50 + 20).alias("end")), ["chrom"])
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("chrom"), (F.col("c_custkey") * 3).alias("pos"), F.expr("repeat('A', int(c_custkey % 4))").alias("ref"))
    return comparison.in_regions(rows, merged).select("c_custkey", "inside", "distance")
