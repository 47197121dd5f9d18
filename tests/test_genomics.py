import pytest
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields as fd
from locusmill.operators import intervals as iv
from locusmill.operators import relational as rel
from locusmill.plans import comparison, evidence, peptides, reports, variants
from locusmill.plans.runner import Runner
from locusmill.sources import readers, writers
from locusmill.streaming.audits import audited

HEAD = """##fileformat=VCFv4.2
##INFO=<ID=CSQ,Number=.,Type=String,Description="Annotations. Format: Allele|Consequence|SYMBOL|Feature|HGVSc|HGVSp|CANONICAL|MANE_SELECT|MAX_AF">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tN1\tT1
"""
#: name, info, tumor, normal, filter, reasons
CASES = [
    ("A", "TLOD=9;CSQ=T|missense_variant|A|ENST1|c.1A>T|p.K1N|YES||", "0/1:30,9:0.23:39", "0/0:40,0:0:40", "PASS", ""),
    ("B", "TLOD=6.29;CSQ=T|missense_variant|B|ENST2|c.2A>T|p.K2N|YES||0.5", "0/1:30,9:0.23:39", "0/0:40,0:0:40", "PASS", "tlod;population_af"),
    ("C", "CSQ=T|intron_variant|C|ENST3|||YES||", "0/1:10,4:.:14", "0/0:15,3:0.2:15", "weak", "mutect_filter;tlod;tumor_dp;tumor_alt_reads;normal_dp;normal_alt_reads;normal_af"),
]


def vcf(spark, tmp_path):
    lines = [f"chr1\t{100 + 100 * i}\t.\tA\tT\t.\t{f}\t{info}\tGT:AD:AF:DP\t{n}\t{t}" for i, (_, info, t, n, f, _) in enumerate(CASES)]
    p = tmp_path / "a.vcf"
    p.write_text(HEAD + "\n".join(lines) + "\nchr1\t5\tshort\n")
    return readers.VariantFile(spark, str(p))


def test_filter_and_burden(spark, tmp_path):
    v = vcf(spark, tmp_path)
    rows = {r["gene"]: r for r in variants.manual_filter(v, "T1", "N1").collect()}
    assert {g: r["failure_reasons"] for g, r in rows.items()} == {c[0]: c[5] for c in CASES}
    assert rows["C"]["tumor_af"] == pytest.approx(4 / 14)
    with pytest.raises(ValueError):
        v.sample("X")
    (tmp_path / "r.bed").write_text("track x\nchr1\t90\t150\nchr1\t150\t190\nchr1\t7\t7\n")
    regions = iv.merge(readers.bed(spark, str(tmp_path / "r.bed"), strict=True), ["chrom"])
    assert [tuple(r) for r in regions.collect()] == [("chr1", 90, 190)]
    b = variants.burden_rows(v, "T1", "N1", regions)
    assert {r["pos"]: r["status"] for r in b.collect()} == {100: "accepted", 200: "rejected", 300: "rejected"}
    one = variants.burden(b, regions).first()
    assert one["covered_bp"] == 100 and one["per_mb"] == pytest.approx(10_000) and one["tier"] == "high"
    writers.filtered_vcf(v.header, variants.manual_filter(v, "T1", "N1").where("overall_pass"), "##limits", str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 5


def test_fields(spark):
    row = spark.sql("select 'a=1;b;a=2=3' info, 'GT:AD:AF' f, '0/1:3,4' s, '1.0d' bad, ' 2.5e1' good, 'CAGT' r, 'CAT' a").select(fd.info_map(F.col("info")).alias("m"), fd.format_map(F.col("f"), F.col("s")).alias("z"), fd.format_map(F.col("f"), F.col("s"), True).alias("p"), fd.number(F.col("bad")).alias("bad"), fd.number(F.col("good")).alias("good"), fd.minimal_allele(F.col("r"), F.col("a")).alias("min"), bio.cdna_name(F.lit("NM_1%3A c.12+3A%3EG")).alias("c"), bio.protein_name(F.lit("NP_1:p.Arg15Ter")).alias("prot"), bio.reverse_complement(F.lit("acgN")).alias("rc"), bio.query_index(F.lit("2S3M1I2D4M"), F.lit(10), F.lit(15)).alias("q"), bio.query_index(F.lit("2S3M1I2D4M"), F.lit(10), F.lit(13)).alias("gap"), bio.hla_binding(bio.hla_full(F.lit("A"), F.lit("HLA-A*02:01:01G"))).alias("hla")).first()
    assert row["m"] == {"a": "2=3", "b": "true"} and row["z"] == {"GT": "0/1", "AD": "3,4"} and row["p"]["AF"] == ""
    assert row["bad"] is None and row["good"] == 25 and row["min"] == "-" and row["c"] == "c.12+3A>G" and row["prot"] == "p.R15*"
    assert row["rc"] == "NCGT" and row["q"] == 6 and row["gap"] is None and row["hla"] == "HLA-A*02:01"


def test_nearest_and_contained(spark):
    points = spark.createDataFrame([(i, "a", p) for i, p in enumerate([0, 9, 10, 19, 20, 25, 31, 99, 1000])] + [(50, "b", 5)], "id int, k string, p int")
    merged = spark.createDataFrame([("a", 10, 20), ("a", 30, 31), ("a", 100, 150)], "k string, start int, end int")
    got = {r["id"]: (r["inside"], r["distance"]) for r in iv.nearest(points, merged, F.col("p"), F.col("p") + 1, {"k": "k"}, 16.0).collect()}
    for i, p in enumerate([0, 9, 10, 19, 20, 25, 31, 99, 1000]):
        sides = [(10, 20), (30, 31), (100, 150)]
        hit = any(p < e and p + 1 > s for s, e in sides)
        assert got[i] == (hit, 0.0 if hit else min(min(abs(p - e), abs(s - p - 1)) for s, e in sides))
    assert got[50] == (False, None)
    inside = iv.contained(points, merged, F.col("p"), {"k": "k"}, 16.0)
    assert sorted(r["p"] for r in inside.collect()) == [10, 19]
    both = iv.intersect(merged, spark.createDataFrame([("a", 15, 120)], "k string, start int, end int"), ["k"], 16.0)
    assert sorted((r["start"], r["end"]) for r in both.collect()) == [(15, 20), (30, 31), (100, 120)]


def test_peptides(spark):
    wild = "MPEPTIDEKLMNPQRSTVWY"
    rows = spark.createDataFrame([("v1", None, wild, ["missense_variant"], 5, "T/A"), ("v2", None, wild, ["stop_gained"], 4, "P/*"), ("v3", None, None, ["missense_variant"], 5, "T/A"), ("v4", None, wild, ["frameshift_variant"], 5, "T/X")], "v string, s string, w string, t array<string>, p int, c string")
    out = {r["v"]: r["m"] for r in rows.select("v", bio.mutant_protein(F.col("s"), F.col("w"), F.col("t"), F.col("p"), F.col("c")).alias("m")).collect()}
    assert out["v1"]["protein"] == "MPEPAIDEKLMNPQRSTVWY" and out["v2"]["protein"] == "MPE"
    assert out["v3"]["reason"] == "missing_wildtype_protein" and out["v4"]["reason"] == "frameshift_requires_mutant_protein_sequence"
    assert peptides.lengths("8-10,9") == [8, 9, 10]
    pairs = spark.createDataFrame([("p1", "MPEPAIDEK")], "peptide_id string, mutant_peptide string")
    assert peptides.binding(pairs, ["HLA-A*02:01"], "simple").first()["binder"] == "no"
    with pytest.raises(ValueError):
        peptides.binding(pairs, ["HLA-A*02:01"])


def test_comparison_and_mapping(spark):
    ours = spark.createDataFrame([("k1", "G", "c.1A>T", "p.K1N", 0.3), ("k2", "G", "c.2A>T", "p.K1N", 0.1), ("k3", "H", "c.9A>T", "", 0.2)], "key string, gene string, hgvsc string, hgvsp string, af double")
    other = spark.createDataFrame([("G", "c.1A>T", "p.K1N", 0.3), ("G", "c.7A>T", "p.K1N", 0.9), ("H", "c.8A>T", "", 0.21), ("H", "c.8A>T", "", 0.5), ("X", "", "", None)], "gene string, hgvsc_norm string, hgvsp_norm string, other_vaf_numeric double")
    c = comparison
    got = comparison.compare(ours, other).collect()
    assert sorted((r["gene"], r["match_method"], r["matched_key"]) for r in got) == sorted([("G", c.BY_BOTH, "k1"), ("G", c.BY_PROTEIN + c.SEVERAL, "k1"), ("H", c.NO_MATCH, ""), ("H", c.BY_SHARE.format("2.0%"), "k3"), ("X", c.NO_MATCH, "")])
    assert [r["key"] for r in comparison.only_ours(ours, comparison.compare(ours, other)).collect()] == ["k2"]
    transcripts = spark.createDataFrame([("G", "T1", 0, "chr1", 1, ["MANE_Select"], [(101, 110), (201, 210)]), ("R", "T2", 1, "chr2", -1, ["type:protein_coding"], [(101, 110), (201, 210)])], "gene string, transcript string, ord long, chrom string, strand int, tags array<string>, cds array<struct<start:long,end:long>>")
    names = spark.createDataFrame([("G", "c.12A>C"), ("R", "c.12A>C"), ("R", "c.10+2A>C"), ("G", "c.99A>C"), ("Q", "c.1A>C"), ("G", "c.1del")], "gene string, hgvsc_norm string")
    got = {(r["gene"], r["hgvsc_norm"]): (r["gtf_mapping_status"], r["gtf_pos"], r["gtf_ref"]) for r in comparison.map_coding(names, transcripts).collect()}
    done, short = comparison.UNCHECKED, comparison.TOO_SHORT
    assert got == {("G", "c.12A>C"): (done, 202, "A"), ("R", "c.12A>C"): (done, 109, "T"), ("R", "c.10+2A>C"): (done, 199, "T"), ("G", "c.99A>C"): (short, None, None), ("Q", "c.1A>C"): (comparison.NO_TRANSCRIPT, None, None), ("G", "c.1del"): (comparison.NOT_SUPPORTED, None, None)}


def test_reads_msi_hla_depth(spark, tmp_path):
    sam = ["@HD"] + [f"r{i}\t{flag}\tchr1\t{start}\t60\t{cigar}\t=\t1\t50\tACGTACGTAC\tIIIIIIIIII" for i, (flag, start, cigar) in enumerate([(99, 100, "10M"), (99, 98, "2S8M"), (1123, 100, "10M"), (4, 100, "10M")])]
    (tmp_path / "a.sam").write_text("\n".join(sam) + "\n")
    loci = spark.createDataFrame([("chr1", 102, "G", "A")], "chrom string, pos long, ref string, alt string")
    seen = evidence.observations(loci, readers.sam(spark, str(tmp_path / "a.sam")))
    assert sorted((r["qname"], r["base"]) for r in seen.collect()) == [("r0", "G"), ("r1", "G"), ("r2", "G")]
    e = evidence.evidence(seen).first()
    assert (e["raw_read_depth"], e["hq_fragment_depth"], e["hq_ref_fragments"], e["hq_alt_vaf"]) == (3, 2, 2, 0.0)
    (tmp_path / "m.tsv").write_text("Total_Number_of_Sites\tNumber_of_Unstable_Sites\t%\n5425\t3\t0.06\n")
    call = reports.msi_call(readers.text_metrics(spark, [str(tmp_path / "m.tsv")]), "s").first()
    assert (call["total_sites"], call["unstable_sites"], call["msi_status"]) == (5425, 3, "MSS") and 0.05 < call["msi_score_percent"] < 0.06
    (tmp_path / "h.txt").write_text("Locus\tChromosome\tAllele\nA\t1\tA*02:01:01G\nDRB1\t1\tDRB1*15:01\nB\t2\tNA\n")
    calls = reports.hla_calls(readers.tabular(spark, str(tmp_path / "h.txt")), "s")
    assert [r["binding_allele"] for r in calls.orderBy("at").collect()] == ["HLA-A*02:01", ""]
    bins = spark.createDataFrame([("chr1", 0, 10, "a", 10.0), ("chr1", 10, 30, "b", 40.0), ("chr1", 30, 30, "c", 0.0)], "chromosome string, start int, end int, region string, depth double")
    got = {r["region"]: (r["qc_flag"], r["log2_ratio"]) for r in reports.depth_qc(bins).collect()}
    assert got["a"][0] == "LOW" and got["b"][0] == "HIGH" and got["c"] == ("LOW", -10.0)


def test_runner_and_stream(spark, tmp_path):
    run = Runner(spark, str(tmp_path / "stages"), {"a": lambda s, r: s.range(3), "b": lambda s, r: r.result("a").where("id > 0")})
    assert run.run(dry=True) == ["a", "b"] and run.run(last="a") == ["a"] and run.status() == {"a": "done", "b": "open"}
    assert run.run() == ["b"] and run.result("b").count() == 2
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    q = audited(stream, [("small", F.col("id") < 3)]).writeStream.format("memory").queryName("audits").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("select * from audits where failure_reasons = 'small'").count() == 2


def test_orientation_goes_by_the_read_number(spark):
    flags = {0x40: "F1R2", 0x50: "F2R1", 0x80: "F2R1", 0x90: "F1R2", 0x1: "unpaired", 0x11: "unpaired", 0x63: "F1R2", 0xC1: "F1R2"}
    got = {r["f"]: r["o"] for r in spark.createDataFrame([(f,) for f in flags], "f long").select("f", bio.orientation(F.col("f")).alias("o")).collect()}
    assert got == flags


def test_mutant_proteins_of_every_case(spark):
    wild = "MKTAYIAK"
    cases = [  # supplied, wild, terms, place, change -> method, protein, reason, start, end
        (("mk*t", wild, "frameshift_variant", None, ""), ("custom_mutant_protein", "MKT", "", 1, 1)),
        ((None, "", "missense_variant", 2, "K/R"), ("", None, "missing_wildtype_protein", 2, 2)),
        ((None, wild, "missense_variant", 9, "K/R"), ("", None, "invalid_or_missing_protein_position", 9, 9)),
        ((None, wild, "stop_gained", 3, "T"), ("", None, "missing_amino_acid_change", 3, 3)),
        ((None, wild, "protein_altering_variant", 2, "KT/R"), ("simple_aa_substitution", "MRTAYIAK", "", 2, 2)),
        ((None, wild, "missense_variant", 2, "K/RR"), ("", None, "unsupported_missense_amino_acid_change", 2, 2)),
        ((None, wild, "inframe_insertion", 3, "-/GG"), ("simple_inframe_insertion", "MKGGTAYIAK", "", 3, 4)),
        ((None, wild, "inframe_insertion&stop_gained", 3, "T/*"), ("stop_gained_truncation", "MK", "", 2, 2)),
        ((None, wild, "inframe_deletion", 7, "AK/-"), ("simple_inframe_deletion", "MKTAYI", "", 6, 6)),
        ((None, wild, "inframe_deletion", 2, "-/-"), ("", None, "unsupported_inframe_deletion", 2, 2)),
        ((None, wild, "stop_gained", 1, "M/*"), ("stop_gained_truncation", "", "", 1, 1)),
        ((None, wild, "stop_lost", 8, "K/R"), ("", None, "stop_lost_requires_mutant_protein_sequence", 8, 8)),
        ((None, wild, "intron_variant", 8, "K/R"), ("", None, "unsupported_consequence", 8, 8)),
    ]
    rows = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, s string, w string, t string, p int, c string")
    out = bio.mutant_protein(F.col("s"), F.col("w"), F.split("t", "&"), F.col("p"), F.col("c"))
    got = {r["i"]: tuple(r["m"][k] for k in ("method", "protein", "reason", "change_start", "change_end")) for r in rows.select("i", out.alias("m")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]
    kind = {r["t"]: r["k"] for r in rows.select("t", bio.event_type(F.split("t", "&")).alias("k")).collect()}
    assert kind["protein_altering_variant"] == "missense" and kind["inframe_insertion&stop_gained"] == "stop_gained" and kind["intron_variant"] == "other"


def test_kmers_of_long_and_short_texts(spark):
    texts = ["", "abc", "abcd", "é😀x" * 200, "z" * 131, "z" * 132, "q" * 259, None]
    got = [r["k"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(rel.kmers(F.col("t"), 4).alias("k")).collect()]
    assert got == [[t[i : i + 4] for i in range(len(t) - 3)] if t else [] for t in texts]


def test_tables_of_filter_burden_and_comparison(spark, tmp_path):
    v = vcf(spark, tmp_path)
    rows = variants.manual_filter(v, "T1", "N1")
    table = variants.as_text(rows, variants.AUDIT)
    assert table.columns == list(variants.AUDIT) and len(table.columns) == 27
    got = {r["gene"]: r for r in table.collect()}
    assert (got["B"]["tlod"], got["B"]["tumor_af"], got["B"]["pass_tlod"], got["B"]["overall_pass"], got["B"]["max_population_af"]) == ("6.29", "0.23", "False", "False", "0.5")
    assert got["C"]["tlod"] == "" and got["C"]["tumor_af"] == "0.285714" and got["A"]["overall_pass"] == "True" and got["A"]["failure_reasons"] == ""
    burden = variants.as_text(variants.burden_rows(v, "T1", "N1"), variants.BURDEN)
    assert len(burden.columns) == 20 and {r["status"] for r in burden.collect()} == {"accepted", "rejected"}
    s = variants.filter_summary(rows, "T1", "N1").first()
    assert (s["input_variants"], s["passed_variants"], s["failed_variants"]) == (3, 1, 2) and s["failure_reason_counts"]["tlod"] == 2 and s["thresholds"]["min_tlod"] == 6.3
    details, notes = comparison.our_variants(v, "T1", "N1")
    mine = {r["gene"]: r for r in details.collect()}
    assert mine["B"]["key"] == "chr1:200:A:T" and (mine["B"]["hgvsc"], mine["B"]["tlod"], mine["B"]["tumor_alt_reads"], mine["B"]["all_consequences"]) == ("c.2A>T", 6.29, 9, "missense_variant")
    other = spark.createDataFrame([("b", "c.2A>T", "", 0.9), ("C", "c.x", "", 0.29), ("Q", "", "", None)], "gene string, hgvsc_norm string, hgvsp_norm string, other_vaf_numeric double")
    out = {r["gene"]: r for r in comparison.with_ours(comparison.compare(notes, other), details).collect()}
    assert (out["b"]["our_pos"], out["b"]["our_filter"], out["b"]["matched_variant_key"], out["b"]["same_gene_seen_in_our_vcf"]) == (200, "PASS", "chr1:200:A:T", "是")
    assert out["C"]["comparison_status"] == comparison.LIKELY and out["C"]["our_tumor_dp"] == 14 and out["Q"]["our_pos"] is None and out["Q"]["same_gene_seen_in_our_vcf"] == "否"
    details = comparison.filtered_details(v, "T1", "N1")
    traced = comparison.traced(spark.createDataFrame([("chr1:300:A:T", ""), ("", "chr1:100:A:T"), ("", "")], "matched_key string, gtf_variant string"), details)
    told = {(r["matched_key"], r["gtf_variant"]): (r["filtered_filter"], r["filtered_tumor_dp"]) for r in traced.collect()}
    assert told["chr1:300:A:T", ""] == ("weak", 14) and told["", "chr1:100:A:T"][0] == "PASS" and told["", ""] == ("", None)
