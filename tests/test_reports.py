"""Evidence, mapping and comparison tables against brute force and the documented cases."""

import re
import statistics
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.functions import fields
from locusmill.plans import comparison, evidence, reports
from locusmill.sources import readers

READS = "at long, qname string, flag long, chrom string, start long, mapq int, cigar string, seq string, quality string"


def pile(n=600, seed=2):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        cigar = str(r.choice(["40M", "5S35M", "20M2I18M", "15M3D25M", "10M30N30M", "40="]))
        length = sum(int(x) for x, k in re.findall(r"(\d+)([MIDNSHP=X])", cigar) if k in "MIS=X")
        quality = "*" if r.random() < 0.05 else "".join(chr(33 + int(q)) for q in r.choice([5, 12, 19, 20, 30, 37], length))
        flag = int(r.choice([0, 16, 0x41, 0x91, 0x441, 0x81, 0x1, 0x51]))
        rows.append((i, f"f{r.integers(0, n // 2)}", flag, str(r.choice(["chr1", "chr2"])), int(r.integers(80, 121)), int(r.choice([0, 29, 30, 60])), cigar, "".join(r.choice(list("ACGa"), length)), quality))
    return rows


def base_at(cigar, start, pos):
    ref, query = start, 0
    for n, kind in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        n = int(n)
        if kind in "M=X":
            if ref <= pos < ref + n:
                return query + pos - ref
            ref, query = ref + n, query + n
        elif kind in "DN":
            ref += n
        elif kind in "IS":
            query += n
    return None


def way(flag):
    if not flag & 0xC0:
        return "unpaired"
    return "F1R2" if bool(flag & 0x40) != bool(flag & 0x10) else "F2R1"


def brute_evidence(rows, chrom, pos, ref, alt):
    seen = []
    for at, name, flag, c, start, mapq, cigar, seq, quality in rows:
        i = base_at(cigar, start, pos) if c == chrom else None
        if i is not None and i < len(seq):
            seen.append({"at": at, "name": name, "flag": flag, "mapq": mapq, "base": seq[i].upper(), "bq": 0 if quality == "*" else ord(quality[i]) - 33, "start": start, "end": min(i, len(seq) - 1 - i), "clip": "S" in cigar, "indel": "I" in cigar or "D" in cigar})
    live = [s for s in seen if not s["flag"] & 0x400]
    good = [s for s in live if s["mapq"] >= 30 and s["bq"] >= 20]
    a, r = [s for s in seen if s["base"] == alt], [s for s in seen if s["base"] == ref]
    names = defaultdict(list)
    for s in good:
        names[s["name"]].append(s)
    whole = [max(g, key=lambda s: (s["bq"], s["mapq"], -s["at"])) for g in names.values() if len({s["base"] for s in g}) == 1]
    mine, ga = [s for s in whole if s["base"] == alt], [s for s in good if s["base"] == alt]
    starts = defaultdict(list)
    for s in live:
        if s["mapq"] >= 30 and s["bq"] >= 10:
            starts[s["start"]].append(s)
    cap = [s for g in starts.values() for s in sorted(g, key=lambda s: s["at"])[:5]]
    n = lambda some: len(list(some))
    values = [n(seen), n(r), n(a), n(s for s in a if s["mapq"] == 0), n(s for s in a if s["mapq"] < 30), n(s for s in a if s["bq"] < 20), n(s for s in a if s["clip"]), n(s for s in a if s["indel"]), n(s for s in a if s["clip"] or s["indel"]), n(s for s in r if s["clip"])]
    values += [n(live), n(good), n(s for s in good if s["base"] == ref), n(ga), n(s for s in good if s["base"] not in (ref, alt)), n(whole), n(s for s in whole if s["base"] == ref), n(mine), round(len(mine) / len(whole), 5) if whole else 0.0]
    values += [n(s for s in mine if not s["flag"] & 16), n(s for s in mine if s["flag"] & 16), n(s for s in mine if way(s["flag"]) == "F1R2"), n(s for s in mine if way(s["flag"]) == "F2R1"), n(s for s in mine if s["flag"] & 0x40), n(s for s in mine if s["flag"] & 0x80 and not s["flag"] & 0x40)]
    values += [round(statistics.mean(s["bq"] for s in ga), 2) if ga else 0, round(statistics.mean(s["mapq"] for s in ga), 2) if ga else 0, statistics.median(s["end"] for s in ga) if ga else 0, n(s for s in ga if s["clip"]), len({s["start"] for s in ga}), n(seen) - n(live), n(cap), n(s for s in cap if s["base"] == alt)]
    return dict(zip(evidence.METRICS, values, strict=True))


def test_evidence_has_all_metrics(spark):
    rows = pile()
    loci = [("chr1", p, "A", b, f"G{p}", "x") for p in (85, 100, 119, 130, 150) for b in "CG"] + [("chr2", 110, "C", "A", None, "y"), ("chr3", 5, "A", "C", "none", "z")]
    spots = spark.createDataFrame(loci, "chrom string, pos long, ref string, alt string, gene string, note string")
    reads = spark.createDataFrame(rows, READS).repartition(4)
    got = {(r["chrom"], r["pos"], r["alt"]): r for r in evidence.evidence(evidence.observations(spots, reads), spots).collect()}
    assert len(evidence.METRICS) == 33 and len(got) == len(loci)
    for chrom, pos, ref, alt, *_ in loci:
        r = got[chrom, pos, alt]
        assert {c: r[c] for c in evidence.METRICS} == brute_evidence(rows, chrom, pos, ref, alt)
    other = pile(300, 7)
    paired = evidence.paired_evidence(spots, evidence.observations(spots, reads), evidence.observations(spots, spark.createDataFrame(other, READS)))
    assert paired.columns == ["gene", "variant", *evidence.LOCUS, "note", *[f"{p}_{c}" for p in ("tumor", "normal") for c in evidence.METRICS], "preliminary_reason"]
    for r in paired.collect():
        assert {c: r[f"normal_{c}"] for c in evidence.METRICS} == brute_evidence(other, r["chrom"], r["pos"], r["ref"], r["alt"])
        assert r["gene"] is not None and r["variant"] == f"{r['chrom']}:{r['pos']}:{r['ref']}:{r['alt']}"


def test_judgements(spark):
    calm = dict.fromkeys(evidence.METRICS, 0) | {"hq_fragment_depth": 100, "alt_f1r2_fragments": 5, "alt_f2r1_fragments": 5, "alt_median_end_distance": 20.0, "hq_alt_vaf": 0.1, "hq_alt_fragments": 10, "raw_alt_reads": 10}
    some, ends = evidence.SOME_EVIDENCE, evidence.AT_ENDS
    cases = [
        ({}, {}, some),
        ({"hq_fragment_depth": 0, "raw_read_depth": 3, "raw_alt_reads": 2, "raw_alt_low_mapq_reads": 2}, {}, evidence.BADLY_MAPPED),
        ({"hq_fragment_depth": 0, "raw_alt_reads": 0}, {}, evidence.NO_DEPTH),
        ({"hq_alt_fragments": 0, "hq_alt_vaf": 0.0}, {}, evidence.NO_ALT),
        ({"hq_alt_fragments": 2, "hq_alt_vaf": 0.01235, "alt_f2r1_fragments": 0}, {}, f"肿瘤仅2个高质量ALT片段；肿瘤ALT VAF低({0.01235:.2%})"),
        ({"alt_f1r2_fragments": 0, "alt_median_end_distance": 5.0}, {}, f"{evidence.ONE_WAY}；{ends}"),
        ({"raw_alt_complex_cigar_reads": 4}, {"hq_alt_fragments": 2}, f"{evidence.COMPLEX}；{evidence.IN_NORMAL}"),
        ({"raw_alt_complex_cigar_reads": 3}, {"hq_alt_fragments": 1, "hq_alt_vaf": 0.02}, evidence.IN_NORMAL),
    ]
    quiet = dict.fromkeys(evidence.METRICS, 0)
    rows = [(i, *[float((calm | t)[c]) for c in evidence.METRICS], *[float((quiet | n)[c]) for c in evidence.METRICS]) for i, (t, n, _) in enumerate(cases)]
    schema = "i int, " + ", ".join(f"{p}_{c} double" for p in ("tumor", "normal") for c in evidence.METRICS)
    df = spark.createDataFrame(rows, schema).withColumn("tumor_hq_alt_fragments", F.col("tumor_hq_alt_fragments").cast("long"))
    got = {r["i"]: r["s"] for r in df.select("i", evidence.judgement().alias("s")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_rounding_is_exact(spark):
    values = [n / d for d in (3, 7, 32, 64, 320, 1600, 8000, 999) for n in range(0, d, max(1, d // 97))] + [2.675, 1.005, 0.003125, 59.995, 0.5]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", fields.rounded(F.col("v"), 5).alias("a"), fields.rounded(F.col("v"), 2).alias("b")).collect()
    assert [(r["v"], r["a"], r["b"]) for r in rows if (r["a"], r["b"]) != (round(r["v"], 5), round(r["v"], 2))] == []


def test_mapping_checks_the_reference(spark):
    transcripts = spark.createDataFrame([("G", "T1", "3", 0, "chr1", 1, ["b", "MANE_Select", "type:x"], [(11, 20)]), ("R", "T2", "", 1, "2", -1, ["a"], [(11, 20), (31, 40)]), ("E", "T3", "1", 2, "1", 1, ["a"], [])], "gene string, transcript string, version string, ord long, chrom string, strand int, tags array<string>, cds array<struct<start:long,end:long>>")
    chunks = readers.genome_chunks(spark.createDataFrame([("chr1 x", "A" * 12 + "C" * 30), ("2", "G" * 50)], "name string, sequence string"))
    names = [("G", "c.2a>t"), ("G ", "c.3A>T"), ("R", "c.1C>A"), ("R", "c.11-1C>A"), ("G", "c.11A>T"), ("E", "c.1A>T"), ("G", "c.1_2del"), ("", ""), ("R", None)]
    got = comparison.map_coding(spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "i int, gene string, hgvsc_other string"), transcripts, chunks).orderBy("i").collect()
    told = [(r["gtf_mapping_status"], r["gtf_reference_check"], r["gtf_variant"], r["gtf_transcript"], r["gtf_tags"]) for r in got]
    c = comparison
    assert told[0] == (c.CHECKED, c.SAME, "chr1:12:A:T", "T1.3", "MANE_Select;b")
    assert told[1] == (c.UNCHECKED, "不一致(FASTA=C)", "chr1:13:A:T", "T1.3", "MANE_Select;b")
    assert told[2] == (c.CHECKED, c.SAME, "chr2:40:G:T", "T2", "a")
    assert told[3] == (c.CHECKED, c.SAME, "chr2:21:G:T", "T2", "a")
    assert told[4] == (c.TOO_SHORT, None, "", "T1", None)
    assert told[5][0] == c.NO_TRANSCRIPT and [t[0] for t in told[6:]] == [c.NOT_SUPPORTED] * 3


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


@pytest.mark.parametrize("genes, size", [(4, 60), (40, 60), (1, 400)])
def test_comparison_by_brute_force(spark, genes, size):
    r = np.random.default_rng(genes + size)
    pick = lambda values: values[int(r.integers(len(values)))]
    gene = lambda: pick([f"g{r.integers(genes)}", f"G{r.integers(genes)}", f"G{r.integers(2 * genes)}", None])
    c, p = lambda: pick(["", None, *(f"c.{i}" for i in range(6))]), lambda: pick(["", "?", "p.?", None, *(f"p.{i}" for i in range(6))])
    af = {f"k{i}": float(r.integers(100)) / 100 for i in range(size // 2)}
    ours = [(k, gene(), c(), p(), af[k]) for k in map(lambda i: f"k{i}", r.integers(size // 2, size=size))]
    other = [(i, gene(), c(), p(), pick([None, float(r.integers(100)) / 100])) for i in range(300)]
    B, L, E, t = comparison.BOTH, comparison.LIKELY, comparison.EXTERNAL, comparison
    want = set()
    for i, g, hc, hp, share in other:
        same = [o for o in ours if o[1] and g and o[1].upper() == g.upper()]
        by_c, by_p = {o[0] for o in same if hc and o[2] == hc}, {o[0] for o in same if hp not in ("", "?", "p.?", None) and o[3] == hp}
        found = by_c & by_p or by_c or by_p
        how = (t.BY_BOTH if by_c & by_p else t.BY_CODING if by_c else t.BY_PROTEIN) + (t.SEVERAL if len(found) > 1 else "")
        keys = {o[0] for o in same}
        near = len(keys) == 1 and share is not None and abs(af[min(keys)] - share) <= 0.3
        told = (B, how, min(found)) if found else (L, t.BY_SHARE.format("30.0%"), min(keys)) if near else (E, t.NO_MATCH, "")
        want.add((i, *told, t.SEEN if same else t.UNSEEN))
    ours = spark.createDataFrame(ours, "key string, gene string, hgvsc string, hgvsp string, af double")
    other = spark.createDataFrame(other, "i int, gene string, hgvsc_norm string, hgvsp_norm string, other_vaf_numeric double")
    out = comparison.compare(ours, other, 0.3)
    names = ["comparison_status", "match_method", "matched_key", "gene_in_ours"]
    assert out.columns == other.columns + names
    assert sorted(map(tuple, out.select("i", *names).collect())) == sorted(want)
    # A name that many variants share must not send all of them along with every row that has it.
    joins = [n.schema().simpleString() for n in _nodes(out._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    assert joins and not [j for j in joins if "array" in j]


def test_status_diagnosis_and_counts(spark):
    merged = spark.createDataFrame([("chr1", 100, 200)], "chrom string, start long, end long")
    ours = spark.createDataFrame([("k1", True), ("k2", False), ("k3", True)], "key string, in_bed boolean")
    B, L, E = comparison.BOTH, comparison.LIKELY, comparison.EXTERNAL
    rows = [
        (1, B, "k1", "", "", "", "", "", "", "", "", ""),
        (2, L, "k2", "", "", "", "", "", "", "", "", ""),
        (3, E, "", "1", "150", "A", "", "", "", "", "", ""),
        (4, E, "", "chr1", "205", "AC", "", "", "", "", "", "PASS;x"),
        (5, E, "", "chr1", "201", "A", "", "", "", "", "", ""),
        (6, E, "", "", "", "", "chr1", "90", "AAA", "T1", "通过", ""),
        (7, E, "", "", "", "", "chr1", "101.0", "A", "T1", "未检查", ""),
        (8, E, "", "", "", "", "chr7", "5", "A", "T2", "通过", ""),
        (9, E, "", "", "", "", "", "", "", "", "", ""),
    ]
    schema = "i int, comparison_status string, matched_key string, chrom string, pos string, ref string, gtf_chrom string, gtf_pos string, gtf_ref string, gtf_transcript string, gtf_reference_check string, filtered_filter string"
    df = spark.createDataFrame(rows, schema).withColumn("gtf_mapping_status", F.when(F.col("i") == 9, comparison.TOO_SHORT).otherwise(""))
    out = comparison.with_bed_status(df, ours, merged)
    got = {r["i"]: (r["bed_status"], r["bed_explanation"]) for r in out.collect()}
    by_map = "Ensembl115 {} canonical/MANE近似映射，参考碱基{}"
    assert got == {
        1: ("BED内", comparison.BY_MATCH), 2: ("BED外", comparison.BY_MATCH), 3: ("BED内", comparison.BY_REPORT),
        4: ("BED外", comparison.BY_REPORT + "；距最近BED约4 bp"), 5: ("BED外", comparison.BY_REPORT),
        6: ("BED外（近似）", by_map.format("T1", "通过") + "；距最近BED约8 bp"), 7: ("BED内（近似）", by_map.format("T1", "未检查")),
        8: ("BED外（近似）", by_map.format("T2", "通过")), 9: ("无法判定", "Ensembl115 GTF: canonical CDS长度不足，无法映射"),
    }
    told = out.withColumn("difference_diagnosis", comparison.diagnosis(True))
    said = {r["i"]: r["difference_diagnosis"] for r in told.collect()}
    assert said == {1: comparison.PASSED, 2: comparison.PASSED, 3: comparison.NOT_CALLED, 4: "Mutect2已检出，但被过滤: PASS;x", 5: comparison.BEYOND, 6: comparison.BEYOND, 7: comparison.NOT_CALLED, 8: comparison.BEYOND, 9: comparison.NO_COORDINATE}
    assert {r["d"] for r in out.where("i in (3, 9)").select(comparison.diagnosis(False).alias("d")).collect()} == {comparison.NOT_TRACED}
    filtered = spark.createDataFrame([("PASS",), ("a;PASS",), ("b",)], "filter string")
    row = comparison.comparison_summary(told, ours, filtered).first().asDict()
    assert list(row.values()) == [3, 9, 2, 1, 1, 1, 7, 2, 1, 3, 2, 4, 4, 3, 2, 1, 2, 4, 1]


def test_reads_near_loci_by_all_they_cover(spark):
    rows = pile(200, 3)
    loci = spark.createDataFrame([("chr1", 140), ("chr2", 400)], "chrom string, pos long")
    got = {r["at"] for r in reports.sliced_reads(spark.createDataFrame(rows, READS), loci, 5).collect()}
    reach = lambda cigar: sum(int(n) for n, k in re.findall(r"(\d+)([MIDNSHP=X])", cigar) if k in "MDN=X")
    want = {r[0] for r in rows if any(r[3] == c and r[4] - 1 < p + 5 and r[4] - 1 + reach(r[6]) > p - 6 for c, p in (("chr1", 140), ("chr2", 400)))}
    assert got == want and want


def test_small_counts(spark):
    segments = spark.createDataFrame([("1",), ("2",), ("2",), ("3",), ("x",)], "CN string")
    assert tuple(reports.copy_number_counts(segments).first()) == (5, 1, 2, 1)
    calls = spark.createDataFrame([("A",), ("C",), ("DRB1",), ("MICA",)], "locus string")
    assert tuple(reports.hla_classes(calls).first()) == (2, 1, 1)


@pytest.mark.parametrize("total", [1.0, 0.5])
def test_mix_fractions(spark, total):
    got = reports.mix_fractions(spark.createDataFrame([(25.0,)], "ratio_a_percent double"), total).first()
    assert (got["actual_fraction_a"], got["actual_fraction_b"]) == (0.25 * total, 0.75 * total)


def lines_of(spark, **files):
    rows = [(name, i, line) for name, text in files.items() for i, line in enumerate(text.split("\n"), 1)]
    return spark.createDataFrame(rows, "file string, line int, value string")


def test_metric_texts(spark, tmp_path):
    picard = "## htsjdk\n# tool\n\n## METRICS CLASS\tx\nLIBRARY\tPAIRS\tPERCENT_DUPLICATION\nlib1\t10\t0.25\nlib2\t5\t\n\n## HISTOGRAM\nBIN\tVALUE\n1\t2"
    got = sorted(tuple(r) for r in readers.metrics_table(lines_of(spark, a=picard)).collect())
    assert got == [("a", 1, "LIBRARY", "lib1"), ("a", 1, "PAIRS", "10"), ("a", 1, "PERCENT_DUPLICATION", "0.25"), ("a", 2, "LIBRARY", "lib2"), ("a", 2, "PAIRS", "5"), ("a", 2, "PERCENT_DUPLICATION", "")]
    depth = readers.depth_summary(lines_of(spark, a="chrom\tlength\tbases\tmean\tmin\tmax\nchr1\t10\t20\t2.0\t0\t5\ntotal_region\t5\t6\t1.2\t1\t2\nx"))
    assert {r["chrom"]: r["mean"] for r in depth.collect()} == {"chr1": 2.0, "total_region": 1.2}
    said = readers.contamination(lines_of(spark, a="#x\ty\nsample\tcontamination\terror\ns1\t0.01\t0\ns2\t0.5\t0", b="none"))
    assert [tuple(r) for r in said.collect()] == [("a", "0.01")]
    flags = "10 + 0 in total\n9 + 0 mapped (90.00% : N/A)\n8 + 0 primary mapped (80.00% : N/A)\n6 + 0 properly paired (60.00% : N/A)"
    rates = {r["file"]: tuple(r)[1:] for r in readers.flagstat_rates(lines_of(spark, a=flags, b="nothing")).collect()}
    assert rates == {"a": ("90.00%", "60.00%"), "b": ("NA", "NA")}
    for name in ("s1_x.txt", "s1_call.tsv", "s1_summary.txt", "t_x.txt"):
        (tmp_path / name).write_text("msi: 5\n")
    assert readers.metric_files(spark, str(tmp_path), "s1").select("file").distinct().count() == 1


def test_files_without_annotations_or_records(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tT\tN\n"
    (tmp_path / "none.vcf").write_text(head)
    (tmp_path / "some.vcf").write_text(head + "chr1\t1\t.\tA\tT\t.\tPASS\tX\tDP\t1\t2\n")
    none, some = (readers.VariantFile(spark, str(tmp_path / n)) for n in ("none.vcf", "some.vcf"))
    assert none.alleles("T").count() == 0 and some.pair() == ("T", "N") and some.pair("N") == ("N", "N")
    with pytest.raises(ValueError, match="no CSQ"):
        some.alleles()
    with pytest.raises(ValueError, match="there are T, N"):
        some.pair("Q")
    (tmp_path / "x.bed").write_text("2\t5\t9\nchr1\t7\t8\nchr1\t3\t9\nbad\n")
    assert [tuple(r) for r in readers.bed(spark, str(tmp_path / "x.bed"), chr_prefix=True, ordered=True).collect()] == [("chr1", 3, 9), ("chr1", 7, 8), ("chr2", 5, 9)]


def test_tags_in_order_of_first_sight(spark):
    from locusmill.operators import relational as rel
    from locusmill.plans import variants

    rows = spark.createDataFrame([(3, "b;a"), (1, "z;y"), (2, "y;z;c")], "at int, filter string").repartition(3)
    assert [tuple(r) for r in variants.tag_counts(rows, 4).collect()] == [("z", 2), ("y", 2), ("c", 1), ("b", 1)]
    assert [tuple(r) for r in rel.tag_histogram(rows, F.split("filter", ";"), "tag", 2).collect()] == [("y", 2), ("z", 2)]
    assert [r["at"] for r in rel.first_rows(rows, [F.desc("at")], 2).collect()] == [3, 2]


def test_peptide_tables(spark):
    from locusmill.plans import peptides

    wild = "MKTAYIAKQRQISFVKSH"
    entry = "struct<SYMBOL:string,Gene:string,Feature:string,ENSP:string,Consequence:string,HGVSc:string,HGVSp:string,Protein_position:string,Amino_acids:string>"
    cases = [
        ("v1", "missense_variant", "5", "Y/W", None),
        ("v2", "inframe_insertion", "5", "-/WWW", None),
        ("v3", "inframe_deletion", "5", "YI/-", None),
        ("v4", "stop_gained", "6", "I/*", None),
        ("v5", "frameshift_variant", "6", "I/X", None),
        ("v6", "frameshift_variant", "2", "", "mwww*"),
    ]
    rows = [(v, "chr1", i, "A", "T", i, sup, term.split("&"), ("", "G", "T1.2", "P1.1", term, "c", "p", pos, aa)) for i, (v, term, pos, aa, sup) in enumerate(cases)]
    changes = spark.createDataFrame(rows, f"variant_id string, chrom string, pos long, ref string, alt string, at long, supplied string, terms array<string>, e {entry}")
    aliases = spark.createDataFrame([("P1", wild)], "alias string, sequence string")
    proteins = peptides.mutant_proteins(changes, aliases, "S")
    table = peptides.protein_table(proteins)
    assert tuple(table.columns) == peptides.PROTEIN_TABLE and len(table.columns) == 22
    got = {r["variant_id"]: r for r in table.collect()}
    parts = lambda r: [r[f"{n}_{p}"] for n in ("wildtype", "mutant") for p in ("prefix", "changed", "suffix")]
    assert parts(got["v1"]) == ["MKTA", "Y", "IAKQRQISFVKSH", "MKTA", "W", "IAKQRQISFVKSH"] and got["v1"]["gene"] == "G"
    assert parts(got["v2"]) == ["MKTA", "Y", "IAKQRQISFVKSH", "MKTA", "WWW", "YIAKQRQISFVKSH"]
    assert parts(got["v3"]) == ["MKTA", "YI", "AKQRQISFVKSH", "MKTA", "A", "KQRQISFVKSH"]
    assert parts(got["v4"]) == ["MKTAY", "I", "AKQRQISFVKSH", "MKTA", "Y", ""]
    assert parts(got["v5"]) == [""] * 6 and got["v5"]["method"] == got["v5"]["reason"] == "frameshift_requires_mutant_protein_sequence"
    assert parts(got["v6"]) == ["", "", "", "M", "W", "WW"] and got["v6"]["status"] == "reconstructed"
    found = peptides.new_peptides(proteins, [4, 8])
    assert tuple(peptides.peptide_table(found).columns) == peptides.PEPTIDE_TABLE and len(peptides.PEPTIDE_TABLE) == 14
    # Every window holds the whole change: three residues put in at 5 to 7.
    spans = sorted((r["mer"], r["mutant_peptide_start"], r["mutant_peptide"]) for r in found.where("variant_id = 'v2'").collect())
    mutant = wild[:4] + "WWW" + wild[4:]
    assert spans == [(m, s, mutant[s - 1 : s - 1 + m]) for m in (4, 8) for s in range(max(1, 7 - m + 1), 6) if mutant[s - 1 : s - 1 + m] not in wild]
    listed = peptides.manifest_table(peptides.manifest(proteins, found))
    assert tuple(listed.columns) == peptides.MANIFEST_TABLE and len(listed.columns) == 26
    status = {r["variant_id"]: (r["status"], r["reason"]) for r in listed.collect()}
    assert status["v4"] == ("no_novel_peptide", peptides.NOTHING_NEW) and status["v5"][0] == "skipped" and status["v1"] == ("emitted", "")
    assert tuple(peptides.peptide_counts(proteins, found).first()) == (6, found.count())
