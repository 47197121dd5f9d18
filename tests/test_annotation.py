"""Annotation tables, stored knowledge and reports in several encodings."""

import pytest
from pyspark.sql import functions as F

from locusmill import bindings
from locusmill.plans import annotation, comparison
from locusmill.sources.readers import VariantFile


def test_annotation_tables_in_both_conventions(spark, tmp_path):
    head = "Chr\tStart\tEnd\tRef\tAlt\tFunc.refGene\tGene.refGene\tExtra"
    lines = ["chr1\t100\t100\tA\tT\texonic\tG1\t", "chr1\t200\t200\t-\tGG\tins\tG2\t", "chr1\t301\t302\tCT\t-\tdel\tG3\t", "chr1\t100\t100\tA\tT\tlast\tG9\t", "chr1\t\t1\tA\tC\tx\ty\t", "chr2\t5\t5\tC\tG\t\t\tother", "chr1\t400\t401\tACG\tTG\texact\tG5\t"]
    (tmp_path / "a.txt").write_text("\n".join([head, *lines]) + "\n")
    table = annotation.annovar_table(spark, str(tmp_path / "a.txt"))
    variants = spark.createDataFrame([(1, "chr1", 100, "A", "T"), (2, "chr1", 200, "A", "AGG"), (3, "chr1", 300, "ACT", "A"), (4, "chr2", 5, "C", "G"), (5, "chr2", 5, "C", "T"), (6, "chr1", 400, "ACG", "TG"), (7, "chr1", 99, "CAC", "CTC")], "id int, chrom string, pos long, ref string, alt string")
    got = {r["id"]: r["annovar_annotation"] for r in annotation.with_annovar(variants, table).collect()}
    assert got[1] == "Func.refGene=last;Gene.refGene=G9" and got[7] == got[1]
    assert got[2] == "Func.refGene=ins;Gene.refGene=G2" and got[3] == "Func.refGene=del;Gene.refGene=G3"
    assert got[4] == "Chr=chr2;Start=5;End=5;Ref=C;Alt=G;Extra=other" and got[5] == "" and got[6] == "Func.refGene=exact;Gene.refGene=G5"
    (tmp_path / "b.csv").write_text("CHROM,POS,REF,ALT,Gene.refGene\n1,7,A,C,G\n")
    assert annotation.annovar_table(spark, str(tmp_path / "b.csv")).first()["annotation"] == "Gene.refGene=G"
    (tmp_path / "c.txt").write_text("a\tb\n1\t2\n")
    assert annotation.annovar_table(spark, str(tmp_path / "c.txt")).count() == 0


@pytest.mark.parametrize(("pos", "ref", "alt", "want"), [(10, "A", "T", (10, "A", "T")), (10, "AT", "A", (11, "T", "-")), (10, "A", "ATT", (10, "-", "TT")), (10, "CAG", "CTG", (11, "A", "T")), (10, "TAA", "TA", (12, "A", "-")), (10, "AC", "GT", (10, "AC", "GT"))])
def test_alleles_as_tables_write_them(spark, pos, ref, alt, want):
    row = spark.createDataFrame([(pos, ref, alt)], "pos long, ref string, alt string")
    assert tuple(row.select(annotation.table_alleles(F.col("pos"), F.col("ref"), F.col("alt")).alias("x")).first()["x"]) == want


def knowledge(path, rows):
    head = ["##fileformat=VCFv4.2", '##INFO=<ID=AF,Number=A,Type=Float,Description="x">', '##INFO=<ID=CLNSIG,Number=.,Type=String,Description="x">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    path.write_text("\n".join(head + ["\t".join(map(str, r)) for r in rows]) + "\n")


def test_stored_knowledge_is_not_shuffled(spark, tmp_path):
    knowledge(tmp_path / "k.vcf", [("1", 100, "rs1", "A", "T,G", ".", ".", "AF=0.1,0.2;CLNSIG=p"), ("chr1", 200, "rs2", "CAT", "CT", ".", ".", "AF=0.3"), ("1", 100, "rs9", "A", "T", ".", ".", "AF=0.9"), ("2", 5, ".", "c", "cT", ".", ".", "CLNSIG=b")])
    knowledge(tmp_path / "l.vcf", [("1", 100, "cos1", "A", "G", ".", ".", "")])
    annotation.store_knowledge(VariantFile(spark, str(tmp_path / "k.vcf")), "known_one", ["AF", "CLNSIG"], 4)
    annotation.store_knowledge(VariantFile(spark, str(tmp_path / "l.vcf")), "known_two", [], 4)
    try:
        variants = spark.createDataFrame([(1, "chr1", 100, "A", "T"), (2, "chr1", 100, "A", "G"), (3, "chr1", 201, "AT", "T"), (4, "chr2", 5, "C", "CT"), (5, "chr3", 1, "A", "C")], "id int, chrom string, pos long, ref string, alt string")
        out = annotation.annotate(variants, ["known_one", "known_two"])
        got = {r["id"]: (r["known_one_id"], r["known_one_AF"], r["known_one_CLNSIG"], r["known_two_id"]) for r in out.collect()}
        assert got == {1: ("rs1", "0.1", "p", None), 2: ("rs1", "0.2", "p", "cos1"), 3: ("rs2", "0.3", None, None), 4: (".", None, "b", None), 5: (None, None, None, None)}
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        for part in plan.split("FileScan")[1:]:
            assert "SelectedBucketsCount" in part or "Bucketed: true" in part
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.sql("drop table known_one")
        spark.sql("drop table known_two")


def test_reports_in_several_encodings_and_headers(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.txt").write_bytes("基因\t核苷酸变异\t氨基酸变异\t丰度/拷贝数\r\nEGFR \tc.1A>T\tp.K1N\t12.5%\r\n\r\nKRAS\tc.2A>T\r\n".encode("gb18030"))
    (tmp_path / "r" / "b.txt").write_text("﻿SYMBOL\tVAF\tc.HGVS\nTP53\t3%\tc.9del\n", encoding="utf-8")
    (tmp_path / "r" / "c.txt").write_text("")
    rows = annotation.normalised_report(annotation.report_rows(spark, f"file://{tmp_path}/r", comparison.REPORT_ALIASES))
    got = sorted((r["file"][-5:], r["other_row"], r["gene"], r["hgvsc_norm"], r["hgvsp_norm"], r["other_vaf_numeric"], r["chrom"]) for r in rows.collect())
    assert got == [("a.txt", 1, "EGFR", "c.1A>T", "p.K1N", 0.125, ""), ("a.txt", 2, "KRAS", "c.2A>T", "", None, ""), ("b.txt", 1, "TP53", "c.9del", "", 0.03, "")]


def test_novel_kmers_of_ids_that_repeat(spark, tmp_path):
    text = "abcdefghijklm"
    rows = [(1, text), (1, text), (1, text + "n"), (2, text), (None, text), (None, text), (3, "known text")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("known text",)], "text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r["n_novel"] for r in bindings.QUERIES["novel_kmers"](spark, str(tmp_path)).collect()}
    assert got == {1: 6, 2: 5, None: 5}
