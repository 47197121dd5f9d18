"""Sinks: filtered VCF, tables, summaries, FASTA, nested JSON and FASTQ, all written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filtered_vcf(header: list[str], passed: DataFrame, note: str, path: str) -> None:
    """Original lines in input order below their header, with a line on the thresholds before #CHROM. (K1)"""
    spark = passed.sparkSession
    top = [h for h in header if not h.startswith("#CHROM")] + [note] + [h for h in header if h.startswith("#CHROM")]
    head = spark.createDataFrame([(-1, i, h) for i, h in enumerate(top)], "part int, at long, value string")
    body = passed.select(F.lit(0).alias("part"), "at", F.col("raw_line").alias("value"))
    head.union(body).orderBy("part", "at").select("value").write.text(path)


def tsv(df: DataFrame, path: str) -> None:
    """Nulls become empty. (K2, K6, K7)"""
    df.write.csv(path, sep="\t", header=True, nullValue="", emptyValue="", quote="")


def summary_json(row: DataFrame, path: str) -> None:
    """(K3, K9)"""
    row.coalesce(1).write.json(path, ignoreNullFields=False)


def peptide_fasta(peptides: DataFrame, path: str, by_length: bool = False) -> None:
    """(K5)"""
    lines = peptides.select("mer", F.concat(F.lit(">"), "peptide_id", F.lit("\n"), "mutant_peptide").alias("value"))
    (lines.write.partitionBy("mer").text(path) if by_length else lines.select("value").write.text(path))


def fastq(reads: DataFrame, path: str) -> None:
    """(name, seq) with one constant quality."""
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), F.expr("repeat('I', length(seq))")).alias("value")).write.text(path)


def single_line(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct values in order of first sight, as one comma list."""
    first = df.where(F.coalesce(column, F.lit("")) != "").groupBy(column).agg(F.min(order).alias("o"))
    return first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", column))), lambda s: s[column]), ",").alias("value"))
