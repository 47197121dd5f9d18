"""Variants beside what other files say of them: annotation tables with their own coordinates, and stored knowledge."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields as fd
from locusmill.sources.readers import VariantFile, tabular

#: Header names of annotation tables, and the fields that are told first (fixed values).
TABLE_KEYS = {"chrom": ("Chr", "CHROM", "chrom", "#CHROM"), "start": ("Start", "POS", "pos"), "ref": ("Ref", "REF", "ref"), "alt": ("Alt", "ALT", "alt")}
PREFERRED = ["Func.refGene", "Gene.refGene", "ExonicFunc.refGene", "AAChange.refGene", "Func.ensGene", "Gene.ensGene", "ExonicFunc.ensGene", "AAChange.ensGene"]
#: Buckets of a stored knowledge table.
BUCKETS = 64


def annovar_table(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, start, ref, alt, annotation``: a tab or comma table by place and alleles; the last row of a key counts.

    ``annotation`` names the preferred fields that are not empty, or all that are not, where none is preferred. Rows that lack a
    part of the key go; a table without such columns has no rows.
    """
    rows = tabular(spark, path)
    quoted = lambda c: F.col(f"`{c}`")
    filled = lambda names: fd.first_non_empty(*[quoted(n) for n in names if n in rows.columns]) if set(names) & set(rows.columns) else F.lit("")
    told = fd.key_values({c: quoted(c) for c in rows.columns}, PREFERRED)
    keyed = rows.select(*[filled(names).alias(k) for k, names in TABLE_KEYS.items()], told.alias("annotation"), F.monotonically_increasing_id().alias("at"))
    keyed = keyed.where("chrom <> '' and start <> '' and ref <> '' and alt <> ''")
    return keyed.groupBy(*TABLE_KEYS).agg(F.max_by("annotation", "at").alias("annotation"))


def table_alleles(pos: Column, ref: Column, alt: Column) -> Column:
    """Struct of start, ref and alt as annotation tables write them: without shared ends, "-" for nothing, insertions at the base before them."""
    p = fd.common_prefix(ref, alt)

    def cut(x: Column) -> Column:
        return F.substring(x, p + 1, F.length(x))

    s = fd.common_prefix(F.reverse(cut(ref)), F.reverse(cut(alt)))
    short = lambda x: F.left(cut(x), F.length(cut(x)) - s)
    r, a = short(ref), short(alt)
    start = pos + p - F.when(r == "", 1).otherwise(0)
    return F.struct(start.cast("long").alias("start"), F.when(r == "", "-").otherwise(r).alias("ref"), F.when(a == "", "-").otherwise(a).alias("alt"))


def with_annovar(variants: DataFrame, table: DataFrame) -> DataFrame:
    """``variants`` (chrom, pos, ref, alt) with annovar_annotation, "" where the table has nothing: by the alleles as they are, else as such tables write them."""
    side = lambda i: table.select(*[F.col(c).alias(f"_{c}{i}") for c in TABLE_KEYS], F.col("annotation").alias(f"_said{i}"))
    other = table_alleles(F.col("pos"), F.col("ref"), F.col("alt"))
    rows = variants.withColumn("_other", other)
    keys = ([F.col("chrom"), F.col("pos").cast("string"), F.col("ref"), F.col("alt")], [F.col("chrom"), F.col("_other.start").cast("string"), F.col("_other.ref"), F.col("_other.alt")])
    for i, key in enumerate(keys):
        on = F.lit(True)
        for mine, c in zip(key, TABLE_KEYS):
            on = on & (mine == F.col(f"_{c}{i}"))
        rows = rows.join(side(i), on, "left")
    said = F.coalesce("_said0", "_said1", F.lit(""))
    return rows.select(*[F.col(f"`{c}`") for c in variants.columns], said.alias("annovar_annotation"))


def _minimal(pos: Column, ref: Column, alt: Column) -> Column:
    return table_alleles(pos, F.upper(ref), F.upper(alt))


def store_knowledge(vcf: VariantFile, name: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """A variant file's ID and INFO ``keys`` as the table ``name``, bucketed and sorted by contig and minimal allele.

    A key with a value for each allele (Number=A in the header) gives each its own. The first record of an allele counts.
    """
    each = {m[1] for h in vcf.header if (m := re.match(r"##INFO=<ID=([^,]+),Number=A,", h))}
    value = lambda k: (fd.per_allele(F.element_at("info", k), F.col("i")) if k in each else F.element_at("info", k)).alias(k)
    rows = vcf.records().select("*", F.posexplode("alts").alias("i", "alt"))
    rows = rows.select(F.regexp_replace("chrom", "^chr", "").alias("contig"), _minimal(F.col("pos"), F.col("ref"), F.col("alt")).alias("m"), "at", "i", F.struct("id", *map(value, keys)).alias("said"))
    rows = rows.groupBy("contig", F.col("m.start").alias("start"), F.col("m.ref").alias("ref"), F.col("m.alt").alias("alt")).agg(F.min_by("said", F.struct("at", "i")).alias("said"))
    out = rows.select("contig", "start", "ref", "alt", "said.*")
    out.write.bucketBy(buckets, "contig", "start", "ref", "alt").sortBy("contig", "start").mode("overwrite").saveAsTable(name)


def annotate(variants: DataFrame, names: list[str]) -> DataFrame:
    """``variants`` (chrom, pos, ref, alt) with <name>_<column> of each stored table; null where it lacks the allele.

    The stored tables are read bucket by bucket and not shuffled again; only the variants are, once for all tables of as many buckets.
    """
    spark = variants.sparkSession
    mine = _minimal(F.col("pos"), F.col("ref"), F.col("alt"))
    rows = variants.withColumns({"_contig": F.regexp_replace("chrom", "^chr", ""), "_m": mine}).withColumns({"_start": F.col("_m.start"), "_ref": F.col("_m.ref"), "_alt": F.col("_m.alt")}).drop("_m")
    key = ["_contig", "_start", "_ref", "_alt"]
    for name in names:
        table = spark.table(name)
        label = name.rsplit(".", 1)[-1]
        told = [c for c in table.columns if c not in ("contig", "start", "ref", "alt")]
        side = table.select(*[F.col(c).alias(k) for c, k in zip(("contig", "start", "ref", "alt"), key)], *[F.col(c).alias(f"{label}_{c}") for c in told])
        rows = rows.join(side.hint("merge"), key, "left")
    return rows.drop(*key)


def report_rows(spark: SparkSession, path: str, aliases: dict[str, list[str]]) -> DataFrame:
    """``file, other_row`` and the aliased columns of tab-separated reports, one file or many, each by its own header.

    A file that is not UTF-8 throughout is read as GB18030. Missing columns and values are "". Reports are small: each is
    read whole by one task, and many files by many.
    """
    @F.pandas_udf("string")
    def other_text(contents: pd.Series) -> pd.Series:
        return contents.map(lambda raw: None if raw is None else raw.decode("gb18030", "replace"))

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    plain = F.col("content").cast("string")
    good = files.where(F.is_valid_utf8(plain)).select("file", plain.alias("text"))
    bad = files.where(~F.is_valid_utf8(plain)).select("file", other_text("content").alias("text"))
    lines = good.unionByName(bad).select("file", F.filter(F.split(F.regexp_replace("text", "^﻿", ""), "\r?\n", -1), lambda x: F.trim(x) != "").alias("lines"))
    plain_name = lambda x: F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]", "")
    head = F.transform(F.split(F.get("lines", F.lit(0)), "\t", -1), plain_name)
    rows = lines.select("file", head.alias("head"), F.posexplode(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).alias("at", "line"))
    cells = F.split("line", "\t", -1)

    def pick(target: str, names: list[str]) -> Column:
        known = ["".join(c for c in n.lower() if c.isalnum()) for n in [target, *names]]
        at = F.coalesce(*[F.nullif(F.array_position("head", F.lit(n)).cast("int"), F.lit(0)) for n in known])
        return F.coalesce(F.get(cells, at - 1), F.lit("")).alias(target)

    return rows.select("file", (F.col("at") + 1).cast("long").alias("other_row"), *[pick(t, names) for t, names in aliases.items()])


def normalised_report(rows: DataFrame) -> DataFrame:
    """``report_rows`` with trimmed genes and comparable names and fractions."""
    return rows.withColumns({"gene": F.trim("gene"), "hgvsc_norm": bio.cdna_name(F.col("hgvsc_other")), "hgvsp_norm": bio.protein_name(F.col("hgvsp_other")), "other_vaf_numeric": fd.percent(F.col("other_vaf"))})

