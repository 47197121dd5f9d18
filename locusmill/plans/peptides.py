"""Plans over mutant proteins: peptides that are new, and their binding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields as fd
from locusmill.sources.readers import VariantFile


def lengths(text: str) -> list[int]:
    """"8,9" or "8-15" as sorted distinct numbers. (P20)"""
    out: set[int] = set()
    for part in text.split(","):
        a, _, b = part.strip().partition("-")
        out.update(range(int(a), int(b or a) + 1))
    return sorted(out)


def best_changes(vcf: VariantFile) -> DataFrame:
    """The best protein-changing annotation of each variant name: canonical, with transcript, with protein. (F5, W1d)"""
    rows = vcf.alleles()
    name = F.when(F.col("id").isin("", "."), F.concat_ws(":", "chrom", F.col("pos").cast("string"), F.concat("ref", F.lit(">"), "alt"))).otherwise(F.col("id"))
    rows = rows.select(name.alias("variant_id"), "chrom", "pos", "ref", "alt", "at", "i", F.element_at("info", "MUTANT_PROTEIN").alias("supplied"), F.posexplode("csq").alias("k", "e"))
    terms = F.split("e.Consequence", "&")
    rows = rows.withColumn("terms", terms).where(F.arrays_overlap("terms", F.array(*map(F.lit, bio.PROTEIN_CHANGING))))
    no = lambda c: F.when(c, 0).otherwise(1)
    order = [no(F.col("e.CANONICAL") == "YES"), no(F.col("e.Feature") != ""), no(F.col("e.ENSP") != ""), "at", "i", "k"]
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("variant_id").orderBy(*order))).where("n = 1").drop("n")


def mutant_proteins(changes: DataFrame, aliases: DataFrame, sample: str) -> DataFrame:
    """Each change with wild type and mutant protein, or the reason why there is none."""
    plain = lambda c: F.regexp_replace(c, r"\.\d+$", "")
    a, b = aliases.select(F.col("alias").alias("_p"), F.col("sequence").alias("_ps")), aliases.select(F.col("alias").alias("_t"), F.col("sequence").alias("_ts"))
    rows = changes.join(a, plain(F.col("e.ENSP")) == F.col("_p"), "left").join(b, plain(F.col("e.Feature")) == F.col("_t"), "left")
    rows = rows.withColumn("wildtype_protein", F.coalesce("_ps", "_ts")).withColumn("position", fd.first_int(F.col("e.Protein_position")).cast("int"))
    rows = rows.withColumn("m", bio.mutant_protein(F.col("supplied"), F.col("wildtype_protein"), F.col("terms"), F.col("position"), F.col("e.Amino_acids")))
    have = changes.schema["e"].dataType.fieldNames()
    gene = fd.first_non_empty(*[F.col(f"e.{f}") for f in ("SYMBOL", "Gene") if f in have])
    start, end = F.greatest(F.col("m.change_start"), F.lit(1)), F.greatest(F.col("m.change_end"), F.col("m.change_start"), F.lit(1))
    taken = F.length(F.replace(F.substring_index("e.Amino_acids", "/", 1), F.lit("-"), F.lit("")))
    wild_end = F.when(F.col("m.method") == "simple_inframe_deletion", F.col("position") + taken - 1).otherwise(F.col("position"))
    supplied = F.col("m.method") == "custom_mutant_protein"
    mutant = bio.split_protein(F.col("m.protein"), start, end)
    wild = bio.split_protein(F.when(F.col("m.protein").isNotNull() & ~supplied, F.col("wildtype_protein")), F.col("position"), F.greatest(wild_end, F.col("position")))
    parts = [F.coalesce(x[p], F.lit("")).alias(f"{n}_{p}") for n, x in (("wildtype", wild), ("mutant", mutant)) for p in ("prefix", "changed", "suffix")]
    return rows.select(F.lit(sample).alias("sample"), "variant_id", *[c for c in ("chrom", "pos", "ref", "alt") if c in changes.columns], gene.alias("gene"), F.col("e.Feature").alias("feature"), F.col("e.ENSP").alias("protein_id"), F.col("e.Consequence").alias("vep_consequence"), bio.event_type(F.col("terms")).alias("event_type"), F.col("e.HGVSc").alias("hgvsc"), F.col("e.HGVSp").alias("hgvsp"), F.col("e.Protein_position").alias("protein_position"), F.col("e.Amino_acids").alias("amino_acids"), F.col("m.method").alias("method"), "wildtype_protein", F.col("m.protein").alias("mutant_protein"), *parts, "position", F.col("m.change_start").alias("change_start"), F.col("m.change_end").alias("change_end"), F.col("m.reason").alias("reason"), "at")


def new_peptides(proteins: DataFrame, mers: list[int]) -> DataFrame:
    """Windows that hold all changed places, of standard residues, that the wild type does not hold."""
    rows = proteins.where(F.col("mutant_protein").isNotNull()).withColumn("mer", F.explode(F.array(*map(F.lit, mers))))
    first, last = F.greatest(F.lit(1), F.col("change_end") - F.col("mer") + 1), F.least(F.col("change_start"), F.length("mutant_protein") - F.col("mer") + 1)
    rows = rows.withColumn("lo", first).withColumn("hi", last).where("lo <= hi").withColumn("mutant_peptide_start", F.explode(F.sequence("lo", "hi")))
    rows = rows.withColumn("mutant_peptide", F.substring("mutant_protein", F.col("mutant_peptide_start"), F.col("mer"))).withColumn("mutant_peptide_end", F.col("mutant_peptide_start") + F.col("mer") - 1)
    rows = rows.where(F.col("mutant_peptide").rlike(f"^[{bio.STANDARD}]+$") & ~F.coalesce(F.contains("wildtype_protein", "mutant_peptide"), F.lit(False)))
    rows = rows.withColumn("wildtype_peptide", F.when(F.col("mutant_peptide_end") <= F.length("wildtype_protein"), F.substring("wildtype_protein", F.col("mutant_peptide_start"), F.col("mer"))).otherwise(""))
    place = F.row_number().over(Window.partitionBy("variant_id").orderBy("mer", "mutant_peptide_start"))
    rows = rows.withColumn("place", place)
    name = F.concat_ws("|", "sample", "variant_id", "gene", "feature", F.concat(F.col("mer").cast("string"), F.lit("mer")), F.concat_ws("-", F.col("mutant_peptide_start").cast("string"), F.col("mutant_peptide_end").cast("string")), F.concat(F.lit("p"), F.col("place").cast("string")))
    return rows.select("sample", name.alias("peptide_id"), "variant_id", "gene", "feature", "protein_id", "hgvsc", "hgvsp", "amino_acids", "mer", "mutant_peptide_start", "mutant_peptide_end", "wildtype_peptide", "mutant_peptide", "place")


def manifest(proteins: DataFrame, peptides: DataFrame, every: bool = False) -> DataFrame:
    """Each change with status; its last peptide, or every one."""
    last = peptides if every else peptides.withColumn("n", F.row_number().over(Window.partitionBy("variant_id").orderBy(F.desc("place")))).where("n = 1").drop("n")
    last = last.select("variant_id", "peptide_id", "mer", "mutant_peptide_start", "mutant_peptide_end", "wildtype_peptide", "mutant_peptide")
    status = F.when(F.col("mutant_protein").isNull(), "skipped").when(F.col("peptide_id").isNull(), "no_novel_peptide").otherwise("emitted")
    return proteins.join(last, "variant_id", "left").withColumn("status", status)


#: Columns of the three tables, in their order, and the reason for a change without new peptides (fixed values).
PROTEIN_TABLE = ("sample", "variant_id", "annovar_annotation", "vep_consequence", "gene", "feature", "protein_id", "hgvsc", "hgvsp", "protein_position", "amino_acids", "method", "status", "wildtype_protein", "mutant_protein", "wildtype_prefix", "wildtype_changed", "wildtype_suffix", "mutant_prefix", "mutant_changed", "mutant_suffix", "reason")
PEPTIDE_TABLE = ("sample", "peptide_id", "variant_id", "gene", "feature", "protein_id", "hgvsc", "hgvsp", "amino_acids", "mer", "mutant_peptide_start", "mutant_peptide_end", "wildtype_peptide", "mutant_peptide")
MANIFEST_TABLE = ("sample", "variant_id", "annovar_annotation", "gene", "feature", "protein_id", "consequence", "event_type", "protein_position", "amino_acids", "hgvsc", "hgvsp", "method", "status", "peptide_id", "mer", "mutant_peptide_start", "mutant_peptide_end", "wildtype_peptide", "mutant_peptide", "wildtype_protein", "mutant_protein", "mutant_prefix", "mutant_changed", "mutant_suffix", "reason")
NOTHING_NEW = "no_mutant_peptide_not_seen_in_wildtype_protein"


def _table(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns as text, "" for nothing and for columns that are not there; a change that was skipped tells why as its method, too."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    method = fd.first_non_empty(said("method"), said("reason"))
    return rows.select(*[(method if c == "method" else said(c)).alias(c) for c in columns])


def protein_table(proteins: DataFrame) -> DataFrame:
    """22 columns on each change."""
    status = F.when(F.col("mutant_protein").isNull(), "skipped").otherwise("reconstructed")
    return _table(proteins.withColumn("status", status), PROTEIN_TABLE)


def peptide_table(peptides: DataFrame) -> DataFrame:
    """14 columns on each new peptide. (K6)"""
    return _table(peptides, PEPTIDE_TABLE)


def manifest_table(listed: DataFrame) -> DataFrame:
    """26 columns on each row of ``manifest``. (K6, F16)"""
    reason = F.when(F.col("status") == "no_novel_peptide", NOTHING_NEW).otherwise(F.col("reason"))
    return _table(listed.withColumns({"consequence": F.col("vep_consequence"), "reason": reason}), MANIFEST_TABLE)


def peptide_counts(proteins: DataFrame, peptides: DataFrame) -> DataFrame:
    """One row: neoantigen_records and neoantigen_peptides."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return n(proteins, "neoantigen_records").crossJoin(F.broadcast(n(peptides, "neoantigen_peptides")))  # one row each


def simple_predictor(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("b", bio.mock_binding(F.col("peptide"), F.col("allele"))).select("*", "b.affinity_nm", "b.rank").drop("b")


#: Predictors by name: a function from (peptide_id, peptide, allele) to the same with affinity_nm and rank.
PREDICTORS: dict[str, Callable[[DataFrame], DataFrame]] = {"simple": simple_predictor}


def binding(peptides: DataFrame, alleles: list[str], tool: str = "auto", threshold: float = 500.0) -> DataFrame:
    """Every peptide with every allele of a short list."""
    if tool == "auto":
        tool = next((t for t in PREDICTORS if t != "simple"), "")
    if tool not in PREDICTORS:
        raise ValueError(f"no predictor {tool or 'besides simple, which must be asked for'}")
    pairs = peptides.select("peptide_id", F.col("mutant_peptide").alias("peptide"), F.explode(F.array(*map(F.lit, alleles))).alias("allele"))
    out = PREDICTORS[tool](pairs)
    return out.select("peptide_id", "peptide", "allele", F.lit(tool).alias("prediction_tool"), "affinity_nm", "rank", F.when(F.col("affinity_nm") <= threshold, "yes").otherwise("no").alias("binder"))
