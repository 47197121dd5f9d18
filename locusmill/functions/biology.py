"""Column functions over sequences, HGVS names, alleles, reads and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Three-letter to one-letter amino acids (fixed values).
AMINO_ACIDS = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V",
    "Ter": "*", "Stop": "*", "Sec": "U",
}
#: Consequences that can change a protein (fixed values).
PROTEIN_CHANGING = ("missense_variant", "protein_altering_variant", "stop_gained", "stop_lost", "start_lost", "frameshift_variant", "inframe_insertion", "inframe_deletion")
#: Consequences that count for mutation burden (fixed values).
BURDEN_CONSEQUENCES = ("missense_variant", "stop_gained", "stop_lost", "start_lost", "frameshift_variant", "inframe_insertion", "inframe_deletion", "splice_acceptor_variant", "splice_donor_variant", "protein_altering_variant")
STANDARD = "ACDEFGHIKLMNPQRSTVWY"


def with_chr(chrom: Column) -> Column:
    """(P11)"""
    return F.when(chrom.startswith("chr"), chrom).otherwise(F.concat(F.lit("chr"), chrom))


def _decoded(text: Column) -> Column:
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(plain), F.coalesce(text, F.lit("")))


def cdna_name(text: Column) -> Column:
    """The c. or n. part of an HGVS name without spaces."""
    tail = F.replace(F.substring_index(_decoded(text), ":", -1), F.lit(" "), F.lit(""))
    found = F.regexp_extract(tail, r"([cn]\..+)", 1)
    return F.when(found != "", found).otherwise(tail)


def protein_name(text: Column) -> Column:
    """The p. part of an HGVS name with one-letter amino acids."""
    tail = F.replace(F.substring_index(_decoded(text), ":", -1), F.lit(" "), F.lit(""))
    found = F.regexp_extract(tail, r"(p\..+)", 1)
    tail = F.when(found != "", found).otherwise(tail)
    return reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), AMINO_ACIDS.items(), tail)


def reverse_complement(sequence: Column) -> Column:
    """(P34)"""
    return F.translate(F.reverse(F.upper(sequence)), "ACGT", "TGCA")


def split_protein(sequence: Column, start: Column, end: Column) -> Column:
    """Prefix, changed part and suffix for 1-based closed places."""
    return F.struct(F.left(sequence, start - 1).alias("prefix"), F.substring(sequence, start, end - start + 1).alias("changed"), F.substring(sequence, end + 1, F.length(sequence)).alias("suffix"))


def event_type(terms: Column) -> Column:
    """Kind of change by precedence of its consequence terms."""
    out = F.lit("other")
    order = (("missense_variant", "missense"), ("protein_altering_variant", "missense"), ("stop_gained", "stop_gained"), ("stop_lost", "stop_lost"), ("start_lost", "start_lost"), ("frameshift_variant", "frameshift"), ("inframe_insertion", "inframe_insertion"), ("inframe_deletion", "inframe_deletion"))
    for term, name in reversed(order):
        out = F.when(F.array_contains(terms, term), name).otherwise(out)
    return out


def mutant_protein(supplied: Column, wild: Column, terms: Column, position: Column, change: Column) -> Column:
    """Struct of method, protein (null where there is none), reason and the changed places.

    ``change`` is REF/ALT in amino acids. Cases in order: a supplied protein (without stops, in capitals), no wild type, no
    valid place, no change, one substituted residue, residues put in before the place, residues taken out, a stop; the rest
    needs a sequence.
    """
    ref = F.replace(F.substring_index(change, "/", 1), F.lit("-"), F.lit(""))
    alt = F.replace(F.substring(change, F.locate("/", change) + 1, F.length(change)), F.lit("*"), F.lit(""))
    n = F.length(wild)

    def case(method: str, protein, reason: str = "", cs=None, ce=None) -> Column:
        text = protein if isinstance(protein, Column) else F.lit(protein).cast("string")
        return F.struct(F.lit(method).alias("method"), text.alias("protein"), F.lit(reason).alias("reason"), (position if cs is None else cs).cast("int").alias("change_start"), (position if ce is None else ce).cast("int").alias("change_end"))

    fail = lambda why: case("", None, why)
    has = lambda term: F.array_contains(terms, term)
    one = alt.rlike(f"^[{STANDARD}]$")
    substituted = has("missense_variant") | has("protein_altering_variant")
    head, tail = F.left(wild, position - 1), lambda k: F.substring(wild, position + k, n)
    inside = lambda length: F.least(position, F.greatest(length, F.lit(1)))
    first, short = F.coalesce(position, F.lit(1)), n - F.least(F.length(ref), n - position + 1)
    rules = [
        (F.coalesce(supplied, F.lit("")) != "", case("custom_mutant_protein", F.upper(F.replace(supplied, F.lit("*"), F.lit(""))), cs=first, ce=first)),
        (F.coalesce(wild, F.lit("")) == "", fail("missing_wildtype_protein")),
        (position.isNull() | (position < 1) | (position > n), fail("invalid_or_missing_protein_position")),
        (~F.coalesce(change, F.lit("")).contains("/"), fail("missing_amino_acid_change")),
        (substituted & one, case("simple_aa_substitution", F.concat(head, alt, tail(F.lit(1))))),
        (substituted, fail("unsupported_missense_amino_acid_change")),
        (has("inframe_insertion") & (alt != ""), case("simple_inframe_insertion", F.concat(head, alt, tail(F.lit(0))), ce=position + F.length(alt) - 1)),
        (has("inframe_deletion") & (ref != ""), case("simple_inframe_deletion", F.concat(head, tail(F.length(ref))), cs=inside(short), ce=inside(short))),
        (has("inframe_deletion"), fail("unsupported_inframe_deletion")),
        (has("stop_gained"), case("stop_gained_truncation", head, cs=inside(position - 1), ce=inside(position - 1))),
        (has("stop_lost"), fail("stop_lost_requires_mutant_protein_sequence")),
        (has("start_lost"), fail("start_lost_requires_alternative_start_model")),
        (has("frameshift_variant"), fail("frameshift_requires_mutant_protein_sequence")),
    ]
    out = F.when(*rules[0])
    for condition, value in rules[1:]:
        out = out.when(F.coalesce(condition, F.lit(False)), value)
    return out.otherwise(fail("unsupported_consequence"))


def mock_binding(peptide: Column, allele: Column) -> Column:
    """Struct of affinity_nm and rank: a deterministic stand-in for a binding predictor."""
    n = F.length(peptide)
    count = lambda letters: n - F.length(F.regexp_replace(peptide, f"[{letters}]", ""))
    seed = F.aggregate(F.filter(F.split(allele, ""), lambda c: c != ""), F.lit(0), lambda a, c: a + F.ascii(c)) % 17 / 100.0
    raw = F.lit(0.12) + count("AILMFWVY") / F.greatest(n, F.lit(1)) * 0.65 + count("FWY") * 0.03 - F.abs(n - 9) * 0.15 + seed
    score = F.greatest(F.lit(0.01), F.least(F.lit(0.99), raw))
    return F.struct(F.round(F.greatest(F.lit(20.0), 50000.0 / (1.0 + score * 80.0)), 3).alias("affinity_nm"), F.round((1.0 - score) * 5.0, 4).alias("rank"))


def hla_full(locus: Column, allele: Column) -> Column:
    """An allele without HLA- and one trailing group letter, with its locus."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(allele), "^HLA-", ""), "[gGpPnN]$", "")
    return F.when(plain.contains("*"), plain).otherwise(F.concat(locus, F.lit("*"), plain))


def hla_fields(full: Column) -> Column:
    """(P24)"""
    return F.size(F.split(F.substring_index(full, "*", -1), ":"))


def hla_binding(full: Column) -> Column:
    """Two fields of a class I allele with HLA-, else ""."""
    parts = F.split(F.substring_index(full, "*", -1), ":")
    locus = F.substring_index(full, "*", 1)
    return F.when(locus.isin("A", "B", "C") & (F.size(parts) >= 2), F.concat(F.lit("HLA-"), locus, F.lit("*"), F.get(parts, F.lit(0)), F.lit(":"), F.get(parts, F.lit(1)))).otherwise("")


def msi_class(score: Column, low: float = 3.0, high: float = 20.0) -> Column:
    """(P26)"""
    return F.when(score.isNull(), "NOT_DETERMINED").when(score >= high, "MSI-H").when(score >= low, "MSI-L").otherwise("MSS")


def burden_tier(per_mb: Column) -> Column:
    """(P38)"""
    return F.when(per_mb >= 10, "high").when(per_mb >= 5, "intermediate").otherwise("low")


def orientation(flag: Column) -> Column:
    """Which way the fragment was read: by the strand of its first read, or against that of its second; else unpaired."""
    bit = lambda b: flag.bitwiseAND(F.lit(b)) != 0
    forward = F.when(bit(0x40), ~bit(0x10)).when(bit(0x80), bit(0x10))
    return F.when(forward, "F1R2").when(~forward, "F2R1").otherwise("unpaired")


def query_index(cigar: Column, start: Column, position: Column) -> Column:
    """0-based place in the read of a reference position; null where the read does not hold it."""
    steps = F.regexp_extract_all(cigar, F.lit(r"\d+[MIDNSHP=X]"), F.lit(0))
    zero = F.struct(start.cast("long").alias("ref"), F.lit(0).cast("long").alias("query"), F.lit(None).cast("long").alias("hit"))

    def step(s: Column, op: Column) -> Column:
        n, kind = F.left(op, F.length(op) - 1).cast("long"), F.right(op, F.lit(1))
        both = kind.isin("M", "=", "X")
        here = both & (position >= s["ref"]) & (position < s["ref"] + n)
        return F.struct((s["ref"] + F.when(both | kind.isin("D", "N"), n).otherwise(0)).alias("ref"), (s["query"] + F.when(both | kind.isin("I", "S"), n).otherwise(0)).alias("query"), F.coalesce(s["hit"], F.when(here, s["query"] + position - s["ref"])).alias("hit"))

    return F.aggregate(steps, zero, step, lambda s: s["hit"])


def depth_flag(ratio: Column, low: float = 0.75, high: float = 1.25) -> Column:
    """(P37)"""
    return F.when(ratio < low, "LOW").when(ratio > high, "HIGH").otherwise("OK")


def log2_ratio(ratio: Column) -> Column:
    """(P37)"""
    return F.when(ratio > 0, F.log2(ratio)).otherwise(F.lit(-10.0))
