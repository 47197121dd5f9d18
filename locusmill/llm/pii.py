"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, no_text, table

KINDS = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
#: The look-behinds start a run of characters once only, where a later start inside it could not match either; so a long
#: run costs linear time. Possessive loops keep Java's matcher from recursing.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this cannot hold the kind.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]"}
CONTEXT = {
    "email": r"mail|contact|write to|@",
    "ip": r"\bip\b|address|host|server|login",
    "card": r"card|visa|master|credit|payment|cvv|expir",
    "phone": r"phone|tel|call|mobile|fax|cell",
    "iban": r"iban|bank|account|konto|transfer",
    "ssn": r"ssn|social|security|insurance|tax",
}
CONTEXT_CHARS = 40
#: Score of a pattern alone, what a checksum or a plausible range adds, what a word nearby adds; what an added kind needs.
PATTERN_SCORE, CHECK_SCORE, CONTEXT_SCORE, NEEDED = 0.4, 0.3, 0.3, 0.65
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_BLOCK = 128


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' check digit is right."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an IBAN's remainder is 1."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.when(digit, (rest * 10 + F.try_to_number(F.when(digit, c), F.lit("9")).cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return let(_digits(match), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return F.when(F.length(match).between(15, 42), mod97(match)).otherwise(False)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _before(lengths: Column) -> Column:
    """For each place the sum of the lengths before it; in blocks, so that long arrays are not copied for every entry."""
    empty = F.array().cast("array<bigint>")
    zero = F.struct(F.lit(0).cast("bigint").alias("sum"), empty.alias("out"))
    step = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out"))
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<array<bigint>>").alias("out"))

    def block(s: Column, k: Column) -> Column:
        first = F.struct(s["sum"].alias("sum"), zero["out"].alias("out"))
        return let(F.aggregate(F.slice(lengths, k * _BLOCK + 1, F.lit(_BLOCK)), first, step), lambda r: F.struct(r["sum"].alias("sum"), F.concat(s["out"], F.array(r["out"])).alias("out")))

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
    return F.aggregate(blocks, start, block, lambda s: F.flatten(s["out"]))


_SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def spans(kind: str, text: Column) -> Column:
    """Spans of one kind, in order: kind, start, end (code points, end exclusive) and score; failing matches are dropped."""

    def place(found: Column, gaps: Column) -> Column:
        lengths = F.zip_with(gaps, found, lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("bigint"))

        def one(before: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(gaps, i))
                near = F.concat_ws(" ", F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)), F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS)))
                checked = 0.0 if kind == "email" else CHECK_SCORE
                score = F.round(F.lit(PATTERN_SCORE + checked) + F.when(F.lower(near).rlike(CONTEXT[kind]), CONTEXT_SCORE).otherwise(0.0), 2)
                return F.when(_valid(kind, m), F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), score.alias("score")))

            return F.filter(F.transform(found, span), lambda s: s.isNotNull())

        return let(_before(lengths), one)

    pattern = PATTERNS[kind]
    all_of = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lambda gaps: place(found, gaps))))
    out = F.coalesce(F.when(text.rlike(NEEDS[kind]), all_of), F.array().cast(_SPAN)).cast(_SPAN)
    if kind in ADDED:
        keep = NEEDED + (CONTEXT_SCORE if kind == "ssn" else 0)
        out = F.filter(out, lambda s: s["score"] >= keep)
    return out


def find_pii(docs: DataFrame) -> DataFrame:
    """``(doc_id, findings)``: all spans of ``docs.text`` by kind (email, ip, card, phone, iban, ssn), then start.

    The first four are what their patterns and checks say, whatever the score. IBANs need their remainder, social security
    numbers need a word nearby. Nulls: a null text is empty; a null id stays. Repeated rows and ties are rows like others.
    """
    text = docs.select("doc_id", no_text(F.col("text")).alias("text"))
    each = text.select("doc_id", *[spans(k, F.col("text")).alias(k) for k in KINDS + ADDED])
    return each.select("doc_id", F.concat(*KINDS, *ADDED).alias("findings"))


def _redacted(kind: str, text: Column) -> Column:
    said = lambda g, m: F.concat(g, F.when(m.isNull(), "").when(_valid(kind, m), f"[{kind}]").otherwise(m))
    pieces = let(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), lambda found: F.array_join(F.zip_with(F.split(text, PATTERNS[kind], -1), found, said), ""))
    return F.when(text.rlike(NEEDS[kind]), pieces).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every base match that holds replaced by its kind in brackets, kind after kind; all columns stay."""
    for kind in KINDS:
        docs = docs.withColumn("text", _redacted(kind, F.col("text")))
    return docs


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    told = lambda kinds: F.array_join(F.transform(F.filter("findings", lambda s: s["kind"].isin(*kinds)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("findings", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(told(KINDS), 256).alias("base_sha256"), told(KINDS + ADDED).alias("spans"), F.round(F.coalesce(F.array_max(F.transform("findings", lambda s: s["score"])), F.lit(0.0)), 2).alias("top_score"))
