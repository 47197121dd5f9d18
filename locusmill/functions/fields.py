"""Column functions over text fields: numbers, INFO and FORMAT maps, per-allele values, annotation entries, reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value (fixed values).
MISSING = ("", ".", "NA", "-")
_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def number(text: Column) -> Column:
    """A double, or null for missing values and texts that are no number."""
    return F.when(text.isin(*MISSING) | ~text.rlike(_NUMBER), None).otherwise(F.trim(text).try_cast("double"))


def info_map(text: Column) -> Column:
    """``k=v;flag`` as a map: flags are "true", the first = splits, the last of repeated keys counts."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda p: p != "")
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), F.when(p.contains("="), F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise("true").alias("value")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    last = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"].alias("value")))
    return F.map_from_entries(last)


def format_map(keys: Column, values: Column, pad: bool = False) -> Column:
    """FORMAT and sample fields as a map; cut to the shorter, or padded with "" where ``pad``."""
    k, v = F.array_distinct(F.split(keys, ":")), F.split(values, ":")
    if pad:
        return F.map_from_arrays(k, F.transform(k, lambda x, i: F.coalesce(F.get(v, i), F.lit(""))))
    n = F.least(F.size(k), F.size(v))
    return F.map_from_arrays(F.slice(k, 1, n), F.slice(v, 1, n))


def per_allele(text: Column, i: Column) -> Column:
    """Entry i of a comma list; beyond its end, the first."""
    parts = F.split(text, ",")
    return F.coalesce(F.get(parts, i), F.get(parts, F.lit(0)))


def sample_metrics(sample: Column, i: Column) -> Column:
    """Struct of depth, alt reads (AD[i + 1]) and alt fraction, which falls back to alt / depth. (P5)"""
    dp = number(F.element_at(sample, "DP"))
    alt = number(F.get(F.split(F.element_at(sample, "AD"), ","), i + 1))
    af = number(per_allele(F.element_at(sample, "AF"), i))
    return F.struct(dp.cast("long").alias("dp"), alt.cast("long").alias("alt_reads"), F.coalesce(af, F.when(dp != 0, alt / dp)).alias("af"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    n = F.least(F.length(a), F.length(b))
    same = F.filter(F.sequence(F.lit(1), n), lambda i: F.left(a, i) == F.left(b, i))
    return F.when(n > 0, F.size(same)).otherwise(0)


def minimal_allele(ref: Column, alt: Column) -> Column:
    """ALT without the prefix, then the suffix, that it shares with REF; "-" if nothing is left."""
    p = common_prefix(ref, alt)
    r, a = F.substring(ref, p + 1, F.length(ref)), F.substring(alt, p + 1, F.length(alt))
    s = common_prefix(F.reverse(r), F.reverse(a))
    out = F.left(a, F.length(a) - s)
    return F.when(out == "", "-").otherwise(out)


def annotations(text: Column, fields: list[str]) -> Column:
    """Annotation entries as an array of structs by the header's fields; short entries are padded."""

    def entry(e: Column) -> Column:
        parts = F.split(e, r"\|", -1)
        return F.struct(*[F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(f) for i, f in enumerate(fields)])

    return F.when(text.isNull() | (text == ""), F.transform(F.array().cast("array<string>"), entry)).otherwise(F.transform(F.split(text, ","), entry))


def max_population_af(entries: Column, fields: list[str], separators: str = "[&,]") -> Column:
    """Largest population frequency among the given fields of all entries."""
    values = F.flatten(F.transform(entries, lambda e: F.flatten(F.array(*[F.transform(F.split(e[f], separators), number) for f in fields]))))
    return F.array_max(F.filter(values, lambda v: v.isNotNull()))


def meets(value: Column, least=None, most=None) -> Column:
    """Inclusive threshold test; a missing value fails."""
    ok = F.lit(True)
    if least is not None:
        ok = ok & (value >= least)
    if most is not None:
        ok = ok & (value <= most)
    return F.coalesce(ok & value.isNotNull(), F.lit(False))


def reasons(checks: list[tuple[str, Column]]) -> Column:
    """Names of the checks that fail, in their order, joined by ";". (P10)"""
    return F.concat_ws(";", *[F.when(~ok, F.lit(name)) for name, ok in checks])


def first_non_empty(*columns: Column) -> Column:
    """(P15)"""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def first_int(text: Column) -> Column:
    """(P14)"""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("long")


def first_number(text: Column) -> Column:
    """(P14)"""
    return F.regexp_extract(text, r"([-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)", 1).try_cast("double")


def key_values(columns: dict[str, Column], preferred: list[str]) -> Column:
    """``k=v`` of the preferred fields that are not empty; of all others where none is."""
    say = lambda names: F.concat_ws(";", *[F.when(F.coalesce(columns[n], F.lit("")) != "", F.concat(F.lit(n + "="), columns[n])) for n in names if n in columns])
    first = say(preferred)
    return F.when(first != "", first).otherwise(say(list(columns)))


def percent(text: Column) -> Column:
    """A share from a text like 12.5%."""
    return F.trim(F.replace(text, F.lit("%"), F.lit(""))).try_cast("double") / 100


def safe_label(text: Column) -> Column:
    """(P41)"""
    return F.regexp_replace(text, "[^A-Za-z0-9_.-]", "_")


def html_escape(text: Column) -> Column:
    """(P41)"""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Powers of ten up to this one are doubles exactly.
_EXACT_TENS = 22


def _written(value: Column) -> Column:
    """Struct of a positive double's shortest decimal digits (no zeros before or behind) and the power of ten of the first, as ``d.ddd * 10^e``."""
    text = value.cast("string")
    whole = F.substring_index(text, "E", 1)
    shift = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
    before, after = F.substring_index(whole, ".", 1), F.substring_index(whole, ".", -1)

    def told(every: Column) -> Column:
        lead = F.length(every) - F.length(F.ltrim(every, F.lit("0")))
        return F.struct(F.rtrim(F.ltrim(every, F.lit("0")), F.lit("0")).alias("digits"), (F.length(before) - 1 - lead + shift).alias("e"))

    return let(F.concat(before, after), told)


def _side(value: Column, middle: Column, power: Column) -> Column:
    """Sign of ``value - middle * 10^power``, exactly where 10^|power| is a double: the product's rounding error is found by halving the factors' digits."""

    def halves(x: Column) -> tuple[Column, Column]:
        c = x * 134217729.0
        high = c - (c - x)
        return high, x - high

    def error(a: Column, b: Column, product: Column) -> Column:
        (ah, al), (bh, bl) = halves(a), halves(b)
        return al * bl - (((product - ah * bh) - al * bh) - ah * bl)

    def sign(ten: Column) -> Column:
        up = let(middle * ten, lambda p: (value - p) - error(middle, ten, p))
        down = let(value * ten, lambda p: (p - middle) + error(value, ten, p))
        return F.signum(F.when(power >= 0, up).otherwise(down))

    return F.when(F.abs(power) > _EXACT_TENS, F.lit(1.0)).otherwise(let(F.concat(F.lit("1e"), F.abs(power)).cast("double"), sign))


def rounded(value: Column, places: int) -> Column:
    """A double of at least 0 rounded to so many decimals by its exact value, ties to even."""

    def near(whole: Column) -> Column:
        side = _side(value, whole + 0.5, F.lit(-places))
        up = (side > 0) | ((side == 0) & (whole % 2 == 1))
        return (whole + F.when(up, 1.0).otherwise(0.0)) / float(10**places)

    return F.when(value.isNotNull(), let(F.floor(value * float(10**places)).cast("double"), near))


def _rounded(value: Column, digits: int) -> Column:
    """Struct of a positive double's ``digits`` significant digits, as C rounds them, and the power of ten of the first.

    The shortest decimal lies on the same side of the middle between two results as the double does, unless it is that middle:
    then the double itself is compared with it, and an exact tie goes to the even digit.
    """

    def near(d: Column) -> Column:
        head = F.rpad(F.left(d["digits"], F.lit(digits)), digits, "0").cast("long")
        rest = F.substring(d["digits"], digits + 1, 400)
        tie = _side(value, (head * 10 + 5).cast("double"), d["e"] - digits)
        up = F.when(rest == "5", (tie > 0) | ((tie == 0) & (head % 2 == 1))).otherwise(rest >= "5")

        def carried(n: Column) -> Column:
            over = n == 10**digits
            text = F.when(over, F.lit(str(10 ** (digits - 1)))).otherwise(n.cast("string"))
            return F.struct(F.rtrim(text, F.lit("0")).alias("digits"), (d["e"] + over.cast("int")).alias("e"))

        return let(head + up.cast("long"), carried)

    return let(_written(value), near)


def _laid_out(value: Column, decimal: Column, most: int, point: str) -> Column:
    """Digits and power as C prints them: with an exponent below 1e-4 and from 10^most on; ``point`` follows whole numbers."""

    def told(d: Column) -> Column:
        digits, e, n = d["digits"], d["e"], F.length(d["digits"])
        exponent = F.concat(F.when(n > 1, F.concat(F.left(digits, F.lit(1)), F.lit("."), F.substring(digits, 2, 400))).otherwise(digits), F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
        whole = F.concat(F.rpad(digits, e + 1, F.lit("0")), F.lit(point))
        mixed = F.concat(F.left(digits, e + 1), F.lit("."), F.substring(digits, e + 2, F.lit(400)))
        return F.when((e < -4) | (e >= most), exponent).when(e < 0, small).when(n <= e + 1, whole).otherwise(mixed)

    minus = F.when((value < 0) | (value.cast("string") == "-0.0"), "-").otherwise("")
    plain = F.when(F.isnan(value), "nan").when(F.abs(value) == float("inf"), F.concat(minus, F.lit("inf"))).when(value == 0, F.concat(minus, F.lit("0" + point)))
    return F.when(value.isNotNull(), F.coalesce(plain, F.concat(minus, let(decimal, told))))


def shown(value: Column, digits: int = 6) -> Column:
    """A double as C's ``%.{digits}g`` prints it.

    Beyond 1e22 and below 1e-22 a double whose shortest decimal is the very middle between two results is rounded up; numbers
    below 2.3e-308, which have fewer digits than others, are shown by their shortest decimal.
    """
    return _laid_out(value, _rounded(F.abs(value), digits), digits, "")


def shown_whole(value: Column) -> Column:
    """A double by the shortest digits that tell it apart, with a point always, as the audit tables print it: 6.0, 1e-05."""
    return _laid_out(value, _written(F.abs(value)), 16, ".0")
