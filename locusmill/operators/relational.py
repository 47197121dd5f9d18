"""Operators over any table: audits, histograms, rankings, matches by precedence, consensus and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions.fields import reasons


def audit(rows: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """``rows`` with pass_<name> for each check, overall_pass and failure_reasons."""
    out = rows.withColumns({f"pass_{name}": F.coalesce(ok, F.lit(False)) for name, ok in checks})
    named = [(name, F.col(f"pass_{name}")) for name, _ in checks]
    every = named[0][1]
    for _, ok in named[1:]:
        every = every & ok
    return out.withColumn("overall_pass", every).withColumn("failure_reasons", reasons(named))


def tag_histogram(rows: DataFrame, tags: Column, name: str, top: int | None = None, at: Column | None = None) -> DataFrame:
    """How often each tag of an array stands in a row; the ``top`` most common, ties by name, or by where they stand first if ``at`` orders the rows."""
    found = rows.select((F.lit(0) if at is None else at).alias("_at"), F.posexplode(tags).alias("_i", name))
    out = found.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_at", "_i")).alias("_first"))
    if top is not None:
        out = out.orderBy(F.desc("n"), name if at is None else "_first").limit(top)
    return out.select(name, "n")


def first_rows(rows: DataFrame, order: list[Column], n: int = 300) -> DataFrame:
    """The rows that a report shows: the first ``n`` in an order, found without sorting the others. (O3)"""
    return rows.orderBy(*order).limit(n)


def best(rows: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a total order."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", at).where(F.col("_place") <= n).drop("_place")


def precedence_match(left: DataFrame, right: DataFrame, levels: list[tuple[str, list[Column], list[Column]]], key: Column) -> DataFrame:
    """``left`` with match_key (least key of the first level that has candidates), match_level and n_candidates.

    ``levels`` are (name, left keys, right keys), strongest first; right sides are summed up before they are joined.
    """
    out = left
    for i, (_, mine, theirs) in enumerate(levels):
        found = right.groupBy(*[c.alias(f"_r{i}_{j}") for j, c in enumerate(theirs)]).agg(F.min(key).alias(f"_key{i}"), F.count(F.lit(1)).alias(f"_n{i}"))
        on = [c == F.col(f"_r{i}_{j}") for j, c in enumerate(mine)]
        out = out.join(found, on, "left").drop(*[f"_r{i}_{j}" for j in range(len(theirs))])
    level = F.coalesce(*[F.when(F.col(f"_n{i}").isNotNull(), F.lit(n)) for i, (n, _, _) in enumerate(levels)], F.lit("none"))
    out = out.withColumn("match_level", level).withColumn("match_key", F.coalesce(*[F.col(f"_key{i}") for i in range(len(levels))]))
    out = out.withColumn("n_candidates", F.coalesce(*[F.col(f"_n{i}") for i in range(len(levels))], F.lit(0)))
    return out.drop(*[f"_{k}{i}" for k in ("key", "n") for i in range(len(levels))])


def unique_band_match(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, value: Column, other: Column, tolerance: float, key: Column) -> DataFrame:
    """Rows of ``left`` with the only candidate of their key, if its value is near enough."""
    only = right.groupBy(right_key.alias("_group")).agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("match_key"), F.min(other).alias("_value")).where("_n = 1")
    near = left.join(only, left_key == F.col("_group")).where(F.abs(value - F.col("_value")) <= tolerance)
    return near.drop("_group", "_n", "_value")


def consensus(rows: DataFrame, keys: list[str], call: str) -> DataFrame:
    """Groups that agree on one call."""
    out = rows.groupBy(*keys).agg(F.min(call).alias(call), F.max(call).alias("_most"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col(call) == F.col("_most")).drop("_most")


def running_before(rows: DataFrame, keys: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of the values before each."""
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(value).over(by), F.lit(0)))


def depth_ratio(rows: DataFrame, depth: str, length: str) -> DataFrame:
    """``rows`` with their depth over the table's weighted mean (1 where that is not positive), log2 and flag."""
    from locusmill.functions.biology import depth_flag, log2_ratio

    mean = rows.agg((F.sum(F.col(depth) * F.col(length)) / F.nullif(F.sum(length), F.lit(0))).alias("_mean"))
    mean = mean.select(F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(1.0).alias("_mean"))
    out = rows.crossJoin(F.broadcast(mean)).withColumn("ratio", F.col(depth) / F.col("_mean")).drop("_mean")  # one row, whatever the table
    return out.withColumn("log2_ratio", log2_ratio(F.col("ratio"))).withColumn("qc_flag", depth_flag(F.col("ratio")))


def unpivot(row: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """A one-row summary as metric and value. (K4)"""
    return row.unpivot([], row.columns, metric, value)


def only_left(left: DataFrame, right: DataFrame, mine: str, theirs: str) -> DataFrame:
    """(U2)"""
    return left.join(right.select(F.col(theirs).alias("_theirs")).distinct(), F.col(mine) == F.col("_theirs"), "left_anti")


def with_default(left: DataFrame, right: DataFrame, on: list[str], column: str, default: str, as_: str) -> DataFrame:
    """A lookup that gives ``default`` where there is no entry."""
    return left.join(right, on, "left").withColumn(as_, F.coalesce(F.col(column), F.lit(default)))


def kmers(text: Column, k: int) -> Column:
    """All k-mers of a text, in order; none where it is shorter or null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1)), F.array().cast("array<string>"))
