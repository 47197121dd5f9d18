"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, no_text, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
SEED = "mix-1"
#: Copies are counted in units of 2^-24, so that prefix sums are exact integers.
UNIT = 1 << 24


def word_count(text: Column) -> Column:
    return F.regexp_count(no_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT) -> DataFrame:
    """``(source, source_size)`` with each source's ``target``.

    Sources in order of code point (null last) weigh ``weights``, repeating, and share ``share`` times all sizes. A target
    stops at ``limit`` times its source's size; the excess goes to the others by weight until none is above. One sorted
    pass finds that level: below it sources are full, above it they get level x weight.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    full = sizes.select("source", "source_size", w.alias("w")).withColumn("cap", F.col("source_size") * limit)
    by_need = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1)))
    level = (everything * share - before) / rest
    full = full.select("source", "source_size", "w", "cap", level.alias("level"), (F.col("cap") / F.col("w")).alias("need"))
    open_level = F.min_by(F.when(F.col("level") <= F.col("need"), F.col("level")), F.when(F.col("level") <= F.col("need"), F.col("need")))
    top = open_level.over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1)))
    return full.select("source", "source_size", F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(F.col("cap").cast("double"), F.coalesce(top * F.col("w"), F.col("cap").cast("double")))).alias("target"))


def _copies(k: Column, rate: Column, offset: Column) -> Column:
    """Integer boundaries crossed between the prefix sums k x rate and (k + 1) x rate."""
    return F.shiftright((k + 1) * rate + offset, 24) - F.shiftright(k * rate + offset, 24)


def _offset(source: Column, seed: str) -> Column:
    """The source's one offset, drawn by the seed alone, from 0 to UNIT - 1."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long")


def mix(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, share=SHARE, limit=LIMIT, carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """Each row of ``docs`` (columns doc_id, source, text among any others) with its part in the mix.

    Returns ``row`` (the columns to ``carry`` as a struct, so that no column name can clash), size, source_size, target, copies.
    Rows lie in order of source, size and doc_id over all tasks, so a hot source spreads like any other; a task's rows are
    counted, and the counts' prefix sums give every row its place within its source. Expected copies are target /
    source_size; a row is emitted once per integer that its stretch of the prefix sum, shifted by the source's one seeded
    offset, crosses: never more than ``limit`` times. As rows lie by size, a source's words miss its target by about its
    largest text at most.

    Nulls: a null text has size 0, a null source is a source of its own, null ids sort first. Empty tables give no rows.
    Repeated rows are rows like others. Sources of size 0 have target 0 and no copies.
    """
    size = word_count(F.col("text"))
    rows = docs.select(F.struct(*carry).alias("row"), F.col("source").alias("source"), size.alias("size"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"))
    order = ["source", "size", "id", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = materialise(rows, "mix-rows").withColumn("part", F.shiftright("at", 33))

    held = rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.sum("size").alias("size"))
    held = materialise(held, "mix-parts")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = held.select("source", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    goal = targets(held.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(F.lit(0)).cast("long")
    goal = materialise(goal.withColumn("rate", rate), "mix-goal")

    a, b = places.alias("a"), goal.alias("b")
    placed = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "part", "shift", "source_size", "target", "rate")
    placed = materialise(placed, "mix-placed").alias("p")
    same = F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.part") == F.col("p.part"))
    k = F.col("r.at") + F.col("p.shift")
    out = rows.alias("r").join(placed, same)
    copies = _copies(k, F.col("rate"), _offset(F.col("r.source"), seed))
    return out.select("row", "size", "source_size", "target", copies.alias("copies"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    out = mix(docs, **how).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), carry=("doc_id",))
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS w
  FROM d GROUP BY source
), c AS (
  SELECT *, source_size * 2 AS cap, (source_size * 2)::DOUBLE / w AS need,
         ((sum(source_size) OVER ())::DOUBLE * 1.5
          - coalesce(sum(source_size * 2) OVER (ORDER BY (source_size * 2)::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(w) OVER (ORDER BY (source_size * 2)::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM s
), g AS (
  SELECT source, source_size,
         CASE WHEN source_size = 0 THEN 0.0::DOUBLE
              ELSE least(cap::DOUBLE, coalesce((SELECT arg_min(level, need) FROM c WHERE level <= need) * w, cap::DOUBLE)) END AS target
  FROM c
), r AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size * 16777216) AS BIGINT) ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) - 1 AS k,
         CAST('0x' || substr(md5('mix-1:' || coalesce('s' || d.source, 'n')), 1, 6) AS BIGINT) AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST((((k + 1) * rate + u) // 16777216 - (k * rate + u) // 16777216) * size AS BIGINT) AS taken,
       CAST(((k + 1) * rate + u) // 16777216 - (k * rate + u) // 16777216 AS BIGINT) AS copies
FROM r
"""
