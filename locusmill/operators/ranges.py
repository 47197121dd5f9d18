"""Total orders over whole tables: rows are sorted in ranges, and ranges exchange one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusmill.shared import written

_PLACE = (1 << 33) - 1


def in_ranges(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` as a written table, with ``_range`` (a number that rises with the order) and ``_nth``, a row's place in its range.

    Rows that ``order`` cannot tell apart lie in one range, so it should end in columns that tell rows apart.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(rows.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("_nth")), name)


def placed(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``df`` with the number of each row, from 1, in a total order."""
    rows = in_ranges(df, order, "placed")
    sizes = sorted((r["_range"], r["count"]) for r in rows.groupBy("_range").count().collect())  # a row for each range
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    first = F.broadcast(df.sparkSession.createDataFrame(before, "_range int, _before long"))
    return rows.join(first, "_range").select(*df.columns, (F.col("_before") + F.col("_nth") + 1).alias(name))


def carried(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """``df`` with ``_last`` and ``_next``: the last value that is not null at a row or before it, and the first after it, among rows of the same keys.

    The values that neighbouring ranges carry over meet on the driver, two for each range.
    """
    rows = in_ranges(df.withColumn("_held", F.when(F.col(value).isNotNull(), F.struct(*keys, F.col(value).alias("_v")))), [*[F.col(k) for k in keys], *order], "carried")
    held = rows.where("_held is not null").groupBy("_range").agg(F.min_by("_held", "_nth").alias("first"), F.max_by("_held", "_nth").alias("last"))
    ends = {r["_range"]: r for r in held.collect()}
    every = sorted(r["_range"] for r in rows.select("_range").distinct().collect())
    back, ahead, seen = {}, {}, None
    for part in every:
        back[part], seen = seen, ends[part]["last"] if part in ends else seen
    seen = None
    for part in reversed(every):
        ahead[part], seen = seen, ends[part]["first"] if part in ends else seen
    kind = rows.schema["_held"].dataType.simpleString()
    over = F.broadcast(df.sparkSession.createDataFrame([(p, back[p], ahead[p]) for p in every], f"_range int, _back {kind}, _ahead {kind}"))
    by = Window.partitionBy("_range")
    rows = rows.withColumn("_l", F.last("_held", True).over(by.orderBy("_nth").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_n", F.last("_held", True).over(by.orderBy(F.desc("_nth")).rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.join(over, "_range")
    same = lambda h: F.lit(True) if not keys else F.struct(*[h[k].alias(k) for k in keys]).eqNullSafe(F.struct(*keys))
    pick = lambda own, other: F.coalesce(F.col(own), F.col(other))
    out = {n: F.when(same(h), h["_v"]) for n, h in (("_last", pick("_l", "_back")), ("_next", pick("_n", "_ahead")))}
    return rows.withColumns(out).select(*df.columns, "_last", "_next")


def write_sorted(df: DataFrame, path: str, order: list[str], parts: int | None = None) -> None:
    """Parquet whose parts, in order of their names, are one sorted table; ``path/_ranges`` has rows, first and last key of each part.

    Columns beside ``order`` decide between equal keys, so that the order is the same each time, and split a key that many rows share.
    """
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c not in order and not kinds[c].startswith(("map", "variant"))]
    cols = [F.col(f"`{c}`") for c in [*order, *rest]]
    rows = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    rows.sortWithinPartitions(*cols).write.parquet(path)
    key = F.struct(*order)
    told = df.sparkSession.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("file"))
    told.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last")).coalesce(1).write.parquet(f"{path}/_ranges")


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    """The table with ``place``, a row's number from 1 in the order in which it was written."""
    told = sorted((r["file"], r["n"]) for r in spark.read.parquet(f"{path}/_ranges").select("file", "n").collect())  # a row for each part
    before, total = [], 0
    for file, n in told:
        before.append((file, total))
        total += n
    rows = spark.read.parquet(path)
    first = F.broadcast(spark.createDataFrame(before, "_file string, _before long"))
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")).join(first, "_file")
    return rows.withColumn("place", F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


def files_between(spark: SparkSession, path: str, low: dict, high: dict) -> list[str]:
    """Parts that can hold keys from ``low`` to ``high``, both inclusive, each given by its first columns."""
    told = spark.read.parquet(f"{path}/_ranges")
    bound = lambda end, given: F.struct(*[F.col(f"{end}.{c}") for c in given])
    value = lambda given: F.struct(*[F.lit(v).alias(c) for c, v in given.items()])
    hit = (bound("last", low) >= value(low)) & (bound("first", high) <= value(high))
    return [f"{path}/{r['file']}" for r in told.where(hit).select("file").orderBy("file").collect()]


def read_between(spark: SparkSession, path: str, low: dict, high: dict) -> DataFrame:
    """Rows of a sorted table with keys from ``low`` to ``high``; parts that cannot hold any are not opened."""
    files = files_between(spark, path, low, high)
    if not files:
        return spark.read.parquet(path).limit(0)
    key = lambda given: F.struct(*[F.col(c) for c in given])
    value = lambda given: F.struct(*[F.lit(v).alias(c) for c, v in given.items()])
    rows = spark.read.schema(spark.read.parquet(path).schema).parquet(*files)
    return rows.where((key(low) >= value(low)) & (key(high) <= value(high)))


def contig_rank(chrom: Column, contigs: list[str]) -> Column:
    """A contig's place in the header, from 1; those that it lacks, and reads without one, come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, contigs)).cast("array<string>"), chrom).cast("int"), F.lit(0)), F.lit(len(contigs) + 1))


def natural_key(name: Column) -> Column:
    """Sorts names by text and number in turn, as in r2 before r10."""
    parts = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    plain = lambda p: F.when(p.rlike(r"^\d"), F.regexp_replace(p, "^0+", "")).otherwise(p)
    told = F.transform(parts, lambda p: F.struct(F.when(p.rlike(r"^\d"), F.length(plain(p))).otherwise(-1).alias("digits"), plain(p).alias("part")))
    return F.struct(told.alias("parts"), F.transform(parts, F.length).alias("widths"))
