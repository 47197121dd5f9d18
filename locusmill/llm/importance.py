"""Importance resampling: documents are drawn with weights that make their features look like a target's.

Weights come from arrays of counts by hashed feature. The cut between drawn and undrawn documents is the exact k-th key of
(score, id), found digit by digit: every pass counts one digit of the keys that are still in question, and nothing is sorted
but what is drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, no_text, ranked, received, shipped, table, tidied, word_lists

#: Buckets of features, and the longest run of words that is a feature.
BUCKETS, LONGEST = 10_000, 1
#: Share of the documents of LEAST_WORDS words or more that is drawn, in percent.
PERCENT, LEAST_WORDS = 10, 20
SEED = 2024
#: Bits of a key that one pass decides: so many counts, 2 to this power, reach the driver at most.
DIGIT = 16
_SIGN = 1 << 63


def feature_buckets(text: bytes, buckets: int, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For stretches of a text, the number of their words and the buckets of the features that end there."""
    last: list[bytes] = []
    for words in word_lists(text):
        features = words
        if longest > 1:
            run = last + words
            features = [b" ".join(run[e - n : e]) for e in range(len(last) + 1, len(run) + 1) for n in range(1, min(longest, e) + 1)]
            last = run[1 - longest :]
        yield len(words), np.fromiter(map(zlib.crc32, features), dtype=np.int64, count=len(features)) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``bucket, n``: features of all of ``texts.text`` by bucket, summed up in each task before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                for _, found in feature_buckets(text.as_py(), buckets, longest):
                    n += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held])], names=["bucket", "n"])

    found = texts.select(no_text(F.col("text")).alias("text")).mapInArrow(tidied(count), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """For each bucket 1000 times the logarithm of how much likelier the target makes it, rounded down; one row a bucket reaches the driver."""
    sides = []
    for texts in (docs, target):
        n = np.zeros(buckets, dtype=np.int64)
        for bucket, count in bucket_counts(texts, buckets, longest).collect():
            n[bucket] = count
        sides.append(n)
    s, t = sides
    over, under = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b + 1) * over) / (float(a + 1) * under))) for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def gumbel(name: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel variate, rounded down, from a hash of the seed and the name."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` (and the columns ``keep``) of every document, a written table.

    Texts are read twice, once to count and once to weigh, and never shuffled. Nulls: a null text has no words and weight 0;
    a null id stays and is hashed as an empty one.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    gain = shipped(spark, gains(docs, target, buckets, longest))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = received(gain)
        for batch in batches:
            told = []
            for text in batch.column(0).cast(pa.binary()):
                n_words = n_features = weight = 0
                for n, found in feature_buckets(text.as_py(), buckets, longest):
                    n_words, n_features, weight = n_words + n, n_features + len(found), weight + int(worth[found].sum())
                told.append((n_words, n_features, weight))
            columns = [pa.array([x[i] for x in told], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[1:]], names=["n_words", "n_features", "weight", *batch.schema.names[1:]])

    rows = docs.select(no_text(F.col("text")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"), *keep)
    kinds = ", ".join(f"`{n}` {k}" for n, k in rows.dtypes[1:])
    weighed = rows.mapInArrow(tidied(weigh), f"n_words long, n_features long, weight long, {kinds}")
    score = F.col("weight") + gumbel(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed)
    return materialise(weighed.withColumn("score", score), "importance-scores")


def kth_key(rows: DataFrame, keys: list[str], k: int) -> tuple[int, ...]:
    """The k-th least tuple (from 1) of the long columns ``keys``, by radix selection from the most significant digit on.

    Digits that all keys share are skipped. Each pass groups the rows still in question by one digit; the filters on them are
    plain comparisons, which reach the scan.
    """
    out = []
    for name in keys:
        low, high = (x + _SIGN for x in rows.agg(F.min(name), F.max(name)).first())
        shift = (low ^ high).bit_length()
        low = low >> shift << shift
        high = low + (1 << shift) - 1
        while shift:
            width = min(DIGIT, shift)
            shift -= width
            digit = F.shiftrightunsigned(F.col(name).bitwiseXOR(F.lit(-_SIGN)), shift).bitwiseAND(F.lit((1 << width) - 1))
            for d, n in sorted(tuple(r) for r in rows.where(F.col(name).between(low - _SIGN, high - _SIGN)).groupBy(digit).count().collect()):
                if k <= n:
                    break
                k -= n
            low += d << shift
            high = low + (1 << shift) - 1
        out.append(low - _SIGN)
        rows = rows.where(F.col(name) == out[-1])
    return tuple(out)


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (a written table) with ``rank``: 1, 2, 3... for the highest scores, ties to the smaller id; null for all others.

    Of the N rows of ``least_words`` words or more, floor(percent * N / 100) are drawn. A null id counts as the largest.
    Rows equal in score and id are ranked by n_features, and if those are equal too, in any order; each is a row of its own.
    An empty table gives no rows.
    """
    nameless = F.coalesce(F.col("doc_id"), F.lit(2**63 - 1))
    rows = scored.withColumns({"_fall": -F.col("score"), "_id": nameless, "_row": F.monotonically_increasing_id()})
    fit = rows.where(F.col("n_words") >= least_words)
    k = fit.count() * percent // 100
    columns = scored.columns
    if not k:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    keys = ["_fall", "_id", "n_features"]
    last = kth_key(fit, keys, k)
    up_to = F.lit(True)
    for name, value in reversed(list(zip(keys, last))):
        up_to = (F.col(name) < value) | ((F.col(name) == value) & up_to)
    within = (F.col("n_words") >= least_words) & up_to
    place = F.col("place") + 1
    chosen = ranked(rows.where(within), [F.col(c) for c in (*keys, "_row")], "importance-drawn")
    return chosen.select(*columns, F.when(place <= k, place).alias("rank")).unionByName(rows.where(~within).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, **how) -> DataFrame:
    """The drawn rows of ``docs``, all columns; rows of the same id and text as a drawn one stay too. See ``scores`` and ``drawn``."""
    marked = docs.select("doc_id", "text", F.md5(no_text(F.col("text"))).alias("_digest"))
    ids = drawn(scores(marked, target, keep=("_digest",), **how), percent, least_words).where("rank is not null")
    ids = ids.select(F.col("doc_id").alias("_drawn"), F.col("_digest").alias("_same")).distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["_drawn"]) & (F.md5(no_text(docs["text"])) == ids["_same"]), "left_semi")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drawn(scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


#: The SQL reckons crc32 byte by byte, once for each different word.
OP11_SQL = r"""
WITH RECURSIVE t8 AS (
  SELECT i AS n, i AS c, 0 AS k FROM range(256) r(i) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM t8 WHERE k < 8
), tab AS (SELECT list(c ORDER BY n) AS tab FROM t8 WHERE k = 8),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
dw AS (SELECT doc_id, w, count(*) AS n FROM d GROUP BY doc_id, w),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
bw AS (SELECT w, count(*) AS n FROM b GROUP BY w),
words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
bytes AS (SELECT w, [CAST(4294967295 AS BIGINT)] || list_transform(range(0, CAST(length(h) AS BIGINT) // 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT)) AS bytes FROM words),
hashed AS (SELECT w, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, CAST(tab[xor(c & 255, x) + 1] AS BIGINT))), 4294967295) % 10000 AS bucket FROM bytes, tab),
s AS (SELECT bucket, CAST(sum(n) AS DOUBLE) AS s FROM dw JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, CAST(sum(n) AS DOUBLE) AS t FROM bw JOIN hashed USING (w) GROUP BY bucket),
total AS (SELECT coalesce((SELECT sum(s) FROM s), 0) + 10000 AS s, coalesce((SELECT sum(t) FROM t), 0) + 10000 AS t),
g AS (SELECT bucket, CAST(floor(1000 * ln(((coalesce(t.t, 0) + 1) * total.s) / ((coalesce(s.s, 0) + 1) * total.t))) AS BIGINT) AS gain FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), total),
weights AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * gain) AS BIGINT) AS weight FROM dw JOIN hashed USING (w) JOIN g USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((list_reduce([CAST(0 AS BIGINT)] || list_transform(range(1, 9), lambda i: CAST(instr('0123456789abcdef', sha256('2024:' || doc_id)[i]) - 1 AS BIGINT)), lambda a, x: a * 16 + x) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), fit AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN fit USING (doc_id)
"""
