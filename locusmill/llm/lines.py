"""Line dedup: content-defined chunks of lines that repeat anywhere in the corpus are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, let, materialise, no_text, small, table

#: A single line is a chunk of its own from so many words on.
MIN_WORDS = 50
#: Uses of a chunk that one task takes at most; places of chunks used more often are dealt to several.
KEY_ROWS = 50_000


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def text_key(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(no_text(text))


def chunks(text: Column, min_words: int = MIN_WORDS) -> Column:
    """Array of (first, last, key): every two neighbouring lines of the text, and each line of ``min_words`` words or more.

    A hash rolls over the lines that are not blank, two at a time, and each of its values is a chunk (``key`` joins both line
    digests). So a boundary of what repeats lies wherever the rolling hash stops being one that the corpus holds elsewhere:
    it depends on the lines inside alone, and an inserted line moves no other boundary. Blank lines are not hashed; those between
    two lines of a chunk belong to it.
    """

    def build(found: Column) -> Column:
        def pair(a: Column, i: Column) -> Column:
            b = F.get(found, i + 1)
            return F.when(b.isNotNull(), F.struct(a["line"].alias("first"), b["line"].alias("last"), F.concat(a["digest"], b["digest"]).alias("key")))

        pairs = F.filter(F.transform(found, pair), lambda c: c.isNotNull())
        singles = F.transform(F.filter(found, lambda a: a["long"]), lambda a: F.struct(a["line"].alias("first"), a["line"].alias("last"), a["digest"].alias("key")))
        return F.concat(pairs, singles)

    def told(line: Column, i: Column) -> Column:
        long = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) >= min_words
        return F.when(line.rlike(r"[^\x00-\x20]"), F.struct(i.cast("int").alias("line"), _digest(line).alias("digest"), long.alias("long")))

    return let(F.filter(F.transform(F.split(no_text(text), "\n", -1), told), lambda x: x.isNotNull()), build)


def _same_bytes(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """Those of the ``digests`` that different lines share: none, unless someone forges them."""
    lines = F.explode(F.filter(F.split(no_text(F.col("text")), "\n", -1), lambda x: x.rlike(r"[^\x00-\x20]")))
    texts = docs.select(lines.alias("line")).select("line", _digest(F.col("line")).alias("digest")).join(digests, "digest", "left_semi")
    return texts.groupBy("digest").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b").select("digest")


def repeated_chunks(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """Per document ``(doc_id, text_key, n_lines, n_chunks)``, and the chunks to remove: ``(doc_id, text_key, first, last)``, lines from 0, both inclusive.

    A chunk stays in the document of least id that holds it, at its first place there, and goes everywhere else; neighbouring
    and overlapping ones make up the whole repeated passage. Chunks meet by the digests of their lines, and the bytes of every
    line of a repeated chunk are compared: a chunk with a digest that different lines share stays everywhere. Only digests,
    and one text for each task and repeated line, are shuffled.

    ``text_key`` tells documents of the same id apart by their text: each keeps what only it holds. Rows that are equal in
    both are one document. Nulls: a null text is one empty line; rows without id lose chunks to rows with one, and keep what only
    they hold. Empty tables give no rows; other columns are not looked at.
    """
    cut = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.size(F.split(no_text(F.col("text")), "\n", -1)).cast("long").alias("n_lines"), chunks(F.col("text"), min_words).alias("chunks"))
    cut = materialise(cut, "line-chunks")
    facts = cut.select("doc_id", "text_key", "n_lines", F.size("chunks").cast("long").alias("n_chunks"))
    places = cut.select("doc_id", "text_key", F.inline("chunks"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("doc"), F.col("text_key").alias("text"), F.col("first").alias("at"))
    owners = places.groupBy("key").agg(F.min(order).alias("owner"), F.count(F.lit(1)).alias("uses")).where("uses > 1 and owner.doc is not null")
    owners = materialise(owners.select("key", F.col("owner.doc").alias("owner"), F.col("owner.text").alias("owner_text"), F.col("owner.at").alias("at"), "uses"), "line-owners")

    halves = F.array(F.substring("key", 1, 16), F.substring("key", 17, 16))
    digests = materialise(owners.select(F.explode(halves).alias("digest")).where("length(digest) > 0").distinct(), "line-digests")
    forged = materialise(_same_bytes(docs, small(digests)), "line-forged")
    honest = owners.join(F.broadcast(forged), F.array_contains(halves, forged["digest"]), "left_anti") if not forged.isEmpty() else owners
    discard(digests)

    # Places of hot chunks are dealt to several tasks, and their owners copied to each.
    hot = owners.where(F.col("uses") > KEY_ROWS).select("key", F.ceil(F.col("uses") / KEY_ROWS).cast("int").alias("copies"))
    dealt = places.join(small(hot), "key", "left").select("doc_id", "text_key", "first", "last", "key", F.pmod(F.xxhash64("doc_id", "first"), F.coalesce("copies", F.lit(1))).cast("int").alias("part"))
    copied = honest.select("key", "owner", "owner_text", "at", F.explode(F.sequence(F.lit(0), F.ceil(F.col("uses") / KEY_ROWS).cast("int") - 1)).alias("part"))
    if owners.count() <= KEY_ROWS:
        here = places.join(F.broadcast(honest.select("key", "owner", "owner_text", "at")), "key")
    else:
        here = dealt.join(copied, ["key", "part"])
    same = F.col("doc_id").eqNullSafe(F.col("owner")) & (F.col("text_key") == F.col("owner_text"))
    gone = here.where(~same | (F.col("first") > F.col("at")))
    return facts, gone.select("doc_id", "text_key", "first", "last")


def passages(gone: DataFrame) -> DataFrame:
    """``(doc_id, text_key, n, spans)``: chunks to remove in each document, and the stretches of lines that they cover, as (start, end) with end exclusive."""
    lines = F.flatten(F.transform(F.collect_set(F.struct("first", "last")), lambda c: F.sequence(c["first"], c["last"])))
    by_doc = gone.groupBy("doc_id", "text_key").agg(F.size(F.collect_set(F.struct("first", "last"))).cast("long").alias("n"), F.array_sort(F.array_distinct(lines)).alias("lines"))
    starts = F.filter("lines", lambda x, i: (i == 0) | (F.get("lines", i - 1) < x - 1))
    ends = F.filter("lines", lambda x, i: (i == F.size("lines") - 1) | (F.get("lines", i + 1) > x + 1))
    spans = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))
    return by_doc.select("doc_id", "text_key", "n", spans.alias("spans"))


def dedup_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text``; all columns stay. See ``repeated_chunks``."""
    _, gone = repeated_chunks(docs, **how)
    lost = passages(gone).select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_of"), F.col("spans").alias("_lost"))
    row = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("_key"))
    kept = F.array_join(F.filter(F.split(F.col("_row.text"), "\n", -1), lambda x, i: ~F.exists("_lost", lambda s: (i >= s["start"]) & (i < s["end"]))), "\n")
    out = row.join(lost, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_of")), "left")
    text = F.when(F.col("_lost").isNull(), F.col("_row.text")).otherwise(kept)
    return out.select(*[text.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, gone = repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    told = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    lost = passages(gone).select("doc_id", "text_key", size.alias("n_removed_lines"), F.col("n").alias("n_removed_chunks"), told.alias("removed"))
    a, b = facts.alias("a"), lost.alias("b")
    out = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("a.doc_id", "n_lines", "n_chunks", zero("n_removed_lines"), zero("n_removed_chunks"), F.coalesce("removed", F.lit("")).alias("removed"))


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS i, lines[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), range(1, len(lines) + 1) t(i)
), w AS (
  SELECT doc_id, i, line, lead(i) OVER d AS j, lead(line) OVER d AS next FROM l WHERE regexp_matches(line, '[^\x00-\x20]') WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT doc_id, i AS a, j AS b, line || chr(10) || next AS key FROM w WHERE next IS NOT NULL
  UNION ALL SELECT doc_id, i, i, line FROM w WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50
), g AS (
  SELECT doc_id, a, b FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, a) AS seen FROM c) WHERE seen > 1
), x AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM g),
s AS (SELECT doc_id, min(i) AS a, max(i) + 1 AS b FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM x) GROUP BY doc_id, run),
t AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS nl, string_agg(a || ':' || b, ',' ORDER BY a) AS removed FROM s GROUP BY doc_id)
SELECT f.doc_id, n_lines, coalesce(nc, 0) AS n_chunks, coalesce(nl, 0) AS n_removed_lines, coalesce(ng, 0) AS n_removed_chunks, coalesce(removed, '') AS removed
FROM (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id) f LEFT JOIN (SELECT doc_id, count(*) AS nc FROM c GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS ng FROM g GROUP BY doc_id) USING (doc_id) LEFT JOIN t USING (doc_id)
"""
