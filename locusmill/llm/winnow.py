"""Document fingerprints: the least k-gram hash of every window, with its position. Built-in functions only.

Any run of ``k + window - 1`` characters that two texts share puts the same hash into both fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, materialise, no_text, ranked, table

#: Characters of a k-gram, and hashes of a window (a square: its minimum is taken in two steps of as many).
K, SIDE = 8, 4
WINDOW = SIDE * SIDE
#: Windows that one array holds: the memory of a text's hashes is bounded, however long it is.
_STRETCH = 4096
_LOCAL = 13
#: Bits of a position in a packed entry ``hash << _PLACE | position``.
_PLACE = 31
#: Documents of a run at least, and runs at most.
RUN_DOCS, RUNS = 64, 65_536
#: Characters that one task fingerprints, some 20 seconds of work; by bytes alone Spark would give it far more.
TASK_CHARS = 32_000_000


def _hashes(piece: Column, k: int) -> Column:
    """One number for each k-gram of a piece (four bytes a character): its hash, and below it the place counted from the end, so that of equal hashes the rightmost is least."""
    last = F.greatest((F.length(piece) / 4).cast("int") - k, F.lit(0))
    place = (1 << _LOCAL) - 1

    def one(i: Column) -> Column:
        h = F.xxhash64(F.substring(piece, i * 4 + 1, F.lit(4 * k))).bitwiseAND(F.lit((1 << 32) - 1))
        return F.shiftleft(h, _LOCAL).bitwiseOR(F.lit(place) - i)

    return F.transform(F.sequence(F.lit(0), last), one)


def _window_minima(hashes: Column, side: int) -> Column:
    """Minima of each ``side`` * ``side`` neighbours (of all, if they are fewer): of ``side`` neighbours first, then of every ``side``-th of those."""
    near = lambda h: F.transform(h, lambda x, i: F.least(x, *[F.get(h, i + j) for j in range(1, side)]))

    def far(m: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(m) - side * side, F.lit(0)))
        return F.transform(starts, lambda i: F.least(*[F.get(m, i + j * side) for j in range(side)]))

    return let(let(hashes, near), far)


def winnowed(text: Column, offset: Column, k: int = K, side: int = SIDE) -> Column:
    """Entries ``hash << 31 | position`` that some window of the text selects, by position; ``offset`` is added to positions.

    Of equal least hashes the rightmost counts. A text of fewer than k characters is one k-gram, an empty one has none.
    """

    def build(code: Column) -> Column:
        windows = F.greatest((F.length(code) / 4).cast("int") - (k + side * side - 2), F.lit(1))
        stretches = F.sequence(F.lit(0), F.floor((windows - 1) / _STRETCH).cast("int"))

        def one(b: Column) -> Column:
            piece = F.substring(code, b * (4 * _STRETCH) + 1, F.lit(4 * (_STRETCH + k + side * side - 2)))
            base = b.cast("long") * _STRETCH + offset + ((1 << _LOCAL) - 1)
            entry = lambda m: F.shiftleft(F.shiftright(m, _LOCAL), _PLACE).bitwiseOR(base - m.bitwiseAND(F.lit((1 << _LOCAL) - 1)))
            return F.transform(F.array_distinct(_window_minima(let(piece, lambda p: _hashes(p, k)), side)), entry)

        return F.array_distinct(F.flatten(F.transform(stretches, one)))

    return F.when(F.length(text) > 0, let(F.encode(text, "UTF-32"), build)).otherwise(F.array().cast("array<bigint>"))


def hashes_of(entries: Column) -> Column:
    """The different hashes of a fingerprint."""
    return F.array_distinct(F.transform(entries, lambda e: F.shiftright(e, _PLACE)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; two empty ones are alike."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def told(entries: Column) -> Column:
    """A fingerprint as text: hash (hexadecimal) and position of each entry."""
    return F.array_join(F.transform(entries, lambda e: F.concat(F.hex(F.shiftright(e, _PLACE)), F.lit(":"), e.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("string"))), ",")


def fingerprints(docs: DataFrame, k: int = K, side: int = SIDE) -> DataFrame:
    """``doc_id`` and ``fingerprint``, an array of (hash, position) in order of positions, of each whole text. No shuffle.

    Nulls: a null text is empty and has an empty fingerprint; a null id stays. Repeated rows are rows like others, empty
    tables give no rows, other columns are not looked at. Texts of any length are taken in stretches of 4,096 windows.
    """
    entries = winnowed(no_text(F.col("text")), F.lit(0).cast("long"), k, side)
    pair = lambda e: F.struct(F.shiftright(e, _PLACE).alias("hash"), e.bitwiseAND(F.lit((1 << _PLACE) - 1)).alias("position"))
    return docs.select("doc_id", F.transform(entries, pair).alias("fingerprint"))


def _runs(docs: DataFrame) -> DataFrame:
    """``run, guest, doc_id, digest, text, copies`` of the different documents: each run holds neighbours by id, and as a guest the first of the next run.

    Only ids and digests are sorted. A document finds its run among the first keys of all runs, at most 65,536, which travel
    as one value; then the texts are shuffled once, so that a run is in one task.
    """
    rows = docs.select("doc_id", no_text(F.col("text")).alias("text")).withColumn("digest", F.unhex(F.md5("text")))
    found = materialise(rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"), F.first(F.length("text").cast("long")).alias("n_chars")), "winnow-keys")
    n, most, chars = found.agg(F.count(F.lit(1)), F.max("copies"), F.sum("n_chars")).first()
    if (most or 0) > 1:  # equal rows are one document, so that they cannot fill a run
        rows = rows.groupBy("doc_id", "digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("digest"))
    step = max(RUN_DOCS, -(-n // RUNS))
    side = max(1, round((-(-n // step)) ** 0.5))
    first = ranked(found.select(key.alias("key")), [F.col("key")], "winnow-order").where(F.col("place") % step == 0)
    shelf = first.groupBy(F.floor(F.col("place") / (step * side)).alias("shelf")).agg(F.array_sort(F.collect_list("key")).alias("keys"))
    starts = shelf.agg(F.transform(F.array_sort(F.collect_list(F.struct("shelf", "keys"))), lambda s: s["keys"]).alias("starts"))
    rows = rows.withColumns({"key": key, "starts": starts.scalar()})
    up_to = lambda keys: F.size(F.filter(keys, lambda k: k <= F.col("key"))) - 1
    rows = rows.withColumn("shelf", up_to(F.transform("starts", lambda s: F.get(s, F.lit(0)))))
    rows = rows.withColumn("keys", F.get("starts", F.col("shelf"))).withColumn("book", up_to(F.col("keys")))
    run = F.col("shelf") * side + F.col("book")
    runs = max(1, -(-n // step))
    own, seen = F.struct(run.alias("run"), F.lit(False).alias("guest")), F.struct(F.pmod(run - 1, F.lit(runs)).alias("run"), F.lit(True).alias("guest"))
    places = F.when(F.get("keys", F.col("book")) == F.col("key"), F.array(own, seen)).otherwise(F.array(own))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(chars or 0) // TASK_CHARS))
    return rows.select(F.explode(places).alias("place"), "doc_id", "digest", "text", "copies").select("place.*", "doc_id", "digest", "text", "copies").repartition(min(tasks, runs), "run")


def edited_fingerprints(docs: DataFrame, k: int = K, side: int = SIDE) -> DataFrame:
    """``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``; fingerprints are arrays of packed entries (``told``, ``hashes_of``).

    ``edited`` is the text with its last quarter replaced by the beginning of the next document's. Windows that lie within
    the three quarters which both share are hashed once. Documents follow one another by id (none: last), those of one id by
    digest; after the last comes the first. Nulls: a null text is empty. Repeated rows are one document and get the same
    result each. Empty tables give no rows; other columns are not looked at. Texts are shuffled once, in runs of neighbours.
    """
    zero = F.lit(0).cast("long")
    rows = _runs(docs)
    n = F.col("n_chars")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("quarter", F.floor(n / 4).cast("int"))
    rows = rows.withColumn("from", F.greatest(n - F.col("quarter") - (k + side * side - 2), zero))
    # Windows that begin before "from" lie in the part that stays.
    head = F.when(F.col("from") > 0, F.left("text", (n - F.col("quarter")).cast("int"))).otherwise("")
    rows = rows.withColumn("head", winnowed(head, zero, k, side))
    tail = winnowed(F.substring("text", (F.col("from") + 1).cast("int"), n.cast("int")), F.col("from"), k, side)
    rows = rows.withColumn("fingerprint", F.array_distinct(F.concat("head", tail)))
    rows = rows.withColumn("hashes", hashes_of(F.col("fingerprint")))
    by = Window.partitionBy("run").orderBy("guest", F.col("doc_id").asc_nulls_last(), "digest")
    rows = rows.withColumns({"next_text": F.lead("text").over(by), "next_hashes": F.lead("hashes").over(by)}).where("not guest")
    rows = rows.withColumn("edited", F.concat(F.left("text", (n - F.col("quarter")).cast("int")), F.left("next_text", F.col("quarter"))))
    # A next document of a few characters may leave no window beyond those of the head.
    rest = F.when((F.col("from") == 0) | (F.length("edited") - F.col("from") >= k + side * side - 1), F.substring("edited", (F.col("from") + 1).cast("int"), n.cast("int"))).otherwise("")
    tail = winnowed(rest, F.col("from"), k, side)
    rows = rows.withColumn("edited_fingerprint", F.array_distinct(F.concat("head", tail)))
    rows = rows.withColumn("near_edited", likeness(F.col("hashes"), hashes_of(F.col("edited_fingerprint"))))
    rows = rows.withColumn("near_next", likeness(F.col("hashes"), F.col("next_hashes")))
    columns = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*columns)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = edited_fingerprints(table(spark, sf_dir, "documents"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), told(F.col("fingerprint")).alias("fingerprint"), told(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
