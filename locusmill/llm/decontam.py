"""Benchmark decontamination: training words stream through a suffix automaton of the test items."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, materialise, received, shipped, table, tidied

WINDOW = 13
#: A document is contaminated where hit words are at least one in so many.
COVERAGE = 20
#: Words of test items in one automaton; more items go to further automata, one pass over the documents each.
BLOCK_WORDS = 200_000
#: Lower case for A-Z, space for the other ASCII characters that no word holds.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences. State 0 is the root."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        ids = self.vocabulary
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, seq in items:
            if seq:
                codes = [ids.setdefault(w, len(ids)) for w in seq]
                coded.append((item, codes))
                last = 0
                for c in codes:
                    last = self._extend(last, c)
        n = len(self.next)
        #: The state of the last ``window`` words, for states that match as many.
        self.windowed = [0] * n
        for v in sorted(range(1, n), key=self.length.__getitem__):
            if self.length[v] >= window:
                self.windowed[v] = v if self.length[self.link[v]] < window else self.windowed[self.link[v]]
        #: Items that hold a window, by the window's state; short items by the state of the whole of them.
        self.items: dict[int, list] = {}
        short: dict[int, list] = {}
        self.shortest = window
        for item, codes in coded:
            if len(codes) < window:
                v = 0
                for c in codes:
                    v = self.next[v][c]
                short.setdefault(v, []).append((len(codes), item))
                self.shortest = min(self.shortest, len(codes))
            else:
                v = size = 0
                for c in codes:
                    v, size = self.step(v, size, c)
                    if size >= window:
                        held = self.items.setdefault(self.windowed[v], [])
                        if item not in held[-1:]:
                            held.append(item)
        #: For a state the short items that end there: its own, and those of the states that its links reach.
        self.short: dict[int, list] = {}
        if short:
            for v in sorted(range(1, n), key=self.length.__getitem__):
                if found := short.get(v, []) + self.short.get(self.link[v], []):
                    self.short[v] = found

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(c)) is not None:
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def step(self, v: int, size: int, c: int) -> tuple[int, int]:
        """State and longest matching length after word c."""
        nxt = self.next
        while True:
            to = nxt[v].get(c)
            if to is not None:
                return to, size + 1
            if v == 0:
                return 0, 0
            v = self.link[v]
            size = self.length[v]

    def match(self, seq: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged stretches of hit words (end exclusive) and the items whose windows occur in ``seq``."""
        get, nxt, link, length, window, shortest, short = self.vocabulary.get, self.next, self.link, self.length, self.window, self.shortest, self.short
        hits: list[tuple[int, int]] = []
        found: set = set()
        v = size = 0
        for i, c in enumerate(map(get, seq)):
            if c is None:
                v = size = 0
                continue
            while True:
                to = nxt[v].get(c)
                if to is not None:
                    v, size = to, size + 1
                    break
                if v == 0:
                    size = 0
                    break
                v = link[v]
                size = length[v]
            if size < shortest:
                continue
            longest = 0
            if size >= window and (held := self.items.get(self.windowed[v])):
                found.update(held)
                longest = window
            if short:
                for n, item in short.get(v, ()):
                    if n <= size:
                        found.add(item)
                        longest = max(longest, n)
            if longest:
                start = i + 1 - longest
                if hits and start <= hits[-1][1]:
                    start = min(start, hits.pop()[0])
                hits.append((start, i + 1))
                while len(hits) > 1 and hits[-2][1] >= hits[-1][0]:
                    b = hits.pop()
                    a = hits.pop()
                    hits.append((min(a[0], b[0]), max(a[1], b[1])))
        return hits, found


def _blocks(items: DataFrame, most: int) -> Iterator[list]:
    """Test items as lists of (item id, words) of at most ``most`` words, streamed to the driver one block at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        seq = words((row["text"] or "").encode())
        if block and size + len(seq) > most:
            yield block
            block, size = [], 0
        block.append((row["item"], seq))
        size += len(seq)
    yield block


def _passes(docs: DataFrame, keep: list[str], items: DataFrame, window: int, block_words: int, cut: bool = False) -> DataFrame:
    """What each block of items hits, one pass a block; ``cut``: also ``_cut``, the text without the pass's hit words (null where none is hit)."""
    kept = [f for f in docs.schema.fields if f.name in keep]
    out = None
    for block in _blocks(items, block_words):
        model = shipped(docs.sparkSession, Automaton(block, window))

        def scan(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            automaton = received(model)
            for batch in batches:
                n_words, spans, found, rest = [], [], [], []
                for text in batch.column("_text"):
                    text = text.as_py() or b""
                    seq = words(text)
                    hits, held = automaton.match(seq)
                    n_words.append(len(seq))
                    spans.append([x for pair in hits for x in pair])
                    found.append(sorted(held - {None}))
                    rest.append(without(text, hits) if cut and hits else None)
                arrays = [batch.column(n) for n in batch.schema.names if n != "_text"]
                names = [n for n in batch.schema.names if n != "_text"]
                more = [pa.array(rest, pa.binary())] if cut else []
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string())), *more], names=[*names, "_n", "_spans", "_items", *["_cut"] * cut])

        schema = T.StructType([*kept, T.StructField("_n", T.LongType()), T.StructField("_spans", T.ArrayType(T.IntegerType())), T.StructField("_items", T.ArrayType(T.StringType())), *[T.StructField("_cut", T.BinaryType())] * cut])
        part = docs.select(*keep, F.col("_text_source").cast("binary").alias("_text")).mapInArrow(tidied(scan), schema)
        out = part if out is None else out.unionByName(part)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, nameless: bool = False) -> DataFrame:
    """Per row of ``docs``: ``row`` (the whole row as a struct), n_words, n_hit, spans (word places), items, contaminated.

    An item's windows are its runs of ``window`` words, or the whole item where it has fewer, but not none. Words inside an
    occurrence of a window are hit. The automaton of a block of items (at most ``block_words`` words, whatever the number
    of items) goes to every task; further blocks are matched by further passes whose spans are united by row.

    Nulls: a null text has no words and is never contaminated; an item without words matches nothing, and one
    without id only where ``nameless`` says so (its words are hit then, but items don't list it). Repeated rows are rows
    like others; empty tables give no rows.
    """
    return _found(docs, benchmark, window, block_words, nameless)


def _found(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, nameless: bool = False, cut: bool = False) -> DataFrame:
    """``contamination``; with ``cut`` and a single pass also ``_cut``, so that no second Python worker a task is needed to cut the texts."""
    bounded_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(F.lit(nameless) | F.col("item").isNotNull())
    base = docs.select(F.struct("*").alias("row"), F.col("text").alias("_text_source"))
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    if total > block_words:  # perhaps more than one block: rows need a key to unite what several passes find
        base = materialise(base.withColumn("_at", F.monotonically_increasing_id()), "docs")
        found = _passes(base, ["_at"], items, window, block_words)
        places = F.flatten(F.transform(F.collect_list("_spans"), lambda s: F.transform(F.sequence(F.lit(1), (F.size(s) / 2).cast("int")), lambda i: F.struct(F.get(s, 2 * i - 2).alias("a"), F.get(s, 2 * i - 1).alias("b")))))
        united = found.where("size(_spans) > 0").groupBy("_at").agg(F.array_sort(places).alias("_pairs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"))
        first = found.groupBy("_at").agg(F.max("_n").alias("_n"))
        rows = base.drop("_text_source").join(first, "_at").join(united, "_at", "left")
        empty = F.array().cast("array<struct<a:int,b:int>>")
        pairs, held = F.coalesce("_pairs", empty), F.coalesce("_items", F.array().cast("array<string>"))
    else:
        rows = _passes(base, ["row"], items, window, block_words, cut)
        pairs = F.when(F.size("_spans") > 0, F.transform(F.sequence(F.lit(1), (F.size("_spans") / 2).cast("int")), lambda i: F.struct(F.get("_spans", 2 * i - 2).alias("a"), F.get("_spans", 2 * i - 1).alias("b")))).otherwise(F.array().cast("array<struct<a:int,b:int>>"))
        held = F.col("_items")
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    add = lambda s, p: F.struct((s["n"] + F.greatest(F.lit(0), p["b"] - F.greatest(p["a"], s["end"]))).alias("n"), F.greatest(s["end"], p["b"]).alias("end"))
    out = rows.select("row", F.col("_n").alias("n_words"), pairs.alias("spans"), held.alias("items"), *[c for c in rows.columns if c == "_cut"])
    out = out.withColumn("n_hit", F.aggregate("spans", start, add, lambda s: s["n"]).cast("long"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * COVERAGE >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents whose hit words reach the limit of coverage; the others lose their hit words. Items without id count."""
    return _cut(_found(docs, benchmark, nameless=True, cut=True, **how).where(~F.col("contaminated")), docs.columns)


def cut_spans(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` with the hit words of every document taken out of its text (words keep what follows them)."""
    return _cut(_found(docs, benchmark, cut=True, **how), docs.columns)


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of ``spans`` (places of words, end exclusive; in order, may overlap) and what follows each up to the next word."""
    starts = [m.start() for m in _WORD.finditer(text)]
    starts.append(len(text))
    out, done = [], 0
    for a, b in spans:
        out.append(text[done : max(done, starts[a])])
        done = max(done, starts[b])
    out.append(text[done:])
    return b"".join(out)


def _cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, spans = batch.column(0), batch.column(1).to_pylist()
        if any(spans):
            parts = rows.flatten()
            at = rows.type.get_field_index("text")
            texts = [without(t.as_py(), [(s["a"], s["b"]) for s in held]) if held else t.as_py() for t, held in zip(parts[at].cast(pa.binary()), spans)]
            parts[at] = pa.array(texts, pa.binary()).cast(rows.type.field(at).type, safe=False)
            rows = pa.StructArray.from_arrays(parts, fields=list(rows.type))
        yield pa.RecordBatch.from_arrays([rows], names=["row"])


def _cut(found: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``_found`` as they were, without their hit words: one walk over each text with hits, none over others.

    A single pass has cut the texts itself. Two Python steps in one stage would be two workers for each task, which live on
    and hold what later steps keep in each. After several passes rows come from a shuffle, and are cut in a stage of their own.
    """
    if "_cut" in found.columns:
        return found.select(*[(F.coalesce(F.col("_cut").cast("string"), F.col("row.text")) if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in columns])
    rows = found.select("row", "spans")
    out = rows.mapInArrow(tidied(_cutting), T.StructType([rows.schema["row"]]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = contamination(docs, table(spark, sf_dir, "benchmark"), nameless=True)
    ids = F.array_join("items", ",")
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM b, range(1, greatest(1, len(w) - 12) + 1) t(i) WHERE len(w) > 0
), ks AS (SELECT DISTINCT k FROM iw), dw AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS win FROM d, ks, range(1, len(w) - k + 2) t(i)
), o AS (SELECT doc_id, i, dw.k, item FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM o) GROUP BY doc_id),
n AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
