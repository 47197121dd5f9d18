"""Ranked lexical search: for each item the highest-scoring documents, by branch and bound over trees of maxima.

Documents are indexed in segments, ranges of ids that one task holds. In a segment every term has a tree: its leaves are the
term's largest value in 32 neighbouring documents, every node above holds the largest of eight. An item adds up the trees of
its terms, weighted; the node of the highest sum is opened first, and what cannot reach the best found so far stays shut.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, discard, materialise, no_text, received, shipped, table, tidied, word_lists

#: Documents and postings of one segment at most, documents of a leaf, children of a node.
SEGMENT_DOCS, SEGMENT_POSTINGS, LEAF, FANOUT = 4096, 2_000_000, 32, 8
#: Terms of the items (repeats in different items counted) that one index is made for; more items take another pass over the documents.
BLOCK_TERMS = 500_000
#: One segment in so many is searched before the others, which then begin with its scores as what must be reached.
SCOUTS = 16
K, B = 10, 90
_INDEX = "docs array<long>, sizes array<long>, terms array<int>, df array<int>, at array<int>, tf array<long>, n long, l long"


class Segment:
    """Postings of a few documents, kept in order of ids (null last)."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.terms: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.postings = self.n = self.l = 0

    def add(self, doc: int | None, text: bytes, vocabulary: dict[bytes, int]) -> None:
        size, held = 0, []
        for words in word_lists(text):
            size += len(words)
            ids = np.fromiter(map(vocabulary.get, words, [-1] * len(words)), dtype=np.int64, count=len(words))
            held.append(ids[ids >= 0])
        self.n += size > 0
        self.l += size
        if not held or not any(map(len, held)):
            return
        terms, tf = np.unique(np.concatenate(held), return_counts=True)
        self.docs.append(doc)
        self.sizes.append(size)
        self.terms.append(terms)
        self.tf.append(tf)
        self.postings += len(terms)

    def full(self) -> bool:
        return len(self.docs) >= SEGMENT_DOCS or self.postings >= SEGMENT_POSTINGS

    def batch(self) -> pa.RecordBatch:
        order = sorted(range(len(self.docs)), key=lambda i: (self.docs[i] is None, self.docs[i] or 0))
        counts = [len(self.terms[i]) for i in order]
        terms = np.concatenate([np.zeros(0, dtype=np.int64), *[self.terms[i] for i in order]])
        tf = np.concatenate([np.zeros(0, dtype=np.int64), *[self.tf[i] for i in order]])
        at = np.repeat(np.arange(len(order)), counts)
        by_term = np.argsort(terms, kind="stable")
        held, df = np.unique(terms, return_counts=True)
        lists = [([self.docs[i] for i in order], pa.int64()), ([self.sizes[i] for i in order], pa.int64()), (held, pa.int32()), (df, pa.int32()), (at[by_term], pa.int32()), (tf[by_term], pa.int64())]
        columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind)) for x, kind in lists]
        return pa.RecordBatch.from_arrays([*columns, pa.array([self.n], pa.int64()), pa.array([self.l], pa.int64())], names=["docs", "sizes", "terms", "df", "at", "tf", "n", "l"])


def _indexed(docs: DataFrame, vocabulary) -> DataFrame:
    """Segments with the postings of the terms in ``vocabulary``, a written table; texts are read once and not shuffled."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(vocabulary)
        segment = Segment()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                segment.add(doc, text.as_py(), known)
                if segment.full():
                    yield segment.batch()
                    segment = Segment()
        yield segment.batch()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_text(F.col("text")).alias("text"))
    scout = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SCOUTS)) == 0
    return materialise(rows.mapInArrow(tidied(build), _INDEX).withColumn("scout", scout), "search-index")


class Trees:
    """The trees of maxima of one segment."""

    def __init__(self, row: dict, n: int, l: int, b: int) -> None:
        self.docs: list[int | None] = row["docs"].as_py()
        self.terms, df, self.at, tf = (row[c].values.to_numpy(zero_copy_only=False) for c in ("terms", "df", "at", "tf"))
        sizes = row["sizes"].as_py()
        m = np.array([100 - b + (b * s * n) // l for s in sizes], dtype=np.int64)
        self.value = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.at])
        leaves = -(-len(sizes) // LEAF)
        place = np.repeat(np.arange(len(self.terms), dtype=np.int64), df) * leaves + self.at // LEAF
        #: Where the postings of a term in a leaf begin; those of the next leaf, or of the next term, begin where they end.
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=len(self.terms) * leaves))))
        self.leaves = leaves
        level = np.zeros(len(self.terms) * leaves, dtype=np.int64)
        if len(place):
            starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            level[place[starts]] = np.maximum.reduceat(self.value, starts)
        self.levels = [level.reshape(len(self.terms), leaves)]
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            pad = -below.shape[1] % FANOUT
            wide = np.pad(below, ((0, 0), (0, pad)))
            self.levels.append(wide.reshape(len(self.terms), -1, FANOUT).max(axis=2))
        self.opened = 0

    def scores(self, rows: np.ndarray, weights: np.ndarray, leaf: int) -> np.ndarray:
        starts, ends = self.begin[rows * self.leaves + leaf], self.begin[rows * self.leaves + leaf + 1]
        sizes = ends - starts
        took = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        out = np.zeros(LEAF, dtype=np.int64)
        np.add.at(out, self.at[took] - leaf * LEAF, np.repeat(weights, sizes) * self.value[took])
        return out

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, best: list[tuple], least: int) -> None:
        """Improve ``best``, the ``k`` best (-score, id is null, id) in order, by this segment's documents of at least ``least``.

        A node whose bound equals the last score is opened as well, unless its first id is beyond the last one's.
        """
        rows = np.searchsorted(self.terms, terms)
        there = rows < len(self.terms)
        there[there] = self.terms[rows[there]] == terms[there]
        rows, weights = rows[there], weights[there]
        if not len(rows):
            return
        key = lambda i: (self.docs[i] is None, self.docs[i] or 0)
        top = len(self.levels) - 1
        heap = [(-int(weights @ self.levels[top][rows, 0]), 0, top, 0)]
        while heap:
            bound, first, level, node = heapq.heappop(heap)
            if -bound < max(1, least) or len(best) == k and bound > best[-1][0]:
                return
            if len(best) == k and (bound, *key(first)) > best[-1]:
                continue
            self.opened += 1
            if level:
                begin = node * FANOUT
                part = weights @ self.levels[level - 1][rows, begin : begin + FANOUT]
                width = LEAF * FANOUT ** (level - 1)
                for j, x in enumerate(part.tolist()):
                    if x > 0:
                        heapq.heappush(heap, (-x, (begin + j) * width, level - 1, begin + j))
                continue
            found = self.scores(rows, weights, node)
            for j in np.flatnonzero(found >= max(1, least)).tolist():
                one = (-int(found[j]), *key(node * LEAF + j))
                if len(best) < k or one < best[-1]:
                    best.append(one)
                    best.sort()
                    del best[k:]


def _searched(index: DataFrame, model, k: int) -> DataFrame:
    """``item, doc_id, score``: of each task the best documents of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, items, weights, least, n, l, b = received(model)
        best: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("docs", "sizes", "terms", "df", "at", "tf")}
                if not len(row["docs"]):
                    continue
                trees = Trees(row, n, l, b)
                for found, terms, must in zip(best, items, least):
                    trees.search(terms, weights[terms], k, found, must)
        rows = [(number, None if nameless else doc, -score) for number, found in zip(numbers, best) for score, nameless, doc in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], names=["item", "doc_id", "score"])

    return index.select("docs", "sizes", "terms", "df", "at", "tf").mapInArrow(tidied(run), "item long, doc_id long, score long")


def _weights(index: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """The weight of each term, the documents that hold a term, and the terms in all."""
    n, l = index.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()
    counts = index.select(F.inline(F.arrays_zip("terms", "df"))).groupBy("terms").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, dtype=np.int64)
    df[counts.column("terms").to_numpy()] = counts.column("df").to_numpy()
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64), n, l


def _first(rows: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _block(docs: DataFrame, items: DataFrame, k: int, b: int) -> DataFrame:
    """``item, rank, doc_id, score`` for items that are few enough to be sent to every task."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    numbers, terms = [], []
    for number, text in items.select("item", "text").collect():
        numbers.append(number)
        terms.append(np.array(sorted({vocabulary.setdefault(w, len(vocabulary)) for words in word_lists(text.encode()) for w in words}), dtype=np.int64))
    index = _indexed(docs, shipped(spark, vocabulary))
    weights, n, l = _weights(index, len(vocabulary))
    terms = [ids[weights[ids] > 0] for ids in terms]
    least = dict.fromkeys(numbers, 0)
    search = lambda part: _searched(index.where(part), shipped(spark, (numbers, terms, weights, [least[x] for x in numbers], n, l, b)), k)
    scouted = materialise(_first(search("scout"), k), "search-scouts")
    least |= {r["item"]: r["score"] for r in scouted.where(F.col("rank") == k).select("item", "score").collect()}
    out = materialise(_first(scouted.drop("rank").unionByName(search("not scout")), k), "search-found")
    discard(index, scouted)
    return out


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, b: int = B, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """For each row of ``items`` (item_id, text) its ``k`` highest-scoring documents with a score above 0: ``item_id, rank, doc_id, score``.

    Every document is searched, exactly: bounds are sums of maxima, so that what stays shut cannot belong to the result. Items
    are taken in blocks of about ``block_terms`` terms, each with one pass over the documents; only postings of the block's terms
    are kept. Equal scores go by id (null last); repeated documents are documents of their own, repeated items items of
    their own. Items and documents without terms, and empty tables, give no rows. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    numbered = materialise(items.select("item_id", no_text(F.col("text")).alias("text"), F.monotonically_increasing_id().alias("item")), "search-items")
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    terms = numbered.agg(F.coalesce(F.sum(F.size(F.array_distinct(words))), F.lit(0))).first()[0]
    blocks = max(1, -(-terms // block_terms))
    found = [_block(docs, numbered.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block), k, b) for block in range(blocks)]
    return reduce(DataFrame.unionByName, found).join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS tf FROM d GROUP BY doc_id, w),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM size),
weight AS (SELECT w, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), whole),
m AS (SELECT doc_id, 10 + (90 * n * n_docs) // l AS m FROM size, whole),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN tf USING (w) JOIN weight USING (w) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""
