"""Embedding near-dedup: an inverted multi-index. Codebooks on both halves of the vectors form a grid of cells."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, discard, materialise, received, shipped, small, table, tidied
from .graph import components

THRESHOLD = 0.95
#: Vectors that codebooks are fitted on at most, those whose ids have the smallest hashes; queries that set the number of cells.
SAMPLE, QUERIES = 16_384, 512
#: Vectors of a cell on average, and codewords of a half at most.
PER_CELL, MOST_WORDS = 12, 2048
#: Share of neighbours just at the threshold that the visited cells must hold, looked for from either side.
RECALL = 0.98
#: Members of a unit on average; members and visitors of a part of one that is too large.
UNIT = 1024
PART_MEMBERS, PART_VISITORS = 4096, 16_384


def nearest_cells(first: np.ndarray, second: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Multi-sequence traversal: places (i, j) in order of first[i] + second[j], both sorted, the nearest ``most``."""
    heap = [(float(first[0] + second[0]), 0, 0)]
    out = []
    while heap and len(out) < most:
        _, i, j = heapq.heappop(heap)
        out.append((i, j))
        if i + 1 < len(first):
            heapq.heappush(heap, (float(first[i + 1] + second[j]), i + 1, j))
        if i == 0 and j + 1 < len(second):
            heapq.heappush(heap, (float(first[0] + second[j + 1]), 0, j + 1))
    return out


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    words = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = _distances(x, words).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(words)
        np.add.at(sums, own, x)
        words[n > 0] = sums[n > 0] / n[n > 0, None]
        if (n == 0).any():
            words[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return words


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ words.T + (words * words).sum(axis=1)[None, :], 0)


class MultiIndex:
    """Codebooks of both halves, the units that cells lie in, and how many cells a query visits.

    A unit is a stretch of the cells of one codeword of the first half; codewords of the second half are in order along their main axis, so
    that near cells lie in one unit and a vector is sent once for many cells that it visits.
    """

    def __init__(self, sample: np.ndarray, total: int, threshold: float, recall: float) -> None:
        rng = np.random.default_rng(5)
        self.half = sample.shape[1] // 2
        k = int(np.clip(np.ceil(np.sqrt(total / PER_CELL)), 1, min(MOST_WORDS, len(sample))))
        self.books = [_k_means(part, k, rng) for part in (sample[:, : self.half], sample[:, self.half :])]
        second = self.books[1] - self.books[1].mean(axis=0)
        axis = np.linalg.svd(second, full_matrices=False)[2][0] if k > 1 else np.ones(second.shape[1])
        self.books[1] = self.books[1][np.argsort(second @ axis, kind="stable")]
        self.width = min(k, max(1, round(UNIT / PER_CELL)))
        # Neighbours just at the threshold, in random directions: how far down the traversal do their units lie?
        at = rng.choice(len(sample), QUERIES)
        a = sample[at]
        away = rng.normal(size=a.shape)
        away -= (away * a).sum(axis=1)[:, None] * a
        length = np.linalg.norm(away, axis=1)[:, None]
        away = np.where(length > 1e-12, away / np.maximum(length, 1e-12), 0)
        b = threshold * a + np.sqrt(1 - threshold**2) * away
        ranks = np.minimum(self._rank(a, self.unit_of(self.cells(b))), self._rank(b, self.unit_of(self.cells(a))))
        self.visits = int(min(k * k, np.quantile(ranks, recall, method="higher") + 1))

    def unit_of(self, cells: np.ndarray) -> np.ndarray:
        k = len(self.books[1])
        return cells // k * -(-k // self.width) + cells % k // self.width

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, : self.half], self.books[0]), _distances(x[:, self.half :], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.parts(x)
        return a.argmin(axis=1) * len(self.books[1]) + b.argmin(axis=1)

    def _rank(self, x: np.ndarray, units: np.ndarray) -> np.ndarray:
        """How many cells lie nearer to each vector than the nearest one of the given unit."""
        a, b = self.parts(x)
        k = len(self.books[1])
        across = -(-k // self.width)
        out = np.zeros(len(x), dtype=np.int64)
        for i, u in enumerate(units.tolist()):
            own = a[i, u // across] + b[i, u % across * self.width : (u % across + 1) * self.width].min()
            out[i] = np.searchsorted(np.sort(b[i]), own - a[i], side="left").sum()
        return out

    def visited(self, x: np.ndarray) -> np.ndarray:
        """Cells of each vector in the order of the traversal, its own first."""
        a, b = self.parts(x)
        k, most = len(self.books[1]), self.visits
        near = min(k, most)
        ia, ib = np.argsort(a, axis=1, kind="stable")[:, :near], np.argsort(b, axis=1, kind="stable")[:, :near]
        sa, sb = np.take_along_axis(a, ia, 1), np.take_along_axis(b, ib, 1)
        out = np.empty((len(x), min(most, near * near)), dtype=np.int64)
        for r in range(len(x)):
            got = nearest_cells(sa[r], sb[r], out.shape[1])
            i, j = np.array(got).T
            out[r] = ia[r, i] * k + ib[r, j]
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


_ENTRY = "own long, copies long, vector array<{kind}>, home long, visits array<long>"


def _indexing(index, dim: int):
    """Each vector with the unit of its own cell and those of the cells that it visits, its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(index)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                x = _unit(_matrix(batch.column(2), dim))
                if dim % 2:
                    x = np.column_stack((x, np.zeros(len(x))))
                units = [list(dict.fromkeys(u)) for u in model.unit_of(model.visited(x)).tolist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([u[0] for u in units], pa.int64()), pa.array(units, pa.list_(pa.int64()))], names=["own", "copies", "vector", "home", "visits"])

    return run


def _joining(dim: int, threshold: float):
    """Rows (part, unit, own, copies, vector, home, visits) come by part, members before visitors; gives (own, n, least): links, each counted once, and connection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, members, waiting, last = None, [], [], None
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def compare() -> None:
            """The waiting vectors against the members of their unit."""
            if not members or not waiting:
                return
            m_own, m_copies, m_x, m_visits = (list(chain.from_iterable(p)) if isinstance(p[0], list) else np.concatenate(p) for p in zip(*members))
            v_own, v_copies, v_x, v_home = (np.concatenate(p) for p in zip(*waiting))
            for at in range(0, len(v_own), 1024):
                own, copies, home = v_own[at : at + 1024], v_copies[at : at + 1024], v_home[at : at + 1024]
                hit = v_x[at : at + 1024] @ m_x.T >= threshold
                hit &= own[:, None] != m_own[None, :]
                i, j = np.nonzero(hit)
                if not len(i):
                    continue
                # Where a member visits the other's unit too, that pair is found there as well, and counts there for the member.
                back = np.fromiter((h in m_visits[b] for h, b in zip(home[i].tolist(), j.tolist())), dtype=bool, count=len(i))
                n = np.bincount(i, m_copies[j], minlength=len(own)).astype(np.int64)
                m = np.bincount(j[~back], copies[i[~back]], minlength=len(m_own)).astype(np.int64)
                # Least linked node, spread both ways until it stays: a spanning star for each group of this block.
                a, b = own.copy(), m_own.copy()
                while True:
                    a2, b2 = a.copy(), b.copy()
                    np.minimum.at(a2, i, b[j])
                    np.minimum.at(b2, j, a2[i])
                    if (a2 == a).all() and (b2 == b).all():
                        break
                    a, b = a2, b2
                keep = (n > 0) | (a != own)
                out.append((own[keep], n[keep], a[keep]))
                keep = (m > 0) | (b != m_own)
                out.append((m_own[keep], m[keep], b[keep]))

        def made() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["own", "n", "least"])

        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1], [True])))
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if parts[s] != part:
                    compare()
                    part, members, waiting, last = parts[s], [], [], None
                some = batch.slice(s, e - s)
                # Rows that repeat a vector under its own id are one.
                own = some.column(3).to_numpy()
                some = some.filter(pa.array(np.concatenate(([own[0] != last], own[1:] != own[:-1]))))
                last = own[-1]
                if not some.num_rows:
                    continue
                member, waits, own, copies, home = (some.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4, 6))
                x = _unit(_matrix(some.column(5), dim))
                if member.any():
                    visits = some.column(7).filter(pa.array(member)).to_pylist()
                    members.append((own[member], copies[member], x[member], visits))
                if waits.any():
                    waiting.append((own[waits], copies[waits], x[waits], home[waits]))
                    if sum(len(w[0]) for w in waiting) > 8192 and not member.any():
                        compare()
                        waiting = []
            if sum(len(o[0]) for o in out) > 50_000:
                yield made()
        compare()
        yield made()

    return run


def _search(distinct: DataFrame, dim: int, total: int, threshold: float, recall: float) -> DataFrame:
    """(own, n, least) for the vectors of one dimension: ``distinct`` has own, copies and vector."""
    spark = distinct.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = distinct.orderBy(F.xxhash64("own"), "own").limit(SAMPLE).select("vector").toArrow().column(0).combine_chunks()
    x = _unit(_matrix(sample, dim))
    if dim % 2:
        x = np.column_stack((x, np.zeros(len(x))))
    index = shipped(spark, MultiIndex(x, total, threshold, recall))
    kind = distinct.schema["vector"].dataType.elementType.simpleString()
    entries = materialise(distinct.select("own", "copies", "vector").mapInArrow(tidied(_indexing(index, dim)), _ENTRY.format(kind=kind)), "vector-entries")
    held = entries.select("home", F.explode("visits").alias("unit")).groupBy("unit").agg(F.count_if(F.col("home") == F.col("unit")).alias("members"), F.count(F.lit(1)).alias("visitors")).where("members > 0")
    # A unit that is too large is dealt: its members to m parts, those that visit to v; each part of one meets each of the other.
    held = held.select("unit", F.ceil(F.col("members") / PART_MEMBERS).cast("int").alias("m"), F.when(F.col("members") <= PART_MEMBERS, F.ceil(F.col("visitors") / PART_VISITORS)).otherwise(F.greatest(F.ceil(F.col("members") / PART_MEMBERS), F.ceil(F.col("visitors") / PART_VISITORS))).cast("int").alias("v"))
    held = materialise(held, "vector-units")
    rows = entries.select("own", "copies", "vector", "home", "visits", F.explode("visits").alias("unit")).join(small(held), "unit")
    a, b = F.pmod(F.xxhash64("own"), F.col("m")).cast("int"), F.pmod(F.xxhash64("own", F.lit(1)), F.col("v")).cast("int")
    is_member = F.col("home") == F.col("unit")
    as_member = F.transform(F.sequence(F.lit(0), F.col("v") - 1), lambda j: F.struct(a.alias("a"), j.alias("b"), is_member.alias("member"), (j == b).alias("waits")))
    as_visitor = F.transform(F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda i: ~is_member | (i != a)), lambda i: F.struct(i.alias("a"), b.alias("b"), F.lit(False).alias("member"), F.lit(True).alias("waits")))
    at = F.when(is_member, F.concat(as_member, as_visitor)).otherwise(as_visitor)
    parts = rows.select(F.explode(at).alias("at"), "unit", "own", "copies", "vector", "home", F.when(is_member, F.col("visits")).alias("visits"))
    parts = parts.select(F.xxhash64("unit", "at.a", "at.b").alias("part"), "at.member", "at.waits", "own", "copies", "vector", "home", "visits")
    parts = parts.repartition(n, "part").sortWithinPartitions("part", F.desc("member"), "own")
    return parts.mapInArrow(tidied(_joining(dim, threshold)), "own long, n long, least long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors`` (vec_id, embedding).

    Equal vectors (by two 64-bit hashes of their components) are one entry of the index that counts its copies; each vector visits the cells nearest to it in the
    order of the traversal, as many as let a pair just at the threshold be found, from one side or the other, with
    probability ``recall``. Every pair found is checked by its cosine in double precision. A pair that both sides find is
    counted once. Only vectors of equal length are compared.

    Nulls: vectors that are null, empty, zero or hold null or non-finite components link with nothing; rows without id have
    no links and no component. Rows that repeat an id link like others, but share its component. Empty tables give no rows.
    """
    bounded_batches(vectors.sparkSession)
    usable = "embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)"
    narrow = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if narrow else "array<double>").alias("embedding"))
    good = rows.where(usable).where("vec_id is not null").select("vec_id", "embedding", F.xxhash64("embedding").alias("h"), F.xxhash64(F.lit("other"), "embedding").alias("g"))
    named = materialise(good.select("vec_id", "h", "g", F.size("embedding").alias("dim")), "vector-names")
    owners = materialise(named.groupBy("h", "g", "dim").agg(F.min("vec_id").alias("own"), F.count(F.lit(1)).alias("copies")), "vector-owners")
    sizes = owners.groupBy("dim").count().orderBy("dim").collect()
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = None
    for row in sizes:
        own = small(owners.where(F.col("dim") == row["dim"]).drop("dim"))
        distinct = good.join(own, (good["vec_id"] == own["own"]) & (good["h"] == own["h"]) & (good["g"] == own["g"])).select("own", "copies", F.col("embedding").alias("vector"))
        part = _search(distinct, row["dim"], row["count"], threshold, recall)
        found = part if found is None else found.union(part)
    found = materialise(found, "vector-links")
    copies = materialise(named.join(small(owners.drop("dim")), ["h", "g"]).select("vec_id", "own", "copies"), "vector-copies")
    ties = copies.where("vec_id <> own").select(F.col("vec_id").alias("a"), F.col("own").alias("b"))
    groups = components(found.where("own <> least").select("own", "least").union(ties))
    n = found.groupBy("own").agg(F.sum("n").alias("n"))
    counts = copies.join(n, "own", "left").select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    counts = counts.groupBy("vec_id").agg(F.max("n_links").alias("n_links"))
    out = rows.select(F.col("vec_id").alias("id")).join(counts, F.col("id") == F.col("vec_id"), "left").join(groups, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    discard(named, owners)
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op3_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs: for small tables only.
OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), fit AS (
  SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (SELECT a AS id, b AS root FROM l UNION SELECT l.a, r.root FROM l JOIN r ON l.b = r.id)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, least(vec_id, coalesce(low, vec_id)) = vec_id AS kept
FROM v LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id) LEFT JOIN (SELECT id AS vec_id, min(root) AS low FROM r GROUP BY id) USING (vec_id)
"""
