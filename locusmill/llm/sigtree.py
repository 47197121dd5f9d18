"""N-gram Jaccard join: signature trees over sets of word shingles.

The top of the tree is spread over the cluster, the rest is built in tasks. Top nodes are buckets of min-hash bands, so many
that a pair at the threshold meets in one of them but for a chance of ``MISS``; buckets that share documents form one
subtree. Within it, documents lie in units of bounded size. A task builds a tree for each unit: nodes hold the OR of
their documents' token bitmaps and the range of set sizes. Two trees (or one with itself) are walked together, and node
pairs go where their largest possible overlap is too small; what is left is decided by the sets themselves. Words of a
unit are told apart by their bytes, so that no hash decides a link.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, bounded_batches, discard, materialise, mixed, run_hashes, run_numbers, small, table, tidied, word_digests, word_places, worker_state
from .graph import components

ROWS = 4
MISS = 1e-9
#: Documents and shingles of one unit.
UNIT_DOCS, UNIT_SHINGLES = 256, 300_000
BITS = 2048
LEAF, FAN = 8, 4
#: Texts that are hashed at once.
_TOGETHER = 50
_SEEDS = np.random.default_rng(77).integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of ``rows`` min-hashes that leave a pair at the threshold unseen with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


_FOLD = bytes(32 if c in b"\t\n\v\f\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def fold(text: bytes | None) -> bytes:
    """A text with A-Z in lower case and spaces between words."""
    return (text or b"").translate(_FOLD)


def signed_sets(texts: list[bytes | None], k: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text hashes of its distinct shingles (of the whole sequence where it has fewer words), and a digest of the set.

    A shingle has two hashes of 64 bits: shingles are one only if both agree.
    """
    raw = b" ".join(folded := [fold(t) for t in texts])
    starts, ends = word_places(np.frombuffer(raw, dtype=np.uint8))
    words = word_digests(raw, starts, ends)
    runs = [run_hashes(h, k) for h in words]
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in folded)]))
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        if a == b:
            yield np.zeros(0, dtype=np.uint64), b""
            continue
        low, high = (h[a : b - k + 1] if b - a >= k else run_hashes(w[a:b], b - a) for h, w in zip(runs, words))
        order = np.argsort(low)
        low, high = low[order], high[order]
        same = low[1:] == low[:-1]
        if same.any():
            if (same & (high[1:] != high[:-1])).any():
                order = np.lexsort((high, low))
                low, high = low[order], high[order]
                same = (low[1:] == low[:-1]) & (high[1:] == high[:-1])
            first = np.concatenate(([True], ~same))
            low, high = low[first], high[first]
        yield low, hashlib.blake2b(low.tobytes() + int(high.sum()).to_bytes(8, "little"), digest_size=16).digest()


def _keys(sets: np.ndarray, n: int, rows: int) -> np.ndarray:
    least = np.full(n * rows, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(sets), 4096):
        part = sets[at : at + 4096]
        for j in range(0, n * rows, 16):
            seeds = _SEEDS[j : min(j + 16, n * rows)]
            least[j : j + len(seeds)] = np.minimum(least[j : j + len(seeds)], np.multiply.outer(seeds, part).min(axis=1))
    powers = _SEEDS[-rows:]
    return mixed((least.reshape(n, rows) * powers).sum(axis=1) + np.arange(n, dtype=np.uint64))


def _signing(k: int, n: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state().clear()
        for whole in batches:
            for at in range(0, whole.num_rows, _TOGETHER):
                batch = whole.slice(at, _TOGETHER)
                sizes, digests, keys = [], [], []
                for hashes, digest in signed_sets(batch.column(1).to_pylist(), k):
                    sizes.append(len(hashes))
                    digests.append(digest)
                    keys.append(_keys(hashes, n, rows).view(np.int64) if len(hashes) else np.empty(0, np.int64))
                ends = np.concatenate(([0], np.cumsum([len(x) for x in keys])))
                keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys) if keys else []).cast(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), keys], names=["doc_id", "name", "n_shingles", "digest", "bands"])

    return run


class Tree:
    """A signature tree over some sets: levels of nodes with OR-bitmaps, size ranges and the most shingles a bitmap hides."""

    def __init__(self, sets: list[np.ndarray], order: np.ndarray) -> None:
        self.order = order
        words = BITS // 64
        maps = np.zeros((len(order), words), dtype=np.uint64)
        for i, d in enumerate(order):
            bits = sets[d] % BITS
            np.bitwise_or.at(maps[i], bits // 64, np.uint64(1) << (bits % 64).astype(np.uint64))
        size = np.array([len(sets[d]) for d in order], dtype=np.int64)
        hidden = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, size, size, hidden)]
        for width in [LEAF, *[FAN] * 20]:
            maps, lo, hi, hidden = self.levels[-1]
            if len(maps) == 1:
                break
            at = np.arange(0, len(maps), width)
            self.levels.append((np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(hidden, at)))

    def width(self, level: int) -> int:
        return LEAF if level == 1 else FAN


def join_trees(a: Tree, b: Tree, threshold: tuple[int, int]) -> Iterator[tuple[int, int]]:
    """Pairs of documents (by place in their lists) that the trees cannot tell apart; one tree with itself gives each pair once."""
    num, den = threshold
    same = a is b
    level = max(len(a.levels), len(b.levels)) - 1
    pairs = np.array([[0, 0]])
    while True:
        la, lb = min(level, len(a.levels) - 1), min(level, len(b.levels) - 1)
        (ma, loa, hia, sa), (mb, lob, hib, sb) = a.levels[la], b.levels[lb]
        left = []
        for at in range(0, len(pairs), 20_000):
            x, y = pairs[at : at + 20_000].T
            fits = (den * hia[x] >= num * lob[y]) & (den * hib[y] >= num * loa[x])
            x, y = x[fits], y[fits]
            overlap = np.bitwise_count(ma[x] & mb[y]).sum(axis=1, dtype=np.int64) + np.minimum(sa[x], sb[y])
            overlap = np.minimum(overlap, np.minimum(hia[x], hib[y]))
            # intersection >= t / (1 + t) of both sizes together
            fits = (num + den) * overlap >= num * (loa[x] + lob[y])
            left.append(np.column_stack((x[fits], y[fits])))
        pairs = np.concatenate(left) if left else np.empty((0, 2), np.int64)
        if level == 0 or not len(pairs):
            break
        down = [(np.arange(w)[None, :] + pairs[:, [i]] * w if l == level else pairs[:, [i]]) for i, (l, w) in enumerate(((la, a.width(level)), (lb, b.width(level))))]
        limit = [len(t.levels[l - 1][0]) if l == level else len(t.levels[l][0]) for t, l in ((a, la), (b, lb))]
        x, y = np.broadcast_arrays(down[0][:, :, None], down[1][:, None, :])
        x, y = x.reshape(-1), y.reshape(-1)
        inside = (x < limit[0]) & (y < limit[1])
        if same:
            inside &= x <= y
        pairs = np.column_stack((x[inside], y[inside]))
        level -= 1
    for i, j in pairs.tolist():
        if not same or i < j:
            yield int(a.order[i]), int(b.order[j])


class Sets:
    """Documents of a unit pair, united as links are found; a pair already united is not compared again."""

    def __init__(self, docs: list[int]) -> None:
        self.up = list(range(len(docs)))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def unite(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def links(docs: list[int], sets: list[np.ndarray], sides: list[int], threshold: tuple[int, int], groups: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links among one unit (all sides equal), or between side 0 and side 1.

    ``groups``: documents of the same group are known to be joined already.
    """
    num, den = threshold
    held = Sets(docs)
    first: dict[int, int] = {}
    for i, g in enumerate(groups):
        held.unite(first.setdefault(g, i), i)
    trees = []
    for side in sorted(set(sides)):
        place = [i for i, s in enumerate(sides) if s == side]
        order = sorted(place, key=lambda i: (len(sets[i]), sets[i][:2].tolist(), docs[i]))
        trees.append(Tree(sets, np.array(order)))
    out = []
    for i, j in join_trees(trees[0], trees[-1], threshold):
        if held.root(i) != held.root(j):
            a, b = sets[i], sets[j]
            common = len(np.intersect1d(a, b, assume_unique=True))
            if den * common >= num * (len(a) + len(b) - common):
                held.unite(i, j)
                out.append((docs[i], docs[j]))
    return out


def unit_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Each text's set of shingles as sorted numbers, equal for equal shingles among these texts only."""
    words = Words()
    seqs = [fold(t).split() for t in texts]
    gap = np.array([2**31], dtype=np.int64)  # no word's number: a run across two texts is none
    parts, owners, short = [], [], {}
    for i, seq in enumerate(seqs):
        numbers = words.numbers(seq)
        if len(seq) < k:
            short[i] = tuple(numbers.tolist())
        else:
            parts += [numbers, gap]
            owners += [np.full(len(seq) - k + 1, i), np.full(k, -1)]
    line = np.concatenate(parts) if parts else np.empty(0, np.int64)
    runs = run_numbers(line, k)
    owner = np.concatenate(owners)[: len(runs)] if owners else np.empty(0, np.int64)
    runs, owner = runs[owner >= 0], owner[owner >= 0]
    pairs = np.unique((owner.astype(np.int64) << 32) | runs)
    cuts = np.searchsorted(pairs >> 32, np.arange(len(texts) + 1))
    sets = [pairs[a:b] & (2**32 - 1) for a, b in zip(cuts, cuts[1:])]
    whole: dict[tuple, int] = {}
    for i, seq in short.items():
        sets[i] = np.array([2**32 + whole.setdefault(seq, len(whole))] if seq else [], dtype=np.int64)
    return sets


def _joining(k: int, threshold: tuple[int, int]):
    """Rows come in order of unit, side, doc_id and name; columns: unit, side, group, doc_id, text. A document has an entry for each of its sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        out: list[tuple[int, int]] = []

        def made() -> pa.RecordBatch:
            a = np.array(out, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

        def found() -> list[tuple[int, int]]:
            if len(rows) < 2:
                return []
            sides, groups, docs, texts = zip(*rows)
            return links(list(docs), unit_sets(texts, k), list(sides), threshold, list(groups))

        for batch in batches:
            for u, *row in zip(*[batch.column(i).to_pylist() for i in range(4)], batch.column(4)):
                if u != unit:
                    out += found()
                    unit, rows = u, []
                side, group, doc, text = *row[:3], row[3].as_py()
                if not rows or (rows[-1][0], *rows[-1][2:]) != (side, doc, text):
                    rows.append((side, group, doc, text))
            if len(out) > 10_000:
                yield made()
                out = []
        out += found()
        yield made()

    return run


def _verified(texts: DataFrame, members: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """Links found within units. ``members``: unit, side, grp, doc_id, name (of a text of the document); a text can be in several units."""
    rows = texts.join(small(members), ["doc_id", "name"]).select("unit", "side", "grp", "doc_id", "name", "text")
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "unit").sortWithinPartitions("unit", "side", "doc_id", "name").drop("name")
    return rows.mapInArrow(tidied(_joining(k, threshold)), "a long, b long")


def _roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (doc_id, ...) with ``grp``: their component under ``edges``, or themselves."""
    found = components(edges)
    return nodes.join(found, nodes["doc_id"] == found["node"], "left").select(nodes["*"], F.coalesce("component", "doc_id").alias("grp"))


def similar_sets(docs: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs`` (doc_id, text).

    Equal sets are one representative, that of least id. Its bands give subtrees; within each, documents are dealt to units
    of bounded size. Links are sought first inside units, then among the first documents of each unit's groups; so a group
    of near copies, however large, costs about its size. Last come those pairs of units that are not one group already, so that
    no link between different sets that share a bucket is left out. Every link is an exact one: a pair counts only if its sets
    say so.

    Nulls: null and empty texts have no set and link with nothing; rows without id take no part and have no component. Rows
    of the same id are one document: it has the links of all of them, each text under its hash as a name. Empty tables give
    no rows. Extra columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    num, den = threshold
    n = bands(num / den)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("name"))
    signed = materialise(rows.mapInArrow(tidied(_signing(k, n, ROWS)), "doc_id long, name long, n_shingles long, digest binary, bands array<long>"), "signatures")
    some = signed.where("doc_id is not null and n_shingles > 0")
    owners = materialise(some.groupBy("digest").agg(F.min("doc_id").alias("owner")), "set-owners")
    owned = some.select("doc_id", "digest").join(owners, "digest").where("doc_id <> owner").select(F.col("doc_id").alias("a"), F.col("owner").alias("b"))

    distinct = some.join(owners, (some["doc_id"] == owners["owner"]) & (some["digest"] == owners["digest"]), "left_semi")
    keyed = distinct.select("doc_id", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    near = keyed.join(buckets, "band").where("doc_id <> least").select("doc_id", "least")
    trees = components(near)

    placed = trees.select(F.col("node").alias("doc_id"), F.col("component").alias("tree")).join(distinct.groupBy("doc_id", "name").agg(F.max("n_shingles").alias("size")), "doc_id")
    units = lambda: F.greatest(F.ceil(F.count(F.lit(1)) / UNIT_DOCS), F.ceil(F.sum("size") / UNIT_SHINGLES)).cast("long").alias("units")
    placed = placed.join(placed.groupBy("tree").agg(units()), "tree").select("doc_id", "name", "tree", "size", F.when(F.col("units") > 1, F.pmod(F.xxhash64("doc_id", "name"), F.col("units"))).otherwise(0).alias("part"), "units")
    placed = materialise(placed, "set-units")
    discard(trees)

    # Only texts that meet others are read from here on.
    texts = materialise(rows.where("doc_id is not null").join(small(placed.select("doc_id", "name")), ["doc_id", "name"], "left_semi"), "set-texts")
    own = placed.select(F.xxhash64("tree", "part").alias("unit"), F.lit(0).alias("side"), F.col("doc_id").alias("grp"), "doc_id", "name")
    edges = materialise(_verified(texts, own, k, threshold), "set-links")

    wide = placed.where("units > 1")
    if not wide.isEmpty():
        # Groups of different units meet by their first documents, level by level, while that makes them fewer.
        grouped = materialise(_roots(wide, edges), "set-groups")
        before = None
        while True:
            heads = grouped.where("doc_id = grp").select("tree", "doc_id", "name", "grp")
            count = heads.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / UNIT_DOCS).cast("long").alias("units"), F.count(F.lit(1)).alias("n"))
            count = materialise(count.where("n > 1"), "set-heads")
            total = count.agg(F.sum("n")).first()[0] or 0
            if not total or (before is not None and total > 0.7 * before):
                break
            before = total
            again = heads.join(count, "tree").select(F.xxhash64("tree", F.pmod(F.xxhash64("doc_id", "name", F.lit(total)), F.col("units"))).alias("unit"), F.lit(0).alias("side"), "grp", "doc_id", "name")
            old = edges, grouped
            edges = materialise(edges.union(_verified(texts, again, k, threshold)), "set-links")
            grouped = materialise(_roots(wide, edges), "set-groups")
            discard(count, *old)
        # Pairs of units that still hold different groups.
        held = grouped.groupBy("tree", "part").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"))
        held = materialise(held, "set-parts")
        a, b = held.alias("a"), held.alias("b")
        open_ = a.join(b, (F.col("a.tree") == F.col("b.tree")) & (F.col("a.part") < F.col("b.part")) & ((F.col("a.lo") != F.col("b.lo")) | (F.col("a.hi") != F.col("b.hi")) | (F.col("a.lo") != F.col("a.hi"))))
        side = F.explode(F.array(F.struct(F.col("a.part").alias("part"), F.lit(0).alias("side")), F.struct(F.col("b.part").alias("part"), F.lit(1).alias("side")))).alias("s")
        pairs = open_.select(F.col("a.tree").alias("tree"), F.xxhash64("a.tree", "a.part", "b.part").alias("unit"), side).select("tree", "unit", "s.part", "s.side")
        across = materialise(pairs.join(grouped, ["tree", "part"]).select("unit", "side", "grp", "doc_id", "name"), "set-across")
        old = edges
        edges = materialise(edges.union(_verified(texts, across, k, threshold)), "set-links")
        discard(across, grouped, held, old)
    discard(texts, placed)

    found = materialise(components(edges.union(owned)), "set-components")
    out = signed.select("doc_id", "n_shingles").join(found, signed["doc_id"] == found["node"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` with one document of each group, that of least id; rows without id stay, and all columns do."""
    lost = similar_sets(docs, k, threshold).where("doc_id <> component_id").select(F.col("doc_id").alias("_lost")).distinct()
    lost = small(materialise(lost, "lost"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"))
    return rows.join(lost, F.col("_id") == F.col("_lost"), "left_anti").select("_row.*")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"), 4, (85, 100))


#: Sets by exact shingles, links by counting shared shingles, components by walking links; equal sets are one node.
OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END)) AS x FROM d
), u AS (SELECT x, min(doc_id) AS node, len(x) AS n FROM s WHERE len(x) > 0 GROUP BY x),
g AS (SELECT node, n, unnest(x) AS x FROM u),
p AS (
  SELECT a.node AS a, b.node AS b FROM g a JOIN g b ON a.x = b.x AND a.node < b.node
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT node, node AS seen FROM u UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.x) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id
FROM s LEFT JOIN u ON s.x = u.x LEFT JOIN c ON u.node = c.node
"""
