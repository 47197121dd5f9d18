"""Toxicity: class-conditional Kneser-Ney models of words and word pairs, with shared backoff counts.

The toxic and the ordinary model are learnt from labelled texts; counts are documents that hold a pair of neighbours, a word or
the beginning of words. Absolute discounting takes DISCOUNT off every count and hands it down by backoff: from a pair to its second
word, from a word to its beginnings, for a rare word is often an inflected one. How much a node gets of it follows its continuation
count in all documents of the corpus: the different words before a word, the different words that go on from a beginning.
Backoff counts are the same in both classes, so that a rare expression says what its lower orders say, and one of which no
labelled text holds a part says nothing. A text is judged by the difference of its two log-likelihoods, normalised by length: over
the whole text, and over the extract of its few most toxic words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, discard, materialise, mixed, received, run_hashes, shipped, table, tidied, word_digests, word_places, worker_state

#: Labelled rows that are used at most: those whose ids have the smallest hashes.
LABELLED = 10_000
#: Words and pairs that fewer labelled documents hold are left to backoff.
LEAST = 2
DISCOUNT = 0.75
#: Documents that back every node beside its continuation count.
BASE = 2.0
#: Bytes of the beginnings of words.
BEGINNINGS = (4, 6)
THRESHOLD = 0.3
#: Words of an extract.
EXTRACT = 6
#: Characters of scripts that write no spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, Kana and Han.
_UNSPACED = re.compile(rb"(?:\xe0[\xb8-\xbf][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xe3[\x81-\xbf][\x80-\xbf]|[\xe4-\xe9][\x80-\xbf]{2}|\xef[\xa4-\xab][\x80-\xbf]|\xf0[\xa0-\xb3][\x80-\xbf]{2})+")
#: Their first bytes, looked for before all else.
_LEADS = re.compile(rb"[\xe0\xe1\xe3-\xe9\xef\xf0]")
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from; rows without id are not among them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def _pairs(run: re.Match) -> bytes:
    """A run of such characters as its pairs of neighbours, or the only character, set off by spaces."""
    chars = run[0].decode()
    return f" {' '.join(a + b for a, b in zip(chars, chars[1:])) or chars} ".encode()


PAIR = len(BEGINNINGS) + 1


def _at_level(h: np.ndarray, level: int) -> np.ndarray:
    """Hashes with the level in the two last bits."""
    return (h & ~np.uint64(3)) | np.uint64(level)


def nodes(texts: list[bytes | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each word (runs of letters and digits in lower case; pairs of characters where a script has no spaces) its nodes, and where texts begin and end.

    64-bit hashes of the beginnings (0 where the word is no longer), of the word, and of the pair with the word before it (0
    for the first of a text); the two last bits are the level.
    """
    folded = [(t or b"").translate(_FOLD) for t in texts]
    folded = [_UNSPACED.sub(_pairs, t) if not t.isascii() and _LEADS.search(t) else t for t in folded]
    raw = b" ".join(folded)
    starts, ends = word_places(np.frombuffer(raw, dtype=np.uint8))
    out = []
    for level, size in enumerate(BEGINNINGS):
        longer = ends - starts > size
        some = np.zeros(len(starts), dtype=np.uint64)
        some[longer] = _at_level(word_digests(raw, starts[longer], starts[longer] + size)[0], level)
        out.append(some)
    word = _at_level(word_digests(raw, starts, ends)[0], PAIR - 1)
    pair = np.concatenate((np.zeros(min(1, len(word)), dtype=np.uint64), _at_level(run_hashes(word, 2), PAIR)))
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in folded)]))
    pair[cuts[:-1][cuts[:-1] < len(word)]] = 0
    return [*out, word, pair], cuts


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _TOGETHER):
        yield batch.slice(at, _TOGETHER)


def above(levels: list[np.ndarray]) -> list[np.ndarray]:
    """What each node backs off to (0: nothing)."""
    out = [np.zeros_like(levels[0])]
    for lower in levels[:-1]:
        out.append(np.where(lower != 0, lower, out[-1]))
    return out


# ---------------------------------------------------------------- counts of labelled texts

#: Ordinary and toxic documents, in 32 bits each.
_COUNTING = "key long, up long, n long"
#: Nodes that a task sums up before it passes them on; texts that are hashed at once.
_HOLD, _TOGETHER = 400_000, 50


def _summed(parts: list[tuple]) -> tuple:
    key, up, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    key, up, n = key[order], up[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], up[first], np.add.reduceat(n, first)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are (text, toxic)."""
    parts, size = [], 0

    def out(found: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in found], names=["key", "up", "n"])

    for batch in chain.from_iterable(map(_slices, batches)):
        levels, cuts = nodes(batch.column(0).to_pylist())
        ups = above(levels)
        for a, b, toxic in zip(cuts, cuts[1:], batch.column(1).to_pylist()):
            for own, up in zip(levels, ups):
                own, up = own[a:b], up[a:b]
                key, at = np.unique(own[own != 0], return_index=True)
                parts.append((key, up[own != 0][at], np.full(len(key), 1 << (32 * toxic), dtype=np.int64)))
                size += len(key)
            if size > _HOLD:
                parts = [_summed(parts)]
                size = len(parts[0][0])
                if size > _HOLD // 2:
                    yield out(parts[0])
                    parts, size = [], 0
    if size:
        yield out(_summed(parts))


# ---------------------------------------------------------------- continuation counts of the corpus

#: Registers of the sketch that counts the contexts of a node.
_REGISTERS = 64


class Lookup:
    """Places of 64-bit keys, by their sorted list and an index over the keys' first bits."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(10, int(3 * len(keys)).bit_length())
        # The last key ends every search.
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.first = np.searchsorted(self.keys, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; the number of keys where it is none of them."""
        at = self.first[(keys >> np.uint64(64 - self.bits)).astype(np.int64)]
        late = np.flatnonzero(self.keys[at] < keys)
        while len(late):
            at[late] += 1
            late = late[self.keys[at[late]] < keys[late]]
        return np.where(self.keys[at] == keys, at, len(self.keys) - 1)


def sketched(registers: np.ndarray, places: np.ndarray, contexts: np.ndarray) -> None:
    """Enter contexts (64-bit hashes) into the sketches of the nodes at ``places``."""
    h = mixed(contexts)
    rest = (h >> np.uint64(6)) | np.uint64(1 << 57)
    rank = np.bitwise_count((rest & (~rest + np.uint64(1))) - np.uint64(1)) + np.uint8(1)
    np.maximum.at(registers.reshape(-1), places * _REGISTERS + (h & np.uint64(63)).astype(np.int64), rank)


def estimates(registers: np.ndarray) -> np.ndarray:
    """How many contexts each sketch has seen, within some 13 %."""
    raw = 0.709 * _REGISTERS**2 / np.exp2(-registers.astype(np.float64)).sum(axis=1)
    empty = (registers == 0).sum(axis=1)
    return np.where((raw <= 2.5 * _REGISTERS) & (empty > 0), _REGISTERS * np.log(_REGISTERS / np.maximum(empty, 1)), raw)


def _continuing(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state().clear()
        lookup = received(known)
        n = len(lookup.keys) - 1
        registers = np.zeros((n, _REGISTERS), dtype=np.uint8)
        for batch in chain.from_iterable(map(_slices, batches)):
            (*begin, word, pair), _ = nodes(batch.column(0).to_pylist())
            first = pair == 0
            for node, context in ((word[~first], np.roll(word, 1)[~first]), *((b[b != 0], word[b != 0]) for b in begin)):
                place = lookup.find(node)
                there = place < n
                sketched(registers, place[there].astype(np.int64), context[there])
        seen = np.flatnonzero(registers.any(axis=1))
        for at in range(0, len(seen), 10_000):
            some = seen[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([r.tobytes() for r in registers[some]], pa.binary())], names=["word", "registers"])

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of word; the last word of a batch may go on in the next."""
    held = None
    for batch in batches:
        word = batch.column(0).to_numpy()
        registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(-1, _REGISTERS)
        if held is not None:
            word, registers = np.concatenate((held[0], word)), np.concatenate((held[1], registers))
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        word, registers = word[first], np.maximum.reduceat(registers, first, axis=0)
        held = word[-1:], registers[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(word[:-1]), pa.array(estimates(registers[:-1]))], names=["word", "contexts"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(estimates(held[1]))], names=["word", "contexts"])


def continuation(texts: DataFrame, keys: np.ndarray) -> np.ndarray:
    """For each of the sorted ``keys`` (words and beginnings) about how many different words precede or continue it in all ``texts``.

    A task passes one sketch for each node that it met, whatever its size; sketches of a node are united by maximum.
    """
    spark = texts.sparkSession
    known = shipped(spark, Lookup(keys))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.mapInArrow(tidied(_continuing(known)), "word long, registers binary").repartition(n, "word").sortWithinPartitions("word")
    found = rows.mapInArrow(tidied(_united), "word long, contexts double").toArrow()
    known.unpersist()
    out = np.zeros(len(keys))
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


# ---------------------------------------------------------------- models

class Counts:
    """What labelled texts say, nodes with their ordinary and toxic documents in order of key, and the corpus: contexts of words and beginnings."""

    def __init__(self, rows: pa.Table) -> None:
        key, up, n = (rows.column(c).to_numpy() for c in ("key", "up", "n"))
        order = np.argsort(key.view(np.uint64))
        self.keys = key.view(np.uint64)[order]
        self.level = (self.keys & np.uint64(3)).astype(np.int64)
        self.seen = np.column_stack((n[order] & 0xFFFFFFFF, n[order] >> 32))
        #: Place of the node that each backs off to; one past the end: none.
        self.up = Lookup(self.keys).find(up.view(np.uint64)[order])
        self.contexts = np.zeros(len(self.keys))

    def single(self) -> np.ndarray:
        return np.flatnonzero(self.level < PAIR)


class Model:
    """Log-likelihood ratios of nodes."""

    def __init__(self, counts: Counts, sizes: list[int]) -> None:
        """``sizes`` are ordinary and toxic documents. Counts of either class are brought to the size of the smaller one."""
        self.scale = min(sizes) / np.maximum(1, np.array(sizes))
        taken = (counts.seen * self.scale - self._kept(counts.seen)).sum(axis=1) / 2
        self.lookup, self.seen = Lookup(counts.keys), counts.seen
        self.back = np.zeros(len(counts.keys))
        #: The last entry is for what is not known.
        self.ratio = np.zeros(len(counts.keys) + 1)
        for level in range(PAIR + 1):
            at = np.flatnonzero(counts.level == level)
            contexts = counts.contexts[at]
            self.back[at] = BASE + taken[at].sum() * contexts / max(1.0, contexts.sum())
            self.ratio[at] = self._ratio(at, counts.seen[at], self.ratio[counts.up[at]])

    def _kept(self, seen: np.ndarray) -> np.ndarray:
        return np.maximum(seen - DISCOUNT, 0) * self.scale

    def _ratio(self, at: np.ndarray, seen: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Of nodes with these counts; the backoff count falls to the classes as the probability of the node below does."""
        kept, back = self._kept(seen), 2 * self.back[at]
        toxic = back / (1 + np.exp(-below))
        return np.log(kept[:, 1] + toxic) - np.log(kept[:, 0] + back - toxic)

    def final(self) -> Model:
        """Without the counts, for texts that it was not learnt from."""
        self.seen = self.back = None
        return self

    def ratios(self, texts: list[bytes | None], toxic: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """For each word of each text the log-likelihood ratio of the highest of its nodes that is known.

        ``toxic``: the labels of texts that the model was learnt from; each is scored as if it had not been one of them.
        """
        levels, cuts = nodes(texts)
        out = np.zeros(len(levels[0]))
        label = None if toxic is None else np.repeat(toxic, np.diff(cuts))
        for keys in levels:
            at = np.flatnonzero(keys)
            place = self.lookup.find(keys[at])
            known = place < len(self.ratio) - 1
            at, place = at[known], place[known]
            if label is None:
                out[at] = self.ratio[place]
            else:
                seen = self.seen[place]
                seen[np.arange(len(at)), label[at]] -= 1
                left = seen.sum(axis=1) >= LEAST
                out[at[left]] = self._ratio(place[left], seen[left], out[at[left]])
        for a, b in zip(cuts, cuts[1:]):
            yield out[a:b]

    def features(self, texts: list[bytes | None], toxic: np.ndarray | None = None) -> np.ndarray:
        """Differences of the log-likelihoods by length, for each text: of the whole, and of the extract of its most toxic words."""
        found = np.zeros((len(texts), len(FEATURES)))
        for i, ratio in enumerate(self.ratios(texts, toxic)):
            if len(ratio):
                extract = np.partition(ratio, len(ratio) - EXTRACT)[-EXTRACT:] if len(ratio) > EXTRACT else ratio
                found[i] = ratio.sum() / len(ratio), extract.sum() / EXTRACT
        return found


FEATURES = ("whole", "extract")


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (last: intercept), and the features' means and scales."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1.0] * (len(w) - 1) + [1e-6])
        step = np.linalg.solve(h, z.T @ (y - p) - np.array([1.0] * (len(w) - 1) + [0.0]) * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


class Scorer:
    """The final model and the scale from differences to probabilities; without labels of both kinds all scores are the share of toxic labels."""

    def __init__(self, model: Model | None, fit: tuple | None, prior: float) -> None:
        self.model, self.fit, self.prior = model, fit, prior

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.fit is None:
            return np.full(len(texts), self.prior)
        w, mean, scale = self.fit
        z = (self.model.features(texts) - mean) / scale
        return 1 / (1 + np.exp(-np.clip(z @ w[:-1] + w[-1], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Scorer:
    """Fit on ``docs`` and those ``labels`` (doc_id, toxic) that are not held out, ``most`` at most.

    Only labelled texts are read for counts by class. Each of them is scored by a model without its own counts, which fits the
    scale. One pass over all documents gives the continuation counts. The driver gets the nodes that ``LEAST`` labelled texts
    hold, so that their number is bounded by ``most``, never by the corpus.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("_toxic"))
    rows = rows.orderBy(F.xxhash64("_id"), "_id").limit(most)
    chosen = materialise(rows, "toxic-labels")
    n, toxic = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("_toxic"), F.lit(0))).first()
    prior = toxic / n if n else 0.0
    if not 0 < toxic < n:
        return Scorer(None, None, prior)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    labelled = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "_toxic")  # at most ``most`` ids
    labelled = materialise(labelled, "toxic-texts")
    found = labelled.mapInArrow(tidied(_counting), _COUNTING).groupBy("key").agg(F.first("up").alias("up"), F.sum("n").alias("n"))
    every = F.col("n").bitwiseAND(F.lit(0xFFFFFFFF)) + F.shiftright("n", 32)
    counts = Counts(found.where(every >= LEAST).toArrow())
    single = counts.single()
    counts.contexts[single] = continuation(texts.select("text"), counts.keys[single])
    model = Model(counts, [n - toxic, toxic])
    whole = shipped(spark, model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(whole)
        for batch in chain.from_iterable(map(_slices, batches)):
            label = batch.column(1).to_numpy()
            x = own.features(batch.column(0).to_pylist(), label)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (label.astype(np.float64), *x.T)], names=["y", *FEATURES])

    seen = labelled.mapInArrow(tidied(measure), ", ".join(f"{c} double" for c in ("y", *FEATURES))).toArrow()
    a = np.column_stack([seen.column(c).to_numpy() for c in ("y", *FEATURES)])
    a = a[np.lexsort(a.T)]
    whole.unpersist()
    discard(chosen, labelled)
    if not len(a) or a[:, 0].min() == a[:, 0].max():
        return Scorer(None, None, prior)
    return Scorer(model.final(), _logistic(a[:, 1:], a[:, 0]), prior)


def score_toxicity(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with ``score`` (0 to 1).

    Nulls: a null text is empty and scores like other empty texts; rows without id are scored, but teach no label. Repeated
    rows count each time. Empty tables give no rows; without usable labels every score is their share of toxic ones (0 where
    there are none). Texts and words of any length are read whole.
    """
    scorer = shipped(docs.sparkSession, train(docs, labels, **how))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(scorer)
        for batch in chain.from_iterable(map(_slices, batches)):
            scores = own.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("binary").alias("_bytes"))
    schema = rows.select("row", F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(tidied(run), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; nulls, empty texts and repeats as in ``score_toxicity``."""
    return score_toxicity(docs, labels, **how).where(F.col("score") < threshold).select("row.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_toxicity(docs, table(spark, sf_dir, "labels"))
    doc = F.col("row.doc_id")
    return out.select(doc.alias("doc_id"), held_out(doc).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
