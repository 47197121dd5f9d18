"""Token-ID output: texts are encoded, put in order of document id, and written as one wavelet matrix file per shard."""

from __future__ import annotations

import json
import os
import re
import string
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, discard, materialise, mixed, no_text, shared_path, table, tidied, worker_state
from .wavelet import WaveletFile, encode

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: A shard ends with the document that reaches so many tokens; it bounds what a task holds.
SHARD_TOKENS = 2_000_000
#: Encoded stretches that a worker keeps, about 40 bytes each; beyond that, those that did not come again go.
CACHE = 1_000_000
_SLOTS = 21
#: New stretches encoded in one call, some 500 bytes each while it lasts.
_TOGETHER = 20_000
#: Rows and half the characters that are looked up at once: small, since tables of numbers are many times the text.
_STEP, _CHARS = 250, 1 << 15


_RNG = np.random.default_rng(20240229)
_BYTE_CODES = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
#: Stretches of more bytes are compared byte by byte.
_LONG = 64
_MASKS = np.array([2 ** (8 * n) - 1 for n in range(9)], dtype=np.uint64)
_LETTERS = np.isin(np.arange(256), np.frombuffer((string.ascii_lowercase + string.digits).encode(), dtype=np.uint8))
#: Second bytes of ß to ÿ, which follow C3.
_LATIN = np.isin(np.arange(256), [b for b in range(0x9F, 0xC0) if b != 0xB7])


class ByteHasher:
    """64-bit hashes of stretches of bytes, from prefix sums (no loop over stretches). They only find candidates: equal hashes prove nothing."""

    def __init__(self) -> None:
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        steps = np.full(n + 1, _BASE, dtype=np.uint64)
        back = np.full(n + 1, _BASE_INVERSE, dtype=np.uint64)
        steps[0] = back[0] = 1
        self.power = np.multiply.accumulate(steps)
        self.inverse = np.multiply.accumulate(back)

    def ranges(self, line: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from ``first`` to ``last`` of a line, wherever they stand."""
        n = len(line)
        if n >= len(self.power):
            self._grow(2 * n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[line] * self.power[:n], out=total[1:])
        return mixed((total[last] - total[first]) * self.inverse[first] + (last - first).astype(np.uint64))


def by_word(description: dict) -> bool:
    """Whether a tokenizer's pieces never cross a space, so that texts can be encoded stretch by stretch between spaces.

    Known to be so: normalisers that lower characters one by one, and may fold white space or compose; a splitting pattern whose
    classes leave white space out, with what lies between removed; runs of letters whole, and nothing else that holds letters or
    digits together with marks; a byte-pair model; no added token with a space in it, or that wants other than letters around it.
    """
    normalizer, splitter = description.get("normalizer") or {}, description.get("pre_tokenizer") or {}
    steps = normalizer.get("normalizers", [normalizer] if normalizer else [])
    plain = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ") for n in steps)
    parts = splitter.get("pretokenizers", [splitter] if splitter else [])
    if not parts or parts[0]["type"] != "Split" or parts[0]["behavior"] != "Removed" or not parts[0]["invert"]:
        return False
    pieces = parts[0]["pattern"].get("Regex", " ").split("|")
    apart = all(re.fullmatch(r"'[a-z]+|\[\\p\{N\}\]\+?|\[(\\p\{L\}|\\p\{L\}\\p\{N\}|\\p\{N\}\\p\{L\})\]\+|\[\^(?=.*\\s)(?=.*\\p\{L\})(?=.*\\p\{N\})[^\[\] ]+\]\+?", x) for x in pieces)
    apart = apart and any(re.match(r"\[(\\p\{N\})?\\p\{L\}", x) for x in pieces)
    later = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in parts[1:])
    whole = all(" " not in t["content"] and not t["single_word"] and not t["lstrip"] and not t["rstrip"] and not t["normalized"] for t in description.get("added_tokens", []))
    lowered = any(n["type"] == "Lowercase" for n in steps)  # texts are lowered before they are looked up
    return plain and lowered and apart and later and whole and description["model"]["type"] == "BPE" and description.get("post_processor") is None


def _longer(a: np.ndarray) -> np.ndarray:
    """``a`` with room for more: a quarter, not as much again, since every worker holds such arrays."""
    return np.concatenate((a, np.zeros(max(1 << 16, len(a) // 4), dtype=a.dtype)))


def _eights(raw: bytes | np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))


def _places_of(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``first``, one run after the other."""
    until = np.cumsum(size, dtype=np.int64)
    out = np.repeat(first - (until - size), size)
    out += np.arange(len(out))
    return out


class Encoder:
    """Token ids of whole texts, equal to the library's; stretches that were seen are looked up instead of encoded again.

    The tokenizer splits at white space and its pieces never cross it, so a text's ids are those of its stretches between
    spaces; a mark after a letter or digit begins a stretch as well, since pieces end there. Stretches are found by
    64-bit hashes for many texts at once, and then compared byte by byte with what the entry was learnt from: a text in
    which any differs is encoded by the library. New plain words are encoded together in one call, without the steps that
    leave them as they are (normalising, search for pieces), and cut at the ids that end a word, other stretches one by one.
    """

    def __init__(self, path: str | None, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        self.library = Tokenizer.from_file(path)
        words = self.library.get_vocab()
        self.kind = "<u2" if max(words.values()) < 1 << 16 else "<u4"
        ends = np.zeros(max(words.values()) + 1, dtype=bool)
        ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        said = json.loads(self.library.to_str())
        self.by_word = by_word(said) and said["model"].get("end_of_word_suffix") == "</w>"
        self.ends = ends
        self.plain = re.compile("[a-zß-öø-ÿ]+")
        self.marks = np.zeros(256, dtype=bool)
        if self.by_word:
            self.words = Tokenizer(self.library.model)
            later = [pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False) for _ in said["pre_tokenizer"].get("pretokenizers", [0])[1:]]
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), *later])
            added = "".join(t["content"] for t in said["added_tokens"])  # never cut inside one
            self.marks[[ord(c) for c in string.punctuation if c not in added]] = True
        self.simple = re.compile(r"[\x00-į]*")
        self.hasher = ByteHasher()
        self._forget()

    def _forget(self) -> None:
        self._fill(*(np.zeros(1, dtype=k) for k in (np.uint64, np.int32)), np.zeros(0, dtype=self.kind), np.zeros(1, dtype=np.int32), np.zeros(0, dtype=np.uint8))

    def _fill(self, keys: np.ndarray, size: np.ndarray, ids: np.ndarray, width: np.ndarray, raw: np.ndarray) -> None:
        """Know these stretches only; entry 0 is the empty one. ``raw`` has their bytes, ``width`` how many each."""
        self.width, self.begin, self.filled = width, np.cumsum(width, dtype=np.int64) - width, len(raw)
        self.bytes = np.concatenate((raw, np.zeros(8, dtype=np.uint8)))  # eight can be read from each place
        self.n, self.used = len(keys), len(ids)
        self.keys, self.size, self.first = keys, size, (np.cumsum(size) - size).astype(np.int32)
        self.ids, self.again = ids, np.zeros(len(keys), dtype=bool)
        self.slot = np.zeros(1 << _SLOTS, dtype=np.int32)
        self._deal(keys[1:], np.arange(1, self.n, dtype=np.int32))

    def _shrink(self) -> None:
        """Keep stretches that came again since the last time; none if those are most of all."""
        keep = np.flatnonzero(self.again[: self.n])
        keep = np.concatenate(([0], keep[keep > 0]))
        if len(keep) > 3 * CACHE // 4:
            return self._forget()
        width = self.width[keep]
        self._fill(self.keys[keep], self.size[keep], self._flat(keep, self.size[keep]), width, self.bytes[_places_of(self.begin[keep], width)])

    def _flat(self, place: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Ids of these entries, one after the other."""
        return self.ids[_places_of(self.first[place], size)]

    def _deal(self, keys: np.ndarray, entries: np.ndarray) -> None:
        """Put entries into the first free slots from their own on."""
        at = (keys >> np.uint64(64 - _SLOTS)).astype(np.int64)
        while len(at):
            free = self.slot[at] == 0
            self.slot[at[free]] = entries[free]
            left = self.slot[at] != entries
            at, entries = (at[left] + 1) & (len(self.slot) - 1), entries[left]

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, need: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches one after the other, and how many each has."""
        is_plain = np.fromiter((self.plain.fullmatch(w) is not None for w in need), dtype=bool, count=len(need))
        plain, odd = [w for w, p in zip(need, is_plain) if p], [w for w, p in zip(need, is_plain) if not p]
        ids = [np.zeros(0, dtype=self.kind)]
        size = np.zeros(len(need), dtype=np.int32)
        if plain:
            ids.append(np.array(self.words.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, dtype=self.kind))
            at = np.flatnonzero(self.ends[ids[-1]]) + 1
            if len(at) != len(plain):
                raise ValueError("a plain word was not one piece")
            size[is_plain] = np.diff(at, prepend=0)
        if odd:
            raw = self.raw(odd)
            ids.append(np.frombuffer(b"".join(raw), dtype=self.kind))
            size[~is_plain] = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // ids[-1].itemsize
        # Plain words lie first in the ids, the others after them: back to the order of the call.
        order = np.concatenate((np.flatnonzero(is_plain), np.flatnonzero(~is_plain)))
        first = np.zeros(len(need), dtype=np.int64)
        first[order] = np.cumsum(size[order], dtype=np.int64) - size[order]
        return np.concatenate(ids)[_places_of(first, size)], size

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        raw, width = np.frombuffer(b"".join(words), dtype=np.uint8), np.fromiter(map(len, words), dtype=np.int32, count=len(words))
        begin = self.filled + np.cumsum(width, dtype=np.int64) - width
        while self.filled + len(raw) + 8 > len(self.bytes):
            self.bytes = _longer(self.bytes)
        self.bytes[self.filled : self.filled + len(raw)] = raw
        self.filled += len(raw)
        for at in range(0, len(words), _TOGETHER):
            some = keys[at : at + _TOGETHER]
            ids, size = self._encoded([w.decode() for w in words[at : at + _TOGETHER]])
            n, more = self.n, len(some)
            while n + more > len(self.keys):
                self.keys, self.first, self.size, self.again, self.width, self.begin = (_longer(x) for x in (self.keys, self.first, self.size, self.again, self.width, self.begin))
            while self.used + len(ids) > len(self.ids):
                self.ids = _longer(self.ids)
            self.ids[self.used : self.used + len(ids)] = ids
            self.keys[n : n + more], self.size[n : n + more] = some, size
            self.width[n : n + more], self.begin[n : n + more] = width[at : at + more], begin[at : at + more]
            self.first[n : n + more] = self.used + np.cumsum(size) - size
            self.again[n : n + more] = False
            self.used += len(ids)
            self.n += more
            self._deal(some, np.arange(n, n + more, dtype=np.int32))

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each key, and which keys have none."""
        at = (keys >> np.uint64(64 - _SLOTS)).astype(np.int64)
        place = self.slot[at]
        lost = np.flatnonzero(self.keys[place] != keys)
        unknown = []
        while len(lost):
            no = place[lost] == 0
            unknown.append(lost[no])
            lost = lost[~no]
            at[lost] = (at[lost] + 1) & (len(self.slot) - 1)
            place[lost] = self.slot[at[lost]]
            lost = lost[self.keys[place[lost]] != keys[lost]]
        return place, np.concatenate(unknown) if unknown else lost

    def _places(self, keys: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of each stretch; new ones are encoded first."""
        place, lost = self._find(keys)
        self.again[place] = True
        if len(lost):
            new, first, back = np.unique(keys[lost], return_index=True, return_inverse=True)
            n, at = self.n, lost[first]
            self._learn(new, [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            place[lost] = n + back
        return place

    def _strange(self, place: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which stretches are not the bytes that their entries were learnt from, compared eight at a time, long ones one by one."""
        size = ends - starts
        wrong = self.width[place] != size
        here, known = _eights(raw + bytes(8)), _eights(self.bytes)
        on = np.flatnonzero(~wrong & (size > 0) & (size <= _LONG))
        at, to, left = starts[on], self.begin[place[on]], size[on]
        while len(on):
            wrong[on.compress(((here[at] ^ known[to]) & _MASKS[np.minimum(left, 8)]) != 0)] = True
            more = np.flatnonzero(left > 8)
            on, at, to, left = on[more], at[more] + 8, to[more] + 8, left[more] - 8
        long = np.flatnonzero(~wrong & (size > _LONG))
        if len(long):
            size = size[long]
            differ = np.frombuffer(raw, dtype=np.uint8)[_places_of(starts[long], size)] != self.bytes[_places_of(self.begin[place[long]], size)]
            wrong[long] = np.logical_or.reduceat(differ, np.cumsum(size) - size)
        return wrong

    def _lines(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """Texts with spaces for line ends, long ones cut at spaces; and the text of each."""
        lines, owner = [], []
        for i, t in enumerate(texts):
            if self.simple.fullmatch(t) and "İ" not in t:
                t = t.lower()
            t = t.replace("\n", " ")
            while len(t) > 2 * _CHARS and (cut := t.find(" ", _CHARS)) >= 0:
                lines.append(t[:cut])
                owner.append(i)
                t = t[cut + 1 :]
            lines.append(t)
            owner.append(i)
        return lines, owner

    def _some(self, lines: list[str]) -> list[bytes]:
        raw = "\n".join(lines).encode() + b"\n"
        line = np.frombuffer(raw, dtype=np.uint8)
        space = (line == 32) | (line == 10)
        # A stretch ends at white space, and where a mark follows a-z, 0-9 or one of ß-ÿ (bytes C3 9F to C3 BF; B7 is no letter).
        cut = np.flatnonzero(self.marks[line])
        last, before = line[np.maximum(cut - 1, 0)], line[np.maximum(cut - 2, 0)]
        cut = cut.compress((cut > 0) & (_LETTERS[last] | (_LATIN[last] & (before == 0xC3))))
        edge = space.copy()
        edge[cut] = True
        ends = np.flatnonzero(edge)
        over = space[ends]
        starts = np.concatenate(([0], ends[:-1] + over[:-1]))
        done = line[ends] == 10
        keys = self.hasher.ranges(line, starts, ends)
        if self.n > CACHE:
            self._shrink()
        place = self._places(keys, raw, starts, ends)
        size = np.where(ends > starts, self.size[place], 0).astype(np.int64)
        until = np.cumsum(size)
        flat = self._flat(place, size)
        cuts = np.concatenate(([0], until[np.flatnonzero(done)])).tolist()
        out = [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        wrong = self._strange(place, raw, starts, ends)
        if wrong.any():
            for i in np.unique((np.cumsum(done) - done)[wrong]).tolist():
                out[i] = self.raw([lines[i]])[0]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self.raw(texts)
        lines, owner = self._lines(texts)
        out: list[list[bytes]] = [[] for _ in texts]
        at = 0
        while at < len(lines):
            to, size = at, 0
            while to < len(lines) and (to == at or size + len(lines[to]) <= 2 * _CHARS):
                size += len(lines[to])
                to += 1
            for i, ids in zip(owner[at:to], self._some(lines[at:to])):
                out[i].append(ids)
            at = to
        return [b"".join(parts) for parts in out]


def _encoder(path: str | None, vocabulary: str) -> Encoder:
    """One encoder for each worker process; the words it knows serve all its tasks, until another operator comes."""
    kept = worker_state()
    if (path, vocabulary) not in kept:
        kept[path, vocabulary] = Encoder(path, vocabulary)
    return kept[path, vocabulary]


def _encoding(path: str | None, vocabulary: str, bounds: list[int], end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, vocabulary)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP)
                ids = [b + end for b in encoder.encode(batch.column(1).to_pylist())]
                docs = batch.column(0)
                place = np.searchsorted(np.array(bounds, dtype=np.int64), docs.fill_null(-(2**63)).to_numpy(zero_copy_only=False)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(place), docs, pa.array(ids, pa.binary())], names=["bucket", "doc_id", "ids"])

    return run


def _writing(folder: str, kind: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        worker_state().clear()  # the encoder has done its work
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        bucket, number, docs, parts, size = None, 0, [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(p) for p in parts], dtype=np.int64) // np.dtype(kind).itemsize
            raw = encode(np.frombuffer(b"".join(parts), dtype=kind), docs, np.cumsum(lengths))
            name = f"{bucket:06d}-{number:06d}-{uuid.uuid4().hex}.wm"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(raw)
            return pa.RecordBatch.from_pylist([{"bucket": bucket, "shard": number, "file": name, "n_docs": len(docs), "n_tokens": int(lengths.sum())}], pa.schema([("bucket", pa.int32()), ("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for b, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if docs and (b != bucket or size >= most):
                    yield shard()
                    number = number + 1 if b == bucket else 0
                    docs, parts, size = [], [], 0
                bucket = b
                docs.append(doc)
                parts.append(ids.as_py())
                size += len(parts[-1]) // np.dtype(kind).itemsize
        if docs:
            yield shard()

    return run


def write_tokens(docs: DataFrame, folder: str | None = None, path: str | None = None, vocabulary: str = VOCABULARY, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, str]:
    """Encode ``docs`` (doc_id, text), write shards to ``folder`` and return their manifest and the folder.

    The manifest has bucket, shard, file, n_docs, n_tokens and start (tokens of all shards before). Ids are cut into as many
    ranges as there are shuffle partitions, at quantiles; only encoded ids are shuffled. A file gets a new name each time a
    task writes it, and the manifest names those of the tasks that counted, so lost and repeated tasks do no harm.

    Nulls: a null text is empty (its end id only); null ids come first. Rows of the same id lie next to each other in order
    of their tokens. An empty table has no shards. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    bounds = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 20 * n).alias("q")).first()["q"] or []
    bounds = sorted({int(b) for b in bounds})
    kind = "<u2" if Encoder(path, vocabulary).kind == "<u2" else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_text(F.col("text")).alias("text"))
    rows = rows.mapInArrow(tidied(_encoding(path, vocabulary, bounds, end_id)), "bucket int, doc_id long, ids binary")
    rows = rows.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "ids")
    shards = rows.mapInArrow(tidied(_writing(folder, kind, shard_tokens)), "bucket int, shard int, file string, n_docs long, n_tokens long")
    shards = materialise(shards, "token-shards")
    totals = shards.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    manifest = shards.withColumn("inside", inside).join(before, "bucket").select("bucket", "shard", "file", "n_docs", "n_tokens", (F.col("before") + F.col("inside")).alias("start"))
    manifest = materialise(manifest, "token-manifest")
    discard(shards)
    return manifest, folder


def _reading(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{root}/{name}") as f:
                    shard = WaveletFile(lambda at, n: f.read_at(n, at))
                    docs, ends = shard.documents()
                    raw = memoryview(shard.tokens().astype("<u4").tobytes())
                firsts = np.concatenate(([0], ends[:-1]))
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(firsts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(firsts + start, pa.int64()), pa.array(ends - firsts, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """What the files hold, per document: doc_id, start, n_tokens, ids_crc32."""
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    files = manifest.select("file", "start").repartition(n)
    return files.mapInArrow(tidied(_reading(folder)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(*write_tokens(table(spark, sf_dir, "documents")))


