"""Helpers that the operators share: tables, the shared folder, and numbers and digests of words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import pickle
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN_FOLDERS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a temporary folder stands in where that is unset and driver and tasks are one process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        base = _OWN_FOLDERS.setdefault(app, "file://" + tempfile.mkdtemp(prefix="locusmill-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and a lost executor loses nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._locusmill_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete tables that ``materialise`` wrote and that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_locusmill_path", None)
        if path is not None:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shipped(spark: SparkSession, model: object):
    """A broadcast of ``model`` by value, classes included, so that workers need no copy of the package. Read it with ``received``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(broadcast) -> object:
    return pickle.loads(broadcast.value)


#: Rows of ids and a few numbers that are sent to every task at most, some 50 MB; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """``df`` (a written table, or columns of one) marked for broadcast if its rows are few enough, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``place``, its row's number from 0 in a total order: rows are sorted in ranges, and each range begins at the sum of the ranges before it.

    Rows that ``order`` cannot tell apart go to one task. Of the ranges only their sizes meet, one row for each.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_range"), within.alias("_at"))
    rows = materialise(rows, name)
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    out = rows.join(F.broadcast(before), "_range")
    return out.select(*df.columns, (F.col("_before") + F.col("_at")).alias("place"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, even where ``body`` uses it inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def no_text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


#: Rows and bytes of one Arrow batch: texts are long, and an executor holds a few batches for each task.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small for this session from now on (the queries run later, so that it must stay so)."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(name).rstrip("bB")) <= most:
            spark.conf.set(name, most)


def tidy() -> None:
    """Give memory that a finished task no longer needs back to the system; workers live on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run):
    """``run`` (a function for mapInArrow) with ``tidy`` at the end of each task."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    return whole


def worker_state() -> dict:
    """What this worker process keeps from one task to the next."""
    return vars(sys.modules.setdefault("_locusmill_worker", types.ModuleType("_locusmill_worker"))).setdefault("kept", {})


# ---------------------------------------------------------------- words

#: Lower case for A-Z, space for the other ASCII characters that no word holds.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def word_lists(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text (digits, letters in lower case, all beyond ASCII), in lists of about ``most`` bytes, so that long texts take no more memory."""
    text = text.translate(_FOLD)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + most)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


# ---------------------------------------------------------------- numbers and digests of words

_ODD = np.random.default_rng(20240229).integers(0, 2**62, 64, dtype=np.uint64) * np.uint64(4) + np.uint64(1)
#: Words of more bytes are digested one by one.
_LONG = 256
_MASKS = np.array([2 ** (8 * n) - 1 for n in range(9)], dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_places(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a line begin and end, between spaces."""
    inside = np.concatenate(([False], line != 32, [False]))
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_digests(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each word, mixed from eight bytes at a time, for all words at once; long words by a digest of theirs."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    eights = np.ndarray((len(raw),), dtype="<u8", buffer=raw + bytes(8), strides=(1,))
    left = (ends - starts).astype(np.int64)
    low, high = mixed(left.astype(np.uint64) + _ODD[60]), mixed(left.astype(np.uint64) + _ODD[61])
    for i in np.flatnonzero(left > _LONG).tolist():
        digest = hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=16).digest()
        low[i], high[i] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
    at, on = starts, np.flatnonzero(left <= _LONG)
    at, left = starts[on], left[on]
    every = len(on) == len(low)
    while len(on):
        part = eights[at] & _MASKS[np.minimum(left, 8)]
        if every:
            low, high, every = mixed((low ^ part) * _ODD[62]), mixed((high + part) * _ODD[63]), False
        else:
            low[on], high[on] = mixed((low[on] ^ part) * _ODD[62]), mixed((high[on] + part) * _ODD[63])
        more = left > 8
        on, at, left = on[more], at[more] + 8, left[more] - 8
    return low, high


class Words(dict):
    """A number for each word, told apart by its bytes."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def run_hashes(digests: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words, from hashes of the words."""
    m = max(0, len(digests) - k + 1)
    out = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        out += digests[j : j + m] * _ODD[j]
    return mixed(out)


def run_numbers(numbers: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of k words, equal for equal runs only: runs get numbers as pairs of shorter ones."""
    out, width = numbers, 1
    while width < k:
        step = width if 2 * width <= k else 1
        right = out if step == width else numbers
        m = max(0, len(numbers) - width - step + 1)
        pairs = (out[:m].astype(np.uint64) << np.uint64(32)) | right[width : width + m].astype(np.uint64)
        out = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width += step
    return out
