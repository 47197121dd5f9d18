"""Secret scans: known shapes, and candidate strings whose sliding window has high entropy in its character class."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, no_text, table, tidied

KINDS = ("assign", "access", "hex")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Window in characters, and for each class its alphabet and the entropy in bits that some window must reach.
WINDOW = 20
CLASSES = (("hex", r"[0-9a-fA-F]+", 3.0), ("alnum", r"[A-Za-z0-9]+", 3.9), ("base64", r"[A-Za-z0-9+/_=-]+", 3.9))
#: Strings that look random but are known not to be secrets: UUIDs, plain words joined by - or _, paths, alphabets, digests of nothing.
#: Every segment can be read in one way only, so that a match fails in linear time.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[A-Z]?[a-z]+(?:[-_/=+][A-Z]?[a-z]+)*",
    r"[A-Z]+(?:[-_/][A-Z]+)*",
    r"[0-9]+(?:[-_/][0-9]+)*",
    r"(?i:.*(?:abcdefghij|0123456789|qwertyuiop|example|placeholder).*)",
    r"da39a3ee5e6b4b0d3255bfef95601890afd80709|d41d8cd98f00b204e9800998ecf8427e",
)
_TERMS = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def top_entropy(s: str, window: int = WINDOW) -> float:
    """Largest Shannon entropy in bits of a window, by counts that change by one character in and one out."""
    terms = _TERMS if window == WINDOW else [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    n = min(window, len(s))
    if not n:
        return 0.0
    counts: dict[str, int] = {}
    total = 0.0
    for c in s[:n]:
        k = counts.get(c, 0)
        total += terms[k + 1] - terms[k]
        counts[c] = k + 1
    least = total
    for old, new in zip(s, s[n:]):
        if old != new:
            k = counts[old]
            total += terms[k - 1] - terms[k]
            counts[old] = k - 1
            k = counts.get(new, 0)
            total += terms[k + 1] - terms[k]
            counts[new] = k + 1
            least = min(least, total)
    return math.log2(n) - least / n


class Scanner:
    """Spans of one text: base ones as (start, kind number, end), and entropy ones as (start, end, class)."""

    def __init__(self, allowed=ALLOWED) -> None:
        self.assign, self.access, self.hex, self.candidate = map(re.compile, (ASSIGN, ACCESS, HEX, CANDIDATE))
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed))
        self.classes = [(name, re.compile(p), bits) for name, p, bits in CLASSES]

    def base(self, text: str) -> list[tuple[int, int, int]]:
        out = []
        if ":" in text or "=" in text:
            out = [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if m.end(2) - m.start(2) >= 6]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in self.access.finditer(text)]
        out += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return sorted(out)

    def entropy(self, text: str) -> list[tuple[int, int, str]]:
        out = []
        for m in self.candidate.finditer(text):
            s = m.group()
            if self.allowed.fullmatch(s):
                continue
            for name, shape, bits in self.classes:
                if shape.fullmatch(s):
                    if top_entropy(s) >= bits:
                        out.append((m.start(), m.end(), name))
                    break
        return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        counts: list[list[int]] = [[], [], []]
        digests, told, n_entropy = [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base, more = scanner.base(text), scanner.entropy(text)
            for k in range(3):
                counts[k].append(sum(b[1] == k for b in base))
            digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest())
            every = sorted(base + [(s, 3, e) for s, e, _ in more])
            told.append(",".join(f"{(*KINDS, 'entropy')[k]}:{s}:{e}" for s, k, e in every))
            n_entropy.append(len(more))
        arrays = [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(told, pa.string()), pa.array(n_entropy, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Counts and spans of each whole text: no shuffle, one pass.

    Nulls: a null text is empty; a null id stays. Repeated rows are rows like others, empty tables give no rows, other columns
    are not looked at. Time is linear in a text's length, whatever it holds.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_text(F.col("text")).alias("text")).mapInArrow(tidied(_scan), schema)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
