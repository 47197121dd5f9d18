"""A wavelet matrix in one compressed file: token access, counting and occurrence lookup over succinct bit-planes.

File: magic, length of the header (4 bytes), header (JSON), sections. Sections are compressed one by one: the documents'
ids, a validity byte for each, their ends, and for each bit a plane with the number of ones before every 512th place.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa

MAGIC = b"LMWM1\n"
SUPER = 512
#: Tokens of a plane that are dealt at once: few enough that what is made of them stays in a core's cache.
_STEP = 1 << 15


def _packed(a: np.ndarray) -> tuple[bytes, int]:
    raw = a.tobytes()
    return bytes(pa.compress(raw, codec="zstd", asbytes=True)), len(raw)


def _dealt(order: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """Tokens without the bit, then those with it. ``compress`` is some five times as fast as a mask as index."""
    out, low, high = np.empty_like(order), 0, zeros
    for at in range(0, len(order), _STEP):
        part, one = order[at : at + _STEP], ones[at : at + _STEP]
        a, b = part.compress(~one), part.compress(one)
        out[low : low + len(a)], out[high : high + len(b)] = a, b
        low, high = low + len(a), high + len(b)
    return out


def _undealt(order: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """What ``_dealt`` was given."""
    out, low, high = np.empty_like(order), 0, zeros
    for at in range(0, len(order), _STEP):
        part, one = out[at : at + _STEP], ones[at : at + _STEP]
        a, b = np.flatnonzero(~one), np.flatnonzero(one)
        part[a], part[b] = order[low : low + len(a)], order[high : high + len(b)]
        low, high = low + len(a), high + len(b)
    return out


def encode(tokens: np.ndarray, doc_ids: list, ends: np.ndarray) -> bytes:
    """File contents for the tokens of some documents; ``ends`` are running token counts."""
    tokens = tokens.astype(np.uint16 if not len(tokens) or tokens.max() < 1 << 16 else np.uint32)
    bits = max(1, int(tokens.max()).bit_length()) if len(tokens) else 1
    sections, zeros, order = [], [], tokens
    sections.append(_packed(np.array([0 if d is None else d for d in doc_ids], dtype="<i8")))
    sections.append(_packed(np.array([d is not None for d in doc_ids], dtype=np.uint8)))
    sections.append(_packed(np.asarray(ends, dtype="<i8")))
    for level in range(bits):
        ones = (order & order.dtype.type(1 << (bits - 1 - level))) != 0
        plane = np.packbits(ones, bitorder="little")
        padded = np.zeros(-(-len(ones) // SUPER) * SUPER // 8, dtype=np.uint8)
        padded[: len(plane)] = plane
        per = np.bitwise_count(padded.view("<u8")).reshape(-1, SUPER // 64).sum(axis=1, dtype=np.int64)
        before = np.concatenate(([0], np.cumsum(per)[:-1])) if len(per) else per
        sections += [_packed(padded), _packed(before.astype("<u4"))]
        zeros.append(len(ones) - int(np.count_nonzero(ones)))
        order = _dealt(order, ones, zeros[-1])
    header = json.dumps({"docs": len(doc_ids), "tokens": len(tokens), "bits": bits, "zeros": zeros, "sections": [[len(b), n] for b, n in sections]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *[b for b, _ in sections]])


class WaveletFile:
    """``read(offset, size)`` fetches bytes of the file; planes are fetched when a call needs them."""

    def __init__(self, read: Callable[[int, int], bytes]) -> None:
        self._read = read
        head = read(0, len(MAGIC) + 4)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (n,) = struct.unpack("<I", head[len(MAGIC) :])
        self.header = json.loads(read(len(MAGIC) + 4, n))
        self.bits, self.n, self.zeros = self.header["bits"], self.header["tokens"], self.header["zeros"]
        self._at = np.concatenate(([0], np.cumsum([s[0] for s in self.header["sections"]]))) + len(MAGIC) + 4 + n
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, raw: bytes) -> WaveletFile:
        return cls(lambda at, n: raw[at : at + n])

    def _section(self, k: int, kind: str) -> np.ndarray:
        size, plain = self.header["sections"][k]
        return np.frombuffer(pa.decompress(self._read(int(self._at[k]), size), decompressed_size=plain, codec="zstd", asbytes=True) if plain else b"", dtype=kind)

    def documents(self) -> tuple[list, np.ndarray]:
        """Document ids (None where null) and ends."""
        ids, valid, ends = self._section(0, "<i8"), self._section(1, np.uint8), self._section(2, "<i8")
        return [i if v else None for i, v in zip(ids.tolist(), valid.tolist())], ends

    def _plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in self._planes:
            self._planes[level] = self._section(3 + 2 * level, np.uint8), self._section(4 + 2 * level, "<u4")
        return self._planes[level]

    def _rank(self, level: int, i: int) -> int:
        """Ones before place i of a plane."""
        plane, before = self._plane(level)
        block = min(i // SUPER, max(0, len(before) - 1))
        if not len(before):
            return 0
        part = plane[block * SUPER // 8 : i // 8]
        ones = int(before[block]) + int(np.bitwise_count(part).sum())
        return ones + (int(plane[i // 8] & ((1 << (i % 8)) - 1)).bit_count() if i % 8 else 0)

    def _bit(self, level: int, i: int) -> int:
        return int(self._plane(level)[0][i // 8]) >> (i % 8) & 1

    def access(self, i: int) -> int:
        """The token at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            ones = self._rank(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self._rank(level, start), self._rank(level, end)
            if token >> (self.bits - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the token stands in [start, end)."""
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of this kind in a plane."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._rank(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def select(self, token: int, k: int) -> int:
        """Place of the token's k-th occurrence, from 0."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All tokens in order, by undoing the stable partitions from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        order = np.zeros(self.n, dtype=kind)
        for level in reversed(range(self.bits)):
            plane, _ = self._plane(level)
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            zeros = self.zeros[level]
            order[zeros:] |= kind(1 << (self.bits - 1 - level))
            order = _undealt(order, ones, zeros)
            del self._planes[level]
        return order
