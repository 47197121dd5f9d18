"""Block-compressed files and their indexes: gzip members of at most 64 KB, virtual offsets, bins and linear index.

A virtual offset is the place of a block in the file, shifted by 16 bits, and a place inside the block's content. Formats and
numbers are those of the public specifications of the SAM/BAM and tabix formats.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyarrow import fs

#: Content of a block at most, the empty block that ends a file, first bytes of a block (fixed values).
BLOCK = 0xFF00
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MAGIC = b"\x1f\x8b\x08\x04"
#: Bits of a place that bins of each level share, the smallest bins first, and the number of the level's first bin (fixed values).
LEVELS = ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1), (29, 0))
LINEAR = 14


def open_fs(path: str):
    """A file system and the path in it; plain paths are local."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def compressed(data: bytes) -> bytes:
    """One block of ``data``, which has at most ``BLOCK`` bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = MAGIC + struct.pack("<IBBHBBHH", 0, 0, 0xFF, 6, 66, 67, 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def block_size(head: bytes) -> int | None:
    """Length of the block that begins with ``head``, or None where none does."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    extra = struct.unpack_from("<H", head, 10)[0]
    at, end = 12, 12 + extra
    while at + 4 <= min(end, len(head)):
        a, b, n = head[at], head[at + 1], struct.unpack_from("<H", head, at + 2)[0]
        if (a, b, n) == (66, 67, 2) and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


def content(block: bytes) -> bytes:
    extra = struct.unpack_from("<H", block, 10)[0]
    return zlib.decompress(block[12 + extra : -8], -15)


def blocks_from(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the blocks from a block's place on; ``file`` can be read at any place."""
    held, begin = b"", at
    while at < size:
        if at - begin + 65_536 > len(held) and begin + len(held) < size:
            file.seek(at)
            held, begin = file.read(1 << 20), at
        n = block_size(held[at - begin : at - begin + 64])
        if n is None:
            raise ValueError(f"no block at byte {at}")
        data = content(held[at - begin : at - begin + n])
        if data:
            yield at, data
        at += n


def first_block(file, at: int, size: int) -> int:
    """Where the first block at or after a byte begins: its head, and that of the block which must follow it, are what heads are."""
    while at < size:
        file.seek(at)
        held = file.read(1 << 17)
        place = held.find(MAGIC)
        while 0 <= place <= 1 << 16:
            n = block_size(held[place : place + 64])
            after = None if n is None else held[place + n : place + n + 64]
            if n is not None and (at + place + n == size or block_size(after) is not None):
                return at + place
            place = held.find(MAGIC, place + 1)
        at += 1 << 16
    return size


def bin_of(begin: int, end: int) -> int:
    """The smallest bin that holds [begin, end)."""
    last = max(begin, end - 1)
    return next(first + (begin >> shift) for shift, first in LEVELS if begin >> shift == last >> shift)


def bins_over(begin: int, end: int) -> set[int]:
    """All bins that can hold something of [begin, end)."""
    last = max(begin, end - 1)
    return {b for shift, first in LEVELS for b in range(first + (begin >> shift), first + (last >> shift) + 1)}


def united(chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted stretches, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for a, z in chunks:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


class BinIndex:
    """Chunks of virtual offsets by contig and bin, and the least offset by contig and 16 KB window."""

    def __init__(self) -> None:
        self.bins: dict[int, dict[int, list[list[int]]]] = {}
        self.linear: dict[int, dict[int, int]] = {}

    def add(self, contig: int, begin: int, end: int, start: int, stop: int) -> None:
        """A record at [begin, end) whose bytes lie from ``start`` to ``stop``; records come in the order of the file."""
        chunks = self.bins.setdefault(contig, {}).setdefault(bin_of(begin, end), [])
        if chunks and chunks[-1][1] == start:
            chunks[-1][1] = stop
        else:
            chunks.append([start, stop])
        windows = self.linear.setdefault(contig, {})
        for w in range(begin >> LINEAR, (max(begin, end - 1) >> LINEAR) + 1):
            windows[w] = min(windows.get(w, start), start)

    def join(self, other: BinIndex, shift: int) -> None:
        """Add the index of a part that begins ``shift`` bytes into the file."""
        for contig, bins in other.bins.items():
            own = self.bins.setdefault(contig, {})
            for b, chunks in bins.items():
                own.setdefault(b, []).extend([a + (shift << 16), z + (shift << 16)] for a, z in chunks)
        for contig, windows in other.linear.items():
            own = self.linear.setdefault(contig, {})
            for w, start in windows.items():
                own[w] = min(own.get(w, start + (shift << 16)), start + (shift << 16))

    def chunks(self, contig: int, begin: int, end: int) -> list[tuple[int, int]]:
        """Stretches of the file that hold every record which overlaps [begin, end), in order, none touching another."""
        least = self.linear.get(contig, {}).get(begin >> LINEAR, 0)
        held = self.bins.get(contig, {})
        return united(sorted((max(a, least), z) for b in bins_over(begin, end) & held.keys() for a, z in held[b] if z > least))

    def starts(self) -> list[int]:
        """All offsets at which a record is known to begin."""
        return sorted({a for bins in self.bins.values() for chunks in bins.values() for a, _ in chunks} | {s for w in self.linear.values() for s in w.values()})

    def encoded(self, contigs: int) -> bytes:
        out = []
        for contig in range(contigs):
            bins, windows = self.bins.get(contig, {}), self.linear.get(contig, {})
            out.append(struct.pack("<i", len(bins)))
            for b in sorted(bins):
                out.append(struct.pack("<Ii", b, len(bins[b])) + b"".join(struct.pack("<QQ", *c) for c in bins[b]))
            filled, last = [], 0
            for w in range(max(windows, default=-1) + 1):
                last = windows.get(w, last)
                filled.append(last)
            out.append(struct.pack(f"<i{len(filled)}Q", len(filled), *filled))
        return b"".join(out)

    @classmethod
    def decoded(cls, data: bytes, at: int, contigs: int) -> BinIndex:
        out = cls()
        for contig in range(contigs):
            (n,) = struct.unpack_from("<i", data, at)
            at += 4
            for _ in range(n):
                b, m = struct.unpack_from("<Ii", data, at)
                ends = struct.unpack_from(f"<{2 * m}Q", data, at + 8)
                at += 8 + 16 * m
                if b != 37450:  # counts of the contig, not a bin
                    out.bins.setdefault(contig, {})[b] = [list(x) for x in zip(ends[::2], ends[1::2])]
            (n,) = struct.unpack_from("<i", data, at)
            for w, start in enumerate(struct.unpack_from(f"<{n}Q", data, at + 4)):
                if start:
                    out.linear.setdefault(contig, {})[w] = start
            at += 4 + 8 * n
        return out


def contig_index(index: BinIndex, contigs: int) -> bytes:
    """The bytes of a .bai file."""
    return b"BAI\1" + struct.pack("<i", contigs) + index.encoded(contigs)


def read_contig_index(data: bytes) -> BinIndex:
    if data[:4] != b"BAI\1":
        raise ValueError("no index of an alignment file")
    return BinIndex.decoded(data, 8, struct.unpack_from("<i", data, 4)[0])


def text_index(index: BinIndex, names: list[str]) -> bytes:
    """The bytes of a .tbi file of variants: contig in the first column, place in the second, # before what is no record."""
    said = b"".join(n.encode() + b"\0" for n in names)
    data = b"TBI\1" + struct.pack("<8i", len(names), 2, 1, 2, 0, ord("#"), 0, len(said)) + said + index.encoded(len(names))
    return b"".join(compressed(data[i : i + BLOCK]) for i in range(0, len(data), BLOCK)) + END_OF_FILE


def read_text_index(raw: bytes) -> tuple[BinIndex, list[str]]:
    data, at = b"", 0
    while at < len(raw):
        n = block_size(raw[at : at + 64])
        data += content(raw[at : at + n])
        at += n
    if data[:4] != b"TBI\1":
        raise ValueError("no index of a text file")
    contigs, size = struct.unpack_from("<i", data, 4)[0], struct.unpack_from("<i", data, 32)[0]
    names = [n.decode() for n in data[36 : 36 + size].split(b"\0")[:-1]]
    return BinIndex.decoded(data, 36 + size, contigs), names
