"""Binary alignment files as a Spark source: split at blocks, pruned by the index, decoded to Arrow batches in the tasks."""

from __future__ import annotations

import struct
import sys
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from locusmill.sources import blocks
from locusmill.sources.readers import read_groups

# The classes travel by value, so that workers need no copy of the package.
for _module in (blocks.__name__, __name__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

SCHEMA = "file string, at long, qname string, flag long, chrom string, start long, mapq int, cigar string, next_chrom string, next_start long, insert_size long, seq string, quality string, read_group string, library string"
#: Bytes of a file that one task reads, and records of one batch.
SPLIT_BYTES, BATCH_RECORDS = 32 << 20, 4096
#: Letters of operations and bases by their code (fixed values).
OPERATIONS, BASES = "MIDNSHP=X", b"=ACMGRSVTWYHKDBN"
#: Flags whose alignments ``primary`` leaves out: unmapped, secondary, failed, supplementary.
NOT_PRIMARY = 0xB04
_WIDE = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_BASES = bytes(BASES[int(chr(c), 16)] if chr(c) in "0123456789abcdef" else 78 for c in range(256))
_QUALITY = bytes(min(c + 33, 126) for c in range(256))
#: Records that must follow one another before a place counts as the beginning of a record, and blocks that are looked at ahead.
_CHAIN, _LOOK = 5, 32


def tag(data: bytes, at: int, end: int, wanted: bytes) -> str:
    """The value of a text tag of a record, or ""."""
    while at + 3 <= end:
        name, kind = data[at : at + 2], chr(data[at + 2])
        at += 3
        if kind in "ZH":
            stop = data.index(b"\0", at, end)
            if name == wanted:
                return data[at:stop].decode()
            at = stop + 1
        elif kind == "B":
            at += 5 + _WIDE[chr(data[at])] * struct.unpack_from("<i", data, at + 1)[0]
        else:
            at += _WIDE[kind]
    return ""


class Header:
    """Text, contigs and the offset of the first record."""

    def __init__(self, file, size: int) -> None:
        data, ends = b"", []
        walk = blocks.blocks_from(file, 0, size)

        def more(n: int) -> None:
            nonlocal data
            while len(data) < n:
                place, got = next(walk)
                ends.append((len(data), place))
                data += got

        more(12)
        if data[:4] != b"BAM\1":
            raise ValueError("no alignment file")
        (text,) = struct.unpack_from("<i", data, 4)
        more(12 + text)
        self.lines = data[8 : 8 + text].rstrip(b"\0").decode().splitlines()
        (n,) = struct.unpack_from("<i", data, 8 + text)
        at, self.names, self.lengths = 12 + text, [], []
        for _ in range(n):
            more(at + 4)
            (width,) = struct.unpack_from("<i", data, at)
            more(at + 8 + width)
            self.names.append(data[at + 4 : at + 3 + width].decode())
            self.lengths.append(struct.unpack_from("<i", data, at + 4 + width)[0])
            at += 8 + width
        if at == len(data):  # the first record begins with the next block, if there is one
            place = next(walk, (size, b""))[0]
            self.first = place << 16
        else:
            begin, place = max(e for e in ends if e[0] <= at)
            self.first = place << 16 | at - begin


def plausible(data: bytes, at: int, lengths: list[int]) -> int | None:
    """Length of what may be a record, or None where it cannot be one; 0 if there is too little to tell."""
    if at + 36 > len(data):
        return 0
    size, contig, pos, width, _, _, ops, _, bases, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    known = lambda c, p: -1 <= c < len(lengths) and -1 <= p and (c < 0 or p <= lengths[c])
    if size < 32 or size > 1 << 28 or not known(contig, pos) or not known(mate, mate_pos) or width < 1 or bases < 0 or 32 + width + 4 * ops + (bases + 1) // 2 + bases > size:
        return None
    name = data[at + 36 : at + 36 + width]
    if len(name) == width and (name[-1] or not all(33 <= c <= 126 for c in name[:-1])):
        return None
    return size + 4


def first_record(file, place: int, size: int, lengths: list[int]) -> int | None:
    """Virtual offset of the first record that begins at or after a block: the first place from which records follow one another."""
    walk = blocks.blocks_from(file, place, size)
    ahead = deque(islice(walk, _LOOK))
    while ahead:
        data = b"".join(d for _, d in ahead)
        for at in range(len(ahead[0][1])):
            here, n, step = at, 0, 1
            while n < _CHAIN and here < len(data) and (step := plausible(data, here, lengths)):
                here, n = here + step, n + 1
            if n and step is not None:
                return ahead[0][0] << 16 | at
        ahead.popleft()
        ahead.extend(islice(walk, 1))
    return None


class Region:
    """What filters ask for: a contig and a stretch that reads overlap (0-based, half-open)."""

    def __init__(self, text: str = "") -> None:
        self.chrom, self.begin, self.end = None, 0, 1 << 29
        if text:
            chrom, _, span = text.partition(":")
            low, _, high = span.replace(",", "").partition("-")
            self.chrom, self.begin, self.end = chrom, int(low or 1) - 1, int(high) if high else 1 << 29


class Regions:
    """Several regions, merged by contig; a read is wanted if it overlaps one."""

    def __init__(self, texts: list[str]) -> None:
        self.spans: dict[str, list[tuple[int, int]]] = {}
        for r in sorted((Region(t) for t in texts if t.strip()), key=lambda r: (r.chrom, r.begin)):
            held = self.spans.setdefault(r.chrom, [])
            if held and r.begin <= held[-1][1]:
                held[-1] = (held[-1][0], max(held[-1][1], r.end))
            else:
                held.append((r.begin, r.end))

    def touch(self, chrom: str, begin: int, end: int) -> bool:
        held = self.spans.get(chrom, [])
        i = bisect_left(held, (end,)) - 1  # the last that begins before the end; merged ones end in order
        return i >= 0 and held[i][1] > begin


class Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.asked = Regions(options.get("region", "").split(";"))
        self.pushed = Region()

    def files(self) -> list[tuple[str, int]]:
        system, root = blocks.open_fs(self.path)
        info = system.get_file_info(root)
        if info.type == blocks.fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.is_file:
            return [(self.path, info.size)]
        found = system.get_file_info(blocks.fs.FileSelector(root))
        return sorted((f"{self.path.rstrip('/')}/{x.base_name}", x.size) for x in found if x.is_file and x.base_name.endswith(".bam"))

    def index_of(self, path: str) -> blocks.BinIndex | None:
        system, place = blocks.open_fs(path)
        for name in (place + ".bai", place.removesuffix(".bam") + ".bai"):
            if system.get_file_info(name).is_file:
                with system.open_input_file(name) as f:
                    return blocks.read_contig_index(f.read())
        return None

    def partitions(self) -> list[InputPartition]:
        """(file, first offset, last offset, whether the first is known to begin a record)."""
        out = []
        for path, size in self.files():
            system, place = blocks.open_fs(path)
            index = self.index_of(path)
            with system.open_input_file(place) as f:
                header = Header(f, size)
            whole = [(header.first, size << 16)]
            asked = [(c, *span) for c, spans in self.asked.spans.items() for span in spans]
            pushed = [(self.pushed.chrom, self.pushed.begin, self.pushed.end)] if self.pushed.chrom is not None else []
            for wanted in filter(None, (asked, pushed)) if index else ():
                held = [index.chunks(header.names.index(c), b, e) for c, b, e in wanted if c in header.names]
                found = blocks.united(sorted(x for chunks in held for x in chunks))
                whole = [(max(a, x), min(z, y)) for a, z in whole for x, y in found if max(a, x) < min(z, y)]
            known = index.starts() if index else []
            for first, last in whole:
                cuts = [first]
                if index:
                    for k in known:
                        if first < k < last and (k >> 16) - (cuts[-1] >> 16) >= self.split:
                            cuts.append(k)
                else:
                    cuts += [at << 16 for at in range((first >> 16) + self.split, last >> 16, self.split)]
                out += [InputPartition((path, a, z, index is not None or a == header.first)) for a, z in zip(cuts, [*cuts[1:], last])]
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, first, last, sure = partition.value
        system, place = blocks.open_fs(path)
        size = system.get_file_info(place).size
        with system.open_input_file(place) as f:
            header = Header(f, size)
            if not sure:
                found = first_record(f, blocks.first_block(f, first >> 16, size), size, header.lengths)
                if found is None:
                    return
                first = found
            if last & 0xFFFF == 0 and last >> 16 < size:
                last = blocks.first_block(f, last >> 16, size) << 16
            yield from _batches(path, header, _records(f, first, last, size), self.asked)


class PushingReader(Reader):
    """For sessions that push filters to Python sources; Spark refuses the method in others."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """A contig and bounds of ``start`` prune blocks; Spark applies them all again."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("chrom",):
                self.pushed.chrom = f.value
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("start",):
                self.pushed.begin = max(self.pushed.begin, f.value - 1)
            elif isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == ("start",):
                self.pushed.end = min(self.pushed.end, max(f.value, 1))
            yield f


def _records(file, first: int, last: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(virtual offset, bytes) of the records that begin from ``first`` to before ``last``."""
    walk = blocks.blocks_from(file, first >> 16, size)
    got = next(walk, None)
    if got is None:
        return
    begins, data, at = [(0, got[0])], got[1], first & 0xFFFF
    while True:
        while len(data) < at + 4 or len(data) < at + 4 + struct.unpack_from("<i", data, at)[0]:
            got = next(walk, None)
            if got is None:
                return
            kept = [b for b in begins if b[0] <= at][-1:] + [b for b in begins if b[0] > at]
            cut = min(kept[0][0], at)
            data, at, begins = data[cut:] + got[1], at - cut, [(b - cut, p) for b, p in kept] + [(len(data) - cut, got[0])]
        begin, place = next(b for b in reversed(begins) if b[0] <= at)
        offset = place << 16 | at - begin
        if offset >= last:
            return
        size_of = struct.unpack_from("<i", data, at)[0]
        yield offset, data[at + 4 : at + 4 + size_of]
        at += 4 + size_of


def _batches(path: str, header: Header, records: Iterator[tuple[int, bytes]], asked: Regions) -> Iterator[pa.RecordBatch]:
    names = [n.strip().split() for n in SCHEMA.split(",")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    libraries = read_groups(header.lines)
    contig = lambda i: header.names[i] if i >= 0 else "*"

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), names)], names=[n for n, _ in names])

    rows = []
    for at, data in records:
        ref, pos, width, mapq, _, ops, flag, bases, mate, mate_pos, size = struct.unpack_from("<iiBBHHHiiii", data, 0)
        here = 32 + width
        cigar = struct.unpack_from(f"<{ops}I", data, here)
        covered = sum(c >> 4 for c in cigar if c & 15 in (0, 2, 3, 7, 8))
        if asked.spans and not asked.touch(contig(ref), pos, pos + max(1, covered)):
            continue
        qualities = here + 4 * ops + (bases + 1) // 2
        quality = data[qualities : qualities + bases]
        group = tag(data, qualities + bases, len(data), b"RG")
        seq = data[here + 4 * ops : qualities].hex().encode().translate(_BASES)[:bases].decode()
        steps = "".join(f"{c >> 4}{OPERATIONS[c & 15]}" for c in cigar)
        shown = "*" if not bases or quality[0] == 0xFF else quality.translate(_QUALITY).decode()
        rows.append((path, at, data[32 : here - 1].decode(), flag, contig(ref), pos + 1, mapq, steps or "*", contig(mate), mate_pos + 1, size, seq or "*", shown, group, libraries.get(group, "")))
        if len(rows) == BATCH_RECORDS:
            yield batch(rows)
            rows = []
    if rows:
        yield batch(rows)


class AlignmentFile(DataSource):
    """Format ``alignments``: a .bam file, or a folder of them; options ``region`` (chrom:begin-end, several with ; between, as reads overlap them) and ``splitbytes``."""

    @classmethod
    def name(cls) -> str:
        return "alignments"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return (PushingReader if self.options.get("push") == "true" else Reader)(dict(self.options))


def pushes(spark: SparkSession) -> str:
    return str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower()


def bam(spark: SparkSession, path: str, region: str | list[str] | None = None, primary: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Alignments of .bam files, columns as ``readers.sam`` has them, and ``file``; ``at`` is a record's virtual offset.

    With an index (.bai beside the file) tasks begin at indexed records and ``region``, one or a list, or filters on chrom and start (where the
    session pushes filters to Python sources), prune blocks; without, tasks look for the first record of their stretch.
    """
    spark.dataSource.register(AlignmentFile)
    read = spark.read.format("alignments").option("splitbytes", split_bytes).option("push", pushes(spark))
    asked = region if isinstance(region, str) else ";".join(region or [])
    rows = (read.option("region", asked) if asked else read).load(path)
    return rows.where(f"flag & {NOT_PRIMARY} = 0") if primary else rows
