"""Variant files that are block-compressed and indexed: written in parts by the tasks, indexed as one file at commit, read by region.

The parts of a folder, joined in order of their names, are one file, and its index is that of the whole.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from locusmill.operators.ranges import contig_rank
from locusmill.sources import blocks

# The classes travel by value, so that workers need no copy of the package.
for _module in (blocks.__name__, __name__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

SCHEMA = "chrom string, pos long, line string"
INDEX, MANIFEST = "variants.tbi", "_parts.json"


@dataclass
class Part(WriterCommitMessage):
    """What a task has written: its place among the parts, file, bytes, and the index with offsets from the part's beginning."""

    number: int
    file: str
    size: int
    records: int
    index: blocks.BinIndex


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.contigs, self.header = options["path"], json.loads(options["contigs"]), json.loads(options["header"])
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        system, root = blocks.open_fs(self.path)
        system.create_dir(root, recursive=True)
        number = TaskContext.get().partitionId()
        # A task that runs twice writes two files; only the one whose message arrives is kept.
        name = f".{number:06d}-{uuid.uuid4().hex}"
        rank = {c: i for i, c in enumerate(self.contigs)}
        index, held, begun, size, n = blocks.BinIndex(), bytearray(), 0, 0, 0
        waiting: list[tuple] = []
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:

            def flush(least: int) -> None:
                nonlocal held, begun, size
                while len(held) >= max(1, least):
                    block = blocks.compressed(bytes(held[: blocks.BLOCK]))
                    out.write(block)
                    places.append((begun, size))
                    begun += min(len(held), blocks.BLOCK)
                    size += len(block)
                    held = held[blocks.BLOCK :]

            places: list[tuple[int, int]] = []
            written = 0
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("chrom", "pos", "end", "line")]
                for chrom, pos, end, line in zip(*columns):
                    raw = line.encode() + b"\n"
                    waiting.append((rank[chrom], pos - 1, max(end, pos), written, written + len(raw)))
                    held += raw
                    written += len(raw)
                    n += 1
                flush(blocks.BLOCK)
            flush(1)
        offsets = _Offsets(places, size)
        for contig, begin, end, start, stop in waiting:
            index.add(contig, begin, end, offsets.of(start), offsets.of(stop))
        return Part(number, name, size, n, index)

    def commit(self, messages: list[Part | None]) -> None:
        system, root = blocks.open_fs(self.path)
        system.create_dir(root, recursive=True)
        parts = sorted((m for m in messages if m and m.records), key=lambda m: m.number)
        kept = {m.file for m in parts}
        for old in system.get_file_info(blocks.fs.FileSelector(root)):
            if old.is_file and old.base_name not in kept and (self.overwrite or old.base_name.startswith(".0")):
                system.delete_file(old.path)
        text = "".join(h + "\n" for h in self.header).encode()
        top = b"".join(blocks.compressed(text[i : i + blocks.BLOCK]) for i in range(0, len(text), blocks.BLOCK))
        whole, at, told = blocks.BinIndex(), len(top), [("part-000000.vcf.gz", len(top))]
        self._put(system, f"{root}/part-000000.vcf.gz", top)
        for i, m in enumerate(parts, 1):
            name = f"part-{i:06d}.vcf.gz"
            system.move(f"{root}/{m.file}", f"{root}/{name}")
            whole.join(m.index, at)
            told.append((name, m.size))
            at += m.size
        last = f"part-{len(parts) + 1:06d}.vcf.gz"
        self._put(system, f"{root}/{last}", blocks.END_OF_FILE)
        told.append((last, len(blocks.END_OF_FILE)))
        self._put(system, f"{root}/{INDEX}", blocks.text_index(whole, self.contigs))
        self._put(system, f"{root}/{MANIFEST}", json.dumps({"parts": told, "records": sum(m.records for m in parts)}).encode())

    def abort(self, messages: list[Part | None]) -> None:
        system, root = blocks.open_fs(self.path)
        for m in messages:
            if m and system.get_file_info(f"{root}/{m.file}").is_file:
                system.delete_file(f"{root}/{m.file}")

    @staticmethod
    def _put(system, path: str, data: bytes) -> None:
        with system.open_output_stream(path, compression=None) as f:
            f.write(data)


class _Offsets:
    """Virtual offsets of places in a part's content, asked for in rising order of their beginnings."""

    def __init__(self, places: list[tuple[int, int]], size: int) -> None:
        self.places, self.size = places, size

    def of(self, at: int) -> int:
        number = at // blocks.BLOCK  # every block but the last is full
        if number >= len(self.places):
            return self.size << 16
        return self.places[number][1] << 16 | at - self.places[number][0]


class Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.chrom = options.get("chrom")
        self.begin, self.end = int(options.get("begin", 0)), int(options.get("end", 1 << 29))

    def _read(self, name: str) -> bytes:
        system, root = blocks.open_fs(self.path)
        with system.open_input_file(f"{root}/{name}") as f:
            return f.read()

    def partitions(self) -> list[InputPartition]:
        """(part, first offset, last offset): whole parts, or the stretches of the index that can hold the region's records."""
        parts = json.loads(self._read(MANIFEST))["parts"]
        if self.chrom is None:
            return [InputPartition((name, 0, size << 16)) for name, size in parts[1:-1]] or [InputPartition(None)]
        index, names = blocks.read_text_index(self._read(INDEX))
        found = index.chunks(names.index(self.chrom), self.begin, self.end) if self.chrom in names else []
        out, at = [], 0
        for name, size in parts:
            for first, last in found:
                first, last = max(first, at << 16), min(last, at + size << 16)
                if first < last:
                    out.append(InputPartition((name, first - (at << 16), last - (at << 16))))
            at += size
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        name, first, last = partition.value
        system, root = blocks.open_fs(self.path)
        size = system.get_file_info(f"{root}/{name}").size
        left = b""
        with system.open_input_file(f"{root}/{name}") as f:
            for place, data in blocks.blocks_from(f, first >> 16, size):
                if place > last >> 16 or place == last >> 16 and not last & 0xFFFF:
                    break
                end = last & 0xFFFF if place == last >> 16 else len(data)
                data = left + data[first & 0xFFFF if place == first >> 16 else 0 : end]
                cut = data.rfind(b"\n") + 1
                left = data[cut:]
                lines = [x.split("\t", 2)[:2] + [x] for x in data[:cut].decode().split("\n")[:-1]]
                lines = [(c, int(p), x) for c, p, x in lines]
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in lines], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string()))], names=["chrom", "pos", "line"])


class VariantFile(DataSource):
    """Format ``variants``. Write (chrom, pos, end, line) in order of the file, with options header and contigs (JSON lists); read SCHEMA, with options chrom, begin and end (0-based, half-open)."""

    @classmethod
    def name(cls) -> str:
        return "variants"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return Reader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(dict(self.options), overwrite)


def write_variants(rows: DataFrame, header: list[str], contigs: list[str], path: str, note: str | None = None, parts: int | None = None) -> None:
    """Records (chrom, pos, ref, raw_line) by contig and place below their header, with ``note`` before #CHROM. (K1)

    Tasks sort, compress and index their own range; the driver only adds the indexes up. Contigs that ``contigs`` lacks raise.
    """
    rows.sparkSession.dataSource.register(VariantFile)
    top = [h for h in header if not h.startswith("#CHROM")] + ([note] if note else []) + [h for h in header if h.startswith("#CHROM")]
    rank = contig_rank(F.col("chrom"), contigs)
    known = F.when(rank > len(contigs), F.raise_error(F.concat(F.lit("the header has no contig "), F.coalesce("chrom", F.lit("null"))))).otherwise(rank)
    out = rows.select("chrom", F.col("pos").cast("long").alias("pos"), (F.col("pos") - 1 + F.greatest(F.length("ref"), F.lit(1))).cast("long").alias("end"), F.col("raw_line").alias("line"), known.alias("_rank"))
    order = ["_rank", "pos", "line"]
    out = (out.repartitionByRange(parts, *order) if parts else out.repartitionByRange(*order)).sortWithinPartitions(*order).drop("_rank")
    out.write.format("variants").option("header", json.dumps(top)).option("contigs", json.dumps(contigs)).mode("overwrite").save(path)


def read_variants(spark: SparkSession, path: str, chrom: str | None = None, begin: int = 0, end: int = 1 << 29) -> DataFrame:
    """``chrom, pos, line`` of all records, or of those that overlap [begin, end) of a contig: by the index, blocks elsewhere are not read. (K1)"""
    spark.dataSource.register(VariantFile)
    read = spark.read.format("variants")
    if chrom is None:
        return read.load(path)
    ref = F.element_at(F.split("line", "\t", 5), 4)
    rows = read.option("chrom", chrom).option("begin", begin).option("end", end).load(path)
    return rows.where((F.col("chrom") == chrom) & (F.col("pos") - 1 < end) & (F.col("pos") - 1 + F.greatest(F.length(ref), F.lit(1)) > begin))


def join_parts(path: str, target: str) -> None:
    """One file of a folder's parts, with its index beside it, for tools that want one; copied in steps of 8 MB."""
    (system, root), (other, place) = blocks.open_fs(path), blocks.open_fs(target)
    with system.open_input_file(f"{root}/{MANIFEST}") as f:
        parts = json.loads(f.read())["parts"]
    with other.open_output_stream(place, compression=None) as out:
        for name, _ in parts:
            with system.open_input_stream(f"{root}/{name}", compression=None) as part:
                while got := part.read(8 << 20):
                    out.write(got)
    with system.open_input_file(f"{root}/{INDEX}") as f, other.open_output_stream(place + ".tbi", compression=None) as out:
        out.write(f.read())
