"""Block-compressed alignment and variant files: round trips, splits, and what an index leaves unread."""

import gzip
import struct

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

from locusmill.sources import alignment_file, blocks, readers, variant_file

CONTIGS = [("chr1", 3_000_000), ("chr2", 500_000), ("chr3", 1000)]
HEADER = ["@HD\tVN:1.6\tSO:coordinate", *[f"@SQ\tSN:{n}\tLN:{m}" for n, m in CONTIGS], "@RG\tID:g1\tLB:libA\tSM:s", "@RG\tID:g2\tSM:s"]


def sam_rows(n=6000, seed=4):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        chrom = int(r.choice([0, 0, 0, 1]))
        length = int(r.choice([1, 50, 75, 150]))
        cigar = str(r.choice([f"{length}M", f"{length}M200N0M" if length > 50 else f"{length}M", f"1S{length - 1}M" if length > 1 else "1M", f"5H{length}="]))
        quality = "*" if i % 50 == 0 else "".join(chr(33 + int(q)) for q in r.integers(0, 60, length))
        tags = ["NM:i:0", "XA:A:c", "XB:B:S,1,2,3", "ZZ:Z:text with spaces", "RG:Z:" + str(r.choice(["g1", "g2"]))][: int(r.integers(0, 6))]
        flag = int(r.choice([0, 16, 99, 147, 0x100, 0x400]))
        rows.append((chrom, int(r.integers(1, CONTIGS[chrom][1] - 400)), flag, f"read{i}", int(r.integers(0, 61)), cigar, "=" if flag in (99, 147) else "*", int(r.integers(1, 1000)) if flag in (99, 147) else 0, int(r.integers(-500, 500)), "".join(r.choice(list("ACGTN"), length)), quality, tags))
    rows.sort(key=lambda x: x[:4])
    rows += [(-1, 0, 4, f"unmapped{i}", 0, "*", "*", 0, 0, "*", "*", []) for i in range(5)]
    return rows


def sam_line(x):
    chrom = CONTIGS[x[0]][0] if x[0] >= 0 else "*"
    return "\t".join(map(str, [x[3], x[2], chrom, x[1], x[4], x[5], x[6], x[7], x[8], x[9], x[10], *x[11]]))


def bam_record(x):
    chrom, pos, flag, name, mapq, cigar, mate, mate_pos, size, seq, quality, tags = x
    ops, n = [], ""
    for c in cigar if cigar != "*" else "":
        n, ops = (n + c, ops) if c.isdigit() else ("", [*ops, int(n) << 4 | "MIDNSHP=X".index(c)])
    bases = "" if seq == "*" else seq
    codes = ["=ACMGRSVTWYHKDBN".index(b) for b in bases] + [0]
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(bases), 2))
    marks = b"\xff" * len(bases) if quality == "*" else bytes(ord(c) - 33 for c in quality)
    extra = b""
    for t in tags:
        tag, kind, value = t.split(":", 2)
        extra += tag.encode() + kind.encode()
        extra += {"i": lambda: struct.pack("<i", int(value)), "A": value.encode, "Z": lambda: value.encode() + b"\0", "B": lambda: b"S" + struct.pack("<i3H", 3, *map(int, value[2:].split(",")))}[kind]()
    covered = sum(o >> 4 for o in ops if o & 15 in (0, 2, 3, 7, 8))
    body = struct.pack("<iiBBHHHiiii", chrom, pos - 1, len(name) + 1, mapq, blocks.bin_of(pos - 1, pos - 1 + max(1, covered)) if pos else 4680, len(ops), flag, len(bases), chrom if mate == "=" else -1, mate_pos - 1, size)
    body += name.encode() + b"\0" + struct.pack(f"<{len(ops)}I", *ops) + packed + marks + extra
    return struct.pack("<i", len(body)) + body, covered


def write_bam(path, rows, block=1500, index=True):
    """A file of small blocks, so that records lie across them."""
    text = ("\n".join(HEADER) + "\n").encode()
    data = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(CONTIGS))
    for n, m in CONTIGS:
        data += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", m)
    places = []
    for x in rows:
        raw, covered = bam_record(x)
        places.append((x[0], x[1] - 1, x[1] - 1 + max(1, covered), len(data), len(data) + len(raw)))
        data += raw
    out, starts = b"", []
    for i in range(0, len(data), block):
        starts.append(len(out))
        out += blocks.compressed(data[i : i + block])
    starts.append(len(out))
    offset = lambda at: starts[at // block] << 16 | at % block
    path.write_bytes(out + blocks.END_OF_FILE)
    if index:
        told = blocks.BinIndex()
        for contig, begin, end, start, stop in places:
            if contig >= 0:
                told.add(contig, begin, end, offset(start), offset(stop))
        path.with_name(path.name + ".bai").write_bytes(blocks.contig_index(told, len(CONTIGS)))


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("reads")
    rows = sam_rows()
    (folder / "a.sam").write_text("\n".join([*HEADER, *map(sam_line, rows)]) + "\n")
    write_bam(folder / "a.bam", rows)
    write_bam(folder / "plain.bam", rows, index=False)
    return folder, rows


COLUMNS = ["qname", "flag", "chrom", "start", "mapq", "cigar", "next_chrom", "next_start", "insert_size", "seq", "quality", "read_group", "library"]


@pytest.mark.parametrize("name", ["a.bam", "plain.bam"])
def test_alignments_equal_their_text_in_many_splits(spark, files, name):
    folder, _ = files
    want = sorted(map(tuple, readers.sam(spark, f"{folder}/a.sam", primary=False).select(*COLUMNS).collect()))
    for split in (20_000, 70_001, 1 << 30):
        got = alignment_file.bam(spark, f"{folder}/{name}", primary=False, split_bytes=split)
        assert sorted(map(tuple, got.select(*COLUMNS).collect())) == want
        assert (got.rdd.getNumPartitions() > 3) == (split < 100_000)
        assert got.select("at").distinct().count() == len(want)
    assert alignment_file.bam(spark, f"{folder}/{name}").count() == readers.sam(spark, f"{folder}/a.sam").count()


@pytest.mark.parametrize("region", ["chr1:1,000,000-1,050,000", "chr2", "chr1:2999000", "chr3:1-10", "none"])
@pytest.mark.parametrize("name", ["a.bam", "plain.bam"])
def test_regions_equal_a_filter(spark, files, name, region):
    folder, rows = files
    asked = alignment_file.Region(region)
    got = alignment_file.bam(spark, f"{folder}/{name}", region, primary=False).select("qname").collect()
    want = [x[3] for x in rows if x[0] >= 0 and CONTIGS[x[0]][0] == asked.chrom and x[1] - 1 < asked.end and x[1] - 1 + max(1, bam_record(x)[1]) > asked.begin]
    assert sorted(r[0] for r in got) == sorted(want)


@pytest.mark.parametrize("name", ["a.bam", "plain.bam"])
def test_several_regions_give_each_read_once(spark, files, name):
    folder, rows = files
    asked = ["chr1:1000-30000", "chr1:20000-40000", "chr1:2900000", "chr2:1-5", "chr2:7000-7001", "chrX:1-2"]
    got = alignment_file.bam(spark, f"{folder}/{name}", asked, primary=False, split_bytes=50_000).select("qname").collect()
    spans = [alignment_file.Region(t) for t in asked]
    want = [x[3] for x in rows if x[0] >= 0 and any(CONTIGS[x[0]][0] == r.chrom and x[1] - 1 < r.end and x[1] - 1 + max(1, bam_record(x)[1]) > r.begin for r in spans)]
    assert sorted(r[0] for r in got) == sorted(want) and len(want) > 100


def test_evidence_from_an_indexed_file(spark, files):
    from locusmill.plans import evidence

    folder, rows = files
    spots = [(CONTIGS[x[0]][0], x[1] + 20, "A", "C") for x in rows[100:4000:300]] + [("chr3", 5, "A", "C")]
    loci = spark.createDataFrame(spots, "chrom string, pos long, ref string, alt string")
    told = [evidence.evidence(evidence.observations(loci, reads), loci).orderBy("chrom", "pos").collect() for reads in (readers.sam(spark, f"{folder}/a.sam"), evidence.reads_over(f"{folder}/a.bam", loci))]
    assert told[0] == told[1] and sum(r["raw_read_depth"] for r in told[0]) >= 5
    assert evidence.reads_over(f"{folder}/a.bam", loci.limit(0)).count() == 0


def span(reader):
    return sum((p.value[2] >> 16) - (p.value[1] >> 16) for p in reader.partitions() if p.value)


def test_filters_prune_blocks(spark, files):
    folder, rows = files
    options = {"path": f"{folder}/a.bam"}
    whole, some = alignment_file.PushingReader(options), alignment_file.PushingReader(options)
    kept = list(some.pushFilters([EqualTo(("chrom",), "chr1"), GreaterThanOrEqual(("start",), 1_500_000), LessThan(("start",), 1_520_000)]))
    assert len(kept) == 3 and 0 < span(some) < span(whole) / 10
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = alignment_file.bam(spark, f"{folder}/a.bam", primary=False).where("chrom = 'chr1' and start >= 1500000 and start < 1520000")
        assert sorted(r["qname"] for r in got.collect()) == sorted(x[3] for x in rows if x[0] == 0 and 1_500_000 <= x[1] < 1_520_000)
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_first_blocks_and_records_are_found_from_any_byte(files):
    folder, rows = files
    path = folder / "plain.bam"
    size = path.stat().st_size
    with open(path, "rb") as f:
        header = alignment_file.Header(f, size)
        starts = [at for at, _ in alignment_file._records(f, header.first, size << 16, size)]
        assert len(starts) == len(rows)
        places = [at for at, _ in blocks.blocks_from(f, 0, size)]
        for at in range(1, size, size // 40):
            block = blocks.first_block(f, at, size)
            assert block == min((p for p in places if p >= at), default=block) and block >= at
            assert alignment_file.first_record(f, block, size, header.lengths) == min((s for s in starts if s >= block << 16), default=None)


def variants(n=5000, seed=6):
    r = np.random.default_rng(seed)
    rows = [(str(r.choice(["chr1", "chr1", "chr2"])), int(r.integers(1, 400_000)), "A" * int(r.choice([1, 1, 3, 40_000 if i == 7 else 2])), f"v{i}") for i in range(n)]
    return [(c, p, ref, f"{c}\t{p}\t{i}\t{ref}\tT\t.\tPASS\tK={'x' * 60}{i}") for c, p, ref, i in rows]


@pytest.mark.parametrize("parts", [1, 5])
def test_variant_files(spark, tmp_path, parts):
    rows = variants()
    df = spark.createDataFrame(rows, "chrom string, pos long, ref string, raw_line string").repartition(6)
    header = ["##fileformat=VCFv4.2", "##contig=<ID=chr1>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    path = f"{tmp_path}/out"
    for _ in range(2):  # written again over itself
        variant_file.write_variants(df, header, ["chr1", "chr2", "chr3"], path, "##note=1", parts)
    variant_file.join_parts(path, f"{tmp_path}/one.vcf.gz")
    text = gzip.open(f"{tmp_path}/one.vcf.gz", "rt").read().splitlines()
    assert text[:4] == [header[0], header[1], "##note=1", header[2]]
    assert text[4:] == [x[3] for x in sorted(rows, key=lambda x: (x[0], x[1], x[3]))]
    assert sorted(r["line"] for r in variant_file.read_variants(spark, path).collect()) == sorted(x[3] for x in rows)
    for chrom, begin, end in [("chr1", 100_000, 120_000), ("chr2", 0, 1 << 29), ("chr2", 399_990, 500_000), ("chr3", 0, 100), ("chr9", 0, 9)]:
        got = variant_file.read_variants(spark, path, chrom, begin, end)
        assert sorted(r["line"] for r in got.collect()) == sorted(x[3] for x in rows if x[0] == chrom and x[1] - 1 < end and x[1] - 1 + len(x[2]) > begin)
    whole = variant_file.Reader({"path": path})
    some = variant_file.Reader({"path": path, "chrom": "chr1", "begin": "100000", "end": "101000"})
    assert span(some) < span(whole) / 3
    # The joined file's own index names the same chunks.
    index, names = blocks.read_text_index((tmp_path / "one.vcf.gz.tbi").read_bytes())
    with open(tmp_path / "one.vcf.gz", "rb") as f:
        size = (tmp_path / "one.vcf.gz").stat().st_size
        for first, _ in index.chunks(names.index("chr1"), 100_000, 101_000):
            place, data = next(blocks.blocks_from(f, first >> 16, size))
            assert place == first >> 16 and data[first & 0xFFFF :].startswith(b"chr1\t")


def test_variant_files_of_nothing_and_of_unknown_contigs(spark, tmp_path):
    none = spark.createDataFrame([], "chrom string, pos long, ref string, raw_line string")
    variant_file.write_variants(none, ["#CHROM"], ["chr1"], f"{tmp_path}/none")
    assert variant_file.read_variants(spark, f"{tmp_path}/none").count() == 0
    odd = spark.createDataFrame([("chrZ", 1, "A", "chrZ\t1")], none.schema)
    with pytest.raises(Exception, match="no contig chrZ"):
        variant_file.write_variants(odd, ["#CHROM"], ["chr1"], f"{tmp_path}/odd")


def test_bins_hold_what_they_should():
    r = np.random.default_rng(1)
    for _ in range(500):
        begin = int(r.integers(0, 1 << 28))
        end = begin + int(r.choice([1, 100, 20_000, 5_000_000]))
        low = int(r.integers(max(0, begin - 1000), end))
        assert blocks.bin_of(begin, end) in blocks.bins_over(low, low + 1) or not begin <= low < end
    assert (blocks.bin_of(0, 1), blocks.bin_of(0, 1 << 29), blocks.bin_of(16383, 16385)) == (4681, 0, 585)
