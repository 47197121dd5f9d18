"""Plans over alignments and their order, against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.operators import intervals as iv
from locusmill.operators import ranges as rg
from locusmill.operators import sweep
from locusmill.plans import coverage

READS = "at long, qname string, flag long, chrom string, start long, mapq int, cigar string, next_chrom string, next_start long, insert_size long, seq string, quality string, library string"
CIGARS = ["50M", "5S45M", "20M3D30M", "10M2I38M", "30M100N20M", "4H46M4S", "20=1X29M", "10M5P40M", "*"]


def some_reads(n=400, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        flag = int(r.choice([0x1 | 0x2 | 0x40, 0x1 | 0x2 | 0x80 | 0x10, 0x10, 0, 0x400, 0x100, 0x4, 0x200]))
        cigar = str(r.choice(CIGARS))
        rows.append((i, f"q{r.integers(0, n // 2)}", flag, str(r.choice(["chr1", "chr2"])), int(r.integers(1, 600)), int(r.choice([0, 19, 20, 60])), cigar, "*", 0, 0, "A" * 50, "I" * 50, "lib"))
    return rows


def blocks_of(cigar, start):
    at, out = start - 1, []
    for n, kind in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        if kind in "M=X":
            out += range(at, at + int(n))
        if kind in "M=XDN":
            at += int(n)
    return out


def brute_depth(rows, least=20, once=True):
    depth = defaultdict(Counter)
    seen = set()
    for at, name, flag, chrom, start, mapq, cigar, *_ in rows:
        if flag & 0x704 or mapq < least:
            continue
        for p in blocks_of(cigar, start):
            if not once or (chrom, name, p) not in seen:
                seen.add((chrom, name, p))
                depth[chrom][p] += 1
    return depth


def test_coverage(spark):
    rows = some_reads() + [(1000 + i, f"hot{i}", 0, "chr1", 77, 60, "50M", "*", 0, 0, "", "", "lib") for i in range(3000)]
    reads = spark.createDataFrame(rows, READS).repartition(4)
    depth = brute_depth(rows)
    segments = sweep.depth_segments(coverage.covering_blocks(reads), ["chrom"], width=64)
    got = defaultdict(Counter)
    told = sorted((r["chrom"], r["start"], r["end"], r["depth"]) for r in segments.collect())
    for chrom, start, end, d in told:
        for p in range(start, end):
            got[chrom][p] += d
    assert got == depth
    assert not any(a[0] == b[0] and a[2] == b[1] and a[3] == b[3] for a, b in zip(told, told[1:]))
    regions = [("chr1", 0, 200, "a"), ("chr1", 50, 90, "b"), ("chr1", 50, 90, "c"), ("chr2", 100, 164, "d"), ("chr3", 0, 10, "e"), ("chr1", 9, 9, "f"), (None, 1, 5, "g"), ("chr1", 5000, 9000, "h")]
    out = {r["name"]: r for r in coverage.coverage(reads, spark.createDataFrame(regions, "chrom string, start long, end long, name string")).collect()}
    assert len(out) == len(regions)
    every = coverage.bed_coverage(reads, spark.createDataFrame(regions, "chrom string, start long, end long, name string"))
    sums = {r["name"]: r["depth_sum"] for r in every.collect()}
    plain = brute_depth(rows, 0, once=False)
    for chrom, start, end, name in regions:
        here = [depth[chrom][p] for p in range(start, end)]
        r = out[name]
        assert (r["bases"], r["covered"], r["depth_sum"]) == (len(here), sum(d > 0 for d in here), sum(here))
        assert r["mean_depth"] == pytest.approx(sum(here) / len(here) if here else 0)
        for t in coverage.THRESHOLDS:
            assert r[f"share_{t}"] == pytest.approx(sum(d >= t for d in here) / len(here) if here else 0)
        assert sums[name] == sum(plain[chrom][p] for p in range(start, end))


def test_coverage_summary(spark):
    rows = some_reads(200, 4)
    depth = brute_depth(rows)
    segments = sweep.depth_segments(coverage.covering_blocks(spark.createDataFrame(rows, READS)), ["chrom"])
    contigs = spark.createDataFrame([("chr1", 900), ("chr2", 800), ("chr3", 5)], "chrom string, length long")
    regions = spark.createDataFrame([("chr1", 10, 100), ("chr1", 90, 300), ("chr2", 0, 50)], "chrom string, start long, end long")
    got = {r["chrom"]: tuple(r)[1:] for r in coverage.coverage_summary(segments, contigs, regions).collect()}

    def told(places):
        d = [depth[c][p] for c, p in places]
        return len(d), sum(d), round(sum(d) / len(d), 2), min(d), max(d)

    spots = {"chr1": [("chr1", p) for p in range(900)], "chr2": [("chr2", p) for p in range(800)], "chr3": [("chr3", p) for p in range(5)], "chr1_region": [("chr1", p) for p in range(10, 300)], "chr2_region": [("chr2", p) for p in range(50)]}
    spots["total"] = [x for c in ("chr1", "chr2", "chr3") for x in spots[c]]
    spots["total_region"] = spots["chr1_region"] + spots["chr2_region"]
    assert got == {c: told(p) for c, p in spots.items()}


def test_depth_of_nothing(spark):
    none = spark.createDataFrame([("c", 5, 5), ("c", 7, 2), ("c", None, 2)], "chrom string, start long, end long")
    assert sweep.depth_segments(none, ["chrom"]).count() == 0
    keyed = spark.createDataFrame([(None, 0, 3), (None, 1, 2)], "chrom string, start long, end long")
    assert sorted(tuple(r) for r in sweep.depth_segments(keyed, ["chrom"]).collect()) == [(None, 0, 1, 1), (None, 1, 2, 2), (None, 2, 3, 1)]


def test_sorted_parts_and_scans_of_a_range(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(int(c), int(p), f"n{i}") for i, (c, p) in enumerate(zip(r.integers(1, 4, 3000), r.integers(0, 500, 3000)))] + [(2, 250, f"hot{i}") for i in range(4000)]
    path = f"file://{tmp_path}/sorted"
    df = spark.createDataFrame(rows, "contig int, pos int, name string").repartition(7)
    rg.write_sorted(df, path, ["contig", "pos"], parts=12)
    got = rg.read_sorted(spark, path)
    assert [tuple(x)[:3] for x in sorted(got.collect(), key=lambda x: x["place"])] == sorted(rows)
    assert sorted(x["place"] for x in got.collect()) == list(range(1, len(rows) + 1))
    # The hot key is split between parts, and a scan opens only the parts of its range.
    files = rg.files_between(spark, path, {"contig": 2, "pos": 250}, {"contig": 2, "pos": 250})
    assert len(files) > 3
    few = rg.files_between(spark, path, {"contig": 3, "pos": 400}, {"contig": 3})
    assert 0 < len(few) < 4
    part = rg.read_between(spark, path, {"contig": 3, "pos": 400}, {"contig": 3})
    assert sorted(tuple(x) for x in part.collect()) == sorted(x for x in rows if x[0] == 3 and x[1] >= 400)
    assert len(part.inputFiles()) == len(few)
    assert rg.read_between(spark, path, {"contig": 9}, {"contig": 9}).count() == 0


def test_orders_of_contigs_and_names(spark):
    names = ["r10", "r2", "r2a", "a1b10", "a1b9", "r02", "x"]
    rows = spark.createDataFrame([(n, c) for n, c in zip(names, ["chr2", "chr10", "chr1", None, "chrX", "chr10", "chr1"])], "name string, chrom string")
    order = [r["name"] for r in rows.orderBy(rg.natural_key(F.col("name"))).collect()]
    assert order == ["a1b9", "a1b10", "r2", "r02", "r2a", "r10", "x"]
    ranks = {r["chrom"]: r["k"] for r in rows.select("chrom", rg.contig_rank(F.col("chrom"), ["chr1", "chr2", "chr10"]).alias("k")).collect()}
    assert ranks == {"chr1": 1, "chr2": 2, "chr10": 3, "chrX": 4, None: 4}


@pytest.mark.parametrize("keyed", [True, False])
def test_nearest_carries_intervals_over_ranges(spark, keyed):
    r = np.random.default_rng(8)
    ivs = [(k, int(s) * 40, int(s) * 40 + int(n)) for k in "ab" for s, n in zip(sorted({int(x) for x in r.integers(0, 4000, 60)}), r.integers(1, 39, 60))]
    points = [(i, str(r.choice(list("abc"))), float(x)) for i, x in enumerate(r.integers(-500, 165_000, 400))]
    if not keyed:
        ivs = [("a", s, e) for k, s, e in ivs if k == "a"]
    side = spark.createDataFrame(ivs, "k string, start long, end long")
    keys = {"k": "k"} if keyed else {}
    out = iv.nearest(spark.createDataFrame(points, "id int, k string, v double"), side, F.col("v"), F.col("v"), keys, 50.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    got = {r["id"]: (r["inside"], r["distance"]) for r in out.collect()}
    for i, k, v in points:
        near = [(s, e) for key, s, e in ivs if not keyed or key == k]
        inside = any(s <= v < e for s, e in near)
        assert got[i] == (inside, 0.0 if inside else min((min(abs(v - e), abs(s - v)) for s, e in near), default=None))


def five(cigar, start, back):
    ops = [(int(n), k) for n, k in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    def clip(some):
        n = 0
        for m, k in some:
            if k not in "SH":
                break
            n += m
        return n
    if back:
        return start + sum(n for n, k in ops if k in "MDN=X") - 1 + clip(reversed(ops))
    return start - clip(ops)


def brute_duplicates(rows):
    mapped = [r for r in rows if not r[2] & 0x904]
    end = {r[0]: (r[3], five(r[6], r[4], bool(r[2] & 0x10)), bool(r[2] & 0x10)) for r in mapped}
    score = {r[0]: sum(ord(c) - 33 for c in r[11] if ord(c) - 33 >= 15) if r[11] != "*" else 0 for r in mapped}
    library = {r[0]: r[12] or "" for r in mapped}
    mates = defaultdict(dict)
    for r in sorted(mapped):
        if r[2] & 0x1 and not r[2] & 0x8 and r[1] is not None:
            for b in (0x40, 0x80):
                if r[2] & b:
                    mates[library[r[0]], r[1]].setdefault(b, r[0])
    pairs = [(m[0x40], m[0x80]) for m in mates.values() if len(m) == 2 and m[0x40] != m[0x80]]
    groups, gone, paired = defaultdict(list), set(), {a for p in pairs for a in p}
    for a, b in pairs:
        groups[library[a], *sorted([end[a], end[b]])].append((-(score[a] + score[b]), min(a, b), a, b))
    for g in groups.values():
        gone |= {x for p in sorted(g)[1:] for x in p[2:]}
    singles = defaultdict(list)
    for r in mapped:
        singles[library[r[0]], *end[r[0]]].append(r[0])
    for g in singles.values():
        alone = sorted((-score[a], a) for a in g if a not in paired)
        gone |= {a for _, a in alone[0 if any(a in paired for a in g) else 1 :]}
    return gone


def pair_reads(n=500, seed=5):
    """Mates with clips and strands, single reads, mates that are unmapped, names that repeat, secondary alignments, reads without qualities."""
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lib, spot = str(r.choice(["l1", "l2"])) if i % 7 else None, int(r.integers(100, 130))
        quality = lambda: "*" if r.random() < 0.1 else "".join(chr(33 + int(q)) for q in r.integers(5, 40, 20))
        cigar = lambda: str(r.choice(["20M", "5S15M", "15M5S", "10M5D10M", "2H3S15M", "15M3S2H"]))
        back = int(r.choice([0, 0x10]))
        kind = r.random()
        name = f"q{i}" if kind < 0.95 else "again"
        row = lambda flag, start, mate: (len(rows), name, flag, "chr1" if r.random() < 0.9 else "chr2", start, 60, cigar(), "chr1", mate, 100, "A" * 20, quality(), lib)
        if kind < 0.3 or kind > 0.95:
            rows.append(row(back, spot, 0))
        elif kind < 0.4:
            rows.append(row(0x1 | 0x40 | 0x8 | back, spot, 0))
            rows.append((len(rows), name, 0x1 | 0x80 | 0x4, "chr1", spot, 0, "*", "chr1", spot, 0, "A" * 20, quality(), lib))
        else:
            rows.append(row(0x1 | 0x40 | back, spot, spot + 50))
            rows.append(row(0x1 | 0x80 | (back ^ 0x10), spot + int(r.integers(50, 54)), spot))
        if kind < 0.05:
            rows.append(row(0x100 | back, spot, 0))
    return rows


def test_duplicates(spark):
    from locusmill.plans import duplicates as dup

    rows = pair_reads()
    hot = [(10_000 + i, f"hot{i}", 0, "chr1", 500, 60, "20M", "*", 0, 0, "A" * 20, chr(33 + i % 40) * 20, "l1") for i in range(4000)]
    reads = spark.createDataFrame(rows + hot, READS).repartition(5)
    marked = dup.mark_duplicates(reads)
    assert marked.columns == [*reads.columns, "duplicate"]
    got = {r["at"] for r in marked.where("duplicate").collect()}
    assert marked.count() == len(rows + hot)
    assert got == brute_duplicates(rows + hot) and len(got) > 4000
    assert dup.mark_duplicates(reads.limit(0)).count() == 0
    by_library = {r["library"]: r for r in dup.duplicate_metrics(marked).collect()}
    one = by_library["l2"]
    mine = [r for r in rows if r[12] == "l2"]
    pairs = [r for r in mine if not r[2] & 0x904 and r[2] & 1 and not r[2] & 8]
    assert one["read_pairs_examined"] == len(pairs) // 2 and one["read_pair_duplicates"] == sum(r[0] in got for r in pairs) // 2
    assert one["unmapped_reads"] == sum(bool(r[2] & 4) for r in mine) and one["secondary_or_supplementary_reads"] == sum(bool(r[2] & 0x100) for r in mine)
    n, c, x = one["read_pairs_examined"], one["read_pairs_examined"] - one["read_pair_duplicates"], one["estimated_library_size"]
    assert abs(c / x - 1 + np.exp(-n / x)) < 0.02


def test_alignment_metrics(spark):
    from locusmill.plans import alignment_quality as quality

    rows = pair_reads(300, 9)
    reads = spark.createDataFrame([(*r[:9], (1 if r[2] & 0x40 else -1) * (50 + r[0] % 37), *r[10:]) for r in rows], READS)
    hist = {(r["orientation"], r["size"]): r["n"] for r in quality.insert_sizes(reads).collect()}
    want = Counter()
    for r in reads.collect():
        if r["flag"] & 1 and not r["flag"] & (4 | 8 | 0x40 | 0x100 | 0x400 | 0x800):
            back = bool(r["flag"] & 0x10)
            length = sum(int(n) for n, k in re.findall(r"(\d+)([MIDNSHP=X])", r["cigar"]) if k in "MDN=X")
            plus, minus = (r["next_start"], r["start"] + length - 1) if back else (r["start"], r["start"] + r["insert_size"])
            want["TANDEM" if back == bool(r["flag"] & 0x20) else "FR" if plus < minus else "RF", abs(r["insert_size"])] += 1
    assert hist == want
    summary = {r["category"]: r for r in quality.alignment_summary(reads).collect()}
    first = [r for r in rows if r[2] & 1 and r[2] & 0x40 and not r[2] & 0x900]
    assert summary["FIRST_OF_PAIR"]["total_reads"] == len(first) and summary["PAIR"]["total_reads"] == sum(bool(r[2] & 1) and not r[2] & 0x900 for r in rows)
    cycles = {(r["read"], r["cycle"]): r for r in quality.by_cycle(reads).collect()}
    for read in (1, 2):
        some = [r for r in rows if not r[2] & 0x904 and r[11] != "*" and (2 if r[2] & 0x80 else 1) == read]
        for c in (1, 20):
            q = [ord((r[11][::-1] if r[2] & 0x10 else r[11])[c - 1]) - 33 for r in some]
            assert cycles[read, c]["mean_quality"] == pytest.approx(np.mean(q), abs=1e-6)
            assert cycles[read, c]["pct_t"] == pytest.approx(np.mean([bool(r[2] & 0x10) for r in some]), abs=1e-6)
    marks = Counter(ord(c) - 33 for r in rows if not r[2] & 0x904 and r[11] != "*" for c in r[11])
    assert {r["quality"]: r["n"] for r in quality.quality_distribution(reads).collect()} == marks


def test_gc_bias(spark):
    from locusmill.plans import alignment_quality as quality
    from locusmill.sources import readers

    r = np.random.default_rng(6)
    genome = {"chr1": "".join(r.choice(list("ACGT"), 2500, p=[0.2, 0.3, 0.3, 0.2])) + "N" * 30 + "".join(r.choice(list("ACGTN"), 400)), "chr2": "ACGT" * 20}
    chunks = readers.genome_chunks(spark.createDataFrame(list(genome.items()), "name string, sequence string"), 500)
    rows = [x for x in some_reads(300, 12)] + [(999, "q", 0, "chr1", 2790, 60, "50M", "*", 0, 0, "", "", "l"), (1000, "q", 16, "chr1", 20, 60, "50M", "*", 0, 0, "", "", "l")]
    content = {}
    for chrom, s in genome.items():
        for i in range(len(s) - 99):
            w = s[i : i + 100]
            known = sum(w.count(c) for c in "ACGT")
            if 100 - known <= 4:
                content[chrom, i] = int(100 * (w.count("G") + w.count("C")) / known + 0.5)
    windows, starts = Counter(content.values()), Counter()
    for _, _, flag, chrom, start, _, cigar, *_ in rows:
        if not flag & 0xB04:
            reach = sum(int(n) for n, k in re.findall(r"(\d+)([MIDNSHP=X])", cigar) if k in "MDN=X")
            place = start - 1 + reach - 100 if flag & 16 else start - 1
            if (chrom, place) in content:
                starts[content[chrom, place]] += 1
    got = {x["gc"]: x for x in quality.gc_bias(spark.createDataFrame(rows, READS), chunks, chunk=500).collect()}
    assert {g: x["windows"] for g, x in got.items()} == windows and {g: x["read_starts"] for g, x in got.items() if x["read_starts"]} == starts
    mean = sum(starts.values()) / sum(windows.values())
    for g, x in got.items():
        assert x["normalized_coverage"] == pytest.approx(starts[g] / windows[g] / mean)
        assert x["error_bar_width"] == pytest.approx(np.sqrt(starts[g]) / windows[g] / mean)
