"""Sources as DataFrames. Headers and parameters are read on the driver; records stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusmill.functions.fields import annotations, format_map, info_map


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place in the file: ``file, at, line``; also from .gz."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "\r$", "").alias("line"))


def tabular(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """A table with a header row, tab or comma as its first line says, all columns text."""
    head = spark.read.text(path).where("trim(value) <> '' and not startswith(value, '##')").first()
    sep = "\t" if head is None or "\t" in head[0] else ","
    return spark.read.csv(path, sep=sep, header=True, encoding=encoding, quote="" if sep == "\t" else '"')


def column_of(df: DataFrame, names: list[str]) -> str | None:
    """The first column whose name, without case and signs, is one of ``names``. (P25)"""
    plain = lambda s: "".join(c for c in s.lower() if c.isalnum())
    have = {plain(c): c for c in reversed(df.columns)}
    return next((have[plain(n)] for n in names if plain(n) in have), None)


def aliased(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns by their aliases; "" where there is none, or no value."""
    pick = lambda c: F.lit("") if c is None else F.coalesce(F.col(f"`{c}`"), F.lit(""))
    return df.select(*[pick(column_of(df, [k, *names])).alias(k) for k, names in aliases.items()])


class VariantFile:
    """A VCF: header on the driver, records as a DataFrame."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        lines = _lines(spark, path)
        self.header = [r["line"] for r in lines.where(F.col("line").startswith("#")).orderBy("at").select("line").collect()]
        names = next((h for h in self.header if h.startswith("#CHROM")), "#CHROM")
        self.samples = names.split("\t")[9:]
        said = [h for h in self.header if h.startswith("##INFO=<ID=CSQ,")]
        self.annotation_fields = said[0].split("Format: ")[1].split('"')[0].strip().split("|") if said else None
        self._lines = lines.where((F.col("line") != "") & ~F.col("line").startswith("#"))

    def sample(self, name: str) -> int:
        if name not in self.samples:
            raise ValueError(f"no sample {name!r}; there are {', '.join(self.samples)}")
        return self.samples.index(name)

    def pair(self, tumor: str | None = None, normal: str | None = None) -> tuple[str, str | None]:
        """Names of tumor and normal: the first and the second sample where none is given. (S3)"""
        if not self.samples:
            raise ValueError("the file has no samples")
        own, other = tumor or self.samples[0], normal or (self.samples[1] if len(self.samples) > 1 else None)
        for name in filter(None, (own, other)):
            self.sample(name)
        return own, other

    def records(self, least_fields: int = 8) -> DataFrame:
        """``at, raw_line, chrom, pos, id, ref, alts, qual, filter, info, format, sample_values``; shorter lines go."""
        f = F.split("line", "\t", -1)
        rows = self._lines.where(F.size(f) >= least_fields)
        get = lambda i: F.get(f, F.lit(i))
        return rows.select("at", F.col("line").alias("raw_line"), get(0).alias("chrom"), get(1).try_cast("long").alias("pos"), get(2).alias("id"), get(3).alias("ref"), F.split(get(4), ",").alias("alts"), get(5).alias("qual"), get(6).alias("filter"), info_map(get(7)).alias("info"), get(8).alias("format"), F.slice(f, 10, 1 << 20).alias("sample_values"))

    def alleles(self, tumor: str | None = None, normal: str | None = None, least_fields: int = 8) -> DataFrame:
        """One row per ALT with ``i``, ``tumor`` and ``normal`` maps (null without a sample) and ``csq`` entries."""
        named = self.annotation_fields
        if named is None:
            if not self.records(least_fields).isEmpty():
                raise ValueError("the header has no CSQ format")
            named = ["Allele"]  # no record, nothing to annotate
        fields = lambda name: F.lit(None).cast("map<string,string>") if not name else format_map(F.col("format"), F.get("sample_values", F.lit(self.sample(name))))
        rows = self.records(least_fields).withColumns({"tumor": fields(tumor), "normal": fields(normal), "csq": annotations(F.element_at("info", "CSQ"), named)})
        return rows.select("*", F.posexplode("alts").alias("i", "alt"))


def filter_options(header: list[str], tool: str, options: list[str]) -> dict[str, str | None]:
    """Options of a tool's command line in VCF metadata; a flag alone is "true"."""
    import shlex

    line = next((h for h in header if h.startswith("##") and f"ID={tool}," in h and "CommandLine=" in h), "")
    words = shlex.split(line.split('CommandLine="', 1)[1].rsplit('"', 1)[0].split('",')[0]) if 'CommandLine="' in line else []
    out: dict[str, str | None] = {}
    for o in options:
        if o in words:
            after = words[words.index(o) + 1 : words.index(o) + 2]
            out[o] = after[0] if after and not after[0].startswith("--") else "true"
        else:
            out[o] = None
    return out


def bed(spark: SparkSession, path: str, strict: bool = False, chr_prefix: bool = False, ordered: bool = False) -> DataFrame:
    """``chrom, start, end``: comments and empty intervals go.

    ``strict`` raises on a line of fewer than three columns, else such lines go; ``chr_prefix`` adds chr where it lacks; ``ordered``
    sorts by contig and place.
    """
    from locusmill.functions.biology import with_chr

    lines = _lines(spark, path).where((F.trim("line") != "") & ~F.col("line").rlike("^(#|track|browser)"))
    f = F.split("line", "\t")
    if strict:
        lines = lines.where(F.when(F.size(f) < 3, F.raise_error(F.lit("a BED line has fewer than three columns"))).otherwise(F.lit(True)))
    chrom = F.get(f, F.lit(0))
    out = lines.select((with_chr(chrom) if chr_prefix else chrom).alias("chrom"), F.get(f, F.lit(1)).try_cast("long").alias("start"), F.get(f, F.lit(2)).try_cast("long").alias("end"))
    out = out.where("start is not null and end is not null and end > start")
    return out.orderBy("chrom", "start", "end") if ordered else out


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """``ord, name, sequence`` with sequences in upper case without line ends and ``*``."""
    rows = spark.read.text(path, lineSep=">").where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("ord"), "value")
    return rows.select("ord", F.trim(F.substring_index("value", "\n", 1)).alias("name"), F.upper(F.regexp_replace(F.expr("substring(value, instr(value, '\n') + 1)"), r"[\s*]", "")).alias("sequence"))


def protein_aliases(proteins: DataFrame) -> DataFrame:
    """``alias, sequence``: full name, its words, parts and versions without suffix; the first in the file counts."""
    parts = F.filter(F.split("name", r"[|\s]+"), lambda p: p != "")
    names = F.array_distinct(F.concat(F.array("name"), parts, F.transform(parts, lambda p: F.regexp_replace(p, r"\.\d+$", ""))))
    rows = proteins.select("ord", "sequence", F.explode(names).alias("alias"))
    return rows.groupBy("alias").agg(F.min_by("sequence", "ord").alias("sequence"))


def genome_chunks(sequences: DataFrame, chunk: int = 10_000) -> DataFrame:
    """``chrom, chunk, bases`` for lookups of bases by an equi join."""
    n = F.floor((F.length("sequence") - 1) / chunk).cast("int")
    rows = sequences.where("sequence <> ''").select(F.substring_index("name", " ", 1).alias("chrom"), "sequence", F.explode(F.sequence(F.lit(0), n)).alias("chunk"))
    return rows.select("chrom", F.col("chunk").cast("long").alias("chunk"), F.substring("sequence", F.col("chunk") * chunk + 1, F.lit(chunk)).alias("bases"))


def with_base(rows: DataFrame, chunks: DataFrame, chrom: str, pos: str, name: str = "base", chunk: int = 10_000) -> DataFrame:
    """``rows`` with the base at a 1-based place, with or without chr; "" beyond the sequence."""
    plain = lambda c: F.regexp_replace(c, "^chr", "")
    side = chunks.select(plain(F.col("chrom")).alias("_c"), F.col("chunk").alias("_k"), "bases")
    at = F.col(pos) - 1
    out = rows.join(side, (plain(F.col(chrom)) == F.col("_c")) & (F.floor(at / chunk).cast("long") == F.col("_k")), "left")
    return out.withColumn(name, F.coalesce(F.substring("bases", (F.pmod(at, F.lit(chunk)) + 1).cast("int"), F.lit(1)), F.lit(""))).drop("_c", "_k", "bases")


def gtf(spark: SparkSession, path: str, genes: list[str] | None = None) -> DataFrame:
    """Transcripts: ``gene, transcript, version, chrom, strand, tags, cds`` (1-based closed, in file order)."""
    lines = _lines(spark, path).where(~F.col("line").startswith("#"))
    if genes:
        lines = lines.where(F.regexp_extract("line", r'gene_name "([^"]*)"', 1).isin(genes))
    f = F.split("line", "\t")
    get = lambda i: F.get(f, F.lit(i))
    attribute = lambda k: F.regexp_extract(get(8), rf'(?:^|[; ]){k} "([^"]*)"', 1)
    tags = F.regexp_extract_all(get(8), F.lit(r'tag "([^"]*)"'), F.lit(1))
    kind = F.concat(F.array(F.concat(F.lit("type:"), F.coalesce(F.nullif(attribute("transcript_type"), F.lit("")), attribute("transcript_biotype")))), tags)
    rows = lines.where((F.size(f) >= 9) & get(2).isin("transcript", "CDS")).select("at", attribute("gene_name").alias("gene"), attribute("transcript_id").alias("transcript"), attribute("transcript_version").alias("version"), get(0).alias("chrom"), F.when(get(6) == "-", -1).otherwise(1).alias("strand"), get(2).alias("feature"), get(3).try_cast("long").alias("start"), get(4).try_cast("long").alias("end"), kind.alias("tags"))
    cds = F.collect_list(F.when(F.col("feature") == "CDS", F.struct("at", "start", "end")))
    grouped = rows.groupBy("gene", "transcript").agg(F.min("at").alias("ord"), F.min_by("chrom", "at").alias("chrom"), F.min_by("strand", "at").alias("strand"), F.coalesce(F.min_by(F.nullif("version", F.lit("")), F.when(F.col("version") != "", F.col("at"))), F.lit("")).alias("version"), F.array_distinct(F.flatten(F.collect_list("tags"))).alias("tags"), F.array_sort(cds).alias("cds"))
    return grouped.withColumn("cds", F.transform("cds", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))))


def read_groups(header: list[str]) -> dict[str, str]:
    """Library by read group, from a header's @RG lines; a group that names none is its own."""
    out = {}
    for line in header:
        if line.startswith("@RG\t"):
            said = dict(f.split(":", 1) for f in line.split("\t")[1:] if ":" in f)
            out[said.get("ID", "")] = said.get("LB", said.get("ID", ""))
    return out


def sam(spark: SparkSession, path: str, primary: bool = True) -> DataFrame:
    """Alignments of a SAM text; ``primary``: flags 0x4, 0x100, 0x200 and 0x800 go."""
    lines = _lines(spark, path)
    libraries = read_groups([r["line"] for r in lines.where(F.col("line").startswith("@RG\t")).select("line").collect()])
    f = F.split("line", "\t")
    get = lambda i: F.get(f, F.lit(i))
    group = F.regexp_extract("line", r"\tRG:Z:([^\t]*)", 1)
    library = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in libraries.items() for x in pair]), group), F.lit("")) if libraries else F.lit("")
    mate = F.when(get(6) == "=", get(2)).otherwise(get(6))
    rows = lines.where(~F.col("line").startswith("@") & (F.size(f) >= 11)).select("at", get(0).alias("qname"), get(1).try_cast("long").alias("flag"), get(2).alias("chrom"), get(3).try_cast("long").alias("start"), get(4).try_cast("int").alias("mapq"), get(5).alias("cigar"), mate.alias("next_chrom"), get(7).try_cast("long").alias("next_start"), get(8).try_cast("long").alias("insert_size"), get(9).alias("seq"), get(10).alias("quality"), group.alias("read_group"), library.alias("library"))
    return rows.where(F.col("flag").bitwiseAND(F.lit(0xB04)) == 0) if primary else rows


def text_metrics(spark: SparkSession, paths: list[str], most_bytes: int = 20 << 20) -> DataFrame:
    """Lines of several files in order of their names; large files go."""
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), "value").where(F.col("size") < most_bytes)
    return rows.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("at"))).select("file", "line", "value")


def metric_files(spark: SparkSession, folder: str, stem: str, most_bytes: int = 20 << 20) -> DataFrame:
    """``text_metrics`` of a folder's files whose names begin with ``stem``, without the tables that ``msi_call``'s results are written to."""
    own = [f"{stem}_call.tsv", f"{stem}_call_summary.txt", f"{stem}_summary.txt"]
    rows = spark.read.option("pathGlobFilter", f"{stem}*").text(folder)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), "value")
    rows = rows.where((F.col("size") < most_bytes) & ~F.col("name").isin(own))
    return rows.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("at"))).select("file", "line", "value")


def metrics_table(lines: DataFrame) -> DataFrame:
    """``row, name, value`` of metric files (file, line, value): the first line that is no comment names the columns, rows follow up to a blank line."""
    by = Window.partitionBy("file").orderBy("line")
    rows = lines.where(~F.col("value").startswith("#")).withColumn("blank", F.trim("value") == "")
    rows = rows.withColumn("seen", F.sum(F.when(F.col("blank"), 0).otherwise(1)).over(by)).where("seen > 0")
    rows = rows.withColumn("over", F.sum(F.when(F.col("blank"), 1).otherwise(0)).over(by)).where("over = 0")
    cells = F.split("value", "\t", -1)
    head = rows.where("seen = 1").select(F.col("file").alias("_f"), cells.alias("names"))
    told = rows.where("seen > 1").join(head, F.col("file") == F.col("_f")).select("file", (F.col("seen") - 1).alias("row"), F.posexplode("names").alias("i", "name"), cells.alias("cells"))
    return told.select("file", "row", "name", F.coalesce(F.get("cells", F.col("i")), F.lit("")).alias("value"))


def depth_summary(lines: DataFrame) -> DataFrame:
    """``chrom, length, bases, mean, min, max`` of a depth summary's lines."""
    f = F.split(F.trim("value"), r"\s+")
    get = lambda i, kind: F.get(f, F.lit(i)).try_cast(kind)
    rows = lines.where((F.size(f) >= 4) & (F.get(f, F.lit(0)) != "chrom"))
    return rows.select(F.get(f, F.lit(0)).alias("chrom"), get(1, "long").alias("length"), get(2, "long").alias("bases"), get(3, "double").alias("mean"), get(4, "long").alias("min"), get(5, "long").alias("max"))


def contamination(lines: DataFrame) -> DataFrame:
    """``file, contamination``: the second field of the first line that is neither comment nor header."""
    f = F.split("value", "\t", -1)
    rows = lines.where(~F.col("value").startswith("#") & (F.size(f) >= 2) & (F.get(f, F.lit(0)) != "sample"))
    return rows.groupBy("file").agg(F.min_by(F.get(f, F.lit(1)), "line").alias("contamination"))


def flagstat_rates(lines: DataFrame) -> DataFrame:
    """``file, mapped_rate, proper_rate`` of flagstat texts, NA where a line is missing."""
    share = F.trim(F.substring_index(F.substring_index(F.substring_index("value", "(", 2), "(", -1), ":", 1))
    mapped = F.col("value").contains(" mapped (") & ~F.col("value").contains("primary")
    proper = F.col("value").contains(" properly paired ")
    last = lambda c: F.coalesce(F.max_by(F.when(c, share), F.when(c, F.col("line"))), F.lit("NA"))
    return lines.groupBy("file").agg(last(mapped).alias("mapped_rate"), last(proper).alias("proper_rate"))


def flagstat(lines: DataFrame) -> DataFrame:
    """Counts and names of a flagstat text's lines."""
    return lines.select(F.regexp_extract("value", r"^(\d+) \+ (\d+) (.*?)(?: \(.*)?$", 1).try_cast("long").alias("passed"), F.regexp_extract("value", r"^(\d+) \+ (\d+) (.*?)(?: \(.*)?$", 3).alias("metric")).where("passed is not null")


def json_document(spark: SparkSession, path: str) -> DataFrame:
    """(S16)"""
    return spark.read.json(path, multiLine=True)


def fastq_pairs(paths: list[str]) -> list[tuple[str, str, str]]:
    """(sample, R1, R2) of files whose mate is there too."""
    import re

    have = set(paths)
    out = []
    for p in sorted(paths):
        if m := re.search(r"^(.*?)([._]R?)1((?:_001)?\.f(?:ast)?q(?:\.gz)?)$", p):
            mate = f"{m[1]}{m[2]}2{m[3]}"
            if mate in have:
                out.append((m[1].rsplit("/", 1)[-1], p, mate))
    return out


def shared_contigs(wanted: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """``chrom, contig``: the name as it is, without chr or with it, that both headers have."""
    c = F.col("chrom")
    names = F.array(c, F.regexp_replace(c, "^chr", ""), F.concat(F.lit("chr"), F.regexp_replace(c, "^chr", "")))
    tried = wanted.select("chrom", F.posexplode(names).alias("rank", "contig"))
    both = tried.join(first.select("contig").intersect(second.select("contig")), "contig", "left_semi")
    return both.groupBy("chrom").agg(F.min_by("contig", "rank").alias("contig"))


