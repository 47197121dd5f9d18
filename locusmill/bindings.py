"""Queries that apply the library's operators to the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusmill.functions import biology as bio
from locusmill.functions import fields
from locusmill.operators import intervals as iv
from locusmill.operators import ranges as rg
from locusmill.operators import relational as rel
from locusmill.operators import sweep
from locusmill.plans import alignment_quality as quality
from locusmill.plans import duplicates as dup
from locusmill.shared import shared_path

#: Known k-mers that are sent to every task, some 50 MB; more are joined by a shuffle.
MOST_KNOWN = 500_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str):
    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[build.__name__], ORACLE[build.__name__] = run, sql
        return build

    return add


count = lambda: F.count(F.lit(1)).cast("long")
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
_AUDIT = "CASE WHEN l_quantity >= 10 THEN NULL ELSE 'quantity' END, CASE WHEN l_discount <= 0.05 THEN NULL ELSE 'discount' END, CASE WHEN l_tax <= 0.04 THEN NULL ELSE 'tax' END"
_OK = "l_quantity >= 10 AND l_discount <= 0.05 AND l_tax <= 0.04"


def _audited(t: Tables) -> DataFrame:
    return rel.audit(t.lineitem, [("quantity", F.col("l_quantity") >= 10), ("discount", F.col("l_discount") <= 0.05), ("tax", F.col("l_tax") <= 0.04)])


@query(f"SELECT {', '.join(LINE)}, l_quantity >= 10 AS pass_quantity, l_discount <= 0.05 AS pass_discount, l_tax <= 0.04 AS pass_tax, {_OK} AS overall_pass, concat_ws(';', {_AUDIT}) AS failure_reasons FROM lineitem")
def threshold_audit(t):
    return _audited(t).select(*LINE, "pass_quantity", "pass_discount", "pass_tax", "overall_pass", "failure_reasons")


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([{_AUDIT}], lambda x: x IS NOT NULL)) AS reason FROM lineitem) GROUP BY reason")
def reason_histogram(t):
    return rel.tag_histogram(_audited(t).where("not overall_pass"), F.split("failure_reasons", ";"), "reason")


@query(f"SELECT l_returnflag, count(*) AS accepted, round(count(*) / ((SELECT sum(p_size) FROM part) / 1000.0), 6) AS per_unit FROM lineitem WHERE {_OK} GROUP BY l_returnflag")
def burden_per_unit(t):
    size = t.part.agg(F.sum("p_size").alias("size"))
    n = _audited(t).where("overall_pass").groupBy("l_returnflag").agg(count().alias("accepted"))
    return n.crossJoin(F.broadcast(size)).select("l_returnflag", "accepted", F.round(F.col("accepted") / (F.col("size") / 1000.0), 6).alias("per_unit"))


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def best_annotation(t):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return rel.best(t.orders, ["o_custkey"], [rank, F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("""WITH d AS (SELECT DISTINCT l_suppkey, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS s, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + 3 AS e FROM lineitem),
r AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM d),
i AS (SELECT *, sum(CASE WHEN reach >= s THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY s, e) AS island FROM r),
m AS (SELECT l_suppkey, min(s) AS s, max(e) AS e FROM i GROUP BY l_suppkey, island)
SELECT l_suppkey, count(*) AS islands, CAST(sum(e - s) AS BIGINT) AS days FROM m GROUP BY l_suppkey""")
def interval_merge(t):
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    merged = iv.merge(t.lineitem.select("l_suppkey", day.alias("start"), (day + 3).alias("end")), ["l_suppkey"])
    return merged.groupBy("l_suppkey").agg(count().alias("islands"), iv.covered(merged).cast("long").alias("days"))


@query(f"SELECT {', '.join(LINE)}, l_quantity FROM lineitem WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND l_quantity - 1 >= p_size AND l_quantity - 1 < p_size + 5)")
def interval_semi_keyed(t):
    sides = t.part.select("p_partkey", F.col("p_size").alias("start"), (F.col("p_size") + 5).alias("end"))
    return iv.contained(t.lineitem.select(*LINE, "l_quantity"), sides, F.col("l_quantity") - 1, {"l_partkey": "p_partkey"}, 5.0)


def _decades(t: Tables) -> DataFrame:
    return t.nation.select((F.col("n_nationkey") * 10).alias("start"), (F.col("n_nationkey") * 10 + 4).alias("end"))


@query("SELECT event_id, value FROM events e WHERE EXISTS (SELECT 1 FROM nation WHERE e.value >= n_nationkey * 10 AND e.value < n_nationkey * 10 + 4)")
def interval_semi_pure(t):
    return iv.contained(t.events.select("event_id", "value"), _decades(t), F.col("value"), {}, 4.0)


@query("SELECT event_id, min(CASE WHEN value >= n * 10 AND value < n * 10 + 4 THEN 0.0 ELSE least(abs(value - (n * 10 + 4)), abs(n * 10 - value)) END) AS distance, bool_or(value >= n * 10 AND value < n * 10 + 4) AS inside FROM events, (SELECT n_nationkey AS n FROM nation) GROUP BY event_id")
def nearest_interval(t):
    out = iv.nearest(t.events.select("event_id", "value"), _decades(t), F.col("value"), F.col("value"), {}, 10.0)
    inside = F.col("inside")
    return out.select("event_id", "distance", inside.alias("inside"))


@query("""WITH f AS (SELECT s_nationkey AS n, floor(s_acctbal / 1000) AS band, min(s_suppkey) AS k, count(*) AS m FROM supplier GROUP BY 1, 2),
g AS (SELECT s_nationkey AS n, min(s_suppkey) AS k, count(*) AS m FROM supplier GROUP BY 1)
SELECT c_custkey, CASE WHEN f.m IS NOT NULL THEN 'nation_band' WHEN g.m IS NOT NULL THEN 'nation' ELSE 'none' END AS match_level, coalesce(f.k, g.k) AS match_key, coalesce(f.m, g.m, 0) AS n_candidates
FROM customer LEFT JOIN f ON c_nationkey = f.n AND floor(c_acctbal / 1000) = band LEFT JOIN g ON c_nationkey = g.n""")
def precedence_match(t):
    band = lambda c: F.floor(F.col(c) / 1000)
    levels = [("nation_band", [F.col("c_nationkey"), band("c_acctbal")], [F.col("s_nationkey"), band("s_acctbal")]), ("nation", [F.col("c_nationkey")], [F.col("s_nationkey")])]
    return rel.precedence_match(t.customer, t.supplier, levels, F.col("s_suppkey")).select("c_custkey", "match_level", "match_key", "n_candidates")


@query("""WITH c AS (SELECT c_nationkey, floor(c_acctbal / 1000) AS band, count(*) AS n, min(c_custkey) AS k, min(c_acctbal) AS v FROM customer GROUP BY 1, 2)
SELECT s_suppkey, k AS match_key FROM supplier JOIN c ON s_nationkey = c_nationkey AND floor(s_acctbal / 1000) = band WHERE n = 1 AND abs(s_acctbal - v) <= 500""")
def unique_band_match(t):
    key = lambda n, v: F.struct(F.col(n), F.floor(F.col(v) / 1000))
    out = rel.unique_band_match(t.supplier, t.customer, key("s_nationkey", "s_acctbal"), key("c_nationkey", "c_acctbal"), F.col("s_acctbal"), F.col("c_acctbal"), 500, F.col("c_custkey"))
    return out.select("s_suppkey", "match_key")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)")
def anti_only_ours(t):
    return rel.only_left(t.customer, t.events, "c_custkey", "user_id").select("c_custkey", "c_name")


@query("SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, min(event_type) AS event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 1")
def consensus(t):
    return rel.consensus(t.events.withColumn("day", F.col("ts").cast("date").cast("string")), ["user_id", "day"], "event_type")


@query("SELECT user_id, event_id, k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k <= 5")
def cap_per_start(t):
    order = [F.col("ts"), F.col("event_id")]
    out = rel.best(t.events, ["user_id"], order, 5)
    return out.select("user_id", "event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)).cast("long").alias("k"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value >= 50) AS n_high, count(DISTINCT user_id) AS users, round(avg(value), 4) AS mean_value, round(median(value), 4) AS median_value FROM events GROUP BY event_type")
def evidence_summary(t):
    return t.events.groupBy("event_type").agg(count().alias("n"), F.count_if(F.col("value") >= 50).cast("long").alias("n_high"), F.countDistinct("user_id").alias("users"), F.round(F.avg("value"), 4).alias("mean_value"), F.round(F.median("value"), 4).alias("median_value"))


_RATIO = "p_retailprice / (SELECT sum(p_retailprice * p_size) / sum(p_size) FROM part)"


@query(f"SELECT p_partkey, round({_RATIO}, 6) AS ratio, round(log2({_RATIO}), 6) AS log2_ratio, CASE WHEN {_RATIO} < 0.75 THEN 'LOW' WHEN {_RATIO} > 1.25 THEN 'HIGH' ELSE 'OK' END AS qc_flag FROM part")
def depth_ratio(t):
    out = rel.depth_ratio(t.part, "p_retailprice", "p_size")
    return out.select("p_partkey", F.round("ratio", 6).alias("ratio"), F.round("log2_ratio", 6).alias("log2_ratio"), "qc_flag")


@query(f"SELECT {', '.join(LINE)}, coalesce(sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position FROM lineitem")
def cumulative_position(t):
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return rel.running_before(t.lineitem, ["l_orderkey"], order, "l_quantity", "position").select(*LINE, "position")


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 8")
def filter_histogram(t):
    return rel.tag_histogram(t.part, F.array("p_type"), "p_type", 8)


@query("SELECT p_partkey, n_nationkey, CAST((p_size * 37 + n_nationkey * 11) % 101 AS BIGINT) AS score, CASE WHEN (p_size * 37 + n_nationkey * 11) % 101 <= 50 THEN 'yes' ELSE 'no' END AS binder FROM part, nation")
def cross_score(t):
    pairs = t.part.select("p_partkey", "p_size").crossJoin(F.broadcast(t.nation.select("n_nationkey")))  # a fixed list of 25
    score = ((F.col("p_size") * 37 + F.col("n_nationkey") * 11) % 101).cast("long")
    return pairs.select("p_partkey", "n_nationkey", score.alias("score"), F.when(score <= 50, "yes").otherwise("no").alias("binder"))


@query(f"SELECT count(*) AS raw, count(*) FILTER (l_quantity >= 10) AS pass, count(*) FILTER ({_OK}) AS manual FROM lineitem")
def funnel(t):
    a = _audited(t)
    return a.agg(count().alias("raw"), F.count_if("pass_quantity").cast("long").alias("pass"), F.count_if("overall_pass").cast("long").alias("manual"))


@query("SELECT event_type, CAST(floor(value) AS BIGINT) AS level, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, floor(value) ORDER BY event_id) AS k FROM events) WHERE k = 1")
def first_seen(t):
    rows = t.events.withColumn("level", F.floor("value").cast("long"))
    return rel.best(rows, ["event_type", "level"], [F.col("event_id")]).select("event_type", "level", "event_id")


@query("SELECT CASE WHEN value IS NULL THEN 'NOT_DETERMINED' WHEN value >= 20 THEN 'MSI-H' WHEN value >= 3 THEN 'MSI-L' ELSE 'MSS' END AS status, count(*) AS n FROM events GROUP BY 1")
def score_class(t):
    return t.events.groupBy(bio.msi_class(F.col("value")).alias("status")).agg(count().alias("n"))


@query("SELECT event_id, CASE WHEN event_id & 64 <> 0 THEN CASE WHEN event_id & 16 = 0 THEN 'F1R2' ELSE 'F2R1' END WHEN event_id & 128 <> 0 THEN CASE WHEN event_id & 16 = 0 THEN 'F2R1' ELSE 'F1R2' END ELSE 'unpaired' END AS orientation FROM events")
def flag_orientation(t):
    return t.events.select("event_id", bio.orientation(F.col("event_id")).alias("orientation"))


@query(f"SELECT {', '.join(LINE)}, CASE WHEN {_OK} THEN 'accepted' ELSE 'rejected' END AS status FROM lineitem")
def split_union(t):
    a = _audited(t)
    part = lambda ok, name: a.where(ok).select(*LINE, F.lit(name).alias("status"))
    return part("overall_pass", "accepted").unionByName(part("not overall_pass", "rejected"))


@query("""WITH k AS (SELECT DISTINCT text[i : i + 8] AS kmer FROM benchmark, range(1, length(text) - 7) t(i)),
d AS (SELECT doc_id, text[i : i + 8] AS kmer FROM documents, range(1, length(text) - 7) t(i))
SELECT doc_id, count(DISTINCT kmer) AS n_novel FROM d WHERE kmer NOT IN (SELECT kmer FROM k) GROUP BY doc_id""")
def novel_kmers(t):
    known = t.benchmark.select(F.explode(F.array_distinct(rel.kmers(F.col("text"), 9))).alias("kmer")).distinct()
    known = F.broadcast(known) if known.count() <= MOST_KNOWN else known
    own = t.documents.select("doc_id", F.explode(F.array_distinct(rel.kmers(F.col("text"), 9))).alias("kmer")).join(known, "kmer", "left_anti")
    # K-mers are distinct within a row, so only ids that several rows hold are made distinct by a shuffle.
    several = t.documents.groupBy("doc_id").agg(count().alias("rows")).where("rows > 1").select(F.col("doc_id").alias("several"))
    again = F.col("doc_id").eqNullSafe(F.col("several"))
    rows = own.join(several, again, "left_anti").unionByName(own.join(several, again, "left_semi").distinct())
    return rows.groupBy("doc_id").agg(count().alias("n_novel"))


@query("SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS weighted_price FROM lineitem GROUP BY l_returnflag")
def weighted_mean(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_quantity")) / F.sum("l_quantity"), 4).alias("weighted_price"))


@query("SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY event_type")
def json_metric(t):
    return t.events.groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").try_cast("long")).alias("k_sum"))


@query("SELECT page_id, regexp_replace(lower(url), '^[a-z]+://', '') AS plain, regexp_extract(lower(url), '^[a-z]+://([^/]+)', 1) AS host FROM pages")
def url_normalise(t):
    url = F.lower("url")
    return t.pages.select("page_id", F.regexp_replace(url, "^[a-z]+://", "").alias("plain"), F.regexp_extract(url, "^[a-z]+://([^/]+)", 1).alias("host"))


@query("SELECT s_suppkey, coalesce(n_name, 'no_entry') AS entry FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <= 1) ON s_nationkey = n_nationkey")
def knowledge_join(t):
    base = t.nation.where("n_regionkey <= 1").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return rel.with_default(t.supplier, base, ["s_nationkey"], "n_name", "no_entry", "entry").select("s_suppkey", "entry")


@query(f"SELECT unnest(['input', 'passed', 'failed']) AS metric, unnest([count(*), count(*) FILTER ({_OK}), count(*) FILTER (NOT ({_OK}))]) AS value FROM lineitem")
def summary_unpivot(t):
    row = _audited(t).agg(count().alias("input"), F.count_if("overall_pass").cast("long").alias("passed"), F.count_if(~F.col("overall_pass")).cast("long").alias("failed"))
    return rel.unpivot(row)


@query("SELECT conv_id, turn, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS next_role FROM conversations")
def adjacent_pair(t):
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return t.conversations.select("conv_id", "turn", "role", F.lead("role").over(by).alias("next_role"))


@query("SELECT role, first(text ORDER BY conv_id, turn, text) AS text FROM conversations GROUP BY role")
def first_write_wins(t):
    return t.conversations.groupBy("role").agg(F.min_by("text", F.struct("conv_id", "turn", "text")).alias("text"))


@query("SELECT p_partkey, translate(reverse(upper(p_name)), 'ACGT', 'TGCA') AS rc FROM part")
def reverse_complement(t):
    return t.part.select("p_partkey", bio.reverse_complement(F.col("p_name")).alias("rc"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN coalesce(c_mktsegment, '') ELSE '' END AS segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def conditional_update(t):
    rows = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", F.coalesce("c_mktsegment", F.lit(""))).otherwise("").alias("segment"))


@query(f"SELECT l_partkey FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE {_OK} EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def set_algebra(t):
    a = _audited(t)
    key = lambda ok: a.where(ok).select("l_partkey")
    return key("l_returnflag = 'R'").intersect(key("overall_pass")).subtract(key("l_quantity >= 49"))


@query("SELECT p_brand, count(DISTINCT p_type) AS n_types, min(p_type) AS first_type, max(p_type) AS last_type, string_agg(DISTINCT p_type, '&' ORDER BY p_type) AS types FROM part GROUP BY p_brand")
def gene_multimap(t):
    types = F.array_sort(F.collect_set("p_type"))
    return t.part.groupBy("p_brand").agg(F.size(types).cast("long").alias("n_types"), F.min("p_type").alias("first_type"), F.max("p_type").alias("last_type"), F.array_join(types, "&").alias("types"))


@query("SELECT p_partkey, CAST(length(p_name) - length(p_brand) AS BIGINT) AS gap, CAST((SELECT count(*) FROM range(1, least(length(p_name), length(p_type)) + 1) t(i) WHERE left(p_name, i) = left(p_type, i)) AS BIGINT) AS common FROM part")
def common_prefix(t):
    return t.part.select("p_partkey", (F.length("p_name") - F.length("p_brand")).cast("long").alias("gap"), fields.common_prefix(F.col("p_name"), F.col("p_type")).cast("long").alias("common"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS parsed FROM events")
def lenient_number(t):
    text = F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, "NA").otherwise("1.0d")).otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", fields.number(text).alias("parsed"))


@query("SELECT s_suppkey, s_nationkey FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT s_suppkey, s_nationkey FROM supplier WHERE s_acctbal >= 5000")
def union_all(t):
    s = t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    return s.where("s_acctbal < 0").unionByName(s.where("s_acctbal >= 5000")).select("s_suppkey", "s_nationkey")


@query("SELECT doc_id, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(coalesce(text, ''), ' '), lambda w: CAST(length(w) AS BIGINT))), lambda a, n: (a * 31 + n) % 1000003) AS walked FROM documents")
def fold_positions(t):
    words = F.split(F.coalesce("text", F.lit("")), " ", -1)
    return t.documents.select("doc_id", F.aggregate(words, F.lit(0).cast("long"), lambda a, w: (a * 31 + F.length(w)) % 1000003).alias("walked"))


_DAYS = "SELECT l_returnflag AS chrom, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS s, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) AS e FROM lineitem"
_COVERED = f"SELECT chrom, pos, count(*) AS depth FROM (SELECT chrom, unnest(generate_series(s, e - 1)) AS pos FROM ({_DAYS})) GROUP BY chrom, pos"


def _line_days(t: Tables) -> DataFrame:
    start = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return t.lineitem.select(F.col("l_returnflag").alias("chrom"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"))


@query(f"""SELECT chrom, min(pos) AS start, max(pos) + 1 AS "end", depth FROM (
SELECT *, pos - row_number() OVER (PARTITION BY chrom, depth ORDER BY pos) AS island FROM ({_COVERED})) GROUP BY chrom, depth, island""")
def depth_segments(t):
    return sweep.depth_segments(_line_days(t), ["chrom"], width=64)


@query(f"""WITH c AS ({_COVERED}), r AS (SELECT p_partkey, ['A', 'N', 'R'][p_partkey % 3 + 1] AS chrom, 9000 + p_partkey * 7 % 2800 AS s, 9000 + p_partkey * 7 % 2800 + p_size AS e FROM part)
SELECT p_partkey, CAST(e - s AS BIGINT) AS bases, count(pos) AS covered, CAST(coalesce(sum(depth), 0) AS BIGINT) AS depth_sum, round(coalesce(sum(depth), 0) / (e - s), 6) AS mean_depth,
round(count(pos) FILTER (depth >= 10) / (e - s), 6) AS share_10, round(count(pos) FILTER (depth >= 100) / (e - s), 6) AS share_100, round(count(pos) FILTER (depth >= 250) / (e - s), 6) AS share_250
FROM r LEFT JOIN c ON c.chrom = r.chrom AND pos >= s AND pos < e GROUP BY p_partkey, s, e""")
def region_depth(t):
    start = F.lit(9000) + F.col("p_partkey") * 7 % 2800
    regions = t.part.select("p_partkey", F.element_at(F.array(*map(F.lit, "ANR")), (F.col("p_partkey") % 3 + 1).cast("int")).alias("chrom"), start.alias("start"), (start + F.col("p_size")).alias("end"))
    out = sweep.depth_over(sweep.depth_segments(_line_days(t), ["chrom"], width=64), regions, ["chrom"], [10, 100, 250], width=64)
    return out.select("p_partkey", "bases", "covered", "depth_sum", *[F.round(c, 6).alias(c) for c in ("mean_depth", "share_10", "share_100", "share_250")])


_CONTIGS = ["view", "click", "error"]
_RANK = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 ELSE 4 END"


def _sorted_events(t: Tables) -> str:
    path = shared_path(t.spark, "events-in-order")
    rows = t.events.select(rg.contig_rank(F.col("event_type"), _CONTIGS).alias("contig"), F.floor("value").cast("long").alias("pos"), "event_id")
    rg.write_sorted(rows, path, ["contig", "pos"])
    return path


@query(f"SELECT event_id, {_RANK} AS contig, CAST(floor(value) AS BIGINT) AS pos, row_number() OVER (ORDER BY {_RANK}, floor(value), event_id) AS place FROM events")
def coordinate_order(t):
    return rg.read_sorted(t.spark, _sorted_events(t)).select("event_id", "contig", "pos", "place")


@query(f"SELECT event_id, CAST(floor(value) AS BIGINT) AS pos FROM events WHERE {_RANK} = 2 AND floor(value) BETWEEN 5 AND 20")
def range_scan(t):
    return rg.read_between(t.spark, _sorted_events(t), {"contig": 2, "pos": 5}, {"contig": 2, "pos": 20}).select("event_id", "pos")


@query("SELECT user_id, event_id, row_number() OVER (ORDER BY user_id, ts, event_id) AS place FROM events")
def name_order(t):
    return rg.placed(t.events.select("user_id", "event_id", "ts"), [F.col(c) for c in ("user_id", "ts", "event_id")]).select("user_id", "event_id", "place")


_CIGARS = ["50M", "5S45M", "40M10S", "3H47M2S"]
#: Alignments made of events: neighbours by id are mates, but for every fifth two.
_READS = """SELECT event_id AS id, event_id // 2 AS name, event_id // 2 % 5 = 0 AS alone, user_id % 3 AS chrom, event_type = 'click' AS back, event_id // 2 % 2 AS library,
1000 + CAST(floor(value) AS BIGINT) + CASE WHEN event_type = 'click' THEN [49, 44, 49, 48][event_id % 4 + 1] ELSE [0, -5, 0, -3][event_id % 4 + 1] END AS five,
CASE WHEN 10 + event_id % 30 >= 15 THEN 50 * (10 + event_id % 30) ELSE 0 END AS score FROM events"""


def _event_reads(t: Tables) -> DataFrame:
    alone = F.floor(F.col("event_id") / 2) % 5 == 0
    flag = F.when(alone, 0).when(F.col("event_id") % 2 == 0, 0x41).otherwise(0x81) + F.when(F.col("event_type") == "click", 0x10).otherwise(0)
    name = F.floor(F.col("event_id") / 2)
    cigar = F.element_at(F.array(*map(F.lit, _CIGARS)), (F.col("event_id") % 4 + 1).cast("int"))
    return t.events.select(F.col("event_id").alias("at"), F.concat(F.lit("q"), name).alias("qname"), flag.cast("long").alias("flag"), F.concat(F.lit("chr"), F.col("user_id") % 3).alias("chrom"), (F.lit(1000) + F.floor("value")).cast("long").alias("start"), cigar.alias("cigar"), F.expr("repeat(char(43 + event_id % 30), 50)").alias("quality"), F.concat(F.lit("lib"), name % 2).alias("library"))


@query(f"""WITH r AS ({_READS}), a AS (SELECT * FROM r WHERE NOT alone AND id % 2 = 0), b AS (SELECT * FROM r WHERE NOT alone AND id % 2 = 1),
p AS (SELECT a.id, b.id AS other, a.library, least((a.chrom, a.five, a.back), (b.chrom, b.five, b.back)) AS low, greatest((a.chrom, a.five, a.back), (b.chrom, b.five, b.back)) AS high, a.score + b.score AS score FROM a JOIN b ON a.name = b.name),
best AS (SELECT id, other, row_number() OVER (PARTITION BY library, low, high ORDER BY score DESC, id) AS k FROM p),
mate AS (SELECT unnest([id, other]) AS id, k FROM best), f AS (SELECT r.*, mate.k, mate.id IS NOT NULL AS paired FROM r LEFT JOIN mate USING (id)),
g AS (SELECT *, bool_or(paired) OVER (PARTITION BY library, chrom, five, back) AS beside, row_number() OVER (PARTITION BY library, chrom, five, back ORDER BY paired, score DESC, id) AS place FROM f)
SELECT id AS event_id, CASE WHEN paired THEN k > 1 ELSE beside OR place > 1 END AS duplicate FROM g""")
def mark_duplicates(t):
    return dup.mark_duplicates(_event_reads(t)).select(F.col("at").alias("event_id"), "duplicate")


@query("""WITH e AS (SELECT event_type AS orientation, CAST(floor(value * 10) AS BIGINT) AS size FROM events), m AS (SELECT orientation, median(size) AS med, count(*) AS n, min(size) AS lo, max(size) AS hi FROM e GROUP BY orientation),
d AS (SELECT orientation, median(abs(size - med)) AS mad FROM e JOIN m USING (orientation) GROUP BY orientation),
o AS (SELECT orientation, size, count(*) AS n FROM e GROUP BY 1, 2), mode AS (SELECT orientation, arg_max(size, n * 1000000 - size) AS mode FROM o GROUP BY orientation),
t AS (SELECT orientation, avg(size) AS mean, stddev_samp(size) AS sd FROM e JOIN m USING (orientation) JOIN d USING (orientation) WHERE size <= med + 10 * mad GROUP BY orientation),
w AS (SELECT orientation, abs(size - CAST(floor(med) AS BIGINT)) AS off, row_number() OVER (PARTITION BY orientation ORDER BY abs(size - CAST(floor(med) AS BIGINT))) AS k, n FROM e JOIN m USING (orientation)),
v AS (SELECT orientation, 2 * min(off) FILTER (k >= 0.5 * n) + 1 AS w50, 2 * min(off) FILTER (k >= 0.99 * n) + 1 AS w99 FROM w GROUP BY orientation)
SELECT orientation, n AS read_pairs, lo AS min_insert_size, hi AS max_insert_size, mode AS mode_insert_size, med AS median_insert_size, mad AS median_absolute_deviation, round(mean, 5) AS mean_insert_size, round(sd, 5) AS standard_deviation, w50 AS width_of_50_percent, w99 AS width_of_99_percent
FROM m JOIN d USING (orientation) JOIN mode USING (orientation) JOIN t USING (orientation) JOIN v USING (orientation)""")
def histogram_metrics(t):
    hist = t.events.groupBy(F.col("event_type").alias("orientation"), F.floor(F.col("value") * 10).cast("long").alias("size")).agg(count().alias("n"))
    out = quality.insert_size_metrics(hist, minimum_pct=0.0)
    keep = ["orientation", "read_pairs", "min_insert_size", "max_insert_size", "mode_insert_size", "median_insert_size", "median_absolute_deviation"]
    return out.select(*keep, F.round("mean_insert_size", 5).alias("mean_insert_size"), F.round("standard_deviation", 5).alias("standard_deviation"), "width_of_50_percent", "width_of_99_percent")
