"""Importance resampling, ranked search and fingerprints against brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.llm import importance, registry, search, winnow

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score string, rank string, run long"
rng = np.random.default_rng(11)
VOCAB = ["".join(rng.choice(list("abcdefé"), 4)) for _ in range(120)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCAB, n))


def edge_docs():
    """Nulls, empty texts, ties, repeated rows, copies, a very long text, signs only; extra columns with the names of inner ones."""
    texts = [prose(40, 1), prose(40, 1), None, "", " .,; ", "A-b c_d E9 É", prose(19, 2), prose(20, 3), prose(60_000, 4), "日本語 テキスト", "x" * 70_000]
    texts += [prose(30, 100 + i) for i in range(60)]
    rows = [(3 * i - 5, t, "s", "r", 7) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (4, prose(25, 9), "s", "r", 7), (None, prose(33, 8), None, None, None), (None, None, None, None, None), (-(2**63), prose(22, 7), "", "", 0), (2**63 - 1, prose(21, 6), "", "", 0)]


def items():
    return [(1, prose(12, 4)), (2, prose(8, 5)), (2, prose(8, 5)), (3, None), (4, "nowhere.."), (5, "É c"), (None, prose(6, 9))]


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def features(text, longest):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_scores(docs, target, buckets, longest):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text, longest)) for texts in (docs, target))
    over, under = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log(((t[b] + 1) * over) / ((s[b] + 1) * under))) for b in {*s, *t}}
    return [(len(words(text)), len(f := features(text, longest)), sum(gain[bucket(x)] for x in f)) for text in docs]


@pytest.mark.parametrize(("buckets", "longest"), [(10_000, 1), (50, 3)])
def test_importance(spark, buckets, longest):
    rows = edge_docs()
    docs, target = spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(items(), "item_id long, text string")
    scored = importance.scores(docs, target, buckets, longest)
    got = [tuple(r) for r in importance.drawn(scored, percent=40).collect()]
    want = []
    for (doc, *_), (n_words, n_features, weight) in zip(rows, brute_scores([r[1] for r in rows], [r[1] for r in items()], buckets, longest)):
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        want.append((n_words, n_features, weight, doc, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    names = scored.columns
    plain = lambda r: dict(zip([*names, "rank"], r))
    key = lambda r: (-r["score"], 2**63 - 1 if r["doc_id"] is None else r["doc_id"], r["n_features"])
    made = [plain(r) for r in got]
    assert Counter((r["n_words"], r["n_features"], r["weight"], r["doc_id"], r["score"]) for r in made) == Counter(want)
    fit = sorted((r for r in made if r["n_words"] >= 20), key=key)
    k = len(fit) * 40 // 100
    assert [key(r) for r in sorted((r for r in made if r["rank"]), key=lambda r: r["rank"])] == [key(r) for r in fit[:k]]
    assert sorted(r["rank"] for r in made if r["rank"]) == list(range(1, k + 1))


def test_importance_keeps_columns_and_bears_empty_tables(spark):
    docs, target = spark.createDataFrame(edge_docs(), DOCS), spark.createDataFrame(items(), "item_id long, text string")
    ranked = importance.drawn(importance.scores(docs, target), percent=50).where("rank is not null")
    kept = importance.resample(docs, target, percent=50)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in ranked.collect()}
    assert importance.drawn(importance.scores(docs.limit(0), target)).count() == 0
    assert importance.drawn(importance.scores(docs, target.limit(0))).count() == docs.count()


def test_kth_key_over_the_whole_range_of_long(spark):
    r = np.random.default_rng(5)
    some = [-(2**63), -1, 0, 1, 2**63 - 1, 7, 7, 7]
    rows = [(int(r.choice(some)), int(x)) for x in r.integers(-(2**63), 2**63 - 1, 200)] + [(5, 5)] * 40
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    for k in (1, 2, 60, 100, 150, 239, 240):
        assert importance.kth_key(df, ["a", "b"], k) == sorted(rows)[k - 1]


def brute_search(docs, queries, k=10, b=90):
    terms = [Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for _, t in docs]
    terms = [Counter({w: 0 for w in ()}) + Counter(x for w, n in c.items() for x in [low(w)] * n) for c in terms]
    n, total = sum(bool(c) for c in terms), sum(sum(c.values()) for c in terms)
    df = Counter(w for c in terms for w in c)
    out = []
    for item, text in queries:
        found = []
        for (doc, _), c in zip(docs, terms):
            m = 100 - b + (b * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(words(text)) if c[w])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if null else doc, -s) for i, (s, null, doc) in enumerate(sorted(found)[:k])]
    return Counter(out)


@pytest.mark.parametrize(("segment", "leaf", "block_terms"), [(4096, 32, 10**6), (7, 2, 10)])
def test_search(spark, monkeypatch, segment, leaf, block_terms):
    monkeypatch.setattr(search, "SEGMENT_DOCS", segment)
    monkeypatch.setattr(search, "LEAF", leaf)
    monkeypatch.setattr(search, "SCOUTS", 3)
    rows = edge_docs()
    docs, queries = spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(items(), "item_id long, text string")
    got = search.ranked_search(docs, queries, block_terms=block_terms)
    assert Counter(tuple(r) for r in got.collect()) == brute_search([r[:2] for r in rows], items())
    assert search.ranked_search(docs.limit(0), queries).count() == 0
    assert search.ranked_search(docs, queries.limit(0)).count() == 0


def tree_of(docs, queries):
    vocabulary = {w: i for i, w in enumerate(sorted({w for q in queries for w in q}))}
    segment = search.Segment()
    for i, text in enumerate(docs):
        segment.add(i, text.encode(), {w.encode(): i for w, i in vocabulary.items()})
    batch = segment.batch()
    row = {c: batch.column(c)[0] for c in ("docs", "sizes", "terms", "df", "at", "tf")}
    return search.Trees(row, segment.n, segment.l, 90), [np.array(sorted(vocabulary[w] for w in q)) for q in queries]


def test_search_leaves_most_leaves_shut_and_opens_equal_bounds():
    docs = [prose(50, i) for i in range(3000)]
    docs[1234] = "rare gem " + docs[1234]
    terms = sorted({"rare", "gem", *VOCAB[:3]})
    trees, (query,) = tree_of(docs, [terms])
    best = []
    trees.search(query, np.array([7000 if w in ("rare", "gem") else 1000 for w in terms]), 1, best, 0)
    assert best[0][2] == 1234 and trees.opened < trees.leaves / 3
    # Equal documents: the smallest ids win, and nodes beyond them are not opened.
    trees, (query,) = tree_of(["same words here"] * 2000, [["same"]])
    best = []
    trees.search(query, np.full(1, 1000), 3, best, 0)
    assert [x[2] for x in best] == [0, 1, 2] and trees.opened < 10


def brute_prints(text, hashed, k=winnow.K, w=winnow.WINDOW):
    if not text:
        return []
    h = [hashed(text[i : i + k]) for i in range(max(1, len(text) - k + 1))]
    out = []
    for s in range(max(1, len(h) - w + 1)):
        part = h[s : s + w]
        one = (min(part), s + max(i for i, x in enumerate(part) if x == min(part)))
        if not out or out[-1] != one:
            out.append(one)
    return out


def fingerprint_docs():
    rows = [r for r in edge_docs() if len(r[1] or "") != 70_000]
    return [*rows, (50, "y" * 9000, "s", "r", 7), (51, prose(3000, 77), "s", "r", 7), (52, "short 👍", "s", "r", 7), (53, "x" * 22, "", "", 0), (54, "q" * 23, "", "", 0)]


@pytest.mark.parametrize("run_docs", [64, 1, 5])
def test_fingerprints(spark, monkeypatch, run_docs):
    monkeypatch.setattr(winnow, "RUN_DOCS", run_docs)
    rows = [r for r in fingerprint_docs() if len(r[1] or "") < 100_000 or run_docs == 64]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = winnow.edited_fingerprints(docs).withColumns({"fingerprint": winnow.told(F.col("fingerprint")), "edited_fingerprint": winnow.told(F.col("edited_fingerprint"))}).collect()
    order = sorted({(r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest(), r[1] or "") for r in rows})
    pairs = []
    for i, (null, doc, _, text) in enumerate(order):
        after, q = order[(i + 1) % len(order)][3], len(text) // 4
        pairs.append((None if null else doc, text, text[: len(text) - q] + after[:q], after))
    grams = sorted({t[i : i + winnow.K] for _, *texts in pairs for t in texts for i in range(max(1, len(t) - winnow.K + 1))})
    hashes = dict(spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.xxhash64(F.encode("g", "UTF-32")).bitwiseAND(F.lit((1 << 32) - 1))).collect())
    told = lambda e: ",".join(f"{h:X}:{p}" for h, p in e)

    def near(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    want = {}
    for doc, text, edited, after in pairs:
        a, b, c = (brute_prints(t, hashes.__getitem__) for t in (text, edited, after))
        want[doc, edited] = (len(text), told(a), told(b), near(a, b), near(a, c))
    copies = Counter((r[0], r[1] or "") for r in rows)
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["edited"]) for r in got) == Counter({(d, e): copies[d, t] for d, t, e, _ in pairs})
    for r in got:
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == want[r["doc_id"], r["edited"]][:3]
        assert (r["near_edited"], r["near_next"]) == pytest.approx(want[r["doc_id"], r["edited"]][3:])


def test_fingerprints_of_few_and_no_documents(spark):
    docs = spark.createDataFrame([(1, prose(30, 1), "", "", 0)], DOCS)
    (one,) = winnow.edited_fingerprints(docs).collect()
    assert one["near_next"] == 1.0 and one["edited"][: one["n_chars"] // 4] == docs.first()["text"][: one["n_chars"] // 4]
    assert winnow.edited_fingerprints(docs.limit(0)).count() == 0 and winnow.fingerprints(docs.limit(0)).count() == 0


def test_shared_runs_are_always_found(spark):
    """The guarantee: a run of k + window - 1 characters in common puts one hash into both fingerprints."""
    r = np.random.default_rng(2)
    noise = lambda n: "".join(r.choice(list("abcdefghij "), n))
    rows = []
    for i in range(60):
        shared = noise(winnow.K + winnow.WINDOW - 1)
        rows += [(i, noise(int(r.integers(0, 200))) + shared + noise(int(r.integers(0, 200))), "", "", 0) for _ in range(2)]
    found = winnow.fingerprints(spark.createDataFrame(rows, DOCS)).collect()
    by_doc = {}
    for row in found:
        by_doc.setdefault(row["doc_id"], []).append({e["hash"] for e in row["fingerprint"]})
    assert all(a & b for a, b in by_doc.values())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
@pytest.mark.parametrize("name", ["op11_importance", "op12_search"])
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = db.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    got = registry.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(cols)
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == Counter(want.fetchall())
