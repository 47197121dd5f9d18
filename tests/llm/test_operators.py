import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.llm import decontam, lines, mixing, pii, secrets, sigtree, tokens, toxicity, vectors, warc
from locusmill.llm.common import run_numbers
from locusmill.llm.graph import components
from locusmill.llm.wavelet import WaveletFile, encode

DOCS = "doc_id long, text string, source string, row string, n_chars long"
rng = np.random.default_rng(3)
VOCAB = ["".join(rng.choice(list("abcdefghiké"), 5)) for _ in range(300)]


def prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(VOCAB, n))


def edge_docs():
    """Nulls, empty texts, ties, repeated rows, a long text, copies and near copies; a column named like an inner one."""
    base = prose(200, 1)
    near = base.split()
    near[100] = "changed"
    texts = [base, base, " ".join(near), None, "", "  \n ", prose(3, 2), prose(3, 2).upper(), prose(30_000, 4), prose(60, 5)]
    rows = [(i, t, ["b", "a", None][i % 3], "x", 1) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, base, "a", None, None), (None, None, None, None, None)]


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def brute_components(docs, k, num, den):
    sets = {}
    for i, t, *_ in docs:
        if i is not None:
            w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
            sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("units", [256, 4])
def test_similar_sets(spark, monkeypatch, units):
    monkeypatch.setattr(sigtree, "UNIT_DOCS", units)
    docs = edge_docs()
    base = prose(200, 1).split()
    for i in range(40):  # a large group of near copies that needs several units
        own = list(base)
        own[i * 4] = f"new{i}"
        docs.append((100 + i, " ".join(own), "a", "x", 1))
    got = sigtree.similar_sets(frame(spark, docs), 4, (85, 100)).collect()
    want = brute_components(docs, 4, 85, 100)
    assert len(got) == len(docs)
    assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]
    kept = sigtree.keep_one(frame(spark, docs)).collect()
    assert {r["doc_id"] for r in kept} == {c for _, c in brute_components(docs, 5, 80, 100).values()} | {None} and kept[0].asDict().keys() == {"doc_id", "text", "source", "row", "n_chars"}
    assert sigtree.similar_sets(frame(spark, []), 4, (85, 100)).count() == 0


@pytest.mark.parametrize("units", [256, 2])
def test_similar_sets_keeps_the_links_of_every_text_of_an_id(spark, monkeypatch, units):
    monkeypatch.setattr(sigtree, "UNIT_DOCS", units)
    docs = [(50, None, "a", "x", 1), (50, "", "a", "x", 1), (3, "", "a", "x", 1), (4, prose(200, 90), "a", "x", 1)]
    for i in range(6):  # six texts under one id, each with a near copy of its own
        text = prose(200, 70 + i)
        near = text.split()
        near[100] = "changed"
        docs += [(50, text, "a", "x", 1), (50, text.upper(), "a", "x", 1), (10 + i, " ".join(near), "a", "x", 1)]
    got = {(r["doc_id"], r["component_id"]) for r in sigtree.similar_sets(frame(spark, docs), 4, (85, 100)).collect()}
    assert got == {(3, 3), (4, 4), (50, 10), *((10 + i, 10) for i in range(6))}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (7, 9), (9, 8), (5, 5), (None, 4)] + [(100 + i, 101 + i) for i in range(50)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} | {100 + i: 100 for i in range(51)}


def test_components_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr("locusmill.llm.graph.CHUNK", 7)
    r = np.random.default_rng(8)
    ids = r.permutation(2000) - 500  # negative ids too
    links = [(int(ids[i]), int(ids[i + 1])) for i in range(600)] + [(int(a), int(b)) for a, b in zip(r.choice(ids[700:], 900), r.choice(ids[700:], 900))]
    up = {i: i for pair in links for i in pair}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long").repartition(13)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: root(i) for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def thue_morse(n):
    """A word of n letters and its complement: their polynomial hashes modulo 2^64 are the same for every base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_hash_alike_are_told_apart(spark):
    pairs = [w for n in (1024, 2048) for w in thue_morse(n)]
    encoder = tokens.Encoder(None, tokens.VOCABULARY)
    assert encoder.by_word and encoder.encode(pairs) == encoder.raw(pairs)
    together = [" ".join(pairs), " ".join(reversed(pairs))]
    assert encoder.encode(together) == encoder.raw(together) and encoder.encode(pairs[::-1]) == encoder.raw(pairs[::-1])
    docs = [(30 + i, w, "a", "x", 1) for i, w in enumerate(pairs)] + [(40, pairs[1], "a", "x", 1)]
    got = {r["doc_id"]: r["component_id"] for r in sigtree.similar_sets(frame(spark, docs), 4, (85, 100)).collect()}
    assert got == {30: 30, 31: 31, 32: 32, 33: 33, 40: 31}


def test_stretches_with_equal_keys_are_encoded_by_the_library(monkeypatch):
    monkeypatch.setattr(tokens.ByteHasher, "ranges", lambda self, line, first, last: (last - first).astype(np.uint64))
    encoder = tokens.Encoder(None, tokens.VOCABULARY)
    texts = [prose(30, 5), "abc abd, abe. abf", prose(30, 6)]
    assert encoder.encode(texts) == encoder.raw(texts) and encoder.encode(texts[::-1]) == encoder.raw(texts[::-1])


@pytest.mark.parametrize("n", [1, 7, 8, 9, 16, 63, 64, 65, 200])
def test_stretches_that_differ_in_one_byte_are_told_apart(monkeypatch, n):
    monkeypatch.setattr(tokens.ByteHasher, "ranges", lambda self, line, first, last: (last - first).astype(np.uint64))
    encoder = tokens.Encoder(None, tokens.VOCABULARY)
    words = ["a" * n, "a" * (n - 1) + "b", "b" + "a" * (n - 1)]
    assert encoder.encode(words) == encoder.raw(words) and encoder.encode(words[::-1]) == encoder.raw(words[::-1])


def test_only_tokenizers_that_split_at_spaces_go_by_word():
    import json

    said = json.loads(tokens.Encoder(None, tokens.VOCABULARY).library.to_str())
    assert tokens.by_word(said)
    kept = [n for n in said["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
    assert len(kept) < len(said["normalizer"]["normalizers"])
    for change in ({"normalizer": said["normalizer"] | {"normalizers": kept}}, {"pre_tokenizer": None}, {"normalizer": {"type": "Strip"}}, {"added_tokens": [{"content": "a b", "lstrip": False, "rstrip": False, "normalized": False}]}):
        assert not tokens.by_word(said | change)


def test_words_before_marks_are_not_learnt_again():
    encoder = tokens.Encoder(None, tokens.VOCABULARY)
    words = sorted({*prose(60, 9).split(), "größe", "été", "maß", "x1"})
    encoder.encode([" ".join(words)])
    known, tails = encoder.n, [".", ",", "%%%", ".,***", "'s", "-"]
    texts = [" ".join(w + t for w in words) for t in tails]
    assert encoder.encode(texts) == encoder.raw(texts) and encoder.n == known + len(tails)


def test_pieces_that_end_elsewhere_are_left_to_the_library():
    import json

    said = json.loads(tokens.Encoder(None, tokens.VOCABULARY).library.to_str())
    splitter = json.dumps(said["pre_tokenizer"])
    letters, rest = r"[\\p{L}]+", r"[^\\s\\p{L}\\p{N}]+"
    assert letters in splitter and rest in splitter
    for old, new in ((letters, r"[\\p{L}]"), (rest, r"[^\\s]+"), (letters + "|", "")):
        assert not tokens.by_word(said | {"pre_tokenizer": json.loads(splitter.replace(old, new))})
    assert not tokens.by_word(said | {"added_tokens": [said["added_tokens"][0] | {"single_word": True}]})


def test_encoder_equals_library_on_odd_pieces():
    r = np.random.default_rng(12)
    pieces = ["a", "tree", "é", "ß", "ÿ", "÷", "İ", "Σ", "Z", "7", "²", "'s", "'", "’", ".", ",", "%%", "<", "|", ">", "<|endoftext|>", "_", "=", "\u0338", "\u0301", "\u00a0", "\t", "\n", "\x00", " ", "  ", "日本", "\u3099", "か", "\U0001f600", "K", "ﬁ"]
    encoder = tokens.Encoder(None, tokens.VOCABULARY)
    for _ in range(20):
        texts = ["".join(r.choice(pieces, r.integers(0, 30))) for _ in range(100)]
        assert encoder.encode(texts) == encoder.raw(texts)


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 7])
def test_runs_have_equal_numbers_only_if_equal(k):
    x = np.random.default_rng(k).integers(0, 3, 400)
    got = run_numbers(x, k)
    seen = [tuple(x[i : i + k]) for i in range(len(x) - k + 1)]
    assert len(got) == len(seen) and len(set(zip(got.tolist(), seen))) == len(set(seen)) == len(set(got.tolist()))


def test_shingles_of_texts_hashed_together():
    texts = [prose(50, 1), None, "", "one two", prose(300, 2), "one TWO", "x" * 5000 + " y", prose(9, 3) + " " + prose(9, 3)]
    sets = [{tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if (w := words(t.lower() if t else t)) else set() for t in texts]
    raw = [t if t is None else t.encode() for t in texts]
    hashed = list(sigtree.signed_sets(raw, 4))
    assert [len(h) for h, _ in hashed] == [len(s) for s in sets] and hashed[3][1] == hashed[5][1] != hashed[0][1]
    numbered = sigtree.unit_sets(raw, 4)
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(numbered[i], numbered[j])) == len(np.intersect1d(hashed[i][0], hashed[j][0])) == len(sets[i] & sets[j])


@pytest.mark.parametrize("units", [256, 3])
def test_similar_sets_in_a_chain_of_half_similar_documents(spark, monkeypatch, units):
    """One subtree of many buckets: neighbours share half of their words, some are linked."""
    monkeypatch.setattr(sigtree, "UNIT_DOCS", units)
    line = prose(1500, 21).split()
    docs = [(i, " ".join(line[i * 30 : i * 30 + 120]), "a", "x", 1) for i in range(40)]
    docs += [(100 + i, " ".join(line[i * 30 : i * 30 + 115]), "a", "x", 1) for i in range(0, 40, 3)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in sigtree.similar_sets(frame(spark, docs), 4, (85, 100)).collect()}
    assert got == brute_components(docs, 4, 85, 100)


def test_mix(spark):
    docs = edge_docs() + [(1000 + i, prose(5 + i % 50, i), "abc"[i % 3], "x", 1) for i in range(300)]
    got = mixing.mix(frame(spark, docs)).collect()
    again = mixing.mix(frame(spark, docs)).collect()
    key = lambda rows: sorted((repr(r["row"]["doc_id"]), r["size"], r["copies"]) for r in rows)
    assert key(got) == key(again) and len(got) == len(docs) and max(r["copies"] for r in got) <= 2
    sizes, targets, taken = defaultdict(int), {}, defaultdict(int)
    for i, t, s, *_ in docs:
        sizes[s] += len(words(t))
    left, total = dict.fromkeys(sizes), 1.5 * sum(sizes.values())
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    while left:
        level = total / sum(weight[s] for s in left)
        full = [s for s in left if level * weight[s] > 2 * sizes[s]]
        for s in full or list(left):
            targets[s] = 2 * sizes[s] if full else level * weight[s]
            total -= targets[s]
            del left[s]
    for r in got:
        s = r["row"]["source"]
        assert r["size"] == len(words(r["row"]["text"])) and r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        taken[s] += r["copies"] * r["size"]
    assert all(taken[s] == pytest.approx(targets[s], rel=0.05) for s in ("b", "c"))
    assert mixing.mixed_documents(frame(spark, docs)).count() == sum(r["copies"] for r in got)
    assert mixing.mix(frame(spark, [])).count() == 0


def brute_lines(docs):
    """Removed lines by document, straight from the rule: pairs of neighbouring lines, and long lines, at any but their first place."""
    uses = defaultdict(list)
    for i, t, *_ in docs:
        own = [(k, x) for k, x in enumerate((t or "").split("\n")) if re.search(r"[^\x00-\x20]", x)]
        for (k, x), (m, y) in zip(own, own[1:]):
            uses[x, y].append((i is None, i or 0, k, m))
        for k, x in own:
            if len(words(x)) >= 50:
                uses[x].append((i is None, i or 0, k, k))
    gone = defaultdict(set)
    for places in uses.values():
        for nameless, i, k, m in sorted(places)[1:] if not min(places)[0] else []:
            gone[None if nameless else i].update(range(k, m + 1))
    return gone


@pytest.mark.parametrize("rows", [lines.KEY_ROWS, 3])
def test_lines(spark, monkeypatch, rows):
    monkeypatch.setattr(lines, "KEY_ROWS", rows)  # few: hot chunks are dealt to several tasks
    block = "\n".join(f"license line {i}" for i in range(5))
    long = prose(60, 9)
    docs = [(1, f"own start\n{block}\nown end", "a", "x", 1), (2, f"other\n{block}", "a", "x", 1), (3, None, "a", "x", 1), (4, "\n\n\n\n", "a", "x", 1), (5, "\n\n\n\n", "a", "x", 1), (None, block, "a", "x", 1)]
    docs += [(6, "a\n\nb\nc", "a", "x", 1), (7, "z\na\n\nb\nd", "a", "x", 1), (8, f"first\n{long}\nlast", "a", "x", 1), (9, f"other\n{long}", "a", "x", 1), (10, "b\na\nb\na\nb\na", "a", "x", 1), (11, "", "a", "x", 1)]
    docs += [(100 + i, f"top {i}\n{block}\nend {i}", "a", "x", 1) for i in range(20)]
    facts, gone = lines.repeated_chunks(frame(spark, docs))
    assert sorted((r["doc_id"] or 0, r["n_lines"]) for r in facts.collect())[:8] == [(0, 5), (1, 7), (2, 6), (3, 1), (4, 5), (5, 5), (6, 4), (7, 5)]
    got = {r["doc_id"]: {i for s in r["spans"] for i in range(s["start"], s["end"])} for r in lines.passages(gone).collect()}
    want = brute_lines(docs)
    assert got == want and got[2] == {1, 2, 3, 4, 5} and got[None] == {0, 1, 2, 3, 4} and got[7] == {1, 2, 3} and got[9] == {1} and 4 not in got
    text = {r["doc_id"]: r["text"] for r in lines.dedup_lines(frame(spark, docs)).collect()}
    assert text == {i: t if i not in want else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]) for i, t, *_ in docs}
    assert lines.repeated_chunks(frame(spark, []))[0].count() == 0 and lines.dedup_lines(frame(spark, [])).count() == 0


def test_line_digests_that_different_lines_share_remove_nothing(spark, monkeypatch):
    monkeypatch.setattr(lines, "_digest", lambda line: F.unhex(F.md5(F.substring(line, 1, 1))))
    docs = [(1, "aa\nbb", "a", "x", 1), (2, "ax\nbb", "a", "x", 1), (3, "ca\nda", "a", "x", 1), (4, "ca\nda", "a", "x", 1)]
    assert [r["doc_id"] for r in lines.repeated_chunks(frame(spark, docs))[1].collect()] == [4]


def test_lines_of_different_texts_of_one_id(spark):
    docs = [(1, "p q\nr s\nend a", "a", "x", 1), (5, "p q\nr s\nown five", "a", "x", 1), (5, "precious one\nprecious two\nprecious three", "a", "x", 1), (7, "twice a\ntwice b", "a", "x", 1), (7, "twice a\ntwice b", "a", "x", 1)]
    got = sorted((r["doc_id"], r["text"]) for r in lines.dedup_lines(frame(spark, docs)).collect())
    assert got == [(1, "p q\nr s\nend a"), (5, "own five"), (5, "precious one\nprecious two\nprecious three"), (7, "twice a\ntwice b"), (7, "twice a\ntwice b")]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, t) if ok(m.group())]


def random_texts(pieces, n):
    r = np.random.default_rng(8)
    return ["".join(r.choice(pieces, 40)) for _ in range(n)]


def test_pii(spark):
    pieces = ["a@b.co", "@", ".", "c_d@e-f.org", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+", "12", " ", "-", "é", "\U0001f600", "x", "\n", "000.01.1.2.9", "5500000000000004"]
    texts = [*random_texts(pieces, 150), None, "", "1" * 20_000, "a" * 50_000, "my iban is DE89 3704 0044 0532 0130 00.", "iban DE88370400440532013000", "ssn 123-45-6789", "123-45-6789"]
    got = {r["doc_id"]: r["findings"] for r in pii.find_pii(frame(spark, [(i, t, "a", "x", 1) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert [f"{s.kind}:{s.start}:{s.end}" for s in got[i] if s.kind in pii.KINDS] == base_pii(t or ""), t
    assert [[s.kind for s in got[i]] for i in range(len(texts) - 4, len(texts))] == [["iban"], [], ["ssn"], []]
    assert pii.redact(frame(spark, [(1, "to a@b.co now", "a", "x", 1)])).first()["text"] == "to [email] now"


def base_secrets(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


def test_secrets(spark):
    pieces = ["password", "ToKeN", '": "', "=", " ", "hunter2x", "api_key", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef0123", "é", "'", "Secret:", "deadbeef", "\n", "zQ9x7Lk2"]
    texts = random_texts(pieces, 200)
    scanner = secrets.Scanner()
    for t in texts:
        assert scanner.base(t) == base_secrets(t)
    for s in ("a" * 50, "abcdefghijklmnopqrstuvwxyz0123456789", "".join(random_texts(list("abcXYZ019"), 3))):
        direct = max(-sum(p * np.log2(p) for p in [w.count(c) / len(w) for c in set(w)]) for w in [s[i : i + 20] for i in range(len(s) - 19)])
        assert secrets.top_entropy(s) == pytest.approx(direct)
    assert scanner.entropy("key 9fK2pQ7xLm4Zt8RwVb3Ns6 and 123e4567-e89b-12d3-a456-426614174000") == [(4, 26, "alnum")]
    got = secrets.scan_secrets(frame(spark, edge_docs())).collect()
    assert len(got) == len(edge_docs()) and {r["base_sha256"] for r in got if r["doc_id"] in (3, 4)} == {hashlib.sha256(b"").hexdigest()}


def test_secrets_take_linear_time():
    """Slugs of many words, and long runs of each class, with an end that no allowed string has."""
    import time

    scanner = secrets.Scanner()
    texts = ["-".join(["the"] * 200) + "-2024", "com/blog/" + "-".join(["how", "to", "Do"] * 100) + "-2024", "/".join("AB" for _ in range(300)) + "_9", "_".join("12" for _ in range(300)) + "x"]
    texts += [c * 100_000 + "!" for c in ("a", "A", "0", "f", "-", "=", "password", "aB3", " ", "a ", "AKIA", "key=")]
    for t in texts:
        began = time.process_time()
        scanner.base(t), scanner.entropy(t)
        assert time.process_time() - began < 2, t[:40]


def test_secrets_of_an_empty_table(spark):
    assert secrets.scan_secrets(frame(spark, [])).count() == 0 and pii.find_pii(frame(spark, [])).count() == 0


def brute_contamination(text, items):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, found = fold(text), set(), set()
    for i, t in items:
        own = fold(t)
        k = min(13, len(own))
        windows = {tuple(own[j : j + k]) for j in range(len(own) - k + 1)} if own else set()
        for j in range(len(w) - k + 1):
            if tuple(w[j : j + k]) in windows:
                hit.update(range(j, j + k))
                found.add(str(i))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [decontam.BLOCK_WORDS, 40])
def test_decontamination(spark, block):
    items = [(1, prose(20, 50)), (2, "One, two Three."), (3, None), (4, ""), (5, prose(13, 51)), (6, prose(20, 50) + " tail"), (7, "two three"), (None, prose(20, 52))]
    text = [f"{prose(30, 60)} {prose(20, 50)} {prose(30, 61)}", "one TWO three one two", prose(13, 51), prose(20, 50)[20:], prose(100, 62) + " two three", " ".join(prose(20, 50).split()[3:17] * 3)]
    docs = [(100 + i, t, "a", "x", 1) for i, t in enumerate(text)] + edge_docs()
    got = decontam.contamination(frame(spark, docs), frame(spark, items, "item_id long, text string"), block_words=block).collect()
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = brute_contamination(r["row"]["text"], [i for i in items if i[0] is not None])
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, found)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
    cut = {r["doc_id"]: r["text"] for r in decontam.cut_spans(frame(spark, docs[:6]), frame(spark, items, "item_id long, text string")).collect()}
    assert cut[100] == f"{prose(30, 60)} {prose(30, 61)}" and cut[104].split() == prose(100, 62).split()
    assert {r["doc_id"] for r in decontam.decontaminate(frame(spark, docs[:6]), frame(spark, items, "item_id long, text string")).collect()} == {r["row"]["doc_id"] for r in got if not r["contaminated"] and r["row"]["doc_id"] in range(100, 106)}


@pytest.mark.parametrize("block", [decontam.BLOCK_WORDS, 40])
def test_decontamination_cuts_the_passages_of_documents_that_stay(spark, block):
    items = frame(spark, [(1, prose(20, 50)), (2, prose(30, 53)), (3, prose(13, 51))], "item_id long, text string")
    a, b, long = prose(500, 60), prose(300, 61), "x" * 30_000
    docs = [(1, f"({a}\n\n{prose(20, 50)}, {b}", "a", "x", 1), (2, f"{a} {b}", "a", "x", 1), (3, f"{a} {prose(30, 53)}", "a", "x", 1), (4, f"{' ' * 30_000}{long} {a} {prose(20, 50)} {b} {prose(13, 51)}", "a", "x", 1), (5, None, "a", "x", 1)]
    kept = {r["doc_id"]: r for r in decontam.decontaminate(frame(spark, docs), items, block_words=block).collect()}
    assert {i: r["text"] for i, r in kept.items()} == {1: f"({a}\n\n{b}", 2: f"{a} {b}", 4: f"{' ' * 30_000}{long} {a} {b} ", 5: None}
    assert kept[1]["source"] == "a" and kept[1].asDict().keys() == {"doc_id", "text", "source", "row", "n_chars"}


@pytest.mark.parametrize("block", [decontam.BLOCK_WORDS, 40])
def test_decontamination_heeds_items_without_id(spark, block):
    items = frame(spark, [(1, prose(20, 50)), (None, prose(20, 52)), (None, prose(30, 53)), (2, prose(20, 52)[:0])], "item_id long, text string")
    a = prose(500, 60)
    docs = frame(spark, [(1, f"own {prose(20, 52)}", "a", "x", 1), (2, f"{a} {prose(30, 53)}", "a", "x", 1), (3, f"{a} {prose(20, 52)}", "a", "x", 1), (4, prose(20, 50), "a", "x", 1)])
    assert {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, items, block_words=block).collect()} == {3: f"{a} "}
    assert {(r["row"]["doc_id"], r["n_hit"], tuple(r["items"])) for r in decontam.contamination(docs, items, block_words=block, nameless=True).collect()} == {(1, 20, ()), (2, 30, ()), (3, 20, ()), (4, 20, ("1",))}


@pytest.mark.parametrize("cut", [decontam.decontaminate, decontam.cut_spans])
def test_decontamination_needs_one_python_worker_a_task(spark, cut):
    docs = cut(frame(spark, [(1, f"{prose(500, 60)} {prose(20, 50)}", "a", "x", 1)]), frame(spark, [(1, prose(20, 50))], "item_id long, text string"))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    assert [r["text"] for r in docs.collect()] == [f"{prose(500, 60)} "]


def test_wavelet():
    z = np.random.default_rng(1).integers(0, 70, 3000)
    f = WaveletFile.of(encode(z, [5, None], np.array([1000, 3000])))
    assert (f.tokens() == z).all() and f.documents()[0] == [5, None]
    for t in (0, 17, 69, 500):
        at = np.flatnonzero(z == t).tolist()
        assert f.count(t) == len(at) and f.occurrences(t)[:20] == at[:20] and f.count(t, 100, 900) == sum(100 <= i < 900 for i in at)
    assert [f.access(i) for i in (0, 511, 512, 2999)] == [z[i] for i in (0, 511, 512, 2999)]
    assert WaveletFile.of(encode(np.empty(0, np.int64), [], np.empty(0, np.int64))).tokens().size == 0


@pytest.mark.parametrize("n", [1 << 15, (1 << 16) + 1, 100_000])
def test_wavelet_of_several_steps(n):
    z = np.random.default_rng(n).integers(0, 50_000, n)
    f = WaveletFile.of(encode(z, [1], np.array([n])))
    assert (f.tokens() == z).all() and [f.access(i) for i in (0, 32_767, n - 1)] == z[[0, 32_767, n - 1]].tolist()


def test_tokens(spark):
    docs = edge_docs() + [(200 + i, t, "a", "x", 1) for i, t in enumerate(["a., b", "x_. y", "don't. o'", "É. ÀB, ", "İa. b", "<|endoftext|>. a", "7. 8, 9", "...", "a\n.\nb, c.", "ΑΣ. x", "a . b,\tc. d", "\U0001f600, x"])]
    got = tokens.read_tokens(*tokens.write_tokens(frame(spark, docs), shard_tokens=500)).orderBy("start").collect()
    library = tokens.Encoder(None, tokens.VOCABULARY).library
    ids = [(d[0], library.encode(d[1] or "", add_special_tokens=False).ids + [1]) for d in docs]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes()))
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got] == [(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids]
    assert [r["start"] for r in got] == np.cumsum([0] + [len(i) for _, i in ids])[:-1].tolist()
    assert tokens.read_tokens(*tokens.write_tokens(frame(spark, []))).count() == 0


@pytest.mark.parametrize("cache", [50, 400, 1_000_000])
def test_encoder_forgets_words_and_stays_exact(monkeypatch, cache):
    monkeypatch.setattr(tokens, "CACHE", cache)
    monkeypatch.setattr(tokens, "_TOGETHER", 70)
    encoder = tokens.Encoder(None, tokens.VOCABULARY)
    texts = [prose(80, i) + f" odd{i}, x-{i}." for i in range(30)] + ["", " ", "\n\n", "a  b.", "İß, ñé.", "日本 語", "x" * 600_000, "y, " * 200_000]
    got = [ids for at in range(0, len(texts), 4) for ids in encoder.encode(texts[at : at + 4])]
    assert got == encoder.raw(texts)


def test_toxicity(spark):
    bad = ["nastyword", "vileterm", "foulness"]
    docs, marks = [], []
    for i in range(400):
        w = prose(40, 1000 + i).split()
        if i % 8 == 0:
            w[5:5] = bad
        docs.append((i, " ".join(w), "a", "x", 1))
        marks.append((i, int(i % 8 == 0)))
    docs += [(None, "nastyword", "a", "x", 1), (999, None, "a", "x", 1), (998, "", "a", "x", 1)]
    labels = frame(spark, [*marks, (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["row"]["doc_id"]: r["score"] for r in toxicity.score_toxicity(frame(spark, docs), labels).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i] >= 0.3) != (i % 8 == 0) for i in held) <= 1 and all(0 <= s <= 1 for s in got.values()) and got[999] == got[998] < 0.3
    none = toxicity.score_toxicity(frame(spark, docs[:3]), labels.limit(0)).collect()
    assert [r["score"] for r in none] == [0, 0, 0]
    assert toxicity.drop_toxic(frame(spark, docs), labels).columns == frame(spark, docs).columns


def test_toxicity_finds_every_learned_node():
    keys = np.unique(np.random.default_rng(5).integers(1, 2**64 - 1, 50_000, dtype=np.uint64))
    assert (toxicity.Lookup(keys).find(keys) == np.arange(len(keys))).all() and (toxicity.Lookup(keys[::2]).find(keys[1::2]) == len(keys[::2])).all()


def test_toxicity_reads_long_words_and_text_without_spaces():
    (four, six, word, pair), cuts = toxicity.nodes([b"x" * 70_000 + b"one", b"x" * 70_000 + b"two", None, b"a b"])
    assert word[0] != word[1] and four[0] == four[1] and six[0] == six[1] and cuts.tolist() == [0, 1, 2, 2, 4] and (pair != 0).tolist() == [False, False, False, True]
    held = set(toxicity.nodes(["毒物".encode()])[0][2].tolist())
    assert held <= set(toxicity.nodes(["这里有毒物吗 caf\u00e9".encode()])[0][2].tolist()) and len(toxicity.nodes(["这里有毒物吗 caf\u00e9 \ud55c\uad6d\uc5b4".encode()])[0][0]) == 7
    assert [len(toxicity.nodes([t.encode()])[0][0]) for t in ("毒", "สวัสดี", "na\u00efve \u201cquote\u201d")] == [1, 5, 2]


def test_continuation_counts(spark):
    texts = [" ".join(f"w{i}x beta" for i in range(at, at + 40)) for at in range(0, 400, 20)] + [None, "", "beta", "alpha1 alpha22 alpha333"]
    words = {w: toxicity.nodes([w.encode()])[0] for w in ("beta", "alpha1", "gamma")}
    keys = np.unique(np.array([words["beta"][2][0], words["alpha1"][2][0], words["alpha1"][0][0], words["gamma"][2][0]], dtype=np.uint64))
    got = dict(zip(keys.tolist(), toxicity.continuation(spark.createDataFrame([(t.encode() if t else None,) for t in texts], "text binary").repartition(5), keys)))
    assert got[int(words["beta"][2][0])] == pytest.approx(420, rel=0.4)  # a sketch of 64 registers
    assert got[int(words["alpha1"][0][0])] == pytest.approx(3, rel=0.1) and got[int(words["alpha1"][2][0])] == got[int(words["gamma"][2][0])] == 0


def test_toxicity_model_is_what_its_formula_says(spark):
    """Ratios of a small model, reckoned again node by node from the texts."""
    texts = [(f"plain w{i % 7} vileness w{i % 5}" if i % 4 == 0 else f"plain w{i % 7} gentle w{i % 3}", i % 4 == 0) for i in range(40)]
    rows = [(t.encode(), int(y)) for t, y in texts]
    counted = spark.createDataFrame(rows, "text binary, toxic int").mapInArrow(toxicity._counting, toxicity._COUNTING).groupBy("key").agg(F.first("up").alias("up"), F.sum("n").alias("n"))
    counts = toxicity.Counts(counted.toArrow())
    kept = counts.seen.sum(axis=1) >= 2
    counts = toxicity.Counts(counted.where(F.col("key").isin(counts.keys.view(np.int64)[kept].tolist())).toArrow())
    counts.contexts[counts.single()] = np.arange(1, len(counts.single()) + 1)
    model = toxicity.Model(counts, [30, 10])
    contexts = dict(zip(counts.keys.tolist(), counts.contexts))

    seen = defaultdict(lambda: [0, 0])
    for t, y in texts:
        w = t.split()
        held = {(0, x[:4]) for x in w if len(x) > 4} | {(1, x[:6]) for x in w if len(x) > 6} | {(2, x) for x in w} | {(3, a + " " + b) for a, b in zip(w, w[1:])}
        for node in held:
            seen[node][int(y)] += 1
    seen = {k: v for k, v in seen.items() if sum(v) >= 2}
    docs = [30, 10]

    def key(node):
        level, text = node
        return int(toxicity.nodes([(text if level > 1 else text + "zzz").encode()])[0][level][-1])

    kept = lambda n, y: max(n - 0.75, 0) * 10 / docs[y]
    taken = [sum(sum(v[y] * 10 / docs[y] - kept(v[y], y) for y in (0, 1)) / 2 for k, v in seen.items() if k[0] == level) for level in range(4)]
    total = [sum(contexts[key(k)] for k in seen if k[0] == level) for level in range(4)]

    def ratio(node):
        level, text = node
        word = text.split()[-1]
        lower = [n for n in ((0, word[:4]), (1, word[:6]), (2, word)) if n[0] < level and (n[0] == 2 or len(word) > (4, 6)[n[0]])]
        below = ratio(lower[-1]) if lower and lower[-1] in seen else 0.0
        back = 2 + (taken[level] * contexts[key(node)] / max(1, total[level]))
        part = 2 * back / (1 + np.exp(-below))
        return np.log(kept(seen[node][1], 1) + part) - np.log(kept(seen[node][0], 0) + 2 * back - part)

    for node in seen:
        place = model.lookup.find(np.array([key(node)], dtype=np.uint64))[0]
        assert model.ratio[place] == pytest.approx(ratio(node), rel=1e-4, abs=1e-5), node
    assert ratio((2, "vileness")) > 1 and ratio((2, "gentle")) < -1
    # A text left out scores less like its own class.
    for t, y in (rows[0], rows[1]):
        (own,), (other,) = model.ratios([t], np.array([y])), model.ratios([t])
        assert len(own) == 4 and (own.sum() < other.sum()) == (y == 1)


@pytest.mark.parametrize("parts", [4096, 7])
def test_vectors(spark, monkeypatch, parts):
    monkeypatch.setattr(vectors, "PART_MEMBERS", parts)  # few: units are dealt to parts
    monkeypatch.setattr(vectors, "PART_VISITORS", 4 * parts)
    monkeypatch.setattr(vectors, "UNIT", 30)
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 16))
    x[50:80] = x[0] + 0.08 * r.normal(size=(30, 16))
    x[80:90] = x[1]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [1.0] * 7, 0), (504, [2.0] * 7, 0), (None, x[0].tolist(), 0), (505, [], 0)]
    got = {i["vec_id"]: i for i in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    n = np.array([got[i]["n_links"] for i in range(300)])
    assert (n <= hit.sum(axis=1)).all() and n.sum() >= 0.9 * hit.sum() and hit.sum() > 500
    assert all(got[i]["component_id"] == 1 for i in range(80, 90)) and all(got[i]["n_links"] == 0 for i in (500, 501, 502, 505))
    assert got[504]["component_id"] == 503 and got[503]["n_links"] == 1 and got[None]["kept"] is False
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_vectors_that_repeat_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, [-1.0, 0.0, 5.0])]
    got = sorted(tuple(r) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_cells_are_walked_in_order():
    r = np.random.default_rng(2)
    first, second = np.sort(r.random(6)), np.sort(r.random(6))
    walked = [first[i] + second[j] for i, j in vectors.nearest_cells(first, second, 36)]
    assert walked == sorted(walked) and len(walked) == 36


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no driver tables")
def test_vectors_against_all_pairs_of_the_driver_tables(spark):
    """Recall of links, and every row's component and flag, on the 2,000 vectors of sf0.1."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").toPandas()
    x = np.array(table["embedding"].tolist(), dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.95
    np.fill_diagonal(hit, False)
    got = vectors.op3_embed_dedup(spark, "/root/testdata/sf0.1").orderBy("vec_id").toPandas()
    assert (got["vec_id"] == table["vec_id"]).all() and (got["n_links"].to_numpy() <= hit.sum(axis=1)).all()
    assert got["n_links"].sum() >= 0.9 * hit.sum()
    root = table["vec_id"].to_numpy().copy()
    while True:
        low = np.minimum(root, np.where(hit, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == root).all():
            break
        root = low
    assert (got["component_id"].to_numpy() == root).mean() >= 0.99 and (got["kept"] == (got["vec_id"] == got["component_id"])).all()


def test_warc(spark):
    big = "é" * 700
    pages = [(1, "http://a/x y", big), (2, "http://b", big), (3, None, big), (4, "http://c", "short"), (5, "http://d", "short"), (6, "u", None), (None, "n", big), (3, "again", big), (7, "http://e", "x" * 2000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = warc.captures(warc.read_records(*warc.write_archives(df), blocks=True)).collect()
    got = sorted((r["metadata"]["page_id"] or 0, r["main"]["type"], r["main"]["refers_to"], r["main"]["n_bytes"], r["n_records"]) for r in found)
    n = len(big.encode())
    assert got == sorted([(0, "revisit", 3, n, 3), (1, "revisit", 3, n, 3), (2, "revisit", 3, n, 3), (3, "response", None, n, 3), (3, "response", None, n, 3), (4, "response", None, 5, 3), (5, "response", None, 5, 3), (6, "response", None, 0, 3), (7, "response", None, 2000, 3)], key=lambda r: r[:2])
    seven = next(r for r in found if r["metadata"]["page_id"] == 7)
    assert bytes(seven["main"]["block"]).endswith(b"\r\n\r\n" + b"x" * 2000) and seven["main"]["digest"] == hashlib.sha1(b"x" * 2000).hexdigest() and seven["request"]["uri"] == "http://e"
    assert warc.captures(warc.read_records(*warc.write_archives(df.limit(0)))).count() == 0


def test_entry_without_clashes(spark):
    import corpus_pipeline

    docs = frame(spark, edge_docs(), DOCS.replace("row string", "lang string"))
    out = corpus_pipeline.ngram_join_stage(spark, docs, "")
    assert out.columns == docs.columns and F is not None
