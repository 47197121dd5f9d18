"""The pipeline's stages, each against brute force on what the one before kept, and ``run`` against its stages."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
from test_operators import brute_components, brute_contamination

import corpus_pipeline
from locusmill.llm import mixing, tokens, toxicity, vectors
from locusmill.llm.common import materialise, table

DATA = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
def test_stages_and_run(spark):
    docs = table(spark, DATA, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    kept = [docs]
    for at, stage in enumerate(stages.values()):
        kept.append(materialise(stage(spark, kept[-1], DATA), f"test-stage-{at}"))
    calm, single, clean, mixed, written = kept[1:]
    assert all(df.columns == docs.columns for df in kept[:5])

    marks = {r["row"]["doc_id"]: r["score"] >= toxicity.THRESHOLD for r in toxicity.score_toxicity(docs, table(spark, DATA, "labels")).collect()}
    assert rows_of(calm) == [r for r in rows_of(docs) if not marks[r[0]]]
    toxic = {r["doc_id"] for r in table(spark, DATA, "labels").where("toxic = 1").collect()}
    assert len(toxic & {r["doc_id"] for r in calm.collect()}) <= len(toxic) / 4

    root = brute_components([tuple(r) for r in calm.select("doc_id", "text").collect()], 5, 80, 100)
    assert rows_of(single) == [r for r in rows_of(calm) if root[r[0]][1] == r[0]]

    items = [(r["item_id"], r["text"]) for r in table(spark, DATA, "benchmark").collect()]
    after = {r["doc_id"]: r["text"] for r in clean.collect()}
    whole = 0
    for r in single.collect():
        n, hit, _ = brute_contamination(r["text"], items)
        assert (r["doc_id"] in after) == (not hit or 20 * hit < n)
        if not hit:
            assert after[r["doc_id"]] == r["text"]
            whole += 1
    assert 0 < whole <= len(after) <= single.count()

    taken = Counter(r["doc_id"] for r in mixed.collect())
    wanted = {r["doc_id"]: r["copies"] for r in mixing.mix(clean).select("row.doc_id", "copies").collect() if r["copies"]}
    assert taken == Counter(wanted) and set(taken.values()) <= {1, 2}

    encoder = tokens.Encoder(None, tokens.VOCABULARY)
    crc = Counter()
    for r in mixed.collect():
        ids = [*encoder.library.encode(r["text"] or "", add_special_tokens=False).ids, tokens.END_ID]
        crc[r["doc_id"], len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in written.collect()) == crc
    assert rows_of(corpus_pipeline.run(spark, DATA)) == rows_of(written)


def test_planted_near_vectors_are_found(spark):
    """Recall of planted pairs at cosines of 0.951 to 0.97, the hardest that count, among clustered vectors; no false link."""
    r = np.random.default_rng(17)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    n, dim, planted = 4000, 64, 800
    x = unit(unit(r.normal(size=(60, dim)))[r.integers(0, 60, n)] + 0.9 / np.sqrt(dim) * r.normal(size=(n, dim)))
    cosine = r.uniform(0.951, 0.97, (planted, 1))
    noise = r.normal(size=(planted, dim))
    noise = unit(noise - (noise * x[:planted]).sum(axis=1, keepdims=True) * x[:planted])
    y = np.vstack([x, cosine * x[:planted] + np.sqrt(1 - cosine**2) * noise])
    hit = unit(y) @ unit(y).T >= 0.95
    np.fill_diagonal(hit, False)
    rows = [(i, v.tolist()) for i, v in enumerate(y)]
    got = {g["vec_id"]: g["n_links"] for g in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    found = np.array([got[i] for i in range(len(y))])
    assert hit.sum() >= 2 * planted and (found <= hit.sum(axis=1)).all()
    assert found.sum() >= 0.95 * hit.sum()
