"""Queries of the subpackage against their SQL on the driver's smallest tables."""

import os

import duckdb
import pytest

from locusmill.llm import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_mix", "op3_embed_dedup", "op6_decontam", "op9_ngram_join", "op10_warc"])
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = db.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    got = registry.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == sorted(want.fetchall(), key=repr)
