import os

import duckdb
import pytest

from locusmill import bindings, plan_bindings  # noqa: F401

DATA = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if v is None or v != v:
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_same_rows_as_sql(spark, name):
    got = bindings.QUERIES[name](spark, DATA)
    db = duckdb.connect()
    for t in NAMES:
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = db.execute(bindings.ORACLE[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    order = sorted(cols)
    a = sorted(repr([_plain(r[c]) for c in order]) for r in got.collect())
    b = sorted(repr([_plain(r[cols.index(c)]) for c in order]) for r in want.fetchall())
    assert a == b
