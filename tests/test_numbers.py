"""Numbers as text, against C's rules."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.functions import fields


def doubles():
    r = np.random.default_rng(12)
    some = [struct.unpack("<d", struct.pack("<q", int(x)))[0] for x in r.integers(-(2**63), 2**63 - 1, 30_000)]
    some += [float(x) for x in r.lognormal(0, 12, 30_000)] + [float(x) for x in np.round(r.random(20_000), 4)]
    # Middles between two results: 5 behind the last digit, exact ties and doubles just beside them.
    for digits in (4, 6):
        for n in r.integers(10 ** (digits - 1), 10**digits, 4000):
            for e in (-9, -7, -4, -2, -1, 0, 1, 5):
                some.append(float(f"{n}5e{e}"))
    some += [0.0, -0.0, math.inf, -math.inf, math.nan, 1.0, 9.9999995, 999999.5, 99999.95, 0.0001, 0.00009999995, 1e-5, 123456.5, 1e16, 1e15, 1.7976931348623157e308, 0.5, 2.5, 1e22, 1e23]
    return some + [math.nextafter(x, math.inf) for x in some[80_000:90_000]]


@pytest.mark.parametrize("digits", [1, 4, 6])
def test_significant_digits_as_c_prints_them(spark, digits):
    values = doubles()
    assert len(values) > 100_000
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", fields.shown(F.col("x"), digits).alias("s")).collect()
    assert [(r["x"], r["s"]) for r in rows if r["s"] != f"{r['x']:.{digits}g}"] == []


def test_shortest_digits(spark):
    values = [x for x in doubles() if not math.isfinite(x) or 1e-15 < abs(x) < 1e15 or x == 0]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", fields.shown_whole(F.col("x")).alias("s")).collect()
    wrong = [(r["x"], r["s"]) for r in rows if r["s"] != repr(r["x"])]
    assert all(float(s) == x for x, s in wrong) and len(wrong) <= len(values) / 100
    assert spark.range(1).select(fields.shown(F.lit(None).cast("double")).alias("s")).first()["s"] is None
