"""Stateless filters and tag histograms over streams: the batch operators, fed by ``readStream``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.operators.relational import audit


def audited(stream: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """Append mode: every row of the stream with its checks and reasons."""
    return audit(stream, checks)


def windowed_reasons(stream: DataFrame, checks: list[tuple[str, Column]], time: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts of failure reasons per window of event time; rows later than ``late`` are left out."""
    failed = audit(stream.withWatermark(time, late), checks).where("not overall_pass")
    return failed.select(F.col(time), F.explode(F.split("failure_reasons", ";")).alias("reason")).groupBy(F.window(time, width), "reason").agg(F.count(F.lit(1)).alias("n"))
