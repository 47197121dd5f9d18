"""Tables between two jobs, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDERS: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a temporary folder stands in where that is unset and driver and tasks are one process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _OWN_FOLDERS.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="locusmill-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: lineage is cut, and a lost executor loses nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
