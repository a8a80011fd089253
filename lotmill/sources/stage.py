"""Tables between two steps, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master without that setting (tests) takes a temporary folder of this machine."""
    global _own
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _own is None:
        _own = "file://" + tempfile.mkdtemp(prefix="lotmill-")
    return _own


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lotmill-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: worked out once, however often it is read, and kept when executors are lost."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
