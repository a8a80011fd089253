"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only on a local master without the setting (tests) a temporary folder of this machine is taken; a cluster must name one.
    """
    global _own_dir
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="lotmill-")
    return _own_dir


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/lotmill-{uuid.uuid4().hex}/{name}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give what a Python worker has freed back to the system; workers live on between tasks, beside the executor's heap."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns that clash with output names, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, A_TO_Z, A_TO_Z.lower())


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
