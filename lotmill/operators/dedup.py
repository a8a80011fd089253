"""Rows of landed pages: duplicates, recency, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_key(urls: Sequence[Column], fields: Sequence[Column]) -> Column:
    """The first link that is not empty, else the fields; tagged, so that a link never equals fields."""
    link = F.coalesce(*[F.nullif(u, F.lit("")) for u in urls])
    named = F.struct(*[f.cast("string").alias(f"f{k}") for k, f in enumerate(fields)])
    return F.coalesce(F.concat(F.lit("u:"), link), F.concat(F.lit("f:"), F.to_json(named, {"ignoreNullFields": "false"})))


def first_seen(rows: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """All rows with ``kept``: whether they are the first of their key; the others go to the rejects.

    ``order`` names columns that tell every two rows apart.  The first of a key is a minimum, taken before the shuffle, so
    that a key of very many rows is no hot task.
    """
    place = F.struct(*order)
    first = rows.groupBy(key.alias("__key")).agg(F.min(place).alias("__first"))
    return rows.withColumn("__k", key).join(first, F.col("__k") == F.col("__key")).withColumn("kept", place == F.col("__first")).drop("__k", "__key", "__first")


def recent(rows: DataFrame, today: Column, days: int, date_col: str = "notice_date") -> DataFrame:
    """Rows from the last ``days`` days; rows without a date stay."""
    return rows.where(F.col(date_col).isNull() | (F.col(date_col) >= F.date_sub(today, days)))


def pages_until(rows: DataFrame, cutoff: Column, page_col: str = "page", date_col: str = "notice_date") -> DataFrame:
    """Rows up to the first page whose dated rows are all older than ``cutoff``, that page included."""
    old = rows.groupBy(page_col).agg(F.max(date_col).alias("newest")).where(F.col("newest") < cutoff)
    stop = old.agg(F.min(page_col).alias("__stop"))  # one row
    return rows.join(F.broadcast(stop), F.col("__stop").isNull() | (F.col(page_col) <= F.col("__stop"))).drop("__stop")


def page_completeness(pages: DataFrame) -> DataFrame:
    """From (page, n_rows, total): each page that should exist with its rows, 0 and missing where it was not landed."""
    first = pages.where("page = 1").agg(F.first("total").alias("total"), F.first("n_rows").alias("per_page"))
    expected = first.select(F.explode(F.sequence(F.lit(1), F.coalesce(F.ceil(F.try_divide(F.col("total"), F.col("per_page"))), F.lit(1)).cast("int"))).alias("page"))
    return expected.join(pages.select("page", "n_rows"), "page", "left").select(
        "page", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.col("n_rows").isNull().alias("missing")
    )
