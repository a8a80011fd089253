"""Stored tables: state that gains columns, append-only logs, report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import change_status, final_state, history, keyed, merge_state
from ..operators.enrich import merge_enrichment
from .keyed import KeyedTable

NARRATIVE = "struct<summary: string, price_read: string, risk_notes: array<string>, data_gaps: array<string>>"
HITS = "array<struct<title: string, url: string, snippet: string>>"


def conform(stored: DataFrame, schema: T.StructType) -> DataFrame:
    """Older tables under a newer schema: columns that are missing are NULL, flags False; others are cast."""
    there = {c.lower(): c for c in stored.columns}

    def column(field: T.StructField) -> Column:
        if field.name.lower() in there:
            return F.col(there[field.name.lower()]).cast(field.dataType).alias(field.name)
        empty = F.lit(False) if isinstance(field.dataType, T.BooleanType) else F.lit(None)
        return empty.cast(field.dataType).alias(field.name)

    return stored.select(*[column(f) for f in schema.fields])


def as_json(df: DataFrame) -> Column:
    """The whole row as JSON text; NULLs stay visible."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def typed_enrichment(rows: DataFrame) -> DataFrame:
    """JSON texts of older enrichment tables as typed columns; what does not parse is NULL."""
    return rows.withColumns({"narrative": F.from_json("narrative", NARRATIVE), "hits": F.from_json("hits", HITS)})


def replace_batch(rows: DataFrame, path: str, writer: str, batch_no: int, partition_by: Sequence[str] = ()) -> None:
    """Rows of a batch of a writer in an append-only log; the same batch again replaces what it wrote, and nothing else."""
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/writer={writer}/batch_no={batch_no}")


def append_history(changed: DataFrame, at: str, path: str, writer: str, batch_no: int) -> None:
    """One row for each changed field of a batch, below its day."""
    replace_batch(history(changed, at), path, writer, batch_no, ["changed_at"])


def collisions(changed: DataFrame, state: DataFrame, at: str) -> DataFrame:
    """Colliding observations beside the listing that owns their key, both as JSON, unresolved."""
    hits = changed.where("status = 'collision'")
    incoming = hits.select("listing_key", F.col(at).alias("detected_at"), as_json(hits.drop("changes")).alias("incoming_json"))
    existing = state.select("listing_key", as_json(state).alias("existing_json")).hint("merge")  # it grows with the listings
    return incoming.join(existing, "listing_key", "left").select(
        "listing_key", "detected_at", "existing_json", "incoming_json", F.lit(False).alias("resolved"), F.lit(None).cast("string").alias("resolution_note")
    )


def append_collisions(changed: DataFrame, state: DataFrame, at: str, path: str, writer: str, batch_no: int) -> None:
    """Collisions of a batch with the listings that they collide with."""
    replace_batch(collisions(changed, state, at), path, writer, batch_no)


def apply_batch(table: KeyedTable, batch: DataFrame, batch_no: int, order: Sequence[str], at: str, logs: str, writer: str = "batch") -> DataFrame:
    """Statuses of a batch against the table as it was before; the table, its history and its collisions move on.

    Work is in proportion to the batch and the buckets that it touches.  The same batch again leaves everything as it is.
    """
    spark = table.spark
    touched = table.touched(keyed(batch))
    old = table.read(batch_no, touched)
    path = f"{logs}/changes"
    replace_batch(change_status(batch, order, old), path, writer, batch_no)
    changed = spark.read.parquet(f"{path}/writer={writer}/batch_no={batch_no}")
    append_history(changed, at, f"{logs}/history", writer, batch_no)
    new = final_state(changed, order, at)
    table.write(merge_state(old, new), batch_no)
    append_collisions(changed, table.read(batch_no + 1, touched), at, f"{logs}/collisions", writer, batch_no)
    return changed


def upsert_enrichment(table: KeyedTable, new: DataFrame, batch_no: int, modules: Sequence[str], at: Column) -> None:
    """Enrichment results of a batch over the stored ones; the same batch again leaves the table as it is."""
    table.merge(new, batch_no, lambda old, batch: merge_enrichment(old, batch, modules, at))


def write_report(table: DataFrame, report_date: Column, path: str) -> None:
    """A report table under its date; the same date again replaces that date only."""
    table.withColumn("report_date", report_date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date").parquet(path)
