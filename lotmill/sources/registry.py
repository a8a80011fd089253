"""Company registry: files of one state each, headers by alias, the last row of a number counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import registrar_state, strip, without_placeholder
from ..params import REGISTRY_HEADERS
from .csv_records import read_csv


def match_header(headers: Sequence[str], variants: Sequence[str]) -> str | None:
    """The header that carries a field, whatever its case; the first variant that occurs counts."""
    there = {h.lstrip("﻿").strip().lower(): h for h in headers}
    return next((there[v.strip().lower()] for v in variants if v.strip().lower() in there), None)


def normalise(raw: DataFrame, state: str | None = None) -> DataFrame:
    """Fields by alias, placeholders as NULL, upper-case numbers; rows without a number are dropped.

    Fields without a header are NULL; without a number column the file is unusable.
    """
    found = {field: match_header(raw.columns, variants) for field, variants in REGISTRY_HEADERS.items()}
    if found["cin"] is None:
        raise ValueError(f"no column of company numbers among {raw.columns}")
    fields = [
        (without_placeholder(F.col(f"`{h}`").cast("string")) if h else F.lit(None).cast("string")).alias(f) for f, h in found.items() if f != "cin"
    ]
    number = F.upper(strip(F.col(f"`{found['cin']}`")))
    extra = [F.col("file_pos")] if "file_pos" in raw.columns else [F.monotonically_increasing_id().alias("file_pos")]
    out = raw.select(number.alias("cin"), *fields, *extra).where(F.coalesce(F.col("cin"), F.lit("")) != "")
    return out.withColumn("state", F.lit(state) if state else registrar_state(F.col("cin")))


def read_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Registry of several states from CSV files: state -> path.  A file that cannot be used is an error."""
    registry, reasons = open_files(spark, paths)
    if reasons:
        raise ValueError(f"registry files that cannot be used: {reasons}")
    return registry


def open_files(spark: SparkSession, paths: Mapping[str, str]) -> tuple[DataFrame | None, dict[str, str]]:
    """Registry of the CSV files that can be used, and why the others cannot: state -> reason.

    Reasons: ``file_absent``, ``unreadable``, ``no_key`` (no column of company numbers), ``no_rows`` (none with a number).
    Values may hold line breaks, and quotes that are doubled; a file is read in as many splits as it has, and ``file_pos`` is
    the number of a row's record, whatever the splits.
    """
    parts, reasons = {}, {}
    for state, path in paths.items():
        try:
            raw = read_csv(spark, path)
        except AnalysisException as e:
            reasons[state] = "file_absent" if e.getCondition() == "PATH_NOT_FOUND" else "unreadable"
            continue
        if match_header(raw.columns, REGISTRY_HEADERS["cin"]) is None:
            reasons[state] = "no_key"
        else:
            parts[state] = normalise(raw, state)
    if not parts:
        return None, reasons
    first, *others = parts.values()
    for part in others:
        first = first.unionByName(part, allowMissingColumns=True)
    filled = {r["state"] for r in first.groupBy("state").count().collect()}  # one row a file
    return first, reasons | {state: "no_rows" for state in parts if state not in filled}


def last_rows(registry: DataFrame) -> DataFrame:
    """One row for each number, the last of its file, with ``duplicates``, the rows that it replaces."""
    last = Window.partitionBy("state", "cin")
    nth = F.row_number().over(last.orderBy(F.col("file_pos").desc()))
    return registry.withColumns({"__nth": nth, "duplicates": F.count("*").over(last) - 1}).where("__nth = 1").drop("__nth")


def _reasons(unavailable: Mapping[str, str] | Sequence[str], default: str) -> dict[str, str]:
    return dict(unavailable) if isinstance(unavailable, Mapping) else dict.fromkeys(unavailable, default)


def availability(registry: DataFrame, expected: Sequence[str], missing: Mapping[str, str] | Sequence[str] = ()) -> DataFrame:
    """For each expected state: ok, empty, or why it is missing (as ``open_files`` tells), with its rows and duplicates."""
    spark = registry.sparkSession
    why = _reasons(missing, "missing")
    states = spark.createDataFrame([(s, why.get(s)) for s in expected], "state string, gone string")
    counts = registry.groupBy("state").agg(F.count("*").alias("n_rows"), F.countDistinct("cin").alias("n_numbers"))
    status = F.when(F.col("gone").isNotNull(), F.col("gone")).when(F.col("n_rows").isNull(), "empty").otherwise("ok")
    return states.join(counts, "state", "left").select(
        "state", status.alias("status"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        (F.coalesce("n_rows", F.lit(0)) - F.coalesce("n_numbers", F.lit(0))).alias("duplicates"),
    )


def lookup(rows: DataFrame, registry: DataFrame, unavailable: Mapping[str, str] | Sequence[str] = (), fields: Sequence[str] = ("company_name", "company_status", "paidup_capital")) -> DataFrame:
    """Adds the registry's fields and, where there is no match, ``miss_reason``.

    The registry is cut down to the numbers that are looked up before the last row of each is found.
    """
    rows = rows.withColumns({"__cin": F.upper(strip(F.col("cin"))), "__state": registrar_state(F.col("cin"))})
    why = _reasons(unavailable, "file_absent")
    sought = rows.where("__state IS NOT NULL").select(F.col("__state").alias("state"), F.col("__cin").alias("cin")).distinct()
    there = registry.where(~F.col("state").isin(list(why)) if why else F.lit(True)).join(sought, ["state", "cin"], "left_semi")
    there = last_rows(there)
    there = there.select(F.col("state").alias("__s"), F.col("cin").alias("__c"), *fields)
    gone = F.try_element_at(F.create_map(*[F.lit(x) for pair in why.items() for x in pair]), F.col("__state")) if why else F.lit(None).cast("string")
    joined = rows.join(there, (F.col("__state") == F.col("__s")) & (F.col("__cin") == F.col("__c")), "left")
    reason = (
        F.when(F.coalesce(F.col("__cin"), F.lit("")) == "", "no_cin").when(F.col("__state").isNull(), "unmapped_code")
        .when(gone.isNotNull(), gone).when(F.col("__c").isNull(), "no_match")
    )
    return joined.withColumn("miss_reason", reason).withColumn("registry_state", F.col("__state")).drop("__cin", "__state", "__s", "__c")
