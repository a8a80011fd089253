"""JSON of any shape as VARIANT: unknown keys survive, and a changed type is told apart from a missing value."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FENCES = r"^`{3,}\s*(?i:json)?|`{3,}$"


def as_variant(text: Column) -> Column:
    """Model answers and stored snapshots; code fences do not count, and what is no JSON is NULL."""
    return F.try_parse_json(F.regexp_replace(F.regexp_replace(F.trim(text), FENCES, ""), r"^\s+|\s+$", ""))


def typed(rows: DataFrame, variant: str, fields: Mapping[str, str], flags: str = "type_flags") -> DataFrame:
    """Adds a column for each of ``fields`` (name: type) of a VARIANT, and ``flags`` of those that are there but of another type.

    Texts are taken from texts only; other types as they cast.

    Defined results: a key that is missing or null is NULL without a flag; a value that cannot be cast is NULL with the flag
    ``<name>.type``; a NULL variant, or one that is no object, has no fields; other keys stay in the variant.
    """
    there = {name: F.try_variant_get(F.col(variant), f'$["{name}"]', "variant") for name in fields}
    value = {name: F.try_variant_get(F.col(variant), f'$["{name}"]', kind) for name, kind in fields.items()}
    value |= {name: F.when(F.schema_of_variant(there[name]) == "STRING", value[name]) for name, kind in fields.items() if kind == "string"}
    changed = [F.when(value[n].isNull() & there[n].isNotNull() & ~F.is_variant_null(there[n]), f"{n}.type") for n in fields]
    return rows.withColumns({**value, flags: F.array_compact(F.array(*changed))})


def extra_keys(rows: DataFrame, variant: str, key: str, known: list[str]) -> DataFrame:
    """(``key``, ``name``, ``value`` as JSON, ``type``): what objects hold beside the known keys."""
    values = each_value(rows, variant, key)
    return values.where(~F.col("name").isin(known))


def each_value(rows: DataFrame, variant: str, key: str) -> DataFrame:
    """(``key``, ``name``, ``value`` as JSON, ``type``) of each key of the objects in a VARIANT column."""
    spark = rows.sparkSession
    held = rows.select(F.col(key), F.col(variant).alias("__v")).where("__v IS NOT NULL AND schema_of_variant(__v) LIKE 'OBJECT%'")
    held = held.select(F.col(key).alias("__key"), "__v")
    values = held.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer()))
    return values.select(F.col("__key").alias(key), F.col("key").alias("name"), F.to_json("value").alias("value"), F.schema_of_variant("value").alias("type"))


def shape(rows: DataFrame, variant: str, by: list[str]) -> DataFrame:
    """The schema that all values of a group have in common, and how many there are."""
    return rows.groupBy(*by).agg(F.count(variant).alias("n"), F.schema_of_variant_agg(variant).alias("shape"))
