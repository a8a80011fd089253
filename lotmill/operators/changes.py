"""Change detection: status of each observation against what came before it, and the state that results.

The order of observations within a key is all that counts, so one window by key does what a row-at-a-time fold would:
the first observation owns the key; others of another identity are collisions and touch nothing; among the owner's, each
is compared with the one before.  Stored state stands before all observations of its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import listing_key, norm
from ..params import IDENTITY, STATUSES, TRACKED


def keyed(rows: DataFrame) -> DataFrame:
    """Adds ``listing_key``, the normalised identity and the normalised tracked fields."""
    return rows.withColumns({
        "listing_key": listing_key([F.col(c) for c in IDENTITY]),
        "__identity": F.array(*[norm(F.col(c)) for c in IDENTITY]),
        "__tracked": F.array(*[norm(F.col(c)) for c in TRACKED]),
    })


def held(state: DataFrame) -> DataFrame:
    """What change detection needs of stored state, by the key as it is stored.

    State grows with the listings, so it is merged and not sent to the driver; rows are sorted by the key in any case.
    """
    key = F.col("listing_key") if "listing_key" in state.columns else listing_key([F.col(c) for c in IDENTITY])
    return state.select(
        key.alias("listing_key"), F.array(*[norm(F.col(c)) for c in IDENTITY]).alias("__owner"), F.array(*[norm(F.col(c)) for c in TRACKED]).alias("__last"),
        F.col("reserve_price").cast("long").alias("__paid"),
    ).hint("merge")


def price_drop(old: Column, new: Column, zero_is_unknown: bool = False) -> Column:
    known = old.isNotNull() & new.isNotNull()
    if zero_is_unknown:
        known = known & (old != 0) & (new != 0)
    return F.coalesce(known & (new < old), F.lit(False))


def change_status(
    rows: DataFrame, order: Sequence[str], state: DataFrame | None = None, zero_is_unknown: bool = False
) -> DataFrame:
    """Every observation with ``status``, ``changes`` (field, old and new text) and ``price_drop``.

    ``order`` names the columns by which observations follow each other.  ``state`` holds at most one row a listing with the
    identity and tracked fields, which stand before all observations; where it is bucketed by ``listing_key``, it does not move.
    """
    now = keyed(rows)
    if state is None:
        now = now.withColumns({"__owner": F.lit(None).cast("array<string>"), "__last": F.lit(None).cast("array<string>"), "__paid": F.lit(None).cast("long")})
    else:
        now = now.join(held(state), "listing_key", "left")
    by_key = Window.partitionBy("listing_key").orderBy(*order)
    now = now.withColumn("__collides", F.col("__identity") != F.coalesce("__owner", F.first("__identity").over(by_key)))
    # the owner's observation before, in the same order as above: rows are sorted once
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(~F.col("__collides"), F.struct(F.col("__tracked").alias("tracked"), F.col("reserve_price").cast("long").alias("price"))), ignorenulls=True)
    stored = F.struct(F.col("__last").alias("tracked"), F.col("__paid").alias("price"))
    now = now.withColumn("__prior", last.over(earlier)).withColumn("__prior", F.when(~F.col("__collides"), F.coalesce("__prior", stored)))
    now = now.withColumns({"__before": F.col("__prior.tracked"), "__old_price": F.col("__prior.price")})
    status = (
        F.when(F.col("__collides"), "collision").when(F.col("__before").isNull(), "new")
        .when(F.col("__before") == F.col("__tracked"), "unchanged").otherwise("changed")
    )
    fields = F.array(*[
        F.when(
            F.get(F.col("__before"), k) != F.get(F.col("__tracked"), k),
            F.struct(F.lit(name).alias("field"), F.get(F.col("__before"), k).alias("old_value"), F.get(F.col("__tracked"), k).alias("new_value")),
        )
        for k, name in enumerate(TRACKED)
    ])
    changed = F.col("status") == "changed"
    return (
        now.withColumn("status", status)
        .withColumn("changes", F.when(changed, F.array_compact(fields)).otherwise(F.array().cast(fields_type())))
        .withColumn("price_drop", changed & price_drop(F.col("__old_price"), F.col("reserve_price"), zero_is_unknown))
        .drop("__identity", "__tracked", "__owner", "__last", "__paid", "__collides", "__prior", "__before", "__old_price")
    )


def fields_type() -> str:
    return "array<struct<field: string, old_value: string, new_value: string>>"


def preview(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Status of each row against stored state alone: rows of the same key do not see each other."""
    status = (
        F.when(F.col("__owner").isNull(), "new").when(F.col("__owner") != F.col("__identity"), "collision")
        .when(F.col("__last") == F.col("__tracked"), "unchanged").otherwise("changed")
    )
    return keyed(rows).join(held(state), "listing_key", "left").withColumn("status", status).drop("__identity", "__tracked", "__owner", "__last", "__paid")


def history(changed: DataFrame, at: str) -> DataFrame:
    """One row for each field that changed; values as they were compared."""
    return changed.where("status = 'changed'").select("listing_key", F.col(at).alias("changed_at"), "input_seq", "price_drop", F.explode("changes").alias("c")).select(
        "listing_key", "changed_at", "input_seq", "c.field", "c.old_value", "c.new_value",
        ((F.col("c.field") == "reserve_price") & F.col("price_drop")).alias("is_price_drop"),
    )


def final_state(changed: DataFrame, order: Sequence[str], at: str, carried: Sequence[str] = (), raw: Sequence[str] = (*IDENTITY, *TRACKED)) -> DataFrame:
    """State after the observations: identity and first sight from the owner's first, the rest from the owner's last.

    ``raw_json`` holds the columns ``raw`` of the owner's last observation that was new or changed.
    """
    own = changed.where("status <> 'collision'")
    rank = F.struct(*order)
    moved = F.col("status").isin("new", "changed")
    together = lambda columns: F.struct(*[F.col(c) for c in columns])
    found = own.groupBy("listing_key").agg(
        F.min_by(together(IDENTITY), rank).alias("__first"), F.max_by(together((*TRACKED, *carried)), rank).alias("__last"),
        F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.max(F.when(moved, F.col(at))).alias("last_changed"),
        F.count("*").alias("observations"), F.max_by(F.when(moved, together(raw)), F.when(moved, rank)).alias("__raw"),
    )
    return found.select(
        "listing_key", *[F.col("__first")[c].alias(c) for c in IDENTITY], *[F.col("__last")[c].alias(c) for c in (*TRACKED, *carried)],
        "first_seen", "last_seen", "last_changed", "observations", F.to_json("__raw", {"ignoreNullFields": "false"}).alias("raw_json"),
    )


def merge_state(old: DataFrame, new: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Stored state overlaid by ``final_state`` of a later run; first sight and identity stay with the older."""
    o, n = old.alias("o"), new.alias("n")
    pick = lambda c, first, second: F.when(F.col(f"{first}.listing_key").isNotNull(), F.col(f"{first}.{c}")).otherwise(F.col(f"{second}.{c}")).alias(c)
    return o.join(n, F.col("o.listing_key") == F.col("n.listing_key"), "full").select(
        pick("listing_key", "n", "o"), *[pick(c, "o", "n") for c in (*IDENTITY, "first_seen")],
        *[pick(c, "n", "o") for c in (*TRACKED, *carried, "last_seen")],
        F.greatest("o.last_changed", "n.last_changed").alias("last_changed"),
        (F.coalesce("o.observations", F.lit(0)) + F.coalesce("n.observations", F.lit(0))).alias("observations"),
        F.coalesce("n.raw_json", "o.raw_json").alias("raw_json"),  # a run without a change leaves what is stored
    )


def status_summary(changed: DataFrame) -> DataFrame:
    """Count of each status, zero included."""
    counts = changed.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in STATUSES])).alias("s")).select("s.*")
