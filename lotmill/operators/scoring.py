"""Scores of listings.  What is unknown scores neutral or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import area_mentions, blank, flags, land_class, mean_known, plot_size, possession, round1
from ..params import DEFAULTS, POSSESSION_SCORES, Params


#: Ranges of prices within each doubling.
RANGES = 64


def _percentile(less: Column, equal: Column, n: Column) -> Column:
    share = F.when(n > 1, (less + 0.5 * (equal - 1)) / (n - 1)).otherwise(0.5)
    return round1((1 - share) * 100)


def price_flag(price: Column) -> Column:
    return F.when(price.isNull(), "price.missing").when(price == 0, "price.placeholder_zero").when(price < 0, "price.negative")


def price_percentile(rows: DataFrame, batch: str | None = None, price: str = "reserve_price") -> DataFrame:
    """Adds ``price_score``: 100 for the lowest price of the batch, 0 for the highest, ties by average rank.

    Prices that are NULL or not above zero have no score and are nobody's peers.  Without ``batch`` all rows are one.
    No task holds a batch: equal prices become one row before they are shuffled, prices fall into ranges that follow from
    the price alone, and each range is told how many rows lie before it.
    """
    group = F.col(batch) if batch else F.lit(0)
    known = rows.where(F.col(price) > 0)
    counts = known.groupBy(group.alias("__b"), F.col(price).alias("__p")).agg(F.count("*").alias("equal"))
    counts = counts.withColumn("__r", F.floor(F.log2("__p") * RANGES))
    ranges = counts.groupBy("__b", "__r").agg(F.sum("equal").alias("n"))
    before = Window.partitionBy("__b").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # at most 64 * RANGES rows
    starts = ranges.select("__b", "__r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy("__b")).alias("n"))
    inside = Window.partitionBy("__b", "__r").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("before", F.coalesce(F.sum("equal").over(inside), F.lit(0)))
    ranked = ranked.alias("c").join(starts.alias("s"), F.col("c.__b").eqNullSafe(F.col("s.__b")) & F.col("c.__r").eqNullSafe(F.col("s.__r")))  # plain equality would filter one use of the counts and have them taken twice
    ranked = ranked.select("c.__b", "c.__p", _percentile(F.col("start") + F.col("before"), F.col("equal"), F.col("n")).alias("price_score"))
    out = rows.join(ranked, group.eqNullSafe(F.col("__b")) & (F.col(price) == F.col("__p")), "left").drop("__b", "__p")
    return out.withColumn("price_flag", price_flag(F.col(price)))


def location_score(rows: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds ``location_score`` and ``matched_region``, the first preferred region that the location names."""
    lower = F.lower("location")
    region = F.coalesce(F.lit(None).cast("string"), *[F.when(lower.contains(r.lower()), r) for r in params.preferred_regions])
    return rows.withColumns({
        "matched_region": region, "location_score": F.lit(params.neutral) + F.when(region.isNotNull(), params.bonus).otherwise(0),
        "location_flag": F.when(blank(F.col("location")), "location.unknown"),
    })


def possession_score(rows: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds possession (of the notice only), land class (of the notice, or of the assets without one) and their scores."""
    text, usable, land = F.col("notice_text"), F.col("__usable"), F.col("land_classification")
    rows = rows.withColumns({"__p": possession(text), "__usable": ~blank(text)})
    rows = rows.withColumn("__told", F.when(usable, text).otherwise(F.col("nature_of_assets"))).withColumn("land_classification", land_class(F.col("__told")))
    preferred = F.coalesce(F.lower(land).isin([c.lower() for c in params.preferred_land_classes]), F.lit(False)) if params.preferred_land_classes else F.lit(False)
    rows = rows.withColumns({
        "possession_status": F.col("__p.status"),
        "possession_flags": flags(
            F.when(usable, F.col("__p.flag")).otherwise("possession.no_text"), F.when(land.isNull(), "land.none"), F.when(land.isNotNull() & ~usable, "land.from_assets"),
        ),
    })
    known = F.when(F.col("possession_status") == "physical", POSSESSION_SCORES["physical"]).when(F.col("possession_status") == "symbolic", POSSESSION_SCORES["symbolic"])
    return rows.withColumns({
        "possession_score": known.otherwise(POSSESSION_SCORES[None]), "land_score": F.lit(params.neutral) + F.when(preferred, params.bonus).otherwise(0),
    }).drop("__p", "__usable", "__told")


def plot_score(rows: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds the mentions, ``plot_sqft``, ``plot_flags`` and ``plot_score``."""
    rows = rows.withColumn("plot_area_mentions", area_mentions(F.col("nature_of_assets")))
    rows = rows.withColumn("__s", plot_size(F.col("plot_area_mentions"))).withColumns({"plot_sqft": F.col("__s.sqft"), "plot_flags": F.col("__s.flags")})
    large = F.lit(False) if params.min_plot_sqft is None else F.coalesce(F.col("plot_sqft") >= params.min_plot_sqft, F.lit(False))
    return rows.withColumn("plot_score", F.lit(params.neutral) + F.when(large, params.bonus).otherwise(0)).drop("__s")


def combined_score(rows: DataFrame, batch: str, params: Params = DEFAULTS) -> DataFrame:
    """All scores; parts are rounded before they are averaged, and the average again."""
    rows = plot_score(possession_score(location_score(price_percentile(rows, batch), params), params), params)
    rows = rows.withColumns({
        "score_a": mean_known(F.col("price_score"), F.col("location_score")),
        "score_b": mean_known(F.col("possession_score"), F.col("land_score")), "score_c": F.col("plot_score").cast("double"),
    })
    return rows.withColumn("combined", mean_known(F.col("score_a"), F.col("score_b"), F.col("score_c")))
