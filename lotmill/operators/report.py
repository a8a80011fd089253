"""Routing and report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import currency, nearest_upcoming, show_date
from ..params import DEFAULTS, PLATE, SECTIONS, STATUSES, VEHICLES, Params
from .phrases import name_places

#: Input numbers that one task orders within a section.
BLOCK = 1 << 16


def location_route(rows: DataFrame, params: Params = DEFAULTS, keywords: DataFrame | None = None, key: str = "input_seq") -> DataFrame:
    """Adds ``route``: kept, other_location or unknown_location; every row gets one.

    ``keywords`` is a table (``keyword``) of any number of further keywords, found in one pass over each location; ``key``
    tells the rows apart.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    state = F.coalesce(F.lower("state").isin([s.lower() for s in params.included_states]), F.lit(False))
    place = F.lower("location")
    word = F.coalesce(F.exists(F.array(*[F.lit(k) for k in params.included_keywords]).cast("array<string>"), lambda k: F.contains(place, k)), F.lit(False))
    if keywords is not None:
        names = keywords.select(F.lit(0).alias("ord"), F.lit("").alias("name"), F.col("keyword").alias("variant"))
        rows = name_places(rows, "location", names, key, "__keywords", bounds=False)
        word = word | (F.col("__keywords.n") > 0)
    route = F.when(empty("location") & empty("state"), "unknown_location").when(state | word, "kept").otherwise("other_location")
    return rows.withColumn("route", route).drop("__keywords")


def asset_exclusion(rows: DataFrame) -> DataFrame:
    """Adds ``excluded``: the assets name a vehicle or a registration plate.  Without a text nothing is excluded."""
    words = r"(?i)\b(?:" + "|".join(VEHICLES) + r")\b"
    text = F.col("nature_of_assets")
    return rows.withColumn("excluded", F.coalesce(text.rlike(words) | text.rlike(PLATE), F.lit(False)))


def closing(rows: DataFrame, today: Column) -> DataFrame:
    """Adds the nearest upcoming date, its field and the days until then."""
    rows = rows.withColumn("__n", nearest_upcoming(today, auction_date=F.col("auction_date"), emd_due_date=F.col("emd_due_date")))
    return rows.withColumns({
        "closing_date": F.col("__n.day"), "closing_field": F.col("__n.field"), "closing_days": F.datediff(F.col("__n.day"), today),
    }).drop("__n")


def report_sections(rows: DataFrame, today: Column, order: str = "input_seq", params: Params = DEFAULTS) -> DataFrame:
    """Long table of sections: section, nth, and the row's key; a listing may stand in several.

    Needs ``combined`` and ``status``.  The best are a top-k; other sections keep the input's order.
    """
    rows = closing(rows, today)
    top = rows.where(F.col("combined").isNotNull()).orderBy(F.col("combined").desc(), order).limit(params.top_n)
    top = top.withColumn("nth", F.row_number().over(Window.orderBy(F.col("combined").desc(), order))).select(F.lit("top_scored").alias("section"), "nth", order)
    label = {"new": "new_today", "changed": "watchlist_changes", "collision": "collisions"}
    sections = F.array_compact(F.array(
        F.when(F.col("closing_days") <= params.closing_days, "closing_soon"),
        *[F.when(F.col("status") == s, name) for s, name in label.items()],
    ))
    rest = rows.select(F.explode(sections).alias("section"), "closing_date", order)
    rest = rest.withColumn("day", F.when(F.col("section") == "closing_soon", F.col("closing_date")))
    return top.unionByName(_numbered(rest, order).select("section", "nth", order))


def _numbered(rows: DataFrame, order: str) -> DataFrame:
    """Number the rows of each section by day and ``order``: blocks of ``order`` are counted first, then their rows.

    A section may hold nearly all rows; no task holds more than a block of it.
    """
    rows = rows.withColumn("__block", F.floor(F.col(order) / BLOCK))
    upto = Window.partitionBy("section").orderBy("day", "__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("section", "day", "__block").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    inside = Window.partitionBy("section", "day", "__block").orderBy(order)
    r, b = rows.withColumn("__nth", F.row_number().over(inside)).alias("r"), blocks.alias("b")
    same = (F.col("r.section") == F.col("b.section")) & F.col("r.day").eqNullSafe(F.col("b.day")) & (F.col("r.__block") == F.col("b.__block"))
    return r.join(b, same).select("r.section", (F.col("before") + F.col("__nth")).cast("int").alias("nth"), f"r.{order}")


def section_counts(sections: DataFrame) -> DataFrame:
    """Rows of each section, zero included."""
    counts = sections.agg(*[F.count_if(F.col("section") == s).alias(s) for s in SECTIONS])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.col(s).alias("n")) for s in SECTIONS])).alias("s")).select("s.*")


LINKS = {"details_url": "details", "notice_url": "notice", "platform_url": "platform"}


def listing_cards(rows: DataFrame) -> DataFrame:
    """Facts of each listing as they are shown, with what changed, its flags and links.

    Columns that the rows do not have (``state``, ``changes``, ``card_flags``, the links' urls) count as unknown or none.
    """
    has = set(rows.columns)
    field = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    links = [F.concat(F.lit(f"{label}: "), F.col(c)) for c, label in LINKS.items() if c in has]
    lines = F.transform("changes", lambda c: F.concat(c["field"], F.lit(": "), c["old_value"], F.lit(" -> "), c["new_value"])) if "changes" in has else F.array().cast("array<string>")
    return rows.select(
        F.coalesce(field("state"), F.lit("not stated in source data")).alias("state"), F.array_join(lines, "; ").alias("changes"),
        F.array_join(F.col("card_flags") if "card_flags" in has else F.array().cast("array<string>"), "; ").alias("flags"),
        F.coalesce(F.nullif(F.concat_ws(" | ", *links), F.lit("")), F.lit("no links yet")).alias("links"),
        "input_seq", currency(F.col("reserve_price")).alias("price"), F.coalesce("location", F.lit("not yet known")).alias("location"),
        show_date(F.col("auction_date")).alias("auction_date"), show_date(F.col("emd_due_date")).alias("emd_due_date"),
        F.coalesce("ip_name", F.lit("unknown")).alias("ip_name"), F.coalesce("nature_of_assets", F.lit("unknown")).alias("nature_of_assets"),
        F.coalesce(F.col("combined").cast("decimal(9,1)").cast("string"), F.lit("no score")).alias("score"),
    )


def run_summary(changed: DataFrame, routed: DataFrame) -> DataFrame:
    """One row: statuses, enrichment routes; deferred rows count as reused, as well as on their own."""
    a = changed.agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("new", "changed", "unchanged", "collision")])
    b = routed.agg(
        F.count_if(F.col("route") == "reenrich").alias("reenriched"), F.count_if(F.col("route").isin("reuse", "deferred")).alias("reused"),
        F.count_if(F.col("route") == "deferred").alias("deferred"), F.count_if(F.col("route") == "collision").alias("skipped_collision"),
    )
    return a.join(F.broadcast(b))


def write_counted(rows: DataFrame, path: str, counts: Mapping[str, Column], whole: Mapping[str, Sequence[str]] | None = None) -> dict[str, int]:
    """Write ``rows`` to ``path`` and count in the same pass: no second scan.  Returns the counts.

    ``whole`` names counts that have to add up: of each key the listed counts, together, are that count.  Where they do
    not, rows got lost or were counted twice, and what was written is not to be used: an error says so.
    """
    seen = Observation()
    rows.observe(seen, *[c.alias(name) for name, c in counts.items()]).write.mode("overwrite").parquet(path)
    found = {name: int(n) for name, n in seen.get.items()}
    for name, parts in (whole or {}).items():
        if found[name] != sum(found[p] for p in parts):
            raise ValueError(f"{name} is {found[name]}, but {' + '.join(parts)} are {sum(found[p] for p in parts)}")
    return found


def status_counts() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1)), **{f"n_{s}": F.count_if(F.col("status") == s) for s in STATUSES}}


def route_counts() -> dict[str, Column]:
    """Enrichment routes; deferred rows count as reused, as well as on their own."""
    return {
        "rows": F.count(F.lit(1)), "reenriched": F.count_if(F.col("route") == "reenrich"), "reused": F.count_if(F.col("route").isin("reuse", "deferred")),
        "deferred": F.count_if(F.col("route") == "deferred"), "skipped_collision": F.count_if(F.col("route") == "collision"),
    }


def filter_counts() -> dict[str, Column]:
    """Listings by ``route``, and those that ``excluded`` keeps out."""
    kept_in = {r: F.count_if((F.col("route") == r) & ~F.col("excluded")) for r in ("kept", "other_location", "unknown_location")}
    return {"rows": F.count(F.lit(1)), **kept_in, "excluded": F.count_if("excluded")}


def fetch_counts() -> dict[str, Column]:
    """Sources that are fetched and those whose fields come from stored state."""
    return {"rows": F.count(F.lit(1)), **{
        f"{s}_{'fetched' if fetched else 'reused'}": F.count_if(F.col(f"need_{s}") if fetched else ~F.col(f"need_{s}"))
        for s in ("details", "notice") for fetched in (True, False)
    }}


def fetch_summary(gated: DataFrame) -> DataFrame:
    """One row: sources that are fetched and those whose fields come from stored state, of rows with ``need_details`` and ``need_notice``."""
    return gated.agg(*[
        F.count_if(F.col(f"need_{s}") if fetched else ~F.col(f"need_{s}")).alias(f"{s}_{'fetched' if fetched else 'reused'}")
        for s in ("details", "notice") for fetched in (True, False)
    ])


def filter_summary(rows: DataFrame) -> DataFrame:
    """One row: listings by ``route``, and those that ``excluded`` keeps out; the counts of routes add up to the rows."""
    return rows.agg(
        *[F.count_if((F.col("route") == r) & ~F.col("excluded")).alias(r) for r in ("kept", "other_location", "unknown_location")],
        F.count_if("excluded").alias("excluded"),
    )


def problem_lines(problems: DataFrame, most: int = 10) -> DataFrame:
    """The first problems, and how many more there are."""
    n = problems.agg(F.count("*").alias("n"))
    first = problems.orderBy("seq").limit(most).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "reason"))), lambda p: p["reason"]).alias("first"))
    return first.join(F.broadcast(n)).select("first", F.greatest(F.col("n") - most, F.lit(0)).alias("more"))
