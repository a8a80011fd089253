"""Incremental work: what to fetch, what to enrich, what to keep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import NARRATIVE_KEYS
from .phrases import containing


def refetch_gate(previewed: DataFrame, state: DataFrame) -> DataFrame:
    """Adds ``need_details`` and ``need_notice``: new, changed or colliding, or never parsed with success."""
    old = state.select("listing_key", F.col("details_parsed").alias("__d"), F.col("notice_parsed").alias("__n"))
    fresh = F.col("status").isin("new", "changed", "collision")
    rows = previewed.join(old, "listing_key", "left")
    return rows.withColumns({
        "need_details": fresh | ~F.coalesce("__d", F.lit(False)), "need_notice": fresh | ~F.coalesce("__n", F.lit(False)),
    }).drop("__d", "__n")


def reuse_fields(rows: DataFrame, state: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fields of rows that are not fetched again come from stored state.

    ``groups`` names, for each gate column, the fields that its source fills.
    """
    wanted = [f for fields in groups.values() for f in fields]
    old = state.select("listing_key", F.lit(True).alias("__known"), *[F.col(f).alias(f"__{f}") for f in wanted])
    rows = rows.join(old, "listing_key", "left")
    for gate, fields in groups.items():
        keep = F.coalesce(F.col("__known") & ~F.col(gate), F.lit(False))
        rows = rows.withColumns({f: F.when(keep, F.col(f"__{f}")).otherwise(F.col(f)) for f in fields})
        rows = rows.withColumn(f"{gate}_reused", keep)
    return rows.drop("__known", *[f"__{f}" for f in wanted])


def enrichment_route(rows: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Adds ``route`` (collision, reenrich or reuse), ``has_row`` and ``reason``.

    Collisions are set aside.  Others are enriched again when new or changed, without a stored row, or when a source was
    parsed that was not at the last enrichment; a flag that is not stored counts as not parsed.
    """
    old = enrichment.select("listing_key", F.lit(True).alias("__has"), F.col("details_at_enrich").alias("__d"), F.col("notice_at_enrich").alias("__n"))
    rows = rows.join(old, "listing_key", "left")
    has = F.coalesce("__has", F.lit(False))
    reason = (
        F.when(F.col("status") == "collision", "collision").when(F.col("status").isin("new", "changed"), "status").when(~has, "no_row")
        .when(F.col("details_parsed") & ~F.coalesce("__d", F.lit(False)), "details_parsed")
        .when(F.col("notice_parsed") & ~F.coalesce("__n", F.lit(False)), "notice_parsed")
    )
    route = F.when(reason == "collision", "collision").when(reason.isNotNull(), "reenrich").otherwise("reuse")
    return rows.withColumns({"has_row": has, "reason": reason, "route": route}).drop("__has", "__d", "__n")


def cap_enrichment(routed: DataFrame, cap: int, order: Sequence[str]) -> DataFrame:
    """At most ``cap`` rows stay ``reenrich``, those never enriched first; the others become ``deferred``.

    The first ``cap`` are a top-k, which every task cuts down for itself; no task sees all candidates.  ``order`` has to tell
    rows apart (end it with a key): rows of equal order at the cap would all stay.
    """
    keys = ["has_row", *order]
    chosen = routed.where("route = 'reenrich'").select(*keys).orderBy(*keys).limit(cap).agg(F.max(F.struct(*keys)).alias("__last"), F.count("*").alias("__n"))
    over = (F.col("route") == "reenrich") & (F.col("__n") == cap) & (F.struct(*keys) > F.col("__last"))
    return routed.join(F.broadcast(chosen)).withColumn("route", F.when(over, "deferred").otherwise(F.col("route"))).drop("__last", "__n")


def merge_enrichment(old: DataFrame, new: DataFrame, modules: Sequence[str], at: Column) -> DataFrame:
    """New results over stored ones; a module that did not run (NULL) keeps its stored result and time.

    ``<module>_attempted`` says whether it ever ran; the parse flags become the snapshot for the next decision.
    """
    o, n = old.alias("o"), new.alias("n")
    isnew = F.col("n.listing_key").isNotNull()
    cols = [F.coalesce("n.listing_key", "o.listing_key").alias("listing_key")]
    for m in modules:
        ran = F.col(f"n.{m}").isNotNull()
        cols += [
            F.coalesce(f"n.{m}", f"o.{m}").alias(m), F.when(ran, at).otherwise(F.col(f"o.{m}_at")).alias(f"{m}_at"),
            (ran | F.coalesce(f"o.{m}_attempted", F.lit(False))).alias(f"{m}_attempted"),
        ]
    for flag in ("details", "notice"):
        cols.append(F.when(isnew, F.col(f"n.{flag}_parsed")).otherwise(F.col(f"o.{flag}_at_enrich")).alias(f"{flag}_at_enrich"))
    return o.join(n, F.col("o.listing_key") == F.col("n.listing_key"), "full").select(*cols)


#: Phrases of so many signs in all are looked up by automata; more are looked up by their words.
MAX_PHRASE_CHARS = 1 << 23
#: Words that are broadcast at most: some 10 MB.
MAX_WORDS = 200_000


def _few(words: DataFrame) -> DataFrame:
    """Words, to be broadcast where they are few enough."""
    return F.broadcast(words) if words.limit(MAX_WORDS + 1).count() <= MAX_WORDS else words


def _by_words(phrases: DataFrame, docs: DataFrame, entity: str) -> DataFrame:
    """Phrases (``entity``, tier, phrase) and the documents that contain them, for more phrases than automata hold.

    A phrase is looked up by one word: of the words inside it (not at its edges, where they may be parts of longer words) by
    the one that the fewest documents have; where there is none, by each word of the corpus that its longer edge may be a
    part of.  All joins are equi joins, the rarest words come first, and ``contains`` settles what meets.
    """
    in_docs = docs.select("doc_id", F.explode(F.array_distinct(F.split("body", r"\s+"))).alias("word")).where("word <> ''")

    words = F.filter(F.split("phrase", r"\s+"), lambda w: w != "")
    size = F.size(words)
    phrases = phrases.select(entity, "tier", "phrase", words.alias("words"))
    inner = phrases.where(size > 2).select(entity, "tier", "phrase", F.explode(F.array_distinct(F.slice("words", 2, size - 2))).alias("word"))
    sought = inner.select("word").distinct()
    counts = in_docs.join(_few(sought), "word").groupBy("word").agg(F.count("*").alias("n"))
    rarest = inner.join(counts, "word", "left").groupBy(entity, "tier", "phrase").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("word"))

    first, last = F.element_at("words", 1), F.element_at("words", -1)
    side = F.when(F.size("words") == 1, "any").when(F.length(first) >= F.length(last), "end").otherwise("start")
    edges = phrases.where(F.size("words") <= 2).select(entity, "tier", "phrase", side.alias("side"), F.when(side == "start", last).otherwise(first).alias("edge"))
    lengths = edges.groupBy("side").agg(F.collect_set(F.length("edge")).alias("lengths"))  # three rows
    of = in_docs.select("word").distinct().join(F.broadcast(lengths))
    starts = lambda n: F.when(F.col("side") == "start", F.array(F.lit(1))).when(F.col("side") == "end", F.array(F.length("word") - n + 1)).otherwise(F.sequence(F.lit(1), F.length("word") - n + 1))
    fitting = F.filter("lengths", lambda n: n <= F.length("word"))
    parts = F.flatten(F.transform(fitting, lambda n: F.transform(starts(n), lambda k: F.substring(F.col("word"), k, n))))
    around = of.select("word", "side", F.explode(F.array_distinct(parts)).alias("edge")).join(edges.select("side", "edge").distinct(), ["side", "edge"])
    listed = rarest.unionByName(edges.join(around, ["side", "edge"]).select(entity, "tier", "phrase", "word"))
    met = in_docs.join(_few(listed.select("word").distinct()), "word")
    return met.join(listed, "word").select(entity, "tier", "phrase", "doc_id").join(docs, "doc_id").where(F.contains("body", "phrase"))


def tiered_search(
    tiers: DataFrame, corpus: DataFrame, hits: int, entity: str = "item_id", doc_id: str = "doc_id", text: str = "text", max_phrase_chars: int = MAX_PHRASE_CHARS,
) -> DataFrame:
    """First tier with a hit for each entity and its first ``hits`` documents; entities without any get one row of NULLs.

    A phrase hits a document that contains it; a phrase without a word hits none.  Automata over the phrases pass over each
    body where it lies.  Phrases of more than ``max_phrase_chars`` signs in all, which would take too many passes, are looked
    up by their words instead.
    """
    docs = corpus.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    phrases = tiers.select(entity, "tier", "phrase").where(F.col("phrase").rlike(r"[^ \t\n\x0B\f\r]"))
    if phrases.agg(F.coalesce(F.sum(F.length("phrase")), F.lit(0))).first()[0] <= max_phrase_chars:
        found = containing(docs, phrases, hits).join(phrases, "phrase")
    else:
        found = _by_words(phrases, docs, entity)
    found = found.select(entity, "tier", "doc_id").distinct()
    best = Window.partitionBy(entity).orderBy("tier", "doc_id")
    chosen = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= hits)
    chosen = chosen.withColumn("__t", F.min("tier").over(Window.partitionBy(entity))).where(F.col("tier") == F.col("__t")).drop("__t")
    everyone = tiers.select(entity).distinct()
    flag = F.when(F.col("tier").isNull(), "search.exhausted").when(F.col("tier") > 1, "search.broadened")
    return everyone.join(chosen, entity, "left").select(entity, "tier", "doc_id", "nth", flag.alias("flag"))


PROMPT = (
    "Read one auction listing. Use the fields below only: no outside knowledge, no guesses, no market prices. "
    "Say so where a field is null.\n\n%s\n\nAnswer with one JSON object with the keys " + ", ".join(NARRATIVE_KEYS) + "."
)


def assemble(changed: DataFrame, routed: DataFrame, enrichment: DataFrame, key: str = "input_seq") -> DataFrame:
    """One entry for each observation: its status, changes and price drop, its enrichment, and whether that was reused.

    ``changed`` comes from ``change_status``, ``routed`` (by ``key``) from ``enrichment_route``.  Colliding entries get no
    enrichment, as it belongs to another listing, and a flag that says so.
    """
    routes = routed.select(F.col(key).alias("__key"), "route")
    stored = enrichment.select(F.col("listing_key").alias("__stored"), "narrative")
    rows = changed.join(routes, F.col(key) == F.col("__key"), "left").join(stored, F.col("listing_key") == F.col("__stored"), "left")
    collides = F.col("status") == "collision"
    return rows.withColumns({
        "narrative": F.when(~collides, F.col("narrative")), "enrichment_reused": F.coalesce(F.col("route").isin("reuse", "deferred"), F.lit(False)),
        "entry_flags": F.when(collides, F.array(F.lit("enrichment.skipped_collision"))).otherwise(F.array().cast("array<string>")),
    }).drop("__key", "__stored", "route")


def prompts(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Adds ``prompt``; fields that are null stay visible in it."""
    shown = F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})
    return rows.withColumn("prompt", F.format_string(PROMPT, shown))


def parse_responses(rows: DataFrame, text: str = "response") -> DataFrame:
    """Adds ``narrative`` and flags from model answers; code fences do not count, and an answer that is no object is NULL."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.col(text)), r"^`{3,}\s*(?i:json)?|`{3,}$", ""), r"^\s+|\s+$", "")
    schema = "struct<summary: string, price_read: string, risk_notes: array<string>, data_gaps: array<string>>"
    keys = F.json_object_keys(bare)
    missing = F.array_except(F.array(*[F.lit(k) for k in NARRATIVE_KEYS]), keys)
    broken = F.col(text).isNull() | keys.isNull()
    return rows.withColumns({
        "narrative": F.when(~broken, F.from_json(bare, schema)),
        "narrative_flags": F.when(broken, F.array(F.lit("narrative.unparseable"))).otherwise(F.transform(missing, lambda k: F.concat(F.lit("narrative.missing."), k))),
    })
