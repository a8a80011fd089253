"""Mixing sources to target weights by weighted fair queueing, with built-in functions only.

Within each source documents stand in shuffled order, and the order repeats ``max_repeats`` times.  A copy's virtual
finish time is the number of words of its source up to and with it, divided by the source's target.  All copies of all
sources are then taken in order of finish time until the budget of words is spent.

Running sums have levels: words by source and block of buckets of the shuffled order first, then by bucket, then within
buckets, so that a hot source is spread like any other.  Finish times grow evenly with the words taken, so equal steps of
time are the ranges of the global sort.  They are summed up in blocks of steps first, then those of the one block that holds
the cut; only the step that holds it is ordered row by row.  Rows that repeat id and text are summed up before.  The cut becomes one threshold for each
source and repetition, and the documents are decided in place: their texts never shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table, text_or_empty, without, word_count

OUT = ("size", "source_size", "target", "copies", "taken")
ROWS_PER_BUCKET = 1 << 9
#: Rows that a step of finish times holds on average, and buckets or steps of a block.
ROWS_PER_STEP = 1 << 12
BLOCK = 1 << 10
MAX_BROADCAST_SOURCES = 200_000


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """Share all words among sources (source, source_size) by weight; none gets over ``max_repeats`` times its size.

    Weights repeat over the sources in order of code points, null last.  In order of size to weight, the sources that
    are stopped by their size come first; the others share what is left by weight.
    """
    everything = Window.partitionBy()
    nth = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    ranked = sizes.withColumn("rank", nth).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    )
    ranked = ranked.withColumn("most", F.col("source_size") * max_repeats)
    filling = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    ranked = ranked.withColumns({
        "step": F.row_number().over(filling),
        "stopped": F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rest": F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(everything),
    })
    left = F.col("total") - F.col("stopped")
    ranked = ranked.withColumn("first", F.min(F.when(F.col("most") * F.col("rest") > F.col("weight") * left, F.col("step"))).over(everything))
    at = F.col("step") == F.col("first")
    ranked = ranked.withColumns({
        "left": F.max(F.when(at, left)).over(everything), "share": F.max(F.when(at, F.col("rest"))).over(everything),
    })
    target = F.when(F.col("step") >= F.col("first"), (F.col("weight") * F.col("left")).cast("double") / F.col("share")).otherwise(
        F.col("most").cast("double")
    )
    return ranked.select("source", "source_size", "rank", target.alias("target"), "total")


def sums_before(sums: DataFrame, at: str, words: str, *keys: str) -> DataFrame:
    """``sums`` with ``before``: the sum of ``words`` over smaller ``at`` with equal ``keys``, by blocks and then in blocks."""
    block = F.floor(F.col(at) / BLOCK).alias("block")
    over = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.groupBy(*keys, block).agg(F.sum(words).alias("n")).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("block").alias("__block"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("__first")
    )
    within = Window.partitionBy(*keys, "block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inner = sums.withColumn("block", block).withColumn("before", F.coalesce(F.sum(words).over(within), F.lit(0)))
    same = F.col("block") == F.col("__block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return inner.join(blocks, same).withColumn("before", F.col("before") + F.col("__first")).select(*sums.columns, "before")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_repeats: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Decide how often each document is taken so that the sources reach their targets.

    Adds ``size`` (words), ``source_size``, ``target`` (words, of its source), ``copies`` (0 to ``max_repeats``) and
    ``taken`` (``copies`` times ``size``).  The order within a source is the MD5 of seed, id and text, so reruns agree.

    Defined results: null text has size 0 and is taken like the documents around it; a null source is a source of
    its own, the last; rows that repeat id and text share one place and are taken together; a source without words has
    target 0; an empty table gives an empty result; input columns named as an output column are replaced.
    """
    base = without(docs, OUT)
    text = text_or_empty(text_col)
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    keyed = base.withColumns({"size": word_count(text), "__key": F.md5(F.concat(F.lit(f"{seed}:"), ident, F.lit(":"), text))})
    thin = stage_table(keyed.select(F.col(source_col).alias("source"), F.col("__key").alias("key"), "size"), "sizes")
    targets = stage_table(source_targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats), "targets")
    n_sources = targets.count()
    few = F.broadcast if n_sources <= MAX_BROADCAST_SOURCES else (lambda df: df)

    buckets = max(1, -(-thin.count() // ROWS_PER_BUCKET))
    thin = thin.groupBy("source", "key").agg(F.sum("size").alias("size"))  # rows that repeat id and text have one place
    thin = thin.withColumn("bucket", F.expr(f"CAST(CAST(conv(substring(key, 1, 8), 16, 10) AS BIGINT) * {buckets}L DIV 4294967296L AS INT)"))
    offsets = sums_before(thin.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "bucket", "words", "source")
    here = Window.partitionBy("source", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    local = thin.withColumn("here", F.sum("size").over(here))
    running = local.alias("l").join(
        offsets.alias("o"), F.col("l.source").eqNullSafe(F.col("o.source")) & (F.col("l.bucket") == F.col("o.bucket"))
    ).select("l.source", "l.key", "l.size", (F.col("before") + F.col("here")).alias("upto"))
    running = running.alias("r").join(few(targets).alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "rank", "key", "size", "upto", "source_size", "target",
    )
    running = stage_table(running, "running")

    copies = running.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    finish = (F.col("epoch") * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")
    copies = copies.where("target > 0 AND size > 0").withColumn("finish", finish)  # documents without words change no sum
    steps = max(1, -(-copies.count() // ROWS_PER_STEP))
    copies = copies.withColumn("step", F.floor(F.col("finish") * steps))
    total = targets.agg(F.max("total")).first()[0] or 0
    ranges = stage_table(copies.groupBy("step").agg(F.sum("size").alias("words")), "ranges")
    ranges = sums_before(ranges, "step", "words")
    cut, spent = ranges.where(F.col("before") + F.col("words") > total).agg(F.min("step"), F.min_by("before", "step")).first()
    full = copies.groupBy("rank", "epoch")
    if cut is None:
        within = full.agg(F.max("key").alias("last"))
    else:
        order = Window.orderBy("finish", "rank", "epoch", "key")  # of the one range that holds the cut
        over = copies.where(F.col("step") == cut).withColumn("spent", F.lit(spent) + F.sum("size").over(order))
        taken = copies.where(F.col("step") < cut).select("rank", "epoch", "key").unionByName(
            over.where(F.col("spent") <= total).select("rank", "epoch", "key")
        )
        within = taken.groupBy("rank", "epoch").agg(F.max("key").alias("last"))
    limits = targets.alias("t").join(
        within.groupBy("rank").agg(F.collect_list("last").alias("lasts")).alias("w"), F.col("t.rank") == F.col("w.rank"), "left"
    ).select(F.col("t.source").alias("__source"), "source_size", "target", "lasts")
    limits = few(stage_table(limits, "limits"))

    times = F.size(F.filter(F.coalesce("lasts", F.array().cast("array<string>")), lambda x: F.col("__key") <= x))
    return (
        keyed.join(limits, F.col(source_col).eqNullSafe(F.col("__source")), "left")
        .withColumn("copies", times).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
        .select(*[F.col(f"`{c}`") for c in base.columns], *OUT)
    )


def repeat_taken(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes.

    Defined results: documents with no copy are left out; null and repeated rows, ties and long texts are copied as they
    are; an empty table gives an empty result; all columns stay, whatever their names (one named ``__copy`` is dropped).
    """
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("__copy")


def op5_fair_queue_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, 3 * source_size AS most FROM s),
f AS (
  SELECT *, row_number() OVER o AS step, CAST(sum(source_size) OVER () AS BIGINT) AS total,
    CAST(coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS stopped,
    CAST(sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM w WINDOW o AS (ORDER BY most / weight, rank)),
k AS (SELECT step AS first, total - stopped AS left_over, rest AS share FROM f
      WHERE most * rest > weight * (total - stopped) ORDER BY step LIMIT 1),
t AS (
  SELECT f.source, f.source_size, f.rank, f.total,
    CASE WHEN f.step >= k.first THEN CAST(f.weight * k.left_over AS DOUBLE) / k.share ELSE CAST(f.most AS DOUBLE) END AS target
  FROM f LEFT JOIN k ON TRUE),
r AS (
  SELECT d.doc_id, d.key, d.size, t.source_size, t.target, t.rank, t.total,
    CAST(sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.key) AS BIGINT) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT r.*, e.epoch, CAST(e.epoch * source_size + upto AS DOUBLE) / target AS finish
  FROM r CROSS JOIN (VALUES (0), (1), (2)) e(epoch) WHERE target > 0),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, epoch, key) AS spent FROM c),
n AS (SELECT rank, key, count(DISTINCT epoch) AS copies FROM g WHERE spent <= total GROUP BY rank, key)
SELECT r.doc_id, r.size, r.source_size, r.target, CAST(coalesce(n.copies, 0) * r.size AS BIGINT) AS taken
FROM r LEFT JOIN n ON r.rank = n.rank AND r.key = n.key
"""
