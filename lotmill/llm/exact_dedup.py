"""Exact de-duplication by two-pass Bloom filtering, with built-in functions only.

Pass one hashes every text to two slots of a bit space and keeps the slots that were hit more than once, as bitmaps.  Hashes
that hit such slots only may be repeated: these alone are shuffled, by the SHA-256 of their text, and settled exactly (pass
one moves slot numbers beside them, counted before they move).  Pass two tests every row against a filter of the texts that
are repeated.  A row that misses it has no copy and passes straight through, without any shuffle; the others meet their group.

No filter is larger than ``max_filter_bits`` (64 MB by default, the bound of what is broadcast), a power of two up to 2**31.
Pass one takes ``bits_per_row`` bits a row where they fit.  Where fewer than ``LEAST_BITS`` would be left, the space of hashes
is cut into ranges, each with a filter of its own; hashes are stored in order within each task, so that a range reads its own
part of them, and texts are read no more often.  At b bits an entry, two slots let a row without a copy through to the shuffle
with probability (1 - exp(-2 / b)) squared, 0.01 at 16 bits and 0.15 at 4.  The filter of pass two fills with repeated texts
only, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage_path, stage_table, text_or_empty, without

#: Bits a row below which pass one is cut into ranges of hashes.
LEAST_BITS = 4
OUT = ("keep_id", "group_size", "kept", "text_sha256")


def _bit_set(bitmap: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set; False where there is no bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))) != 0, F.lit(False))


def _slots(bits: int) -> dict[str, Column]:
    """Two positions of a hash among ``bits``; mixed again, so that a range of hashes still meets all positions."""
    mixed = F.xxhash64("__hash")
    return {
        "__slot1": mixed.bitwiseAND(F.lit(bits - 1)),
        "__slot2": F.shiftrightunsigned(mixed, 32).bitwiseAND(F.lit(bits - 1)),
    }


def _filter(hashes: DataFrame, bits: int, least: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the slots that ``hashes`` hit ``least`` times or more; ``bits / 8`` bytes at most."""
    slots = (
        hashes.select(F.explode(F.array(*_slots(bits).values())).alias("slot")).groupBy("slot").count().where(F.col("count") >= least)
    )
    bitmaps = slots.groupBy(F.call_function("bitmap_bucket_number", F.col("slot")).alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("slot"))).alias("bitmap")
    )
    return stage_table(bitmaps, "bloom")


def _tested(df: DataFrame, bloom: DataFrame, bits: int) -> DataFrame:
    """``__maybe``: both slots are set."""
    df = df.withColumns(_slots(bits))
    for k in ("1", "2"):
        slot = F.col(f"__slot{k}")
        part = F.broadcast(bloom.select(F.col("bucket").alias(f"__bucket{k}"), F.col("bitmap").alias(f"__bitmap{k}")))
        df = df.join(part, F.call_function("bitmap_bucket_number", slot) == F.col(f"__bucket{k}"), "left")
        df = df.withColumn(f"__hit{k}", _bit_set(F.col(f"__bitmap{k}"), F.call_function("bitmap_bit_position", slot)))
        df = df.drop(f"__bucket{k}", f"__bitmap{k}")
    return df.withColumn("__maybe", F.col("__hit1") & F.col("__hit2")).drop("__hit1", "__hit2", "__slot1", "__slot2")


def _filter_bits(entries: int, bits_per_row: int, max_filter_bits: int) -> int:
    return min(1 << max(15, (entries * bits_per_row - 1).bit_length()), max_filter_bits)


def maybe_repeated(thin: DataFrame, bits_per_row: int, max_filter_bits: int) -> DataFrame:
    """The rows of ``thin`` whose ``__hash`` may occur twice, stored; the others have no copy."""
    spark, rows = thin.sparkSession, thin.count()
    ranges = max(1, -(-rows * LEAST_BITS // max_filter_bits))
    bits = _filter_bits(-(-rows // ranges), bits_per_row, max_filter_bits)
    path = stage_path(spark, "maybe")
    for k in range(ranges):
        first, last = -(2**63) + 2**64 * k // ranges, -(2**63) + 2**64 * (k + 1) // ranges - 1
        part = thin if ranges == 1 else thin.where(F.col("__hash").between(first, last))
        _tested(part, _filter(part, bits, 2), bits).where("__maybe").drop("__maybe").write.parquet(f"{path}/{k}")
    return spark.read.schema(thin.schema).parquet(*[f"{path}/{k}" for k in range(ranges)])


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 16,
    max_filter_bits: int = 2**29,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Mark, for every row, the row of the same text that stays.

    Texts are equal when identical after lower-casing A-Z.  Of equal texts the row with the largest id stays.
    Adds ``keep_id`` (id of the row that stays), ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text)
    to all columns, or to those in ``columns``; where these leave the text out, texts are read and hashed once only.

    Defined results: a null text counts as empty; a null id is smaller than any other, and where all ids of a group
    are null, ``keep_id`` is null; of rows that repeat both text and id exactly one is kept; an empty table gives an
    empty result; input columns named as an output column are replaced.
    """
    base = without(docs, OUT)
    rows = base.withColumn("__text", ascii_lower(text_or_empty(text_col)))
    rows = rows.withColumns({"text_sha256": F.sha2("__text", 256), "__hash": F.xxhash64("__text")}).drop("__text")
    if columns is not None:
        asked = {c.lower() for c in columns} | {id_col.lower()}
        base = base.select([F.col(f"`{c}`") for c in base.columns if c.lower() in asked])
        rows = rows.select(*[F.col(f"`{c}`") for c in base.columns], "text_sha256", "__hash")
    hashes = ("text_sha256", "__hash")
    if text_col.lower() in {c.lower() for c in base.columns}:
        thin = stage_table(rows.select(id_col, *hashes).sortWithinPartitions("__hash"), "hashes")
    else:
        thin = rows = stage_table(rows.sortWithinPartitions("__hash"), "hashes")
    thin = thin.select(F.col(id_col).alias("__id"), *hashes)

    groups = (  # of two rows at least; summed up before the shuffle, so that a hot text is no hot task
        maybe_repeated(thin, bits_per_row, max_filter_bits)
        .groupBy("text_sha256", "__id").agg(F.count("*").alias("same"), F.min("__hash").alias("__hash"))
        .groupBy("text_sha256")
        .agg(
            F.sum("same").alias("__size"), F.max("__id").alias("__keep"), F.max_by("same", "__id").alias("__winners"),
            F.min("__hash").alias("__hash"),
        )
        .where("__size > 1")
        .select("text_sha256", "__hash", "__size", "__keep", F.coalesce("__winners", "__size").alias("__winners"))
    )
    repeated = stage_table(groups, "groups")
    bits = _filter_bits(repeated.count(), bits_per_row, max_filter_bits)
    marked = _tested(rows, _filter(repeated, bits, 1), bits).drop("__hash")
    groups = repeated.drop("__hash")
    once = marked.where("NOT __maybe").select(
        *[F.col(f"`{c}`") for c in base.columns], F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    joined = marked.where("__maybe").join(groups, "text_sha256", "left")  # a hot text is split by the skew join
    wins = F.col(id_col).eqNullSafe(F.col("__keep"))
    tie = F.coalesce(wins & (F.col("__winners") > 1), F.lit(False))

    def out(df: DataFrame, kept: Column) -> DataFrame:
        alone = F.col("__size").isNull()
        return df.select(
            *[F.col(f"`{c}`") for c in base.columns], F.when(alone, F.col(id_col)).otherwise(F.col("__keep")).alias("keep_id"),
            F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"), (alone | kept).alias("kept"), "text_sha256",
        )

    whole = once.unionByName(out(joined.where(~tie), wins))
    if not groups.where("__winners > 1").limit(1).count():
        return whole
    # rows that repeat text and id: each gets a place, and the first place of a text is found by a minimum
    tied = marked.where("__maybe").join(groups.where("__winners > 1"), "text_sha256").where(tie)
    tied = stage_table(tied.withColumn("__at", F.monotonically_increasing_id()), "tied")
    first = tied.groupBy("text_sha256").agg(F.min("__at").alias("__first"))
    return whole.unionByName(out(tied.join(first, "text_sha256"), F.col("__at") == F.col("__first")))


def op1_exact_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs, columns=["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
