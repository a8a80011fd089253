"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.llm.common import stage_table
from lotmill.llm.exact_dedup import exact_dedup
from lotmill.llm.mixing import mix_sources, repeat_taken
from lotmill.llm.near_dedup import drop_similar
from lotmill.llm.packing import pack_documents
from lotmill.llm.quality import classify_quality


USED = ("doc_id", "text", "source")


def aside(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that no operator reads under names that no operator gives."""
    return docs.select([F.col(f"`{c}`").alias(c if c in USED else f"__own{k}") for k, c in enumerate(docs.columns)])


def back(decided: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, under their own names."""
    return decided.select([F.col(f"`{c}`" if c in USED else f"__own{k}").alias(c) for k, c in enumerate(docs.columns)])


# In all stages: a null text counts as an empty one; null, repeated and tied rows are settled as the operators' docstrings say;
# texts are taken whole; an empty table gives an empty one; further columns, whatever their names, are carried unchanged by
# all stages but the last, which leaves them out.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; those without words are kept, as nothing speaks against them."""
    return back(classify_quality(aside(docs)).where("keep"), docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that of the largest id; of rows that repeat text and id, one."""
    return back(exact_dedup(aside(docs)).where("kept"), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group that similarities of at least 0.8, by shingles of five words, join."""
    return drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times; a null source is a source of its own."""
    return back(repeat_taken(mix_sources(aside(docs))), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: The scorer, the hashes and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
