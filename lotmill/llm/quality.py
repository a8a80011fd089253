"""Quality classifier from weak labels.

Overlapping heuristic labellers vote keep, reject or nothing on every document.  How often each combination of votes
occurs is counted over all documents (at most three to the number of labellers, whatever the corpus), and expectation
maximisation estimates from the counts how accurate each labeller is, with no labels at all: a labeller is as good as
it agrees with what the others, weighted by their own accuracy, believe.  The posterior of each combination is then the
soft label that trains a linear scorer over hashed word shapes, which reads every document.  Only the training rows are
a sample: of each side at most ``sample`` documents, the least by hash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, stage_table, text_or_empty, without, word_count

OUT = ("quality_score", "keep")
FEATURES = 1 << 12
SAMPLE = 3000
#: Words from which a document's shapes count fully; shorter ones lean to the bias.
SURE_WORDS = 20

_SHAPE = bytes(
    65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 97 if 97 <= b <= 122 or b >= 128 else b for b in range(256)
)
_RUN = re.compile(rb"([^\s])\1+")


def labellers(text: Column) -> dict[str, Column]:
    """Votes of each labeller: 1 keep, -1 reject, 0 nothing."""
    words = F.greatest(word_count(text), F.lit(1)).cast("double")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)) / words
    vote = lambda reject, keep: F.when(reject, -1).when(keep, 1).otherwise(0)
    never = F.lit(False)
    plain = count(r"(?<!\S)\p{L}+[,.;:!?]?(?!\S)")
    ends = count(r"[\p{L}\p{N}][.!?](?!\S)")
    distinct = F.size(F.array_distinct(F.split(text, r"\s+"))) / words
    long = words >= SURE_WORDS
    return {
        "signs": vote(count(r"[#$%&*~^=+<>]{2,}") > 0.1, never),
        "shouts": vote(long & (count(r"(?<!\p{L})\p{Lu}{2,}") > 0.4), never),
        "exclaims": vote(long & (count(r"!") > 0.3), never),
        "cells": vote(long & (count(r"[|\t]") > 0.15), never),
        "repeats": vote(long & (count(r"(?<!\S)(\S+)(?=\s\1(?!\S))") > 0.15), never),
        "plain": vote(long & (plain < 0.6), plain > 0.85),
        "sentences": vote(long & ((ends < 0.005) | (ends > 0.5)), (ends > 0.02) & (ends < 0.3)),
        "variety": vote((words >= 60) & (distinct < 0.25), long & (distinct > 0.35)),
    }


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation maximisation over combinations of votes (-1, 0, 1) that occur ``counts`` times.

    Returns the posterior of keep for each combination, for each labeller the chance of each vote given reject and keep,
    and the share of keep.  It starts from equal labellers that are right more often than wrong.
    """
    n = counts.sum()
    score = (votes == 1).sum(axis=1) - 2.0 * (votes == -1).sum(axis=1)
    keep = 1 / (1 + np.exp(-(score + 1.0)))
    tables, share = np.zeros((votes.shape[1], 2, 3)), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - keep) * counts, keep * counts])
        share = float(np.clip(weight[1].sum() / n, 1e-4, 1 - 1e-4)) if n else 0.5
        for j in range(votes.shape[1]):
            for side in (0, 1):
                seen = np.array([weight[side][votes[:, j] == v].sum() for v in (-1, 0, 1)]) + 0.1
                tables[j, side] = seen / seen.sum()
        logs = np.log(tables)
        odds = np.log(share) - np.log1p(-share) + sum(logs[j, 1, votes[:, j] + 1] - logs[j, 0, votes[:, j] + 1] for j in range(votes.shape[1]))
        new = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        if np.abs(new - keep).max(initial=0) < 1e-9:
            keep = new
            break
        keep = new
    return keep, tables, share


def shapes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word shapes of a whole text: buckets, and root of each one's share of words (less in short texts)."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    seen = Counter(_RUN.sub(rb"\1", raw.translate(_SHAPE)).split())
    seen[b" again"] = sum(map(eq, words, words[1:]))
    held: dict[int, int] = {}
    for shape, n in seen.items():
        bucket = zlib.crc32(shape) % FEATURES
        held[bucket] = held.get(bucket, 0) + n
    n = len(words)
    values = np.sqrt(np.array(list(held.values())) / n) * min(1.0, n / SURE_WORDS)
    return np.array(list(held), np.int64), values


def fit(rows: list[tuple[list[int], list[float], float, float]], share: float, rounds: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic weights from (buckets, values, chance of keep, weight), by Adam on soft labels.

    The bias is the log odds of ``share``: a document of which too little is known is as good as documents are.
    """
    weights, bias = np.zeros(FEATURES), float(np.log(share) - np.log1p(-share))
    if not rows:
        return weights, bias
    at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    column = np.concatenate([np.asarray(r[0], np.int64) for r in rows])
    value = np.concatenate([np.asarray(r[1], float) for r in rows])
    label, weight = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    weight = weight / weight.sum()
    m, v = np.zeros(FEATURES), np.zeros(FEATURES)
    for k in range(1, rounds + 1):
        z = np.bincount(at, value * weights[column], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) * weight
        slope = np.bincount(column, value * error[at], FEATURES) + ridge * weights
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        weights = weights - 0.2 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return weights, bias


class QualityModel:
    """A fitted scorer, with what expectation maximisation found out about the labellers."""

    def __init__(self, weights: np.ndarray, bias: float, accuracy: dict[str, float], share: float):
        self.weights, self.bias, self.accuracy, self.share = weights, bias, accuracy, share

    def score(self, docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
        """Adds ``quality_score`` (chance that the document is good) and ``keep``."""
        weights, bias = self.weights, self.bias

        @F.pandas_udf("double")
        def scorer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                out = np.empty(len(texts))
                for k, text in enumerate(texts):
                    buckets, values = shapes(text)
                    out[k] = bias + values @ weights[buckets]
                yield pd.Series(1 / (1 + np.exp(-np.clip(out, -40, 40))))
            release_memory()

        scored = without(docs, OUT).withColumn("quality_score", scorer(text_or_empty(text_col)))
        return scored.withColumn("keep", F.col("quality_score") >= threshold)


def fit_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> QualityModel:
    """Estimate the labellers over all documents and train the scorer on at most ``sample`` documents of each side."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    votes = labellers(text)
    names = list(votes)
    order = F.xxhash64(F.col(id_col), text)
    cast = docs.select(order.alias("order"), F.concat_ws(",", *[v.cast("string") for v in votes.values()]).alias("votes"))
    cast = stage_table(cast, "votes")
    found = cast.groupBy("votes").count().orderBy("votes").collect()  # at most 3 ** labellers rows
    table = np.array([[int(x) for x in r["votes"].split(",")] for r in found], int).reshape(-1, len(names))
    counts = np.array([r["count"] for r in found], float)
    posterior, tables, share = estimate(table, counts)

    # of an Arrow table, as rows of a list start Python workers of another kind, which stay beside those that score
    known = pa.table({"votes": pa.array([r["votes"] for r in found], pa.string()), "belief": pa.array(posterior, pa.float64())})
    beliefs = spark.createDataFrame(known)
    marked = cast.join(F.broadcast(beliefs), "votes")
    sides, chosen = {True: 0.0, False: 0.0}, None
    for p, n in zip(posterior, counts):
        sides[bool(p >= 0.5)] += n
    for side in (True, False):
        part = marked.where((F.col("belief") >= 0.5) == F.lit(side)).groupBy("order").agg(F.first("belief").alias("belief")).orderBy("order").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(chosen)  # at most 2 * sample rows

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shapes(t) for t in batch["text"]]
            yield pd.DataFrame({"order": batch["order"], "belief": batch["belief"], "k": [f[0] for f in found], "v": [f[1] for f in found]})
        release_memory()

    drawn = docs.select(order.alias("order"), text.alias("text")).join(chosen, "order")
    rows = drawn.mapInPandas(featurise, "order long, belief double, k array<long>, v array<double>").dropDuplicates(["order"]).orderBy("order").collect()
    held = Counter(r["belief"] >= 0.5 for r in rows)
    training = [(r["k"], r["v"], r["belief"], sides[r["belief"] >= 0.5] / held[r["belief"] >= 0.5]) for r in rows]
    weights, bias = fit(training, share)
    right = {n: float(share * tables[j, 1, 2] + (1 - share) * tables[j, 0, 0]) for j, n in enumerate(names)}
    voted = {n: float(share * (1 - tables[j, 1, 1]) + (1 - share) * (1 - tables[j, 0, 1])) for j, n in enumerate(names)}
    return QualityModel(weights, bias, {n: right[n] / voted[n] for n in names}, share)


def classify_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """All documents with ``quality_score`` and ``keep``; fitted on the documents themselves.

    Defined results: a null text counts as empty; texts without words have the score of the bias, as nothing speaks
    against them; ids serve to draw the training rows only and may be null or repeat; repeated rows count once
    among the training rows and get equal scores;
    an empty table gives an empty result; input columns named as an output column are replaced.
    """
    return fit_quality(docs, id_col, text_col, sample).score(docs, text_col, threshold)


def op2_weak_label_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify_quality(docs).select("doc_id", "quality_score", "keep")
