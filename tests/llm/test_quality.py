import math
import re

import numpy as np
import pytest
import regex
from pyspark import SparkContext
from pyspark.sql import functions as F

from lotmill.llm import quality
from lotmill.llm.quality import classify_quality, estimate, fit_quality, op2_weak_label_quality


def test_estimate_finds_the_better_labeller():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.7
    votes = np.stack([np.where(rng.random(20_000) < right, truth, ~truth) * 2 - 1 for right in (0.95, 0.9, 0.7)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, tables, share = estimate(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.03
    right = [share * t[1, 2] + (1 - share) * t[0, 0] for t in tables]
    assert right[0] > right[1] > right[2] and abs(right[0] - 0.95) < 0.03
    assert ((posterior > 0.5) == (patterns[:, 0] == 1)).mean() > 0.7


@pytest.mark.parametrize("directory", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_accuracy_on_labels(spark, directory):
    got = op2_weak_label_quality(spark, directory).join(spark.read.parquet(f"{directory}/labels.parquet").select("doc_id", "quality"), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]  # labels that the method never saw
    assert good.keep.mean() > 0.995 and (~bad.keep).mean() > 0.95


def test_edges(spark):
    prose = "It was a mild day, and the people of the town went out. They came back at night, tired and glad."
    rows = [(1, prose), (1, prose), (None, None), (2, ""), (3, " \n\t"), (4, "word " * 100_000), (5, "!!! ### | |"), (6, "Ok.")] + [(k, f"{prose} Then number {k} spoke.") for k in range(10, 60)]
    rows += [(k, "SHOUTING!! WORDS!! " * 20) for k in range(60, 70)]
    df = spark.createDataFrame([(i, t, "mine") for i, t in rows], "doc_id long, text string, KEEP string")
    got = classify_quality(df)
    assert got.columns == ["doc_id", "text", "quality_score", "keep"]
    found = {(r.doc_id, (r.text or "")[:9]): r for r in got.collect()}
    assert got.count() == len(rows) and found[(1, prose[:9])].keep and found[(6, "Ok.")].keep and found[(2, "")].keep and found[(None, "")].keep
    assert not found[(60, "SHOUTING!")].keep and not found[(4, "word word")].keep
    assert classify_quality(df.limit(0)).count() == 0


def brute_votes(text):
    """Each labeller's rule, on a list of words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = max(len(words), 1)
    count = lambda pattern: sum(1 for _ in regex.finditer(pattern, text)) / n
    vote = lambda reject, keep: -1 if reject else 1 if keep else 0
    long, plain, ends = n >= 20, count(r"(?<!\S)\p{L}+[,.;:!?]?(?!\S)"), count(r"[\p{L}\p{N}][.!?](?!\S)")
    distinct = len(set(regex.split(r"[ \t\n\x0b\f\r]+", text))) / n
    return (
        vote(count(r"[#$%&*~^=+<>]{2,}") > 0.1, False), vote(long and count(r"(?<!\p{L})\p{Lu}{2,}") > 0.4, False), vote(long and count(r"!") > 0.3, False),
        vote(long and count(r"[|\t]") > 0.15, False), vote(long and count(r"(?<!\S)(\S+)(?=\s\1(?!\S))") > 0.15, False), vote(long and plain < 0.6, plain > 0.85),
        vote(long and (ends < 0.005 or ends > 0.5), 0.02 < ends < 0.3), vote(n >= 60 and distinct < 0.25, long and distinct > 0.35),
    )


def brute_posterior(rows, rounds=200):
    """Expectation maximisation row by row, in plain Python."""
    keep = [1 / (1 + math.exp(-(sum(v == 1 for v in r) - 2 * sum(v == -1 for v in r) + 1))) for r in rows]
    for _ in range(rounds):
        share = min(max(sum(keep) / len(rows), 1e-4), 1 - 1e-4)
        odds = [math.log(share / (1 - share))] * len(rows)
        for j in range(len(rows[0])):
            for side, sign in ((keep, 1), ([1 - p for p in keep], -1)):
                seen = {v: 0.1 + sum(p for p, r in zip(side, rows) if r[j] == v) for v in (-1, 0, 1)}
                total = sum(seen.values())
                odds = [o + sign * math.log(seen[r[j]] / total) for o, r in zip(odds, rows)]
        new = [1 / (1 + math.exp(-min(max(o, -40), 40))) for o in odds]
        if max(abs(a - b) for a, b in zip(new, keep)) < 1e-9:
            return new, share
        keep = new
    return keep, share


def test_query_against_brute_force(spark, sf_dir):
    """Votes, posterior and scorer computed again: row by row, and by dense matrices."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    votes = [brute_votes(t) for _, t in docs]
    shown = spark.createDataFrame(docs, "doc_id long, text string")
    cast = shown.select("doc_id", *[v.alias(k) for k, v in quality.labellers(F.col("text")).items()]).collect()
    assert {r.doc_id: tuple(r)[1:] for r in cast} == {i: v for (i, _), v in zip(docs, votes)}

    belief, share = brute_posterior(votes)
    x = np.zeros((len(docs), quality.FEATURES))
    for k, (_, text) in enumerate(docs):
        buckets, values = quality.shapes(text)
        x[k, buckets] = values
    label, side = np.array(belief), np.array(belief) >= 0.5
    weight = np.ones(len(docs)) / len(docs)
    w, m, v, bias = np.zeros(quality.FEATURES), 0.0, 0.0, math.log(share / (1 - share))
    for step in range(1, 401):
        slope = x.T @ ((1 / (1 + np.exp(-(x @ w + bias))) - label) * weight) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w = w - 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    want = {i: s for (i, _), s in zip(docs, 1 / (1 + np.exp(-(x @ w + bias))))}
    got = {r.doc_id: r for r in op2_weak_label_quality(spark, sf_dir).collect()}
    assert side.any() and not side.all() and set(got) == set(want)
    assert all(abs(got[i].quality_score - s) < 1e-3 for i, s in want.items())
    assert all(got[i].keep == (s >= 0.5) for i, s in want.items() if abs(s - 0.5) > 1e-3)


def test_repeated_rows_count_once(spark):
    prose = "It was a mild day, and the people of the town went out. They came back at night, tired and glad, and told of"
    rows = [(k, f"{prose} {k} things.") for k in range(300)] + [(k, "SHOUTING!! WORDS!! " * 20 + str(k)) for k in range(300, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = df.orderBy(F.xxhash64("doc_id", "text")).limit(1)
    many = df
    for _ in range(5):
        many = many.unionByName(first)
    plain, repeated = (fit_quality(d, sample=100) for d in (df, many))
    assert np.abs(plain.weights - repeated.weights).max() < 0.05


def test_whole_text_counts():
    a, b = quality.shapes("word " * 5000), quality.shapes("word " * 5000 + "NOISE!! " * 5000)
    assert len(b[0]) > len(a[0])


def test_model_tells_about_labellers(spark, sf_dir):
    model = fit_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert set(model.accuracy) == {"signs", "shouts", "exclaims", "cells", "repeats", "plain", "sentences", "variety"} and 0.5 < model.share < 1


def test_beliefs_need_no_workers_of_their_own(spark, monkeypatch):
    prose = "It was a mild day, and the people of the town went out. They came back at night, tired and glad."
    df = spark.createDataFrame([(k, f"{prose} Then number {k} spoke." if k % 4 else "### | | !!! " * k) for k in range(80)], "doc_id long, text string")

    def refused(*args, **named):
        raise AssertionError("rows of a list go through Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", refused)
    assert classify_quality(df).count() == 80 and classify_quality(df.where("false")).count() == 0
