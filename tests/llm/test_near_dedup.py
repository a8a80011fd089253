import random

import corpus_pipeline
from pyspark.sql import functions as F

from lotmill.llm import near_dedup
from lotmill.llm.near_dedup import drop_similar


def runs(text, words=5):
    tokens = (text or "").lower().split()
    return {tuple(tokens[k : k + words]) for k in range(max(1, len(tokens) - words + 1))}


def brute_kept(rows, similarity=0.8):
    sets = [runs(t) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if part[i] != part[j] and common >= similarity * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                part = [part[j] if p == part[i] else p for p in part]
    return sorted(min(rows[k][0] for k in range(len(rows)) if part[k] == p) for p in set(part))


def made(seed=3):
    """Texts of their own, copies with some words changed, and a large group of copies of one text."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = []
    for k in range(40):
        base = fresh(rng.choice([3, 30, 120, 400]))
        texts.append(base)
        for changes in (1, 2, 4, 8, 20):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            texts.append(copy)
    base = fresh(200)
    for k in range(60):
        copy = list(base)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(200)] = f"y{rng.randrange(5000)}"
        texts.append(copy)
    rng.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts)] + [(1000, ""), (1001, None), (1002, " \n"), (1003, texts[0][0].upper())]


def test_against_brute_force(spark):
    rows = made()
    want = brute_kept(rows)
    assert len(want) < len(rows) - 100
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (512, 16):  # small blocks: clusters are cut into keys and pairs of blocks
        got = drop_similar(df, block=block)
        assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == want
    assert drop_similar(df.limit(0)).count() == 0


def test_chain_over_many_blocks(spark):
    """Each text is similar to its neighbours only, so that dealing blocks at random leaves links to the second pass."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(9000)}" for _ in range(900)]
    rows = [(k, " ".join(words[6 * k : 6 * k + 200])) for k in range(100)] + [(500 + k, " ".join(words[:100]) + f" end{k} " * (k + 1)) for k in range(9)]
    want = brute_kept(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in drop_similar(df, block=8).collect()) == want


def test_group_of_copies_is_settled_by_dealing(spark, monkeypatch):
    """Of a large group of copies the second pass sees few parts or none; both passes together lose no link."""
    seen, before = [], near_dedup._unsettled
    monkeypatch.setattr(near_dedup, "_unsettled", lambda keyed, large, block: seen.append(large) or before(keyed, large, block))
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for k in range(400):
        copy = list(base)
        copy[rng.randrange(200)] = f"y{k}"
        texts.append((k, " ".join(copy)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert [r.doc_id for r in drop_similar(df, block=32).collect()] == [0]
    assert seen[0].count() == 400 and seen[0].select("part").distinct().count() == 1


def test_runs_of_equal_segments_bring_texts_together(spark):
    """Where no MinHash key is shared, fingerprints within the radius of the SimHash operator are candidates all the same."""
    rng = random.Random(11)
    texts = []
    while len(texts) < 6:
        base = [f"w{rng.randrange(9000)}" for _ in range(3000)]
        copy = [*base[:-1], "end"]
        a, b = (near_dedup.simhash(near_dedup.shingles(" ".join(t))) for t in (base, copy))
        if 0 < int(a ^ b).bit_count() <= 2:
            texts += [" ".join(base), " ".join(copy)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_dedup.signatures(df, "doc_id", "text", 5)
    alone = rows.withColumn("keys", F.transform(F.sequence(F.lit(1), F.lit(near_dedup.BANDS)), lambda k: F.xxhash64("node", k)))
    nodes = {r.node: r.__getitem__("__id") for r in rows.collect()}
    found = near_dedup.links(df, alone, "text", 5, 0.8, 512).collect()
    assert sorted(sorted((nodes[e.a], nodes[e.b])) for e in found) == [[0, 1], [2, 3], [4, 5]]


def test_repeats_and_null_ids(spark):
    long = " ".join(f"w{k}" for k in range(100))
    near = long.replace("w50", "other")
    df = spark.createDataFrame([(5, long), (5, long), (2, near), (None, long), (None, "alone"), (7, "Alone")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in drop_similar(df).collect()) == [(2, near), (7, "Alone")]


def test_large_ids_beside_null(spark):
    long = " ".join(f"w{k}" for k in range(100))
    df = spark.createDataFrame([(None, "a"), (9007199254740993, long), (9007199254740992, long + " end")], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in drop_similar(df).collect()} == {None, 9007199254740992}


def test_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    once = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, sf_dir)
    want = brute_kept([(r.doc_id, r.text) for r in once.collect()])
    assert len(want) < once.count()
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, once, sf_dir)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == want
