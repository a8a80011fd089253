import corpus_pipeline
from test_packing import PATH, check
from test_near_dedup import brute_kept
from tokenizers import Tokenizer

import __spark_entry__ as entry


def test_registered():
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in entry.queries() if q.startswith("op")}


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    good = stages["quality"](spark, docs, sf_dir)
    assert good.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [(r.doc_id, r.text) for r in good.collect()]
    kept = {i for i, _ in rows}
    assert all(i in kept for i, q in labels.items() if q == 1) and sum(i in kept for i, q in labels.items() if q == 0) <= 2

    once = stages["exact_dedup"](spark, good, sf_dir)
    best = {}
    for i, t in rows:
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        best[key] = max(best.get(key, i), i)
    rows = sorted((r.doc_id, r.text) for r in once.collect())
    assert once.columns == columns and [i for i, _ in rows] == sorted(best.values())

    apart = stages["near_dedup"](spark, once, sf_dir)
    want = brute_kept(rows)
    assert apart.columns == columns and sorted(r.doc_id for r in apart.collect()) == want

    mixed = stages["mixing"](spark, apart, sf_dir)
    rows = [(r.doc_id, r.text) for r in mixed.collect()]
    assert mixed.columns == columns and {i for i, _ in rows} <= set(want) and max(sum(i == j for j, _ in rows) for i, _ in rows) <= 3

    single = mixed.dropDuplicates(["doc_id"])
    packed = stages["packing"](spark, single, sf_dir).collect()
    tokenizer = Tokenizer.from_file(PATH)
    check(packed, dict(rows), tokenizer, 4096)


def test_columns_of_users_stay(spark, sf_dir):
    prose = "It was a mild day, and the people of the town went out. They came back at night, tired and glad."
    rows = [(k, f"{prose} Then number {k} spoke of {k * 7} other things that no one knew, and went home.", "s") for k in range(40)] + [(100, None, None), (None, "", "s")]
    names = ["keep", "quality_score", "kept", "keep_id", "taken", "size", "copies", "__text", "target"]
    df = spark.createDataFrame([(*r, *names) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, df, sf_dir)
        assert got.columns == df.columns and stage(spark, df.limit(0), sf_dir).count() == 0
        found = got.collect()
        assert found and all(r[n] == n for r in found for n in names), name


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).where("length > 0").count() > 100
