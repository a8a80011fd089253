import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotmill.llm.sharding import hilbert_index, hilbert_shards, op6_hilbert_sharding


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    names = [f"d{k}" for k in range(dims)]
    df = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=dims)), names)
    got = df.withColumn("h", hilbert_index([F.col(n).cast("int") for n in names], bits)).orderBy("h").toPandas()
    assert got.h.tolist() == list(range(1 << bits * dims)) and (np.abs(np.diff(got[names].values, axis=0)).sum(axis=1) == 1).all()


def check(got, rows, shards):
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in got) == sorted(str((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))) for i, t in rows)
    counts = {}
    for r in got:
        counts.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    sizes = [len(counts.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op6_hilbert_sharding(spark, sf_dir).collect()
    check(got, rows, 40)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def spread(docs, **more):
    """Of all sources, languages and sizes, how much a shard spans on average."""
    got = hilbert_shards(docs, carry=["source", "lang"])
    by = got.groupBy("shard").agg(F.countDistinct("lang").alias("l"), F.countDistinct("source").alias("s"), F.percentile_approx("size", [0.1, 0.9]).alias("z")).toPandas()
    sizes = np.sort(got.select("size").toPandas()["size"].to_numpy())
    span = [(np.searchsorted(sizes, z[1]) - np.searchsorted(sizes, z[0])) / len(sizes) for z in by.z]
    return by.s.mean(), by.l.mean(), float(np.mean(span))


def test_shards_prune(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sources, langs, sizes = spread(docs)
    assert sources < 7 and langs < 2.2 and sizes < 0.45  # of 20, 4 and 1


def test_common_prefixes_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = {r.doc_id: r.shard for r in hilbert_shards(docs).collect()}
    long = docs.withColumn("source", F.concat(F.lit("https://crawl-2024-"), "source"))
    assert {r.doc_id: r.shard for r in hilbert_shards(long).collect()} == plain


def test_edges(spark):
    rows = [(1, None, None, None), (None, "é", "s", "en"), (None, "é", "s", "en"), (2, "", "s", None), (3, "x" * 300_000, "t", "de")] + [(k, "same", "hot", "en") for k in range(10, 60)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, lang string, Shard int")
    got = hilbert_shards(df, shards=7, carry=["text", "Shard", "lang"])
    assert got.columns == ["doc_id", "text", "lang", "size", "text_crc32", "hilbert", "law", "shard", "slot"]
    check(got.collect(), [r[:2] for r in rows], 7)
    check(hilbert_shards(df.where("doc_id < 4"), shards=40).collect(), [r[:2] for r in rows if r[0] and r[0] < 4], 40)
    assert hilbert_shards(df.limit(0)).count() == 0
    sized = hilbert_shards(df.where("doc_id >= 10"), shards=5, law="bytes").groupBy("shard").agg(F.sum("size").alias("b")).toPandas()
    assert len(sized) == 5 and sized.b.max() - sized.b.min() <= 20
    with pytest.raises(ValueError):
        hilbert_shards(df, law="no")


def test_main_path_is_native(spark, sf_dir):
    assert not any(w in op6_hilbert_sharding(spark, sf_dir)._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("kind, values", [
    ("double", [0.1, 0.9, None, float("nan"), float("inf"), -float("inf"), 1e300, -1e300, 0.2, 0.3]), ("decimal(20,3)", [None, "0.125", "7.5", "-12345678901234567.5"]),
    ("long", [None, -(2**63) + 1, 2**63 - 1, 0, 5]),
])
def test_numbers_of_any_size(spark, kind, values):
    """Fractions are told apart, and huge, infinite and missing numbers are placed in order."""
    df = spark.createDataFrame([(k, str(v) if v is not None else None) for k, v in enumerate(values * 4)], "doc_id long, v string").selectExpr("doc_id", "'' AS text", f"CAST(v AS {kind}) AS v")
    got = hilbert_shards(df, shards=3, dims=["v"], carry=["v"]).collect()
    order = sorted((r.hilbert, -1e309 if r.v is None else 1e309 if r.v != r.v else float(r.v)) for r in got)
    assert [v for _, v in order] == sorted(v for _, v in order) and len({r.hilbert for r in got}) >= 3


def test_two_fractions_have_many_cells(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'' AS text", "rand(1) AS a", "rand(2) AS b")
    assert hilbert_shards(df, dims=["a", "b"]).select("hilbert").distinct().count() > 500
