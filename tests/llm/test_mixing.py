from compare import duck_rows, spark_rows

from lotmill.llm.mixing import OP5_SQL, mix_sources, op5_fair_queue_mixing, repeat_taken


def test_query(spark, duck, sf_dir):
    assert spark_rows(op5_fair_queue_mixing(spark, sf_dir)) == duck_rows(duck, OP5_SQL)


def test_near_targets_at_scale(spark):
    got = op5_fair_queue_mixing(spark, "/root/testdata/sf0.1").toPandas()
    by = got.groupby("target").agg(taken=("taken", "sum"), most=("size", "max"))
    sources = got.groupby(["source_size", "target"]).agg(taken=("taken", "sum"), most=("size", "max")).reset_index()
    assert ((sources.taken - sources.target).abs() <= sources.most).all() and len(by)
    assert (got.taken <= 3 * got["size"]).all() and abs(got.taken.sum() - got["size"].sum()) <= got["size"].max()


def test_targets_stop_and_are_shared(spark):
    rows = [(k, "w " * 10, "a") for k in range(2)] + [(10 + k, "w " * 10, "b") for k in range(50)] + [(100 + k, "w " * 10, None) for k in range(48)]
    got = {r.source: r for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got["a"].target == 60.0 and got["b"].target == (1000 - 60) * 2 / 3 and got[None].target == (1000 - 60) / 3
    assert got["a"].copies == 3


def test_edges(spark):
    rows = [(1, None, None), (None, "a b", "s"), (None, "a b", "s"), (2, "", "s"), (3, "x " * 100_000, "t"), (4, "\x0b one\ttwo　three", "s"), (5, None, "empty")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, source string, Taken string")
    got = mix_sources(df)
    assert got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    found = got.collect()
    assert len(found) == len(rows) and {r.doc_id: r.size for r in found if r.doc_id} == {1: 0, 2: 0, 3: 100_000, 4: 2, 5: 0}
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in found)
    assert len({r.copies for r in found if r.text == "a b"}) == 1
    assert {r.source: r.target for r in found}["empty"] == 0.0
    assert mix_sources(df.limit(0)).count() == 0
    again = mix_sources(df.repartition(3))
    assert sorted(map(str, again.collect())) == sorted(map(str, found))
    assert repeat_taken(got).count() == sum(r.copies for r in found)
