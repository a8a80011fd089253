"""Table functions, observed counts and VARIANT."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lotmill.functions import tables
from lotmill.functions import variant as V
from lotmill.operators import report
from lotmill.sources import pages as P

PAGE = """<table><tr><td>menu</td></tr></table><table><tr><th>Date</th><th>Name of Corporate Debtor</th><th>Reserve Price</th><th>Details</th></tr>
<tr><td>1-1-2024</td><td>Acme <b>Ltd</b> &amp; Co</td><td>5</td><td><a href="/d/1.pdf">PDF</a></td></tr><tr></tr><tr><td>2-1-2024</td><td>B</td><td>6</td></tr><tr><td>cut</td></tr></table>"""


def test_rows_equal_the_operator(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>none</p>")], "page int, html string")
    tables.register(spark)
    good, _ = P.split_rows(P.extract_rows(df))
    fields = ["corporate_debtor", "details_pdf_url"]
    want = [(r.page, r.row_idx, *[r[f].text if r[f] else None for f in fields], r.cell_flags) for r in P.records(good, fields).orderBy("row_idx").collect()]
    got = spark.sql("SELECT * FROM listing_rows(TABLE({p}), 'corporate_debtor, details_pdf_url') ORDER BY row_idx", p=df)
    assert got.columns == ["page", "row_idx", *fields, "cell_flags"] and [tuple(r) for r in got.collect()] == want and len(want) == 2
    assert len(spark.sql("SELECT * FROM listing_rows(TABLE({p}))", p=df).columns) == 13


def test_schemas_are_decided_when_queries_are_analysed(spark):
    tables.register(spark)
    df = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    assert spark.sql("SELECT * FROM page_anchors(TABLE({p}))", p=df).dtypes == [("page_id", "bigint"), ("nth", "int"), ("href", "string")]
    for query in ("listing_rows(TABLE({p}), 'no_such_field')", "page_anchors(TABLE(SELECT 1 AS x))", "page_anchors(1)"):
        with pytest.raises(AnalysisException):
            spark.sql(f"SELECT * FROM {query}", p=df)


def test_blocks_and_anchors_in_sql(spark):
    tables.register(spark)
    html = '<div class="result x"><a href="u&amp;v">T</a><p class="snippet">s</p></div><!-- <a href="no">x</a> --><div class="result"><a href="w"> </a></div>'
    df = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    assert [tuple(r) for r in spark.sql("SELECT * FROM result_blocks(TABLE({p}))", p=df).collect()] == [tuple(r) for r in P.result_blocks(df).collect()] == [(1, 0, "T", "u&v", "s")]
    assert [r.href for r in spark.sql("SELECT * FROM page_anchors(TABLE({p})) ORDER BY nth", p=df).collect()] == ["u&v", "w"]


def jobs(spark, action):
    group = f"g{id(action)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counting_is_no_second_scan(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 'kept' ELSE 'other_location' END AS route", "id % 10 = 0 AS excluded").mapInArrow(count, "route string, excluded boolean")
    write = lambda: report.write_counted(rows, str(tmp_path / "out"), report.filter_counts(), {"rows": ["kept", "other_location", "unknown_location", "excluded"]})
    got, n = jobs(spark, write)
    assert got == {"rows": 1000, "kept": 300, "other_location": 600, "unknown_location": 0, "excluded": 100} and n == 1 and seen.value == 1000
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_counts_that_do_not_add_up(spark, tmp_path):
    rows = spark.createDataFrame([("kept", False), (None, False)], "route string, excluded boolean")
    with pytest.raises(ValueError, match="rows is 2"):
        report.write_counted(rows, str(tmp_path / "out"), report.filter_counts(), {"rows": ["kept", "other_location", "unknown_location", "excluded"]})


TEXTS = ['{"a": 5, "b": "x", "new": {"k": [1, null]}}', '```json\n{"a": "no", "b": 7}\n```', '{"a": null}', "[1, 2]", "broken {", None, '{"b": "", "a": 1.5}', '"text"']


def test_variants_of_any_shape(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "k int, t string").select("k", V.as_variant(F.col("t")).alias("v"))
    got = V.typed(rows, "v", {"a": "bigint", "b": "string"}).orderBy("k").collect()
    assert [(r.a, r.b, r.type_flags) for r in got] == [
        (5, "x", []), (None, None, ["a.type", "b.type"]), (None, None, []), (None, None, []), (None, None, []), (None, None, []), (2, "", []) if got[6].a == 2 else (1, "", []), (None, None, []),
    ]
    extra = V.extra_keys(rows, "v", "k", ["a", "b"]).collect()
    assert [(r.k, r.name, json.loads(r.value), r.type) for r in extra] == [(0, "new", {"k": [1, None]}, extra[0].type)] and extra[0].type.startswith("OBJECT<k: ARRAY<")
    shape = V.shape(rows.where("k IN (0, 6)"), "v", []).first()
    assert shape.n == 2 and "a: " in shape["shape"] and "b: STRING" in shape["shape"]
