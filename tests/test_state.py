import datetime
import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_operators import SCHEMA, observations

from lotmill.operators import changes
from lotmill.sources import state
from lotmill.sources.keyed import KeyedTable


def test_older_tables_conform(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("parsed", T.BooleanType()), T.StructField("note", T.StringType())])
    got = state.conform(spark.createDataFrame([("5", 1)], "A string, extra int"), schema)
    assert got.schema == schema or got.dtypes == [("a", "bigint"), ("parsed", "boolean"), ("note", "string")]
    assert tuple(got.first()) == (5, False, None)


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(df.select(state.as_json(df)).first()[0]) == {"a": 1, "b": None}


def test_typed_enrichment(spark):
    df = spark.createDataFrame([('{"summary":"s"}', '[{"title":"t"}]'), ("broken", None)], "narrative string, hits string")
    a, b = state.typed_enrichment(df).collect()
    assert a.narrative.summary == "s" and a.hits[0].title == "t" and b.hits is None and (b.narrative is None or b.narrative.summary is None)


ORDER = ["run_date", "input_seq"]


def table_of(spark, tmp_path, df, buckets=8):
    final = changes.final_state(changes.change_status(df, ORDER), ORDER, "run_date")
    name = f"t_{uuid.uuid4().hex}"
    return lambda: KeyedTable(spark, name, str(tmp_path / "state"), final.schema, buckets=buckets)


def shown(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_batches_and_reruns(spark, tmp_path):
    """State, history and collisions of three batches, each run twice, the middle one again at the end of it all."""
    df = spark.createDataFrame(observations(120, 2), SCHEMA)
    table, logs = table_of(spark, tmp_path, df)(), str(tmp_path / "logs")
    parts = [df.where(f"input_seq >= {a} AND input_seq < {b}") for a, b in ((0, 40), (40, 80), (80, 120))]
    whole = changes.change_status(df, ORDER)
    for k, part in enumerate(parts):
        for _ in range(2):
            got = state.apply_batch(table, part, k, ORDER, "run_date", logs)
        assert shown(got, ["input_seq", "status", "price_drop", "changes"]) == shown(whole.join(part.select("input_seq"), "input_seq"), ["input_seq", "status", "price_drop", "changes"])
    state.apply_batch(table, parts[1], 1, ORDER, "run_date", logs)
    columns = ["listing_key", "corporate_debtor", "reserve_price", "first_seen", "last_seen", "last_changed", "observations"]
    assert shown(table.read(2), columns) == shown(changes.final_state(changes.change_status(df.where("input_seq < 80"), ORDER), ORDER, "run_date"), columns)
    state.apply_batch(table, parts[2], 2, ORDER, "run_date", logs)
    assert shown(table.read(), columns) == shown(changes.final_state(whole, ORDER, "run_date"), columns)
    assert spark.read.parquet(f"{logs}/history").count() == changes.history(whole, "run_date").count() > 0
    hits = spark.read.parquet(f"{logs}/collisions").collect()
    assert len(hits) == whole.where("status = 'collision'").count() > 0
    assert all(json.loads(h.existing_json)["listing_key"] == h.listing_key == json.loads(h.incoming_json)["listing_key"] and not h.resolved for h in hits)


def test_state_stays_where_it_is(spark, tmp_path):
    """The bucketed side of the join has no exchange below it, and a second session finds the table again."""
    df = spark.createDataFrame(observations(120, 4), SCHEMA)
    opened = table_of(spark, tmp_path, df)
    state.apply_batch(opened(), df.where("input_seq < 60"), 0, ORDER, "run_date", str(tmp_path / "logs"))
    table = opened()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = changes.change_status(df.where("input_seq >= 60"), ORDER, table.read())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan.split("== Initial Plan ==")[0]
    side = plan[plan.index("Join") :]
    scan = next(line for line in side.splitlines() if "state" in line and "FileScan" in line or "Scan parquet" in line and "bucket" in line.lower())
    assert "Bucketed: true" in scan
    above = side[: side.index(scan)].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    chain, at = [], depth(scan)
    for line in reversed(above):
        if depth(line) < at:
            chain.append(line)
            at = depth(line)
    assert not any("Exchange" in line for line in chain[:-1]), plan


def test_a_batch_writes_its_buckets_only(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('k', id) AS listing_key", "id AS v")
    table = KeyedTable(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "t"), rows.schema, buckets=100)
    table.write(rows, 0)
    over = lambda old, new: old.join(new, "listing_key", "anti").unionByName(new)
    part = rows.where("listing_key = 'k7'").withColumn("v", F.lit(-1).cast("long"))
    for _ in range(2):
        table.merge(part, 1, over)
    assert len({d for d in (tmp_path / "t" / "batch_no=1").iterdir() if d.is_dir()}) == 1
    assert table.read().count() == 2000 and table.read().where("v = -1").count() == 1 and table.read(1).where("v = -1").count() == 0
    table.forget(1)
    assert table.read(1).count() == 2000
    table.forget(2)
    assert table.read().count() == 2000 and table.read(1).count() < 2000


def test_enrichment_upsert_again(spark, tmp_path):
    stored = "listing_key string, narrative string, narrative_at date, narrative_attempted boolean, details_at_enrich boolean, notice_at_enrich boolean"
    table = KeyedTable(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "e"), spark.createDataFrame([], stored).schema, buckets=4)
    batches = [[("a", "one", True, False), ("b", "two", False, False)], [("a", None, True, True), ("c", "three", False, False)]]
    for k, rows in enumerate(batches):
        new = spark.createDataFrame(rows, "listing_key string, narrative string, details_parsed boolean, notice_parsed boolean")
        for _ in range(2):
            state.upsert_enrichment(table, new, k, ["narrative"], F.lit(f"2024-01-0{k + 1}").cast("date"))
    got = [(r.listing_key, r.narrative, str(r.narrative_at), r.notice_at_enrich) for r in table.read().orderBy("listing_key").collect()]
    assert got == [("a", "one", "2024-01-01", True), ("b", "two", "2024-01-01", False), ("c", "three", "2024-01-02", False)]


def test_report_replaces_its_date_only(spark, tmp_path):
    path = str(tmp_path / "report")
    for day, n in (("2024-01-01", 3), ("2024-01-02", 2), ("2024-01-01", 1)):
        state.write_report(spark.range(n).toDF("nth"), F.lit(day).cast("date"), path)
    got = {r.report_date: r["count"] for r in spark.read.parquet(path).groupBy("report_date").count().collect()}
    assert got == {datetime.date(2024, 1, 1): 1, datetime.date(2024, 1, 2): 2}


def test_stored_state_is_not_sent_to_the_driver(spark):
    """However small: state grows with the listings, and a broadcast of it goes through the driver."""
    df = spark.createDataFrame(observations(30, 3), SCHEMA)
    order = ["run_date", "input_seq"]
    stored = changes.final_state(changes.change_status(df, order), order, "run_date")
    changed = changes.change_status(df, order, stored)
    for rows in (changed, changes.preview(df, stored), state.collisions(changed, stored, "run_date")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
