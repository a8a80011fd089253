import json

from test_operators import SCHEMA, fold, observations

from lotmill.operators import changes
from lotmill.streaming.snapshots import follow, listing_state

ORDER = ["run_date", "input_seq"]


def run(spark, df, tmp_path, cuts):
    for a, b in cuts:
        df.where(f"input_seq >= {a} AND input_seq < {b}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        follow(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()  # starts again from its checkpoint
    return spark.read.parquet(str(tmp_path / "out")).selectExpr("*", "CAST(get_json_object(incoming_json, '$.input_seq') AS INT) AS input_seq")


def test_stream_equals_batch_and_fold(spark, tmp_path):
    rows = observations(90, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.input_seq, r.status, r.price_drop, [tuple(c) for c in r.changes]) for r in run(spark, df, tmp_path, ((0, 25), (25, 60), (60, 90))).collect())
    want = changes.change_status(df, ORDER).orderBy("input_seq").collect()
    assert got == [(r.input_seq, r.status, r.price_drop, [tuple(c) for c in r.changes]) for r in want]
    statuses, state = fold([dict(zip(df.columns, r)) for r in rows])
    assert [g[:3] for g in got] == statuses
    held = listing_state(spark, str(tmp_path / "cp")).collect()
    assert sorted((r.observations, r.last_seen, r.price or 0) for r in held) == sorted((s["n"], str(s["last"]), s["price"] or 0) for s in state.values())
    final = {r.listing_key: r for r in changes.final_state(changes.change_status(df, ORDER), ORDER, "run_date").collect()}
    assert all((str(final[r.listing_key].first_seen), str(final[r.listing_key].last_changed)) == (r.first_seen, r.last_changed) for r in held)


def test_late_rows_count_when_they_arrive(spark, tmp_path):
    rows = observations(40, 5)
    late = rows[20:] + rows[:20]  # the later half arrives first
    df = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(late)], SCHEMA)
    got = sorted((r.input_seq, r.status, r.price_drop) for r in run(spark, df, tmp_path, ((0, 20), (20, 40))).collect())
    assert got == fold([dict(zip(df.columns, (k, *r[1:]))) for k, r in enumerate(late)])[0]


def test_collisions_carry_both_rows(spark, tmp_path):
    df = spark.createDataFrame(observations(60, 2), SCHEMA)
    hits = run(spark, df, tmp_path, ((0, 60),)).where("status = 'collision'").collect()
    assert hits
    for h in hits:
        ours, theirs = json.loads(h.existing_json), json.loads(h.incoming_json)
        key = lambda r: f"{r['corporate_debtor'].strip().lower()}|{(r['ip_name'] or '').strip().lower()}"
        assert key(ours) == key(theirs) and ours["corporate_debtor"].strip().lower() != theirs["corporate_debtor"].strip().lower()


def test_a_batch_costs_its_own_keys(spark, tmp_path):
    """Rows of state that a batch updates are those of its keys, whatever the state holds."""
    many = spark.range(3000).selectExpr(
        "CAST(id AS INT) AS input_seq", "DATE '2024-01-01' AS run_date", "concat('D', id) AS corporate_debtor", "'i' AS ip_name", "'t' AS notice_type", "'land' AS nature_of_assets",
        "5L AS reserve_price", "DATE '2024-05-01' AS auction_date", "DATE '2024-01-01' AS notice_date", "CAST(NULL AS DATE) AS emd_due_date",
    )
    again = many.where("input_seq < 7").selectExpr("input_seq + 3000 AS input_seq", *[c for c in many.columns if c != "input_seq"])
    updated = []
    for part in (many, again):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = follow(spark.readStream.schema(many.schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        updated.append(sum(s["numRowsUpdated"] for p in query.recentProgress for s in p["stateOperators"]))
    assert updated == [3000, 7]
    assert spark.read.parquet(str(tmp_path / "out")).where("status = 'unchanged'").count() == 7


def test_one_call_serves_many_keys():
    """Rows of many keys, mixed and in several frames; a state row is read and written once a key; prices stay whole numbers."""
    import pandas as pd

    from lotmill.streaming.snapshots import ListingState

    held, calls = {}, {"get": 0, "put": 0}

    class Map:
        def getValue(self, key):
            calls["get"] += 1
            return held.get(key)

        def updateValue(self, key, value):
            calls["put"] += 1
            held[key] = value

    class Handle:
        def getMapState(self, *_):
            return Map()

    state = ListingState()
    state.init(Handle())
    tracked = [json.dumps(["t", "land", str(p), "d"]) for p in range(3)]
    price = [str(2**53 + 2 - k) for k in range(2)] + [None]
    rows = [(f"k{key}", "me" if key != 5 or n < 2 else "other", tracked[n], price[n], f"{n}", f"2024-01-0{n + 1}", "{}") for n in (1, 0, 2) for key in range(9)]
    frame = pd.DataFrame(rows, columns=["listing_key", "identity", "tracked", "price", "nth", "at", "row_json"])
    got = pd.concat(state.handleInputRows((0,), iter([frame[:11], frame[11:]]), None))
    assert got["listing_key"].tolist() == [f"k{key}" for key in range(9) for _ in range(3)]
    for key, part in got.groupby("listing_key"):
        assert part["status"].tolist() == ["new", "changed", "collision" if key == "k5" else "changed"]
        assert part["price_drop"].tolist() == [False, True, False]
    assert calls == {"get": 9, "put": 9} and held[("k0",)][6] == 3 and held[("k5",)][6] == 2
