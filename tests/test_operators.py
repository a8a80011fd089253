import datetime
import random

import pytest
from pyspark.sql import functions as F

from lotmill.operators import changes, dedup, enrich, report, scoring
from lotmill.params import IDENTITY, TRACKED, Params

DAY = datetime.date


def norm(x):
    return "" if x is None else str(x).strip().lower()


def fold(rows):
    """Row by row, as a store would do it."""
    state, out = {}, []
    for r in rows:
        ident, tracked = tuple(norm(r[c]) for c in IDENTITY), tuple(norm(r[c]) for c in TRACKED)
        key = "|".join(ident)
        if key not in state:
            status, drop = "new", False
            state[key] = {"ident": ident, "tracked": tracked, "price": r["reserve_price"], "last": r["run_date"], "n": 1}
        elif state[key]["ident"] != ident:
            status, drop = "collision", False
        else:
            old = state[key]
            status = "unchanged" if old["tracked"] == tracked else "changed"
            drop = status == "changed" and None not in (old["price"], r["reserve_price"]) and r["reserve_price"] < old["price"]
            old.update(tracked=tracked, price=r["reserve_price"], last=r["run_date"], n=old["n"] + 1)
        out.append((r["input_seq"], status, drop))
    return out, state


SCHEMA = (
    "input_seq int, run_date date, corporate_debtor string, ip_name string, notice_type string, nature_of_assets string, "
    "reserve_price long, auction_date date, notice_date date, emd_due_date date"
)


def observations(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        debtor, ip = rng.choice([("A", "x"), ("a|b", "c"), ("a", "b|c"), ("B ", None), ("b", "")])
        rows.append((
            k, DAY(2024, 1, 1 + k * 20 // n), debtor, ip, rng.choice(["t", "T "]), "land", rng.choice([None, 0, 5, 7]), rng.choice([None, DAY(2024, 5, 1)]),
            DAY(2024, 1, 1), None,
        ))
    return rows


def test_change_status_equals_a_fold(spark):
    for seed in range(4):
        rows = observations(120, seed)
        df = spark.createDataFrame(rows, SCHEMA)
        want, state = fold([dict(zip(df.columns, r)) for r in rows])
        changed = changes.change_status(df.repartition(3), ["run_date", "input_seq"])
        assert [(r.input_seq, r.status, r.price_drop) for r in changed.orderBy("input_seq").collect()] == want
        final = changes.final_state(changed, ["run_date", "input_seq"], "run_date").collect()
        assert sorted((r.observations, r.last_seen, r.reserve_price or 0) for r in final) == sorted((s["n"], s["last"], s["price"] or 0) for s in state.values())


def test_state_carries_over(spark):
    df = spark.createDataFrame(observations(120, 9), SCHEMA)
    order = ["run_date", "input_seq"]
    whole = {r.input_seq: r.status for r in changes.change_status(df, order).collect()}
    state = None
    for a, b in ((0, 40), (40, 80), (80, 120)):
        part = df.where(f"input_seq >= {a} AND input_seq < {b}")
        got = changes.change_status(part, order, state)
        assert {r.input_seq: r.status for r in got.collect()} == {k: v for k, v in whole.items() if a <= k < b}
        new = changes.final_state(got, order, "run_date")
        state = new if state is None else changes.merge_state(state, new)
    want = changes.final_state(changes.change_status(df, order), order, "run_date")
    columns = ["listing_key", "reserve_price", "first_seen", "last_seen", "last_changed", "observations"]
    assert sorted(map(str, state.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))


def test_same_snapshot_again_changes_nothing(spark):
    df = spark.createDataFrame(observations(1, 1), SCHEMA)
    twice = df.unionByName(df.withColumn("input_seq", F.lit(1)))
    got = changes.change_status(twice, ["input_seq"])
    assert [r.status for r in got.orderBy("input_seq").collect()] == ["new", "unchanged"]
    assert changes.history(got, "run_date").count() == 0
    assert {r.status: r.n for r in changes.status_summary(got).collect()} == {"new": 1, "unchanged": 1, "changed": 0, "collision": 0}
    assert changes.change_status(df.limit(0), ["input_seq"]).count() == 0


def test_preview_does_not_see_the_batch(spark):
    df = spark.createDataFrame(observations(1, 1), SCHEMA)
    twice = df.unionByName(df)
    empty = changes.final_state(changes.change_status(df.limit(0), ["input_seq"]), ["input_seq"], "run_date")
    assert [r.status for r in changes.preview(twice, empty).collect()] == ["new", "new"]


def test_placeholder_price(spark):
    rows = [(0, DAY(2024, 1, 1), "a", "b", "c", "d", 5, None, None, None), (1, DAY(2024, 1, 2), "a", "b", "c", "d", 0, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    drops = lambda **o: [r.price_drop for r in changes.change_status(df, ["input_seq"], **o).orderBy("input_seq").collect()]
    assert drops() == [False, True] and drops(zero_is_unknown=True) == [False, False]


def test_percentile(spark):
    df = spark.createDataFrame([(1, p) for p in (1_000_000, 5_000_000, 3_000_000, 3_000_000, None, 0)] + [(2, 7)], "batch int, reserve_price long")
    got = {(r.batch, r.reserve_price): r.price_score for r in scoring.price_percentile(df, "batch").collect()}
    assert got == {(1, 1_000_000): 100.0, (1, 5_000_000): 0.0, (1, 3_000_000): 50.0, (1, None): None, (1, 0): None, (2, 7): 50.0}
    one = df.where("batch = 1")
    assert sorted(map(str, scoring.price_percentile(one).select("price_score", "price_flag").collect())) == sorted(
        map(str, scoring.price_percentile(one, "batch").select("price_score", "price_flag").collect())
    )


def test_location_scores(spark):
    df = spark.createDataFrame([(x,) for x in ("Delhi NCR", "Rajpura, Punjab", "Indore, Madhya Pradesh", "Mumbai", None)], "location string")
    assert {r.location_score for r in scoring.location_score(df).collect()} == {50}  # nothing is preferred unless told
    params = Params(preferred_regions=("Delhi", "Rajpura", "Madhya Pradesh"))
    assert [r.location_score for r in scoring.location_score(df, params).collect()] == [75, 75, 75, 50, 50]


def test_preferences(spark):
    df = spark.createDataFrame([("physical possession", "land of 2 acres"), (None, "Industrial shed")], "notice_text string, nature_of_assets string")
    params = Params(preferred_land_classes=("industrial",), min_plot_sqft=1000.0)
    got = scoring.plot_score(scoring.possession_score(df, params), params).collect()
    assert [(r.possession_score, r.land_score, r.plot_score) for r in got] == [(100, 50, 75), (50, 75, 50)]
    assert got[1].possession_flags == ["possession.no_text", "land.from_assets"]


def test_dedup_key_is_tagged(spark):
    df = spark.createDataFrame([(1, 0, "/a", "x"), (1, 1, "", "x"), (2, 0, "/a", "y"), (2, 1, None, "x")], "page int, row_idx int, url string, debtor string")
    got = dedup.first_seen(df, dedup.dedup_key([F.col("url")], [F.col("debtor")]), ["page", "row_idx"]).orderBy("page", "row_idx").collect()
    assert [r.kept for r in got] == [True, True, False, False]


def test_routes_are_exhaustive(spark):
    df = spark.createDataFrame([("Ranchi", "Jharkhand"), ("Noida", None), (None, None), ("", ""), ("Pune", "Maharashtra")], "location string, state string")
    params = Params(included_states=("Jharkhand",), included_keywords=("noida",))
    assert {r.route for r in report.location_route(df).collect()} == {"other_location", "unknown_location"}  # nothing is included unless told
    assert [r.route for r in report.location_route(df, params).collect()] == ["kept", "kept", "unknown_location", "unknown_location", "other_location"]
    cars = spark.createDataFrame([("Motor Vehicle",), ("Swift VXI MH02EK5147",), ("carpet",), (None,), ("mh02ek5147",)], "nature_of_assets string")
    assert [r.excluded for r in report.asset_exclusion(cars).collect()] == [True, True, False, False, False]


def test_enrichment_route_and_cap(spark):
    rows = spark.createDataFrame(
        [(0, "a", "new", False, False), (1, "b", "unchanged", False, False), (2, "c", "unchanged", True, False), (3, "d", "unchanged", False, False), (4, "e", "collision", False, False), (5, "f", "changed", False, False)],
        "input_seq int, listing_key string, status string, details_parsed boolean, notice_parsed boolean",
    )
    stored = spark.createDataFrame([("c", False, False), ("d", False, False), ("f", True, True)], "listing_key string, details_at_enrich boolean, notice_at_enrich boolean")
    routed = enrich.enrichment_route(rows, stored)
    assert [(r.route, r.reason) for r in routed.orderBy("input_seq").collect()] == [
        ("reenrich", "status"), ("reenrich", "no_row"), ("reenrich", "details_parsed"), ("reuse", None), ("collision", "collision"), ("reenrich", "status"),
    ]
    for cap, want in ((2, ["reenrich", "reenrich", "deferred", "reuse", "collision", "deferred"]), (3, ["reenrich"] * 3 + ["reuse", "collision", "deferred"]), (9, ["reenrich"] * 3 + ["reuse", "collision", "reenrich"])):
        assert [r.route for r in enrich.cap_enrichment(routed, cap, ["input_seq"]).orderBy("input_seq").collect()] == want


def test_cap_with_ties_and_a_key(spark):
    rows = spark.createDataFrame([(7, f"k{k}", "reenrich", False) for k in range(5)], "input_seq int, listing_key string, route string, has_row boolean")
    got = enrich.cap_enrichment(rows, 2, ["input_seq", "listing_key"]).orderBy("listing_key").collect()
    assert [r.route for r in got] == ["reenrich"] * 2 + ["deferred"] * 3


def test_state_keeps_the_last_changed_row(spark):
    rows = [(0, DAY(2024, 1, 1), "a", "b", "c", "d", 5, None, None, None), (1, DAY(2024, 1, 2), "a", "b", "c", "d", 4, None, None, None), (2, DAY(2024, 1, 3), "A ", "b", "c", "d", 4, None, None, None)]
    changed = changes.change_status(spark.createDataFrame(rows, SCHEMA), ["input_seq"])
    state = changes.final_state(changed, ["input_seq"], "run_date", raw=["corporate_debtor", "reserve_price"])
    assert state.first().raw_json == '{"corporate_debtor":"a","reserve_price":4}'
    again = changes.final_state(changes.change_status(spark.createDataFrame(rows[2:], SCHEMA), ["input_seq"], state), ["input_seq"], "run_date", raw=["corporate_debtor", "reserve_price"])
    assert again.first().raw_json is None and changes.merge_state(state, again).first().raw_json == '{"corporate_debtor":"a","reserve_price":4}'


def test_merge_preserves_modules(spark):
    old = spark.createDataFrame([("a", "old", DAY(2024, 1, 1), True, True, False)], "listing_key string, narrative string, narrative_at date, narrative_attempted boolean, details_at_enrich boolean, notice_at_enrich boolean")
    new = spark.createDataFrame([("a", None, True, True), ("b", "fresh", False, False)], "listing_key string, narrative string, details_parsed boolean, notice_parsed boolean")
    got = enrich.merge_enrichment(old, new, ["narrative"], F.expr("DATE '2024-02-02'")).orderBy("listing_key").collect()
    assert [(r.narrative, r.narrative_at, r.narrative_attempted, r.notice_at_enrich) for r in got] == [
        ("old", DAY(2024, 1, 1), True, True), ("fresh", DAY(2024, 2, 2), True, False),
    ]


@pytest.mark.parametrize("chars", [2**20, 0])
def test_tiered_search_equals_contains(spark, chars):
    """By automata, and by words where there are too many phrases."""
    docs = [(1, "the quick brown fox jumps"), (2, "a quick brown dog"), (3, "quick-brown"), (4, None), (5, "xquick brown foxy"), (6, "a a the a the of"), (7, "aa\tbb  cc")]
    tiers = [(1, 1, "quick brown cat"), (1, 2, "quick brown"), (2, 1, "nothing like it"), (2, 2, "zzz"), (3, 1, "quick brown fox"), (4, 1, "own"), (5, 1, "k b"), (6, 1, " quick "), (7, 1, "a the a"), (8, 1, "quick-b"), (9, 1, "a\tb"), (10, 1, "b  c"), (11, 1, "")]
    got = enrich.tiered_search(spark.createDataFrame(tiers, "item_id int, tier int, phrase string"), spark.createDataFrame(docs, "doc_id int, text string"), 3, max_phrase_chars=chars)
    want = []
    for item in range(1, 12):
        for tier, phrase in sorted((t, p) for i, t, p in tiers if i == item):
            hits = [d for d, body in docs if body and phrase and phrase in body][:3]
            if hits:
                want += [(item, tier, d) for d in hits]
                break
        else:
            want.append((item, None, None))
    assert sorted(map(str, [(r.item_id, r.tier, r.doc_id) for r in got.collect()])) == sorted(map(str, want))


def test_responses(spark):
    rows = ['{"summary":"s","price_read":null,"risk_notes":[],"data_gaps":["x"]}', '```json\n{"summary":"s"}\n```', "no", None]
    got = enrich.parse_responses(spark.createDataFrame([(r,) for r in rows], "response string")).collect()
    assert got[0].narrative.data_gaps == ["x"] and got[0].narrative_flags == []
    assert got[1].narrative.summary == "s" and got[1].narrative_flags == ["narrative.missing.price_read", "narrative.missing.risk_notes", "narrative.missing.data_gaps"]
    assert got[2].narrative is None and got[3].narrative_flags == ["narrative.unparseable"]


def test_sections(spark):
    rows = [(0, 90.0, "new", None, None), (1, 90.0, "changed", DAY(2024, 1, 5), None), (2, None, "collision", DAY(2024, 1, 20), DAY(2024, 1, 2)), (3, 95.0, "unchanged", DAY(2023, 1, 1), None)]
    df = spark.createDataFrame(rows, "input_seq int, combined double, status string, auction_date date, emd_due_date date")
    got = report.report_sections(df, F.expr("DATE '2024-01-01'"), params=Params(top_n=2))
    assert sorted((r.section, r.nth, r.input_seq) for r in got.collect()) == [
        ("closing_soon", 1, 2), ("closing_soon", 2, 1), ("collisions", 1, 2), ("new_today", 1, 0), ("top_scored", 1, 3), ("top_scored", 2, 0), ("watchlist_changes", 1, 1),
    ]
    assert {r.section: r.n for r in report.section_counts(got.limit(0)).collect()} == dict.fromkeys(("top_scored", "closing_soon", "new_today", "watchlist_changes", "collisions"), 0)


def test_problem_lines(spark):
    df = spark.createDataFrame([(k, f"p{k}") for k in range(12)], "seq int, reason string")
    row = report.problem_lines(df).first()
    assert row.first == [f"p{k}" for k in range(10)] and row.more == 2


def test_unknown_flags_enrich_again(spark):
    rows = spark.createDataFrame([("a", "unchanged", True, False), ("b", "unchanged", False, True), ("c", "unchanged", False, False)], "listing_key string, status string, details_parsed boolean, notice_parsed boolean")
    stored = spark.createDataFrame([(k, None, None) for k in "abc"], "listing_key string, details_at_enrich boolean, notice_at_enrich boolean")
    got = enrich.enrichment_route(rows, stored).orderBy("listing_key").collect()
    assert [(r.route, r.reason) for r in got] == [("reenrich", "details_parsed"), ("reenrich", "notice_parsed"), ("reuse", None)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_patterns_are_tried_once_a_row(spark):
    """What several scores and flags are made of is worked out once: each pattern stands in the plan once."""
    rows = spark.createDataFrame([(1, "physical possession", "land of 2 acres", "x")], "input_seq long, notice_text string, nature_of_assets string, location string").repartition(1)
    plan = _plan(scoring.plot_score(scoring.possession_score(rows)))
    assert plan.count("physical possession") == plan.count("symbolic possession") == plan.count(r"\bindustrial\b") == 1
    assert plan.count("regexp_extract(") == 2


def test_observations_are_sorted_once(spark):
    """Both what owns a key and what came before are told in one order of the observations."""
    plan = _plan(changes.change_status(spark.createDataFrame(observations(30, 3), SCHEMA), ["run_date", "input_seq"]))
    assert plan.count("Sort [") == 1
