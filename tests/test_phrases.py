import random
import re

import pytest

from lotmill.operators import enrich, phrases

WORD = "[^\\W]"


def texts(seed, count, words="ab Ab a-b é_ NCR \t x1 the of"):
    rng = random.Random(seed)
    return [None if rng.random() < 0.05 else "".join(rng.choice(words.split(" ") + [" ", "  ", ",", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(count)]


@pytest.mark.parametrize("part_chars", [2**20, 40])
def test_containing_equals_brute_force(spark, part_chars):
    docs = [(None if k % 50 == 7 else k // 2, t) for k, t in enumerate(texts(1, 300))]
    sought = sorted({t[a : a + 4] for t in texts(2, 60) if t for a in (0, 3)} | {"", "zzz", "of"})
    got = phrases.containing(
        spark.createDataFrame(docs, "doc_id long, body string").repartition(4), spark.createDataFrame([(p,) for p in [*sought, None]], "phrase string"), 3, part_chars,
    )
    firsts = {}
    for r in got.collect():
        firsts.setdefault(r.phrase, set()).add(r.doc_id)
    order = lambda i: (i is not None, i or 0)
    for p in sought:
        hits = sorted({i for i, t in docs if p and t and p in t}, key=order)[:3]
        assert sorted(firsts.get(p, ()), key=order)[:3] == hits, p


@pytest.mark.parametrize("part_chars", [2**20, 30])
@pytest.mark.parametrize("bounds", [True, False])
def test_names_equal_patterns(spark, part_chars, bounds):
    names = [(0, "first", "ab"), (0, "first", "NCR  the"), (1, "second", "a-B"), (2, "third", "x1"), (2, "third", None), (3, "fourth", " "), (4, "fifth", "of\tof"), (5, "sixth", "é_"), (6, "same", "AB"), (7, "long", "the of ab ncr x1 the of ab")]
    rows = list(enumerate(texts(3, 400)))
    got = phrases.name_places(
        spark.createDataFrame(rows, "k int, t string").repartition(3), "t", spark.createDataFrame(names, "ord int, name string, variant string"), "k", bounds=bounds, part_chars=part_chars,
    ).collect()
    edge = r"\b" if bounds else ""
    patterns = [(o, n, re.compile(edge + r"\s+".join(map(re.escape, v.split())) + edge, re.I)) for o, n, v in names if v and v.strip()]
    want = {}
    for k, t in rows:
        found = sorted({(o, n) for o, n, p in patterns if t and p.search(" ".join(t.split()))})
        want[k] = (found[0][1] if found else None, len(found))
    assert {r.k: (r.named.name, r.named.n) for r in got} == want and len(got) == len(rows)


def test_a_table_of_many_variants(spark):
    variants = spark.range(100_000).selectExpr("CAST(id DIV 2 AS INT) AS ord", "concat('place ', id DIV 2) AS name", "concat('Place no ', id) AS variant")
    rows = spark.createDataFrame([(k, f"near place  NO {k * 997 % 100_000}, and place no 7") for k in range(500)], "k int, t string")
    got = {r.k: (r.named.name, r.named.n) for r in phrases.name_places(rows, "t", variants, "k").collect()}
    for k in range(500):
        numbers = {k * 997 % 100_000 // 2, 3}
        assert got[k] == (f"place {min(numbers)}", len(numbers))


def test_bodies_are_read_once_and_never_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tiers = spark.createDataFrame([(1, 1, "abc"), (2, 1, "def")], "item_id int, tier int, phrase string")
    plan = enrich.tiered_search(tiers, docs, 3)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert plan.count("documents.parquet") == 1 and "contains" not in plan.lower()
    below = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in below[: below.index("documents.parquet")]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, body string")
    none = spark.createDataFrame([], "phrase string")
    assert phrases.containing(docs, none, 3).count() == 0 and phrases.containing(docs.limit(0), spark.createDataFrame([("a",)], "phrase string"), 3).count() == 0
    names = spark.createDataFrame([], "ord int, name string, variant string")
    assert phrases.name_places(docs, "body", names, "doc_id").first().named.n == 0
