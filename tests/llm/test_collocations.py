import re
from collections import Counter

import pytest
from compare import duck_rows, spark_rows

from lotmill.llm import collocations as C
from lotmill.llm.collocations import OP11_SQL, collocations, op11_stripe_collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count=30, top=2000, max_words=4):
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    count[lang, words[i : i + m]] += 1
    found = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= min_count}
    inside = lambda short, long: any(long[i : i + len(short)] == short for i in range(len(long) - len(short) + 1))
    out = {}
    for (lang, p), a in found.items():
        if any(g == lang and len(q) > len(p) and inside(p, q) and 100 * b >= 80 * a for (g, q), b in found.items()):
            continue
        score, _, left, right = min((2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((g, k + 1, p.decode(), -a, x, y, n[g], -s) for g, found in out.items() for k, (s, a, p, x, y) in enumerate(sorted(found)[:top]))


def answer(df):
    return sorted(tuple(r) for r in df.collect())


def texts():
    rows = [("en", f"New York City, the Big Apple {k % 3}! the big\tapple  of new york. Of the the the") for k in range(40)]
    rows += [("de", "Der große Straße;ÉTÉ de la Straße\r\nder große Bär") for _ in range(35)] + [(None, "und so und so und so")] * 12 + [("und", "und so")] * 9
    rows += [("en", None), ("en", ""), (None, None), ("", "a b a b a b " * 20), ("en", "..!!\n\n  \t "), ("en", "nbsp here and there " * 31), ("xx", "rare words")]
    return rows + [("en", "a very long text of few words " * 3000), ("en", "x" * 5000)]


@pytest.mark.parametrize("min_count, top, max_words", [(30, 2000, 4), (5, 7, 3), (1, 2000, 2), (3, 2000, 5)])
def test_against_brute_force(spark, min_count, top, max_words):
    df = spark.createDataFrame(texts(), "lang string, text string").repartition(5)
    assert answer(collocations(df, min_count=min_count, top=top, max_words=max_words)) == brute(texts(), min_count, top, max_words)


@pytest.mark.parametrize("block, chars, parts", [(50, 64, 4), (7, 16, 1024)])
def test_small_blocks_and_hot_prefixes(spark, monkeypatch, block, chars, parts):
    """Windows across blocks and slices count once, stripes in parts as whole ones, and a full filter loses nothing."""
    rows = [r if r[1] is None else (r[0], r[1][:3000]) for r in texts()]
    want = brute(rows, 5)
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    monkeypatch.setattr(C, "BLOCK_CHARS", block)
    monkeypatch.setattr(C, "SLICE_CHARS", chars)
    monkeypatch.setattr(C, "PARTS", parts)
    assert answer(collocations(df, min_count=5)) == want
    monkeypatch.setattr(C.PhraseFilter, "holds", lambda self, hashes: hashes == hashes)
    assert answer(collocations(df, min_count=5)) == want


def test_filter_prunes(spark):
    rows = [("en", f"one{k} two three four{k} five six seven") for k in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("lang", "text")
    words = spark.createDataFrame([("en", w) for w in ("two", "three", "five", "six", "seven")], "lang string, phrase string")
    got = C.stripes(df, 1, C.phrase_filter(words, 1, 2**29), {}).collect()
    assert {(r.prefix, r.next, r.f) for r in got} == {("two", "three", 40), ("five", "six", 40), ("six", "seven", 40)}


def test_merging_needs_one_exchange(spark):
    df = spark.createDataFrame(texts(), "lang string, text string")
    plan = C.stripes(df, 0, None, {})._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Final Plan ==")[-1].count("Exchange") == 1, plan


def test_large_numbers(spark):
    assert spark.sql("SELECT 2000000 * cast(9000000000000000000 AS decimal(20,0)) div (9000000000000000000L + 1L) AS s").first().s == 1999999


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([("en", "a b", "x", 1)] * 30, "lang string, text string, Phrase string, n int")
    assert answer(collocations(df)) == [("en", 1, "a b", 30, 30, 30, 60, 1000000)]
    assert collocations(df.limit(0)).count() == 0


def test_query(spark, duck, sf_dir):
    got = spark_rows(op11_stripe_collocations(spark, sf_dir))
    assert got == duck_rows(duck, OP11_SQL) and len(got[1]) > 10
