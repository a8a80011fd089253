import hashlib

import pytest
from compare import duck_rows, spark_rows

from lotmill.llm.exact_dedup import OP1_SQL, exact_dedup, maybe_repeated, op1_exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "Éa"), (6, "éa"), (None, "x"), (7, "x"), (None, "only"), (None, "only"), (8, "y" * 200_000), (9, "Y" * 200_000), (10, "z"), (10, "z"), (10, "Z"), (2, "other")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = False
        for i in ids:
            first = i == keep and not kept
            kept |= first
            out.append((i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, out))


def answer(df):
    return sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in df.collect())


@pytest.mark.parametrize("bits", [2**29, 2**15])
def test_edges(spark, bits):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert answer(exact_dedup(df, max_filter_bits=bits)) == brute(ROWS)


def test_filter_that_is_full(spark):
    rows = [(k, f"t{k % 90_000}") for k in range(100_000)]  # more slots are asked for than there are
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup(df, max_filter_bits=2**15)
    assert got.where("kept").count() == 90_000 and got.where("group_size = 2").count() == 20_000


@pytest.mark.parametrize("bits, most", [(2**20, 0.02), (2**17, 0.35), (2**15, 1.0)])
def test_rows_that_shuffle(spark, bits, most):
    """Rows without a copy pass straight through but for the filter's share of mistakes; nothing shuffles for them alone."""
    rows = [(k, f"text number {k}") for k in range(32_000)] + [(k, f"twice {k % 500}") for k in range(40_000, 41_000)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), max_filter_bits=bits)
    assert got.where("kept").count() == 32_500
    through, settled = branches(got)
    assert through + settled == len(rows) and 1000 <= settled <= 1000 + most * 32_000


@pytest.mark.parametrize("columns", [None, ["doc_id"], ["other"]])
def test_ranges_of_hashes(spark, columns):
    """More rows than one small filter holds: pass one works in ranges, and few rows without a copy shuffle in either pass."""
    rows = [(k, f"text number {k}", k % 7) for k in range(30_000)] + [(k, f"Twice {k % 500}", 3) for k in range(40_000, 41_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other long")
    got = exact_dedup(df, max_filter_bits=2**15, columns=columns)
    assert got.columns[:-4] == {None: ["doc_id", "text", "other"], ("doc_id",): ["doc_id"]}.get(columns and tuple(columns), ["doc_id", "other"])
    assert answer(got) == brute([r[:2] for r in rows])
    through, settled = branches(got)
    assert through + settled == len(rows) and 1000 <= settled <= 1200
    thin = df.selectExpr("doc_id AS __id", "sha2(lower(text), 256) AS text_sha256", "xxhash64(lower(text)) AS __hash")
    assert 1000 <= maybe_repeated(thin, 16, 2**15).count() <= 1000 + 0.25 * 30_000


def branches(df):
    """Rows of each branch of the union that ends the operator: those that pass through, and those that were shuffled."""
    parts = df._jdf.queryExecution().analyzed().children()
    dataset = df.sparkSession._jvm.org.apache.spark.sql.classic.Dataset
    return [dataset.ofRows(df.sparkSession._jsparkSession, parts.apply(k)).count() for k in range(parts.size())]


def test_one_row_repeated_many_times(spark):
    rows = [(7, "same")] * 3000 + [(3, "same"), (9, "other")]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert answer(got) == brute(rows) and got.where("kept").count() == 2


def test_a_third_is_one_text(spark):
    rows = [(k, "same" if k % 3 == 0 else f"t{k}") for k in range(3000)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert answer(got) == brute(rows)


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "mine", 5)], "doc_id long, text string, Keep_ID string, other int")
    got = exact_dedup(df)
    assert got.columns == ["doc_id", "text", "other", "keep_id", "group_size", "kept", "text_sha256"]
    assert got.first().keep_id == 1 and exact_dedup(df.limit(0)).count() == 0


def test_query(spark, duck, sf_dir):
    assert spark_rows(op1_exact_dedup(spark, sf_dir)) == duck_rows(duck, OP1_SQL)


def test_main_path_is_native(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    text = exact_dedup(df)._jdf.queryExecution().toString()
    assert not any(w in text for w in ("Python", "Pandas", "Arrow"))
