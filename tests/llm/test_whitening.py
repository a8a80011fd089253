import math

import numpy as np
import pytest

from lotmill.llm.whitening import deviations, one_sided_jacobi, op12_jacobi_whitening, pivoted_cholesky, principal, whiten


def good(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, components=4):
    """Rows (id, component): deviation, whitened up to its sign, explained; by whole numbers and numpy's own solver."""
    kept = [(i, [math.floor(float(c) * 256) for c in v]) for i, v in rows if good(v)]
    out = {}
    for length in {len(x) for _, x in kept}:
        here = [(i, x) for i, x in kept if len(x) == length]
        fit = sorted({tuple(x) for _, x in here})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array(fit, float) - np.array(sums) / n
        values, vectors = np.linalg.eigh(centred.T @ centred / n) if length else (np.empty(0), None)
        rank = int((values > 1e-9 * values.max(initial=0)).sum())
        for i, x in here:
            for k in range(min(components, rank)):
                white = (np.array(x, float) - np.array(sums) / n) @ vectors[:, -1 - k] / math.sqrt(values[-1 - k])
                out.setdefault((i, k + 1), []).append((n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), abs(white), values[-1 - k] / values.sum()))
    return out


def check(df, rows, components=4):
    want = brute(rows, components)
    got = {}
    for r in df.collect():
        got.setdefault((r[0], r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
        assert r.identity_error <= 1e-9
    assert got.keys() == want.keys()
    for key in want:
        assert [g[:2] for g in sorted(got[key])] == [w[:2] for w in sorted(want[key])]
        np.testing.assert_allclose([g[2:] for g in sorted(got[key])], [w[2:] for w in sorted(want[key])], rtol=1e-7, atol=1e-9)


def vectors(count, length, seed=1):
    rng = np.random.default_rng(seed)
    scales = 2.0 ** -np.arange(length)
    return [[float(c) for c in v] for v in (rng.normal(size=(count, length)) * scales * 3 + 5).astype(np.float32)]


def test_against_brute_force(spark):
    rows = list(enumerate(vectors(400, 7) + vectors(50, 7)))  # the last 50 repeat the first
    rows += [(1000, None), (1001, [1.0] * 6 + [None]), (1002, [float("nan")] * 7), (1003, [float("inf")] + [0.0] * 6), (None, rows[3][1]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    check(whiten(df).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"), rows)


def test_lengths_ranks_and_small_fits(spark):
    rows = list(enumerate(vectors(60, 3) + vectors(40, 5, 2) + [[1.0], [2.0], [2.0]] + [[], []] + [[4.0, 4.0]] + [[float(k), 2.0 * k, -1.0 * k, 7.0] for k in range(9)]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(whiten(df, components=5), rows, 5)


def test_exact_deviations():
    x = np.array([[3, -4], [2**40, 7]])
    assert deviations(x, 5, [10, -3]) == [25 + 289, (5 * 2**40 - 10) ** 2 + 38**2 if (5 * 2**40 - 10) ** 2 < 2**63 else None]
    assert deviations(np.array([[2**30, 1]]), 3, [1, 1]) == [None if (3 * 2**30 - 1) ** 2 + 4 >= 2**63 else (3 * 2**30 - 1) ** 2 + 4]


def test_huge_entries(spark):
    rows = [(k, [v, float(k)]) for k, v in enumerate([3e38, -3e38, 1.0, 2.0])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {(r.vec_id, r.deviation is None) for r in got} == {(0, True), (1, True), (2, False), (3, False)}
    assert all(math.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("size, rank", [(1, 1), (2, 2), (9, 9), (30, 11), (65, 64)])
def test_decomposition(size, rank):
    rng = np.random.default_rng(size)
    half = rng.normal(size=(size, rank)) * 10.0 ** -np.linspace(0, 3, rank)
    scatter = half @ half.T
    factor, order = pivoted_cholesky(scatter)
    assert factor.shape[1] == rank
    np.testing.assert_allclose(factor @ factor.T, scatter[np.ix_(order, order)], atol=1e-12 * scatter.max())
    assert np.allclose(np.triu(factor, 1)[:, 1:] if rank > 1 else 0, 0)
    columns = one_sided_jacobi(factor)
    norms = np.sqrt((columns**2).sum(0))
    np.testing.assert_allclose((columns / norms).T @ (columns / norms), np.eye(rank), atol=1e-12)
    values, components = principal(scatter)
    np.testing.assert_allclose(values, np.linalg.eigvalsh(scatter)[::-1][:rank], rtol=1e-6)
    np.testing.assert_allclose(components.T @ components, np.eye(rank), atol=1e-12)
    np.testing.assert_allclose(scatter @ components, components * values, atol=1e-12 * values.max())


def test_no_scatter():
    assert principal(np.zeros((3, 3)))[0].size == 0 and principal(np.zeros((0, 0)))[0].size == 0


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(k, [float(k), 1.0], "mine", 5) for k in range(3)], "vec_id long, embedding array<double>, Component string, other int")
    got = whiten(df)
    assert got.columns == ["vec_id", "embedding", "other", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 3 and whiten(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(op12_jacobi_whitening(spark, sf_dir), rows)
