import numpy as np
import pytest

from lotmill.llm.ann import MultiIndex, centroids_for, op4_inverted_multi_index, scored, search, unit, walk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    vecs = {i: np.array(v, float) for i, v in rows}
    out = []
    for q in sorted(vecs):
        if q % 50 == 0:
            scores = sorted((-float(vecs[q] @ v / np.sqrt(v @ v) / np.sqrt(vecs[q] @ vecs[q])), i) for i, v in vecs.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("directory", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, directory):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{directory}/embeddings.parquet").collect()]
    want = brute(rows)
    got = op4_inverted_multi_index(spark, directory).collect()
    pairs = {(q, i): s for q, _, i, s in want}
    found = [r for r in got if (r.query_id, r.vec_id) in pairs]
    assert len(found) / len(want) >= 0.9 and len(got) == len(want)
    assert all(abs(r.score - pairs[(r.query_id, r.vec_id)]) < 1e-12 for r in found)


def test_all_probed_is_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=6)]) for k in range(300)]
    got = search(spark.createDataFrame(rows, SCHEMA), probe=1.0, centroids=8, list_rows=20)
    assert [(r.query_id, r.rank, r.vec_id) for r in got.orderBy("query_id", "rank").collect()] == [x[:3] for x in brute(rows)]


def test_ties_and_hot_vector(spark):
    rows = [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(0, 120)] + [(k, [1.0, 0.0, 0.0, float(k)]) for k in range(200, 230)]
    got = search(spark.createDataFrame(rows, SCHEMA), list_rows=16).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got if r.query_id == 0] == [1, 2, 3, 4, 5]
    assert [r.vec_id for r in got if r.query_id == 100] == [0, 1, 2, 3, 4] and len({r.score for r in got if r.query_id == 100}) == 1


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [0.5, 0.5]), (7, []), (50, [1e-30, 1e-30]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA + ", score string")
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 6, round(0.5**0.5, 9)), (0, 2, 50, round(0.5**0.5, 9)), (50, 1, 6, 1.0), (50, 2, 0, round(0.5**0.5, 9))]
    flat = spark.createDataFrame([(0, [2.0]), (1, [3.0]), (2, [-1.0])], SCHEMA)
    assert [(r.vec_id, r.score) for r in search(flat).orderBy("rank").collect()] == [(1, 1.0), (2, -1.0)]
    assert search(df.limit(0)).count() == 0 and search(df, df.limit(0)).count() == 0


def test_many_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(1000 * d + k, [float(x) for x in rng.normal(size=d)]) for d in range(1, 80) for k in (0, 1, 2)]
    rows += [(k, [float(x) for x in rng.normal(size=90)]) for k in range(200_000, 200_400)]
    got = search(spark.createDataFrame(rows, SCHEMA), list_rows=50, chunk=3, probe=1.0).collect()
    want = [x for d in range(1, 80) for x in brute([r for r in rows if r[0] // 1000 == d])] + brute([r for r in rows if r[0] >= 200_000])
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(x[:3] for x in want)


def test_clusters_are_pruned(spark):
    """Of clustered vectors a query looks at a small share, and finds its neighbours."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(150, 16))
    rows = [(k, [float(x) for x in centres[k % 150] + 0.15 * rng.normal(size=16)]) for k in range(9000)]
    index = MultiIndex(np.array([v for _, v in rows], float))
    assert index.probe < 0.1
    want = {(q, i) for q, _, i, _ in brute(rows)}
    got = search(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)


def test_share_follows_the_recall_asked_for():
    vecs = np.random.default_rng(7).normal(size=(3000, 32))
    shares = [MultiIndex(vecs, recall=r).probe for r in (0.5, 0.8, 0.95, 1.0)]
    assert shares == sorted(shares) and shares[0] < 0.5 and MultiIndex(vecs[:10]).probe == 1.0


def test_walk_is_by_summed_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(7), rng.random(9)
    pairs = walk(a, b, np.ones((7, 9), int), 63)
    sums = [a[i] + b[j] for i, j in pairs]
    assert len(set(pairs)) == 63 and sums == sorted(sums)
    assert len(walk(a, b, np.ones((7, 9), int), 10)) == 10


def share_scored(vecs, recall, count):
    """Of all entries, the share that queries probe and the share that they are multiplied with; and the recall."""
    index = MultiIndex(vecs, count, recall=recall)
    a, b = index.cells(vecs)
    np.add.at(index.sizes, (a, b), 1)
    order = np.lexsort((b, a))
    vecs, a, b = unit(vecs[order]), a[order], b[order]
    asked = np.arange(0, len(vecs), 50)
    walks = list(index.probes(vecs[asked], 6))
    probed = sum(int(index.sizes[p]) for w in walks for p in w)
    multiplied, best = 0, {}
    for first in range(len(index.first)):
        at = np.flatnonzero(a == first)
        for q, there, row in scored(vecs[asked], [[y for x, y in w if x == first] for w in walks], vecs[at], b[at]):
            multiplied += len(row)
            best.setdefault(q, []).extend(zip(row.tolist(), at[there].tolist()))
    hits = 0
    for q, me in enumerate(asked):
        truth = vecs @ vecs[me]
        truth[me] = -2
        near = set(np.argsort(-truth)[:5].tolist())
        hits += len(near & {i for _, i in sorted(x for x in best[q] if x[1] != me)[::-1][:5]})
    n = len(asked) * len(vecs)
    return probed / n, multiplied / n, hits / (5 * len(asked))


def test_work_is_in_proportion_to_what_is_probed(spark):
    rng = np.random.default_rng(8)
    clustered = rng.normal(size=(400, 16))[np.arange(12_000) % 400] + 0.1 * rng.normal(size=(12_000, 16))
    probed, multiplied, recall = share_scored(clustered, 0.9, 32)
    assert multiplied <= 1.1 * probed and multiplied < 0.02 and recall >= 0.9
    flat = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()], float)
    probed, multiplied, recall = share_scored(flat, 0.97, centroids_for(len(flat)))
    assert multiplied <= 1.1 * probed < 0.9 and recall >= 0.9
    print(probed, multiplied, recall)


def test_a_length_that_the_sample_would_miss(spark):
    """A length with few of all vectors, but many of its own, has an index of its own."""
    rng = np.random.default_rng(9)
    rows = [(k, [float(x) for x in rng.normal(size=4)]) for k in range(3000)] + [(k, [float(x) for x in rng.normal(size=3)]) for k in range(5000, 5200)]
    got = search(spark.createDataFrame(rows, SCHEMA), sample=400, recall=1.0).collect()
    want = brute([r for r in rows if len(r[1]) == 4]) + brute([r for r in rows if len(r[1]) == 3])
    assert len(got) == len(want) and len({x[:3:2] for x in want} & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)
    assert (centroids_for(10), centroids_for(51_282), centroids_for(10**6), centroids_for(10**10)) == (16, 28, 125, 256)
