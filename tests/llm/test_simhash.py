import itertools
import re

import numpy as np
import xxhash

from lotmill.llm import simhash
from lotmill.llm.simhash import components, drop_near_duplicates, links, op7_simhash_pigeonring, signed, simhash_components


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=2):
    prints = np.array(prints, np.uint64)
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(ids))]


def test_query(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    ids, prints = [i for i, _ in rows], [brute_print(t) for _, t in rows]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op7_simhash_pigeonring(spark, sf_dir).collect()}
    roots = brute_components(ids, prints)
    assert got == {i: (f"{p:016x}", ids[k]) for i, p, k in zip(ids, prints, roots)}


def test_links_by_either_way(spark):
    rng = np.random.default_rng(3)
    prints = set()
    for base in rng.integers(0, 1 << 63, 30, dtype=np.uint64):
        for _ in range(25):
            x = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(k)
            prints.add(x)
    prints = sorted(prints)
    want = brute_components(prints, prints)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for max_key in (8192, 4):
        found = {r.node: r.least for r in components(links(df, max_key=max_key)).collect()}
        got = [found.get(signed(p), signed(p)) for p in prints]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) < len(prints)


def test_chains_lose_nothing():
    """Every two fingerprints within the radius keep the budgets of some chain: the theorem, for all places of two bits."""
    count, radius = simhash.SEGMENTS, simhash.RADIUS
    for a, b in itertools.combinations_with_replacement(range(64), 2):
        x = (1 << a) | (1 << b)
        assert any(
            all((x & simhash.chain_mask(first, n, count)).bit_count() <= n * radius // count for n in range(1, count + 1)) for first in range(count)
        )


def test_ring_filter_is_the_radius():
    rng = np.random.default_rng(4)
    differ = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) & rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    for radius in (2, 8, 16, 24):
        assert (simhash.ring_near(differ, radius) == (np.bitwise_count(differ) <= radius)).all()


def test_large_ids_beside_null(spark):
    rows = [(None, "a b c d"), (9007199254740993, "x y z w"), (2**63 - 1, "k l m n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.component_id) for r in simhash_components(df).collect()} == {(i, i) for i, _ in rows}


def test_long_path_of_links(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (502, 501)], "a long, b long")
    got = {r.node: r.least for r in components(edges).collect()}
    assert all(got[k] == 0 for k in range(201)) and got[500] == got[501] == got[502] == 500
    assert components(edges.limit(0)).count() == 0


def test_edges(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(5, None), (3, ""), (9, " \n"), (1, "one two"), (2, "ONE two"), (7, long), (8, long + " end"), (None, long), (4, "Éa b c d"), (6, "éa b c d"), (2, "ONE two"), (None, "alone here now")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, Component_ID string")
    got = simhash_components(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == len(rows)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in got.collect() if r.doc_id is not None}
    assert all(found[i] == ("0" * 16, 3) for i in (5, 3, 9)) and found[2][1] == 1 and found[8][1] == found[7][1] == 7
    assert {i: f for i, (f, _) in found.items()} == {i: f"{brute_print(t):016x}" for i, t in rows if i is not None}
    assert sorted(str(r.component_id) for r in got.collect() if r.doc_id is None) == ["7", "None"]
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [3, 1, 7, 4, 6, None] if found[4][1] != found[6][1] else [3, 1, 7, 4, None]))
    assert simhash_components(df.limit(0)).count() == 0 and drop_near_duplicates(df.limit(0)).count() == 0
