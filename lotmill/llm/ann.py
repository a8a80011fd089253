"""Approximate nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut in two halves.  Each half is quantised by its own few centroids, and a vector is filed under its pair
of centroids: with K centroids a half there are K * K cells, for the cost of finding 2 K distances.  A query walks the
pairs in order of their summed distance with a heap, from the nearest pair outwards, until the cells it has passed hold
a share of all vectors; their vectors are then ranked by exact cosine on the original vectors.  The share is measured on
the sample that the centroids are fitted on: it is what finds ``recall`` of the true neighbours there, a few hundredths
where vectors form clusters and most of all vectors where they have no structure.

Entries are kept in lists, one for each centroid of the first half, in the order of the second half's centroids, and a list of
more than ``list_rows`` vectors is dealt into several by hash, so that a hot cell is many small lists.  Queries travel to the
lists that they probe and are multiplied with the cells that they probe there and no others; each list returns its best few.
Centroids grow with the root of the number of vectors, so that cells, and what is multiplied beyond the share, stay small.  A list that many queries probe is copied for each ``CHUNK`` of them, so that what moves
stays in proportion to what is compared.  Equal vectors are one entry with their least ids, as many as could ever be
returned.  Vectors of each length have cells and lists of their own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

#: Centroids a half: the root of the number of vectors by ``ROOT``, within these bounds.
LEAST_CENTROIDS, MOST_CENTROIDS, ROOT = 16, 256, 8
RECALL = 0.97
SAMPLE = 20_000
#: Vectors of a length below which the length is one cell, lengths that are indexed (those of most vectors), and queries of the
#: sample that the share is measured with.
FEW = 64
LENGTHS = 64
ASKED = 512
LIST_ROWS = 8192
#: Queries that one task holds beside a list, and that it compares at a time.
CHUNK = 16_384
BLOCK = 256
#: Scores this close are settled by exact recomputation, whatever the order in which products are summed up.
CLOSE = 1e-9


def kmeans(points: np.ndarray, count: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct random points; one for a half without components."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(rounds):
        near = nearest(points, centroids)
        sums, held = np.zeros_like(centroids), np.bincount(near, minlength=len(centroids))
        np.add.at(sums, near, points)
        centroids = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centroids)
    return centroids


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return distances(points, centroids).argmin(axis=1) if len(points) else np.empty(0, int)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Pairs of centroids by summed distance until their cells hold ``wanted`` entries.

    ``first`` and ``second`` are the distances of the halves.  A pair enters the heap when both pairs before it, one
    step nearer in either half, have left it.
    """
    order1, order2 = first.argsort(kind="stable"), second.argsort(kind="stable")
    near1, near2 = first[order1], second[order2]
    heap, entered, left, pairs, held = [(near1[0] + near2[0], 0, 0)], {(0, 0)}, set(), [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        left.add((i, j))
        a, b = int(order1[i]), int(order2[j])
        if sizes[a, b]:
            pairs.append((a, b))
            held += int(sizes[a, b])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(near1) and q < len(near2) and (p, q) not in entered:
                if (p == 0 or (p - 1, q) in left) and (q == 0 or (p, q - 1) in left):
                    entered.add((p, q))
                    heapq.heappush(heap, (near1[p] + near2[q], p, q))
    return pairs


def centroids_for(vectors: int) -> int:
    return min(MOST_CENTROIDS, max(LEAST_CENTROIDS, int(vectors**0.5 / ROOT)))


def scored(queries: np.ndarray, asked: list[list[int]], units: np.ndarray, cell: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Query, entries and products of the cells that each query asks for; ``cell`` rises.  A cell is multiplied once for all its queries."""
    cells, starts = np.unique(cell, return_index=True)
    ends = np.append(starts[1:], len(cell))
    by_cell: dict[int, list[int]] = {}
    for q, wanted in enumerate(asked):
        for b in wanted:
            by_cell.setdefault(int(b), []).append(q)
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for b, start, end in zip(cells.tolist(), starts.tolist(), ends.tolist()):
        if (who := by_cell.get(b)) is not None:
            for q, row in zip(who, queries[who] @ units[start:end].T):
                found.setdefault(q, []).append((np.arange(start, end), row))
    for q, parts in found.items():
        yield q, np.concatenate([e for e, _ in parts]), np.concatenate([r for _, r in parts])


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest  # first, so that squares neither vanish nor overflow
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine in double precision, summed up row by row, so that equal vectors have equal scores."""
    query = query / np.abs(query).max()
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors**2).sum(axis=1)) * np.sqrt((query**2).sum()))


class MultiIndex:
    """Centroids of both halves, the number of entries in each cell, and the share of them that a query looks at."""

    def __init__(self, vectors: np.ndarray, count: int = LEAST_CENTROIDS, k: int = 5, recall: float = RECALL, probe: float | None = None):
        units = unit(vectors)
        self.half = units.shape[1] // 2
        if len(units) < FEW:
            count = 1
        self.first, self.second = kmeans(units[:, : self.half], count), kmeans(units[:, self.half :], count)
        self.sizes = np.zeros((len(self.first), len(self.second)), np.int64)
        self.probe = self._measure(units, k, recall) if probe is None else probe

    def _measure(self, units: np.ndarray, k: int, recall: float) -> float:
        """Share of the sample that walks have to pass to reach the cells of ``recall`` of the true neighbours in it."""
        if len(self.first) * len(self.second) == 1:
            return 1.0
        cells = nearest(units[:, : self.half], self.first) * len(self.second) + nearest(units[:, self.half :], self.second)
        held = np.bincount(cells, minlength=len(self.first) * len(self.second))
        asked = units[:: max(1, len(units) // ASKED)]
        passed = []
        for at in range(0, len(asked), 64):
            some = asked[at : at + 64]
            scores = some @ units.T
            scores[np.arange(len(some)), (np.arange(at, at + len(some))) * max(1, len(units) // ASKED)] = -np.inf  # itself
            best = np.argpartition(-scores, min(k, len(units) - 1) - 1, axis=1)[:, :k]
            d1, d2 = distances(some[:, : self.half], self.first), distances(some[:, self.half :], self.second)
            order = (d1[:, :, None] + d2[:, None, :]).reshape(len(some), -1).argsort(axis=1, kind="stable")
            for row, near in zip(order, best):
                before = np.empty(len(held), np.int64)
                before[row] = np.cumsum(held[row]) - held[row]  # entries that a walk has passed when it comes to a cell
                passed.append(before[cells[near]] + 1)
        return min(1.0, float(np.quantile(np.concatenate(passed), recall, method="higher")) / len(units))

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        units = unit(vectors)
        return nearest(units[:, : self.half], self.first), nearest(units[:, self.half :], self.second)

    def probes(self, vectors: np.ndarray, least: int) -> Iterator[list[tuple[int, int]]]:
        """Cells of each query: they hold the share ``probe`` of all entries, and ``least`` at least."""
        units, wanted = unit(vectors), max(self.probe * self.sizes.sum(), least)
        d1, d2 = distances(units[:, : self.half], self.first), distances(units[:, self.half :], self.second)
        for a, b in zip(d1, d2):
            yield walk(a, b, self.sizes, wanted)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part, as ``id`` and ``vec`` (doubles), each pair once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return rows.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False))).distinct()


def search(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    k: int = 5,
    recall: float = RECALL,
    probe: float | None = None,
    centroids: int | None = None,
    sample: int = SAMPLE,
    list_rows: int = LIST_ROWS,
    chunk: int = CHUNK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest of ``vectors`` found for each of ``queries``: query_id, rank (from 1), vec_id, score (cosine).

    Without ``queries``, they are the rows whose id is divisible by 50.  A row with the query's id is no candidate.  The
    centroids are fitted on at most ``sample`` vectors, the least by hash; every vector is indexed.  A query looks at the
    share ``probe`` of all entries; without it, at the share that finds ``recall`` of the true neighbours in the sample
    (neighbours in all vectors are nearer than those in a sample, so they are found no less often).

    Defined results: vectors that are null, all zero or hold a null or non-finite component take no part, nor do null
    ids; with vectors of several lengths each length, however many there are, is a world of its own (the ``LENGTHS`` with most
    vectors are indexed, each with its part of the sample; others, and those of fewer than ``FEW`` vectors, are searched
    whole); rows that repeat id and vector count once; of equal scores the
    smaller id comes first; fewer candidates than ``k`` are all returned; without candidates or queries the result is
    empty; other columns are left out.
    """
    rows = stage_table(usable(vectors, id_col, vector_col), "vectors")
    asked = rows.where("id % 50 = 0") if queries is None else stage_table(usable(queries, id_col, vector_col), "asked")
    many = rows.groupBy(F.size("vec").alias("dim")).count().where(F.col("count") >= FEW).orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()
    indexes = {}
    for r in many:
        drawn = rows.where(F.size("vec") == r["dim"]).orderBy(F.xxhash64("id", "vec")).limit(max(FEW, sample // len(many))).collect()
        indexes[r["dim"]] = MultiIndex(np.array([d["vec"] for d in drawn], float), centroids or centroids_for(r["count"]), k, recall, probe)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["vec"].map(len).to_numpy()
            a, b = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int32)
            for dim in np.unique(dims):
                if int(dim) in indexes:
                    at = np.flatnonzero(dims == dim)
                    a[at], b[at] = indexes[int(dim)].cells(np.stack(batch["vec"].to_numpy()[at]).astype(float))
            yield pd.DataFrame({"id": batch["id"], "vec": batch["vec"], "dim": dims.astype("int32"), "a": a, "b": b})

    filed = rows.mapInPandas(file, "id long, vec array<double>, dim int, a int, b int")
    nth = F.row_number().over(Window.partitionBy("dim", "a", "b", "vec").orderBy("id"))
    filed = filed.withColumn("nth", nth).where(F.col("nth") <= k + 1)  # of equal vectors no more can be returned
    filed = stage_table(filed.drop("nth"), "filed")
    held = filed.groupBy("dim", "a", "b").count()
    for r in held.where(F.col("dim").isin(list(indexes))).collect():  # one row a cell, of at most sample / FEW lengths
        indexes[r["dim"]].sizes[r["a"], r["b"]] = r["count"]
    parts = held.groupBy("dim", "a").agg(F.ceil(F.sum("count") / list_rows).cast("int").alias("parts"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for dim, of in batch.groupby(batch["vec"].map(len)):
                for at in range(0, len(of), BLOCK):
                    block = of.iloc[at : at + BLOCK]
                    if (index := indexes.get(int(dim))) is None:
                        out += [(q, vec, dim, 0, [0]) for q, vec in zip(block["id"], block["vec"])]
                        continue
                    vecs = np.stack(block["vec"].to_numpy()).astype(float)
                    for q, vec, pairs in zip(block["id"], block["vec"], index.probes(vecs, k + 1)):
                        cells: dict[int, list[int]] = {}
                        for a, b in pairs:
                            cells.setdefault(a, []).append(b)
                        out += [(q, vec, dim, a, bs) for a, bs in cells.items()]
            yield pd.DataFrame(out, columns=["q", "qvec", "dim", "a", "bs"])

    travelling = asked.mapInPandas(ask, "q long, qvec array<double>, dim int, a int, bs array<int>")
    travelling = stage_table(travelling, "travelling")
    load = travelling.groupBy("dim", "a").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    lists = stage_table(parts.join(load, ["dim", "a"]), "lists")  # of lists that a query probes
    deal = lambda salt, n, *keys: F.pmod(F.xxhash64(*keys, F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    travelling = travelling.join(lists, ["dim", "a"]).withColumn("c", deal(1, "chunks", "q", "qvec")).withColumn("p", every("parts")).drop("parts", "chunks")
    entries = filed.join(lists, ["dim", "a"]).withColumn("p", deal(2, "parts", "id")).withColumn("c", every("chunks")).drop("parts", "chunks")

    def compare(asking: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asking) and len(entries):
            entries = entries.sort_values("b", kind="stable")
            ids, cell = entries["id"].to_numpy(), entries["b"].to_numpy()
            vecs = np.stack(entries["vec"].to_numpy()).astype(float)
            units = unit(vecs)
            for at in range(0, len(asking), BLOCK):
                block = asking.iloc[at : at + BLOCK]
                qs, qvecs = block["q"].to_numpy(), np.stack(block["qvec"].to_numpy()).astype(float)
                for q, there, row in scored(unit(qvecs), list(block["bs"]), units, cell):
                    row = np.where(ids[there] != qs[q], row, -np.inf)
                    limit = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                    top = there[(row >= limit - CLOSE) & (row > -np.inf)]
                    exact = cosine(qvecs[q], vecs[top])
                    best = np.lexsort((ids[top], -exact))[:k]
                    out += zip([qs[q]] * len(best), ids[top][best], exact[best])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    key = ("dim", "a", "p", "c")
    best = travelling.groupBy(*key).cogroup(entries.groupBy(*key)).applyInPandas(compare, "query_id long, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # an id that repeats with several vectors
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_inverted_multi_index(spark, sf_dir):
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
