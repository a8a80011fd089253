"""Near-duplicates by SimHash at a stated similarity of word shingles, every link confirmed exactly.

Two texts with 0.8 of their shingles in common have SimHashes of 64 bits that differ in some ten bits, up to twenty.  A
radius that wide has no selective run of equal segments, so fingerprints alone cannot bring all such texts together on a
large corpus.  Runs of equal segments, chains and Hamming distances are taken as in the SimHash operator, with its radius,
and the fingerprints that they link are one key of their texts.  Beside it stand MinHash keys, for texts that no run
reaches: a text has ``BANDS`` of ``ROWS`` values each, and two texts of similarity s share one with probability
1 - (1 - s^ROWS)^BANDS, which is 0.99997 at 0.8.  What a key brings together is then pruned by chains of segments on the
ring whose differences keep within the budgets of ``RADIUS`` bits, and what is left is settled by comparing the sets of
shingles themselves.

Texts that keys bring together, at one or more removes, are a cluster.  A small cluster is compared whole in one task.  A
large one is dealt into blocks at random, ``DEALS`` times over, and each block compared; in a group of copies that joins
nearly all of it, at a cost in proportion to its size.  What is left are the keys that texts of several parts share: there
pairs of blocks are compared, but for those of one and the same part, so that no pair with a key in common is left out
and no task holds more than some two blocks.  Only edges that join two parts are emitted.  Equal texts are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import A_TO_Z, release_memory, stage_table, text_or_empty
from .simhash import MAX_BROADCAST_ROWS, components, ring_near
from .simhash import links as fingerprint_links

WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 4
#: Bits in which the SimHashes of texts at the bound differ at most: five standard deviations above their mean.
RADIUS = 24
#: Texts and shingles of a block.
BLOCK = 512
BLOCK_SHINGLES = 500_000
#: Times that a cluster of several blocks is dealt into blocks.
DEALS = 2
_LOWER = bytes.maketrans(A_TO_Z.encode(), A_TO_Z.lower().encode())
_SEEDS = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_TIMES, _PLUS = _SEEDS[0] | np.uint64(1), _SEEDS[1]


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct runs of ``words`` words, sorted; a text of fewer words is one run."""
    import xxhash

    tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()  # at \x20 and \x09-\x0D
    run = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([digest(run, 42)], np.uint64)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[: -words] + 1])
    return np.unique(np.array([digest(run[a:b], 42) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist())], np.uint64))


def keys(hashes: np.ndarray) -> np.ndarray:
    """The text's key of each band, as signed longs."""
    least = np.full(len(_TIMES), ~np.uint64(0))
    for k in range(0, len(hashes), 2048):  # of a very long text a part at a time
        h = hashes[k : k + 2048, None]
        np.minimum(least, (h * _TIMES + _PLUS).min(axis=0), out=least)
    out = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        out = (out ^ row ^ (row >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def simhash(hashes: np.ndarray) -> np.uint64:
    """A bit is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[k : k + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return (np.uint64(1) << np.flatnonzero(ones * 2 > len(hashes)).astype(np.uint64)).sum(dtype=np.uint64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Id, ``node`` (hash of the text), ``size`` (distinct shingles), ``fp`` (SimHash, a signed long) and ``keys`` of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, found = [], [], []
            for text in batch.column("__text"):
                hashes = shingles(text.as_py(), words)
                sizes.append(len(hashes))
                prints.append(simhash(hashes))
                found.append(keys(hashes))
            columns = {"__id": batch.column("__id"), "node": batch.column("node"), "size": pa.array(sizes, pa.int64()), "fp": np.array(prints, np.uint64).view(np.int64)}
            yield pa.RecordBatch.from_pydict({**columns, "keys": pa.array(found, pa.list_(pa.int64()))})
        release_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), F.xxhash64(text).alias("node"))
    return rows.mapInArrow(work, f"__id {kind}, node long, size long, fp long, keys array<long>")


def similar(
    sets: list[np.ndarray], similarity: float = SIMILARITY, radius: int = RADIUS, part: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Pairs of places that connect all sets whose Jaccard similarity reaches the bound; sets of equal ``part`` are connected
    already.  There is at most one pair less than there are parts."""
    sizes = np.array([len(s) for s in sets])
    stops = np.cumsum(sizes)
    prints = np.array([simhash(s) for s in sets], np.uint64)
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    part = np.arange(len(sets)) if part is None else np.array(part)
    edges = []
    for i in range(len(sets) - 1):
        others = np.flatnonzero(part[i + 1 :] != part[i]) + i + 1  # what is joined already needs no second edge
        others = others[ring_near(prints[others] ^ prints[i], radius)]
        if not len(others):
            continue
        has = np.zeros(len(values), bool)
        has[flat[stops[i] - sizes[i] : stops[i]]] = True
        for j in others.tolist():
            common = int(np.count_nonzero(has[flat[stops[j] - sizes[j] : stops[j]]]))
            if part[i] != part[j] and common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9:
                part[part == part[j]] = part[i]
                edges.append((i, j))
    return edges


def _parts(block: int) -> Column:
    """Blocks that a group of ``size``s is cut into."""
    return F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("size") / F.lit(BLOCK_SHINGLES)))


def _compare(docs: DataFrame, cells: DataFrame, text_col: str, words: int, similarity: float) -> DataFrame:
    """Edges (a, b) that join different parts within a cell; ``cells`` has a node, its part and the list of its cells."""
    cells = stage_table(cells, "cells")
    places = cells.agg(F.sum(F.size("cells"))).first()[0] or 0
    wanted = F.broadcast(cells) if places <= MAX_BROADCAST_ROWS else cells
    texts = docs.select(F.xxhash64(text_or_empty(text_col)).alias("node"), text_or_empty(text_col).alias("text"))
    # a text moves once; it goes to its cells from there
    texts = texts.join(wanted, "node").dropDuplicates(["node"]).select("node", "part", "text", F.explode("cells").alias("cell"))

    def work(cell: pd.DataFrame) -> pd.DataFrame:
        names = cell["node"].to_numpy()
        found = similar([shingles(t, words) for t in cell["text"]], similarity, part=cell["part"].to_numpy())
        return pd.DataFrame([(names[i], names[j]) for i, j in found], columns=["a", "b"]).astype("int64")

    return texts.groupBy("cell").applyInPandas(work, "a long, b long")


def _unsettled(keyed: DataFrame, large: DataFrame, block: int) -> DataFrame:
    """Cells of the keys that texts of several parts share; ``large``: node, size, part.

    A part that fills several blocks of a key has these to itself, the other texts of the key are mixed.  Two blocks make a
    cell, unless both are of one part; so all pairs of different parts with a key in common meet.
    """
    key = ["band", "key"]
    rows = keyed.select("node", *key).join(large, "node")
    shared = rows.groupBy(*key).agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select(*key)
    rows = stage_table(rows.join(shared, key), "shared")
    own = rows.groupBy(*key, "part").agg(_parts(block).alias("own"))
    rows = rows.join(own, [*key, "part"]).withColumn("of", F.when(F.col("own") > 1, F.col("part")))
    mixed = rows.where("of IS NULL").groupBy(*key).agg(_parts(block).alias("mixed"))
    rows = rows.join(mixed, key, "left")
    count = F.when(F.col("of").isNull(), F.col("mixed")).otherwise(F.col("own"))
    at = F.struct(F.coalesce("of", F.lit(0).cast("long")).alias("of"), F.col("of").isNull().alias("mix"), F.pmod(F.xxhash64("node"), count).alias("n"))
    rows = stage_table(rows.select("node", "part", *key, at.alias("at")), "blocks")
    blocks = rows.select(*key, "at").distinct()
    pairs = blocks.join(blocks.withColumnRenamed("at", "to"), key).where("at < to OR (at = to AND at.mix)")
    pairs = pairs.where("at = to OR at.mix OR to.mix OR at.of <> to.of")
    cell = F.struct(*key, "at", "to").alias("cell")
    ends = pairs.select(*key, "at", cell).unionByName(pairs.where("at <> to").select(*key, F.col("to").alias("at"), cell))
    return rows.join(ends, [*key, "at"]).groupBy("node", "part").agg(F.collect_list("cell").alias("cells"))


def _keyed(nodes: DataFrame) -> DataFrame:
    """Node, size, ``band`` and ``key``: what runs of equal segments link is the key of the last band, those before are MinHash keys."""
    near = components(fingerprint_links(nodes.select("fp").distinct())).select(F.col("node").alias("__fp"), F.col("least").alias("__least"))
    rings = nodes.join(near, F.col("fp") == F.col("__fp"), "left").select("node", "size", F.lit(BANDS).alias("band"), F.coalesce("__least", "fp").alias("key"))
    return nodes.select("node", "size", F.posexplode("keys").alias("band", "key")).unionByName(rings)


def links(docs: DataFrame, nodes: DataFrame, text_col: str, words: int, similarity: float, block: int) -> DataFrame:
    """Edges (a, b) between the ``nodes`` whose texts are similar enough."""
    keyed = _keyed(nodes)
    least = keyed.groupBy("band", "key").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1").select("band", "key", "least")
    keyed = stage_table(keyed.join(least, ["band", "key"]), "keys")
    joined = components(keyed.select(F.col("node").alias("a"), F.col("least").alias("b")).where("a <> b").distinct())
    joined = stage_table(joined.join(nodes.select("node", "size"), "node"), "clusters")
    clusters = stage_table(joined.groupBy("least").agg(_parts(block).alias("parts")), "parts")
    dealt = joined.join(clusters, "least")
    deals = F.sequence(F.lit(1), F.when(F.col("parts") > 1, DEALS).otherwise(1))
    cells = F.transform(deals, lambda k: F.struct(F.col("least").alias("key"), k.alias("deal"), F.pmod(F.xxhash64("node", k), F.col("parts")).alias("n")))
    found = stage_table(_compare(docs, dealt.select("node", F.col("node").alias("part"), cells.alias("cells")), text_col, words, similarity), "links")
    if not clusters.where("parts > 1").limit(1).count():
        return found
    parts = components(found).withColumnRenamed("least", "part")
    large = dealt.where("parts > 1").select("node", "size").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    return found.unionByName(_compare(docs, _unsettled(keyed, large, block), text_col, words, similarity))


def drop_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, block: int = BLOCK,
) -> DataFrame:
    """The documents without those that another of their component stands for; links are similarities of at least the bound.

    Defined results: the least id of a component stays (of equal ids the least hash of the text; null ids only where there
    is no other).  A null text counts as empty, texts without words as equal, A-Z as a-z; a text of fewer than ``words``
    words is one shingle, so that it is similar to equal ones only; texts of any length are compared whole.  Rows that
    repeat both id and text count as one document, all of whose rows stay or go.  An empty table gives an empty result.
    All columns stay as they are, whatever their names.
    """
    rows = stage_table(signatures(docs, id_col, text_col, words), "signatures")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("node").alias("text_hash")))
    nodes = stage_table(rows.groupBy("node").agg(first.alias("first"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "nodes")
    joined = components(links(docs, nodes, text_col, words, similarity, block)).withColumnRenamed("node", "__node")
    nodes = nodes.select("node", "first").join(joined, F.col("node") == F.col("__node"), "left").withColumn("least", F.coalesce("least", "node"))
    keepers = nodes.groupBy("least").agg(F.min("first").alias("keeper"))
    found = rows.select("__id", "node").join(nodes.join(keepers, "least").select("node", "keeper"), "node")
    stays = F.col("__id").eqNullSafe(F.col("keeper.id")) & (F.col("node") == F.col("keeper.text_hash"))
    gone = stage_table(found.where(~stays).select("__id", F.col("node").alias("__hash")).distinct(), "gone")
    if gone.count() <= MAX_BROADCAST_ROWS:  # then texts need not shuffle; beyond, both sides do
        gone = F.broadcast(gone)
    same = docs[id_col].eqNullSafe(gone["__id"]) & (F.xxhash64(text_or_empty(text_col)) == gone["__hash"])
    return docs.join(gone, same, "left_anti")
