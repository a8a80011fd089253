"""Near-duplicates by SimHash, with candidates from pigeonring filtering.

Fingerprints are 64 bits, cut into ``SEGMENTS`` segments on a ring.  If two fingerprints differ in at most ``radius``
bits, some chain of consecutive segments keeps within its proportional budget at every length: the first l segments of
the chain differ in at most l * radius / SEGMENTS bits.  While that budget is below one the segments must be equal, so
such a run of equal segments is the key that brings candidates together (two or more of them, which is far more
selective than one), and the budgets of the longer chains prune candidates before the full Hamming distance is taken.

Equal fingerprints are one class from the start, so a hot text is one row here.  A key's candidates are compared in
numpy tiles and only edges that join two parts of that key are emitted, never all pairs.  A key that holds more than
``max_key`` fingerprints is not compared but expanded: each fingerprint is joined, for every choice of at most
``radius`` of the bits outside the key, to the least fingerprint that agrees in all other bits.  Two fingerprints within
the radius agree outside some such choice, so this loses no link, and grouping by minimum is summed up before the shuffle.

Classes are joined to components by alternating large-star and small-star steps over the written edges.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import A_TO_Z, release_memory, stage_table, text_or_empty

SEGMENTS = 7
WORDS = 3
RADIUS = 2
MAX_KEY = 8192
TILE = 1024
#: Rows of id and hash that are broadcast at most: some 20 MB.
MAX_BROADCAST_ROWS = 500_000
_LOWER = bytes.maketrans(A_TO_Z.encode(), A_TO_Z.lower().encode())


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of the text's word shingles: a bit is 1 if it is set in over half of the shingles' hashes."""
    import xxhash

    tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()  # at \x20 and \x09-\x0D
    if not tokens:
        return 0
    run = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    stops = ends[words - 1 :] if len(tokens) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, done = np.zeros(64, np.int64), 0
    for k in range(0, n, 8192):  # of a very long text a part at a time
        hashes = [digest(run[a:b], 42) for a, b in zip(starts[k : k + 8192].tolist(), stops[k : k + 8192].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        done += len(hashes)
    return int((np.uint64(1) << np.flatnonzero(ones * 2 > done).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``fp`` (the fingerprint as a signed long) and ``text_hash`` of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in batch.column("__text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"__id": batch.column("__id"), "fp": fp, "text_hash": batch.column("text_hash")})
        release_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(work, f"__id {kind}, fp long, text_hash long")


def segments(count: int = SEGMENTS) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    marks = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(marks, marks[1:])]


def chain_mask(first: int, length: int, count: int) -> int:
    """Bits of ``length`` consecutive segments on the ring."""
    parts = segments(count)
    return sum(((1 << width) - 1) << at for at, width in (parts[(first + k) % count] for k in range(length)))


def equal_run(radius: int, count: int) -> int:
    """Segments at the start of a chain whose budget is below one: they must be equal."""
    return max(length for length in range(count + 1) if length * radius < count)


def ring_near(differ: np.ndarray, radius: int, count: int = SEGMENTS) -> np.ndarray:
    """Where ``differ`` (exclusive or of two fingerprints) has at most ``radius`` bits: first some chain has to keep within
    its budget at every length, then all bits are counted."""
    near = np.zeros(differ.shape, bool)
    bits = [np.bitwise_count(differ & np.uint64(chain_mask(k, 1, count))).astype(np.int64) for k in range(count)]
    for first in range(count):
        keeps, sums = np.ones(differ.shape, bool), np.zeros(differ.shape, np.int64)
        for length in range(1, count):
            sums = sums + bits[(first + length - 1) % count]
            keeps &= sums * count <= length * radius
        near |= keeps
    return near & (np.bitwise_count(differ) <= radius)


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _forest(values: np.ndarray, first: int, radius: int, count: int) -> list[tuple[int, int]]:
    """Edges that join the fingerprints of one key, at most one less than there are fingerprints."""
    checks = [
        (np.uint64(chain_mask(first, length, count)), length * radius // count)
        for length in range(equal_run(radius, count) + 1, count)
    ]
    n = len(values)
    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for a in range(0, n, TILE):
        for b in range(a, n, TILE):
            differ = values[a : a + TILE, None] ^ values[None, b : b + TILE]
            near = np.ones(differ.shape, bool)
            for mask, budget in checks:
                near &= np.bitwise_count(differ & mask) <= budget
            i, j = np.nonzero(near)
            keep = i + a < j + b
            i, j = i[keep], j[keep]
            close = np.bitwise_count(differ[i, j]) <= radius  # the full Hamming check
            for x, y in zip((i[close] + a).tolist(), (j[close] + b).tolist()):
                p, q = root(x), root(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    edges.append((x, y))
    return edges


def links(classes: DataFrame, radius: int = RADIUS, count: int = SEGMENTS, max_key: int = MAX_KEY) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect all that are within ``radius`` of each other."""
    run = equal_run(radius, count)
    masks = [chain_mask(k, run, count) for k in range(count)]
    keyed = classes.select(
        "fp", F.explode(F.array(*[
            F.struct(F.lit(k).alias("first"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(masks)
        ])).alias("c"),
    ).select("fp", "c.first", "c.key")
    shared = stage_table(keyed.groupBy("first", "key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    keyed = keyed.join(shared, ["first", "key"])
    together = keyed.where(F.col("n") <= max_key).groupBy("first", "key").agg(F.collect_list("fp").alias("fps"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for first, fps in zip(batch["first"], batch["fps"]):
                values = np.sort(np.asarray(fps, np.int64))
                out += [(values[x], values[y]) for x, y in _forest(values.view(np.uint64), int(first), radius, count)]
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    near = together.select("first", "fps").mapInPandas(work, "a long, b long")

    def choices(first: int):
        free = [k for k in range(64) if not masks[first] >> k & 1]
        return [signed(~sum(1 << k for k in bits) & (1 << 64) - 1) for bits in itertools.combinations(free, radius)]

    hot = keyed.where(F.col("n") > max_key)
    table = F.create_map(*[x for k in range(count) for x in (F.lit(k), F.lit(choices(k)))])
    wild = hot.select("fp", "first", F.posexplode(F.element_at(table, F.col("first"))).alias("choice", "mask"))
    wild = wild.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    least = wild.groupBy("first", "choice", "key").agg(F.min("fp").alias("b"), F.count("*").alias("m")).where("m > 1").select("first", "choice", "key", "b")
    far = wild.join(least, ["first", "choice", "key"]).where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return near.unionByName(far) if shared.where(F.col("n") > max_key).limit(1).count() else near


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Least node of each node's component, for the nodes of ``edges`` (a, b): columns ``node`` and ``least``."""
    edges = stage_table(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(below.select("u", F.col("m").alias("v")))
        edges = stage_table(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("least")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("least"))
    ).distinct()


def labelled(
    docs: DataFrame, words: int = WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
    count: int = SEGMENTS, max_key: int = MAX_KEY,
) -> DataFrame:
    """``__id``, ``fp``, ``text_hash`` and ``keeper`` (the row that stands for the component: least id, null last)."""
    prints = stage_table(fingerprints(docs, words, id_col, text_col), "fingerprints")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), "text_hash"))
    classes = stage_table(prints.groupBy("fp").agg(first.alias("first")), "classes")
    joined = components(links(classes.select("fp"), radius, count, max_key))
    classes = classes.join(joined, F.col("fp") == F.col("node"), "left").withColumn("least", F.coalesce("least", "fp"))
    keepers = classes.groupBy("least").agg(F.min("first").alias("keeper"))
    return prints.join(classes.join(keepers, "least").select("fp", "keeper"), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Id, ``fingerprint`` (16 hex digits) and ``component_id``, the least id that links lead to, of every row.

    Defined results: a null text counts as empty and has fingerprint zero, which links like any other; texts of fewer
    words than a shingle are one shingle; a null id gets its component but is no ``component_id`` unless all ids of
    the component are null; repeated rows give repeated results; an empty table gives an empty result; other columns
    are left out, whatever their names.
    """
    return labelled(docs, id_col=id_col, **options).select(
        F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("keeper.id").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without those that another of their component stands for.

    The least id of a component stays (of equal ids the least hash of the text; null ids only where there is no other).
    Rows that repeat both id and text count as one document.  Columns stay as they are.
    """
    found = labelled(docs, id_col=id_col, text_col=text_col, **options)
    stays = F.col("__id").eqNullSafe(F.col("keeper.id")) & (F.col("text_hash") == F.col("keeper.text_hash"))
    gone = stage_table(found.where(~stays).select("__id", F.col("text_hash").alias("__hash")).distinct(), "gone")
    if gone.count() <= MAX_BROADCAST_ROWS:  # then texts need not shuffle; beyond, both sides do
        gone = F.broadcast(gone)
    same = docs[id_col].eqNullSafe(gone["__id"]) & (F.xxhash64(text_or_empty(text_col)) == gone["__hash"])
    return docs.join(gone, same, "left_anti")


def op7_simhash_pigeonring(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_components(docs)
