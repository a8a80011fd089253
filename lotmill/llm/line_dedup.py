"""Lines that many documents share, dropped by a sharded minimal perfect hash.

Lines are known by 128-bit hashes.  The distinct hashes found in at least two documents are dealt into shards of some
``SHARD_KEYS``; each shard is a minimal perfect hash (levels of bits: a key rests at the first level where no other key of
its shard falls on its bit, and its slot is the number of bits before that one) over an array of 64-bit fingerprints and an
array of document counts.  A document hashes its lines, looks the slots up and reads the counts; the fingerprint refuses
lines that have no entry.  No line is joined with another, and no text leaves its row.

An index of at most ``max_index_bytes`` (checked; some 12.6 bytes a repeated line) is sent to all executors, and documents are
marked where they are read.  A larger one stays where it is: hashes of lines, 28 bytes each, travel to their shards instead,
shards that many lines ask for are copied once for each ``CHUNK`` of them, and places of lines to drop travel back.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage_table, text_or_empty, without

SHARD_KEYS = 1 << 17
MAX_INDEX_BYTES = 64 << 20
#: Lines that one copy of a shard is asked for, where shards do not travel.
CHUNK = 1 << 20
#: Bits of a level for each key that is left.
BITS_PER_KEY = 2
WHITE = " \t\n\x0b\x0c\r"
OUT = ("n_lines", "n_dropped", "kept_text")


def _mixed(hashes: np.ndarray, prints: np.ndarray, level: int) -> np.ndarray:
    """64 bits of each pair, others at each level."""
    z = hashes ^ (prints * np.uint64(0x9E3779B97F4A7C15) + np.uint64((level + 1) * 0xD1B54A32D192ED03 % 2**64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Shard:
    """Minimal perfect hash over pairs of hash and fingerprint, with the arrays that its slots index."""

    def __init__(self, sizes: list[int], words: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> None:
        self.sizes, self.words, self.prints, self.counts = sizes, words, prints, counts
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, hashes: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> Shard:
        sizes, parts, left = [], [], np.arange(len(hashes))
        while len(left):
            bits = -(-len(left) * BITS_PER_KEY // 64) * 64
            at = (_mixed(hashes[left], prints[left], len(sizes)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            sizes.append(bits)
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        shard = cls(sizes, np.concatenate(parts) if parts else np.empty(0, "<u8"), prints, counts)
        slots = shard.slots(hashes, prints)
        shard.prints, shard.counts = np.empty(len(slots), "<u8"), np.empty(len(slots), "<u4")
        shard.prints[slots], shard.counts[slots] = prints, np.minimum(counts, 2**32 - 1)
        return shard

    def slots(self, hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Slot of each pair: its own if it is a key, any or -1 if it is not."""
        found, left = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, bits in enumerate(self.sizes):
            at = self.starts[level] + (_mixed(hashes[left], prints[left], level) % np.uint64(bits)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit & np.uint64(1)) > 0
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[here]] = (self.before[at >> 6] + below)[here]
            left = left[~here]
        return found

    def counts_of(self, hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Documents that hold each line; 0 for a line that is no key."""
        slots = self.slots(hashes, prints)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == prints[known]
        return np.where(known, self.counts[slots] if len(self.counts) else 0, 0)

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<QI{len(self.sizes)}Q", len(self.prints), len(self.sizes), *self.sizes)
        return head + b"".join(x.tobytes() for x in (self.words, self.prints, self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        keys, levels = struct.unpack_from("<QI", data)
        sizes = list(struct.unpack_from(f"<{levels}Q", data, 12))
        at, words = 12 + 8 * levels, sum(sizes) // 64
        parts = [np.frombuffer(data, kind, n, at + skip) for kind, n, skip in (("<u8", words, 0), ("<u8", keys, 8 * words), ("<u4", keys, 8 * (words + keys)))]
        return cls(sizes, *parts)


def _lines(text_col: str) -> tuple[Column, Column]:
    """The lines of a text, and their keys."""
    text = text_or_empty(text_col)
    return F.split(text, "\n", -1), F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.trim(line, F.lit(WHITE)))


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _print(key: Column) -> Column:
    return F.xxhash64(F.lit("line"), key)


def _shard_of(hash_: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hash_, 64 - bits).cast("int") if bits else F.lit(0)


def line_index(docs: DataFrame, text_col: str = "text", least: int = 2, min_chars: int = 1) -> tuple[DataFrame, int]:
    """Stored shards (``shard``, ``data``) over the lines found in ``least`` documents or more, and the bits of a shard number.

    Each row is a document, whatever its id, and a line counts once in it.  Lines whose keys have fewer than ``min_chars``
    code points get no entry.
    """
    keys = docs.select(F.explode(F.array_distinct(_lines(text_col)[1])).alias("key")).where(F.char_length("key") >= min_chars)
    counts = keys.select(_hash(F.col("key")).alias("hash"), _print(F.col("key")).alias("print")).groupBy("hash", "print").count()
    counts = stage_table(counts.where(F.col("count") >= least), "line-counts")
    bits = max(0, (counts.count() - 1) // SHARD_KEYS).bit_length()

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        hashes, prints = (rows[c].to_numpy().view(np.uint64) for c in ("hash", "print"))
        shard = Shard.build(hashes, prints, rows["count"].to_numpy())
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "data": [shard.to_bytes()]})

    shards = counts.withColumn("shard", _shard_of(F.col("hash"), bits)).groupBy("shard").applyInPandas(build, "shard int, data binary")
    return stage_table(shards, "line-index"), bits


def _marks_where_read(rows: DataFrame, index: DataFrame, bits: int, min_docs: int) -> DataFrame:
    """``__drop`` from the index as a broadcast."""
    sent = rows.sparkSession.sparkContext.broadcast({r.shard: bytes(r.data) for r in index.collect()})
    opened: dict[int, Shard] = {}

    @F.arrow_udf("array<boolean>")
    def marked(hashes: pa.Array, prints: pa.Array) -> pa.Array:
        if not opened:
            opened.update({k: Shard.from_bytes(data) for k, data in sent.value.items()})
        h, f = (np.asarray(x.flatten()).view(np.uint64) for x in (hashes, prints))
        shards = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
        often = np.zeros(len(h), bool)
        order = np.argsort(shards, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
            if len(part) and (shard := opened.get(int(shards[part[0]]))) is not None:
                often[part] = shard.counts_of(h[part], f[part]) >= min_docs
        lengths = np.asarray(hashes.value_lengths())
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(often))

    return rows.withColumn("__drop", marked("__hashes", "__prints")).drop("__hashes", "__prints")


def _marks_by_travel(rows: DataFrame, index: DataFrame, bits: int, min_docs: int, chunk: int) -> DataFrame:
    """``__drop`` from shards that stay where they are."""
    rows = stage_table(rows.withColumn("__row", F.monotonically_increasing_id()), "lines")
    asked = rows.select("__row", F.posexplode(F.arrays_zip(F.col("__hashes").alias("hash"), F.col("__prints").alias("print"))).alias("at", "x"))
    asked = asked.select("__row", "at", "x.hash", "x.print").withColumn("shard", _shard_of(F.col("hash"), bits))
    loads = stage_table(asked.groupBy("shard").agg(F.ceil(F.count("*") / chunk).alias("copies")), "loads")
    asked = asked.join(loads, "shard").withColumn("copy", F.pmod(F.xxhash64("__row", "at"), "copies")).drop("copies")
    copied = index.join(loads, "shard").select("shard", "data", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))

    def look(lines: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        if not len(shards):
            return lines.loc[:, ["__row", "at"]].iloc[:0]
        h, f = (lines[c].to_numpy().view(np.uint64) for c in ("hash", "print"))
        often = Shard.from_bytes(shards["data"].iloc[0]).counts_of(h, f) >= min_docs
        return lines.loc[often, ["__row", "at"]]

    hits = asked.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInPandas(look, "__row long, at int")
    places = hits.groupBy("__row").agg(F.collect_list("at").alias("__places"))  # no more than a document has lines

    @F.arrow_udf("array<boolean>")
    def mask(lengths: pa.Array, places: pa.Array) -> pa.Array:
        return pa.array([_mask(n, p) for n, p in zip(lengths.to_pylist(), places)], pa.list_(pa.bool_()))

    joined = rows.join(places, "__row", "left").withColumn("__places", F.coalesce("__places", F.array().cast("array<int>")))
    return joined.withColumn("__drop", mask(F.size("__hashes"), "__places")).drop("__row", "__hashes", "__prints", "__places")


def _mask(length: int, places: pa.ListScalar) -> np.ndarray:
    out = np.zeros(length, bool)
    out[np.asarray(places.values, np.int64)] = True
    return out


def dedup_lines(
    docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1, max_index_bytes: int = MAX_INDEX_BYTES, chunk: int = CHUNK,
) -> DataFrame:
    """Drop every line whose key is found in ``min_docs`` documents or more; the others stay, joined by line feeds.

    A line's key is the line without white space at its ends, A-Z in lower case.  Adds ``n_lines`` (before dropping),
    ``n_dropped`` and ``kept_text``.

    Defined results: a null or empty text is one empty line; keys of fewer than ``min_chars`` code points are never dropped;
    a line that a document repeats counts once there but goes everywhere; rows that repeat an id or a whole document are
    documents of their own; null ids are no matter; an empty table gives an empty one; input columns named as an output
    column are replaced.
    """
    base = without(docs, OUT)
    lines, keys = _lines(text_col)
    names = base.columns
    rows = base.select("*", lines.alias("__lines"), F.transform(keys, _hash).alias("__hashes"), F.transform(keys, _print).alias("__prints"))
    index, bits = line_index(docs, text_col, min(2, min_docs), min_chars)
    held = index.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    if held <= max_index_bytes:
        rows = _marks_where_read(rows, index, bits, min_docs)
    else:
        rows = _marks_by_travel(rows, index, bits, min_docs, chunk)
    kept = F.filter("__lines", lambda line, k: ~F.get("__drop", k))
    return rows.select(
        *[F.col(f"`{c}`") for c in names], F.size("__lines").cast("long").alias("n_lines"),
        F.size(F.filter("__drop", lambda x: x)).cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("kept_text"),
    )


def op13_perfect_hash_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (o.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (o.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often o ON k.key = o.key GROUP BY r, doc_id
"""
