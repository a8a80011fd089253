"""Token files: ids bit-packed at fixed width, with offsets for random access.

Layout, little-endian:

    blocks    each of ``ids a block`` ids (the last may be shorter), packed in ``bits`` bits, padded to whole words
    documents int64 id, uint8 whether it is null, uint64 first id in this file (as three columns)
    offsets   uint64 place of each block, and of the end
    trailer   4 bytes "LMT1", uint32 bits an id, uint64 documents, uint64 ids, uint32 ids a block, uint32 blocks,
              uint64 place of the document table, uint64 place of the block table

An id is stored in the least number of bits that the vocabulary needs.  Sixty-four ids fill ``bits`` whole words of 64
bits, so packing and unpacking are a few shifts over numpy arrays, and any id or block can be read by itself.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory, stage_path, stage_table, text_or_empty
from .token_cache import MAX_WORDS, encoder, slices

MAGIC = b"LMT1"
TRAILER = struct.Struct("<4sIQQIIQQ")
BLOCK_IDS = 1 << 16


def bits_for(vocabulary: int) -> int:
    """Least number of bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` at ``bits`` bits each, in whole 64-bit words; a last group of 64 is filled with zeros."""
    lanes = np.zeros(-(-len(ids) // 64) * 64, np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(-1, 64).T
    words = np.zeros((bits, lanes.shape[1]), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[word] |= lanes[k] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return words.T.astype("<u8").tobytes()


def unpack_bits(raw: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of what ``pack_bits`` returned."""
    words = np.frombuffer(raw, "<u8").reshape(-1, bits).T
    mask = np.uint64((1 << bits) - 1)
    lanes = np.empty((64, words.shape[1]), np.uint32)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[word + 1] << np.uint64(64 - shift)
        lanes[k] = value & mask
    return lanes.T.reshape(-1)[:count]


class TokenFileWriter:
    """Makes the bytes of one file, block by block; holds one block of ids and the document table."""

    def __init__(self, bits: int, block_ids: int = BLOCK_IDS):
        self.bits, self.block_ids = bits, block_ids
        self.at = 0
        self.places: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.ids = 0
        self.doc_ids: list[int] = []
        self.nulls: list[bool] = []
        self.firsts: list[int] = []

    def _block(self, ids: np.ndarray) -> bytes:
        raw = pack_bits(ids, self.bits)
        self.places.append(self.at)
        self.at += len(raw)
        return raw

    def add(self, doc_id: int | None, ids: np.ndarray) -> bytes:
        """Blocks that are full with this document."""
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.firsts.append(self.ids)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        done = b""
        if self.n_waiting >= self.block_ids:
            run = np.concatenate(self.waiting)
            whole = len(run) // self.block_ids * self.block_ids
            done = b"".join(self._block(run[k : k + self.block_ids]) for k in range(0, whole, self.block_ids))
            self.waiting, self.n_waiting = [run[whole:]], len(run) - whole
        return done

    def finish(self) -> bytes:
        """What follows the full blocks."""
        tail = b""
        if self.n_waiting:
            tail = self._block(np.concatenate(self.waiting))
        docs_at = self.at
        table = np.array(self.doc_ids, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes() + np.array(self.firsts, "<u8").tobytes()
        places = np.array([*self.places, docs_at], "<u8").tobytes()
        trailer = TRAILER.pack(MAGIC, self.bits, len(self.doc_ids), self.ids, self.block_ids, len(self.places), docs_at, docs_at + len(table))
        return tail + table + places + trailer


class TokenFile:
    """Random access to a token file, of which only the tables are held."""

    def __init__(self, source):
        self.source = source
        self.magic, self.bits, n_docs, self.ids, self.block_ids, n_blocks, docs_at, places_at = TRAILER.unpack(self._at(-TRAILER.size, TRAILER.size))
        if self.magic != MAGIC:
            raise ValueError("not a token file")
        table = self._at(docs_at, 17 * n_docs)
        self.doc_ids = np.frombuffer(table[: 8 * n_docs], "<i8")
        self.nulls = np.frombuffer(table[8 * n_docs : 9 * n_docs], "u1").astype(bool)
        self.firsts = np.append(np.frombuffer(table[9 * n_docs :], "<u8"), np.uint64(self.ids)).astype(np.int64)
        self.places = np.frombuffer(self._at(places_at, 8 * (n_blocks + 1)), "<u8").astype(np.int64)

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place, 0 if place >= 0 else 2)
        return self.source.read(size)

    def block(self, k: int) -> np.ndarray:
        count = min(self.block_ids, self.ids - k * self.block_ids)
        return unpack_bits(self._at(int(self.places[k]), int(self.places[k + 1] - self.places[k])), count, self.bits)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        run = [self.block(k) for k in range(first, last + 1)]
        return np.concatenate(run)[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document with its ids; every block is unpacked once, and one is held at a time."""
        at, block = -1, np.empty(0, np.uint32)
        for k in range(len(self.doc_ids)):
            start, stop = int(self.firsts[k]), int(self.firsts[k + 1])
            parts = []
            while start < stop:
                if (b := start // self.block_ids) != at:
                    at, block = b, self.block(b)
                here = block[start - b * self.block_ids : stop - b * self.block_ids]
                parts.append(here)
                start += len(here)
            ids = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32)
            yield None if self.nulls[k] else int(self.doc_ids[k]), ids


def write_token_files(
    docs: DataFrame, tokenizer_path: str, out_dir: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS, max_words: int = MAX_WORDS,
) -> DataFrame:
    """Write the ids of all documents, in ascending order of the id, to token files in ``out_dir``.

    ``out_dir`` is a URI that every executor can write (of any file system that pyarrow knows).  Returns the manifest,
    one row a file: ``part`` (order of the files), ``path``, ``n_docs``, ``n_ids``, ``first_id`` (ids in all files
    before it).  A file's name is its own for each attempt, and only the manifest tells which files count, so a task
    may run again at any time.  ``max_words`` bounds the words that a Python worker remembers.

    Defined results: a null or empty text is the end id alone; null ids come first; of repeated ids the order is that of
    a hash of the text; added tokens of the tokenizer in a text are those tokens, as the tokenizer has it; an empty table
    gives an empty manifest; other columns are left out.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encoded = encoder(tokenizer_path, max_words)
        part = TaskContext.get().partitionId()
        files, folder = fs.FileSystem.from_uri(out_dir)
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.lmt"
        end = np.array([end_id], np.uint32)
        writer = out = None
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t) for t in texts]):
                if writer is None:
                    files.create_dir(folder, recursive=True)
                    out = files.open_output_stream(path)
                    writer = TokenFileWriter(bits_for(encoded.size), block_ids)
                for doc, ids in zip(keys[a:b], encoded.encode(texts[a:b])):
                    out.write(writer.add(doc, np.concatenate([ids, end])))
        if writer is None:
            return
        out.write(writer.finish())
        out.close()
        release_memory()
        row = {"part": pa.array([part], pa.int32()), "path": [path], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.ids]}
        yield pa.RecordBatch.from_pydict(row)

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("__text"))
    rows = rows.withColumn("__tie", F.xxhash64("__text"))
    rows = rows.repartitionByRange(id_col, "__tie").sortWithinPartitions(id_col, "__tie").drop("__tie")
    manifest = stage_table(rows.mapInArrow(work, "part int, path string, n_docs long, n_ids long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, uri: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Documents of the files in ``manifest``: id, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` (of its ids as little-endian 32-bit), and ``ids`` with ``with_ids``.

    Defined results: every document that was written comes back once, in no order, null, repeated and large ids as they
    were and null and empty texts as the end id alone; a document of any length is read whole; an empty manifest gives an
    empty result; columns of the manifest beside ``path`` and ``first_id`` are left out.
    """
    schema = f"{id_col} long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    names = [id_col, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, k) for column, k in zip(zip(*rows), kinds)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist()):
                with files.open_input_file(path) as source:
                    found, rows, held = TokenFile(source), [], 0
                    for k, (doc, ids) in enumerate(found.documents()):
                        row = (doc, first + int(found.firsts[k]), len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        rows.append((*row, ids.astype("int32")) if with_ids else row)
                        held += len(ids) if with_ids else 1
                        if held >= (1 << 20 if with_ids else 1 << 14):
                            yield made(rows)
                            rows, held = [], 0
                    if rows:
                        yield made(rows)

    files = max(1, manifest.count())
    return manifest.select("path", "first_id").repartition(files).mapInArrow(work, schema)


def op9_bit_packed_tokens(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out_dir = stage_path(spark, "tokens")
    manifest = write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), out_dir)
    return read_token_files(manifest, out_dir)
