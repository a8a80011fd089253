"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document longer than the window fills whole windows; what is left over is packed with other left-overs.  A block of
left-overs is dealt into the least number of windows that can hold it: every left-over starts as a partition with one
loaded window, and the two partitions of largest imbalance are merged again and again, the heavy windows of one with
the light windows of the other, until one partition is left.  If its heaviest window exceeds the capacity, the number
of windows rises by one and the block is dealt anew.  Short left-overs are bundled in the order they come until a bundle
is worth differencing, so that a block of short texts fills as many windows as any other.  Blocks are filled and packed
while a task reads its partition, so nothing is shuffled and a task holds one block at a time.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, text_or_empty
from .token_cache import MAX_WORDS, encoder, slices

WINDOW = 4096
#: Windows that a block of left-overs is worth.
BLOCK = 64
#: Pieces of a left-over are at most this long, so that the windows of a block come out near equal.
LARGEST_PIECE = 1024
#: A bundle of left-overs is closed at a length between a quarter of this and this, another for each, as equal bundles would not fill a window.
BUNDLE = 256


def karmarkar_karp(sizes: list[int], windows: int) -> list[list[int]]:
    """Positions of ``sizes`` in each window, by largest differencing of partial partitions."""
    if not sizes:
        return [[] for _ in range(windows)]
    heap = [(-size, k, [(0, ())] * (windows - 1) + [(size, (k,))]) for k, size in enumerate(sizes)]
    heapq.heapify(heap)  # of partitions, each in ascending order of load
    while len(heap) > 1:
        _, k, one = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        loads = [(a[0] + b[0], a[1], b[1]) for a, b in zip(one, reversed(other))]
        merged = sorted(((n, a if not b else b if not a else (a, b)) for n, a, b in loads), key=lambda x: x[0])
        heapq.heappush(heap, (merged[0][0] - merged[-1][0], k, merged))

    def flat(node) -> list[int]:
        out, stack = [], [node]
        while stack:
            x = stack.pop()
            stack.extend(reversed(x)) if isinstance(x, tuple) else out.append(x)
        return sorted(out)

    return [flat(members) for _, members in reversed(heap[0][2])]


def pack_block(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of a block: as few as capacity allows, one more whenever the heaviest exceeds it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        packed = karmarkar_karp(sizes, windows)
        if max(sum(sizes[k] for k in w) for w in packed) <= capacity:
            return [w for w in packed if w]
        windows += 1


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    window: int = WINDOW,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Cut documents into pieces and give each piece its place in a sequence of at most ``window`` ids.

    Returns, for each piece: the id, ``start`` (ids of the document before it), ``length``, ``ids_crc32`` (of its ids
    as little-endian 32-bit), ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` (in the sequence, gapless
    from 0), and ``ids`` with ``with_ids``.  Sequence ids are unique, not gapless: task number and a count.  Left-overs
    worth ``block`` windows are packed at a time, and ``max_words`` bounds the words that a Python worker remembers.

    Defined results: a null or empty text is one piece that holds the end id alone; a null id stays null and others stay
    exact, whatever their type; repeated rows are packed each for itself; added tokens of the tokenizer in a text are
    those tokens, as the tokenizer has it; an empty table gives an empty result; other columns are left out.
    """
    schema = (
        f"{id_col} {docs.schema[id_col].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    )
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    end = np.array([end_id], "<u4")
    largest, least = min(LARGEST_PIECE, window), min(BUNDLE, window // 4)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path, max_words)
        context = TaskContext.get()
        following = (context.partitionId() if context else 0) << 36
        waiting: list[list[tuple]] = []  # bundles of pieces of left-overs: id, start, doc_tokens, ids
        sizes: list[int] = []
        held = 0

        def row(doc, start, total, ids, sequence, offset):
            piece = (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset)
            return (*piece, ids.view("<i4")) if with_ids else piece

        def add(piece: tuple) -> None:
            nonlocal held
            size = len(piece[3])
            held += size
            if sizes and sizes[-1] < least // 4 + len(sizes) * 37 % 64 * least * 3 // 256 and sizes[-1] + size <= window:
                waiting[-1].append(piece)
                sizes[-1] += size
            else:
                waiting.append([piece])
                sizes.append(size)

        def settle() -> list[tuple]:
            nonlocal following
            rows = []
            for members in pack_block(sizes, window):
                offset = 0
                for k in members:
                    for doc, start, total, ids in waiting[k]:
                        rows.append(row(doc, start, total, ids, following, offset))
                        offset += len(ids)
                following += 1
            waiting.clear()
            sizes.clear()
            return rows

        def made(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(column, k) for column, k in zip(zip(*rows), kinds)], names=names)

        kind = None
        for batch in batches:
            docs_in, texts = batch.column(0), batch.column(1)
            kind, keys = docs_in.type, docs_in.to_pylist()
            for a, b in slices(pc.utf8_length(texts).to_pylist()):
                rows = []
                for doc, ids in zip(keys[a:b], words.encode(texts[a:b].to_pylist())):
                    ids = np.concatenate([ids, end])
                    total = len(ids)
                    whole = total // window * window
                    for start in range(0, whole, window):
                        rows.append(row(doc, start, total, ids[start : start + window], following, 0))
                        following += 1
                    rest = total - whole
                    if rest:
                        parts = -(-rest // largest)
                        marks = [whole + rest * k // parts for k in range(parts + 1)]
                        for x, y in zip(marks, marks[1:]):
                            add((doc, x, total, ids[x:y]))
                    if held >= block * window:
                        rows += settle()
                        held = 0
                if rows:
                    yield made(rows, kind)
        if waiting:
            yield made(settle(), kind)
        words.forget()  # idle workers stand beside those of whatever comes next
        release_memory()

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("__text")).mapInArrow(work, schema)


def op3_karmarkar_karp_packing(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
