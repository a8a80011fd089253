"""Records of CSV files of any size, with line breaks and doubled quotes in values, read in as many tasks as there are splits.

Whether a line begins a record depends on all quotes before it.  Each split of a file tells, for both states that it may be
entered in, the state that it leaves and the records that begin in it: one row a split.  Put together in the order of
splits, these give each split its true state and the number of its first record, and a second pass cuts the records out.
Only pieces of records that cross from one split to another meet in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines in which the header's record has to end.
HEADER_LINES = 100
BOM = "﻿"


def open_after(line: str, inside: bool) -> bool:
    """Whether a quoted value is open at the end of a line that is entered ``inside`` of one or not."""
    at = 0
    if not inside and line.lstrip(BOM).startswith('"'):
        inside, at = True, line.index('"') + 1
    while True:
        if inside:
            q = line.find('"', at)
            if q < 0:
                return True
            after = line[q + 1 : q + 2]
            if after == '"':
                at = q + 2
            elif after in ("", ",") or line[q + 1 :] == "\r":
                inside, at = False, q + 1
            else:  # a quote that neither ends a value nor is doubled belongs to it
                at = q + 1
        else:
            begin = line.find(',"', at)
            if begin < 0:
                return False
            inside, at = True, begin + 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def _split_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: the state after it, and the records that begin in it, entered outside of a value and inside of one."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, split, line in zip(*(c.to_pylist() for c in batch.columns)):
            s = found.setdefault((file, split), [False, True, 0, 0])
            for k in (0, 1):
                s[2 + k] += not s[k]
                s[k] = open_after(line, s[k]) if '"' in line else s[k]
    if found:
        rows = [(*key, *s) for key, s in found.items()]
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "split", "out0", "out1", "n0", "n1"])


def _entries(splits: pd.DataFrame) -> pd.DataFrame:
    """State and first record number of each split of a file."""
    inside, number, out = False, 0, []
    for r in splits.sort_values("split").itertuples():
        out.append((r.file, r.split, inside, number))
        inside, number = (r.out1, number + r.n1) if inside else (r.out0, number + r.n0)
    return pd.DataFrame(out, columns=["file", "split", "inside", "first_no"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split; those that begin before it or end after it as pieces, not ``whole``."""
    key, inside, number, lines, whole, out = None, False, 0, [], True, []

    def shown() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["file", "record_no", "split", "whole", "record"])
        out.clear()
        return batch

    for batch in batches:
        for file, split, line, entered, first in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, split) != key:
                if lines:
                    out.append((key[0], number, key[1], False, "\n".join(lines)))
                key, inside, lines = (file, split), entered, []
                whole, number = not entered, first - 1
            if not inside:
                number, whole = number + 1, True
            lines.append(line)
            inside = open_after(line, inside) if '"' in line else inside
            if not inside:
                out.append((file, number, split, whole, "\n".join(lines)))
                lines = []
            if len(out) >= 10_000:
                yield shown()
    if lines:
        out.append((key[0], number, key[1], False, "\n".join(lines)))
    if out:
        yield shown()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``record_no``, ``record``) of the CSV files at ``path``; records count from 0, the header, in each file.

    Numbers do not depend on how files are split.  A value that is never closed goes on to the end of its file.
    """
    lines = _lines(spark, path)
    states = lines.mapInArrow(_split_states, "file string, split long, out0 boolean, out1 boolean, n0 long, n1 long")
    entries = states.groupBy("file").applyInPandas(_entries, "file string, split long, inside boolean, first_no long")  # a row a split
    known = lines.join(F.broadcast(entries), ["file", "split"]).select("file", "split", "value", "inside", "first_no")
    cut = known.mapInArrow(_cut, "file string, record_no long, split long, whole boolean, record string")
    pieces = cut.where("NOT whole").groupBy("file", "record_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "record"))), lambda p: p["record"]), "\n").alias("record")
    )
    return cut.where("whole").select("file", "record_no", "record").unionByName(pieces)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Names in the first record, made different from each other as Spark's own reader does."""
    head, inside, lines = _lines(spark, path).where("split = 0").limit(HEADER_LINES).collect(), False, []
    for r in head:
        lines.append(r.value)
        inside = open_after(r.value, inside)
        if not inside:
            break
    first = "\n".join(lines).lstrip(BOM).rstrip("\r")
    if not first:
        return []
    count = spark.range(1).select(F.from_csv(F.lit(first), ", ".join(f"c{k} string" for k in range(first.count(",") + 1)), {"escape": '"'}).alias("r")).first().r
    names = [(n or "").strip() for n in count]
    while names and not names[-1]:
        names.pop()
    lower = [n.lower() for n in names]
    return [f"_c{k}" if not n else f"{n}{k}" if lower.count(n.lower()) > 1 else n for k, n in enumerate(names)]


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The file at ``path`` with its header's columns as texts, and ``file_pos``, the number of the record.

    Short records end in NULLs, values beyond the header are left out, and blank lines are no records.
    """
    names = csv_header(spark, path)
    rows = csv_records(spark, path).where("record_no > 0")
    text = F.regexp_replace("record", "\r$", "")
    schema = ", ".join(f"c{k} string" for k in range(len(names))) or "c0 string"
    cells = rows.where(F.trim(text) != "").select(F.col("record_no").alias("file_pos"), F.from_csv(text, schema, {"escape": '"'}).alias("r"))
    return cells.select(*[F.col(f"r.c{k}").alias(n) for k, n in enumerate(names)], "file_pos")
