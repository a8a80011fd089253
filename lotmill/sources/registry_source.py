"""Registry folders as a data source: a partition a state, filters on the state open no other file, and a table of what is there.

A folder holds ``<state>.csv``, or ``slug=<state>/`` with files in it; ``<state>`` is written as ``state_slug`` does.  Files may be
on any file system that pyarrow knows.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..functions.text import strip, without_placeholder
from ..params import REGISTRY_HEADERS

NAME = "company_registry"
FIELDS = tuple(REGISTRY_HEADERS)
ROWS = "state string, file_pos long, " + ", ".join(f"{f} string" for f in FIELDS)
THERE = "state string, status string, n_rows long"
BATCH = 10_000


def slug(state: str) -> str:
    return state.strip().lower().replace(" ", "_").replace("&", "and")


@dataclass
class StateFiles(InputPartition):
    state: str
    files: list[str]


class RegistryReader(DataSourceReader):
    """Rows of the states that are asked for, or what became of their files."""

    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.table = options["path"], options.get("table", "rows")
        self.opened = options.get("opened")
        self.states = [s.strip() for s in options["states"].split(",") if s.strip()]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("state",):
                self.states = [s for s in self.states if s == f.value]
            elif isinstance(f, In) and f.attribute == ("state",):
                self.states = [s for s in self.states if s in set(f.value)]
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.folder)
        parts = []
        for state in self.states:
            single, several = f"{root}/{slug(state)}.csv", f"{root}/slug={slug(state)}"
            a, b = system.get_file_info([single, several])
            files = [single] if a.type == fs.FileType.File else []
            if b.type == fs.FileType.Directory:
                files += sorted(i.path for i in system.get_file_info(fs.FileSelector(several)) if i.is_file and not i.base_name.startswith(("_", ".")))
            if files or self.table != "rows":
                parts.append(StateFiles(state, files))
        return parts or [StateFiles("", [])]

    def _records(self, part: StateFiles) -> Iterator[tuple[dict[str, int] | None, list[str]]]:
        """For each record where its fields stand; an empty record and None for a file without a column of numbers."""
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.folder)
        for path in part.files:
            if self.opened:  # which files are opened, for those who want to know
                place = f"{fs.FileSystem.from_uri(self.opened)[1]}/{path.rsplit('/', 1)[-1]}-{part.state}"
                system.open_output_stream(place).close()
            with system.open_input_stream(path) as raw:
                rows = csv.reader(io.TextIOWrapper(io.BufferedReader(raw), "utf-8-sig", "replace", newline=""))
                headers = {h.strip().lower(): k for k, h in reversed(list(enumerate(next(rows, []))))}
                at = {f: next((headers[v.strip().lower()] for v in variants if v.strip().lower() in headers), -1) for f, variants in REGISTRY_HEADERS.items()}
                if at["cin"] < 0:
                    yield None, []
                    continue
                for row in rows:
                    if row:
                        yield at, row

    def read(self, partition: StateFiles) -> Iterator[pa.RecordBatch]:
        if self.table != "rows":
            yield self._availability(partition)
            return
        rows = []
        for pos, (at, row) in enumerate(self._records(partition), 1):
            if at is not None:
                rows.append((partition.state, pos, *(row[k] if 0 <= k < len(row) else None for k in at.values())))
            if len(rows) >= BATCH:
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), *[pa.string()] * len(FIELDS)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["state", "file_pos", *FIELDS])

    def _availability(self, partition: StateFiles) -> pa.RecordBatch:
        status, n, keyed, keyless = "file_absent", 0, False, False
        if partition.files:
            try:
                for at, row in self._records(partition):
                    keyless |= at is None
                    keyed |= at is not None
                    n += at is not None and at["cin"] < len(row) and bool(row[at["cin"]].strip())
                status = "ok" if n else "no_key" if keyless and not keyed else "no_rows"
            except (OSError, csv.Error):
                status = "unreadable"
        rows = [(partition.state, status, int(n))] if partition.state else []
        columns = zip(*rows) if rows else ([], [], [])
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["state", "status", "n_rows"])


class RegistrySource(DataSource):
    """``spark.read.format("company_registry").option("states", "delhi,goa").load(folder)``; option ``table``: rows or availability."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ROWS if self.options.get("table", "rows") == "rows" else THERE

    def reader(self, schema) -> RegistryReader:
        return RegistryReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RegistrySource)


def registry_rows(spark: SparkSession, folder: str, states: list[str], **options: str) -> DataFrame:
    """Registry of the states whose files are there, normalised; a filter on ``state`` opens the files of those states only."""
    register(spark)
    raw = spark.read.format(NAME).options(states=",".join(states), **options).load(folder)
    fields = [without_placeholder(F.col(f)).alias(f) for f in FIELDS if f != "cin"]
    rows = raw.select(F.upper(strip(F.col("cin"))).alias("cin"), *fields, "file_pos", "state")
    return rows.where(F.coalesce(F.col("cin"), F.lit("")) != "")


def registry_availability(spark: SparkSession, folder: str, states: list[str]) -> DataFrame:
    """For each state that is expected: ok, or file_absent, unreadable, no_key or no_rows, with its rows."""
    register(spark)
    return spark.read.format(NAME).options(states=",".join(states), table="availability").load(folder)
