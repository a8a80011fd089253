"""Table functions for SQL over landed pages: ``SELECT * FROM listing_rows(TABLE(pages), 'corporate_debtor,reserve_price_raw')``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..params import HEADER_FIELDS
from ..sources.pages import anchors, listing_table, result_rows

MARKS = ("reserve price", "corporate debtor")
LONGEST_FIRST = sorted(HEADER_FIELDS, key=len, reverse=True)


def _page_columns(pages: AnalyzeArgument) -> tuple[str, T.DataType]:
    """The column that tells pages apart, and its type; a table without it or without ``html`` is refused when the query is analysed."""
    if not pages.isTable:
        raise ValueError("the first argument must be a table: TABLE(pages)")
    kinds = {f.name: f.dataType for f in pages.dataType.fields}
    key = next((k for k in ("page", "page_id") if k in kinds), None)
    if key is None or "html" not in kinds:
        raise ValueError(f"a table of pages has page or page_id, and html; this one has {', '.join(kinds)}")
    return key, kinds[key]


def _asked(fields: AnalyzeArgument | None) -> list[str]:
    if fields is None:
        return list(HEADER_FIELDS.values())
    if not isinstance(fields.value, str):
        raise ValueError("fields must be a constant text: names, with commas between them")
    names = [f.strip() for f in fields.value.split(",") if f.strip()]
    if unknown := sorted(set(names) - set(HEADER_FIELDS.values())):
        raise ValueError(f"no such fields: {', '.join(unknown)}; there are {', '.join(HEADER_FIELDS.values())}")
    return names


@dataclass
class Asked(AnalyzeResult):
    key: str = ""
    fields: list[str] = field(default_factory=list)


def header_field(header: str) -> str | None:
    """Field of a header: that of the longest key that it contains."""
    low = header.lower()
    return next((HEADER_FIELDS[k] for k in LONGEST_FIRST if k in low), None)


class ListingRows:
    """Rows of each page's listing table: a text column for each field that is asked for, and the fields that a row lacks.

    Rows with more than one cell missing are left out, as ``split_rows`` does; ``extract_rows`` shows them.
    """

    @staticmethod
    def analyze(pages: AnalyzeArgument, fields: AnalyzeArgument | None = None) -> Asked:
        key, kind = _page_columns(pages)
        names = _asked(fields)
        schema = T.StructType([T.StructField(key, kind), T.StructField("row_idx", T.IntegerType()), *[T.StructField(f, T.StringType()) for f in names], T.StructField("cell_flags", T.ArrayType(T.StringType()))])
        return Asked(schema=schema, key=key, fields=names)

    def __init__(self, asked: Asked) -> None:
        self.key, self.fields = asked.key, asked.fields

    def eval(self, page: Row, fields: str | None = None) -> Iterator[tuple]:
        rows = listing_table(page["html"] or "", MARKS) or []
        at = {f: k for k, c in enumerate(rows[0]) if (f := header_field(" ".join(c["pieces"])))} if rows else {}  # the last column counts
        for k, row in enumerate(rows[1:], 1):
            cells = [c for c in row if c["tag"] == "td"]
            if cells and len(cells) >= len(rows[0]) - 1:
                values = [" ".join(cells[at[f]]["pieces"]) if at.get(f, len(cells)) < len(cells) else None for f in self.fields]
                yield (page[self.key], k, *values, [f"cell.missing.{f}" for f in self.fields if f in at and at[f] >= len(cells)])


class PageAnchors:
    """Addresses of each page's anchors in order, as they stand."""

    @staticmethod
    def analyze(pages: AnalyzeArgument) -> Asked:
        key, kind = _page_columns(pages)
        return Asked(schema=T.StructType([T.StructField(key, kind), T.StructField("nth", T.IntegerType()), T.StructField("href", T.StringType())]), key=key)

    def __init__(self, asked: Asked) -> None:
        self.key = asked.key

    def eval(self, page: Row) -> Iterator[tuple]:
        for nth, href in enumerate(anchors(page["html"])):
            yield page[self.key], nth, href


class ResultBlocks:
    """The first ``most`` search results of each page, without those that have no title."""

    @staticmethod
    def analyze(pages: AnalyzeArgument, most: AnalyzeArgument | None = None) -> Asked:
        key, kind = _page_columns(pages)
        texts = [T.StructField(c, T.StringType()) for c in ("title", "url", "snippet")]
        return Asked(schema=T.StructType([T.StructField(key, kind), T.StructField("nth", T.IntegerType()), *texts]), key=key, fields=[str(3 if most is None else most.value)])

    def __init__(self, asked: Asked) -> None:
        self.key, self.most = asked.key, int(asked.fields[0])

    def eval(self, page: Row, most: int | None = None) -> Iterator[tuple]:
        for row in result_rows(page["html"], self.most):
            yield (page[self.key], *row)


def register(spark: SparkSession) -> None:
    """Make ``listing_rows``, ``page_anchors`` and ``result_blocks`` known to this session's SQL."""
    for name, handler in (("listing_rows", ListingRows), ("page_anchors", PageAnchors), ("result_blocks", ResultBlocks)):
        spark.udtf.register(name, F.udtf(handler, useArrow=True))
