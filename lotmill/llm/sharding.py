"""Sharding along a Hilbert curve, with built-in functions only.

Several metadata columns are quantised to cells of near-equal row counts, the cell of each row gets its index on the
Hilbert curve, rows are sorted by it over the whole cluster, and the sorted run is cut into shards.  Rows of a shard
are close in every dimension at once, so that a reader can skip shards by their ranges in any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table, text_or_empty, without

BITS = 5


def hilbert_steps(dims: int) -> tuple[list[int], list[int]]:
    """For each state and corner: the digit on the curve, and the next state.  A state is entry corner * dims + axis.

    From the rule of Hamilton's compact Hilbert indices: reflect by the entry corner, rotate by the axis, undo the
    Gray code; then move to the entry corner and the axis of the cell that was entered.
    """
    full = (1 << dims) - 1
    rotl = lambda x, k: ((x << k % dims) | (x >> (dims - k % dims))) & full
    gray = lambda x: x ^ (x >> 1)
    ungray = {gray(x): x for x in range(full + 1)}
    trailing = lambda x: ((~x) & (x + 1)).bit_length() - 1  # noqa: E731  ones at the low end
    digits, states = [], []
    for entry in range(full + 1):
        for axis in range(dims):
            for corner in range(full + 1):
                w = ungray[rotl(corner ^ entry, dims - (axis + 1))]
                inner = 0 if w == 0 else gray(2 * ((w - 1) // 2))
                turn = 0 if w == 0 else trailing(w - 1 if w % 2 == 0 else w) % dims
                digits.append(w)
                states.append((entry ^ rotl(inner, axis + 1)) * dims + (axis + turn + 1) % dims)
    return digits, states


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell, from the highest bit of each coordinate down."""
    digits, states = (F.array(*[F.lit(x) for x in table]) for table in hilbert_steps(len(cells)))
    size = 1 << len(cells)

    def corner(level: Column) -> Column:
        out = F.lit(0)
        for k, cell in enumerate(cells):
            bit = F.call_function("shiftright", cell, level).bitwiseAND(F.lit(1))
            out = out + bit * (1 << k)
        return out

    def step(acc: Column, level: Column) -> Column:
        at = acc["state"] * size + corner(level) + 1
        return F.struct(
            F.element_at(states, at).alias("state"), (acc["h"] * size + F.element_at(digits, at)).cast("long").alias("h"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda acc: acc["h"])


def _below(value: Column):
    return lambda point: point < value


def is_text(kind: str) -> bool:
    return kind in ("string", "binary") or kind.startswith(("char", "varchar"))


#: Bounds of doubles: infinities and what is beyond count as these.
LARGEST = 1.7976931348623157e308


def is_fraction(kind: str) -> bool:
    return kind in ("float", "double") or kind.startswith("decimal")


def as_number(column: Column, kind: str) -> Column:
    """A number in the column's own order, a double for fractions and decimals, else a long; null is before all, NaN after all."""
    if is_fraction(kind):
        number = column.cast("double")
        bounded = F.greatest(F.least(number, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.when(number.isNull(), -LARGEST).when(F.isnan(number), LARGEST).otherwise(bounded)
    if kind in ("timestamp", "timestamp_ntz"):
        column = F.unix_micros(column.cast("timestamp"))
    elif kind == "date":
        column = F.unix_date(column).cast("long")
    else:
        column = column.cast("long")
    return F.coalesce(column, F.lit(-(2**63)))


def text_cells(docs: DataFrame, column: Column, cells: int) -> list[tuple[str, int]]:
    """First text and number of each cell, by rank: a cell ends where a further ``1 / cells`` of all rows do.

    Rows are counted by text first, so that a hot text is one row; the texts are sorted over the whole cluster, and places
    are summed up within sorted partitions and over partitions.  At most ``cells`` rows come to the driver.
    """
    counts = docs.groupBy(column.alias("value")).agg(F.count("*").alias("n")).where("value IS NOT NULL")
    nulls = docs.where(column.isNull()).count()
    run = counts.repartitionByRange("value").sortWithinPartitions("value").withColumn("part", F.spark_partition_id())
    run = stage_table(run, "values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each sorted partition
    sums = run.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all")
    )
    within = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.lit(nulls) + F.col("before") + F.col("upto") - F.col("n") / 2
    placed = run.withColumn("upto", F.sum("n").over(within)).join(F.broadcast(sums), "part")
    placed = placed.select("value", F.floor(middle * cells / (F.col("all") + nulls)).cast("int").alias("cell"))
    return [(r["value"], r["cell"]) for r in placed.groupBy("cell").agg(F.min("value").alias("value")).orderBy("cell").collect()]


def hilbert_shards(
    docs: DataFrame,
    shards: int = 40,
    dims: Sequence[str] = ("source", "lang", "size"),
    law: str = "rows",
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Deal documents into ``shards`` runs along the Hilbert curve of ``dims``.

    Returns the id, the columns in ``carry`` (name the text and others here to write the shards), ``size`` (UTF-8
    bytes of the text plus 16), ``text_crc32``, ``hilbert``, ``law``, ``shard`` and ``slot`` (place in the shard,
    gapless from 0).  ``law`` is ``rows`` (counts at most one apart) or ``bytes`` (sizes near equal).  ``size`` may be
    named in ``dims``.

    Texts, numbers and times in a dimension are quantised by rank, whatever they begin with: whole numbers and times as longs,
    fractions and decimals as doubles.  NaN and infinity come last.

    Defined results: null texts have no bytes and the checksum of the empty text; a null in a dimension sorts first;
    rows of one cell are ordered by checksum and id, so that a hot cell is split like any other; with fewer rows than
    shards some shards are empty; an empty table gives an empty result; carried columns named as an output column are
    replaced.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law must be rows or bytes, not {law!r}")
    out = ("size", "text_crc32", "hilbert", "law", "shard", "slot")
    kinds = {name.lower(): kind for name, kind in docs.dtypes}
    size = F.octet_length(text_or_empty(text_col)).cast("long") + 16
    texts = [i for i, d in enumerate(dims) if d != "size" and is_text(kinds[d.lower()])]
    numbers = [i for i in range(len(dims)) if i not in texts]
    keys = [F.col(d) if i in texts else size if d == "size" else as_number(F.col(d), kinds[d.lower()]) for i, d in enumerate(dims)]
    taken = {*out, id_col.lower()}
    rows = docs.select(
        F.col(id_col), *[F.col(f"`{c}`") for c in carry if c.lower() not in taken], size.alias("size"),
        F.crc32(text_or_empty(text_col)).alias("text_crc32"), *[k.alias(f"__d{i}") for i, k in enumerate(keys)],
    )
    marks = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    cuts = {}
    if numbers:
        asked = [F.percentile_approx(f"__d{i}", marks, 10_000).alias(f"c{i}") for i in numbers]
        cuts = docs.select([keys[i].alias(f"__d{i}") for i in numbers]).agg(*asked).first().asDict()
    cells = []
    for i in range(len(dims)):
        value = F.col(f"__d{i}")
        if i in texts:
            cell = F.lit(0)
            for first, number in text_cells(docs, keys[i], 1 << BITS):
                cell = F.when(value >= F.lit(first), number).otherwise(cell)
            cells.append(cell.cast("int").alias(f"__c{i}"))
            continue
        points = sorted(set(cuts[f"c{i}"] or []))
        number = "double" if is_fraction(kinds.get(dims[i].lower(), "")) else "bigint"
        at = F.array(*[F.lit(x) for x in points]).cast(f"array<{number}>")
        place = F.size(F.filter(at, _below(value)))  # few values are spread over all cells, so that their first bits tell them apart
        cells.append(F.floor(place * (1 << BITS) / (len(points) + 1)).cast("int").alias(f"__c{i}"))
    rows = rows.withColumns({f"__c{i}": c for i, c in enumerate(cells)})
    rows = rows.withColumn("hilbert", hilbert_index([F.col(f"__c{i}") for i in range(len(dims))]))
    order = ["hilbert", "text_crc32", id_col]
    run = rows.drop(*[f"__{x}{i}" for x in "dc" for i in range(len(dims))])
    run = run.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    run = stage_table(run, "run")  # the place in the sorted run is fixed from here on

    part, local = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each sorted partition
    offsets = (
        run.groupBy(part.alias("__part")).agg(F.count("*").alias("n"), F.sum("size").alias("b"))
        .select(
            "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__rows0"),
            F.coalesce(F.sum("b").over(before), F.lit(0)).alias("__bytes0"), F.sum("n").over(Window.partitionBy()).alias("__n"),
            F.sum("b").over(Window.partitionBy()).alias("__b"),
        )
    )
    ranked = run.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn("__rank", F.col("__rows0") + local)
    if law == "rows":
        ranked = ranked.withColumn("shard", F.expr(f"CAST(__rank * {shards} DIV __n AS INT)"))
        ranked = ranked.withColumn("slot", F.expr(f"__rank - (shard * __n + {shards - 1}) DIV {shards}"))
    else:
        upto = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
        middle = F.col("__bytes0") + F.sum("size").over(upto) - F.expr("(size + 1) DIV 2")
        ranked = ranked.withColumn("__middle", middle).withColumn("shard", F.expr(f"CAST(__middle * {shards} DIV __b AS INT)"))
        first = ranked.groupBy("shard").agg(F.min("__rank").alias("__first"))  # one row a shard
        ranked = ranked.join(F.broadcast(first), "shard").withColumn("slot", F.col("__rank") - F.col("__first"))
    ranked = ranked.withColumn("law", F.lit(law))
    return ranked.select(id_col, *[c for c in carry if c.lower() not in taken], *out)


def op6_hilbert_sharding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return hilbert_shards(docs).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )
