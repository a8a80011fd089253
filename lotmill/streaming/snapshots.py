"""Change detection over snapshots as they arrive, with keyed state in Spark's state store.

A stateful processor holds for each listing key its owner, the owner's last tracked values and what is known of its history.
It is called for a bucket of keys, not for each, as a call costs more than the rows of most keys; the state has a row a key.
A batch reads and writes the keys that it brings; the state store's changelog makes up its checkpoint, so that work grows
with the batch and not with the state, and a restart goes on where the checkpoint ends.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.changes import keyed
from ..params import IDENTITY, TRACKED
from ..sources.state import as_json, replace_batch

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Normalised values as JSON arrays, prices and times as they came.
HELD = "owner string, tracked string, price long, first_seen string, last_seen string, last_changed string, observations long, owner_json string, raw_json string"
#: Buckets that keys are dealt into; a task holds the rows that a batch brings for one.
BUCKETS = 1024
#: Rows that leave a Python worker at once.
CHUNK = 10_000
STATUS = (
    "listing_key string, nth string, at string, status string, price_drop boolean, changes array<struct<field: string, old_value: string, new_value: string>>, "
    "incoming_json string, existing_json string"
)

NAMES = ["listing_key", "nth", "at", "status", "price_drop", "changes", "incoming_json", "existing_json"]


class ListingState(StatefulProcessor):
    """Status of each observation of a key against the one before; the first observation owns the key.

    Observations of a batch follow each other by ``order``; a batch follows the batches before it, whatever its dates.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.listing = handle.getMapState("listing", "listing_key string", HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["listing_key", "nth"], kind="stable")
        columns = (batch[c].tolist() for c in ("listing_key", "identity", "tracked", "price", "nth", "at", "row_json"))
        out, last, held = [], None, None
        for name, identity, tracked, price, nth, at, row_json in zip(*columns):
            if name != last:
                if last is not None:
                    self.listing.updateValue((last,), tuple(held))
                last, held = name, self.listing.getValue((name,))
                held = None if held is None else list(held)
            price = None if price is None else int(price)
            drop, changes, existing = False, [], None
            if held is None:
                status, held = "new", [identity, tracked, price, at, at, at, 1, row_json, row_json]
            elif held[0] != identity:
                status, existing = "collision", held[8]
            else:
                status = "unchanged" if held[1] == tracked else "changed"
                if status == "changed":
                    drop = held[2] is not None and price is not None and price < held[2]
                    pairs = zip(TRACKED, json.loads(held[1]), json.loads(tracked))
                    changes = [{"field": f, "old_value": a, "new_value": b} for f, a, b in pairs if a != b]
                    held[5], held[8] = max(held[5], at), row_json
                held[1:3], held[3], held[4], held[6] = [tracked, price], min(held[3], at), max(held[4], at), held[6] + 1
            out.append((name, nth, at, status, drop, changes, row_json, existing))
            if len(out) == CHUNK:
                yield pd.DataFrame(out, columns=NAMES)
                out = []
        self.listing.updateValue((last,), tuple(held))
        yield pd.DataFrame(out, columns=NAMES)

    def close(self) -> None:
        pass


def statuses(stream: DataFrame, order: Sequence[str], at: str) -> DataFrame:
    """The stream of statuses: key, place in the order (``nth``), time, status, changes, price drop, and the rows as JSON."""
    rows = keyed(stream)
    asked = rows.select(
        "listing_key", F.to_json("__identity").alias("identity"), F.to_json("__tracked").alias("tracked"), F.col("reserve_price").cast("long").cast("string").alias("price"),
        F.array_join(F.array(*[_sortable(rows, c) for c in order]), " ").alias("nth"), F.col(at).cast("string").alias("at"),
        as_json(rows.select(*IDENTITY, *TRACKED, *[c for c in (*order, at) if c not in (*IDENTITY, *TRACKED)])).alias("row_json"),
    )
    asked = asked.withColumn("bucket", F.pmod(F.xxhash64("listing_key"), F.lit(BUCKETS)).cast("int"))
    return asked.groupBy("bucket").transformWithStateInPandas(ListingState(), outputStructType=STATUS, outputMode="Append", timeMode="None")


def _sortable(rows: DataFrame, column: str) -> F.Column:
    """Text that sorts as the column does: whole numbers with leading zeros, others (dates, times, texts) as they are shown."""
    if dict(rows.dtypes)[column] in ("tinyint", "smallint", "int", "bigint"):
        return F.lpad((F.col(column).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def follow(
    stream: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ("run_date", "input_seq"), at: str = "run_date", writer: str = "stream",
) -> StreamingQuery:
    """Statuses of every arriving batch, as a batch of a log below ``path``; a batch that runs again replaces what it wrote."""
    spark = stream.sparkSession
    out = statuses(stream, order, at)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # the query takes the setting along when it starts
    try:
        return (
            out.writeStream.foreachBatch(lambda batch, k: replace_batch(batch, path, writer, k))
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def listing_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state after the last batch, a row for each listing key, out of the checkpoint."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "listing").load()
    return rows.select(F.col("user_map_key.listing_key").alias("listing_key"), "user_map_value.*")
