"""Tables with one row a key that batches change: bucketed by the key, and versioned bucket by bucket.

A batch replaces the buckets that its keys fall in and no others, under its own number; a bucket's newest version counts.
What a batch reads is the table as it was before its number, so that a batch that runs again finds the same and writes the
same.  Scans keep the buckets: a join on the key moves the batch only, never the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stage import staged

VERSION, BUCKET = "batch_no", "bucket_no"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


class KeyedTable:
    """A table below ``path``, known to this session's catalog as ``name``."""

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, key: str = "listing_key", buckets: int = 64):
        self.spark, self.name, self.key, self.buckets, self.schema = spark, name, key, buckets, schema
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {VERSION} BIGINT, {BUCKET} INT) USING parquet PARTITIONED BY ({VERSION}, {BUCKET}) "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {name}")  # versions that an earlier session wrote

    def bucket(self) -> Column:
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def newest(self, before: int | None = None) -> dict[int, int]:
        """Version of each bucket, of those before a batch."""
        found: dict[int, int] = {}
        for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():  # at most a row for each bucket and version
            version, bucket = (int(p.split("=")[1]) for p in r[0].split("/"))
            if before is None or version < before:
                found[bucket] = max(version, found.get(bucket, version))
        return found

    def read(self, before: int | None = None, only: set[int] | None = None) -> DataFrame:
        """The table as it is, or as it was before a batch; of some buckets only, if told."""
        by_version: dict[int, list[int]] = {}
        for bucket, version in self.newest(before).items():
            if only is None or bucket in only:
                by_version.setdefault(version, []).append(bucket)
        chosen = F.lit(False)
        for version, buckets in by_version.items():
            chosen = chosen | ((F.col(VERSION) == version) & F.col(BUCKET).isin(buckets))
        return self.spark.table(self.name).where(chosen).drop(VERSION, BUCKET)

    def touched(self, keys: DataFrame) -> set[int]:
        """Buckets that hold the keys of a batch."""
        return {r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect()}

    def write(self, rows: DataFrame, batch_no: int) -> None:
        """Whole buckets as the version of a batch; what the batch wrote before is replaced.

        The rows are staged, as Spark does not overwrite a table that they may come from, whatever its partitions.
        """
        out = staged(rows, self.key)
        out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields], F.lit(batch_no).cast("long").alias(VERSION), self.bucket().alias(BUCKET))
        before = self.spark.conf.get(OVERWRITE)
        self.spark.conf.set(OVERWRITE, "dynamic")  # insertInto takes it from the session alone
        try:
            out.repartition(self.buckets, self.key).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(OVERWRITE, before)

    def merge(self, batch: DataFrame, batch_no: int, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Apply ``merged(old, batch)``, which returns all rows of the old table and of the batch, to the buckets that the batch touches."""
        self.write(merged(self.read(batch_no, self.touched(batch)), batch), batch_no)

    def forget(self, before: int) -> None:
        """Drop versions that no batch from ``before`` on reads."""
        kept = set(self.newest(before).items())
        for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            version, bucket = (int(p.split("=")[1]) for p in r[0].split("/"))
            if version < before and (bucket, version) not in kept:
                path = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").first()[1]
                self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({VERSION} = {version}, {BUCKET} = {bucket})")
                hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}={version}/{BUCKET}={bucket}")
                hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)
