"""Upserts of a stream into a versioned table, each micro-batch exactly once.

The table's rows are dealt to buckets by a hash of their key. A batch rewrites only the buckets that it has keys for, into a folder of its own, and then
adds a manifest that says for each bucket which batch wrote it last. The newest complete manifest is the table, and its number is the ledger:
a batch that is delivered again finds its own number there and changes nothing, one whose writer was lost before its manifest was complete is written anew.
Readers see the table before or after a batch, never in between.

Defined cases: of several rows of a key in a batch and the table the latest by the order columns counts (keep="first": the earliest), rows that are equal in them go by the other columns; null
keys are a key; an empty batch adds a manifest only; a table without any batch is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.search import first_seen, latest

BUCKETS = 64


class UpsertTable:
    """A table at path of rows of a schema (DDL), with one row for each key."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], order: list[str], buckets: int = BUCKETS, keep: str = "latest") -> None:
        self.spark, self.path, self.key, self.order, self.buckets = spark, path.rstrip("/"), key, order, buckets
        self.schema = spark.createDataFrame([], schema).schema
        self._merge = {"latest": latest, "first": first_seen}[keep]

    def ledger(self) -> int:
        """The number of the last batch that is in the table; -1 before the first."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/batch=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return max((int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found or []), default=-1)

    def _manifest(self, number: int) -> dict[int, int]:
        """bucket -> the batch that wrote it last. There are no more rows than buckets."""
        if number < 0:
            return {}
        return {r["bucket"]: r["written"] for r in self.spark.read.schema("bucket int, written long").parquet(f"{self.path}/manifests/batch={number}").collect()}

    def _rows(self, manifest: dict[int, int]) -> DataFrame:
        with_bucket = StructType([*self.schema.fields, StructField("_bucket", IntegerType())])
        if not manifest:
            return self.spark.createDataFrame([], with_bucket)
        paths = [f"{self.path}/data/batch={written}/_bucket={bucket}" for bucket, written in sorted(manifest.items())]
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        return rows.withColumn("_bucket", self._bucket())

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        return self._rows(self._manifest(self.ledger())).drop("_bucket")

    def merge(self, batch: DataFrame, number: int) -> bool:
        """Bring a batch into the table, unless it is there already; whether it wasn't."""
        done = self.ledger()
        if number <= done:
            return False
        manifest = self._manifest(done)
        incoming = batch.select(*self.schema.names).withColumn("_bucket", self._bucket()).persist()
        try:
            touched = [r[0] for r in incoming.select("_bucket").distinct().collect()]
            if touched:
                old = self._rows({b: w for b, w in manifest.items() if b in touched})
                rows = self._merge(incoming.unionByName(old), [*self.key, "_bucket"], self.order)
                rows.repartition(len(touched), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/data/batch={number}")
        finally:
            incoming.unpersist()
        manifest |= dict.fromkeys(touched, number)
        listed = self.spark.createDataFrame(sorted(manifest.items()), "bucket int, written long")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/batch={number}")
        return True


def upsert_stream(stream: DataFrame, table: UpsertTable, checkpoint: str):
    """Start a query that brings each micro-batch of the stream into the table and ends when what is there has been read."""
    writer = stream.writeStream.foreachBatch(lambda batch, number: table.merge(batch, number) and None)
    return writer.option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
