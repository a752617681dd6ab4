"""Refresh of the law dictionary: merge, counters, guards, staleness, atomic publication."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MIN_DICTIONARY
from ..functions.identifiers import is_stale

ABOLISHED_SHARE = 0.5


class RefusedRefresh(ValueError):
    """The new dictionary looks damaged; the old one stays."""


def merged(laws: DataFrame, orders: DataFrame) -> DataFrame:
    """ordinal, law_name, pcode, abolished of both feeds (see sources.files.feed_laws), each with an ordinal: of equal names the last holds.

    An item's code counts as abolished if any item with the code is.
    """
    both = laws.withColumn("source", F.lit(0)).unionByName(orders.withColumn("source", F.lit(1)))
    last = both.groupBy("law_name").agg(F.max_by("pcode", F.struct("source", "ordinal")).alias("pcode"), F.min(F.struct("source", "ordinal")).alias("at"))
    gone = both.where("abolished").select("pcode").distinct().withColumn("gone", F.lit(True))
    return last.join(gone, "pcode", "left").select(F.col("at.source").alias("source"), F.col("at.ordinal").alias("ordinal"), "law_name", "pcode", F.coalesce("gone", F.lit(False)).alias("abolished"))


def counters(items: DataFrame) -> DataFrame:
    """One row: law_count and order_count (items), total (names), abolished_count (codes). items: kind, law_name, pcode, abolished."""
    return items.agg(
        F.count_if(F.col("kind") == "law").alias("law_count"), F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_distinct("law_name").alias("total"), F.count_distinct(F.when(F.col("abolished"), F.col("pcode"))).alias("abolished_count"),
    )


def guard(total: Column, abolished: Column, least: int = MIN_DICTIONARY) -> Column:
    """Why a dictionary is refused: too few names, or more than half abolished; null if it is fine."""
    return F.when(total < least, "too_few").when(abolished > total * ABOLISHED_SHARE, "too_many_abolished")


def publish(items: DataFrame, path: str, least: int = MIN_DICTIONARY) -> None:
    """Replace the dictionary at path by items if the guards let it pass; readers see the old or the new one.

    A version is written whole beside the others before a one-line pointer file names it, and the pointer is
    replaced by a rename.
    """
    spark = items.sparkSession
    version = uuid.uuid4().hex
    target = f"{path}/version={version}"
    items.write.parquet(target)
    row = counters(spark.read.parquet(target)).withColumn("refused", guard(F.col("total"), F.col("abolished_count"), least)).first()
    if row.refused:
        raise RefusedRefresh(f"{row.refused}: {row.total} names, {row.abolished_count} abolished codes")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pointer, fresh = jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT"), jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT.{version}")
    fs = pointer.getFileSystem(conf)
    out = fs.create(fresh)
    out.write(bytearray(version.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fresh, pointer, options)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary that the pointer names."""
    version = spark.read.text(f"{path}/CURRENT", wholetext=True).first()[0].strip()
    return spark.read.parquet(f"{path}/version={version}")


def reload_view(spark: SparkSession, laws: DataFrame, view: str, least: int = MIN_DICTIONARY) -> bool:
    """Swap a temporary view to a dictionary of at least so many names; False (and no swap) for a smaller one."""
    if laws.limit(least).count() < least:
        return False
    laws.createOrReplaceTempView(view)
    return True


def staleness(headers: DataFrame, now: Column) -> DataFrame:
    """headers with stale: update_date is missing, unreadable or before the latest Saturday."""
    return headers.withColumn("stale", is_stale(F.coalesce("update_date", F.lit("")), now))
