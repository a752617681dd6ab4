"""As-of joins and next or last values whose partitions may be of any size.

A window over one partition runs in one task, however large that partition is. Here rows are dealt by ranges of (partition, order) instead, so that a span is a piece of
about SPAN_ROWS rows of neighbours and a huge partition has many. The value is carried on two levels:

1. within each span by a window over its rows,
2. between the spans of a partition by a window over one row a span: its first (or last) value.

A row takes the value of its own span and, where that has none, the one handed on. Ranges come from a sample, so the dealt rows are written once,
with the number of their span; all that follows reads that table and gives the same rows again if tasks are lost.

Defined cases: rows of equal order go by the tie columns, if given, else in any order among them; null orders come first; null partition values are a
partition; rows keep their number and columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import shared_folder

SPAN_ROWS = 1 << 20


def spans_of(rows: DataFrame, by: list[str], order: list[str], span_rows: int = SPAN_ROWS) -> DataFrame:
    """rows with _span: a number that grows with (by, order); each span holds about span_rows rows."""
    spark = rows.sparkSession
    count = max(1, -(-rows.count() // span_rows))
    path = shared_folder(spark, "spans")
    rows.repartitionByRange(count, *by, *order).withColumn("_span", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(StructType([*rows.schema.fields, StructField("_span", IntegerType())])).parquet(path)


def attach_near(rows: DataFrame, by: list[str], order: list[str], value: Column, name: str, forward: bool = True, own: bool = False, span_rows: int = SPAN_ROWS) -> DataFrame:
    """rows with the value of the next row (forward) or the last row before that has one; own: a row's own value comes first."""
    dealt = spans_of(rows.withColumn("_value", value), by, order, span_rows)
    towards = [F.col(c).desc() if forward else F.col(c).asc() for c in order]
    end = Window.currentRow if own else -1
    inside = F.last("_value", ignorenulls=True).over(Window.partitionBy("_span", *by).orderBy(*towards).rowsBetween(Window.unboundedPreceding, end))
    # of each span the value that the spans on its other side see: the nearest to them
    place = F.struct(*order)
    pick = F.min_by if forward else F.max_by
    sums = dealt.groupBy("_span", *by).agg(pick(F.when(F.col("_value").isNotNull(), F.col("_value")), F.when(F.col("_value").isNotNull(), place)).alias("_edge"))
    beyond = Window.partitionBy(*by).orderBy(F.col("_span").desc() if forward else F.col("_span").asc()).rowsBetween(Window.unboundedPreceding, -1)
    handed = sums.withColumn("_handed", F.last("_edge", ignorenulls=True).over(beyond)).where("_handed IS NOT NULL")
    h, d = handed.alias("h"), dealt.withColumn("_inside", inside).alias("d")
    same = F.col("d._span") == F.col("h._span")
    for c in by:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"h.{c}"))
    columns = [F.col(f"d.{c}").alias(c) for c in rows.columns if c != name]
    return d.join(h, same, "left").select(*columns, F.coalesce("d._inside", "h._handed").alias(name))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], forward: bool = False, exact: bool = True, span_rows: int = SPAN_ROWS) -> DataFrame:
    """left with the columns values of the nearest row of right at or before (forward: at or after) its own value of on, among equal values of by.

    exact: a row of right with the same value of on counts. Of rows of right that are equal in on the greatest by values counts. Rows of left whose on is null get nulls.
    """
    if clash := set(values) & set(left.columns):
        raise ValueError(f"columns in both tables: {sorted(clash)}")
    once = right.where(F.col(on).isNotNull()).groupBy(*by, on).agg(F.max(F.struct(*values)).alias("_r"))
    # at one value of on the right row stands where the left one sees it, or where it doesn't
    first = 0 if exact != forward else 1
    rows = left.select(*by, on, F.struct(*[c for c in left.columns if c not in (*by, on)]).alias("_l") if set(left.columns) - {*by, on} else F.lit(1).alias("_l"), F.lit(1 - first).alias("_side"), F.lit(True).alias("_mine"))
    others = once.select(*by, on, F.lit(None).cast(rows.schema["_l"].dataType).alias("_l"), F.lit(first).alias("_side"), F.lit(False).alias("_mine"), "_r")
    both = rows.withColumn("_r", F.lit(None).cast(others.schema["_r"].dataType)).unionByName(others)
    met = attach_near(both, by, [on, "_side"], F.col("_r"), "_found", forward, span_rows=span_rows).where("_mine")
    found = F.when(F.col(on).isNotNull(), F.col("_found"))
    kept = [F.col(c) if c in (*by, on) else F.col(f"_l.{c}").alias(c) for c in left.columns]
    return met.withColumn("_found", found).select(*kept, *(F.col(f"_found.{c}").alias(c) for c in values))
