"""Deep pages of an ordered table.

`orderBy().offset()` sorts everything for every page. A ranked table is written once in ranges of its order: rows within a range are sorted, and a small table keeps for each range how
many rows it has and how many come before. Page k then reads only the ranges that hold its rows (one or two folders), and a continuation token, the order values
of the last row given out, finds its range by the first values of the ranges.

Defined cases: the order should end in a unique column, else rows of equal order may change places between two builds (not between pages of one
build); nulls come first in ascending and last in descending order, as in orderBy; a page beyond the end is empty; negative offsets and sizes below 1 are refused.
"""

from __future__ import annotations

import base64
import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..constants import PAGE_SIZE

RANGE_ROWS = 1 << 18
#: Ranges of a table at most. Each costs a task, a folder, and sampled rows and a task's report for the driver; in a table with more rows than that the ranges grow.
MOST_RANGES = 512


class RankedTable:
    """A table at path, ordered by columns; a leading - makes one descending."""

    def __init__(self, spark: SparkSession, path: str, order: list[str]) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.names = [c.removeprefix("-") for c in order]
        self.down = [c.startswith("-") for c in order]

    @property
    def _order(self) -> list[Column]:
        return [F.col(n).desc() if d else F.col(n).asc() for n, d in zip(self.names, self.down, strict=True)]

    def build(self, rows: DataFrame, range_rows: int = RANGE_ROWS) -> RankedTable:
        """Write the rows in ranges of about range_rows, or more where that would make more than MOST_RANGES of them."""
        count = min(MOST_RANGES, max(1, -(-rows.count() // range_rows)))
        ranged = rows.repartitionByRange(count, *self._order).sortWithinPartitions(*self._order)
        ranged.withColumn("_range", F.spark_partition_id()).write.mode("overwrite").partitionBy("_range").parquet(f"{self.path}/rows")
        self.schema = rows.schema
        place = F.row_number().over(Window.partitionBy("_range").orderBy(*self._order))  # a range is of bounded size
        first = F.max(F.when(F.col("place") == 1, F.struct(*self.names))).alias("first")
        found = self._rows().select("_range", *self.names, place.alias("place")).groupBy("_range").agg(F.count("*").alias("n"), first)
        before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row for each range
        found.withColumn("before", before.cast("long")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ranges")
        return self

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("_range", IntegerType())])).parquet(f"{self.path}/rows")

    def ranges(self) -> DataFrame:
        """_range, n, first (order values of its first row), before."""
        return self.spark.read.parquet(f"{self.path}/ranges")

    def _read(self, numbers: list[int]) -> DataFrame:
        return self._rows().where(F.col("_range").isin(numbers))

    def page(self, offset: int, size: int = PAGE_SIZE) -> DataFrame:
        """size rows from offset on, in order."""
        if offset < 0 or size < 1:
            raise ValueError("an offset of 0 or more and a size of 1 or more are needed")
        held = self.ranges().where((F.col("before") < offset + size) & (F.col("before") + F.col("n") > offset)).orderBy("_range").collect()
        skip = offset - held[0]["before"] if held else 0
        return self._read([r["_range"] for r in held]).drop("_range").orderBy(*self._order).offset(skip).limit(size)

    def total(self) -> int:
        return self.ranges().agg(F.sum("n")).first()[0] or 0

    def token(self, rows: DataFrame) -> str:
        """The continuation after the last of the rows of a page: its order values, as text."""
        last = rows.orderBy(*[F.col(n).asc() if d else F.col(n).desc() for n, d in zip(self.names, self.down, strict=True)]).limit(1)
        value = last.select(F.to_json(F.struct(*self.names), {"ignoreNullFields": "false"})).first()
        return base64.urlsafe_b64encode((value[0] if value else "null").encode()).decode()

    def after(self, token: str, size: int = PAGE_SIZE) -> DataFrame:
        """The size rows that follow those of the page that the token comes from; none after an empty page. Only the range that holds the token is read, and the next ones until size rows are there."""
        text = base64.urlsafe_b64decode(token.encode()).decode()
        if text == "null":
            return self._read([]).drop("_range")
        json.loads(text)  # refuses what isn't a token
        schema = ", ".join(f"`{n}` {self.schema[n].dataType.simpleString()}" for n in self.names)
        given = [F.from_json(F.lit(text), schema)[n] for n in self.names]
        # the last range that doesn't begin beyond the token, and the next ones that fill the page
        begun = self.ranges().where(~self._beyond(given, "first.")).agg(F.max("_range")).first()[0]
        start, have = begun or 0, 0
        read = [start]
        for r in self.ranges().where(F.col("_range") > start).orderBy("_range").limit(size).collect():
            if have >= size:
                break
            read.append(r["_range"])
            have += r["n"]
        return self._read(read).where(self._beyond(given)).drop("_range").orderBy(*self._order).limit(size)

    def _beyond(self, given: list[Column], of: str = "") -> Column:
        """Rows after the given values: greater in one column, equal in those before it."""
        tests = []
        for i, (name, down) in enumerate(zip(self.names, self.down, strict=True)):
            own, value = F.col(of + name), given[i]
            beyond = (own < value) | (own.isNull() & value.isNotNull()) if down else (own > value) | (own.isNotNull() & value.isNull())
            same = reduce(lambda a, b: a & b, (F.col(of + n).eqNullSafe(g) for n, g in zip(self.names[:i], given[:i], strict=True)), F.lit(True))
            tests.append(same & F.coalesce(beyond, F.lit(False)))
        return reduce(or_, tests)
