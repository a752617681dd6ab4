"""A table of ranges against a table of points, as equi-joins.

Points lie in cells of a fixed width. Cells that hold points are counted; a range is cut into dyadic nodes of the cells it spans (at most two for each power of
two), every cell knows the nodes above it, and equality of nodes tells which cells with points a range meets, each exactly once. So a wide range costs
a logarithm and then only the cells that have something for it, which its result pays for. Cells with more than HOT points (one article that everybody cites) are
salted: points are dealt to salts by a hash, and the ranges of that cell are repeated for each. Only the cells at a range's ends compare values
that don't match; there is no nested loop. The joins are merge joins by hint: nodes and cells are enumerated rows, which the planner takes to be as few as
the rows they come from, and would broadcast through the driver.

Defined cases: both ends of a range count; a range that ends before it begins, one with a null end, and null points meet nothing; null keys
meet nothing, as in any equi-join; repeated ranges and points count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import article_order

CELL = 256
HOT = 100_000
#: Minor numbers below each major one in the key of articles.
MINORS = 1 << 20
_LEVELS = 62


def article_number_key(number: Column) -> Column:
    """article_order as one long."""
    at = article_order(number)
    return at["major"].cast("long") * MINORS + F.least(at["minor"].cast("long"), F.lit(MINORS - 1))


def dyadic_nodes(lo: Column, hi: Column) -> Column:
    """array<struct<level, node>>: the fewest nodes (node << level up to the next one) that cover lo..hi; empty if hi < lo."""
    none = F.array().cast("array<struct<level:int,node:long>>")
    node = lambda level, n: F.array(F.struct(level.alias("level"), n.alias("node")))
    start = F.struct(lo.cast("long").alias("l"), (hi.cast("long") + 1).alias("r"), none.alias("nodes"))

    def step(s: Column, level: Column) -> Column:
        open_ = s["l"] < s["r"]
        left, right = open_ & (s["l"].bitwiseAND(F.lit(1).cast("long")) == 1), open_ & (s["r"].bitwiseAND(F.lit(1).cast("long")) == 1)
        found = F.concat(s["nodes"], F.when(left, node(level, s["l"])).otherwise(none), F.when(right, node(level, s["r"] - 1)).otherwise(none))
        up = lambda v: F.shiftright(v, 1)
        l, r = up(s["l"] + F.when(left, 1).otherwise(0)), up(s["r"] - F.when(right, 1).otherwise(0))  # noqa: E741
        return F.when(open_, F.struct(l.alias("l"), r.alias("r"), found.alias("nodes"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(0), F.lit(_LEVELS - 1)), start, step, lambda s: s["nodes"])


def range_join(points: DataFrame, ranges: DataFrame, by: list[str], point: str, lo: str, hi: str, cell: int = CELL, hot: int = HOT) -> DataFrame:
    """ranges beside the points (same values of by, lo <= point <= hi). Columns other than by must have different names in the two tables."""
    clash = (set(points.columns) & set(ranges.columns)) - set(by)
    if clash:
        raise ValueError(f"columns in both tables: {sorted(clash)}")
    of = lambda c: F.expr(f"CAST(floor(CAST(`{c}` AS DECIMAL(20, 0)) / {cell}) AS BIGINT)")
    dealt = points.where(F.col(point).isNotNull()).withColumn("_cell", of(point))
    cells = dealt.groupBy(*by, "_cell").agg(F.count("*").alias("_n")).select(*by, "_cell", F.ceil(F.col("_n") / hot).cast("int").alias("_salts"))
    span = ranges.where(F.col(lo) <= F.col(hi))
    nodes = span.withColumn("_node", F.explode(dyadic_nodes(of(lo), of(hi))))
    top = span.agg(F.max(F.greatest(F.abs(of(lo)), F.abs(of(hi))))).first()[0] or 1
    above = F.explode(F.transform(F.sequence(F.lit(0), F.lit(int(top + 1).bit_length())), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", "_cell", k).alias("node"))))
    met = nodes.hint("merge").join(cells.withColumn("_node", above), [*by, "_node"]).drop("_node")
    asked = met.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    every = [c for c in points.columns if c not in by]
    salted = dealt.hint("merge").join(cells, [*by, "_cell"]).withColumn("_salt", F.pmod(F.xxhash64(*every), F.col("_salts")).cast("int")).drop("_salts")
    return asked.drop("_salts").hint("merge").join(salted, [*by, "_cell", "_salt"]).where(F.col(point).between(F.col(lo), F.col(hi))).drop("_cell", "_salt")


def articles_in_ranges(articles: DataFrame, ranges: DataFrame) -> DataFrame:
    """ranges (range_id, pcode, from_no, to_no) beside the articles (pcode, number, ...) between their ends, with 15-10 between 15-9 and 16."""
    points = articles.withColumn("_at", article_number_key(F.col("number")))
    spans = ranges.withColumns({"_from": article_number_key(F.col("from_no")), "_to": article_number_key(F.col("to_no"))})
    return range_join(points, spans, ["pcode"], "_at", "_from", "_to", cell=CELL * MINORS).drop("_at", "_from", "_to")
