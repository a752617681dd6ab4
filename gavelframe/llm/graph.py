"""Connected components by alternating large-star and small-star steps (joins and grouped minima only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long), in any direction -> node, component (its smallest reachable node).

    Nodes without an edge to another node don't appear. Each round writes its edges to the shared folder;
    a hub with many edges is joined with its minimum like any skewed key, never gathered in one group: minima are dealt
    out anew, so that adaptive execution can split the hub's edges.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = materialize(pairs, "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")).repartition("u")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m")).repartition("u")
        ends = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        small = large.join(lowest, "u").select(ends.alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        after = materialize(small, "edges")
        release(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.xxhash64("v", "u") / 1024).cast("long").cast("decimal(38,0)"))).first())
