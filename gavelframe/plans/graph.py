"""Extensions beyond lookups: joins and aggregates over the star schema, and two-hop citations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.api import citation_edges
from .base import query, table
from .citations import _EDGES
from .fixtures import RULINGS


@query("citations_two_hops", f"WITH e AS ({_EDGES}) SELECT DISTINCT a.source, b.case_id AS target FROM e a JOIN e b ON b.source = a.case_id WHERE b.case_id <> a.source")
def citations_two_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = citation_edges(RULINGS.frame(spark)).select("source", "case_id")
    second = edges.select(F.col("source").alias("case_id"), F.col("case_id").alias("target"))
    return edges.join(second, "case_id").where("target <> source").select("source", "target").distinct()


@query("revenue_by_nation", "SELECT n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name")
def revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    rows = t("lineitem").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    price = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount")).cast("decimal(18,2)")
    return rows.groupBy("n_name").agg(F.sum(price).cast("double").alias("revenue"), F.count("*").alias("n"))


@query("pricing_summary", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    total = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), total("l_quantity").alias("sum_qty"), total("l_extendedprice").alias("sum_price"))
