"""Queries in SQL text that call the library's functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.sql import register
from .base import ORACLE_SQL, query, table
from .tables import COUNTED, ITEM_ARTICLES, REFS
from .texts import KEYWORD


def _sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    register(spark)
    return spark.sql(text, **views)


@query("sql_snippets", ORACLE_SQL["kwic_snippets"])
def sql_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 as a table function joined to each document."""
    return _sql(spark, f"SELECT d.doc_id, s.position, s.snippet FROM {{docs}} d, LATERAL keyword_snippets(d.text, '{KEYWORD}', 200, 10) s", docs=table(spark, sf_dir, "documents"))


@query(
    "sql_citations_by_customer",
    """SELECT o_custkey, 0 AS rank, 0::BIGINT AS year, o_orderkey % 13 AS number FROM orders WHERE o_orderkey % 2 = 0 UNION
    SELECT o_custkey, 1, year(o_orderdate) - 1880, o_orderkey % 5 FROM orders WHERE o_orderkey % 3 = 0""",
)
def sql_citations_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, O8, X4 as a table function over all rows of a key."""
    text = """SELECT o_custkey, concat_ws('及', CASE WHEN o_orderkey % 2 = 0 THEN concat('釋字第 ', o_orderkey % 13, ' 號') END, CASE WHEN o_orderkey % 3 = 0 THEN concat(year(o_orderdate) - 1880, '年憲判字第', o_orderkey % 5, '號') END) AS body FROM {orders}"""
    rows = spark.sql(text, orders=table(spark, sf_dir, "orders"))
    return _sql(spark, "SELECT * FROM distinct_citations(TABLE(SELECT * FROM {rows}) PARTITION BY (o_custkey), 'body')", rows=rows)


@query("sql_case_references", f"SELECT ordinal, system AS case_system, year AS case_year, number AS case_number FROM ({ORACLE_SQL['parse_case_id']})")
def sql_case_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 as scalar functions."""
    return _sql(spark, "SELECT ordinal, case_system(raw) AS case_system, case_year(raw) AS case_year, case_number(raw) AS case_number FROM {refs}", refs=REFS.frame(spark, sf_dir))


@query("sql_chinese_numbers", f"SELECT numeral, value FROM {COUNTED.sql}")
def sql_chinese_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19 as a scalar function."""
    return _sql(spark, "SELECT numeral, chinese_number(numeral) AS value FROM {rows}", rows=COUNTED.frame(spark, sf_dir))


@query("sql_article_range", f"SELECT number, major, minor FROM ({ORACLE_SQL['article_range_ordered']})")
def sql_article_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11, X1 as scalar functions."""
    return _sql(spark, """SELECT number, article_major(number) AS major, article_minor(number) AS minor FROM {rows} WHERE pcode = 'B0000001' AND NOT contains(number, '.')
      AND (article_major(number), article_minor(number)) >= (15, 1) AND (article_major(number), article_minor(number)) <= (247, 1)""", rows=ITEM_ARTICLES.frame(spark, sf_dir))  # fmt: skip
