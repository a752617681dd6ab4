"""Registration of queries and small fixed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
#: Queries on invented rows, name -> (query, SQL), whose name a query on given tables has taken over; tests run them.
CASES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame, with the SQL that gives the same rows on the same tables."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            CASES[name] = QUERIES[name], ORACLE_SQL.pop(name, None)
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def literal_list(values: list) -> str:
    return "[" + ", ".join(map(literal, values)) + "]"


class Fixture:
    """A small table, as a DataFrame and as SQL."""

    def __init__(self, schema: str, rows: list[tuple]) -> None:
        self.schema, self.rows = schema, rows

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.schema)

    @property
    def sql(self) -> str:
        names = ", ".join(part.split()[0] for part in self.schema.split(", "))
        rows = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in self.rows)
        return f"(SELECT * FROM (VALUES {rows}) v({names}))"
