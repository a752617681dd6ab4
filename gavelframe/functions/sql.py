"""The library's expressions for SQL: scalar functions and table functions, registered with a session.

Scalar functions are SQL expressions, which Spark inlines into the plan: article_key(number), article_major(number), article_minor(number), chinese_number(text), case_system(ref), case_year(ref),
case_number(ref). Table functions run in Python, a row or a partition at a time:

* keyword_snippets(text, keyword, context, most): position and snippet of the first matches of a text.
* distinct_citations(TABLE(docs) PARTITION BY key [ORDER BY ...]): the distinct citations of all rows of a key, in order; analyze() finds the columns that it partitions by, which come first in its rows.

Defined cases: null texts and keywords give no rows or null; the values are those of the functions of the same purpose for columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..constants import NEW_CITATION, OLD_CITATION, SNIPPET_CONTEXT, SNIPPET_MATCHES

_PARTS = "split(regexp_replace(number, '之', '-'), '-')"
_DIGITS = "零一二三四五六七八九"
_TRIM = r"regexp_replace(coalesce(ref, ''), '(?U)^\\s+|\\s+$', '')"


def _found(pattern: str) -> str:
    """The first group of a pattern in the trimmed reference as a number, or null; digits of any width."""
    return rf"try_cast(translate(nullif(regexp_extract({_TRIM}, '(?U){pattern}', 1), ''), '０１２３４５６７８９', '0123456789') AS BIGINT)"


_NEW, _OLD = f"contains({_TRIM}, '憲判')", f"(contains({_TRIM}, '釋字') OR contains({_TRIM}, '解釋'))"
_YEAR = f"coalesce({_found(r'(\\d+)\\s*年')}, {_found(r'^\\s*(\\d+)\\s*憲判')})"
_NUMBER = f"CASE WHEN {_NEW} THEN CASE WHEN {_YEAR} IS NOT NULL THEN {_found(r'憲判[^\\d]*(\\d+)')} END WHEN {_OLD} THEN {_found(r'(?:釋字|解釋)[^\\d]*(\\d+)')} ELSE {_found(r'^\\s*(\\d+)\\s*$')} END"
#: name -> (parameters, type, expression)
SCALAR = {
    "article_key": ("number STRING", "DOUBLE", f"coalesce(try_cast({_PARTS}[0] AS DOUBLE) + CASE WHEN size({_PARTS}) > 1 THEN try_cast(try_element_at({_PARTS}, 2) AS DOUBLE) / 10 ELSE 0.0D END, 0.0D)"),
    "article_major": ("number STRING", "INT", f"coalesce(try_cast({_PARTS}[0] AS INT), 0)"),
    "article_minor": ("number STRING", "INT", f"coalesce(try_cast(try_element_at({_PARTS}, 2) AS INT), 0)"),
    "chinese_number": ("numeral STRING", "BIGINT", f"""aggregate(filter(split(numeral, ''), c -> c <> ''), named_struct('total', 0L, 'digit', 0L),
      (s, c) -> CASE WHEN c IN ('十', '百', '千') THEN named_struct('total', s.total + (CASE WHEN s.digit = 0 AND c = '十' THEN 1L ELSE s.digit END) * (CASE c WHEN '十' THEN 10L WHEN '百' THEN 100L ELSE 1000L END), 'digit', 0L)
        WHEN c IN ('〇', '０') THEN named_struct('total', s.total, 'digit', 0L) WHEN instr('{_DIGITS}', c) > 0 THEN named_struct('total', s.total, 'digit', CAST(instr('{_DIGITS}', c) - 1 AS BIGINT)) ELSE s END, s -> s.total + s.digit)"""),
    "case_number": ("ref STRING", "BIGINT", _NUMBER),
    "case_system": ("ref STRING", "STRING", f"CASE WHEN ({_NUMBER}) IS NOT NULL THEN CASE WHEN {_NEW} THEN '憲判字' ELSE '釋字' END END"),
    "case_year": ("ref STRING", "BIGINT", f"CASE WHEN ({_NUMBER}) IS NOT NULL THEN CASE WHEN {_NEW} THEN {_YEAR} ELSE 0L END END"),
}


class KeywordSnippets:
    """Rows of the first matches of a keyword that don't overlap, with text on both sides."""

    @staticmethod
    def analyze(text: AnalyzeArgument, keyword: AnalyzeArgument, context: AnalyzeArgument | None = None, most: AnalyzeArgument | None = None) -> AnalyzeResult:
        for name, argument, kind in (("text", text, StringType), ("keyword", keyword, StringType), ("context", context, (IntegerType, LongType)), ("most", most, (IntegerType, LongType))):
            if argument is not None and not isinstance(argument.dataType, kind):
                raise ValueError(f"{name} has the wrong type")
        for name, argument in (("context", context), ("most", most)):
            if argument is not None and (argument.value is None or argument.value < 0):
                raise ValueError(f"{name} must be a constant that isn't negative")
        return AnalyzeResult(StructType().add("position", LongType()).add("snippet", StringType()))

    def eval(self, text: str | None, keyword: str | None, context: int = SNIPPET_CONTEXT, most: int = SNIPPET_MATCHES) -> Iterator[tuple[int, str]]:
        at = 0
        for _ in range(most if text and keyword else 0):
            at = text.find(keyword, at)
            if at < 0:
                return
            first, last = max(at - context, 0), min(at + len(keyword) + context, len(text))
            yield at, ("..." if first > 0 else "") + text[first:last] + ("..." if last < len(text) else "")
            at += len(keyword)


@dataclass
class PartitionedBy(AnalyzeResult):
    """The names of the columns that rows are partitioned by."""

    names: tuple[str, ...] = ()


class DistinctCitations:
    """The distinct citations of the rows of a partition: the old system's by number, then the new one's by year and number."""

    def __init__(self, about: PartitionedBy) -> None:
        self.names, self.key, self.found = about.names, (), set()

    @staticmethod
    def analyze(rows: AnalyzeArgument, text: AnalyzeArgument) -> PartitionedBy:
        if not rows.isTable:
            raise ValueError("the first argument must be a table")
        columns = rows.dataType
        if text.value not in columns.names:
            raise ValueError(f"no column {text.value}")
        names = tuple(n for n in columns.names if n != text.value)
        schema = StructType()
        for n in names:
            schema.add(n, columns[n].dataType)
        return PartitionedBy(schema.add("rank", IntegerType()).add("year", LongType()).add("number", LongType()), names=names)

    def eval(self, row, text: str) -> None:
        self.key = tuple(row[n] for n in self.names)
        body = row[text] or ""
        self.found |= {(0, 0, int(n)) for n in re.findall(OLD_CITATION, body)} | {(1, int(y), int(n)) for y, n in re.findall(NEW_CITATION, body)}

    def terminate(self) -> Iterator[tuple]:
        for rank, year, number in sorted(self.found):
            yield (*self.key, rank, year, number)


def register(spark: SparkSession) -> None:
    """Make the functions known to a session's SQL, in place of temporary ones of these names."""
    from pyspark.sql.functions import udtf

    for name, (parameters, kind, body) in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("keyword_snippets", udtf(KeywordSnippets))
    spark.udtf.register("distinct_citations", udtf(DistinctCitations))
