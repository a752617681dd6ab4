"""The lookups on single texts, names and numbers over whole given tables.

A Derived table is a SELECT of one given table in expressions that Spark and DuckDB read alike; Spark's side runs the library's functions on it,
the SQL side says what these mean. Where a query on invented rows (plans/fixtures.py) has SQL that says its semantics, it is taken over with the tables exchanged.
Queries here take over the names of those on invented rows, which stay as cases for the tests (base.CASES).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CRITICAL_FIELDS, MIN_FIELDS
from ..functions.identifiers import (
    article_key, article_order, chinese_number, dotted_date, fold_variant, format_case_ref, is_stale, is_valid, jid_from_url, parse_case_ref, url_allowed, url_parameter, valid_jid,
)
from ..operators.api import Engine, citation_edges
from ..operators.refresh import merged
from ..operators.resolve import clean_statute_names, courts, known_names, names_of_codes, page_law_name, resolve_names, with_court, with_history
from ..operators.search import all_valid, attach_next, search_judgments
from ..session import shared_folder
from ..sources import archive
from ..sources.html import judgment_pages, missing_fields, result_list, ruling_pages, single_articles, statute_pages
from .base import ORACLE_SQL, query, table
from .citations import CASE_REFS, NUMERALS
from .fixtures import ARTICLES, CODES, HISTORIES, JIDS, LAWS, RULINGS, TERMS, URLS
from .judgments import DATES
from .names import COURT_ROWS, RAW, SMALL_BUILTIN, TITLES, _resolve_sql
from .validity import EXPIRIES, NOW


class Derived:
    """A given table in other columns: as a DataFrame and as SQL."""

    def __init__(self, source: str, where: str = "true", **columns: str) -> None:
        self.source, self.where, self.columns = source, where, columns

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, self.source).where(self.where).selectExpr(*(f"{e} AS {c}" for c, e in self.columns.items()))

    @property
    def sql(self) -> str:
        return f"(SELECT {', '.join(f'{e} AS {c}' for c, e in self.columns.items())} FROM {self.source} WHERE {self.where})"


def exchanged(name: str, *pairs: tuple) -> str:
    """The SQL of a query with other tables."""
    sql = ORACLE_SQL[name]
    for old, new in pairs:
        assert old.sql in sql, (name, old.sql[:60])
        sql = sql.replace(old.sql, new.sql)
    return sql


def pick(number: str, *values: str) -> str:
    """One of the values (SQL expressions) by number modulo their number."""
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values))
    return f"CASE {number} % {len(values)} {cases} END"


TEXT = "CAST({} AS STRING)".format
ORDER, YEAR = TEXT("o_orderkey"), TEXT("year(o_orderdate) - 1911")

# ------------------------------------------------------------ identifiers

REFS = Derived("orders", ordinal="o_orderkey", raw=pick(
    "o_orderkey", f"'釋字第 ' || {ORDER} || ' 號'", f"'釋字' || {ORDER}", f"{YEAR} || '年憲判字第' || {ORDER} || '號'", "'憲判字第1號'", f"' ' || {ORDER} || ' '", f"'x' || {ORDER}", "''", f"{YEAR} || '年憲判'", f"'司法院釋字第' || {ORDER} || '號解釋'",
    f"{YEAR} || '憲判' || {ORDER}", "CAST(NULL AS STRING)"))


@query("parse_case_id", exchanged("parse_case_id", (CASE_REFS, REFS)))
def parse_case_id_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3."""
    return REFS.frame(spark, sf_dir).withColumn("r", parse_case_ref(F.col("raw"))).select("ordinal", "raw", "r.error", "r.system", "r.number", "r.year")


_DAY = "lpad(CAST(year(o_orderdate) AS STRING), 4, '0') || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')"
_CODE = pick("o_orderkey", "'TPS'", "'TPD'", "'KSY'", "'IPC'", "'XXX'", "'TPP'")
_JID = f"{_CODE} || {pick('o_custkey', chr(39) + 'V' + chr(39), chr(39) + 'M' + chr(39), chr(39) + 'A' + chr(39), chr(39) + 'P' + chr(39))} || ',' || {YEAR} || ',訴,' || {ORDER} || ',' || {_DAY} || ',1'"
CASES = Derived("orders", ordinal="o_orderkey", jid=f"CASE WHEN o_orderstatus <> 'P' THEN {_JID} WHEN o_custkey % 3 = 0 THEN '' WHEN o_custkey % 3 = 1 THEN 'TPSV,' || {ORDER} ELSE CAST(NULL AS STRING) END")


@query("jid_valid", exchanged("jid_valid", (JIDS, CASES)))
def jid_valid_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16."""
    return CASES.frame(spark, sf_dir).select("ordinal", "jid", valid_jid(F.col("jid")).alias("valid"))


GOOD_CASES = Derived("orders", "o_orderstatus <> 'P'", ordinal="o_orderkey", jid=_JID)


@query("jid_gate", f"SELECT 'all' AS orders, * FROM ({exchanged('jid_gate', (JIDS, CASES))}) UNION ALL SELECT 'shipped', * FROM ({exchanged('jid_gate', (JIDS, GOOD_CASES))})")
def jid_gate_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all rows of a result are well-formed."""
    one = lambda rows, name: all_valid(rows.frame(spark, sf_dir)).select(F.lit(name).alias("orders"), "n", "valid")
    return one(CASES, "all").unionByName(one(GOOD_CASES, "shipped"))


@query("longest_prefix_court", exchanged("longest_prefix_court", (JIDS, CASES)))
def court_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3, X23."""
    return with_court(CASES.frame(spark, sf_dir)).select("ordinal", "jid", "court", "court_level", "case_type")


_HOSTS = pick("o_orderkey", "'https://judgment.judicial.gov.tw'", "'http://data.judicial.gov.tw:8080'", "'HTTPS://user:pw@LAW.moj.gov.tw'", "'https://law.moj.gov.tw.evil.example'", "'https://evil.example/law.moj.gov.tw'", "'ftp://law.moj.gov.tw'", "'law.moj.gov.tw'")
ADDRESSES = Derived("orders", url=f"{_HOSTS} || {pick('o_custkey', chr(39) + '/FJUD/data.aspx?ty=JD&id=TPSV%2c' + chr(39) + ' || ' + ORDER, chr(39) + '/LawAll.aspx?pcode=B' + chr(39) + ' || ' + ORDER, chr(39) + '/x?PCode=C1&id=a+b%E5%8F%B0' + chr(39), chr(39) + chr(39))}")


@query("url_allowlist", exchanged("url_allowlist", (URLS, ADDRESSES)))
def url_allowlist_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17."""
    return ADDRESSES.frame(spark, sf_dir).select("url", url_allowed(F.col("url")).alias("allowed"))


@query("url_identifiers", exchanged("url_identifiers", (URLS, ADDRESSES)))
def url_identifiers_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X24."""
    url = F.col("url")
    pcode = F.coalesce(F.nullif(url_parameter(url, "pcode"), F.lit("")), url_parameter(url, "PCode"))
    return ADDRESSES.frame(spark, sf_dir).select("url", jid_from_url(url).alias("jid"), pcode.alias("pcode"))


_N = "(1 + p_partkey % 9999)"


def _numeral() -> str:
    """1 to 9,999 in Chinese numbers: with a zero in place of missing units, tens without a one below twenty."""
    digit = lambda unit: f"CAST(floor({_N} / {unit}) AS INT) % 10"
    sign = lambda unit: f"substr('零一二三四五六七八九', {digit(unit)} + 1, 1)"
    parts = []
    for unit, name, above in ((1000, "千", 10_000), (100, "百", 1000), (10, "十", 100), (1, "", 10)):
        own = f"CASE WHEN {_N} >= 10 AND {_N} < 20 THEN '' ELSE {sign(10)} END || '十'" if unit == 10 else f"{sign(unit)} || '{name}'"
        zero = f"{_N} >= {above} AND {_N} % {unit} > 0" if unit > 1 else "false"
        parts.append(f"CASE WHEN {digit(unit)} > 0 THEN {own} WHEN {zero} THEN '零' ELSE '' END")
    return " || ".join(parts)


COUNTED = Derived("part", numeral=_numeral(), value=f"CAST({_N} AS BIGINT)")


@query("cn_numeral", f"SELECT numeral, value FROM {COUNTED.sql}")
def cn_numeral_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers written out and read back."""
    return COUNTED.frame(spark, sf_dir).select("numeral", chinese_number(F.col("numeral")).alias("value"))


DOTTED = Derived("orders", raw=pick("o_orderkey", *(f"{YEAR} || '{a}' || {TEXT('month(o_orderdate)')} || '{b}' || {TEXT('day(o_orderdate)')}" for a, b in ("..", "//", "./", "--")), "''", f"{YEAR} || '.' || {ORDER}"))


@query("dotted_dates", exchanged("dotted_dates", (DATES, DOTTED)))
def dotted_dates_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X31."""
    return DOTTED.frame(spark, sf_dir).select("raw", dotted_date(F.col("raw")).alias("day"))


_JANUARY = "'2024-01-' || lpad(CAST(1 + event_id % 31 AS STRING), 2, '0')"
ENTRIES = Derived("events", k=TEXT("event_id"), expires_at=pick("event_id", _JANUARY, f"{_JANUARY} || ' 12:00:00'", f"{_JANUARY} || 'T00:00:00'", "'9999-12-31T23:59:59'", "'soon'", "CAST(NULL AS STRING)", "''"))


@query("ttl_parse", exchanged("ttl_parse", (EXPIRIES, ENTRIES)))
def ttl_parse_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """expiry times as texts."""
    return ENTRIES.frame(spark, sf_dir).select("k", is_valid(F.col("expires_at"), F.lit(NOW).cast("timestamp")).alias("valid"))


# ------------------------------------------------------------ names

PART = TEXT("p_partkey")
PART_LAWS = Derived("part", ordinal="p_partkey", law_name=f"p_name || ' ' || {PART}", pcode=f"'P' || {TEXT('p_size')}", abolished="p_size > 25")
PART_ALIASES = Derived("part", alias=f"'short' || {PART}", law_name=f"CASE WHEN p_size % 5 = 0 THEN 'no such law' ELSE p_name || ' ' || {PART} END")
ALIAS_TERMS = Derived("part", term=f"'short' || {PART}")


@query("alias_resolve", _resolve_sql(ALIAS_TERMS.sql, PART_LAWS.sql, PART_ALIASES.sql, SMALL_BUILTIN.sql))
def alias_resolve_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alias by the whole cascade."""
    return resolve_names(ALIAS_TERMS.frame(spark, sf_dir), PART_LAWS.frame(spark, sf_dir), PART_ALIASES.frame(spark, sf_dir), SMALL_BUILTIN.frame(spark))


PART_ARTICLES = Derived("part", pcode=f"'P' || {TEXT('p_size')}", number=PART, content="p_name")
SUPPLIER_HISTORIES = Derived("supplier", pcode=f"'P' || {TEXT('s_suppkey')}", history="s_name")


@query("history_attach", exchanged("history_attach", (ARTICLES, PART_ARTICLES), (HISTORIES, SUPPLIER_HISTORIES)))
def history_attach_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5."""
    return with_history(PART_ARTICLES.frame(spark, sf_dir), SUPPLIER_HISTORIES.frame(spark, sf_dir)).select("pcode", "number", "history")


SUPPLIER_CODES = Derived("supplier", pcode=f"'P' || {TEXT('s_suppkey')}", parsed_name=pick("s_suppkey", "''", "'條文內容'", "s_name"))


@query("reverse_lookup_cascade", exchanged("reverse_lookup_cascade", (CODES, SUPPLIER_CODES), (LAWS, PART_LAWS)))
def reverse_lookup_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the dictionary's last name of a code, else the name in its page."""
    return names_of_codes(SUPPLIER_CODES.frame(spark, sf_dir), PART_LAWS.frame(spark, sf_dir))


_ITEM = f"{TEXT('l_suppkey')} || {pick('l_linenumber', chr(39) + '-' + chr(39), chr(39) + '之' + chr(39))} || {TEXT('l_linenumber')}"
ITEM_ARTICLES = Derived("lineitem", pcode="CASE WHEN l_returnflag = 'A' THEN 'B0000001' ELSE l_returnflag END", number=f"CASE WHEN l_linenumber = 1 THEN {TEXT('l_suppkey')} WHEN l_linenumber = 7 THEN '附則' ELSE {_ITEM} END", content="l_linestatus")


@query("article_range", exchanged("article_range", (ARTICLES, ITEM_ARTICLES)))
def article_range_of_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11, X1 by the decimal key."""
    key = article_key(F.col("number"))
    return ITEM_ARTICLES.frame(spark, sf_dir).where("pcode = 'B0000001'").where(key.between(15.0, 247.1)).select("number", "content", key.alias("article_key"))


@query("article_range_ordered", exchanged("article_range_ordered", (ARTICLES, ITEM_ARTICLES)))
def article_range_ordered_of_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11, X1 by (major, minor)."""
    at = article_order(F.col("number"))
    rows = ITEM_ARTICLES.frame(spark, sf_dir).where("pcode = 'B0000001' AND NOT contains(number, '.')")
    return rows.where(at.between(article_order(F.lit("15-1")), article_order(F.lit("247-1")))).select("number", at["major"].alias("major"), at["minor"].alias("minor"))


CUSTOMER = TEXT("c_custkey")
SEGMENT_LAWS = Derived("customer", law_name="c_mktsegment || '法'")
NAMES_IN_TEXT = Derived("customer", raw=pick("c_custkey", f"'依' || {CUSTOMER} || c_mktsegment || '法'", f"'又上開' || {CUSTOMER} || c_mktsegment || '法'", f"'違反' || {CUSTOMER} || '條例'", f"{CUSTOMER} || '法'"))


@query("suffix_lookup", exchanged("suffix_lookup", (RAW, NAMES_IN_TEXT), (LAWS, SEGMENT_LAWS)))
def suffix_lookup_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as texts have them, by prefixes and known suffixes."""
    return clean_statute_names(NAMES_IN_TEXT.frame(spark, sf_dir), known_names(SEGMENT_LAWS.frame(spark, sf_dir)))


@query("known_names", exchanged("known_names", (LAWS, SEGMENT_LAWS)))
def known_names_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U5."""
    return known_names(SEGMENT_LAWS.frame(spark, sf_dir)).select("law_name", F.length("law_name").cast("bigint").alias("n"))


PAGE_TITLES = Derived("part", title=pick("p_partkey", "p_name || '-全國法規資料庫'", "'條文內容'", "'  ' || p_name || ' '", "''", f"'歷史法規-' || {PART}"))


@query("page_title_names", exchanged("page_title_names", (TITLES, PAGE_TITLES)))
def page_title_names_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X29."""
    return PAGE_TITLES.frame(spark, sf_dir).select("title", page_law_name(F.col("title")).alias("law_name"))


VARIANTS = Derived("supplier", court=f"{pick('s_suppkey', chr(39) + '臺灣臺' + chr(39), chr(39) + '台' + chr(39))} || s_name", code=TEXT("s_suppkey"))


@query("variant_fold", exchanged("variant_fold", (COURT_ROWS, VARIANTS)))
def variant_fold_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X26."""
    return VARIANTS.frame(spark, sf_dir).select("code", fold_variant(F.col("court")).alias("folded"))


#: Two feeds that share names and codes.
FEED_LAWS = Derived("part", ordinal="p_partkey", law_name="p_name || CASE WHEN p_size % 2 = 0 THEN '' ELSE ' x' END", pcode=f"'P' || {TEXT('p_partkey % 500')}", abolished="p_size = 50")
FEED_ORDERS = Derived("supplier", ordinal="s_suppkey", law_name=pick("s_suppkey", "s_name", "'red ring'", "'old gear x'"), pcode=f"'P' || {TEXT('s_suppkey * 7')}", abolished="s_nationkey = 3")


@query(
    "refresh_merge",
    f"""WITH b AS (SELECT 0 AS source, * FROM {FEED_LAWS.sql} UNION ALL SELECT 1, * FROM {FEED_ORDERS.sql}),
    r AS (SELECT *, row_number() OVER (PARTITION BY law_name ORDER BY source DESC, ordinal DESC) AS last, min((source, ordinal)) OVER (PARTITION BY law_name) AS first FROM b)
    SELECT law_name, pcode, pcode IN (SELECT pcode FROM b WHERE abolished) AS abolished FROM r WHERE last = 1""",
)
def refresh_merge_of_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal names the last of both feeds holds."""
    return merged(FEED_LAWS.frame(spark, sf_dir), FEED_ORDERS.frame(spark, sf_dir)).select("law_name", "pcode", "abolished")


# ------------------------------------------------------------ searches

_LEVEL = pick("o_orderkey", "1", "3", "2", "3", "99", "2")
RESULT_ROWS = Derived(
    "orders", arrival="o_orderkey", jid=f"CASE WHEN o_custkey % 11 = 0 THEN '' ELSE {_JID} END", court=pick("o_orderkey", "'最高法院'", "'臺灣臺北地方法院'", "'臺灣高等法院'"), court_level=_LEVEL, case_type=pick("o_custkey", "'民事'", "'刑事'", "'懲戒'", "'行政'"),
    year="CAST(year(o_orderdate) - 1911 AS INT)", word=pick("o_custkey", "'臺上'", "'台上'", "'訴'"), number=TEXT("o_orderkey % 20"), full_text="o_orderpriority || ' ' || o_orderstatus || ' 給付'", main_text=f"'被告應將' || o_orderpriority || {pick('o_orderkey', chr(39) + '移轉' + chr(39), chr(39) + chr(39))}",
)
_FOUND = f"SELECT jid, min(court_level) AS court_level, min(arrival) AS arrival FROM {RESULT_ROWS.sql} WHERE jid <> '' AND {{}} GROUP BY jid ORDER BY court_level, arrival, jid LIMIT 200"


@query("judgment_search_keyword", f"SELECT jid FROM ({_FOUND.format("year BETWEEN 85 AND 87 AND contains(full_text, 'URGENT') AND contains(full_text, '給付')")})")
def judgment_search_years_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of years and all words."""
    return search_judgments(RESULT_ROWS.frame(spark, sf_dir), keyword="URGENT 給付", year_from=85, year_to=87, max_results=200).select("jid")


@query("judgment_search_precise", f"SELECT jid FROM ({_FOUND.format("year = 86 AND number = '5' AND replace(word, '臺', '台') = '台上' AND case_type <> '懲戒'")})")
def judgment_search_precise_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year, folded words, the default types."""
    return search_judgments(RESULT_ROWS.frame(spark, sf_dir), case_word="臺上", case_number="5", year_from=86, year_to=89, max_results=200).select("jid")


@query("judgment_search_main_text", f"SELECT jid FROM ({_FOUND.format("contains(main_text, '被告應將2-HIGH') AND contains(main_text, '移轉')")})")
def judgment_search_main_text_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, F7 on the main text."""
    return search_judgments(RESULT_ROWS.frame(spark, sf_dir), main_text="被告應將2-HIGH 移轉", max_results=200).select("jid")


# ------------------------------------------------------------ saved pages


def _html(spark: SparkSession, sf_dir: str, source: str, key: str, html: str) -> DataFrame:
    return table(spark, sf_dir, source).selectExpr(f"{key} AS page_id", f"{html} AS html")


_ROW = f"""'<tr><td>' || {ORDER} || '.</td><td>' || CASE WHEN o_orderkey % 5 = 0 THEN 'no link' ELSE '<a href="data.aspx?ty=JD&amp;id=' || replace({_JID}, ',', '%2C') || '">' || {ORDER} || '號判決</a>' END || '</td><td>'
  || {YEAR} || '.' || {TEXT('month(o_orderdate)')} || '/' || {TEXT('day(o_orderdate)')} || '</td>' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '<td> ' || o_orderpriority || ' </td>' END || '</tr>'
  || CASE WHEN o_orderkey % 4 = 0 THEN '<tr class="summary"><td colspan="4"><span class="tdCut"> summary ' || {ORDER} || '</span></td></tr>' WHEN o_orderkey % 4 = 1 THEN '<tr><td>short</td></tr>' ELSE '' END"""


@query(
    "result_page",
    f"""SELECT o_custkey AS page_id, {ORDER} || '號判決' AS case_id, lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 2, '0') || strftime(o_orderdate, '-%m-%d') AS date, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS cause,
    CASE WHEN o_orderkey % 4 = 0 THEN 'summary ' || o_orderkey ELSE '' END AS summary, {_JID} AS jid FROM orders WHERE o_orderkey % 5 <> 0""",
)
def result_pages_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as a saved page of results, some without a link, a cause or a summary."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_custkey AS page_id", "o_orderkey", f"{_ROW} AS row")
    pages = rows.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "row"))), lambda r: r["row"]), "").alias("rows"))
    html = pages.select("page_id", F.concat(F.lit('<html><body><p>found</p><table class="jub-table"><tr><th>序號</th><th>x</th><th>y</th></tr>'), "rows", F.lit("</table></body></html>")).alias("html"))
    return result_list(html).select("page_id", "case_id", "date", "cause", "summary", "jid")


_LAW_ROW = f"""CASE WHEN p_size % 4 = 0 THEN '<div class="h3 char-' || {TEXT('1 + p_size % 3')} || '">第 ' || {PART} || ' 章 ' || p_name || '</div>' ELSE '' END
  || CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 7 = 1 THEN '<div class="row"><div class="col-no">無號</div><div class="col-data">x</div></div>' ELSE '<div class="row"><div class="col-no">第 ' || {PART} || '-1 條</div><div class="col-data">' || p_type || '</div></div>' END"""
_LAW_SQL = """WITH r AS (SELECT p_brand AS page_id, 2 * p_partkey AS place, 'heading' AS kind, '第' || p_partkey || '章' || replace(p_name, ' ', '') AS label, CAST(1 + p_size % 3 AS INTEGER) AS level, NULL AS content FROM part WHERE p_size % 4 = 0
  UNION ALL SELECT p_brand, 2 * p_partkey + 1, 'article', p_partkey || '-1', NULL, p_type FROM part WHERE p_size % 7 > 1),
a AS (SELECT *, first_value(CASE WHEN kind = 'article' THEN label END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM r)
SELECT page_id, kind, label, level, content, CASE WHEN kind = 'heading' THEN next END AS first_article FROM a UNION ALL SELECT DISTINCT p_brand, 'title', p_brand || '-全國法規資料庫', NULL, NULL, NULL FROM part"""


@query("statute_page", _LAW_SQL)
def statute_pages_of_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each brand as a law with headings of three levels, articles and rows without a number."""
    rows = table(spark, sf_dir, "part").selectExpr("p_brand AS page_id", "p_partkey", f"{_LAW_ROW} AS row")
    body = rows.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "row"))), lambda r: r["row"]), "").alias("body"))
    title = F.concat("page_id", F.lit("-全國法規資料庫"))
    html = body.select("page_id", F.concat(F.lit("<html><head><title>"), title, F.lit('</title></head><body><h2>'), title, F.lit('</h2><div class="law-reg-content">'), "body", F.lit("</div></body></html>")).alias("html"))
    found = attach_next(statute_pages(html), ["page_id"], ["position"], F.when(F.col("kind") == "article", F.col("label")), "first_article")
    return found.select("page_id", "kind", "label", "level", "content", F.when(F.col("kind") == "heading", F.col("first_article")).alias("first_article"))


_LONG = f"'第 ' || {CUSTOMER} || '-2 條 ' || c_name || ' 之規定，應依其性質辦理之。'"
_SINGLE = pick(
    "c_custkey", f"'<h2>a</h2><div class=\"law-article\">' || {_LONG} || '</div>'", f"'<div id=\"pnlContent\"><b>' || {_LONG} || '</b></div><pre>no</pre>'", f"'<p>短</p><div>' || {_LONG} || '</div><td>' || c_name || '</td>'", "'<p>短</p>'",
    f"'<pre>' || {_LONG} || '著作權聲明</pre>'", "'<div class=\"content-law\">' || c_name || '</div>'")


@query(
    "single_article_page",
    f"SELECT c_custkey AS page_id, CASE WHEN c_custkey % 6 < 3 THEN {_LONG} WHEN c_custkey % 6 = 5 THEN c_name ELSE '' END AS content, CASE WHEN c_custkey % 6 < 3 THEN c_custkey || '-2' ELSE '' END AS number FROM customer",
)
def single_articles_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known containers in their order, the longest block where there is none, footers and short blocks refused."""
    return single_articles(_html(spark, sf_dir, "customer", "c_custkey", _SINGLE)).select("page_id", "content", "number")


_FIELD = "'<ul><li class=\"title\">{0}</li><li class=\"text\">' || {1} || '</li></ul>'".format
_RULING = " || ".join([
    f"CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE {_FIELD('解釋字號', 's_name')} END", f"CASE WHEN s_suppkey % 3 = 0 THEN {_FIELD('解釋文', chr(39) + chr(39))} ELSE {_FIELD('解釋文', chr(39) + '<ul class=paragraphs><li><pre>one</pre></li><li><pre>' + chr(39) + ' || s_name || ' + chr(39) + '</pre></li></ul>' + chr(39))} END",
    f"CASE WHEN s_suppkey % 2 = 0 THEN {_FIELD('理由書', chr(39) + 'a<br>b' + chr(39))} ELSE '' END", _FIELD("解釋字號", "'again'"),
])


@query(
    "ruling_page_fields",
    """WITH f AS (SELECT s_suppkey AS page_id, CASE WHEN s_suppkey % 5 = 0 THEN 'again' ELSE s_name END AS name, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'one' || chr(10) || chr(10) || s_name END AS holding, s_suppkey % 2 = 0 AS reasons FROM supplier)
    SELECT page_id, name, holding, CASE WHEN reasons THEN 'a' || chr(10) || 'b' END AS reasons, CASE WHEN holding = '' THEN '解釋文' ELSE '' END AS missing, reasons AND holding <> '' AS complete FROM f""",
)
def ruling_pages_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of saved rulings, the first of equal titles, and what is missing."""
    rows = missing_fields(ruling_pages(_html(spark, sf_dir, "supplier", "s_suppkey", _RULING)), CRITICAL_FIELDS["釋字"], MIN_FIELDS)
    field = lambda title: F.col("fields")[title]
    return rows.select("page_id", field("解釋字號").alias("name"), field("解釋文").alias("holding"), field("理由書").alias("reasons"), F.array_join("missing", ",").alias("missing"), "complete")


@query(
    "ruling_page_sanity",
    """WITH f AS (SELECT s_suppkey AS page_id, s_suppkey % 3 = 0 AS empty, s_suppkey % 2 = 0 AS reasons FROM supplier)
    SELECT page_id, CASE WHEN empty THEN '解釋文' ELSE '' END AS missing, CASE WHEN reasons THEN '理由書,' ELSE '' END || '解釋字號,解釋文' AS found, reasons AND NOT empty AS complete FROM f""",
)
def ruling_page_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields a saved page has, and which of the necessary ones it lacks."""
    rows = missing_fields(ruling_pages(_html(spark, sf_dir, "supplier", "s_suppkey", _RULING)), CRITICAL_FIELDS["釋字"], MIN_FIELDS)
    return rows.select("page_id", F.array_join("missing", ",").alias("missing"), F.array_join("found", ",").alias("found"), "complete")


_BODY = f"repeat('內文', 20) || {CUSTOMER} || '<abbr>不確定</abbr><span>' || c_mktsegment || '</span>者'"
_LABELS = "'<div class=\"row\"><div class=\"col-th\">裁判案由：</div><div class=\"col-td\"> ' || c_mktsegment || ' </div></div>'"
_JUDGMENT = pick(
    "c_custkey", f"'<div id=\"jud\">' || {_LABELS} || '<div class=\"htmlcontent\">' || {_BODY} || '</div></div>'", f"'<div class=\"jud-content\"><div class=\"htmlcontent\">short</div><div class=\"text-pre\">' || {_BODY} || '</div></div>'",
    f"'<pre>' || {_BODY} || '</pre>'", f"'<html><body><div class=\"jud_content\">' || {_BODY} || '</div></body></html>'")


@query("judgment_page", f"SELECT c_custkey AS page_id, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END AS label_cause, repeat('內文', 20) || {CUSTOMER} || '不確定' || c_mktsegment || '者' AS raw_text FROM customer")
def judgment_pages_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and bodies in their order, inline terms kept in their line, labels beside the text."""
    return judgment_pages(_html(spark, sf_dir, "customer", "c_custkey", _JUDGMENT)).select("page_id", "label_cause", "raw_text")


# ------------------------------------------------------------ the engine's methods

#: The law in the middle of the dictionary, by its number of rows.
_MIDDLE = "(SELECT count(*) // 2 FROM part)"
ENGINE_ARTICLES = Derived("lineitem", pcode=f"'P' || {TEXT('l_partkey')}", number=f"{TEXT('l_linenumber')} || {pick('l_orderkey', chr(39) + chr(39), chr(39) + '-2' + chr(39), chr(39) + '之10' + chr(39))}", content=f"'Order ' || {TEXT('l_orderkey')}")
ENGINE_LAWS = Derived("part", ordinal="p_partkey", law_name=f"p_name || ' ' || {PART}", pcode=f"'P' || {PART}", abolished="p_size > 25")
ENGINE_HISTORIES = Derived("supplier", pcode=f"'P' || {TEXT('s_suppkey')}", history="s_name")


def _engine(spark: SparkSession, sf_dir: str) -> tuple[Engine, str]:
    """The engine on derived tables, and the middle law's name."""
    laws = ENGINE_LAWS.frame(spark, sf_dir)
    middle = table(spark, sf_dir, "part").count() // 2
    name = laws.where(F.col("ordinal") == middle).select("law_name").first()[0]
    return Engine(spark, laws, ENGINE_HISTORIES.frame(spark, sf_dir), ENGINE_ARTICLES.frame(spark, sf_dir), document_cases(spark, sf_dir), order_rulings(spark, sf_dir)), name


def document_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .judgments import document_judgments

    return document_judgments(spark, sf_dir).select("jid", "raw_text")


RULING_ROWS = Derived("orders", system=pick("o_orderkey", "'釋字'", "'憲判字'"), year=f"CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE CAST(year(o_orderdate) - 1911 AS BIGINT) END", number="o_orderkey", issues=f"CASE WHEN o_custkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE o_orderpriority END", reasoning=f"'reason ' || o_orderstatus || ' 釋字第 ' || {TEXT('o_custkey')} || ' 號及釋字第' || {TEXT('o_custkey % 7')} || '號' || repeat('婚姻自由受憲法保障。', 1 + CAST(o_custkey % 20 AS INT))", opinions="o_orderstatus")


def order_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RULING_ROWS.frame(spark, sf_dir)


_MAJOR = "CAST(regexp_extract(number, '^([0-9]+)', 1) AS INTEGER)"
_MINOR = "coalesce(try_cast(regexp_extract(number, '[-之]([0-9]+)$', 1) AS INTEGER), 0)"


@query(
    "api_query_regulation",
    f"""SELECT a.pcode, a.number, a.content, l.law_name, CASE WHEN l.abolished THEN '已廢止' ELSE '現行法規' END AS status, h.history FROM {ENGINE_ARTICLES.sql} a JOIN {ENGINE_LAWS.sql} l ON l.pcode = a.pcode LEFT JOIN {ENGINE_HISTORIES.sql} h ON h.pcode = a.pcode
    WHERE l.ordinal = {_MIDDLE} AND ({_MAJOR} > 1 OR {_MAJOR} = 1 AND {_MINOR} >= 2) AND ({_MAJOR} < 5 OR {_MAJOR} = 5 AND {_MINOR} <= 9)""",
)
def api_query_regulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A law by its name, with a range of articles, its status and history."""
    engine, name = _engine(spark, sf_dir)
    return engine.query_regulation(law_name=name, from_no="1-2", to_no="5-9", include_history=True).select("pcode", "number", "content", "law_name", "status", "history")


@query("api_resolve_law", f"SELECT law_name AS term, 0 AS tier, law_name, pcode, CASE WHEN abolished THEN '已廢止' ELSE '現行法規' END AS status, CAST(NULL AS VARCHAR) AS matched_from FROM {ENGINE_LAWS.sql} WHERE ordinal = {_MIDDLE}")
def api_resolve_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine, name = _engine(spark, sf_dir)
    return engine.resolve_law(name).select("term", "tier", "law_name", "pcode", "status", "matched_from")


@query("api_search_regulations", f"SELECT ordinal, law_name, pcode, abolished FROM {ENGINE_LAWS.sql} WHERE contains(law_name, 'gear') AND NOT abolished ORDER BY abolished, law_name, ordinal LIMIT 50 OFFSET 50")
def api_search_regulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a search of names that are in force."""
    return _engine(spark, sf_dir)[0].search_regulations("gear", 50, exclude_abolished=True).select("ordinal", "law_name", "pcode", "abolished")


@query("api_get_judgment", "SELECT 'TPDV,110,訴,' || doc_id || ',20210120,1' AS jid, '110年度訴字第' || doc_id || '號' AS case_id, '110-01-20' AS date, '給付價金' AS cause, '林甲' AS judges FROM documents WHERE doc_id = (SELECT 3 * (count(*) // 6) FROM documents)")
def api_get_judgment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judgment with its parts, by an address that has its identifier."""
    middle = 3 * (table(spark, sf_dir, "documents").count() // 6)
    url = f"https://judgment.judicial.gov.tw/FJUD/data.aspx?ty=JD&id=TPDV%2c110%2c%e8%a8%b4%2c{middle}%2c20210120%2c1"
    return _engine(spark, sf_dir)[0].get_judgment(url=url).select("jid", "case_id", "date", "cause", F.array_join("judges", ",").alias("judges"))


_CASE = "CASE WHEN system = '釋字' THEN '釋字第' || number || '號' ELSE year || '年憲判字第' || number || '號' END"


@query("api_search_rulings", f"SELECT system, {_CASE} AS case_id, year, number, coalesce(issues, '') AS issues FROM {RULING_ROWS.sql} WHERE contains(coalesce(issues, ''), 'HIGH') OR contains(reasoning, 'HIGH') ORDER BY CASE system WHEN '憲判字' THEN 0 ELSE 1 END, year DESC, number DESC LIMIT 100")
def api_search_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir)[0].search_rulings(100, keyword="HIGH")


@query("ruling_citations_one", f"SELECT DISTINCT 0 AS rank, 0::BIGINT AS year, n AS number, '釋字第' || n || '號' AS case_id FROM (SELECT unnest([o_custkey, o_custkey % 7]) AS n FROM orders WHERE o_orderkey = 2 * (SELECT count(*) // 4 FROM orders))")
def ruling_citations_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one ruling cites."""
    middle = 2 * (table(spark, sf_dir, "orders").count() // 4)
    return _engine(spark, sf_dir)[0].citations(f"釋字第{middle}號").select("rank", "year", "number", "case_id")


@query("api_get_ruling", f"SELECT system, year, number, issues, length(reasoning) AS reasoning_full_length, length(reasoning) < 50 AS reasoning_unavailable FROM {RULING_ROWS.sql} WHERE number = 2 * (SELECT count(*) // 4 FROM orders)")
def api_get_ruling(spark: SparkSession, sf_dir: str) -> DataFrame:
    middle = 2 * (table(spark, sf_dir, "orders").count() // 4)
    rows = _engine(spark, sf_dir)[0].get_ruling(f"釋字第 {middle} 號", include_reasoning=True)
    return rows.select("system", "year", "number", "issues", "reasoning_full_length", "reasoning_unavailable")


@query("ruling_default_layer", f"SELECT system, year, number, issues FROM {RULING_ROWS.sql} WHERE number = 2 * (SELECT count(*) // 4 FROM orders)")
def ruling_default_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """no long field unless it is asked for."""
    middle = 2 * (table(spark, sf_dir, "orders").count() // 4)
    return _engine(spark, sf_dir)[0].get_ruling(f"釋字{middle}").select("system", "year", "number", "issues")


_MATCHES = "len(string_split(reasoning, '婚姻自由')) - 1"


@query(
    "ruling_keyword_layer",
    f"""SELECT number, length(reasoning) < 50 AS reasoning_unavailable, CASE WHEN length(reasoning) >= 50 THEN {_MATCHES} END AS reasoning_match_count, CASE WHEN length(reasoning) >= 50 THEN least({_MATCHES}, 10) END AS shown
    FROM {RULING_ROWS.sql} WHERE system = '釋字' AND number = 2 * (SELECT count(*) // 4 FROM orders)""",
)
def ruling_keyword_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snippets of a keyword instead of the long field."""
    middle = 2 * (table(spark, sf_dir, "orders").count() // 4)
    rows = _engine(spark, sf_dir)[0].get_ruling(str(middle), reasoning_keyword="婚姻自由")
    return rows.select("number", "reasoning_unavailable", "reasoning_match_count", F.when(~F.col("reasoning_unavailable"), F.size("reasoning_matches")).cast("bigint").alias("shown"))


@query("issue_index", f"SELECT {_CASE} AS case_id, coalesce(issues, opinions, '') AS issues FROM {RULING_ROWS.sql}")
def issue_index_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issues of every ruling, or their summary."""
    from ..sources.files import issues

    return order_rulings(spark, sf_dir).select(format_case_ref(F.col("system"), F.col("year"), F.col("number")).alias("case_id"), issues(F.col("issues"), F.col("opinions")).alias("issues"))




TITLED = Derived("customer", term=pick("c_custkey", "c_mktsegment", f"'red ring ' || {TEXT('c_custkey')}", f"'the old gear ' || {TEXT('c_custkey')} || ' of'", "'ring'", "''", "c_name"))


@query("fuzzy_resolve", exchanged("fuzzy_resolve", (TERMS, TITLED), (LAWS, PART_LAWS)))
def fuzzy_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that hold names, that names hold, and that have none, with the library's aliases and built-in names."""
    return resolve_names(TITLED.frame(spark, sf_dir), PART_LAWS.frame(spark, sf_dir))


@query("case_id_format", exchanged("case_id_format", (RULINGS, RULING_ROWS)))
def case_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X28."""
    return order_rulings(spark, sf_dir).select("system", "year", "number", format_case_ref(F.col("system"), F.col("year"), F.col("number")).alias("case_id"))


@query("citations_edges", exchanged("citations_edges", (RULINGS, RULING_ROWS)))
def citations_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of all rulings."""
    return citation_edges(order_rulings(spark, sf_dir)).select("source", "case_id")


@query("citations_two_hops", exchanged("citations_two_hops", (RULINGS, RULING_ROWS)))
def citations_two_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = citation_edges(order_rulings(spark, sf_dir)).select("source", "case_id")
    second = edges.select(F.col("source").alias("case_id"), F.col("case_id").alias("target"))
    return edges.join(second, "case_id").where("target <> source").select("source", "target").distinct()


ASKED_COURTS = Derived("supplier", name=pick("s_suppkey", "'最高法院'", "s_name", "'臺灣高等法院'"))


@query("court_filter_passthrough", f"SELECT v.name, coalesce(c.code, v.name) AS code FROM {ASKED_COURTS.sql} v LEFT JOIN {COURT_ROWS.sql} c ON c.court = v.name")
def court_filter_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a court's code; unknown courts stay as they are."""
    joined = ASKED_COURTS.frame(spark, sf_dir).join(courts(spark).select(F.col("court").alias("name"), F.col("code")), "name", "left")
    return joined.select("name", F.coalesce("code", "name").alias("code"))


@query("citations_in_degree", exchanged("citations_in_degree", (RULINGS, RULING_ROWS)))
def citations_in_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citation_edges(order_rulings(spark, sf_dir)).groupBy("case_id").agg(F.count("*").alias("cited_by"))


UPDATED = Derived("events", update_date=pick("event_id", _JANUARY, "'2024/1/' || CAST(1 + event_id % 31 AS STRING) || ' 上午 12:00:00'", "'2024/1/' || CAST(1 + event_id % 31 AS STRING)", "''", "'bad'", "CAST(NULL AS STRING)"))


@query(
    "stale_formats",
    f"""SELECT update_date, coalesce(coalesce(try_cast(CASE WHEN contains(update_date, '-') THEN update_date END AS DATE), CAST(try_strptime(split_part(update_date, ' ', 1), '%Y/%-m/%-d') AS DATE)) < DATE '2024-01-20', true) AS stale FROM {UPDATED.sql}""",
)
def stale_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of an update in several forms, on the day after a Saturday."""
    return UPDATED.frame(spark, sf_dir).select("update_date", is_stale(F.col("update_date"), F.lit("2024-01-21 12:00:00").cast("timestamp")).alias("stale"))


# ------------------------------------------------------------ archives


@query("archived_pages", "SELECT CAST(page_id AS VARCHAR) || '.html' AS entry, CAST(octet_length(encode(html)) AS BIGINT) AS size, sha256(html) AS sha256 FROM pages")
def archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages written as ZIP archives and read back in parts."""
    archive.register(spark)
    path = shared_folder(spark, "archives")
    rows = table(spark, sf_dir, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("entry"), F.col("html").cast("binary").alias("content"))
    rows.repartition(4, "entry").write.format("archive").mode("overwrite").option("path", path).save()
    return spark.read.format("archive").option("path", path).option("part_bytes", 1 << 18).load().select("entry", "size", F.sha2("content", 256).alias("sha256"))
