"""Queries on names: dictionary lookups, resolution, status, name search and paging, courts, statute names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ABOLISHED, ALIASES, BUILTIN_LAWS, CASE_TYPES, COURT_LEVELS, COURTS, CURRENT, DEFAULT_LEVEL, INVALID_NAMES, NAME_PREFIXES, SHORT_NAMES
from ..functions.identifiers import article_key, article_order, fold_variant
from ..operators.resolve import abolished_codes, clean_statute_names, known_names, names_of_codes, page_law_name, resolve_names, suggestions, with_court, with_history, with_status, without_abolished
from ..operators.search import page, page_counts, search_names
from .base import Fixture, query, table
from .fixtures import ARTICLES, CODES, HISTORIES, JIDS, LAWS, TERMS

KEYWORD = "ring"
ALIAS_ROWS, BUILTIN_ROWS = Fixture("alias string, law_name string", list(ALIASES.items())), Fixture("law_name string, pcode string", list(BUILTIN_LAWS.items()))
COURT_ROWS = Fixture("court string, code string, level int", [(n, c, COURT_LEVELS.get(c, DEFAULT_LEVEL)) for n, c in COURTS.items()])
TYPE_ROWS = Fixture("case_type string, letter string", list(CASE_TYPES.items()))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as a dictionary: its order is p_partkey, large sizes count as abolished."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ordinal"), F.col("p_name").alias("law_name"), F.col("p_brand").alias("pcode"), (F.col("p_size") > 25).alias("abolished"))


PART_SQL = "(SELECT p_partkey AS ordinal, p_name AS law_name, p_brand AS pcode, p_size > 25 AS abolished FROM part)"


def _page(offset: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = search_names(parts(spark, sf_dir), KEYWORD)
        rows = page(found, [F.col("abolished"), F.col("law_name"), F.col("ordinal")], offset)
        return rows.select("ordinal", "law_name", "pcode", F.when(F.col("abolished"), ABOLISHED).otherwise(CURRENT).alias("status"))

    return run


for _number in (1, 2):
    query(
        f"name_search_page{_number}",
        f"SELECT ordinal, law_name, pcode, CASE WHEN abolished THEN '{ABOLISHED}' ELSE '{CURRENT}' END AS status FROM {PART_SQL} WHERE contains(law_name, '{KEYWORD}') ORDER BY abolished, law_name, ordinal LIMIT 50 OFFSET {50 * (_number - 1)}",
    )(_page(50 * (_number - 1)))


@query("name_search_counts", f"SELECT count(*) AS total, count(*) > 50 AS has_more FROM {PART_SQL} WHERE contains(law_name, '{KEYWORD}')")
def name_search_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_counts(search_names(parts(spark, sf_dir), KEYWORD))


@query("name_search_current_only", f"SELECT ordinal, law_name FROM {PART_SQL} WHERE contains(law_name, '{KEYWORD}') AND NOT abolished ORDER BY law_name, ordinal LIMIT 50")
def name_search_current_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page(search_names(parts(spark, sf_dir), KEYWORD, exclude_abolished=True), [F.col("law_name"), F.col("ordinal")]).select("ordinal", "law_name")


@query("exact_lookup", "SELECT p_partkey AS ordinal, p_brand AS pcode FROM part WHERE p_name = 'red ring'")
def exact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).where(F.col("law_name") == "red ring").select("ordinal", "pcode")


@query(
    "reverse_lookup_cascade",
    f"""SELECT c.pcode, coalesce(d.law_name, b.law_name, CASE WHEN c.parsed_name NOT IN ({', '.join(f"'{n}'" for n in INVALID_NAMES)}) THEN c.parsed_name END, '') AS law_name
    FROM {CODES.sql} c LEFT JOIN (SELECT pcode, arg_max(law_name, ordinal) AS law_name FROM {LAWS.sql} GROUP BY pcode) d ON d.pcode = c.pcode
    LEFT JOIN (SELECT pcode, min(law_name) AS law_name FROM {BUILTIN_ROWS.sql} GROUP BY pcode) b ON b.pcode = c.pcode""",
)
def reverse_lookup_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names_of_codes(CODES.frame(spark), LAWS.frame(spark))


@query("reverse_lookup_last_wins", f"SELECT pcode, arg_max(law_name, ordinal) AS law_name FROM {PART_SQL} GROUP BY pcode")
def reverse_lookup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    laws = parts(spark, sf_dir)
    return names_of_codes(laws.select("pcode").distinct().withColumn("parsed_name", F.lit("")), laws)


@query(
    "status_flag",
    f"SELECT c_custkey AS pcode, c_name AS name, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN '{ABOLISHED}' ELSE '{CURRENT}' END AS status FROM customer",
)
def status_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership in a set decides the status; unknown codes are current."""
    gone = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("pcode"))
    return with_status(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pcode"), F.col("c_name").alias("name")), gone)


@query("exclude_abolished", "SELECT c_custkey AS pcode, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def exclude_abolished(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("pcode"))
    return without_abolished(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pcode"), F.col("c_name").alias("name")), gone)


def _resolve_sql(terms: str, laws: str, alias: str, builtin: str) -> str:
    return f"""
WITH q AS (SELECT DISTINCT term FROM {terms} WHERE length(term) > 0), d AS (SELECT ordinal, law_name, pcode FROM {laws}),
found AS (
  SELECT term, 0 AS tier, 0 AS size, ordinal, law_name, pcode FROM q JOIN d ON law_name = term
  UNION ALL SELECT q.term, 1, 0, d.ordinal, d.law_name, d.pcode FROM q JOIN {alias} a ON a.alias = q.term JOIN d ON d.law_name = a.law_name
  UNION ALL SELECT q.term, 2, 0, 0, b.law_name, b.pcode FROM q JOIN {builtin} b ON b.law_name = q.term
  UNION ALL SELECT term, 3, -length(law_name), ordinal, law_name, pcode FROM q JOIN d ON contains(term, law_name)
  UNION ALL SELECT term, 4, length(law_name), ordinal, law_name, pcode FROM q JOIN d ON contains(law_name, term)),
best AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY tier, size, ordinal) AS place FROM found)
SELECT q.term, CAST(b.tier AS INTEGER) AS tier, b.law_name, b.pcode FROM q LEFT JOIN best b ON b.term = q.term AND b.place = 1"""


@query("alias_resolve", f"SELECT a.alias, a.law_name, d.pcode FROM {ALIAS_ROWS.sql} a LEFT JOIN {LAWS.sql} d ON d.law_name = a.law_name")
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ALIAS_ROWS.frame(spark).join(LAWS.frame(spark).select("law_name", "pcode"), "law_name", "left").select("alias", "law_name", "pcode")


@query("fuzzy_resolve", _resolve_sql(TERMS.sql, LAWS.sql, ALIAS_ROWS.sql, BUILTIN_ROWS.sql))
def fuzzy_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_names(TERMS.frame(spark), LAWS.frame(spark))


NAME_PARTS = "(SELECT min(p_partkey) AS ordinal, p_name AS law_name, min(p_brand) AS pcode FROM part GROUP BY p_name)"
SMALL_ALIASES = Fixture("alias string, law_name string", [("rg", "red ring"), ("gone", "no such part")])
SMALL_BUILTIN = Fixture("law_name string, pcode string", [("spare part", "Brand#0")])
PART_TERMS = "(SELECT DISTINCT p_name || ' mk2' AS term FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 1) FROM part UNION SELECT DISTINCT p_name FROM part UNION SELECT unnest(['rg', 'gone', 'spare part', '']))"


@query("fuzzy_resolve_parts", _resolve_sql(PART_TERMS, NAME_PARTS, SMALL_ALIASES.sql, SMALL_BUILTIN.sql))
def fuzzy_resolve_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    laws = p.groupBy(F.col("p_name").alias("law_name")).agg(F.min("p_partkey").alias("ordinal"), F.min("p_brand").alias("pcode"))
    some = spark.createDataFrame([("rg",), ("gone",), ("spare part",), ("",)], "term string")
    terms = p.select(F.concat("p_name", F.lit(" mk2")).alias("term")).union(p.select(F.split_part("p_name", F.lit(" "), F.lit(1)))).union(p.select("p_name")).union(some)
    return resolve_names(terms, laws, SMALL_ALIASES.frame(spark), SMALL_BUILTIN.frame(spark))


@query("suggestions_top10", f"SELECT ordinal, law_name, pcode FROM {PART_SQL} WHERE contains(law_name, 'gear') ORDER BY ordinal LIMIT 10")
def suggestions_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suggestions(parts(spark, sf_dir), "gear")


@query("history_attach", f"SELECT a.pcode, a.number, h.history FROM {ARTICLES.sql} a LEFT JOIN {HISTORIES.sql} h ON h.pcode = a.pcode")
def history_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_history(ARTICLES.frame(spark), HISTORIES.frame(spark)).select("pcode", "number", "history")


_ART = "string_split(replace(number, '之', '-'), '-')"
_KEY = f"coalesce(try_cast({_ART}[1] AS DOUBLE) + CASE WHEN len({_ART}) > 1 THEN try_cast({_ART}[2] AS DOUBLE) / 10 ELSE 0 END, 0)"


@query("article_range", f"SELECT number, content, {_KEY} AS article_key FROM {ARTICLES.sql} WHERE pcode = 'B0000001' AND {_KEY} BETWEEN 15 AND 247.1")
def article_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range by the decimal key, in which 15-10 is 16."""
    key = article_key(F.col("number"))
    return ARTICLES.frame(spark).where("pcode = 'B0000001'").where(key.between(15.0, 247.1)).select("number", "content", key.alias("article_key"))


@query(
    "article_range_ordered",
    f"""SELECT number, major, minor FROM (SELECT number, coalesce(try_cast({_ART}[1] AS INTEGER), 0) AS major, coalesce(try_cast({_ART}[2] AS INTEGER), 0) AS minor FROM {ARTICLES.sql} WHERE pcode = 'B0000001' AND NOT contains(number, '.'))
    WHERE (major > 15 OR major = 15 AND minor >= 1) AND (major < 247 OR major = 247 AND minor <= 1)""",
)
def article_range_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range by (major, minor), in which 15-10 is before 16."""
    at = article_order(F.col("number"))
    rows = ARTICLES.frame(spark).where("pcode = 'B0000001' AND NOT contains(number, '.')")
    return rows.where(at.between(article_order(F.lit("15-1")), article_order(F.lit("247-1")))).select("number", at["major"].alias("major"), at["minor"].alias("minor"))


@query(
    "longest_prefix_court",
    f"""WITH j AS (SELECT ordinal, jid, split_part(coalesce(jid, ''), ',', 1) AS head FROM {JIDS.sql}),
    c AS (SELECT ordinal, court, code, level, row_number() OVER (PARTITION BY ordinal ORDER BY length(code) DESC) AS place, substr(head, length(code) + 1) AS rest FROM j JOIN {COURT_ROWS.sql} t ON starts_with(head, code))
    SELECT j.ordinal, j.jid, coalesce(c.court, '') AS court, coalesce(c.level, 0) AS court_level, coalesce(t.case_type, '') AS case_type
    FROM j LEFT JOIN c ON c.ordinal = j.ordinal AND c.place = 1 LEFT JOIN {TYPE_ROWS.sql} t ON t.letter = c.rest""",
)
def longest_prefix_court(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_court(JIDS.frame(spark)).select("ordinal", "jid", "court", "court_level", "case_type")


RAW = Fixture("raw string", [(n,) for n in ["依民法", "按刑法", "違反洗錢防制法", "適用民事訴訟法", "消費者保護法", "本件應依全民健康保險法", "及其施行細則辦法", "依法", "勞基法", "又上開民法", "依據公司法", "另依證券交易法"]])


@query(
    "suffix_lookup",
    f"""WITH known AS (SELECT law_name FROM {LAWS.sql} UNION SELECT unnest([{', '.join(f"'{n}'" for n in SHORT_NAMES)}])),
    p AS (SELECT unnest([{', '.join(f"'{n}'" for n in NAME_PREFIXES)}]) AS prefix, generate_subscripts([{', '.join(f"'{n}'" for n in NAME_PREFIXES)}], 1) AS i),
    cut AS (SELECT raw, arg_min(prefix, i) AS prefix FROM {RAW.sql} r JOIN p ON starts_with(raw, prefix) AND length(raw) > length(prefix) + 1 GROUP BY raw),
    n AS (SELECT r.raw, substr(r.raw, 1 + coalesce(length(c.prefix), 0)) AS name FROM {RAW.sql} r LEFT JOIN cut c ON c.raw = r.raw),
    e AS (SELECT raw, arg_max(law_name, length(law_name)) AS suffix FROM n JOIN known ON ends_with(name, law_name) AND (length(law_name) >= 2 OR law_name = name) GROUP BY raw)
    SELECT n.raw, CASE WHEN n.raw IN (SELECT law_name FROM known) THEN n.raw ELSE coalesce(e.suffix, n.name) END AS law_name FROM n LEFT JOIN e ON e.raw = n.raw""",
)
def suffix_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_statute_names(RAW.frame(spark), known_names(LAWS.frame(spark)))


@query("known_names", f"SELECT law_name, length(law_name) AS n FROM (SELECT law_name FROM {LAWS.sql} UNION SELECT unnest([{', '.join(f"'{n}'" for n in SHORT_NAMES)}]))")
def known_names_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_names(LAWS.frame(spark)).select("law_name", F.length("law_name").cast("bigint").alias("n"))


TITLES = Fixture("title string", [("民法-全國法規資料庫",), ("條文內容",), ("全國法規資料庫-首頁",), (" 公司法 ",), ("",)])


@query("page_title_names", f"SELECT title, CASE WHEN n IN ({', '.join(f"'{x}'" for x in INVALID_NAMES)}) THEN '' ELSE n END AS law_name FROM (SELECT title, trim(split_part(title, '-', 1)) AS n FROM {TITLES.sql})")
def page_title_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TITLES.frame(spark).select("title", page_law_name(F.col("title")).alias("law_name"))


@query("abolished_codes", f"SELECT DISTINCT pcode FROM {PART_SQL} WHERE abolished")
def abolished_codes_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abolished_codes(parts(spark, sf_dir))


@query("longest_name", "SELECT max(length(p_name)) AS n FROM part")
def longest_name_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).agg(F.max(F.length("law_name")).cast("bigint").alias("n"))


@query("variant_fold", f"SELECT code, replace(court, '臺', '台') AS folded FROM {COURT_ROWS.sql}")
def variant_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return COURT_ROWS.frame(spark).select("code", fold_variant(F.col("court")).alias("folded"))


@query("court_filter_passthrough", f"SELECT v.name, coalesce(c.code, v.name) AS code FROM (VALUES ('最高法院'), ('unknown'), ('臺灣高等法院')) v(name) LEFT JOIN {COURT_ROWS.sql} c ON c.court = v.name")
def court_filter_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A court's code; unknown courts stay as they are."""
    asked = spark.createDataFrame([("最高法院",), ("unknown",), ("臺灣高等法院",)], "name string")
    joined = asked.join(COURT_ROWS.frame(spark).select(F.col("court").alias("name"), "code"), "name", "left")
    return joined.select("name", F.coalesce("code", "name").alias("code"))
