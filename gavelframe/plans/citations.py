"""Queries on citations and rulings: references, edges, contexts, search, statutes, numerals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CRITICAL_FIELDS, MIN_FIELDS
from ..functions.identifiers import NEW_CITATION, OLD_CITATION, chinese_number, contexts, format_case_ref, parse_case_ref
from ..functions.sections import cited_statutes, normalized_article
from ..operators.api import Engine, citation_edges
from ..operators.resolve import known_names
from ..operators.search import available_years, listed_rulings, search_rulings, truncated
from ..sources.files import issues
from ..sources.html import missing_fields, new_listing, old_listing, ruling_pages
from .base import Fixture, query, table
from .fixtures import CASE_REFS, LAWS, NUMERALS, PAGES, RULINGS, STATUTE_TEXTS

_REF_SQL = rf"""SELECT ordinal, raw, s, contains(s, '憲判') AS is_new, contains(s, '釋字') OR contains(s, '解釋') AS is_old,
  try_cast(coalesce(nullif(regexp_extract(s, '([0-9]+)\s*年', 1), ''), nullif(regexp_extract(s, '^\s*([0-9]+)\s*憲判', 1), '')) AS BIGINT) AS y,
  try_cast(nullif(regexp_extract(s, '憲判[^0-9]*([0-9]+)', 1), '') AS BIGINT) AS new_no, try_cast(nullif(regexp_extract(s, '(?:釋字|解釋)[^0-9]*([0-9]+)', 1), '') AS BIGINT) AS old_no,
  try_cast(nullif(regexp_extract(s, '^\s*([0-9]+)\s*$', 1), '') AS BIGINT) AS plain FROM (SELECT *, trim(coalesce(raw, '')) AS s FROM {CASE_REFS.sql})"""


@query(
    "parse_case_id",
    f"""WITH r AS ({_REF_SQL}), e AS (SELECT *, CASE WHEN s = '' THEN 'empty' WHEN is_new AND y IS NULL THEN 'year_missing' WHEN is_new AND new_no IS NULL THEN 'number_missing'
      WHEN NOT is_new AND is_old AND old_no IS NULL THEN 'number_missing' WHEN NOT is_new AND NOT is_old AND plain IS NULL THEN 'unparsable' END AS error FROM r)
    SELECT ordinal, raw, error, CASE WHEN error IS NULL THEN CASE WHEN is_new THEN '憲判字' ELSE '釋字' END END AS system,
      CASE WHEN error IS NULL THEN CASE WHEN is_new THEN new_no WHEN is_old THEN old_no ELSE plain END END AS number, CASE WHEN error IS NULL THEN CASE WHEN is_new THEN y ELSE 0 END END AS year FROM e""",
)
def parse_case_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CASE_REFS.frame(spark).withColumn("r", parse_case_ref(F.col("raw"))).select("ordinal", "raw", "r.error", "r.system", "r.number", "r.year")


_TITLE = "CASE WHEN system = '釋字' THEN '釋字第' || number || '號' ELSE year || '年憲判字第' || number || '號' END"


@query("case_id_format", f"SELECT system, year, number, {_TITLE} AS case_id FROM {RULINGS.sql}")
def case_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RULINGS.frame(spark).select("system", "year", "number", format_case_ref(F.col("system"), F.col("year"), F.col("number")).alias("case_id"))


_EDGES = rf"""SELECT DISTINCT {_TITLE} AS source, '釋字第' || CAST(n AS BIGINT) || '號' AS case_id FROM (SELECT *, unnest(regexp_extract_all(reasoning, '釋字第\s*([0-9]+)\s*號', 1)) AS n FROM (SELECT system, year, number, replace(coalesce(reasoning, ''), '１', '1') AS reasoning FROM {RULINGS.sql}))
UNION SELECT DISTINCT {_TITLE}, CAST(regexp_extract(m, '^([0-9]+)', 1) AS BIGINT) || '年憲判字第' || CAST(regexp_extract(m, '第\s*([0-9]+)', 1) AS BIGINT) || '號' FROM (SELECT *, unnest(regexp_extract_all(coalesce(reasoning, ''), '[0-9]{{3,4}}\s*年\s*憲判字第\s*[0-9]+\s*號')) AS m FROM {RULINGS.sql})"""


@query("citations_edges", _EDGES)
def citations_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citation_edges(RULINGS.frame(spark)).select("source", "case_id")


@query("citations_in_degree", f"SELECT case_id, count(*) AS cited_by FROM ({_EDGES}) GROUP BY case_id")
def citations_in_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citation_edges(RULINGS.frame(spark)).groupBy("case_id").agg(F.count("*").alias("cited_by"))


@query(
    "citations_context",
    r"""WITH w AS (SELECT doc_id, text, string_split_regex(text, '[0-9]+ ') AS g, regexp_extract_all(text, '[0-9]+ ') AS m FROM documents WHERE regexp_matches(text, '[0-9]+ ')),
    i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM w),
    p AS (SELECT doc_id, text, m[i] AS match, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS position FROM i),
    b AS (SELECT *, greatest(position - 80, 0) AS s, least(position + length(match) + 80, length(text)) AS e FROM p)
    SELECT doc_id, position, match, (CASE WHEN s > 0 THEN '...' ELSE '' END) || substr(text, s + 1, e - s) || (CASE WHEN e < length(text) THEN '...' ELSE '' END) AS context FROM b""",
)
def citations_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match of a pattern of varying length, with 80 characters on both sides."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike("[0-9]+ "))
    return docs.select("doc_id", F.explode(contexts(F.col("text"), "[0-9]+ ")).alias("c")).select("doc_id", "c.position", "c.match", "c.context")


def _contexts_sql(pattern: str) -> str:
    return rf"""SELECT system, year, number, position, match, (CASE WHEN s > 0 THEN '...' ELSE '' END) || substr(reasoning, s + 1, e - s) || (CASE WHEN e < length(reasoning) THEN '...' ELSE '' END) AS context
    FROM (SELECT *, greatest(position - 80, 0) AS s, least(position + length(match) + 80, length(reasoning)) AS e
      FROM (SELECT *, m[i] AS match, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS position
        FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT *, string_split_regex(reasoning, '{pattern}') AS g, regexp_extract_all(reasoning, '{pattern}') AS m FROM {RULINGS.sql}))))"""


@query("citations_context_rulings", _contexts_sql(r"釋字第\s*[0-9０-９]+\s*號") + " UNION ALL " + _contexts_sql(r"[0-9０-９]{3,4}\s*年\s*憲判字第\s*[0-9０-９]+\s*號"))
def citations_context_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("reasoning")
    return RULINGS.frame(spark).select("system", "year", "number", F.explode(F.concat(contexts(text, OLD_CITATION), contexts(text, NEW_CITATION))).alias("c")).select("system", "year", "number", "c.*")


@query("ruling_citations_one", "SELECT * FROM (VALUES ('釋字第242號'), ('釋字第499號'), ('111年憲判字第1號')) v(case_id)")
def ruling_citations_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Engine(spark, rulings=RULINGS.frame(spark)).citations("釋字第748號").select("case_id")


@query("cn_numeral", f"SELECT numeral, value FROM {NUMERALS.sql}")
def cn_numeral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NUMERALS.frame(spark).select("numeral", chinese_number(F.col("numeral")).alias("value"))


STATUTES = Fixture("doc_id bigint, entry string", [
    (0, "民法第377條"), (1, "勞動基準法第18-1條"), (2, "民法第247-1條"), (2, "民法第247之1條"), (4, "刑法第339條"), (4, "洗錢防制法第14條"), (5, "民事訴訟法第255條"), (5, "民法第184條"), (8, "消費者保護法第7條"),
])


@query("cited_statutes", f"SELECT doc_id, entry FROM {STATUTES.sql}")
def cited_statutes_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cited_statutes(STATUTE_TEXTS.frame(spark), known_names(LAWS.frame(spark))).select("doc_id", "entry")


@query("cited_statutes_normalized", f"SELECT DISTINCT doc_id, replace(entry, '之', '-') AS entry FROM {STATUTES.sql}")
def cited_statutes_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """247之1 and 247-1 as one article."""
    found = cited_statutes(STATUTE_TEXTS.frame(spark), known_names(LAWS.frame(spark)))
    return found.select("doc_id", F.concat(F.col("law_name"), F.lit("第"), normalized_article(F.col("article")), F.lit("條")).alias("entry")).distinct()


def _rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents and labels as rulings of two systems: labelled ones are new."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels.select("doc_id", "quality"), "doc_id", "left")
    new = F.col("quality").isNotNull()
    return joined.select(F.when(new, "憲判字").otherwise("釋字").alias("system"), F.when(new, 110 + F.col("quality")).otherwise(0).cast("bigint").alias("year"), F.col("doc_id").alias("number"), F.col("source").alias("issues"), F.col("text").alias("reasoning"))


_RULINGS = "(SELECT CASE WHEN l.doc_id IS NULL THEN '釋字' ELSE '憲判字' END AS system, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 110 + l.quality END AS year, d.doc_id AS number, d.source AS issues, d.text AS reasoning FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
_MATCH = f"(contains({_TITLE}, '11') OR CAST(number AS VARCHAR) = '11' OR (system = '憲判字' AND CAST(year AS VARCHAR) = '11') OR contains(issues, '11') OR contains(reasoning, '11'))"


@query("ruling_search", f"SELECT system, {_TITLE} AS case_id, CAST(year AS BIGINT) AS year, number, issues FROM {_RULINGS} WHERE {_MATCH} ORDER BY CASE WHEN system = '憲判字' THEN 0 ELSE 1 END, year DESC, number DESC LIMIT 30")
def ruling_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_rulings(_rulings(spark, sf_dir), "11").limit(30)


@query("ruling_number_range", f"SELECT system, {_TITLE} AS case_id, CAST(year AS BIGINT) AS year, number, issues FROM (SELECT o_orderkey, '釋字' AS system, 0 AS year, CAST(o_custkey AS BIGINT) AS number, o_orderpriority AS issues FROM orders) WHERE number BETWEEN 5 AND 40")
def ruling_number_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of numbers as the feature, on a column that many rows share."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.lit("釋字").alias("system"), F.lit(0).cast("bigint").alias("year"), F.col("o_custkey").cast("bigint").alias("number"), F.col("o_orderpriority").alias("issues"), F.lit(None).cast("string").alias("reasoning"))
    return search_rulings(rows, number_from=5, number_to=40)


_CITING = "(SELECT doc_id, text || ' 依釋字第 ' || (doc_id % 800 + 1) || ' 號及' || (110 + doc_id % 3) || '年憲判字第' || (doc_id % 20 + 1) || '號，違反民法第' || (doc_id % 1200 + 1) || '條及依勞動基準法第十八條之一。' AS text FROM documents)"


def _citing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as reasonings, each with citations at its end."""
    n = F.col("doc_id")
    parts = [F.col("text"), F.lit(" 依釋字第 "), n % 800 + 1, F.lit(" 號及"), 110 + n % 3, F.lit("年憲判字第"), n % 20 + 1, F.lit("號，違反民法第"), n % 1200 + 1, F.lit("條及依勞動基準法第十八條之一。")]
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(*[p.cast("string") for p in parts]).alias("text"))


_CITED = "SELECT '釋字第' || (doc_id % 800 + 1) || '號' AS case_id, doc_id FROM documents UNION ALL SELECT (110 + doc_id % 3) || '年憲判字第' || (doc_id % 20 + 1) || '號', doc_id FROM documents"


@query("citations_of_documents", f"SELECT doc_id, case_id FROM ({_CITED})")
def citations_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _citing(spark, sf_dir).select(F.lit("釋字").alias("system"), F.lit(0).alias("year"), F.col("doc_id").alias("number"), F.col("text").alias("reasoning"))
    return citation_edges(rows).select(F.regexp_extract("source", r"(\d+)", 1).cast("bigint").alias("doc_id"), "case_id")


@query("citations_in_degree_documents", f"SELECT case_id, count(*) AS cited_by FROM ({_CITED}) GROUP BY case_id")
def citations_in_degree_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations_of_documents(spark, sf_dir).groupBy("case_id").agg(F.count("*").alias("cited_by"))


@query("citation_context_of_documents", r"""SELECT doc_id, position, '釋字第 ' || (doc_id % 800 + 1) || ' 號' AS match, CASE WHEN position > 80 THEN '...' ELSE '' END || substr(text, greatest(position - 80, 0) + 1, least(position, 80) + length('釋字第 ' || (doc_id % 800 + 1) || ' 號') + 80)
  || CASE WHEN position + length('釋字第 ' || (doc_id % 800 + 1) || ' 號') + 80 < length(text) THEN '...' ELSE '' END AS context FROM (SELECT doc_id, text, CAST(strpos(text, '釋字第') - 1 AS BIGINT) AS position FROM """ + _CITING + ")")
def citation_context_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _citing(spark, sf_dir).select("doc_id", F.explode(contexts(F.col("text"), OLD_CITATION)).alias("c")).select("doc_id", "c.position", "c.match", "c.context")


@query("cited_statutes_of_documents", "SELECT doc_id, '民法第' || (doc_id % 1200 + 1) || '條' AS entry FROM documents UNION ALL SELECT doc_id, '勞動基準法第18-1條' FROM documents")
def cited_statutes_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cited_statutes(_citing(spark, sf_dir), known_names(LAWS.frame(spark))).select("doc_id", "entry")


@query("listed_rulings", "SELECT s.s_suppkey AS number, s.s_name AS issues, c.c_name AS reasoning FROM (SELECT DISTINCT l_suppkey FROM lineitem) l JOIN supplier s ON s.s_suppkey = l.l_suppkey LEFT JOIN customer c ON c.c_custkey = s.s_suppkey AND c.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')")
def listed_rulings_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with issues, and reasoning where the ruling is known."""
    ref = lambda column: [F.lit("釋字").alias("system"), F.lit(0).alias("year"), F.col(column).alias("number")]
    listing = table(spark, sf_dir, "lineitem").select(*ref("l_suppkey")).distinct()
    issued = table(spark, sf_dir, "supplier").select(*ref("s_suppkey"), F.col("s_name").alias("issues"))
    urgent = table(spark, sf_dir, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    cases = table(spark, sf_dir, "customer").join(urgent, "c_custkey", "left_semi").select(*ref("c_custkey"), F.col("c_name").alias("reasoning"))
    return listed_rulings(listing, issued, cases).select("number", "issues", "reasoning")


@query("available_years", f"SELECT DISTINCT CAST(year AS BIGINT) AS year FROM {_RULINGS} WHERE system = '憲判字'")
def available_years_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available_years(_rulings(spark, sf_dir))


@query("ruling_search_year", f"SELECT system, {_TITLE} AS case_id, CAST(year AS BIGINT) AS year, number, issues FROM {_RULINGS} WHERE system = '憲判字' AND year = 111")
def ruling_search_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year leaves the old system out."""
    return search_rulings(_rulings(spark, sf_dir), year=111)


@query("ruling_search_counts", f"SELECT count(*) AS n, count(*) > 30 AS truncated FROM {_RULINGS} WHERE {_MATCH}")
def ruling_search_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(search_rulings(_rulings(spark, sf_dir), "11"), 30)


@query("ruling_default_layer", f"SELECT system, year, number, issues FROM {RULINGS.sql} WHERE system = '釋字' AND number = 748")
def ruling_default_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Engine(spark, rulings=RULINGS.frame(spark)).get_ruling("釋字748")


@query("ruling_keyword_layer", "SELECT 748 AS number, 30 AS reasoning_match_count, false AS reasoning_unavailable, 30 AS shown_of_total, 10 AS shown")
def ruling_keyword_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Engine(spark, rulings=RULINGS.frame(spark)).get_ruling("748", reasoning_keyword="婚姻自由")
    return rows.select(F.col("number").cast("int").alias("number"), F.col("reasoning_match_count").cast("int").alias("reasoning_match_count"), "reasoning_unavailable", F.col("reasoning_match_count").cast("int").alias("shown_of_total"), F.size("reasoning_matches").alias("shown"))


@query("issue_index", f"SELECT number, coalesce(issues, '') AS issues FROM {RULINGS.sql}")
def issue_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RULINGS.frame(spark).select("number", issues(F.col("issues"), F.lit(None).cast("string")).alias("issues"))


@query("ruling_listing", "SELECT * FROM (VALUES (0, 748, 310929), (0, 1, 310001), (111, 1, 309000)) v(year, number, doc_id)")
def ruling_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = PAGES.frame(spark)
    old = old_listing(pages).select(F.lit(0).cast("bigint").alias("year"), "number", "doc_id")
    return old.unionByName(new_listing(pages).select("year", "number", "doc_id")).select(*[F.col(c).cast("int").alias(c) for c in ("year", "number", "doc_id")])


@query("ruling_listing_of_documents", "SELECT doc_id, doc_id % 900 + 1 AS number, 110 + doc_id % 3 AS year FROM documents")
def ruling_listing_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in either order of their attributes, two in a page."""
    n = F.col("doc_id")
    old = F.format_string('<a title="釋字第%d號" href="/docdata.aspx?fid=100&id=%d">x</a>', n % 900 + 1, n)
    new = F.format_string('<a class="b" href="/docdata.aspx?fid=38&amp;id=%d" title="%d年憲判字第%d號">y</a><a href="/other">z</a>', n, 110 + n % 3, n % 900 + 1)
    pages = table(spark, sf_dir, "documents").select(n.cast("string").alias("page_id"), F.concat(F.lit("<ul>"), old, new, F.lit("</ul>")).alias("html"))
    joined = old_listing(pages).join(new_listing(pages), ["page_id", "doc_id", "number"])
    return joined.select("doc_id", "number", "year")


@query("ruling_page_fields", "SELECT * FROM (VALUES ('解釋字號', '釋字第748號'), ('解釋文', '第一段' || chr(10) || chr(10) || '第二段'), ('理由書', '理由' || chr(10) || '續')) v(title, body)")
def ruling_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruling_pages(PAGES.frame(spark).where("page_id = 'ruling'")).select(F.explode("fields").alias("title", "body"))


@query("ruling_page_sanity", "SELECT 'ruling' AS page_id, true AS complete, '' AS missing UNION ALL SELECT 'empty', false, '解釋字號,解釋文'")
def ruling_page_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = ruling_pages(PAGES.frame(spark).where("page_id IN ('ruling', 'empty')"))
    rows = missing_fields(pages, CRITICAL_FIELDS["釋字"], MIN_FIELDS)
    return rows.select("page_id", "complete", F.array_join("missing", ",").alias("missing"))
