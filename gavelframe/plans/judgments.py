"""Queries on judgments and saved pages: search, ranking, gates, sections, result lists, statutes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ALLOWED_HOSTS, JID
from ..functions.identifiers import absolute_url, dotted_date, jid_from_url, url_allowed, url_host, url_parameter, url_scheme, valid_jid
from ..functions.sections import parties
from ..functions.text import is_block_page, normalize_space
from ..operators.api import judgment_parts
from ..operators.resolve import with_court
from ..operators.search import all_valid, attach_following, attach_next, first_seen, ranked, ranked_within, search_judgments
from ..sources.html import judgment_pages, parsed, result_list, single_articles, statute_pages
from .base import Fixture, literal_list, query, table
from .fixtures import JIDS, JUDGMENTS, PAGES, RESULTS, URLS

_LEVELS = Fixture("o_orderpriority string, court_level int", [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)])
_RANKED = f"SELECT o.o_orderkey, o.o_orderpriority, coalesce(l.court_level, 99) AS level FROM orders o LEFT JOIN {_LEVELS.sql} l ON l.o_orderpriority = o.o_orderpriority"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").join(_LEVELS.frame(spark), "o_orderpriority", "left")


def _level(rows: DataFrame) -> DataFrame:
    return rows.select("o_orderkey", "o_orderpriority", F.coalesce("court_level", F.lit(99)).alias("level"))


@query("rank_by_level", f"{_RANKED} ORDER BY level, o_orderkey LIMIT 200")
def rank_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _level(ranked(_orders(spark, sf_dir), 200, ["o_orderkey"]))


@query("pre_limit_rank", f"SELECT * FROM ({_RANKED} ORDER BY o_orderkey LIMIT 500) ORDER BY level, o_orderkey LIMIT 50")
def pre_limit_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked only among the pages that were read."""
    return _level(ranked_within(_orders(spark, sf_dir), 500, 50, ["o_orderkey"]))


@query("precise_lookup", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 20 AND year(o_orderdate) = 1995")
def precise_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year as an equality; of two bounds the first given counts."""
    lo, hi = 1995, 1997
    rows = table(spark, sf_dir, "orders").where(F.col("o_custkey") == 20)
    return rows.where(F.year("o_orderdate") == (lo or hi)).select("o_orderkey", "o_custkey", "o_totalprice")


@query("judgment_search_keyword", f"SELECT DISTINCT jid, court FROM {RESULTS.sql} WHERE jid <> '' AND year BETWEEN 108 AND 111 AND contains(full_text, '給付') AND contains(full_text, '價金')")
def judgment_search_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_judgments(RESULTS.frame(spark), keyword="給付 價金", year_from=108, year_to=111).select("jid", "court")


@query("judgment_search_precise", f"SELECT DISTINCT jid, court, case_type FROM {RESULTS.sql} WHERE jid <> '' AND year = 109 AND number = '5' AND replace(word, '臺', '台') = '台上' AND case_type <> '懲戒'")
def judgment_search_precise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_judgments(RESULTS.frame(spark), case_word="臺上", case_number="5", year_from=109, year_to=112).select("jid", "court", "case_type")


@query("judgment_search_main_text", f"SELECT DISTINCT jid FROM {RESULTS.sql} WHERE contains(main_text, '被告應將') AND contains(main_text, '移轉')")
def judgment_search_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_judgments(RESULTS.frame(spark), main_text="被告應將 移轉").select("jid")


_CODES = ["TPD", "TPS", "TPH"]
_JID = f"({literal_list(_CODES)})[CAST(doc_id % 3 AS INTEGER) + 1] || 'V,110,訴,' || doc_id || ',20210120,1'"
_COURT = f"({literal_list(['臺灣臺北地方法院', '最高法院', '臺灣高等法院'])})[CAST(doc_id % 3 AS INTEGER) + 1]"
_BODY = r"array_to_string(list_filter(list_transform(string_split(replace(text, chr(160), ' '), chr(10)), lambda x: regexp_replace(regexp_replace(x, '^[\s\x{3000}\x{2000}-\x{200a}\x{0085}\x{2028}\x{2029}]+', ''), '[\s\x{3000}\x{2000}-\x{200a}\x{0085}\x{2028}\x{2029}]+$', '')), lambda x: x <> ''), chr(10))"


def document_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as judgments: jid, raw_text with heading, parties, sections and date around the text, and arrival."""
    n = F.col("doc_id")
    jid = F.concat(F.element_at(F.array(*map(F.lit, _CODES)), (n % 3 + 1).cast("int")), F.lit("V,110,訴,"), n.cast("string"), F.lit(",20210120,1"))
    lines = [
        F.lit("臺灣臺北地方法院民事判決"), F.format_string("110年度訴字第%d號", n), F.concat(F.lit("原      告  甲"), F.col("lang"), F.lit("公司")), F.concat(F.lit("          乙"), F.col("source"), F.lit("行")),
        F.format_string("被      告  丙%d", n), F.lit("上列當事人間請求給付價金事件，本院判決如下："), F.lit("主    文"), F.col("text"), F.lit("事實及理由"), F.format_string("一、共%d字。", F.col("n_chars").cast("long")),
        F.lit("理    由"), F.lit("理由如次。"), F.lit("中    華    民    國  110  年  1  月  20  日"), F.lit("法 官 林甲"),
    ]
    return table(spark, sf_dir, "documents").select("doc_id", jid.alias("jid"), F.concat_ws("\n", *lines).alias("raw_text"), F.col("text"), F.col("source"))


@query(
    "judgment_sections_of_documents",
    f"""SELECT {_JID} AS jid, {_COURT} AS court, '110年度訴字第' || doc_id || '號' AS case_id, '臺灣臺北地方法院' AS court_in_text, '110-01-20' AS date, '給付價金' AS cause, '林甲' AS judges,
    sha256({_BODY}) AS main_text, '一、共' || n_chars || '字。' AS facts, '理由如次。' AS reasoning FROM documents""",
)
def judgment_sections_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judgment_parts(document_judgments(spark, sf_dir).select("jid", "raw_text"))
    return rows.select("jid", "court", "case_id", "court_in_text", "date", "cause", F.array_join("judges", ",").alias("judges"), F.sha2("main_text", 256).alias("main_text"), "facts", "reasoning")


@query("judgment_parties_of_documents", "SELECT doc_id, '原告' AS role, '甲' || lang || '公司,乙' || source || '行' AS names FROM documents UNION ALL SELECT doc_id, '被告', '丙' || doc_id FROM documents")
def judgment_parties_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_judgments(spark, sf_dir).select("doc_id", F.explode(parties(F.col("raw_text"))).alias("role", "names"))
    return rows.select("doc_id", "role", F.array_join("names", ",").alias("names"))


@query("judgment_search_of_documents", f"SELECT {_JID} AS jid FROM documents WHERE {_COURT} = '最高法院' AND contains(text, 'the') AND contains(text, 'and') ORDER BY doc_id, jid LIMIT 200")
def judgment_search_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words, in the court of a code."""
    rows = with_court(document_judgments(spark, sf_dir)).select("jid", "court", "court_level", "case_type", F.lit(110).alias("year"), F.lit("訴").alias("word"), F.col("doc_id").cast("string").alias("number"), F.col("text").alias("full_text"), F.lit("").alias("main_text"), F.col("doc_id").alias("arrival"))
    return search_judgments(rows, keyword="the and", court="TPS", max_results=200).select("jid")


@query("block_pages", "SELECT page_id, length(html) = 0 OR (length(html) < 500 AND contains(html, 'Request Rejected')) OR (contains(html, 'bobcmn') AND contains(html, 'TSPD')) AS blocked FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN html WHEN 1 THEN '<p>Request Rejected</p>' || html WHEN 2 THEN html || 'bobcmn TSPD' ELSE html || 'bobcmn' END AS html FROM pages)")
def block_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("page_id") % 4
    html = F.when(kind == 0, F.col("html")).when(kind == 1, F.concat(F.lit("<p>Request Rejected</p>"), "html")).when(kind == 2, F.concat("html", F.lit("bobcmn TSPD"))).otherwise(F.concat("html", F.lit("bobcmn")))
    return table(spark, sf_dir, "pages").select("page_id", is_block_page(html).alias("blocked"))


@query("union_fanout_dedup", "SELECT user_id, min(event_id) AS event_id FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_id")
def union_fanout_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three searches as one bag, then the first of each key."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    sides = [events.where(F.col("event_type") == kind) for kind in ("click", "view", "purchase")]
    bag = sides[0].unionByName(sides[1]).unionByName(sides[2])
    return first_seen(bag.drop("event_type"), ["user_id"], ["event_id"])


@query("jid_valid", f"SELECT ordinal, jid, coalesce(regexp_matches(jid, '{JID}'), false) AS valid FROM {JIDS.sql}")
def jid_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JIDS.frame(spark).select("ordinal", "jid", valid_jid(F.col("jid")).alias("valid"))


@query("jid_gate", f"SELECT count(*) AS n, count(*) > 0 AND coalesce(bool_and(coalesce(regexp_matches(jid, '{JID}'), false)), false) AS valid FROM {JIDS.sql}")
def jid_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_valid(JIDS.frame(spark))


@query("heading_attach", "SELECT conv_id, turn, role, first_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_assistant FROM conversations")
def heading_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return attach_next(rows, ["conv_id"], ["turn"], F.when(F.col("role") == "assistant", F.col("turn")), "next_assistant")


@query("summary_attach", "SELECT conv_id, turn, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations")
def summary_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return attach_following(rows, ["conv_id"], ["turn"], F.col("role"), "next_role").drop("role")


@query("url_parts", r"SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)) AS host, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page FROM pages")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", url_scheme(url).alias("scheme"), url_host(url).alias("host"), url_parameter(url, "page").alias("page"))


_HOST_SQL = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1))"


@query("url_allowlist", f"SELECT url, coalesce(lower(split_part(url, ':', 1)) IN ('http', 'https') AND {_HOST_SQL} IN (SELECT unnest({literal_list(ALLOWED_HOSTS)})), false) AS allowed FROM {URLS.sql}")
def url_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return URLS.frame(spark).select("url", url_allowed(F.col("url")).alias("allowed"))


@query("url_identifiers", f"SELECT url, url_decode(regexp_extract(url, 'id=([^&]+)', 1)) AS jid, coalesce(nullif(regexp_extract(url, '[?&]pcode=([^&#]*)', 1), ''), regexp_extract(url, '[?&]PCode=([^&#]*)', 1)) AS pcode FROM {URLS.sql}")
def url_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    pcode = F.coalesce(F.nullif(url_parameter(url, "pcode"), F.lit("")), url_parameter(url, "PCode"))
    return URLS.frame(spark).select("url", jid_from_url(url).alias("jid"), pcode.alias("pcode"))


_LINKS = """unnest(regexp_extract_all(html, 'href="([^"]*)"', 1))"""


@query("link_graph", f"SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href WHEN href = '' THEN '' ELSE 'https://base.example/' || href END AS target FROM (SELECT page_id, {_LINKS} AS href FROM pages)")
def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    return links.withColumn("target", absolute_url(F.col("href"), "https://base.example/"))


def _elements(html: str) -> list[dict]:
    from ..sources.html import dom

    top = dom(html)
    return [{"articles": len(top.every("article")), "links": len(top.every("a")), "items": len(top.every("li"))}]


@query("html_extract", "SELECT page_id, CAST(len(regexp_extract_all(html, '<article[ >]')) AS INTEGER) AS articles, CAST(len(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)[ >].*?</(script|style)>', '', 'g'), '<a[ >]')) AS INTEGER) AS links FROM pages")
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(table(spark, sf_dir, "pages"), "page_id", "articles int, links int, items int", _elements).select("page_id", "articles", "links")


@query("result_page", "SELECT * FROM (VALUES (0, '最高法院 104 年度台上字第 472 號判決', '最高法院', '民事', 1, '104-03-26', '給付價金', '要旨一', 'TPSV,104,台上,472,20150326,1'), (1, '懲戒法院', '懲戒法院懲戒法庭', '懲戒', 2, '109-02-03', '', '', 'TPPDP,109,x,12,20200203,1')) v(position, case_id, court, case_type, court_level, date, cause, summary, jid)")
def result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_list(PAGES.frame(spark).where("page_id = 'results'")).select("position", "case_id", "court", "case_type", "court_level", "date", "cause", "summary", "jid")


@query("statute_page", "SELECT * FROM (VALUES ('title', '民法-全國法規資料庫', NULL, NULL), ('heading', '第一編總則', 1, '1'), ('heading', '第一章法例', 2, '1'), ('article', '1', NULL, NULL), ('article', '1-1', NULL, NULL), ('heading', '第二節尾', 3, NULL)) v(kind, label, level, first_article)")
def statute_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings with the first article after them; a trailing one has none."""
    rows = statute_pages(PAGES.frame(spark).where("page_id = 'statute'"))
    rows = attach_next(rows, ["page_id"], ["position"], F.when(F.col("kind") == "article", F.col("label")), "first_article")
    return rows.select("kind", "label", "level", F.when(F.col("kind") == "heading", F.col("first_article")).alias("first_article"))


ARTICLE_PAGES = Fixture("page_id string, html string", [
    ("a", "<h2>民法-全國法規資料庫</h2><div class='law-article'>第 184 條 因故意或過失</div>"), ("b", "<title>條文內容</title><div class='law-article'>著作權聲明</div>"),
    ("c", "<p>短</p><div>這是一個沒有任何已知容器但是相當長的段落，第 15-1 條，應被採用。</div>"), ("d", "<p>太短</p>"), ("e", "<div>本網站係提供法規之最新動態資訊，瀏覽人次總計一二三四五六七八九十人</div>"),
])


@query("single_article_page", "SELECT * FROM (VALUES ('a', '第 184 條 因故意或過失', '184'), ('b', '', ''), ('c', '這是一個沒有任何已知容器但是相當長的段落，第 15-1 條，應被採用。', '15-1'), ('d', '', ''), ('e', '', '')) v(page_id, content, number)")
def single_article_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_articles(ARTICLE_PAGES.frame(spark)).select("page_id", "content", "number")


@query("judgment_page", "SELECT 'judgment' AS page_id, '給付價金' AS label_cause, '" + "內文" * 30 + "不確定故意者' AS raw_text")
def judgment_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgment_pages(PAGES.frame(spark).where("page_id = 'judgment'")).select("page_id", "label_cause", "raw_text")


@query(
    "judgment_sections",
    """SELECT * FROM (VALUES ('TPDV,110,訴,123,20210120,1', '110年度訴字第123號', '臺灣臺北地方法院', '110-01-20', '給付價金', '林甲,陳乙', '被告應給付原告新臺幣壹佰元。' || chr(10) || '訴訟費用由被告負擔。', '最高法院 109 年度台上字第 5 號,臺灣高等法院臺中分院98年度上字第77號'),
    ('TPSV,109,台上,5,20200101,1', '109年度台上字第5號', '最高法院', '', '', '', '上訴駁回。', ''), ('X', '', '', '', '', '', '', ''), ('Y', '', '', '', '', '', '', '')) v(jid, case_id, court_in_text, date, cause, judges, main_text, cited_cases)""",
)
def judgment_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judgment_parts(JUDGMENTS.frame(spark))
    joined = lambda c: F.coalesce(F.array_join(c, ","), F.lit("")).alias(c)
    return rows.select("jid", "case_id", "court_in_text", "date", "cause", joined("judges"), "main_text", joined("cited_cases"))


@query("judgment_parties", "SELECT * FROM (VALUES ('原告', '王大明,李小華'), ('訴訟代理人', '陳律師'), ('被告', '某某股份有限公司'), ('法定代理人', '張三')) v(role, names)")
def judgment_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judgment_parts(JUDGMENTS.frame(spark)).where("jid LIKE 'TPDV%'")
    return rows.select(F.explode("parties").alias("role", "names")).select("role", F.array_join(F.transform("names", normalize_space), ",").alias("names"))


DATES = Fixture("raw string", [("115.02.10",), ("99/1/2",), ("2024-01-01",), ("",), ("115.2",)])


_DOTTED = "'^([0-9]{2,3})[./]([0-9]{1,2})[./]([0-9]{1,2})'"


@query("dotted_dates", f"SELECT raw, CASE WHEN regexp_matches(raw, {_DOTTED}) THEN regexp_extract(raw, {_DOTTED}, 1) || '-' || lpad(regexp_extract(raw, {_DOTTED}, 2), 2, '0') || '-' || lpad(regexp_extract(raw, {_DOTTED}, 3), 2, '0') ELSE '' END AS day FROM {DATES.sql}")
def dotted_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DATES.frame(spark).select("raw", dotted_date(F.col("raw")).alias("day"))
