"""Queries on long texts: snippets, counts, valve, predicates, cleaning, fingerprints, opt-in fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SAFETY_VALVE
from ..functions.identifiers import fingerprint
from ..functions.text import clean_judgment_text, has_all_terms, is_substantive, long_field, looks_like_article, match_count, normalize_space, safety_valve, snippets, strip_inline_tags
from ..operators.search import first_seen
from .base import Fixture, query, table
from .fixtures import JUDGMENTS

KEYWORD = "the"


def _snippet_sql(source: str, key: str, keyword: str, context: int, limit: int) -> str:
    k = len(keyword)
    return f"""WITH g AS (SELECT {key}, text, string_split(text, '{keyword}') AS g FROM {source} WHERE contains(text, '{keyword}')),
    i AS (SELECT {key}, text, g, unnest(range(1, least({limit} + 1, len(g)))) AS i FROM g),
    p AS (SELECT {key}, text, i, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + (i - 1) * {k} AS BIGINT) AS position FROM i),
    b AS (SELECT *, greatest(position - {context}, 0) AS s, least(position + {k} + {context}, length(text)) AS e FROM p)
    SELECT {key}, position, (CASE WHEN s > 0 THEN '...' ELSE '' END) || substr(text, s + 1, e - s) || (CASE WHEN e < length(text) THEN '...' ELSE '' END) AS snippet FROM b"""


@query("kwic_snippets", _snippet_sql("documents", "doc_id", KEYWORD, 200, 10))
def kwic_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.col("text").contains(KEYWORD))
    return docs.select("doc_id", F.explode(snippets(F.col("text"), KEYWORD)).alias("s")).select("doc_id", "s.position", "s.snippet")


@query("keyword_match_counts", f"SELECT doc_id, CAST(coalesce(len(string_split(text, '{KEYWORD}')) - 1, 0) AS BIGINT) AS matches FROM documents")
def keyword_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", match_count(F.col("text"), KEYWORD).alias("matches"))


@query(
    "safety_valve",
    f"""SELECT doc_id, length(text) > {SAFETY_VALVE} AS truncated, sha256(CASE WHEN length(text) > {SAFETY_VALVE} THEN substr(text, 1, {SAFETY_VALVE}) || chr(10) || chr(10) || '[System Warning: 本欄位字數過長（原長 ' || length(text) || ' 字），已截斷末端 '
    || (length(text) - {SAFETY_VALVE}) || ' 字。請優先基於已提供的部分進行推理，切勿直接斷言「大法官並未提及某事」——被截斷的內容可能包含關鍵論述。若判斷末端內容關鍵，可回報使用者需人工查閱完整判決。]' ELSE text END) AS digest FROM documents""",
)
def safety_valve_(spark: SparkSession, sf_dir: str) -> DataFrame:
    valved = safety_valve(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", valved["truncated"].alias("truncated"), F.sha2(valved["text"], 256).alias("digest"))


_BLANK = r"[\s\x{00a0}\x{3000}\x{2000}-\x{200a}\x{0085}\x{2028}\x{2029}\x{202f}\x{205f}\x{1680}\x{000b}]"


@query("substantive_flag", rf"SELECT doc_id, length(regexp_replace(regexp_replace(text, '^{_BLANK}+', ''), '{_BLANK}+$', '')) >= 50 AS substantive FROM documents")
def substantive_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", is_substantive(F.col("text")).alias("substantive"))


MARKERS = ["cookie", "Copyright", "subscribe", "newsletter"]


@query("boilerplate_filter", "SELECT page_id, url FROM pages WHERE NOT (" + " OR ".join(f"contains(html, '{m}')" for m in MARKERS) + ")")
def boilerplate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where(looks_like_article(F.col("html"), MARKERS)).select("page_id", "url")


@query("multi_criteria_search", "SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND n_chars BETWEEN 500 AND 20000 AND contains(text, 'the') AND contains(text, 'and')")
def multi_criteria_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where((F.col("lang") == "en") & F.col("n_chars").between(500, 20000))
    return docs.where(has_all_terms(F.col("text"), "the and")).select("doc_id", "lang", "source")


@query("dedup_first_seen", "SELECT sha256(text) AS digest, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def dedup_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By digests, so that no text is shuffled."""
    return first_seen(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id", "source"), ["digest"], ["doc_id"])


@query("strip_inline_tags", "SELECT page_id, sha256(regexp_replace(html, '</?(?:abbr|span)[^>]*>', '', 'g')) AS digest FROM pages")
def strip_inline_tags_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(strip_inline_tags(F.col("html")), 256).alias("digest"))


@query("normalize_space", rf"SELECT doc_id, length(regexp_replace(text, '{_BLANK}+', '', 'g')) AS n FROM documents")
def normalize_space_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.length(normalize_space(F.col("text"))).cast("bigint").alias("n"))


_CLEAN = rf"regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(raw_text, '^{_BLANK}*版面大小[\s0-9%]*', ''), chr(160), ' '), '[ \t\r\x{{3000}}]+(\n|$)', '\1', 'g'), '\n{{3,}}', E'\n\n', 'g'), '^{_BLANK}+|{_BLANK}+$', '', 'g')"


@query("text_clean", f"SELECT jid, {_CLEAN} AS full_text FROM {JUDGMENTS.sql}")
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JUDGMENTS.frame(spark).select("jid", clean_judgment_text(F.col("raw_text")).alias("full_text"))


@query("entity_mentions", r"SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS email FROM documents")
def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0))
    return table(spark, sf_dir, "documents").where(F.col("text").contains("@")).select("doc_id", F.explode(found).alias("email"))


@query("query_fingerprint", """SELECT doc_id, sha256('{"lang":"' || lang || '","source":"' || source || '"}') AS fingerprint FROM documents""")
def query_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fingerprint({"source": F.col("source"), "lang": F.col("lang")}).alias("fingerprint"))


@query("opt_in_none", "SELECT doc_id, lang FROM documents")
def opt_in_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a request the long column is not even read."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", *[c.alias(f"text_{n}") for n, c in long_field(F.col("text")).items()])


@query(
    "opt_in_keyword",
    f"""SELECT doc_id, NOT s AS text_unavailable, length(text) AS text_full_length, CASE WHEN s THEN CAST(len(string_split(text, 'tion')) - 1 AS BIGINT) END AS text_match_count, 'tion' AS text_keyword
    FROM (SELECT *, length(regexp_replace(regexp_replace(text, '^{_BLANK}+', ''), '{_BLANK}+$', '')) >= 50 AS s FROM documents)""",
)
def opt_in_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = long_field(F.col("text"), "tion")
    return table(spark, sf_dir, "documents").select("doc_id", *[asked[n].alias(f"text_{n}") for n in ("unavailable", "full_length", "match_count", "keyword")])


TEXTS = Fixture("doc_id bigint, text string", [(1, "aXbXXc"), (2, "none"), (3, ""), (4, None), (5, "X" * 12 + "民法" * 300)])


@query("kwic_snippets_short", _snippet_sql(TEXTS.sql, "doc_id", "X", 3, 10))
def kwic_snippets_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TEXTS.frame(spark).select("doc_id", F.explode(snippets(F.col("text"), "X", 3)).alias("s")).select("doc_id", "s.position", "s.snippet")
