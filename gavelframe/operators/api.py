"""The eight lookups of the engine as DataFrame-returning methods."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ABOLISHED, CURRENT
from ..functions.identifiers import article_key, article_order, case_id_line, cause, citations, cited_cases, contexts, court_name, format_case_ref, jid_from_url, judges, judgment_date, parse_case_ref, url_allowed
from ..functions.identifiers import NEW_CITATION, OLD_CITATION
from ..functions.sections import cited_statutes, parties, section_texts
from ..functions.text import clean_judgment_text, long_field, looks_like_article
from .resolve import known_names, resolve_name, suggestions, with_court
from .search import available_years, page, search_judgments, search_names, search_rulings
from .text_index import TextIndex


def error_envelope(message: str, at: datetime, **context: object) -> dict[str, object]:
    """A failed lookup as a JSON-ready answer: success, error, timestamp and what the caller adds (which wins over these)."""
    return {"success": False, "error": message, "timestamp": at.isoformat()} | context


class Engine:
    """Tables: laws (ordinal, law_name, pcode, abolished), histories (pcode, history), articles (pcode, number, content), judgments, rulings; index: of the judgments' full_text by jid."""

    def __init__(self, spark: SparkSession, laws: DataFrame | None = None, histories: DataFrame | None = None, articles: DataFrame | None = None, judgments: DataFrame | None = None, rulings: DataFrame | None = None, index: TextIndex | None = None) -> None:
        self.index = index
        self.spark, self.laws, self.histories, self.articles, self.judgments, self.rulings = spark, laws, histories, articles, judgments, rulings

    def search_judgments(self, **criteria) -> DataFrame:
        """See operators.search.search_judgments."""
        return search_judgments(self.judgments, index=self.index, **criteria)

    def get_judgment(self, jid: str = "", url: str = "") -> DataFrame:
        """The judgment with its parts; by identifier, or by an allowed url."""
        if not jid and not url:
            raise ValueError("an identifier or a url is needed")
        if not jid:
            jid, fine = self.spark.range(1).select(jid_from_url(F.lit(url)), url_allowed(F.lit(url))).first()
            if not fine:
                raise ValueError(f"documents don't come from this address: {url[:80]}")
        return judgment_parts(self.judgments.where(F.col("jid") == jid))

    def query_regulation(self, law_name: str = "", pcode: str = "", article_no: str = "", from_no: str = "", to_no: str = "", include_history: bool = False, compat: bool = False) -> DataFrame:
        """Articles of a law: one, a range (if both ends are given), or all, in order, with the law's status.

        compat: ranges by one decimal key, in which 15-10 is 16; otherwise by (major, minor).
        """
        if not law_name and not pcode:
            raise ValueError("a name or a code is needed")
        if pcode:
            laws = self.laws.where(F.col("pcode") == pcode).groupBy("pcode").agg(F.max_by("law_name", "ordinal").alias("law_name"), F.bool_or("abolished").alias("abolished"))
        else:
            found = resolve_name(law_name, self.laws).where("pcode IS NOT NULL").select("law_name", "pcode")
            gone = self.laws.where("abolished").select("pcode").distinct().withColumn("abolished", F.lit(True))
            laws = found.join(gone, "pcode", "left").withColumn("abolished", F.coalesce("abolished", F.lit(False)))
        rows = self.articles.where(looks_like_article(F.col("content"))).join(laws, "pcode")
        key = article_key if compat else article_order
        if article_no:
            rows = rows.where(F.col("number") == article_no)
        elif from_no and to_no:
            rows = rows.where(key(F.col("number")).between(key(F.lit(from_no)), key(F.lit(to_no))))
        rows = rows.withColumn("status", F.when(F.col("abolished"), ABOLISHED).otherwise(CURRENT))
        if include_history and self.histories is not None:
            rows = rows.join(self.histories, "pcode", "left")
        return rows.drop("abolished").orderBy(article_order(F.col("number")), "number")

    def resolve_law(self, name: str) -> DataFrame:
        """term, tier, law_name, pcode, status, matched_from (if the name isn't the law's), suggestions."""
        if not name:
            raise ValueError("a name is needed")
        found = resolve_name(name, self.laws)
        status = self.laws.groupBy("pcode").agg(F.bool_or("abolished").alias("gone"))
        rows = found.join(status, "pcode", "left")
        return rows.select("term", "tier", "law_name", "pcode", F.when(F.col("pcode").isNotNull(), F.when(F.col("gone"), ABOLISHED).otherwise(CURRENT)).alias("status"), F.when(F.col("law_name") != F.col("term"), F.col("term")).alias("matched_from"))

    def suggest(self, term: str) -> DataFrame:
        return suggestions(self.laws, term)

    def search_regulations(self, keyword: str, offset: int = 0, exclude_abolished: bool = False) -> DataFrame:
        """One page of names, current ones first."""
        return page(search_names(self.laws, keyword, exclude_abolished=exclude_abolished), [F.col("abolished"), F.col("law_name"), F.col("ordinal")], offset)

    def get_ruling(self, case_ref: str, include_reasoning: bool = False, reasoning_keyword: str = "", include_opinions: bool = False, opinions_keyword: str = "") -> DataFrame:
        """The ruling; its long fields only when they are asked for, as snippets or whole."""
        ref = parse_case_ref(F.lit(case_ref))
        rows = self.rulings.where((F.col("system") == ref["system"]) & (F.col("year") == ref["year"]) & (F.col("number") == ref["number"]))
        rest = [c for c in rows.columns if c not in ("reasoning", "opinions")]
        extra = [c.alias(f"{field}_{name}") for field, keyword, full in (("reasoning", reasoning_keyword, include_reasoning), ("opinions", opinions_keyword, include_opinions)) for name, c in long_field(F.col(field), keyword, full).items()]
        return rows.select(*rest, *extra)

    def available_years(self) -> DataFrame:
        """year of the new system's rulings, sorted."""
        return available_years(self.rulings)

    def search_rulings(self, max_results: int = 30, **criteria) -> DataFrame:
        if max_results <= 0:
            raise ValueError("the number of results must be positive")
        return search_rulings(self.rulings, **criteria).limit(max_results)

    def citations(self, case_ref: str, include_context: bool = False, cut: int | None = None) -> DataFrame:
        """case_id of each ruling that the reasoning cites; with context, each mention. cut: look at so many characters only."""
        ref = parse_case_ref(F.lit(case_ref))
        rows = self.rulings.where((F.col("system") == ref["system"]) & (F.col("year") == ref["year"]) & (F.col("number") == ref["number"]))
        text = F.substring("reasoning", 1, cut) if cut else F.col("reasoning")
        if include_context:
            return rows.select(F.explode(F.concat(contexts(text, OLD_CITATION), contexts(text, NEW_CITATION))).alias("c")).select("c.*")
        return citation_edges(rows.withColumn("reasoning", text)).drop("source")


def citation_edges(rulings: DataFrame) -> DataFrame:
    """source, rank, year, number, case_id: the whole corpus's citation edges."""
    edges = rulings.select(format_case_ref(F.col("system"), F.col("year"), F.col("number")).alias("source"), F.explode(citations(F.col("reasoning"))).alias("c")).select("source", "c.*")
    return edges.withColumn("case_id", format_case_ref(F.when(F.col("rank") == 0, "釋字").otherwise("憲判字"), F.col("year"), F.col("number")))


def judgment_parts(rows: DataFrame) -> DataFrame:
    """rows (jid, raw_text) with cleaned full_text and everything read from it; raw_text stays."""
    full = rows.withColumn("full_text", clean_judgment_text(F.col("raw_text")))
    text = F.col("full_text")
    s = section_texts(text)
    parts = full.withColumns({
        "case_id": case_id_line(text), "court_in_text": court_name(text), "date": judgment_date(text), "judges": judges(text), "parties": parties(text), "cause": cause(text),
        "main_text": s["main_text"], "facts": s["facts"], "reasoning": s["reasoning"], "cited_cases": cited_cases(text),
    })
    return with_court(parts) if "jid" in rows.columns else parts


def cited_statutes_of(rows: DataFrame, laws: DataFrame, key: str = "jid", text: str = "full_text") -> DataFrame:
    return cited_statutes(rows, known_names(laws), key, text)
