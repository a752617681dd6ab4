"""Filters, ranking, paging and deduplication of judgments, rulings and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FAN_OUT, MAX_RESULTS, MISSING_LEVEL, PAGE_SIZE
from ..functions.identifiers import fold_variant, format_case_ref, valid_jid
from ..functions.text import has_all_terms
from .resolve import court_named
from .text_index import TextIndex


def page(rows: DataFrame, order: list[Column], offset: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """One page of the ordered rows."""
    if offset < 0:
        raise ValueError("offset must not be negative")
    return rows.orderBy(*order).offset(offset).limit(size)


def page_counts(rows: DataFrame, offset: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """total before paging, and has_more after this page."""
    total = F.count("*")
    return rows.agg(total.alias("total"), (total > offset + size).alias("has_more"))


def checked_limit(limit: int, most: int = MAX_RESULTS) -> int:
    if limit <= 0:
        raise ValueError("the number of results must be positive")
    return min(limit, most)


def search_names(laws: DataFrame, keyword: str, name: str = "law_name", abolished: str = "abolished", exclude_abolished: bool = False) -> DataFrame:
    """Names that hold the keyword, as it is written."""
    if not keyword:
        raise ValueError("a keyword is needed")
    found = laws.where(F.col(name).contains(keyword))
    return found.where(~F.col(abolished)) if exclude_abolished else found


def first_seen(rows: DataFrame, key: list[str], arrival: list[str]) -> DataFrame:
    """For each key the row that arrived first. Hot keys are aggregated before the shuffle."""
    others = [c for c in rows.columns if c not in key]
    first = rows.groupBy(*key).agg(F.min(F.struct(*arrival, *[c for c in others if c not in arrival])).alias("_first"))
    return first.select(*[F.col(c) if c in key else F.col(f"_first.{c}") for c in rows.columns])


def latest(rows: DataFrame, key: list[str], at: list[str]) -> DataFrame:
    """Upserts: for each key the row written last."""
    others = [c for c in rows.columns if c not in key]
    last = rows.groupBy(*key).agg(F.max(F.struct(*at, *[c for c in others if c not in at])).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col(f"_last.{c}") for c in rows.columns])


def level(column: str = "court_level") -> Column:
    return F.coalesce(F.col(column), F.lit(MISSING_LEVEL))


def ranked(rows: DataFrame, limit: int, arrival: list[str], by_level: bool = True) -> DataFrame:
    """The first rows by court level (only if no court was asked for), then by arrival."""
    order = ([level()] if by_level else []) + [F.col(c) for c in arrival]
    return rows.orderBy(*order).limit(checked_limit(limit))


def ranked_within(rows: DataFrame, pages_rows: int, limit: int, arrival: list[str]) -> DataFrame:
    """As ranked, but only among the first pages_rows rows that arrived."""
    return ranked(rows.orderBy(*[F.col(c) for c in arrival]).limit(pages_rows), limit, arrival)


def year_between(year: Column, lo: int = 0, hi: int = 0) -> Column:
    """Both bounds count; 0 leaves one open."""
    out = F.lit(True)
    if lo:
        out = out & (year >= lo)
    return out & (year <= hi) if hi else out


def search_judgments(
    rows: DataFrame, keyword: str = "", court: str = "", case_type: str = "", year_from: int = 0, year_to: int = 0, case_word: str = "", case_number: str = "", main_text: str = "", max_results: int = 10, index: TextIndex | None = None,
) -> DataFrame:
    """Judgments (jid, court, court_level, case_type, year, word, number, full_text, main_text, arrival), one per jid.

    With word and number alone the year is an equality and only the default types are searched; otherwise the
    years are a range and all words of keyword and main_text must occur. Higher courts come first unless a court is
    named, which goes by its name or its code. With an index of full_text by jid only the judgments that it finds for the keyword are read.
    """
    limit = checked_limit(max_results)
    if not (keyword or case_number or main_text):
        raise ValueError("a keyword, a case number or a main text is needed")
    found = rows
    if court:
        found = found.where(court_named(court))
    if case_word:
        found = found.where(fold_variant(F.col("word")) == F.translate(F.lit(case_word), "臺", "台"))
    if case_number:
        found = found.where(F.col("number") == str(case_number))
    if case_word and case_number and not keyword and not main_text:
        from ..constants import CASE_TYPES

        kinds = [case_type] if case_type else [name for name, code in CASE_TYPES.items() if code in FAN_OUT]
        found = found.where(F.col("case_type").isin(kinds))
        if year_from or year_to:
            found = found.where(F.col("year") == (year_from or year_to))
    else:
        if case_type:
            found = found.where(F.col("case_type") == case_type)
        found = found.where(year_between(F.col("year"), year_from, year_to))
        if keyword and index is not None:
            found = found.join(index.search(keyword).select(F.col("key").alias("jid")).distinct(), "jid", "left_semi")
        found = found.where(has_all_terms(F.col("full_text"), keyword)) if keyword else found
        found = found.where(has_all_terms(F.col("main_text"), main_text)) if main_text else found
    once = first_seen(found.where(F.col("jid") != ""), ["jid"], ["arrival"])
    return ranked(once, limit, ["arrival", "jid"], by_level=not court)


def all_valid(rows: DataFrame, jid: str = "jid") -> DataFrame:
    """One row: n, and valid: there are rows and every one has a well-formed identifier."""
    good = F.coalesce(F.bool_and(valid_jid(F.col(jid))), F.lit(False))
    return rows.agg(F.count("*").alias("n"), (good & (F.count("*") > 0)).alias("valid"))


def search_rulings(rulings: DataFrame, keyword: str = "", year: int = 0, number_from: int = 0, number_to: int = 0, include_old: bool = True, include_new: bool = True) -> DataFrame:
    """Matching rulings (system, year, number, issues, reasoning): the new system's newest first, then the old one's.

    A year leaves the old system out. The keyword is held by the title, equals number or (new) year, or is held by issues or reasoning.
    """
    keyword = keyword.strip()
    is_new = F.col("system") == "憲判字"
    title = format_case_ref(F.col("system"), F.col("year"), F.col("number"))
    found = rulings.where(year_between(F.col("number"), number_from, number_to))
    found = found.where((is_new & F.lit(include_new)) | (~is_new & F.lit(include_old and not year)))
    if year:
        found = found.where(F.col("year") == year)
    if keyword:
        held = lambda c: F.coalesce(F.col(c).contains(keyword), F.lit(False))
        found = found.where(title.contains(keyword) | (F.col("number").cast("string") == keyword) | (is_new & (F.col("year").cast("string") == keyword)) | held("issues") | held("reasoning"))
    rank = F.when(is_new, 0).otherwise(1)
    return found.select("system", title.alias("case_id"), "year", "number", F.coalesce("issues", F.lit("")).alias("issues")).orderBy(rank, F.desc("year"), F.desc("number"))


def listed_rulings(listing: DataFrame, issues: DataFrame, cases: DataFrame) -> DataFrame:
    """listing (system, year, number) with the issues and, where the ruling itself is known, its reasoning."""
    key = ["system", "year", "number"]
    joined = listing.join(issues.select(*key, "issues"), key, "left").join(cases.select(*key, "reasoning"), key, "left")
    return joined.withColumn("issues", F.coalesce("issues", F.lit("")))


def available_years(listing: DataFrame) -> DataFrame:
    """year: those of the new system's rulings, distinct and sorted; what a missing ruling is answered with."""
    return listing.where("system = '憲判字'").select("year").distinct().orderBy("year")


def truncated(rows: DataFrame, limit: int) -> DataFrame:
    """One row: n matches, and if a page of limit rows leaves some out."""
    return rows.agg(F.count("*").alias("n"), (F.count("*") > checked_limit(limit, 1 << 30)).alias("truncated"))


def attach_next(rows: DataFrame, partition: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """rows with the value of the next row that has one (a heading and the first article after it).

    Read backwards it is the last value so far, which a window carries along instead of searching all later rows.
    """
    seen = Window.partitionBy(*partition).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(seen))


def attach_following(rows: DataFrame, partition: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """rows with the value of the very next row."""
    return rows.withColumn(name, F.lead(value).over(Window.partitionBy(*partition).orderBy(*order)))
