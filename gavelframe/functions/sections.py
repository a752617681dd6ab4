"""Parts of judgments that need the order of lines: sections, parties, cited statutes."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CASE_ID, CN_DIGITS, FACTS_HEADINGS, NOT_NAMES, PARTY_FILLERS, PARTY_STOPS, PATTERN_NAMES, ROLES
from ..operators.resolve import clean_statute_names
from .identifiers import chinese_number, is_date_line
from .text import bound, lines, normalize_space, strip

MAIN, FACTS, REASONS = "主文", "事實", "理由"


def section_texts(text: Column) -> Column:
    """struct<main_text, facts, reasoning>: the lines below each heading up to the line of the date.

    Headings and the first date below one are looked up by their place; what lies between is cut out.
    """
    names = {MAIN: "main_text", FACTS: "facts", REASONS: "reasoning"}

    first_signs = sorted({heading[0] for heading in (MAIN, REASONS, *FACTS_HEADINGS)})

    def kind_of(line: Column) -> Column:
        # few lines hold a sign of a heading at all
        likely = reduce(or_, (line.contains(sign) for sign in first_signs))
        kind = lambda title: F.when(title == MAIN, MAIN).when(title.isin(FACTS_HEADINGS), FACTS).when(title == REASONS, REASONS)
        return F.when(likely, bound(normalize_space(line), kind))

    def read(line: Column, i: Column) -> Column:
        return bound(kind_of(line), lambda kind: F.struct(i.alias("i"), strip(line).alias("own"), kind.alias("kind"), (kind.isNull() & line.contains("華") & is_date_line(line)).alias("dated")))

    def sections(rows: Column, end: Column) -> Column:
        heads = F.filter(rows, lambda r: r["kind"].isNotNull() & (r["i"] < end))
        return bound(heads, lambda h: F.transform(h, lambda r, k: F.struct(r["kind"].alias("kind"), F.slice(rows, r["i"] + 2, F.coalesce(F.try_element_at(h["i"], k + 2), end) - r["i"] - 1)["own"].alias("lines"))))

    def joined(found: Column) -> Column:
        of = lambda kind: F.flatten(F.filter(found, lambda s: s["kind"] == kind)["lines"])
        return F.struct(*[F.array_join(F.filter(of(kind), lambda own: own != ""), "\n").alias(name) for kind, name in names.items()])

    def all_of(rows: Column) -> Column:
        first = F.try_element_at(F.filter(rows, lambda r: r["kind"].isNotNull()), F.lit(1))["i"]
        dated = F.try_element_at(F.filter(rows, lambda r: r["dated"] & (r["i"] > first)), F.lit(1))["i"]
        return bound(F.coalesce(dated, F.size(rows)), lambda end: bound(sections(rows, end), joined))

    return bound(F.transform(lines(F.coalesce(text, F.lit(""))), read), all_of)


ROLE = r"(?U)^\s*((?:" + "|".join(r"\s*".join(role) for role in ROLES) + r"))\s+(.+)$"
#: A line that ends the list of parties.
ENDING = r"(?U)(?:^|\n)[^\S\n]*(?:" + "|".join(r"[^\S\n]*".join(ending) for ending in [MAIN, "據上論結"]) + r")[^\S\n]*(?=\n|\z)"
HEAD_LINES = 10
NAME_CHARS = (2, 30)


def parties(text: Column) -> Column:
    """map<role, names>, from the lines between the case number (in the first lines) and the main text.

    A line names a role and its first party; lines below it without a role are further parties of it, until one
    tells that the list is over. Only the lines before the main text are read; they are cut at the places of the roles.
    """
    least, most = NAME_CHARS
    any_of = lambda value, words: F.exists(F.array(*map(F.lit, words)), lambda w: value.contains(w))
    place = lambda rows, test: F.try_element_at(F.filter(rows, test), F.lit(1))["i"]

    def read(line: Column, i: Column) -> Column:
        own, title = strip(line), normalize_space(line)
        role = normalize_space(F.regexp_extract(line, ROLE, 1))
        named = F.regexp_replace(F.when(role != "", strip(F.regexp_extract(line, ROLE, 2))).otherwise(own), r"(?U)\s{2,}", "")
        more = ~title.isin(PARTY_FILLERS) & F.length(named).between(least, most) & ~any_of(named, NOT_NAMES)
        return F.struct(
            i.alias("i"), role.alias("role"), F.when(F.when(role != "", F.length(named) >= least).otherwise(more), named).alias("name"), ((role == "") & any_of(own, PARTY_STOPS)).alias("stops"),
        )

    def below_case(head: Column) -> Column:
        cased = F.transform(F.slice(head, 1, HEAD_LINES), lambda line: strip(line).rlike(CASE_ID))
        at = F.array_position(cased, F.lit(True))  # from 1; 0 where there is none
        return bound(at, lambda k: F.when(k > 0, F.slice(head, k.cast("int") + 1, F.size(head))).otherwise(F.slice(head, 1, 0)))

    def before_stop(rows: Column) -> Column:
        first = place(rows, lambda r: r["role"] != "")
        return F.filter(rows, lambda r: (r["i"] >= first) & (r["i"] < F.coalesce(place(rows, lambda s: s["stops"] & (s["i"] > first)), r["i"] + 1)))

    def by_role(rows: Column) -> Column:
        heads = F.filter(rows, lambda r: r["role"] != "")
        start = rows[0]["i"]
        parts = lambda h: F.transform(h, lambda r, k: F.struct(r["role"].alias("role"), F.slice(rows, r["i"] - start + 1, F.coalesce(F.try_element_at(h["i"], k + 2), start + F.size(rows)) - r["i"])["name"].alias("names")))
        names = lambda p, role: F.filter(F.flatten(F.filter(p, lambda s: s["role"] == role)["names"]), lambda n: n.isNotNull())
        return bound(bound(heads, parts), lambda p: F.map_from_entries(F.transform(F.array_distinct(p["role"]), lambda role: F.struct(role, names(p, role)))))

    none = F.create_map().cast("map<string,array<string>>")
    head = lines(F.split(F.coalesce(text, F.lit("")), ENDING, 2)[0])
    listed = bound(bound(head, below_case), lambda rows: F.transform(rows, read))
    found = bound(bound(listed, before_stop), lambda rows: F.when(F.size(rows) > 0, by_role(rows)).otherwise(none))
    return F.coalesce(found, none)


_NAMES = "(?=[一-鿿])(?:" + "|".join(PATTERN_NAMES) + "|[一-鿿]{2,15}(?:法|條例|規則|辦法))"
ARABIC = rf"(?U)({_NAMES})\s*第\s*(\d{{1,4}}(?:[-之]\d{{1,2}})?)\s*條(?:\s*第\s*\d+\s*項)?"
CHINESE = rf"(?U)({_NAMES})\s*第\s*({CN_DIGITS}{{1,8}})\s*條(?:之({CN_DIGITS}{{1,4}}))?"


def statute_mentions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, ordinal, raw (name as written), article: each mention, Arabic numbers before Chinese ones."""
    body = F.coalesce(F.col(text), F.lit(""))
    entry = lambda m, name, article: F.struct(F.regexp_extract(m, name, 1).alias("raw"), article.alias("article"))
    arabic = F.transform(F.regexp_extract_all(body, F.lit(ARABIC), F.lit(0)), lambda m: entry(m, ARABIC, F.regexp_extract(m, ARABIC, 2)))

    def chinese_entry(m: Column) -> Column:
        main, sub = chinese_number(F.regexp_extract(m, CHINESE, 2)), F.regexp_extract(m, CHINESE, 3)
        number = F.when(sub == "", main.cast("string")).otherwise(F.concat_ws("-", main.cast("string"), chinese_number(sub).cast("string")))
        return entry(m, CHINESE, F.when(main != 0, number))

    chinese = F.filter(F.transform(F.regexp_extract_all(body, F.lit(CHINESE), F.lit(0)), chinese_entry), lambda e: e["article"].isNotNull())
    rows = docs.select(key, F.posexplode(F.concat(arabic, chinese)).alias("ordinal", "e"))
    return rows.select(key, "ordinal", "e.raw", "e.article")


def cited_statutes(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ordinal, law_name, article, entry: distinct citations of statutes per document, by first mention."""
    found = statute_mentions(docs, key, text)
    named = found.join(clean_statute_names(found, known), "raw")
    entry = F.concat(F.col("law_name"), F.lit("第"), F.col("article"), F.lit("條"))
    return named.groupBy(key, "law_name", "article").agg(F.min("ordinal").alias("ordinal")).withColumn("entry", entry)


def normalized_article(article: Column) -> Column:
    """247之1 and 247-1 alike as 247-1."""
    return F.regexp_replace(article, "之", "-")
