"""Column builders for long texts: cleaning, snippets, safety valve, predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BOILERPLATE, CHALLENGE, CUT_WARNING, REFUSAL, REFUSAL_CHARS, SAFETY_VALVE, SNIPPET_CONTEXT, SNIPPET_MATCHES, SUBSTANTIVE

#: All characters that Unicode counts as white space.
WHITE = "\t\n\v\f\r \u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Elements that running() sums together first.
SPAN = 256


def quoted(literal: str) -> str:
    """A Java regular expression that matches the literal."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def bound(value: Column, use) -> Column:
    """use(value), with value evaluated once however often use() names it (also in lambdas)."""
    return F.transform(F.array(value), use)[0]


def running(numbers: Column) -> Column:
    """For each number of an array the sum of those before it.

    Sums are taken in spans of SPAN numbers and then over the spans, so that no fold copies a long array at every step.
    """

    def sums(values: Column, start: Column) -> Column:
        first = F.struct(start.alias("sum"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(values, first, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.array_append(s["out"], s["sum"]).alias("out")), lambda s: s["out"])

    zero = F.lit(0).cast("bigint")
    cut = lambda n: F.transform(F.sequence(F.lit(0), F.ceil(F.size(n) / SPAN).cast("int") - 1), lambda k: F.slice(n, k * SPAN + 1, F.lit(SPAN)))
    total = lambda span: F.aggregate(span, zero, lambda s, x: s + x)
    summed = lambda spans: F.flatten(F.zip_with(spans, sums(F.transform(spans, total), zero), sums))
    return bound(numbers.cast("array<bigint>"), lambda n: F.when(F.size(n) > 0, bound(cut(n), summed)).otherwise(F.array().cast("array<bigint>")))


def strip(text: Column) -> Column:
    """Without white space of any kind (ideographic and no-break spaces too) at both ends."""
    return F.btrim(text, F.lit(WHITE))


def normalize_space(text: Column) -> Column:
    """Without any white space."""
    return F.translate(text, WHITE, "")


def strip_inline_tags(html: Column) -> Column:
    """Without abbr and span tags; their text stays."""
    return F.regexp_replace(html, r"</?(?:abbr|span)[^>]*>", "")


def clean_judgment_text(text: Column) -> Column:
    """Without the font-size widget, trailing blanks of lines and runs of empty lines."""
    out = F.regexp_replace(text, r"(?U)^\s*版面大小[\s\d%]*", "")
    out = F.regexp_replace(F.translate(out, "\u00a0", " "), r"(?U)[\s&&[^\n]]++(?=\n|\z)", "")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def match_count(text: Column, keyword: str) -> Column:
    """Occurrences of the keyword from left to right that don't overlap; 0 for null texts."""
    if not keyword:
        return F.lit(0).cast("long")
    return F.coalesce(F.size(F.split(text, quoted(keyword), -1)) - 1, F.lit(0)).cast("long")


def snippets(text: Column, keyword: str, context: int = SNIPPET_CONTEXT, limit: int = SNIPPET_MATCHES) -> Column:
    """array<struct<position bigint, snippet string>> of the first matches; position counts from 0."""
    k = len(keyword)
    gaps = lambda t: F.split(t, quoted(keyword), limit + 1)  # noqa: E731  # no further than needed
    before = lambda parts: F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda g: F.length(g) + k)
    # a match starts where the gaps and matches before it end, and its own gap
    starts = lambda parts: F.zip_with(running(before(parts)), F.slice(parts, 1, F.size(parts) - 1), lambda s, g: s + F.length(g))
    return bound(F.coalesce(text, F.lit("")), lambda t: F.transform(bound(gaps(t), starts), lambda s: clipped(t, s, s + k, context, "snippet")))


def clipped(text: Column, start: Column, stop: Column, context: int, name: str) -> Column:
    """struct<position, name>: text[start:stop] with context on both sides, with ellipses where it is clipped."""
    first, last = F.greatest(start - context, F.lit(0)), F.least(stop + context, F.length(text))
    inner = F.substring(text, first + 1, last - first)
    before, after = F.when(first > 0, "...").otherwise(""), F.when(last < F.length(text), "...").otherwise("")
    return F.struct(start.cast("bigint").alias("position"), F.concat(before, inner, after).alias(name))


def safety_valve(text: Column, limit: int = SAFETY_VALVE) -> Column:
    """struct<text, truncated>: texts over the limit are cut and carry a warning at their end."""
    n = F.length(text)
    warning = F.format_string(CUT_WARNING, n, n - limit)
    cut = F.coalesce(n > limit, F.lit(False))
    return F.struct(F.when(cut, F.concat(F.substring(text, 1, limit), warning)).otherwise(text).alias("text"), cut.alias("truncated"))


def is_substantive(text: Column, least: int = SUBSTANTIVE) -> Column:
    """At least so many characters without white space at the ends."""
    return F.coalesce(F.length(strip(text)) >= least, F.lit(False))


def looks_like_article(text: Column, markers: list[str] = BOILERPLATE) -> Column:
    """No marker of page footers in the text."""
    found = F.lit(False)
    for marker in markers:
        found = found | text.contains(marker)
    return F.coalesce(~found, F.lit(True))


def is_block_page(html: Column) -> Column:
    """A saved page that isn't the document: nothing, a short refusal, or a challenge for browsers."""
    challenge = F.forall(F.array(*map(F.lit, CHALLENGE)), lambda mark: html.contains(mark))
    return F.coalesce((F.length(html) == 0) | ((F.length(html) < REFUSAL_CHARS) & html.contains(REFUSAL)) | challenge, F.lit(True))


def has_all_terms(text: Column, terms: str) -> Column:
    """Every term (between white space) occurs in the text."""
    out = F.lit(True)
    for term in terms.split():
        out = out & text.contains(term)
    return F.coalesce(out, F.lit(False))


def long_field(text: Column, keyword: str = "", include_full: bool = False) -> dict[str, Column]:
    """Columns of an opt-in long field: none by default, snippets for a keyword, else the valved text."""
    keyword = keyword.strip()
    if not keyword and not include_full:
        return {}
    fine = is_substantive(text)
    out = {"unavailable": ~fine, "full_length": F.coalesce(F.length(text), F.lit(0)).cast("long")}
    if keyword:
        return out | {"matches": F.when(fine, snippets(text, keyword)), "match_count": F.when(fine, match_count(text, keyword)), "keyword": F.lit(keyword)}
    valved = safety_valve(text)
    return out | {"text": F.when(fine, valved["text"]), "truncated": F.when(fine, valved["truncated"])}
