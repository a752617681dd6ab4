"""Column builders for identifiers: articles, case numbers, citations, dates, urls, validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ALLOWED_HOSTS, CASE_ID, CAUSE, CITATION_CONTEXT, CITED_COURT, COURT, JID, JUDGE, NEW_CITATION, OLD_CITATION, ROC_DATE_LINE
from .text import bound, lines, normalize_space, running, strip

EMPTY = ""


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null where there is none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _number(digits: Column) -> Column:
    """Digits of any width as a bigint."""
    return F.translate(digits, "０１２３４５６７８９", "0123456789").try_cast("bigint")


# ------------------------------------------------------------------ articles


def article_key(number: Column) -> Column:
    """One sort key for an article: major + minor / 10 (so that 15-10 is 16.0); 0 if it isn't numeric."""
    parts = F.split(F.regexp_replace(number, "之", "-"), "-")
    minor = F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(2)).try_cast("double") / 10).otherwise(0.0)
    return F.coalesce(parts[0].try_cast("double") + minor, F.lit(0.0))


def article_order(number: Column) -> Column:
    """struct<major int, minor int>: the order of articles, with 15-10 between 15-9 and 16."""
    parts = F.split(F.regexp_replace(number, "之", "-"), "-")
    return F.struct(F.coalesce(parts[0].try_cast("int"), F.lit(0)).alias("major"), F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("int"), F.lit(0)).alias("minor"))


def chinese_number(text: Column) -> Column:
    """Value of a Chinese numeral up to 9,999; a lone 十 is 10, a lone 百 or 千 is 0, of digits in a row the last holds."""
    digits, units = "零一二三四五六七八九", {"十": 10, "百": 100, "千": 1000}
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).cast("bigint").alias("digit"))

    def step(s: Column, ch: Column) -> Column:
        digit = F.when(ch.isin("〇", "０"), 0).otherwise(F.instr(F.lit(digits), ch) - 1).cast("bigint")
        unit = F.lit(None).cast("bigint")
        for name, value in units.items():
            unit = F.when(ch == name, value).otherwise(unit)
        held = F.when((s["digit"] == 0) & (ch == "十"), F.lit(1).cast("bigint")).otherwise(s["digit"])
        return (
            F.when(unit.isNotNull(), F.struct((s["sum"] + held * unit).alias("sum"), F.lit(0).cast("bigint").alias("digit")))
            .when(ch.isin("〇", "０") | (F.instr(F.lit(digits), ch) > 0), F.struct(s["sum"].alias("sum"), digit.alias("digit")))
            .otherwise(s)
        )

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(chars, start, step, lambda s: s["sum"] + s["digit"])


# ------------------------------------------------------------------ rulings


def parse_case_ref(raw: Column) -> Column:
    """struct<system, number, year, error> of a reference to a ruling; year is 0 in the old system."""
    s = strip(F.coalesce(raw, F.lit("")))
    is_new, is_old = s.contains("憲判"), s.contains("釋字") | s.contains("解釋")
    year = _number(F.coalesce(_found(s, r"(?U)(\d+)\s*年"), _found(s, r"(?U)^\s*(\d+)\s*憲判")))
    new_no = _number(_found(s, r"(?U)憲判[^\d]*(\d+)"))
    old_no = _number(_found(s, r"(?U)(?:釋字|解釋)[^\d]*(\d+)"))
    plain = _number(_found(s, r"(?U)^\s*(\d+)\s*$"))
    error = (
        F.when(s == "", "empty")
        .when(is_new & year.isNull(), "year_missing")
        .when(is_new & new_no.isNull(), "number_missing")
        .when(~is_new & is_old & old_no.isNull(), "number_missing")
        .when(~is_new & ~is_old & plain.isNull(), "unparsable")
    )
    number = F.when(is_new, new_no).when(is_old, old_no).otherwise(plain)
    fine = error.isNull()
    return F.struct(
        F.when(fine, F.when(is_new, "憲判字").otherwise("釋字")).alias("system"), F.when(fine, number).alias("number"),
        F.when(fine, F.when(is_new, year).otherwise(0)).cast("bigint").alias("year"), error.alias("error"),
    )


def format_case_ref(system: Column, year: Column, number: Column) -> Column:
    return F.when(system == "釋字", F.concat(F.lit("釋字第"), number.cast("string"), F.lit("號"))).otherwise(F.concat(year.cast("string"), F.lit("年憲判字第"), number.cast("string"), F.lit("號")))


def citations(text: Column) -> Column:
    """Distinct cited rulings, array<struct<rank, year, number>>: the old system (rank 0) by number, then the new one by year and number."""
    text = F.coalesce(text, F.lit(""))
    zero = F.lit(0).cast("bigint")
    entry = lambda rank, year, number: F.struct(F.lit(rank).alias("rank"), year.alias("year"), number.alias("number"))
    old = F.transform(F.regexp_extract_all(text, F.lit("(?U)" + OLD_CITATION), F.lit(1)), lambda n: entry(0, zero, _number(n)))
    whole = F.regexp_extract_all(text, F.lit("(?U)" + NEW_CITATION), F.lit(0))
    new = F.transform(whole, lambda m: entry(1, _number(F.regexp_extract(m, r"(?U)^(\d+)", 1)), _number(F.regexp_extract(m, r"(?U)第\s*(\d+)", 1))))
    return F.array_sort(F.array_distinct(F.concat(old, new)))


def contexts(text: Column, pattern: str, context: int = CITATION_CONTEXT) -> Column:
    """array<struct<position bigint, match string, context string>> of every match, with text on both sides.

    The text around a match is joined from the gaps and matches next to it (a match has a character at least), so that a long text
    is not read again for each.
    """
    pattern, none = "(?U)" + pattern, F.lit(0)
    last = lambda t: F.substring(t, -context, context)
    head = lambda t: F.substring(t, 1, context)

    def of(b: Column) -> Column:
        """b: text length, found (matches), gaps (one more), starts (of the gaps), ends and begins (their clipped ends and beginnings)."""

        def one(match: Column, i: Column) -> Column:
            start = b["starts"][i] + F.length(b["gaps"][i])
            stop = start + F.length(match)
            back = F.least(i, F.lit(context))
            earlier = F.zip_with(F.slice(b["ends"], i - back + 1, back), F.slice(b["found"], i - back + 1, back), lambda g, m: F.concat(g, m))
            later = F.zip_with(F.slice(b["found"], i + 2, F.lit(context)), F.slice(b["begins"], i + 3, F.lit(context)), lambda m, g: F.concat(m, F.coalesce(g, F.lit(""))))
            left = last(F.concat(F.array_join(earlier, ""), b["ends"][i]))
            right = head(F.concat(b["begins"][i + 1], F.array_join(later, "")))
            around = F.concat(F.when(start > context, "...").otherwise(""), left, match, right, F.when(stop + context < b["n"], "...").otherwise(""))
            return F.struct(start.cast("bigint").alias("position"), match.alias("match"), around.alias("context"))

        return F.transform(b["found"], one)

    def parts(s: Column) -> Column:
        sizes = F.zip_with(s["gaps"], s["found"], lambda g, m: F.length(g) + F.coalesce(F.length(m), none))
        return F.struct(s["n"].alias("n"), s["found"].alias("found"), s["gaps"].alias("gaps"), running(sizes).alias("starts"), F.transform(s["gaps"], last).alias("ends"), F.transform(s["gaps"], head).alias("begins"))

    whole = lambda t: F.struct(F.length(t).alias("n"), F.regexp_extract_all(t, F.lit(pattern), none).alias("found"), F.split(t, pattern, -1).alias("gaps"))
    return bound(F.coalesce(text, F.lit("")), lambda t: bound(whole(t), lambda s: bound(parts(s), of)))


# ------------------------------------------------------------------ judgments


def valid_jid(jid: Column) -> Column:
    return F.coalesce(jid.rlike(JID), F.lit(False))


def fold_variant(text: Column) -> Column:
    return F.translate(text, "臺", "台")


def _first_line(text: Column, keep, value, head: int | None = None) -> Column:
    """value of the first line that keep accepts; empty without one."""
    rows = lines(text) if head is None else F.slice(lines(text), 1, head)
    return F.coalesce(F.try_element_at(F.transform(F.filter(rows, keep), value), F.lit(1)), F.lit(EMPTY))


def case_id_line(text: Column) -> Column:
    """The line with the case number among the first ten."""
    return _first_line(text, lambda x: strip(x).rlike(CASE_ID), strip, 10)


def court_name(text: Column) -> Column:
    return _first_line(text, lambda x: x.rlike("(?U)" + COURT), lambda x: F.regexp_extract(strip(x), "(?U)" + COURT, 1), 10)


def cause(text: Column) -> Column:
    return _first_line(text, lambda x: x.rlike(CAUSE), lambda x: strip(F.regexp_extract(x, CAUSE, 1)))


def is_date_line(line: Column) -> Column:
    """A line that is little else than a date."""
    pattern = "(?U)" + ROC_DATE_LINE
    return line.rlike(pattern) & (F.length(normalize_space(F.regexp_replace(line, "(?U)^(.*?)" + ROC_DATE_LINE, "$1"))) <= 5)


def roc_date(text: Column, pattern: str) -> Column:
    """YYY-MM-DD of the first match (year, month and day are its groups); null without one."""
    part = lambda k: F.regexp_extract(text, pattern, k)
    return F.when(text.rlike(pattern), F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")))


def judgment_date(text: Column) -> Column:
    return _first_line(text, is_date_line, lambda x: roc_date(x, "(?U)" + ROC_DATE_LINE))


def dotted_date(text: Column) -> Column:
    """115.2.10 or 115/2/10 -> 115-02-10; empty if it isn't one."""
    return F.coalesce(roc_date(text, r"^(\d{2,3})[./](\d{1,2})[./](\d{1,2})"), F.lit(EMPTY))


def to_roc(day: Column) -> Column:
    return F.concat_ws("-", F.lpad((F.year(day) - 1911).cast("string"), 3, "0"), F.date_format(day, "MM-dd"))


def from_roc(text: Column) -> Column:
    """Date of YYY-MM-DD; null if it isn't one."""
    year = F.regexp_extract(text, r"^(\d{2,3})-(\d{2}-\d{2})$", 1).try_cast("int") + 1911
    return F.try_to_date(F.concat_ws("-", year.cast("string"), F.regexp_extract(text, r"^(\d{2,3})-(\d{2}-\d{2})$", 2)), "yyyy-MM-dd")


def judges(text: Column) -> Column:
    """Names in the last twenty lines, in order."""
    rows = lines(text)
    tail = F.transform(F.slice(rows, F.greatest(F.lit(-20), -F.size(rows)), F.lit(20)), strip)
    pattern = "(?U)" + JUDGE
    names = F.transform(F.filter(tail, lambda x: x.rlike(pattern)), lambda x: normalize_space(F.regexp_extract(x, pattern, 1)))
    return F.filter(names, lambda n: F.length(n) >= 2)


def cited_cases(text: Column) -> Column:
    pattern = r"(?U)(?=[最臺台智懲福])" + CITED_COURT + r"\s*\d+\s*年度?\s*\S+字\s*第?\s*\d+\s*號"
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)))


# ------------------------------------------------------------------ urls


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def url_host(url: Column) -> Column:
    """Host without user, password and port, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))


def url_allowed(url: Column, hosts: list[str] = ALLOWED_HOSTS) -> Column:
    return F.coalesce(url_scheme(url).isin("http", "https") & url_host(url).isin(*hosts), F.lit(False))


def url_parameter(url: Column, name: str) -> Column:
    """First value of a query parameter, not decoded; empty without one."""
    return F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)


def jid_from_url(url: Column) -> Column:
    """The percent-decoded id parameter; undecodable ones stay as they are."""
    raw = F.regexp_extract(url, r"id=([^&]+)", 1)
    return F.coalesce(F.try_url_decode(F.regexp_replace(raw, r"\+", "%2B")), raw)


def absolute_url(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).when(href == "", "").otherwise(F.concat(F.lit(base), href))


def title_name(title: Column) -> Column:
    """A page title's part before the first hyphen."""
    return strip(F.split_part(title, F.lit("-"), F.lit(1)))


# ------------------------------------------------------------------ validity


def is_valid(expires_at: Column, now: Column) -> Column:
    """now <= expires_at; 9999... never ends; what can't be read has ended."""
    return F.coalesce(expires_at.startswith("9999") | (now <= F.try_to_timestamp(expires_at)), F.lit(False))


def latest_saturday(now: Column, hour: int = 6) -> Column:
    """The Saturday of the last update as of now: before that hour of a Saturday it is a week earlier."""
    day = F.to_date(now)
    back = F.pmod(F.weekday(day) - 5, F.lit(7))
    return F.date_sub(day, F.when((back == 0) & (F.hour(now) < hour), 7).otherwise(back).cast("int"))


def is_stale(update_date: Column, now: Column) -> Column:
    """No date, one that can't be read (2024-01-20, or 2024/1/20 and anything), or one before the latest Saturday."""
    slashed = F.split_part(strip(update_date), F.lit(" "), F.lit(1))
    day = F.coalesce(F.try_to_date(update_date, "yyyy-MM-dd"), F.try_to_date(slashed, "y/M/d"))
    return F.coalesce(day < latest_saturday(now), F.lit(True))


def fingerprint(columns: dict[str, Column]) -> Column:
    """SHA-256 of the JSON object of the columns, by sorted names."""
    return F.sha2(F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)])), 256)
