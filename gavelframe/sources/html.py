"""Saved web pages to rows: result lists, judgments, statutes, rulings and listings.

Pages are parsed once, inside Arrow batches, by the standard library's tolerant parser; everything after the
markup (dates, identifiers, courts, sections) is done by DataFrame expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BOILERPLATE
from ..functions.identifiers import absolute_url, dotted_date, jid_from_url
from ..operators.resolve import with_court

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDED_BY = {"li": {"li"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "p": {"p", "div", "table", "ul", "h1", "h2", "h3"}, "option": {"option"}}
SKIPPED = frozenset(["script", "style"])
RESULT_BASE = "https://judgment.judicial.gov.tw/FJUD/"


class Element:
    __slots__ = ("tag", "attributes", "parent", "children")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def walk(self) -> Iterator[Element]:
        """Elements below, in page order."""
        stack = self.children[::-1]
        while stack:
            child = stack.pop()
            if isinstance(child, Element):
                yield child
                stack += child.children[::-1]

    def _fitting(self, test: str) -> Iterator[Element]:
        tag, sign, name = test.partition("#") if "#" in test else test.partition(".")
        if not sign:
            return (e for e in self.walk() if not tag or e.tag == tag)
        fits = {"#": lambda e: e.attributes.get("id") == name, ".": lambda e: name in e.classes}[sign]
        return (e for e in self.walk() if (not tag or e.tag == tag) and fits(e))

    def every(self, test: str) -> list[Element]:
        """Elements below that fit tag, #id, .class, tag#id or tag.class, in page order."""
        return list(self._fitting(test))

    def first(self, *tests: str) -> Element | None:
        """The first element of the first test that finds any."""
        return next((found for test in tests for found in self._fitting(test)), None)

    def strings(self) -> Iterator[str]:
        stack = self.children[::-1]
        while stack:
            child = stack.pop()
            if isinstance(child, str):
                yield child
            elif child.tag not in SKIPPED:
                stack += child.children[::-1]

    def text(self, between: str = "", stripped: bool = True) -> str:
        parts = (s.strip() for s in self.strings()) if stripped else self.strings()
        return between.join(p for p in parts if p or not stripped)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.begin(tag, {k: v or "" for k, v in attrs})

    def begin(self, tag: str, attributes: dict[str, str]) -> None:
        if self.at.tag in ENDED_BY and tag in ENDED_BY[self.at.tag]:
            self.at = self.at.parent or self.top
        if tag == "tr" and self.at.tag in ("td", "th"):
            self.handle_endtag("tr")
        child = Element(tag, attributes, self.at)
        self.at.children.append(child)
        if tag not in VOID:
            self.at = child

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        up: Element | None = self.at
        while up is not None and up.tag != tag:
            up = up.parent
        if up is not None and up.parent is not None:
            self.at = up.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


#: Markup that the tolerant parser takes as it stands: tags in lower case with quoted attributes, and text. What the parser treats apart (comments, declarations, tags
#: with their own kind of text, references in attributes other than the usual ones) is left to it.
_NAME = r"(?!script|style|title|textarea|xmp|iframe|no|plaintext)[a-z][a-z0-9]*+"
_VALUE = r'"((?:[^"&<>]|&(?:amp|lt|gt|quot);)*+)"'
_ATTRIBUTE = re.compile(rf"[ \n\t]+([a-z][a-z0-9-]*+)={_VALUE}")
_ATTRIBUTES = rf"(?:{_ATTRIBUTE.pattern.replace('(', '(?:').replace('(?:?:', '(?:')})*+"
_TOKEN = re.compile(rf"([^<]++)|<(/)?({_NAME})((?(2)|{_ATTRIBUTES}))>")
_PLAIN = re.compile(rf"(?:[^<]++|</{_NAME}>|<{_NAME}{_ATTRIBUTES}>)*+")


def dom(html: str | None) -> Element:
    """The tree of a page. Plain markup is cut by one expression, which is several times faster than the tolerant parser and gives the same tree; all else is parsed."""
    builder = _Builder()
    if _PLAIN.fullmatch(html or ""):
        for text, end, tag, attributes in _TOKEN.findall(html or ""):
            if text:
                builder.at.children.append(unescape(text))
            elif end:
                builder.handle_endtag(tag)
            else:
                builder.begin(tag, {k: unescape(v) for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {})
        return builder.top
    return tolerant_dom(html)


def tolerant_dom(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.top


def parsed(pages: DataFrame, key: str, schema: str, rows_of: Callable[[str], list[dict]]) -> DataFrame:
    """key, position and the rows that rows_of finds in each page's html; the work is spread over the pages' partitions."""
    kind = pages.schema[key].dataType.simpleString()
    names = [key, "position", *[part.strip().split(" ")[0] for part in schema.split(",")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [[k, i, *[row.get(n) for n in names[2:]]] for k, html in zip(batch[key], batch["html"], strict=True) for i, row in enumerate(rows_of(html))]
            yield pd.DataFrame(rows, columns=names)

    return pages.select(key, "html").mapInPandas(run, f"{key} {kind}, position int, {schema}")


# ------------------------------------------------------------------ result lists


def _hits(html: str) -> list[dict]:
    table = dom(html).first("table#jud", "table.jub-table")
    rows = table.every("tr") if table else []
    out = []
    for i, row in enumerate(rows):
        classes = row.classes
        if "summary" in classes or (not classes and row.first("th")):
            continue
        cells = row.every("td")
        if len(cells) < 3:
            continue
        link = cells[1].first("a")
        summary = rows[i + 1].first("span.tdCut") if i + 1 < len(rows) and "summary" in rows[i + 1].classes else None
        entry = {
            "case_id": link.text() if link else "", "href": link.attributes.get("href", "") if link else "", "day": cells[2].text(),
            "cause": cells[3].text() if len(cells) > 3 else "", "summary": summary.text() if summary else "",
        }
        if entry["case_id"]:
            out.append(entry)
    return out


def result_list(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Hits of saved result pages: case_id, court, case_type, court_level, date, cause, summary, url, jid."""
    rows = parsed(pages, key, "case_id string, href string, day string, cause string, summary string", _hits)
    rows = rows.select(key, "position", "case_id", dotted_date(F.col("day")).alias("date"), "cause", "summary", absolute_url(F.col("href"), RESULT_BASE).alias("url"), jid_from_url(F.col("href")).alias("jid"))
    return with_court(rows)


# ------------------------------------------------------------------ judgments

LEAST_BODY = 50


def _judgment(html: str) -> list[dict]:
    top = dom(html)
    holder = top.first("#jud", "#jud_content", ".jud-content", "pre", "#MainContent", "body") or top
    labels = {}
    for row in holder.every(".row"):
        name, value = row.first(".col-th"), next((e for e in row.every(".col-td") if "jud_content" not in e.classes), None)
        if name and value and value.text():
            for label in ("裁判字號", "裁判日期", "裁判案由"):
                if label in name.text():
                    labels[label] = value.text()
                    break
    body = holder
    for test in (".htmlcontent", ".text-pre", ".jud_content"):
        found = holder.first(test)
        if found and len(found.text()) >= LEAST_BODY:
            body = found
            break
    for element in list(body.walk()):  # inline terms don't break lines
        if element.tag in ("abbr", "span") and element.parent:
            k = element.parent.children.index(element)
            for child in element.children:
                if isinstance(child, Element):
                    child.parent = element.parent
            element.parent.children[k : k + 1] = element.children
    _join_strings(body)
    return [{"raw_text": body.text("\n", stripped=False), "label_case_id": labels.get("裁判字號"), "label_day": labels.get("裁判日期"), "label_cause": labels.get("裁判案由")}]


def _join_strings(element: Element) -> None:
    for holder in [element, *element.walk()]:
        runs = groupby(holder.children, key=lambda child: isinstance(child, str))
        holder.children = [part for text, run in runs for part in (["".join(run)] if text else run)]


def judgment_pages(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """raw_text and the labelled case number, day and cause of saved judgment pages."""
    return parsed(pages, key, "raw_text string, label_case_id string, label_day string, label_cause string", _judgment)


# ------------------------------------------------------------------ statutes


def _article(row: Element) -> tuple[str, str] | None:
    number, content = row.first(".col-no"), row.first(".col-data")
    return (number.text(), content.text()) if number and content and content.text() else None


def _statute_row(element: Element) -> dict | None:
    """An element as a heading, or as an article of a row or of a table's cells."""
    if element.tag == "tr":
        cells = [cell.text() for cell in element.every("td")]
        return {"kind": "article", "label": cells[0], "level": None, "content": cells[1]} if len(cells) > 1 and cells[1] else None
    if "h3" in element.classes:
        label = "".join(element.text().split())
        levels = [n for n in (1, 2) if f"char-{n}" in element.classes]
        return {"kind": "heading", "label": label, "level": (levels or [3])[0], "content": None} if label else None
    found = _article(element) if "row" in element.classes else None
    return {"kind": "article", "label": found[0], "level": None, "content": found[1]} if found else None


def _statute(html: str) -> list[dict]:
    """Rows of kind title, heading or article, in page order; table rows count where nothing else is an article."""
    top = dom(html)
    title, body = top.first("h2", "title"), top.first(".law-reg-content")
    elements = [c for c in body.children if isinstance(c, Element) and c.tag != "tr"] if body else top.every("div.row")
    rows = [row for row in map(_statute_row, elements) if row and (body or row["kind"] == "article")]
    if all(row["kind"] != "article" for row in rows):
        rows += filter(None, map(_statute_row, top.every("tr")))
    return [{"kind": "title", "label": title.text() if title else "", "level": None, "content": None}, *rows]


def statute_pages(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """position, kind (title, heading, article), label, level and content; articles' labels are their numbers."""
    rows = parsed(pages, key, "kind string, label string, level int, content string", _statute)
    number = F.regexp_extract("label", r"(?U)第\s*(\S+?)\s*條", 1)
    kept = rows.where((F.col("kind") != "article") | (number != ""))
    return kept.withColumn("label", F.when(F.col("kind") == "article", number).otherwise(F.col("label")))


CONTAINERS, LEAST_BLOCK = [".law-article", "#pnlContent", ".content-law", "pre"], 20


def _single(html: str) -> list[dict]:
    """The text of a known container, else of the longest block that isn't too short; none for page footers."""
    top = dom(html)
    title, holder = top.first("h2", ".law-title", "title"), top.first(*CONTAINERS)
    if holder:
        content = holder.text()
    else:
        longest = max((e for e in top.walk() if e.tag in ("p", "div", "td")), key=lambda e: len(e.text(stripped=False)), default=None)
        content = longest.text() if longest and len(longest.text()) > LEAST_BLOCK else ""
    footer = any(marker in content for marker in BOILERPLATE)
    return [{"title": title.text() if title else "", "content": "" if footer else content}]


def single_articles(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """title, content (empty for page footers) and number of saved pages of one article."""
    rows = parsed(pages, key, "title string, content string", _single)
    return rows.withColumn("number", F.regexp_extract("content", r"(?U)第\s*(\d+[-之]?\d*)\s*條", 1))


# ------------------------------------------------------------------ rulings


def _fields(html: str) -> list[dict]:
    out: dict[str, str] = {}
    for group in dom(html).every("ul"):
        items = [c for c in group.children if isinstance(c, Element) and c.tag == "li"]
        title, text = (next((i for i in items if name in i.classes), None) for name in ("title", "text"))
        if title is None or text is None:
            continue
        paragraphs = [p.text("\n") for u in text.every("ul.paragraphs") for p in u.every("pre")]
        out.setdefault(title.text(), "\n\n".join(p for p in paragraphs if p) if paragraphs else text.text("\n"))
    return [{"fields": list(out.items())}]


def ruling_pages(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """fields: a map of titles and texts; the first of equal titles holds."""
    return parsed(pages, key, "fields map<string,string>", lambda html: [{"fields": dict(r["fields"])} for r in _fields(html)])


def missing_fields(rows: DataFrame, critical: list[str], least: int) -> DataFrame:
    """rows with missing (critical fields without text), found (sorted titles) and complete."""
    wanted = F.array(*map(F.lit, critical))
    has = F.map_keys(F.map_filter("fields", lambda _, v: v != ""))
    missing = F.array_except(wanted, has)
    return rows.withColumns({"missing": missing, "found": F.sort_array(F.map_keys("fields")), "complete": (F.size("fields") >= least) & (F.size(missing) == 0)})


def _listed(pages: DataFrame, key: str, title: str, fid: int, **numbers: int) -> DataFrame:
    """key, the numbers in the title (by their group) and doc_id of the links of a listing whose title fits, whatever the order of their attributes."""
    links = pages.select(key, F.explode(F.regexp_extract_all("html", F.lit(r"<a\s[^>]*>"), F.lit(0))).alias("link"))
    attribute = lambda name: F.regexp_extract("link", rf'\s{name}="([^"]*)"', 1)
    href = rf"^/docdata\.aspx\?fid={fid}&(?:amp;)?id=(\d+)$"
    fits = links.select(key, attribute("title").alias("title"), attribute("href").alias("href")).where(F.col("title").rlike(title) & F.col("href").rlike(href))
    found = {name: F.regexp_extract("title", title, group).cast("bigint").alias(name) for name, group in numbers.items()}
    return fits.select(key, *found.values(), F.regexp_extract("href", href, 1).cast("bigint").alias("doc_id")).distinct()


def old_listing(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """number and doc_id of the old system's rulings in saved listings."""
    return _listed(pages, key, r"^釋字第(\d+)號$", 100, number=1)


def new_listing(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """year, number and doc_id of the new system's rulings in saved listings."""
    return _listed(pages, key, r"^(\d+)年憲判字第(\d+)號$", 38, year=1, number=2)
