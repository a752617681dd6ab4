"""Secrets in texts, with the parts of one credential linked to each other.

A pattern is strong or weak. Strong matches count wherever they stand. Weak ones (a short password, a user name, an address) are
common in clean texts, so that one is reported only where the parts that complete it are near:

* a weak secret beside an identifier (weak or strong),
* a weak identifier beside a secret,
* an endpoint beside both.

Beside means in one scope, a block of text without a blank line, and with starts at most REACH code points apart.

One scan of each text finds the candidates of all patterns and cuts the scopes; its table holds a few numbers for each document. The candidates
of documents with weak ones are then joined as intervals: each scope is laid out in cells of REACH code points, a cell keeps the first and the last
start of each role, and a weak candidate asks its own cell and the two beside it for the roles it needs. What is in its own cell is near,
of the cell before only the last start matters, of the next one the first. So a document with a million candidates in a line costs as much as
a million with one each: no pairs of candidates are formed.

Defined cases: null texts are empty; each row gets its own result, rows of one doc_id too, and rows equal in both are judged once; null doc_ids
are allowed; offsets count code points, ends are exclusive; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ARROW_ROWS, materialize, release, table

REACH = 300
IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"


def _letters(names: str) -> str:
    """A pattern of names whose ASCII letters match in either case (and no other letters that some engines fold to them)."""
    return re.sub(r"[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", names)


_GIVEN = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_SECRET_NAMES = f"({_letters('password|passwd|secret|token|api_?key')})"


@dataclass(frozen=True)
class Pattern:
    """A kind of candidate: matches whose group has shortest to longest code points and, if needs is given, holds a match of it."""

    kind: str
    role: str
    weak: bool
    pattern: str
    group: int
    shortest: int
    longest: int | None = None
    needs: str | None = None


#: In the order in which spans of one start are listed. The first three are fixed.
PATTERNS = (
    Pattern("assign", SECRET, False, _SECRET_NAMES + _GIVEN, 2, 8),
    Pattern("access", IDENTIFIER, False, r"AKIA[A-Z0-9]+", 0, 16),
    Pattern("hex", SECRET, False, r"[0-9a-f]+", 0, 32),
    Pattern("short", SECRET, True, _SECRET_NAMES + _GIVEN, 2, 4, 7),
    Pattern("phrase", SECRET, True, f"({_letters('pwd|passphrase|private_?key|credential')})" + _GIVEN, 2, 4),
    Pattern("partial", SECRET, True, r"[0-9a-f]+", 0, 16, 31, r"[a-f]"),
    Pattern("user", IDENTIFIER, True, f"({_letters('user_?name|user_?id|user|login|account|client_?id|key_?id')})" + _GIVEN, 2, 3),
    Pattern("key", IDENTIFIER, True, r"AKIA[A-Z0-9]+", 0, 8, 15),
    Pattern("endpoint", ENDPOINT, True, f"({_letters('https?|ftp|jdbc|postgresql|postgres|mysql|mongodb|redis|amqp|s3')})" + r"://[A-Za-z0-9_.:/@%-]+", 0, 10),
)
#: Roles that a weak candidate of a role needs beside it.
NEEDED = {SECRET: [IDENTIFIER], IDENTIFIER: [SECRET], ENDPOINT: [IDENTIFIER, SECRET]}
BLANK_LINE = r"\n[ \t\r]*\n"
CANDIDATE = "array<struct<start:long, kind:int, end:long, scope:long>>"


def _finder(p: Pattern) -> re.Pattern:
    """The pattern as it is run: of a single class only runs of the shortest length or more can pass, so that others aren't tried."""
    plain = re.fullmatch(r"(\w*)(\[[^\]]+\])\+", p.pattern)
    return re.compile(f"{plain[1]}{plain[2]}{{{p.shortest - len(plain[1])},}}" if plain else p.pattern)


def candidates(text: str, patterns: tuple[Pattern, ...] = PATTERNS, finders: list[re.Pattern] | None = None) -> list[tuple[int, int, int]]:
    """(start, number of the pattern, end) of all candidates, by start and number."""
    found = []
    for k, (p, finder) in enumerate(zip(patterns, finders or [_finder(p) for p in patterns], strict=True)):
        for m in finder.finditer(text):
            size = m.end(p.group) - m.start(p.group)
            if size >= p.shortest and (p.longest is None or size <= p.longest) and (p.needs is None or re.search(p.needs, m[p.group])):
                found.append((m.start(), k, m.end()))
    return sorted(found)


def _scanner(patterns: tuple[Pattern, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders, blank = [_finder(p) for p in patterns], re.compile(BLANK_LINE)
        item = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())])
        for batch in batches:
            digests, lists = [], []
            for value in batch.column(1):
                text = value.as_py()
                found, digest = candidates(text, patterns, finders), None
                scopes = [0] * len(found)
                if any(patterns[k].weak for _, k, _ in found):
                    digest, breaks, scope = hashlib.sha256(text.encode()).digest(), [m.end() for m in blank.finditer(text)], 0
                    for i, (start, _, _) in enumerate(found):
                        while scope < len(breaks) and breaks[scope] <= start:
                            scope += 1
                        scopes[i] = scope
                digests.append(digest)
                lists.append([{"start": s, "kind": k, "end": e, "scope": c} for (s, k, e), c in zip(found, scopes, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(lists, pa.list_(item))], ["doc_id", "digest", "found"])

    return run


def scan(docs: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS) -> DataFrame:
    """doc_id, digest (of texts with weak candidates, else null), found: all candidates of each row, with their scope where that matters."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(_scanner(patterns), f"doc_id {kind}, digest binary, found {CANDIDATE}")


def linked(scanned: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS, reach: int = REACH) -> DataFrame:
    """doc_id, digest, links: the weak candidates (start, kind, end) that have their complementary parts near."""
    role = F.array(*(F.lit(p.role) for p in patterns))
    weak = F.array(*(F.lit(p.weak) for p in patterns))
    needed = F.array(*(F.array(*(F.lit(r) for r in NEEDED[p.role])) for p in patterns))
    of = ["doc_id", "digest"]
    once = scanned.where("digest is not null").groupBy(*of).agg(F.first("found").alias("found"))
    each = once.select(*of, F.explode("found").alias("c")).select(*of, "c.*").withColumn("cell", F.expr(f"start div {reach}"))
    each = each.withColumns({"role": F.get(role, "kind"), "weak": F.get(weak, "kind"), "needs": F.get(needed, "kind")})
    cells = each.groupBy(*of, "scope", "cell", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    asked = each.where("weak").withColumn("need", F.explode("needs")).withColumn("side", F.explode(F.array(*(F.lit(x) for x in (-1, 0, 1)))))
    asked = asked.select(*of, "scope", (F.col("cell") + F.col("side")).alias("cell"), F.col("need").alias("role"), "side", "start", "kind", "end", F.size("needs").alias("wanted"))
    a, c = asked.alias("a"), cells.alias("c")
    same = F.col("a.doc_id").eqNullSafe(F.col("c.doc_id"))
    for k in ("digest", "scope", "cell", "role"):
        same = same & (F.col(f"a.{k}") == F.col(f"c.{k}"))
    near = (F.col("side") == 0) | ((F.col("side") < 0) & (F.col("start") - F.col("last") <= reach)) | ((F.col("side") > 0) & (F.col("first") - F.col("start") <= reach))
    met = a.join(c, same).where(near).groupBy(*(F.col(f"a.{k}").alias(k) for k in of), "start", "kind", "end", "wanted").agg(F.count_distinct("a.role").alias("met"))
    return met.where("met = wanted").groupBy(*of).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("links"))


def secrets(docs: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS, reach: int = REACH) -> DataFrame:
    """doc_id, spans array<struct<start, kind, end>>: strong matches and linked weak ones of each row, by start and kind (a number of patterns)."""
    scanned = materialize(scan(docs, patterns), "scanned", ARROW_ROWS)
    strong = F.transform(F.filter("found", lambda x: ~F.get(F.array(*(F.lit(p.weak) for p in patterns)), x["kind"])), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    rows = scanned.select("doc_id", "digest", strong.alias("strong"))
    s, k = rows.where("digest is not null").alias("s"), linked(scanned, patterns, reach).alias("k")
    joined = s.join(k, F.col("s.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("s.digest") == F.col("k.digest")), "left")
    none = F.array().cast("array<struct<start:long, kind:int, end:long>>")
    open_rows = joined.select("s.doc_id", F.array_sort(F.concat("s.strong", F.coalesce("k.links", none))).alias("spans"))
    out = materialize(rows.where("digest is null").select("doc_id", F.col("strong").alias("spans")).unionByName(open_rows), "secrets")
    release(scanned)
    return out


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    kinds = F.array(*(F.lit(p.kind) for p in PATTERNS))
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _hits_sql(k: int, p: Pattern) -> str:
    """Matches with their places: pieces between matches and matches, summed up."""
    test = f"length(v) >= {p.shortest}" + (f" AND length(v) <= {p.longest}" if p.longest else "") + (f" AND regexp_matches(v, {_quoted(p.needs)})" if p.needs else "")
    return f"""SELECT row, {k} AS kind, '{p.kind}' AS name, '{p.role}' AS role, {p.weak} AS weak, s AS start, s + length(h) AS "end" FROM (
  SELECT row, h[i] AS h, v[i] AS v, CAST(list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM (
    SELECT row, g, h, v, unnest(range(1, len(h) + 1)) AS i FROM (SELECT row, string_split_regex(text, {_quoted(p.pattern)}) AS g, regexp_extract_all(text, {_quoted(p.pattern)}) AS h, regexp_extract_all(text, {_quoted(p.pattern)}, {p.group}) AS v FROM d))) WHERE {test}"""


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
c AS ({" UNION ALL ".join(_hits_sql(k, p) for k, p in enumerate(PATTERNS))}),
p AS (SELECT c.*, len(string_split_regex(substr(text, 1, start), {_quoted(BLANK_LINE)})) AS scope FROM c JOIN d USING (row)),
n AS (SELECT a.row, a.kind, a.name, a.role, a.start, a."end", count(DISTINCT b.role) AS met FROM p a JOIN p b ON a.row = b.row AND a.scope = b.scope AND a.role <> b.role AND abs(a.start - b.start) <= {REACH}
  AND (a.role <> 'secret' OR b.role = 'identifier') AND (a.role <> 'identifier' OR b.role = 'secret') WHERE a.weak GROUP BY ALL),
s AS (SELECT row, kind, name, start, "end" FROM p WHERE NOT weak UNION ALL SELECT row, kind, name, start, "end" FROM n WHERE met = CASE role WHEN 'endpoint' THEN 2 ELSE 1 END),
o AS (SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  coalesce(string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) FILTER (kind < 3), '') AS base, string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) AS spans FROM s GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN o USING (row)
"""
