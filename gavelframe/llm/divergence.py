"""Divergence of sources: how far the word use of each source is from the others of its language and from the language.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. Each language keeps the terms that MIN_DOCS of its
documents hold. Every (lang, source) group gives every kept term a smoothed share p (in billionths), and two groups differ by the
sum of floor((p - q)^2 / (p + q)) over all kept terms.

That sum is taken in two parts, which are integers and add up exactly:

* Heavy terms, held by at least a share HEAVY of the groups of their language, are laid out as dense count matrices (terms x sources),
  cut into tiles of about TILE_TERMS terms and two blocks of about TILE_SOURCES sources; a tile gives one number for each pair.
* Light terms are absent from most groups, where their share is the same base value. So every pair starts with (number of light terms) x
  f(base, base); a histogram of the counts of each group corrects it for terms that one of the two holds; and posting lists
  correct it for the terms that both hold, a pair of postings at a time.

Counts are gathered inside tasks first (at most FLUSH entries at a time), so a frequent term costs a row per task and source.
Nothing but the number of rows of a table decides how it is cut; tiles, histograms and blocks of posting lists are separate groups.

Defined cases: null text, lang and source are empty ones; every row counts as a document, repeated ones too; groups without terms have
their pairs (every p is then the base); a language without kept terms has value 0 for all pairs and no terms; a source that is alone
has no pairs; an empty table gives no rows; other columns are ignored. Counts of a language must stay below 9 * 10^15.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ARROW_ROWS, materialize, release, table

MIN_DOCS = 10
TOP_TERMS = 10
#: Share of a language's groups that hold a heavy term.
HEAVY = 0.25
TILE_TERMS = 2048
TILE_SOURCES = 128
#: Light terms whose posting lists make a group.
POSTING_TERMS = 16384
#: Rows of count histograms in a group, for each block of sources.
HISTOGRAM_ROWS = 100_000
#: Distinct terms that a task holds before it sends its counts on.
FLUSH = 300_000
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 22
SCALE = 1000  # three steps of a long division give billionths

#: Bytes to lower-case letters, bytes of other characters, or a blank.
FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def terms(text: str, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text in order, as UTF-8, a list for each piece of it."""
    data = text.encode().translate(FOLD)
    at = 0
    while at < len(data):
        end = at + piece
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            keys = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array([source] * len(keys), pa.string()), pa.array(keys, pa.binary()).cast(pa.string()), pa.array([n[k] for k in keys], pa.int64()), pa.array([docs[k] for k in keys], pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    for batch in batches:
        for text, lang, source in zip(*(batch.column(i) for i in range(3)), strict=True):
            n, docs = counts.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(n), set()
            for some in terms(text.as_py()):
                n.update(some)
                seen.update(some)
            docs.update(seen)
            size += len(n) - before
            if size >= FLUSH:
                yield from rows()
                size = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    found = docs.select(blank("text"), blank("lang"), blank("source")).mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)) without leaving 64 bits."""
    whole = F.greatest(total + 2 * kept, F.lit(1).cast("long"))
    rest, p = n + 2, F.lit(1).cast("long")
    for unit in (SCALE * SCALE, SCALE, 1):
        step = rest * SCALE
        p = p + F.call_function("div", step, whole) * unit
        rest = step % whole
    return p


def shares(n: np.ndarray, total, kept) -> np.ndarray:
    """share() on arrays."""
    whole = np.maximum(np.asarray(total, np.int64) + 2 * np.asarray(kept, np.int64), 1)
    rest, p = np.asarray(n, np.int64) + 2, np.int64(1)
    for unit in (SCALE * SCALE, SCALE, 1):
        step = rest * SCALE
        p = p + step // whole * unit
        rest = step % whole
    return p


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Audit:
    """The tables of one run, and the two parts of its result."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, heavy: float = HEAVY) -> None:
        spark = docs.sparkSession
        counts = materialize(term_counts(docs), "term-counts", ARROW_ROWS)
        kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d"), F.count("*").alias("holders")).where(F.col("d") >= min_docs).drop("d")
        self.rows = materialize(counts.drop("docs").join(kept, ["lang", "term"]), "kept-terms")
        release(counts)
        blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
        sums = self.rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = docs.select(blank("lang"), blank("source")).distinct().join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"))
        groups = materialize(groups, "groups")
        sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("total").alias("lang_total"))
        first = self.rows.join(sizes.select("lang", "sources"), "lang").withColumn("heavy", F.col("holders") >= heavy * F.col("sources"))
        # each holder of a term stands for one of `holders` parts of it, so that terms are counted without a distinct
        parts = first.groupBy("lang", "heavy", "holders").agg(F.count("*").alias("r")).groupBy("lang").agg(
            F.sum(F.expr("r div holders")).alias("kept"), F.sum(F.expr("if(heavy, r div holders, 0)")).alias("heavy_terms"))
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        self.langs = materialize(sizes.join(parts, "lang", "left").select("lang", "sources", "lang_total", zero("kept"), zero("heavy_terms")), "langs")
        blocks = F.ceil(F.col("sources") / TILE_SOURCES).cast("long")
        self.groups = materialize(
            groups.join(self.langs, "lang").select("lang", "source", "total", "kept", "heavy_terms", blocks.alias("blocks"), F.pmod(F.xxhash64("source"), blocks).alias("block"), "sources"), "sized-groups")
        release(groups)
        self.spark, self.heavy = spark, heavy

    def _terms(self, columns: list[str], heavy: bool) -> DataFrame:
        rows = self.rows.join(self.groups, ["lang", "source"])
        return rows.where((F.col("holders") >= self.heavy * F.col("sources")) == F.lit(heavy)).select("lang", "source", "total", "kept", "block", "blocks", "heavy_terms", *columns)

    @staticmethod
    def _tiled(rows: DataFrame) -> DataFrame:
        """Rows beside each pair of blocks (i <= j) that their block is part of."""
        other = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        return other.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))

    def dense(self) -> DataFrame:
        """lang, a, b, value: the heavy terms' sums, of each pair of sources and tile."""
        cuts = F.greatest(F.ceil(F.col("heavy_terms") / TILE_TERMS).cast("long"), F.lit(1).cast("long"))
        rows = self._terms(["term", "n", "holders"], True).withColumn("cut", F.pmod(F.xxhash64("term"), cuts))
        # how many terms a cut has: a tile sees only those that its own sources hold
        sizes = rows.groupBy("lang", "cut", "holders").agg(F.count("*").alias("r")).groupBy("lang", "cut").agg(F.sum(F.expr("r div holders")).alias("terms"))
        rows = rows.drop("holders").withColumn("terms", F.lit(0).cast("long"))
        every = self.groups.where("heavy_terms > 0").withColumn("term", F.lit(None).cast("string")).withColumn("n", F.lit(0).cast("long")).withColumn("cut", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1))).join(sizes, ["lang", "cut"])
        tiles = self._tiled(rows.unionByName(every.select(rows.columns))).select("lang", "i", "j", "cut", "source", "block", "total", "kept", "term", "n", "terms")
        return tiles.groupBy("lang", "i", "j", "cut").applyInPandas(_dense_tile, "lang string, a string, b string, value long")

    def single(self) -> DataFrame:
        """The light terms as if no pair of sources shared any: base values, corrected by the histograms of counts."""
        light = self._terms(["n"], False).groupBy("lang", "source", "total", "kept", "block", "blocks", "n").agg(F.count("*").alias("times"))
        light = materialize(light, "histograms")
        cuts = light.groupBy("lang").agg(F.count("*").alias("r")).select("lang", F.ceil(F.col("r") / HISTOGRAM_ROWS).cast("long").alias("r"))
        every = self.groups.join(cuts, "lang", "left").withColumn("cuts", F.greatest(F.ceil(F.coalesce("r", F.lit(1)) / F.col("blocks")).cast("long"), F.lit(1).cast("long"))).drop("r")
        rows = light.join(every.select("lang", "cuts").distinct(), "lang").withColumn("cut", F.pmod("n", "cuts")).withColumn("light", F.lit(0).cast("long"))
        zero = F.lit(0).cast("long")
        every = every.withColumn("cut", F.explode(F.sequence(zero, F.col("cuts") - 1))).withColumn("light", F.when(F.col("cut") == 0, F.col("kept") - F.col("heavy_terms")).otherwise(0))
        columns = ["lang", "source", "total", "kept", "block", "blocks", "cut", "light", "n", "times"]
        every = every.withColumn("n", F.lit(-1).cast("long")).withColumn("times", zero)
        return self._tiled(rows.select(columns).unionByName(every.select(columns))).groupBy("lang", "i", "j", "cut").applyInPandas(_single_tile, "lang string, a string, b string, value long")

    def shared(self) -> DataFrame:
        """What the light terms that both sources of a pair hold add to single()."""
        cuts = F.ceil(F.greatest(F.col("kept") - F.col("heavy_terms"), F.lit(1)) / POSTING_TERMS).cast("long")
        rows = self._terms(["term", "n", "holders"], False).where("holders > 1").withColumn("cut", F.pmod(F.xxhash64("term"), cuts))
        return rows.select("lang", "cut", "source", "total", "kept", "term", "n", "holders").groupBy("lang", "cut").applyInPandas(_shared_postings, "lang string, a string, b string, value long")

    def pairs(self) -> DataFrame:
        """lang, source, item, value: each source beside each other one of its language."""
        parts = self.dense().unionByName(self.single()).unionByName(self.shared())
        once = parts.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
        return once.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")

    def terms(self) -> DataFrame:
        """lang, source, item, value: the terms that a source uses more than its language."""
        rows = self.rows.join(self.groups.select("lang", "source", "total"), ["lang", "source"]).join(self.langs.select("lang", "kept", "lang_total"), "lang")
        both = rows.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
        return both.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))

    def release(self) -> None:
        release(self.rows, self.groups, self.langs)


def _pairs_of(lang: str, left: pd.DataFrame, right: pd.DataFrame, values: np.ndarray, same: bool) -> pd.DataFrame:
    """A row for each cell of values (left x right); of a block beside itself each pair once."""
    i, j = np.triu_indices(len(left), 1) if same else (x.ravel() for x in np.indices(values.shape))
    return pd.DataFrame({"lang": lang, "a": left["source"].to_numpy()[i], "b": right["source"].to_numpy()[j], "value": values[i, j]})


def _dense_tile(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    lang, bi, bj, _ = key
    named = group["term"].isna()
    sources, cells = group[named], group[~named]
    width = len(uniques := cells["term"].unique())
    column = pd.Series(np.arange(width), index=uniques)
    side = []
    for block in dict.fromkeys((bi, bj)):
        own = sources[sources["block"] == block].reset_index(drop=True)
        line = pd.Series(np.arange(len(own)), index=own["source"].to_numpy())
        mine = cells[cells["block"] == block]
        n = np.zeros((len(own), width), np.int64)
        n[line[mine["source"].to_numpy()].to_numpy(), column[mine["term"].to_numpy()].to_numpy()] = mine["n"].to_numpy()
        base = shares(np.zeros(len(own), np.int64), own["total"], own["kept"])
        side.append((own, shares(n, own["total"].to_numpy()[:, None], own["kept"].to_numpy()[:, None]), base))
    (left, p, u), (right, q, v) = side[0], side[-1]
    absent = int(sources["terms"].max()) - width  # terms of the cut that no source of the tile holds
    values = distance(u[:, None], v[None, :]) * absent
    for i in range(len(left)):
        values[i] += distance(p[i], q).sum(axis=1)
    return _pairs_of(lang, left, right, values, bi == bj)


def _single_tile(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    lang, bi, bj, _ = key
    known = group["n"] < 0
    sources, cells = group[known], group[~known]
    blocks = []
    for block in dict.fromkeys((bi, bj)):
        own = sources[sources["block"] == block].reset_index(drop=True)
        blocks.append((own, shares(np.zeros(len(own), np.int64), own["total"], own["kept"]), {s: g for s, g in cells[cells["block"] == block].groupby("source")}))
    (left, p, left_counts), (right, q, right_counts) = blocks[0], blocks[-1]

    def corrections(own: pd.DataFrame, base: np.ndarray, counts: dict, others: np.ndarray) -> np.ndarray:
        out = np.zeros((len(own), len(others)), np.int64)
        for i, (source, total, kept) in enumerate(zip(own["source"], own["total"], own["kept"], strict=True)):
            if (mine := counts.get(source)) is not None:
                held = shares(mine["n"].to_numpy(), total, kept)
                change = distance(held[:, None], others[None, :]) - distance(base[i], others)[None, :]
                out[i] = (change * mine["times"].to_numpy()[:, None]).sum(axis=0)
        return out

    light = int(sources["light"].max()) if len(sources) else 0
    values = distance(p[:, None], q[None, :]) * light + corrections(left, p, left_counts, q) + corrections(right, q, right_counts, p).T
    return _pairs_of(lang, left, right, values, bi == bj)


def _shared_postings(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    names, code = np.unique(group["source"].to_numpy().astype(str), return_inverse=True)
    order = np.lexsort((code, pd.factorize(group["term"])[0], group["holders"].to_numpy()))
    group, code = group.iloc[order], code[order]
    p = shares(group["n"].to_numpy(), group["total"].to_numpy(), group["kept"].to_numpy())
    base = shares(np.zeros(len(group), np.int64), group["total"].to_numpy(), group["kept"].to_numpy())
    length, sums = group["holders"].to_numpy(), {}

    def gather(pairs: np.ndarray, values: np.ndarray) -> None:
        found, place = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, place.ravel(), values)
        for x, v in zip(found.tolist(), total.tolist(), strict=True):
            sums[x] = sums.get(x, 0) + v

    for k in np.unique(length):
        start, end = np.searchsorted(length, k), np.searchsorted(length, k, "right")
        step = max(1, (1 << 20) // int(k)) * int(k)
        for s in range(start, end, step):  # a strip of posting lists of one length, a matrix with one list a row
            c, x, y = (v[s : min(s + step, end)].reshape(-1, k) for v in (code, p, base))
            for i in range(int(k) - 1):
                a, u = x[:, i : i + 1], y[:, i : i + 1]
                b, w = x[:, i + 1 :], y[:, i + 1 :]
                gather((c[:, i : i + 1] * len(names) + c[:, i + 1 :]).ravel(), (distance(a, b) - distance(a, w) - distance(u, b) + distance(u, w)).ravel())
    pairs = np.array(list(sums), np.int64)
    return pd.DataFrame({"lang": key[0], "a": names[pairs // len(names)], "b": names[pairs % len(names)], "value": np.array(list(sums.values()), np.int64)})


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` ranks the other sources of the language, part `term` the top_terms terms."""
    audit = Audit(docs, min_docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = audit.pairs().withColumn("rank", rank).withColumn("part", F.lit("pair"))
    best = audit.terms().withColumn("rank", rank).where(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    out = materialize(pairs.select(columns).unionByName(best.select(columns)), "divergence")
    audit.release()
    return out


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2) // CAST(total + 2 * v AS HUGEINT) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (lang_n + 2) // CAST(lang_total + 2 * v AS HUGEINT) AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
