"""Every name of a dictionary in every text, by an Aho-Corasick automaton: leftmost-longest matches that don't overlap.

A text is read once whatever the number of names. How the names get to the texts depends on their size:

* Up to NAME_CHARS characters in all (counted first) they are broadcast, and each task builds one automaton.
* Beyond that, names are dealt into slices of about NAME_CHARS and texts into lots of about LOT_CHARS. Each (slice, lot) is a cogroup that builds
  the slice's automaton and reads the lot; the matches of a text from all slices then meet, and the leftmost-longest ones stay. Nothing goes through the driver.

Defined cases: null and empty texts and names give nothing; repeated names count once; each row has its own matches, repeated rows too; of matches
that overlap the one that starts first stays, of those that start together the longest; positions count characters from 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import chinese_number
from ..constants import CN_DIGITS

NAME_CHARS = 1 << 23
LOT_CHARS = 1 << 25
#: Characters after a match that its row carries.
AFTER = 40
#: Matches that a task holds before it gives them out.
MATCHES = 1 << 14
MATCH = "name string, start long, stop long, after string"


def automaton_of(names: Iterable[str]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for name in names:
        if name:
            out.add_word(name)
    out.make_automaton()
    return out


def all_matches(automaton: ahocorasick.Automaton, text: str) -> list[tuple[int, int]]:
    """(start, stop) of every match, nested and overlapping ones too."""
    return [(end + 1 - size, end + 1) for end, size in automaton.iter(text)] if len(automaton) else []


def leftmost_longest(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of spans those that stay when the first is taken, the longest of those that start with it, and all that overlap it go; and so on."""
    kept, free = [], 0
    for start, stop in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= free:
            kept.append((start, stop))
            free = stop
    return kept


def _scanner(names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(names.value)
        for batch in batches:
            at, found = [], []

            def rows() -> pa.RecordBatch:
                name, start, stop, after = zip(*found, strict=True) if found else ((), (), (), ())
                out = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(name, pa.string()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(after, pa.string())]
                at.clear()
                found.clear()
                return pa.RecordBatch.from_arrays(out, ["key", "name", "start", "stop", "after"])

            for i, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                for start, stop in leftmost_longest(all_matches(automaton, text)):
                    at.append(i)
                    found.append((text[start:stop], start, stop, text[stop : stop + AFTER]))
                    if len(found) >= MATCHES:
                        yield rows()
            yield rows()

    return run


def _slice_of(key: tuple, names: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    automaton = automaton_of(names["name"])
    rows = []
    for k, digest, times, text in zip(texts["key"], texts["digest"], texts["times"], texts["text"], strict=True):
        rows += [(k, digest, times, text[a:b], a, b, text[b : b + AFTER]) for a, b in all_matches(automaton, text)]
    return pd.DataFrame(rows, columns=["key", "digest", "times", "name", "start", "stop", "after"], dtype=object)


def _resolve(matches: pd.DataFrame) -> pd.DataFrame:
    kept = set(leftmost_longest(zip(matches["start"], matches["stop"], strict=True)))
    return matches[[s in kept for s in zip(matches["start"], matches["stop"], strict=True)]]


def names_in_texts(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", name: str = "law_name", name_chars: int = NAME_CHARS, lot_chars: int = LOT_CHARS) -> DataFrame:
    """key, name, start, stop, after (the characters that follow): the matches of the dictionary names (column name) in docs."""
    kind = docs.schema[key].dataType.simpleString()
    words = names.select(F.col(name).cast("string").alias("name")).where(F.length("name") > 0).distinct()
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where(F.length("text") > 0)
    size = words.agg(F.sum(F.length("name").cast("long"))).first()[0] or 0
    if size <= name_chars:
        shared = docs.sparkSession.sparkContext.broadcast([r[0] for r in words.collect()])
        return texts.mapInArrow(_scanner(shared), f"key {kind}, {MATCH}").withColumnRenamed("key", key)
    slices = -(-size // name_chars)
    lots = -(-(texts.agg(F.sum(F.length("text").cast("long"))).first()[0] or 1) // lot_chars)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    once = texts.groupBy("key", "text").agg(F.count("*").alias("times")).withColumn("digest", F.sha2("text", 256))
    dealt_texts = once.withColumn("lot", F.pmod(F.xxhash64("key", "digest"), F.lit(lots))).withColumn("slice", every(slices))
    dealt_names = words.withColumn("slice", F.pmod(F.xxhash64("name"), F.lit(slices))).withColumn("lot", every(lots))
    schema = f"key {kind}, digest string, times long, {MATCH}"
    found = dealt_names.groupBy("slice", "lot").cogroup(dealt_texts.groupBy("slice", "lot")).applyInPandas(_slice_of, schema)
    kept = found.groupBy("key", "digest").applyInPandas(_resolve, schema)
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(F.col("key").alias(key), "name", "start", "stop", "after")


_ARABIC = r"(?U)^\s*第\s*(\d{1,4}(?:[-之]\d{1,2})?)\s*條"
_CHINESE = rf"(?U)^\s*第\s*({CN_DIGITS}{{1,8}})\s*條(?:之({CN_DIGITS}{{1,4}}))?"


def cited_by_name(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, law_name, article, start, entry: the distinct articles cited by a dictionary name (known: law_name), at their first mention.

    Any known name counts, whatever its ending; articles in Chinese numbers are written in Arabic ones.
    """
    found = names_in_texts(docs, known, key, text)
    sub = F.regexp_extract("after", _CHINESE, 2)
    main = chinese_number(F.regexp_extract("after", _CHINESE, 1))
    chinese = F.when(main != 0, F.when(sub == "", main.cast("string")).otherwise(F.concat_ws("-", main.cast("string"), chinese_number(sub).cast("string"))))
    article = F.when(F.col("after").rlike(_ARABIC), F.regexp_extract("after", _ARABIC, 1)).when(F.col("after").rlike(_CHINESE), chinese)
    cited = found.withColumn("article", article).where("article is not null").withColumnRenamed("name", "law_name")
    entry = F.concat(F.col("law_name"), F.lit("第"), F.col("article"), F.lit("條"))
    return cited.groupBy(key, "law_name", "article").agg(F.min("start").alias("start")).withColumn("entry", entry)
