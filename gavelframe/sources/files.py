"""Dictionaries, histories, rulings and official feeds from JSON and ZIP files, with explicit schemas."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BUILTIN_LAWS
from ..functions.identifiers import url_parameter
from ..functions.text import strip

DICTIONARY = "version int, update_date string, law_count long, order_count long, abolished_count long, total long, pcode_map map<string,string>, abolished_set array<string>"
RULING = "case_number string, date string, issues string, petitioner string, issue_summary string, summary string, main_text string, related_statutes string, reasoning string, opinions string, source_url string"
FEED_ITEM = "LawName string, LawURL string, LawAbandonNote string, LawHistories string"


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def law_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """ordinal, law_name, pcode, abolished of a dictionary file; ordinal is the place in the file."""
    top = _whole(spark, path).select(F.from_json("value", DICTIONARY).alias("d")).select("d.pcode_map", "d.abolished_set")
    rows = top.select("abolished_set", F.posexplode(F.map_entries("pcode_map")).alias("ordinal", "e"))
    return rows.select("ordinal", F.col("e.key").alias("law_name"), F.col("e.value").alias("pcode"), F.coalesce(F.array_contains("abolished_set", F.col("e.value")), F.lit(False)).alias("abolished"))


def law_dictionary_or_builtin(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary of a file; the built-in names where the file is missing, damaged or empty."""
    try:
        rows = law_dictionary(spark, path)
        if not rows.isEmpty():
            return rows
    except AnalysisException:  # no such file
        pass
    fixed = [(i, name, code, False) for i, (name, code) in enumerate(BUILTIN_LAWS.items())]
    return spark.createDataFrame(fixed, "ordinal int, law_name string, pcode string, abolished boolean")


def dictionary_header(spark: SparkSession, path: str) -> DataFrame:
    """version, update_date and the counters of a dictionary file."""
    return _whole(spark, path).select(F.from_json("value", DICTIONARY).alias("d")).select("d.version", "d.update_date", "d.law_count", "d.order_count", "d.abolished_count", "d.total")


def law_histories(spark: SparkSession, path: str) -> DataFrame:
    """pcode, history."""
    entries = _whole(spark, path).select(F.explode(F.from_json("value", "map<string,string>")).alias("pcode", "history"))
    return entries


def rulings(spark: SparkSession, old_path: str, new_path: str) -> DataFrame:
    """One table of both systems: system, year (0 in the old one), number and all fields."""
    entries = lambda path: _whole(spark, path).select(F.explode(F.from_json("value", f"map<string,struct<{', '.join(f'{n}:{k}' for n, k in (p.split() for p in RULING.split(', ')))}>>")).alias("key", "r"))
    old = entries(old_path).select(F.lit("釋字").alias("system"), F.lit(0).cast("bigint").alias("year"), F.col("key").cast("bigint").alias("number"), "r.*")
    new = entries(new_path).select(F.lit("憲判字").alias("system"), F.split_part("key", F.lit("_"), F.lit(1)).cast("bigint").alias("year"), F.split_part("key", F.lit("_"), F.lit(2)).cast("bigint").alias("number"), "r.*")
    return old.unionByName(new).withColumn("issues", issues(F.col("issues"), F.col("issue_summary")))


def issues(old: Column, new: Column) -> Column:
    return F.coalesce(old, new, F.lit(""))


def feed(spark: SparkSession, path: str) -> DataFrame:
    """LawName, LawURL, LawAbandonNote, LawHistories of official feeds: ZIP files (their first .json) or JSON files.

    The root may be a list, an object with the list in Laws, or a single item. A feed is tens of MB; a file is read by one task.
    """
    names = [part.split()[0] for part in FEED_ITEM.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                if zipfile.is_zipfile(io.BytesIO(content)):
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        inner = [n for n in archive.namelist() if n.lower().endswith(".json")]
                        content = archive.read(inner[0]) if inner else b"[]"
                root = json.loads(content.decode("utf-8-sig"))
                items = root if isinstance(root, list) else root.get("Laws", [root])
                yield pd.DataFrame([[item.get(n) for n in names] for item in items], columns=names).astype(object)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, FEED_ITEM)


def feed_laws(items: DataFrame, kind: str) -> DataFrame:
    """kind, law_name, pcode, abolished, history of a feed's usable items."""
    pcode = F.coalesce(F.nullif(url_parameter(F.col("LawURL"), "pcode"), F.lit("")), url_parameter(F.col("LawURL"), "PCode"))
    rows = items.select(F.lit(kind).alias("kind"), F.col("LawName").alias("law_name"), pcode.alias("pcode"), (F.coalesce("LawAbandonNote", F.lit("")) == "廢").alias("abolished"), strip(F.coalesce("LawHistories", F.lit(""))).alias("history"))
    return rows.where("law_name <> '' AND pcode <> ''")


def saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id (the path) and html of a folder of saved pages."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("page_id"), F.col("value").alias("html"))
