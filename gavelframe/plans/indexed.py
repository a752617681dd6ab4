"""Keyword search through an index of the documents, and names in texts by an automaton, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.names_in_texts import cited_by_name, names_in_texts
from ..operators.text_index import TextIndex
from ..session import shared_folder
from .base import query, table

WORDS = ["tion", "and the", "a"]
PHRASE_CHARS = 30


def index_of_documents(spark: SparkSession, sf_dir: str) -> TextIndex:
    index = TextIndex(spark, shared_folder(spark, "text-index"))
    index.append(table(spark, sf_dir, "documents"), "doc_id", "text", "documents")
    return index


@query("index_keyword_search", "SELECT doc_id AS key FROM documents WHERE " + " AND ".join(f"contains(text, '{w}')" for w in WORDS))
def index_keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all words must occur; one is shorter than a gram, one holds a blank."""
    asked = spark.createDataFrame([(0, WORDS)], "query int, words array<string>")
    return index_of_documents(spark, sf_dir).search_many(asked).select("key")


@query("index_passage_search", f"SELECT b.item_id AS query, d.doc_id AS key FROM benchmark b JOIN documents d ON contains(d.text, substr(b.text, 1, {PHRASE_CHARS}))")
def index_passage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold the beginning of a benchmark passage, all passages in one search."""
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), F.array(F.substring("text", 1, PHRASE_CHARS)).alias("words"))
    return index_of_documents(spark, sf_dir).search_many(asked)


#: Names to look for: the words of the benchmark's passages and their pairs, some of which begin or end inside others.
_WORDS = "SELECT unnest(list_filter(string_split_regex(text, '[^A-Za-z]+'), lambda w: length(w) >= 5)) AS law_name FROM benchmark"
_PAIRS = "SELECT unnest(regexp_extract_all(text, '[A-Za-z]{3,} [A-Za-z]{3,}')) FROM benchmark"
NAMES_SQL = f"(SELECT DISTINCT law_name FROM ({_WORDS} UNION ALL {_PAIRS}))"


def benchmark_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = table(spark, sf_dir, "benchmark")
    words = F.filter(F.split("text", "[^A-Za-z]+"), lambda w: F.length(w) >= 5)
    pairs = F.regexp_extract_all("text", F.lit("[A-Za-z]{3,} [A-Za-z]{3,}"), F.lit(0))
    return passages.select(F.explode(F.concat(words, pairs)).alias("law_name")).distinct()


@query(
    "names_in_documents",
    f"""WITH p AS (SELECT string_agg(law_name, '|' ORDER BY length(law_name) DESC, law_name) AS p FROM {NAMES_SQL}),
    m AS (SELECT doc_id, unnest(regexp_extract_all(text, p)) AS law_name FROM documents, p)
    SELECT doc_id, law_name, count(*) AS n FROM m GROUP BY ALL""",
)
def names_in_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name in every document, leftmost-longest; as an alternation with the longest names first finds them."""
    found = names_in_texts(table(spark, sf_dir, "documents"), benchmark_names(spark, sf_dir))
    return found.groupBy("doc_id", F.col("name").alias("law_name")).agg(F.count("*").alias("n"))


#: Each part is a law that the document of its number cites at its end, in a shape that depends on the part.
_CITING = """SELECT d.doc_id, d.text || coalesce(' 依' || p.p_name || CASE WHEN p.p_size % 3 = 0 THEN '第 ' || p.p_size || ' 條' WHEN p.p_size % 3 = 1 THEN '第' || p.p_size || '之1條' ELSE '（第五條）' END
  || '，' || p.p_brand || '與' || p.p_name || '第' || (p.p_size + 1) || '條第1項', '') AS text FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id"""


def citing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "doc_id")
    size = F.col("p_size")
    shape = F.when(size % 3 == 0, F.concat(F.lit("第 "), size, F.lit(" 條"))).when(size % 3 == 1, F.concat(F.lit("第"), size, F.lit("之1條"))).otherwise("（第五條）")
    end = F.concat(F.lit(" 依"), "p_name", shape, F.lit("，"), "p_brand", F.lit("與"), "p_name", F.lit("第"), size + 1, F.lit("條第1項"))
    return table(spark, sf_dir, "documents").join(part, "doc_id", "left").select("doc_id", F.concat("text", F.coalesce(end, F.lit(""))).alias("text"))


@query(
    "cited_dictionary_statutes",
    f"""WITH n AS (SELECT string_agg(p_name, '|' ORDER BY length(p_name) DESC, p_name) AS n FROM (SELECT DISTINCT p_name FROM part)), d AS ({_CITING}),
    m AS (SELECT doc_id, n, unnest(regexp_extract_all(text, '(?:' || n || ')\\s*第\\s*[0-9]{{1,4}}(?:[-之][0-9]{{1,2}})?\\s*條')) AS m FROM d, n),
    e AS (SELECT doc_id, regexp_extract(m, '^(?:' || n || ')') AS law_name, regexp_extract(m, '第\\s*([^\\s條]+)', 1) AS article FROM m)
    SELECT DISTINCT doc_id, law_name, article, law_name || '第' || article || '條' AS entry FROM e""",
)
def cited_dictionary_statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles cited by the names of a dictionary table, which no list of patterns knows."""
    return cited_by_name(citing_documents(spark, sf_dir), table(spark, sf_dir, "part").select(F.col("p_name").alias("law_name"))).drop("start")
