"""Archives as a data source, and functions for SQL."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from gavelframe.functions import sql
from gavelframe.sources import archive


@pytest.fixture(scope="module")
def rows(spark):
    archive.register(spark)
    return [(f"d{k % 3}/{k:03d}.html", b"x" * (k * 37 % 900) + str(k).encode()) for k in range(120)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "entry string, content binary").repartition(parts)


def read(spark, path, **options):
    return spark.read.format("archive").option("path", str(path)).options(**options).load()


def test_what_is_written_is_read_in_parts(spark, rows, tmp_path):
    frame(spark, rows).write.format("archive").mode("overwrite").option("path", str(tmp_path / "a")).save()
    for size in (1, 1000, 1 << 26):
        df = read(spark, tmp_path / "a", part_bytes=size)
        assert sorted((r.entry, bytes(r.content)) for r in df.collect()) == sorted(rows) and df.agg(F.sum("size")).first()[0] == sum(len(c) for _, c in rows)
    assert read(spark, tmp_path / "a", part_bytes=1000).rdd.getNumPartitions() > 6 > read(spark, tmp_path / "a").rdd.getNumPartitions()
    listed = read(spark, f"file://{tmp_path}/a", content="false")
    assert listed.where("content IS NULL").count() == 120


def test_conditions_leave_entries_unread(spark, rows, tmp_path):
    frame(spark, rows).write.format("archive").mode("overwrite").option("path", str(tmp_path / "a")).save()
    df = read(spark, tmp_path / "a", part_bytes=1)
    assert df.where("entry = 'd0/003.html'").rdd.getNumPartitions() == 1  # one entry, one part
    assert df.where("entry = 'd0/003.html'").count() == 1 and df.where("entry = 'none'").count() == 0
    assert df.where("startswith(entry, 'd1/') AND size > 100").count() == sum(e.startswith("d1/") and len(c) > 100 for e, c in rows)
    assert df.where("entry IN ('d0/000.html', 'd1/001.html', 'no') AND archive <> 'x'").count() == 2
    one = df.select("archive").first()[0]
    assert 0 < df.where(F.col("archive") == one).count() < 120


def test_other_archives_and_damaged_ones(spark, rows, tmp_path):
    with zipfile.ZipFile(tmp_path / "feed.ZIP", "w") as z:
        z.writestr("folder/", "")
        z.writestr("folder/a.json", "{}")
        z.writestr("a", "1")
    (tmp_path / "other.txt").write_text("no archive")
    assert sorted(r.entry for r in read(spark, tmp_path).collect()) == ["a", "folder/a.json"]
    assert [r.archive for r in read(spark, tmp_path / "feed.ZIP").where("entry = 'a'").collect()] == ["feed.ZIP"]
    os.mkdir(tmp_path / "empty")
    assert read(spark, tmp_path / "empty").count() == 0
    (tmp_path / "empty" / "bad.zip").write_bytes(b"no zip")
    with pytest.raises(Exception, match="zip"):
        read(spark, tmp_path / "empty").count()


def test_failed_writes_leave_the_archives_as_they_were(spark, rows, tmp_path):
    path = tmp_path / "a"
    frame(spark, rows[:10]).write.format("archive").mode("overwrite").option("path", str(path)).save()
    before = sorted(os.listdir(path))
    with pytest.raises(Exception, match="must not be null"):
        frame(spark, [*rows, (None, b"x")]).write.format("archive").mode("append").option("path", str(path)).save()
    assert sorted(os.listdir(path)) == before
    (path / "part-lost.zip").write_bytes(b"of a lost task")
    frame(spark, rows[10:20]).write.format("archive").mode("append").option("path", str(path)).save()
    assert read(spark, path).count() == 20 and not (path / "part-lost.zip").exists()
    frame(spark, rows[:3]).write.format("archive").mode("overwrite").option("path", str(path)).save()
    assert read(spark, path).count() == 3 and len(os.listdir(path)) <= 4
    with pytest.raises(Exception, match="entry and content"):
        spark.range(3).write.format("archive").mode("overwrite").option("path", str(path)).save()


def test_scalar_functions_equal_those_for_columns(spark):
    from gavelframe.functions.identifiers import article_key, article_order, chinese_number, parse_case_ref
    from gavelframe.plans.citations import CASE_REFS, NUMERALS

    sql.register(spark)
    numbers = spark.createDataFrame([(n,) for n in ["15", "15-10", "9之2", "附則", "", "16.5", None, "3-x", "1-2-3"]], "number string")
    at = article_order(F.col("number"))
    for mine, theirs in numbers.select(F.struct(F.expr("article_key(number)"), F.expr("article_major(number)"), F.expr("article_minor(number)")), F.struct(article_key(F.col("number")), at["major"], at["minor"])).collect():
        assert tuple(mine) == tuple(theirs)
    numerals = NUMERALS.frame(spark).select("numeral").union(spark.createDataFrame([(None,), ("",), ("x三y",), ("三四",), ("二〇",)], "numeral string"))
    assert all(r.a == r.b for r in numerals.select(F.expr("chinese_number(numeral)").alias("a"), chinese_number(F.col("numeral")).alias("b")).collect())
    refs = CASE_REFS.frame(spark).select("raw")
    ref = parse_case_ref(F.col("raw"))
    for r in refs.select(F.expr("case_system(raw)").alias("a"), F.expr("case_year(raw)").alias("b"), F.expr("case_number(raw)").alias("c"), ref.alias("r")).collect():
        assert (r.a, r.b, r.c) == (r.r.system, r.r.year, r.r.number)


def test_table_functions(spark):
    sql.register(spark)
    got = spark.sql("SELECT * FROM keyword_snippets('aXbXc', 'X', 1, 5)").collect()
    assert [tuple(r) for r in got] == [(1, "aXb..."), (3, "...bXc")]
    assert spark.sql("SELECT * FROM keyword_snippets(CAST(NULL AS STRING), 'X')").count() == 0 == spark.sql("SELECT * FROM keyword_snippets('abc', '')").count()
    for wrong in ("keyword_snippets(1, 'X')", "keyword_snippets('a', 'X', -1)"):
        with pytest.raises(Exception, match="context|text"):
            spark.sql(f"SELECT * FROM {wrong}").collect()
    docs = spark.createDataFrame([(1, "釋字第3號、釋字第 1 號"), (1, "111年憲判字第2號，釋字第1號"), (2, None), (3, "釋字第9號")], "k int, body string")
    got = spark.sql("SELECT * FROM distinct_citations(TABLE(SELECT * FROM {docs}) PARTITION BY k, 'body')".replace("BY k,", "BY (k),"), docs=docs).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 1), (1, 0, 0, 3), (1, 1, 111, 2), (3, 0, 0, 9)]
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM distinct_citations(TABLE(SELECT * FROM {docs}) PARTITION BY (k), 'text')", docs=docs).collect()
