"""Versions, ranges, as-of joins and pages on random small rows with every limit cut small, against plain Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from gavelframe.operators.asof import asof_join, attach_near, spans_of
from gavelframe.operators.paging import RankedTable
from gavelframe.operators.ranges import article_number_key, articles_in_ranges, dyadic_nodes, range_join
from gavelframe.operators.versions import as_of, changes, entries, first_timeline, timeline_of, with_law_as_of, with_version

ENTRY = "law_name string, pcode string, abolished boolean, history string"
DAY = datetime.date(2024, 1, 1)


# ------------------------------------------------------------ versions


def test_changes(spark):
    old = [("a", "1", False, None), ("b", "2", False, "h"), ("c", "3", True, None), ("d", "4", False, None), ("e", "5", None, "x"), ("f", "6", False, None), ("f2", "6", False, None), ("same", "7", None, None), (None, "8", False, None), ("g", None, False, None)]
    new = [("a", "1", True, None), ("b", "2", False, "h2"), ("c", "3", False, None), ("D", "4", False, "n"), ("e", "55", None, "x"), ("F", "6", False, None), ("same", "7", None, None), ("G", None, False, None), (None, "9", False, None)]
    found = {(r.change, r.law_name, r.old_name, r.pcode, r.old_pcode) for r in changes(spark.createDataFrame(old, ENTRY), spark.createDataFrame(new, ENTRY)).collect()}
    assert found == {
        ("abolished", "a", "a", "1", "1"), ("amended", "b", "b", "2", "2"), ("restored", "c", "c", "3", "3"), ("renamed", "D", "d", "4", "4"), ("recoded", "e", "e", "55", "5"),
        ("gone", None, "f", None, "6"), ("gone", None, "f2", None, "6"), ("added", "F", None, "6", None), ("gone", None, "g", None, None), ("added", "G", None, None, None),
    }
    assert changes(spark.createDataFrame(old, ENTRY), spark.createDataFrame(old, ENTRY)).count() == 0


def test_last_of_repeated_names_counts(spark):
    rows = spark.createDataFrame([(1, "a", "1", False, None), (3, "a", "3", True, "z"), (2, "a", "2", False, None)], f"ordinal int, {ENTRY}")
    assert [tuple(r) for r in entries(rows).collect()] == [("a", "3", True, "z")]


def test_timeline_at_once_equals_one_version_after_the_other(spark):
    rng = random.Random(5)
    versions = []
    for v in range(6):
        versions.append([(n, rng.choice("12"), rng.choice([True, False, None]), rng.choice(["h", None])) for n in "abcde" if rng.random() < 0.7] if v != 3 else [])
    dates = [DAY + datetime.timedelta(10 * v) for v in range(6)]
    # an empty version has no rows to carry its date, so that one row without a name does
    rows = [(d, *e) for d, version in zip(dates, versions, strict=True) for e in [*version, (None, None, None, None)]]
    whole = sorted(tuple(map(str, r)) for r in timeline_of(spark.createDataFrame(rows, f"version_date date, {ENTRY}")).collect())
    step = first_timeline(spark.createDataFrame(versions[0], ENTRY), F.lit(dates[0]))
    for d, version in zip(dates[1:], versions[1:], strict=True):
        step = spark.createDataFrame(with_version(step, spark.createDataFrame(version, ENTRY), F.lit(d)).collect(), step.schema)
    assert sorted(tuple(map(str, r)) for r in step.collect()) == whole
    for d, version in zip(dates, versions, strict=True):
        for shift in (0, 9):
            assert sorted(map(str, as_of(step, F.lit(d + datetime.timedelta(shift))).collect())) == sorted(map(str, spark.createDataFrame(version, ENTRY).collect()))
    asked = spark.createDataFrame([(n, dates[2]) for n in "abcdez"], "law_name string, day date")
    held = {e[0]: e[1] for e in versions[2]}
    assert {r.law_name: r.pcode for r in with_law_as_of(asked, step, "day").collect()} == {n: held.get(n) for n in "abcdez"}


# ------------------------------------------------------------ ranges


def test_dyadic_nodes_cover_each_value_once(spark):
    rng = random.Random(2)
    spans = [(lo, lo + rng.randint(-2, 90)) for lo in (rng.randint(-70, 70) for _ in range(60))]
    rows = spark.createDataFrame(spans, "lo long, hi long").select("lo", "hi", dyadic_nodes(F.col("lo"), F.col("hi")).alias("n")).collect()
    for r in rows:
        covered = [x for n in r.n for x in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(covered) == list(range(r.lo, r.hi + 1)) and len(r.n) <= 14


@pytest.mark.parametrize("cell, hot", [(1, 1), (7, 3), (1000, 2)])
def test_range_join(spark, cell, hot):
    rng = random.Random(cell)
    points = [(rng.choice(["x", "y", None]), rng.choice([None, 5, 5, 5, rng.randint(-300, 300), 10**12]), i) for i in range(150)]
    ranges = [(rng.choice(["x", "y", "z", None]), lo, None if rng.random() < 0.05 else lo + rng.randint(-5, 200), i) for i, lo in enumerate(rng.randint(-300, 300) for _ in range(60))]
    ranges += [("x", -(10**13), 10**13, 100), ("y", 5, 5, 101), ("y", 5, 5, 101)]
    found = range_join(spark.createDataFrame(points, "k string, p long, i int"), spark.createDataFrame(ranges, "k string, lo long, hi long, r int"), ["k"], "p", "lo", "hi", cell, hot)
    expected = sorted((r, i) for k, lo, hi, r in ranges for q, p, i in points if k is not None and k == q and p is not None and hi is not None and lo <= p <= hi)
    assert sorted((x.r, x.i) for x in found.collect()) == expected
    with pytest.raises(ValueError):
        range_join(spark.createDataFrame(points, "k string, p long, i int"), spark.createDataFrame(points, "k string, p long, lo int"), ["k"], "p", "lo", "p")


def test_articles_in_ranges(spark):
    numbers = ["1", "15", "15-1", "15之10", "15-9", "16", "x", "", "184", None]
    articles = spark.createDataFrame([("A", n, i) for i, n in enumerate(numbers)], "pcode string, number string, ordinal int")
    asked = spark.createDataFrame([(1, "A", "15", "16"), (2, "A", "15-9", "15-10"), (3, "A", "16", "15"), (4, "B", "1", "999"), (5, "A", "0", "0")], "range_id int, pcode string, from_no string, to_no string")
    found = {}
    for r in articles_in_ranges(articles, asked).collect():
        found.setdefault(r.range_id, set()).add(r.number)
    assert found == {1: {"15", "15-1", "15之10", "15-9", "16"}, 2: {"15-9", "15之10"}, 5: {"x", "", None}}
    keys = [r.k for r in articles.where("number IN ('15-9', '15之10', '16')").orderBy(article_number_key(F.col("number"))).select(F.col("number").alias("k")).collect()]
    assert keys == ["15-9", "15之10", "16"]


# ------------------------------------------------------------ as-of


@pytest.mark.parametrize("forward, own", [(True, False), (False, False), (False, True)])
def test_attach_near_in_small_spans(spark, forward, own):
    rng = random.Random(1)
    rows = [("hot" if i < 120 else rng.choice(["a", "b", None]), i, rng.choice([None, None, None, i])) for i in range(180)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, at int, v int")
    found = {r.at: r.near for r in attach_near(df, ["k"], ["at"], F.col("v"), "near", forward, own, span_rows=10).collect()}
    for k, at, v in rows:
        others = [(a, w) for q, a, w in rows if q == k and w is not None and ((a > at) if forward else (a < at) or (own and a == at))]
        assert found[at] == ((min(others) if forward else max(others))[1] if others else None)
    sizes = [r["count"] for r in spans_of(df, ["k"], ["at"], 10).groupBy("_span").count().collect()]
    assert max(sizes) < 40 < 120  # the hot partition is cut


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("exact", [True, False])
def test_asof_join(spark, forward, exact):
    rng = random.Random(9)
    left = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(0, 30)]), i) for i in range(60)]
    right = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(0, 30)]), 100 + i) for i in range(25)]
    found = asof_join(spark.createDataFrame(left, "k string, t int, i int"), spark.createDataFrame(right, "k string, t int, w int"), ["k"], "t", ["w"], forward, exact, span_rows=8)

    def nearest(k, t):
        fits = [(u, w) for q, u, w in right if q == k and u is not None and t is not None and ((u > t if forward else u < t) or (exact and u == t))]
        best = (min if forward else max)((u for u, _ in fits), default=None)
        return max((w for u, w in fits if u == best), default=None)

    assert {r.i: r.w for r in found.collect()} == {i: nearest(k, t) for k, t, i in left}
    assert found.columns == ["k", "t", "i", "w"]


# ------------------------------------------------------------ pages


def test_pages_read_their_ranges_only(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1.5, 2.5, rng.random()]), rng.choice(["a", "b", None]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "price double, name string, id int")
    ranked = RankedTable(spark, str(tmp_path), ["-price", "name", "id"]).build(df, 40)
    order = [F.col("price").desc(), F.col("name").asc(), F.col("id").asc()]
    expected = [tuple(r) for r in df.orderBy(*order).collect()]
    assert ranked.total() == 300 and ranked.ranges().count() >= 6
    token, seen = None, []
    for offset in range(0, 320, 80):
        assert [tuple(r) for r in ranked.page(offset, 80).collect()] == expected[offset : offset + 80]
    rows = ranked.page(0, 70)
    while seen != expected:
        got = [tuple(r) for r in rows.collect()]
        assert got
        seen += got
        token = ranked.token(rows)
        rows = ranked.after(token, 70)
    assert rows.count() == 0 and ranked.after(ranked.token(rows), 5).count() == 0
    one = ranked.page(150, 5)
    files = one.select(F.input_file_name()).distinct().count()
    assert files <= 2
    with pytest.raises(ValueError):
        ranked.page(-1)
    with pytest.raises(ValueError):
        ranked.after("no token")


def test_pages_of_an_empty_table(spark, tmp_path):
    ranked = RankedTable(spark, str(tmp_path), ["id"]).build(spark.createDataFrame([], "id int"))
    assert ranked.page(0).count() == 0 and ranked.total() == 0
