"""What must not grow with the tables: rows sent through the driver, and rows of one key in one task."""

import random
import re
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gavelframe.operators import names_in_texts, paging
from gavelframe.operators.ranges import range_join
from gavelframe.operators.resolve import courts, resolve_names, with_court
from gavelframe.operators.text_index import SALTS, TextIndex
from gavelframe.plans import registry
from gavelframe.sources import html

SF = "/root/testdata/sf0.001"


def planned(df) -> str:
    """The plan before anything has run."""
    return df._jdf.queryExecution().sparkPlan().toString()


def broadcast_joins(df) -> int:
    return len(re.findall("BroadcastHashJoin|BroadcastNestedLoopJoin", planned(df)))


@pytest.mark.parametrize("name", ["alias_resolve", "fuzzy_resolve"])
def test_substrings_of_names_are_not_broadcast(spark, name):
    """of the planned joins only that with the built-in names (a given list) may broadcast."""
    assert broadcast_joins(registry.QUERIES[name](spark, SF)) <= 1


def test_names_that_hold_a_common_term_meet_it_in_several_tasks(spark):
    """and the shortest of them, then the first, stays."""
    laws = spark.range(1000).select(F.col("id").alias("ordinal"), F.format_string("x%04d ring %d", "id", F.col("id") % 3).alias("law_name"), F.lit("p").alias("pcode"))
    terms = spark.createDataFrame([("ring",), ("g 2",), ("none",)], "term string")
    found = {r.term: (r.tier, r.law_name) for r in resolve_names(terms, laws).collect()}
    assert found == {"ring": (4, "x0000 ring 0"), "g 2": (4, "x0002 ring 2"), "none": (None, None)}
    assert "salt" in planned(resolve_names(terms, laws))


def test_nodes_of_ranges_are_not_broadcast(spark):
    """F2."""
    assert broadcast_joins(registry.QUERIES["events_in_windows"](spark, SF)) == 0
    points = spark.createDataFrame([(1, 5), (1, 700)], "k int, at int")
    asked = spark.createDataFrame([(1, 0, 600), (1, 0, 700), (2, 0, 9)], "k int, lo int, hi int")
    assert sorted((r.lo, r.hi, r.at) for r in range_join(points, asked, ["k"], "at", "lo", "hi").collect()) == [(0, 600, 5), (0, 700, 5), (0, 700, 700)]


def test_courts_are_found_without_a_shuffle_of_the_rows(spark):
    """a shuffle by the few heads of identifiers brings a third of all texts to a task."""
    rows = spark.createDataFrame([("TPSV,104,x",), ("TPPDP,1",), ("TPDM",), ("QQQ,1",), (None,), ("",)], "jid string")
    mine = with_court(rows)
    assert "Join" not in planned(mine) and "Exchange" not in planned(mine)
    assert sorted(map(str, mine.collect())) == sorted(map(str, with_court(rows, courts(spark)).collect()))
    assert "SortMergeJoin" not in planned(with_court(rows, courts(spark))).split("BroadcastHashJoin")[0]


def test_plain_markup_gives_the_tree_of_the_tolerant_parser(monkeypatch):
    """cut by one expression; anything unusual goes to the parser."""
    tree = lambda e: (e.tag, e.attributes, [c if isinstance(c, str) else tree(c) for c in e.children])
    bits = [
        "<td>", "</td>", "<tr>", "</tr>", "<p>", "</p>", "<br>", "<br/>", '<a href="x&amp;y">', "<a href=x>", "</a>", '<a class="b c" id="q">', "text", "&amp;", "&", "&lt", "&#65;", "<", "\n", "<!-- c -->", "<script>a<b</script>", "<TD>",
        '<a title="&copy=1">', "<li>", "</tr x>", "<title>a&amp;</title>", "é", "<table>", '<a x="1" x="2">', '<a\n y="2">', "\r", "&notit;", "<option>", "<td >", "<noscript>", '<img src="a">',
    ]
    draw = random.Random(7)
    pages = ["".join(draw.choices(bits, k=draw.randrange(9))) for _ in range(5000)]
    assert all(tree(html.dom(p)) == tree(html.tolerant_dom(p)) for p in pages)
    row = '<table class="jub-table"><tr><td>1.</td><td><a href="data.aspx?ty=JD&amp;id=X">x</a></td><td>85.1/3</td></tr></table>'
    monkeypatch.setattr(html, "tolerant_dom", None)
    assert html._hits(row)[0]["href"] == "data.aspx?ty=JD&id=X"


def test_ranges_of_a_ranked_table_do_not_grow_in_number(spark, tmp_path, monkeypatch):
    """each range sends samples and reports to the driver."""
    monkeypatch.setattr(paging, "MOST_RANGES", 4)
    ranked = paging.RankedTable(spark, str(tmp_path / "ranked"), ["-v", "k"]).build(spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")), 10)
    assert ranked.ranges().count() <= 4 and ranked.total() == 1000
    expected = sorted(((k, k % 7) for k in range(1000)), key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in ranked.page(480, 30).collect()] == expected[480:510]
    assert [tuple(r) for r in ranked.after(ranked.token(ranked.page(480, 30)), 400).collect()] == expected[510:910]


def test_one_query_does_not_gather_its_postings_or_texts(spark, tmp_path):
    """joins on a gram or a query go by salts of blocks too, and texts are never dealt by query."""
    docs = spark.range(300).select("id", F.format_string("the text %d", "id").alias("text"))
    index = TextIndex(spark, str(tmp_path / "index"))
    index.append(docs, "id", "text", "one")
    asked = spark.createDataFrame([(0, ["the", "t 1", "x"])], "query int, words array<string>")
    found = index.search_many(asked)
    assert {r.key for r in found.collect()} == {i for i in range(300) if str(i).startswith("1")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan and plan.index("(block#") < plan.index("(query#")  # the outer join is that with the texts, by block and number
    plan = index.candidates(asked)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line and ("gram#" in line or "start#" in line)]
    assert joins and all("salt#" in line for line in joins) and SALTS > 1


def test_matches_of_a_batch_leave_in_parts(monkeypatch):
    """F8: a task holds a bounded number of matches, whatever the batch."""
    monkeypatch.setattr(names_in_texts, "MATCHES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["ab " * 15, None, "abc ab"])], ["key", "text"])
    parts = list(names_in_texts._scanner(SimpleNamespace(value=["ab", "abc"]))(iter([batch])))
    assert max(p.num_rows for p in parts) == 10
    rows = pa.Table.from_batches(parts).to_pylist()
    assert [(r["key"], r["name"], r["start"]) for r in rows] == [(1, "ab", 3 * k) for k in range(15)] + [(3, "abc", 0), (3, "ab", 4)]
    assert rows[14]["after"] == " " and rows[15]["after"] == " ab"
