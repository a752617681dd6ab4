"""Versions of a dictionary, range and as-of joins, and deep pages, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof_join, attach_near
from ..operators.paging import RankedTable
from ..operators.ranges import articles_in_ranges, range_join
from ..operators.versions import changes, timeline_of, with_law_as_of
from ..session import shared_folder
from .base import query, table

# ------------------------------------------------------------ versions of a dictionary

#: Two versions of a dictionary: every part is a law; later large ones are gone, cheap ones have another name, some another code, state or
#: history, and the suppliers are new.
_OLD = "SELECT p_name || ' ' || p_partkey AS law_name, 'P' || p_partkey AS pcode, p_size > 25 AS abolished, p_type AS history FROM part"
_NEW = """SELECT CASE WHEN p_retailprice % 7 < 1 THEN 'new ' ELSE '' END || p_name || ' ' || p_partkey AS law_name, CASE WHEN p_size = 3 THEN 'Q' ELSE 'P' END || p_partkey AS pcode,
  p_size > 20 AND p_size <> 30 AS abolished, CASE WHEN p_size = 7 THEN NULL ELSE p_type END AS history FROM part WHERE p_size < 48 UNION ALL SELECT s_name, 'S' || s_suppkey, FALSE, NULL FROM supplier"""
_CHANGES = f"""WITH o AS ({_OLD}), n AS ({_NEW}),
g AS (SELECT o.* FROM o WHERE law_name NOT IN (SELECT law_name FROM n)), a AS (SELECT n.* FROM n WHERE law_name NOT IN (SELECT law_name FROM o)),
r AS (SELECT g.law_name AS old_name, a.law_name, g.pcode FROM g JOIN a USING (pcode))
SELECT 'renamed' AS change, law_name, old_name, pcode, pcode AS old_pcode FROM r
UNION ALL SELECT 'gone', NULL, law_name, NULL, pcode FROM g WHERE pcode NOT IN (SELECT pcode FROM r)
UNION ALL SELECT 'added', law_name, NULL, pcode, NULL FROM a WHERE pcode NOT IN (SELECT pcode FROM r)
UNION ALL SELECT CASE WHEN o.pcode <> n.pcode THEN 'recoded' WHEN n.abolished AND NOT o.abolished THEN 'abolished' WHEN o.abolished AND NOT n.abolished THEN 'restored' ELSE 'amended' END, law_name, law_name, n.pcode, o.pcode
  FROM o JOIN n USING (law_name) WHERE o.pcode <> n.pcode OR o.abolished <> n.abolished OR o.history IS DISTINCT FROM n.history"""


def two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    name, code = F.concat("p_name", F.lit(" "), "p_partkey"), lambda letter: F.concat(letter, F.col("p_partkey"))
    old = p.select(name.alias("law_name"), code(F.lit("P")).alias("pcode"), (size > 25).alias("abolished"), F.col("p_type").alias("history"))
    renamed = F.concat(F.when(F.col("p_retailprice") % 7 < 1, "new ").otherwise(""), name)
    new = p.where(size < 48).select(
        renamed.alias("law_name"), code(F.when(size == 3, "Q").otherwise("P")).alias("pcode"), ((size > 20) & (size != 30)).alias("abolished"), F.when(size != 7, F.col("p_type")).alias("history"))
    added = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("law_name"), F.concat(F.lit("S"), "s_suppkey").alias("pcode"), F.lit(False).alias("abolished"), F.lit(None).cast("string").alias("history"))
    return old, new.unionByName(added)


@query("dictionary_changes", _CHANGES)
def dictionary_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second version changes."""
    return changes(*two_versions(spark, sf_dir))


#: A version for each month of orders: the customers with orders are in it, their code is the lowest priority, and one with a finished order is abolished.
_VERSIONS = "SELECT date_trunc('month', o_orderdate) AS version_date, o_custkey, min(o_orderpriority) AS pcode, bool_or(o_orderstatus = 'F') AS abolished FROM orders GROUP BY ALL"
_TIMELINE = f"""WITH v AS ({_VERSIONS}), d AS (SELECT version_date, row_number() OVER (ORDER BY version_date) AS n FROM (SELECT DISTINCT version_date FROM v)),
e AS (SELECT v.*, n, n - row_number() OVER (PARTITION BY o_custkey, pcode, abolished ORDER BY n) AS island FROM v JOIN d USING (version_date)),
s AS (SELECT o_custkey, pcode, abolished, min(version_date) AS valid_from, max(n) AS last FROM e GROUP BY o_custkey, pcode, abolished, island)
SELECT 'Customer ' || o_custkey AS law_name, pcode, abolished, s.valid_from, d.version_date AS valid_to FROM s LEFT JOIN d ON d.n = s.last + 1"""


def monthly_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_trunc("month", "o_orderdate")
    found = table(spark, sf_dir, "orders").groupBy(month.alias("version_date"), "o_custkey").agg(F.min("o_orderpriority").alias("pcode"), F.bool_or(F.col("o_orderstatus") == "F").alias("abolished"))
    return found.select("version_date", F.concat(F.lit("Customer "), "o_custkey").alias("law_name"), "pcode", "abolished", F.lit(None).cast("string").alias("history"))


@query("dictionary_timeline", _TIMELINE)
def dictionary_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From which version until which each entry held."""
    return timeline_of(monthly_versions(spark, sf_dir)).drop("history")


@query(
    "law_as_of_order",
    f"""WITH t AS ({_TIMELINE}) SELECT o_orderkey, pcode, abolished FROM orders LEFT JOIN t
    ON law_name = 'Customer ' || o_custkey AND valid_from <= o_orderdate AND coalesce(valid_to > o_orderdate, TRUE)""",
)
def law_as_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry that held when an order was placed."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Customer "), "o_custkey").alias("law_name"), "o_orderdate")
    return with_law_as_of(rows, timeline_of(monthly_versions(spark, sf_dir)), "o_orderdate").select("o_orderkey", "pcode", "abolished")


# ------------------------------------------------------------ ranges

#: Items are articles, numbered by supplier and line, of the law of their flag; suppliers ask for ranges, some of them empty.
_ARTICLES = "SELECT l_returnflag AS pcode, l_suppkey || CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '之' END || l_linenumber AS number, l_suppkey AS major, l_linenumber AS minor, l_quantity FROM lineitem"
_RANGES = """SELECT s_suppkey AS range_id, CASE s_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS pcode, s_suppkey AS from_major, 2 AS from_minor,
  s_suppkey + s_nationkey % 4 - 1 AS to_major, s_nationkey % 7 AS to_minor FROM supplier"""


@query(
    "articles_in_ranges",
    f"""SELECT range_id, count(*) AS articles, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM ({_RANGES}) r JOIN ({_ARTICLES}) a ON a.pcode = r.pcode
    AND (major > from_major OR major = from_major AND minor >= from_minor) AND (major < to_major OR major = to_major AND minor <= to_minor) GROUP BY range_id""",
)
def articles_in_ranges_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of ranges against a table of articles."""
    line = F.col("l_linenumber")
    number = F.concat("l_suppkey", F.when(line % 2 == 0, "-").otherwise("之"), line)
    articles = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("pcode"), number.alias("number"), "l_quantity")
    nation = F.col("s_nationkey")
    ranges = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("range_id"), F.when(nation % 3 == 0, "A").when(nation % 3 == 1, "N").otherwise("R").alias("pcode"),
        F.concat("s_suppkey", F.lit("-2")).alias("from_no"), F.concat((F.col("s_suppkey") + nation % 4 - 1).cast("string"), F.lit("之"), nation % 7).alias("to_no"))
    return articles_in_ranges(articles, ranges).groupBy("range_id").agg(F.count("*").alias("articles"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query(
    "events_in_windows",
    """WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS at FROM events)
    SELECT a.event_id, count(*) AS events, min(b.event_id) AS first_event FROM e a JOIN e b ON a.user_id = b.user_id AND b.at BETWEEN a.at - 3600 * (a.event_id % 5) * (a.event_id % 97) AND a.at GROUP BY a.event_id""",
)
def events_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user did in a window before each event, of some hours up to weeks."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"))
    number = F.col("event_id")
    asked = events.select("user_id", number.alias("asked"), (F.col("at") - 3600 * (number % 5) * (number % 97)).alias("lo"), F.col("at").alias("hi"))
    return range_join(events, asked, ["user_id"], "at", "lo", "hi", cell=7200).groupBy(F.col("asked").alias("event_id")).agg(F.count("*").alias("events"), F.min("event_id").alias("first_event"))


# ------------------------------------------------------------ as-of


@query("next_assistant_turn", "SELECT conv_id, turn, role, first_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_assistant FROM conversations")
def next_assistant_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As heading_attach, with conversations of any length cut into spans."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return attach_near(rows, ["conv_id"], ["turn"], F.when(F.col("role") == "assistant", F.col("turn")), "next_assistant", span_rows=1000)


_KINDS = "WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, max(event_id) AS seen FROM events WHERE event_type = 'view' GROUP BY ALL)"


def _asof(spark: SparkSession, sf_dir: str, forward: bool) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    seen = events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("seen"))
    return asof_join(events.where("event_type = 'purchase'").drop("event_type"), seen, ["user_id"], "ts", ["seen"], forward, span_rows=1000)


@query("last_view_before_purchase", f"{_KINDS} SELECT p.user_id, p.ts, p.event_id, v.seen FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND v.ts <= p.ts")
def last_view_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join backwards."""
    return _asof(spark, sf_dir, False)


@query("next_view_after_purchase", f"{_KINDS} SELECT p.user_id, p.ts, p.event_id, v.seen FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND v.ts >= p.ts")
def next_view_after_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join forwards."""
    return _asof(spark, sf_dir, True)


# ------------------------------------------------------------ deep pages

_ORDER = ["-l_extendedprice", "l_orderkey", "l_linenumber"]
_DEEP = "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 50 OFFSET"


def ranked_items(spark: SparkSession, sf_dir: str) -> RankedTable:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return RankedTable(spark, shared_folder(spark, "ranked"), _ORDER).build(rows, 5000)


@query("deep_page", f"{_DEEP} (SELECT 50 * (count(*) // 100) FROM lineitem)")
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the page in the middle of all items."""
    ranked = ranked_items(spark, sf_dir)
    return ranked.page(50 * (ranked.total() // 100))


@query("deep_page_continued", f"{_DEEP} (SELECT 50 * (count(*) // 100) + 50 FROM lineitem)")
def deep_page_continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the page after it, by the continuation token."""
    ranked = ranked_items(spark, sf_dir)
    return ranked.after(ranked.token(ranked.page(50 * (ranked.total() // 100))))
