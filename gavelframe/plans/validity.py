"""Queries on time and refresh: expiry, staleness, calendars, upserts, hit counts, dictionary guards, streams as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import from_roc, is_stale, is_valid, latest_saturday, to_roc
from ..operators.refresh import counters, guard, merged
from ..operators.search import latest
from ..sources.files import FEED_ITEM, feed_laws
from .base import Fixture, query, table

NOW = "2024-01-20 00:00:00"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("ttl_valid", f"SELECT event_id FROM events WHERE ts + INTERVAL 7 DAY >= TIMESTAMP '{NOW}'")
def ttl_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of seven days that still hold; the bound is on the stored column, so that it reaches the scan."""
    bound = F.lit(NOW).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS")
    return table(spark, sf_dir, "events").where(F.col("ts") >= bound).select("event_id")


EXPIRIES = Fixture("k string, expires_at string", [("a", "2024-01-20T00:00:00"), ("b", "2024-01-19 23:59:59"), ("c", "9999-12-31T23:59:59"), ("d", "soon"), ("e", None), ("f", "2025-01-01")])


@query("ttl_parse", f"SELECT k, coalesce(starts_with(expires_at, '9999') OR TIMESTAMP '{NOW}' <= try_cast(expires_at AS TIMESTAMP), false) AS valid FROM {EXPIRIES.sql}")
def ttl_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EXPIRIES.frame(spark).select("k", is_valid(F.col("expires_at"), F.lit(NOW).cast("timestamp")).alias("valid"))


@query("expires_at", "SELECT event_id, ts + INTERVAL 86400 SECOND AS expires_at FROM events")
def expires_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", (F.col("ts") + F.expr("INTERVAL 86400 SECONDS")).alias("expires_at"))


_SATURDAY = "CAST(CAST(ts AS DATE) - CAST((isodow(ts) + 1) % 7 AS INTEGER) - CASE WHEN isodow(ts) = 6 AND hour(ts) < 6 THEN 7 ELSE 0 END AS DATE)"


@query("stale_before_saturday", f"SELECT event_id, {_SATURDAY} AS saturday, DATE '2024-01-13' < {_SATURDAY} AS stale FROM events")
def stale_before_saturday(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", latest_saturday(now).alias("saturday"), is_stale(F.lit("2024-01-13"), now).alias("stale"))


UPDATES = Fixture("update_date string", [("2024-01-20",), ("2024-01-13",), ("2024/1/20 上午 12:00:00",), ("2024/1/12",), ("",), ("bad",), (None,)])


@query("stale_formats", "SELECT * FROM (VALUES ('2024-01-20', false), ('2024-01-13', true), ('2024/1/20 上午 12:00:00', false), ('2024/1/12', true), ('', true), ('bad', true), (NULL, true)) v(update_date, stale)")
def stale_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UPDATES.frame(spark).select("update_date", is_stale(F.col("update_date"), F.lit("2024-01-21 12:00:00").cast("timestamp")).alias("stale"))


@query("roc_date", "SELECT o_orderkey, lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 3, '0') || strftime(o_orderdate, '-%m-%d') AS roc, CAST(o_orderdate AS DATE) AS back FROM orders")
def roc_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", to_roc(F.col("o_orderdate")).alias("roc"))
    return rows.withColumn("back", from_roc(F.col("roc")))


@query("cache_upsert_latest", "SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def cache_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], ["event_id"])


@query("hit_counts", f"SELECT user_id, count(*) AS hits FROM events WHERE ts + INTERVAL 7 DAY >= TIMESTAMP '{NOW}' GROUP BY user_id")
def hit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = F.lit(NOW).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS")
    return table(spark, sf_dir, "events").where(F.col("ts") >= bound).groupBy("user_id").agg(F.count("*").alias("hits"))


_JUNK = Fixture("name string", [("click",), ("error",)])


@query("invalid_purge", f"""SELECT event_id FROM events WHERE event_type NOT IN (SELECT name FROM {_JUNK.sql}) AND json_valid(props) AND json_extract_string(props, '$.k') IS NOT NULL""")
def invalid_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached rows without junk names and broken JSON."""
    rows = table(spark, sf_dir, "events").where(F.get_json_object("props", "$.k").isNotNull())
    return rows.join(_JUNK.frame(spark).select(F.col("name").alias("event_type")), "event_type", "left_anti").select("event_id")


@query("refresh_guard", "SELECT count(*) AS law_count, 0 AS order_count, count(DISTINCT p_name) AS total, count(DISTINCT CASE WHEN p_size > 25 THEN p_brand END) AS abolished_count, CASE WHEN count(DISTINCT p_name) < 60 THEN 'too_few' WHEN count(DISTINCT CASE WHEN p_size > 25 THEN p_brand END) > count(DISTINCT p_name) * 0.5 THEN 'too_many_abolished' END AS refused FROM part")
def refresh_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "part").select(F.lit("law").alias("kind"), F.col("p_name").alias("law_name"), F.col("p_brand").alias("pcode"), (F.col("p_size") > 25).alias("abolished"))
    rows = counters(items)
    return rows.withColumn("refused", guard(F.col("total"), F.col("abolished_count"), 60)).select("law_count", "order_count", "total", "abolished_count", "refused")


FEED = [
    ("民法", "https://law.moj.gov.tw/LawClass/LawAll.aspx?pcode=B0000001", "", " 沿革 "), ("舊法", "https://law.moj.gov.tw/LawClass/LawAll.aspx?PCode=B0000009", "廢", ""), ("", "x?pcode=Q", "", ""), ("無碼", "x", "", None),
]
ORDERS = [("民法", "https://law.moj.gov.tw/LawClass/LawAll.aspx?pcode=B0000099", "", ""), ("規則", "https://law.moj.gov.tw/LawClass/LawAll.aspx?a=1&pcode=R1", None, "")]


@query("refresh_merge", "SELECT * FROM (VALUES ('民法', 'B0000099', false), ('舊法', 'B0000009', true), ('規則', 'R1', false)) v(law_name, pcode, abolished)")
def refresh_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as one dictionary; of equal names the later one holds."""
    sides = []
    for rows, kind in ((FEED, "law"), (ORDERS, "order")):
        items = feed_laws(spark.createDataFrame(rows, FEED_ITEM), kind)
        sides.append(items.withColumn("ordinal", F.monotonically_increasing_id()))
    return merged(*sides).select("law_name", "pcode", "abolished")


@query("daily_windows", "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming window count, on the table as a batch."""
    from ..streaming.events import windowed_counts

    rows = windowed_counts(_events(spark, sf_dir), ["event_type"])
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
