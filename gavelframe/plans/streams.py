"""Streams over the given events, run until everything is read; their results equal those of SQL on the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming.cache import cache_stream, use_rocksdb
from ..streaming.events import event_stream
from ..streaming.upsert import UpsertTable, upsert_stream
from .base import query

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
TTL = 6 * 3600


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_stream(spark, f"{sf_dir}/events.parque[t]", EVENTS)  # a pattern may be a file or a folder


@query("stream_upsert_latest", "SELECT user_id, event_type, max_by(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, max_by(value, (ts, event_id)) AS value FROM events GROUP BY user_id, event_type")
def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, ST4: the latest event of each user and type, brought into a table batch by batch."""
    found = UpsertTable(spark, shared_folder(spark, "upserts"), "user_id long, event_type string, ts timestamp, event_id long, value double", ["user_id", "event_type"], ["ts", "event_id"])
    upsert_stream(_stream(spark, sf_dir), found, shared_folder(spark, "upsert-checkpoint")).awaitTermination()
    return found.read().select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query(
    "stream_cache_entries",
    f"""WITH e AS (SELECT user_id, epoch_us(ts) AS us, value FROM events), g AS (SELECT *, coalesce(us - lag(us) OVER (PARTITION BY user_id ORDER BY us) > {TTL}::BIGINT * 1000000, TRUE) AS begins FROM e),
    s AS (SELECT *, sum(begins::INT) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS entry FROM g)
    SELECT user_id, min(us) AS cached, max(us) AS latest, count(*) AS hits, max_by(value, us) AS value FROM s GROUP BY user_id, entry""",
)
def stream_cache_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, K3: every entry that the cache held, with its hits; a user's entry ends when no event follows within six hours."""
    use_rocksdb(spark)
    entries = cache_stream(_stream(spark, sf_dir), "user_id", "value", "ts", TTL)
    found = UpsertTable(spark, shared_folder(spark, "entries"), "user_id long, cached long, latest long, hits long, value double", ["user_id", "cached"], ["latest", "hits"])
    upsert_stream(entries, found, shared_folder(spark, "cache-checkpoint")).awaitTermination()
    return found.read()
