"""Streaming counterparts of the cache's mechanics: seen-key dedup, expiry, latest state. Event times are cast to TIMESTAMP for watermarks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema: str, at: str = "ts", files_per_batch: int = 16) -> DataFrame:
    """A stream over a folder of Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path).withColumn(at, F.col(at).cast("timestamp"))


def seen_once(events: DataFrame, key: list[str], at: str = "ts", within: str = "1 day") -> DataFrame:
    """The first event of each key; state is dropped once the watermark has passed it by within."""
    return events.withWatermark(at, within).dropDuplicatesWithinWatermark(key)


def windowed_counts(events: DataFrame, by: list[str], at: str = "ts", size: str = "1 day", late: str = "1 hour") -> DataFrame:
    """window_start, by, n: counts of tumbling windows; later events than late are dropped."""
    counts = events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *by).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), *by, "n")


def session_counts(events: DataFrame, by: list[str], at: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    counts = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def cached_with_expiry(events: DataFrame, key: str, value: str, at: str, ttl_seconds: int) -> DataFrame:
    """key, value, hits, expired: the cached value of each key, counted, and given out as expired when its time is over.

    The value is that of the latest event by its time, null if that event has none; events without a time are left out.
    Events come with a watermark on at; a key without events for ttl_seconds of event time leaves the state.
    """

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield pd.DataFrame({key: [k[0]], "value": [held[0]], "hits": [held[1]], "expired": [True]})
            return
        last, hits, latest = state.get if state.exists else (None, 0, -1)
        for batch in batches:
            hits += len(batch)
            newest = batch.sort_values(at, kind="stable").iloc[-1]
            written = int(newest[at].timestamp() * 1000)
            if written >= latest:  # an event that comes late doesn't overwrite a newer one
                last, latest = None if pd.isna(newest[value]) else float(newest[value]), written
        state.update((last, hits, latest))
        state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + ttl_seconds * 1000)
        yield pd.DataFrame({key: [k[0]], "value": [last], "hits": [hits], "expired": [False]})

    kind = events.schema[key].dataType.simpleString()
    rows = events.where(F.col(at).isNotNull()).select(key, at, F.col(value).cast("double").alias(value))
    return rows.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, value double, hits long, expired boolean", "value double, hits long, latest long", "append", GroupStateTimeout.EventTimeTimeout)
