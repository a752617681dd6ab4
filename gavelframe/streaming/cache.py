"""A cache with expiry as the state of a stream: transformWithState with value state, event-time timers and an initial state.

Each key holds the value of its latest event, when that was and how often the key was asked for since it was cached. An entry expires ttl seconds after its latest
event. Whether it has is decided by event times: an event that comes later than that finds the entry gone and begins a new one with one hit. Timers tell of
the expiry of keys that get no further events once the watermark has passed it. Entries of an older cache come in as initial state.

Defined cases: events without a time are left out; an event older than the entry counts as a hit and doesn't overwrite it; of events at one time the greatest value counts, null the least;
null keys are a key; after a restart from its checkpoint the stream goes on with what it had.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "value double, hits long, cached long, latest long"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that transformWithState needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class ExpiringCache(StatefulProcessor):
    """Times are microseconds. Gives key, value, hits, cached (the entry's first event), latest, expired: an entry as it is after a batch, or for the last time when it has expired."""

    def __init__(self, key: str, ttl_seconds: int) -> None:
        self.key, self.ttl = key, ttl_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", STATE)

    def _row(self, key: tuple, entry: tuple, expired: bool) -> dict:
        return {self.key: key[0], "value": entry[0], "hits": entry[1], "cached": entry[2], "latest": entry[3], "expired": expired}

    def _frame(self, rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[self.key, "value", "hits", "cached", "latest", "expired"])

    def _due(self, entry: tuple) -> int:
        """The timer of an entry, in milliseconds: the first at which it has expired."""
        return (entry[3] + self.ttl) // 1000 + 1

    def _keep(self, entry: tuple) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.entry.update(entry)
        self.handle.registerTimer(self._due(entry))

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        first = initialState.iloc[0]
        self._keep((None if pd.isna(first["value"]) else float(first["value"]), int(first["hits"]), int(first["cached"]), int(first["latest"])))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        entry = self.entry.get() if self.entry.exists() else None
        events = sorted((int(at), value is not None, value or 0.0) for batch in rows for at, value in zip(batch["at"], (None if pd.isna(v) else float(v) for v in batch["value"]), strict=True))
        out = []
        for at, given, number in events:
            value = number if given else None
            if entry is not None and at - entry[3] > self.ttl:
                out.append(self._row(key, entry, True))
                entry = None
            if entry is None:
                entry = (value, 1, at, at)
            else:
                newer = at >= entry[3]
                entry = (value if newer else entry[0], entry[1] + 1, min(entry[2], at), max(entry[3], at))
        self._keep(entry)
        yield self._frame([*out, self._row(key, entry, False)])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.entry.exists():
            entry = self.entry.get()
            if self._due(entry) <= timerValues.getCurrentWatermarkInMs():
                self.entry.clear()
                yield self._frame([self._row(key, entry, True)])

    def close(self) -> None:
        pass


def cache_stream(events: DataFrame, key: str, value: str, at: str, ttl_seconds: int, late: str = "1 hour", initial: DataFrame | None = None) -> DataFrame:
    """The cache of a stream of events; initial: key, value, hits, cached, latest (microseconds) of entries from before, one for each key."""
    kind = events.schema[key].dataType.simpleString()
    timed = events.where(F.col(at).isNotNull()).withWatermark(at, late)
    rows = timed.select(F.col(key), F.col(at), F.unix_micros(at).alias("at"), F.col(value).cast("double").alias("value"))
    schema = f"{key} {kind}, value double, hits long, cached long, latest long, expired boolean"
    start = None if initial is None else initial.select(key, F.col("value").cast("double").alias("value"), "hits", "cached", "latest").groupBy(key)
    return rows.groupBy(key).transformWithStateInPandas(ExpiringCache(key, ttl_seconds), schema, "Update", "EventTime", start)
