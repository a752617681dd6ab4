"""Streams with restarts: exactly-once upserts and the cache in state."""

import random

import pytest
from pyspark.sql import functions as F

from gavelframe.streaming.cache import cache_stream, use_rocksdb
from gavelframe.streaming.events import event_stream
from gavelframe.streaming.upsert import UpsertTable, upsert_stream

SCHEMA = "user_id long, at long, kind string"


def table(spark, path, keep="latest"):
    return UpsertTable(spark, str(path), SCHEMA, ["user_id"], ["at"], buckets=5, keep=keep)


def rows(t):
    return sorted(map(str, map(tuple, t.read().collect())))


@pytest.mark.parametrize("keep, pick", [("latest", max), ("first", min)])
def test_batches_count_once(spark, tmp_path, keep, pick):
    rng = random.Random(3)
    t = table(spark, tmp_path / "t", keep)
    assert rows(t) == [] and t.ledger() == -1
    seen = []
    for number in range(4):
        batch = [(rng.choice([None, *range(12)]), number * 10 + k, f"k{number}") for k in range(8)] if number != 2 else []
        df = spark.createDataFrame([(*b, "extra") for b in batch], f"{SCHEMA}, other string")
        assert t.merge(df, number)
        before = rows(t)
        assert not t.merge(df, number) and not t.merge(spark.createDataFrame([(1, 999, "replayed", "x")], f"{SCHEMA}, other string"), number)  # delivered again
        seen += batch
        best = {}
        for u, at, kind in seen:
            best[u] = pick(best.get(u, (at, kind)), (at, kind))
        assert rows(t) == before == sorted(str((u, *v)) for u, v in best.items())
    assert table(spark, tmp_path / "t", keep).ledger() == 3


def test_a_lost_writer_leaves_the_table_as_it_was(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.merge(spark.createDataFrame([(k, 1, "a") for k in range(10)], SCHEMA), 0)
    before = rows(t)
    fresh = spark.createDataFrame([(k, 2, "b") for k in range(3)], SCHEMA)
    # the batch's data were written, its manifest wasn't
    fresh.withColumn("_bucket", t._bucket()).write.partitionBy("_bucket").parquet(f"{tmp_path}/t/data/batch=1")
    assert rows(t) == before and t.ledger() == 0
    assert t.merge(fresh, 1) and rows(t) != before and len(rows(t)) == 10


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.merge(spark.createDataFrame([(k, 1, "a") for k in range(50)], SCHEMA), 0)
    t.merge(spark.createDataFrame([(7, 2, "b")], SCHEMA), 1)
    assert sorted(t._manifest(1).values()) == [0, 0, 0, 0, 1]


def write(spark, folder, n, events):
    schema = "user_id long, ts timestamp_ntz, value double"
    spark.createDataFrame(events, schema).coalesce(1).write.mode("append").parquet(str(folder))


def entries(spark, tmp_path, initial=None):
    stream = event_stream(spark, str(tmp_path / "events"), "user_id long, ts timestamp_ntz, value double", files_per_batch=1)
    found = UpsertTable(spark, str(tmp_path / "table"), "user_id long, cached long, latest long, hits long, value double, expired boolean", ["user_id", "cached"], ["latest", "hits", "expired"], 3)
    upsert_stream(cache_stream(stream, "user_id", "value", "ts", 3600, "1 minute", initial), found, str(tmp_path / "checkpoint")).awaitTermination()
    return sorted((r.user_id, r.cached // 60_000_000, r.latest // 60_000_000, r.hits, r.value, r.expired) for r in found.read().collect())


def test_cache_in_state_survives_a_restart(spark, tmp_path):
    import datetime

    use_rocksdb(spark)
    at = lambda m: datetime.datetime(1970, 1, 1) + datetime.timedelta(minutes=m)
    first = [(1, at(10), 1.0), (1, at(30), 2.0), (2, at(20), None), (3, None, 9.0), (1, at(31), None)]
    write(spark, tmp_path / "events", 0, first)
    initial = spark.createDataFrame([(1, 7.0, 5, 0, 5 * 60_000_000), (9, 3.0, 2, 0, 0)], "user_id long, value double, hits long, cached long, latest long")
    got = entries(spark, tmp_path, initial)
    assert (1, 0, 31, 8, None, False) in got and (2, 20, 20, 1, None, False) in got and not any(r[0] == 3 for r in got)
    # the stream ends and is started again from its checkpoint with more events: user 1 is late and again in time, user 2 comes after its entry has expired
    write(spark, tmp_path / "events", 1, [(1, at(90), 4.0), (1, at(40), 3.0), (2, at(200), 6.0)])
    write(spark, tmp_path / "events", 2, [(4, at(1000), 1.0)])
    write(spark, tmp_path / "events", 3, [(4, at(1001), 2.0)])
    got = entries(spark, tmp_path, initial)
    assert (1, 0, 90, 10, 4.0, True) in got  # told by a timer: nothing came after it
    assert (2, 20, 20, 1, None, True) in got and (2, 200, 200, 1, 6.0, True) in got
    assert (9, 0, 0, 2, 3.0, True) in got
    assert (4, 1000, 1001, 2, 2.0, False) in got and len(got) == 5


def test_replayed_stream_changes_nothing(spark, tmp_path):
    """The same files read again with a new checkpoint: the ledger refuses batches that it has."""
    for n in range(3):
        spark.createDataFrame([(k, n * 10 + k, f"n{n}") for k in range(5)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    t = table(spark, tmp_path / "t")
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    upsert_stream(stream(), t, str(tmp_path / "c1")).awaitTermination()
    before, ledger = rows(t), t.ledger()
    upsert_stream(stream(), t, str(tmp_path / "c2")).awaitTermination()
    assert rows(t) == before and t.ledger() == ledger
    assert {r.kind for r in t.read().select(F.col("kind")).collect()} == {"n2"}
