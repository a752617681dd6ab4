"""Training-order materialisation: token ids in fixed-stride binary shards, in a keyed global order.

Texts are tokenised in the order of (doc_id, hash of the text) and joined, an end id after each, into sequences of a
fixed number of ids; the last sequence of all is filled up with end ids. Sequences are numbered 0..N-1 and a keyed
Feistel permutation of the next power of four, walked along its cycle until it falls below N, gives each its
slot. The order depends on the rows and the key alone, not on files, partitions or the cluster.

Range partitions of the slots are the shards, one file each: a record is the slot (8 bytes), the sequence's ids (unsigned
integers of ID_BYTES or, for larger vocabularies, 4 bytes; all little-endian) and one closing byte, so that slot s stands in
shard s // shard_rows from byte (s % shard_rows) * stride on, and a run resumes at any slot by reading on from there.
Shards are written by Spark's text writer, whose lines are the raw bytes: its commit protocol leaves a whole
file or none when an executor is lost.

1. Texts are range-partitioned by (doc_id, hash), tokenised in that order and written with their place in the
   partition, their ids apart in chunks of a sequence's length from the partition's first id on; the partitions'
   first places are sums over a table of one row per partition, in two steps.
2. Each chunk is cut where a sequence ends in it, once at most; the cuts go to the partition of their slot's shard,
   sorted by slot and place, and are joined to records there. No sequence or text is gathered anywhere else. This is
   done for one of PASSES ranges of shards after the other, so that the shuffle of one is gone before the next begins.
   Spark cuts the chunks by itself: of the passes over all ids, Python sees the sequences' numbers only.

Defined cases: a null text counts as empty and adds one end id; a null doc_id is kept as a null in doc_ids and
comes first; repeated rows are kept, each with its ids; a very long text fills as many sequences as it needs; an
empty table gives no sequences and no shard; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ARROW_ROWS, arrow_rows, collect_shuffles, materialize, release, scratch_dir, table, text_or_empty
from .packing import worker_tokenizer

SEQUENCE_IDS = 1024
SHARD_ROWS = 16_384
ROUNDS = 6
KEY = "epoch-0"
END_ID = 50_256
#: Bytes of an id where all ids fit in them.
ID_BYTES = 2
#: Bytes before a record's ids: its slot.
HEAD = 8
#: Partitions whose sizes are summed together first, and ranges of shards that are written one after the other.
SPAN, PASSES = 1024, 4
#: Bytes of chunks or records in an Arrow batch, and how many at most.
BATCH_BYTES, BATCH_ROWS = 1 << 23, 4096


def feistel(x: np.ndarray, half_bits: int, keys: np.ndarray) -> np.ndarray:
    """A balanced Feistel network: a permutation of [0, 4^half_bits)."""
    mask = np.uint64((1 << half_bits) - 1)
    left, right = x >> np.uint64(half_bits), x & mask
    for key in keys:
        h = (right + key) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        left, right = right, left ^ (h & mask)
    return left << np.uint64(half_bits) | right


def slots(index: np.ndarray, total: int, key: str = KEY) -> np.ndarray:
    """Slot of each index below total, a permutation of [0, total) chosen by key (cycle-walking)."""
    half_bits = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    seed = hashlib.sha256(key.encode()).digest()
    keys = np.frombuffer(b"".join(hashlib.sha256(seed + bytes([k])).digest()[:8] for k in range(ROUNDS)), "<u8")
    at = feistel(index.astype(np.uint64), half_bits, keys)
    while len(over := np.flatnonzero(at >= np.uint64(total))):
        at[over] = feistel(at[over], half_bits, keys)
    return at.astype(np.int64)


def id_bytes(path: str, end_id: int = END_ID) -> int:
    """Bytes that an id of the tokenizer file needs: ID_BYTES or 4."""
    from tokenizers import Tokenizer

    largest = max(end_id, *Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())
    return ID_BYTES if largest < 1 << (8 * ID_BYTES) else 4


def batch_rows(size: int) -> int:
    """Rows of an Arrow batch of chunks or records of so many bytes each."""
    return max(1, min(BATCH_ROWS, BATCH_BYTES // size))


def grouped(pattern: str) -> str:
    """The same pattern, its alternatives before the look-ahead in one group, which tiktoken's regular expressions match in one go."""
    head, ahead, tail = pattern.partition(r"|\s+(?!\S)")
    return f"(?:{head}){ahead}{tail}" if ahead else pattern


def tokenised(docs: DataFrame, path: str, pattern: str, end_id: int = END_ID, length: int = SEQUENCE_IDS) -> DataFrame:
    """Two kinds of rows, with first (place of the first id among the ids of all texts) and n (ids).

    Every text, end id included, with its doc_id; and, where chunk is true, chunks of at most length ids with the ids (binary).
    """
    width = id_bytes(path, end_id)
    end = np.array([end_id], "<u4").tobytes()
    step, most = length * width, batch_rows(length * width)
    names, kinds = ["part", "chunk", "doc_id", "start", "n", "ids"], (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, place, cut, left = worker_tokenizer(path, grouped(pattern)), TaskContext.get().partitionId(), 0, 0, b""

        def batch_of(chunk: bool, doc_ids: pa.Array, starts: np.ndarray, n: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
            columns = (np.full(len(n), part), np.full(len(n), chunk), doc_ids, starts, n, ids)
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        def chunks(blob: bytes) -> Iterator[pa.RecordBatch]:
            nonlocal cut
            for at in range(0, len(blob), step * most):
                held = [blob[x : x + step] for x in range(at, min(at + step * most, len(blob)), step)]
                n = np.array([len(x) // width for x in held], np.int64)
                yield batch_of(True, pa.nulls(len(n), pa.int64()), cut + np.cumsum(n) - n, n, pa.array(held, pa.binary()))
                cut += int(n.sum())

        for batch in batches:
            ids = [encoder(t or "") + end for t in batch.column("text").to_pylist()]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            yield batch_of(False, batch.column("doc_id"), place + np.cumsum(n) - n, n, pa.nulls(len(n), pa.binary()))
            place += int(n.sum())
            left += np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes()
            whole = len(left) // step * step
            yield from chunks(left[:whole])
            left = left[whole:]
        yield from chunks(left)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # equal rows are interchangeable, so that a number of any kind may part them
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("any", F.monotonically_increasing_id())
    order = ["doc_id", "tie", "text"]
    rows = rows.repartitionByRange("doc_id", "tie", "any").sortWithinPartitions(*order).select("doc_id", "text")
    found = materialize(rows.mapInArrow(run, "part long, chunk boolean, doc_id long, start long, n long, ids binary"), "ids", ARROW_ROWS)
    collect_shuffles(docs.sparkSession)
    sizes = found.where("NOT chunk").groupBy("part").agg(F.sum("n").alias("size")).withColumn("span", F.floor(F.col("part") / SPAN))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.groupBy("span").agg(F.sum("size").alias("size")).select("span", F.coalesce(F.sum("size").over(before().orderBy("span")), F.lit(0)).alias("span_first"))  # a row per SPAN partitions
    firsts = sizes.join(spans, "span").select("part", (F.col("span_first") + F.coalesce(F.sum("size").over(before("span").orderBy("part")), F.lit(0))).alias("part_first"))
    out = found.join(materialize(firsts, "firsts"), "part").select("chunk", "doc_id", (F.col("part_first") + F.col("start")).alias("first"), "n", "ids")
    out._gf_ids = found
    return out


def _slot_of(total: int, key: str):
    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(slots(number.to_numpy(np.int64), total, key))

    return slot


class Order:
    """The sequences of documents in training order. docs: doc_id and text."""

    def __init__(self, docs: DataFrame, path: str, pattern: str, key: str = KEY, length: int = SEQUENCE_IDS, shard_rows: int = SHARD_ROWS, end_id: int = END_ID) -> None:
        self.key, self.length, self.shard_rows, self.end_id = key, length, shard_rows, end_id
        self.found = tokenised(docs, path, pattern, end_id, length)
        self.rows, self.chunks = self.found.where("NOT chunk").select("doc_id", "first", "n"), self.found.where("chunk").select("first", "n", "ids")
        self.width = id_bytes(path, end_id)
        self.total = -(-(self.rows.agg(F.sum("n")).first()[0] or 0) // length)
        self.stride = HEAD + length * self.width + 1

    def contents(self) -> DataFrame:
        """slot, shard, byte_offset, doc_ids (of each text that has ids there, in order) and n_ids before the filling."""
        cuts = F.sequence(F.floor(F.col("first") / self.length), F.floor((F.col("first") + F.col("n") - 1) / self.length))
        held = self.rows.select("doc_id", "first", "n", F.explode(cuts).alias("number"))
        begin = F.greatest("first", F.col("number") * self.length)
        held = held.select("number", "doc_id", begin.alias("begin"), (F.least(F.col("first") + F.col("n"), (F.col("number") + 1) * self.length) - begin).alias("n"))
        one = held.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("begin", "doc_id"))).alias("d"), F.sum("n").cast("int").alias("n_ids"))  # a sequence's length at most
        slot = F.col("slot")
        placed = one.withColumn("slot", _slot_of(self.total, self.key)(F.col("number")))
        return placed.select("slot", F.floor(slot / self.shard_rows).cast("int").alias("shard"), (F.pmod(slot, F.lit(self.shard_rows)) * self.stride).alias("byte_offset"), F.col("d.doc_id").alias("doc_ids"), "n_ids")

    def records(self, first: int, last: int) -> DataFrame:
        """shard and record of the shards from first to before last: a partition per shard, in the order of its slots."""
        length, width, end_id = self.length, self.width, self.end_id

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now: tuple[int, int] | None = None  # slot and shard
            held: list[bytes] = []

            def record() -> bytes:
                body = b"".join(held)
                return now[0].to_bytes(HEAD, "little") + body + np.full(length - len(body) // width, end_id, f"<u{width}").tobytes()

            for batch in batches:
                shards, records = [], []
                for slot, shard, part in zip(*(batch.column(c).to_pylist() for c in ("slot", "shard", "part")), strict=True):
                    if now is not None and now[0] != slot:
                        shards.append(now[1])
                        records.append(record())
                        held = []
                    now = slot, shard
                    held.append(part)
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(records, pa.binary())], ["shard", "record"])
            if now is not None:
                yield pa.RecordBatch.from_arrays([pa.array([now[1]], pa.int32()), pa.array([record()], pa.binary())], ["shard", "record"])

        # a chunk is no longer than a sequence, hence has a part in two at most
        room = F.lit(length) - F.col("place")
        one = F.struct(F.col("number"), F.col("place"), F.substring("ids", F.lit(1), (room * width).cast("int")).alias("part"))
        two = F.struct((F.col("number") + 1).alias("number"), F.lit(0).cast("long").alias("place"), F.substring("ids", (room * width + 1).cast("int"), F.lit(length * width)).alias("part"))
        begun = self.chunks.select(F.expr(f"first div {length}").alias("number"), F.pmod("first", F.lit(length)).alias("place"), "n", "ids")
        cuts = begun.select(F.inline(F.when(F.col("n") > room, F.array(one, two)).otherwise(F.array(one))))
        # not deterministic for the optimizer, which would otherwise work out the slots of the filter and those of the result apart
        cuts = cuts.withColumn("slot", _slot_of(self.total, self.key).asNondeterministic()("number"))
        cuts = cuts.withColumn("shard", F.expr(f"slot div {self.shard_rows}").cast("int")).where((F.col("shard") >= first) & (F.col("shard") < last))
        dealt = cuts.repartitionById(max(1, last - first), F.col("shard") - first).sortWithinPartitions("slot", "place")
        return dealt.select("slot", "shard", "part").mapInArrow(join, "shard int, record binary")

    def write_shards(self, path: str) -> None:
        """A folder shard=K with one file of fixed-stride records for each shard."""
        spark = self.rows.sparkSession
        shards = -(-self.total // self.shard_rows)
        bounds = [shards * k // PASSES for k in range(PASSES + 1)]
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            if first < last:
                lines = self.records(first, last).select(F.col("record").cast("string").alias("value"), "shard")  # the bytes as they are
                with arrow_rows(spark, batch_rows(self.stride)):
                    lines.write.mode("append").option("lineSep", "\n").partitionBy("shard").text(path)
                collect_shuffles(spark)


def read_from(spark: SparkSession, path: str, slot: int = 0, stride: int = HEAD + SEQUENCE_IDS * ID_BYTES + 1, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """slot, shard, byte_offset and payload of the rest of the order from a slot on; earlier shards are not opened.

    Files are split between records, whatever their size.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    shards = sorted(k for k in (int(name.partition("=")[2]) for name in (f.getPath().getName() for f in found) if name.startswith("shard=")) if k >= slot // shard_rows)
    schema = "slot long, shard int, byte_offset long, payload binary"
    if not shards:
        return spark.createDataFrame([], schema)

    def rows(records: Iterator[bytes]) -> Iterator[tuple[int, int, int, bytearray]]:
        for record in records:
            at = int.from_bytes(record[:HEAD], "little")
            if at >= slot:
                yield at, at // shard_rows, at % shard_rows * stride, bytearray(record[HEAD:-1])

    # flat binary records have a reader for RDDs only
    records = spark.sparkContext.binaryRecords(",".join(f"{path}/shard={k}" for k in shards), stride)
    return spark.createDataFrame(records.mapPartitions(rows), schema)


def op2_training_order(spark: SparkSession, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    """Writes the shards under spark.checkpoint.dir; what each record holds, with the CRC-32 of its ids as they are read from their shard by offset."""
    import public_tokenizers

    order = Order(table(spark, sf_dir, "documents"), tokenizer_file or public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    contents = materialize(order.contents(), "contents")
    collect_shuffles(spark)
    if not order.total:
        return contents.withColumn("ids_crc32", F.lit(None).cast("long"))
    path = f"{scratch_dir(spark)}/gf-shards-{uuid.uuid4().hex}"
    order.write_shards(path)
    release(order.found._gf_ids)
    collect_shuffles(spark)
    read = read_from(spark, path, 0, order.stride, order.shard_rows)
    sums = materialize(read.select("slot", F.crc32("payload").alias("ids_crc32")), "sums")
    return contents.join(sums, "slot")
