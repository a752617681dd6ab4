"""Removal of repeated strings: a difference-cover filter, then a join of the hashes of whole strings.

A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller doc_id. Of a suffix array only the
classes of equal LENGTH-byte prefixes would be used, never their order. So there is neither a recursion nor a merge by ranks (the README
has the figures why); prefixes are grouped by hashed names:

1. Texts are joined in the order of doc_id into chunks of CHUNK_BYTES. COVER is a difference cover modulo
   PERIOD: for any two positions some shift below PERIOD takes both into the sample, which is a fifth of all
   positions. Each sampled position gets its tuple, the LENGTH - PERIOD + 1 bytes that start there, and its hashed name.
2. Names are dealt to buckets, where equal ones meet; a tuple that only one document holds settles all prefixes that start up
   to PERIOD - 1 bytes before it.
3. Of the prefixes that are left the full LENGTH bytes are hashed and dealt to buckets in the same way.
4. Equal names form a class; its members in a later document than the first are marked.

A chunk sends each name once, as sorted differences without document numbers (chunks follow the order of
doc_id, so that the smallest chunk has the first document), and gets one bit back for each. With its names of
whole prefixes it sends where the prefixes that are left start, as runs, which come back with the bits, so that the last
pass looks at no tuples again. What a chunk sends to all buckets, and what they send back, is packed and unpacked at once. Texts are
shuffled once, into a table bucketed by chunk that later passes join without another shuffle. Whole texts
that repeat are settled by their digest first. Names are hashes with a key that is drawn anew for each run, so
that no text can be made to collide on purpose: a tuple's may collide, which costs time only; those of whole prefixes
have 64 bits besides the bits of their bucket, taken from another hash. Chunks and buckets grow with the
corpus (growth()), so that what a chunk sends to a bucket stays more than its row's overhead.

Defined cases: a null text counts as empty; texts shorter than LENGTH bytes lose nothing; a very long text is a chunk by
itself, whole; rows that repeat a doc_id are one document, which don't remove from each other; rows with a null doc_id keep
all and remove nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import secrets
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MUL, apart, arrow_rows, collect_shuffles, give_back, lean, materialize, mix64, release, scratch_dir, shuffle_width, table

LENGTH = 50
#: A perfect difference set: every residue modulo PERIOD is the difference of two of its members.
PERIOD, COVER = 31, np.array([0, 1, 3, 8, 12, 18], np.int64)
CHUNK_BYTES = 4 << 20
#: Names in a bucket: of tuples (on average) and of whole prefixes (at most about).
BUCKET_TUPLES, BUCKET_PREFIXES = 1 << 20, 1 << 22
DIGEST = 16
#: Chunks in an Arrow batch.
CHUNK_ROWS = 4
#: Positions named at once, so that what is computed for them stays in the processor's cache.
BLOCK = 1 << 13


def growth(total: int) -> int:
    """How many times larger chunks and buckets are for a corpus of so many bytes: 1 below 128 GB, 53 at 100 TB.

    Both grow with the square root, so that what a chunk sends to a bucket stays the same, however large the corpus; a task then holds a chunk of 222 MB at 100 TB.
    """
    return max(1, math.isqrt(total >> 35))


def word_view(buffer: bytes) -> np.ndarray:
    """The 8-byte little-endian word that starts at each byte."""
    n = max(0, len(buffer) - 7)
    return np.ndarray((n,), "<u8", buffer, strides=(1,)) if n else np.zeros(0, np.uint64)


def names(words: np.ndarray, at: np.ndarray, length: int, seeds: tuple[int, ...]) -> list[np.ndarray]:
    """64-bit names of the length bytes (8 at least) at each position, one for each seed."""
    out = [np.full(len(at), (seed * int(MUL)) % 2**64, np.uint64) for seed in seeds]
    views = [words[k:] for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]]
    shifted = np.empty(min(BLOCK, len(at)), np.uint64)
    for s in range(0, len(at), BLOCK):
        here = at[s : s + BLOCK]
        blocks, shift = [h[s : s + BLOCK] for h in out], shifted[: len(here)]
        for view in views:
            word = view[here]
            for h in blocks:
                h ^= word
                h *= MUL
                np.right_shift(h, np.uint64(29), out=shift)
                h ^= shift
        for h in blocks:
            h[:] = mix64(h)
    return out


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """counts[k] integers upwards from each starts[k]."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def packed(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as their differences, in as few bytes each as the largest needs."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    width = blob[0]
    raw = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)


def packed_groups(values: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """packed() of each group of values; groups begin at starts and aren't empty."""
    if not len(values):
        return []
    steps = np.diff(values, prepend=values.dtype.type(0))
    steps[starts] = values[starts]
    counts = np.diff(starts, append=len(values))
    largest = np.maximum.reduceat(steps, starts)
    widths = 1 + sum((largest >> np.uint64(8 * k) > 0).astype(np.int64) for k in range(1, 8))
    digits = steps.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    if (widths == widths[0]).all():
        digits = digits[:, : widths[0]].ravel()
    else:
        digits = digits[np.arange(8) < np.repeat(widths, counts)[:, None]]
    stops = np.cumsum(counts * widths + 1)
    heads = stops - counts * widths - 1
    whole, body = np.empty(stops[-1], np.uint8), np.ones(stops[-1], bool)
    body[heads] = False
    whole[heads], whole[body] = widths, digits
    data = whole.tobytes()
    return [data[s:e] for s, e in zip(heads.tolist(), stops.tolist(), strict=True)]


def unpacked_groups(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The values of all blobs of packed(), none of an empty group, one after the other, and how many each has."""
    whole = np.frombuffer(b"".join(blobs), np.uint8)
    sizes = np.array([len(b) for b in blobs], np.int64)
    heads = np.cumsum(sizes) - sizes
    widths = whole[heads].astype(np.int64)
    counts = (sizes - 1) // widths
    body = np.ones(len(whole), bool)
    body[heads] = False
    wide = np.zeros((counts.sum(), 8), np.uint8)
    if (widths == widths[0]).all():
        wide[:, : widths[0]] = whole[body].reshape(-1, widths[0])
    else:
        wide[np.arange(8) < np.repeat(widths, counts)[:, None]] = whole[body]
    sums = np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)
    firsts = np.cumsum(counts) - counts
    before = np.where(firsts > 0, sums[firsts - 1], np.uint64(0))
    return sums - np.repeat(before, counts), counts


class Chunk:
    """The texts of a chunk without repeated whole texts, and what is known of them so far."""

    def __init__(self, ids: bytes, lengths: bytes, digests: bytes, text: bytes, copies: list[bytes]) -> None:
        self.ids, self.lengths = np.frombuffer(ids, "<i8"), np.frombuffer(lengths, "<i8")
        stops = np.cumsum(self.lengths)
        seen: dict[bytes, int] = dict.fromkeys(copies, -(2**63))
        self.copy = np.zeros(len(self.ids), bool)
        for k, doc_id in enumerate(self.ids.tolist()):
            digest = digests[DIGEST * k : DIGEST * (k + 1)]
            self.copy[k] = seen.setdefault(digest, doc_id) < doc_id
        own = np.flatnonzero(~self.copy)
        self.own = own
        self.text = b"".join([text[stops[k] - self.lengths[k] : stops[k]] for k in own.tolist()])
        self.stops = np.cumsum(self.lengths[own])
        self.starts = self.stops - self.lengths[own]
        # documents by number: rows of one doc_id share it
        self.number = np.cumsum(np.diff(self.ids[own], prepend=self.ids[own][:1]) != 0) if len(own) else np.zeros(0, np.int64)
        self.words = word_view(self.text)

    def _of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.stops, at, side="right")

    def _tuples(self, buckets: int, length: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions, their documents and names (bucket << 32 | 32 bits)."""
        size = length - PERIOD + 1
        at = (np.arange(0, len(self.text), PERIOD, dtype=np.int64)[:, None] + COVER).ravel()
        at = at[at + size <= len(self.text)]
        doc = self._of(at)
        fits = at + size <= self.stops[doc] if len(at) else np.zeros(0, bool)
        at, doc = at[fits], self.number[doc[fits]]
        h = names(self.words, at, size, (key,))[0]
        return at, doc, ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)

    def tuples(self, buckets: int, length: int, key: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and 32-bit names of the distinct tuples, sorted."""
        value = np.sort(self._tuples(buckets, length, key)[2])
        value = value[_new(value)]
        return (value >> np.uint64(32)).astype(np.int64), value & np.uint64(0xFFFFFFFF)

    def open_runs(self, bits: list[dict] | None, buckets: int, length: int, key: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs of starts of the strings that hold a tuple of several documents, early enough: first and past the last."""
        at, doc, value = self._tuples(buckets, length, key)
        order = np.argsort(value)
        value, doc = value[order], doc[order]
        new = _new(value)
        firsts = np.flatnonzero(new)
        told = _told(bits, (value[firsts] >> np.uint64(32)).astype(np.int64))
        several = np.minimum.reduceat(doc, firsts) != np.maximum.reduceat(doc, firsts) if len(doc) else told
        left = np.empty(len(at), bool)
        left[order] = (several | told)[np.cumsum(new) - 1]
        at = at[left]
        doc = self._of(at)
        begin = np.maximum(at - (PERIOD - 1), self.starts[doc])
        new = np.ones(len(at), bool)
        new[1:] = begin[1:] > at[:-1]  # always so where a document begins
        last = np.flatnonzero(np.append(new[1:], True)) if len(at) else np.flatnonzero(new)
        first, stop = begin[new], np.minimum(at[last] + 1, self.stops[doc[last]] - length + 1)
        return first[first < stop], stop[first < stop]

    def prefixes(self, at: np.ndarray, buckets: int, length: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The order of the strings at these starts by bucket and name, their buckets and names in it, if each is the first of its class."""
        h, other = names(self.words, at, length, (key + 1, key + 2))
        bucket = ((other >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(h)
        order = order[np.argsort(bucket[order], kind="stable")]
        h, bucket = h[order], bucket[order]
        return order, bucket, h, _new(h) | _new(bucket)

    def removed(self, at: np.ndarray, told: Callable[[np.ndarray], np.ndarray], buckets: int, length: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes to remove: first, past the last, place of the document among own. at: the open starts, ascending; told: what the buckets say."""
        order, bucket, _, new = self.prefixes(at, buckets, length, key)
        firsts, place = np.flatnonzero(new), np.cumsum(new) - 1
        number = self.number[self._of(at)][order]
        first = np.minimum.reduceat(number, firsts) if len(at) else number
        gone = np.empty(len(at), bool)
        gone[order] = (number > first[place]) | told(bucket[firsts].astype(np.int64))[place]
        at = at[gone]
        doc = self._of(at)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] > at[:-1] + length) | (doc[1:] != doc[:-1])
        last = np.flatnonzero(np.append(new[1:], True)) if len(at) else np.flatnonzero(new)
        return at[new], at[last] + length, doc[new]


def _new(key: np.ndarray) -> np.ndarray:
    """Where a sorted key changes."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return new


def _blobs(bucket: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The buckets that names (sorted by bucket) go to, and the packed names of each."""
    starts = np.flatnonzero(_new(bucket))
    return bucket[starts], packed_groups(values, starts)


def _told(bits: list[dict] | None, bucket: np.ndarray) -> np.ndarray:
    """The bits that the buckets sent back, in the order of the chunk's distinct names (bucket: of each name)."""
    out = np.zeros(len(bucket), bool)
    rows = [(row["bucket"], row["bits"]) for row in bits or () if row["bits"] is not None]
    if not rows:
        return out
    which = np.array([b for b, _ in rows], np.int64)
    starts = np.searchsorted(bucket, which)
    counts = np.searchsorted(bucket, which, side="right") - starts
    sizes = np.array([len(x) for _, x in rows], np.int64)
    flat = np.unpackbits(np.frombuffer(b"".join(x for _, x in rows), np.uint8))
    out[spread(starts, counts)] = flat[spread(8 * (np.cumsum(sizes) - sizes), counts)]
    return out


def chunked(docs: DataFrame, chunk_bytes: int | None = None) -> DataFrame:
    """The table of chunks, bucketed by chunk: chunk, n_bytes, ids, lengths, digests, text (all binary but the first two)."""
    spark = docs.sparkSession
    estimate = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of the files, without a scan
    chunk_bytes = chunk_bytes or CHUNK_BYTES * growth(estimate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            nonlocal number, ids, texts, size
            digests = b"".join(hashlib.blake2b(t, digest_size=DIGEST).digest() for t in texts)
            row = [(part << 32) + number, size, np.array(ids, "<i8").tobytes(), np.array(list(map(len, texts)), "<i8").tobytes(), digests, b"".join(texts)]
            number, ids, texts, size = number + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int64(), *[pa.binary()] * 4), strict=True)], ["chunk", "n_bytes", "ids", "lengths", "digests", "text"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if size >= chunk_bytes and doc_id != ids[-1]:
                    yield chunk()
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if ids:
            yield chunk()

    rows = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    chunks = rows.mapInArrow(lean(run), "chunk long, n_bytes long, ids binary, lengths binary, digests binary, text binary")
    name = f"gf_chunks_{uuid.uuid4().hex}"
    # each task writes the few chunks that it has made, so that there is a file per chunk at most
    path = f"{scratch_dir(spark)}/{name}"
    writer = chunks.write.format("parquet").option("compression", "zstd").option("path", path)
    with arrow_rows(spark):
        writer.bucketBy(shuffle_width(spark), "chunk").saveAsTable(name)
    collect_shuffles(spark)
    back = spark.table(name)
    back._gf_name, back._gf_path = name, path
    return back


def whole_copies(chunks: DataFrame) -> DataFrame:
    """chunk, copies: the digests of its texts that an earlier chunk has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = sorted({blob[k : k + DIGEST] for k in range(0, len(blob), DIGEST)})
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(own), pa.int64()), pa.array(own, pa.binary())], ["chunk", "digest"])

    rows = chunks.select("chunk", "digests").mapInArrow(lean(run), "chunk long, digest binary")
    firsts = rows.groupBy("digest").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last")).where("first < last").drop("last")
    later = rows.join(firsts, "digest").where("chunk > first")
    return later.groupBy("chunk").agg(F.collect_list("digest").alias("copies"))  # no more than a chunk has texts


def _with(chunks: DataFrame, *sides: DataFrame) -> DataFrame:
    for side in sides:
        chunks = chunks.join(side.hint("shuffle_hash"), "chunk", "left")  # the texts are neither shuffled nor sorted
    return chunks.drop("n_bytes")


def _met(sent: DataFrame, earlier: bool) -> DataFrame:
    """What the buckets find: chunk, bits (bucket, one bit per name, runs as sent): another chunk has the name; with earlier, a smaller one."""

    def met(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        every, counts = unpacked_groups(part["blob"].tolist())
        order = np.argsort(every)
        every = every[order]
        same = every[1:] == every[:-1]
        shared = np.zeros(len(every), bool)
        shared[1:] |= same
        shared[:-1] |= same
        order, every = order[shared], every[shared]
        mark = np.zeros(len(shared), bool)
        mark[order] = True
        if earlier and len(order):
            mark[np.minimum.reduceat(order, np.flatnonzero(_new(every)))] = False  # chunks ascend, so that the lowest place is of the smallest
        sizes = (counts + 7) // 8
        stops, firsts = np.cumsum(sizes), np.cumsum(counts) - counts
        bits = np.zeros(8 * stops[-1], bool)
        bits[spread(8 * (stops - sizes), counts)] = mark
        data, some = np.packbits(bits).tobytes(), np.logical_or.reduceat(mark, firsts)
        found = [data[e - n : e] if a else None for a, e, n in zip(some.tolist(), stops.tolist(), sizes.tolist(), strict=True)]
        out = pd.DataFrame({"chunk": part["chunk"].to_numpy(), "bucket": int(key[0]), "bits": pd.Series(found, dtype=object), "runs": part["runs"].to_numpy()})
        return out[some | out["runs"].notna().to_numpy()]

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = met(key, part)
        give_back()
        return out

    marked = sent.groupBy("bucket").applyInPandas(run, "chunk long, bucket int, bits binary, runs binary")
    return marked.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits", "runs")).alias("bits"))  # one per bucket at most


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: the bytes that stay) and, where bytes go, the text's SHA-256 of every row.

    Write the result with some CHUNK_ROWS rows in an Arrow batch, then call forget() on it.
    """
    if length < PERIOD + 7:
        raise ValueError(f"length must be at least {PERIOD + 7}")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    chunks = chunked(rows.where("doc_id IS NOT NULL"))
    try:
        return _removed(rows, chunks, length)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {chunks._gf_name}")
        release(chunks)
        raise


def _removed(rows: DataFrame, chunks: DataFrame, length: int) -> DataFrame:
    spark = rows.sparkSession
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, text_sha256 string"
    total = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_tuples, n_prefixes = (max(1, -(-total // size)) for size in (BUCKET_TUPLES * growth(total) * PERIOD // len(COVER), BUCKET_PREFIXES * growth(total)))
    key = secrets.randbits(48)
    copies = materialize(whole_copies(chunks), "copies")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Chunk]]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                yield row, Chunk(row["ids"], row["lengths"], row["digests"], row["text"], row["copies"] or [])

    def sent(number: int, buckets: np.ndarray, blobs: list[bytes], runs: bytes | None = None) -> pa.RecordBatch:
        carried: list[bytes | None] = [None] * len(blobs)
        if blobs:  # by any of its rows, so that no bucket carries those of all chunks
            carried[int(mix64(np.array([number], np.uint64))[0] % np.uint64(len(blobs)))] = runs
        columns = [pa.array(buckets.astype(np.int32)), pa.array([number] * len(blobs), pa.int64()), pa.array(blobs, pa.binary()), pa.array(carried, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "blob", "runs"])

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk in each(batches):
            yield sent(row["chunk"], *_blobs(*chunk.tuples(n_tuples, length, key)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk in each(batches):
            first, stop = chunk.open_runs(row["bits"], n_tuples, length, key)
            _, bucket, values, new = chunk.prefixes(spread(first, stop - first), n_prefixes, length, key)
            yield sent(row["chunk"], *_blobs(bucket[new], values[new]), zlib.compress(packed(np.stack([first, stop], 1).ravel().astype(np.uint64)), 1))

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk in each(batches):
            more = row["more"] or []
            runs = next((unpacked(zlib.decompress(r["runs"])).astype(np.int64).reshape(-1, 2) for r in more if r["runs"] is not None), np.zeros((0, 2), np.int64))
            at = spread(runs[:, 0], runs[:, 1] - runs[:, 0])
            first, stop, doc = chunk.removed(at, lambda bucket: _told(more, bucket), n_prefixes, length, key)  # noqa: B023
            n = chunk.lengths
            n_removed, n_spans = np.where(chunk.copy & (n >= length), n, 0), (chunk.copy & (n >= length)).astype(np.int64)
            n_removed[chunk.own] = np.bincount(doc, stop - first, len(chunk.own)).astype(np.int64)
            n_spans[chunk.own] = np.bincount(doc, minlength=len(chunk.own))
            steps = np.zeros(len(chunk.text) + 1, np.int8)
            steps[first] += 1  # no position twice
            steps[stop] -= 1
            left = np.frombuffer(chunk.text, np.uint8)[np.cumsum(steps[:-1], dtype=np.int8) == 0].tobytes()
            ends = np.cumsum((n - n_removed)[chunk.own])
            kept: list[bytes] = [b""] * len(n)
            for k, s, e in zip(chunk.own.tolist(), [0, *ends.tolist()], ends.tolist(), strict=False):
                kept[k] = left[s:e]
            short = np.flatnonzero(chunk.copy & (n < length))
            stops = np.cumsum(n)
            for k in short.tolist():
                kept[k] = row["text"][stops[k] - n[k] : stops[k]]
            sha = [hashlib.sha256(row["text"][stops[k] - n[k] : stops[k]]).hexdigest() if n_removed[k] else None for k in range(len(n))]
            yield pa.RecordBatch.from_arrays([pa.array(chunk.ids), pa.array(n), pa.array(n_removed), pa.array(n_spans), pa.array(kept, pa.binary()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "text_sha256"])

    kinds = "bucket int, chunk long, blob binary, runs binary"
    bits = materialize(_met(_with(chunks, copies).mapInArrow(lean(tuples), kinds), False), "tuples", CHUNK_ROWS)
    collect_shuffles(spark)
    more = materialize(_met(_with(chunks, copies, bits).mapInArrow(lean(prefixes), kinds), True).withColumnRenamed("bits", "more"), "prefixes", CHUNK_ROWS)
    release(bits)
    collect_shuffles(spark)
    found = _with(chunks, copies, more).mapInArrow(lean(results), schema)
    whole = F.length("text").cast("long").alias("n_bytes")
    found = found.unionByName(rows.where("doc_id IS NULL").select("doc_id", whole, F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").alias("kept"), F.lit(None).cast("string").alias("text_sha256")))
    found._gf_chunks, found._gf_tables = chunks, (copies, more)
    return found


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")]
    return written(table(spark, sf_dir, "documents"), lambda every: every.select(*columns), "kept")


def written(docs: DataFrame, view: Callable[[DataFrame], DataFrame], name: str, length: int = LENGTH) -> DataFrame:
    """A view of remove_repeats(), as a table; whether it could be written or not, the table of chunks goes."""
    every = remove_repeats(docs, length)
    try:
        return materialize(view(every), name, CHUNK_ROWS)
    finally:
        forget(every)


def forget(found: DataFrame) -> None:
    """Drop the table of chunks that a result of remove_repeats() reads, once that result is written."""
    found.sparkSession.sql(f"DROP TABLE {found._gf_chunks._gf_name}")
    release(found._gf_chunks, *found._gf_tables)
    collect_shuffles(found.sparkSession)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated strings; one of which nothing is left goes. Other rows stay as they are.

    Removal works on bytes, so that it can cut a character in two; what is left of such a one goes as well. Rows
    with a null doc_id or text stay; rows that repeat a doc_id lose what their text shares with smaller doc_ids, and equal rows
    all stay; n_chars, if docs have it, is that of the new text; other columns stay, whatever their names; an
    empty table stays empty.
    """
    sha, kept, new = apart(docs, "_sha", "_kept", "_new")
    # rows that repeat a doc_id are told apart by their text
    found = written(docs, lambda every: every.where("n_removed > 0").groupBy("doc_id", F.col("text_sha256").alias(sha)).agg(F.min("kept").alias(kept)), "removed")
    joined = docs.withColumn(sha, F.sha2(F.col("text").cast("string").cast("binary"), 256)).join(found, ["doc_id", sha], "left")
    return _cleaned(joined, docs, kept, new)


def _cleaned(joined: DataFrame, docs: DataFrame, kept: str, new: str) -> DataFrame:
    @F.pandas_udf("string")
    def readable(left: pd.Series) -> pd.Series:
        return left.map(lambda b: b.decode("utf-8", "ignore"), na_action="ignore")

    whole = F.col(kept).isNull()
    text = F.when(whole, F.col("text")).otherwise(F.col(new))
    out = joined.withColumn(new, readable(kept)).withColumn("text", text).where(whole | (F.btrim(F.col(new)) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
