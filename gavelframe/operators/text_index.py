"""Keyword search by a positional index of character n-grams, kept as Parquet tables.

An index is a folder of segments; each append writes one. A segment has two tables:

* texts: block, no, key, text, in folders by shard. Documents are dealt to blocks of about BLOCK_CHARS characters by a hash and
  numbered within their block.
* postings: for each block and gram one row (bucket, gram, block, n_docs, docs, counts, positions), in folders by a hash of the gram and sorted
  by gram within their files. Numbers and positions are ascending, stored as differences of variable length. Every position of a text
  begins a gram: at its end grams are filled up with PAD, so that a word shorter than a gram is a prefix of some.

A search takes the RAREST grams of each word (by the number of documents that hold them, read from the small columns of the postings of these grams
only), reads just their postings by bucket and gram, and brings those of one block together, where word starts are intersected: a document stays if
each of its words has the chosen grams at the right distances. All that a document needs is in its block, so that the shuffle carries compressed
postings and no group grows with the corpus. Candidates are then verified by the texts of their shards. A rare word thus
reads a few buckets of postings and a few shards of texts, whatever the size of the corpus.

Results equal those of `contains` on every text: case and width of letters count, null and empty texts hold no word, a document that was
appended twice is found twice. A segment whose marker is missing (its writer was lost) is ignored and can be written again under its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..session import path_exists, shared_folder

GRAM = 3
PAD = "\0"
BLOCK_CHARS = 1 << 22
#: Characters of text in a bucket of postings and in a shard of texts, on average.
BUCKET_CHARS = 1 << 26
LEAST_BUCKETS = 16
#: Parts of a bucket, by block, that are written by different tasks: postings of a frequent gram grow with the corpus.
BUCKET_PARTS = 4
#: Tasks to which postings of one gram and candidates of one query are dealt, by block; the few rows of queries are repeated for each.
SALTS = 16
#: Grams of each word whose postings are read.
RAREST = 4
#: Queries whose postings of a block are taken together.
GROUP_QUERIES = 256
#: Up to so many distinct grams or shards are named in a filter that the scan can use; more are joined.
FILTER_VALUES = 5000
#: Characters whose grams a task sorts at a time.
SORT_CHARS = 1 << 22

POSTINGS = "block long, gram string, n_docs int, docs binary, counts binary, positions binary"


# ------------------------------------------------------------ numbers of variable length


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as groups of seven bits, the last without the high bit: (bytes, end of each value)."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >> np.uint64(7 * k) > 0
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(v) else 0, np.uint8)
    starts = ends - size
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[starts[has] + k] = (v[has] >> np.uint64(7 * k) & np.uint64(127)) | np.where(size[has] > k + 1, 128, 0).astype(np.uint64)
    return out, ends


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    first = np.r_[0, np.flatnonzero(raw < 128)[:-1] + 1]
    shift = np.arange(len(raw)) - np.repeat(first, np.diff(np.r_[first, len(raw)]))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * shift), first)


# ------------------------------------------------------------ building


def gram_postings(numbers: np.ndarray, offsets: np.ndarray, texts: list[str], n: int = GRAM) -> dict[str, pa.Array | np.ndarray]:
    """Postings of a few texts of one block: gram, n_docs, docs, counts, positions. numbers ascend; offsets are the places of the texts in their documents.

    A text may be a part of a document, overlapping the next part by n - 1 characters, so that a number may be repeated; its last n - 1 characters then begin no gram.
    """
    whole = "".join(t + PAD * (n - 1) for t in texts)
    units = np.frombuffer(whole.encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + n - 1) - lengths - n + 1
    cut = np.r_[numbers[1:] == numbers[:-1], False]  # the part goes on in the next one
    used = np.maximum(lengths - np.where(cut, n - 1, 0), 0)
    owner = np.repeat(np.arange(len(texts)), used)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(used) - used, used)
    at = begins[owner] + inner
    code = np.zeros(len(at), np.int64)
    for k in range(n):
        code = code << 21 | units[at + k]
    order = np.argsort(code, kind="stable")
    code, doc, position = code[order], numbers[owner[order]], (offsets[owner] + inner)[order]
    new_gram = np.r_[True, code[1:] != code[:-1]] if len(code) else np.zeros(0, bool)
    new_doc = new_gram | np.r_[True, doc[1:] != doc[:-1]] if len(code) else new_gram
    gram_at, doc_at = np.flatnonzero(new_gram), np.flatnonzero(new_doc)
    steps = np.where(new_doc, position, position - np.r_[0, position[:-1]])
    docs = doc[doc_at]
    doc_steps = np.where(new_gram[doc_at], docs, docs - np.r_[0, docs[:-1]])
    counts = np.diff(np.r_[doc_at, len(code)])
    first_doc = np.searchsorted(doc_at, gram_at)  # of each gram among the documents of all grams
    chars = np.stack([code[gram_at] >> 21 * (n - 1 - k) & 0x1FFFFF for k in range(n)], axis=1).astype("<u4").tobytes().decode("utf-32-le")

    def cells(values: np.ndarray, starts: np.ndarray) -> pa.Array:
        data, ends = pack(values)
        bounds = np.r_[0, ends][np.r_[starts, len(values)]].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])

    return {
        "gram": pa.array([chars[i : i + n] for i in range(0, len(chars), n)], pa.string()), "n_docs": np.diff(np.r_[first_doc, len(docs)]).astype(np.int32),
        "docs": cells(doc_steps, first_doc), "counts": cells(counts, first_doc), "positions": cells(steps, gram_at),
    }


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, no, text, in the order of block and no -> rows of POSTINGS; a block that ends up in two batches has two rows for a gram."""
    held: list[tuple[int, int, str]] = []  # number, offset, text

    def rows(block: int) -> Iterator[pa.RecordBatch]:
        numbers, offsets, texts = zip(*held, strict=True)
        p = gram_postings(np.array(numbers, np.int64), np.array(offsets, np.int64), list(texts))
        held.clear()
        table = pa.table([pa.array(np.full(len(p["gram"]), block, np.int64)), p["gram"], pa.array(p["n_docs"]), p["docs"], p["counts"], p["positions"]], names=["block", "gram", "n_docs", "docs", "counts", "positions"])
        yield from table.to_batches(max_chunksize=1 << 14)

    now, size = None, 0
    for batch in batches:
        for block, no, text in zip(*(batch.column(k) for k in range(3)), strict=True):
            if now is not None and held and (block.as_py() != now or size >= SORT_CHARS):
                yield from rows(now)
                size = 0
            now, value = block.as_py(), text.as_py()
            for i in range(0, max(len(value) - (GRAM - 1), 1), SORT_CHARS):
                part = value[i : i + SORT_CHARS + GRAM - 1]
                held.append((no.as_py(), i, part))
                size += len(part)
                if i + SORT_CHARS + GRAM - 1 < len(value):  # more of it follows: what is here leaves out the overlap
                    held.append((no.as_py(), i + SORT_CHARS, ""))
                    yield from rows(now)
                    size = 0
    if held:
        yield from rows(now)


def salt_of_block() -> Column:
    return F.pmod("block", F.lit(SALTS)).cast("int")


def every_salt() -> Column:
    return F.explode(F.array(*map(F.lit, range(SALTS))))


class TextIndex:
    """An index at a path; see the module. key and text name the columns of what is appended."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # -------------------------------------------------------- writing

    def append(self, docs: DataFrame, key: str, text: str, segment: str) -> None:
        """Add documents as a segment, which searches see when it is complete. A segment that is complete already stays as it is."""
        where = f"{self.path}/segment={segment}"
        if path_exists(self.spark, f"{where}/COMPLETE/_SUCCESS"):
            return
        rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where(F.length("text") > 0)
        total = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
        blocks, cuts = max(1, -(-total // BLOCK_CHARS)), max(1, -(-total // BUCKET_CHARS))
        buckets = max(LEAST_BUCKETS, cuts)
        if total:
            self._write(rows, where, blocks, buckets)
        done = [(segment, int(total), int(blocks), int(buckets), rows.schema["key"].dataType.simpleString())]
        self.spark.createDataFrame(done, "segment string, chars long, blocks long, buckets int, key_type string").coalesce(1).write.mode("overwrite").parquet(f"{where}/COMPLETE")

    def _write(self, rows: DataFrame, where: str, blocks: int, buckets: int) -> None:
        # equal keys with different texts are told apart by the text, so that blocks stay even
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))
        numbered = dealt.withColumn("no", F.row_number().over(Window.partitionBy("block").orderBy("key", "text")) - 1)
        # numbers are fixed by writing them; equal rows of one key are the same whichever comes first
        numbered.withColumn("shard", F.expr(f"cast(block div {max(1, BUCKET_CHARS // BLOCK_CHARS)} as int)")).write.mode("overwrite").partitionBy("shard").parquet(f"{where}/texts")
        texts = self.spark.read.parquet(f"{where}/texts")
        grams = texts.select("block", "no", "text").mapInArrow(_post, POSTINGS)
        grams = grams.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int"))
        spread = grams.repartition(buckets * BUCKET_PARTS, F.col("bucket"), F.pmod("block", F.lit(BUCKET_PARTS))).sortWithinPartitions("bucket", "gram", "block")
        spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{where}/postings")

    # -------------------------------------------------------- reading

    def segments(self) -> list[tuple[str, Row]]:
        """(folder, description) of the complete segments, those without any text too."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/segment=*/COMPLETE/_SUCCESS")
        found = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(hadoop)
        names = sorted(f.getPath().getParent().getParent().toString() for f in found or [])
        if not names:
            raise ValueError(f"no complete segment at {self.path}")
        return [(n, self.spark.read.parquet(f"{n}/COMPLETE").first()) for n in names]

    def _table(self, name: str, where: str, about: Row) -> DataFrame:
        if not about.chars:
            kinds = {"postings": f"{POSTINGS}, bucket int", "texts": f"key {about.key_type}, text string, block long, no int, shard int"}
            return self.spark.createDataFrame([], kinds[name])
        return self.spark.read.parquet(f"{where}/{name}")

    def _postings(self, grams: list[str], prefixes: list[str]) -> DataFrame:
        """Postings of grams, and of all grams that begin with one of prefixes, with the segment; only the buckets of the grams are read."""
        out = None
        for where, about in self.segments():
            rows = self._table("postings", where, about)
            test = F.lit(False)
            if grams:
                named = self.spark.range(1).select(F.explode(F.transform(F.array(*map(F.lit, grams)), lambda g: F.pmod(F.xxhash64(g), F.lit(about.buckets)).cast("int"))).alias("b")).distinct()
                test = F.col("gram").isin(grams) & F.col("bucket").isin([r[0] for r in named.collect()])
            for p in prefixes:
                test = test | F.col("gram").startswith(p)
            rows = rows.where(test).withColumn("segment", F.lit(where))
            out = rows if out is None else out.unionByName(rows)
        return out

    def candidates(self, queries: DataFrame, rarest: int = RAREST) -> DataFrame:
        """segment, block, no, query of the documents that hold the rarest grams of all words of a query at the right distances.

        queries: query, words array<string>. Their distinct grams go to the driver for the filter of the scan, up to FILTER_VALUES of them; with more, the postings
        are joined instead.
        """
        words = queries.select("query", F.posexplode(F.array_distinct("words")).alias("word", "w"))
        starts = F.sequence(F.lit(1), F.greatest(F.length("w") - GRAM + 1, F.lit(1)))
        each = words.select("query", "word", F.posexplode(F.transform(starts, lambda i: F.substring(F.col("w"), i, GRAM))).alias("offset", "gram"))
        short = F.length("gram") < GRAM
        distinct = each.select("gram").distinct().limit(FILTER_VALUES + 1).collect()
        few = len(distinct) <= FILTER_VALUES
        grams = [r[0] for r in distinct if len(r[0]) == GRAM] if few else []
        postings = self._postings(grams, sorted({r[0] for r in distinct if len(r[0]) < GRAM})) if few else self._all()
        postings = postings.withColumn("salt", salt_of_block())
        held = postings.groupBy("gram").agg(F.sum("n_docs").alias("held"))
        exact, prefix = each.where(~short), each.where(short)
        rank = F.row_number().over(Window.partitionBy("query", "word").orderBy(F.coalesce("held", F.lit(0)), "offset"))
        chosen = exact.join(held, "gram", "left").withColumn("rank", rank).where(F.col("rank") <= rarest)
        chosen = chosen.withColumn("wanted", F.count("*").over(Window.partitionBy("query", "word"))).select("query", "word", "offset", "gram", "wanted")
        by_prefix = prefix.select("query", "word", "offset", F.col("gram").alias("start"), F.lit(1).cast("long").alias("wanted"))
        n_words = words.groupBy("query").agg(F.count("*").alias("n_words"))
        for_each = lambda rows: rows.join(n_words, "query").withColumn("salt", every_salt())
        met = postings.join(for_each(chosen), ["gram", "salt"])
        if not few or any(len(r[0]) < GRAM for r in distinct):
            starts_with = F.explode(F.transform(F.sequence(F.lit(1), F.lit(GRAM - 1)), lambda k: F.substring("gram", F.lit(1), k)))
            met = met.unionByName(postings.withColumn("start", starts_with).join(for_each(by_prefix), ["start", "salt"]).drop("start"))
        met = met.withColumn("lot", F.pmod(F.xxhash64("query"), F.lit(max(1, queries.count() // GROUP_QUERIES))))
        kind = queries.schema["query"].dataType.simpleString()
        columns = ["segment", "block", "lot", "query", "n_words", "word", "wanted", "offset", "gram", "docs", "counts", "positions"]
        return met.select(columns).groupBy("segment", "block", "lot").applyInPandas(_intersect, f"segment string, block long, no int, query {kind}")

    def _all(self) -> DataFrame:
        parts = [self._table("postings", where, about).withColumn("segment", F.lit(where)) for where, about in self.segments()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def search_many(self, queries: DataFrame, rarest: int = RAREST) -> DataFrame:
        """query, key: the documents whose text holds all words of a query (query, words array<string>). Empty words are held by every text and are left out; a query without words is refused."""
        asked = queries.select("query", F.filter("words", lambda w: F.length(w) > 0).alias("words"))
        if not asked.where(F.coalesce(F.size("words"), F.lit(0)) < 1).isEmpty():
            raise ValueError("a query needs a word")
        path = shared_folder(self.spark, "candidates")
        self.candidates(asked, rarest).write.parquet(path)
        found, out = self.spark.read.parquet(path), None
        for where, about in self.segments():
            texts = self._table("texts", where, about)
            mine = found.where(F.col("segment") == where).drop("segment")
            shards = mine.select(F.expr(f"cast(block div {max(1, BUCKET_CHARS // BLOCK_CHARS)} as int)").alias("shard")).distinct().limit(FILTER_VALUES + 1).collect()
            if len(shards) <= FILTER_VALUES:
                texts = texts.where(F.col("shard").isin([r[0] for r in shards]))
            # the words come to the candidates before the texts do, else all texts of a query would meet in one task
            worded = mine.withColumn("salt", salt_of_block()).join(asked.withColumn("salt", every_salt()), ["query", "salt"]).drop("salt")
            rows = texts.join(worded, ["block", "no"]).where(F.forall("words", lambda w: F.col("text").contains(w))).select("query", "key")
            out = rows if out is None else out.unionByName(rows)
        return out

    def search(self, keywords: str) -> DataFrame:
        """key: the documents that hold every word of keywords (between white space)."""
        words = keywords.split()
        if not words:
            raise ValueError("a keyword is needed")
        return self.search_many(self.spark.createDataFrame([(0, words)], "query int, words array<string>")).select("key")


def _intersect(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Documents (no) of one block that hold the chosen grams of all words of a query."""
    opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def starts(row) -> np.ndarray:
        """document and start of the word, in one number, for each place of the row's gram."""
        if row.Index not in opened:
            counts = unpack(row.counts)
            docs = np.cumsum(unpack(row.docs))
            steps = unpack(row.positions)
            ends = np.cumsum(counts)
            sums = np.cumsum(steps)
            before = np.r_[0, sums[ends[:-1] - 1]]
            opened[row.Index] = np.repeat(docs, counts), sums - np.repeat(before, counts)
        docs, places = opened[row.Index]
        fine = places >= row.offset
        return docs[fine] << 40 | (places[fine] - row.offset)

    found = []
    for query, rows in group.groupby("query", sort=False):
        common = None
        for _, word in rows.groupby("word", sort=False):
            held = None
            by_offset = [np.unique(np.concatenate([starts(r) for r in g.itertuples()])) for _, g in word.groupby("offset", sort=False)]
            if len(by_offset) < word["wanted"].iloc[0]:
                by_offset = [np.zeros(0, np.int64)]
            for s in sorted(by_offset, key=len):
                held = s if held is None else np.intersect1d(held, s, assume_unique=True)
            docs = np.unique(held >> 40)
            common = docs if common is None else np.intersect1d(common, docs, assume_unique=True)
        if rows["word"].nunique() == rows["n_words"].iloc[0] and len(common):
            found += [(int(no), query) for no in common]
    return pd.DataFrame([(key[0], key[1], no, query) for no, query in found], columns=["segment", "block", "no", "query"], dtype=object)
