"""Best-fit packing of documents into training sequences: best-two-fit.

Each document becomes the ids of its whole text and an end id. A document that is longer than a sequence is
cut into pieces of the full length, the first piece taking the rest. Pieces are packed group by group (a
hash deals them out, GROUP_PIECES on average, so that no task holds more as the corpus grows): a bin is
filled greedily, always with the longest piece that fits; then its smallest piece is given back if two
unpacked pieces together fill the widened gap more tightly.

Defined cases: a null text counts as empty and makes a piece of the end id alone; a null doc_id is packed
like any other; repeated rows are packed once each; a very long text makes as many pieces as it needs, each packed by
itself; of pieces of equal length that with the smaller doc_id is taken first; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ARROW_ROWS, lean, materialize, release, table

LENGTH = 1024
END_ID = 2
GROUP_PIECES = 20_000

_TOKENIZERS: dict[str, Callable[[str], bytes]] = {}


def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file of the tokenizers library, without added tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {x["content"] for x in spec.get("added_tokens", ())}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that such files write as themselves
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(map(byte.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in added}


def added_tokens(path: str) -> list[str]:
    """The added tokens of such a file."""
    with open(path, encoding="utf-8") as file:
        return [x["content"] for x in json.load(file).get("added_tokens", ())]


def worker_tokenizer(path: str, pattern: str) -> Callable[[str], bytes]:
    """Text to its ids as little-endian unsigned 32-bit integers; one tokenizer per Python worker.

    The ids are those of the tokenizers library for the file (tests compare them). That library took about
    1 s for a MB of text here and tiktoken a tenth of it with the same vocabulary, hence tiktoken. Texts that
    hold an added token, and those that tiktoken refuses (very long runs of white space), go to the library.
    """
    if path not in _TOKENIZERS:
        import tiktoken

        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary(path), special_tokens={})
        added = added_tokens(path)
        library = None  # loaded for the first text that needs it: few workers meet one, and it stays in memory

        def encode(text: str) -> bytes:
            nonlocal library
            if not any(token in text for token in added):
                try:
                    return own.encode_to_numpy(text).astype("<u4").tobytes()
                except ValueError:  # its regular expressions ran out of stack
                    pass
            if library is None:
                from tokenizers import Tokenizer

                library = Tokenizer.from_file(path)
            return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

        _TOKENIZERS[path] = encode
    return _TOKENIZERS[path]


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    first = n - (n - 1) // length * length if n else 0
    return [(0, first), *((s, length) for s in range(first, n, length))] if n else []


def pieces(docs: DataFrame, path: str, pattern: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_tokenizer(path, pattern)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blob = encoder(text or "") + end
                for k, (start, n) in enumerate(cut(len(blob) // 4, length)):
                    for column, value in zip(out, (doc_id, k, start, n, zlib.crc32(blob[4 * start : 4 * (start + n)])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_two_fit(lengths: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece, by the counts of each length."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    sizes = np.arange(capacity + 1)
    fits = np.maximum.accumulate(np.where(counts > 0, sizes, 0))  # the longest unpacked length up to x
    left, bins = len(lengths), []

    def take(size: int) -> None:
        nonlocal fits
        counts[size] -= 1
        if not counts[size]:
            fits = np.maximum.accumulate(np.where(counts > 0, sizes, 0))

    while left:
        gap, held = capacity, []
        while gap and (size := int(fits[gap])):
            take(size)
            held.append(size)
            gap -= size
        left -= len(held)
        if gap and left >= 2 and len(held) > 1:
            small = held[-1]
            room = gap + small
            first = sizes[(counts[: room + 1] > 0).nonzero()[0]]
            second = np.minimum(fits[room - first], room)
            # a length of which one piece is left can't stand for both
            twice = (second == first) & (counts[first] < 2)
            second[twice] = fits[np.maximum(np.minimum(room - first[twice], first[twice] - 1), 0)]
            both = np.where(second > 0, first + second, 0)
            if len(both) and both.max() > small:
                k = int(both.argmax())
                held.pop()
                counts[small] += 1
                fits = np.maximum.accumulate(np.where(counts > 0, sizes, 0))
                for size in (int(first[k]), int(second[k])):
                    take(size)
                    held.append(size)
                left -= 1
        bins.append(held)
    by_length = np.argsort(lengths, kind="stable")
    starts = np.searchsorted(lengths[by_length], sizes)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, held in enumerate(bins):
        at = 0
        for size in held:
            k = by_length[starts[size]]
            starts[size] += 1
            number[k], offset[k] = b, at
            at += size
    return number, offset


def pack(rows: DataFrame, capacity: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """rows of pieces (see pieces()) with sequence_id and offset."""
    rows = materialize(rows, "pieces", ARROW_ROWS)
    groups = max(1, -(-rows.count() // group_pieces))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        number, offset = best_two_fit(part["length"].to_numpy(np.int64), capacity)
        return part.drop(columns="deal").assign(sequence_id=number + (int(key[0]) << 32), offset=offset)

    # the row's number in the table parts rows that are equal
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    packed = materialize(dealt.groupBy("deal").applyInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"), "packed")
    release(rows)
    return packed


def _packed(spark: SparkSession, docs: DataFrame, tokenizer_file: str | None) -> DataFrame:
    import public_tokenizers

    path = tokenizer_file or public_tokenizers.path("byte_bpe_50k.json")
    return pack(pieces(docs, path, public_tokenizers.PATTERN))


def op9_packing(spark: SparkSession, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    return _packed(spark, table(spark, sf_dir, "documents"), tokenizer_file)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: where each piece of the kept documents stands (see the module for nulls, repeated rows and empty tables)."""
    return _packed(spark, docs, None)
