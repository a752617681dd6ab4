"""Byte-level BPE encoding and decoding.

A text is cut by the pre-tokenizer pattern; each match is encoded separately. Within a match a segment tree
over the byte positions holds, at leaf i, the rank of the pair that the live token starting at byte i forms
with its live right neighbour, and in its root the leftmost smallest one. A merge removes one token from a
doubly linked list of live tokens and updates three leaves, each in logarithmic time, so that even a match
of a megabyte takes n log n steps. Decoding joins the bytes of the ids.

Frequent short matches are memoised per Python worker in a dictionary of bounded size.

Defined cases: a null text counts as empty and an empty text has no ids; a null doc_id is kept; repeated rows are each
returned; a very long text or match is encoded whole; an empty table gives no rows; other columns are ignored. Ids of
bytes are part of every byte-level vocabulary, so that each text can be encoded and decoding gives back its UTF-8 bytes exactly.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ARROW_ROWS, materialize, table

#: Entries and longest match (characters) that a worker's memory of matches may hold.
MEMO_ENTRIES, MEMO_CHARS = 250_000, 48
NONE = 1 << 62


class SegmentTreeBpe:
    """Encoder and decoder for one vocabulary: ranks maps token bytes to their rank, which is their id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        if n < 2:
            return [ranks[piece]] if piece else []
        width = 1 << (n - 1).bit_length()
        find = ranks.get
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [NONE] * (2 * width)
        # rank * width + position: the smallest is the leftmost of the smallest rank
        for i in range(n - 1):
            rank = find(piece[i : i + 2])
            if rank is not None:
                tree[width + i] = rank * width + i
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        while (root := tree[1]) != NONE:
            i = root % width
            gone = following[i]
            following[i] = after = following[gone]
            left = before[i]
            points = [(gone, NONE), (i, NONE)]
            if after < n:
                before[after] = i
                rank = find(piece[i : following[after]])
                if rank is not None:
                    points[1] = (i, rank * width + i)
            if left >= 0:
                rank = find(piece[left:after])
                points.append((left, NONE if rank is None else rank * width + left))
            for k, value in points:
                k += width
                if tree[k] == value:
                    continue
                tree[k] = value
                while k > 1:
                    other = tree[k ^ 1]
                    if other < value:
                        value = other
                    k >>= 1
                    if tree[k] == value:
                        break
                    tree[k] = value
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : following[i]]])
            i = following[i]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Memo(dict):
    """Match -> its ids as little-endian unsigned 32-bit integers.

    Two generations of MEMO_ENTRIES matches at most: when the younger is full it becomes the older one, and
    a match found in the older one moves back, so that frequent matches stay.
    """

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        blob = self.older.get(match)
        if blob is None:
            blob = np.array(self.encode(match.encode()), "<u4").tobytes()
        self.learn(match, blob)
        return blob

    def learn(self, match: str, blob: bytes) -> None:
        if len(match) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[match] = blob


class TextEncoder:
    """Whole texts to id bytes: pattern, then one encoding for each match."""

    def __init__(self, pattern: str, encode) -> None:
        # white space by its Unicode property, as both tokenizer libraries take it
        self.find = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall
        self.memo = Memo(encode)

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.find(text)))


_ENCODERS: dict[tuple[str, str], tuple[SegmentTreeBpe, TextEncoder]] = {}


def worker_encoder(path: str, pattern: str) -> tuple[SegmentTreeBpe, TextEncoder]:
    """One encoder per Python worker and vocabulary."""
    if (path, pattern) not in _ENCODERS:
        bpe = SegmentTreeBpe(load_ranks(path))
        _ENCODERS[path, pattern] = bpe, TextEncoder(pattern, bpe.encode)
    return _ENCODERS[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, keep: str = "doc_id") -> DataFrame:
    """keep, ids binary (little-endian unsigned 32-bit) and decoded binary for every row. Run it within arrow_rows(), which bounds a batch of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = worker_encoder(path, pattern)
        for batch in batches:
            ids = [encoder(t or "") for t in batch.column(1).to_pylist()]
            decoded = [bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], [keep, "ids", "decoded"])

    rows = docs.select(F.col(keep), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"{keep} {rows.schema[0].dataType.simpleString()}, ids binary, decoded binary")


def op6_bpe(spark: SparkSession, sf_dir: str, ranks_file: str | None = None) -> DataFrame:
    import public_tokenizers

    path = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = encode_texts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    digests = rows.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return materialize(digests, "digests", ARROW_ROWS)
