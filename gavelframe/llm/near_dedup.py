"""MinHash near-duplicates of documents: ProbMinHash over weighted word shingles.

Words are runs of letters and digits of the lower-case text; a shingle is five words in a row and weighs as
often as it occurs. Each shingle is a Poisson process of its weight's rate, seeded by its hash, whose points
fall on REGISTERS registers; a register keeps its first point. A document stops drawing points once none
can come first any more. Two registers agree with the probability of the probability Jaccard similarity.

1. Documents with the same words form one class at once, whatever its size; its smallest doc_id stands for it.
2. Registers are banded. In each bucket every member is a candidate with the bucket's smallest member; of a
   member's candidates the one with most equal registers is verified.
3. In buckets that still hold several components, blocks of members are compared by their registers, which
   gives the members with an open pair: one in two components that may reach the threshold.
4. Blocks of these members meet with their whole shingle sets. A task verifies its open pairs, likeliest first,
   but those that its own links connect by then, and gives the links alone, so that a group of n near copies
   makes fewer than n rows in each pair of blocks and no pair of copies is ever a row. A pair that shares several
   buckets is verified in the first; every open pair is, so that none is left out.

Verification computes the probability Jaccard of the two whole texts exactly. Groups are the connected
components of verified pairs; no step gathers a bucket, a group or a component in one task or on the driver.

Defined cases: a null text counts as empty; texts without any word are classed by their exact text, so that
empty ones are copies of each other; texts of fewer than five words match equal word sequences only; texts
of one doc_id are all compared and then united in one class; rows with a null doc_id are left out; a very long text is
compared whole, in a block of its own; of equal estimates the partner with the larger doc_id is tried first; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ARROW_ROWS, MUL, apart, chunks, collect_shuffles, lean, materialize, mix64, release, span_hashes, table, text_or_empty
from .graph import components

WORDS = 5
SIMILARITY = 0.8
REGISTERS = 256
#: Registers of a band: texts of a similarity of 0.8 share one of the 36 bands in 9,998 of 10,000 cases.
BAND = 7
TAG = np.dtype("<u2")
#: Estimates so far below the threshold (four standard errors) are not verified.
MARGIN = 4 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
#: Members of a block whose registers are compared, bytes of a block whose shingle sets are, and members of a slice of a star.
BLOCK, BLOCK_BYTES, SLICE = 1024, 4 << 20, 64
CHUNK_CHARS = 1_000_000
BANDS = REGISTERS // BAND

_ALNUM: np.ndarray | None = None


def _word_characters(chars: np.ndarray) -> np.ndarray:
    global _ALNUM
    if _ALNUM is None:
        _ALNUM = np.array([chr(c).isalnum() for c in range(1 << 16)] + [True])
    return _ALNUM[np.minimum(chars, 1 << 16)]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and the index of each word's text."""
    lower = [t.lower() for t in texts]
    joined = "\n".join(lower) + "\n"
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _word_characters(chars)
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    stops = np.cumsum([len(t) + 1 for t in lower])
    return span_hashes(chars, starts, ends), np.searchsorted(stops, starts, side="right").astype(np.int64)


def shingles(words: np.ndarray, owner: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes per text, their counts and their text's index (texts ascending, hashes ascending)."""
    if len(words) < n:
        none = np.zeros(0, np.uint64)
        return none, np.zeros(0), np.zeros(0, np.int64)
    rolled = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        rolled *= MUL
        rolled += words[k : len(words) - n + 1 + k]
    same = owner[: len(rolled)] == owner[n - 1 :]
    hashes, own = mix64(rolled[same]), owner[: len(rolled)][same]
    cuts = np.flatnonzero(np.diff(own)) + 1
    for s, e in zip([0, *cuts], [*cuts, len(own)], strict=True):
        hashes[s:e].sort()
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])
    at = np.flatnonzero(first)
    return hashes[at], np.diff(np.append(at, len(hashes))).astype(float), own[at]


def registers(hashes: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, m: int = REGISTERS) -> np.ndarray:
    """The m registers (16-bit tags of the first arrivals) of each text; zeros for texts without shingles."""
    never = np.uint64(0xFFFFFFFFFFFFFFFF)
    best = np.full(texts * m, never, np.uint64)
    total = np.bincount(owner, weights, texts)
    # all registers are filled by this time with a probability of 95 %; a text that isn't gets more time
    horizon = np.where(total > 0, m / np.maximum(total, 1e-300) * (np.log(m) + 3), 0)
    begun = np.zeros(texts)
    todo = total > 0
    while todo.any():
        at = np.flatnonzero(todo[owner])
        h, w, own, time = hashes[at], weights[at], owner[at], np.zeros(len(at))
        k = 0
        while len(h):
            k += 1
            draw = mix64(h + np.uint64(k * 0xD1B54A32D192ED03 % 2**64))
            time = time - np.log(((draw >> np.uint64(12)) + np.uint64(1)) * 2.0**-52) / w
            live = time <= horizon[own]
            if not live.all():
                h, w, own, time, draw = h[live], w[live], own[live], time[live], draw[live]
            new = time > begun[own]
            pick = mix64(draw[new])
            key = time[new].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | pick >> np.uint64(32)
            np.minimum.at(best, own[new] * m + ((pick & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64), key)
        open_ = (best.reshape(texts, m) == never).any(axis=1) & (total > 0)
        begun = np.where(open_, horizon, begun)
        horizon = np.where(open_, horizon * 2, horizon)
        todo = open_
    tags = (best & np.uint64(0xFFFF)).astype(TAG).reshape(texts, m)
    tags[total == 0] = 0
    return tags


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets (hashes ascending, weights)."""
    every = np.union1d(a[0], b[0])
    if not len(every):
        return 0.0
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])], y[np.searchsorted(every, b[0])] = a[1], b[1]
    both = (x > 0) & (y > 0)
    # 1 / sum of max(x_j / x_i, y_j / y_i): sort by x / y, then x counts above the ratio of i and y below it
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    ys, xs = np.concatenate([[0], np.cumsum(y[order])]), np.concatenate([[0], np.cumsum(x[order])])
    at = np.searchsorted(ratio[order], ratio[both], side="left")
    return float((1 / (ys[at] / y[both] + (xs[-1] - xs[at]) / x[both])).sum())


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 (equal for equal word sequences) and sig (registers; null below WORDS words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for i, j in chunks(texts, CHUNK_CHARS):
                words, owner = word_hashes(texts[i:j])
                bounds = np.searchsorted(owner, np.arange(j - i + 1))
                keys = np.stack([span_hashes(w, bounds[:-1], bounds[1:]) for w in (words, mix64(words))], axis=1).view(np.int64)
                for k in np.flatnonzero(bounds[1:] == bounds[:-1]):
                    keys[k] = np.frombuffer(hashlib.blake2b(texts[i + k].encode("utf-8", "surrogatepass"), digest_size=16).digest(), np.int64)
                found = shingles(words, owner)
                tags = registers(*found, j - i)
                has = np.bincount(found[2], minlength=j - i) > 0
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([t.tobytes() if y else None for t, y in zip(tags, has, strict=True)], pa.binary())], ["doc_id", "k1", "k2", "sig"])

    return docs.mapInArrow(lean(run), "doc_id long, k1 long, k2 long, sig binary")


def _estimated(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """pairs (a, b) with est, the share of equal registers; only those that may reach the threshold."""
    joined = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a").join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b").select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), TAG).reshape(-1, REGISTERS) for c in ("sig_a", "sig_b"))
            est = (x == y).mean(axis=1)
            kept = pa.array(est >= SIMILARITY - MARGIN)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept), pa.array(est).filter(kept)], ["a", "b", "est"])

    return joined.mapInArrow(lean(run), "a long, b long, est double")


def _weighted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    hashes, weights, owner = shingles(*word_hashes(texts))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(hashes[s:e], weights[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


def weighted_sets(docs: DataFrame) -> DataFrame:
    """rep and its distinct shingles (hashes, ascending, and counts, as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for i, j in chunks(texts, CHUNK_CHARS):
                sets = _weighted(texts[i:j])
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array([h.tobytes() for h, _ in sets], pa.binary()), pa.array([w.astype(np.uint32).tobytes() for _, w in sets], pa.binary())], ["rep", "hashes", "counts"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "rep long, hashes binary, counts binary")


def _sets(hashes: pa.Array, counts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(h, np.uint64), np.frombuffer(c, np.uint32).astype(float)) for h, c in zip(hashes.to_pylist(), counts.to_pylist(), strict=True)]


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those pairs (a, b) of which the whole texts have at least the similarity; b may be in any number of pairs.

    The partners of a hub b are dealt in slices, so that no task holds more than some SLICE of them.
    """
    many = materialize(pairs.groupBy("b").agg(F.count("*").alias("n")), "stars")
    dealt = pairs.join(many, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / SLICE)).alias("slice"))
    dealt = materialize(dealt, "dealt")
    hubs = dealt.select("b", "slice").distinct().join(sets.toDF("b", "hashes_b", "counts_b"), "b")
    joined = dealt.join(sets.toDF("a", "hashes_a", "counts_a"), "a").join(hubs, ["b", "slice"]).select("a", "b", "hashes_a", "counts_a", "hashes_b", "counts_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_sets(batch.column(f"hashes_{c}"), batch.column(f"counts_{c}")) for c in "ab")
            kept = pa.array([probability_jaccard(p, q) >= similarity for p, q in zip(x, y, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])

    return joined.mapInArrow(lean(run), "a long, b long")


def _with_component(rows: DataFrame, parts: DataFrame, column: str, name: str) -> DataFrame:
    part = parts.select(F.col("node").alias(column), F.col("component").alias("_part"))
    return rows.join(part, column, "left").withColumn(name, F.coalesce("_part", column)).drop("_part")


def _met(rows: DataFrame, data: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of blocks of a bucket, and the blocks. rows: bucket, band, part, rep, size; data: rep and what goes with it.

    Blocks hold about the limit by the sizes. A component of half a block or more has blocks of its own, which
    don't meet each other. m_y is null where a block meets itself.
    """
    sizes = materialize(rows.groupBy("bucket", "part").agg(F.sum("size").alias("own_size")), "sizes")
    small = materialize(sizes.where(F.col("own_size") < limit // 2).groupBy("bucket").agg(F.sum("own_size").alias("rest")), "small")
    deal = sizes.join(small, "bucket", "left").withColumn("large", F.col("own_size") >= limit // 2)
    count = F.ceil(F.when(F.col("large"), F.col("own_size")).otherwise(F.col("rest")) / limit)
    deal = deal.select("bucket", "part", "large", count.alias("n"))
    own = F.when(F.col("large"), F.col("part")).otherwise(F.lit(0))
    dealt = rows.join(deal, ["bucket", "part"]).select("bucket", "band", "part", "rep", F.struct("large", own.alias("own"), F.pmod(F.xxhash64("rep"), F.col("n")).alias("block")).alias("id"))
    dealt = materialize(dealt, "dealt")  # the groups below are then dealt by all their keys, not by the bucket alone
    held = [F.col(c) for c in ("rep", "part", *(c for c in data.columns if c != "rep"))]
    blocks = materialize(dealt.join(data, "rep").groupBy("bucket", "id").agg(F.min("band").alias("band"), F.collect_list(F.struct(*held)).alias("m")), "blocks", 1)
    heads = blocks.select("bucket", "id", "band")
    met = heads.toDF("bucket", "x", "band").join(heads.drop("band").toDF("bucket", "y"), "bucket")
    met = met.where("x <= y AND NOT (x.large AND y.large AND x.own = y.own)").withColumn("y", F.expr("CASE WHEN x <> y THEN y END"))
    side = lambda name: blocks.select("bucket", F.col("id").alias(name), F.col("m").alias(f"m_{name}"))
    return met.join(side("x"), ["bucket", "x"]).join(side("y"), ["bucket", "y"], "left").select("band", "bucket", "m_x", "m_y"), blocks


class Block:
    """Members of a block: reps, components, registers, and the registers of each band in two words."""

    def __init__(self, members: pa.StructArray) -> None:
        self.members = members
        self.reps, self.parts = (members.field(c).to_numpy() for c in ("rep", "part"))
        self.tags = np.frombuffer(b"".join(members.field("sig").to_pylist()), TAG).reshape(-1, REGISTERS)
        wide = np.zeros((len(self.reps), BANDS, 8), TAG)
        wide[:, :, :BAND] = self.tags[:, : BANDS * BAND].reshape(-1, BANDS, BAND)
        self.bands = wide.view(np.uint64)


def open_pairs(x: Block, y: Block | None, band: int, strip: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members (i of x, j of y) in different components, first together in this band, that may reach the threshold; and their equal registers."""
    least = int(np.ceil((SIMILARITY - MARGIN) * REGISTERS))
    alone, y = y is None, y or x
    found = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int16))]
    for c in range(0, len(x.reps), strip):
        tags = x.tags[c : c + strip]
        equal = np.zeros((len(tags), len(y.reps)), np.int16)
        for column in range(REGISTERS):
            equal += tags[:, column, None] == y.tags[None, :, column]
        fit = (equal >= least) & (x.parts[c : c + strip, None] != y.parts[None, :])
        if alone:
            fit &= np.arange(c, c + len(tags))[:, None] < np.arange(len(y.reps))[None, :]
        i, j = np.nonzero(fit)
        for s in range(0, len(i), 4096):
            a, b = i[s : s + 4096], j[s : s + 4096]
            first = (x.bands[a + c] == y.bands[b]).all(axis=2).argmax(axis=1) == band
            found.append(((a[first] + c).astype(np.int32), b[first].astype(np.int32), equal[a[first], b[first]]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _open(rows: DataFrame, sigs: DataFrame) -> DataFrame:
    """bucket, band, part and rep of the members with an open pair in the bucket."""
    met, blocks = _met(rows.withColumn("size", F.lit(1)), sigs, BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                bucket, band = batch.column("bucket")[k].as_py(), batch.column("band")[k].as_py()
                x, y = Block(batch.column("m_x")[k].values), Block(batch.column("m_y")[k].values) if batch.column("m_y")[k].is_valid else None
                i, j, _ = open_pairs(x, y, band)
                sides = [(x, np.unique(np.concatenate([i, j])))] if y is None else [(x, np.unique(i)), (y, np.unique(j))]
                for side, at in sides:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), bucket)), pa.array(np.full(len(at), band, np.int32)), pa.array(side.parts[at]), pa.array(side.reps[at])], ["bucket", "band", "part", "rep"])

    found = materialize(met.mapInArrow(lean(run), "bucket long, band int, part long, rep long"), "open", 1)
    release(blocks)
    return materialize(found.distinct(), "open")


def links_of(x: Block, y: Block | None, band: int, similarity: float) -> list[tuple[int, int]]:
    """Links between components that connect what the block pair's open pairs do when all are verified."""
    i, j, equal = open_pairs(x, y, band)
    if not len(i):
        return []
    sides = [x] if y is None else [x, y]
    sets = [_sets(s.members.field("hashes"), s.members.field("counts")) for s in sides]
    nodes, at = np.unique(np.concatenate([s.parts for s in sides]), return_inverse=True)
    of_x, of_y = at[: len(x.reps)], at[-len(sides[-1].reps) :]
    up = np.arange(len(nodes))

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    links = []
    order = np.argsort(-equal, kind="stable")
    for s in range(0, len(order), 4096):
        some = order[s : s + 4096]
        roots = np.array([find(k) for k in range(len(nodes))])
        some = some[roots[of_x[i[some]]] != roots[of_y[j[some]]]]
        for a, b in zip(i[some], j[some], strict=True):
            p, q = find(of_x[a]), find(of_y[b])
            if p != q and probability_jaccard(sets[0][a], sets[-1][b]) >= similarity:
                up[max(p, q)] = min(p, q)
                links.append((int(nodes[of_x[a]]), int(nodes[of_y[b]])))
    return links


def _settled(rows: DataFrame, sigs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between components by the verified open pairs of all buckets."""
    bytes_of = sets.select("rep", (F.length("hashes") + F.length("counts") + 2 * REGISTERS).alias("size"))
    met, blocks = _met(rows.join(bytes_of, "rep"), sigs.join(sets, "rep"), BLOCK_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = Block(batch.column("m_x")[k].values), Block(batch.column("m_y")[k].values) if batch.column("m_y")[k].is_valid else None
                links = links_of(x, y, batch.column("band")[k].as_py(), similarity)
                yield pa.RecordBatch.from_arrays([pa.array([s[c] for s in links], pa.int64()) for c in (0, 1)], ["a", "b"])

    found = materialize(met.mapInArrow(lean(run), "a long, b long"), "links", 1)
    release(blocks)
    return found


def _keyed(docs: DataFrame, key: str = "_key") -> tuple[DataFrame, DataFrame | None]:
    """The rows with a doc_id, one for each distinct text of it, with a key of their own; and doc_id and _key where the two differ.

    The first text of a doc_id, by its digest, has the doc_id as key; others have a hash that is 2^62 at least. Of several rows with one doc_id and text that
    differ elsewhere the one that is smallest as JSON stays.
    """
    docs = docs.where("doc_id IS NOT NULL")
    own = F.col("doc_id").cast("long")
    repeated = materialize(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return docs.withColumn(key, own), None
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    some = docs.join(repeated, "doc_id", "left_semi").select(own.alias("_id"), F.sha2(text_or_empty().cast("binary"), 256).alias("_sha"), whole.alias("_row"), F.to_json(whole, {"ignoreNullFields": "false"}).alias("_json"))
    some = materialize(some.groupBy("_id", "_sha").agg(F.min_by("_row", "_json").alias("_row")), "texts")
    firsts = materialize(some.groupBy("_id").agg(F.min("_sha").alias("_first")), "firsts")
    other = F.shiftrightunsigned(F.xxhash64("_id", "_sha"), 2).bitwiseOR(F.lit(1 << 62))
    some = some.join(firsts, "_id").withColumn("_key", F.when(F.col("_sha") == F.col("_first"), F.col("_id")).otherwise(other))
    rows = docs.join(repeated, "doc_id", "left_anti").withColumn(key, own).unionByName(some.select("_row.*", F.col("_key").alias(key)))
    return rows, some.where("_key <> _id").select(F.col("_id").alias("doc_id"), "_key")


def groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of its near-duplicates, itself included) of every document; texts of one doc_id are in one class."""
    rows, several = _keyed(docs.select("doc_id", "text"))
    found = _text_groups(rows, similarity)
    if several is None:
        return found
    found = materialize(found, "found")
    of = lambda key, name: found.select(F.col("doc_id").alias(key), F.col("class_id").alias(name))
    edges = several.join(of("_key", "a"), "_key").join(of("doc_id", "b"), "doc_id").select("a", "b")
    united = _with_component(found, components(edges), "class_id", "class_id")
    ids = materialize(united.join(several.select(F.col("_key").alias("doc_id")), "doc_id", "left_anti").select("doc_id", "class_id"), "ids")
    least = ids.groupBy("class_id").agg(F.min("doc_id").alias("least"))
    return ids.join(least, "class_id").select("doc_id", F.col("least").alias("class_id"))


def _text_groups(rows: DataFrame, similarity: float = SIMILARITY, key: str = "_key") -> DataFrame:
    """The key of each row (no two rows have the same) as doc_id, and class_id, the smallest key of its near-duplicates."""
    docs = rows.select(F.col(key).cast("long").alias("doc_id"), text_or_empty().alias("text"))
    spark = docs.sparkSession
    every = materialize(signatures(docs), "signatures", ARROW_ROWS)
    copies = materialize(every.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "copies")
    of_doc = every.join(copies, ["k1", "k2"]).select("doc_id", "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("sig")).alias("sig"))
    of_doc = materialize(of_doc, "classes")
    release(every, copies)
    sigs = of_doc.where("sig IS NOT NULL").select("rep", "sig")

    banded = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (TAG.itemsize * BAND) + 1, F.lit(TAG.itemsize * BAND))))
    buckets = sigs.select("rep", F.posexplode(banded).alias("band", "bucket"))
    hubs = materialize(buckets.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").select("bucket", "hub"), "hubs")
    members = materialize(buckets.join(hubs, "bucket"), "buckets")
    release(hubs)
    collect_shuffles(spark)
    candidates = materialize(members.select("rep").distinct(), "candidates")
    sigs = materialize(sigs.join(candidates, "rep", "left_semi"), "sigs")
    sets = materialize(weighted_sets(docs.join(candidates, F.col("doc_id") == F.col("rep"), "left_semi")), "sets", ARROW_ROWS)
    collect_shuffles(spark)

    stars = materialize(_estimated(members.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(), sigs), "stars", 2048)
    first = materialize(stars.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b")), "first")
    links = materialize(verified(first, sets, similarity), "links", 128)
    parts = materialize(components(links), "parts")
    collect_shuffles(spark)

    dealt = materialize(_with_component(members.select("bucket", "band", "rep"), parts, "rep", "part"), "members")
    mixed = materialize(dealt.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("bucket"), "mixed")
    left = materialize(dealt.join(mixed, "bucket", "left_semi"), "left")
    release(members, stars, first, dealt, mixed)
    still = _open(left, sigs)
    more = _settled(still, sigs, sets, similarity)
    whole = components(more)
    found = _with_component(_with_component(of_doc.select("doc_id", "rep"), parts, "rep", "part"), whole, "part", "class_id").select("doc_id", "class_id")
    found = materialize(found, "groups")
    release(of_doc, candidates, sigs, sets, links, parts, left, still, more)
    collect_shuffles(spark)
    return found


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, one with the smallest doc_id, with all columns of docs, whatever their names.

    Different texts of a doc_id count as documents; of rows with one doc_id and text the one that is smallest as JSON stays; rows without a doc_id stay; a null text counts as
    empty, and empty texts are one group; an empty table stays empty.
    """
    (key,) = apart(docs, "_key")
    rows, _ = _keyed(docs, key)
    kept = _text_groups(rows, key=key).where("doc_id = class_id").select(F.col("doc_id").alias(key))
    return rows.join(kept, key, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where("doc_id IS NULL"))
