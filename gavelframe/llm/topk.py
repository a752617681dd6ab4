"""Exact top-k search by a three-phase uniform threshold.

Vectors are cut into SLICES groups of dimensions, so that a score is the sum of one partial score per slice.

1. Each (block of queries, block of candidates, slice) is a task that gathers a list of the LIST best partial scores of every query (places in the
   block and scores, packed), and the lowest partial score. The first NEAR * k of each list, summed, with the lowest standing in for what isn't among them, bound scores
   from below. The NEAR * k candidates with the highest bounds get their exact scores, of which the k-th best is a safe cutoff whatever
   the others score.
2. A candidate that reaches the cutoff has a partial score of cutoff / SLICES at least in some slice. A list whose last entry is below that
   holds all such candidates of its block. So for a query and a block whose lists all end below, the sufficient entries are in the lists already;
   only where a list ends above is the query open in that block, and its row of partial scores is computed once more.
3. Block pairs with something left get the cutoffs, the open queries and the sufficient entries: the entries' scores are resolved one by one,
   an open query's sufficient ones from its row; those that reach the cutoff are sent, the k best of a block at most, and the k best of all
   are the answer. So what is computed again follows the open lists, and what is sent the number of queries and blocks.

Blocks are filled by a hash (BLOCK rows on average) and joined by number; all candidates meet all queries.

Components become floor(256 * x), x as double. Scores are exact integers below 2^63; a block whose products
could leave 2^53 is multiplied in 64-bit integers.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, as query or
candidate; vectors of different lengths don't meet; a vec_id on several rows counts once, by its smallest
vector; null vec_ids take no part; ties go to the smaller vec_id; with fewer than k candidates all return; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, release, table
from .vector_dedup import usable

K = 5
NEAR = 4
SLICES = 2
BLOCK = 4096
#: Entries of a list: with 64 dimensions and BLOCK candidates nearly all lists then end below the cutoff (README).
LIST = 128
QUERY_BLOCK = 1024
#: Pairs of blocks in an Arrow batch.
BLOCK_PAIRS = 4
#: Queries that are compared with a block at a time.
STRIP = 256


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id and v array<long> of the usable vectors, one row per vec_id."""
    good = vectors.where(usable() & F.col("vec_id").isNotNull())
    one = good.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("e"))
    return one.select("vec_id", F.transform(F.col("e").cast("array<double>"), lambda x: F.floor(x * 256.0)).alias("v"))


def _blocks(rows: DataFrame, per_block: int, name: str) -> DataFrame:
    """block, dim, ids binary, parts array<binary>: the rows of a hash block, cut into slices of dimensions."""
    count = max(1, -(-rows.count() // per_block))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        ids, matrix = group["vec_id"].to_numpy(np.int64).tobytes(), np.array(group["v"].tolist(), np.int64)
        parts = np.array_split(matrix, min(SLICES, matrix.shape[1]), axis=1)
        return pd.DataFrame({"block": key[0], "dim": key[1], "ids": [ids], "parts": [[np.ascontiguousarray(p).tobytes() for p in parts]]})

    keyed = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(count)).alias("block"), F.size("v").alias("dim"), "vec_id", "v")
    return materialize(keyed.groupBy("block", "dim").applyInPandas(run, "block long, dim int, ids binary, parts array<binary>"), name)


def _sliced(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", "dim", "ids", F.posexplode("parts").alias("slice", "part"))


def _paired(queries: DataFrame, candidates: DataFrame, by: list[str], which: DataFrame | None = None) -> DataFrame:
    """Every block of queries beside every block of candidates that agrees with it in the columns by; of which only those with a row in the table which, with its columns."""
    side = lambda df, s: df.select(*by, *(F.col(c).alias(f"{c}_{s}") for c in df.columns if c not in by))
    numbers = lambda df, s: df.select(*by, F.col("block").alias(f"block_{s}"))  # noqa: E731  # block numbers only, no vectors
    pairs = numbers(queries, "q").join(numbers(candidates, "c"), by) if which is None else which
    pairs = pairs.repartition(*by, "block_q", "block_c")
    return pairs.join(side(candidates, "c"), [*by, "block_c"]).join(side(queries, "q"), [*by, "block_q"])


def _products(q_part: bytes, c_part: bytes, n_q: int, n_c: int) -> np.ndarray:
    """The integer partial scores of a pair of blocks in one slice."""
    q, c = np.frombuffer(q_part, "<i8").reshape(n_q, -1), np.frombuffer(c_part, "<i8").reshape(n_c, -1)
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2.0**53:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    return q @ c.T


def local_best(pairs: DataFrame, k: int, length: int = LIST) -> DataFrame:
    """Phase 1: a row for each query, block and slice with the list of its best partial scores.

    vecs and partials: the NEAR * k best; low: the lowest partial score of all; places and values: the `length` best, packed, in any order; last: the lowest of these;
    whole: whether these are all candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids = np.frombuffer(row["ids_q"], "<i8"), np.frombuffer(row["ids_c"], "<i8")
                scores = _products(row["part_q"], row["part_c"], len(q_ids), len(c_ids))
                low = scores.min(axis=1)
                own = q_ids[:, None] == c_ids[None, :]
                scores[own] = -np.iinfo(np.int64).max  # the minimum itself can't be negated
                n = min(max(NEAR * k, length), len(c_ids))
                top = np.argpartition(-scores, n - 1, axis=1)[:, :n] if n < len(c_ids) else np.broadcast_to(np.arange(n), (len(q_ids), n))
                lists = np.take_along_axis(scores, top, axis=1)
                first = np.argsort(-lists, axis=1, kind="stable")[:, : NEAR * k]
                vecs, partials, places, values = [], [], [], []
                for i in range(len(q_ids)):  # a list is a few arrays
                    best, fine = first[i], ~own[i, top[i]]
                    best = best[fine[best]]
                    vecs.append(c_ids[top[i, best]])
                    partials.append(lists[i, best])
                    places.append(top[i, fine].astype("<u4").tobytes())
                    values.append(lists[i, fine].astype("<i8").tobytes())
                rows = len(q_ids)
                same = [pa.array(np.full(rows, row[c], np.int64)) for c in ("dim", "block_q", "block_c", "slice")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids), *same, pa.array(vecs, pa.list_(pa.int64())), pa.array(partials, pa.list_(pa.int64())), pa.array(low), pa.array(places, pa.binary()), pa.array(values, pa.binary()), pa.array(lists.min(axis=1)), pa.array(np.full(rows, n == len(c_ids)))],
                    ["query_id", "dim", "block_q", "block_c", "slice", "vecs", "partials", "low", "places", "values", "last", "whole"],
                )

    return pairs.mapInArrow(run, "query_id long, dim long, block_q long, block_c long, slice long, vecs array<long>, partials array<long>, low long, places binary, values binary, last long, whole boolean")


def work_left(sent: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Phase 2: dim, block_q, block_c, open (queries whose rows are computed once more) and lists (query_id, places, values: those of the others with a sufficient entry).

    Every list of a query and a block counts: if one of them ends at cutoff / SLICES or above and isn't whole, the query is open there. Without a cutoff
    (fewer than k candidates in all) lists that aren't whole are open, and whole ones have all entries.
    """
    known = sent.join(cutoffs, "query_id", "left").withColumn("least", F.expr(f"CASE WHEN cutoff > 0 THEN (cutoff + least({SLICES}, dim) - 1) div least({SLICES}, dim) ELSE cutoff div least({SLICES}, dim) END"))
    beyond = ~F.col("whole") & (F.col("least").isNull() | (F.col("last") >= F.col("least")))
    fits = F.col("least").isNull() | (F.array_max("partials") >= F.col("least"))
    kept = F.when(fits & (F.length("places") > 0), F.struct("query_id", "places", "values"))
    lists = known.groupBy("dim", "block_q", "block_c", "query_id").agg(F.bool_or(beyond).alias("open"), F.collect_list(kept).alias("lists"))  # SLICES at most
    some = lists.where(F.col("open") | (F.size("lists") > 0))
    # no more than the queries of a block
    return some.groupBy("dim", "block_q", "block_c").agg(F.collect_list(F.when(F.col("open"), F.col("query_id"))).alias("open"), F.flatten(F.collect_list(F.when(~F.col("open"), F.col("lists")))).alias("lists"))


def collected(q_ids: np.ndarray, c_ids: np.ndarray, partials: list[np.ndarray], least: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, exact score) of the entries of open queries that some slice collects and that reach the cutoff least (all for queries without a known one)."""
    enough = np.zeros(partials[0].shape, bool)
    for partial in partials:
        enough |= partial >= -(-least // len(partials))[:, None]
    enough |= ~known[:, None]
    i, j = np.nonzero(enough & (q_ids[:, None] != c_ids[None, :]))
    score = sum(partial[i, j] for partial in partials)
    fine = (score >= least[i]) | ~known[i]
    return i[fine], j[fine], score[fine]


def best_of(i: np.ndarray, j: np.ndarray, score: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each query."""
    order = np.lexsort((c_ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k], score[place < k]


def over_cutoff(pairs: DataFrame, k: int) -> DataFrame:
    """Phase 3: query_id, vec_id, score of what each pair of blocks sends, given its open queries, the lists of the others and the cutoffs of its queries (cutoff_ids and cutoffs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids = np.frombuffer(row["ids_q"], "<i8"), np.frombuffer(row["ids_c"], "<i8")  # both ascend
                told = dict(zip(row["cutoff_ids"], row["cutoffs"], strict=True))
                least = np.array([told.get(int(q), 0) for q in q_ids], np.int64)
                known = np.array([int(q) in told for q in q_ids], bool)
                side = lambda parts, n: [np.frombuffer(p, "<i8").reshape(n, -1) for p in parts]
                qs, cs = side(row["parts_q"], len(q_ids)), side(row["parts_c"], len(c_ids))
                found = []
                for e in row["lists"]:
                    i = int(np.searchsorted(q_ids, e["query_id"]))
                    places, values = np.frombuffer(e["places"], "<u4").astype(np.int64), np.frombuffer(e["values"], "<i8")
                    j = places[values >= -(-least[i] // len(qs))] if known[i] else places
                    found.append((np.full(len(j), i), j, sum(c[j] @ q[i] for q, c in zip(qs, cs, strict=True))))
                if found:  # an entry may be in the lists of several slices
                    i, j, score = (np.concatenate(x) for x in zip(*found, strict=True))
                    _, once = np.unique(i * len(c_ids) + j, return_index=True)
                    i, j, score = i[once], j[once], score[once]
                    fine = (score >= least[i]) | ~known[i]
                    found = [(i[fine], j[fine], score[fine])]
                rows = np.searchsorted(q_ids, np.sort(np.array(row["open"], np.int64)))
                for s in range(0, len(rows), STRIP):
                    some = rows[s : s + STRIP]
                    partials = [_products(np.ascontiguousarray(q[some]).tobytes(), p, len(some), len(c_ids)) for q, p in zip(qs, row["parts_c"], strict=True)]
                    i, j, score = collected(q_ids[some], c_ids, partials, least[some], known[some])
                    found.append((some[i], j, score))
                if found:
                    i, j, score = best_of(*(np.concatenate(x) for x in zip(*found, strict=True)), c_ids, k)
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(c_ids[j]), pa.array(score, pa.int64())], ["query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "query_id long, vec_id long, score long")


def _kth(bounds: DataFrame, k: int, column: str) -> DataFrame:
    """query_id and its k-th largest bound; queries with fewer have none."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(column), "vec_id"))
    return bounds.withColumn("place", place).where(F.col("place") == k).select("query_id", F.col(column).alias("cutoff"))


def top_k(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each row for which is_query (a Column) holds."""
    rows = materialize(quantized(vectors), "quantized")
    queries, candidates = _blocks(rows.where(is_query), QUERY_BLOCK, "queries"), _blocks(rows, BLOCK, "candidates")
    sent = materialize(local_best(_paired(_sliced(queries), _sliced(candidates), ["dim", "slice"]), k), "local", BLOCK_PAIRS)
    lows = sent.groupBy("query_id", "slice").agg(F.min("low").alias("low"))
    floor = lows.groupBy("query_id").agg(F.sum("low").alias("floor"))
    heads = sent.select("query_id", "slice", F.explode(F.arrays_zip("vecs", "partials")).alias("e")).select("query_id", "slice", F.col("e.vecs").alias("vec_id"), F.col("e.partials").alias("partial"))
    bounds = heads.join(lows.select("query_id", "slice", F.col("low").alias("slice_low")), ["query_id", "slice"]).groupBy("query_id", "vec_id").agg(F.sum(F.col("partial") - F.col("slice_low")).alias("above"))
    bounds = bounds.join(floor, "query_id").select("query_id", "vec_id", (F.col("above") + F.col("floor")).alias("bound"))
    v = lambda name, column: rows.select(F.col("vec_id").alias(name), F.col("v").alias(column))
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "vec_id"))
    near = materialize(bounds.withColumn("place", place).where(F.col("place") <= NEAR * k).select("query_id", "vec_id"), "near")
    near = near.join(v("query_id", "a"), "query_id").join(v("vec_id", "b"), "vec_id").select("query_id", "vec_id", product.alias("bound"))
    cutoffs = materialize(_kth(near, k, "bound"), "cutoffs")
    # the cutoffs of a block of queries (QUERY_BLOCK numbers) travel with the block
    count = max(1, -(-rows.where(is_query).count() // QUERY_BLOCK))
    in_block = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.pmod(F.xxhash64("vec_id"), F.lit(count)).alias("block"))
    sets = in_block.join(cutoffs, "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "cutoff")).alias("c"))
    none = F.array().cast("array<long>")
    told = queries.join(sets, "block", "left").select(*queries.columns, F.coalesce(F.col("c.query_id"), none).alias("cutoff_ids"), F.coalesce(F.col("c.cutoff"), none).alias("cutoffs"))
    left = materialize(work_left(sent, cutoffs), "left")
    told = _paired(told, candidates, ["dim"], left).withColumnsRenamed({"cutoff_ids_q": "cutoff_ids", "cutoffs_q": "cutoffs"})
    scores = materialize(over_cutoff(told, k), "scores", BLOCK_PAIRS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = materialize(scores.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "top")
    release(rows, queries, candidates, sent, cutoffs, left, scores)
    return out


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, unnest(v) AS a, generate_subscripts(v, 1) AS i FROM v WHERE vec_id % 50 = 0),
c AS (SELECT vec_id, unnest(v) AS b, generate_subscripts(v, 1) AS i FROM v),
s AS (SELECT query_id, vec_id, CAST(sum(a * b) AS BIGINT) AS score FROM q JOIN c USING (i) WHERE query_id <> vec_id GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
