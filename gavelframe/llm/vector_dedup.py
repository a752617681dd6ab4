"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors of one label are rotated into the order of their principal components and sorted by the cells that their leading
components fall into (half as wide as vectors of the wanted cosine can be apart); runs of TILE vectors form
tiles, boxes in the leading components. Two tiles meet only if their boxes are no further apart than that; they
find each other by the cells of the first component, so that only neighbours are ever joined. For a pair of
tiles the leading dimensions are multiplied first; a pair of vectors whose partial product plus the product of its suffix
norms (Cauchy-Schwarz) can't reach the threshold stops there. Survivors get the exact cosine of the original
vectors in double precision. The rotation is fitted on a bounded sample (SAMPLE vectors, in one task that
returns their Gram matrix) and only changes the speed: any rotation gives the same links.

Equal vectors of a label are one vector with a count, so that a group of copies of any size costs one row. A
pair of tiles returns a count and a local component for each vector at most, never its links.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
label, link with nothing; vectors of different lengths don't link; a vec_id on several rows counts once, by
its smallest row; rows with a null vec_id are left out; a cosine of exactly the threshold links; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, release, table
from .graph import components

COSINE = 0.93
TILE = 1024
LEADS = 4
STEP = 16
SAMPLE = 20_000
#: The narrowest cells of the first component, and tiles that one task cuts (on average).
LEAST_CELL, TILES_TOGETHER = 0.05, 8
SLACK = 1e-9


def usable(column: str = "embedding"):
    """True for a vector with finite components only."""
    v = F.col(column).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~odd, F.lit(False))


def _rotation(reps: DataFrame, dim: int) -> np.ndarray:
    """The principal components of a bounded sample, one task's Gram matrix of dim * dim numbers."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = unit(np.array(batch.column("e").to_pylist(), float).reshape(batch.num_rows, dim))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["gram"])

    sample = reps.where(F.size("embedding") == dim).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select(F.col("embedding").cast("array<double>").alias("e"))
    sums = sample.mapInArrow(gram, "gram binary").collect()
    return np.linalg.eigh(sum(np.frombuffer(r.gram).reshape(dim, dim) for r in sums))[1][:, ::-1].copy()


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def links(a: np.ndarray, b: np.ndarray, ya: np.ndarray, yb: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of unit vectors a, b (rotated: ya, yb) whose cosine is at least cosine."""
    d = a.shape[1]
    lead = min(STEP, d)
    partial = ya[:, :lead] @ yb[:, :lead].T
    tail = lambda y, k: np.sqrt(np.maximum((y[:, k:] ** 2).sum(axis=1), 0))
    partial += np.outer(tail(ya, lead), tail(yb, lead))
    i, j = np.nonzero(partial >= cosine - SLACK)
    sums = partial[i, j] - tail(ya, lead)[i] * tail(yb, lead)[j]
    while lead < d and len(i):
        more = min(lead + STEP, d)
        sums = sums + np.einsum("ij,ij->i", ya[i, lead:more], yb[j, lead:more])
        lead = more
        alive = sums + tail(ya, lead)[i] * tail(yb, lead)[j] >= cosine - SLACK
        i, j, sums = i[alive], j[alive], sums[alive]
    exact = np.einsum("ij,ij->i", a[i], b[j])
    return i[exact >= cosine], j[exact >= cosine]


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over links i-j."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[i], low[j])
        after = low.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = after[after]
        if (after == low).all():
            return low
        low = after


def _reach(cosine: float) -> float:
    """How far apart unit vectors of at least this cosine can be."""
    return math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK


def _cell(cosine: float) -> float:
    return max(_reach(cosine), LEAST_CELL)


def tiles(reps: DataFrame, rotations: dict[int, np.ndarray], cosine: float = COSINE, per_tile: int = TILE) -> DataFrame:
    """One row per tile: label, dim, tile, lo and hi of the leading components, ids, copies, unit vectors."""
    spark = reps.sparkSession
    sent = spark.sparkContext.broadcast(rotations)  # one square matrix per length of vectors

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, blobs = [], []
            for e in batch.column("embedding").to_pylist():
                u = unit(np.array([e]))
                cells.append(np.floor((u @ sent.value[len(e)][:, :LEADS])[0] / (_cell(cosine) / 2)).astype(int).tolist())
                blobs.append(u[0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("label"), batch.column("copies"), pa.array([len(b) // 8 for b in blobs], pa.int32()), pa.array(cells, pa.list_(pa.int32())), pa.array(blobs, pa.binary())], ["rep", "label", "copies", "dim", "cells", "unit"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, number = ["label", "dim", "tile", "lo", "hi", "ids", "copies", "units"], [], 0

        def tile(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            rep, label, copies, dim, _, blobs = zip(*rows, strict=True)
            y = np.frombuffer(b"".join(blobs)).reshape(len(rows), -1) @ sent.value[dim[0]]
            number += 1
            values = [[label[0]], [dim[0]], [(TaskContext.get().partitionId() << 32) + number], [y[:, :LEADS].min(axis=0).tolist()], [y[:, :LEADS].max(axis=0).tolist()], [np.array(rep, "<i8").tobytes()], [np.array(copies, "<i8").tobytes()], [b"".join(blobs)]]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) == per_tile or held[-1][1] != row[1] or held[-1][3] != row[3]):
                    yield tile(held)
                    held = []
                held.append(row)
        if held:
            yield tile(held)

    rows = reps.select("rep", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"), "copies")
    led = materialize(rows.mapInArrow(lead, "rep long, label string, copies long, dim int, cells array<int>, unit binary"), "led", 4096)
    ranges = max(1, -(-led.count() // (TILES_TOGETHER * per_tile)))
    spread = led.repartitionByRange(ranges, "label", "dim", "cells", "rep").sortWithinPartitions("label", "dim", "cells", "rep")
    found = spread.mapInArrow(cut, "label string, dim int, tile long, lo array<double>, hi array<double>, ids binary, copies binary, units binary")
    found._gf_led = led
    return found


def tile_pairs(tiled: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b) tiles of a label whose boxes are near enough."""
    reach, cell = _reach(cosine), _cell(cosine)
    meta = tiled.select("label", "dim", "tile", "lo", "hi")
    at = lambda x: F.floor(x / cell)
    side = lambda s, low, high: meta.select("label", "dim", *(F.col(c).alias(f"{c}_{s}") for c in ("tile", "lo", "hi")), at(low).alias(f"from_{s}"), F.explode(F.sequence(at(low), at(high))).alias("cell"))
    a, b = side("a", F.col("lo")[0], F.col("hi")[0]), side("b", F.col("lo")[0] - reach, F.col("hi")[0] + reach)
    # of the cells that two tiles share, the first one counts
    pairs = a.join(b, ["label", "dim", "cell"]).where("tile_a <= tile_b AND cell = greatest(from_a, from_b)")
    gap = lambda k: F.greatest(F.lit(0.0), F.col("lo_a")[k] - F.col("hi_b")[k], F.col("lo_b")[k] - F.col("hi_a")[k])
    apart = sum(F.when(F.size("lo_a") > k, gap(k) * gap(k)).otherwise(0.0) for k in range(LEADS))
    return pairs.where(apart <= reach * reach).select("tile_a", "tile_b")


def compare(tiled: DataFrame, rotations: dict[int, np.ndarray], cosine: float = COSINE) -> DataFrame:
    """rep, n (copies of the vectors linked with it in a pair of tiles), root (smallest rep joined with it there)."""
    spark = tiled.sparkSession
    sent = spark.sparkContext.broadcast(rotations)
    body = tiled.select("tile", "dim", "ids", "copies", "units")
    side = lambda s: body.select(*(F.col(c).alias(f"{c}_{s}") for c in body.columns))
    joined = tile_pairs(tiled, cosine).repartition("tile_a", "tile_b").join(side("a"), "tile_a").join(side("b"), "tile_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["tile_a"] == row["tile_b"]
                ids = [np.frombuffer(row[f"ids_{s}"], "<i8") for s in "ab"]
                copies = [np.frombuffer(row[f"copies_{s}"], "<i8") for s in "ab"]
                a, b = (np.frombuffer(row[f"units_{s}"]).reshape(len(ids[k]), -1) for k, s in enumerate("ab"))
                turn = sent.value[row["dim_a"]]
                i, j = links(a, b, a @ turn, b @ turn, cosine)
                if same:
                    i, j = i[i < j], j[i < j]
                    every, weight = ids[0], copies[0]
                else:
                    every, weight, j = np.concatenate(ids), np.concatenate(copies), j + len(ids[0])
                order = np.argsort(every, kind="stable")  # so that the smallest index is the smallest id
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                count = np.bincount(i, weight[j], len(every)) + np.bincount(j, weight[i], len(every))
                root = every[order][_local_roots(len(every), place[i], place[j])][place]
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(every[at]), pa.array(count[at].astype(np.int64)), pa.array(root[at])], ["rep", "n", "root"])

    return joined.mapInArrow(run, "rep long, n long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vec_id of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.where("vec_id IS NOT NULL").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", "v.embedding")
    nonzero = F.exists(F.col("embedding"), lambda x: x != 0)
    rows = materialize(rows.withColumn("fine", F.coalesce(usable() & nonzero & F.col("label").isNotNull(), F.lit(False))), "rows")
    good = rows.where("fine").drop("fine")
    reps = materialize(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    dims = [r.d for r in reps.select(F.size("embedding").alias("d")).distinct().collect()]  # lengths of vectors, one in practice
    rotations = {d: _rotation(reps, d) for d in dims}
    cut = tiles(reps, rotations, cosine)
    tiled = materialize(cut, "tiles", 4096)
    release(cut._gf_led)
    found = materialize(compare(tiled, rotations, cosine), "links", 8)
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_rep = reps.select("rep", "label", "embedding", "copies").join(counts, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    alone = rows.where("NOT fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = good.join(of_rep, ["label", "embedding"]).select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = materialize(linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id")), "classes")
    release(rows, reps, tiled, found)
    return out


def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
