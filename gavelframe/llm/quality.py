"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words, its character 3- to 5-grams (within a
word, with its boundaries) and a hashed token for each pair of neighbouring words, which stands for the pair's
shape alone: if the second word is the first again. (Pairs by their words can't tell a text that repeats any
one word: see the README for figures.) A softmax over two classes reads the average. Vectors and softmax are trained
together by stochastic gradient descent in numpy, in one Spark task, on a bounded sample of labelled rows;
scoring runs in Spark tasks over every whole text. As the softmax is linear in the average, the trained model folds into
one logit per hash bucket, which is what the tasks receive (BUCKETS floats, whatever the corpus size).

Defined cases: a null text counts as empty; an empty text has no features and gets the bias alone;
rows without a usable label (quality not 0 or 1) are not trained on; if a document has several labels the
largest holds; with no labelled rows at all every score is 0.5, with one class only the training still
runs. A null doc_id is scored and is not held out; repeated rows are each scored; a very long text is scored whole; an empty
table gives no rows. Other columns of the inputs are ignored, or kept by score() and the stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ARROW_ROWS, MUL, apart, arrow_rows, chunks, lean, materialize, mix64, span_hashes, table

BUCKET_BITS = 17
DIM = 8
NGRAMS = (3, 4, 5)
#: Upper bound of the labelled rows that are fitted on, the smallest by a hash of their id.
TRAIN_ROWS = 5000
EPOCHS = 6
THRESHOLD = 0.7
SEED = 17
CHUNK_CHARS = 150_000


def _ids(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix64(hashes + np.uint64(kind * int(MUL) % 2**64)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature (words, repetition tokens, then 3-, 4- and 5-grams): bucket ids and, ascending, their texts' index."""
    words = [" ".join(t.split()) for t in texts]
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    joined = "".join(f" {w} " for w in words)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    space = chars == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    hashes, owners = span_hashes(chars, starts, ends), owner[starts]
    yield _ids(hashes, 1), owners
    # a pair token for each word: does it repeat the word before it, in any text
    again = (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])
    yield _ids(again.astype(np.uint64), 2), owners[1:]
    rolled, inside = chars, None
    for n in range(2, max(NGRAMS) + 1):
        if len(chars) < n:
            return
        rolled = rolled[:-1] * MUL + chars[n - 1 :]
        if n > 2:
            middle = space[n - 2 : len(chars) - 1]
            inside = middle if inside is None else inside[:-1] | middle
            if n in NGRAMS:
                at = np.flatnonzero(~inside)
                yield _ids(rolled[at], n), owner[at]


class Model:
    """weights: one logit per bucket; bias: the logit of a text without features."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, j in chunks(texts, CHUNK_CHARS):
            total, count = np.zeros(j - i), np.zeros(j - i)
            for ids, owner in features(texts[i:j]):
                total += np.bincount(owner, self.weights[ids], j - i)
                count += np.bincount(owner, minlength=j - i)
            out[i:j] = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """examples: (bucket ids, their shares in the text, label)."""
    rng = np.random.default_rng(SEED)
    n = 1 << BUCKET_BITS
    if not examples:
        return Model(np.zeros(n, np.float32), 0.0)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (n, DIM)).astype(np.float32)
    share = float(np.clip(np.mean([y for *_, y in examples]), 0.01, 0.99))
    softmax = np.zeros((2, DIM), np.float32)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    softmax[1] = rng.normal(0, 0.3, DIM)
    softmax[0] = -softmax[1]
    step, steps = 0, EPOCHS * len(examples)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(examples)):
            ids, part, y = examples[k]
            rate = 1.0 * (1 - step / steps) + 0.01
            step += 1
            mean = part @ vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
            z = softmax @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            if len(ids):
                # every vector moves by its share of the text, scaled up by the number of distinct features
                vectors[ids] -= np.outer(np.minimum(part * len(ids), 4.0) * (rate * 0.5), p @ softmax)
                softmax -= rate * 0.2 * np.outer(p, mean)
            bias -= rate * 0.05 * p
    folded = vectors @ (softmax[1] - softmax[0])
    return Model(folded.astype(np.float32), float(bias[1] - bias[0]))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, shares = [], []
        for text in batch.column("text").to_pylist():
            found = [x for x, _ in features([text or ""])]
            unique, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int32), np.zeros(0))
            ids.append(unique.astype(np.int32).tobytes())
            shares.append((counts / max(counts.sum(), 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(shares, pa.binary()), batch.column("label").cast(pa.int32())], ["ids", "shares", "label"])


def held_out(doc_id: str = "doc_id"):
    """True for the rows that are never trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> Model:
    """Train on at most max_rows labelled rows that are not held out."""
    usable = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(usable), "doc_id").select("doc_id", "text", "label")  # at most max_rows ids
    bags = rows.mapInArrow(lean(_bags), "ids binary, shares binary, label int")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [(np.frombuffer(i, np.int32), np.frombuffer(s, np.float32), y) for batch in batches for i, s, y in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        model = train(sorted(examples, key=lambda e: (e[2], e[0].tobytes())))
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    # one task trains on the bounded sample and returns the folded model
    with arrow_rows(docs.sparkSession):
        model = bags.repartition(1).mapInArrow(lean(learn), "weights binary, bias double").collect()
    return Model(np.frombuffer(model[0].weights, np.float32), model[0].bias) if model else train([])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score double and predicted int (under these names, instead of columns of docs that have them); every whole text is scored. Run it within arrow_rows()."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.weights, model.bias))
    keep = [c for c in docs.columns if c not in names]
    docs = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)))  # names with a dot don't get through mapInArrow
    schema = T.StructType([*docs.schema]).add("score", "double").add("predicted", "integer")
    at = keep.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            scores = own.score([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))], schema.names)

    return docs.mapInArrow(lean(run), schema).toDF(*keep, *names)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    small = docs.select("doc_id", held_out().alias("held_out"), "text")
    return materialize(score(small, model).select("doc_id", "held_out", "score", "predicted"), "scores", ARROW_ROWS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, with the columns of documents.

    Rows with a null text or doc_id and repeated rows are judged like others; no row is accepted without labels (all score
    0.5); an empty table stays empty; columns of docs may have any names.
    """
    model = fit(docs, table(spark, sf_dir, "labels"))
    names = tuple(apart(docs, "_gf_score", "_gf_predicted"))
    # written once, which costs less than a join that shuffles all texts to the verdicts
    return materialize(score(docs, model, names=names).where(F.col(names[1]) == 1).select(*(F.col(f"`{c}`") for c in docs.columns)), "accepted", ARROW_ROWS)
