"""Spelling variants: words one edit apart, grouped under their most frequent form.

1. Tasks count the words of whole texts (at most FLUSH at a time); counts are summed by word and words seen once go.
2. Symmetric deletes: every word emits itself and each distinct string that it becomes by losing one code point, as a 64-bit
   hash from prefix sums, so that a word of n code points costs n rows of fixed size and time in proportion to n. Deletions
   inside a run of one letter are the same string and count once, at the first place of the run.
3. An equi-join of the keys pairs words; the pair stands if the two strings behind the keys are equal (which leaves no
   collisions) and the words are exactly one insertion, deletion or replacement apart. Two near words share exactly one such
   string, so that no pair comes twice. Words of up to LONG code points travel with their keys; longer ones are looked up by
   a hash for the few pairs they are in.
4. Forms are the smallest struct (-n, word) of the near words. Roots follow forms by a join of the table with itself until nothing moves:
   each form is ten times as frequent as its word, hence there are no cycles, and the way doubles each time.

A key's words differ in one letter at one place each, so its size is bounded by the alphabet (94 letters) times the word's length, whatever the
number of rows; frequent words are one row.

Defined cases: null texts have no words; null doc_ids count as empty text in the checksum that plants deletions; repeated rows count again;
ties of n go to the word that is smaller in code points; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ARROW_ROWS, MUL, POWERS, materialize, mix64, release, table

MIN_LENGTH = 7
MIN_COUNT = 2
#: A word's form is at least so many times as frequent.
RATIO = 10
#: One in so many occurrences loses a code point (an audit of the method by planted errors); None for none.
PLANT = 31
#: Code points up to which words travel with their keys.
LONG = 64
#: Distinct words that a task holds before it sends its counts on.
FLUSH = 500_000
#: Code points of a text that are cut into words at a time.
PIECE = 1 << 22
#: Words whose keys a task makes; the table of words is small beside that of their keys, so that the size of its files doesn't deal them out.
TASK_WORDS = 20_000
#: Keys in a batch.
KEY_ROWS = 1 << 16

#: Latin-1 bytes: letters stay (A-Z are lower-cased before), the rest parts words.
FOLD = bytes(b if chr(b) in "abcdefghijklmnopqrstuvwxyz" or b >= 0xC0 else 0x20 for b in range(256))


def runs(text: str, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Maximal runs of letters, A-Z lower-cased, as Latin-1, a list for each piece of the text."""
    data = text.encode("latin-1", "replace").lower().translate(FOLD)  # a character beyond Latin-1 becomes ?, which is no letter
    at = 0
    while at < len(data):
        end = at + piece
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _counter(min_length: int, plant: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in counts]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                start = zlib.crc32(f"{name.as_py()}:".encode())
                for some in runs(text.as_py()):
                    words = [w for w in some if len(w) >= min_length]
                    if plant:
                        for k, w in enumerate(words):
                            h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                            if h % plant == 0:
                                at = h % len(w)
                                words[k] = w[:at] + w[at + 1 :]
                        words = [w for w in words if len(w) >= min_length]
                    counts.update(words)
                if len(counts) >= FLUSH:
                    yield rows()
        yield rows()

    return run


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, plant: int | None = PLANT) -> DataFrame:
    """word, n of the words that occur min_count times."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(_counter(min_length, plant), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def deletion_keys(word: str) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): hashes of the word (place -1) and of what it is without the code point at each place that begins a run of one letter."""
    units = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    up, down = POWERS.get(len(units) + 1)
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * up[: len(units)], out=sums[1:])
    places = np.flatnonzero(np.r_[True, units[1:] != units[:-1]]) if len(units) else np.zeros(0, np.int64)
    without = sums[places] + (sums[-1] - sums[places + 1]) * down[1]
    whole = np.r_[sums[-1:], without]
    lengths = np.r_[np.uint64(len(units)), np.full(len(places), max(len(units) - 1, 0), np.uint64)]
    return mix64(whole + lengths * MUL).view(np.int64), np.r_[-1, places].astype(np.int32)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word or ref, n -> key, place, word or ref, n."""
    for batch in batches:
        held: list[tuple] = []
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            if held:
                counts = np.array([len(keys) for keys, _, _ in held])
                place = pa.array(np.repeat([i for _, _, i in held], counts))
                keys, places = np.concatenate([k for k, _, _ in held]), np.concatenate([p for _, p, _ in held])
                carried = [batch.column(c).take(place) for c in range(1, batch.num_columns)]
                whole = pa.table([pa.array(keys), pa.array(places), *carried], names=["key", "place", *batch.schema.names[1:]])
                yield from whole.combine_chunks().to_batches(max_chunksize=KEY_ROWS)
                held.clear()

        for i, word in enumerate(batch.column(0)):
            keys, places = deletion_keys(word.as_py())
            held.append((keys, places, i))
            size += len(keys)
            if size >= KEY_ROWS:
                yield from rows()
                size = 0
        yield from rows()


def _without(word: Column, place: Column) -> Column:
    return F.when(place < 0, word).otherwise(F.concat(F.substr(word, F.lit(1), place), F.substr(word, place + 2)))


def is_near(a: Column, at: Column, b: Column, bt: Column) -> Column:
    """Whether words a and b, which lost the code point at places at and bt (-1: none), became the same string and are one edit apart."""
    i = F.greatest(at, bt)  # a replacement is at the later of the two run starts
    replaced = (F.length(a) == F.length(b)) & (a != b) & (F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i)) & (F.substr(a, i + 2) == F.substr(b, i + 2))
    lost = (F.least(at, bt) < 0) & (F.length(a) != F.length(b))
    return (_without(a, at) == _without(b, bt)) & (lost | ((F.least(at, bt) >= 0) & replaced))


def near_words(words: DataFrame, long: int = LONG) -> DataFrame:
    """a, b, n_a, n_b: each unordered pair of near words once."""
    size, words = F.length("word"), words.repartition(max(1, -(-words.count() // TASK_WORDS)), "word")
    # words of up to `long` code points among themselves
    short = words.where(size <= long).select("word", F.col("word").alias("w"), "n").mapInArrow(_emit, "key long, place int, w string, n long")
    short = materialize(short, "short-keys")
    one = lambda df, s: df.select("key", *(F.col(c).alias(f"{c}_{s}") for c in df.columns if c != "key"))
    pairs = one(short, "a").join(one(short, "b"), "key").where("w_a < w_b")
    pairs = pairs.where(is_near(F.col("w_a"), F.col("place_a"), F.col("w_b"), F.col("place_b"))).select(F.col("w_a").alias("a"), F.col("w_b").alias("b"), "n_a", "n_b")
    # pairs with a longer word: keys carry a hash of the word, the words are looked up for the pairs only
    named = words.where(size >= long).select("word", F.xxhash64("word").alias("ref"), "n")
    keys = materialize(named.select("word", "ref").mapInArrow(_emit, "key long, place int, ref long"), "long-keys")
    met = one(keys, "a").join(one(keys, "b"), "key").where("ref_a < ref_b").drop("key")
    lookup = lambda s: named.select(F.col("ref").alias(f"ref_{s}"), F.col("word").alias(s), F.col("n").alias(f"n_{s}"))
    met = met.join(lookup("a"), "ref_a").join(lookup("b"), "ref_b").where(F.greatest(F.length("a"), F.length("b")) > long)
    met = met.where(is_near(F.col("a"), F.col("place_a"), F.col("b"), F.col("place_b"))).select("a", "b", "n_a", "n_b").distinct()
    out = materialize(pairs.unionByName(met), "near-words")
    release(short, keys)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """word, form -> word, root: forms followed to the last. Each word has one form at most and there are no cycles."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        after = materialize(step, "roots")
        release(now)
        now = after
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, plant: int | None = PLANT) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of documents (doc_id, text)."""
    words = materialize(word_counts(docs, min_length, min_count, plant), "words", ARROW_ROWS)
    pairs = near_words(words)
    each = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m"))))
    best = pairs.select(each.alias("x")).groupBy("x.word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("x.m")).alias("m"), F.col("x.near").alias("near"))).alias("best"))
    has = -F.col("best.m") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.m")).alias("form_n"))
    found = materialize(found, "forms")
    release(words, pairs)
    ends = roots(found.where("form is not null"))
    out = materialize(found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "variants")
    release(found)
    return out


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


#: crc32 by its table, in SQL: entry i is i shifted eight times, with the polynomial where a bit falls out. Near words share a string
#: with one code point wild or gone, which is another way to find them than the operator's.
ORACLE = """
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
u AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{00C0}-\\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
l AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, count(*) AS k FROM u WHERE length(run) >= 7 GROUP BY doc_id, run),
b AS (SELECT run, k, flatten(list_transform(string_split(s, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(x) - 64 AS BIGINT)] END)) AS bytes FROM l),
h AS (SELECT run, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM b, crc),
e AS (SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM h),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM e WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
wild AS (SELECT word, n, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS key FROM x),
gone AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM x),
near AS (SELECT a.word, b.word AS near, b.n AS m FROM wild a JOIN wild b USING (key) WHERE a.word <> b.word
  UNION ALL SELECT g.word, w.word, w.n FROM gone g JOIN w ON g.key = w.word UNION ALL SELECT w.word, g.word, g.n FROM gone g JOIN w ON g.key = w.word),
r AS (SELECT word, near, m, row_number() OVER (PARTITION BY word ORDER BY m DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near),
f AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.m >= 10 * w.n THEN r.near END AS form, CASE WHEN r.m >= 10 * w.n THEN r.m END AS form_n FROM w LEFT JOIN r ON w.word = r.word AND r.place = 1),
way AS (SELECT word, word AS root, 0 AS steps FROM f UNION ALL SELECT way.word, f.form, steps + 1 FROM way JOIN f ON way.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, steps) AS root FROM way GROUP BY word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM f JOIN ends USING (word)
"""
