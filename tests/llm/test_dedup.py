"""Embedding near-duplicates, MinHash near-duplicates, repeated strings, top-k."""

import re
import time
from collections import Counter

import numpy as np
import pytest

from gavelframe.llm import common, near_dedup, registry, repeats, topk, vector_dedup
from gavelframe.llm.graph import components
from pyspark.sql import functions as F

from .conftest import SF
from oracle import both, connect


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, k) for k in range(5001, 5200)]
    want = Groups({x for e in edges for x in e})
    for a, b in edges:
        want.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: want.find(x) for a, b in edges if a != b for x in (a, b)}


def brute_vectors(rows, cosine=0.93):
    usable = [(i, np.array(e, float), label) for i, e, label in rows if e and label is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, groups = Counter(), Groups([i for i, *_ in rows])
    for k, (i, x, a) in enumerate(usable):
        for j, y, b in usable[:k]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    return {i: (links[i], groups.find(i), groups.find(i) == i) for i, *_ in rows}


def test_vector_dedup_equals_brute_force(spark, odd_vectors):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = [(i, [float(np.float32(x)) for x in base[i % 40] + rng.normal(size=16) * (0.15 if i % 3 else 0)], i % 4) for i in range(400)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got == brute_vectors(rows)
    odd = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(odd_vectors).collect()}
    want = brute_vectors(list({r.vec_id: (r.vec_id, r.embedding, r.label) for r in odd_vectors.collect() if r.vec_id is not None}.values()))
    assert odd == want
    assert vector_dedup.near_duplicates(odd_vectors.where("false")).count() == 0


def brute_groups(texts):
    ids = sorted(texts)
    weighted = near_dedup._weighted([texts[i] or "" for i in ids])
    words = {i: tuple(re.findall(r"[^\W_]+", (texts[i] or "").lower())) or texts[i] or "" for i in ids}
    groups = Groups(ids)
    for k, i in enumerate(ids):
        for m in range(k):
            if words[i] == words[ids[m]] or near_dedup.probability_jaccard(weighted[k], weighted[m]) >= 0.8:
                groups.join(i, ids[m])
    return {i: groups.find(i) for i in ids}


def test_near_dedup_equals_brute_force(spark, documents):
    rng = np.random.default_rng(6)
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    vocabulary = [f"w{k}" for k in range(400)]
    base = [list(rng.choice(vocabulary, 80)) for _ in range(6)]
    for k in range(60):
        words = list(base[k % 6])
        for at in rng.integers(0, 80, k % 4):
            words[at] = "changed"
        texts[10_000 + k] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.groups(docs).collect()} == brute_groups(texts)


def test_near_dedup_of_one_large_group(spark, monkeypatch):
    """Near copies of one text, changed in 0 to 15 of 150 words, in many small blocks: links by a plain comparison of all pairs of sets."""
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 1 << 17)
    rng = np.random.default_rng(16)
    base = [f"w{k}" for k in range(150)]
    texts = {}
    for k in range(400):
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 16)):
            words[at] = f"x{rng.integers(0, 3)}"
        texts[k] = " ".join(words)
    sets = [Counter(tuple(w[i : i + 5]) for i in range(146)) for w in (texts[k].split() for k in range(400))]
    groups = Groups(texts)
    for i in range(400):
        for j in range(i):
            both = sets[i] & sets[j]
            if max(sets[i].values()) == max(sets[j].values()) == 1:
                same = len(both) / len(sets[i] | sets[j])
            else:
                same = sum(1 / sum(max(sets[i][z] / sets[i][x], sets[j][z] / sets[j][x]) for z in sets[i] | sets[j]) for x in both)
            if same >= 0.8:
                groups.join(i, j)
    want = {i: groups.find(i) for i in texts}
    got = {r.doc_id: r.class_id for r in near_dedup.groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert 1 < len(set(want.values())) < 400 and got == want


def test_rows_of_a_doc_id_do_not_hide_later_copies(spark):
    rng = np.random.default_rng(12)
    a, b, c = (" ".join(f"w{k}" for k in rng.integers(0, 10_000, 60)) for _ in range(3))
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (7, b), (9, c)], "doc_id long, text string")
    assert sorted(r.text for r in near_dedup.near_dedup_stage(spark, docs, "").collect()) == sorted([a, b, c])
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_near_dedup_odd_rows(spark, odd_docs, no_docs):
    got = {r.doc_id: r.class_id for r in near_dedup.groups(odd_docs).collect()}
    assert got[0] == got[1] == 0 and got[7] == got[8] == 7 and got[9] == 9 and None not in got
    assert near_dedup.groups(no_docs).count() == 0
    stage = near_dedup.near_dedup_stage(spark, odd_docs, "")
    assert stage.columns == odd_docs.columns and stage.where("doc_id IS NULL").count() == 1


def test_probability_jaccard_and_registers():
    a = (np.array([1, 2, 3], np.uint64), np.array([1.0, 1.0, 2.0]))
    assert near_dedup.probability_jaccard(a, a) == pytest.approx(1)
    b = (np.array([1, 2, 4], np.uint64), np.array([2.0, 1.0, 1.0]))
    direct = sum(1 / sum(max(dict(zip(a[0], a[1])).get(j, 0) / x, dict(zip(b[0], b[1])).get(j, 0) / y) for j in {1, 2, 3, 4}) for x, y in ((1.0, 2.0), (1.0, 1.0)))
    assert near_dedup.probability_jaccard(a, b) == pytest.approx(direct)
    rng = np.random.default_rng(7)
    h = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
    x, y = h[:240], h[60:]
    own = np.repeat([0, 1], 240)
    tags = near_dedup.registers(np.concatenate([x, y]), np.ones(480), own, 2, 4096)
    assert (tags[0] == tags[1]).mean() == pytest.approx(180 / 300, abs=0.04)


def brute_repeats(docs, length=50):
    first = {}
    for i, b in sorted(docs, key=lambda d: d[0]):
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], i)
    out = []
    for i, b in docs:
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                mask[k : k + length] = True
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        out.append((i, len(b), int(mask.sum()), spans, np.frombuffer(b, np.uint8)[~mask].tobytes()))
    return sorted(out)


def found_repeats(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


@pytest.mark.parametrize("chunk_bytes", [300, 4 << 20])
def test_repeats_equal_brute_force(spark, chunk_bytes, monkeypatch):
    monkeypatch.setattr(repeats.chunked, "__defaults__", (chunk_bytes,))
    rng = np.random.default_rng(8)
    passages = ["".join(rng.choice(list("abcdé "), n)) for n in (49, 50, 51, 80, 200, 333)]
    texts = []
    for k in range(120):
        parts = [passages[j] if j < 6 else "".join(rng.choice(list("xyzü\n"), 40)) for j in rng.integers(0, 9, rng.integers(0, 6))]
        texts.append("".join(parts))
    texts += ["a" * 300, "a" * 120, "a" * 49, "ab" * 100, texts[3], texts[4]]
    docs = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    docs += [(docs[5][0], docs[5][1]), (docs[5][0], docs[6][1] + docs[5][1])]
    got = found_repeats(repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute_repeats([(i, t.encode()) for i, t in docs])


def test_repeats_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect()]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(odd_docs).collect() if r.doc_id is not None)
    assert got == brute_repeats([r for r in rows if r[0] is not None])
    lone = repeats.remove_repeats(odd_docs).where("doc_id IS NULL").first()
    assert (lone.n_removed, bytes(lone.kept)) == (0, b"no id")
    assert repeats.remove_repeats(no_docs).count() == 0


def test_difference_cover():
    assert {(int(a) - int(b)) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER} == set(range(repeats.PERIOD))
    values = np.sort(np.random.default_rng(9).integers(0, 2**63, 1000).astype(np.uint64))
    assert (repeats.unpacked(repeats.packed(values)) == values).all()


def test_rows_that_repeat_a_doc_id_are_deduplicated(spark):
    rng = np.random.default_rng(11)
    a, b, c, d = (" ".join(f"w{k}" for k in rng.integers(0, 10_000, 60)) for _ in range(4))
    docs = spark.createDataFrame([(7, a), (7, a), (7, b), (3, a), (5, b), (9, c), (9, c), (9, d), (11, d)], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.groups(docs).collect()} == {7: 3, 3: 3, 5: 3, 9: 9, 11: 9}
    kept = sorted((r.doc_id, r.text) for r in near_dedup.near_dedup_stage(spark, docs, "").collect())
    assert [t for _, t in kept if t not in (c, d)] == [a, b] and sorted(t for _, t in kept if t in (c, d)) == sorted([c, d]) and kept[0][0] == 3 and kept[1][0] == 5
    passage = "x%dy " * 30 % tuple(range(30))
    docs = spark.createDataFrame([(1, "first " + passage), (1, "first " + passage), (2, "second " + passage), (2, "second " + passage), (2, "other " + passage)], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in repeats.repeats_stage(spark, docs, "").collect())
    assert got == [(1, "first " + passage)] * 2 + [(2, "other")] + [(2, "second")] * 2


def test_top_k_equals_sql(spark):
    con = connect(SF)
    mine, theirs = both(spark, con, registry.QUERIES["op8_topk"], registry.ORACLE_SQL["op8_topk"], SF)
    assert mine == theirs


def test_top_k_odd_rows(spark, odd_vectors):
    rows = {r.vec_id: r.embedding for r in odd_vectors.collect() if r.vec_id is not None}
    good = {i: np.floor(256 * np.array(e, float)).astype(int) for i, e in rows.items() if e and all(x is not None and np.isfinite(x) for x in e)}
    want = []
    for q, x in good.items():
        if q % 50 == 0:
            scores = sorted((-int(x @ y), i) for i, y in good.items() if i != q and len(y) == len(x))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    got = [tuple(r) for r in topk.top_k(odd_vectors, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == sorted(want)
    assert topk.top_k(odd_vectors.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_with_fewer_than_k_candidates(spark):
    three = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    rare = [(50, [1.0, 0.0, 1.0]), (51, [0.5, 0.0, -1.0]), (100, [7.0])]
    six = [(150 + k, [float(k), float(k), 1.0, 1.0]) for k in range(6)]  # the slices agree on the best
    for rows in (three, three + rare + six):
        good = {i: np.floor(256 * np.array(e)).astype(int) for i, e in rows}
        want = []
        for q, x in good.items():
            if q % 50 == 0:
                scores = sorted((-int(x @ y), i) for i, y in good.items() if i != q and len(y) == len(x))[:5]
                want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
        got = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()]
        assert sorted(got) == sorted(want) and len(got) >= 2


@pytest.mark.parametrize("shape", ["random", "clusters", "negative", "ties", "one dimension"])
def test_top_k_in_small_blocks(spark, monkeypatch, shape):
    """Open and closed lists, with a few vectors in a block, against all products."""
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(4)
    n, d = 400, 1 if shape == "one dimension" else 6
    x = rng.normal(size=(n, d))
    if shape == "clusters":
        x = rng.normal(size=(5, d))[rng.integers(0, 5, n)] * 3 + 0.1 * x
    x = {"negative": -np.abs(x), "ties": np.round(x)}.get(shape, x).astype(np.float32)
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(n)]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 9 == 0, 3).collect())
    q = np.floor(256 * x.astype(float)).astype(np.int64)
    want = []
    for i in range(0, n, 9):
        scores = q @ q[i]
        order = sorted((j for j in range(n) if j != i), key=lambda j: (-scores[j], j))[:3]
        want += [(i, r + 1, j, int(scores[j])) for r, j in enumerate(order)]
    assert got == want


def test_top_k_later_phases_compute_little(spark):
    """On the given vectors fewer than a quarter of the products of the first phase are computed again."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    seen = []
    real = topk.work_left
    try:
        topk.work_left = lambda sent, cutoffs: seen.append(real(sent, cutoffs).select(F.size("open").alias("open")).agg(F.sum("open")).first()[0]) or real(sent, cutoffs)
        topk.top_k(vectors, F.col("vec_id") % 50 == 0)
    finally:
        topk.work_left = real
    queries = vectors.where("vec_id % 50 = 0").count()
    blocks = max(1, -(-vectors.count() // topk.BLOCK))
    assert seen[0] < queries * blocks / 4


def test_growth_keeps_what_a_chunk_sends_to_a_bucket():
    assert [repeats.growth(n) for n in (0, 1 << 35, 1 << 37, 10**14)] == [1, 1, 2, 53]
    for total in (1 << 40, 10**14, 10**16):
        g = repeats.growth(total)
        names = repeats.CHUNK_BYTES * g / (total / (repeats.BUCKET_PREFIXES * g))
        assert names >= repeats.CHUNK_BYTES * repeats.BUCKET_PREFIXES / (1 << 35) * 0.7


def test_repeats_pack_for_all_buckets_at_once_as_for_each():
    rng = np.random.default_rng(12)
    groups = [np.sort(rng.integers(0, 2 ** int(b), n).astype(np.uint64)) for b, n in zip(rng.integers(1, 63, 60), rng.integers(1, 30, 60))]
    for some in (groups, groups[:1], [g >> np.uint64(56) for g in groups]):
        starts = np.cumsum([0, *map(len, some[:-1])])
        blobs = repeats.packed_groups(np.concatenate(some), starts)
        assert blobs == [repeats.packed(g) for g in some]
        values, counts = repeats.unpacked_groups(blobs)
        assert (values == np.concatenate(some)).all() and counts.tolist() == list(map(len, some))
    assert repeats.packed_groups(np.zeros(0, np.uint64), np.zeros(0, np.int64)) == []


def test_last_pass_of_repeats_looks_at_no_tuples(spark):
    docs = spark.createDataFrame([(k, "one passage of more than fifty bytes that every text here holds " + str(k)) for k in range(50)], "doc_id long, text string")
    found = repeats.remove_repeats(docs)
    assert not [f for f in found.inputFiles() if "gf-tuples" in f]
    assert found_repeats(found) == brute_repeats([(r.doc_id, r.text.encode()) for r in docs.collect()])
    repeats.forget(found)


def test_shuffles_of_materialised_tables_go(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def data():
        every = files.getAllFiles()  # once, as files come and go
        return {x for x in (every.apply(k).getName() for k in range(every.size())) if x.endswith(".data")}

    before = data()
    common.materialize(spark.range(10_000).repartition(7, "id"), "shuffled")
    assert data() - before
    common.collect_shuffles(spark)
    for _ in range(50):
        if not data() - before:
            break
        time.sleep(0.1)
    assert not data() - before
