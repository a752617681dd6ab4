"""The n-gram index against a scan of all texts."""

import random

import numpy as np
import pytest

from gavelframe.operators.text_index import GRAM, TextIndex, gram_postings, pack, unpack
from gavelframe.operators import text_index


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 300, 1 << 20, (1 << 41) + 5, 0])
    data, ends = pack(values)
    assert unpack(data.tobytes()).tolist() == values.tolist()
    assert unpack(data[ends[2] : ends[4]].tobytes()).tolist() == [128, 300]
    assert unpack(b"").tolist() == []


def test_postings_hold_every_position():
    texts = ["abcabc", "zabc", "", "𝕏é"]
    p = gram_postings(np.arange(4), np.zeros(4, np.int64), texts)
    found = {}
    for gram, docs, counts, positions in zip(p["gram"].to_pylist(), p["docs"].to_pylist(), p["counts"].to_pylist(), p["positions"].to_pylist(), strict=True):
        steps, at = unpack(positions).tolist(), 0
        for doc, n in zip(np.cumsum(unpack(docs)).tolist(), unpack(counts).tolist(), strict=True):
            found[gram, doc] = np.cumsum(steps[at : at + n]).tolist()
            at += n
    expected = {}
    for doc, t in enumerate(texts):
        for i in range(len(t)):
            expected.setdefault((t[i : i + GRAM].ljust(GRAM, "\0"), doc), []).append(i)
    assert found == expected


ROWS = [(1, "移轉登記 of the land"), (2, "登記 only"), (3, None), (4, ""), (5, "ab"), (6, "abcabcabc" * 50), (7, "ABC the end"), (7, "ABC the end"), (7, "the other text of 7: 移轉 登記"), (8, "x\0y"), (9, "'quoted' \\ % _")]


def plain(words):
    return sorted(k for k, t in ROWS if t and all(w in t for w in words.split()))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    one = TextIndex(spark, str(tmp_path_factory.mktemp("index")))
    frame = spark.createDataFrame(ROWS, "id long, body string").selectExpr("*", "'x' AS text", "1 AS block", "2 AS no", "3 AS shard")
    one.append(frame.limit(0).unionByName(frame), "id", "body", "first")
    return one


CASES = ["移轉登記", "移轉 登記", "the", "a", "ab", "abc the", "abcabcabcabc", "zzz", "記", "\0", "x\0y", "'quoted' \\", "% _", "end the", "登記 only of"]


def test_search_equals_a_scan(index, spark):
    queries = spark.createDataFrame([(w, w.split()) for w in CASES], "query string, words array<string>")
    assert sorted(tuple(r) for r in index.search_many(queries).collect()) == sorted((w, k) for w in CASES for k in plain(w))
    assert sorted(r.key for r in index.search("移轉 登記").collect()) == plain("移轉 登記")


def test_search_of_many_queries_and_short_filters(index, spark, monkeypatch):
    asked = [(i, w.split()) for i, w in enumerate(["the", "a", "移轉 登記", "none such", "abcabc", "ab ab ab"])]
    queries = spark.createDataFrame(asked, "query long, words array<string>")
    expected = sorted((i, k) for i, w in asked for k in plain(" ".join(w)))
    assert sorted(tuple(r) for r in index.search_many(queries).collect()) == expected
    monkeypatch.setattr(text_index, "FILTER_VALUES", 1)  # everything is joined
    monkeypatch.setattr(text_index, "GROUP_QUERIES", 2)
    assert sorted(tuple(r) for r in index.search_many(queries).collect()) == expected


def test_refusals(index, spark, tmp_path):
    with pytest.raises(ValueError):
        index.search("  ")
    with pytest.raises(ValueError):
        index.search_many(spark.createDataFrame([(1, [""])], "query int, words array<string>"))
    with pytest.raises(ValueError):
        TextIndex(spark, str(tmp_path)).search("a")


def test_append_adds_segments_once(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path))
    frame = lambda rows: spark.createDataFrame(rows, "id long, text string")
    index.append(frame([(1, "old text")]), "id", "text", "a")
    index.append(frame([(1, "old text")]), "id", "text", "a")  # a repeated append of a complete segment changes nothing
    index.append(frame([(2, "new text")]), "id", "text", "b")
    index.append(frame([]), "id", "text", "empty")
    assert sorted(r.key for r in index.search("text").collect()) == [1, 2]
    assert [r.key for r in index.search("new").collect()] == [2]


def test_random_texts_in_small_blocks(spark, tmp_path, monkeypatch):
    """Blocks, parts of long texts and buckets are cut small, so that every boundary is crossed."""
    monkeypatch.setattr(text_index, "BLOCK_CHARS", 200)
    monkeypatch.setattr(text_index, "BUCKET_CHARS", 800)
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.choice([0, 1, 2, 3, 40, 400])))) for i in range(60)]
    index = TextIndex(spark, str(tmp_path))
    index.append(spark.createDataFrame(rows, "id long, text string"), "id", "text", "a")
    words = ["ab", "aab", "abab", "bbbb", "a", "aaaaaaa", "abba baab", "b a"]
    queries = spark.createDataFrame([(i, [w]) for i, w in enumerate(words)], "query int, words array<string>")
    expected = sorted((i, k) for i, w in enumerate(words) for k, t in rows if w in t)
    assert sorted(tuple(r) for r in index.search_many(queries).collect()) == expected


def test_parts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(text_index, "SORT_CHARS", 10)
    import pyarrow as pa

    text = "abcdefghijklmnopqrstuvwxyz" * 3
    for n in (8, 9, 10, 11, 12, 13, 20, 22, 23, 78):
        batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0], pa.int32()), pa.array([text[:n]])], ["block", "no", "text"])
        places = []
        for out in text_index._post(iter([batch])):
            for gram, positions in zip(out.column(1).to_pylist(), out.column(5).to_pylist(), strict=True):
                places += [(i, gram) for i in np.cumsum(unpack(positions)).tolist()]
        assert sorted(places) == [(i, text[i : min(i + 3, n)].ljust(3, "\0")) for i in range(n)]


def test_rare_words_read_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "BLOCK_CHARS", 2000)
    monkeypatch.setattr(text_index, "BUCKET_CHARS", 2000)
    rows = [(i, f"common words in every text {i} " * 10 + ("needle" if i == 37 else "")) for i in range(100)]
    index = TextIndex(spark, str(tmp_path))
    index.append(spark.createDataFrame(rows, "id long, text string"), "id", "text", "a")
    files = lambda df: df.select(text_index.F.input_file_name()).distinct().count()
    assert files(index._postings(["eed", "edl"], [])) <= 2 < files(index._all())
    plan = index.search("needle")._jdf.queryExecution().executedPlan().toString()
    shards = [line for line in plan.splitlines() if "PartitionFilters" in line and "shard" in line]
    assert shards and all("shard" in line.split("PartitionFilters")[1] for line in shards)
    assert [r.key for r in index.search("needle").collect()] == [37]


def test_judgment_search_with_an_index(spark, tmp_path):
    from gavelframe.operators.api import Engine
    from gavelframe.plans.fixtures import RESULTS

    judgments = RESULTS.frame(spark)
    index = TextIndex(spark, str(tmp_path))
    index.append(judgments, "jid", "full_text", "a")
    plain_, indexed = Engine(spark, judgments=judgments), Engine(spark, judgments=judgments, index=index)
    for criteria in ({"keyword": "給付 價金"}, {"keyword": "價金", "court": "TPS"}, {"keyword": "nothing"}, {"main_text": "移轉"}, {"case_word": "臺上", "case_number": "5"}):
        assert [r.jid for r in indexed.search_judgments(**criteria).collect()] == [r.jid for r in plain_.search_judgments(**criteria).collect()]
