"""Functions against models in plain Python, streams against batches, files, the API and its refusals."""

import datetime
import json
import random
import re
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from gavelframe.functions.identifiers import article_key, chinese_number, contexts, url_allowed
from gavelframe.functions.sections import parties, section_texts
from gavelframe.functions.text import clean_judgment_text, is_substantive, running, safety_valve, snippets, strip
from gavelframe.operators.api import Engine, error_envelope
from gavelframe.operators.resolve import resolve_name, resolve_names
from gavelframe.operators.refresh import RefusedRefresh, current, publish, reload_view, staleness
from gavelframe.operators.search import search_names
from gavelframe.plans.fixtures import ARTICLES, HISTORIES, JUDGMENTS, LAWS, RESULTS, RULINGS
from gavelframe.constants import BUILTIN_LAWS
from gavelframe.plans.fixtures import TERMS
from gavelframe.sources import files
from gavelframe.sources.html import dom
from gavelframe.streaming import events as streams


def values(spark, texts, build):
    rows = [(i, t) for i, t in enumerate(texts)]
    return [r.v for r in spark.createDataFrame(rows, "i int, t string").select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]


def python_snippets(text, keyword, context, limit):
    out, at = [], 0
    while (at := text.find(keyword, at)) >= 0 and len(out) < limit:
        s, e = max(0, at - context), min(len(text), at + len(keyword) + context)
        out.append((at, ("..." if s else "") + text[s:e] + ("..." if e < len(text) else "")))
        at += len(keyword)
    return out


@pytest.mark.parametrize("keyword", ["ab", "a", "民法", "\\E.*", "a+"])
def test_snippets(spark, keyword):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b", "民法", " ", "\n", "\\E.*", "a+", "𝕏"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    got = values(spark, texts, lambda t: snippets(t, keyword, 5, 4))
    assert [[tuple(s) for s in g] for g in got] == [python_snippets(t, keyword, 5, 4) for t in texts]


def python_contexts(text, pattern, context):
    out = []
    for m in re.finditer(pattern, text):
        s, e = max(0, m.start() - context), min(len(text), m.end() + context)
        out.append((m.start(), m.group(), ("..." if s else "") + text[s:e] + ("..." if e < len(text) else "")))
    return out


def test_contexts(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["釋字第1號", "釋字第 22 號", "x", "民法", "\n", "𝕏", "、" * 9]) for _ in range(rng.randrange(40))) for _ in range(40)] + ["", "釋字第1號" * 300]
    for context in (2, 7, 80):
        got = values(spark, texts, lambda t: contexts(t, r"釋字第\s*\d+\s*號", context))
        assert [[tuple(c) for c in g] for g in got] == [python_contexts(t, r"釋字第\s*\d+\s*號", context) for t in texts]


def test_running_sums(spark):
    rows = [(0, []), (1, [5]), (2, list(range(1000))), (3, [7] * 256)]
    got = [r.v for r in spark.createDataFrame(rows, "i int, n array<int>").select("i", running(F.col("n")).alias("v")).orderBy("i").collect()]
    assert got == [[sum(n[:k]) for k in range(len(n))] for _, n in rows]


def test_long_texts_with_many_matches(spark):
    """Time in proportion to the text: 20,000 matches in 1 MB, with and without contexts."""
    text = ("a" * 45 + "釋字第1號") * 20_000
    began = time.time()
    assert len(values(spark, [text], lambda t: contexts(t, r"釋字第\s*\d+\s*號", 80))[0]) == 20_000
    assert len(values(spark, [text], lambda t: snippets(t, "釋字", 200, 10))[0]) == 10
    assert time.time() - began < 60


def test_parties_and_sections(spark):
    head = "臺灣臺北地方法院民事判決\n110年度訴字第123號\n"
    texts = [
        head + "原 告  王大明\n       李小華\n\n  即被告\n訴訟代理人 陳律師\n共同\n被告 甲  公司\n上列當事人間\n       張三\n主 文\n原告 不算\n",
        "主文\n" + head + "原告 王大明\n", "一\n" * 9 + "110年度訴字第123號\n原告 王大明", "一\n" * 10 + "110年度訴字第123號\n原告 王大明", head + "王大明\n上列\n被告 李\n       109年度甲\n       某某\n原告 乙丙\n被告 丁戊\n據上論結\n被告 己庚", "", None,
    ]
    want = [
        {"原告": ["王大明", "李小華"], "訴訟代理人": ["陳律師"], "被告": ["甲公司"]}, {}, {"原告": ["王大明"]}, {}, {"被告": ["某某", "丁戊"], "原告": ["乙丙"]}, {}, {},
    ]
    assert values(spark, texts, parties) == want
    text = "前言\n主 文\n一\n\n 二 \n事實及理由\n甲\n理由\n乙\n主文\n三\n中華民國110年1月2日\n理由\n不算"
    got = values(spark, [text, "主文", "", None, "中華民國110年1月2日\n事實\n有"], section_texts)
    assert [tuple(r) for r in got] == [("一\n二\n三", "甲", "乙"), ("", "", ""), ("", "", ""), ("", "", ""), ("", "有", "")]


def python_number(text):
    digits, units = dict(zip("零一二三四五六七八九", range(10))) | {"〇": 0, "０": 0}, {"十": 10, "百": 100, "千": 1000}
    total = now = 0
    for ch in text:
        if ch in digits:
            now = digits[ch]
        elif ch in units:
            total += (1 if now == 0 and ch == "十" else now) * units[ch]
            now = 0
    return total + now


def test_chinese_numbers(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("零一二三四五六七八九十百千〇０甲") for _ in range(rng.randrange(8))) for _ in range(200)]
    assert values(spark, texts, chinese_number) == [python_number(t) for t in texts]


def test_article_key(spark):
    assert values(spark, ["184", "247-1", "15之1", "15-10", "附則", "", "7-x"], article_key) == [184.0, 247.1, 15.1, 16.0, 0.0, 0.0, 0.0]


def test_text_helpers(spark):
    assert values(spark, ["　 a b 　\n", "", " x"], strip) == ["a b", "", "x"]
    assert values(spark, ["x" * 49, " " * 60, None, "y" * 50], is_substantive) == [False, False, False, True]
    assert values(spark, ["  版面大小 120% 100%\na   \nb\n\n\n\nc　\n"], clean_judgment_text) == ["a\nb\n\nc"]
    short, long = values(spark, ["z" * 15000, "z" * 15001], safety_valve)
    assert not short.truncated and long.truncated and long.text.startswith("z" * 15000 + "\n\n[System Warning") and "15001" in long.text


def test_urls(spark):
    good = ["https://judgment.judicial.gov.tw/a", "http://data.judicial.gov.tw", "https://law.moj.gov.tw/x?y"]
    bad = ["https://law.moj.gov.tw.evil.com/", "https://evil.com/?law.moj.gov.tw", "file:///etc/passwd", "ftp://law.moj.gov.tw/", "javascript:alert(1)", "http://10.0.0.1/", "", None]
    assert values(spark, good + bad, url_allowed) == [True] * 3 + [False] * 8


def test_api(spark):
    e = Engine(spark, laws=LAWS.frame(spark), histories=HISTORIES.frame(spark), articles=ARTICLES.frame(spark), judgments=RESULTS.frame(spark), rulings=RULINGS.frame(spark))
    assert [r.number for r in e.query_regulation("民法", from_no="15", to_no="16").collect()] == ["15", "15-1", "15-2", "15-10", "16"]
    assert [r.number for r in e.query_regulation(pcode="B0000001", article_no="247-1").collect()] == ["247-1"]
    one = e.query_regulation("民法", article_no="14", include_history=True).first()
    assert one.status == "現行法規" and one.history == "中華民國十八年公布"
    assert e.query_regulation("工廠法").first().status == "已廢止"
    found = e.resolve_law("勞基法").first()
    assert (found.law_name, found.pcode, found.tier, found.matched_from) == ("勞動基準法", "N0030001", 1, "勞基法")
    assert e.resolve_law("查無").first().pcode is None
    assert [r.law_name for r in e.search_regulations("法", exclude_abolished=True).collect()] == sorted(r[1] for r in LAWS.rows if not r[3] and "法" in r[1])
    assert e.get_ruling("釋字第1號", include_opinions=True).first().opinions_unavailable
    assert e.get_ruling("111年憲判字第2號", include_reasoning=True).first().reasoning_truncated
    assert [r.case_id for r in e.search_rulings(keyword="婚姻").collect()] == ["釋字第748號"]
    assert [r.jid for r in e.search_judgments(keyword="價金", max_results=2).collect()] == ["TPSM,109,臺上,5,20200101,2", "TPHM,111,上,7,20220101,1"]
    assert [r.jid for r in e.search_judgments(keyword="價金", court="TPH").collect()] == [r.jid for r in e.search_judgments(keyword="價金", court="臺灣高等法院").collect()] == ["TPHM,111,上,7,20220101,1"]
    assert e.search_judgments(keyword="價金", court="ZZZ").count() == 0
    assert [r.year for r in e.available_years().collect()] == sorted({r[1] for r in RULINGS.rows if r[0] == "憲判字"})
    with pytest.raises(ValueError, match="address"):
        e.get_judgment(url="https://evil.example/?id=TPSV")
    with pytest.raises(ValueError):
        e.search_judgments(court="最高法院")
    with pytest.raises(ValueError):
        e.search_judgments(keyword="x", max_results=0)
    with pytest.raises(ValueError):
        e.query_regulation()
    with pytest.raises(ValueError):
        search_names(LAWS.frame(spark), "")
    with pytest.raises(ValueError):
        e.search_regulations("法", offset=-1)
    assert Engine(spark, judgments=JUDGMENTS.frame(spark)).get_judgment("TPDV,110,訴,123,20210120,1").first().court == "臺灣臺北地方法院"


def test_one_name_resolves_as_many_do(spark):
    laws = LAWS.frame(spark)
    many = {r.term: tuple(r) for r in resolve_names(TERMS.frame(spark), laws).collect()}
    assert len(many) > 5 and all(tuple(resolve_name(term, laws).first()) == row for term, row in many.items())


def test_error_envelope():
    at = datetime.datetime(2024, 1, 2, 3)
    assert error_envelope("no", at, jid="X") == {"success": False, "error": "no", "timestamp": "2024-01-02T03:00:00", "jid": "X"}


def test_deep_pages():
    top = dom("<div>" * 5000 + "deep")
    assert top.text() == "deep" and len(top.every("div")) == 5000


def test_files(spark, tmp_path):
    dictionary = {"version": 2, "update_date": "2024-01-20", "total": 2, "pcode_map": {"民法": "B0000001", "工廠法": "A0000005"}, "abolished_set": ["A0000005"]}
    (tmp_path / "d.json").write_text(json.dumps(dictionary, ensure_ascii=False), encoding="utf-8")
    assert [tuple(r) for r in files.law_dictionary(spark, str(tmp_path / "d.json")).orderBy("ordinal").collect()] == [(0, "民法", "B0000001", False), (1, "工廠法", "A0000005", True)]
    (tmp_path / "damaged.json").write_text("{", encoding="utf-8")
    for name in ("damaged.json", "missing.json"):
        assert {r.law_name: r.pcode for r in files.law_dictionary_or_builtin(spark, str(tmp_path / name)).collect()} == BUILTIN_LAWS
    assert files.law_dictionary_or_builtin(spark, str(tmp_path / "d.json")).count() == 2
    header = staleness(files.dictionary_header(spark, str(tmp_path / "d.json")), F.lit("2024-01-28 00:00:00").cast("timestamp")).first()
    assert header.stale and header.total == 2
    (tmp_path / "h.json").write_text(json.dumps({"B0000001": "沿革"}), encoding="utf-8")
    assert [tuple(r) for r in files.law_histories(spark, str(tmp_path / "h.json")).collect()] == [("B0000001", "沿革")]
    (tmp_path / "o.json").write_text(json.dumps({"748": {"issues": "婚姻", "reasoning": "理由"}}, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "n.json").write_text(json.dumps({"111_1": {"issue_summary": "抽血"}}, ensure_ascii=False), encoding="utf-8")
    rows = files.rulings(spark, str(tmp_path / "o.json"), str(tmp_path / "n.json"))
    assert sorted((r.system, r.year, r.number, r.issues) for r in rows.collect()) == [("憲判字", 111, 1, "抽血"), ("釋字", 0, 748, "婚姻")]
    items = [{"LawName": "民法", "LawURL": "x?pcode=B0000001", "LawAbandonNote": "", "LawHistories": " h "}, {"LawName": "", "LawURL": "x?pcode=Q"}]
    with zipfile.ZipFile(tmp_path / "feed.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("laws.json", "﻿" + json.dumps({"Laws": items}))
    (tmp_path / "single.json").write_text(json.dumps(items[0]), encoding="utf-8")
    for name in ("feed.zip", "single.json"):
        assert [tuple(r) for r in files.feed_laws(files.feed(spark, str(tmp_path / name)), "law").collect()] == [("law", "民法", "B0000001", False, "h")]


def test_publish(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    rows = LAWS.frame(spark).withColumn("kind", F.lit("law"))
    publish(rows, path, least=10)
    assert current(spark, path).count() == 16
    publish(rows.where("ordinal < 12"), path, least=10)
    assert current(spark, path).count() == 12
    for bad in (rows.where("ordinal < 3"), rows.withColumn("abolished", F.lit(True))):
        with pytest.raises(RefusedRefresh):
            publish(bad, path, least=10)
    assert current(spark, path).count() == 12
    assert not reload_view(spark, rows, "laws_view", least=17) and reload_view(spark, rows, "laws_view", least=16)


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts").repartitionByRange(4, "ts").write.mode("overwrite").parquet(path)
    return path


SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def drained(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    return spark.table(name)


def test_streams(spark, event_files):
    stream = lambda: streams.event_stream(spark, event_files, SCHEMA)
    batch = spark.read.parquet(event_files)
    once = drained(spark, streams.seen_once(stream(), ["user_id"], within="60 days"), "once")
    assert once.count() == once.select("user_id").distinct().count() == batch.select("user_id").distinct().count()
    counts = drained(spark, streams.windowed_counts(stream(), ["event_type"]), "counts", "complete")
    want = {(str(r.d), r.event_type): r.n for r in batch.groupBy(F.date_trunc("day", "ts").alias("d"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert {(str(r.window_start), r.event_type): r.n for r in counts.collect()} == want
    sessions = drained(spark, streams.session_counts(stream(), ["user_id"], gap="2 hours"), "sessions", "complete")
    assert sessions.agg(F.sum("n")).first()[0] == batch.count()


def test_cached_with_expiry(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [(1, "2024-01-01 00:00:00", 7, 1.5), (2, "2024-01-01 00:10:00", 7, 2.5), (3, "2024-01-01 00:20:00", 8, 9.0), (6, "2024-01-01 00:50:00", 9, 4.0)], [(5, "2024-01-01 00:40:00", 9, 1.0), (7, "2024-01-01 00:45:00", 10, None)], [(4, "2024-01-02 00:00:00", 8, 3.0)]
    for part in rows:  # one file after the other
        frame = spark.createDataFrame(part, "event_id bigint, ts string, user_id bigint, value double").selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "user_id", "'click' AS event_type", "value", "'{}' AS props")
        frame.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.5)
    stream = streams.event_stream(spark, path, SCHEMA, files_per_batch=1).withWatermark("ts", "1 hour")
    got = {(r.user_id, r.value, r.hits, r.expired) for r in drained(spark, streams.cached_with_expiry(stream, "user_id", "value", "ts", 3600), "cached").collect()}
    assert {(7, 2.5, 2, False), (8, 9.0, 1, False), (8, 3.0, 2, False), (7, 2.5, 2, True), (10, None, 1, False)} <= got
    assert {g for g in got if g[0] == 9} >= {(9, 4.0, 1, False), (9, 4.0, 2, False)}  # the late event is counted and doesn't overwrite
