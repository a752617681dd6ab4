"""HTML main text and the pipeline."""

import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gavelframe.llm import html_text, quality, repeats

from .conftest import SF
from .test_dedup import brute_groups, brute_repeats

MENU = "<nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='box'><p>Repeated box of the site</p></div>"
PAGE = "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>" + MENU + "<article><h1>Title %d</h1><p>First &amp; second&nbsp;  part\nof %d.</p><ul><li>one %d<li>two</ul></article><div class='comments'><p>nice</p></div><footer>(c)</footer></body></html>"


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")


def test_html_main_text(spark):
    rows = [(k, f"https://a.example/{k}", PAGE % (k, k, k)) for k in range(6)]
    got = {r.page_id: r for r in html_text.extract(pages_frame(spark, rows)).collect()}
    for k in range(6):
        assert got[k].text == f"Title {k}\nFirst & second part of {k}.\none {k}\ntwo"
        assert got[k].n_chars == len(got[k].text)


WRAPPED = [
    ('<div class="layout has-sidebar"><article>%s</article></div>', 1), ('<div id="search-wrapper"><article>%s</article></div>', 1), ('<form id="aspnetForm"><article>%s</article></form>', 1),
    ('<article class="post share-enabled">%s</article>', 1), ('<article class="post share">%s</article><footer>(c)</footer>', 1), ('<div class="sidebar"><main>%s</main></div><div>other</div>', 1),
    ('<form action="/"><div>%s</div></form><div>ok</div>', 2), ('<nav>menu</nav><article>%s</article><div class="comments"><article>nice text, and a very long comment on it, longer than all else</article></div>', 1),
    ('<div class="comments"><p>a very long comment, longer than the text itself, and longer still</p></div><div class="content">%s</div>', 1), ('<article>%s<aside>by the way</aside><form>your mail</form><div class="comments">one</div></article>', 1),
    ('<article>%s<section id="public-notice">, a part of it</section></article>', 3), ('<aside class="related"><article>teaser</article></aside><article>%s</article>', 1), ('<div role="banner">Top</div><div>%s</div>', 1),
]


def test_html_names_on_wrappers_lose_no_article(spark):
    """Names of menus and adverts on what holds the article, or inside other names, remove nothing; on what stands beside it they do."""
    text = "The text of the article, which is long enough"
    endings = {1: "", 2: "\nok", 3: "\n, a part of it"}
    rows = [(k, "no host", "<body>" + body % text + "</body>") for k, (body, _) in enumerate(WRAPPED)]
    got = {r.page_id: r.text for r in html_text.extract(pages_frame(spark, rows)).collect()}
    assert got == {k: text + endings[end] for k, (_, end) in enumerate(WRAPPED)}


def test_html_depth_of_the_tree_is_a_parameter(spark):
    """A part that the whole site repeats goes at any depth that the tree is given."""
    deep = "<body><div class='x'>" + "<div>" * 40 + "<div class='promise'><p>We never sleep</p></div><div class='own'><p>Text number %d is its own</p></div>" + "</div>" * 40 + "</div></body>"
    rows = [(k, f"http://b.example/{k}", deep % k) for k in range(8)]
    assert {r.text for r in html_text.extract(pages_frame(spark, rows), depth=64).collect()} == {f"Text number {k} is its own" for k in range(8)}


def test_html_style_tree_removes_what_a_site_repeats(spark):
    body = "<body><div class='head'><div class='promise'><p>We never sleep</p></div></div><div class='main'><p>Text number %d is its own</p></div></body>"
    rows = [(k, f"http://b.example/{k}", body % k) for k in range(8)] + [(100, "http://c.example/1", body % 100)]
    got = {r.page_id: r.text for r in html_text.extract(pages_frame(spark, rows)).collect()}
    assert got[3] == "Text number 3 is its own"
    assert got[100] == "We never sleep\nText number 100 is its own"


def test_html_near_copies_on_a_site_keep_their_article(spark):
    body = "<body><div class='top'>Menu %d</div><article><h1>Same</h1><div class='text'><p>Same long text of all pages of this site</p></div></article></body>"
    rows = [(k, f"http://d.example/{k}", body % k) for k in range(8)]
    assert {r.text for r in html_text.extract(pages_frame(spark, rows)).collect()} == {"Same\nSame long text of all pages of this site"}


def test_html_near_copies_keep_a_list_under_half_of_the_article(spark):
    text = "<p>The same paragraph of each copy, which is longer than the list that comes after it</p>"
    body = "<body><article><h1>Title %d</h1>" + text + "<ul><li>one point</li><li>another point</li></ul></article><div class='advert'>Buy %d</div></body>"
    other = "<body><article><h1>Title %d</h1><p>Paragraph number %d of a text that is all its own</p><div class='box'><p>Rate this text</p></div></article></body>"
    rows = [(k, f"http://e.example/{k}", body % (k, k)) for k in range(4)] + [(k, f"http://e.example/{k}", other % (k, k)) for k in range(10, 16)]
    # four texts of three copies each: their common box still goes
    rows += [(100 + k, f"http://f.example/{k}", (other % (k, k // 3)).replace("Title", "T")) for k in range(12)]
    got = {r.page_id: r.text for r in html_text.extract(pages_frame(spark, rows)).collect()}
    for k in range(4):
        assert got[k] == f"Title {k}\nThe same paragraph of each copy, which is longer than the list that comes after it\none point\nanother point"
    assert got[11] == "Title 11\nParagraph number 11 of a text that is all its own"
    assert got[107] == "T 7\nParagraph number 2 of a text that is all its own"


def brute_tree(sources):
    """Redundancy of each node of one host, from the root's definition downwards; pages are weighted by the middle block of their texts."""
    tops = [html_text.parse(x) for x in dict.fromkeys(sources)]
    blocks = [Counter(html_text.kept_blocks(t, {})) for t in tops]
    pages_of = Counter(b for page in blocks for b in page)
    weights = []
    for page in blocks:
        numbers = sorted(pages_of[b] for b, n in page.items() for _ in range(n * len(b)))
        weights.append(1 / ((numbers[(len(numbers) - 1) // 2] + numbers[len(numbers) // 2]) / 2) if numbers else 1)
    seen, m, looks, kids, contents = set(), Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(lambda: defaultdict(dict))
    for k, top in enumerate(tops):
        for text, holder, _ in html_text._blocks(top):
            holder.own.found.append(text)
        by = defaultdict(list)
        for n in html_text._walk(top):
            if n.own is n:
                by[n.key].append(n)
        for key, same in by.items():
            m[key] += weights[k]
            every = [f for n in same for f in n.found]
            for f in every:
                contents[key][f][k] = every.count(f) / len(every)
            for n in same:
                children = [*n.kids, *(["text"] if n.found else [])]
                looks[key][tuple(children)] += weights[k] / len(same)
                for c in children:
                    kids[key][c] += weights[k] / len(same) / len(children)
            seen.add(key)

    def leaf(key):
        pages = {k for f in contents[key].values() for k in f}
        total = sum(weights[k] for k in pages)
        if total <= 1 + 1e-9:
            return 0
        mass = lambda f: sum(weights[k] * share for k, share in contents[key][f].items())
        return min(1, sum(mass(f) * math.log(max(1, sum(weights[k] for k in contents[key][f]))) for f in contents[key]) / sum(map(mass, contents[key])) / math.log(total))

    def redundancy(key):
        if m[key] <= 1 + 1e-9:
            return 0
        entropy = -sum(x / m[key] * math.log(x / m[key]) for x in looks[key].values()) / math.log(m[key])
        return (1 - min(1, max(0, entropy))) * sum(share / m[key] * (leaf(key) if c == "text" else redundancy(c)) for c, share in kids[key].items())

    return {key: redundancy(key) * (1 - 1 / max(1, m[key])) for key in seen}


def test_html_style_tree_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(40):
        menu = "".join(f"<li><a href='/{j}'>Item {j}</a></li>" for j in range(rng.integers(4, 7)))
        text = "".join(f"<p>Paragraph {k if k < 30 else 30 + k % 3} {j} of a text</p>" for j in range(rng.integers(1, 6)))
        rows.append((k, f"http://{'ab'[k % 2]}.example/{k}", f"<body><div class='m'><ul>{menu}</ul></div><div class='box{k}'><b>Box</b> {k % 3}<div>in {k % 2}</div></div><div class='t'>{text}</div>tail {rng.integers(0, 2)}</body>"))
    rows += [(100, "http://a.example/0", rows[0][2]), (101, "http://c.example/", "<p>alone"), (102, "http://d.example/", ""), (103, "http://d.example/1", None)]
    tree = html_text.style_tree(html_text.style_nodes(pages_frame(spark, rows))).collect()
    for site in "abcd":
        want = brute_tree([x or "" for _, url, x in rows if url.startswith(f"http://{site}.")])
        got = {r.node: r.redundancy for r in tree if r.host == f"{site}.example"}
        assert got.keys() == want.keys()
        assert all(got[n] == pytest.approx(want[n], abs=1e-6) for n in want)
    want = brute_tree([x for _, url, x in rows if url.startswith("http://a.")]).values()
    assert max(want) > 0.3 and min(want) < 0.05


def test_html_article_is_the_most_important_branch_of_every_host(spark, monkeypatch):
    """On the given pages the tree alone, without names and tags of menus and adverts, ranks the article first."""
    monkeypatch.setattr(html_text, "SCRAP_NAMES", frozenset())
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    tree = {(r.host, r.node): r.redundancy for r in html_text.style_tree(html_text.style_nodes(pages)).where("n_pages >= 10").collect()}
    sites = 0
    for row in pages.select("html", html_text.host().alias("host")).dropDuplicates(["host"]).collect():
        top = html_text.parse(row.html)
        branches = {p.tag: tree.get((row.host, p.key)) for p in top.parts if isinstance(p, html_text.Node)}
        if branches.get("article") is not None:
            sites += 1
            assert all(branches["article"] <= r for r in branches.values() if r is not None)
    assert sites >= 3


def test_html_articles_in_parts_and_headlines(spark):
    parts = "<body><article><h1>One</h1><p>First part</p></article><div>between</div><article><p>Second part</p></article><article><a href='/x'>Read another text</a></article></body>"
    main = "<body><div>top</div><main><h1>Headline</h1><article><p>Body</p></article><div class='related'>more</div></main><p>below</p></body>"
    got = [r.text for r in html_text.extract(pages_frame(spark, [(1, "http://g/", parts), (2, "http://g2/", main)])).orderBy("page_id").collect()]
    assert got == ["One\nFirst part\nSecond part", "Headline\nBody"]


def test_html_many_low_branches_go_page_by_page(spark, monkeypatch):
    body = "<body><div class='head'><div class='promise'><p>We never sleep</p></div></div><div class='main'><p>Text number %d is its own</p></div></body>"
    rows = [(k, f"http://b.example/{k}", body % k) for k in range(8)]
    monkeypatch.setattr(html_text, "LISTED", 1)
    assert {r.text for r in html_text.extract(pages_frame(spark, rows)).collect()} == {f"Text number {k} is its own" for k in range(8)}


@pytest.mark.parametrize("source", ["<div>" * 100_000 + "deep", "<b>" * 50_000 + "<div></div>" * 20_000 + "deep", "<ul>" + "<div>" * 50_000 + "<li></li>" * 20_000 + "deep", "<a " * 50_000 + "deep", "<div>" * 50_000 + "</p>" * 50_000 + "deep"])
def test_html_hostile_pages_take_linear_time(source):
    began = time.time()
    top = html_text.parse(source)
    assert html_text.kept_blocks(top, {})[0].endswith("deep")
    assert len(list(html_text.style_rows(top))) < 200
    assert time.time() - began < 10


def test_html_odd_rows(spark):
    rows = [(0, None, None), (1, "", ""), (None, "https://a.example/", "<p>x"), (3, "https://a.example/", "no markup at all"), (3, "https://a.example/", "no markup at all"), (4, "nonsense", "<article>" * 500 + "deep"), (5, "http://h/", "<p>" + "long " * 50_000)]
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(pages_frame(spark, rows)).collect()]
    assert len(got) == len(rows)
    by = {g[0]: g for g in got}
    assert by[0][2] == "" and by[1][2] == "" and by[None][2] == "x" and by[3][2] == "no markup at all" and by[4][2] == "deep" and by[5][3] == 50_000 * 5 - 1
    assert html_text.extract(pages_frame(spark, rows).where("false")).count() == 0


def test_html_pages_table(spark):
    got = html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    assert len(got) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.text and "<" + "p>" not in r.text and r.n_chars == len(r.text) for r in got if r.text)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        results[name] = (before, docs)
        assert name == "packing" or docs.columns == columns
    before, after = results["quality"]
    model = quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality.score(before, model).where("predicted = 1").collect()}
    before, after = results["near_dedup"]
    groups = brute_groups({r.doc_id: r.text for r in before.collect()})
    assert {r.doc_id: r.text for r in after.collect()} == {r.doc_id: r.text for r in before.collect() if groups[r.doc_id] == r.doc_id}
    before, after = results["repeats"]
    kept = {i: b.decode("utf-8", "ignore") for i, *_, b in brute_repeats([(r.doc_id, (r.text or "").encode()) for r in before.collect()])}
    assert {r.doc_id: (r.text, r.n_chars) for r in after.collect()} == {i: (t, len(t)) for i, t in kept.items() if t.strip()}
    before, after = results["packing"]
    tokenizer, pieces, bins = Tokenizer.from_file(P.path("byte_bpe_50k.json")), defaultdict(list), defaultdict(list)
    for r in after.collect():
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    texts = {r.doc_id: r.text for r in before.collect()}
    assert pieces.keys() == texts.keys()
    for i, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in own)
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) <= 1024


def test_pipeline_odd_rows(spark, odd_docs, no_docs, tmp_path):
    """Nulls, empty, long and repeated texts through every stage: each stage's rows by hand."""
    labels = str(tmp_path / "labels")
    spark.createDataFrame([(1, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{labels}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    scores = quality.score(odd_docs, quality.fit(odd_docs, spark.read.parquet(f"{labels}/labels.parquet"))).where("predicted = 1")
    accepted = stages["quality"](spark, odd_docs, labels)
    ids = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.collect())
    assert accepted.columns == odd_docs.columns and ids(accepted) == ids(scores) and {r.score for r in accepted.collect()} <= {1.0, None}
    kept = stages["near_dedup"](spark, odd_docs, labels)
    # null, empty, blank and line-break texts stay apart by their exact text, but null and empty are one; the null id stays
    texts = [r.text for r in kept.collect()]
    assert kept.columns == odd_docs.columns and len(texts) == len({t or "" for t in texts}) and {t or "" for t in texts} == {r.text or "" for r in odd_docs.collect()}
    left = stages["repeats"](spark, odd_docs, labels)
    assert left.columns == odd_docs.columns and left.where("doc_id IS NULL").first().text == "no id"
    assert {r.doc_id for r in left.where("doc_id IS NOT NULL").collect()} <= {r.doc_id for r in odd_docs.collect()}
    packed = stages["packing"](spark, odd_docs, labels).collect()
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for r in odd_docs.collect():
        want[r.doc_id] += len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in packed:
        got[r.doc_id] += r.length
    assert got == want
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, no_docs, labels)
        assert out.count() == 0 and (name == "packing" or out.columns == odd_docs.columns)


INTERNAL = ["_key", "_sha", "_first", "_kept", "_new", "_gf_score", "_gf_predicted", "_row", "_json", "_id", "SCORE", "a.b"]


def test_stages_leave_columns_of_any_name_alone(spark, tmp_path):
    """Every name that a stage uses inside, as a column of the documents, with and without repeated doc_ids."""
    labels = str(tmp_path / "labels")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{labels}/labels.parquet")
    passage = "a passage of more than fifty bytes that stands in two of these documents, "
    texts = [(1, passage + "and one"), (2, "something else entirely, in words of its own, as long as it takes"), (3, passage + "the other end"), (4, "fourth text")]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"`{c}` string" for c in INTERNAL)
    for repeated in (False, True):
        rows = [(i, t, len(t), *(f"{c} of {i} {k}" for c in INTERNAL)) for k in (range(3) if repeated else range(1)) for i, t in texts]
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:3] if repeated else corpus_pipeline.STAGES[1:2]:
            out = stage(spark, docs, labels)
            assert out.columns == docs.columns
            got = out.collect()
            assert {tuple(r[3:]) for r in got} <= {r[3:] for r in rows}
            assert {r.doc_id for r in got} <= {1, 2, 3, 4}
            if name == "near_dedup":  # of equal texts the row that is smallest as JSON stays, whatever the order
                assert sorted((r.doc_id, r["_key"]) for r in got) == [(i, f"_key of {i} 0") for i in range(1, 5)]
                again = stage(spark, spark.createDataFrame(rows[::-1], schema), labels)
                assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
            if name == "repeats":
                assert {r.text for r in got if r.doc_id == 3} == {"the other end"} and {r.n_chars for r in got if r.doc_id == 3} == {13}


def test_a_failed_removal_leaves_no_table(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x" * 80), (2, "x" * 80)], "doc_id long, text string")
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(ZeroDivisionError):
        repeats.written(docs, lambda every: 1 / 0, "kept")
    monkeypatch.setattr(repeats, "whole_copies", lambda chunks: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        repeats.remove_repeats(docs)
    assert {t.name for t in spark.catalog.listTables()} == before
