"""Source divergence, secrets and spelling variants against SQL and plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from gavelframe.llm import divergence, registry, secrets, spelling
from oracle import both, connect

from .conftest import ODD_TEXTS, SF


@pytest.mark.parametrize("name", ["op11_divergence", "op12_secrets", "op13_spelling"])
def test_queries_equal_their_sql(spark, name):
    mine, theirs = both(spark, connect(SF), registry.QUERIES[name], registry.ORACLE_SQL[name], SF)
    assert mine == theirs and mine[0]


# ------------------------------------------------------------ divergence


def brute_divergence(rows, min_docs, top):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", [t.translate(fold) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    found = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for x, _, ts in docs if x == lang for t in set(ts))
        kept = {t for t, n in held.items() if n >= min_docs}
        counts = defaultdict(Counter)
        for x, source, ts in docs:
            if x == lang:
                counts[source].update(t for t in ts if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked[:limit])]
    return sorted(found)


def spread_docs(seed, sources=9, n=140):
    rng = random.Random(seed)
    common, rare = ["The", "of", "é𝕏", "a"], [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for _ in range(n):
        s = rng.randrange(sources)
        words = [rng.choice(common) for _ in range(rng.randrange(6))] + [rng.choice(rare[s * 2 : s * 2 + 4]) for _ in range(rng.randrange(8))]
        rows.append((" ".join(words) + rng.choice(["", ".", "-x9x"]), rng.choice(["en", "en", "de", None]), rng.choice([f"src{s}", f"src{s}", None, "", "ß"])))
    return rows + [("one of its kind", "xx", "lone"), (None, "yy", "a"), ("", "yy", "b")]


@pytest.mark.parametrize("heavy", [0.0, 0.25, 0.6, 2.0])
def test_divergence_in_small_tiles(spark, monkeypatch, heavy):
    """All terms dense, some, or none, with tiles of a few rows, equals plain sums."""
    for name, value in (("TILE_TERMS", 3), ("TILE_SOURCES", 4), ("POSTING_TERMS", 2), ("HISTOGRAM_ROWS", 3), ("HEAVY", heavy)):
        monkeypatch.setattr(divergence, name, value)
    rows = spread_docs(11)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, n long, term string")
    audit = divergence.Audit(docs, 3, heavy)
    got = sorted((r.lang, r.source, "pair", r["item"], r.value) for r in audit.pairs().collect())
    assert got == sorted(r[:5] for r in brute_divergence(rows, 3, 10) if r[2] == "pair")


def test_divergence_whole_result(spark, odd_docs, no_docs):
    rows = spread_docs(5)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence.source_divergence(docs, 3, 4).collect())
    assert got == brute_divergence(rows, 3, 4)
    odd = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    assert sorted(tuple(r) for r in divergence.source_divergence(odd_docs, 2).collect()) == brute_divergence(odd, 2, 10)
    assert divergence.source_divergence(no_docs).count() == 0


def test_terms_of_pieces_and_exact_shares():
    text = "Aé b-C\x00D " * 50
    whole = [t for part in divergence.terms(text) for t in part]
    for piece in (1, 2, 7, 50):
        assert [t for part in divergence.terms(text, piece) for t in part] == whole
    assert whole[:4] == ["aé".encode(), b"b", b"c", b"d"]
    for n, total, kept in ((0, 0, 0), (0, 0, 5), (7, 10**15, 3), (10**15, 10**15, 10**6), (1, 1, 1)):
        want = 1 + 10**9 * (n + 2) // max(total + 2 * kept, 1) if total + kept else None
        assert want is None or int(divergence.shares([n], total, kept)[0]) == want


# ------------------------------------------------------------ secrets

KINDS = [p.kind for p in secrets.PATTERNS]
#: text and the kinds that are found in it.
CASES = [
    ('password = "hunter2hunter"', ["assign"]), ("PassWord:abcdefgh", ["assign"]), ("password = short1", []), ("api_key=abc api-key=abcdefgh APIKEY: 'abcdefgh'", ["assign"]), ("a token: ab", []),
    ("AKIA" + "A1" * 6, ["access"]), ("AKIA" + "A1" * 5, []), ("akia" + "A1" * 8, []), ("0" * 32, ["hex"]), ("0" * 31, []), ("x" + "ab" * 20 + "g", ["hex"]),
    ("user = bob\npassword = secret1", ["user", "short"]), ("user = bob\n\npassword = secret1", []), ("user = bob " + "x" * 400 + " password = secret1", []), ("user = bob", []),
    ("user: bob, password: hunter2hunter", ["user", "assign"]), ("https://db.example:5432/x", []), ("user=bob pwd=abcd https://db.example:5432/x", ["user", "phrase", "endpoint"]), ("pwd=abcd https://db.example:5432/x", []),
    ("AKIA" + "B2" * 5 + " 0123456789abcdef0123", ["key", "partial"]), ("AKIA" + "B2" * 5 + " 01234567890123456789", []), ("login=me 1234567890123456", []), ("ſecret = abcdefgh", []), ("to\u212aen = abcdefghi", []),
    ("é𝕏 user = bob\n \t\r\npassword = secret1", []), ("", []), ("account: root token=abcd1 " * 3, ["user", "short"] * 3),
]


def found_kinds(spans):
    return [s.split(":")[0] for s in spans.split(",") if s]


def test_secret_cases(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, spans string, start long, kind int")
    got = {r.doc_id: [KINDS[x.kind] for x in r.spans] for r in secrets.secrets(df).collect()}
    assert got == {i: kinds for i, (_, kinds) in enumerate(CASES)}


def test_secret_offsets_are_code_points():
    text = "é𝕏 password = abcdefgh, AKIA" + "Z" * 12
    assert secrets.candidates(text)[:1] == [(3, 0, 22)] and text[3:22] == "password = abcdefgh"


def brute_links(text, reach):
    found = secrets.candidates(text)
    breaks = [m.end() for m in re.finditer(secrets.BLANK_LINE, text)]
    scope = lambda s: sum(b <= s for b in breaks)
    kept = []
    for s, k, e in found:
        p = secrets.PATTERNS[k]
        roles = {secrets.PATTERNS[j].role for t, j, _ in found if abs(t - s) <= reach and scope(t) == scope(s)}
        if not p.weak or roles >= set(secrets.NEEDED[p.role]):
            kept.append((s, k, e))
    return kept


def test_links_of_random_texts(spark):
    rng = random.Random(8)
    parts = ["user=bob ", "password=abcd ", "pwd = xyz12 ", "https://h.example/ ", "word " * 3, "\n\n", "\n \n", "token = abcdefghij ", "AKIA" + "Q" * 6 + " ", "0123456789abcdef01 ", "é𝕏 "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([3, 10, 60, 400]))) for _ in range(40)]
    docs = spark.createDataFrame([(i % 30 if i % 7 else None, t) for i, t in enumerate(texts + texts[:5])], "doc_id long, text string")
    got = sorted((str(r.doc_id), [(x.start, x.kind, x.end) for x in r.spans]) for r in secrets.secrets(docs, reach=40).collect())
    assert got == sorted((str(i % 30 if i % 7 else None), brute_links(t, 40)) for i, t in enumerate(texts + texts[:5]))


def test_secrets_odd_rows(spark, odd_docs, no_docs):
    got = sorted((str(r.doc_id), len(r.spans)) for r in secrets.secrets(odd_docs).collect())
    assert got == sorted((str(r.doc_id), 0) for r in odd_docs.collect())
    assert secrets.secrets(no_docs).count() == 0
    assert secrets.candidates(ODD_TEXTS[6]) == []


# ------------------------------------------------------------ spelling


def brute_words(rows, plant):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if plant and h % plant == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, ratio, plant):
    n = brute_words(rows, plant)
    out = {}
    for w in n:
        close = [v for v in n if v != w and near(v, w)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        out[w] = [best if best and n[best] >= ratio * n[w] else None, len(close)]
    result = []
    for w, (form, close) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result.append((w, form, root, n[w], close, n[form] if form else None))
    return sorted(result, key=lambda r: r[0])


def misspelt(rng, w, letters):
    i = rng.randrange(len(w))
    return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])


@pytest.mark.parametrize("letters, size, long", [("ab", 7, 64), ("abcé÷ÿ", 9, 64), ("ab", 8, 8), ("aé", 66, 64)])
def test_spelling_variants(spark, letters, size, long, monkeypatch):
    """Dense and sparse words, long ones by lookup, chains of forms, against all pairs of words."""
    monkeypatch.setattr(spelling, "TASK_WORDS", 20)
    monkeypatch.setattr(spelling.near_words, "__defaults__", (long,))
    rng = random.Random(size)
    base = ["".join(rng.choice(letters) for _ in range(size)) for _ in range(3)]
    words = [w for w in base for _ in range(250)]
    for w in base:
        for _ in range(25):
            v = misspelt(rng, w, letters)
            words += [v] * rng.choice([2, 3, 20])
            words += [misspelt(rng, v, letters)] * 2
    rng.shuffle(words)
    rows = [(k, " ".join(words[k * 40 : k * 40 + 40]).upper() + "İ.一" + rng.choice(["", "short"])) for k in range(-(-len(words) // 40))]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (5, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = sorted((tuple(r) for r in spelling.spelling_variants(docs, ratio=3, plant=5).collect()), key=lambda r: r[0])
    assert got == brute_variants(rows, 3, 5)
    assert any(r[1] and r[1] != r[2] for r in got)  # a form that has a form


def test_deletion_keys_are_those_of_distinct_deletions():
    rng = random.Random(1)
    seen = {}
    for _ in range(300):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(1, 9)))
        keys, places = spelling.deletion_keys(w)
        strings = [w if p < 0 else w[:p] + w[p + 1 :] for p in places.tolist()]
        assert set(strings) == {w} | {w[:i] + w[i + 1 :] for i in range(len(w))} and len(strings) == len(set(strings))
        for s, k in zip(strings, keys.tolist(), strict=True):
            assert seen.setdefault(s, k) == k
    assert len(set(seen.values())) == len(seen)


def test_spelling_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(1, "y" * 70_000), (2, "y" * 70_000), (3, "y" * 70_001), (4, "y" * 70_001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in spelling.spelling_variants(docs).collect()), key=lambda r: r[0])
    assert [r[0][:7] for r in got] == sorted(w[:7] for w in brute_words(rows, 31))
    pair = {len(r[0]): r for r in got if r[0][0] == "y"}
    assert all(r[4] == (2 if len(pair) == 3 and n == 70_000 else 1) for n, r in pair.items()) or len(pair) < 2
    assert spelling.spelling_variants(no_docs).count() == 0


def test_runs_of_pieces():
    text = "Straße ÉCOLE naïve-wordİx ÷× 12ab " * 30
    whole = [t for part in spelling.runs(text) for t in part]
    assert [t.decode("latin-1") for t in whole[:5]] == ["straße", "École".replace("É", "É")[0] + "cole", "naïve", "word", "x"]
    for piece in (1, 5, 33):
        assert [t for part in spelling.runs(text, piece) for t in part] == whole
