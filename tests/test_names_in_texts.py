"""Names in texts against a plain search at every place."""

import random

import pytest

from gavelframe.operators.names_in_texts import all_matches, automaton_of, cited_by_name, leftmost_longest, names_in_texts


def plain(text, names):
    found, i = [], 0
    while i < len(text or ""):
        fits = [n for n in names if n and text.startswith(n, i)]
        if fits:
            n = max(fits, key=len)
            found.append((n, i, i + len(n)))
            i += len(n)
        else:
            i += 1
    return found


def test_leftmost_longest_of_random_texts():
    rng = random.Random(3)
    for _ in range(200):
        names = ["".join(rng.choice("ab法") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 8))]
        text = "".join(rng.choice("ab法 ") for _ in range(rng.randint(0, 60)))
        kept = leftmost_longest(all_matches(automaton_of(names), text))
        assert [(text[a:b], a, b) for a, b in kept] == plain(text, names)


NAMES = [None, "", "民法", "民法總則", "總則施行法", "刑法", "刑法", "a", "aa", "𝕏法"]
TEXTS = [(1, "依民法總則施行法及民法第1條"), (2, None), (3, ""), (4, "刑法刑法"), (4, "刑法刑法"), (4, "aaaaa"), (None, "民法"), (5, "𝕏法 " * 3000), (6, "nothing")]


@pytest.mark.parametrize("limits", [{}, {"name_chars": 3, "lot_chars": 4000}])
def test_names_in_texts(spark, limits):
    """By broadcast, and by slices of names and lots of texts."""
    names = spark.createDataFrame([(n,) for n in NAMES], "law_name string")
    docs = spark.createDataFrame([(*t, "x", 1, 2, 3) for t in TEXTS], "doc_id long, text string, name string, slice int, lot int, digest int")
    found = sorted((str(r.doc_id), r.name, r.start, r.stop) for r in names_in_texts(docs, names, **limits).collect())
    assert found == sorted((str(k), *m) for k, t in TEXTS for m in plain(t, [n for n in NAMES if n]))
    assert names_in_texts(docs.limit(0), names).count() == 0 == names_in_texts(docs, names.limit(0)).count()


def test_cited_by_name(spark):
    docs = spark.createDataFrame([(1, "依民法總則第12條、民法 第 184 條之外，民法第一百八十四條之一，刑法第3之1條，刑法施行"), (2, None)], "doc_id long, text string")
    known = spark.createDataFrame([("民法",), ("民法總則",), ("刑法",)], "law_name string")
    found = {(r.law_name, r.article) for r in cited_by_name(docs, known).collect()}
    assert found == {("民法總則", "12"), ("民法", "184"), ("民法", "184-1"), ("刑法", "3之1")}
