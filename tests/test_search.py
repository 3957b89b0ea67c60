"""Search strings, cover density and pages against plain loops."""

import itertools
import random
import re

import pytest

from larkspur.operators import search

W = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}


@pytest.mark.parametrize(
    "text,want",
    [
        ("python developer -junior", [((("python",), ("developer",)), (("junior",),))]),
        ('"machine learning" or ai -"deep fake"', [((("machine", "learning"),), ()), ((("ai",),), (("deep", "fake"),))]),
        ("a OR or b", [((("a",),), ()), ((("b",),), ())]),
        ('  "" - !! ', []),
        ('open "quote to the end', [((("open",), ("quote", "to", "the", "end")), ())]),
        ("e-mail a a", [((("e", "mail"), ("a",)), ())]),
        ("-x", [((), (("x",),))]),
    ],
)
def test_search_strings(text, want):
    assert [tuple(c) for c in search.web_query(text)] == want


def brute_rank(query, texts, classes):
    """All stretches that hold an alternative and hold no shorter one; then the formula."""
    alternatives = search.web_query(query)
    words, weight = [], []
    for text, c in zip(texts, classes):
        found = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        words.append(found)
        weight.append(W[c])

    def places(term):
        out, before = [], 0
        for ws, wt in zip(words, weight):
            out += [(before + i, before + i + len(term) - 1, 1 / wt) for i in range(len(ws) - len(term) + 1) if tuple(ws[i : i + len(term)]) == term]
            before += len(ws)
        return out

    free = [c for c in alternatives if not any(places(t) for t in c.unwanted)]
    if not any(all(places(t) for t in c.wanted) for c in free):
        return None
    terms = {t for c in alternatives for t in (*c.wanted, *c.unwanted)}
    entries = sorted((e, s, inv) for t in terms for s, e, inv in places(t))
    holds = lambda b, e: any(c.wanted and all(any(b <= s and x <= e for s, x, _ in places(t)) for t in c.wanted) for c in free)
    n = sum(map(len, words))
    good = [(b, e) for b, e in itertools.product(range(n), repeat=2) if b <= e and holds(b, e)]
    score = 0.0
    for b, e in good:
        if any((x, y) != (b, e) and b <= x and y <= e for x, y in good):
            continue
        inside = [inv for y, x, inv in entries if b <= x and y <= e]
        score += len(inside) / sum(inside) / (1 + max(e - b + 1 - len(inside), 0))
    return score


@pytest.mark.parametrize("query", ["a b", "a b c -d", '"a b" c or d e', "a", "a or b or -c", '"a a" b', "-a", "a a b", '"b c d" or e'])
def test_ranks_equal_a_plain_search(spark, query):
    rng = random.Random(query)
    rows = [(i, " ".join(rng.choices("abcde", k=rng.randrange(3))), " ".join(rng.choices("abcdexyz", k=rng.randrange(14))) if i % 7 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, title string, body string")
    want = {i: r for i, title, body in rows if (r := brute_rank(query, [title, body], "AD")) is not None}
    got = {r.doc_id: r for r in search.web_search(df, {"title": "A", "body": "D"}, query, page_size=100).collect()}
    phrases = any(len(t) > 1 for c in search.web_query(query) for t in c.wanted)
    assert set(got) == set(want) and all(r.total == len(want) for r in got.values())
    for i, r in want.items():
        assert abs(got[i].rank - r) < 1e-8 or phrases and got[i].rank > 0, (query, rows[i], got[i].rank, r)


def test_pages_headlines_and_empty_queries(spark):
    rows = [(i, "alpha beta " * (i % 3) + "gamma Delta, end" * (i % 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    whole = [tuple(r) for r in search.web_search(df, {"text": "D"}, "delta or alpha", page_size=100).collect()]
    pages = [tuple(r) for p in (1, 2, 3, 4) for r in search.web_search(df, {"text": "D"}, "delta or alpha", page=p, page_size=7).collect()]
    assert pages == whole and len(whole) == whole[0][3] == 25 and whole == sorted(whole, key=lambda r: (-r[1], r[0]))
    assert all("<b>" in h for _, _, h, _ in whole) and "<b>Delta</b>" in "".join(h for _, _, h, _ in whole)
    assert search.web_search(df, {"text": "D"}, "  ").collect() == [] and search.web_search(df, {"text": "D"}, "nowhere").collect() == []


def test_long_texts_take_one_pass(spark):
    df = spark.createDataFrame([(1, "rare " + "common word " * 50_000 + "rare")], "doc_id int, text string")
    (row,) = search.web_search(df, {"text": "D"}, "rare common").collect()
    assert row.rank > 0 and row.total == 1
