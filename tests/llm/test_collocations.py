import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from cases import empty, long_text, odd, plain
from pyspark.sql import functions as F

from larkspur.llm import collocations, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, top, share=100):
    """The contract, word by word; containment is looked for in all longer candidates."""
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if a >= least and len(p) > 1]
        absorbed = set()
        for long in candidates:
            for m in range(2, len(long)):
                for i in range(len(long) - m + 1):
                    part = long[i : i + m]
                    if 100 * f[long] >= share * f[part]:
                        absorbed.add(part)
        scored = []
        for p in candidates:
            if p not in absorbed:
                n = sizes[lang]
                score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def made(seed, docs=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "b", "new", "york", "city", "é", "日本", "x-y", "\x01", "\x1f", "​", "aa", "\U0001f600"]
    texts = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(40)):
            parts.append(rng.choice(words) if rng.random() < 0.7 else rng.choice(("new york city hall", "a b a b a b", "in spite of the")))
            parts.append(rng.choice((" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", "!?")))
        texts.append((rng.choice(("en", "en", "de", None, "und", "")), "".join(parts) if rng.random() < 0.95 else None))
    return texts


@pytest.mark.parametrize("seed,least,longest,top,share", [(1, 3, 5, 2000, 100), (2, 2, 5, 20, 100), (3, 5, 3, 7, 100), (4, 2, 6, 2000, 60), (5, 1, 2, 2000, 100)])
def test_equals_brute_force(spark, seed, least, longest, top, share):
    rows = made(seed)
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows).repartition(6), least, longest, top, share).collect())
    assert got == brute(rows, least, longest, top, share)


def test_matches_sql(spark, small_dir):
    con = oracle.connect(small_dir)
    df, sql = queries.QUERIES["op11_phrase_collocations"](spark, small_dir), queries.SQL["op11_phrase_collocations"]
    assert oracle.type_differences(df, con, sql) == "" and oracle.differences(df, con, sql) == ""


def test_a_full_sieve_changes_nothing(spark, monkeypatch):
    rows = made(9)
    monkeypatch.setattr(collocations, "SIEVE_BITS", 64)
    monkeypatch.setattr(collocations, "BITS_PER_PHRASE", 1)
    assert collocations.build_sieve(frame(spark, [("en", "a")]).withColumnRenamed("text", "phrase"), 1, 10**9).words.size == 1
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows), 3).collect())
    assert got == brute(rows, 3, 5, 2000)


def test_passes_of_any_size_give_the_same(spark, monkeypatch):
    rows = made(11)
    monkeypatch.setattr(collocations, "BYTES", 50)
    assert sorted(tuple(r) for r in collocations.mine(frame(spark, rows), 3).collect()) == brute(rows, 3, 5, 2000)


def test_hash_of_a_word_covers_all_of_it():
    words = [b"a" * 40 + bytes([97 + i]) + b"b" * 40 for i in range(26)] + [b"a", b"aa", b"aaa", b"b"]
    w = collocations.words_of([b" ".join(words), b"", b"a " + words[3]])
    hashes = w.hashes()
    assert len(set(hashes[:30].tolist())) == 30 and hashes[30] == hashes[26] and hashes[31] == hashes[3]
    assert collocations.gram_hashes(hashes[:1], 2, hashes[:1]).size == 0


def test_scores_are_exact(spark):
    """Products of up to 38 digits; the quotient rounds down."""
    rng = random.Random(4)
    rows = []
    for _ in range(500):
        a = rng.randrange(100, 10 ** rng.randrange(3, 13))
        left, right = (a + rng.randrange(10 ** rng.randrange(1, 14)) for _ in range(2))
        rows.append((a, rng.randrange(max(left, right), 10**15), left, right))
    rows += [(3, 10, 3, 10), (100, 9 * 10**15, 100, 100)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select("*", F.expr(collocations.SCORE).alias("s")).collect()
    assert all(r.s == 1000 * r.a * r.n // (r.l * r.r) for r in got) and len(got) == 502


def test_odd_rows(spark):
    df = odd(spark).withColumns({c: F.lit("x") for c in ("phrase", "m", "l", "r", "a", "rank", "cut", "longer")})
    df = df.unionByName(df).unionByName(df)
    want = brute([(r.lang, r.text) for r in df.collect()], 2, 5, 50)
    assert sorted(tuple(r) for r in collocations.mine(df, 2, top=50).collect()) == want and want
    assert collocations.mine(empty(spark)).collect() == [] and collocations.mine(df, 10**9).collect() == []
    assert plain(collocations.mine(df, 2)) == plain(collocations.mine(df.repartition(7), 2))


def test_long_and_hostile_texts(spark):
    rows = [("en", long_text() + " new york" * 200), ("de", "a" * 3_000_000), ("fr", "a b " * 300_000), ("es", "." * 1_000_000)]
    start = time.time()
    got = collocations.mine(frame(spark, rows)).collect()
    assert time.time() - start < 120
    assert {(r.lang, r.phrase) for r in got if len(r.phrase) < 20} >= {("en", "new york"), ("fr", "a b a b a"), ("fr", "b a b a b")}
    assert np.all([r.a >= 100 for r in got])
