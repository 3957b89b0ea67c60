"""Quality, toxicity and language: held-out accuracy, independence from other columns, odd input."""

import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from cases import crc, empty, long_text, odd
from pyspark.sql import functions as F

from larkspur.llm import language, quality_crf, queries, toxicity

LABELS = "doc_id long, quality int, toxic int"


def auc(rows):
    """Share of (positive, negative) pairs in the right order."""
    good, bad = [s for y, s in rows if y], [s for y, s in rows if not y]
    order = np.argsort(np.argsort(good + bad, kind="stable"), kind="stable")
    values = np.array(good + bad)
    ranks = np.array([np.mean(order[values == v]) for v in values[: len(good)]])
    return (ranks.sum() - len(good) * (len(good) - 1) / 2) / (len(good) * len(bad))


@pytest.fixture(scope="module")
def big_dir(small_dir):
    return small_dir.replace("sf0.01", "sf0.1")


@pytest.mark.parametrize("name,label,bound,least", [("op6_quality_classifier", "quality", 0.7, 0.9), ("op5_toxicity", "toxic", 0.3, 0.85)])
def test_held_out_accuracy(spark, big_dir, name, label, bound, least):
    docs = spark.read.parquet(f"{big_dir}/documents.parquet").select("doc_id")
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{big_dir}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, big_dir).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= bound) for r in rows)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert auc([h[:2] for h in held]) > least
    assert np.mean([y == p for y, _, p in held]) > 0.93


def test_language_accuracy(spark, big_dir):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{big_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_language_id"](spark, big_dir).collect()
    assert len(rows) == len(docs) and all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [(docs[r.doc_id], r.lang_pred) for r in rows if r.held_out]
    assert np.mean([a == b for a, b in held]) > 0.97


@pytest.mark.parametrize("module,label", [(quality_crf, "quality"), (toxicity, "toxic")])
def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, small_dir, module, label):
    docs, labels = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels"))
    hidden = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = labels.withColumns({c: F.when(hidden, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    strange = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.col("doc_id").cast("string"))
    want = sorted(map(tuple, module.classify(docs, labels).collect()))
    assert sorted(map(tuple, module.classify(strange, other).collect())) == want


def test_language_ignores_held_out_rows_and_sources(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert sorted(map(tuple, language.identify(docs).collect())) == sorted(map(tuple, language.identify(other).collect()))


def test_odd_rows(spark):
    df = odd(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (5, 1, None), (6, None, None), (None, 1, 1), (7, 0, 0), (99, 1, 1)], LABELS)
    for module in (quality_crf, toxicity):
        rows = module.classify(df, labels).collect()
        assert len(rows) == df.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert module.classify(empty(spark), labels).collect() == []
        assert len(module.classify(df, labels.limit(0)).collect()) == df.count()
    found = {(r.doc_id, r.lang_pred, r.score > 0) for r in language.identify(df).collect()}
    assert {(2, "und", False), (3, "und", False), (4, "und", False), (8, "und", False), (None, "und", False)} <= found
    assert all(lang in ("en", "fr", "de", "es", "und") for _, lang, _ in found)
    assert language.identify(empty(spark)).collect() == []
    unknown = language.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}


# ---- toxicity -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lexicon(spark, big_dir):
    return toxicity.learned(*(spark.read.parquet(f"{big_dir}/{t}.parquet") for t in ("documents", "labels")))


@pytest.mark.parametrize("text", ["you 1d10t", "you IDІOT", "you st​upid man", "what tr@sh", "a $tupid one", "ｍｏｒｏｎ", "you m0r0n!", "pаthetic lоser", "idiót", "du Arschl0ch", "quel connard", "eres un est\u00fapido", "Schei\u00dfe", "b\u00e2tard!"])
def test_disguised_words(lexicon, text):
    found = toxicity.automaton(lexicon)
    assert toxicity.score(text, found, lexicon.curve) >= 0.3


@pytest.mark.parametrize("text", ["", "put it in the trash can", "guinea pig and clown fish", "the scumbling brush", "call 1 800 555 1234", "classy assumption", "$$$ ### ***", "a 5-star place"])
def test_harmless_words(lexicon, text):
    found = toxicity.automaton(lexicon)
    assert toxicity.score(text, found, lexicon.curve) < 0.3


def test_length_normalises_and_long_texts(lexicon):
    found = toxicity.automaton(lexicon)
    short, long = "you idiot " + "word " * 10, "you idiot " + "word " * 300_000
    assert toxicity.measures(short, found)[1] > toxicity.measures(long, found)[1]
    text = long_text(200_000) + " you worthless idiot " + long_text(200_000)
    assert toxicity.matches(text, found)[1] >= 2


def naive_matches(text, lexicon):
    """Every word and phrase looked for at every place of the folded text."""
    folded = toxicity.fold(text)

    def found(entry):
        at = folded.find(entry)
        while at >= 0:
            end = at + len(entry)
            if not (at and folded[at - 1].isalpha()) and not (end < len(folded) and folded[end].isalpha()):
                yield at, end
            at = folded.find(entry, at + 1)

    covered = [span for phrase in lexicon.exceptions for span in found(phrase)]
    weights = [w for word, w in lexicon.words.items() if word not in lexicon.exceptions for a, b in found(word) if not any(x <= a and b <= y for x, y in covered)]
    return sum(weights), len(weights), len(folded.split())


TOXIC_PARTS = (
    "trash", "can", "trash can", "trash cans", "idiot", "1d10t", "IDІOT", "stupid", "sore loser rule", "loser", "soap scum", "scum", "scumbag", "guinea pig", "pig iron", "pig", "guinea pig iron", "the", "ﬁlth",
    "pond scum soap", "garbage collection", "e", "x", "ѕhit", "trash-can", "idiot.", "'moron'", "hate crime law", "hate", "a trash can,idiot",
)


@pytest.mark.parametrize("piece", [1 << 18, 60, 17])
def test_matches_equal_a_naive_matcher(monkeypatch, piece):
    """Pieces of any size, phrases that overlap, words beside signs: as if every entry were looked for at every place."""
    monkeypatch.setattr(toxicity, "PIECE", piece)
    lexicon = toxicity.Lexicon(toxicity.GENERAL, toxicity.EXCEPTIONS, (1.0, 1.0, 0.0))
    found, rng = toxicity.automaton(lexicon), random.Random(piece)
    for _ in range(400):
        text = "".join(rng.choice(TOXIC_PARTS) + rng.choice((" ", " ", " ", "\n", ", ", "  ", "")) for _ in range(rng.randrange(40)))
        total, hits, words = toxicity.matches(text, found)
        want = naive_matches(text, lexicon)
        assert (round(total, 9), hits, words) == (round(want[0], 9), *want[1:])


def test_scores_do_not_depend_on_where_a_text_is_cut(lexicon, monkeypatch):
    found = toxicity.automaton(lexicon)
    text = "we met at the old trash can beside the guinea pig and the idiot of a control freak accident " * 2
    want = toxicity.matches(text, found)
    for piece in range(1, len(text) + 2):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert toxicity.matches(text, found) == want


def test_time_grows_with_the_matches(lexicon):
    found, start = toxicity.automaton(lexicon), time.time()
    toxicity.matches("trash can " * 100_000, found)
    toxicity.matches("trash can idiot " * 60_000, found)
    assert time.time() - start < 10


def test_copies_do_not_make_words_toxic():
    rows = [("the same line with blimp inside it", 1)] * 50 + [(f"word{i} you idiot number{i}", 1) for i in range(50)] + [(f"nice words{i} here{i}", 0) for i in range(400)]
    words = toxicity.fit(rows).words
    assert "blimp" not in words and "idiot" in words


# ---- language -------------------------------------------------------------------------------------


def test_pieces_count_like_the_whole(monkeypatch):
    text = ("straße écoute mañana the end, " * 40).lower()
    want = language.counts(text)
    monkeypatch.setattr(language, "PIECE", 64)
    assert np.array_equal(language.counts(text), want)
    assert language.counts("12 34 -- !") is None and language.counts("") is None


def test_counts_equal_brute_force():
    text = "ab c"
    padded = "\0ab\0c\0"
    n = language.counts(text)
    assert n.sum() == 3 + sum(1 for a, b in zip(padded, padded[1:-1]) if a != "\0" or b != "\0") + 3


def test_a_rare_language_is_learned(spark):
    """One row in five thousand, and one whose texts are all long: both are known to the model."""
    rows = [(i, f"the house and the garden number {i % 97} of the old town", "en") for i in range(1, 6000)]
    rows += [(100_000 + i, "talo ja puutarha vanhassa kaupungissa sekä järven rannalla", "fi") for i in range(3)]
    rows += [(200_000 + i, "dom i ogród w starym mieście nad jeziorem, gdzie mieszkają ludzie " * 600, "pl") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learned(docs)
    assert model.languages == ("en", "fi", "pl")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    assert {got[100_000], got[100_001], got[100_002]} == {"fi"} and got[200_001] == "pl" and got[7] == "en"


def test_letters_are_lowered_alike_in_learning_and_use(spark):
    rows = [(i, "ΟΔΟΣ ΣΑΣ İSTANBUL ẞ " * 5, "el") for i in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    scores = [r.score for r in language.identify(docs).collect()]
    assert min(scores) > 0.99


def test_rejection_halves_the_score(spark, small_dir):
    model = language.learned(spark.read.parquet(f"{small_dir}/documents.parquet"))
    df = spark.createDataFrame([(1, "日本語のとても長い文章です"), (2, "the thing and the other thing with that")], "doc_id long, text string")
    rows = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert rows[1].rejected and rows[1].score <= 0.5 and rows[2].lang_pred == "en"


# ---- quality --------------------------------------------------------------------------------------


def test_lines_are_counted_by_text():
    x, size, count = quality_crf.lines([b"one two.\n\n three", b"", b"  \n", b"AAA BBB!!\nAAA BBB!!"])
    assert count.tolist() == [2, 0, 0, 2] and size.tolist() == [7, 5, 8, 8]


def plain_features(text):
    """Features of the lines of one text, by loops over its bytes."""
    raw, rows, sizes, seen = text.encode(), [], [], set()
    recent, last = [], 0
    for line in raw.split(b"\n"):
        words = re.findall(rb"[^\x20\x09-\x0D]+", line)
        again = 0
        for w in words:
            again += w in recent[-2:]
            recent.append(w)
        size = sum(map(len, words))
        if words:
            last = words[-1][-1]
        if not words:
            continue
        chars = b"".join(words)
        upper, lower, high = (sum(a <= c <= b for c in chars) for a, b in ((65, 90), (97, 122), (128, 255)))
        symbols = sum(c in b"#*$%&|<>{}[]\\^~_=+@" for c in chars) / len(words)
        shouts, capitals = chars.count(b"!") / len(words), upper / max(upper + lower + high, 1)
        digits, mean, repeat = sum(48 <= c <= 57 for c in chars) / size, size / len(words), again / len(words)
        n = len(words)
        rows.append([
            n < 4, n < 12, n > 60, n > 300, symbols > 0.02, symbols > 0.1, symbols > 0.5, shouts > 0.1, shouts > 0.5, capitals > 0.2, capitals > 0.5, digits > 0.2,
            mean < 3, mean > 9, mean > 15, repeat > 0.1, repeat > 0.4, last in b".!?\"'", line in seen, symbols == 0,
        ])
        seen.add(line)
        sizes.append(size)
    none = [0] * 20
    return [
        [float(x) for x in (*row, *(rows[i - 1] if i else none), *(rows[i + 1] if i + 1 < len(rows) else none), i == 0, i + 1 == len(rows), 1)] for i, row in enumerate(rows)
    ], sizes


def plain_quality(text, model):
    """Length-weighted marginals of the good state over all ways to label the lines."""
    rows, sizes = plain_features(text)
    if not rows:
        return 0.0
    emit = np.array(rows) @ model.weights
    total, good = 0.0, np.zeros(len(rows))
    for path in itertools.product((0, 1), repeat=len(rows)):
        weight = math.exp(model.start[path[0]] + sum(emit[i, s] for i, s in enumerate(path)) + sum(model.trans[a, b] for a, b in zip(path, path[1:])))
        total += weight
        good += weight * np.array(path)
    return float((good / total * np.array(sizes)).sum() / sum(sizes))


def made_text(rng):
    words = ["the", "House", "AAAA", "12", "###", "x", "!!", "word.", "ü", "|", "abcdefghijklmnopXXXX", "abcdefghijklmnopYYYY", "end?", "{}", "a1b2"]
    return "\n".join(" ".join(rng.choices(words, k=rng.randrange(8))) + rng.choice(("", ".", "  ", "\t!")) for _ in range(rng.randrange(8)))


def test_lines_and_scores_equal_plain_loops(spark, small_dir):
    model = quality_crf.learned(*(spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels")))
    rng = random.Random(2)
    batch = [made_text(rng) for _ in range(150)] + ["", "one\none\n\none"]
    x, size, count = quality_crf.lines([t.encode() for t in batch])
    got = quality_crf.qualities([t.encode() for t in batch], model)
    at = 0
    for text, n, q in zip(batch, count, got):
        alone, sizes, _ = quality_crf.lines([text.encode()])
        rows, want = plain_features(text)
        assert len(rows) == n and sizes.tolist() == want == size[at : at + n].tolist()
        assert np.array_equal(alone, np.array(rows, np.float32).reshape(n, x.shape[1]))
        assert np.array_equal(alone, x[at : at + n]) and abs(q - quality_crf.qualities([text.encode()], model)[0]) < 1e-9
        assert abs(quality_crf.qualities([text.encode()], model)[0] - plain_quality(text, model)) < 1e-5
        at += n


def test_words_compare_whole():
    """Words that share sixteen bytes and their length are not repeats."""
    text = b"abcdefghijklmnopXXXX abcdefghijklmnopYYYY abcdefghijklmnopZZZZ"
    x, *_ = quality_crf.lines([text])
    y, *_ = quality_crf.lines([text.replace(b"YYYY", b"XXXX")])
    assert x[0, 15] == x[0, 16] == 0 and y[0, 15] == 1


def test_batches_score_alike(spark, small_dir):
    model = quality_crf.learned(*(spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels")))
    batch = [b"Some line of text.\nAnother one | | | |", b"", long_text(50_000).encode(), b"x\n" * 500]
    assert np.allclose(quality_crf.scores(batch, model), [quality_crf.scores([b], model)[0] for b in batch])
