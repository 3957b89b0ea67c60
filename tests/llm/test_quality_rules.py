from collections import Counter

from cases import SPACE, empty, odd, plain

from larkspur.llm import quality_rules, queries


def brute(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_equal_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    got = queries.QUERIES["op9_quality_rules"](spark, small_dir)
    assert plain(got.select("doc_id", *COLUMNS)) == want


def test_repeats_at_every_place(spark):
    texts = ["a b c d e " * 3, "x a b c d e y a b c d e z", "a " * 9, "a " * 4, "a b c d e f a b c d e f g h i j k a b c d e", "q\nq\n\n \nq r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert plain(quality_rules.judge(df).select("doc_id", *COLUMNS)) == sorted(((i, *brute(t)) for i, t in enumerate(texts)), key=repr)


def test_odd_rows(spark):
    df = odd(spark)
    assert plain(quality_rules.judge(df).select("doc_id", *COLUMNS)) == sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=repr)
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    assert not {2, 3, 4, 5, 7, 8} & {r.doc_id for r in kept.collect()}


def test_empty_table(spark):
    assert quality_rules.judge(empty(spark)).collect() == []
    assert quality_rules.keep_good(empty(spark)).collect() == []


def test_posterior_column_equals_the_estimate(spark, small_dir):
    judged = quality_rules.judge(spark.read.parquet(f"{small_dir}/documents.parquet")).collect()
    patterns = Counter(tuple(r.ballot) for r in judged)
    prior, right = quality_rules.estimate(sorted(patterns.items()), len(quality_rules.RULES))
    for r in judged:
        p = quality_rules.posterior(tuple(r.ballot), prior, right)
        assert abs(p - r.posterior) < 1e-9 and r.kept == (not r.base_failed and p >= 0.5)


def test_em_recovers_planted_accuracies():
    import random

    rng = random.Random(5)
    truth, patterns = [(0.95, 0.9), (0.7, 0.8), (0.85, 0.6), (0.9, 0.9)], Counter()
    for _ in range(40_000):
        good = rng.random() < 0.75
        patterns[tuple(0 if rng.random() < 0.2 else (1 if good else -1) * (1 if rng.random() < t[0 if good else 1] else -1) for t in truth)] += 1
    prior, right = quality_rules.estimate(sorted(patterns.items()), 4)
    assert abs(prior - 0.75) < 0.03
    assert all(abs(a - b) < 0.04 for t, r in zip(truth, right) for a, b in zip(t, r))


def test_agrees_with_labels(spark, small_dir):
    """Labels are not used by the operator; they measure it."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.kept) for r in queries.QUERIES["op9_quality_rules"](spark, small_dir).collect() if r.doc_id in labels]
    kept = sum(k for q, k in rows if q) / sum(1 for q, _ in rows if q)
    dropped = sum(not k for q, k in rows if not q) / sum(1 for q, _ in rows if not q)
    assert kept > 0.9 and dropped > 0.7


def test_no_python_in_the_plan(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    plan = quality_rules.keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
