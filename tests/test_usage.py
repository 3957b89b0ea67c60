"""Usage, governance and evaluation operators on small known cases."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from larkspur.functions import parsing
from larkspur.operators import evals, governance, learning, usage

NOW = dt.datetime(2024, 6, 30, 12)


@pytest.fixture
def calls(spark):
    rows = [
        ("gpt-4o", 0.01, NOW, "chat"), ("gpt-4o", 0.02, NOW, "search"), ("claude-3", 0.05, NOW, "chat"),
        ("gpt-4o", 0.5, NOW - dt.timedelta(days=60), "chat"),
    ]
    return spark.createDataFrame(rows, "model string, cost double, ts timestamp_ntz, use_case string").select(
        "model", usage.money(F.col("cost")).alias("cost_usd"), F.lit(10).alias("total_tokens"), "use_case", "ts"
    )


def as_of():
    return F.lit(NOW).cast("timestamp_ntz")


def test_totals_leave_old_calls_out(calls):
    assert usage.total_cost(calls, as_of()).first().total_cost == 0.08
    assert usage.total_cost(calls.limit(0), as_of()).first().total_cost == 0.0


@pytest.mark.parametrize("key", ["model", "no such key"])
def test_summary_by_model(calls, key):
    out = {r.group_key: (r.calls, r.total_cost) for r in usage.summary(calls, key, as_of()).collect()}
    assert out == {"gpt-4o": (2, 0.03), "claude-3": (1, 0.05)}


def test_window_bound_is_included(calls):
    assert usage.within_days(calls, "ts", as_of(), 60).count() == 4
    assert usage.within_days(calls, "ts", as_of(), 59).count() == 3


def test_anomalies_need_seven_days(spark):
    rows = [(f"2024-01-0{i}", 1.0) for i in range(1, 7)] + [("2024-01-07", 8.0)]
    daily = spark.createDataFrame(rows, "day string, total_cost double")
    assert [r.day for r in usage.cost_anomalies(daily).collect()] == ["2024-01-07"]
    assert usage.cost_anomalies(daily.where("day > '2024-01-01'")).count() == 0


def test_unknown_model_is_not_priced(spark):
    calls = spark.createDataFrame([("gpt-4-turbo", 1000, 500), ("new", 1, 1)], "model string, prompt_tokens int, completion_tokens int")
    prices = spark.createDataFrame([("gpt-4-turbo", 0.01, 0.03)], "model string, input_per_1k double, output_per_1k double")
    out = {r.model: (r.priced, r.cost_usd and float(r.cost_usd)) for r in usage.price_usage(calls, prices).collect()}
    assert out == {"gpt-4-turbo": (True, 0.025), "new": (False, None)}


def test_blended_cost(spark):
    assert spark.range(1).select(usage.blended_cost(F.lit(2000), F.lit(0.01), F.lit(0.03))).first()[0] == pytest.approx(0.04)


def log(spark, n=5):
    rows = [(i, "read" if i % 2 else "write", f"a{i % 3}", i, i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "event_id int, action string, actor string, ts int, is_error boolean")


def test_audit_limit_and_order(spark):
    out = governance.audit_query(log(spark), limit=3).collect()
    assert [r.event_id for r in out] == [2, 3, 4]
    assert governance.audit_query(log(spark), limit=0).count() == 0
    assert [r.event_id for r in governance.audit_query(log(spark), action="read", since=F.lit(2)).collect()] == [3]
    assert [r.event_id for r in governance.audit_query(log(spark), actor="a1").collect()] == [1, 4]


def test_tool_calls(spark):
    rows = log(spark).select("event_id", F.col("action").alias("tool_name"), F.col("actor").alias("agent_id"), "ts", "is_error")
    assert [r.event_id for r in governance.tool_calls(rows, errors_only=True, last=2).collect()] == [2, 4]
    assert [r.event_id for r in governance.tool_calls(rows, tool="read", agent="a1").collect()] == [1]


@pytest.mark.parametrize("n,size", [(23, 5), (20, 5), (3, 5)])
def test_pages_cover_the_rows_once(spark, n, size):
    rows = spark.createDataFrame([(i // 4, i) for i in range(n)], "created int, id int")
    want = sorted(range(n), reverse=True)
    pages = -(-n // size)
    by_offset = [[r.id for r in governance.offset_page(rows, ["created", "id"], p, size).collect()] for p in range(1, pages + 1)]
    assert [x for p in by_offset for x in p] == want
    assert governance.offset_page(rows, ["created", "id"], 1, size).first().total_pages == pages
    seen, cursor, more = want[:1], rows.where(F.col("id") == n - 1), n > 1
    while more:
        page = governance.keyset_page(rows, ["created", "id"], cursor, size).orderBy(F.desc("id")).collect()
        seen += [r.id for r in page]
        more, cursor = page[0].has_more, rows.where(F.col("id") == seen[-1])
    assert seen == want


def test_consent(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [
        ("u", "train", True, None, day(1), 1), ("u", "train", False, None, day(2), 2), ("u", "mail", True, day(3), day(1), 3),
        ("v", "train", True, day(9), day(1), 4),
    ]
    records = spark.createDataFrame(rows, "user_id string, purpose string, granted boolean, expires_at timestamp, recorded_at timestamp, record_id int")
    asked = spark.createDataFrame([("u", "train"), ("u", "mail"), ("v", "train"), ("w", "train")], "user_id string, purpose string")
    decisions = governance.consent_decisions(records, F.lit(day(5)))
    out = {(r.user_id, r.purpose): r.allowed for r in governance.consent_gate(asked, decisions).collect()}
    assert out == {("u", "train"): False, ("u", "mail"): False, ("v", "train"): True, ("w", "train"): False}


def test_retention(spark):
    rows = spark.createDataFrame([(1, "log", NOW - dt.timedelta(days=9)), (2, "log", NOW), (3, "hold", NOW - dt.timedelta(days=99)), (4, "anon", NOW - dt.timedelta(days=9)), (5, "free", NOW - dt.timedelta(days=999))], "id int, cat string, ts timestamp")
    policies = spark.createDataFrame([("log", 5, "hard_delete", False), ("hold", 5, "hard_delete", True), ("anon", 5, "anonymize", False)], "category string, retention_days int, strategy string, legal_hold boolean")
    marked = governance.retention_actions(rows.withColumn("who", F.lit("me")), policies, F.lit(NOW), "cat", "ts")
    out = {r.id: r.who for r in governance.retention_apply(marked, ["who"]).collect()}
    assert out == {2: "me", 3: "me", 4: None, 5: "me"}


def test_majority_ties_go_to_the_first(spark):
    df = spark.createDataFrame([("p", "b", 1), ("p", "a", 2), ("p", "a", 3), ("p", "b", 4), ("q", "z", 1)], "p string, a string, o int")
    out = {r.p: (r.majority, r.agreement) for r in evals.majority_answer(df, "p", "a", ["o"], 0.5).collect()}
    assert out == {"p": ("b", 0.5), "q": ("z", 1.0)}
    assert evals.majority_answer(df, "p", "a", ["o"]).where("p = 'p'").first().majority is None


def test_entropy(spark):
    df = spark.createDataFrame([("g", 1), ("g", 1), ("g", 2), ("h", 3)], "g string, l int")
    out = {r.g: r.entropy for r in evals.label_entropy(df, "g", "l").collect()}
    want = -sum(p * math.log(p + 1e-10) for p in (2 / 3, 1 / 3))
    assert out["g"] == pytest.approx(want) and out["h"] == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize("scores,passed,attempt", [([0.4, 0.9], True, 2), ([0.2, 0.2, 0.2], False, 3), ([0.1, 0.2, 0.3, 0.9], False, 3)])
def test_attempts(spark, scores, passed, attempt):
    df = spark.createDataFrame([("q", i + 1, s) for i, s in enumerate(scores)], "q string, n int, s double")
    r = evals.first_passing_attempt(df, "q", "n", "s").first()
    assert (r.passed, r.attempt) == (passed, attempt)


def test_votes(spark):
    two = [F.lit(True), F.lit(True), F.lit(False)]
    row = spark.range(1).select(evals.vote_verdict(two)[0].alias("a"), evals.vote_verdict(two, 0.67)[0].alias("b")).first()
    assert (row.a, row.b) == (True, False)


def test_grounding(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("c", None)], "a string, ok boolean")
    out = {r.a: (r.grounding, r.is_grounded) for r in evals.grounding_score(df, "a", "ok").collect()}
    assert out == {"a": (0.5, False), "b": (1.0, True), "c": (1.0, True)}


def test_drift_of_nothing(spark):
    empty = spark.createDataFrame([], "similarity double, drifted boolean")
    assert tuple(evals.drift_report(empty).first()) == (0, 0, None, None)


def test_gate(spark):
    df = spark.createDataFrame([(0.9, 0.5, 0.8, None)], "faithfulness double, answer_relevancy double, context_precision double, context_recall double")
    means = evals.eval_means(df, list(evals.EVAL_THRESHOLDS))
    row = evals.eval_gate(means).first()
    assert row.failures == ["answer_relevancy 0.50 < 0.8"] and row.passed is False
    assert row.overall == pytest.approx((0.9 + 0.5 + 0.8) / 3)


def test_citations(spark):
    claims = spark.createDataFrame([("[1]",), ("[2]",), ("[99]",), ("junk",)], "citation string")
    docs = spark.createDataFrame([(1, True), (2, False)], "doc_id bigint, supported boolean")
    out = {r.citation: r.verified for r in evals.citation_check(claims, docs).collect()}
    assert out == {"[1]": True, "[2]": False, "[99]": False, "junk": False}


def test_parsing(spark):
    texts = ["Answer: yes\nConfidence: 1.7\nReasoning: why", "just text", "Confidence: high\nAnswer:"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parsing.parse_tagged(F.col("t")).alias("p")).select("p.*")
    assert [tuple(r) for r in df.collect()] == [
        ("yes", 1.0, "why"),
        ("just text", 0.5, "Based on provided context"),
        (texts[2], 0.5, "Based on provided context"),
    ]
    scores = spark.createDataFrame([(" 8\n",), ("x",), ("11",)], "t string").select(parsing.parse_score(F.col("t"), 10)).collect()
    assert [r[0] for r in scores] == [0.8, 0.5, 1.0]
    lines = spark.createDataFrame([("- one\n\n- two ",)], "t string").select(parsing.expansion_lines(F.col("t"))).first()[0]
    assert lines == ["one", "two"]
    bad = spark.createDataFrame([('{"faithfulness_score": 2}',), ("{",)], "t string").select(parsing.parse_judgement(F.col("t"))).collect()
    assert [r[0] for r in bad] == [None, None]


def test_rubric(spark):
    rows = [('{"scores": [{"criterion": "a", "score": 5}, {"criterion": "b", "score": 2}], "winner": "A"}',), ('{"scores": [], "winner": "B"}',), ('{"winner": "A"}',)]
    df = spark.createDataFrame(rows, "j string")
    assert [r[0] for r in df.select(evals.rubric_mean(F.col("j"))).collect()] == [3.5, 0.0, 0.0]
    assert {r.winner: r.wins for r in evals.win_rates(df, "j").collect()} == {"A": 2, "B": 1}


def test_intents_learn_the_label_names(spark):
    rows = [("refund my bill invoice", "billing"), ("server crash error log", "technical")] * 6
    df = spark.createDataFrame(rows, "text string, label string")
    out = learning.classify_intents(learning.train_intents(df, "text", "label"), df).collect()
    assert all(r.intent == r.label and 0.5 < r.confidence <= 1 for r in out)


def test_routes(spark):
    df = spark.createDataFrame([("billing", 0.9), ("billing", 0.75), ("technical", 0.99), ("escalate", 0.9), ("escalate", 0.1)], "i string, c double")
    got = [r[0] for r in df.select(learning.route(F.col("i"), F.col("c"))).collect()]
    assert got == ["template", "llm", "llm", "escalate", "llm"]


def test_scores_match_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rows = [(float(i % 3), float((i * 7 // 5) % 2 + (i % 4 == 0))) for i in range(60)]
    df = spark.createDataFrame(rows, "y double, prediction double")
    got = {r.metric: r.value for r in learning.classification_scores(df, "y").collect()}
    for metric, value in got.items():
        assert value == pytest.approx(MulticlassClassificationEvaluator(labelCol="y", metricName=metric).evaluate(df))


def test_holdout_is_a_stable_split(spark):
    df = spark.range(2000)
    train, test = learning.holdout(df)
    assert train.count() + test.count() == 2000 and 300 < test.count() < 500
    assert test.join(learning.holdout(df.repartition(9))[1], "id").count() == test.count()
