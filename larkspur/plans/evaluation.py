"""Evaluation, parsing and routing queries over labels, vectors and conversations."""

from pyspark.sql import functions as F

from larkspur.functions import parsing
from larkspur.operators import clusters, evals, learning
from larkspur.plans.registry import query
from larkspur.plans.retrieval import CENTROIDS, centroids
from larkspur.session import work_path

OWN = f"{CENTROIDS}, own AS (SELECT doc_id AS vec_id, cos AS similarity FROM sims WHERE query_id = label)"


def _regression(t):
    """A vector is the expected output, the mean of its label the actual one."""
    expected = t.embeddings.select("vec_id", F.col("embedding").alias("vector"))
    actual = t.embeddings.select("vec_id", "label").join(centroids(t), F.col("label") == F.col("query_id"))
    actual = actual.select("vec_id", F.col("query_vec").alias("vector"))
    return evals.golden_regression(expected, actual, "vec_id", 0.4, 0.3)


@query(
    "golden_regression",
    f"{OWN} SELECT vec_id, round(similarity, 6) AS similarity, similarity >= 0.4 AS passed, similarity < 0.3 AS drifted FROM own",
)
def golden_regression(t):
    return _regression(t).withColumn("similarity", F.round("similarity", 6))


@query(
    "drift_report",
    f"""{OWN} SELECT count(*) AS total_examples, count(*) FILTER (WHERE similarity < 0.3) AS drifted_count,
      round(count(*) FILTER (WHERE similarity < 0.3) * 100.0 / count(*), 6) AS drift_percentage, round(avg(similarity), 6) AS average_similarity FROM own""",
)
def drift_report(t):
    return evals.drift_report(_regression(t))


@query(
    "golden_load",
    "SELECT CAST(item_id AS VARCHAR) AS id, md5(text) AS expected_md5, 'benchmark' AS kind FROM benchmark",
)
def golden_load(t):
    path = work_path(t.spark, "golden")
    t.benchmark.select(
        F.col("item_id").cast("string").alias("id"),
        F.create_map(F.lit("query"), F.col("text")).alias("input"),
        F.col("text").alias("expected_output"),
        F.create_map(F.lit("kind"), F.lit("benchmark")).alias("metadata"),
    ).write.json(path)
    golden = evals.load_golden(t.spark, path)
    return golden.select("id", F.md5("expected_output").alias("expected_md5"), F.col("metadata")["kind"].alias("kind"))


@query(
    "citation_check",
    """WITH c AS (SELECT conv_id, turn, role, conv_id * 8 + turn AS cited FROM conversations),
      v AS (SELECT role, coalesce(quality = 1, false) AS verified FROM c LEFT JOIN labels ON doc_id = cited)
      SELECT role, count(*) AS claims, round(avg(CAST(verified AS INT)), 6) AS accuracy FROM v GROUP BY 1""",
)
def citation_check(t):
    cited = F.concat(F.lit("["), (F.col("conv_id") * 8 + F.col("turn")).cast("string"), F.lit("]"))
    claims = t.conversations.select("conv_id", "turn", "role", cited.alias("citation"))
    docs = t.labels.select("doc_id", (F.col("quality") == 1).alias("supported"))
    return (
        evals.citation_check(claims, docs)
        .groupBy("role")
        .agg(F.count(F.lit(1)).alias("claims"), F.round(evals.share("verified"), 6).alias("accuracy"))
    )


SCORED = """WITH s AS (SELECT documents.doc_id, CAST(quality AS DOUBLE) AS faithfulness, CAST(1 - toxic AS DOUBLE) AS answer_relevancy,
    least(1.0, n_chars / 3000) AS context_precision, CASE WHEN lang <> 'de' THEN least(1.0, n_chars / 1000) END AS context_recall
  FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id),
  m AS (SELECT count(*) AS examples, avg(faithfulness) AS faithfulness, avg(answer_relevancy) AS answer_relevancy,
    avg(context_precision) AS context_precision, avg(context_recall) AS context_recall FROM s)"""
METRICS = list(evals.EVAL_THRESHOLDS)


def _scored(t):
    return t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left").select(
        "doc_id",
        F.col("quality").cast("double").alias("faithfulness"),
        (1 - F.col("toxic")).cast("double").alias("answer_relevancy"),
        F.least(F.lit(1.0), F.col("n_chars") / 3000).alias("context_precision"),
        F.when(F.col("lang") != "de", F.least(F.lit(1.0), F.col("n_chars") / 1000)).alias("context_recall"),
    )


@query(
    "eval_means",
    f"""{SCORED} SELECT examples, round(faithfulness, 6) AS faithfulness, round(answer_relevancy, 6) AS answer_relevancy, round(context_precision, 6) AS context_precision,
      round(context_recall, 6) AS context_recall, round((faithfulness + answer_relevancy + context_precision + context_recall) / 4, 6) AS overall FROM m""",
)
def eval_means(t):
    means = evals.eval_means(_scored(t), METRICS)
    return means.select("examples", *[F.round(c, 6).alias(c) for c in [*METRICS, "overall"]])


@query(
    "eval_gate",
    f"""{SCORED}, f AS (SELECT list_filter(["""
    + ", ".join(
        f"CASE WHEN {m} < {x} THEN '{m} ' || printf('%.2f', {m}) || ' < {x}' END" for m, x in evals.EVAL_THRESHOLDS.items()
    )
    + """], lambda v: v IS NOT NULL) AS f FROM m) SELECT array_to_string(f, '; ') AS failures, len(f) = 0 AS passed FROM f""",
)
def eval_gate(t):
    gate = evals.eval_gate(evals.eval_means(_scored(t), METRICS))
    return gate.select(F.array_join("failures", "; ").alias("failures"), "passed")


@query(
    "case_gate",
    """WITH c AS (SELECT doc_id, CAST(quality AS DOUBLE) AS f, CAST(toxic AS DOUBLE) AS h, least(1.0, (doc_id % 100) / 100) AS r FROM labels),
      g AS (SELECT doc_id, list_filter([CASE WHEN f < 0.7 THEN 'Low faithfulness: ' || printf('%.2f', f) || ' < 0.7' END,
        CASE WHEN h > 0.5 THEN 'Hallucination detected: ' || printf('%.2f', h) END, CASE WHEN r < 0.7 THEN 'Low relevancy: ' || printf('%.2f', r) END], lambda v: v IS NOT NULL) AS i FROM c)
      SELECT doc_id, array_to_string(i, '; ') AS issues, len(i) = 0 AS passed FROM g""",
)
def case_gate(t):
    cases = t.labels.select(
        "doc_id",
        F.col("quality").cast("double").alias("faithfulness"),
        F.col("toxic").cast("double").alias("hallucination"),
        (F.pmod("doc_id", F.lit(100)) / 100).alias("relevancy"),
    )
    return evals.case_gate(cases).select("doc_id", F.array_join("issues", "; ").alias("issues"), "passed")


@query(
    "majority_answer",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS seen FROM events GROUP BY 1, 2),
      t AS (SELECT user_id, sum(n) AS tot FROM c GROUP BY 1)
      SELECT user_id, CASE WHEN n / tot >= 0.25 THEN event_type END AS majority, round(n / tot, 6) AS agreement FROM c JOIN t USING (user_id)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, seen) = 1""",
)
def majority_answer(t):
    rows = t.events.select("user_id", "event_type", "event_id")
    out = evals.majority_answer(rows, "user_id", "event_type", ["event_id"], 0.25)
    return out.withColumn("agreement", F.round("agreement", 6))


@query(
    "label_entropy",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT user_id, sum(n) AS tot FROM c GROUP BY 1)
      SELECT user_id, round(-sum(n / tot * ln(n / tot + 1e-10)), 6) AS entropy FROM c JOIN t USING (user_id) GROUP BY 1""",
)
def label_entropy(t):
    out = evals.label_entropy(t.events, "user_id", "event_type")
    return out.select("user_id", F.round("entropy", 6).alias("entropy"))


@query(
    "grounding_score",
    """WITH c AS (SELECT source, quality = 1 AS ok FROM documents LEFT JOIN labels USING (doc_id)),
      g AS (SELECT source, count(ok) AS claims, coalesce(1 - count(*) FILTER (WHERE NOT ok) / nullif(count(ok), 0), 1.0) AS g, count(*) FILTER (WHERE NOT ok) = 0 AS is_grounded FROM c GROUP BY 1)
      SELECT source, claims, round(g, 6) AS grounding, is_grounded, CASE WHEN g < 0.7 THEN 'Faithfulness score ' || printf('%.2f', g) || ' below threshold 0.70' END AS violation FROM g""",
)
def grounding_score(t):
    claims = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left")
    scored = evals.grounding_score(claims.withColumn("ok", F.col("quality") == 1), "source", "ok")
    return scored.withColumn("violation", evals.faithfulness_violation(F.col("grounding"))).withColumn(
        "grounding", F.round("grounding", 6)
    )


def _judgements(t):
    score = lambda c: F.struct(F.lit(c).alias("criterion"), F.col(c).cast("double").alias("score"))
    winner = F.when(F.col("quality") > F.col("toxic"), "A").when(F.col("quality") < F.col("toxic"), "B").otherwise("tie")
    body = F.struct(F.array(score("quality"), score("toxic")).alias("scores"), winner.alias("winner"))
    return t.labels.select("doc_id", F.to_json(body).alias("judgement"))


@query("rubric_mean", "SELECT doc_id, (quality + toxic) / 2 AS overall FROM labels")
def rubric_mean(t):
    return _judgements(t).select("doc_id", evals.rubric_mean(F.col("judgement")).alias("overall"))


@query(
    "win_rates",
    """SELECT CASE WHEN quality > toxic THEN 'A' WHEN quality < toxic THEN 'B' ELSE 'tie' END AS winner, count(*) AS wins,
      round(count(*) / (SELECT count(*) FROM labels), 6) AS win_rate FROM labels GROUP BY 1""",
)
def win_rates(t):
    return evals.win_rates(_judgements(t), "judgement")


@query(
    "vote_verdict",
    """WITH v AS (SELECT doc_id, CAST(quality = 1 AS INT) + CAST(toxic = 0 AS INT) + CAST(doc_id % 2 = 0 AS INT) AS y FROM labels)
      SELECT doc_id, y >= 2 AS verified, y / 3 >= 0.67 AS verified_literal, round(y / 3, 6) AS confidence FROM v""",
)
def vote_verdict(t):
    votes = [F.col("quality") == 1, F.col("toxic") == 0, F.pmod("doc_id", F.lit(2)) == 0]
    verified, confidence = evals.vote_verdict(votes)
    literal, _ = evals.vote_verdict(votes, 0.67)
    return t.labels.select(
        "doc_id", verified.alias("verified"), literal.alias("verified_literal"), F.round(confidence, 6).alias("confidence")
    )


@query(
    "first_passing_attempt",
    """WITH a AS (SELECT conv_id, turn + 1 AS attempt, (length(text) % 100) / 100 AS score FROM conversations WHERE turn + 1 <= 3),
      g AS (SELECT conv_id, min(CASE WHEN score >= 0.7 THEN attempt END) AS p, max(attempt) AS l FROM a GROUP BY 1)
      SELECT conv_id, p IS NOT NULL AS passed, attempt, score FROM g JOIN a USING (conv_id) WHERE attempt = coalesce(p, l)""",
)
def first_passing_attempt(t):
    score = F.pmod(F.length("text"), F.lit(100)) / 100
    attempts = t.conversations.select("conv_id", (F.col("turn") + 1).alias("attempt"), score.alias("score"))
    return evals.first_passing_attempt(attempts, "conv_id", "attempt", "score")


OUTPUT = """CASE doc_id % 4 WHEN 0 THEN 'Answer: ' || source || chr(10) || 'Confidence: 0.' || doc_id % 10 || chr(10) || '  Reasoning: seen in ' || lang
  WHEN 1 THEN 'Confidence: high' || chr(10) || 'Answer: ' || source WHEN 2 THEN 'Answer: ' || lang || chr(10) || 'Confidence: 7' ELSE source || ' says' END"""


def _outputs(t):
    i, source, lang = F.col("doc_id"), F.col("source"), F.col("lang")
    kind = F.pmod(i, F.lit(4))
    full = F.concat(
        F.lit("Answer: "), source, F.lit("\nConfidence: 0."), F.pmod(i, F.lit(10)).cast("string"), F.lit("\n  Reasoning: seen in "), lang
    )
    text = (
        F.when(kind == 0, full)
        .when(kind == 1, F.concat(F.lit("Confidence: high\nAnswer: "), source))
        .when(kind == 2, F.concat(F.lit("Answer: "), lang, F.lit("\nConfidence: 7")))
        .otherwise(F.concat(source, F.lit(" says")))
    )
    return t.documents.select("doc_id", text.alias("output"))


@query(
    "parse_tagged",
    """SELECT doc_id, CASE doc_id % 4 WHEN 2 THEN lang WHEN 3 THEN source || ' says' ELSE source END AS answer,
      CASE doc_id % 4 WHEN 0 THEN (doc_id % 10) / 10 WHEN 2 THEN 1.0 ELSE 0.5 END AS confidence,
      CASE doc_id % 4 WHEN 0 THEN 'seen in ' || lang ELSE 'Based on provided context' END AS reasoning FROM documents""",
)
def parse_tagged(t):
    return _outputs(t).select("doc_id", parsing.parse_tagged(F.col("output")).alias("p")).select("doc_id", "p.*")


@query(
    "parse_score",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0.5 ELSE least(1.0, value / 10) END AS score FROM events""",
)
def parse_score(t):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit("\n")))
    return t.events.select("event_id", parsing.parse_score(text, 10).alias("score"))


@query(
    "parse_judgement",
    """SELECT doc_id, CASE WHEN doc_id % 3 <> 2 THEN quality = 1 END AS is_grounded,
      CASE WHEN doc_id % 3 <> 2 THEN quality / 2 END AS faithfulness_score FROM labels""",
)
def parse_judgement(t):
    good = F.to_json(
        F.struct((F.col("quality") == 1).alias("is_grounded"), (F.col("quality") / 2).alias("faithfulness_score"))
    )
    text = F.when(F.pmod("doc_id", F.lit(3)) == 2, '{"is_grounded": true, "faithfulness_score": 4}').otherwise(good)
    parsed = t.labels.select("doc_id", parsing.parse_judgement(text).alias("j"))
    return parsed.select("doc_id", "j.is_grounded", "j.faithfulness_score")


@query(
    "route_intent",
    """WITH i AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'technical' WHEN 'fr' THEN 'billing' WHEN 'de' THEN 'general' ELSE 'escalate' END AS intent,
        least(1.0, n_chars / 1000) AS confidence FROM documents)
      SELECT doc_id, intent, CASE WHEN intent IN ('billing', 'general') AND confidence >= 0.8 THEN 'template'
        WHEN intent = 'technical' OR confidence < 0.7 THEN 'llm' WHEN intent = 'escalate' THEN 'escalate' ELSE 'llm' END AS method,
        md5(CASE intent WHEN 'billing' THEN 'You are a billing support agent. Be empathetic but strict about policy.'
          WHEN 'technical' THEN 'You are a technical engineer. Provide step-by-step troubleshooting.' ELSE 'You are a helpful assistant.' END) AS prompt_md5 FROM i""",
)
def route_intent(t):
    lang = F.col("lang")
    intent = F.when(lang == "en", "technical").when(lang == "fr", "billing").when(lang == "de", "general").otherwise("escalate")
    asked = t.documents.select("doc_id", intent.alias("intent"), F.least(F.lit(1.0), F.col("n_chars") / 1000).alias("confidence"))
    renamed = F.when(F.col("intent") == "billing", "refund").when(F.col("intent") == "technical", "technical_support").otherwise(F.col("intent"))
    return asked.select(
        "doc_id", "intent", learning.route(F.col("intent"), F.col("confidence")).alias("method"),
        F.md5(learning.prompt_for(renamed)).alias("prompt_md5"),
    )


# Six numbers of a vector stand for an answer, its label for the prompt.
_CLUSTERS = """p AS (SELECT label, vec_id, embedding[1:6]::DOUBLE[] AS v FROM embeddings),
      e AS (SELECT a.label, a.vec_id AS x, b.vec_id AS y FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND round(list_cosine_similarity(a.v, b.v), 9) >= 0.8),
      core AS (SELECT x FROM e GROUP BY x HAVING count(*) >= 2),
      reach(x, y) AS (SELECT x, x FROM core UNION SELECT r.x, e.y FROM reach r JOIN e ON e.x = r.y JOIN core c ON c.x = e.y),
      own AS (SELECT y AS vec_id, min(x) AS cluster FROM reach GROUP BY y),
      border AS (SELECT e.x AS vec_id, min(o.cluster) AS cluster FROM e JOIN own o ON o.vec_id = e.y WHERE e.x NOT IN (SELECT x FROM core) GROUP BY e.x),
      c AS (SELECT p.label, p.vec_id, coalesce(o.cluster, b.cluster) AS cluster FROM p LEFT JOIN own o USING (vec_id) LEFT JOIN border b USING (vec_id))"""


@query("answer_clusters", f"WITH RECURSIVE {_CLUSTERS} SELECT label, vec_id, cluster FROM c")
def answer_clusters(t):
    rows = t.embeddings.withColumn("v", F.slice("embedding", 1, 6))
    return clusters.density_clusters(rows, "label", "vec_id", "v", eps=0.2, min_samples=3)


@query(
    "answer_entropy",
    f"""WITH RECURSIVE {_CLUSTERS}, n AS (SELECT label, cluster, count(*) / sum(count(*)) OVER (PARTITION BY label) AS share FROM c GROUP BY label, cluster)
      SELECT label, round(-sum(share * ln(share + 1e-10)), 6) AS entropy FROM n GROUP BY label""",
)
def answer_entropy(t):
    rows = t.embeddings.withColumn("v", F.slice("embedding", 1, 6))
    out = clusters.answer_entropy(rows, "label", "vec_id", "v", eps=0.2, min_samples=3)
    return out.select("label", F.round("entropy", 6).alias("entropy"))


@query(
    "drifted_examples",
    f"{OWN} SELECT vec_id, round(similarity, 6) AS similarity, substr(text, 1, 100) AS text FROM own JOIN documents ON doc_id = vec_id WHERE similarity < 0.3",
)
def drifted_examples(t):
    """The drifted vectors of the regression with the beginnings of the documents of their numbers."""
    texts = t.documents.select(F.col("doc_id").alias("vec_id"), "text")
    out = evals.drifted_examples(_regression(t).join(texts, "vec_id"), ["text"])
    return out.select("vec_id", F.round("similarity", 6).alias("similarity"), "text")


@query(
    "expansion_lines",
    r"""WITH l AS (SELECT conv_id, turn, unnest(string_split('- ' || replace(text, '. ', chr(10) || ' - '), chr(10))) AS line FROM conversations),
      c AS (SELECT conv_id, turn, regexp_replace(line, '^[\s\x{0b}\-]+|[\s\x{0b}\-]+$', '', 'g') AS line FROM l)
      SELECT conv_id, turn, count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS chars FROM c WHERE line <> '' GROUP BY 1, 2""",
)
def expansion_lines(t):
    """Messages with a line for each sentence, marked as a list."""
    text = F.concat(F.lit("- "), F.replace("text", F.lit(". "), F.lit("\n - ")))
    lines = t.conversations.select("conv_id", "turn", F.explode(parsing.expansion_lines(text)).alias("line"))
    return lines.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("chars"))
