"""Model training and scoring queries over labelled documents."""

from pyspark.sql import functions as F

from larkspur.operators import learning
from larkspur.plans.registry import query


def _labelled(t):
    name = F.when(F.col("quality") == 1, "good").otherwise("poor")
    return t.heavy("documents", "doc_id").select("doc_id", "text", "n_chars").join(t.labels.select("doc_id", "toxic", name.alias("name")), "doc_id")


@query("intent_classify")
def intent_classify(t):
    # The classifier this stands for keeps a thousand words.
    model = learning.train_intents(_labelled(t), "text", "name", vocabulary=1000)
    scored = learning.classify_intents(model, t.heavy("documents", "doc_id").select("doc_id", "text"))
    return scored.select("doc_id", "intent", F.round("confidence", 6).alias("confidence"))


def _features(t):
    return _labelled(t).select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.col("toxic").cast("double").alias("toxic"),
        (F.col("name") == "good").cast("double").alias("y"),
    )


@query("train_eval")
def train_eval(t):
    return learning.train_eval(_features(t), ["n_chars", "n_words", "toxic"], "y")[0]


@query(
    "classification_scores",
    """WITH p AS (SELECT quality AS y, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS z FROM documents JOIN labels USING (doc_id)),
      c AS (SELECT k, count(*) FILTER (WHERE y = k) AS support, count(*) FILTER (WHERE z = k) AS predicted, count(*) FILTER (WHERE y = k AND z = k) AS hit
        FROM p, (VALUES (0), (1)) AS v(k) GROUP BY 1)
      SELECT 'accuracy' AS metric, round(sum(hit) / sum(support), 9) AS value FROM c
      UNION ALL SELECT 'f1', round(sum(2.0 * hit / (support + predicted) * support) / sum(support), 9) FROM c WHERE support > 0""",
)
def classification_scores(t):
    """Accuracy and weighted F1 of a fixed rule, long texts are good ones."""
    rows = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", F.col("quality").alias("y")), "doc_id")
    scored = rows.select("y", (F.col("n_chars") > 1500).cast("int").alias("z"))
    return learning.classification_scores(scored, "y", "z").withColumn("value", F.round("value", 9))


@query("cross_validate")
def cross_validate(t):
    """Mean F1 per tree depth."""
    _, means = learning.cross_validate(_features(t), ["n_chars", "n_words", "toxic"], "y")
    return t.spark.createDataFrame([(d, float(v)) for d, v in means.items()], "depth int, f1 double")


@query("score_batch")
def score_batch(t):
    _, model = learning.train_eval(_features(t), ["n_chars", "n_words", "toxic"], "y")
    return learning.score_batch(model, _features(t), ["doc_id"])


@query(
    "score_external",
    "SELECT event_id, CASE WHEN value + user_id > 100 THEN 'high' ELSE 'low' END AS label FROM events",
)
def score_external(t):
    def load():
        limit = 100.0
        return lambda rows: ["high" if x > limit else "low" for x in rows["value"] + rows["user_id"]]

    return learning.score_external(t.events.select("event_id", "value", "user_id"), ["value", "user_id"], load).select("event_id", "label")
