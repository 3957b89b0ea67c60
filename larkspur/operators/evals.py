"""Evaluation tables: means, gates, votes, drift and grounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.vectors import cosine
from larkspur.operators.ordered import first_n

# Gate thresholds by metric.
EVAL_THRESHOLDS = {
    "faithfulness": 0.85,
    "answer_relevancy": 0.80,
    "context_precision": 0.75,
    "context_recall": 0.75,
}

GOLDEN_SCHEMA = (
    "id string, input map<string,string>, expected_output string, metadata map<string,string>, created_at string"
)


def load_golden(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Golden examples from JSON; one object per line unless ``multi_line``."""
    return spark.read.schema(GOLDEN_SCHEMA).option("multiLine", multi_line).json(path)


def golden_regression(
    expected: DataFrame, actual: DataFrame, key: str, pass_at: float = 0.85, drift_below: float = 0.7
) -> DataFrame:
    """Expected against actual by id. Columns: key, vector on both sides."""
    right = actual.select(F.col(key), F.col("vector").alias("__actual"))
    similarity = F.coalesce(cosine(F.col("vector"), F.col("__actual")), F.lit(0.0))
    return (
        expected.join(right, key)
        .withColumn("similarity", similarity)
        .withColumn("passed", F.col("similarity") >= pass_at)
        .withColumn("drifted", F.col("similarity") < drift_below)
        .drop("vector", "__actual")
    )


def drift_report(results: DataFrame) -> DataFrame:
    """Totals of a regression run; no examples give nulls, not an error."""
    n, drifted = F.count(F.lit(1)), F.count_if("drifted")
    return results.agg(
        n.alias("total_examples"),
        drifted.alias("drifted_count"),
        F.round(F.try_divide(drifted * 100.0, n), 6).alias("drift_percentage"),
        F.round(F.avg("similarity"), 6).alias("average_similarity"),
    )


def drifted_examples(results: DataFrame, texts: list[str]) -> DataFrame:
    """The drifted examples with their texts cut to 100 characters."""
    return results.where("drifted").select(
        *[F.substring(c, 1, 100).alias(c) if c in texts else F.col(c) for c in results.columns]
    )


def citation_check(claims: DataFrame, docs: DataFrame) -> DataFrame:
    """Claims with ``verified``: the cited document exists and supports the claim.

    ``claims``: citation like ``[12]``; ``docs``: doc_id, supported.
    """
    cited = F.regexp_replace("citation", r"^[\[\]]+|[\[\]]+$", "").try_cast("bigint")
    known = docs.select(F.col("doc_id").alias("__doc"), F.col("supported"))
    return (
        claims.withColumn("__cited", cited)
        .join(known, F.col("__cited") == F.col("__doc"), "left")
        .withColumn("verified", F.coalesce("supported", F.lit(False)))
        .drop("__cited", "__doc", "supported")
    )


def share(flag: str) -> Column:
    """Mean of a flag, 0 when there are no rows."""
    return F.coalesce(F.avg(F.col(flag).cast("int")), F.lit(0.0))


def eval_means(scores: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean per metric without nulls, and the mean of the means that exist."""
    means = scores.agg(F.count(F.lit(1)).alias("examples"), *[F.avg(m).alias(m) for m in metrics])
    present = F.array_compact(F.array(*[F.col(m) for m in metrics]))
    total = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
    return means.withColumn("overall", F.try_divide(total, F.size(present)))


def _join_issues(issues: list[Column]) -> Column:
    return F.array_compact(F.array(*issues))


def eval_gate(means: DataFrame, thresholds: dict[str, float] = EVAL_THRESHOLDS) -> DataFrame:
    """``failures`` texts and ``passed`` for a row of metric means."""
    failures = _join_issues(
        [
            F.when(F.col(m) < t, F.concat(F.lit(f"{m} "), F.format_string("%.2f", F.col(m)), F.lit(f" < {t}")))
            for m, t in thresholds.items()
        ]
    )
    return means.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0)


def case_gate(cases: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Issues per case from faithfulness, hallucination and relevancy scores."""

    def text(prefix: str, score: str, suffix: str = "") -> Column:
        return F.concat(F.lit(prefix), F.format_string("%.2f", F.col(score)), F.lit(suffix))

    issues = _join_issues(
        [
            F.when(F.col("faithfulness") < threshold, text("Low faithfulness: ", "faithfulness", f" < {threshold}")),
            F.when(F.col("hallucination") > 0.5, text("Hallucination detected: ", "hallucination")),
            F.when(F.col("relevancy") < 0.7, text("Low relevancy: ", "relevancy")),
        ]
    )
    return cases.withColumn("issues", issues).withColumn("passed", F.size("issues") == 0)


def majority_answer(
    answers: DataFrame, prompt: str, answer: str, order: list[str], threshold: float = 0.7
) -> DataFrame:
    """Most frequent answer per prompt, ties to the first seen; null below the agreement threshold."""
    counted = answers.groupBy(prompt, answer).agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct(*order)).alias("__seen")
    )
    # Count, then earliest: as one maximum, by what share is still unseen.
    totals = counted.groupBy(F.col(prompt).alias("__p")).agg(F.sum("__n").alias("__all"))
    top = first_n(counted, [prompt], [F.desc("__n"), F.col("__seen")], 1)
    agreement = F.col("__n") / F.col("__all")
    return top.join(totals, F.col(prompt).eqNullSafe(F.col("__p"))).select(
        prompt,
        F.when(agreement >= threshold, F.col(answer)).alias("majority"),
        agreement.alias("agreement"),
    )


def label_entropy(rows: DataFrame, group: str, label: str) -> DataFrame:
    """Entropy of the label shares per group: -sum p ln(p + 1e-10). Labels are counted before groups meet."""
    counts = rows.groupBy(group, label).agg(F.count(F.lit(1)).alias("__n"))
    totals = counts.groupBy(F.col(group).alias("__g")).agg(F.sum("__n").alias("__all"))
    p = F.col("__n") / F.col("__all")
    return (
        counts.join(totals, F.col(group).eqNullSafe(F.col("__g")))
        .groupBy(group)
        .agg((-F.sum(p * F.log(p + 1e-10))).alias("entropy"))
    )


def grounding_score(claims: DataFrame, answer: str, supported: str) -> DataFrame:
    """1 - unsupported / claims per answer; grounded when nothing is unsupported."""
    unsupported, n = F.count_if(~F.col(supported)), F.count(supported)
    score = F.coalesce(1 - F.try_divide(unsupported, n), F.lit(1.0))
    return claims.groupBy(answer).agg(
        n.alias("claims"), score.alias("grounding"), (unsupported == 0).alias("is_grounded")
    )


def faithfulness_violation(score: Column, threshold: float = 0.7) -> Column:
    return F.when(
        score < threshold,
        F.concat(F.lit("Faithfulness score "), F.format_string("%.2f", score), F.lit(f" below threshold {threshold:.2f}")),
    )


RUBRIC_SCHEMA = "scores array<struct<criterion: string, score: double>>, winner string"


def rubric_mean(judgement: Column) -> Column:
    """Mean of the rubric scores in a JSON judgement, 0.0 when there are none."""
    scores = F.transform(F.from_json(judgement, RUBRIC_SCHEMA)["scores"], lambda s: s["score"])
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.try_divide(total, F.nullif(F.size(scores), F.lit(0))), F.lit(0.0))


def win_rates(judgements: DataFrame, judgement: str) -> DataFrame:
    winners = judgements.select(F.from_json(judgement, RUBRIC_SCHEMA)["winner"].alias("winner"))
    everything = winners.agg(F.count("winner")).scalar()
    return winners.groupBy("winner").agg(F.count(F.lit(1)).alias("wins")).withColumn(
        "win_rate", F.round(F.try_divide(F.col("wins"), everything), 6)
    )


def vote_verdict(votes: list[Column], literal_threshold: float | None = None) -> tuple[Column, Column]:
    """(verified, confidence) of boolean signals: two thirds must agree, or the literal share given."""
    yes = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(False)).cast("int") for v in votes])
    confidence = yes / len(votes)
    if literal_threshold is not None:
        return confidence >= literal_threshold, confidence
    return yes * 3 >= 2 * len(votes), confidence


def first_passing_attempt(
    attempts: DataFrame, query: str, attempt: str, score: str, threshold: float = 0.7, max_retries: int = 2
) -> DataFrame:
    """First attempt within 1 + max_retries that passes, else the last one, failed. One partial aggregate."""
    tried = attempts.where(F.col(attempt) <= 1 + max_retries)
    passing = F.when(F.col(score) >= threshold, F.col(attempt))
    return tried.groupBy(query).agg(
        F.min(passing).isNotNull().alias("passed"),
        F.coalesce(F.min(passing), F.max(attempt)).alias("attempt"),
        F.coalesce(F.min_by(score, passing), F.max_by(score, attempt)).alias("score"),
    )
