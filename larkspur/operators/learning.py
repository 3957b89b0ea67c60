"""Training, batch scoring and routing with pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut_lineage, work_path

# System prompt by intent, and the one for any other intent.
INTENT_PROMPTS = {
    "refund": "You are a billing support agent. Be empathetic but strict about policy.",
    "technical_support": "You are a technical engineer. Provide step-by-step troubleshooting.",
    "sales": "You are a sales representative. Focus on benefits and closing the deal.",
}
DEFAULT_PROMPT = "You are a helpful assistant."

# Intents answered from a template, and the confidence limits.
TEMPLATE_INTENTS = ("billing", "general")
TEMPLATE_CONFIDENCE = 0.8
MODEL_BELOW = 0.7


def prompt_for(intent: Column) -> Column:
    prompt = F.lit(DEFAULT_PROMPT)
    for name, text in INTENT_PROMPTS.items():
        prompt = F.when(intent == name, F.lit(text)).otherwise(prompt)
    return prompt


def route(intent: Column, confidence: Column) -> Column:
    """template, llm or escalate for an intent and its confidence."""
    return (
        F.when(intent.isin(*TEMPLATE_INTENTS) & (confidence >= TEMPLATE_CONFIDENCE), "template")
        .when((intent == "technical") | (confidence < MODEL_BELOW), "llm")
        .when(intent == "escalate", "escalate")
        .otherwise("llm")
    )


def train_intents(df: DataFrame, text: str, label: str, vocabulary: int | None = None) -> PipelineModel:
    """TF-IDF over the words, then multinomial naive Bayes; label names come from the data.

    ``vocabulary`` keeps that many of the most frequent words; without it all words count.
    The split texts are read by three fits, so they are kept while training.
    """
    index = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc").fit(df)
    splitter = RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"(?U)\W+", minTokenLength=2)
    words = splitter.transform(index.transform(df.select(text, label))).select("__y", "__words").persist()
    counter = CountVectorizer(inputCol="__words", outputCol="__counts", vocabSize=vocabulary or (1 << 31) - 1).fit(words)
    counts = counter.transform(words)
    weight = IDF(inputCol="__counts", outputCol="__features").fit(counts)
    bayes = NaiveBayes(featuresCol="__features", labelCol="__y", probabilityCol="__p", predictionCol="__z")
    model = bayes.fit(weight.transform(counts))
    words.unpersist()
    names = IndexToString(inputCol="__z", outputCol="intent", labels=index.labels)
    return PipelineModel(stages=[splitter, counter, weight, model, names])


def classify_intents(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``intent`` and ``confidence`` (highest class probability)."""
    best = F.array_max(vector_to_array("__p"))
    return model.transform(df).withColumn("confidence", best).select(*df.columns, "intent", "confidence")


def score_batch(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Predictions of a saved pipeline as text labels."""
    return model.transform(df).select(*keep, F.col("prediction").cast("string").alias("label"))


def score_external(df: DataFrame, features: list[str], load: Callable[[], Callable], out: str = "label") -> DataFrame:
    """Score with a non-Spark model that ``load()`` builds once per Python worker."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = load()
        for rows in batches:
            yield pd.Series([str(x) for x in predict(rows)])

    return df.withColumn(out, run(F.struct(*features)))


def holdout(df: DataFrame, share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row: the same rows on every pass, whatever the partitioning."""
    held = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(10_000)) < int(share * 10_000)
    return df.where(~held), df.where(held)


def classification_scores(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted F1 as (metric, value) rows from the counts of (label, prediction)."""
    pairs = scored.groupBy(F.col(label).alias("y"), F.col(prediction).alias("z")).agg(F.count(F.lit(1)).alias("n"))
    actual = pairs.groupBy("y").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("y") == F.col("z"), F.col("n")).otherwise(0)).alias("right"))
    guessed = pairs.groupBy(F.col("z").alias("g")).agg(F.sum("n").alias("predicted"))
    per_class = actual.join(guessed, F.col("y") == F.col("g"), "left").withColumn(
        "f1", 2 * F.col("right") / (F.col("support") + F.coalesce("predicted", F.lit(0)))
    )
    totals = per_class.agg(
        F.try_divide(F.sum("right"), F.sum("support")).alias("accuracy"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"),
    )
    return totals.select(F.expr("stack(2, 'accuracy', accuracy, 'f1', f1) as (metric, value)"))


def train_eval(df: DataFrame, features: list[str], label: str, seed: int = 42, trees: int = 20) -> tuple[DataFrame, PipelineModel]:
    """80/20 split, random forest, accuracy and F1 plus feature importance as (metric, value) rows."""
    train, test = holdout(df, 0.2, seed)
    assemble = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed)
    # Scored with the model as saved: it carries no training state into the tasks.
    path = work_path(df.sparkSession, "forest")
    Pipeline(stages=[assemble, forest]).fit(train).write().save(path)
    model = PipelineModel.load(path)
    scored = cut_lineage(model.transform(test).select(label, "prediction"), "scored")
    weights = model.stages[-1].featureImportances
    importance = df.sparkSession.createDataFrame(
        [(f"importance:{name}", float(weights[i])) for i, name in enumerate(features)], "metric string, value double"
    )
    return classification_scores(scored, label).unionByName(importance), model


def cross_validate(df: DataFrame, features: list[str], label: str, depths=(3, 5), folds: int = 3, seed: int = 42):
    """The best forest over tree depths by cross-validated F1, and the mean F1 per depth."""
    assemble = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=10, seed=seed)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).build()
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    search = CrossValidator(estimator=forest, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=seed)
    fitted = search.fit(assemble.transform(df))
    return fitted.bestModel, dict(zip(depths, fitted.avgMetrics))
