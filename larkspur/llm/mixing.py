"""Mixing sources to target weights by Poisson replication.

Source s with target weight w_s should fill the share w_s of the mix, so each of its documents is
repeated rate_s = w_s * size / size_s times on average. How often one document is repeated is drawn
from a Poisson distribution with that mean, by inverting its distribution function at a number in
[0, 1) that is hashed from the seed and the document id: repeated runs, lost executors and any
partitioning give the same mix. Copies then move to a place that is hashed from seed, id and copy.

Native column functions only. Texts are moved once, by the final shuffle: the table of rates, one row per
source, is written, its size is checked, and up to ``SENT_STEPS`` numbers it is sent to the texts. A larger
one is joined by shuffle, where adaptive execution splits a hot source: another plan, the same rows.

* null source: a source of its own. Null text: size 0, yet replicated at its source's rate.
* a source whose texts are all empty has no size to reach; its rate is 1.
* null doc_id: hashed as the empty id. Repeated rows get the same number of copies, each on its own.
* sources without a given weight, or with weight 0 or null, are left out. An empty table gives an empty mix.
* a column of the input that is called like a new one makes the new one end in ``_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import fresh
from larkspur.session import cut_lineage

#: Most numbers (8 bytes each) in the table of rates for it to be sent to every executor.
SENT_STEPS = 1 << 20
#: Copies of a document that are listed at once.
BLOCK = 4096


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / float(1 << 52)


def _log_mass(k: Column, rate: Column) -> Column:
    """Logarithm of the Poisson probability of k: by the factorial up to 20, beyond by Stirling's series around the mean."""
    x = k.cast("double")
    small = x * F.log(rate) - rate - F.log(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double"))
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3.0))) + 1 / (1260 * F.pow(x, F.lit(5.0))) - 1 / (1680 * F.pow(x, F.lit(7.0)))
    large = -(x * F.log(x / rate) + rate - x) - 0.5 * F.log(2 * math.pi * x) - series
    return F.when(k <= 20, small).otherwise(large)


def poisson_steps(rates: DataFrame) -> DataFrame:
    """source, first, steps: the distribution function at first, first + 1, ... as far as 52 bits tell it from 0 and from 1.

    ``rates`` has a source (once) and its rate. A source's steps, about 20 times the square root of its rate, are
    summed by a window; nothing is copied from step to step.
    """
    reach = 10 * F.sqrt("rate") + 20
    low = F.floor(F.col("rate") - reach)
    first = F.when(low > 20, low).otherwise(F.lit(0)).cast("long")
    known = rates.select("source", "rate", first.alias("first"), F.explode(F.sequence(first, F.ceil(F.col("rate") + reach).cast("long"))).alias("k"))
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    summed = known.select("source", "first", "k", F.sum(F.exp(_log_mass(F.col("k"), F.col("rate")))).over(upto).alias("step"))
    pairs = F.array_sort(F.collect_list(F.struct("k", "step")))
    return summed.groupBy("source", "first").agg(F.transform(pairs, lambda p: p["step"]).alias("steps"))


def _steps_upto(steps: Column, u: Column) -> Column:
    """How many of the rising steps are at most u, by halving; u is computed once."""
    rounds = F.ceil(F.log2(F.size(steps) + F.lit(1.0))).cast("int")

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
        inside = (a["low"] < a["high"]) & (F.get(steps, middle) <= a["u"])
        return F.struct(
            F.when(inside, middle + 1).otherwise(a["low"]).alias("low"),
            F.when(inside | (a["low"] >= a["high"]), a["high"]).otherwise(middle).alias("high"),
            a["u"].alias("u"),
        )

    start = F.struct(F.lit(0).alias("low"), F.size(steps).alias("high"), u.alias("u"))
    return F.aggregate(F.sequence(F.lit(1), rounds), start, halve)["low"]


def source_rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """source, size (characters), weight and mean repetition rate.

    ``weights`` (source, weight) are the targets, in any unit; without them a source weighs its size to
    the power ``temperature``. The mix is ``epochs`` times as large as the input.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("given")).agg(F.max("weight").cast("double").alias("weight")).where("weight > 0")
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("given"))).drop("given")
    totals = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight"))
    share = F.col("weight") / totals.select("weight").scalar()
    rate = F.when((F.col("size") > 0) & share.isNotNull(), share * totals.select("size").scalar() * epochs / F.col("size"))
    return weighed.select("source", "size", "weight", F.coalesce(rate, F.lit(1.0)).alias("rate"))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, epochs: float = 1.0, seed: str = "mix"
) -> DataFrame:
    """Every copy of every document with all its columns, ``copy`` (1, 2, ...) and its hashed place ``mix_key``, shuffled globally."""
    source, first, steps, times = (fresh(docs, n) for n in ("_rate_source", "_rate_first", "_rate_steps", "_times"))
    copy, key, block = fresh(docs, "copy"), fresh(docs, "mix_key"), fresh(docs, "_block")
    rates = poisson_steps(source_rates(docs, weights, temperature, epochs))
    rates = cut_lineage(rates.select(F.col("source").alias(source), F.col("first").alias(first), F.col("steps").alias(steps)), "mixing-rates")
    if (rates.agg(F.sum(F.size(steps)).alias("n")).first()["n"] or 0) <= SENT_STEPS:
        rates = F.broadcast(rates)
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    drawn = docs.join(rates, F.col("source").eqNullSafe(F.col(source))).withColumn(
        times, F.col(first) + _steps_upto(F.col(steps), _uniform(F.lit(seed), doc_id))
    )
    # Copies in blocks, so that no row's list of copies is long.
    blocks = drawn.where(F.col(times) > 0).withColumn(block, F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / BLOCK))))
    numbers = F.sequence(F.col(block) * BLOCK + 1, F.least(F.col(times), (F.col(block) + 1) * BLOCK))
    copies = blocks.withColumn(copy, F.explode(numbers.cast("array<int>")))
    placed = copies.withColumn(key, F.md5(F.concat_ws(":", F.lit(seed), doc_id, F.col(copy).cast("string"))))
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], copy, key).repartition(F.col(key)).sortWithinPartitions(key)
