"""Usage, cost, latency and rate-limit analytics over call logs.

Money is summed as DECIMAL, so totals do not depend on task order, and rounded to
six digits at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.ordered import exact_quantile, numbered

# Prices in USD per 1 000 tokens (input, output).
MODEL_PRICING = {
    "gpt-4-turbo": (0.01, 0.03),
    "gpt-3.5-turbo": (0.0005, 0.0015),
    "claude-3-opus": (0.015, 0.075),
    "claude-3-sonnet": (0.003, 0.015),
    "claude-3-haiku": (0.00025, 0.00125),
}

# Requests per minute by tier.
TIER_RPM = {"free": 10, "pro": 60, "enterprise": 300}

# Latency histogram bounds in seconds.
LATENCY_BOUNDS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0)

USAGE_KEYS = {"model": "model", "use_case": "use_case", "day": "day"}


def money(amount: Column) -> Column:
    return amount.cast("decimal(18,6)")


def usd(total: Column) -> Column:
    return F.round(F.coalesce(total.cast("double"), F.lit(0.0)), 6)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def within_days(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """Rows with ``ts >= as_of - days``; the bound itself is included."""
    return df.where(F.col(ts) >= as_of - F.make_dt_interval(F.lit(days)))


def newest(df: DataFrame, ts: str) -> Column:
    """Scalar subquery for the log's newest timestamp: the repeatable 'now'."""
    return df.agg(F.max(ts)).scalar()


def summary(usage: DataFrame, group_by: str, as_of: Column, days: int = 30) -> DataFrame:
    """Cost, tokens and calls by model, use case or day; unknown groupings mean model."""
    key = USAGE_KEYS.get(group_by, "model")
    rows = within_days(usage, "ts", as_of, days).withColumn("day", day_text(F.col("ts")))
    return (
        rows.groupBy(F.col(key).alias("group_key"))
        .agg(
            usd(F.sum("cost_usd")).alias("total_cost"),
            F.sum("total_tokens").alias("total_tokens"),
            F.count(F.lit(1)).alias("calls"),
        )
        .orderBy("group_key")
    )


def total_cost(usage: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return within_days(usage, "ts", as_of, days).agg(usd(F.sum("cost_usd")).alias("total_cost"))


def cost_report(usage: DataFrame, group_by: str, as_of: Column, days: int = 30) -> DataFrame:
    """Breakdown rows plus one total row, from a single pass (grand total of the groups)."""
    key = USAGE_KEYS.get(group_by, "model")
    rows = within_days(usage, "ts", as_of, days).withColumn("day", day_text(F.col("ts")))
    return rows.withColumn("group_key", F.col(key)).rollup("group_key").agg(
        F.when(F.grouping("group_key") == 1, "total").otherwise("group").alias("row_type"),
        usd(F.sum("cost_usd")).alias("total_cost"),
        F.count(F.lit(1)).alias("calls"),
    )


def daily_costs(usage: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        within_days(usage, "ts", as_of, days)
        .groupBy(day_text(F.col("ts")).alias("day"))
        .agg(
            usd(F.sum("cost_usd")).alias("total_cost"),
            F.count(F.lit(1)).alias("total_requests"),
            F.sum("total_tokens").alias("total_tokens"),
        )
        .orderBy("day")
    )


def cost_anomalies(daily: DataFrame, threshold: float = 2.0, min_days: int = 7) -> DataFrame:
    """Days whose cost exceeds mean x threshold; needs ``min_days`` days. Input: one row per day."""
    everything = Window.partitionBy()
    return (
        daily.select(
            "day",
            F.col("total_cost").alias("cost"),
            F.avg("total_cost").over(everything).alias("mean"),
            F.count(F.lit(1)).over(everything).alias("n"),
        )
        .where((F.col("n") >= min_days) & (F.col("cost") > F.col("mean") * threshold))
        .select(
            "day",
            "cost",
            F.round("mean", 4).alias("expected_cost"),
            F.round((F.col("cost") - F.col("mean")) / F.col("mean") * 100, 4).alias("deviation_pct"),
        )
    )


def model_cost_anomalies(summary_rows: DataFrame, std_threshold: float = 2.0) -> DataFrame:
    """Per-model rows above mean + threshold x sample deviation.

    The statistics are a partial aggregate joined back, so no model's rows meet in one task.
    """
    stats = summary_rows.groupBy(F.col("model").alias("stat_model")).agg(
        F.avg("total_cost").alias("mean"), F.stddev_samp("total_cost").alias("std")
    )
    return (
        summary_rows.join(stats, F.col("model").eqNullSafe(F.col("stat_model")))
        .where(F.col("total_cost") > F.col("mean") + std_threshold * F.col("std"))
        .drop("stat_model")
    )


def with_quantile(grouped: DataFrame, source: DataFrame, keys: list[str], value: str, q: float, out: str, method="cont"):
    """Attach an exact quantile to an aggregate with the same keys."""
    quantiles = exact_quantile(source, keys, value, q, out, method)
    if not keys:
        # One row on each side: a scalar subquery, not a join.
        return grouped.withColumn(out, quantiles.select(out).scalar())
    quantiles = quantiles.select(*[F.col(k).alias(f"q_{k}") for k in keys], out)
    on = [F.col(k).eqNullSafe(F.col(f"q_{k}")) for k in keys]
    return grouped.join(quantiles, on, "left").drop(*[f"q_{k}" for k in keys])


def price_usage(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost of each call from per-1K prices; a model without a price has ``priced = false`` and null cost.

    ``prices`` is one row per model. It is not hinted: the planner broadcasts it
    when its measured size allows.
    """
    rates = prices.select(F.col("model").alias("price_model"), "input_per_1k", "output_per_1k")
    joined = calls.join(rates, F.col("model") == F.col("price_model"), "left")
    cost = (
        F.col("prompt_tokens") * F.col("input_per_1k") / 1000
        + F.col("completion_tokens") * F.col("output_per_1k") / 1000
    )
    return joined.withColumn("priced", F.col("price_model").isNotNull()).withColumn("cost_usd", money(cost)).drop(
        "price_model", "input_per_1k", "output_per_1k"
    )


def blended_cost(tokens: Column, input_rate: Column, output_rate: Column, per: int = 1000) -> Column:
    """Cost of a token total split half input, half output."""
    half = tokens / 2
    return half * input_rate / per + half * output_rate / per


def latency_buckets(df: DataFrame, keys: list[str], seconds: Column, bounds=LATENCY_BOUNDS) -> DataFrame:
    """Cumulative (``le``) histogram rows per key from one aggregate over the log.

    Each bound is one counter in the aggregate buffer, so the result needs no window.
    """
    counters = [F.count_if(seconds <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(*keys).agg(*counters, F.count(seconds).alias("b_inf"))
    pairs = ", ".join(f"'{float(b)}', b{i}" for i, b in enumerate(bounds))
    return wide.select(*keys, F.expr(f"stack({len(bounds) + 1}, {pairs}, '+Inf', b_inf) as (le, n)"))


def requests_in_last_minute(log: DataFrame, client: str, ts: str, event_id: str) -> DataFrame:
    """For each request, how many the client made in the 60 s up to and including it.

    A row is placed in its own minute and, as context, in the next one. A window
    then spans two minutes of a client at most, however busy the client is.
    """
    minute = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(60_000_000)).cast("bigint")
    tagged = log.withColumn("__m", minute).withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    placed = tagged.withColumn("__slot", F.explode(F.array(F.col("__m"), F.col("__m") + 1)))
    span = Window.partitionBy(client, "__slot").orderBy("__us").rangeBetween(-59_999_999, 0)
    return (
        placed.withColumn("requests_60s", F.count(F.lit(1)).over(span))
        .where(F.col("__slot") == F.col("__m"))
        .drop("__m", "__us", "__slot")
    )


def minute_positions(log: DataFrame, tenant: str, ts: str, event_id: str) -> DataFrame:
    """Position of a request in its tenant's clock minute, counted by second buckets."""
    minute = F.date_trunc("minute", F.col(ts).cast("timestamp"))
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    return numbered(
        log.withColumn("minute", minute), [tenant, "minute"], [F.col(ts), F.col(event_id)], second, "position"
    )


def daily_budget(log: DataFrame, tenant: str, day: str, order: list[str], tokens: str, limit: int) -> DataFrame:
    """Requests admitted under a daily token budget; a request that does not fit uses nothing.

    What is left never grows, so of equal-sized requests the admitted ones come
    first: at most ``limit // size`` per size. Cutting every (tenant, day, size)
    to that many candidates is exact and leaves at most limit x (1 + ln limit)
    rows of a tenant's day for the sequential step.
    """
    from larkspur.operators.ordered import first_n

    sized = log.where(F.col(tokens).between(1, limit))
    ranked = first_n(sized, [tenant, day, tokens], [F.col(c) for c in order], limit, rank="__r")
    candidates = ranked.where(F.col("__r") * F.col(tokens) <= limit).drop("__r")

    def admit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left = None, limit
        for batch in batches:
            kept = []
            for key in zip(*[batch[c].to_pylist() for c in (tenant, day, tokens)]):
                if key[:2] != now:
                    now, left = key[:2], limit
                fits = key[2] <= left
                left -= key[2] if fits else 0
                kept.append(fits)
            yield batch.filter(pa.array(kept, pa.bool_()))

    # Rows of a tenant's day follow one another in a task; only what is left of the budget is held.
    sorted_ = candidates.repartition(tenant, day).sortWithinPartitions(tenant, day, *order)
    admitted = sorted_.mapInArrow(admit, candidates.schema)
    # Requests of no or unknown size use nothing and always fit.
    return admitted.unionByName(log.where(F.coalesce(F.col(tokens), F.lit(0)) <= 0))


def json_number(col: str, path: str, kind: str = "bigint") -> Column:
    return F.get_json_object(F.col(col), path).try_cast(kind)


def over_share(rows: DataFrame, used: Column, limit: Column, pct: float) -> DataFrame:
    """Rows whose use is above a share of its limit, with ``used_pct``. Serves budgets and rate limits."""
    return rows.withColumn("used_pct", F.round(used * 100.0 / limit, 6)).where(F.col("used_pct") > pct)


def budget_alerts(costs: DataFrame, keys: list[str], cost: str, limit: float, pct: float = 90.0) -> DataFrame:
    """Keys whose summed cost is above ``pct`` percent of the budget."""
    spent = costs.groupBy(*keys).agg(usd(F.sum(money(F.col(cost)))).alias("spent"))
    return over_share(spent, F.col("spent"), F.lit(limit), pct)


def step_alerts(steps: DataFrame, task: list[str], limit: int = 50) -> DataFrame:
    """Tasks with more steps than the limit."""
    return steps.groupBy(*task).agg(F.count(F.lit(1)).alias("steps")).where(F.col("steps") > limit)


def rate_limit_alerts(log: DataFrame, client: str, ts: str, per_minute: int, pct: float = 80.0) -> DataFrame:
    """Clients and clock minutes with more than ``pct`` percent of the allowed requests."""
    minute = F.date_trunc("minute", F.col(ts).cast("timestamp")).alias("minute")
    counts = log.groupBy(client, minute).agg(F.count(F.lit(1)).alias("requests"))
    return over_share(counts, F.col("requests"), F.lit(per_minute), pct)


def five_minute_alerts(log: DataFrame, error_pct: float = 5.0, p95_limit: float = 10.0) -> DataFrame:
    """Five-minute windows whose error rate or p95 latency is over its limit.

    Input columns: ts, is_error, latency. p95 is the nearest-rank value.
    """
    windowed = log.withColumn("slot", F.window(F.col("ts").cast("timestamp"), "5 minutes").start)
    rates = windowed.groupBy("slot").agg(
        F.count(F.lit(1)).alias("requests"),
        (F.count_if("is_error") * 100.0 / F.count(F.lit(1))).alias("error_pct"),
    )
    both = with_quantile(rates, windowed, ["slot"], "latency", 0.95, "p95_latency", "nearest")
    return both.withColumn("error_alert", F.col("error_pct") > error_pct).withColumn(
        "latency_alert", F.col("p95_latency") > p95_limit
    )
