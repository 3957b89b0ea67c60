"""Usage, cost, audit and paging queries over ``events``.

An event is read as one call: model, tool or action = ``event_type``; client,
tenant or agent = ``user_id``; cost and latency = ``value``; tokens = ``props.k``.
"""

from pyspark.sql import functions as F

from larkspur.operators import governance, ordered, usage
from larkspur.plans.registry import Tables, query
from larkspur.session import work_path


def calls(t: Tables):
    return t.events.select(
        "event_id",
        "ts",
        F.col("event_type").alias("model"),
        F.col("user_id").cast("string").alias("use_case"),
        usage.json_number("props", "$.k").alias("total_tokens"),
        usage.money(F.col("value")).alias("cost_usd"),
        F.col("value").alias("latency"),
        (F.col("event_type") == "error").alias("is_error"),
    )


# The same mapping for the SQL statements.
CALLS = """WITH calls AS (
  SELECT event_id, ts, event_type AS model, CAST(user_id AS VARCHAR) AS use_case,
         CAST(json_extract(props, '$.k') AS BIGINT) AS total_tokens,
         CAST(value AS DECIMAL(18,6)) AS cost_usd, value AS latency,
         event_type = 'error' AS is_error, strftime(ts, '%Y-%m-%d') AS day
  FROM events),
now_at AS (SELECT max(ts) AS as_of FROM events)"""


def _summary_sql(key: str, days: int) -> str:
    return f"""{CALLS} SELECT {key} AS group_key, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens, count(*) AS calls
  FROM calls, now_at WHERE ts >= as_of - INTERVAL {days} DAY GROUP BY 1"""


@query("usage_by_model", _summary_sql("model", 7))
def usage_by_model(t):
    return usage.summary(calls(t), "model", usage.newest(t.events, "ts"), days=7)


@query("usage_by_day", _summary_sql("day", 30))
def usage_by_day(t):
    return usage.summary(calls(t), "day", usage.newest(t.events, "ts"), days=30)


@query("usage_by_use_case", _summary_sql("use_case", 14))
def usage_by_use_case(t):
    return usage.summary(calls(t), "use_case", usage.newest(t.events, "ts"), days=14)


@query(
    "usage_total",
    f"""{CALLS} SELECT round(CAST(coalesce(sum(cost_usd), 0) AS DOUBLE), 6) AS total_cost
    FROM calls, now_at WHERE ts >= as_of - INTERVAL 7 DAY""",
)
def usage_total(t):
    return usage.total_cost(calls(t), usage.newest(t.events, "ts"), days=7)


@query(
    "usage_report",
    f"""{CALLS}, recent AS (SELECT * FROM calls, now_at WHERE ts >= as_of - INTERVAL 30 DAY)
    SELECT model AS group_key, 'group' AS row_type, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost,
      count(*) AS calls FROM recent GROUP BY 1
    UNION ALL SELECT NULL, 'total', round(CAST(sum(cost_usd) AS DOUBLE), 6), count(*) FROM recent""",
)
def usage_report(t):
    return usage.cost_report(calls(t), "model", usage.newest(t.events, "ts"))


DAILY = f"""{CALLS}, daily AS (SELECT day, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost,
  count(*) AS total_requests, CAST(sum(total_tokens) AS BIGINT) AS total_tokens
  FROM calls, now_at WHERE ts >= as_of - INTERVAL 30 DAY GROUP BY 1)"""


@query("daily_costs", f"{DAILY} SELECT * FROM daily")
def daily_costs(t):
    return usage.daily_costs(calls(t), usage.newest(t.events, "ts"))


@query(
    "cost_anomalies",
    f"""{DAILY} SELECT day, total_cost AS cost, round(mean, 4) AS expected_cost,
      round((total_cost - mean) / mean * 100, 4) AS deviation_pct
    FROM (SELECT *, avg(total_cost) OVER () AS mean, count(*) OVER () AS n FROM daily)
    WHERE n >= 7 AND total_cost > mean * 1.05""",
)
def cost_anomalies(t):
    return usage.cost_anomalies(usage.daily_costs(calls(t), usage.newest(t.events, "ts")), threshold=1.05)


@query(
    "tool_stats",
    """SELECT count(*) AS total_calls, count(*) FILTER (WHERE event_type = 'error') AS total_errors,
      count(DISTINCT event_type) AS unique_tools FROM events""",
)
def tool_stats(t):
    return t.events.agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.count_if(F.col("event_type") == "error").alias("total_errors"),
        F.count_distinct("event_type").alias("unique_tools"),
    )


@query(
    "service_metrics",
    f"""{CALLS} SELECT count(*) AS requests, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
      round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost,
      round(CAST(sum(cost_usd) AS DOUBLE) / count(*), 4) AS avg_latency,
      count(*) FILTER (WHERE is_error) AS errors FROM calls""",
)
def service_metrics(t):
    return calls(t).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("total_tokens").alias("total_tokens"),
        usage.usd(F.sum("cost_usd")).alias("total_cost"),
        F.round(F.sum("cost_usd").cast("double") / F.count(F.lit(1)), 4).alias("avg_latency"),
        F.count_if("is_error").alias("errors"),
    )


@query(
    "bucket_histogram",
    """SELECT event_type AS model, le, n FROM (
      SELECT event_type, b AS bound, CAST(b AS VARCHAR) AS le, count(*) FILTER (WHERE value <= b) AS n
      FROM events, (SELECT unnest([0.1::DOUBLE, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0]) AS b) GROUP BY 1, 2, 3
      UNION ALL SELECT event_type, NULL, '+Inf', count(value) FROM events GROUP BY 1)""",
)
def bucket_histogram(t):
    return usage.latency_buckets(calls(t), ["model"], F.col("latency"))


@query(
    "latency_histogram",
    """SELECT event_type AS model, strftime(ts, '%Y-%m-%d') AS day,
      CAST(least(floor(value / 25) + 1, 21) AS BIGINT) AS bin, count(*) AS requests
      FROM events GROUP BY 1, 2, 3""",
)
def latency_histogram(t):
    bins = F.width_bucket("latency", F.lit(0.0), F.lit(500.0), F.lit(20))
    return (
        calls(t)
        .groupBy("model", usage.day_text(F.col("ts")).alias("day"), bins.alias("bin"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )


@query(
    "usage_analysis",
    f"""{CALLS} SELECT model, count(*) AS requests, round(avg(latency), 4) AS avg_latency,
      round(quantile_cont(latency, 0.95), 4) AS p95_latency,
      round(avg(CASE WHEN is_error THEN 1.0 ELSE 0.0 END), 6) AS error_rate,
      CAST(sum(total_tokens) AS BIGINT) AS total_tokens, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost
      FROM calls GROUP BY 1""",
)
def usage_analysis(t):
    c = calls(t)
    grouped = c.groupBy("model").agg(
        F.count(F.lit(1)).alias("requests"),
        F.round(F.avg("latency"), 4).alias("avg_latency"),
        F.round(F.avg(F.when(F.col("is_error"), 1.0).otherwise(0.0)), 6).alias("error_rate"),
        F.sum("total_tokens").alias("total_tokens"),
        usage.usd(F.sum("cost_usd")).alias("total_cost"),
    )
    return usage.with_quantile(grouped, c, ["model"], "latency", 0.95, "p95_latency").withColumn(
        "p95_latency", F.round("p95_latency", 4)
    )


@query(
    "daily_metrics_view",
    f"""{CALLS} SELECT day, model, count(*) AS total_requests, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
      round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost, round(avg(latency), 4) AS avg_latency,
      round(quantile_cont(latency, 0.95), 4) AS p95_latency,
      round(count(*) FILTER (WHERE is_error) * 100.0 / count(*), 4) AS error_rate
      FROM calls GROUP BY 1, 2""",
)
def daily_metrics_view(t):
    c = calls(t).withColumn("day", usage.day_text(F.col("ts")))
    grouped = c.groupBy("day", "model").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.sum("total_tokens").alias("total_tokens"),
        usage.usd(F.sum("cost_usd")).alias("total_cost"),
        F.round(F.avg("latency"), 4).alias("avg_latency"),
        F.round(F.count_if("is_error") * F.lit(100.0) / F.count(F.lit(1)), 4).alias("error_rate"),
    )
    return usage.with_quantile(grouped, c, ["day", "model"], "latency", 0.95, "p95_latency").withColumn(
        "p95_latency", F.round("p95_latency", 4)
    )


@query(
    "daily_cost_summary",
    f"""{CALLS} SELECT day, model, use_case, count(*) AS calls,
      round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost,
      round(CAST(sum(cost_usd) AS DOUBLE) / count(*), 4) AS mean_cost,
      round(quantile_cont(latency, 0.95), 4) AS p95_latency FROM calls GROUP BY 1, 2, 3""",
)
def daily_cost_summary(t):
    c = calls(t).withColumn("day", usage.day_text(F.col("ts")))
    keys = ["day", "model", "use_case"]
    grouped = c.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"),
        usage.usd(F.sum("cost_usd")).alias("total_cost"),
        F.round(F.sum("cost_usd").cast("double") / F.count(F.lit(1)), 4).alias("mean_cost"),
    )
    return usage.with_quantile(grouped, c, keys, "latency", 0.95, "p95_latency").withColumn(
        "p95_latency", F.round("p95_latency", 4)
    )


@query(
    "aggregate_costs",
    f"""{CALLS} SELECT model, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost,
      round(CAST(sum(cost_usd) AS DOUBLE) / count(*), 4) AS mean_cost, round(avg(latency), 4) AS mean_latency
      FROM calls GROUP BY 1""",
)
def aggregate_costs(t):
    return calls(t).groupBy("model").agg(
        usage.usd(F.sum("cost_usd")).alias("total_cost"),
        F.round(F.sum("cost_usd").cast("double") / F.count(F.lit(1)), 4).alias("mean_cost"),
        F.round(F.avg("latency"), 4).alias("mean_latency"),
    )


@query(
    "top_cost_drivers",
    f"""{CALLS} SELECT use_case, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost, count(*) AS calls,
      round(CAST(sum(cost_usd) AS DOUBLE) / count(*), 4) AS mean_cost
      FROM calls GROUP BY 1 ORDER BY total_cost DESC, use_case LIMIT 10""",
)
def top_cost_drivers(t):
    return (
        calls(t)
        .groupBy("use_case")
        .agg(
            usage.usd(F.sum("cost_usd")).alias("total_cost"),
            F.count(F.lit(1)).alias("calls"),
            F.round(F.sum("cost_usd").cast("double") / F.count(F.lit(1)), 4).alias("mean_cost"),
        )
        .orderBy(F.desc("total_cost"), "use_case")
        .limit(10)
    )


@query(
    "json_agg",
    f"""{CALLS} SELECT model, CAST(sum(total_tokens) AS BIGINT) AS tokens,
      round(avg(total_tokens), 4) AS mean_tokens, max(total_tokens) AS max_tokens FROM calls GROUP BY 1""",
)
def json_agg(t):
    k = usage.json_number("props", "$.k")
    return t.events.groupBy(F.col("event_type").alias("model")).agg(
        F.sum(k).alias("tokens"), F.round(F.avg(k), 4).alias("mean_tokens"), F.max(k).alias("max_tokens")
    )


@query(
    "json_predicates",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
      WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50
        AND list_contains(['purchase', 'signup'], event_type)""",
)
def json_predicates(t):
    k = usage.json_number("props", "$.k")
    tagged = F.array_contains(F.array(F.lit("purchase"), F.lit("signup")), F.col("event_type"))
    return t.events.where((k > 50) & tagged).select("event_id", k.alias("k"))


@query(
    "perf_summary",
    f"""{CALLS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY latency) - 1 AS i,
        count(*) OVER (PARTITION BY model) AS n FROM calls)
      SELECT model, count(*) AS calls, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
        round(avg(latency), 4) AS avg_latency, max(CASE WHEN i = CAST(floor(n * 0.95) AS BIGINT) THEN latency END) AS p95_latency,
        round(avg(CASE WHEN latency > 0 THEN total_tokens / latency END), 4) AS avg_tokens_per_second,
        round(avg(CASE WHEN total_tokens > 0 THEN total_tokens END), 4) AS avg_ttft
      FROM ranked GROUP BY 1""",
)
def perf_summary(t):
    c = calls(t)
    grouped = c.groupBy("model").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("total_tokens").alias("total_tokens"),
        F.round(F.avg("latency"), 4).alias("avg_latency"),
        F.round(F.avg(F.when(F.col("latency") > 0, F.col("total_tokens") / F.col("latency"))), 4).alias(
            "avg_tokens_per_second"
        ),
        F.round(F.avg(F.when(F.col("total_tokens") > 0, F.col("total_tokens"))), 4).alias("avg_ttft"),
    )
    return usage.with_quantile(grouped, c, ["model"], "latency", 0.95, "p95_latency", "index")


@query(
    "agent_cost_report",
    f"""{CALLS} SELECT use_case AS agent, CAST(sum(total_tokens) AS BIGINT) AS tokens,
        round(CAST(sum(cost_usd) AS DOUBLE), 6) AS cost, count(*) AS calls FROM calls GROUP BY 1
      UNION ALL SELECT 'TOTAL', CAST(sum(total_tokens) AS BIGINT), round(CAST(sum(cost_usd) AS DOUBLE), 6), count(*)
      FROM calls""",
)
def agent_cost_report(t):
    total = F.grouping("use_case") == 1
    return (
        calls(t)
        .rollup("use_case")
        .agg(
            F.when(total, "TOTAL").otherwise(F.col("use_case")).alias("agent"),
            F.sum("total_tokens").alias("tokens"),
            usage.usd(F.sum("cost_usd")).alias("cost"),
            F.count(F.lit(1)).alias("calls"),
        )
        .drop("use_case")
    )


@query(
    "budget_usage",
    f"""{CALLS}, budgets AS (SELECT c_custkey AS agent, round(c_acctbal) AS budget FROM customer WHERE round(c_acctbal) > 0)
      SELECT CAST(use_case AS BIGINT) AS agent, used, budget, round(used / budget, 6) AS ratio, used / budget >= 0.8 AS needs_summary
      FROM (SELECT use_case, CAST(sum(total_tokens) AS BIGINT) AS used FROM calls GROUP BY 1)
      JOIN budgets ON CAST(use_case AS BIGINT) = agent""",
)
def budget_usage(t):
    budgets = t.customer.where(F.round("c_acctbal") > 0).select(
        F.col("c_custkey").alias("agent"), F.round("c_acctbal").alias("budget")
    )
    used = t.events.groupBy(F.col("user_id").alias("agent")).agg(
        F.sum(usage.json_number("props", "$.k")).alias("used")
    )
    ratio = F.col("used") / F.col("budget")
    return used.join(budgets, "agent").select(
        "agent", "used", "budget", F.round(ratio, 6).alias("ratio"), (ratio >= 0.8).alias("needs_summary")
    )


@query(
    "tenant_monthly_cost",
    f"""{CALLS} SELECT use_case AS tenant, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS monthly_cost FROM calls, now_at
      WHERE date_trunc('month', ts) = date_trunc('month', as_of) GROUP BY 1""",
)
def tenant_monthly_cost(t):
    now = usage.newest(t.events, "ts")
    return (
        calls(t)
        .where(F.col("ts") >= F.date_trunc("month", now.cast("timestamp")).cast("timestamp_ntz"))
        .where(F.col("ts") <= now)
        .groupBy(F.col("use_case").alias("tenant"))
        .agg(usage.usd(F.sum("cost_usd")).alias("monthly_cost"))
    )


@query(
    "cost_spike_users",
    f"""{CALLS} SELECT use_case AS user_name, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS cost, count(*) AS calls,
        round(avg(total_tokens), 4) AS mean_prompt_tokens, sum(cost_usd) > 50 AS over_cap
      FROM calls, now_at WHERE ts >= as_of - INTERVAL 1 HOUR GROUP BY 1 ORDER BY cost DESC, user_name LIMIT 10""",
)
def cost_spike_users(t):
    now = usage.newest(t.events, "ts")
    return (
        calls(t)
        .where(F.col("ts") >= now - F.expr("INTERVAL '1' HOUR"))
        .groupBy(F.col("use_case").alias("user_name"))
        .agg(
            usage.usd(F.sum("cost_usd")).alias("cost"),
            F.count(F.lit(1)).alias("calls"),
            F.round(F.avg("total_tokens"), 4).alias("mean_prompt_tokens"),
            (F.sum("cost_usd") > 50).alias("over_cap"),
        )
        .orderBy(F.desc("cost"), "user_name")
        .limit(10)
    )


@query(
    "alerts_5min",
    """WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS slot, value, event_type = 'error' AS is_error FROM events),
      r AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY value) - 1 AS i,
              count(*) OVER (PARTITION BY slot) AS n FROM w)
      SELECT strftime(slot, '%Y-%m-%d %H:%M') AS slot, count(*) AS requests,
        round(count(*) FILTER (WHERE is_error) * 100.0 / count(*), 4) AS error_pct,
        max(CASE WHEN i = floor((n - 1) * 0.95 + 0.5) THEN value END) AS p95_latency,
        count(*) FILTER (WHERE is_error) * 100.0 / count(*) > 5 AS error_alert,
        max(CASE WHEN i = floor((n - 1) * 0.95 + 0.5) THEN value END) > 10 AS latency_alert
      FROM r GROUP BY 1""",
)
def alerts_5min(t):
    return usage.five_minute_alerts(calls(t)).select(
        F.date_format("slot", "yyyy-MM-dd HH:mm").alias("slot"),
        "requests",
        F.round("error_pct", 4).alias("error_pct"),
        "p95_latency",
        "error_alert",
        "latency_alert",
    )


@query(
    "model_cost_anomalies",
    f"""{CALLS}, daily AS (SELECT day, model, round(CAST(sum(cost_usd) AS DOUBLE), 6) AS total_cost FROM calls GROUP BY 1, 2),
      stats AS (SELECT model AS m, avg(total_cost) AS mean, stddev_samp(total_cost) AS std FROM daily GROUP BY 1)
      SELECT day, model, total_cost, round(mean, 4) AS mean, round(std, 4) AS std
      FROM daily JOIN stats ON m = model WHERE total_cost > mean + 1.5 * std""",
)
def model_cost_anomalies(t):
    daily = (
        calls(t)
        .groupBy(usage.day_text(F.col("ts")).alias("day"), "model")
        .agg(usage.usd(F.sum("cost_usd")).alias("total_cost"))
    )
    return usage.model_cost_anomalies(daily, 1.5).select(
        "day", "model", "total_cost", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std")
    )


# Which priced model each kind of event stands for; 'error' has no price on purpose.
EVENT_MODEL = {
    "click": "gpt-4-turbo",
    "view": "gpt-3.5-turbo",
    "purchase": "claude-3-opus",
    "signup": "claude-3-sonnet",
}


def _event_model_sql() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_MODEL.items())
    return f"CASE event_type {whens} ELSE event_type END"


def _price_rows_sql() -> str:
    return ", ".join(f"('{m}', {i}::DOUBLE, {o}::DOUBLE)" for m, (i, o) in usage.MODEL_PRICING.items())


@query(
    "price_usage",
    f"""WITH prices(model, pin, pout) AS (VALUES {_price_rows_sql()}),
      c AS (SELECT event_id, {_event_model_sql()} AS model, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
      SELECT event_id, c.model, prices.model IS NOT NULL AS priced,
        round(k * pin / 1000 + k * pout / 1000, 6) AS cost_usd
      FROM c LEFT JOIN prices ON c.model = prices.model""",
)
def price_usage(t):
    k = usage.json_number("props", "$.k")
    mapping = F.create_map(*[F.lit(x) for pair in EVENT_MODEL.items() for x in pair])
    model = F.coalesce(F.try_element_at(mapping, F.col("event_type")), F.col("event_type"))
    rows = t.events.select("event_id", model.alias("model"), k.alias("prompt_tokens"), k.alias("completion_tokens"))
    prices = t.spark.createDataFrame(
        [(m, float(i), float(o)) for m, (i, o) in usage.MODEL_PRICING.items()],
        "model string, input_per_1k double, output_per_1k double",
    )
    return usage.price_usage(rows, prices).select(
        "event_id", "model", "priced", F.round(F.col("cost_usd").cast("double"), 6).alias("cost_usd")
    )


@query(
    "rate_violations",
    """WITH w AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
          RANGE BETWEEN INTERVAL '59.999999 seconds' PRECEDING AND CURRENT ROW) AS requests_60s FROM events)
      SELECT event_id, user_id, requests_60s, greatest(1 - requests_60s, 0) AS remaining FROM w WHERE requests_60s > 1""",
)
def rate_violations(t):
    rpm = 1
    seen = usage.requests_in_last_minute(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id")
    return seen.where(F.col("requests_60s") > rpm).select(
        "event_id", "user_id", "requests_60s", F.greatest(rpm - F.col("requests_60s"), F.lit(0)).alias("remaining")
    )


@query(
    "tier_limits",
    """WITH w AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
          RANGE BETWEEN INTERVAL '59.999999 seconds' PRECEDING AND CURRENT ROW) AS requests_60s FROM events),
      tiers(tier, rpm) AS (VALUES ('free', 10), ('pro', 60), ('enterprise', 300)),
      users AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'free' WHEN c_acctbal < 5000 THEN 'pro' ELSE 'enterprise' END AS tier
        FROM customer)
      SELECT coalesce(users.tier, 'free') AS tier, count(*) AS requests, count(*) FILTER (WHERE requests_60s > rpm) AS denied,
        min(greatest(rpm - requests_60s, 0)) AS lowest_remaining
      FROM w LEFT JOIN users ON user_id = c_custkey JOIN tiers ON tiers.tier = coalesce(users.tier, 'free') GROUP BY 1""",
)
def tier_limits(t):
    limits = F.create_map(*[F.lit(x) for pair in usage.TIER_RPM.items() for x in pair])
    tier = F.when(F.col("c_acctbal") < 0, "free").when(F.col("c_acctbal") < 5000, "pro").otherwise("enterprise")
    users = t.customer.select(F.col("c_custkey").alias("user_id"), tier.alias("tier"))
    seen = usage.requests_in_last_minute(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id")
    limited = (
        seen.join(users, "user_id", "left")
        .withColumn("tier", F.coalesce("tier", F.lit("free")))
        .withColumn("rpm", limits[F.col("tier")])
    )
    return limited.groupBy("tier").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("requests_60s") > F.col("rpm")).alias("denied"),
        F.min(F.greatest(F.col("rpm") - F.col("requests_60s"), F.lit(0))).alias("lowest_remaining"),
    )


@query(
    "minute_quota",
    """SELECT event_type AS tenant, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute_text, event_id, position
      FROM (SELECT *, row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY ts, event_id) AS position
        FROM events) WHERE position > 1""",
)
def minute_quota(t):
    return (
        usage.minute_positions(t.events.select("event_id", "event_type", "ts"), "event_type", "ts", "event_id")
        .where(F.col("position") > 1)
        .select(
            F.col("event_type").alias("tenant"),
            F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute_text"),
            "event_id",
            "position",
        )
    )


@query(
    "daily_budget",
    """WITH c AS (SELECT event_type AS tenant, strftime(ts, '%Y-%m-%d') AS day, ts, event_id,
        CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
      folded AS (SELECT tenant, day, list_reduce(list(k ORDER BY ts, event_id),
        lambda acc, x: CASE WHEN acc // 1000000 + x <= 900 THEN acc + x * 1000000 + 1 ELSE acc END, 0::BIGINT) AS f
        FROM c GROUP BY 1, 2)
      SELECT tenant, day, f // 1000000 AS used_tokens, f % 1000000 AS admitted FROM folded""",
)
def daily_budget(t):
    rows = t.events.select(
        F.col("event_type").alias("tenant"),
        usage.day_text(F.col("ts")).alias("day"),
        F.col("ts"),
        "event_id",
        usage.json_number("props", "$.k").alias("k"),
    )
    admitted = usage.daily_budget(rows, "tenant", "day", ["ts", "event_id"], "k", 900)
    return admitted.groupBy("tenant", "day").agg(
        F.sum("k").alias("used_tokens"), F.count(F.lit(1)).alias("admitted")
    )


@query(
    "latest_per_key",
    """SELECT user_id, event_type, event_id, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key(t):
    rows = t.events.select("user_id", "event_type", "event_id", "value", "ts")
    return ordered.latest_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "event_replay",
    """WITH v AS (SELECT user_id, event_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM events)
      SELECT user_id, count(*) AS versions, max(version) AS last_version, max_by(event_id, version) AS last_event,
        max(version) - count(*) AS gaps, round(CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE), 6) AS state_value
      FROM v WHERE event_id % 7 <> 3 GROUP BY 1""",
)
def event_replay(t):
    """Versions are numbered over all events; the log then lacks one in seven, so there are gaps to find."""
    versioned = ordered.numbered(
        t.events.select("user_id", "event_id", "ts", "value"),
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60),
        "version",
    )
    state = usage.usd(F.sum(usage.money(F.col("value")))).alias("state_value")
    return governance.replay(versioned.where("event_id % 7 <> 3"), "user_id", "version", "event_id", state)


@query(
    "audit_query",
    """SELECT event_id, event_type AS action, user_id AS actor FROM (
        SELECT * FROM events, (SELECT max(ts) AS as_of FROM events)
        WHERE event_type = 'purchase' AND ts >= as_of - INTERVAL 20 DAY ORDER BY ts DESC, event_id DESC LIMIT 100)""",
)
def audit_query(t):
    log = t.events.select("event_id", F.col("event_type").alias("action"), F.col("user_id").alias("actor"), "ts")
    since = usage.newest(t.events, "ts") - F.make_dt_interval(F.lit(20))
    return governance.audit_query(log, action="purchase", since=since, limit=100).drop("ts")


@query(
    "tool_log_query",
    """SELECT event_id, event_type AS tool_name, user_id AS agent_id FROM (
        SELECT * FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 50)""",
)
def tool_log_query(t):
    log = t.events.select(
        "event_id",
        F.col("event_type").alias("tool_name"),
        F.col("user_id").alias("agent_id"),
        (F.col("event_type") == "error").alias("is_error"),
        "ts",
    )
    return governance.tool_calls(log, errors_only=True, last=50).drop("ts", "is_error")


@query(
    "idempotent_filter",
    """SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def idempotent_filter(t):
    done = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("event_id"))
    return governance.unprocessed(t.events.select("event_id", "event_type"), done, "event_id")


@query(
    "page_offset",
    """SELECT o_orderkey, total_rows, greatest(1, CAST(ceil(total_rows / 25.0) AS BIGINT)) AS total_pages
      FROM (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25 OFFSET 50),
        (SELECT count(*) AS total_rows FROM orders WHERE o_orderstatus = 'O')""",
)
def page_offset(t):
    rows = t.orders.where(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderdate")
    return governance.offset_page(rows, ["o_orderdate", "o_orderkey"], page=3, size=25).drop("o_orderdate")


@query(
    "page_position",
    """WITH n AS (SELECT count(*) AS total_rows FROM orders), p AS (SELECT CAST(ceil(total_rows / 3.0) AS BIGINT) AS total_pages FROM n)
      SELECT o_orderkey, total_rows, total_pages FROM orders, n, p
      QUALIFY row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) BETWEEN (total_pages - 100) * 3 + 1 AND (total_pages - 99) * 3""",
)
def page_position(t):
    """The hundredth page from the end, out of range partitions laid out once."""
    root, order = work_path(t.spark, "pages"), ["o_orderdate", "o_orderkey"]
    governance.write_pages(t.orders.select("o_orderkey", "o_orderdate"), order, root)
    pages = governance.page_at(t.spark, root, order, 1, 3).first()["total_pages"]
    return governance.page_at(t.spark, root, order, pages - 99, 3).drop("o_orderdate")


@query(
    "page_keyset",
    """WITH c AS (SELECT o_orderdate AS cd, o_orderkey AS ck FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1 OFFSET 99),
      p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders, c
        WHERE o_orderdate < cd OR (o_orderdate = cd AND o_orderkey < ck))
      SELECT o_orderkey, (SELECT max(rn) FROM p WHERE rn <= 26) > 25 AS has_more FROM p WHERE rn <= 25""",
)
def page_keyset(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    newest_first = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    cursor = rows.orderBy(*newest_first).offset(99).limit(1)
    return governance.keyset_page(rows, ["o_orderdate", "o_orderkey"], cursor, size=25).drop("o_orderdate")


@query(
    "budget_alerts",
    """SELECT user_id, round(CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE), 6) AS spent,
      round(round(CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE), 6) * 100.0 / 2000, 6) AS used_pct FROM events GROUP BY 1 HAVING used_pct > 90""",
)
def budget_alerts(t):
    return usage.budget_alerts(t.events, ["user_id"], "value", 2000.0)


@query(
    "step_alerts",
    "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS steps FROM events GROUP BY 1, 2 HAVING count(*) > 50",
)
def step_alerts(t):
    days = t.events.select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return usage.step_alerts(days, ["event_type", "day"])


@query(
    "rate_limit_alerts",
    """SELECT event_type, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*) AS requests, round(count(*) * 100.0 / 3, 6) AS used_pct
      FROM events GROUP BY 1, 2 HAVING count(*) * 100.0 / 3 > 80""",
)
def rate_limit_alerts(t):
    found = usage.rate_limit_alerts(t.events, "event_type", "ts", 3)
    return found.withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@query(
    "blended_cost",
    "SELECT event_id, round(user_id / 2 * 0.01 / 1000 + user_id / 2 * 0.03 / 1000, 9) AS per_1k, round(user_id / 2 * 2.5 / 1000000 + user_id / 2 * 10 / 1000000, 9) AS per_1m FROM events",
)
def blended_cost(t):
    tokens = F.col("user_id").cast("double")
    return t.events.select(
        "event_id",
        F.round(usage.blended_cost(tokens, F.lit(0.01), F.lit(0.03)), 9).alias("per_1k"),
        F.round(usage.blended_cost(tokens, F.lit(2.5), F.lit(10.0), 1_000_000), 9).alias("per_1m"),
    )


@query(
    "audit_append",
    """SELECT event_type AS action, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1, 2""",
)
def audit_append(t):
    """The events as audit records, appended in two parts."""
    from larkspur.session import work_path

    path = work_path(t.spark, "audit")
    records = t.events.select(
        F.col("event_type").alias("action"), F.col("user_id").cast("string").alias("actor"), F.lit("event").alias("resource"),
        F.col("props").alias("details"), F.lit("t").alias("tenant_id"), F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"),
    )
    for part in ("id % 2 = 0", "id % 2 = 1"):
        governance.append_audit(records.where(part), path)
    back = t.spark.read.parquet(path)
    return back.groupBy("action", F.date_format("day", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")
    )


@query("export_csv", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def export_csv(t):
    """All events exported to CSV files of at most a thousand rows and read back."""
    from larkspur.session import work_path
    from larkspur.sources import sinks

    path = work_path(t.spark, "export")
    sinks.export(t.events.select("event_id", "event_type"), path, "csv", 1000)
    back = t.spark.read.option("header", True).schema("event_id bigint, event_type string").csv(path)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
