"""Consent, subject rights, retention and feedback queries."""

from pyspark.sql import functions as F

from larkspur.operators import governance, usage
from larkspur.plans.registry import query

CONSENT = """WITH rec AS (SELECT event_id, user_id, CASE WHEN event_type IN ('click', 'view') THEN 'analytics' ELSE 'training' END AS purpose, value < 100 AS granted,
    CASE WHEN value < 30 THEN ts + INTERVAL 12 DAY END AS expires_at, ts FROM events),
  newest AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY user_id, purpose ORDER BY ts DESC, event_id DESC) = 1),
  dec AS (SELECT user_id, purpose, granted AND (expires_at IS NULL OR expires_at >= (SELECT max(ts) - INTERVAL 1 DAY FROM events) + INTERVAL 12 DAY) AS allowed FROM newest)"""


@query(
    "consent_gate",
    f"""{CONSENT} SELECT c_custkey AS user_id, p AS purpose, coalesce(allowed, false) AS allowed
      FROM customer, (SELECT unnest(['analytics', 'training']) AS p) LEFT JOIN dec ON user_id = c_custkey AND purpose = p""",
)
def consent_gate(t):
    purpose = F.when(F.col("event_type").isin("click", "view"), "analytics").otherwise("training")
    records = t.events.select(
        "user_id",
        purpose.alias("purpose"),
        (F.col("value") < 100).alias("granted"),
        F.when(F.col("value") < 30, F.col("ts") + F.make_dt_interval(F.lit(12))).alias("expires_at"),
        F.col("ts").alias("recorded_at"),
        F.col("event_id").alias("record_id"),
    )
    as_of = usage.newest(t.events, "ts") + F.make_dt_interval(F.lit(11))
    decisions = governance.consent_decisions(records, as_of)
    requests = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.explode(F.array(F.lit("analytics"), F.lit("training"))).alias("purpose")
    )
    return governance.consent_gate(requests, decisions)


def _stores(t):
    return {
        "orders": (t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "o_custkey"),
        "events": (t.events.select("event_id", "user_id", "event_type"), "user_id"),
    }


def _subjects(t):
    return t.customer.where(F.col("c_acctbal") < 0).select("c_custkey")


@query(
    "subject_erase",
    """SELECT 'orders' AS store, count(*) AS remaining FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
      UNION ALL SELECT 'events', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def subject_erase(t):
    left = governance.subject_erase(_stores(t), _subjects(t), "c_custkey")
    counts = [df.agg(F.lit(name).alias("store"), F.count(F.lit(1)).alias("remaining")) for name, df in left.items()]
    return counts[0].unionByName(counts[1])


@query(
    "subject_export",
    """SELECT 'orders' AS store, o_custkey AS subject, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS record
      FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
      UNION ALL SELECT 'events', user_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'
      FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def subject_export(t):
    return governance.subject_export(_stores(t), _subjects(t), "c_custkey")


# category, days, strategy, legal hold
POLICIES = [
    ("click", 10, "hard_delete", False),
    ("view", 5, "anonymize", False),
    ("purchase", 1, "hard_delete", True),
    ("error", 20, "soft_delete", False),
]

MARKED = """WITH pol(category, days, strategy, hold) AS (VALUES ('click', 10, 'hard_delete', false), ('view', 5, 'anonymize', false), ('purchase', 1, 'hard_delete', true), ('error', 20, 'soft_delete', false)),
  m AS (SELECT event_id, user_id, event_type, CASE WHEN ts < (SELECT max(ts) FROM events) - to_days(days) AND NOT hold
      THEN CASE WHEN strategy = 'anonymize' THEN 'anonymize' ELSE 'delete' END ELSE 'keep' END AS action
    FROM events LEFT JOIN pol ON category = event_type)"""


def _marked(t):
    policies = t.spark.createDataFrame(POLICIES, "category string, retention_days int, strategy string, legal_hold boolean")
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return governance.retention_actions(rows, policies, usage.newest(t.events, "ts"), "event_type", "ts")


@query(
    "retention_apply",
    f"{MARKED} SELECT event_id, event_type, CASE WHEN action <> 'anonymize' THEN user_id END AS user_id FROM m WHERE action <> 'delete'",
)
def retention_apply(t):
    return governance.retention_apply(_marked(t), ["user_id"]).select("event_id", "event_type", "user_id")


@query("retention_report", f"{MARKED} SELECT event_type, action, count(*) AS n FROM m GROUP BY 1, 2")
def retention_report(t):
    return _marked(t).groupBy("event_type", "action").agg(F.count(F.lit(1)).alias("n"))


@query(
    "feedback_rollup",
    """WITH f AS (SELECT CASE turn % 4 WHEN 0 THEN 'helpful' WHEN 1 THEN 'harmful' WHEN 2 THEN 'biased' ELSE 'wrong' END AS feedback_type, substr(text, 1, 2000) AS c FROM conversations)
      SELECT feedback_type, count(*) AS n, count(*) FILTER (WHERE feedback_type IN ('harmful', 'biased')) AS escalated, CAST(max(length(c)) AS INT) AS longest_comment FROM f GROUP BY 1""",
)
def feedback_rollup(t):
    kinds = F.array(*[F.lit(k) for k in ("helpful", "harmful", "biased", "wrong")])
    kind = F.element_at(kinds, (F.pmod("turn", F.lit(4)) + 1).cast("int"))
    return governance.feedback_rollup(t.conversations.select(kind.alias("feedback_type"), F.col("text").alias("comment")))
