"""Structured Streaming jobs run to the end of what the tables hold."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import chunks, usage
from larkspur.plans.registry import query
from larkspur.session import work_path
from larkspur.sources import sinks
from larkspur.streaming import cache, chain, tables, topics


def stream_of(t, name):
    """A table as a stream; the pattern stands for one file as for a folder of files."""
    return topics.read_files(t.spark, f"{t.sf_dir}/{name}.parque[t]", getattr(t, name).schema)


MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query(
    "stream_json_to_table",
    """SELECT CASE WHEN event_id % 50 = 0 THEN 'rejected' ELSE event_type END AS kind, count(*) AS n FROM events GROUP BY 1""",
)
def stream_json_to_table(t):
    """Events as JSON lines, one in fifty cut short, read as a topic."""
    base = work_path(t.spark, "topic")
    text = F.to_json(F.struct("event_id", "event_type", "value"))
    broken = F.when(F.pmod("event_id", F.lit(50)) == 0, F.lit('{"event_id": ')).otherwise(text)
    t.events.select(broken.alias("value")).write.text(f"{base}/in")
    stream = topics.read_files(t.spark, f"{base}/in", "value string", "text")
    topics.json_to_table(stream, MESSAGE, f"{base}/out", f"{base}/rejects", f"{base}/checkpoint")
    good = t.spark.read.schema(MESSAGE).parquet(f"{base}/out").select(F.col("event_type").alias("kind"))
    bad = t.spark.read.schema("bad_json string").parquet(f"{base}/rejects").select(F.lit("rejected").alias("kind"))
    return good.unionByName(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("stream_dedupe", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1")
def stream_dedupe(t):
    """The events delivered twice, kept once."""
    base = work_path(t.spark, "twice")
    rows = t.events.select("event_id", "event_type", "ts")
    rows.write.parquet(f"{base}/in/a")
    rows.write.parquet(f"{base}/in/b")
    stream = topics.read_files(t.spark, f"{base}/in/*", rows.schema)
    topics.run_to_end(topics.once(stream, "ts", "event_id"), topics.batch_writer(f"{base}/out"), f"{base}/checkpoint", conf=topics.ROCKSDB)
    out = t.spark.read.schema("event_id bigint, event_type string").parquet(f"{base}/out")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query(
    "outbox_relay",
    """SELECT event_type || '.' || CASE WHEN value > 100 THEN 'large' ELSE 'small' END AS topic, CAST(event_id AS VARCHAR) AS key, props AS value FROM (
      SELECT * FROM events WHERE event_type <> 'view')""",
)
def outbox_relay(t):
    """One pass over an outbox in which views are already published."""
    base = work_path(t.spark, "outbox")
    outbox = t.events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("aggregate_type"),
        F.when(F.col("value") > 100, "large").otherwise("small").alias("event_type"),
        F.col("props").alias("payload"),
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "view", F.col("ts")).alias("published_at"),
    )
    topics.relay(t.spark, outbox, f"{base}/topics", f"{base}/ledger")
    return t.spark.read.parquet(f"{base}/topics").select("topic", "key", "value")


@query(
    "stream_ingest",
    """WITH ch AS (SELECT doc_id, i, substr(text, i * 800 + 1, 1000) AS chunk FROM documents, unnest(generate_series(0, (length(text) - 1) // 800)) AS g(i) WHERE length(text) > 0)
      SELECT substr(sha256(chunk), 1, 16) AS chunk_id, doc_id, CAST(i AS INT) AS chunk_index FROM ch QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY doc_id DESC, i DESC) = 1""",
)
def stream_ingest(t):
    base = work_path(t.spark, "index")
    docs = stream_of(t, "documents").select("doc_id", "source", "text")
    tables.ingest_stream(docs, "text", "source", "doc_id", f"{base}/chunks", f"{base}/rejects", f"{base}/checkpoint")
    return tables.current_chunks(t.spark, f"{base}/chunks", "doc_id").select("chunk_id", "doc_id", "chunk_index")


@query(
    "stream_rate_alerts",
    """WITH w AS (SELECT time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * o) AS s, user_id FROM events, (SELECT unnest(generate_series(0, 5)) AS o))
      SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, user_id, count(*) AS requests FROM w GROUP BY 1, 2 HAVING count(*) > 1""",
)
def stream_rate_alerts(t):
    base = work_path(t.spark, "rates")
    log = stream_of(t, "events").select("ts", "user_id")
    windows = lambda batch: tables.rate_windows(batch, "user_id")
    tables.running_table_stream(log, windows, ["window_start", "user_id"], ["requests"], f"{base}/table", f"{base}/checkpoint")
    out = tables.current(t.spark, f"{base}/table").where(F.col("requests") > 1)
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "user_id", "requests")


@query(
    "stream_error_alerts",
    """WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS s, event_type = 'error' AS e FROM events)
      SELECT strftime(s, '%Y-%m-%d %H:%M') AS window_start, count(*) AS requests, count(*) FILTER (WHERE e) AS errors FROM w GROUP BY 1 HAVING count(*) FILTER (WHERE e) * 100.0 / count(*) > 5""",
)
def stream_error_alerts(t):
    base = work_path(t.spark, "errors")
    log = stream_of(t, "events").select("ts", (F.col("event_type") == "error").alias("is_error"))
    tables.running_table_stream(log, tables.error_windows, ["window_start"], ["requests", "errors"], f"{base}/table", f"{base}/checkpoint")
    out = tables.over_error_limit(tables.current(t.spark, f"{base}/table"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "requests", "errors")


@query(
    "stream_daily_cost",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS model, round(CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE), 6) AS cost,
      CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens, count(*) AS calls FROM events GROUP BY 1, 2""",
)
def stream_daily_cost(t):
    base = work_path(t.spark, "daily")
    log = stream_of(t, "events").select(
        "ts",
        F.col("event_type").alias("model"),
        usage.money(F.col("value")).alias("cost_usd"),
        usage.json_number("props", "$.k").alias("total_tokens"),
    )
    tables.daily_cost_stream(log, f"{base}/table", f"{base}/checkpoint")
    out = tables.current(t.spark, f"{base}/table")
    return out.select("day", "model", usage.usd(F.col("cost")).alias("cost"), "tokens", "calls")


@query(
    "stream_memory",
    "SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4",
)
def stream_memory(t):
    base = work_path(t.spark, "memory")
    messages = stream_of(t, "conversations")
    tables.memory_stream(messages, "conv_id", "turn", f"{base}/table", f"{base}/checkpoint", n=4)
    return tables.current(t.spark, f"{base}/table").select("conv_id", "turn", "role")


@query(
    "stream_ingest_changes",
    """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'new ' || text ELSE text END AS text FROM documents WHERE doc_id % 5 <> 1),
      ch AS (SELECT doc_id, i, substr(text, i * 800 + 1, 1000) AS chunk FROM d, unnest(generate_series(0, (length(text) - 1) // 800)) AS g(i) WHERE length(text) > 0)
      SELECT substr(sha256(chunk), 1, 16) AS chunk_id, doc_id, CAST(i AS INT) AS chunk_index FROM ch""",
)
def stream_ingest_changes(t):
    """All documents, then two newer versions of every fifth in one batch and a null text for the next one, each delivered twice."""
    base = work_path(t.spark, "changes")
    docs = t.documents.select("doc_id", "source", "text")
    later = (
        docs.where("doc_id % 5 = 0").withColumn("text", F.concat(F.lit("old "), "text")).withColumn("version", F.lit(2))
        .unionAll(docs.where("doc_id % 5 = 0").withColumn("text", F.concat(F.lit("new "), "text")).withColumn("version", F.lit(3)))
        .unionAll(docs.where("doc_id % 5 = 1").withColumn("text", F.lit(None).cast("string")).withColumn("version", F.lit(2)))
    )
    for rows in (later.limit(0), later, later):  # the first run has the documents alone, as they lie in their table
        rows.write.mode("append").parquet(f"{base}/in")
        first = stream_of(t, "documents").select("doc_id", "source", "text").withColumn("version", F.lit(1))
        stream = first.unionAll(topics.read_files(t.spark, f"{base}/in", later.schema))
        tables.ingest_stream(stream, "text", "source", "doc_id", f"{base}/chunks", f"{base}/rejects", f"{base}/checkpoint", "version")
    return tables.current(t.spark, f"{base}/chunks").select("chunk_id", "doc_id", "chunk_index")


@query(
    "stream_memory_repeated",
    "SELECT conv_id, turn, role FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3",
)
def stream_memory_repeated(t):
    """Every message delivered twice in one batch and once more in the next."""
    base = work_path(t.spark, "again")
    rows = t.conversations
    for copies in (2, 1):
        for _ in range(copies):
            rows.write.mode("append").parquet(f"{base}/in")
        stream = topics.read_files(t.spark, f"{base}/in", rows.schema)
        tables.memory_stream(stream, "conv_id", "turn", f"{base}/table", f"{base}/checkpoint", n=3)
    return tables.current(t.spark, f"{base}/table").select("conv_id", "turn", "role")


@query(
    "stream_late_rows",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, event_type = 'error' AS e, ts FROM events),
      w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS s, e FROM d),
      late AS (SELECT count(*) AS n FROM d WHERE date_part('day', day) % 2 = 1 AND ts < (SELECT max(ts) FROM d WHERE date_part('day', day) % 2 = 0) - INTERVAL 10 MINUTE)
      SELECT count(*) AS windows, CAST(sum(requests) AS BIGINT) AS requests, CAST(sum(errors) AS BIGINT) AS errors, (SELECT n FROM late) AS late_rows
      FROM (SELECT s, count(*) AS requests, count(*) FILTER (WHERE e) AS errors FROM w GROUP BY s)""",
)
def stream_late_rows(t):
    """Error windows of two runs: the events of even days first, those of odd days, a month late, in the second."""
    base = work_path(t.spark, "late")
    log = t.events.select("ts", (F.col("event_type") == "error").alias("is_error"))
    for odd in (0, 1):
        log.where(F.dayofmonth("ts") % 2 == odd).write.mode("append").parquet(f"{base}/in")
        stream = topics.read_files(t.spark, f"{base}/in", log.schema)
        tables.running_table_stream(stream, tables.error_windows, ["window_start"], ["requests", "errors"], f"{base}/table", f"{base}/checkpoint")
    late = tables.late_rows(t.spark, f"{base}/table").agg(F.sum("late_rows"))
    out = tables.current(t.spark, f"{base}/table").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("requests").alias("requests"), F.sum("errors").alias("errors")
    )
    return out.withColumn("late_rows", late.scalar())


@query(
    "stream_retry",
    """WITH ch AS (SELECT doc_id, unnest(generate_series(0, (length(text) - 1) // 800)) AS i FROM documents WHERE length(text) > 0 AND doc_id % 10 <> 7),
      n AS (SELECT doc_id, count(*) AS n_chunks FROM ch GROUP BY 1)
      SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 OR doc_id % 10 = 7 THEN 'dead_letter' ELSE 'index' END AS target,
             CASE WHEN coalesce(length(text), 0) = 0 THEN 'parse' ELSE 'embed' END AS step,
             CAST(CASE WHEN coalesce(length(text), 0) = 0 OR doc_id % 10 IN (3, 7) THEN 3 ELSE 1 END AS INT) AS tries,
             CASE WHEN coalesce(length(text), 0) = 0 THEN 'no text' WHEN doc_id % 10 = 7 THEN 'model is away' END AS error, coalesce(n_chunks, 0) AS n_chunks
      FROM documents LEFT JOIN n USING (doc_id)""",
)
def stream_retry(t):
    """The documents through parsing, chunking and an embedding that fails twice for some and always for others."""
    base = work_path(t.spark, "chain")

    def parse(rows):
        return rows.withColumn("error", F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, F.lit("no text")))

    def split(rows):
        return chunks.ingest(rows, "text", "source").withColumn("error", F.lit(None).cast("string"))

    def embed(rows):
        away = (F.col("doc_id") % 10 == 7) | ((F.col("doc_id") % 10 == 3) & (F.col("try_number") < 3))
        return rows.withColumns({"vector": F.array(F.length("chunk").cast("double")), "error": F.when(away, F.lit("model is away"))})

    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    docs = t.documents.select("doc_id", "text", "source")
    chain.upload(docs, "doc_id", base, start)
    for seconds in (0, 100, 300, 400):  # the first try, the second after a minute, the third after two, the outcome
        status = chain.run_chain(
            t.spark, docs, "doc_id", [("parse", parse), ("chunk", split), ("embed", embed)], base, start + dt.timedelta(seconds=seconds)
        )
    held = sinks.read_keyed(t.spark, f"{base}/index").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    return status.join(held, "doc_id", "left").na.fill(0, ["n_chunks"])


@query(
    "stream_cache",
    """WITH l AS (SELECT event_id, ts, CAST(user_id % 150 AS VARCHAR) AS key, event_type = 'purchase' AS is_set, value FROM events),
      w AS (SELECT *, max(CASE WHEN is_set THEN ts END) OVER o AS set_at, last_value(CASE WHEN is_set THEN value END IGNORE NULLS) OVER o AS answer
            FROM l WINDOW o AS (PARTITION BY key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
      SELECT event_id AS request_id, key, coalesce(ts < set_at + INTERVAL 12 HOUR, false) AS hit,
             CASE WHEN ts < set_at + INTERVAL 12 HOUR THEN round(answer, 6) END AS value
      FROM w WHERE NOT is_set""",
)
def stream_cache(t):
    """Purchases store an answer for twelve hours; all other events ask. Two runs, half of the time each."""
    base = work_path(t.spark, "cache")
    log = t.events.select(
        F.pmod("user_id", F.lit(150)).cast("string").alias("key"),
        F.col("event_id").alias("request_id"),
        "ts",
        F.when(F.col("event_type") == "purchase", "set").otherwise("get").alias("kind"),
        F.col("value").cast("string").alias("value"),
    )
    middle = t.events.agg(F.min("ts") + (F.max("ts") - F.min("ts")) / 2).scalar()
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        log.where(part).write.mode("append").parquet(f"{base}/in")
        answers = cache.cache_stream(topics.read_files(t.spark, f"{base}/in", log.schema), 12 * 3600)
        topics.run_to_end(answers, topics.batch_writer(f"{base}/out"), f"{base}/checkpoint", conf=topics.ROCKSDB)
    out = t.spark.read.schema(cache.ANSWER).parquet(f"{base}/out")
    return out.select("request_id", "key", "hit", F.round(F.col("value").cast("double"), 6).alias("value"))
