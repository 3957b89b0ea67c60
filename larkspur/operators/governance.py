"""Audit, paging, consent, retention and subject-rights operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.operators.ordered import latest_per_key


def audit_query(
    log: DataFrame,
    action: str | None = None,
    actor: object | None = None,
    since: Column | None = None,
    limit: int = 100,
    order: tuple[str, ...] = ("ts", "event_id"),
) -> DataFrame:
    """The newest ``limit`` matching entries in time order; limit 0 gives none."""
    if action is not None:
        log = log.where(F.col("action") == action)
    if actor is not None:
        log = log.where(F.col("actor") == actor)
    if since is not None:
        log = log.where(F.col("ts") >= since)
    return log.orderBy(*[F.desc(c) for c in order]).limit(limit).orderBy(*order)


def tool_calls(
    log: DataFrame,
    tool: str | None = None,
    agent: object | None = None,
    errors_only: bool = False,
    last: int = 100,
    order: tuple[str, ...] = ("ts", "event_id"),
) -> DataFrame:
    if tool is not None:
        log = log.where(F.col("tool_name") == tool)
    if agent is not None:
        log = log.where(F.col("agent_id") == agent)
    if errors_only:
        log = log.where("is_error")
    return log.orderBy(*[F.desc(c) for c in order]).limit(last).orderBy(*order)


def unprocessed(messages: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Messages whose id was not handled before."""
    return messages.join(done.select(key), key, "left_anti")


def offset_page(rows: DataFrame, order: list[str], page: int, size: int) -> DataFrame:
    """One page, newest first, with row and page totals (at least one page)."""
    total = rows.agg(F.count(F.lit(1))).scalar()
    return (
        rows.orderBy(*[F.desc(c) for c in order])
        .offset((page - 1) * size)
        .limit(size)
        .withColumn("total_rows", total)
        .withColumn("total_pages", F.greatest(F.lit(1), F.ceil(F.col("total_rows") / size)).cast("bigint"))
    )


def write_pages(rows: DataFrame, order: list[str], root: str, partitions: int | None = None) -> None:
    """Lay rows out newest first for pages by position: range partitions, and how many rows lie before each.

    ``order`` must tell rows apart, so that ranges are even. Written once, read by any number of ``page_at``.
    """
    newest = [F.desc(c) for c in order]
    ranged = rows.repartitionByRange(partitions, *newest) if partitions else rows.repartitionByRange(*newest)
    laid_out = ranged.withColumn("part", F.spark_partition_id()).sortWithinPartitions("part", *newest)
    laid_out.write.partitionBy("part").parquet(f"{root}/rows")
    rows.limit(0).write.parquet(f"{root}/empty")  # the columns, should there be no row
    counts = rows.sparkSession.read.schema(laid_out.schema).parquet(f"{root}/rows").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    counts.coalesce(1).write.parquet(f"{root}/counts")


def page_at(spark: SparkSession, root: str, order: list[str], page: int, size: int) -> DataFrame:
    """A page of what ``write_pages`` wrote, with row and page totals.

    Only the partitions that hold the page are read, and no task holds more than one of them, however deep the page.
    """
    counts = sorted((r["part"], r["n"]) for r in spark.read.parquet(f"{root}/counts").collect())  # a row per partition
    first, last, before = (page - 1) * size, page * size, 0
    held: list[Column] = []
    parts = []
    for part, n in counts:
        if before < last and before + n > first:
            parts.append(part)
            held += [F.lit(part), F.lit(before)]
        before += n
    pages = max(1, -(-before // size))
    totals = {"total_rows": F.lit(before).cast("long"), "total_pages": F.lit(pages).cast("long")}
    if not parts:
        return spark.read.parquet(f"{root}/empty").withColumns(totals)
    newest = [F.desc(c) for c in order]
    place = F.row_number().over(Window.partitionBy("part").orderBy(*newest)) + F.create_map(*held)[F.col("part")]
    found = spark.read.parquet(f"{root}/rows").where(F.col("part").isin(parts)).withColumn("__place", place)
    return (
        found.where((F.col("__place") > first) & (F.col("__place") <= last))
        .orderBy("__place")
        .drop("part", "__place")
        .withColumns(totals)
    )


def keyset_page(rows: DataFrame, order: list[str], cursor: DataFrame, size: int) -> DataFrame:
    """The ``size`` rows strictly after the cursor row in descending order, with ``has_more``.

    The cursor is a one-row frame; its values become scalar subqueries, so the
    comparison is a plain filter and the page a top-n.
    """
    at = F.struct(*[cursor.select(c).scalar().alias(c) for c in order])
    newest_first = [F.desc(c) for c in order]
    peek = rows.where(F.struct(*order) < at).orderBy(*newest_first).limit(size + 1)
    # The peek holds at most size + 1 rows.
    position = F.row_number().over(Window.partitionBy().orderBy(*newest_first))
    found = F.count(F.lit(1)).over(Window.partitionBy())
    return (
        peek.withColumn("__pos", position)
        .withColumn("has_more", found > size)
        .where(F.col("__pos") <= size)
        .drop("__pos")
    )


def replay(events: DataFrame, aggregate: str, version: str, event: str, *state: Column) -> DataFrame:
    """Last event and version gaps per aggregate from a partial aggregate.

    Versions are unique and start at 1, so gaps = last version - number of versions.
    """
    return events.groupBy(aggregate).agg(
        F.count(F.lit(1)).alias("versions"),
        F.max(version).alias("last_version"),
        F.max_by(event, version).alias("last_event"),
        (F.max(version) - F.count(F.lit(1))).alias("gaps"),
        *state,
    )


def append_audit(records: DataFrame, path: str, as_of: Column | None = None) -> int:
    """Append audit records (action, actor, resource, details, tenant_id, and id and timestamp where known).

    A missing timestamp is ``as_of``; a missing id is the hash of the record, so the
    same record sent again can be told. Records are only ever added, by day.
    """
    from larkspur.sources.sinks import bronze_append

    when = F.coalesce(F.col("timestamp"), as_of if as_of is not None else F.current_timestamp())
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("action", "actor", "resource", "details", "tenant_id")]
    stamped = records.withColumn("timestamp", when).withColumn(
        "id", F.coalesce(F.col("id"), F.sha2(F.to_json(F.array(*fields, F.col("timestamp").cast("string"))), 256))
    )
    return bronze_append(stamped.withColumn("day", F.to_date("timestamp")), path, ["day"])


def tenant_view(rows: DataFrame, tenant_col: str, tenant: object) -> DataFrame:
    """Rows of one tenant; on a table partitioned by tenant this prunes directories."""
    return rows.where(F.col(tenant_col) == tenant)


def pseudonym(user: Column, salt: str) -> Column:
    return F.sha2(F.concat(user.cast("string"), F.lit(salt)), 256)


def input_digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def consent_decisions(records: DataFrame, as_of: Column) -> DataFrame:
    """Newest record per (user, purpose) decides; withdrawn or expired means no.

    Columns: user_id, purpose, granted, expires_at, recorded_at, record_id.
    """
    newest = latest_per_key(records, ["user_id", "purpose"], ["recorded_at", "record_id"])
    live = F.col("expires_at").isNull() | (F.col("expires_at") >= as_of)
    return newest.select("user_id", "purpose", (F.col("granted") & live).alias("allowed"))


def consent_gate(requests: DataFrame, decisions: DataFrame) -> DataFrame:
    """Requests with an ``allowed`` flag; no record means no."""
    return requests.join(decisions, ["user_id", "purpose"], "left").withColumn(
        "allowed", F.coalesce("allowed", F.lit(False))
    )


def subject_erase(stores: dict[str, tuple[DataFrame, str]], subjects: DataFrame, key: str) -> dict[str, DataFrame]:
    """Each store without the subjects' rows."""
    ids = subjects.select(F.col(key).alias("__subject")).distinct()
    return {
        name: df.join(ids, F.col(col) == F.col("__subject"), "left_anti") for name, (df, col) in stores.items()
    }


def subject_export(stores: dict[str, tuple[DataFrame, str]], subjects: DataFrame, key: str) -> DataFrame:
    """All rows of the subjects as (store, subject, record JSON)."""
    ids = subjects.select(F.col(key).alias("__subject")).distinct()
    parts = [
        df.join(ids, F.col(col) == F.col("__subject"), "left_semi").select(
            F.lit(name).alias("store"), F.col(col).alias("subject"), F.to_json(F.struct(*df.columns)).alias("record")
        )
        for name, (df, col) in stores.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def retention_actions(rows: DataFrame, policies: DataFrame, as_of: Column, category: str, ts: str) -> DataFrame:
    """Mark every row keep, delete or anonymize by its category's policy.

    ``policies``: category, retention_days, strategy, legal_hold. A row older than
    its cutoff is acted on unless the policy is on hold; no policy keeps it.
    """
    rules = policies.select(F.col("category").alias("__cat"), "retention_days", "strategy", "legal_hold")
    due = (F.col(ts) < as_of - F.make_dt_interval(F.col("retention_days"))) & ~F.col("legal_hold")
    verb = F.when(F.col("strategy") == "anonymize", "anonymize").otherwise("delete")
    action = F.when(due, verb).otherwise("keep")
    return (
        rows.join(rules, F.col(category) == F.col("__cat"), "left")
        .withColumn("action", action)
        .drop("__cat", "retention_days", "strategy", "legal_hold")
    )


def retention_apply(marked: DataFrame, personal: list[str]) -> DataFrame:
    """Drop deleted rows and null the personal columns of anonymized ones."""
    kept = marked.where(F.col("action") != "delete")
    for c in personal:
        kept = kept.withColumn(c, F.when(F.col("action") != "anonymize", F.col(c)))
    return kept


# Feedback kinds that go to a person.
ESCALATED = ("harmful", "biased")


def feedback_rollup(feedback: DataFrame) -> DataFrame:
    """Counts by type with the escalated ones marked; comments are cut to 2 000 characters."""
    return (
        feedback.withColumn("comment", F.substring("comment", 1, 2000))
        .groupBy("feedback_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("feedback_type").isin(*ESCALATED)).alias("escalated"),
            F.max(F.length("comment")).alias("longest_comment"),
        )
    )
