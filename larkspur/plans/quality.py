"""Scans, sinks, cleaning, validation and load queries."""

from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.operators import clean, quality
from larkspur.operators.quality import Expectation, FieldRule
from larkspur.plans.registry import query
from larkspur.plans.runs import Pipeline, register_pipeline, run_etl
from larkspur.session import work_path
from larkspur.sources import files, sinks

# SQL form of the Unicode strip.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"


def strip_sql(column: str) -> str:
    return f"regexp_replace({column}, '^{WS}|{WS}$', '', 'g')"



@register_pipeline
class SpMigration(Pipeline):
    """A stored-procedure body as a job: open rows with a key, stamped, joined and summed."""

    name = "sp_migration"

    def __init__(self, spark, orders, customer, target, status="O"):
        super().__init__(spark)
        self.orders, self.customer, self.target, self.status = orders, customer, target, status

    def extract(self):
        return self.orders

    def transform(self, df):
        return (
            clean.drop_nulls(df.where(F.col("o_orderstatus") == self.status), ["o_orderkey"])
            .withColumn("processed_at", F.current_timestamp())
            .join(self.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
        )

    def load(self, df):
        return sinks.write_table(df, self.target, "parquet")


@query(
    "sp_migration",
    """SELECT c_mktsegment, count(*) AS n_orders, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,6))) AS DOUBLE), 4) AS total_price
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O' AND o_orderkey IS NOT NULL GROUP BY 1""",
)
def sp_migration(t):
    job = SpMigration(t.spark, t.orders, t.customer, None)
    return (
        job.transform(job.extract())
        .groupBy("c_mktsegment")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.round(F.sum(F.col("o_totalprice").cast("decimal(18,6)")).cast("double"), 4).alias("total_price"),
        )
    )


@query(
    "etl_run_metrics",
    """SELECT 'sp_migration' AS name, 'success' AS status, count(*) AS records_read,
      count(*) FILTER (WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer)) AS records_processed,
      CAST(0 AS BIGINT) AS records_failed FROM orders""",
)
def etl_run_metrics(t):
    # records_read counts every order, in a job that reads no column; the filter reaches the scan of the other.
    job = SpMigration(t.spark, t.orders, t.customer, work_path(t.spark, "sp"))
    return job.run().drop("duration_seconds", "errors")


@query(
    "write_table",
    """SELECT l_returnflag, count(*) AS n, round(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), 2) AS qty
      FROM lineitem GROUP BY 1""",
)
def write_table(t):
    path = work_path(t.spark, "lineitem")
    sinks.write_table(t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag"), path, partition_by=["l_returnflag"])
    back = files.read_table(t.spark, path)
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double"), 2).alias("qty"),
    )


def _format_round_trip(t, fmt, **options):
    path = work_path(t.spark, "orders") + f".{fmt}"
    sinks.write_table(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), path)
    back = files.read_table(t.spark, path, **options)
    return back.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2).alias("total"),
    )


ROUND_TRIP = """SELECT o_orderpriority, count(*) AS n,
  round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total FROM orders GROUP BY 1"""


@query("csv_strings", ROUND_TRIP)
def csv_strings(t):
    return _format_round_trip(t, "csv", infer=False)


@query("json_scan", ROUND_TRIP)
def json_scan(t):
    return _format_round_trip(t, "json", schema="o_orderkey bigint, o_orderpriority string, o_totalprice double")


@query("orc_scan", ROUND_TRIP)
def orc_scan(t):
    return _format_round_trip(t, "orc")


@query(
    "source_schema",
    """SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE 'string' END AS type,
             "null" = 'YES' AS nullable FROM (DESCRIBE orders)""",
)
def source_schema(t):
    """The columns of a file source without reading its rows."""
    return files.describe_source(t.spark, t.path("orders"))


@query(
    "read_corpus",
    """SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY 1""",
)
def read_corpus(t):
    path = work_path(t.spark, "corpus")
    out = t.documents.select("lang", "text").write.option("maxRecordsPerFile", 10_000).partitionBy("lang")
    out.text(path)
    good, _ = files.read_corpus(t.spark, path, "*.txt")
    lang = F.regexp_extract("path", "/lang=([^/]*)/", 1)
    return good.groupBy(lang.alias("lang")).agg(F.sum(F.octet_length("text")).alias("n_bytes"))


@query(
    "file_admission_reasons",
    """WITH f AS (SELECT page_id % 6 AS k, octet_length(encode(html)) AS n FROM pages),
      r AS (SELECT CASE k WHEN 1 THEN NULL WHEN 2 THEN 'exe' WHEN 4 THEN 'pdf' WHEN 5 THEN 'png' ELSE 'txt' END AS extension,
        CASE k WHEN 1 THEN 'no extension' WHEN 2 THEN 'extension not allowed'
          ELSE CASE WHEN k <> 3 AND n + CASE WHEN k = 5 THEN 8 ELSE 0 END > 3000 THEN 'too large' WHEN k = 3 THEN 'empty' WHEN k = 4 THEN 'type does not match extension' END
        END AS reject_reason FROM f)
      SELECT extension, reject_reason, count(*) AS files FROM r GROUP BY 1, 2""",
)
def file_admission_reasons(t):
    """Uploads made from the pages: right, without or with a wrong extension, empty, mislabelled and with a PNG beginning."""
    k = F.pmod("page_id", F.lit(6))
    name = F.element_at(F.array(*[F.lit(n) for n in ("a.txt", "b", "c.exe", "d.txt", "e.pdf", "f.PNG")]), (k + 1).cast("int"))
    body = F.encode("html", "UTF-8")
    content = F.when(k == 3, F.encode(F.lit(""), "UTF-8")).when(k == 5, F.concat(F.unhex(F.lit("89504E470D0A1A0A")), body)).otherwise(body)
    uploads = t.pages.select(F.concat(F.lit("up/"), name).alias("path"), content.alias("content"))
    uploads = uploads.withColumn("length", F.octet_length("content").cast("bigint"))
    found = files.file_admission(uploads, files.ADMITTED | {"txt": ("text/plain", "")}, 3000)
    return found.groupBy("extension", "reject_reason").agg(F.count(F.lit(1)).alias("files"))


@query("file_admission")
def file_admission(t):
    path = work_path(t.spark, "uploads")
    t.documents.select("lang", "text").write.option("maxRecordsPerFile", 10_000).partitionBy("lang").text(path)
    found = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    types = files.ADMITTED | {"txt": ("text/plain", "")}
    return files.file_admission(found, types).groupBy("extension", "reject_reason").agg(F.count(F.lit(1)).alias("files"))


@query(
    "infer_schema",
    """SELECT 'c_custkey' AS name, 'int' AS type, count(*) FILTER (WHERE c_custkey IS NULL) > 0 AS nullable FROM customer
      UNION ALL SELECT 'c_name', 'str', count(*) FILTER (WHERE c_name IS NULL) > 0 FROM customer
      UNION ALL SELECT 'c_nationkey', 'int', count(*) FILTER (WHERE c_nationkey IS NULL) > 0 FROM customer
      UNION ALL SELECT 'c_acctbal', 'float', count(*) FILTER (WHERE c_acctbal IS NULL) > 0 FROM customer
      UNION ALL SELECT 'c_mktsegment', 'str', count(*) FILTER (WHERE c_mktsegment IS NULL) > 0 FROM customer""",
)
def infer_schema(t):
    return quality.infer_schema(t.customer)


@query(
    "schema_diff",
    """SELECT * FROM (VALUES ('s_address', 'added', NULL, 'str'), ('s_name', 'removed', 'str', NULL),
      ('s_acctbal', 'retyped', 'float', 'str')) AS v(name, change, old_type, new_type)
      WHERE (SELECT count(*) FROM supplier) > 0""",
)
def schema_diff(t):
    after = t.supplier.select(
        "s_suppkey", "s_nationkey", F.col("s_acctbal").cast("string").alias("s_acctbal"), F.col("s_name").alias("s_address")
    )
    return quality.schema_diff(quality.infer_schema(t.supplier), quality.infer_schema(after))


@query(
    "schema_diff_nullability",
    """SELECT 's_name' AS name, 'nullability' AS change, 'str' AS old_type, 'str' AS new_type
      WHERE (SELECT count(*) FROM supplier WHERE s_suppkey % 10 = 0) > 0 AND (SELECT count(*) FROM supplier WHERE s_name IS NULL) = 0""",
)
def schema_diff_nullability(t):
    after = t.supplier.withColumn("s_name", F.when(F.col("s_suppkey") % 10 != 0, F.col("s_name")))
    return quality.schema_diff(quality.infer_schema(t.supplier), quality.infer_schema(after))


@query(
    "dataset_profile",
    """SELECT count(*) AS record_count, 6 AS field_count, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS fields
      FROM orders""",
)
def dataset_profile(t):
    return quality.dataset_profile(t.orders)


@query(
    "clean_strip",
    f"SELECT doc_id, md5({strip_sql('text')}) AS text_md5, CAST(length({strip_sql('text')}) AS INT) AS n FROM documents",
)
def clean_strip(t):
    stripped = clean.strip_strings(t.heavy("documents", "doc_id").select("doc_id", "text"))
    return stripped.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"))


@query(
    "clean_drop_nulls",
    """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL""",
)
def clean_drop_nulls(t):
    joined = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return clean.drop_nulls(joined, ["quality"])


@query(
    "clean_dedupe",
    """SELECT doc_id, md5(text) AS text_md5 FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def clean_dedupe(t):
    rows = clean.drop_duplicates(t.documents.select("doc_id", "text"), ["text"], [F.col("doc_id")])
    return rows.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "clean_records",
    f"""SELECT doc_id, source, md5(body) AS text_md5 FROM (
        SELECT doc_id, source, {strip_sql('text')} AS body FROM documents WHERE source IS NOT NULL AND text IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1""",
)
def clean_records(t):
    rows = clean.clean(
        t.documents.select("doc_id", "source", "text"),
        [F.col("doc_id")],
        null_columns=["source", "text"],
        dedup_columns=["text"],
    )
    return rows.select("doc_id", "source", F.md5("text").alias("text_md5"))


@query(
    "metadata_scalars",
    """SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS value FROM events""",
)
def metadata_scalars(t):
    return t.events.select("event_id", F.explode(clean.scalar_metadata("props")).alias("name", "value"))


@query(
    "doc_staging",
    rf"""SELECT doc_id, lang, CAST(length(body) AS INT) AS content_length,
        CAST(len(list_filter(regexp_split_to_array(body, '{WS}'), lambda w: w <> '')) AS INT) AS word_count
      FROM (SELECT doc_id, lang, {strip_sql('text')} AS body FROM documents WHERE text IS NOT NULL) WHERE length(body) > 50""",
)
def doc_staging(t):
    body = tx.strip(F.col("text"))
    return (
        t.heavy("documents", "doc_id").where(F.col("text").isNotNull())
        .select("doc_id", "lang", body.alias("body"))
        .where(F.length("body") > 50)
        .select("doc_id", "lang", F.length("body").alias("content_length"), tx.word_count(F.col("body")).alias("word_count"))
        .orderBy(F.desc("doc_id"))
    )


@query(
    "tenant_view",
    """SELECT event_id, event_type, value FROM events WHERE user_id = (SELECT min(c_custkey) + 7 FROM customer)""",
)
def tenant_view(t):
    from larkspur.operators.governance import tenant_view as view

    tenant = t.customer.agg(F.min("c_custkey") + 7).scalar()
    return view(t.events, "user_id", tenant).select("event_id", "event_type", "value")


@query(
    "build_features",
    """SELECT o_orderkey, CAST(length(o_orderpriority) AS INT) AS text_length, CAST(len(string_split(o_orderpriority, ' ')) AS INT) AS word_count,
        CAST(hour(o_orderdate) AS INT) AS hour, CAST(isodow(o_orderdate) AS INT) AS weekday,
        CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INT) AS category_code, upper(o_orderstatus) AS status_upper,
        round(o_totalprice / 10, 4) AS scaled FROM orders""",
)
def build_features(t):
    out = clean.build_features(t.orders, "o_orderpriority", "o_orderdate", "o_orderstatus")
    return out.select(
        "o_orderkey", "text_length", "word_count", "hour", "weekday", "category_code",
        F.upper("o_orderstatus").alias("status_upper"), F.round(F.col("o_totalprice") / 10, 4).alias("scaled"),
    )


ORDER_RULES = [
    FieldRule("o_orderkey", "int", False),
    FieldRule("o_comment_code", "int", False),
    FieldRule("o_totalprice", "float", False),
]


def _coded_orders(t):
    """Priority digits as text, with words where an int is declared and a null for low priority."""
    code = F.when(F.col("o_orderpriority").startswith("5"), None).when(
        F.col("o_orderpriority").startswith("4"), F.col("o_orderpriority")
    ).otherwise(F.substring("o_orderpriority", 1, 1))
    return t.orders.select("o_orderkey", "o_totalprice", code.alias("o_comment_code"))


CODED = """WITH coded AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderpriority LIKE '5%' THEN NULL
  WHEN o_orderpriority LIKE '4%' THEN o_orderpriority ELSE substr(o_orderpriority, 1, 1) END AS code FROM orders)"""


@query(
    "validate_schema",
    f"""{CODED} SELECT o_orderkey AS record, 'o_comment_code' AS field,
      CASE WHEN code IS NULL THEN 'null' ELSE 'type' END AS rule,
      'Record ' || o_orderkey || ': field ''o_comment_code'' ' ||
        CASE WHEN code IS NULL THEN 'is null but not nullable' ELSE 'expected int' END AS message
      FROM coded WHERE code IS NULL OR TRY_CAST(code AS BIGINT) IS NULL""",
)
def validate_schema(t):
    return quality.validate_schema(_coded_orders(t), ORDER_RULES, "o_orderkey")[1]


@query(
    "validate_dataset",
    f"""{CODED}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE code IS NULL OR TRY_CAST(code AS BIGINT) IS NULL) AS bad FROM coded)
      SELECT bad = 0 AS is_valid, total AS total_records, total - bad AS valid_records, bad AS invalid_records FROM c""",
)
def validate_dataset(t):
    return quality.validate_schema(_coded_orders(t), ORDER_RULES, "o_orderkey")[0]


@query(
    "run_etl",
    f"""{CODED}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE code IS NULL OR TRY_CAST(code AS BIGINT) IS NULL) AS bad FROM coded)
      SELECT 'partial' AS status, total AS records_read, total - bad AS records_written, bad AS records_quarantined FROM c""",
)
def run_etl_query(t):
    target = work_path(t.spark, "etl")
    done = run_etl(_coded_orders(t), target, ORDER_RULES, "o_orderkey", "quarantine", target + "-rejected")
    return t.spark.createDataFrame(
        [(done.status, done.records_read, done.records_written, done.records_quarantined)],
        "status string, records_read bigint, records_written bigint, records_quarantined bigint",
    )


@query(
    "run_etl_split",
    f"""{CODED}, c AS (SELECT code IS NOT NULL AND TRY_CAST(code AS BIGINT) IS NOT NULL AS is_valid, count(*) AS n FROM coded GROUP BY 1)
      SELECT is_valid, n, CASE WHEN is_valid THEN 0 ELSE n END AS with_errors, (SELECT sum(n) FROM c)::BIGINT AS records_read,
             (SELECT n FROM c WHERE is_valid) AS records_written, (SELECT n FROM c WHERE NOT is_valid) AS records_quarantined FROM c""",
)
def run_etl_split(t):
    """Valid and rejected rows in one table and one job, read back by the partition column."""
    target = work_path(t.spark, "etl")
    done = run_etl(_coded_orders(t), target, ORDER_RULES, "o_orderkey", "split")
    flag = F.col("is_valid").cast("boolean").alias("is_valid")  # a partition value is a text
    table = t.spark.read.parquet(target).groupBy(flag).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("errors") > 0).alias("with_errors"))
    numbers = {"records_read": done.records_read, "records_written": done.records_written, "records_quarantined": done.records_quarantined}
    return table.withColumns({k: F.lit(v).cast("bigint") for k, v in numbers.items()})


@query(
    "run_etl_load",
    f"""{CODED}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE code IS NULL OR TRY_CAST(code AS BIGINT) IS NULL) AS bad FROM coded)
      SELECT 'success' AS status, total AS records_written, bad AS records_invalid FROM c""",
)
def run_etl_load(t):
    """Invalid rows are written too, and counted in the same job."""
    done = run_etl(_coded_orders(t), work_path(t.spark, "etl"), ORDER_RULES, "o_orderkey")
    return t.spark.createDataFrame(
        [(done.status, done.records_written, done.records_invalid)], "status string, records_written bigint, records_invalid bigint"
    )


@query(
    "run_etl_fail",
    f"""{CODED}, c AS (SELECT count(*) FILTER (WHERE code IS NULL OR TRY_CAST(code AS BIGINT) IS NULL) AS bad FROM coded)
      SELECT CASE WHEN bad > 0 THEN 'failed' ELSE 'success' END AS status, CAST(0 AS BIGINT) AS records_written, bad AS records_invalid FROM c""",
)
def run_etl_fail(t):
    done = run_etl(_coded_orders(t), work_path(t.spark, "etl"), ORDER_RULES, "o_orderkey", "fail")
    return t.spark.createDataFrame(
        [(done.status, done.records_written, done.records_invalid)], "status string, records_written bigint, records_invalid bigint"
    )


@query(
    "split_valid",
    f"""SELECT lang, length({strip_sql('text')}) >= 400 AS valid, count(*) AS n FROM documents GROUP BY 1, 2""",
)
def split_valid(t):
    body = t.heavy("documents", "doc_id").select("doc_id", "lang", tx.strip(F.col("text")).alias("content"))
    short = F.filter(F.array(F.when(F.length("content") < 400, F.lit("content too short"))), lambda e: e.isNotNull())
    valid, invalid = quality.split_valid(body, short)
    both = valid.select("lang", F.lit(True).alias("valid")).unionByName(invalid.select("lang", F.lit(False).alias("valid")))
    return both.groupBy("lang", "valid").agg(F.count(F.lit(1)).alias("n"))


@query(
    "expectations",
    """WITH c AS (SELECT count(*) AS checked, count(*) FILTER (WHERE text IS NULL) AS a, count(*) FILTER (WHERE length(text) < 400) AS b,
        count(*) FILTER (WHERE lang NOT IN ('en', 'fr')) AS d, count(*) FILTER (WHERE n_chars < 0 OR n_chars > 5000) AS e FROM documents),
      u AS (SELECT coalesce(sum(n), 0) AS r FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)),
      i AS (SELECT coalesce(sum(n), 0) AS r FROM (SELECT count(*) AS n FROM documents GROUP BY doc_id HAVING count(*) > 1)),
      rows AS (SELECT 'not_null' AS expectation, 'text' AS column_name, checked, a AS failed FROM c
        UNION ALL SELECT 'length_between', 'text', checked, b FROM c UNION ALL SELECT 'in_set', 'lang', checked, d FROM c
        UNION ALL SELECT 'value_between', 'n_chars', checked, e FROM c UNION ALL SELECT 'unique', 'text', checked, u.r FROM c, u
        UNION ALL SELECT 'unique', 'doc_id', checked, i.r FROM c, i)
      SELECT expectation, column_name, checked, CAST(failed AS BIGINT) AS failed, failed = 0 AS success FROM rows""",
)
def expectations(t):
    return quality.expectations(
        t.documents,
        [
            Expectation("not_null", "text"),
            Expectation("length_between", "text", low=400),
            Expectation("in_set", "lang", values=("en", "fr")),
            Expectation("value_between", "n_chars", low=0, high=5000),
            Expectation("unique", "text"),
            Expectation("unique", "doc_id"),
        ],
    )


@query(
    "nested_total_check",
    """WITH s AS (SELECT l_orderkey, max(l_quantity) AS top, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS summed
        FROM lineitem GROUP BY 1)
      SELECT o_orderkey, top > 40 AS item_above_cap, abs(summed - o_totalprice) > 0.1 AS total_differs
      FROM orders JOIN s ON l_orderkey = o_orderkey""",
)
def nested_total_check(t):
    # An order may own any number of lines, so they are summed, not nested.
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_quantity").alias("top"),
        F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"), 2).alias("summed"),
    )
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .join(sums, "o_orderkey")
        .select(
            "o_orderkey",
            (F.col("top") > 40).alias("item_above_cap"),
            (F.abs(F.col("summed") - F.col("o_totalprice")) > 0.1).alias("total_differs"),
        )
    )


def _customer_changes(t):
    """Existing customers, and a batch of changed and new ones derived from orders (two versions of some)."""
    existing = t.customer.select("c_custkey", "c_name", "c_acctbal")
    incoming = t.orders.select(
        (F.col("o_custkey") * 2).alias("c_custkey"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderkey").alias("load_order"),
    )
    return existing, incoming


UPSERT = """WITH inc AS (SELECT o_custkey * 2 AS c_custkey, 'order ' || o_orderkey AS c_name, o_totalprice AS c_acctbal
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
  SELECT * FROM inc UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM inc)"""


@query("upsert_by_key", UPSERT)
def upsert_by_key(t):
    existing, incoming = _customer_changes(t)
    return sinks.upsert_by_key(existing, incoming, "c_custkey", [F.desc("load_order")])


@query("silver_merge", UPSERT)
def silver_merge(t):
    existing, incoming = _customer_changes(t)
    root = work_path(t.spark, "silver")
    sinks.silver_merge(t.spark, existing, root, "c_custkey", [F.col("c_name")])
    return sinks.silver_merge(t.spark, incoming, root, "c_custkey", [F.desc("load_order")])


@query(
    "upsert_missing_ids",
    """WITH b AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) END AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_name FROM customer),
      inc AS (SELECT coalesce(id, CAST(pos AS VARCHAR)) AS id, c_name, pos FROM b QUALIFY row_number() OVER (PARTITION BY coalesce(id, CAST(pos AS VARCHAR)) ORDER BY pos DESC) = 1)
      SELECT id, c_name FROM inc UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier WHERE CAST(s_suppkey AS VARCHAR) NOT IN (SELECT id FROM inc)""",
)
def upsert_missing_ids(t):
    """Customers, two in three without an id, upserted over suppliers: a missing id is the position in the batch."""
    batch = t.customer.select(F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")).alias("id"), "c_name", "c_custkey")
    named = sinks.key_or_position(batch, "id", [F.col("c_custkey")], F.floor(F.col("c_custkey") / 4096))
    existing = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("c_name"))
    return sinks.upsert_by_key(existing, named, "id", [F.desc("c_custkey")])


@query("clear_table", "SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 2 = 0) AS again FROM customer")
def clear_table(t):
    """A keyed table written, cleared and written again with other rows."""
    root = work_path(t.spark, "cleared")
    rows = t.customer.select("c_custkey", "c_name")
    n = sinks.silver_merge(t.spark, rows, root, "c_custkey", [F.col("c_name")]).count()
    sinks.clear(t.spark, root)
    again = sinks.silver_merge(t.spark, rows.where("c_custkey % 2 = 0"), root, "c_custkey", [F.col("c_name")])
    return again.agg(F.lit(n).cast("bigint").alias("n"), F.count(F.lit(1)).alias("again"))


@query(
    "nested_bounds",
    """SELECT l_orderkey, l_linenumber, CASE WHEN over AND off THEN 'item above cap,total differs from sum' WHEN over THEN 'item above cap' WHEN off THEN 'total differs from sum' ELSE '' END AS errors
      FROM (SELECT l_orderkey, l_linenumber, l_quantity > 40 OR l_discount * 1000 > 40 OR l_tax * 1000 > 40 AS over,
                   abs(l_quantity + l_discount * 1000 + l_tax * 1000 - l_linenumber * 30.0) > 20.0 AS off FROM lineitem)""",
)
def nested_bounds(t):
    """Three amounts of a line as its nested items: one above the cap, or a total that is not their sum."""
    amounts = [F.col("l_quantity"), F.col("l_discount") * 1000, F.col("l_tax") * 1000]
    items = F.array(*[F.struct(a.alias("hours")) for a in amounts])
    found = quality.nested_total_errors(items, "hours", F.col("l_linenumber") * 30.0, 40, 20.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.array_join(found, ",").alias("errors"))


@query(
    "delete_by_key",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def delete_by_key(t):
    gone = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return sinks.delete_by_key(t.customer.select("c_custkey", "c_name"), gone, "c_custkey")


@query(
    "bronze_append",
    """SELECT o_orderstatus, count(*) AS n, count(o_orderpriority) AS with_priority FROM (
        SELECT o_orderstatus, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F') GROUP BY 1""",
)
def bronze_append(t):
    path = work_path(t.spark, "bronze")
    old = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    new = t.orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sinks.bronze_append(old, path, ["o_orderstatus"])
    sinks.bronze_append(new, path, ["o_orderstatus"])
    return (
        sinks.read_bronze(t.spark, path)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.count("o_orderpriority").alias("with_priority"))
    )


@query(
    "bronze_table",
    """SELECT o_orderstatus, count(*) AS n, count(priority) AS with_priority, count(total) AS with_total FROM (
        SELECT o_orderstatus, NULL AS priority, o_totalprice AS total FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT o_orderstatus, o_orderpriority, NULL FROM orders WHERE o_orderstatus = 'P') GROUP BY 1""",
)
def bronze_table(t):
    """Three appends to a catalog table: the second brings a column, the third lacks one; read by name."""
    path = work_path(t.spark, "bronze_table")
    name = "bronze_" + path.rsplit("-", 1)[1]
    columns = {"F": ["o_orderkey", "o_totalprice"], "O": ["o_orderkey", "o_orderpriority", "o_totalprice"], "P": ["o_orderpriority", "o_orderkey"]}
    for status, kept in columns.items():
        sinks.bronze_table(t.orders.where(F.col("o_orderstatus") == status).select(*kept, "o_orderstatus"), name, ["o_orderstatus"], path)
    return (
        t.spark.table(name)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.count("o_orderpriority").alias("with_priority"), F.count("o_totalprice").alias("with_total"))
    )


@query(
    "gold_publish",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2000-02-01'""",
)
def gold_publish(t):
    path = work_path(t.spark, "gold")
    sinks.gold_publish(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), path, ["o_orderdate", "o_orderkey"])
    month = F.col("o_orderdate").between(F.expr("timestamp_ntz'2000-01-01'"), F.expr("timestamp_ntz'2000-01-31 23:59:59.999999'"))
    return files.read_table(t.spark, path).where(month).select("o_orderkey", "o_totalprice")
