"""Registered queries of the training-data operators, each beside its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import (
    collocations,
    decontaminate,
    divergence,
    html_blocks,
    language,
    mixing,
    pii,
    quality_crf,
    quality_rules,
    secret_scan,
    simhash,
    toxicity,
    urls,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), distance=3, shingle=3)


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find(_table(spark, sf_dir, "documents")))


@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


#: Host, path and verdict of the rules of op4.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op4_url_filter",
    r"""
    WITH rest AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), split AS (
      SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM rest
    ), rules(rule_host, rule_path, rule_verdict) AS (
      VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    ), fits AS (
      SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict
      FROM split LEFT JOIN rules
        ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
      QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
    )
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(_table(spark, sf_dir, "pages"), rules)


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op7_benchmark_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query(
    "op8_source_mixing",
    """
    WITH sizes AS (
      SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source
    ), rates AS (
      SELECT source, coalesce(CASE WHEN size > 0 THEN sqrt(size) / sum(sqrt(size)) OVER () * sum(size) OVER () / size END, 1.0) AS rate
      FROM sizes
    ), mass AS (
      SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS step
      FROM rates, LATERAL (SELECT unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k)
    ), drawn AS (
      SELECT d.*, CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
      FROM documents d
    ), copies AS (
      SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, m.k + 1 AS copy
      FROM drawn d JOIN mass m ON d.source IS NOT DISTINCT FROM m.source AND m.step <= d.u
    )
    SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(copy AS VARCHAR)) AS mix_key
    FROM copies
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), temperature=0.5, epochs=1.0, seed="mix")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


@query(
    "op11_phrase_collocations",
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents
    ), words AS (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), grams AS (
      SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
      FROM words, (SELECT unnest(range(1, 6)) AS m)
    ), counts AS (
      SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
    ), sizes AS (
      SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang
    ), candidates AS (
      SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 100
    ), kept AS (
      SELECT * FROM candidates c
      WHERE NOT EXISTS (
        SELECT 1 FROM candidates b
        WHERE b.lang = c.lang AND b.m > c.m AND 100 * b.f >= 100 * c.f AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')
      )
    ), cut AS (
      SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, s.n,
             CAST(1000::HUGEINT * c.f * s.n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM kept c, LATERAL (SELECT unnest(range(1, c.m)) AS k)
      JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
      JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
      JOIN sizes s ON s.lang = c.lang
    ), weakest AS (
      SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM weakest QUALIFY rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


@query(
    "op12_source_divergence",
    r"""
    WITH docs AS (
      SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents
    ), terms AS (
      SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
    ), kept AS (
      SELECT lang, term, count(*) AS total FROM terms GROUP BY lang, term HAVING count(DISTINCT id) >= 10
    ), langs AS (
      SELECT lang, count(*) AS kinds, sum(total) AS size FROM kept GROUP BY lang
    ), counts AS (
      SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL
    ), groups AS (
      SELECT g.lang, g.source, coalesce(sum(n), 0) AS size
      FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source
      GROUP BY ALL
    ), shares AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.size + 2 * l.kinds) AS p,
             1 + 1000000000::HUGEINT * (k.total + 2) // (l.size + 2 * l.kinds) AS q
      FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
      LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), sums AS (
      SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY ALL
    ), found AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM found QUALIFY part = 'pair' OR rank <= 10
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least_docs=10, top=10)


@query("op13_pii")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))
