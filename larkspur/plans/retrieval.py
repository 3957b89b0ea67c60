"""Vector, cache, rerank and text-search queries.

The query vectors are derived from the whole table: the mean vector of each label,
or of each user's history.
"""

from pyspark.sql import functions as F

from larkspur.functions import vectors
from larkspur.operators import search, similarity, usage
from larkspur.plans.registry import query
from larkspur.session import work_path
from larkspur.sources import sinks

CENTROIDS = """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  parts AS (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
  q AS (SELECT label AS query_id, list(m ORDER BY i) AS qv FROM (SELECT label, i, avg(x) AS m FROM parts GROUP BY 1, 2) GROUP BY 1),
  sims AS (SELECT query_id, vec_id AS doc_id, label, round(list_cosine_similarity(e, qv), 9) AS cos, round(1 - list_sum([(e[j] - qv[j]) ** 2 FOR j IN generate_series(1, len(e))]), 9) AS l2 FROM q, v)"""
RANK_COS = "row_number() OVER (PARTITION BY query_id ORDER BY cos DESC, doc_id)"


def centroids(t):
    return vectors.mean_vectors(t.embeddings, "label", "embedding", "query_vec").withColumnRenamed("label", "query_id")


def shown(df, *extra):
    return df.select("query_id", "doc_id", F.round("score", 6).alias("score"), *extra)


@query(
    "vector_topk",
    f"{CENTROIDS} SELECT query_id, doc_id, round(cos, 6) AS score, CAST({RANK_COS} AS INT) AS rank FROM sims QUALIFY {RANK_COS} <= 10",
)
def vector_topk(t):
    return shown(similarity.top_k(t.embeddings, centroids(t), 10), "rank")


@query(
    "vector_topk_l2",
    f"{CENTROIDS} SELECT query_id, doc_id, round(l2, 6) AS score FROM sims WHERE label >= 5 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY l2 DESC, doc_id) <= 10",
)
def vector_topk_l2(t):
    kept = t.embeddings.where(F.col("label") >= 5)
    return shown(similarity.top_k(kept, centroids(t), 10, metric="l2sq"))


HISTORY = CENTROIDS.replace(
    "SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v",
    "SELECT user_id AS label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v JOIN events ON event_id = vec_id",
)


def histories(t):
    seen = t.events.select(F.col("event_id").alias("vec_id"), "user_id").join(t.embeddings.select("vec_id", "embedding"), "vec_id")
    return vectors.mean_vectors(seen, "user_id", "embedding", "query_vec").withColumnRenamed("user_id", "query_id")


@query(
    "vector_threshold",
    f"{HISTORY} SELECT query_id, doc_id, round(cos, 6) AS score FROM sims WHERE cos >= 0.4 QUALIFY {RANK_COS} <= 10",
)
def vector_threshold(t):
    return shown(similarity.top_k(t.embeddings, histories(t), 10, at_least=0.4))


@query(
    "recommend_by_history",
    f"{HISTORY} SELECT query_id, doc_id, round(cos, 6) AS score FROM sims QUALIFY {RANK_COS} <= 10",
)
def recommend_by_history(t):
    return shown(similarity.top_k(t.embeddings, histories(t), 10))


@query(
    "vector_namespaces",
    f"""{CENTROIDS} SELECT query_id, doc_id, round(cos, 6) AS score, CASE WHEN label < 5 THEN 'facts' ELSE 'examples' END AS namespace FROM sims
      QUALIFY row_number() OVER (PARTITION BY query_id, label < 5 ORDER BY cos DESC, doc_id) <= 3""",
)
def vector_namespaces(t):
    asked = centroids(t)
    facts = similarity.top_k(t.embeddings.where(F.col("label") < 5), asked, 3)
    examples = similarity.top_k(t.embeddings.where(F.col("label") >= 5), asked, 3)
    return shown(facts, F.lit("facts").alias("namespace")).unionByName(shown(examples, F.lit("examples").alias("namespace")))


@query(
    "vector_topk_all_cells",
    f"{CENTROIDS} SELECT query_id, doc_id, round(cos, 6) AS score, CAST({RANK_COS} AS INT) AS rank FROM sims QUALIFY {RANK_COS} <= 10",
)
def vector_topk_all_cells(t):
    """The approximate search with every cell probed is the exact one."""
    celled, centres = similarity.cluster_cells(t.embeddings, 8)
    return shown(similarity.top_k_approx(celled, centres, centroids(t), 10, probes=8), "rank")


@query("vector_topk_approx")
def vector_topk_approx(t):
    celled, centres = similarity.cluster_cells(t.embeddings, 8)
    return shown(similarity.top_k_approx(celled, centres, centroids(t), 10, probes=3))


def _kept_cells(t, vectors, cells):
    """Four fifths of the vectors fitted and written, the others added later."""
    root = work_path(t.spark, "cells")
    similarity.write_cells(vectors.where("vec_id % 5 <> 0"), cells, root)
    similarity.add_to_cells(vectors.where("vec_id % 5 = 0"), root)
    return root


@query(
    "vector_kept_cells",
    f"{CENTROIDS} SELECT query_id, doc_id, round(cos, 6) AS score, CAST({RANK_COS} AS INT) AS rank FROM sims QUALIFY {RANK_COS} <= 10",
)
def vector_kept_cells(t):
    """The kept index, with vectors added after the fit, gives the exact neighbours when all of its cells are probed."""
    root = _kept_cells(t, t.embeddings.select("vec_id", "embedding"), 8)
    return shown(similarity.search_cells(t.spark, root, centroids(t), 10, probes=8), "rank")


@query("vector_kept_cells_recall", "SELECT true AS good, count(DISTINCT label) * 10 AS wanted FROM embeddings")
def vector_kept_cells_recall(t):
    """Half of the cells, over the first four numbers of the vectors: nine in ten of the exact neighbours or more are found."""
    vectors = t.embeddings.select("vec_id", F.slice("embedding", 1, 4).alias("embedding"))
    asked = centroids(t).withColumn("query_vec", F.slice("query_vec", 1, 4))
    root = _kept_cells(t, vectors, 16)
    found = similarity.search_cells(t.spark, root, asked, 10, probes=8)
    return similarity.recall(found, similarity.top_k(vectors, asked, 10)).select((F.col("recall") >= 0.9).alias("good"), "wanted")


@query(
    "cosine",
    f"{CENTROIDS} SELECT doc_id AS vec_id, round(cos, 6) AS similarity FROM sims WHERE query_id = label",
)
def cosine(t):
    joined = t.embeddings.join(centroids(t), F.col("label") == F.col("query_id"))
    return joined.select("vec_id", F.round(vectors.cosine(F.col("embedding"), F.col("query_vec")), 6).alias("similarity"))


RERANKED = f"""ranked AS (SELECT *, {RANK_COS} AS was FROM sims QUALIFY {RANK_COS} <= 10),
  ext AS (SELECT r.query_id, r.doc_id, was, coalesce(quality + toxic * 0.5, 0.0) AS score FROM ranked r LEFT JOIN labels l ON l.doc_id = r.doc_id)"""


def _external(t):
    """Scores by document; the hits are joined to them in one pass."""
    return t.labels.select("doc_id", (F.col("quality") + F.col("toxic") * 0.5).alias("score"))


@query(
    "rerank",
    f"""{CENTROIDS}, {RERANKED} SELECT query_id, doc_id, CAST(score AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, was) AS INT) AS rank FROM ext
      QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, was) <= 5""",
)
def rerank(t):
    hits = similarity.top_k(t.embeddings, centroids(t), 10)
    return similarity.rerank(hits, _external(t), 5, ("doc_id",)).select("query_id", "doc_id", "score", "rank")


@query(
    "retrieve_rerank",
    f"""{CENTROIDS}, {RERANKED.replace('<= 10', '<= 8')} SELECT query_id, doc_id, CAST(score AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, was) AS INT) AS rank FROM ext
      QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, was) <= 4""",
)
def retrieve_rerank(t):
    k = 4
    hits = similarity.top_k(t.embeddings, centroids(t), 2 * k)
    return similarity.rerank(hits, _external(t), k, ("doc_id",)).select("query_id", "doc_id", "score", "rank")


VARIANTS = f"""{CENTROIDS}, one AS (SELECT label AS question, 2 AS ord, arg_min(e, vec_id) AS qv FROM v GROUP BY 1
    UNION ALL SELECT label, 3, arg_max(e, vec_id) FROM v GROUP BY 1 UNION ALL SELECT query_id, 1, qv FROM q),
  vs AS (SELECT question, ord, vec_id AS doc_id, round(list_cosine_similarity(e, qv), 9) AS s FROM one, v),
  hit AS (SELECT * FROM vs QUALIFY row_number() OVER (PARTITION BY question, ord ORDER BY s DESC, doc_id) <= 5)"""


def _variant_hits(t):
    """Hits of three query vectors per label: its mean, its first and its last vector."""
    vec = F.col("embedding").cast("array<double>")
    ends = t.embeddings.groupBy(F.col("label").alias("question")).agg(
        F.min_by(vec, "vec_id").alias("first"), F.max_by(vec, "vec_id").alias("last")
    )
    asked = (
        centroids(t).select(F.col("query_id").alias("question"), F.lit(1).alias("ord"), "query_vec")
        .unionByName(ends.select("question", F.lit(2).alias("ord"), F.col("first").alias("query_vec")))
        .unionByName(ends.select("question", F.lit(3).alias("ord"), F.col("last").alias("query_vec")))
    )
    named = asked.withColumn("query_id", F.col("question").cast("bigint") * 10 + F.col("ord"))
    hits = similarity.top_k(t.embeddings, named, 5)
    return hits.withColumn("question", F.floor(F.col("query_id") / 10).cast("int")).withColumn(
        "ord", F.pmod("query_id", F.lit(10)).cast("int")
    )


@query(
    "multi_query_union",
    f"{VARIANTS} SELECT question, doc_id, round(arg_min(s, ord), 6) AS score FROM hit GROUP BY 1, 2",
)
def multi_query_union(t):
    merged = similarity.multi_query_union(_variant_hits(t), "question", "ord")
    return merged.select("question", "doc_id", F.round("score", 6).alias("score")).orderBy("question", F.desc("score"), "doc_id")


@query(
    "hybrid_merge",
    f"""{VARIANTS} SELECT question AS query_id, doc_id, round(list_reduce(list(s ORDER BY ord), lambda a, x: (a + x) / 2), 6) AS score FROM hit GROUP BY 1, 2""",
)
def hybrid_merge(t):
    hits = _variant_hits(t).select(F.col("question").alias("query_id"), "doc_id", "ord", "score")
    return shown(similarity.hybrid_merge(hits, "ord"))


@query(
    "adaptive_retrieve",
    f"""{VARIANTS}, firsts AS (SELECT question, doc_id, arg_min(s, ord) AS score, min(ord) AS level FROM hit GROUP BY 1, 2),
      pt AS (SELECT question, doc_id, score, tier FROM firsts, (SELECT unnest([1, 2, 3]) AS tier) WHERE tier >= level),
      best AS (SELECT *, row_number() OVER (PARTITION BY question, tier ORDER BY score DESC, doc_id) AS rank FROM pt QUALIFY rank <= 5),
      means AS (SELECT question, tier, avg(score) AS mean_score FROM best GROUP BY 1, 2),
      chosen AS (SELECT question, coalesce(min(CASE WHEN mean_score >= 0.42 THEN tier END), 3) AS tier FROM means GROUP BY 1)
      SELECT best.question AS query_id, doc_id, round(score, 6) AS score, CASE tier WHEN 1 THEN 'vector' WHEN 2 THEN 'hybrid' ELSE 'expanded' END AS strategy, round(mean_score, 6) AS mean_score
      FROM best JOIN chosen USING (question, tier) JOIN means USING (question, tier)""",
)
def adaptive_retrieve(t):
    hits = _variant_hits(t).select(F.col("question").alias("query_id"), "doc_id", "ord", "score")
    tiers = [(name, hits.where(F.col("ord") == i)) for i, name in ((1, "vector"), (2, "hybrid"), (3, "expanded"))]
    out = similarity.adaptive(tiers, 5, threshold=0.42)
    return shown(out, "strategy", F.round("mean_score", 6).alias("mean_score"))


CACHE = f"""{CENTROIDS}, span AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM events),
  best AS (SELECT doc_id AS query_id, query_id AS doc_id, cos FROM sims QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cos DESC, query_id) = 1),
  look AS (SELECT best.query_id, CASE WHEN cos >= 0.25 AND t0 + to_days(best.doc_id) >= t1 - INTERVAL 25 DAY THEN 'answer ' || best.doc_id END AS answer, round(cos, 6) AS score FROM best, span)"""


def _lookups(t):
    """Every vector asks a cache of label means; older labels' answers have expired."""
    cached = centroids(t)
    asked = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    best = similarity.top_k(cached, asked, 1, id_col="query_id", vec_col="query_vec")
    first = t.events.agg(F.min("ts")).scalar()
    answers = cached.select(
        F.col("query_id").alias("doc_id"),
        F.concat(F.lit("answer "), F.col("query_id").cast("string")).alias("answer"),
        (first + F.make_dt_interval(F.col("query_id"))).alias("created_at"),
    )
    return similarity.cache_lookup(best, answers, usage.newest(t.events, "ts"), F.make_dt_interval(F.lit(25)), 0.25)


@query("semantic_cache_lookup", f"{CACHE} SELECT query_id, answer IS NOT NULL AS hit, answer, score FROM look")
def semantic_cache_lookup(t):
    return _lookups(t).withColumn("score", F.round("score", 6))


@query(
    "cache_stats",
    f"""{CACHE} SELECT count(answer) AS hits, count(*) - count(answer) AS misses, round(count(answer) / count(*), 6) AS hit_rate,
      round(count(answer) * 0.0001::DOUBLE, 6) AS cost_saved FROM look""",
)
def cache_stats(t):
    return similarity.cache_stats(_lookups(t))


@query(
    "exact_cache_lookup",
    """WITH mx AS (SELECT max(doc_id) AS m FROM documents),
      cached AS (SELECT text, lang, arg_max('r' || d.doc_id, d.doc_id) AS response FROM documents d JOIN labels l ON l.doc_id = d.doc_id, mx
        WHERE d.doc_id * 10 >= m * 10 - 7200 GROUP BY 1, 2)
      SELECT d.doc_id, c.response IS NOT NULL AS hit, c.response FROM documents d LEFT JOIN cached c ON c.text = d.text AND c.lang = d.lang AND d.lang = 'en'""",
)
def exact_cache_lookup(t):
    temperature = F.when(F.col("lang") == "en", 0.0).otherwise(0.7)
    requests = t.documents.select(
        "doc_id",
        temperature.alias("temperature"),
        similarity.request_key(F.col("text"), F.col("lang"), temperature, F.lit(256)).alias("key"),
    )
    cached = requests.join(t.labels.select("doc_id"), "doc_id").select(
        "key",
        F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("response"),
        (F.col("doc_id") * 10).alias("created_at"),
    )
    now = t.documents.agg(F.max("doc_id") * 10).scalar()
    return similarity.exact_cache_lookup(requests, cached, now, F.lit(7200)).select("doc_id", "hit", "response")


@query(
    "answer_sources",
    f"""{CENTROIDS}, r AS (SELECT * FROM sims QUALIFY {RANK_COS} <= 10)
      SELECT query_id, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM r JOIN documents d ON d.doc_id = r.doc_id GROUP BY 1""",
)
def answer_sources(t):
    hits = similarity.top_k(t.embeddings, centroids(t), 10)
    out = similarity.answer_sources(hits, t.documents)
    return out.select("query_id", F.array_join("sources", ",").alias("sources"))


@query(
    "lambda_view",
    """SELECT event_type, count(*) AS calls, round(CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE), 6) AS cost FROM events GROUP BY 1""",
)
def lambda_view(t):
    cut = usage.newest(t.events, "ts") - F.make_dt_interval(F.lit(1))

    def view(rows):
        return rows.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("calls"), F.sum(usage.money(F.col("value"))).alias("cost")
        )

    both = similarity.lambda_view(
        view(t.events.where(F.col("ts") < cut)), view(t.events.where(F.col("ts") >= cut)), ["event_type"], ["calls", "cost"]
    )
    return both.withColumn("cost", usage.usd(F.col("cost")))


TOK = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


@query(
    "bm25_search",
    f"""WITH d AS (SELECT doc_id, source, text, {TOK.format('source')} AS ts, {TOK.format('text')} AS tt FROM documents),
      c AS (SELECT *, len(ts) + len(tt) AS dl, len(list_filter(ts, lambda w: w = 'the')) + 0.1 * len(list_filter(tt, lambda w: w = 'the')) AS a,
        len(list_filter(ts, lambda w: w = 'and')) + 0.1 * len(list_filter(tt, lambda w: w = 'and')) AS b FROM d),
      s AS (SELECT count(*) AS n, avg(dl) AS al, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c)
      SELECT doc_id, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / al)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / al)), 6) AS score
      FROM c, s WHERE a > 0 AND b > 0 AND contains(' ' || array_to_string(tt, ' ') || ' ', ' of the ') AND NOT list_contains(tt, 'for')
      ORDER BY round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / al)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / al)), 9) DESC, doc_id LIMIT 25""",
)
def bm25_search(t):
    docs = t.heavy("documents", "doc_id").select("doc_id", "source", "text")
    hits = search.bm25(docs, {"source": "A", "text": "D"}, ["the", "and"], phrases=["of the"], without=["for"])
    return hits.select("doc_id", F.round("score", 6).alias("score"))


@query(
    "web_search",
    f"""WITH d AS (SELECT doc_id, {TOK.format('source')} AS a, {TOK.format("coalesce(text, '')")} AS b FROM documents),
      w AS (SELECT doc_id, unnest(list_concat(a, b)) AS word, unnest(range(len(a) + len(b))) AS pos, len(a) AS la FROM d),
      n AS (SELECT *, lag(word) OVER o AS before, lag(pos < la) OVER o AS before_a FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
      t AS (SELECT doc_id, pos, CASE WHEN word IN ('the', 'and', 'for', 'with') THEN word END AS term, pos AS first, 0 AS sub, pos < la AS in_a FROM n WHERE word IN ('the', 'and', 'for', 'with')
            UNION ALL SELECT doc_id, pos, 'of the', pos - 1, 1, pos < la FROM n WHERE word = 'the' AND before = 'of' AND before_a = (pos < la)),
      x AS (SELECT *, row_number() OVER o AS nth, sum(CASE WHEN in_a THEN 1.0 ELSE 10.0 END) OVER (o ROWS UNBOUNDED PRECEDING) AS inv,
                   bool_or(term = 'for') OVER (PARTITION BY doc_id) AS has_for FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY pos, sub)),
      l AS (SELECT *, max(CASE WHEN term = 'the' THEN {{'p': first, 'n': nth}} END) OVER o AS s1, max(CASE WHEN term = 'and' THEN {{'p': first, 'n': nth}} END) OVER o AS s2,
                   max(CASE WHEN term = 'of the' THEN {{'p': first, 'n': nth}} END) OVER o AS s3, max(CASE WHEN term = 'with' THEN {{'p': first, 'n': nth}} END) OVER o AS s4
            FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY nth ROWS UNBOUNDED PRECEDING)),
      g AS (SELECT *, CASE WHEN NOT has_for AND s1 IS NOT NULL AND s2 IS NOT NULL THEN least(s1, s2) END AS g1, CASE WHEN s3 IS NOT NULL AND s4 IS NOT NULL THEN least(s3, s4) END AS g2 FROM l),
      b AS (SELECT *, greatest(coalesce(g1, g2), coalesce(g2, g1)) AS beg FROM g),
      f AS (SELECT *, max(beg.p) OVER (PARTITION BY doc_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS begun FROM b),
      c AS (SELECT f.doc_id, (f.nth - f.beg.n + 1) AS entries, f.inv - y.inv + CASE WHEN y.in_a THEN 1.0 ELSE 10.0 END AS inverse, f.pos - f.beg.p + 1 AS width
            FROM f JOIN x y ON y.doc_id = f.doc_id AND y.nth = f.beg.n WHERE f.beg.p > coalesce(f.begun, -1)),
      r AS (SELECT doc_id, round(sum(entries / inverse / (1 + greatest(width - entries, 0))), 9) AS rank FROM c GROUP BY doc_id)
      SELECT doc_id, round(rank, 6) AS rank, (SELECT count(*) FROM r) AS total FROM r ORDER BY r.rank DESC, doc_id LIMIT 25""",
)
def web_search(t):
    """The first page of a search string with a phrase, an alternative and an excluded word."""
    docs = t.heavy("documents", "doc_id").select("doc_id", "source", "text")
    hits = search.web_search(docs, {"source": "A", "text": "D"}, 'the and -for or "of the" with')
    return hits.select("doc_id", F.round("rank", 6).alias("rank"), "total")


def _gram_sql(expr: str) -> str:
    return f"""list_distinct(flatten([[substr('  ' || w || ' ', CAST(i AS INT), 3) FOR i IN generate_series(1, length(w) + 1)] FOR w IN {TOK.format(expr)}]))"""


@query(
    "trigram_match",
    f"""WITH g AS (SELECT p_partkey, p_name, {_gram_sql('p_name')} AS a, {_gram_sql("'smal rings'")} AS b FROM part),
      s AS (SELECT p_partkey, p_name, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS score FROM g)
      SELECT * FROM s WHERE score > 0.3 ORDER BY score DESC, p_partkey LIMIT 10""",
)
def trigram_match(t):
    return search.fuzzy_search(t.part.select("p_partkey", "p_name"), F.col("p_name"), "smal rings", "p_partkey")


# Every document has 64 numbers of length 1, or 0 without a word.
@query(
    "embed",
    r"""SELECT doc_id, 64 AS dims, CASE WHEN regexp_matches(text, '[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length FROM documents""",
)
def embed(t):
    out = similarity.hashed_embedding(t.heavy("documents", "doc_id").select("doc_id", "text"), "text", "vector")
    return out.select("doc_id", F.size("vector").alias("dims"), F.round(vectors.norm(F.col("vector")), 4).alias("length"))


@query(
    "reindex",
    r"""SELECT doc_id, 128 AS dims, CASE WHEN regexp_matches(text, '[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length FROM documents""",
)
def reindex(t):
    """Embed the documents into a first version, re-embed them into the next, and read what is current."""
    root = work_path(t.spark, "vectors")
    docs = t.heavy("documents", "doc_id").select("doc_id", "text")
    sinks.publish(similarity.hashed_embedding(docs, "text", "vector", 64).drop("text"), root)
    sinks.publish(similarity.hashed_embedding(docs, "text", "vector", 128).drop("text"), root)
    current = sinks.read_current(t.spark, root)
    return current.select("doc_id", F.size("vector").alias("dims"), F.round(vectors.norm(F.col("vector")), 4).alias("length"))
