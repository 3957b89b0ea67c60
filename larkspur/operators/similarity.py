"""Vector top-k over tables of queries, and what is built on it.

The scores are block matrix products inside Arrow batches; Spark spreads and
merges them. The smaller side is shipped to every task only when its size was
found to be within a limit. When neither side is small both are cut into blocks and each pair of
blocks is one task, so nothing grows with the data but the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import let
from larkspur.functions.vectors import SCORE_DIGITS, norm
from larkspur.operators.ordered import first_n

# Bytes of vectors (rows x dimensions x 8) that one side may have to be shipped to every task,
# and that a block of queries or of the corpus holds where neither side is that small.
SHIP_BYTES = 100 << 20
QUERY_BLOCK_BYTES = 32 << 20
CORPUS_BLOCK_BYTES = 64 << 20
# Scores and queries of one matrix product, rows of the first one, and rows that a task has at least when queries are shipped.
CELLS = 4_000_000
QUERY_STEP = 1024
FIRST_ROWS = 256
TASK_ROWS = 8192


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _raw(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Scores before rounding."""
    if metric == "cosine":
        return _directions(queries) @ _directions(rows).T
    if metric == "l2sq":
        distance = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :] - 2 * queries @ rows.T
        return 1.0 - np.maximum(distance, 0.0)
    raise ValueError(f"metric: {metric}")


def _directions(vectors: np.ndarray) -> np.ndarray:
    """The vectors in length 1; zero where the length is 0 or unknown."""
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    known = np.broadcast_to(lengths > 0, vectors.shape)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=known)


def _scores(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    return np.round(_raw(queries, rows, metric), SCORE_DIGITS)


class _Best:
    """The k best (query, id, score) triples of ``n`` queries seen so far, ties by id."""

    def __init__(self, k: int, at_least: float | None, n: int):
        self.k, self.at_least = k, at_least
        self.query = np.empty(0, np.int64)
        self.row_id = None
        self.score = np.empty(0)
        self.edge = np.full(n, -np.inf)  # the k-th best score of a query that has k

    def add(self, raw: np.ndarray, ids: np.ndarray) -> None:
        """Scores before rounding; only those that can be among the best are rounded and sorted."""
        if raw.size == 0:
            return
        if raw.shape[1] > self.k:
            edge = self.edge
            if np.isneginf(edge).any():
                edge = np.maximum(edge, -np.partition(-raw, self.k - 1, axis=1)[:, self.k - 1])
            q, r = np.nonzero(raw >= (edge - 10.0**-SCORE_DIGITS)[:, None])
        else:
            q, r = np.nonzero(np.ones_like(raw, dtype=bool))
        scores = np.round(raw[q, r], SCORE_DIGITS)
        if self.at_least is not None:
            enough = scores >= self.at_least
            q, r, scores = q[enough], r[enough], scores[enough]
        if not len(q):
            return
        query = np.concatenate([self.query, q])
        row_id = ids[r] if self.row_id is None else np.concatenate([self.row_id, ids[r]])
        score = np.concatenate([self.score, scores])
        order = np.lexsort((row_id, -score, query))
        query, row_id, score = query[order], row_id[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        top, last = place < self.k, place == self.k - 1
        self.query, self.row_id, self.score = query[top], row_id[top], score[top]
        self.edge[query[last]] = np.where(np.isnan(score[last]), -np.inf, score[last])

    def result(self, query_ids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
        ids = self.row_id if self.row_id is not None else np.empty(0, np.int64)
        columns = [query_ids[self.query], ids, self.score]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


class _Search:
    """Queries, in blocks, against rows that come bit by bit."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, at_least: float | None, metric: str):
        self.metric = metric
        cuts = [slice(at, at + QUERY_STEP) for at in range(0, len(queries), QUERY_STEP)]
        self.blocks = [(query_ids[c], queries[c], _Best(k, at_least, len(queries[c]))) for c in cuts]

    def scan(self, rows: np.ndarray, ids: np.ndarray) -> None:
        for _, queries, best in self.blocks:
            most, at = max(1, CELLS // len(queries)), 0
            # A few rows first: what they leave out of the rest need not be sorted.
            step = min(most, max(FIRST_ROWS, 8 * best.k)) if np.isneginf(best.edge).any() else most
            while at < len(rows):
                best.add(_raw(queries, rows[at : at + step], self.metric), ids[at : at + step])
                at, step = at + step, min(most, 4 * step)

    def results(self, schema: pa.Schema) -> list[pa.RecordBatch]:
        return [best.result(query_ids, schema) for query_ids, _, best in self.blocks]


def _vectors(df: DataFrame, id_col: str, vec_col: str, id_as: str, vec_as: str) -> DataFrame:
    """Id and vector; rows without a vector are skipped."""
    return df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).select(
        F.col(id_col).alias(id_as), F.col(vec_col).cast("array<double>").alias(vec_as)
    )


def _bytes(df: DataFrame, vec_col: str) -> int:
    """Bytes of the vectors as doubles, counted without fetching any."""
    return 8 * (df.agg(F.sum(F.size(vec_col).cast("bigint")).alias("n")).first()["n"] or 0)


def _small(df: DataFrame, vec_col: str) -> pa.Table | None:
    """The frame as a local table if its vectors are within ``SHIP_BYTES``, else None."""
    return df.toArrow() if _bytes(df, vec_col) <= SHIP_BYTES else None


def _out_schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_id", corpus.schema["doc_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def top_k(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    at_least: float | None = None,
) -> DataFrame:
    """The k best rows of ``corpus`` per query as (query_id, doc_id, score, rank).

    ``cosine`` is 0 where a norm is 0; ``l2sq`` scores 1 - squared distance. Equal
    scores rank by id. ``at_least`` drops lower scores before ranking.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    q = _vectors(queries, query_id, query_vec, "query_id", "query_vec")
    c = _vectors(corpus, id_col, vec_col, "doc_id", "doc_vec")
    out = _out_schema(q, c)
    arrow = to_arrow_schema(out)
    spark = corpus.sparkSession
    ranked = [F.desc("score"), F.col("doc_id")]

    local = _small(q, "query_vec")
    if local is not None:
        shipped = spark.sparkContext.broadcast((local["query_id"].to_numpy(), _matrix(local["query_vec"])))

        def scan_corpus(batches):
            search = _Search(*shipped.value, k, at_least, metric)
            for batch in batches:
                if len(batch):
                    search.scan(_matrix(batch["doc_vec"]), batch["doc_id"].to_numpy(zero_copy_only=False))
            yield from search.results(arrow)

        found = _dealt(c, len(local)).mapInArrow(scan_corpus, out)
    else:
        local = _small(c, "doc_vec")
        if local is not None:
            shipped = spark.sparkContext.broadcast((local["doc_id"].to_numpy(), _matrix(local["doc_vec"])))

            def scan_queries(batches):
                ids, vectors = shipped.value
                for batch in batches:
                    if len(batch) and len(vectors):
                        search = _Search(batch["query_id"].to_numpy(zero_copy_only=False), _matrix(batch["query_vec"]), k, at_least, metric)
                        search.scan(vectors, ids)
                        yield from search.results(arrow)

            found = q.mapInArrow(scan_queries, out)
        else:
            found = _grid(c, q, k, metric, at_least, out, arrow)
    return first_n(found, ["query_id"], ranked, k, rank="rank")


def _dealt(c: DataFrame, asked: int) -> DataFrame:
    """The corpus over all cores, if there is more to multiply than one product makes and its files give fewer tasks than cores.

    A task puts out k rows per query, so it has ``TASK_ROWS`` rows or more.
    """
    want = c.sparkSession.sparkContext.defaultParallelism
    if c.rdd.getNumPartitions() >= want:
        return c
    rows = c.count()
    tasks = min(3 * want, rows // TASK_ROWS)
    return c.repartition(tasks, "doc_id") if tasks > c.rdd.getNumPartitions() and rows * asked > CELLS else c


def _grid(c: DataFrame, q: DataFrame, k: int, metric: str, at_least, out: T.StructType, arrow: pa.Schema) -> DataFrame:
    """Blocks of queries against blocks of the corpus, one task per pair."""
    q_blocks = -(-_bytes(q, "query_vec") // QUERY_BLOCK_BYTES)
    c_blocks = -(-_bytes(c, "doc_vec") // CORPUS_BLOCK_BYTES)

    def spread(df, id_col, own, own_n, other, other_n):
        block = F.pmod(F.xxhash64(id_col), F.lit(own_n)).cast("int")
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))))

    left = spread(c, "doc_id", "cb", c_blocks, "qb", q_blocks).groupBy("qb", "cb")
    right = spread(q, "query_id", "qb", q_blocks, "cb", c_blocks).groupBy("qb", "cb")

    def block(rows: pa.Table, asked: pa.Table) -> pa.Table:
        search = _Search(asked["query_id"].to_numpy(), _matrix(asked["query_vec"]), k, at_least, metric)
        if len(rows) and len(asked):
            search.scan(_matrix(rows["doc_vec"]), rows["doc_id"].to_numpy())
        return pa.Table.from_batches(search.results(arrow), arrow)

    return left.cogroup(right).applyInArrow(block, out)


def cluster_cells(corpus: DataFrame, cells: int, vec_col: str = "embedding", seed: int = 7):
    """Add ``cell`` from a distributed k-means; returns (corpus with cell, cell centres)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    featured = corpus.withColumn("__v", array_to_vector(F.col(vec_col).cast("array<double>")))
    model = KMeans(k=cells, seed=seed, featuresCol="__v", predictionCol="cell", maxIter=10).fit(featured)
    return model.transform(featured).drop("__v"), np.array(model.clusterCenters())


def _unit(vector: Column) -> Column:
    """The vector in double precision, of length 1; a zero vector stays."""
    v = vector.cast("array<double>")
    return let(norm(v), lambda size: F.transform(v, lambda x: F.when(size > 0, x / size).otherwise(x)))


def write_cells(corpus: DataFrame, cells: int, root: str, vec_col: str = "embedding", seed: int = 7) -> None:
    """Keep an approximate index as a table: vectors in a partition per cell, and the cells' centres beside them.

    Fits the cells once, on the directions of the vectors; searches and later additions read the centres.
    """
    known = corpus.where(F.col(vec_col).isNotNull()).withColumn("__unit", _unit(F.col(vec_col)))
    celled, centres = cluster_cells(known, cells, "__unit", seed)
    celled.drop("__unit").write.partitionBy("cell").parquet(f"{root}/rows")
    rows = [(i, c.tolist()) for i, c in enumerate(centres)]
    corpus.sparkSession.createDataFrame(rows, "cell int, centre array<double>").coalesce(1).write.parquet(f"{root}/centres")


def _centres(spark: SparkSession, root: str) -> np.ndarray:
    rows = sorted((r["cell"], r["centre"]) for r in spark.read.parquet(f"{root}/centres").collect())  # as many as cells
    return np.array([c for _, c in rows])


def add_to_cells(new: DataFrame, root: str, vec_col: str = "embedding") -> None:
    """Put further vectors into the cells of their nearest centres, without a new fit. Null vectors are left out."""
    centres = _centres(new.sparkSession, root)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(len(batch), np.int32)
            if len(batch):
                vectors = _matrix(batch[vec_col])
                length = np.linalg.norm(vectors, axis=1, keepdims=True)
                cell = _scores(vectors / np.where(length > 0, length, 1), centres, "l2sq").argmax(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    known = new.where(F.col(vec_col).isNotNull())
    schema = T.StructType([*known.schema.fields, T.StructField("cell", T.IntegerType())])
    known.mapInArrow(placed, schema).write.mode("append").partitionBy("cell").parquet(f"{root}/rows")


def search_cells(
    spark: SparkSession, root: str, queries: DataFrame, k: int, probes: int, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Cosine top-k in the kept cells; files of cells that no query probes are not read."""
    asked = queries.withColumn("query_vec", _unit(F.col("query_vec")))
    return top_k_approx(spark.read.parquet(f"{root}/rows"), _centres(spark, root), asked, k, probes, id_col, vec_col)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of the exact (query_id, doc_id) pairs that were found, and how many there are."""
    keys = ["query_id", "doc_id"]
    marked = exact.select(keys).join(found.select(*keys, F.lit(True).alias("hit")), keys, "left")
    return marked.agg(F.avg(F.coalesce("hit", F.lit(False)).cast("int")).alias("recall"), F.count(F.lit(1)).alias("wanted"))


def top_k_approx(
    corpus: DataFrame, centres: np.ndarray, queries: DataFrame, k: int, probes: int, id_col="vec_id", vec_col="embedding"
) -> DataFrame:
    """Cosine top-k looking only into the ``probes`` cells nearest each query.

    A task multiplies the rows of a cell with the queries that probe it, so a hot
    cell is spread over as many tasks as its files. Any number of queries: they are
    shipped in blocks within ``SHIP_BYTES``, each with a scan of the cells it probes.
    """
    q = _vectors(queries, "query_id", "query_vec", "query_id", "query_vec")
    # Twice the blocks that would do, as a hash does not deal them out evenly.
    blocks = -(-2 * _bytes(q, "query_vec") // SHIP_BYTES) if _bytes(q, "query_vec") > SHIP_BYTES else 1
    found = None
    for b in range(blocks):
        part = q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b) if blocks > 1 else q
        hits = _probe(corpus, centres, part, k, probes, id_col, vec_col)
        found = hits if found is None else found.unionByName(hits)
    return first_n(found, ["query_id"], [F.desc("score"), F.col("doc_id")], k, rank="rank")


def _probe(corpus: DataFrame, centres: np.ndarray, q: DataFrame, k: int, probes: int, id_col: str, vec_col: str) -> DataFrame:
    """The k best of every batch of a cell for each query of one block."""
    from pyspark.sql.pandas.types import to_arrow_schema

    local = q.toArrow()
    vectors = _matrix(local["query_vec"])
    near = np.argsort(-_scores(vectors, centres, "l2sq"), axis=1, kind="stable")[:, :probes]
    shipped = corpus.sparkSession.sparkContext.broadcast((local["query_id"].to_numpy(), vectors, near))
    rows = corpus.select(
        F.col(id_col).alias("doc_id"), F.col(vec_col).cast("array<double>").alias("doc_vec"), F.col("cell")
    ).where(F.col("cell").isin([int(x) for x in np.unique(near)]))
    out = _out_schema(q, rows)
    arrow = to_arrow_schema(out)

    def scan(batches):
        query_ids, asked, probed = shipped.value
        for batch in batches:
            cells = batch["cell"].to_numpy()
            ids, vecs = batch["doc_id"].to_numpy(zero_copy_only=False), _matrix(batch["doc_vec"])
            for cell in np.unique(cells):
                who = np.nonzero((probed == cell).any(axis=1))[0]
                here = np.nonzero(cells == cell)[0]
                if len(who):
                    search = _Search(query_ids[who], asked[who], k, None, "cosine")
                    search.scan(vecs[here], ids[here])
                    yield from search.results(arrow)

    return rows.mapInArrow(scan, out)


def rerank(candidates: DataFrame, scores: DataFrame, k: int, keys=("query_id", "doc_id")) -> DataFrame:
    """Replace scores by external ones (missing = 0.0) and keep the k best; ties stay in candidate order."""
    joined = candidates.drop("score").join(scores.select(*keys, "score"), list(keys), "left")
    scored = joined.withColumn("score", F.coalesce("score", F.lit(0.0))).withColumnRenamed("rank", "__was")
    return first_n(scored, ["query_id"], [F.desc("score"), F.col("__was")], k, rank="rank").drop("__was")


def by_score(rows: DataFrame, k: int) -> DataFrame:
    return first_n(rows, ["query_id"], [F.desc("score"), F.col("doc_id")], k, rank="rank")


def multi_query_union(results: DataFrame, question: str, ordinal: str, keep: str = "first") -> DataFrame:
    """Union of several queries' hits per question; a document keeps the score of the first query that found it.

    ``keep="best"`` keeps the highest instead.
    """
    value = F.min_by("score", ordinal) if keep == "first" else F.max("score")
    return results.groupBy(question, "doc_id").agg(value.alias("score"))


def hybrid_merge(results: DataFrame, ordinal: str) -> DataFrame:
    """Fold repeated scores as (so far + new) / 2 in retriever order; a document has one score per retriever."""
    held = results.groupBy("query_id", "doc_id").agg(F.array_sort(F.collect_list(F.struct(ordinal, "score"))).alias("s"))
    folded = F.aggregate(
        F.slice("s", F.lit(2), F.size("s")), F.col("s")[0]["score"], lambda acc, x: (acc + x["score"]) / 2
    )
    return held.select("query_id", "doc_id", folded.alias("score"))


def adaptive(tiers: list[tuple[str, DataFrame]], k: int, threshold: float = 0.7) -> DataFrame:
    """First tier whose k best hits average at least ``threshold``, else the last one.

    A tier adds its hits to those before it; a repeated document keeps its first
    score. Columns: query_id, doc_id, score.
    """
    pool = None
    for level, (_, frame) in enumerate(tiers):
        part = frame.select("query_id", "doc_id", "score").withColumn("level", F.lit(level))
        pool = part if pool is None else pool.unionByName(part)
    firsts = pool.groupBy("query_id", "doc_id").agg(F.min_by("score", "level").alias("score"), F.min("level").alias("level"))
    # A hit of level l belongs to the pool of every tier from l on.
    per_tier = firsts.withColumn("tier", F.explode(F.sequence(F.col("level"), F.lit(len(tiers) - 1))))
    best = first_n(per_tier, ["query_id", "tier"], [F.desc("score"), F.col("doc_id")], k, rank="rank")
    means = best.groupBy("query_id", "tier").agg(F.avg("score").alias("mean_score"))
    good = F.when(F.col("mean_score") >= threshold, F.col("tier"))
    chosen = means.groupBy("query_id").agg(F.coalesce(F.min(good), F.lit(len(tiers) - 1)).alias("tier"))
    names = F.array(*[F.lit(name) for name, _ in tiers])
    return (
        best.join(chosen, ["query_id", "tier"])
        .join(means, ["query_id", "tier"])
        .select("query_id", "doc_id", "score", "rank", "mean_score", F.element_at(names, F.col("tier") + 1).alias("strategy"))
    )


def cache_lookup(best: DataFrame, answers: DataFrame, as_of: Column, ttl: Column, at_least: float) -> DataFrame:
    """Answer of the best match when similar enough and not expired, else a miss.

    ``best``: query_id, doc_id, score. ``answers``: doc_id, answer, created_at.
    """
    live = answers.where(F.col("created_at") >= as_of - ttl)
    close = F.coalesce(F.col("score") >= at_least, F.lit(False))
    # One pass: misses by score stay in the join under their own key, where the condition finds them nothing.
    looked = best.join(live.withColumnRenamed("doc_id", "__doc"), (F.col("doc_id") == F.col("__doc")) & close, "left")
    return looked.select("query_id", "answer", "score").withColumn("hit", F.col("answer").isNotNull())


def cache_stats(lookups: DataFrame, saved_per_hit: float = 0.0001) -> DataFrame:
    hits, n = F.count_if("hit"), F.count(F.lit(1))
    return lookups.agg(
        hits.alias("hits"),
        (n - hits).alias("misses"),
        F.round(F.coalesce(F.try_divide(hits, n), F.lit(0.0)), 6).alias("hit_rate"),
        F.round(hits * saved_per_hit, 6).alias("cost_saved"),
    )


def request_key(prompt: Column, model: Column, temperature: Column, max_tokens: Column) -> Column:
    """SHA-256 of the request's fields as JSON in name order."""
    fields = F.struct(
        max_tokens.alias("max_tokens"), model.alias("model"), prompt.alias("prompt"), temperature.alias("temperature")
    )
    return F.sha2(F.to_json(fields), 256)


def exact_cache_lookup(requests: DataFrame, cached: DataFrame, as_of: Column, ttl: Column) -> DataFrame:
    """Join requests of temperature 0 to unexpired cached responses by key; one response per key."""
    live = cached.where(F.col("created_at") >= as_of - ttl).groupBy("key").agg(
        F.max_by("response", "created_at").alias("response")
    )
    fixed = F.coalesce(F.col("temperature"), F.lit(0.0)) == 0
    looked = requests.where(fixed).join(live, "key", "left").select(*requests.columns, "response")
    others = requests.where(~fixed).withColumn("response", F.lit(None).cast("string"))
    return looked.unionByName(others).withColumn("hit", F.col("response").isNotNull())


def answer_sources(hits: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct sources of each answer's top-k documents, sorted."""
    joined = hits.join(sources.select("doc_id", "source"), "doc_id")
    return joined.groupBy("query_id").agg(F.sort_array(F.collect_set("source")).alias("sources"))


def lambda_view(batch: DataFrame, recent: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Batch view and recent view served as one, re-aggregated by key."""
    return batch.unionByName(recent).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def hashed_embedding(df: DataFrame, text: str, out: str, dims: int = 64) -> DataFrame:
    """Default embedder: hashed word counts scaled to length 1, on the JVM."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    from larkspur.functions.text import words

    tokens = df.withColumn("__w", words(F.lower(F.col(text))))
    counted = HashingTF(numFeatures=dims, inputCol="__w", outputCol="__tf").transform(tokens)
    scaled = Normalizer(inputCol="__tf", outputCol="__n").transform(counted)
    return scaled.withColumn(out, vector_to_array("__n", "float32")).drop("__w", "__tf", "__n")


def embed_with(df: DataFrame, text: str, out: str, load) -> DataFrame:
    """Embed with a model that ``load()`` builds once per Python worker; texts arrive in Arrow batches."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            yield pd.Series(list(model(texts)))

    return df.withColumn(out, run(F.col(text)))
