"""Chunking, context, memory and text-function queries."""

from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.operators import chunks, context, governance, ordered
from larkspur.plans.quality import WS, strip_sql
from larkspur.plans.registry import query
from larkspur.session import work_path
from larkspur.sources import files, sinks
from larkspur.sources.sinks import upsert_by_key

CHUNKED = """WITH ch AS (SELECT doc_id, source, CAST(i AS INT) AS chunk_index, CAST(i * {step} AS INT) AS chunk_start,
    substr(text, i * {step} + 1, {size}) AS chunk
  FROM documents, unnest(generate_series(0, (length(text) - 1) // {step})) AS g(i) WHERE length(text) > 0 {where})"""


def chunked_sql(size=1000, overlap=200, where=""):
    return CHUNKED.format(size=size, step=size - overlap, where=where)


@query("chunk_fixed", f"{chunked_sql()} SELECT doc_id, chunk_index, chunk_start, md5(chunk) AS chunk_md5 FROM ch")
def chunk_fixed(t):
    out = chunks.chunk_fixed(t.documents.select("doc_id", "text"), "text")
    return out.select("doc_id", "chunk_index", "chunk_start", F.md5("chunk").alias("chunk_md5"))


@query(
    "chunk_ids",
    f"""{chunked_sql(500, 0)} SELECT substr(sha256(chunk), 1, 16) AS chunk_id, doc_id || '_chunk_' || chunk_index AS chunk_name,
      md5(chunk) AS query_id FROM ch""",
)
def chunk_ids(t):
    out = chunks.chunk_fixed(t.heavy("documents", "doc_id").select("doc_id", "text"), "text", 500, 0)
    return out.select(
        tx.content_id(F.col("chunk")).alias("chunk_id"),
        F.format_string("%s_chunk_%s", F.col("doc_id"), F.col("chunk_index")).alias("chunk_name"),
        F.md5("chunk").alias("query_id"),
    )


@query(
    "ingest_documents",
    f"""{chunked_sql(where=f"AND length({strip_sql('text')}) > 0")}
      SELECT substr(sha256(chunk), 1, 16) AS chunk_id, doc_id, chunk_index, CAST(length(chunk) AS INT) AS n FROM ch
      QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY doc_id DESC, chunk_index DESC) = 1""",
)
def ingest_documents(t):
    fresh = chunks.ingest(t.heavy("documents", "doc_id").select("doc_id", "source", "text"), "text", "source")
    fresh = fresh.select("chunk_id", "doc_id", "chunk_index", F.length("chunk").alias("n"))
    store = fresh.where(F.lit(False))
    return upsert_by_key(store, fresh, "chunk_id", [F.desc("doc_id"), F.desc("chunk_index")])


@query(
    "ingest_corpus",
    f"""WITH t AS (SELECT item_id, {strip_sql("coalesce(text, '')")} AS text FROM benchmark),
      ch AS (SELECT item_id, CAST(i AS INT) AS chunk_index, substr(text, i * 80 + 1, 100) AS chunk FROM t, unnest(generate_series(0, (length(text) - 1) // 80)) AS g(i) WHERE length(text) > 0)
      SELECT substr(sha256(chunk), 1, 16) AS chunk_id, item_id, chunk_index FROM ch QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY item_id DESC, chunk_index DESC) = 1""",
)
def ingest_corpus(t):
    """Benchmark items as text files, scanned, stripped, cut, named and upserted into a keyed table: one run from files to the index."""
    base = work_path(t.spark, "corpus")
    t.benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("value")).write.partitionBy("item_id").text(f"{base}/files")
    good, _ = files.read_corpus(t.spark, f"{base}/files", "*.txt")
    item = F.regexp_extract("path", "item_id=([0-9]+)/", 1).cast("bigint").alias("item_id")
    docs = good.select(item, tx.strip(F.col("text")).alias("text"), F.lit("corpus").alias("source"))
    rows = chunks.ingest(docs, "text", "source", 100, 20).select("chunk_id", "item_id", "chunk_index")
    return sinks.silver_merge(t.spark, rows, f"{base}/index", "chunk_id", [F.desc("item_id"), F.desc("chunk_index")])


@query(
    "chunk_sentence",
    """WITH RECURSIVE c AS (
        SELECT doc_id, text, 0 AS start, CASE WHEN 500 < length(text) AND 500 - instr(reverse(substr(text, 1, 500)), '.') > 250
            AND instr(reverse(substr(text, 1, 500)), '.') > 0 THEN 500 - instr(reverse(substr(text, 1, 500)), '.') + 1 ELSE 500 END AS stop, 0 AS i
        FROM documents WHERE length(text) > 0
        UNION ALL
        SELECT doc_id, text, stop - 50, CASE WHEN stop + 450 < length(text) AND 500 - instr(reverse(substr(text, stop - 49, 500)), '.') > 250
            AND instr(reverse(substr(text, stop - 49, 500)), '.') > 0 THEN stop - 50 + 500 - instr(reverse(substr(text, stop - 49, 500)), '.') + 1 ELSE stop + 450 END, i + 1
        FROM c WHERE stop - 50 < length(text))
      SELECT doc_id, i AS chunk_index, CAST(start AS INT) AS chunk_start, md5("""
    + strip_sql("substr(text, start + 1, stop - start)")
    + """) AS chunk_md5 FROM c""",
)
def chunk_sentence(t):
    out = chunks.chunk_sentence(t.heavy("documents", "doc_id").select("doc_id", "text"), "text")
    return out.select("doc_id", "chunk_index", "chunk_start", F.md5("chunk").alias("chunk_md5"))


@query("chunk_recursive_rebuilt", "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE length(text) > 0")
def chunk_recursive_rebuilt(t):
    """Without overlap the chunks put together are the text."""
    out = chunks.chunk_recursive(t.heavy("documents", "doc_id").select("doc_id", "text"), "text", F.lit("faq"))
    parts = F.array_sort(F.collect_list(F.struct("chunk_index", "chunk")))
    return out.groupBy("doc_id").agg(F.md5(F.array_join(F.transform(parts, lambda p: p["chunk"]), "")).alias("text_md5"))


@query("chunk_recursive")
def chunk_recursive(t):
    kind = F.when(F.col("lang") == "en", "plain_text").when(F.col("lang") == "fr", "legal").otherwise("default")
    out = chunks.chunk_recursive(t.heavy("documents", "doc_id").select("doc_id", "lang", "text"), "text", kind)
    return out.groupBy("lang").agg(
        F.count(F.lit(1)).alias("chunks"), F.max(F.length("chunk")).alias("longest"), F.sum(F.length("chunk")).alias("chars")
    )


@query(
    "chunk_markdown",
    f"""WITH s AS (SELECT doc_id, unnest(string_split(body, chr(1))) AS s, generate_subscripts(string_split(body, chr(1)), 1) - 1 AS i
        FROM (SELECT doc_id, regexp_replace('# Doc ' || doc_id || chr(10) || replace(text, chr(10), chr(10) || '## Part' || chr(10)), '(?m)^(#{{1,3}} )', chr(1) || '\\1', 'g') AS body FROM documents))
      SELECT doc_id, nullif(regexp_extract(s, '^#{{1,3}} +([^\\r\\n]*)', 1), '') AS header, count(*) AS sections,
        CAST(sum(length({strip_sql("regexp_replace(s, '^#{1,3} [^\\r\\n]*', '')")})) AS BIGINT) AS chars
      FROM s WHERE length({strip_sql('s')}) > 0 GROUP BY 1, 2""",
)
def chunk_markdown(t):
    marked = F.concat(
        F.lit("# Doc "), F.col("doc_id").cast("string"), F.lit("\n"), F.replace("text", F.lit("\n"), F.lit("\n## Part\n"))
    )
    out = chunks.chunk_markdown(t.heavy("documents", "doc_id").select("doc_id", marked.alias("body")), "body")
    return out.groupBy("doc_id", "header").agg(
        F.count(F.lit(1)).alias("sections"), F.sum(F.length("chunk")).alias("chars")
    )


@query(
    "chunk_size_compare",
    """SELECT doc_id, size AS chunk_size, CAST(i AS INT) AS chunk_index, md5(substr(text, i * size + 1, size)) AS chunk_md5
      FROM documents, (SELECT unnest([256, 512, 1024]) AS size), (SELECT unnest([0, 1, 2]) AS i) WHERE i * size < length(text)""",
)
def chunk_size_compare(t):
    out = chunks.compare_sizes(t.documents.select("doc_id", "text"), "text")
    return out.select("doc_id", "chunk_size", "chunk_index", F.md5("chunk").alias("chunk_md5"))


@query(
    "token_estimate",
    """SELECT conv_id, turn, CAST(greatest(1, length(text) // 4) AS INT) AS tokens, CAST(length(text) // 4 AS INT) AS tokens_floor0 FROM conversations""",
)
def token_estimate(t):
    return t.conversations.select(
        "conv_id", "turn", tx.token_estimate(F.col("text")).alias("tokens"),
        tx.token_estimate(F.col("text"), 0).alias("tokens_floor0"),
    )


SUMMARY = """list_sort([{'k': -(length(s) + 50 * len(regexp_extract_all(lower(s), 'important'))), 'i': i, 's': s} FOR s, i IN string_split(text, '. ')])"""


@query(
    "extractive_summary",
    f"""SELECT doc_id, md5(array_to_string([x.s FOR x IN ({SUMMARY})[1:3]], '. ') || '.') AS summary_md5 FROM documents""",
)
def extractive_summary(t):
    return t.heavy("documents", "doc_id").select("doc_id", F.md5(context.extractive_summary(F.col("text"))).alias("summary_md5"))


@query(
    "compression_ratio",
    f"""SELECT doc_id, CASE WHEN length(text) // 4 > 0 THEN round((length(array_to_string([x.s FOR x IN ({SUMMARY})[1:3]], '. ') || '.') // 4) / (length(text) // 4), 6) ELSE 0 END AS ratio
      FROM documents""",
)
def compression_ratio(t):
    short = t.heavy("documents", "doc_id").select("doc_id", "text", context.extractive_summary(F.col("text")).alias("short"))
    return short.select("doc_id", F.round(tx.compression_ratio(F.col("text"), F.col("short")), 6).alias("ratio"))


@query(
    "word_jaccard",
    rf"""WITH w AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(lower(text), '{WS}'), lambda x: x <> '')) AS ws FROM conversations)
      SELECT a.conv_id, a.turn, round(coalesce(len(list_intersect(a.ws, b.ws)) / nullif(len(list_distinct(list_concat(a.ws, b.ws))), 0), 0), 6) AS similarity
      FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
)
def word_jaccard(t):
    left = t.conversations.select("conv_id", "turn", F.col("text").alias("a"))
    right = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    return left.join(right, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.round(tx.word_jaccard(F.col("a"), F.col("b")), 6).alias("similarity")
    )


@query(
    "pseudonymize",
    """SELECT event_id, sha256(user_id || 'pepper') AS user_hash, substr(sha256(props), 1, 16) AS input_hash,
      substr(props, 1, 500) AS summary FROM events""",
)
def pseudonymize(t):
    return t.events.select(
        "event_id",
        governance.pseudonym(F.col("user_id"), "pepper").alias("user_hash"),
        governance.input_digest(F.col("props")).alias("input_hash"),
        F.substring("props", 1, 500).alias("summary"),
    )


@query(
    "ab_assign",
    """WITH b AS (SELECT c_custkey, CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS bucket FROM customer)
      SELECT c_custkey, bucket, CASE WHEN bucket < 50 THEN 'control' WHEN bucket < 80 THEN 'v2' ELSE 'v3' END AS version FROM b""",
)
def ab_assign(t):
    b = t.customer.select("c_custkey", tx.bucket_100(F.col("c_custkey")).alias("bucket"))
    return b.withColumn(
        "version", F.when(F.col("bucket") < 50, "control").when(F.col("bucket") < 80, "v2").otherwise("v3")
    )


ENTITIES = """WITH p AS (SELECT html, regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article>', 1) AS article, regexp_extract(html, '(?is)<body\\b[^>]*>(.*)</body>', 1) AS body, page_id FROM pages),
  a AS (SELECT page_id, CASE WHEN article <> '' THEN article WHEN body <> '' THEN body ELSE html END AS x FROM p),
  b AS (SELECT page_id, regexp_replace(x, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'g') AS x FROM a),
  c AS (SELECT page_id, regexp_replace(regexp_replace(x, '(?i)<br\\s*/?>|</?(p|div|h[1-6]|li|ul|ol|tr|table|section)\\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS x FROM b),
  d AS (SELECT page_id, replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS x FROM c)"""


@query(
    "page_text",
    f"""{ENTITIES} SELECT page_id, md5(y) AS text_md5, CAST(length(y) AS INT) AS n FROM (
      SELECT page_id, {strip_sql("regexp_replace(regexp_replace(x, '[ \\t]+', ' ', 'g'), '[\\s\\x{0b}]*\\n[\\s\\x{0b}]*', chr(10), 'g')")} AS y FROM d)""",
)
def page_text(t):
    return t.heavy("pages", "page_id").select("page_id", chunks.page_text(F.col("html")).alias("y")).select(
        "page_id", F.md5("y").alias("text_md5"), F.length("y").alias("n")
    )


TOP_DOCS = """WITH r AS (SELECT doc_id, source, lang, text, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents)"""


def _longest(t, k):
    docs = t.documents.select("doc_id", "source", "lang", "n_chars", "text")
    return ordered.first_n(docs, ["source"], [F.desc("n_chars"), F.col("doc_id")], k, rank="rank")


@query(
    "build_context",
    f"""{TOP_DOCS} SELECT source, md5(string_agg('[Source: ' || doc_id || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank)) AS sourced_md5,
        md5(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS plain_md5,
        md5(string_agg('[' || rank || ']: ' || text, chr(10) || chr(10) ORDER BY rank)) AS numbered_md5
      FROM r WHERE rank <= 5 GROUP BY 1""",
)
def build_context(t):
    top = _longest(t, 5)
    text = F.col("text")
    forms = {
        "sourced_md5": (F.concat(F.lit("[Source: "), F.col("doc_id").cast("string"), F.lit("]\n"), text), "\n\n"),
        "plain_md5": (text, "\n\n---\n\n"),
        "numbered_md5": (F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("]: "), text), "\n\n"),
    }
    ranked = F.array_sort(F.collect_list(F.struct("rank", *[p.alias(n) for n, (p, _) in forms.items()])))
    joined = [
        F.md5(F.array_join(F.col(f"p.{n}"), sep)).alias(n)
        for n, (_, sep) in forms.items()
    ]
    return top.groupBy("source").agg(ranked.alias("p")).select("source", *joined)


@query(
    "prompt_batch",
    f"""{TOP_DOCS}, c AS (SELECT source, string_agg('[Source: ' || doc_id || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS ctx FROM r WHERE rank <= 3 GROUP BY 1)
      SELECT source, md5(replace(replace('{context.ANSWER_PROMPT.replace("'", "''")}', '{{question}}', 'What does ' || source || ' say?'), '{{context}}', ctx)) AS prompt_md5 FROM c""",
)
def prompt_batch(t):
    piece = F.concat(F.lit("[Source: "), F.col("doc_id").cast("string"), F.lit("]\n"), F.col("text"))
    contexts = context.build_context(_longest(t, 3), "source", "rank", piece, "\n\n")
    question = F.concat(F.lit("What does "), F.col("source"), F.lit(" say?"))
    return context.prompt_batch(contexts, question).select("source", F.md5("prompt").alias("prompt_md5"))


PACK = """WITH r AS (SELECT doc_id, source, chr(10) || '---' || chr(10) || text AS piece, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rank FROM documents),
  tk AS (SELECT *, greatest(1, length(piece) // 4) AS tk FROM r),
  u AS (SELECT *, sum(tk) OVER (PARTITION BY source ORDER BY rank) AS upto, 1500 - 6 - 8 AS room FROM tk),
  k AS (SELECT source, doc_id, rank, upto > room AS is_cut, CASE WHEN upto <= room THEN piece ELSE substr(piece, 1, CAST((room - upto + tk) * 4 AS BIGINT)) END AS piece
    FROM u WHERE upto <= room OR (upto - tk <= room AND room - (upto - tk) > 10))"""
QUESTION, SYSTEM = "What is new?", "Answer from the documents below."


@query(
    "pack_context",
    f"""{PACK} SELECT source, doc_id, rank, is_cut, CAST(greatest(1, length(piece) // 4) AS INT) AS tokens, md5(piece) AS piece_md5 FROM k""",
)
def pack_context(t):
    return _packed(t).select("source", "doc_id", F.col("rank").cast("bigint").alias("rank"), "is_cut", "tokens", F.md5("piece").alias("piece_md5"))


def _packed(t):
    docs = t.documents.select("doc_id", "source", "n_chars", "text")
    return context.pack_context(docs, "source", [F.col("n_chars"), F.col("doc_id")], "text", 1500, QUESTION, SYSTEM)


@query(
    "assembled_prompt",
    f"""{PACK} SELECT source, md5('{SYSTEM}' || chr(10) || chr(10) || 'Context:' || chr(10) || string_agg(piece, chr(10) ORDER BY rank) || chr(10) || chr(10) || 'Question: {QUESTION}' || chr(10) || chr(10) || 'Answer:') AS prompt_md5,
      count(*) AS docs_added, CAST(sum(greatest(1, length(piece) // 4)) AS BIGINT) AS doc_tokens FROM k GROUP BY 1""",
)
def assembled_prompt(t):
    out = context.assembled(_packed(t), "source", QUESTION, SYSTEM)
    return out.select("source", F.md5("prompt").alias("prompt_md5"), "docs_added", "doc_tokens")


SLOTS = """WITH s AS (SELECT source, doc_id, text AS content, 'd' || doc_id AS name, CASE lang WHEN 'en' THEN 5 WHEN 'fr' THEN 4 WHEN 'de' THEN 3 ELSE 1 END AS priority,
    200 AS max_tokens, CASE WHEN lang = 'en' THEN 'retrieved' ELSE 'memory' END AS category FROM documents),
  z AS (SELECT *, least(length(content) // 4, max_tokens) AS tokens FROM s),
  u AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY priority DESC, doc_id) AS used FROM z),
  k AS (SELECT source, doc_id, CAST(used AS BIGINT) AS used_tokens, '[' || upper(category) || ': ' || name || ']' || chr(10) || CASE WHEN length(content) // 4 > max_tokens THEN substr(content, 1, max_tokens * 4) || '...' ELSE content END || chr(10) AS piece
    FROM u WHERE used <= 4000)"""


def _slots(t):
    lang = F.col("lang")
    return t.documents.select(
        "source",
        "doc_id",
        F.col("text").alias("content"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"),
        F.when(lang == "en", 5).when(lang == "fr", 4).when(lang == "de", 3).otherwise(1).alias("priority"),
        F.lit(200).alias("max_tokens"),
        F.when(lang == "en", "retrieved").otherwise("memory").alias("category"),
    )


@query("pack_slots", f"{SLOTS} SELECT source, doc_id, used_tokens, md5(piece) AS piece_md5 FROM k")
def pack_slots(t):
    out = context.pack_slots(_slots(t), "source", "doc_id", 4000)
    return out.select("source", "doc_id", "used_tokens", F.md5("piece").alias("piece_md5"))


@query(
    "slot_usage",
    f"""{SLOTS}, c AS (SELECT source, CAST((sum(length(piece)) + count(*) - 1) // 4 AS BIGINT) AS used_tokens FROM k GROUP BY 1)
      SELECT source, used_tokens, 4000 - used_tokens AS remaining_tokens, CAST(floor(used_tokens / 4000 * 100) AS INT) AS utilization_pct FROM c""",
)
def slot_usage(t):
    return context.slot_usage(context.pack_slots(_slots(t), "source", "doc_id", 4000), "source", 4000)


@query(
    "memory_last_n",
    "SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3",
)
def memory_last_n(t):
    return context.last_messages(t.conversations, "conv_id", "turn", 3).select("conv_id", "turn", "role")


@query(
    "memory_batches",
    """WITH p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
      b AS (SELECT conv_id, role, text, i, (i - 1) // 2 + 1 AS batch, CASE WHEN n >= 5 THEN (n - 5) // 2 + 1 ELSE 0 END AS flushes FROM p)
      SELECT conv_id, CAST(batch AS BIGINT) AS batch, md5(string_agg(role || ': ' || text, chr(10) ORDER BY i)) AS text_md5 FROM b WHERE batch <= flushes GROUP BY 1, 2""",
)
def memory_batches(t):
    out = context.memory_batches(t.conversations, "conv_id", "turn", threshold=5)
    return out.select("conv_id", "batch", F.md5("batch_text").alias("text_md5"))


@query(
    "conversation_history",
    """WITH p AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 4 + 1 AS page FROM conversations)
      SELECT conv_id, CAST(page AS BIGINT) AS page, count(*) AS n, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS text_md5 FROM p GROUP BY 1, 2""",
)
def conversation_history(t):
    pages = context.conversation_history(t.conversations, "conv_id", "turn", page_size=4)
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return pages.select(
        "conv_id", "page", F.size("messages").cast("bigint").alias("n"), F.md5(F.array_join(lines, "\n")).alias("text_md5")
    )


@query(
    "top_entities",
    rf"""WITH w AS (SELECT conv_id, turn, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM (
        SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '{WS}'), lambda x: x <> '') AS ws FROM conversations)),
      c AS (SELECT conv_id, word, count(*) AS n, min(turn * 1000000 + place) AS seen FROM w WHERE regexp_matches(word, '^\p{{Lu}}') AND length(word) > 3 GROUP BY 1, 2)
      SELECT conv_id, word, n, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, seen) AS INT) AS rank FROM c
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, seen) <= 5""",
)
def top_entities(t):
    return context.top_entities(t.heavy("conversations", "conv_id", "turn"), "conv_id", "turn", "text")


@query(
    "index_stats",
    f"{chunked_sql()} SELECT count(*) AS chunks, count(DISTINCT doc_id) AS documents FROM ch",
)
def index_stats(t):
    out = chunks.chunk_fixed(t.documents.select("doc_id", "text"), "text")
    return out.agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("doc_id").alias("documents"))


@query("chunks_per_doc", f"{chunked_sql()} SELECT doc_id, count(*) AS chunks FROM ch GROUP BY 1")
def chunks_per_doc(t):
    out = chunks.chunk_fixed(t.documents.select("doc_id", "text"), "text")
    return out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks")).orderBy("doc_id")
