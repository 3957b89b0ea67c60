"""Context packing under a token budget, conversation memory, prompt batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.operators.ordered import first_n, numbered, running_total

# Prompt layout.
DOC_MARK = "\n---\n"
CONTEXT_MARK = "\nContext:"
ANSWER_MARK = "Answer:"
SMALLEST_CUT = 10


def question_part(question: str) -> str:
    return f"\nQuestion: {question}\n"


def _tokens(text: str) -> int:
    return max(1, len(text) // tx.CHARS_PER_TOKEN)


def pack_context(
    docs: DataFrame,
    query: str,
    order: list[Column],
    content: str,
    budget: int,
    question: str,
    system_prompt: str = "",
) -> DataFrame:
    """Documents of each query that fit its budget, in rank order, with their piece of the prompt.

    The first that does not fit is cut to the room left when that exceeds ten
    tokens, and ends the list. A document takes a token at least, so only the
    first ``budget`` ranks can matter: the cut before the window is exact and
    bounds every group.
    """
    room = budget - _tokens(question_part(question)) - (_tokens(system_prompt) if system_prompt else 0)
    if room < 0:
        raise ValueError("system prompt and question exceed the budget")
    piece = F.concat(F.lit(DOC_MARK), F.col(content))
    ranked = first_n(
        docs.withColumn("__tokens", tx.token_estimate(piece)), [query], order, max(room, 1), rank="rank"
    )
    upto = Window.partitionBy(query).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    used = ranked.withColumn("__upto", F.sum("__tokens").over(upto))
    left = F.lit(room) - (F.col("__upto") - F.col("__tokens"))
    whole = F.col("__upto") <= room
    cut = ~whole & (left > SMALLEST_CUT)
    return (
        used.where(whole | cut)
        .withColumn("piece", F.when(whole, piece).otherwise(F.substring(piece, F.lit(1), (left * 4).cast("int"))))
        .withColumn("tokens", tx.token_estimate(F.col("piece")))
        .withColumn("is_cut", ~whole)
        .drop("__tokens", "__upto")
    )


def assembled(packed: DataFrame, query: str, question: str, system_prompt: str = "") -> DataFrame:
    """One prompt per query from the packed pieces; its size is bounded by the budget."""
    head = "\n".join(([system_prompt] if system_prompt else []) + [CONTEXT_MARK])
    tail = "\n".join([question_part(question), ANSWER_MARK])
    pieces = F.array_sort(F.collect_list(F.struct("rank", "piece")))
    body = F.array_join(F.transform(pieces, lambda p: p["piece"]), "\n")
    return packed.groupBy(query).agg(
        F.concat(F.lit(head + "\n"), body, F.lit("\n" + tail)).alias("prompt"),
        F.count(F.lit(1)).alias("docs_added"),
        F.sum("tokens").alias("doc_tokens"),
    )


def pack_slots(slots: DataFrame, owner: str, ordinal: str, total_budget: int = 8000) -> DataFrame:
    """Slots by falling priority until the first that does not fit.

    Columns: name, content, priority, max_tokens, category. A slot longer than its
    own limit is cut and marked. Slots of no tokens exist, so the prefix sum runs
    over (priority, ordinal) buckets instead of cutting by rank.
    """
    size = tx.token_estimate(F.col("content"), 0)
    over = size > F.col("max_tokens")
    shown = F.when(over, F.concat(F.expr("substring(content, 1, max_tokens * 4)"), F.lit("..."))).otherwise(F.col("content"))
    sized = slots.withColumn("tokens", F.least(size, F.col("max_tokens")).cast("bigint"))
    bucket = F.struct((-F.col("priority")).alias("p"), F.floor(F.col(ordinal) / 4096).alias("o"))
    order = [F.desc("priority"), F.col(ordinal)]
    summed = running_total(sized, [owner], order, bucket, F.col("tokens"), "used_tokens")
    label = F.concat(F.lit("["), F.upper("category"), F.lit(": "), F.col("name"), F.lit("]\n"), shown, F.lit("\n"))
    return summed.where(F.col("used_tokens") <= total_budget).withColumn("piece", label)


def slot_usage(packed: DataFrame, owner: str, total_budget: int = 8000) -> DataFrame:
    """Estimated use of the assembled blueprint: pieces joined by a line break, four characters a token."""
    chars = F.sum(F.length("piece")) + F.count(F.lit(1)) - 1
    used = F.floor(chars / 4).cast("bigint")
    return packed.groupBy(owner).agg(used.alias("used_tokens")).select(
        owner,
        "used_tokens",
        (total_budget - F.col("used_tokens")).alias("remaining_tokens"),
        F.floor(F.col("used_tokens") / total_budget * 100).cast("int").alias("utilization_pct"),
    )


def build_context(ranked: DataFrame, query: str, rank: str, piece: Column, separator: str) -> DataFrame:
    """Pieces of each query's top-k documents joined in rank order."""
    return (
        ranked.select(query, rank, piece.alias("piece"))
        .groupBy(query)
        .agg(F.array_sort(F.collect_list(F.struct(rank, "piece"))).alias("p"))
        .select(query, F.array_join(F.transform("p", lambda x: x["piece"]), separator).alias("context"))
    )


def last_messages(messages: DataFrame, conversation: str, turn: str, n: int = 10) -> DataFrame:
    return first_n(messages, [conversation], [F.desc(turn)], n)


# Turns per bucket of the position count.
TURNS = 4096


def _positions(messages: DataFrame, conversation: str, turn: str, total: str | None = None) -> DataFrame:
    return numbered(messages, [conversation], [F.col(turn)], F.floor(F.col(turn) / TURNS), "position", total)


def memory_batches(messages: DataFrame, conversation: str, turn: str, threshold: int = 10, keep: int = 3) -> DataFrame:
    """Message groups that get summarised, in closed form, with their text.

    The first summary happens when ``threshold`` messages are held and covers all
    but the last ``keep``; after that one happens every ``threshold - keep``. A
    batch is that many messages, so the joined text is bounded.
    """
    if threshold <= keep:
        raise ValueError("threshold must exceed the messages kept")
    step = threshold - keep
    placed = _positions(messages, conversation, turn, "n")
    flushes = F.when(F.col("n") >= threshold, F.floor((F.col("n") - threshold) / step) + 1).otherwise(F.lit(0))
    batch = F.floor((F.col("position") - 1) / step) + 1
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    return (
        placed.withColumn("batch", batch)
        .where(F.col("batch") <= flushes)
        .groupBy(conversation, "batch")
        .agg(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))).alias("lines"))
        .select(conversation, "batch", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("batch_text"))
    )


def conversation_history(messages: DataFrame, conversation: str, turn: str, page_size: int = 1000) -> DataFrame:
    """Ordered messages per conversation in pages of bounded size; page 1 is the start."""
    page = F.floor((F.col("position") - 1) / page_size) + 1
    entry = F.struct(F.col(turn), F.col("role"), F.col("text"))
    return (
        _positions(messages, conversation, turn)
        .withColumn("page", page)
        .groupBy(conversation, "page")
        .agg(F.array_sort(F.collect_list(entry)).alias("messages"))
    )


def top_entities(messages: DataFrame, conversation: str, turn: str, text: str, n: int = 5) -> DataFrame:
    """Most frequent capitalised words over three letters per conversation; ties go to the first seen."""
    from pyspark.sql.functions import posexplode

    words = messages.select(conversation, turn, posexplode(tx.words(F.col(text))).alias("place", "word"))
    named = words.where(F.col("word").rlike(r"^\p{Lu}") & (F.length("word") > 3))
    counted = named.groupBy(conversation, "word").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(turn, "place")).alias("first_seen")
    )
    return first_n(counted, [conversation], [F.desc("n"), F.col("first_seen")], n, rank="rank").drop("first_seen")


def extractive_summary(text: Column, sentences: int = 3) -> Column:
    """The highest-scoring sentences joined by ``. ``: length plus 50 per occurrence of "important".

    Works inside one row: sort by (score desc, place), no shuffle.
    """
    scored = F.transform(
        F.split(text, r"\. "),
        lambda s, i: F.struct(
            (-(F.length(s) + 50 * F.regexp_count(F.lower(s), F.lit("important")))).alias("k"), i.alias("i"), s.alias("s")
        ),
    )
    best = F.slice(F.array_sort(scored), 1, sentences)
    return F.concat(F.array_join(F.transform(best, lambda x: x["s"]), ". "), F.lit("."))


# Fixed value: the grounded-answer prompt.
ANSWER_PROMPT = """You are a helpful assistant. Answer the user's question
using ONLY the provided context. If the context does not contain enough
information, say so explicitly.

## Context
{context}

## Question
{question}

## Instructions
- Base your answer strictly on the context above
- Cite sources when possible
- Be concise and direct
"""


def prompt_batch(contexts: DataFrame, question: Column, template: str = ANSWER_PROMPT) -> DataFrame:
    """Filled prompts as an input table for offline inference."""
    return contexts.withColumn("prompt", tx.render(template, context=F.col("context"), question=question))
