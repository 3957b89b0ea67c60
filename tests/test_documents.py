"""Chunking, packing and memory against the cases the operators are defined by."""

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.operators import chunks, context

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")


def test_chunk_starts(spark):
    out = chunks.chunk_fixed(docs(spark, ["x" * 100]), "text", 50, 10).collect()
    assert [r.chunk_start for r in out] == [0, 40, 80]
    out = chunks.chunk_fixed(docs(spark, ["x" * 100]), "text", 30, 0).collect()
    assert [r.chunk_start for r in out] == [0, 30, 60, 90]
    assert [r.chunk for r in chunks.chunk_fixed(docs(spark, ["short", "", None]), "text").collect()] == ["short"]
    with pytest.raises(ValueError):
        chunks.chunk_fixed(docs(spark, ["a"]), "text", 10, 10)


@FEW
@given(st.text(min_size=1, max_size=300), st.integers(2, 40), st.integers(0, 39))
def test_chunks_rebuild_the_text(spark, body, size, overlap):
    body = body.encode("utf-16", "surrogatepass").decode("utf-16", "ignore").replace("\x00", "") or "a"
    overlap = min(overlap, size - 1)
    out = sorted(chunks.chunk_fixed(docs(spark, [body]), "text", size, overlap).collect(), key=lambda r: r.chunk_index)
    assert "".join(r.chunk[: size - overlap] for r in out[:-1]) + out[-1].chunk == body


def test_sentence_chunks_end_at_stops(spark):
    body = ("word " * 70 + "end. ") * 4
    out = chunks.chunk_sentence(docs(spark, [body, None]), "text").collect()
    assert out[0].chunk.endswith("end.")
    assert all(b.chunk_start < a.chunk_start + 500 for a, b in zip(out, out[1:]))


@pytest.mark.parametrize("kind", sorted(chunks.SPLITTERS))
def test_recursive_chunks_keep_all_words(spark, kind):
    body = "\n\n".join(" ".join(f"w{p}x{i}." for i in range(90)) for p in range(9))
    size, _, separators = chunks.SPLITTERS[kind]
    out = chunks.chunk_recursive(docs(spark, [body]), "text", F.lit(kind)).collect()
    assert set(" ".join(r.chunk for r in out).split()) >= set(body.split())
    if " " in separators:
        assert max(len(r.chunk) for r in out) <= size


def test_markdown_sections(spark):
    out = chunks.chunk_markdown(docs(spark, ["intro\n# A\none\n#### deep\n## B\n\ntwo\n"]), "text").collect()
    assert [(r.header, r.chunk) for r in out] == [(None, "intro"), ("A", "one\n#### deep"), ("B", "two")]


def test_content_id_can_be_salted(spark):
    df = spark.createDataFrame([("a", "s1"), ("a", "s2")], "t string, s string")
    plain = df.select(tx.content_id(F.col("t"))).distinct().count()
    salted = df.select(tx.content_id(F.col("t"), F.col("s"))).distinct().count()
    assert (plain, salted) == (1, 2)


def test_strip_takes_unicode_blanks(spark):
    body = " \x1f\t Ünï \x85　\n"
    assert docs(spark, [body]).select(tx.strip(F.col("text"))).first()[0] == body.strip()


def _packed(lengths, budget, question, system):
    """The loop the operator stands for."""
    left = budget - (max(1, len(system) // 4) if system else 0) - max(1, len(context.question_part(question)) // 4)
    out = []
    for i, n in enumerate(lengths):
        piece = context.DOC_MARK + "y" * n
        tokens = max(1, len(piece) // 4)
        if tokens <= left:
            out.append((i, piece))
            left -= tokens
        else:
            if left > 10:
                out.append((i, piece[: left * 4]))
            break
    return out


@FEW
@given(st.lists(st.integers(0, 300), min_size=1, max_size=25), st.integers(20, 260))
def test_pack_context_equals_the_loop(spark, lengths, budget):
    rows = [("q", i, "y" * n) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "q string, i int, content string")
    got = context.pack_context(df, "q", [F.col("i")], "content", budget, "why", "sys prompt").collect()
    assert sorted((r.i, r.piece) for r in got) == _packed(lengths, budget, "why", "sys prompt")


def test_pack_context_keeps_fewer_than_offered(spark):
    df = spark.createDataFrame([("q", i, "z" * 1000) for i in range(5)], "q string, i int, content string")
    packed = context.pack_context(df, "q", [F.col("i")], "content", 300, "a question")
    assert 0 < packed.count() < 5
    prompt = context.assembled(packed, "q", "a question").first().prompt
    assert prompt.startswith("\nContext:\n\n---\nzzz") and prompt.endswith("\n\nQuestion: a question\n\nAnswer:")


def _batches(n, threshold, keep=3):
    held, out = [], []
    for i in range(1, n + 1):
        held.append(i)
        if len(held) >= threshold:
            out.append(held[:-keep])
            held = held[-keep:]
    return out


@pytest.mark.parametrize("threshold", [4, 5, 10])
@pytest.mark.parametrize("n", [3, 9, 24])
def test_memory_batches_equal_the_loop(spark, threshold, n):
    df = spark.createDataFrame([(1, i, "user", str(i)) for i in range(1, n + 1)], "c int, turn int, role string, text string")
    got = sorted(context.memory_batches(df, "c", "turn", threshold).collect(), key=lambda r: r.batch)
    assert [[int(x.split(": ")[1]) for x in r.batch_text.split("\n")] for r in got] == _batches(n, threshold)


def test_history_pages_are_bounded(spark):
    df = spark.createDataFrame([(1, i, "user", "t") for i in range(25)], "c int, turn int, role string, text string")
    pages = context.conversation_history(df, "c", "turn", 10).collect()
    assert sorted((r.page, len(r.messages)) for r in pages) == [(1, 10), (2, 10), (3, 5)]


def test_render_leaves_values_alone(spark):
    df = spark.createDataFrame([("{b}", "x")], "a string, b string")
    assert df.select(tx.render("<{a}|{b}>", a=F.col("a"), b=F.col("b"))).first()[0] == "<{b}|x>"


def test_page_text_prefers_the_article(spark):
    html = "<html><body><p>out</p><article><h1>T</h1><script>x</script><p>a &amp;lt; b</p></article></body></html>"
    assert docs(spark, [html]).select(chunks.page_text(F.col("text"))).first()[0] == "T\na &lt; b"


def test_texts_are_cut_in_steps_of_bounded_bytes(spark, monkeypatch):
    texts = pa.array(["a" * 600, None, "b" * 600, "é" * 900, "", "c"])
    monkeypatch.setattr(chunks, "CUT_BYTES", 1000)
    assert [(s.start, s.stop) for s in chunks._in_steps(texts)] == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(chunks._in_steps(texts[:0])) == []
    df = docs(spark, texts.to_pylist()).coalesce(1)
    cut = chunks.chunk_sentence(df, "text").groupBy(F.substring("chunk", 1, 1).alias("c")).count().collect()
    assert {r.c: r["count"] for r in cut} == {"a": 2, "b": 2, "é": 2, "c": 1}
    whole = chunks.chunk_recursive(df, "text", F.lit("faq")).select("chunk").collect()
    assert sorted(r.chunk for r in whole) == sorted(t for t in texts.to_pylist() if t)
