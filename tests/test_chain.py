"""The indexing chain: tries, waiting times, dead letters, documents that come again."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from larkspur.sources import sinks
from larkspur.streaming import chain

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def steps(always=7, twice=3):
    def parse(rows):
        return rows.withColumn("error", F.when(F.col("text").isNull(), F.lit("no text")))

    def split(rows):
        words = rows.withColumn("chunk", F.explode(F.split("text", " "))).drop("text")
        return words.withColumn("error", F.lit(None).cast("string"))

    def embed(rows):
        bad = (F.col("doc_id") % 10 == always) | ((F.col("doc_id") % 10 == twice) & (F.col("try_number") < 3))
        return rows.withColumns({"vector": F.array(F.length("chunk").cast("double")), "error": F.when(bad, F.lit("model is away"))})

    return [("parse", parse), ("chunk", split), ("embed", embed)]


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def status(df):
    return {r.doc_id: (r.target, r.step, r.tries, r.error) for r in df.collect()}


def test_tries_waits_and_dead_letters(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (3, "c d"), (7, "e"), (9, None)], "doc_id long, text string")
    root = str(tmp_path)
    chain.upload(docs, "doc_id", root, at(0))
    run = lambda seconds: status(chain.run_chain(spark, docs, "doc_id", steps(), root, at(seconds)))
    assert run(0) == {}  # the outcomes of the first try come back with the next call
    first = run(10)
    assert first == {1: ("index", "embed", 1, None), 3: ("waiting", "embed", 1, "model is away"), 7: ("waiting", "embed", 1, "model is away"), 9: ("waiting", "parse", 1, "no text")}
    assert run(40) == first  # nobody's time has come
    run(70)
    second = run(80)
    assert second[3] == ("waiting", "embed", 2, "model is away") and second[9] == ("waiting", "parse", 2, "no text")
    assert run(150) == second  # the second wait is twice as long
    run(220)
    last = run(230)
    assert last == {1: ("index", "embed", 1, None), 3: ("index", "embed", 3, None), 7: ("dead_letter", "embed", 3, "model is away"), 9: ("dead_letter", "parse", 3, "no text")}
    rows = sinks.read_keyed(spark, f"{root}/index").collect()
    assert sorted((r.doc_id, r.chunk, r.vector[0]) for r in rows) == [(1, "a", 1.0), (1, "b", 1.0), (3, "c", 1.0), (3, "d", 1.0)]
    assert run(1000) == last


def test_a_document_that_comes_again_starts_anew(spark, tmp_path):
    root = str(tmp_path)
    old = spark.createDataFrame([(1, "old"), (7, "old seven")], "doc_id long, text string")
    chain.upload(old, "doc_id", root, at(0))
    chain.run_chain(spark, old, "doc_id", steps(), root, at(0))
    new = spark.createDataFrame([(1, "new text"), (7, "mended")], "doc_id long, text string")
    chain.upload(new, "doc_id", root, at(5), version=2)
    chain.run_chain(spark, new, "doc_id", steps(always=-1), root, at(5))
    got = status(chain.run_chain(spark, new, "doc_id", steps(always=-1), root, at(10)))
    assert got == {1: ("index", "embed", 1, None), 7: ("index", "embed", 1, None)}
    assert sorted(r.chunk for r in sinks.read_keyed(spark, f"{root}/index").collect()) == ["mended", "new", "text"]
    assert status(chain.run_chain(spark, new, "doc_id", steps(always=-1), root, at(500))) == got


class Held:
    """A value state that counts how often it is reached."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def get(self):
        self.calls += 1
        return self.value

    def exists(self):
        self.calls += 1
        return self.value is not None

    def update(self, value):
        self.calls += 1
        self.value = value

    def getValueState(self, *_):
        return self

    def registerTimer(self, when):
        self.timers.append(when)

    def deleteTimer(self, when):
        self.timers.remove(when)

    def listTimers(self):
        self.calls += 1
        return list(self.timers)


def test_state_is_reached_once_a_batch():
    held, tries = Held(), chain.Attempts("parse", 3, 60_000)
    tries.init(held)

    def event(kind, seconds, version=1, step=None, error=None):
        return Row(doc_id=5, event=kind, version=version, step=step, error=error, ts=at(seconds))

    def send(*rows):
        before = held.calls
        return [(r.kind, r.version, r.step, r.tries) for r in tries.handleInputRows((5,), iter(rows), None)], held.calls - before

    assert send(event("uploaded", 0)) == ([("try", 1, "parse", 1)], 2)
    assert send(event("failed", 1, step="embed", error="away")) == ([("waiting", 1, "embed", 1)], 2)
    assert held.timers == [int(at(61).timestamp() * 1000)] and held.value == (1, "embed", 1, 1)
    assert send(event("uploaded", 9, version=2), event("failed", 9, step="embed")) == ([("waiting", 1, "embed", 2), ("try", 2, "parse", 1)], 3) and held.timers == []
    assert send(event("done", 10, version=2, step="embed")) == ([("index", 2, "embed", 1)], 1)
