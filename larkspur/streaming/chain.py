"""The indexing chain: documents go step by step into an index; failed steps are tried again, then set aside.

Events of documents (uploaded, failed, done) lie in a topic. A keyed state holds, per document, the step it is at
and the tries it has had there; a timer in event time brings the next try, each twice as late as the one before.
The state decides only what is due. The work itself is done on whole batches by column expressions: every step is a
function from rows to rows with an ``error`` column, and documents without an error go on to the next step at once.
What a document had reached is kept where it failed, so a later try starts at that step.

Each call of ``run_chain`` works off what is due at ``now`` and stops; a scheduler calls it again. Outcomes go back
into the topic as events, folders are named by batch, and the index and the status are keyed tables, so a repeated
batch changes nothing and a try is never counted twice.

* a document that is uploaded again starts anew; outcomes of the version before are ignored.
* after ``most`` failed tries of a step the document goes to the dead letters with its step and last error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from larkspur.session import Scratch
from larkspur.sources import sinks
from larkspur.streaming import topics

EVENT = "doc_id long, event string, version long, step string, error string, ts timestamp"
DUE = "doc_id long, kind string, version long, step string, tries int, error string"

#: A step: its name, and a function from rows (doc_id, version, try_number and what the step before made) to rows with ``error``.
Step = tuple[str, Callable[[DataFrame], DataFrame]]


def _due(doc: int, kind: str, version: int, step: str, tries: int, error: str | None) -> Row:
    return Row(doc_id=doc, kind=kind, version=version, step=step, tries=tries, error=error)


class Attempts(StatefulProcessor):
    """What a document waits for. Puts out tries that are due (kind ``try``) and how documents stand (``waiting``, ``dead_letter``, ``index``)."""

    def __init__(self, first: str, most: int, backoff_ms: int):
        self.first, self.most, self.backoff_ms = first, most, backoff_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.at = handle.getValueState("at", "version long, step string, failed int, all_failed int")

    def _stop_timers(self) -> None:
        for when in list(self.handle.listTimers()):
            self.handle.deleteTimer(when)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        doc = key[0]
        rows = sorted(rows, key=lambda r: (r.version, r.event != "uploaded", r.ts))
        if doc is None:  # a tick of the clock
            return
        # The state is read once and written once a batch: each access is a call to the JVM.
        now = self.at.get()
        before, known, timers = now, now is not None, []
        for r in rows:
            if r.event == "uploaded":
                if now is None or now[0] < r.version:
                    if known:
                        self._stop_timers()
                    now, known, timers = (r.version, self.first, 0, 0), False, []
                    yield _due(doc, "try", r.version, self.first, 1, None)
            elif now is None or now[0] != r.version:
                continue  # of a version before
            elif r.event == "done":
                yield _due(doc, "index", r.version, r.step, now[3] + 1, None)
            else:
                failed = now[2] + 1 if now[1] == r.step else 1
                now = (r.version, r.step, failed, now[3] + 1)
                if failed >= self.most:
                    yield _due(doc, "dead_letter", r.version, r.step, now[3], r.error)
                else:
                    timers.append(int(r.ts.timestamp() * 1000) + self.backoff_ms * 2 ** (failed - 1))
                    yield _due(doc, "waiting", r.version, r.step, now[3], r.error)
        if now is not before:
            self.at.update(now)
        for when in timers:
            self.handle.registerTimer(when)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        version, step, failed, _ = self.at.get()
        yield _due(key[0], "try", version, step, failed + 1, None)

    def close(self) -> None:
        pass


def put_events(events: DataFrame, root: str, name: str) -> None:
    """Add events to the topic; the same name replaces what it added before."""
    events.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) {c.split()[0]}" for c in EVENT.split(", ")]).write.mode("overwrite").parquet(
        f"{root}/events/{name}"
    )


def upload(docs: DataFrame, key: str, root: str, now: datetime, version: int = 1) -> None:
    """Announce documents to the chain."""
    at = F.lit(now).cast("timestamp")
    rows = docs.select(F.col(key).alias("doc_id"), F.lit("uploaded").alias("event"), F.lit(version).alias("version"))
    put_events(rows.withColumns({"step": F.lit(None), "error": F.lit(None), "ts": at}), root, f"upload-{version}-{now:%Y%m%d%H%M%S}")


def _work(
    due: DataFrame, fetch: Callable[[DataFrame], DataFrame], steps: list[Step], root: str, batch_id: int, scratch: Scratch
) -> tuple[DataFrame, DataFrame | None]:
    """Do the tries that are due: the outcomes (doc_id, event, version, step, error) and the rows for the index."""
    spark = due.sparkSession
    outcomes, carried, before = [], None, None
    for place, (name, step) in enumerate(steps):
        mine = due.where(F.col("step") == name).select("doc_id", "version", F.col("tries").alias("try_number"))
        kept = f"{root}/kept/{name}"
        if place == 0:
            rows = fetch(mine)
        elif sinks.exists(spark, kept):
            rows = spark.read.option("mergeSchema", True).parquet(kept).drop("batch_id", "try_number").join(mine, ["doc_id", "version"])
        else:
            rows = None
        if carried is not None:
            rows = carried if rows is None else rows.select(*carried.columns).unionByName(carried)
        if rows is None:
            continue
        done = scratch.cut(step(rows), f"chain-{name}")
        written = scratch.paths[-1]
        failed = done.where(F.col("error").isNotNull()).groupBy("doc_id", "version").agg(F.min("error").alias("error"))
        failed = scratch.cut(failed.withColumns({"event": F.lit("failed"), "step": F.lit(name)}), "chain-failed")
        outcomes.append(failed)
        if place:  # what a document failed with at the first try is where the next one begins
            again = rows.where("try_number = 1").join(failed.select("doc_id", "version"), ["doc_id", "version"], "left_semi")
            again.write.mode("overwrite").parquet(f"{kept}/batch_id={batch_id}")
        if before:  # what the step before made has been read for the last time
            scratch.drop(before)
        before = written
        good = done.join(failed.select("doc_id", "version"), ["doc_id", "version"], "left_anti").drop("error")
        carried = good.withColumn("try_number", F.lit(1))
    last = steps[-1][0]
    finished = carried.select("doc_id", "version").distinct().withColumns({"event": F.lit("done"), "step": F.lit(last), "error": F.lit(None).cast("string")})
    columns = ["doc_id", "event", "version", "step", "error"]
    out = finished.select(columns)
    for part in outcomes:
        out = out.unionByName(part.select(columns))
    return out, carried.drop("try_number")


def run_chain(
    spark: SparkSession,
    docs: DataFrame,
    key: str,
    steps: list[Step],
    root: str,
    now: datetime,
    most: int = 3,
    backoff_seconds: int = 60,
) -> DataFrame:
    """Work off what is due at ``now``; the status of all documents: doc_id, target, step, tries, error.

    ``docs`` holds the documents by ``key``. ``now`` must be later than at the call before by two seconds or more.
    """
    at = int(now.timestamp())
    tick = spark.range(1).selectExpr("NULL doc_id", "'tick' event", "0L version", "NULL step", "NULL error", f"timestamp_seconds({at}) ts")
    put_events(tick, root, f"tick-{at}")

    def fetch(mine: DataFrame) -> DataFrame:
        return docs.withColumnRenamed(key, "doc_id").join(mine, "doc_id")

    def work(batch: DataFrame, batch_id: int) -> None:
        with Scratch(spark) as scratch:
            batch = scratch.cut(batch, "chain-due")
            status = batch.where("kind <> 'try'").select("doc_id", F.col("kind").alias("target"), "step", "tries", "error")
            if not status.isEmpty():
                sinks.silver_merge(spark, status, f"{root}/status", "doc_id", [F.desc("tries"), F.col("target")])
            due = batch.where("kind = 'try'")
            if due.isEmpty():
                return
            outcomes, rows = _work(due, fetch, steps, root, batch_id, scratch)
            sinks.replace_keys(spark, f"{root}/index", "doc_id", due.select("doc_id").distinct(), sinks.by_bucket(rows, "doc_id"))
            put_events(outcomes.withColumn("ts", F.timestamp_seconds(F.lit(at + 1))), root, f"outcome-{batch_id}")

    events = topics.read_files(spark, f"{root}/events/*", EVENT).withWatermark("ts", "0 seconds")
    states = events.groupBy("doc_id").transformWithState(Attempts(steps[0][0], most, backoff_seconds * 1000), DUE, "Update", "EventTime")
    topics.run_to_end(states, work, f"{root}/checkpoint", "update", topics.ROCKSDB)
    known = sinks.read_keyed(spark, f"{root}/status")
    return known if known is not None else spark.createDataFrame([], "doc_id long, target string, step string, tries int, error string")
