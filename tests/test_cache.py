"""Cache entries that expire as the stream goes on."""

import datetime as dt
import random

from pyspark.sql import Row

from larkspur.streaming import cache, topics

LOG = "key string, request_id long, ts timestamp, kind string, value string"


def brute(rows, ttl):
    held, out = {}, {}
    for key, rid, ts, kind, value in sorted(rows, key=lambda r: (r[2], r[1])):
        if kind == "set":
            held[key] = (value, ts + dt.timedelta(seconds=ttl))
        else:
            hit = key in held and ts < held[key][1]
            out[rid] = (hit, held[key][0] if hit else None)
    return out


def test_hits_and_misses_over_runs(spark, tmp_path):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        ts = start + dt.timedelta(seconds=rng.randrange(4 * 3600), microseconds=rng.randrange(10**6))
        rows.append((rng.choice(["a", "b", "c", None]), i, ts, rng.choice(["set", "get", "get"]), f"v{i}"))
    rows += [("edge", 1000, start, "set", "x"), ("edge", 1001, start + dt.timedelta(seconds=599, microseconds=999999), "get", None), ("edge", 1002, start + dt.timedelta(seconds=600), "get", None)]
    rows.sort(key=lambda r: r[2])
    got = {}
    for part in (rows[:200], rows[200:450], rows[450:]):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        answers = cache.cache_stream(topics.read_files(spark, f"{tmp_path}/in", LOG), 600)
        topics.run_to_end(answers, topics.batch_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", conf=topics.ROCKSDB)
    for r in spark.read.schema(cache.ANSWER).parquet(f"{tmp_path}/out").collect():
        assert r.request_id not in got
        got[r.request_id] = (r.hit, r.value)
    want = brute(rows, 600)
    assert got == want and want[1001] == (True, "x") and want[1002] == (False, None) and {h for h, _ in want.values()} == {True, False}


class Held:
    """A value state that counts how often it is reached."""

    def __init__(self, value=None):
        self.value, self.reads, self.writes, self.timers = value, 0, 0, []

    def get(self):
        self.reads += 1
        return self.value

    def exists(self):
        self.reads += 1
        return self.value is not None

    def update(self, value):
        self.writes += 1
        self.value = value

    def getValueState(self, *_):
        return self

    def registerTimer(self, when):
        self.timers.append(when)


def test_state_is_reached_once_a_batch():
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [Row(key="a", request_id=i, ts=start + dt.timedelta(seconds=i), kind="set" if i % 10 == 0 else "get", value=f"v{i}") for i in range(1000)]
    held, entries = Held(), cache.Entries(5)
    entries.init(held)
    got = {r.request_id: (r.hit, r.value) for r in entries.handleInputRows(("a",), iter(rows), None)}
    assert got == {i: (i % 10 < 5, f"v{i - i % 10}" if i % 10 < 5 else None) for i in range(1000) if i % 10}
    last = int((start + dt.timedelta(seconds=995)).timestamp())
    assert (held.reads, held.writes, held.value, held.timers) == (1, 1, ("v990", last * 10**6), [last * 1000])
    assert list(entries.handleInputRows(("a",), iter([rows[1]]), None))[0].hit and (held.reads, held.writes) == (2, 1)
