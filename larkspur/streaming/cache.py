"""A cache on a stream: answers are kept per key for a time to live, requests hit or miss as time goes on."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ANSWER = "key string, request_id long, ts timestamp, hit boolean, value string"


class Entries(StatefulProcessor):
    """The entry of a key and when it expires. A timer in event time removes what nobody asks for any more."""

    def __init__(self, ttl_seconds: float):
        self.ttl_ms = int(ttl_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "value string, expires_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # The state is read once and written once a batch, however many rows the key has: each access is a call to the JVM.
        held = self.entry.get()
        before = held
        for r in sorted(rows, key=lambda r: (r.ts, r.request_id)):
            at = int(r.ts.timestamp() * 1_000_000 + 0.5)
            if r.kind == "set":
                expires = at + self.ttl_ms * 1000
                if held is None or held[1] <= expires:
                    held = (r.value, expires)
                continue
            hit = held is not None and at < held[1]
            yield Row(key=key[0], request_id=r.request_id, ts=r.ts, hit=hit, value=held[0] if hit else None)
        if held is not before:
            self.entry.update(held)
            self.handle.registerTimer(-(-held[1] // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.entry.exists() and self.entry.get()[1] <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.entry.clear()
        return iter(())

    def close(self) -> None:
        pass


def cache_stream(log: DataFrame, ttl_seconds: float, delay: str = "10 minutes") -> DataFrame:
    """Every request of a stream with its answer: key, request_id, ts, hit, value.

    ``log`` has key, request_id, ts, kind (``set`` stores ``value`` for the time to live, anything else asks) and value.
    A request hits if the entry set last is younger than the time to live, in the order of ts, then request_id. Rows
    more than ``delay`` later than others are not answered. An entry's state goes when its time is over, so what is
    held follows the live entries, not the keys ever seen. Run it with ``topics.ROCKSDB``; a null key is a key.
    """
    rows = log.select("key", "request_id", F.col("ts").cast("timestamp").alias("ts"), "kind", F.col("value").cast("string").alias("value"))
    return rows.withWatermark("ts", delay).groupBy("key").transformWithState(Entries(ttl_seconds), ANSWER, "Append", "EventTime")
