"""Extract-transform-load runs with metrics gathered inside the write job."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from larkspur.operators.quality import FieldRule, row_errors
from larkspur.sources.sinks import write_split, write_table

RUN_SCHEMA = (
    "name string, status string, records_read bigint, records_processed bigint, records_failed bigint, "
    "duration_seconds double, errors array<string>"
)


class Pipeline:
    """Subclass with ``extract``, ``transform`` and ``load``; ``run`` counts rows without extra jobs."""

    name = "pipeline"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def extract(self) -> DataFrame:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        return df

    def load(self, df: DataFrame) -> int:
        """Write the frame and return how many rows went out."""
        raise NotImplementedError

    def run(self) -> DataFrame:
        """One metrics row; an exception becomes status ``failed`` with its text.

        Rows read are counted by a job of their own, which needs no column (for columnar
        files no data either); so the filters of ``transform`` still reach the scan, and a
        ``load`` that runs no job cannot keep the run waiting.
        """
        started = time.time()
        read = processed = 0
        errors: list[str] = []
        status = "success"
        try:
            source = self.extract()
            processed = self.load(self.transform(source))
            read = source.count()
        except Exception as error:  # the run's outcome is data, so the reason is kept
            status, errors = "failed", [f"{type(error).__name__}: {error}"]
        row = (self.name, status, read, processed, 0, time.time() - started, errors)
        return self.spark.createDataFrame([row], RUN_SCHEMA)


_JOBS: dict[str, type[Pipeline]] = {}


def register_pipeline(cls: type[Pipeline]) -> type[Pipeline]:
    _JOBS[cls.name] = cls
    return cls


def pipeline_named(name: str) -> type[Pipeline]:
    if name not in _JOBS:
        raise KeyError(f"unknown pipeline {name}; known: {sorted(_JOBS)}")
    return _JOBS[name]


@dataclass
class EtlOutcome:
    status: str
    records_read: int
    records_written: int
    records_quarantined: int
    #: rows that break a rule, written or not
    records_invalid: int = 0


def run_etl(
    source: DataFrame,
    target: str,
    rules: list[FieldRule] | None = None,
    record: str | None = None,
    on_invalid: str = "load",
    quarantine: str | None = None,
    partition_by: list[str] | None = None,
) -> EtlOutcome:
    """Read, validate, write.

    Rules are checked in every mode. ``on_invalid``: ``load`` writes invalid rows too
    and reports how many there are, ``quarantine`` sends them to another path with
    their errors, ``split`` writes both into one table in one job, apart by the partition column ``is_valid`` and with
    their errors, ``fail`` stops before the write. A run that set rows aside is ``partial``.
    """
    if on_invalid not in ("load", "quarantine", "split", "fail"):
        raise ValueError(f"on_invalid: {on_invalid}")
    if not rules:
        n = write_table(source, target, partition_by=partition_by)
        return EtlOutcome("success", n, n, 0)
    checked = source.withColumn("errors", row_errors(source, rules, record))
    if on_invalid == "load":  # counted inside the write: the job runs, so the observation is there
        seen = Observation()
        n = write_table(
            checked.observe(seen, F.count_if(F.size("errors") > 0).alias("invalid")).drop("errors"), target, partition_by=partition_by
        )
        return EtlOutcome("success", n, n, 0, seen.get["invalid"])
    if on_invalid == "split":
        good, bad = write_split(checked, target, F.size("errors") > 0, partition_by=partition_by)
        return EtlOutcome("partial" if bad else "success", good + bad, good, bad, bad)
    if on_invalid == "quarantine" and quarantine is None:
        raise ValueError("quarantine needs a path")
    checked = checked.persist(StorageLevel.DISK_ONLY)  # the source is read and checked once for both writes
    try:
        invalid = checked.where(F.size("errors") > 0)
        valid = checked.where(F.size("errors") == 0).drop("errors")
        if on_invalid == "fail":
            bad = invalid.count()
            if bad:
                return EtlOutcome("failed", 0, 0, 0, bad)
            n = write_table(valid, target, partition_by=partition_by)
            return EtlOutcome("success", n, n, 0)
        good = write_table(valid, target, partition_by=partition_by)
        bad = write_table(invalid, quarantine)
        return EtlOutcome("partial" if bad else "success", good + bad, good, bad, bad)
    finally:
        checked.unpersist()
