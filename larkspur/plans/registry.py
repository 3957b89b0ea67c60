"""Registry of queries and lazy access to the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.session import spread

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


class Tables:
    """``t.events`` is the lazy scan of ``<sf_dir>/events.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def heavy(self, name: str, *keys: str) -> DataFrame:
        """The table for work that is heavy per row, spread by the keys of a row when its files are few."""
        return spread(self.spark.read.parquet(self.path(name)), *keys)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name`` with its SQL statement."""

    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn

    return register
