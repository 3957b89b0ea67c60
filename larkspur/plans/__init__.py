"""Registered queries: each plan module pairs a Spark query with its SQL statement."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from larkspur.plans.registry import REGISTRY, Tables

MODULES = (
    "usage",
    "quality",
    "documents",
    "guards",
    "retrieval",
    "evaluation",
    "graph",
    "governance",
    "learning",
    "streams",
)


def _load() -> None:
    for name in MODULES:
        import_module(f"larkspur.plans.{name}")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, (fn, _) in REGISTRY.items()}


def all_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}
