"""Registry of query keys -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..sources import tables

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn(spark) -> DataFrame`` under ``key``.

    The stored builder takes ``(spark, sf_dir)``: it registers the tables of
    ``sf_dir``, stages what the query's statement asks for, and then calls ``fn``.
    """
    needs = cache(lambda: tables.needs_of(oracle))  # once every module of statements is read

    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            tables.load(spark, sf_dir, only=needs())
            return fn(spark)
        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        build.plain = fn  # on tables that are registered already
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = (build, oracle)
        return fn
    return deco


PLAN_MODULES = ["basic", "calendar_q", "ledger", "jobs", "posting_jobs", "metric_jobs", "io_jobs", "backfill"]


def load_all() -> dict[str, tuple[Builder, str | None]]:
    import importlib
    for m in PLAN_MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return REGISTRY
