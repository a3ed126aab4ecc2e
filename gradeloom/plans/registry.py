"""Registered queries: a Spark builder, the survey ids it covers and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gradeloom.plans.models import Models, with_models

QUERIES: dict[str, Callable[[Models], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(models) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Models], DataFrame]) -> Callable[[Models], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        COVERS[name] = tuple(covers.split())
        if sql:
            ORACLES[name] = with_models(sql)
        return fn

    return register


def bound(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[name](Models(spark, sf_dir))

    run.__name__ = name
    return run


def load_all() -> None:
    """Import every module that registers queries."""
    from importlib import import_module

    for module in ("corpus", "structure", "damage", "matching", "comparing", "scoring", "coherence", "battery",
                   "auditing", "claims", "validation", "state", "runlog", "defects",
                   "publication", "streams"):
        try:
            import_module(f"gradeloom.plans.{module}")
        except ModuleNotFoundError as error:
            if error.name != f"gradeloom.plans.{module}":
                raise
