"""All registered queries of the bar engine with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.plans.bindings import shared_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, shared: bool = False):
    """Register a function (spark, folder) -> DataFrame, and its SQL if there is one; ``shared``: its parts read the same bindings, which are written first."""
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        def sharing(spark: SparkSession, folder: str) -> DataFrame:
            with shared_inputs():
                return f(spark, folder)

        QUERIES[name] = sharing if shared else f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return keep


def load() -> None:
    from barloom.plans import bar_queries, change_queries, ingest_queries, schedule_queries, source_queries, state_queries  # noqa: F401
