"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from review_engine.session import configure

Run = Callable[[SparkSession, str], DataFrame]

_RUNS: dict[str, Run] = {}
_SQL: dict[str, str] = {}

MODULES = ("scans", "shapes", "expressions", "quality", "opinion", "dashboards", "checks", "pages", "streams", "batch")


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; ``sql`` must give the same rows on the same tables."""

    def register(run: Run) -> Run:
        if name in _RUNS:
            raise ValueError(f"query {name} is defined twice")

        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return run(configure(spark), folder)

        _RUNS[name] = prepared
        if sql is not None:
            _SQL[name] = sql
        return run

    return register


@lru_cache(maxsize=1)
def _load() -> None:
    for module in MODULES:
        import_module(f"review_engine.plans.{module}")


def runs() -> dict[str, Run]:
    _load()
    return dict(_RUNS)


def sqls() -> dict[str, str]:
    _load()
    return dict(_SQL)
