"""The registered queries: each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ambertill.sources.retail import Retail

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None, name: str | None = None):
    """Register a function of ``Retail``; without SQL only its rows are counted."""

    def wrap(build: Callable[[Retail], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: build(Retail(spark, folder))
        if oracle:
            ORACLES[key] = oracle
        return build

    return wrap


for _module in ("sales", "films", "matching", "changes", "quality", "jobs"):
    import_module(f"{__name__}.{_module}")
