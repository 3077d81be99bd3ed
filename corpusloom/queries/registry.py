"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import ship_package, spread

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("labels", "texts", "corpus", "annotation", "venues", "files")


class Tables:
    """Attribute access to the Parquet tables of a folder; ``wide`` spreads a table of few splits."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")

    def wide(self, name: str, *columns: str) -> DataFrame:
        return spread(getattr(self, name).select(*columns))


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function of the tables under a name, with its SQL if there is any."""

    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, folder))

        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run

    return register


def _load() -> None:
    for module in _MODULES:
        import_module(f"corpusloom.queries.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
