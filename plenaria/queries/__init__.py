"""Registered queries over the benchmark tables, each with an equivalent SQL text where one exists.

The tables stand in for parliamentary records; every query runs the library's operators over whole
tables. ``registry()`` returns all queries by name.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
MODULES = ("sources", "versions", "scalars", "dates", "texts", "joins", "aggregates", "windows", "reshapes",
           "calendars", "catalogue", "increments", "checks", "semantics", "votings", "seatings", "analyses", "stars")


class Tables:
    """Benchmark tables by attribute, read from one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(self.build(Tables(spark, folder)))


_REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL text if there is one."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        _REGISTRY[name] = Query(name, build, sql)
        return build
    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and other numbers as double, so engines compare alike."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint").alias(f.name)
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            column = column.cast("double").alias(f.name)
        columns.append(column)
    return df.select(*columns)


def registry() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
    return dict(_REGISTRY)
