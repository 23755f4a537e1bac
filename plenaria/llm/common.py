"""Helpers shared by the operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenaria.session import checkpoint, scratch_path


def kept(name: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker makes once and keeps for its later tasks."""
    holder = sys.modules.setdefault("_plenaria_worker", types.ModuleType("_plenaria_worker")).__dict__
    if name not in holder:
        holder[name] = make()
    return holder[name]


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def texts_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Only the id as a long and the text, null read as empty; other columns cannot clash."""
    return docs.select(column(doc_id).cast("long").alias("doc_id"), F.coalesce(column(text).cast("string"), F.lit("")).alias("text"))


def slices(rows: Iterable[tuple], most: int, size: Callable[[tuple], int]) -> Iterator[list[tuple]]:
    """Runs of rows whose sizes sum to about ``most``; a larger row is a run of its own."""
    run, total = [], 0
    for row in rows:
        if run and total + size(row) > most:
            yield run
            run, total = [], 0
        run.append(row)
        total += size(row)
    if run:
        yield run


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder of the cluster and read back, compressed; later jobs start from there."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While it lasts Spark removes the shuffle files of a job when the job ends; frames that are used again must be stored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


__all__ = ["checkpoint", "column", "kept", "shuffles_freed", "slices", "stored", "table", "texts_of"]
