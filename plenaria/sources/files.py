"""CSV exchange, Parquet releases, relation and entity views, named batches, catalog summaries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header row and a declared schema; identifiers declared as text stay text."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish(tables: Mapping[str, DataFrame], root: str, release: int, counts: bool = True) -> None:
    """Write every table of a release, then its manifest.

    The release's number is claimed first by a file that only one writer can create; a number that
    is taken is refused, so nothing that readers follow is ever overwritten. The tables go to a
    folder of this attempt. Readers follow the manifest, so a release becomes visible as a whole,
    and one that is interrupted never does; its number stays taken.
    """
    spark = next(iter(tables.values())).sparkSession
    try:
        # an existing folder is an error for the writer
        spark.createDataFrame([(release,)], "release bigint").coalesce(1).write.mode("error").parquet(f"{root}/claims/release={release}")
    except AnalysisException as error:
        if "PATH_ALREADY_EXISTS" not in str(error):
            raise
        raise ValueError(f"release {release} is already published or claimed") from error
    attempt, rows = uuid.uuid4().hex, []
    for name, df in tables.items():
        path = f"{root}/data/release={release}/{attempt}/{name}"
        df.write.parquet(path)
        rows.append((release, name, path, spark.read.parquet(path).count() if counts else None))
    (spark.createDataFrame(rows, "release bigint, tabel string, pad string, rijen bigint").coalesce(1)
     .write.mode("append").parquet(f"{root}/manifest"))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Tables of the newest complete release."""
    listed = spark.read.schema("release bigint, tabel string, pad string, rijen bigint").parquet(f"{root}/manifest").distinct()
    return listed.where(F.col("release") == listed.agg(F.max("release").alias("_r")).scalar())


def read_release(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the newest release (the manifest has one row per table)."""
    return {r["tabel"]: spark.read.parquet(r["pad"]) for r in manifest(spark, root).select("tabel", "pad").collect()}


def relation(df: DataFrame, key: str, column: str, target: str | None, out: str, parent: str = "parent_id",
             deleted: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """(parent, child) pairs of a relation array; empty relations and deleted parents give none."""
    live = df if deleted is None else df.where(F.col(deleted) == F.lit(False))
    value = F.col("_x") if target is None else F.col(f"_x.{target}")
    return live.select(F.col(key).alias(parent), F.explode(column).alias("_x"), *extra).select(parent, value.alias(out), *extra)


def split_children(df: DataFrame, parent_id: str, column: str, out: str) -> DataFrame:
    """Child rows of a repeated element with parent id and list position."""
    return df.select(F.col(parent_id).alias("_parent_id"), F.posexplode(column).alias("_list_idx", out))


def entity_view(df: DataFrame, names: Mapping[str, str], deleted: str = "verwijderd", where: Column | None = None) -> DataFrame:
    """Renamed business columns of the rows that are not deleted."""
    live = df.where(F.col(deleted) == F.lit(False))
    live = live if where is None else live.where(where)
    return live.select(*[F.col(c).alias(n) for c, n in names.items()])


def named_batch(queries: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]], tables: Mapping[str, DataFrame],
                root: str, fmt: str = "parquet") -> dict[str, str]:
    """Run named definitions and store each result under its name; returns the paths."""
    paths = {}
    for name, query in queries.items():
        paths[name] = f"{root}/{name}"
        writer = query(tables).write.mode("overwrite")
        (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(paths[name])
    return paths


def catalog_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rijen")).select(F.lit(n).alias("tabel"), "rijen") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns and types per table, from the schemas alone."""
    rows = [(n, i + 1, f.name, f.dataType.simpleString()) for n, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "tabel string, volgnummer int, kolom string, type string")


def to_spark(spark: SparkSession, frame, schema: T.StructType | str, table: str | None = None, max_rows: int = 100_000) -> DataFrame:
    """A small client frame as DataFrame, saved as a table when named. Large ones belong in files."""
    if len(frame) > max_rows:
        raise ValueError(f"{len(frame)} rows: write a file and read it instead")
    df = spark.createDataFrame(frame, schema)
    if table:
        df.write.mode("overwrite").saveAsTable(table)
    return df


def with_unknown(df: DataFrame, **values) -> DataFrame:
    """Adds the unknown member; columns not named are NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.sparkSession.range(1).select(*[F.lit(v).cast(types[c]).alias(c) for c, v in values.items()])
    return df.unionByName(row, allowMissingColumns=True)
