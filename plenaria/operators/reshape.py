"""Pivots, cross tables and coverage tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.functions.numbers import percentage


def pivot_counts(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], total: str | None = "totaal") -> DataFrame:
    """Row counts per value of ``column`` as columns (missing = 0) with an optional row total."""
    counted = df.groupBy(*rows).agg(
        *[F.count(F.when(F.col(column) == v, 1)).alias(str(v)) for v in values],
        *([F.count(F.lit(1)).alias(total)] if total else []))
    return counted


def pivot_sums(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], measure: Column) -> DataFrame:
    """Sums of ``measure`` per value of ``column`` as columns (missing = 0)."""
    return df.groupBy(*rows).agg(
        *[F.coalesce(F.sum(F.when(F.col(column) == v, measure)), F.lit(0)).alias(str(v)) for v in values])


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str], normalize: bool = True, digits: int = 1) -> DataFrame:
    """Counts of ``row`` x ``column``, as percentages of the row when ``normalize``."""
    counts = pivot_counts(df, [row], column, values, "_total")
    if not normalize:
        return counts.drop("_total")
    return counts.select(row, *[percentage(F.col(str(v)), F.col("_total"), digits).alias(str(v)) for v in values])


def margins(df: DataFrame, a: str, b: str, total: str = "totaal", count: str = "aantal") -> DataFrame:
    """Counts per (a, b) together with both margins and the grand total."""
    def label(c: str) -> Column:
        return F.when(F.grouping(c) == 1, F.lit(total)).otherwise(F.col(c).cast("string"))

    return (df.cube(a, b).agg(F.count(F.lit(1)).alias(count), label(a).alias("_a"), label(b).alias("_b"))
            .select(F.col("_a").alias(a), F.col("_b").alias(b), count))


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "variabele", value: str = "waarde") -> DataFrame:
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in columns], name, value)


def coverage(df: DataFrame, group: Sequence[str], flags: Mapping[str, Column], digits: int = 1) -> DataFrame:
    """Per group and variable: rows, rows with a value, and the share with a value."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"),
                                    *[F.count(F.when(c, 1)).alias(name) for name, c in flags.items()])
    long = melt(counts, [*group, "n"], list(flags), "variabele", "ingevuld")
    return long.withColumn("percentage", percentage(F.col("ingevuld"), F.col("n"), digits))
