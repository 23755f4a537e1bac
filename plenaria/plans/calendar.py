"""Date and year dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenaria.functions.dates import OPEN_END_KEY, UNKNOWN_KEY, date_attributes, date_key, decade


def calendar(spark: SparkSession, first: date, last: date, attributes: Sequence[str]) -> DataFrame:
    """One row per day of a fixed range."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("datum"))
    return days.select("datum", *date_attributes(F.col("datum"), list(attributes)))


def calendar_over(frames: Sequence[tuple[DataFrame, Sequence[str]]], attributes: Sequence[str],
                  also: Sequence[date] = ()) -> DataFrame:
    """One row per day between the earliest and latest date of several columns and extra days.

    Each table is reduced to its bounds in one scan; only those single rows are combined.
    """
    bounds = None
    for df, columns in frames:
        lows, highs = ([f(F.col(c).cast("date")) for c in columns] for f in (F.min, F.max))
        low, high = (lows[0] if len(lows) == 1 else F.least(*lows)), (highs[0] if len(highs) == 1 else F.greatest(*highs))
        one = df.agg(low.alias("lo"), high.alias("hi"))
        bounds = one if bounds is None else bounds.unionByName(one)
    spark = frames[0][0].sparkSession
    for day in also:
        bounds = bounds.unionByName(spark.range(1).select(F.lit(day).alias("lo"), F.lit(day).alias("hi")))
    ends = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo is not null")
    days = ends.select(F.explode(F.sequence("lo", "hi")).alias("datum"))
    return days.select("datum", *date_attributes(F.col("datum"), list(attributes)))


def with_special_days(dates: DataFrame) -> DataFrame:
    """Contact-star date dimension: key, day, month, year, plus the unknown and still-running members."""
    named = dates.select(date_key(F.col("datum")).cast("int").alias("date_key"), F.col("datum").alias("calendar_date"),
                         F.date_format("datum", "yyyy-MM").alias("month"), F.year("datum").cast("bigint").alias("year"))
    extra = dates.sparkSession.createDataFrame([(UNKNOWN_KEY, "Onbekend"), (OPEN_END_KEY, "Nog actief")], "date_key int, month string")
    return named.unionByName(extra, allowMissingColumns=True)


def year_dimension(spark: SparkSession, first: int = 1750, last: int = 2030) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").alias("jaar"), decade(F.col("id")).alias("decennium"))


def day_or_unknown(day: Column) -> Column:
    """Fact date key where an empty day is unknown."""
    return date_key(day, UNKNOWN_KEY).cast("int")


def day_or_open(day: Column) -> Column:
    """Fact date key where an empty day means still running."""
    return date_key(day, OPEN_END_KEY).cast("int")
