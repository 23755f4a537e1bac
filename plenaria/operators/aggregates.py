"""Grouped aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plenaria.functions.numbers import percentage
from plenaria.session import stored


def argmax_by(df: DataFrame, group: Sequence[str], value: str, weight: Column, out: str | None = None) -> DataFrame:
    """Per group the value with the largest summed weight; ties go to the smallest value, weights of NULL come last."""
    totals = df.groupBy(*group, value).agg(weight.alias("_weight"))
    best = F.min_by(F.col(value), F.struct(F.col("_weight").isNull(), -F.col("_weight"), F.col(value)))
    return totals.groupBy(*group).agg(best.alias(out or value))


def first_by(df: DataFrame, group: Sequence[str], columns: Mapping[str, str], order: Column) -> DataFrame:
    """Per group the columns of the row with the smallest ``order``."""
    packed = F.struct(*[F.col(c).alias(out) for out, c in columns.items()])
    return df.groupBy(*group).agg(F.min_by(packed, order).alias("_row")).select(*group, "_row.*")


def last_by(df: DataFrame, group: Sequence[str], columns: Mapping[str, str], order: Column) -> DataFrame:
    """Per group the columns of the row with the largest ``order``."""
    packed = F.struct(*[F.col(c).alias(out) for out, c in columns.items()])
    return df.groupBy(*group).agg(F.max_by(packed, order).alias("_row")).select(*group, "_row.*")


def share(df: DataFrame, by: Sequence[str], within: Sequence[str] = (), count: str = "aantal",
          out: str = "aandeel", digits: int = 1) -> DataFrame:
    """Rows per value with their share in percent of all rows, or of the ``within`` group."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    if not within:
        total = df.agg(F.count(F.lit(1)).alias("_total")).scalar()
        return counts.withColumn(out, percentage(F.col(count), total, digits))
    window = Window.partitionBy(*within)
    return counts.withColumn(out, percentage(F.col(count), F.sum(count).over(window), digits))


def two_level(df: DataFrame, inner: Sequence[str], inner_aggs: Sequence[Column],
              outer: Sequence[str], outer_aggs: Sequence[Column]) -> DataFrame:
    """Aggregate, then aggregate the result."""
    return df.groupBy(*inner).agg(*inner_aggs).groupBy(*outer).agg(*outer_aggs)


def quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Mapping[str, float],
              few_values: bool = False, ranges: int | None = None) -> DataFrame:
    """Exact interpolated quantiles per group.

    ``few_values`` is for values with a naturally small domain (days, years, ages): equal values
    are counted first and the quantiles come from the counts of a group.

    Otherwise the values are selected by rank. Equal values of a group are counted, in their task
    first, and the counts are sorted over ``ranges`` range partitions (by default as many as Spark
    uses), so that a large group spreads over many. Sums per range tell in which range a rank lies,
    and values are numbered in those ranges only. The input is read once.
    """
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"))
    if few_values:
        counts = rows.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
        array = F.percentile("_v", list(probs.values()), F.col("_n"))
        wide = counts.groupBy(*group).agg(array.alias("_q"))
        return wide.select(*group, *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)])

    counts = rows.withColumn("_v", F.col("_v").cast("double")).groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    order = [*group, "_v"]
    spread = counts.repartitionByRange(ranges, *order) if ranges else counts.repartitionByRange(*order)
    # stored, so that both uses see the same ranges
    ranged = stored(spread.withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*group, "_part").agg(F.sum("_n").alias("_in")).select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_part").alias("_of"), "_in",
        F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_before"), F.sum("_in").over(Window.partitionBy(*group)).alias("_rows"))
    places = [F.lit(p) * (F.col("_rows") - 1) for p in probs.values()]
    ranks = [(F.floor(x), F.ceil(x)) for x in places]

    def within(rank: Column, start: Column, count: Column) -> Column:
        return (rank >= start) & (rank < start + count)

    wanted = sums.where(reduce(lambda x, y: x | y, (within(r, F.col("_before"), F.col("_in")) for pair in ranks for r in pair)))
    condition = F.col("_part") == F.col("_of")
    for g in group:
        condition = condition & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    running = Window.partitionBy("_part", *group).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.join(wanted, condition).select(*group, "_v", "_n", "_rows", (F.col("_before") + F.sum("_n").over(running) - F.col("_n")).alias("_start"))
    hits = [F.max(F.when(within(r, F.col("_start"), F.col("_n")), F.col("_v"))) for pair in ranks for r in pair]
    picked = placed.groupBy(*group).agg(F.max("_rows").alias("_rows"), *[h.alias(f"_hit{k}") for k, h in enumerate(hits)])
    low, high = ([F.col(f"_hit{2 * i + k}") for i in range(len(places))] for k in (0, 1))
    return picked.select(*group, *[(a + (x - F.floor(x)) * (z - a)).alias(name) for name, x, a, z in zip(probs, places, low, high, strict=True)])


def describe(df: DataFrame, group: Sequence[str], value: str, probs: Mapping[str, float] | None = None,
             few_values: bool = False, digits: int = 4) -> DataFrame:
    """Count, mean, standard deviation, extremes and quantiles per group."""
    probs = probs or {"p25": 0.25, "mediaan": 0.5, "p75": 0.75}
    base = df.groupBy(*group).agg(
        F.count(value).alias("aantal"), F.round(F.avg(value), digits).alias("gemiddelde"),
        F.round(F.stddev_samp(value), digits).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    spots = quantiles(df, group, value, probs, few_values)
    if not group:
        found = spots.select(F.struct(*probs).alias("q")).scalar()
        return base.select("*", *[found[p].alias(p) for p in probs])
    return base.join(spots, list(group), "left")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per group; the limit already applies before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k)
    return ranked.drop("_rank") if rank is None else ranked.withColumnRenamed("_rank", rank)


def top_with_other(df: DataFrame, key: str, value: str, n: int, label: str = "Overige") -> DataFrame:
    """Totals of the ``n`` largest keys, and one row for all other keys together.

    The input holds one total per key. The top keys are found by a distributed top-n.
    """
    top = df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(n)
    rest = df.join(top.select(key), key, "left_anti")
    other = rest.agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias(value)).where("_n > 0")
    return top.select(key, value).unionByName(other.select(F.lit(label).alias(key), value))


def ordered_strings(df: DataFrame, group: Sequence[str], value: str, out: str, separator: str = ", ") -> DataFrame:
    """Distinct values per group in order, joined to one text."""
    names = F.array_join(F.array_sort(F.collect_set(value)), separator)
    return df.groupBy(*group).agg(names.alias(out))


def drop_last_group(df: DataFrame, key: str) -> DataFrame:
    """Without the rows of the largest key (an incomplete period)."""
    return df.where(F.col(key) < df.agg(F.max(key).alias("_last")).scalar())


def iqr_filter(df: DataFrame, value: str, k: float = 1.5, few_values: bool = False) -> DataFrame:
    """Rows strictly inside the quartile fences."""
    q = quantiles(df, [], value, {"q1": 0.25, "q3": 0.75}, few_values)
    reach = q.select(F.struct((F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lo"),
                              (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("hi")).alias("fences")).scalar()
    return df.where((F.col(value) > reach["lo"]) & (F.col(value) < reach["hi"]))


def quantile_cut(df: DataFrame, value: str, prob: float, few_values: bool = False) -> DataFrame:
    """Rows up to the given upper quantile."""
    limit = quantiles(df, [], value, {"q": prob}, few_values)
    return df.where(F.col(value) <= limit.scalar())
