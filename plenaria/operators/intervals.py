"""Joins and counts over validity intervals with inclusive ends (empty end = still running)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from plenaria.session import stored

#: Days of a slot of the finest level, slots of a level in one of the next, and levels. A date has a row per level in a
#: join, so there are few. Days further from 1970 than so many of the finest slots (89 years) share the first or last one.
SLOT_DAYS, FAN, LEVELS = 32, 32, 2
REACH = FAN**LEVELS
#: Days of a chunk in which groups_on_day() gathers what runs, and chunks on either side of 1970 (89 years), the last of which have all days beyond.
CHUNK_DAYS, CHUNKS = 512, 64
#: Most slots of one interval, however long it is.
MOST_SLOTS = 2 * (FAN - 1) * (LEVELS - 1) + 2 * REACH // FAN ** (LEVELS - 1)


def _slot(day: Column, slot_days: int) -> Column:
    number = F.floor(F.unix_date(day) / slot_days)
    return F.when(number.isNotNull(), F.greatest(F.least(number, F.lit(REACH - 1)), F.lit(-REACH)))


def _keyed(level: int, number: Column) -> Column:
    return number * LEVELS + level


def cover(first: Column, last: Column, level: int = 0) -> Column:
    """The fewest slots of all levels that make up the finest slots from ``first`` to ``last``, as keys.

    Of each level but the coarsest there are at most ``2 * (FAN - 1)``, and ``MOST_SLOTS`` in all.
    """
    def span(a: Column, b: Column) -> Column:
        numbers = F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda n: _keyed(level, n))

    if level == LEVELS - 1:
        return span(first, last)
    above, below = F.ceil(first / FAN), F.floor((last + 1) / FAN) - 1
    whole = above <= below
    left = span(first, F.when(whole, above * FAN - 1).otherwise(last))
    right = span(F.when(whole, (below + 1) * FAN).otherwise(last + 1), last)
    return F.concat(left, right, cover(F.when(whole, above).otherwise(F.lit(1)), F.when(whole, below).otherwise(F.lit(0)), level + 1))


def interval_join(points: DataFrame, members: DataFrame, keys: Sequence[str], at: str, start: str, end: str,
                  how: str = "inner", slot_days: int = SLOT_DAYS, on_overlap: str = "all",
                  row_key: Sequence[str] = (), order: Sequence[str] = (), until: date | None = None) -> DataFrame:
    """Attach to each dated row the interval rows of the same key that cover its date.

    Time is cut into slots of several widths, each ``FAN`` times the last. An interval becomes the few slots that make
    it up (see ``cover``), a date looks into its one slot of each width, and both meet by key and slot. So the rows of
    one key divide over its slots, an interval's rows do not grow with its length, and a date meets only intervals that
    cover its slot. Each interval has at most one slot of a date's, so no match appears twice; both inputs are read once.

    The interval rows' slots are many more than the rows that Spark's size estimate goes by, so they are never broadcast.

    Open ends have none; with ``until`` later dates match nothing open. ``how`` is inner or left; for left the dated
    rows are stored with a number, only number, keys and date look for intervals, and the matches join back by number. ``on_overlap='latest'`` keeps, per ``row_key``, only
    the interval that started last (ties: highest ``order``).
    Column names of the two inputs must differ except for ``keys``.
    """
    others = [c for c in members.columns if c not in keys]
    if how == "left":
        numbered = stored(points.withColumn("_point", F.monotonically_increasing_id()))
        found = interval_join(numbered.select("_point", *dict.fromkeys([*keys, at])), members, keys, at, start, end, "inner", slot_days, until=until).select("_point", *others)
        joined = numbered.join(found, "_point", "left")
    else:
        last = F.coalesce(F.col(end), F.lit(until) if until else F.lit(date.max))
        slots = cover(_slot(F.col(start), slot_days), _slot(last, slot_days))
        spread = members.where(F.col(start) <= last).select(*[F.col(k).alias(f"_m_{k}") for k in keys], F.explode(slots).alias("_slot"), *others)
        number = _slot(F.col(at), slot_days)
        probes = F.array(*[_keyed(level, F.floor(number / FAN**level)) for level in range(LEVELS)])
        dated = points.where(F.col(at).isNotNull()).withColumn("_at_slot", F.explode(probes))
        condition = (F.col("_at_slot") == F.col("_slot")) & F.col(at).between(F.col(start), F.coalesce(F.col(end), F.lit(until or date.max)))
        for k in keys:
            condition = condition & (F.col(k) == F.col(f"_m_{k}"))
        joined = dated.join(spread.hint("merge"), condition, how)
    if on_overlap == "latest":
        newest = Window.partitionBy(*row_key).orderBy(
            F.col(start).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in order])
        joined = joined.withColumn("_n", F.row_number().over(newest)).where("_n = 1")
    return joined.select(*points.columns, *others)


def expand_years(members: DataFrame, start: str, end: str, lo: int | Column, hi: int | Column, out: str = "jaar") -> DataFrame:
    """One row per calendar year in which the interval is active, clipped to ``lo..hi``."""
    lo, hi = (b if isinstance(b, Column) else F.lit(b) for b in (lo, hi))
    first = F.greatest(F.year(F.col(start)), lo)
    last = F.least(F.coalesce(F.year(F.col(end)), hi), hi)
    return (members.where(F.col(start).isNotNull() & (first <= last))
            .withColumn(out, F.explode(F.sequence(first, last))))


def year_membership(facts: DataFrame, members: DataFrame, keys: Sequence[str], year: str, start: str, end: str,
                    how: str = "left") -> DataFrame:
    """Attach the memberships whose years cover the fact's year; overlaps fan out.

    Memberships are expanded to one row per year first, which turns the range test into an equi-join on key and year.
    After the last year in which any membership begins or ends the same ones stay open, so one more year stands for all
    later ones: open memberships run up to that year, and later facts look there. The facts are read once.
    """
    years = members.agg(F.struct(F.min(F.year(start)).alias("first"), (F.greatest(F.max(F.year(start)), F.max(F.year(end))) + 1).alias("last")).alias("y")).scalar()
    per_year = expand_years(members, start, end, years["first"], years["last"], "_year")
    renamed = per_year.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "_year",
                              *[c for c in members.columns if c not in keys])
    condition = F.when(F.col(year).isNotNull(), F.least(F.col(year), years["last"])) == F.col("_year")
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_m_{k}"))
    return facts.join(renamed, condition, how).select(
        *facts.columns, *[c for c in members.columns if c not in keys])


def merge_intervals(members: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Union of the intervals of one key as disjoint intervals (open end stays NULL).

    Rows are first reduced to one per key and start day, so a window group is at most one row
    per calendar day however many rows the key has.
    """
    far = F.lit("9999-12-31").cast("date")
    per_day = (members.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) <= F.col(end))))
               .groupBy(*keys, start).agg(F.max(F.coalesce(F.col(end), far)).alias("_end")))
    before = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    running = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, 0)
    opened = F.when(F.col(start) > F.max("_end").over(before), 1).otherwise(0)
    return (per_day.withColumn("_opened", opened)
            .withColumn("_island", F.sum("_opened").over(running))
            .groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max("_end").alias(end))
            .withColumn(end, F.when(F.col(end) < far, F.col(end)))
            .drop("_island"))


def count_active(events: DataFrame, members: DataFrame, keys: Sequence[str], at: str, start: str, end: str,
                 distinct: Sequence[str], out: str) -> DataFrame:
    """How many distinct, known members of the event's key are active on the event's date.

    Works from daily changes: +1 on the first day of a member's merged interval, -1 on the day
    after its last. The running total per key has at most one row per calendar day, and events
    pick it up with an equi-join, so no event is compared with the members one by one.
    """
    named = members
    for c in distinct:
        named = named.where(F.col(c).isNotNull())
    merged = merge_intervals(named, [*keys, *distinct], start, end)
    steps = F.array(F.struct(F.col(start).alias("_day"), F.lit(1).alias("_step")),
                    F.struct(F.date_add(F.col(end), 1).alias("_day"), F.lit(-1).alias("_step")))
    changes = (merged.select(*keys, F.inline(steps)).where("_day IS NOT NULL")
               .unionByName(events.select(*keys, F.col(at).alias("_day")).distinct()
                            .withColumn("_step", F.lit(0))))
    running = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    totals = (changes.groupBy(*keys, "_day").agg(F.sum("_step").alias("_step"))
              .select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_day",
                      F.sum("_step").over(running).alias("_active")))
    condition = F.col(at) == F.col("_day")
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_t_{k}"))
    return events.join(totals, condition, "left").select(
        *events.columns, F.coalesce(F.col("_active"), F.lit(0)).cast("bigint").alias(out))


def _chunk(day: Column) -> Column:
    return F.greatest(F.least(F.floor(F.unix_date(day) / CHUNK_DAYS), F.lit(CHUNKS - 1)), F.lit(-CHUNKS))


def groups_on_day(points: DataFrame, members: DataFrame, details: DataFrame, keys: Sequence[str], at: str, group: str, start: str, end: str, out: str) -> DataFrame:
    """Each distinct dated row with every group that has intervals of its key on its date, and the columns of its key's details.

    ``out`` counts the pairs of rows equal to it and such intervals. Intervals have both ends; missing keys and dates match nothing.

    The intervals of a key and group become steps, each a time in which their number stays the same, from daily changes; so
    however many intervals there are, a key has at most a step per group and day. Steps are gathered per key and chunk of
    time with the details, and dated rows are shuffled once, to their chunk: their copies are counted there, too.
    """
    others = [c for c in details.columns if c not in keys]
    changes = F.array(F.struct(F.col(start).alias("_first"), F.lit(1).alias("_step")), F.struct(F.date_add(F.col(end), 1).alias("_first"), F.lit(-1).alias("_step")))
    ends = members.dropna(subset=list(keys)).where(F.col(start) <= F.col(end)).select(*keys, F.col(group).alias("_group"), F.inline(changes))
    daily = ends.groupBy(*keys, "_group", "_first").agg(F.sum("_step").alias("_step")).repartition(*keys)
    ahead = Window.partitionBy(*keys, "_group").orderBy("_first")
    steps = daily.select(*keys, "_group", "_first", F.date_sub(F.lead("_first").over(ahead), 1).alias("_last"), F.sum("_step").over(ahead).cast("int").alias("_n")).where("_n > 0")
    running = (steps.withColumn("_chunk", F.explode(F.sequence(_chunk(F.col("_first")), _chunk(F.col("_last")))))
               .groupBy(*keys, "_chunk").agg(F.collect_list(F.struct("_first", "_last", "_group", "_n")).alias("_steps"))
               .select(*keys, "_chunk", *[F.col(f"_steps.{c}").alias(c) for c in ("_first", "_last", "_group", "_n")]))  # a list each: less than half the bytes
    dated = points.dropna(subset=[*keys, at]).withColumn("_chunk", _chunk(F.col(at))).repartition(*keys, "_chunk")
    counted = dated.groupBy(*points.columns, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    met = counted.join(running.join(details, list(keys)), [*keys, "_chunk"])
    held = met.select(*points.columns, "_rows", F.explode(F.filter(F.arrays_zip("_first", "_last", "_group", "_n"), lambda s: F.col(at).between(s["_first"], s["_last"]))).alias("_held"), *others)
    return held.select(*points.columns, F.col("_held._group").alias(group), (F.col("_rows") * F.col("_held._n")).alias(out), *others)
