"""Decisions, activities and the life cycle of cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.functions.numbers import percentage
from plenaria.operators.aggregates import quantiles, share, top_per_group, two_level
from plenaria.operators.references import not_in
from plenaria.operators.reshape import melt, pivot_counts
from plenaria.rules.classifiers import outcome_by_regex
from plenaria.rules.fixed import OUTCOMES


def with_outcome(decisions: DataFrame, kind: str = "besluit_soort") -> DataFrame:
    return decisions.withColumn("uitkomst", outcome_by_regex(F.col(kind)))


def outcome_shares(decided: DataFrame, by: str) -> DataFrame:
    """Outcome shares within each kind of case."""
    return share(decided.where(F.col("uitkomst").isNotNull()), [by, "uitkomst"], [by], digits=2)


def outcomes_per_proposer(decided: DataFrame, by: str, case: str = "zaak_id", outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    """Outcome percentages per proposer over distinct (case, outcome) pairs, plus distinct cases."""
    named = decided.where(F.col(by).isNotNull())
    unique = named.select(case, by, "uitkomst").distinct()
    counts = pivot_counts(unique.where(F.col("uitkomst").isNotNull()), [by], "uitkomst", outcomes, "_total")
    cases = unique.groupBy(by).agg(F.countDistinct(case).alias("aantal_zaken"))
    return counts.join(cases, by).select(by, *[percentage(F.col(o), F.col("_total"), 2).alias(o) for o in outcomes], "aantal_zaken")


def top_per_outcome(shares: DataFrame, by: str, k: int = 3, outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    """Top proposers per outcome, leaving out those with any 100%."""
    mixed = F.lit(True)
    for o in outcomes:
        mixed = mixed & (F.col(o) != 100)
    long = melt(shares.where(mixed), [by, "aantal_zaken"], list(outcomes), "categorie", "percentage")
    return top_per_group(long, ["categorie"], [F.col("percentage").desc(), F.col(by).asc()], k)


def most_common_outcome(decided: DataFrame, by: str) -> DataFrame:
    """Per kind the outcome with the highest share."""
    shares = outcome_shares(decided, by)
    return top_per_group(shares, [by], [F.col("aantal").desc(), F.col("uitkomst").asc()], 1)


def duration_by_outcome(decided: DataFrame, minutes: str = "duur_minuten") -> DataFrame:
    """Count, mean and median duration per outcome; a duration in whole minutes has few values."""
    rows = decided.where(F.col("uitkomst").isNotNull() & F.col(minutes).isNotNull())
    base = rows.groupBy("uitkomst").agg(F.count(F.lit(1)).alias("aantal"), F.round(F.avg(minutes), 2).alias("gemiddelde"))
    return base.join(quantiles(rows, ["uitkomst"], minutes, {"mediaan": 0.5}, few_values=True), "uitkomst")


def activities_per_day(activities: DataFrame, day: str = "datum") -> DataFrame:
    """How many days have 1, 2, 3, ... activities."""
    return two_level(activities, [day], [F.count(F.lit(1)).alias("activiteiten")], ["activiteiten"], [F.count(F.lit(1)).alias("dagen")])


def kinds_per_day(activities: DataFrame, day: str = "datum", kind: str = "soort") -> DataFrame:
    """How many days have 1, 2, 3, ... different kinds of activity."""
    return two_level(activities, [day], [F.countDistinct(kind).alias("soorten")], ["soorten"], [F.count(F.lit(1)).alias("dagen")])


def not_done(cases: DataFrame, kind: str = "soort", done: str = "afgedaan", min_cases: int = 1) -> DataFrame:
    """Share of cases not done per kind, for kinds with any case not done and enough cases."""
    totals = cases.where(F.col(kind).isNotNull()).groupBy(kind).agg(
        F.count(F.lit(1)).alias("totaal"), F.count(F.when(~F.col(done), 1)).alias("niet_afgedaan"))
    return totals.where((F.col("niet_afgedaan") > 0) & (F.col("totaal") >= min_cases)).withColumn(
        "pct_niet_afgedaan", percentage(F.col("niet_afgedaan"), F.col("totaal"), 2))


def always_done(cases: DataFrame, kind: str = "soort", done: str = "afgedaan") -> DataFrame:
    """Kinds without any case that is not done. A case without kind that is not done makes the
    SQL ``NOT IN`` empty, as in the source analysis."""
    return not_in(cases.select(kind).distinct(), kind, cases.where(~F.col(done)).select(kind), "sql")


def done_summary(cases: DataFrame, done: str = "afgedaan", title: str = "titel") -> DataFrame:
    """Totals: cases, done, not done, without title."""
    return cases.agg(F.count(F.lit(1)).alias("zaken"), F.count(F.when(F.col(done), 1)).alias("afgedaan"),
                     F.count(F.when(~F.col(done), 1)).alias("niet_afgedaan"),
                     F.count(F.when(F.col(title).isNull(), 1)).alias("zonder_titel"))


def openness_counts(activities: DataFrame, label: Column) -> DataFrame:
    return activities.groupBy(label.alias("type_activiteit")).agg(F.count(F.lit(1)).alias("aantal"))
