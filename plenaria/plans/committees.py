"""Committee structure and influence."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.functions.dates import active_at, close_interval, completed_years, days_between
from plenaria.functions.numbers import exact_mean, percentage, ratio
from plenaria.operators.aggregates import quantiles
from plenaria.operators.references import full_outer_counts
from plenaria.rules.classifiers import committee_type_analysis
from plenaria.rules.fixed import DONE_STATUS


def by_type(committees: DataFrame, kind: Column | None = None) -> DataFrame:
    """Committees and still active ones per type."""
    kind = committee_type_analysis(F.col("naam_nl")) if kind is None else kind
    return committees.groupBy(kind.alias("commissietype")).agg(
        F.count(F.lit(1)).alias("aantal"), F.count(F.when(F.col("datum_inactief").isNull(), 1)).alias("nog_actief"))


def seat_counts(sittings: DataFrame, as_of: date) -> DataFrame:
    """Seats occupied on a day per committee."""
    now = sittings.where(active_at(F.col("van"), F.col("tot_en_met"), F.lit(as_of)))
    return now.groupBy("commissie_id").agg(F.countDistinct("commissie_zetel_id").alias("aantal_zetels"))


def vacancies(vacant: DataFrame, as_of: date, by: str = "commissie_id") -> DataFrame:
    """Vacancies, those open now and mean days open."""
    days = days_between(F.col("van"), close_interval(F.col("tot_en_met"), as_of))
    return vacant.groupBy(by).agg(
        F.count(F.lit(1)).alias("vacatures"), F.count(F.when(F.col("tot_en_met").isNull(), 1)).alias("nu_open"),
        F.round(F.avg(days), 0).alias("gem_dagen_open"))


def per_year(rows: DataFrame, day: str, out: str) -> DataFrame:
    return rows.where(F.col(day).isNotNull()).groupBy(F.year(day).cast("bigint").alias("jaar")).agg(F.count(F.lit(1)).alias(out))


def inflow_outflow(sittings: DataFrame) -> DataFrame:
    """Members who started and who left per year; a missing side is 0."""
    return full_outer_counts(per_year(sittings, "van", "nieuwe_leden"), per_year(sittings, "tot_en_met", "vertrokken_leden"), "jaar")


def tenure(sittings: DataFrame, as_of: date, by: str = "commissie_id", min_sittings: int = 10) -> DataFrame:
    """Mean sitting length in years of committees with enough sittings."""
    days = days_between(F.col("van"), close_interval(F.col("tot_en_met"), as_of))
    totals = (sittings.where(F.col("van").isNotNull()).groupBy(by)
              .agg(F.count(F.lit(1)).alias("zittingen"), F.sum(days).alias("_d")).where(F.col("zittingen") >= min_sittings))
    return totals.select(by, "zittingen", F.round(ratio(F.col("_d"), F.col("zittingen")) / 365.25, 1).alias("gem_jaren"))


def gender(members: DataFrame, by: str = "commissie_id", min_members: int = 5) -> DataFrame:
    """Women and men among the distinct members, with the share of women."""
    people = members.select(by, "persoon_id", F.lower("geslacht").alias("_g")).distinct()
    totals = people.groupBy(by).agg(
        F.count(F.when(F.col("_g").startswith("vrouw"), 1)).alias("vrouwen"),
        F.count(F.when(F.col("_g").startswith("man"), 1)).alias("mannen"), F.count(F.lit(1)).alias("totaal"))
    return totals.where(F.col("totaal") >= min_members).withColumn("pct_vrouw", percentage(F.col("vrouwen"), F.col("totaal")))


def ages(members: DataFrame, as_of: date, by: str = "commissie_id") -> DataFrame:
    """Member count, mean, median, youngest and oldest age in completed years."""
    people = (members.where(F.col("geboortedatum").isNotNull())
              .select(by, "persoon_id", completed_years(F.col("geboortedatum"), F.lit(as_of)).alias("leeftijd")).distinct())
    base = people.groupBy(by).agg(F.count(F.lit(1)).alias("leden"), F.round(F.avg("leeftijd"), 1).alias("gemiddeld"),
                                  F.min("leeftijd").alias("jongste"), F.max("leeftijd").alias("oudste"))
    return base.join(quantiles(people, [by], "leeftijd", {"mediaan": 0.5}, few_values=True), by)


def lead_activities(activities: DataFrame, by: str = "voortouwcommissie_id") -> DataFrame:
    return activities.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("activiteiten"))


def linked_cases(activities: DataFrame, items: DataFrame, decisions: DataFrame, decision_cases: DataFrame) -> DataFrame:
    """Distinct cases with a decision on an agenda item of the committee's activities."""
    chain = (activities.where(F.col("voortouwcommissie_id").isNotNull())
             .select(F.col("id").alias("activiteit_id"), F.col("voortouwcommissie_id").alias("commissie_id"))
             .join(items.select(F.col("id").alias("agendapunt_id"), "activiteit_id"), "activiteit_id")
             .join(decisions.select(F.col("id").alias("besluit_id"), "agendapunt_id"), "agendapunt_id")
             .join(decision_cases.select("besluit_id", "zaak_id"), "besluit_id"))
    return chain.groupBy("commissie_id").agg(F.countDistinct("zaak_id").alias("zaken"))


def effectiveness(activities: DataFrame, by: str = "voortouwnaam", min_activities: int = 100, done: str = DONE_STATUS) -> DataFrame:
    """Share of activities that took place."""
    totals = activities.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("totaal"), F.count(F.when(F.lower("status") == done.lower(), 1)).alias("uitgevoerd"))
    return totals.where(F.col("totaal") >= min_activities).withColumn(
        "pct_uitgevoerd", percentage(F.col("uitgevoerd"), F.col("totaal")))


def scorecard(committees: DataFrame, sittings: DataFrame, vacant: DataFrame, activities: DataFrame, as_of: date) -> DataFrame:
    """One row per committee: type, seats, vacancies, tenure and activities."""
    base = committees.select(F.col("id").alias("commissie_id"), "naam_nl", committee_type_analysis(F.col("naam_nl")).alias("commissietype"))
    lead = lead_activities(activities).withColumnRenamed("voortouwcommissie_id", "commissie_id")
    joined = (base.join(seat_counts(sittings, as_of), "commissie_id", "left")
              .join(vacancies(vacant, as_of), "commissie_id", "left")
              .join(tenure(sittings, as_of, min_sittings=1), "commissie_id", "left")
              .join(lead, "commissie_id", "left"))
    return joined.fillna(0, ["aantal_zetels", "vacatures", "nu_open", "activiteiten", "zittingen"])
