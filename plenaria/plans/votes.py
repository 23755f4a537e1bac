"""Voting analyses over vote rows.

Vote rows have ``besluit_id, fractie_id, persoon_id, soort, fractie_grootte, vergissing``. A row
without a person is the vote of a whole faction. Ties in weight go to the smallest label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.functions.numbers import percentage, ratio
from plenaria.operators.aggregates import argmax_by, two_level
from plenaria.operators.pairs import co_occurrence
from plenaria.rules.fixed import AGAINST, FOR
from plenaria.session import checkpoint

MISTAKE = "vergissing"


def valid_votes(votes: DataFrame, options: Sequence[str] | None = (FOR, AGAINST), keep_unknown: bool = False) -> DataFrame:
    """Votes that count: no mistakes, and one of the given options.

    A NULL mistake flag is dropped unless ``keep_unknown``.
    """
    flag = F.col(MISTAKE)
    rows = votes.where(F.coalesce(~flag, F.lit(True)) if keep_unknown else ~flag)
    return rows if options is None else rows.where(F.col("soort").isin(list(options)))


def _weight() -> Column:
    return F.coalesce(F.col("fractie_grootte"), F.lit(1)).cast("decimal(18,2)")


def unanimity(votes: DataFrame, min_votes: int = 1, min_decisions: int = 1) -> DataFrame:
    """Per faction the decisions in which all its votes were equal.

    ``min_votes`` > 1 looks only at decisions with several vote rows of the faction.
    """
    per_decision = (valid_votes(votes, None).groupBy("fractie_id", "besluit_id")
                    .agg(F.count(F.lit(1)).alias("stemmen"), F.countDistinct("soort").alias("opties"))
                    .where(F.col("stemmen") >= min_votes))
    totals = per_decision.groupBy("fractie_id").agg(
        F.count(F.lit(1)).alias("besluiten"), F.count(F.when(F.col("opties") == 1, 1)).alias("unaniem"))
    return (totals.where(F.col("besluiten") >= min_decisions)
            .withColumn("pct_unaniem", percentage(F.col("unaniem"), F.col("besluiten"))))


def votes_per_faction_decision(votes: DataFrame) -> DataFrame:
    """How often a faction has 1, 2, 3, ... vote rows on one decision."""
    return two_level(votes, ["besluit_id", "fractie_id"], [F.count(F.lit(1)).alias("stemmen")],
                     ["stemmen"], [F.count(F.lit(1)).alias("aantal")])


def faction_position(votes: DataFrame) -> DataFrame:
    """One position per faction and decision: the option with the most weight, and that weight.

    Votes are summed per decision, faction and option first, which leaves a few rows per decision.
    Those are partitioned by decision once; the steps after it, and joins on the decision, need no
    further shuffle.
    """
    totals = (valid_votes(votes).groupBy("besluit_id", "fractie_id", "soort").agg(F.sum(_weight()).alias("gewicht"))
              .repartition("besluit_id"))
    best = F.min_by(F.struct("soort", "gewicht"), F.struct(-F.col("gewicht"), F.col("soort")))
    return totals.groupBy("besluit_id", "fractie_id").agg(best.alias("_b")).select("besluit_id", "fractie_id", "_b.*")


def majority(positions: DataFrame, weight: str = "gewicht") -> DataFrame:
    """The option with the most weight per decision."""
    return argmax_by(positions, ["besluit_id"], "soort", F.sum(weight), "meerderheid")


def member_weighted(votes: DataFrame) -> DataFrame:
    """Vote rows weighing the faction's size, or 1 for a single member."""
    weight = F.when(F.col("persoon_id").isNull(), _weight()).otherwise(F.lit(1).cast("decimal(18,2)"))
    return valid_votes(votes, keep_unknown=True).withColumn("gewicht", weight)


def against_majority(votes: DataFrame, min_decisions: int = 20, factions: Sequence | None = None) -> DataFrame:
    """How often each faction's position differs from the majority.

    A faction filter applies after the majority is known.
    """
    positions = faction_position(votes)
    joined = positions.join(majority(positions), "besluit_id")
    if factions is not None:
        joined = joined.where(F.col("fractie_id").isin(list(factions)))
    return _against(joined, ["fractie_id"]).where(F.col("besluiten") >= min_decisions)


def _against(joined: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("besluiten"),
        F.count(F.when(F.col("soort") != F.col("meerderheid"), 1)).alias("tegen"))
    return totals.withColumn("pct_tegen", percentage(F.col("tegen"), F.col("besluiten")))


def against_majority_rows(votes: DataFrame, factions: Sequence | None = None) -> DataFrame:
    """Row version: every faction vote row counts, with the faction's mean size."""
    rows = valid_votes(votes, keep_unknown=True).where(F.col("persoon_id").isNull()).withColumn("gewicht", _weight())
    joined = rows.join(majority(rows), "besluit_id")
    if factions is not None:
        joined = joined.where(F.col("fractie_id").isin(list(factions)))
    size = joined.groupBy("fractie_id").agg(
        F.sum(F.col("fractie_grootte").cast("decimal(18,2)")).alias("_s"), F.count("fractie_grootte").alias("_n"))
    sizes = size.select("fractie_id", ratio(F.col("_s"), F.col("_n"), 4).alias("fractiegrootte"))
    return _against(joined, ["fractie_id"]).join(sizes, "fractie_id")


def dissent_from_faction(votes: DataFrame, min_votes: int = 10, top: int | None = 25) -> DataFrame:
    """Members voting against their own faction, in decisions where several of its members voted."""
    members = valid_votes(votes).where(F.col("persoon_id").isNotNull())
    group = members.groupBy("besluit_id", "fractie_id", "soort").agg(F.count(F.lit(1)).alias("_n"))
    own = (group.groupBy("besluit_id", "fractie_id")
           .agg(F.sum("_n").alias("_all"), F.min_by("soort", F.struct(-F.col("_n"), F.col("soort"))).alias("meerderheid"))
           .where("_all > 1").drop("_all"))
    result = (_against(members.join(own, ["besluit_id", "fractie_id"]), ["fractie_id", "persoon_id"])
              .where(F.col("besluiten") >= min_votes))
    if top is None:
        return result
    return result.orderBy(F.col("pct_tegen").desc(), "fractie_id", "persoon_id").limit(top)


def dissent_from_chamber(votes: DataFrame, min_votes: int = 5) -> DataFrame:
    """Members voting against the majority of the whole chamber."""
    weighted = member_weighted(votes)
    joined = weighted.where(F.col("persoon_id").isNotNull()).join(majority(weighted), "besluit_id")
    return _against(joined, ["fractie_id", "persoon_id"]).where(F.col("besluiten") >= min_votes)


def size_and_dissent(votes: DataFrame, min_votes: int = 100, min_decisions: int = 20) -> DataFrame:
    """Mean faction size beside the share of positions against the majority."""
    sized = valid_votes(votes, None).where(F.col("fractie_grootte").isNotNull())
    sizes = (sized.groupBy("fractie_id")
             .agg(F.sum(F.col("fractie_grootte").cast("decimal(18,2)")).alias("_s"), F.count(F.lit(1)).alias("stemmen"))
             .where(F.col("stemmen") >= min_votes)
             .select("fractie_id", "stemmen", ratio(F.col("_s"), F.col("stemmen"), 4).alias("gem_grootte")))
    return sizes.join(against_majority(votes, min_decisions), "fractie_id")


def agreement(votes: DataFrame, min_votes: int = 20000) -> DataFrame:
    """Share of common decisions in which two factions took the same position, per pair."""
    positions = checkpoint(faction_position(votes).select("besluit_id", "fractie_id", F.when(F.col("soort") == FOR, 1).otherwise(-1).alias("_sign")))
    active = positions.groupBy("fractie_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_votes)
    kept = positions.join(active.select("fractie_id"), "fractie_id", "left_semi")
    pairs = co_occurrence(kept, "besluit_id", "fractie_id", "_sign")
    return pairs.select(F.col("a").alias("fractie_1"), F.col("b").alias("fractie_2"), "samen", "gelijk",
                        percentage(F.col("gelijk"), F.col("samen")).alias("overeenkomst"))


def divided_by_kind(votes: DataFrame, decision_cases: DataFrame, cases: DataFrame, min_decisions: int = 50) -> DataFrame:
    """Share of decisions with both options among the votes, per kind of case."""
    options = valid_votes(votes).groupBy("besluit_id").agg(F.countDistinct("soort").alias("_o"))
    linked = decision_cases.join(options, "besluit_id").join(
        cases.select(F.col("id").alias("zaak_id"), F.col("soort").alias("zaaksoort")), "zaak_id")
    totals = linked.groupBy("zaaksoort").agg(
        F.count(F.lit(1)).alias("besluiten"), F.count(F.when(F.col("_o") > 1, 1)).alias("verdeeld"))
    return (totals.where(F.col("besluiten") >= min_decisions)
            .withColumn("pct_verdeeld", percentage(F.col("verdeeld"), F.col("besluiten"))))
