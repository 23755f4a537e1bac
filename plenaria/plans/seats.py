"""Seats over time: memberships, switches, turnover and the network of factions.

Membership rows have ``persoon_id, fractie_id, fractie (normalised), van, tot_en_met``; faction
rows ``id, afkorting, naam_nl, datum_actief, datum_inactief``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from plenaria.functions.dates import years_between
from plenaria.functions.numbers import ratio
from plenaria.operators.aggregates import ordered_strings
from plenaria.operators.graph import connected_components
from plenaria.operators.intervals import count_active, expand_years
from plenaria.operators.pairs import co_occurrence
from plenaria.operators.sequence import neighbour
from plenaria.rules.classifiers import normalise_faction
from plenaria.session import checkpoint


def memberships(seat_persons: DataFrame, seats: DataFrame, factions: DataFrame, normalise=normalise_faction) -> DataFrame:
    """Person, faction and interval of every seat holding."""
    seat = seats.select(F.col("id").alias("fractie_zetel_id"), "fractie_id")
    faction = factions.select(F.col("id").alias("fractie_id"), "afkorting", "naam_nl", "datum_actief", "datum_inactief",
                              normalise(F.col("afkorting")).alias("fractie"))
    return (seat_persons.select("persoon_id", "fractie_zetel_id", "functie", "van", "tot_en_met")
            .join(seat, "fractie_zetel_id").join(faction, "fractie_id"))


def with_faction(members: DataFrame, factions: DataFrame) -> DataFrame:
    """Members with the columns of their faction; factions have one row each and are few.

    They are broadcast: a shuffle by faction would leave members in as many tasks as there are factions, and whatever
    groups by faction and more columns would stay there.
    """
    return members.join(F.broadcast(factions), "fractie_id")


def existence_years(as_of: date, digits: int | None = 1) -> Column:
    """Years a faction has existed, at least 0.01."""
    return years_between(F.col("datum_actief"), F.coalesce(F.col("datum_inactief"), F.lit(as_of)), digits=digits, floor=0.01)


def seat_events(members: DataFrame, arrival: str = "aanmelding", departure: str = "vertrek") -> DataFrame:
    """One row per arrival and per departure."""
    others = [c for c in members.columns if c not in ("van", "tot_en_met")]
    both = F.array(*[F.struct(F.col(day).alias("datum"), F.lit(kind).alias("event_type")) for day, kind in (("van", arrival), ("tot_en_met", departure))])
    return members.select(*others, F.inline(both)).where("datum IS NOT NULL")


def seat_changes(members: DataFrame, as_of: date) -> DataFrame:
    """Seat events with year, the faction's years of existence and its members on that day."""
    events = seat_events(members)
    counted = count_active(events, members, ["fractie_id"], "datum", "van", "tot_en_met", ["persoon_id"], "zetels_op_datum")
    return counted.select("persoon_id", "fractie_id", "datum", "event_type", "fractie",
                          F.year("datum").cast("bigint").alias("jaar"),
                          existence_years(as_of).alias("jaren_bestaan"), "zetels_op_datum")


def yearly_seats(members: DataFrame, first: int = 2000, last: int = 2026, by: str = "fractie") -> DataFrame:
    """Members active in each year and the change since the previous row of the faction."""
    counts = (expand_years(members, "van", "tot_en_met", first, last)
              .groupBy(by, "jaar").agg(F.countDistinct("persoon_id").alias("zetels")))
    before = F.lag("zetels").over(Window.partitionBy(by).orderBy("jaar"))
    return counts.select(by, F.col("jaar").cast("bigint").alias("jaar"), "zetels", before.alias("zetels_vorig_jaar"),
                         (F.col("zetels") - before).alias("verandering"))


def turnover(members: DataFrame, factions: DataFrame, first: date, last: date, as_of: date) -> DataFrame:
    """Arrivals, departures and both per year of existence, of factions active in the period."""
    present = factions.where((F.col("datum_actief") <= F.lit(last)) & (
        F.col("datum_inactief").isNull() | (F.col("datum_inactief") >= F.lit(first))))
    years = present.groupBy("fractie").agg(F.sum(existence_years(as_of, None)).alias("_jaren"))
    events = (seat_events(members.join(present.select("fractie_id"), "fractie_id", "left_semi"))
              .where(F.col("datum").between(F.lit(first), F.lit(last))))
    counts = events.groupBy("fractie").agg(
        F.count(F.lit(1)).alias("wisselingen"),
        F.count(F.when(F.col("event_type") == "aanmelding", 1)).alias("aanmeldingen"),
        F.count(F.when(F.col("event_type") == "vertrek", 1)).alias("vertrekken"))
    return counts.join(years, "fractie").select(
        "fractie", "wisselingen", "aanmeldingen", "vertrekken", F.round("_jaren", 1).alias("jaren_bestaan"),
        ratio(F.col("wisselingen"), F.col("_jaren"), 2).alias("per_jaar"))


def turnover_ratio(members: DataFrame, first: date, last: date) -> DataFrame:
    """Mean events per active year against the mean number of members."""
    per_year = (expand_years(members, "van", "tot_en_met", first.year, last.year)
                .groupBy("fractie", "jaar").agg(F.countDistinct("persoon_id").alias("_n")))
    size = per_year.groupBy("fractie").agg(F.sum("_n").alias("_s"), F.count(F.lit(1)).alias("actieve_jaren"))
    events = (seat_events(members).where(F.col("datum").between(F.lit(first), F.lit(last)))
              .groupBy("fractie").agg(F.count(F.lit(1)).alias("_e")))
    per = F.coalesce(F.col("_e"), F.lit(0)) / F.col("actieve_jaren")
    mean = F.col("_s") / F.col("actieve_jaren")
    return size.join(events, "fractie", "left").select(
        "fractie", F.round(mean, 1).alias("gem_zetels"), "actieve_jaren", F.round(per, 1).alias("wisselingen_per_jaar"),
        F.round(per / F.nullif(mean, F.lit(0)), 2).alias("verhouding"))


def in_several_factions(members: DataFrame) -> DataFrame:
    """Persons with more than one normalised faction, with the ordered list."""
    distinct = members.select("persoon_id", "fractie").distinct()
    many = distinct.groupBy("persoon_id").agg(F.count(F.lit(1)).alias("aantal_fracties")).where("aantal_fracties > 1")
    named = ordered_strings(distinct.join(many, "persoon_id", "left_semi"), ["persoon_id"], "fractie", "fracties")
    return many.join(named, "persoon_id")


def with_previous(members: DataFrame, order: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    """Adds columns of the person's previous membership; months split the rows of busy persons."""
    return neighbour(members, ["persoon_id"], order, F.trunc(F.col(order[0]), "MM"), columns, "previous")


def switch_counts(members: DataFrame, order: tuple[str, ...], party: str = "fractie") -> DataFrame:
    """How often a person's faction differs from the one before, for persons with a switch."""
    seen = with_previous(members, order, {"_vorige": party})
    return (seen.groupBy("persoon_id").agg(F.count(F.when(F.col(party) != F.col("_vorige"), 1)).alias("wissels"))
            .where("wissels > 0"))


def moves(members: DataFrame, order: tuple[str, ...], start: str = "van", party: str = "fractie") -> DataFrame:
    """Each move to another faction: from, to, end of the old and start of the new membership."""
    nxt = neighbour(members, ["persoon_id"], order, F.trunc(F.col(order[0]), "MM"),
                    {"naar": party, "start_volgende": start}, "next")
    return nxt.where(F.col("naar").isNotNull() & (F.col("naar") != F.col(party))).select(
        "persoon_id", F.col(party).alias("van_fractie"), F.col("tot_en_met").alias("einde_vorige"), "naar", "start_volgende")


def shared_members(members: DataFrame, party: str = "fractie", least: int = 1) -> DataFrame:
    """How many persons two factions have shared, per pair that shared ``least`` or more."""
    pairs = co_occurrence(members, "persoon_id", party, least=least)
    return pairs.select(F.col("a").alias("fractie_1"), F.col("b").alias("fractie_2"), F.col("samen").alias("gedeelde_leden"))


def faction_groups(members: DataFrame, threshold: int, party: str = "fractie") -> DataFrame:
    """Groups of factions connected by at least ``threshold`` shared members.

    Groups are named after their smallest faction and numbered by size, then name.
    """
    edges = checkpoint(shared_members(members, party, threshold))
    nodes = members.select(F.col(party).alias("node")).where("node is not null").distinct()
    labels = connected_components(nodes, edges, "node", "fractie_1", "fractie_2", "groep")
    size = labels.groupBy("groep").agg(F.count(F.lit(1)).alias("grootte"))
    return labels.join(size, "groep").select(F.col("node").alias("fractie"), "groep", "grootte")


def extremes(factions: DataFrame, as_of: date, key: str = "fractie") -> DataFrame:
    """Oldest and youngest faction that is still active, with age in years."""
    active = factions.where(F.col("datum_inactief").isNull()).groupBy(key).agg(F.min("datum_actief").alias("start"))
    picked = active.agg(F.min_by(F.struct(key, "start"), F.struct("start", key)).alias("oudste"),
                        F.max_by(F.struct(key, "start"), F.struct("start", key)).alias("jongste"))
    rows = picked.select(F.explode(F.array(
        F.struct(F.lit("oudste").alias("welke"), F.col("oudste").alias("f")),
        F.struct(F.lit("jongste").alias("welke"), F.col("jongste").alias("f")))).alias("x"))
    return rows.select("x.welke", F.col(f"x.f.{key}").alias("fractie"), F.col("x.f.start").alias("start"),
                       years_between(F.col("x.f.start"), F.lit(as_of), 365.2425).alias("jaren"))


def largest_ever(changes: DataFrame) -> DataFrame:
    """The event with the most members on its day (earliest day, then smallest faction on ties)."""
    best = F.min_by(F.struct("fractie_id", "datum", "zetels_op_datum"),
                    F.struct(-F.col("zetels_op_datum"), F.col("datum"), F.col("fractie_id")))
    return changes.agg(best.alias("_b")).select("_b.*")
