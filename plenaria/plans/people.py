"""Persons: income, travel, contact channels, rooms, education, careers, places."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plenaria.functions import text as T
from plenaria.functions.dates import days_between, decade, years_between
from plenaria.functions.numbers import annualise, exact_sum, percentage
from plenaria.operators.aggregates import argmax_by, first_by, last_by
from plenaria.operators.intervals import interval_join, year_membership
from plenaria.operators.versioned import apply_corrections
from plenaria.rules import classifiers, fixed


# ---- income ------------------------------------------------------------------------------------
def yearly_income(rows: DataFrame, by: Sequence[str], amount: str = "bedrag", frequency: str = "frequentie",
                  factors: Mapping[str, int] = fixed.MONTHLY_ONLY) -> DataFrame:
    """Annualised sums."""
    value = annualise(F.col(amount).cast("decimal(18,2)"), F.col(frequency), dict(factors))
    return rows.where(F.col(amount).isNotNull()).groupBy(*by).agg(F.sum(value).cast("double").alias("bedrag"))


def income_facts(incomes: DataFrame, memberships: DataFrame, first: int = 2015, last: int = 2026) -> DataFrame:
    """Positive yearly incomes with the factions of that year; several factions give several rows.

    ``incomes`` has ``nevenfunctie_id, persoon_id, jaar, bedrag, frequentie``.
    """
    kept = incomes.where((F.col("bedrag") > 0) & F.col("jaar").between(first, last))
    joined = year_membership(kept, memberships.select("persoon_id", "fractie_id", "van", "tot_en_met"),
                             ["persoon_id"], "jaar", "van", "tot_en_met")
    value = annualise(F.col("bedrag").cast("decimal(18,2)"), F.col("frequentie"), fixed.INCOME_FACTORS)
    return joined.select("nevenfunctie_id", "persoon_id", "fractie_id", F.col("jaar").alias("jaar_id"), value.cast("double").alias("bedrag"))


def earner_share(incomes: DataFrame, memberships: DataFrame, party: str = "fractie") -> DataFrame:
    """Persons, earners, their share and their income per faction."""
    earned = yearly_income(incomes.where(F.col("bedrag") > 0), ["persoon_id"])
    people = memberships.select("persoon_id", party).distinct()
    totals = people.join(earned, "persoon_id", "left").groupBy(party).agg(
        F.count(F.lit(1)).alias("personen"), F.count("bedrag").alias("verdieners"),
        F.coalesce(exact_sum(F.col("bedrag")), F.lit(0.0)).alias("totaal"))
    per_earner = F.round(F.col("totaal") / F.nullif(F.col("verdieners"), F.lit(0)), 0)
    return totals.select(party, "personen", "verdieners", percentage(F.col("verdieners"), F.col("personen")).alias("pct_verdieners"),
                         "totaal", per_earner.alias("gem_per_verdiener"))


def dominant_party(income: DataFrame, party: str = "fractie_id") -> DataFrame:
    """Per person the faction under which most income was earned."""
    return argmax_by(income, ["persoon_id"], party, F.sum(F.col("bedrag").cast("decimal(18,2)")), "hoofd_fractie")


# ---- travel and gifts --------------------------------------------------------------------------
def counts_by(rows: DataFrame, column: str, out: str = "aantal") -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(out))


def with_party_on_day(rows: DataFrame, memberships: DataFrame, day: str, party: str = "fractie", on_overlap: str = "all",
                      row_key: Sequence[str] = ()) -> DataFrame:
    """Trips or gifts with the faction held on their day; overlapping seats give several rows."""
    held = memberships.select("persoon_id", F.col(party).alias("fractie_op_dag"), F.col("van").alias("_van"), F.col("tot_en_met").alias("_tot"))
    return interval_join(rows, held, ["persoon_id"], day, "_van", "_tot", on_overlap=on_overlap, row_key=row_key,
                         order=["fractie_op_dag"]).drop("_van", "_tot")


def trip_days(rows: DataFrame, start: str = "van", end: str = "tot_en_met") -> DataFrame:
    return rows.withColumn("duur_dagen", days_between(F.col(start), F.col(end)))


def counts_with_zero(people: DataFrame, rows: DataFrame, by: str, out: str) -> DataFrame:
    """Rows per group of persons; groups without rows count 0. Rows are counted per person first."""
    per_person = rows.groupBy("persoon_id").agg(F.count(F.lit(1)).alias("_n"))
    return (people.join(per_person, people["id"] == per_person["persoon_id"], "left").groupBy(by)
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(out)))


def mentions_party(rows: DataFrame, names: Sequence[str], text: str = "omschrijving") -> DataFrame:
    return rows.where(T.any_keyword(F.col(text), names))


# ---- contact channels --------------------------------------------------------------------------
def channel_stats(contacts: DataFrame) -> DataFrame:
    """Contacts and mean weight per merged channel."""
    return contacts.groupBy(classifiers.channel(F.col("soort")).alias("kanaal")).agg(
        F.count(F.lit(1)).alias("aantal"), F.round(F.avg("gewicht"), 4).alias("gem_gewicht"))


def top_channel(contacts: DataFrame, people: DataFrame, party: str = "fractielabel") -> DataFrame:
    """Channel with the most weight per faction label."""
    labelled = people.where(F.col(party).isNotNull() & (F.lower(F.trim(party)) != "nan")).select(F.col("id").alias("persoon_id"), party)
    joined = contacts.where(F.col("soort").isNotNull()).join(labelled, "persoon_id")
    return argmax_by(joined, [party], "soort", F.sum("gewicht"), "kanaal")


def mean_contacts(people: DataFrame, contacts: DataFrame, by: str) -> DataFrame:
    """Mean number of contacts per person, persons without any counting 0."""
    per_person = contacts.groupBy("persoon_id").agg(F.count(F.lit(1)).alias("_n"))
    return (people.join(per_person, people["id"] == per_person["persoon_id"], "left").groupBy(by)
            .agg(F.count(F.lit(1)).alias("personen"), F.round(F.avg(F.coalesce(F.col("_n"), F.lit(0))), 2).alias("gem_contacten")))


# ---- rooms -------------------------------------------------------------------------------------
def room_use(meetings: DataFrame, room: str = "zaal", top: int | None = 20) -> DataFrame:
    """Meetings per room after merging spellings, with a display name."""
    key = T.map_values(T.room_key(F.col(room)), fixed.ROOM_ALIASES)
    counts = meetings.where(F.col(room).isNotNull()).groupBy(key.alias("zaal_sleutel")).agg(F.count(F.lit(1)).alias("vergaderingen"))
    named = counts.withColumn("zaal", T.map_values(F.col("zaal_sleutel"), fixed.ROOM_NAMES))
    return named if top is None else named.orderBy(F.col("vergaderingen").desc(), "zaal_sleutel").limit(top)


# ---- education and careers ---------------------------------------------------------------------
def levels_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.EDUCATION_LEVELS), "niveau string, rang int, omschrijving string")


def sectors_table(spark: SparkSession) -> DataFrame:
    base = spark.createDataFrame(list(fixed.SECTORS), "sector string, binnen_politiek boolean, onduidelijk boolean")
    known = ~F.col("sector").isin(fixed.SECTOR_UNKNOWN, fixed.SECTOR_NONE)
    outside = ~F.col("binnen_politiek") & known
    return base.withColumn("telt_buiten_bovengrens", outside).withColumn("telt_buiten_zeker", outside & ~F.col("onduidelijk"))


def rank_of(level: Column) -> Column:
    table = F.create_map(*[F.lit(x) for name, rank, _ in fixed.EDUCATION_LEVELS if rank is not None for x in (name, rank)])
    return F.try_element_at(table, level)


def highest_level(educations: DataFrame) -> DataFrame:
    """Per person the best completed level: rank, then text before institution, then lowest id.

    ``educations`` has ``persoon_id, id, categorie, bron, status``.
    """
    ranked = educations.where(F.col("status") == "voltooid").withColumn("_rang", rank_of(F.col("categorie"))).where("_rang is not null")
    order = F.struct(-F.col("_rang"), F.when(F.col("bron") == "tekst", 0).otherwise(1), F.col("id"))
    return first_by(ranked, ["persoon_id"], {"opleiding_hoogste": "categorie", "opleiding_hoogste_bron": "bron"}, order)


def education_summary(people: DataFrame, educations: DataFrame) -> DataFrame:
    """Number of educations, highest level and status text for every person."""
    counts = educations.groupBy("persoon_id").agg(F.count(F.lit(1)).alias("n_opleidingen"))
    joined = (people.select(F.col("id").alias("persoon_id")).join(counts, "persoon_id", "left")
              .join(highest_level(educations), "persoon_id", "left")
              .withColumn("n_opleidingen", F.coalesce(F.col("n_opleidingen"), F.lit(0))))
    status = (F.when(F.col("opleiding_hoogste").isNotNull(), "niveau bepaald")
              .when(F.col("n_opleidingen") > 0, "geregistreerd, geen voltooid niveau af te leiden")
              .otherwise("geen opleiding geregistreerd"))
    return joined.withColumn("opleiding_status", status)


def sector_bounds(careers: DataFrame) -> DataFrame:
    """Jobs per person: all, possibly outside politics, and certainly outside politics."""
    flags = sectors_table(careers.sparkSession)
    joined = careers.join(F.broadcast(flags), "sector")
    return joined.groupBy("persoon_id").agg(
        F.count(F.lit(1)).alias("n_loopbaanrijen"),
        F.count(F.when(F.col("telt_buiten_bovengrens"), 1)).alias("n_buiten_politiek"),
        F.count(F.when(F.col("telt_buiten_zeker"), 1)).alias("n_buiten_zeker"))


# ---- places ------------------------------------------------------------------------------------
def place_lookup(register: DataFrame, place: str = "woonplaats", municipality: str = "gemeente", code: str = "gemeentecode",
                 province: str = "provincie") -> DataFrame:
    """Search keys of places and municipalities with their municipality, and how many share a key."""
    trimmed = register.select(*[F.trim(F.col(c)).alias(n) for c, n in
                                ((place, "plaats"), (municipality, "gemeente"), (code, "gemeentecode"), (province, "provincie"))])
    both = trimmed.unionByName(trimmed.withColumn("plaats", F.col("gemeente"))).withColumn("sleutel", T.place_key(F.col("plaats")))
    packed = F.min(F.struct("gemeentecode", "gemeente", "provincie"))
    return (both.where("sleutel is not null").groupBy("sleutel")
            .agg(F.countDistinct("gemeentecode").alias("_n"), packed.alias("_m")).select("sleutel", "_n", "_m.*"))


def match_places(df: DataFrame, text: str, lookup: DataFrame, aliases: Mapping[str, str] = fixed.PLACE_ALIASES,
                 key: Column | None = None) -> DataFrame:
    """Adds key, municipality, province and match status of a place text."""
    own = T.map_values(T.place_key(F.col(text)) if key is None else key, aliases)
    places = lookup.select(F.col("sleutel").alias("_k"), "_n", "gemeentecode", "gemeente", "provincie")
    joined = df.withColumn("sleutel", own).join(places, F.col("sleutel") == F.col("_k"), "left")
    unique = F.col("_n") == 1
    status = (F.when(F.col("sleutel").isNull(), fixed.PLACE_STATUS["none"]).when(unique, fixed.PLACE_STATUS["match"])
              .when(F.col("_n") > 1, fixed.PLACE_STATUS["ambiguous"]).otherwise(fixed.PLACE_STATUS["missing"]))
    return joined.select(*df.columns, "sleutel", *[F.when(unique, F.col(c)).alias(c) for c in ("gemeentecode", "gemeente", "provincie")],
                         status.alias("plaats_status"))


def alias_targets_missing(spark: SparkSession, lookup: DataFrame, aliases: Mapping[str, str] = fixed.PLACE_ALIASES) -> DataFrame:
    """Alias targets that the lookup does not know."""
    wanted = spark.createDataFrame([(t,) for t in sorted(set(aliases.values()))], "doel string")
    return wanted.join(lookup.select("sleutel"), F.col("doel") == F.col("sleutel"), "left_anti")


def place_shares(matched: DataFrame, by: str = "provincie") -> DataFrame:
    """Matched persons per province or municipality with their share."""
    rows = matched.where(F.col("plaats_status") == fixed.PLACE_STATUS["match"])
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("aantal"))
    total = rows.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return counts.withColumn("aandeel", percentage(F.col("aantal"), total))


# ---- person dimension --------------------------------------------------------------------------
def life_status(birth: Column, death: Column, threshold: int = 1930) -> Column:
    return (F.when(death.isNotNull(), "overleden (datum bekend)").when(birth.isNull(), "onbekend (geen geboortedatum)")
            .when(F.year(birth) >= threshold, "aangenomen in leven").otherwise("onbekend"))


def person_dimension(people: DataFrame, corrections: DataFrame, memberships: DataFrame, educations: DataFrame,
                     careers: DataFrame, places: DataFrame, as_of: date) -> DataFrame:
    """One row per person with derived ages, first and last faction, education, career and places.

    ``educations`` carry ``categorie, bron, status``; ``careers`` carry ``sector``; ``places`` has
    one row per person with ``geboorte_gemeentecode, geboorte_status, woon_gemeentecode, woon_status``.
    """
    base = apply_corrections(people, corrections, "id", ["geboortedatum"])
    early, late = F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    stop = F.coalesce(F.col("tot_en_met"), late)
    first = first_by(memberships, ["persoon_id"], {"fractie_eerste_id": "fractie_id", "_van": "van"},
                     F.struct(F.coalesce(F.col("van"), late), stop, F.col("fractie_id")))
    last = last_by(memberships, ["persoon_id"], {"fractie_laatste_id": "fractie_id"},
                   F.struct(F.coalesce(F.col("van"), early), stop, F.col("fractie_id")))
    education = education_summary(people, educations)
    career = sector_bounds(careers)
    joined = (base.withColumnRenamed("id", "persoon_id").join(first, "persoon_id", "left").join(last, "persoon_id", "left")
              .join(education, "persoon_id", "left").join(career, "persoon_id", "left").join(places, "persoon_id", "left"))
    birth, birth_year = F.col("geboortedatum"), F.year("geboortedatum")
    unknown = ["niet ingevuld", "niet bepaald"]
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_loopbaanrijen", "n_buiten_politiek", "n_buiten_zeker", "n_opleidingen")}
    return joined.select(
        "persoon_id",
        T.person_name(F.coalesce(F.col("roepnaam"), F.col("initialen")), F.col("tussenvoegsel"), F.col("achternaam")).alias("naam"),
        "geslacht", "functie", (F.col("functie") == fixed.SENATOR_FUNCTION).alias("is_eerste_kamerlid"),
        birth.alias("geboortedatum"), birth_year.cast("bigint").alias("geboortejaar"), decade(birth_year).alias("geboortedecennium"),
        "overlijdensdatum", "handmatig_aangevuld", life_status(birth, F.col("overlijdensdatum")).alias("levensstatus"),
        F.when(F.col("functie") == fixed.MEMBER_FUNCTION, years_between(birth, F.lit(as_of))).alias("leeftijd_nu"),
        F.year("_van").cast("bigint").alias("start_jaar_fractie"),
        (F.year("_van") - birth_year).cast("bigint").alias("leeftijd_aantreden"),
        F.col("fractie_eerste_id").isNotNull().alias("heeft_fractie"), "fractie_eerste_id", "fractie_laatste_id",
        zero["n_opleidingen"].alias("n_opleidingen"), "opleiding_hoogste", "opleiding_hoogste_bron", "opleiding_status",
        zero["n_loopbaanrijen"].alias("n_loopbaanrijen"), zero["n_buiten_politiek"].alias("n_buiten_politiek"),
        zero["n_buiten_zeker"].alias("n_buiten_zeker"),
        "geboorte_gemeentecode", "geboorte_status", "woon_gemeentecode", "woon_status",
        birth.isNotNull().alias("heeft_geboortedatum"),
        (~F.col("geboorte_status").isin(unknown)).alias("heeft_geboorteplaats"),
        (~F.col("woon_status").isin(unknown)).alias("heeft_woonplaats"),
        (zero["n_opleidingen"] > 0).alias("heeft_opleidingsrij"), (zero["n_loopbaanrijen"] > 0).alias("heeft_loopbaanrij"))
