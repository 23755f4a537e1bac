"""Star schemas per theme over the conformed tables.

Every function takes the conformed tables by name and returns the star's tables by name, each
built when it is first read; ``as_of`` stands in for "today" so that results repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date, timedelta
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from plenaria.functions.dates import active_at, close_interval, date_key, days_between, minutes_between, year_boundaries
from plenaria.functions.text import map_values
from plenaria.operators.filters import linked
from plenaria.operators.intervals import groups_on_day
from plenaria.operators.references import null_safe_join
from plenaria.operators.sequence import dense_key, surrogate_key
from plenaria.plans import calendar, people, seats
from plenaria.rules import classifiers
from plenaria.sources.files import with_unknown

Tables = Mapping[str, DataFrame]


class StarTables(Mapping):
    """Tables by name; a table's plan (and any keys it needs) is made on first access."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = {name: cache(build) for name, build in builders.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _pick(df: DataFrame, *columns: str, **renamed: str) -> DataFrame:
    """``renamed`` maps new name to source column."""
    return df.select(*[F.col(source).alias(name) for name, source in renamed.items()], *columns)


def _key(day: Column) -> Column:
    return date_key(day, None).cast("int")


# ---- contacts and seats ------------------------------------------------------------------------
def contacts(t: Tables, as_of: date) -> StarTables:
    """Contact details and seat holdings with unknown members and surrogate keys."""
    info, persons, factions = t["persoon_contactinformatie"], t["persoon"], t["fractie"]
    channel = cache(lambda: dense_key(info.where(F.col("soort").isNotNull()), ["soort"], "channel_key"))
    kind = cache(lambda: dense_key(info, ["soort", "waarde", "gewicht"], "soort_id"))
    seat = t["fractie_zetel_persoon"]

    def facts() -> DataFrame:
        rows = (info.join(persons.select(F.col("id").alias("_p")), F.col("persoon_id") == F.col("_p"), "left")
                .join(channel().select("channel_key", F.col("soort").alias("_kanaal")), F.col("soort") == F.col("_kanaal"), "left"))
        return null_safe_join(rows, kind(), ["soort", "waarde", "gewicht"]).select(
            "gewijzigd_op", F.col("persoon_id").alias("_persoon"), F.col("id").alias("_id"),
            F.coalesce("_p", F.lit("-1")).alias("persoon_id"),
            calendar.day_or_unknown(F.col("gewijzigd_op").cast("date")).alias("date_key"),
            F.coalesce("channel_key", F.lit(-1)).alias("channel_key"), F.coalesce("soort_id", F.lit(-1)).alias("soort_id"),
            F.lit(1).alias("contact_count"))

    contact_order = [F.col("gewijzigd_op").desc_nulls_last(), F.col("_persoon").asc_nulls_last(), F.col("_id").asc()]
    held = (seat.join(t["fractie_zetel"].select(F.col("id").alias("_z"), "fractie_id", F.col("gewicht").alias("zetel_gewicht")),
                      F.col("fractie_zetel_id") == F.col("_z"), "left")
            .join(factions.select(F.col("id").alias("_f")), F.col("fractie_id") == F.col("_f"), "left")
            .join(persons.select(F.col("id").alias("_p")), F.col("persoon_id") == F.col("_p"), "left"))
    held = held.select(
        "van", "id", F.coalesce("_p", F.lit("-1")).alias("persoon_id"), F.coalesce("_f", F.lit("-1")).alias("fractie_id"),
        calendar.day_or_unknown(F.col("van")).alias("van_date_key"), calendar.day_or_open(F.col("tot_en_met")).alias("tot_en_met_date_key"),
        F.col("_z").alias("fractie_zetel_id"), "zetel_gewicht", "functie",
        days_between(F.col("van"), close_interval(F.col("tot_en_met"), as_of)).alias("aantal_dagen"), F.lit(1).alias("zetel_count"))
    dates = calendar.calendar_over([(info, ["gewijzigd_op"]), (seat, ["van", "tot_en_met"])], [], [as_of])
    return StarTables({
        "dim_persoon": lambda: with_unknown(_pick(persons, "nummer", "titels", "voornamen", "tussenvoegsel", "achternaam", "roepnaam", "geslacht",
                                          "initialen", "functie", "fractielabel", "geboortedatum", "overlijdensdatum", persoon_id="id"),
                                    persoon_id="-1", achternaam="Onbekend"),
        "dim_fractie": lambda: with_unknown(_pick(factions, "nummer", "afkorting", "naam_nl", "naam_en", "aantal_zetels", "aantal_stemmen",
                                          "datum_actief", "datum_inactief", "logo_url", fractie_id="id"),
                                    fractie_id="-1", naam_nl="Onbekend", naam_en="Unknown"),
        "dim_kanaal": lambda: with_unknown(_pick(channel(), "channel_key", kanaal="soort"), channel_key=-1, kanaal="Onbekend"),
        "dim_soort": lambda: with_unknown(kind().select("soort_id", "waarde", "soort", "gewicht"), soort_id=-1, waarde="Onbekend", soort="Onbekend"),
        "dim_datum": lambda: calendar.with_special_days(dates),
        "fact_contactgegevens_persoon": lambda: surrogate_key(facts(), contact_order, "contactgegeven_persoon_key").drop("gewijzigd_op", "_persoon", "_id"),
        "fact_fractie_zetel_persoon": lambda: surrogate_key(held, [F.col("van").desc_nulls_last(), F.col("id").asc()],
                                                    "fractie_zetel_persoon_key").drop("van", "id"),
    })


# ---- documents ---------------------------------------------------------------------------------
def documents(t: Tables) -> StarTables:
    """Publication facts, citations and their dimensions."""
    doc = t["document"]
    version = t["document_versie"].select(F.col("id").alias("_v"), "bestandsgrootte", "versienummer")
    meta = t["document_publicatie_metadata"].where(F.col("document_type") == "Metadata").select(
        F.col("document_versie_id").alias("_mv"), "document_type", F.col("publicatie_datum").alias("publicatiedatum"))
    publication = (doc.join(version, F.col("huidige_document_versie_id") == F.col("_v"), "left")
                   .join(meta, F.col("_v") == F.col("_mv"), "left")
                   .select(F.col("id").alias("document_id"), "soort", "document_type", "organisatie", "datum", "publicatiedatum",
                           days_between(F.col("datum"), F.col("publicatiedatum")).alias("dagen_tot_publicatie"),
                           "bestandsgrootte", "versienummer"))
    kinds = doc.select(F.col("id").alias("_id"), F.col("soort").alias("_soort"))
    cites = t["document_bron_document"]
    citation = (cites.join(kinds, F.col("document_id") == F.col("_id"), "left").withColumnRenamed("_soort", "document_soort").drop("_id")
                .join(kinds, F.col("bron_document_id") == F.col("_id"), "left").withColumnRenamed("_soort", "bron_document_soort")
                .select("document_id", "bron_document_id", "document_soort", "bron_document_soort", "relatie_gewijzigd_op"))

    def values(df: DataFrame, column: str) -> DataFrame:
        return df.where(F.col(column).isNotNull()).select(column).distinct()

    parts = ["jaar", "maand", "dag", "kwartaal", "weeknummer", "dagnaam", "dagnr"]
    return StarTables({
        "fact_document_publicatie": lambda: publication, "fact_bronvermelding": lambda: citation,
        "dim_documentsoort": lambda: values(doc, "soort"), "dim_documenttype": lambda: values(publication, "document_type"),
        "dim_organisatie": lambda: values(doc, "organisatie"), "dim_document": lambda: _pick(doc, "titel", document_id="id"),
        "dim_tijd": lambda: calendar.calendar_over([(publication, ["datum", "publicatiedatum"])], parts),
    })


# ---- seats over time ---------------------------------------------------------------------------
def seat_history(t: Tables, as_of: date, first: int = 2000, last: int = 2026) -> StarTables:
    """Seat changes and the yearly seat picture."""
    members = seats.memberships(t["fractie_zetel_persoon"], t["fractie_zetel"], t["fractie"])
    changes = seats.seat_changes(members, as_of).withColumnRenamed("datum", "datum_id").withColumnRenamed("fractie", "fractie_norm")
    order = [F.col("datum_id").asc(), F.col("persoon_id").asc_nulls_last(), F.col("fractie_id").asc(), F.col("event_type").asc()]
    yearly = seats.yearly_seats(members, first, last).withColumnRenamed("fractie", "fractie_norm")
    return StarTables({
        "dim_persoon": lambda: t["persoon"].select("id", "roepnaam", "voornamen", "tussenvoegsel", "achternaam", "geslacht", "geboortedatum", "fractielabel"),
        "dim_fractie": lambda: t["fractie"].select("id", "afkorting", "naam_nl", classifiers.normalise_faction(F.col("afkorting")).alias("fractie_norm"),
                                           "aantal_zetels", "datum_actief", "datum_inactief", seats.existence_years(as_of).alias("jaren_bestaan")),
        "fact_zetelwisseling": lambda: surrogate_key(changes, order, "event_id"),
        "agg_zetelbeeld_per_jaar": lambda: yearly,
        "dim_tijd": lambda: calendar.calendar_over([(members, ["van", "tot_en_met"])], ["jaar", "maand", "maandnaam", "vergaderjaar"]),
    })


# ---- committees --------------------------------------------------------------------------------
def committees(t: Tables, as_of: date, since: date = date(2024, 1, 1)) -> StarTables:
    """Sittings, vacancies, activities and cases of committees."""
    seat = t["commissie_zetel"].select(F.col("id").alias("commissie_zetel_id"), "commissie_id")
    now = F.lit(as_of)

    def period(df: DataFrame, days: str, flag: str, key: str, *extra: str) -> DataFrame:
        return df.join(seat, "commissie_zetel_id").select(
            F.col("id").alias(key), "commissie_id", *extra, _key(F.col("van")).alias("datum_id_van"), _key(F.col("tot_en_met")).alias("datum_id_tot"),
            F.col("commissie_zetel_id").alias("zetel_id"), days_between(F.col("van"), close_interval(F.col("tot_en_met"), as_of)).alias(days),
            active_at(F.col("van"), F.col("tot_en_met"), now).alias(flag))

    persons = t["commissie_zetel_vast_persoon"].where(F.col("persoon_id").isNotNull())
    recent = t["activiteit"].where(F.col("voortouwcommissie_id").isNotNull() & (F.col("datum") >= F.lit(since)))
    activities = recent.select(F.col("id").alias("activiteit_id"), F.col("voortouwcommissie_id").alias("commissie_id"),
                               _key(F.col("datum")).alias("datum_id"), "soort", "status", (F.col("status") == "Uitgevoerd").alias("is_uitgevoerd"))
    chain = (recent.select(F.col("id").alias("activiteit_id"), F.col("voortouwcommissie_id").alias("commissie_id"), "datum")
             .join(t["agendapunt"].select(F.col("id").alias("agendapunt_id"), "activiteit_id"), "activiteit_id")
             .join(t["besluit"].select(F.col("id").alias("besluit_id"), "agendapunt_id"), "agendapunt_id")
             .join(t["besluit_zaak"].select("besluit_id", "zaak_id"), "besluit_id"))
    cases = chain.groupBy("commissie_id", "zaak_id").agg(
        _key(F.min("datum")).alias("datum_id"), F.countDistinct("besluit_id").alias("aantal_besluiten"))
    seated = (t["commissie_zetel_vast_persoon"].where(active_at(F.col("van"), F.col("tot_en_met"), now)).join(seat, "commissie_zetel_id")
              .groupBy(F.col("commissie_id").alias("_c")).agg(F.countDistinct("commissie_zetel_id").alias("_n")))
    dim = t["commissie"].join(seated, F.col("id") == F.col("_c"), "left").select(
        F.col("id").alias("commissie_id"), "naam_nl", "afkorting", "soort", classifiers.committee_type_star(F.col("naam_nl")).alias("commissietype"),
        "datum_actief", "datum_inactief", (F.col("datum_inactief").isNull() | (F.col("datum_inactief") > now)).alias("is_actief"),
        F.coalesce("_n", F.lit(0)).alias("aantal_zetels"))
    return StarTables({
        "fact_commissie_zitting": lambda: period(persons, "dagen_zitting", "is_huidig", "zitting_id", "persoon_id", "functie"),
        "fact_commissie_vacature": lambda: period(t["commissie_zetel_vast_vacature"], "dagen_open", "is_open", "vacature_id", "fractie_id"),
        "fact_commissie_activiteit": lambda: activities, "fact_commissie_zaak": lambda: cases, "dim_commissie": lambda: dim,
        "dim_persoon": lambda: linked(t["persoon"], "id", persons, "persoon_id").select(
            F.col("id").alias("persoon_id"), "achternaam", "geslacht", "geboortedatum", year_boundaries(F.col("geboortedatum"), now).alias("leeftijd")),
        "dim_fractie": lambda: _pick(t["fractie"], "afkorting", "naam_nl", fractie_id="id"),
        "dim_zaak": lambda: linked(t["zaak"], "id", cases, "zaak_id").select(
            F.col("id").alias("zaak_id"), "soort", F.substring("onderwerp", 1, 100).alias("onderwerp"), "status", "afgedaan"),
        "dim_datum": lambda: calendar.calendar(persons.sparkSession, date(2020, 1, 1), date(2030, 12, 31), ["datum_id", "jaar", "kwartaal", "maand"]),
    })


# ---- decisions ---------------------------------------------------------------------------------
def decisions(t: Tables) -> StarTables:
    """Activities with their decisions and cases."""
    activity = t["activiteit"]
    minutes = minutes_between(F.col("aanvangstijd"), F.col("eindtijd")).alias("duur_minuten")
    chain = (activity.select(F.col("id").alias("activiteit_id"), minutes)
             .join(t["agendapunt"].select(F.col("id").alias("_ap"), F.col("activiteit_id").alias("_a")), F.col("activiteit_id") == F.col("_a"), "left")
             .join(t["besluit"].select(F.col("id").alias("besluit_id"), F.col("agendapunt_id").alias("_bap")), F.col("_ap") == F.col("_bap"), "left")
             .join(t["besluit_zaak"].select(F.col("besluit_id").alias("_b"), F.col("zaak_id").alias("_z")), F.col("besluit_id") == F.col("_b"), "left")
             .join(t["zaak"].select(F.col("id").alias("zaak_id")), F.col("_z") == F.col("zaak_id"), "left"))
    return StarTables({
        "bridge_besluit_zaak": lambda: t["besluit_zaak"].select("besluit_id", "zaak_id"),
        "bridge_zaak_actor": lambda: _pick(t["zaak_actor"], "zaak_id", "fractie_id", "actor_naam", "actor_fractie", "relatie", zaak_actor_id="id"),
        "dim_activiteit": lambda: _pick(activity, "soort", "onderwerp", "datum", "datum_soort", "aanvangstijd", "eindtijd", activiteit_id="id"),
        "dim_besluit": lambda: t["besluit"].select(F.col("id").alias("besluit_id"), "stemmings_soort", "besluit_soort",
                                           classifiers.outcome_by_like(F.col("besluit_soort")).alias("uitkomst")),
        "dim_fractie": lambda: t["fractie"].select(F.col("id").alias("fractie_id"), "afkorting", "naam_nl",
                                           classifiers.normalise_faction(F.col("afkorting")).alias("fractie_norm"), "datum_actief", "datum_inactief"),
        "dim_zaak": lambda: _pick(t["zaak"], "soort", "onderwerp", zaak_id="id"),
        "fact_activiteit": lambda: activity.select(F.col("id").alias("activiteit_id"), "datum", "datum_soort", minutes),
        "fact_activiteit_besluit": lambda: chain.select("activiteit_id", "zaak_id", "besluit_id", "duur_minuten"),
    })


# ---- votes -------------------------------------------------------------------------------------
def votes(t: Tables, first: date = date(2024, 1, 1), until: date = date(2025, 1, 1)) -> StarTables:
    """Votes of one period with dimensions trimmed to them."""
    meeting = (t["besluit"].select(F.col("id").alias("besluit_id"), "agendapunt_id", "besluit_soort", "stemmings_soort", "status")
               .join(t["agendapunt"].select(F.col("id").alias("agendapunt_id"), "activiteit_id", F.col("onderwerp").alias("agendapunt_onderwerp")), "agendapunt_id")
               .join(t["activiteit"].where((F.col("datum") >= F.lit(first)) & (F.col("datum") < F.lit(until)))
                     .select(F.col("id").alias("activiteit_id"), "datum", F.col("soort").alias("activiteit_soort"), "kamer"), "activiteit_id"))
    fact = t["stemming"].join(meeting.select("besluit_id", "datum"), "besluit_id").select(
        F.col("id").alias("stemming_id"), "besluit_id", "fractie_id", "persoon_id", "datum", "soort", "fractie_grootte", "vergissing")
    bridge = linked(t["besluit_zaak"], "besluit_id", fact).select("besluit_id", "zaak_id")
    return StarTables({
        "fact_stemming": lambda: fact,
        "dim_fractie": lambda: linked(_pick(t["fractie"], "naam_nl", "afkorting", "datum_actief", "datum_inactief", "aantal_zetels", fractie_id="id"), "fractie_id", fact),
        "dim_persoon": lambda: linked(_pick(t["persoon"], "achternaam", "roepnaam", "geslacht", "geboortedatum", "functie", persoon_id="id"), "persoon_id", fact),
        "dim_besluit": lambda: linked(meeting, "besluit_id", fact).select(
            "besluit_id", "besluit_soort", "stemmings_soort", "status", "agendapunt_onderwerp", "activiteit_soort", "kamer"),
        "dim_zaak": lambda: linked(_pick(t["zaak"], "onderwerp", "titel", "status", "afgedaan", "gestart_op", zaak_id="id", zaak_soort="soort"), "zaak_id", bridge),
        "brug_besluit_zaak": lambda: bridge,
        "dim_datum": lambda: calendar.calendar(fact.sparkSession, first, until - timedelta(days=1), ["jaar", "maand", "jaar_maand", "dagnr"]),
    })


# ---- income, travel, legislation, planning -----------------------------------------------------
def income(t: Tables) -> StarTables:
    """Side-job income per year and faction."""
    jobs = t["persoon_nevenfunctie"]
    rows = t["persoon_nevenfunctie_inkomsten"].join(
        jobs.select(F.col("id").alias("persoon_nevenfunctie_id"), "persoon_id"), "persoon_nevenfunctie_id")
    members = seats.memberships(t["fractie_zetel_persoon"], t["fractie_zetel"], t["fractie"])
    return StarTables({
        "feit_inkomen": lambda: people.income_facts(rows.withColumnRenamed("persoon_nevenfunctie_id", "nevenfunctie_id"), members),
        "dim_nevenfunctie": lambda: _pick(jobs, "omschrijving", nevenfunctie_id="id", vergoedingssoort="vergoeding_soort"),
        "dim_persoon": lambda: _pick(t["persoon"], "voornamen", "achternaam", persoon_id="id"),
        "dim_fractie": lambda: t["fractie"].select(F.col("id").alias("fractie_id"), classifiers.normalise_faction_name(F.col("naam_nl")).alias("fractienaam"),
                                           F.col("datum_actief").alias("opgericht_datum")),
    })


def travel(t: Tables, as_of: date) -> StarTables:
    """Trips and gifts with the faction held on their day. A seat without end runs to ``as_of``."""
    members = seats.memberships(t["fractie_zetel_persoon"], t["fractie_zetel"], t["fractie"]).withColumn(
        "tot_en_met", close_interval(F.col("tot_en_met"), as_of))
    person = t["persoon"].select(F.col("id").alias("persoon_id"), "roepnaam", "achternaam", "overlijdensdatum")
    trips = t["persoon_reis"].select("id", "persoon_id", "doel", "bestemming", "van", "tot_en_met", "betaald_door")
    gifts = t["persoon_geschenk"].select("id", "persoon_id", "datum", "gewicht", "omschrijving")
    seated = members.select("persoon_id", "afkorting", F.col("van").alias("_van"), F.col("tot_en_met").alias("_tot"))
    held = groups_on_day(trips, seated, person, ["persoon_id"], "van", "afkorting", "_van", "_tot", "_n").withColumnRenamed("afkorting", "fractielabel")
    days = (F.col("_n") * days_between(F.col("van"), F.col("tot_en_met"))).alias("reisduur")
    return StarTables({
        "gold_fact_reis": lambda: held.select("persoon_id", *[c for c in trips.columns if c != "persoon_id"], "fractielabel", days, *person.columns[1:]),
        "gold_fact_geschenk": lambda: people.with_party_on_day(gifts, members, "datum", "afkorting").withColumnRenamed("fractie_op_dag", "afkorting").join(person, "persoon_id"),
    })


def legislation(t: Tables, sample: int = 500) -> StarTables:
    """A repeatable sample of dossiers with their documents, actors and factions."""
    from plenaria.operators.sampling import smallest_hashes

    dossiers = smallest_hashes(t["kamerstukdossier"], F.col("id"), sample).select("id", "titel", "nummer", "toevoeging", "kamer")
    docs = linked(t["document"], "kamerstukdossier_id", dossiers, "id").select(
        "id", "kamerstukdossier_id", "document_nummer", "titel", "soort", "vergaderjaar", "datum", "datum_registratie", "datum_ontvangst")
    return StarTables({"kamerstukdossier": lambda: dossiers, "document": lambda: docs,
            "document_actor": lambda: linked(t["document_actor"], "document_id", docs, "id").select("document_id", "fractie_id", "relatie"),
            "fractie": lambda: linked(t["fractie"], "id", t["document_actor"], "fractie_id").select("id", "afkorting")})


def planning(t: Tables) -> StarTables:
    """Room reservations with activity and room."""
    activity = t["activiteit"].select(F.col("id").alias("activiteit_id"), "datum", F.col("soort").alias("activiteitssoort"),
                                      F.col("onderwerp").alias("activiteit"), "status", "besloten")
    room = t["zaal"].select(F.col("id").alias("zaal_id"), F.col("naam").alias("vergaderzaal"))
    rows = t["reservering"].select(F.col("id").alias("reservering_id"), "activiteit_id", "zaal_id").join(activity, "activiteit_id", "left")
    return StarTables({"planning": lambda: rows.join(room, "zaal_id", "left").drop("zaal_id")})


def place_status(matches: DataFrame) -> DataFrame:
    """Place matches per person with the status texts reduced to five values."""
    def norm(c: str) -> Column:
        short = map_values(F.col(c), {"gematcht (eenduidig)": "gematcht", "geen plaats ingevuld": "niet ingevuld",
                                      "niet eenduidig (meerdere gemeenten)": "niet eenduidig"})
        return F.coalesce(short, F.lit("niet bepaald"))

    return matches.select(F.col("id").alias("persoon_id"), "geboorte_gemeentecode", norm("plaats_status").alias("geboorte_status"),
                          "woon_gemeentecode", norm("woon_status").alias("woon_status"))


def careers(t: Tables, staging: Tables, as_of: date) -> StarTables:
    """Education, career and person dimension.

    ``staging`` holds ``correcties, plaats, onderwijs, loopbaan, register``: corrections, place
    matches, classified educations and careers, and the municipality register.
    """
    spark = t["persoon"].sparkSession
    register = staging["register"]
    education = linked(t["persoon_onderwijs"], "persoon_id", t["persoon"], "id").join(staging["onderwijs"], "id")
    career = linked(t["persoon_loopbaan"], "persoon_id", t["persoon"], "id").join(staging["loopbaan"], "id")
    members = seats.memberships(t["fractie_zetel_persoon"], t["fractie_zetel"], t["fractie"])

    years = [F.year("van").cast("bigint").alias("jaar_van"), F.year("tot_en_met").cast("bigint").alias("jaar_tot")]

    places = place_status(staging["plaats"])
    return StarTables({
        "dim_gemeente": lambda: register.select(*[F.trim(F.col(c)).alias(n) for c, n in (
            ("Code_3", "gemeentecode"), ("Naam_2", "gemeente"), ("Code_5", "provinciecode"), ("Naam_4", "provincie"), ("Naam_6", "landsdeel"))]).distinct(),
        "dim_opleidingsniveau": lambda: people.levels_table(spark), "dim_sector": lambda: people.sectors_table(spark),
        "dim_fractie": lambda: _pick(t["fractie"], "afkorting", "naam_nl", fractie_id="id"), "dim_jaar": lambda: calendar.year_dimension(spark),
        "fact_opleiding": lambda: education.select(F.col("id").alias("opleiding_id"), "persoon_id", F.col("categorie").alias("niveau"), F.col("bron").alias("niveau_bron"),
                                           F.col("status").alias("voltooid_status"), (F.col("status") == "voltooid").alias("is_voltooid"), *years, "instelling"),
        "fact_loopbaan": lambda: career.select(F.col("id").alias("loopbaan_id"), "persoon_id", "sector", *years, "functie", "werkgever"),
        "dim_persoon": lambda: people.person_dimension(t["persoon"], staging["correcties"], members, education, career, places, as_of),
    })
