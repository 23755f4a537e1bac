"""Parliamentary frames derived from the benchmark tables, with the same frames as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plenaria.operators.sequence import neighbour
from plenaria.queries import Tables

# Votes: decision = order, faction = supplier's nation, member = supplier. Rows from line 4 on are
# votes of a whole faction (no member); weights and mistake flags have gaps.
VOTES_SQL = """votes AS (
  SELECT l_orderkey AS besluit_id, CAST(s_nationkey AS BIGINT) AS fractie_id,
    CASE WHEN l_linenumber < 4 THEN l_suppkey END AS persoon_id,
    CASE WHEN l_returnflag = 'R' THEN 'Tegen' ELSE 'Voor' END AS soort,
    CASE WHEN l_linenumber <> 7 THEN l_quantity END AS fractie_grootte,
    CASE WHEN l_tax > 0 THEN l_linestatus = 'F' END AS vergissing
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""

# Memberships: person = customer, faction = order priority, from the order day to the day before
# the customer's next order; the last one is open. Orders on the same day give empty intervals.
MEMBERS_SQL = """members AS (
  SELECT o_orderkey AS lid_id, o_custkey AS persoon_id, o_orderpriority AS fractie, CAST(o_orderdate AS DATE) AS van,
    CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) - 1 AS tot_en_met
  FROM orders)"""

# Versions of entities: id = user, change time = ts, deleted = error event.
VERSIONS_SQL = """versions AS (
  SELECT CAST(user_id AS VARCHAR) AS id, ts AS bijgewerkt, ts AS feed_updated, event_id AS _row_id,
    event_type = 'error' AS verwijderd, event_type, value FROM events)"""

# Activities: start = event time, end = the user's next event; every 50th event has them swapped.
ACTIVITIES_SQL = """activities AS (
  SELECT event_id AS id, user_id, event_type AS soort, CAST(ts AS DATE) AS datum,
    CASE WHEN event_id % 50 = 0 THEN volgende ELSE ts END AS aanvangstijd,
    CASE WHEN event_id % 50 = 0 THEN ts ELSE volgende END AS eindtijd
  FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS volgende FROM events))"""

# Documents: registered at the order date, received at the ship date; line 7 is received too early.
FLOW_SQL = """flow AS (
  SELECT l_orderkey AS dossier, o_orderpriority AS soort, o_orderstatus AS status, l_partkey AS bron, l_linenumber,
    CAST(o_orderdate AS DATE) AS registratie,
    CASE WHEN l_linenumber = 7 THEN CAST(l_shipdate AS DATE) - 4000 ELSE CAST(l_shipdate AS DATE) END AS ontvangst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def day(column: str):
    return F.col(column).cast("date")


def votes(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity", "l_tax", "l_linestatus")
    joined = lines.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(
        F.col("l_orderkey").alias("besluit_id"), F.col("s_nationkey").cast("bigint").alias("fractie_id"),
        F.when(F.col("l_linenumber") < 4, F.col("l_suppkey")).alias("persoon_id"),
        F.when(F.col("l_returnflag") == "R", "Tegen").otherwise("Voor").alias("soort"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("fractie_grootte"),
        F.when(F.col("l_tax") > 0, F.col("l_linestatus") == "F").alias("vergissing"))


def members(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderkey").alias("lid_id"), F.col("o_custkey").alias("persoon_id"),
                           F.col("o_orderpriority").alias("fractie"), day("o_orderdate").alias("van"))
    ahead = neighbour(rows, ["persoon_id"], ["van", "lid_id"], F.trunc("van", "MM"), {"_volgende": "van"}, "next")
    return ahead.withColumn("tot_en_met", F.date_sub("_volgende", 1)).drop("_volgende")


def versions(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").cast("string").alias("id"), F.col("ts").alias("bijgewerkt"), F.col("ts").alias("feed_updated"),
                           F.col("event_id").alias("_row_id"), (F.col("event_type") == "error").alias("verwijderd"), "event_type", "value")


def activities(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    ahead = neighbour(rows, ["user_id"], ["ts", "event_id"], F.date_trunc("day", "ts"), {"_volgende": "ts"}, "next")
    swap = F.col("event_id") % 50 == 0
    return ahead.select(F.col("event_id").alias("id"), "user_id", F.col("event_type").alias("soort"), day("ts").alias("datum"),
                        F.when(swap, F.col("_volgende")).otherwise(F.col("ts")).alias("aanvangstijd"),
                        F.when(swap, F.col("ts")).otherwise(F.col("_volgende")).alias("eindtijd"))


def flow(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    shipped = day("l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("dossier"), F.col("o_orderpriority").alias("soort"), F.col("o_orderstatus").alias("status"),
        F.col("l_partkey").alias("bron"), "l_linenumber", day("o_orderdate").alias("registratie"),
        F.when(F.col("l_linenumber") == 7, F.date_sub(shipped, 4000)).otherwise(shipped).alias("ontvangst"))


# Conformed tables derived from the benchmark tables, in SQL that both engines read. A name in
# braces is a benchmark table.
CONFORMED = {
    "persoon": """SELECT CAST(c_custkey AS STRING) AS id, c_mktsegment AS nummer, CAST(NULL AS STRING) AS titels, c_name AS voornamen, CASE WHEN c_acctbal > 5000 THEN 'van' END AS tussenvoegsel,
      c_name AS achternaam, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS roepnaam, CASE WHEN c_acctbal < 3000 THEN 'vrouw' ELSE 'man' END AS geslacht, 'X' AS initialen,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'Tweede Kamerlid' WHEN 'MACHINERY' THEN 'Eerste Kamerlid' ELSE 'Oud Kamerlid' END AS functie, CAST(c_nationkey AS STRING) AS fractielabel,
      CASE WHEN c_acctbal > 0 THEN DATE '1925-01-01' + CAST(c_custkey % 25000 AS INT) END AS geboortedatum, CASE WHEN c_acctbal > 9000 THEN DATE '2010-01-01' + CAST(c_custkey % 900 AS INT) END AS overlijdensdatum FROM {customer}""",
    "fractie": """SELECT CAST(n_nationkey AS STRING) AS id, CAST(n_regionkey AS STRING) AS nummer, CASE n_nationkey WHEN 1 THEN 'GL' WHEN 2 THEN 'PvdA' ELSE n_name END AS afkorting,
      CASE n_nationkey WHEN 1 THEN 'GroenLinks' ELSE n_name END AS naam_nl, n_name AS naam_en, n_nationkey * 2 AS aantal_zetels, n_nationkey * 1000 AS aantal_stemmen,
      DATE '1990-01-01' + n_nationkey * 100 AS datum_actief, CASE WHEN n_regionkey = 2 THEN DATE '1999-01-01' + n_nationkey END AS datum_inactief, CAST(NULL AS STRING) AS logo_url FROM {nation}""",
    "fractie_zetel": "SELECT CAST(s_suppkey AS STRING) AS id, CASE WHEN s_acctbal > 0 THEN CAST(s_nationkey AS STRING) END AS fractie_id, CAST(s_suppkey % 5 AS INT) AS gewicht FROM {supplier}",
    "fractie_zetel_persoon": """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_orderkey % 110 AS STRING) AS fractie_zetel_id, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS STRING) END AS persoon_id,
      o_orderpriority AS functie, CAST(o_orderdate AS DATE) AS van, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1500 AS INT) END AS tot_en_met FROM {orders}""",
    "persoon_contactinformatie": """SELECT CAST(o_orderkey AS STRING) AS id, CASE WHEN o_totalprice > 20000 THEN CAST(o_custkey AS STRING) END AS persoon_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS soort,
      o_orderstatus AS waarde, CAST(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 3 END AS INT) AS gewicht, CASE WHEN o_totalprice < 450000 THEN o_orderdate END AS gewijzigd_op FROM {orders}""",
    "document": """SELECT CAST(o_orderkey AS STRING) AS id, o_orderpriority AS soort, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS organisatie, CAST(o_orderdate AS DATE) AS datum, CAST(o_custkey AS STRING) AS titel,
      CAST(o_orderkey * 10 + 1 AS STRING) AS huidige_document_versie_id, CAST(o_custkey AS STRING) AS kamerstukdossier_id, CAST(o_orderkey AS STRING) AS document_nummer, '1996-1997' AS vergaderjaar, CAST(o_orderdate AS DATE) AS datum_registratie,
      CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS datum_ontvangst FROM {orders}""",
    "document_actor": "SELECT CAST(l_orderkey AS STRING) AS document_id, CAST(l_linenumber AS STRING) AS fractie_id, CASE WHEN l_linenumber = 1 THEN 'Eerste ondertekenaar' ELSE 'Mede ondertekenaar' END AS relatie FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    "document_versie": """SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id, CAST(l_orderkey AS STRING) AS document_id, CAST(max(l_partkey) AS BIGINT) AS bestandsgrootte, CAST(l_linenumber AS BIGINT) AS versienummer
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "document_publicatie_metadata": """SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS document_versie_id, CASE WHEN l_returnflag = 'R' THEN 'Metadataowms' ELSE 'Metadata' END AS document_type, CAST(max(l_shipdate) AS DATE) AS publicatie_datum
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber, l_returnflag""",
    "document_bron_document": "SELECT CAST(l_orderkey AS STRING) AS document_id, CAST(l_partkey AS STRING) AS bron_document_id, max(l_shipdate) AS relatie_gewijzigd_op FROM {lineitem} GROUP BY l_orderkey, l_partkey",
    "commissie": """SELECT CAST(n_nationkey AS STRING) AS id, CASE n_regionkey WHEN 0 THEN 'Vaste commissie voor ' WHEN 1 THEN 'Tijdelijke commissie ' WHEN 2 THEN 'Delegatie interparlementair ' ELSE 'Groep ' END || n_name AS naam_nl,
      n_name AS afkorting, 'x' AS soort, DATE '1992-01-01' AS datum_actief, CASE WHEN n_regionkey = 3 THEN DATE '1997-06-01' END AS datum_inactief FROM {nation}""",
    "commissie_zetel": "SELECT CAST(s_suppkey AS STRING) AS id, CAST(s_nationkey AS STRING) AS commissie_id FROM {supplier}",
    "commissie_zetel_vast_persoon": """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_orderkey % 110 AS STRING) AS commissie_zetel_id, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS STRING) END AS persoon_id,
      o_orderpriority AS functie, CAST(o_orderdate AS DATE) AS van, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INT) END AS tot_en_met FROM {orders}""",
    "commissie_zetel_vast_vacature": """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey % 110 AS STRING) AS commissie_zetel_id, CAST(o_orderkey % 25 AS STRING) AS fractie_id, CAST(o_orderdate AS DATE) AS van,
      CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) END AS tot_en_met FROM {orders}""",
    "activiteit": """SELECT CAST(o_orderkey AS STRING) AS id, o_orderpriority AS soort, CAST(o_custkey AS STRING) AS onderwerp, CAST(o_orderdate AS DATE) AS datum, CASE WHEN o_totalprice > 100000 THEN 'Dag' ELSE 'Week' END AS datum_soort,
      CASE o_orderstatus WHEN 'F' THEN 'Uitgevoerd' WHEN 'O' THEN 'Gepland' END AS status, CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey % 25 AS STRING) END AS voortouwcommissie_id, CAST(o_custkey % 25 AS STRING) AS voortouwnaam,
      'TK' AS kamer, o_totalprice < 150000 AS besloten, o_orderdate AS aanvangstijd, CASE WHEN o_totalprice > 30000 THEN o_orderdate + INTERVAL '90' MINUTE END AS eindtijd FROM {orders}""",
    "agendapunt": "SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id, CAST(l_orderkey AS STRING) AS activiteit_id, CAST(l_linenumber AS STRING) AS onderwerp FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    "besluit": """SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id, CAST(l_orderkey * 10 + l_linenumber AS STRING) AS agendapunt_id, 'hand' AS stemmings_soort, max(l_linestatus) AS status,
      CASE max(l_returnflag) WHEN 'R' THEN 'Stemmen - aangenomen' WHEN 'N' THEN 'Stemmen - Verworpen' ELSE 'Anders' END AS besluit_soort FROM {lineitem} WHERE l_linenumber < 6 GROUP BY l_orderkey, l_linenumber""",
    "besluit_zaak": "SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS besluit_id, CAST(l_partkey AS STRING) AS zaak_id FROM {lineitem} WHERE l_linenumber < 6 GROUP BY l_orderkey, l_linenumber, l_partkey",
    "zaak": "SELECT CAST(p_partkey AS STRING) AS id, p_type AS soort, p_name AS onderwerp, CASE WHEN p_size > 20 THEN p_brand END AS titel, p_brand AS status, p_size > 30 AS afgedaan, DATE '1990-01-01' + p_size AS gestart_op FROM {part}",
    "zaak_actor": "SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id, CAST(max(l_partkey) AS STRING) AS zaak_id, CAST(l_linenumber AS STRING) AS fractie_id, 'x' AS actor_naam, CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS STRING) END AS actor_fractie, 'Indiener' AS relatie FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    "stemming": """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS id, CAST(l_orderkey * 10 + max(l_linenumber) AS STRING) AS besluit_id, CAST(l_suppkey % 25 AS STRING) AS fractie_id,
      CASE WHEN max(l_tax) > 0.04 THEN CAST(l_suppkey AS STRING) END AS persoon_id, CASE max(l_returnflag) WHEN 'R' THEN 'Tegen' ELSE 'Voor' END AS soort, CAST(max(l_quantity) AS INT) AS fractie_grootte, max(l_tax) > 0.07 AS vergissing
      FROM {lineitem} GROUP BY l_orderkey, l_partkey, l_suppkey""",
    "persoon_nevenfunctie": "SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS persoon_id, o_orderpriority AS omschrijving, o_orderstatus AS vergoeding_soort FROM {orders}",
    "persoon_nevenfunctie_inkomsten": """SELECT CAST(l_orderkey AS STRING) AS persoon_nevenfunctie_id, CAST(year(l_shipdate) + 20 AS INT) AS jaar, CASE WHEN l_discount > 0 THEN l_extendedprice ELSE 0.0 END AS bedrag,
      CASE l_linenumber WHEN 1 THEN 'Per maand' WHEN 2 THEN 'Per dag' WHEN 3 THEN 'Vrije invoer' ELSE 'Per jaar' END AS frequentie FROM {lineitem}""",
    "persoon_reis": """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS id, CAST(l_suppkey AS STRING) AS persoon_id, max(l_returnflag) AS doel, max(l_linestatus) AS bestemming, max(CAST(l_shipdate AS DATE)) AS van,
      max(CAST(l_shipdate AS DATE)) + CAST(max(l_linenumber) AS INT) AS tot_en_met, 'x' AS betaald_door FROM {lineitem} GROUP BY l_orderkey, l_partkey, l_suppkey""",
    "persoon_geschenk": """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS id, CAST(l_suppkey AS STRING) AS persoon_id, max(CAST(l_shipdate AS DATE)) AS datum, CAST(max(l_linenumber) AS INT) AS gewicht, max(l_returnflag) AS omschrijving
      FROM {lineitem} GROUP BY l_orderkey, l_partkey, l_suppkey""",
    "kamerstukdossier": "SELECT CAST(c_custkey AS STRING) AS id, c_name AS titel, CAST(c_custkey AS INT) AS nummer, c_mktsegment AS toevoeging, 'TK' AS kamer FROM {customer}",
    "zaal": "SELECT CAST(n_nationkey AS STRING) AS id, n_name AS naam FROM {nation}",
    "reservering": "SELECT CAST(event_id AS STRING) AS id, CAST(event_id * 2 AS STRING) AS activiteit_id, CAST(user_id % 30 AS STRING) AS zaal_id FROM {events}",
    "persoon_onderwijs": """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey * 2 AS STRING) AS persoon_id, CAST(o_orderdate AS DATE) AS van, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 700 END AS tot_en_met, o_orderstatus AS instelling FROM {orders}""",
    "persoon_loopbaan": """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey * 3 AS STRING) AS persoon_id, CAST(o_orderdate AS DATE) AS van, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 700 END AS tot_en_met, o_orderpriority AS functie, o_orderstatus AS werkgever FROM {orders}""",
    # staging of the career star
    "stg_onderwijs": """SELECT CAST(o_orderkey AS STRING) AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'wo' WHEN '2-HIGH' THEN 'hbo' WHEN '3-MEDIUM' THEN 'cursus' WHEN '4-NOT SPECIFIED' THEN 'promotie' ELSE 'onbekend' END AS categorie,
      CASE WHEN o_totalprice > 200000 THEN 'tekst' ELSE 'instelling' END AS bron, CASE WHEN o_orderstatus = 'P' THEN 'niet_voltooid' ELSE 'voltooid' END AS status FROM {orders}""",
    "stg_loopbaan": """SELECT CAST(o_orderkey AS STRING) AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'kamerlidmaatschap' WHEN '2-HIGH' THEN 'zorg' WHEN '3-MEDIUM' THEN 'overig_onvoldoende_sectorcontext' WHEN '4-NOT SPECIFIED' THEN 'onbekend' ELSE 'overheid' END AS sector FROM {orders}""",
    "stg_correcties": "SELECT CAST(c_custkey AS STRING) AS id, DATE '1998-07-12' AS geboortedatum FROM {customer} WHERE c_acctbal BETWEEN -500 AND 500",
    "stg_plaats": """SELECT CAST(c_custkey AS STRING) AS id, CASE WHEN c_acctbal > 3000 THEN CAST(c_nationkey AS STRING) END AS geboorte_gemeentecode, CASE WHEN c_acctbal > 3000 THEN 'gematcht (eenduidig)' WHEN c_acctbal > 1000 THEN 'niet gevonden' WHEN c_acctbal > 0 THEN 'geen plaats ingevuld' END AS plaats_status,
      CAST(NULL AS STRING) AS woon_gemeentecode, CASE WHEN c_acctbal > 2000 THEN 'niet eenduidig' ELSE 'niet ingevuld' END AS woon_status FROM {customer}""",
    "stg_register": "SELECT ' ' || n_name AS \"Woonplaatsen\", 'G' || CAST(n_regionkey AS STRING) AS \"Naam_2\", CAST(n_regionkey AS STRING) AS \"Code_3\", r_name AS \"Naam_4\", 'P' AS \"Code_5\", 'L' AS \"Naam_6\" FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
}


class Conformed(dict):
    """Conformed stand-in tables by name, built on first use."""

    def __init__(self, t: Tables):
        super().__init__()
        self._t = t

    def __missing__(self, name: str) -> DataFrame:
        import re

        from plenaria.queries import TABLE_NAMES

        text = CONFORMED[name].replace('"', "`")
        used = {n: getattr(self._t, n) for n in TABLE_NAMES if re.search(r"\{%s\}" % n, text)}
        self[name] = self._t.spark.sql(text, **used)
        return self[name]


def conformed_sql(*names: str) -> str:
    """The named stand-in tables as common table expressions."""
    return ", ".join(f"{n} AS ({CONFORMED[n].replace('{', '').replace('}', '')})" for n in names)
