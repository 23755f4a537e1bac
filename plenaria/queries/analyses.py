"""Committees, decisions, documents, income, travel, contacts, rooms, cases and places."""

from datetime import date

from pyspark.sql import functions as F

from plenaria.plans import committees as C
from plenaria.plans import decisions as B
from plenaria.plans import documents as D
from plenaria.plans import people as P
from plenaria.queries import Tables, query
from plenaria.queries import standins as s
from plenaria.queries.standins import Conformed, conformed_sql
from plenaria.rules import classifiers

_S, _DAY = "DATE '1998-01-01'", date(1998, 1, 1)


# ---- committees --------------------------------------------------------------------------------
def _sittings(c):
    return c["commissie_zetel_vast_persoon"].join(c["commissie_zetel"].withColumnRenamed("id", "commissie_zetel_id"), "commissie_zetel_id")


def _vacant(c):
    return c["commissie_zetel_vast_vacature"].join(c["commissie_zetel"].withColumnRenamed("id", "commissie_zetel_id"), "commissie_zetel_id")


_SIT = "sit AS (SELECT zp.*, z.commissie_id FROM commissie_zetel_vast_persoon zp JOIN commissie_zetel z ON z.id = zp.commissie_zetel_id)"
_VAC = "vac AS (SELECT v.*, z.commissie_id FROM commissie_zetel_vast_vacature v JOIN commissie_zetel z ON z.id = v.commissie_zetel_id)"
_TYPE = "CASE WHEN naam_nl ILIKE '%enquête%' OR naam_nl ILIKE '%tijdelijke%' THEN 'tijdelijk' WHEN naam_nl ILIKE 'vaste commissie%' OR naam_nl ILIKE 'algemene commissie%' OR naam_nl ILIKE 'commissie voor%' THEN 'vast' WHEN naam_nl ILIKE 'delegatie%' OR naam_nl ILIKE '%groep%' THEN 'interparlementair' ELSE 'overig' END"
_SEATED = ("commissie_zetel", "commissie_zetel_vast_persoon")


@query("a15_types", f"WITH {conformed_sql('commissie')} SELECT {_TYPE} AS commissietype, count(*) AS aantal, count(*) FILTER (WHERE datum_inactief IS NULL) AS nog_actief FROM commissie GROUP BY 1")
def types(t: Tables):
    return C.by_type(Conformed(t)["commissie"])


@query("a15_scorecard", f"""WITH {conformed_sql('commissie', 'commissie_zetel_vast_vacature', 'activiteit', *_SEATED)}, {_SIT}, {_VAC},
z AS (SELECT commissie_id, count(DISTINCT commissie_zetel_id) AS n FROM sit WHERE van <= {_S} AND (tot_en_met IS NULL OR tot_en_met >= {_S}) GROUP BY 1),
v AS (SELECT commissie_id, count(*) AS n, count(*) FILTER (WHERE tot_en_met IS NULL) AS o, round(avg(date_diff('day', van, coalesce(tot_en_met, {_S}))), 0) AS g FROM vac GROUP BY 1),
d AS (SELECT commissie_id, count(*) AS n, round(sum(date_diff('day', van, coalesce(tot_en_met, {_S}))) / count(*) / 365.25, 1) AS j FROM sit GROUP BY 1), a AS (SELECT voortouwcommissie_id AS commissie_id, count(*) AS n FROM activiteit WHERE voortouwcommissie_id IS NOT NULL GROUP BY 1)
SELECT c.id AS commissie_id, naam_nl, {_TYPE} AS commissietype, coalesce(z.n, 0) AS aantal_zetels, coalesce(v.n, 0) AS vacatures, coalesce(o, 0) AS nu_open, g AS gem_dagen_open, coalesce(d.n, 0) AS zittingen, j AS gem_jaren, coalesce(a.n, 0) AS activiteiten
FROM commissie c LEFT JOIN z ON z.commissie_id = c.id LEFT JOIN v ON v.commissie_id = c.id LEFT JOIN d ON d.commissie_id = c.id LEFT JOIN a ON a.commissie_id = c.id""")
def scorecard(t: Tables):
    c = Conformed(t)
    return C.scorecard(c["commissie"], _sittings(c), _vacant(c), c["activiteit"], _DAY)


@query("a15_vacancy", f"""WITH {conformed_sql('commissie_zetel', 'commissie_zetel_vast_vacature')}, {_VAC}
SELECT commissie_id, count(*) AS vacatures, count(*) FILTER (WHERE tot_en_met IS NULL) AS nu_open, round(avg(date_diff('day', van, coalesce(tot_en_met, {_S}))), 0) AS gem_dagen_open FROM vac GROUP BY 1""")
def vacancy(t: Tables):
    return C.vacancies(_vacant(Conformed(t)), _DAY)


@query("a15_tenure", f"""WITH {conformed_sql(*_SEATED)}, {_SIT} SELECT commissie_id, count(*) AS zittingen, round(sum(date_diff('day', van, coalesce(tot_en_met, {_S}))) / count(*) / 365.25, 1) AS gem_jaren FROM sit GROUP BY 1 HAVING count(*) >= 10""")
def tenure(t: Tables):
    return C.tenure(_sittings(Conformed(t)), _DAY)


_NOW = f"now AS (SELECT DISTINCT commissie_id, p.id AS persoon_id, geslacht, geboortedatum FROM sit JOIN persoon p ON p.id = sit.persoon_id WHERE tot_en_met IS NULL)"


def _now(c):
    people = c["persoon"].select(F.col("id").alias("persoon_id"), "geslacht", "geboortedatum")
    return _sittings(c).where("tot_en_met IS NULL").join(people, "persoon_id")


@query("a15_gender", f"""WITH {conformed_sql('persoon', *_SEATED)}, {_SIT}, {_NOW} SELECT commissie_id, count(*) FILTER (WHERE geslacht = 'vrouw') AS vrouwen, count(*) FILTER (WHERE geslacht = 'man') AS mannen, count(*) AS totaal,
  round(100.0 * count(*) FILTER (WHERE geslacht = 'vrouw') / count(*), 1) AS pct_vrouw FROM now GROUP BY 1 HAVING count(*) >= 5""")
def gender(t: Tables):
    return C.gender(_now(Conformed(t)))


@query("a15_ages", f"""WITH {conformed_sql('persoon', *_SEATED)}, {_SIT}, {_NOW}, l AS (SELECT commissie_id, date_sub('year', geboortedatum, {_S}) AS j FROM now WHERE geboortedatum IS NOT NULL)
SELECT commissie_id, count(*) AS leden, round(avg(j), 1) AS gemiddeld, min(j) AS jongste, max(j) AS oudste, median(j) AS mediaan FROM l GROUP BY 1""")
def ages(t: Tables):
    return C.ages(_now(Conformed(t)), _DAY)


@query("a15_linked_cases", f"""WITH {conformed_sql('activiteit', 'agendapunt', 'besluit', 'besluit_zaak')} SELECT voortouwcommissie_id AS commissie_id, count(DISTINCT zaak_id) AS zaken FROM activiteit a JOIN agendapunt ap ON ap.activiteit_id = a.id
  JOIN besluit b ON b.agendapunt_id = ap.id JOIN besluit_zaak bz ON bz.besluit_id = b.id WHERE voortouwcommissie_id IS NOT NULL GROUP BY 1""")
def linked_cases(t: Tables):
    c = Conformed(t)
    return C.linked_cases(c["activiteit"], c["agendapunt"], c["besluit"], c["besluit_zaak"])


@query("a15_effectiveness", f"""WITH {conformed_sql('activiteit')} SELECT voortouwnaam, count(*) AS totaal, count(*) FILTER (WHERE status ILIKE 'uitgevoerd') AS uitgevoerd, round(100.0 * count(*) FILTER (WHERE status ILIKE 'uitgevoerd') / count(*), 1) AS pct_uitgevoerd
FROM activiteit GROUP BY 1 HAVING count(*) >= 100""")
def effectiveness(t: Tables):
    return C.effectiveness(Conformed(t)["activiteit"])


# ---- decisions and activities ------------------------------------------------------------------
_DECIDED = f"{conformed_sql('besluit', 'besluit_zaak', 'zaak')}, dec AS (SELECT z.soort, bz.zaak_id, z.status AS indiener, nullif(regexp_extract(besluit_soort, '(aangenomen|verworpen|aangehouden)', 1), '') AS uitkomst FROM besluit b JOIN besluit_zaak bz ON bz.besluit_id = b.id JOIN zaak z ON z.id = bz.zaak_id)"


def _decided(t: Tables):
    """Decisions with case kind, proposer (brand) and outcome; lower case covers both spellings."""
    c = Conformed(t)
    kinds = c["zaak"].select(F.col("id").alias("zaak_id"), "soort", F.col("status").alias("indiener"))
    decided = B.with_outcome(c["besluit"].select(F.col("id").alias("besluit_id"), F.lower("besluit_soort").alias("besluit_soort")))
    return c["besluit_zaak"].join(decided, "besluit_id").join(kinds, "zaak_id")


_DECIDED = _DECIDED.replace("regexp_extract(besluit_soort", "regexp_extract(lower(besluit_soort)")
_PCT = ", ".join(f"round(100.0 * count(*) FILTER (WHERE uitkomst = '{o}') / nullif(count(uitkomst), 0), 2) AS {o}" for o in ("aangenomen", "verworpen", "aangehouden"))
_PROPOSER = f"prop AS (SELECT indiener, {_PCT}, count(DISTINCT zaak_id) AS aantal_zaken FROM (SELECT DISTINCT zaak_id, indiener, uitkomst FROM dec) GROUP BY 1 HAVING count(uitkomst) > 0)"


@query("a17_outcomes", f"WITH {_DECIDED} SELECT soort, uitkomst, count(*) AS aantal, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY soort), 2) AS aandeel FROM dec WHERE uitkomst IS NOT NULL GROUP BY 1, 2")
def outcomes(t: Tables):
    return B.outcome_shares(_decided(t), "soort")


@query("a17_most_common", f"WITH {_DECIDED}, a AS (SELECT soort, uitkomst, count(*) AS aantal, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY soort), 2) AS aandeel FROM dec WHERE uitkomst IS NOT NULL GROUP BY 1, 2) SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY soort ORDER BY aantal DESC, uitkomst) = 1")
def most_common(t: Tables):
    return B.most_common_outcome(_decided(t), "soort")


@query("a17_per_proposer", f"WITH {_DECIDED}, {_PROPOSER} SELECT * FROM prop")
def per_proposer(t: Tables):
    return B.outcomes_per_proposer(_decided(t), "indiener")


@query("a17_top_proposers", f"""WITH {_DECIDED}, {_PROPOSER}, l AS (SELECT indiener, aantal_zaken, unnest(['aangenomen', 'verworpen', 'aangehouden']) AS categorie, unnest([aangenomen, verworpen, aangehouden]) AS percentage FROM prop WHERE aangenomen <> 100 AND verworpen <> 100 AND aangehouden <> 100)
SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY categorie ORDER BY percentage DESC, indiener) <= 3""")
def top_proposers(t: Tables):
    return B.top_per_outcome(B.outcomes_per_proposer(_decided(t), "indiener"), "indiener")


@query("a17_duration", f"""WITH {s.ACTIVITIES_SQL}, d AS (SELECT soort AS uitkomst, CASE WHEN date_diff('minute', aanvangstijd, eindtijd) >= 0 THEN date_diff('minute', aanvangstijd, eindtijd) END AS m FROM activities)
SELECT uitkomst, count(m) AS aantal, round(avg(m), 2) AS gemiddelde, median(m) AS mediaan FROM d GROUP BY 1""")
def durations(t: Tables):
    from plenaria.functions.dates import minutes_between

    minutes = minutes_between(F.col("aanvangstijd"), F.col("eindtijd"))
    rows = s.activities(t).select(F.col("soort").alias("uitkomst"), F.when(minutes >= 0, minutes).alias("duur_minuten"))
    return B.duration_by_outcome(rows)


@query("a18_per_day", "SELECT activiteiten, count(*) AS dagen FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS activiteiten FROM orders GROUP BY 1) GROUP BY 1")
def per_day(t: Tables):
    return B.activities_per_day(t.orders.select(s.day("o_orderdate").alias("datum")))


@query("a18_kinds_per_day", "SELECT soorten, count(*) AS dagen FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(DISTINCT o_orderpriority) AS soorten FROM orders GROUP BY 1) GROUP BY 1")
def kinds_per_day(t: Tables):
    return B.kinds_per_day(t.orders.select(s.day("o_orderdate").alias("datum"), F.col("o_orderpriority").alias("soort")))


# ---- documents ---------------------------------------------------------------------------------
@query("a19_lead_time", f"""WITH {s.FLOW_SQL}, d AS (SELECT soort, date_diff('day', registratie, ontvangst) AS d FROM flow WHERE ontvangst >= registratie)
SELECT soort, count(*) AS aantal, round(avg(d), 2) AS gemiddelde, round(100.0 * count(*) FILTER (WHERE d <= 7) / count(*), 1) AS pct_binnen, median(d) AS mediaan, quantile_cont(d, 0.9) AS p90 FROM d GROUP BY 1 HAVING count(*) >= 100""")
def lead_time(t: Tables):
    rows = s.flow(t).withColumn("dagen", D.lead_days(F.col("registratie"), F.col("ontvangst")))
    return D.lead_time_stats(rows, ["soort"], "dagen", min_rows=100)


@query("a19_first_signatory", f"""WITH {conformed_sql('document', 'document_actor')} SELECT fractie_id, count(*) AS aantal, round(avg(d), 2) AS gemiddelde, round(100.0 * count(*) FILTER (WHERE d <= 7) / count(*), 1) AS pct_binnen, median(d) AS mediaan, quantile_cont(d, 0.9) AS p90
FROM (SELECT fractie_id, date_diff('day', datum_registratie, datum_ontvangst) AS d FROM document JOIN document_actor ON document_id = id WHERE relatie = 'Eerste ondertekenaar') GROUP BY 1""")
def first_signatory(t: Tables):
    c = Conformed(t)
    days = c["document"].select(F.col("id").alias("document_id"), D.lead_days(F.col("datum_registratie"), F.col("datum_ontvangst")).alias("dagen"))
    return D.lead_time_stats(D.first_signatories(c["document_actor"]).join(days, "document_id"), ["fractie_id"], "dagen")


@query("a19_publication_chain", f"""WITH {conformed_sql('document', 'document_versie', 'document_publicatie_metadata')} SELECT d.id AS document_id, v.id AS document_versie_id, publicatie_datum, date_diff('day', datum_registratie, datum_ontvangst) AS dagen_registratie_ontvangst,
  date_diff('day', datum_ontvangst, publicatie_datum) AS dagen_ontvangst_publicatie, date_diff('day', datum_registratie, publicatie_datum) AS dagen_registratie_publicatie FROM document d JOIN document_versie v ON v.document_id = d.id JOIN document_publicatie_metadata p ON p.document_versie_id = v.id""")
def publication_chain(t: Tables):
    c = Conformed(t)
    return D.publication_chain(c["document"], c["document_versie"], c["document_publicatie_metadata"])


_SPAN = f"{s.FLOW_SQL}, sp AS (SELECT dossier, any_value(status) AS status, count(*) AS documenten, min(ontvangst) AS eerste, max(ontvangst) AS laatste, date_diff('day', min(ontvangst), max(ontvangst)) AS looptijd FROM flow GROUP BY 1)"


@query("a20_lifespan", f"""WITH {_SPAN} SELECT CASE WHEN looptijd <= 30 THEN '1. < 1 mnd' WHEN looptijd <= 182 THEN '2. 1-6 mnd' WHEN looptijd <= 365 THEN '3. 6-12 mnd' WHEN looptijd <= 1826 THEN '4. 1-5 jaar' ELSE '5. > 5 jaar' END AS klasse, count(*) AS dossiers FROM sp GROUP BY 1""")
def lifespan(t: Tables):
    return D.lifespan_classes(D.dossier_span(s.flow(t), "dossier", "ontvangst"))


@query("a20_by_status", f"WITH {_SPAN} SELECT status, count(*) AS dossiers, round(avg(looptijd), 2) AS gemiddelde, max(looptijd) AS langste, median(looptijd) AS mediaan FROM sp GROUP BY 1")
def by_status(t: Tables):
    spans = D.dossier_span(s.flow(t), "dossier", "ontvangst").join(t.orders.select(F.col("o_orderkey").alias("dossier"), F.col("o_orderstatus").alias("status")), "dossier")
    return D.lifespan_by_status(spans, "status")


@query("a20_largest", f"WITH {_SPAN} SELECT dossier, documenten, looptijd FROM sp ORDER BY documenten DESC, dossier LIMIT 10")
def largest(t: Tables):
    return D.largest(D.dossier_span(s.flow(t), "dossier", "ontvangst"), "documenten", "dossier").select("dossier", "documenten", "looptijd")


@query("a21_citations", "SELECT p_type AS soort, count(*) AS als_bron FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def cited_kinds(t: Tables):
    documents = t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("soort"))
    return D.cited_kinds(t.lineitem.select(F.col("l_partkey").alias("bron_document_id")), documents)


@query("a21_most_cited", "SELECT l_partkey AS bron_document_id, count(*) AS verwijzingen FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def most_cited(t: Tables):
    return D.most_cited(t.lineitem.select(F.col("l_partkey").alias("bron_document_id")))


@query("a21_citing_share", """
SELECT count(*) AS vermeldingen, count(DISTINCT l_orderkey) AS met_bron, (SELECT count(*) FROM orders) AS documenten, round(100.0 * count(DISTINCT l_orderkey) / (SELECT count(*) FROM orders), 1) AS pct_met_bron FROM lineitem""")
def citing_share(t: Tables):
    return D.citing_share(t.lineitem.select(F.col("l_orderkey").alias("document_id")), t.orders)


@query("a21_several_sources", "SELECT l_orderkey AS document_id, count(*) AS bronnen FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def several_sources(t: Tables):
    return D.several_sources(t.lineitem.select(F.col("l_orderkey").alias("document_id")))


@query("a21_delay_histogram", f"WITH {s.FLOW_SQL} SELECT CAST(floor(date_diff('day', registratie, ontvangst) / 100) * 100 AS BIGINT) AS vanaf, count(*) AS aantal FROM flow GROUP BY 1")
def delays(t: Tables):
    rows = s.flow(t).withColumn("dagen", D.lead_days(F.col("registratie"), F.col("ontvangst"), keep_negative=True))
    return D.delay_histogram(rows, "dagen")


# ---- income, travel, contacts ------------------------------------------------------------------
_INCOME = f"{conformed_sql('persoon_nevenfunctie', 'persoon_nevenfunctie_inkomsten')}, ink AS (SELECT persoon_id, jaar, CAST(bedrag AS DECIMAL(18,2)) AS bedrag, frequentie, CAST(bedrag AS DECIMAL(18,2)) * CASE WHEN lower(frequentie) LIKE '%maand%' THEN 12 ELSE 1 END AS per_jaar FROM persoon_nevenfunctie_inkomsten JOIN persoon_nevenfunctie n ON n.id = persoon_nevenfunctie_id)"


def _income(c):
    return c["persoon_nevenfunctie_inkomsten"].join(c["persoon_nevenfunctie"].select(F.col("id").alias("persoon_nevenfunctie_id"), "persoon_id"), "persoon_nevenfunctie_id")


@query("a22_income", f"WITH {_INCOME} SELECT persoon_id, jaar::BIGINT AS jaar, CAST(sum(per_jaar) AS DOUBLE) AS bedrag FROM ink GROUP BY 1, 2")
def income(t: Tables):
    return P.yearly_income(_income(Conformed(t)), ["persoon_id", "jaar"])


@query("a22_earner_share", f"""WITH {_INCOME}, {s.MEMBERS_SQL}, e AS (SELECT persoon_id, sum(per_jaar) AS b FROM ink WHERE bedrag > 0 GROUP BY 1), p AS (SELECT DISTINCT CAST(persoon_id AS VARCHAR) AS persoon_id, fractie FROM members)
SELECT fractie, count(*) AS personen, count(b) AS verdieners, round(100.0 * count(b) / count(*), 1) AS pct_verdieners, CAST(coalesce(sum(b), 0) AS DOUBLE) AS totaal, round(CAST(sum(b) AS DOUBLE) / nullif(count(b), 0), 0) AS gem_per_verdiener FROM p LEFT JOIN e ON p.persoon_id = e.persoon_id GROUP BY 1""")
def earner_share(t: Tables):
    held = s.members(t).withColumn("persoon_id", F.col("persoon_id").cast("string"))
    return P.earner_share(_income(Conformed(t)), held)


@query("a22_dominant_party", """
SELECT o_custkey AS persoon_id, o_orderpriority AS hoofd_fractie FROM orders GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,2))) DESC, o_orderpriority) = 1""")
def dominant_party(t: Tables):
    return P.dominant_party(t.orders.select(F.col("o_custkey").alias("persoon_id"), F.col("o_orderpriority").alias("fractie_id"), F.col("o_totalprice").alias("bedrag")))


_HELD = "held AS (SELECT l_orderkey, l_partkey, l_suppkey, persoon_id, datum, dagen FROM (SELECT l_orderkey, l_partkey, l_suppkey, o_custkey AS persoon_id, CAST(l_shipdate AS DATE) AS datum, CAST(l_linenumber AS BIGINT) AS dagen FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"


@query("a23_trips", f"""WITH {s.MEMBERS_SQL}, {_HELD} SELECT fractie AS fractie_op_dag, count(*) AS reizen, CAST(sum(dagen) AS BIGINT) AS dagen FROM held h JOIN members m ON h.persoon_id = m.persoon_id AND datum >= van AND (tot_en_met IS NULL OR datum <= tot_en_met) GROUP BY 1""")
def trips(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_linenumber").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    start = s.day("l_shipdate")
    rows = P.trip_days(lines.select(F.col("o_custkey").alias("persoon_id"), start.alias("van"), F.date_add(start, F.col("l_linenumber")).alias("tot_en_met")))
    joined = P.with_party_on_day(rows, s.members(t), "van")
    return joined.groupBy("fractie_op_dag").agg(F.count(F.lit(1)).alias("reizen"), F.sum("duur_dagen").alias("dagen"))


@query("a23_gift_party", f"""WITH {conformed_sql('persoon_geschenk', 'fractie', 'fractie_zetel', 'fractie_zetel_persoon')}, m AS (SELECT persoon_id, f.id AS f, van, tot_en_met FROM fractie_zetel_persoon zp JOIN fractie_zetel z ON z.id = zp.fractie_zetel_id JOIN fractie f ON f.id = z.fractie_id)
SELECT g.id, f AS fractie_op_dag FROM persoon_geschenk g JOIN m ON m.persoon_id = g.persoon_id AND datum >= van AND (tot_en_met IS NULL OR datum <= tot_en_met) QUALIFY row_number() OVER (PARTITION BY g.id ORDER BY van DESC, f DESC) = 1""")
def gift_party(t: Tables):
    """Gifts with one faction: of overlapping seats the one that started last."""
    from plenaria.plans.seats import memberships

    c = Conformed(t)
    held = memberships(c["fractie_zetel_persoon"], c["fractie_zetel"], c["fractie"])
    gifts = c["persoon_geschenk"].select("id", "persoon_id", "datum")
    return P.with_party_on_day(gifts, held, "datum", "fractie_id", on_overlap="latest", row_key=["id"]).select("id", "fractie_op_dag")


@query("a23_destinations", "SELECT l_linestatus AS bestemming, count(*) AS aantal FROM lineitem GROUP BY 1")
def destinations(t: Tables):
    return P.counts_by(t.lineitem.select(F.col("l_linestatus").alias("bestemming")), "bestemming")


_CONTACTS = conformed_sql("persoon", "persoon_contactinformatie")


@query("a24_channels", f"""WITH {_CONTACTS} SELECT CASE WHEN lower(soort) IN ('x', 'twitter') THEN 'X (Twitter)' ELSE soort END AS kanaal, count(*) AS aantal, round(avg(gewicht), 4) AS gem_gewicht FROM persoon_contactinformatie GROUP BY 1""")
def channels(t: Tables):
    return P.channel_stats(Conformed(t)["persoon_contactinformatie"])


@query("a24_top_channel", f"""WITH {_CONTACTS}, s AS (SELECT fractielabel, soort, sum(gewicht) AS g FROM persoon_contactinformatie c JOIN persoon p ON p.id = c.persoon_id WHERE soort IS NOT NULL GROUP BY 1, 2)
SELECT fractielabel, soort AS kanaal FROM s QUALIFY row_number() OVER (PARTITION BY fractielabel ORDER BY g DESC, soort) = 1""")
def top_channel(t: Tables):
    c = Conformed(t)
    return P.top_channel(c["persoon_contactinformatie"], c["persoon"])


# ---- rooms, cases, education, careers, places ---------------------------------------------------
@query("a25_rooms", r"""
SELECT regexp_replace(strip_accents(lower(split_part(text, ' ', 1))), '[^\p{L}\p{N}]+', '', 'g') AS zaal_sleutel, count(*) AS vergaderingen FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def rooms(t: Tables):
    """Top rooms after merging spellings: rooms are the first words of documents."""
    meetings = t.documents.select(F.split_part(F.col("text"), F.lit(" "), F.lit(1)).alias("zaal"))
    return P.room_use(meetings).select("zaal_sleutel", "vergaderingen")


@query("a25_openness", f"WITH {conformed_sql('activiteit')} SELECT CASE WHEN besloten THEN 'Besloten' WHEN NOT besloten THEN 'Openbaar' ELSE 'Onbekend' END AS type_activiteit, count(*) AS aantal FROM (SELECT CASE WHEN soort <> '5-LOW' THEN besloten END AS besloten FROM activiteit) GROUP BY 1")
def openness(t: Tables):
    rows = Conformed(t)["activiteit"].select(F.when(F.col("soort") != "5-LOW", F.col("besloten")).alias("besloten"))
    return B.openness_counts(rows, classifiers.openness(F.col("besloten")))


_CASES = conformed_sql("zaak")


@query("a26_not_done", f"""WITH {_CASES} SELECT soort, count(*) AS totaal, count(*) FILTER (WHERE NOT afgedaan) AS niet_afgedaan, round(100.0 * count(*) FILTER (WHERE NOT afgedaan) / count(*), 2) AS pct_niet_afgedaan FROM zaak GROUP BY 1 HAVING count(*) >= 100 AND count(*) FILTER (WHERE NOT afgedaan) > 0""")
def not_done(t: Tables):
    return B.not_done(Conformed(t)["zaak"], min_cases=100)


@query("a26_always_done", "SELECT DISTINCT p_size::BIGINT AS soort FROM part WHERE p_size NOT IN (SELECT p_size FROM part WHERE p_retailprice < 903)")
def always_done(t: Tables):
    return B.always_done(t.part.select(F.col("p_size").alias("soort"), (F.col("p_retailprice") >= 903).alias("afgedaan")))


@query("a26_summary", f"WITH {_CASES} SELECT count(*) AS zaken, count(*) FILTER (WHERE afgedaan) AS afgedaan, count(*) FILTER (WHERE NOT afgedaan) AS niet_afgedaan, count(*) FILTER (WHERE titel IS NULL) AS zonder_titel FROM zaak")
def summary(t: Tables):
    return B.done_summary(Conformed(t)["zaak"])


_EDU = conformed_sql("stg_onderwijs")


@query("a27_highest_level", f"""WITH {_EDU}, r(c, rang) AS (VALUES ('hbo', 3), ('wo', 4), ('promotie', 5)) SELECT CAST(o_custkey AS VARCHAR) AS persoon_id, categorie AS opleiding_hoogste, bron AS opleiding_hoogste_bron FROM orders JOIN stg_onderwijs ON id = CAST(o_orderkey AS VARCHAR) JOIN r ON c = categorie
WHERE status = 'voltooid' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY rang DESC, (bron = 'tekst') DESC, id) = 1""")
def highest(t: Tables):
    owners = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("persoon_id"))
    return P.highest_level(Conformed(t)["stg_onderwijs"].join(owners, "id"))


@query("a28_sector_bounds", f"""WITH {conformed_sql('stg_loopbaan')} SELECT CAST(o_custkey AS VARCHAR) AS persoon_id, count(*) AS n_loopbaanrijen, count(*) FILTER (WHERE sector IN ('zorg', 'overheid', 'overig_onvoldoende_sectorcontext')) AS n_buiten_politiek,
  count(*) FILTER (WHERE sector IN ('zorg', 'overheid')) AS n_buiten_zeker FROM orders JOIN stg_loopbaan ON id = CAST(o_orderkey AS VARCHAR) GROUP BY 1""")
def sector_bounds(t: Tables):
    owners = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("persoon_id"))
    return P.sector_bounds(Conformed(t)["stg_loopbaan"].join(owners, "id"))


# the register's places are part names, municipalities their types, codes their brands
_PLACES = """reg AS (SELECT DISTINCT p_name AS plaats, p_type AS gemeente, p_brand AS code FROM part WHERE p_size > 45), keys AS (SELECT lower(plaats) AS k, code, gemeente FROM reg UNION SELECT lower(gemeente), code, gemeente FROM reg),
one AS (SELECT k, count(DISTINCT code) AS n, min(struct_pack(code := code, gemeente := gemeente)) AS m FROM keys GROUP BY 1),
p AS (SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_name || ' (Ov.)' END AS w, CASE WHEN p_type <> 'PROMO' THEN CASE lower(p_name) WHEN 'red widget' THEN 'blue widget' ELSE lower(p_name) END END AS k FROM part),
matched AS (SELECT p_partkey, p.k AS sleutel, CASE WHEN n = 1 THEN m.code END AS gemeentecode, CASE WHEN n = 1 THEN m.gemeente END AS gemeente, CASE WHEN p.k IS NULL THEN 'niet ingevuld' WHEN n = 1 THEN 'gematcht' WHEN n > 1 THEN 'niet eenduidig' ELSE 'niet gevonden' END AS plaats_status FROM p LEFT JOIN one ON one.k = p.k)"""


def _matched(t: Tables):
    register = t.part.where("p_size > 45").select(F.col("p_name").alias("woonplaats"), F.col("p_type").alias("gemeente"), F.col("p_brand").alias("gemeentecode"), F.lit("P").alias("provincie")).distinct()
    people = t.part.select("p_partkey", F.when(F.col("p_type") != "PROMO", F.concat(F.initcap("p_name"), F.lit(" (Ov.)"))).alias("woonplaats"))
    return P.match_places(people, "woonplaats", P.place_lookup(register), {"red widget": "blue widget"})


@query("a29_place_match", f"WITH {_PLACES} SELECT * FROM matched")
def place_match(t: Tables):
    return _matched(t).drop("woonplaats", "provincie")


@query("a29_place_shares", f"WITH {_PLACES} SELECT gemeente, count(*) AS aantal, round(100.0 * count(*) / (SELECT count(*) FROM matched WHERE plaats_status = 'gematcht'), 1) AS aandeel FROM matched WHERE plaats_status = 'gematcht' GROUP BY 1")
def place_shares(t: Tables):
    return P.place_shares(_matched(t), "gemeente")


@query("a29_migration", f"WITH {_PLACES} SELECT plaats_status, count(*) FILTER (WHERE p_type = 'ECONOMY') AS \"ECONOMY\", count(*) FILTER (WHERE p_type = 'STANDARD') AS \"STANDARD\", count(*) AS totaal FROM matched JOIN part USING (p_partkey) GROUP BY 1")
def migration(t: Tables):
    from plenaria.operators.reshape import pivot_counts

    return pivot_counts(_matched(t).join(t.part.select("p_partkey", "p_type"), "p_partkey"), ["plaats_status"], "p_type", ["ECONOMY", "STANDARD"])


@query("a30_life_status", f"""WITH {conformed_sql('persoon')} SELECT CASE WHEN overlijdensdatum IS NOT NULL THEN 'overleden (datum bekend)' WHEN geboortedatum IS NULL THEN 'onbekend (geen geboortedatum)' WHEN year(geboortedatum) >= 1930 THEN 'aangenomen in leven' ELSE 'onbekend' END AS levensstatus, count(*) AS aantal FROM persoon GROUP BY 1""")
def life_status(t: Tables):
    people = Conformed(t)["persoon"]
    return people.groupBy(P.life_status(F.col("geboortedatum"), F.col("overlijdensdatum")).alias("levensstatus")).agg(F.count(F.lit(1)).alias("aantal"))
