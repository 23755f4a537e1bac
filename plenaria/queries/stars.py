"""Star schemas on conformed stand-in tables: one query per star table with logic of its own."""

from datetime import date

from plenaria.plans import stars as Z
from plenaria.queries import Tables, query
from plenaria.queries.standins import Conformed, conformed_sql

_AS_OF = date(2026, 10, 10)
_DAY = "DATE '2026-10-10'"
_SITTING_DAY = date(1998, 1, 1)


def _star(name: str, build, table: str, uses: tuple[str, ...], sql: str | None):
    text = None if sql is None else f"WITH {conformed_sql(*uses)} {sql}"

    @query(name, text)
    def run(t: Tables):
        return build(Conformed(t))[table]

    return run


def _contacts(c):
    return Z.contacts(c, _AS_OF)


_star("z_contacts_dim_persoon", _contacts, "dim_persoon", ("persoon",), """
SELECT id AS persoon_id, nummer, titels, voornamen, tussenvoegsel, achternaam, roepnaam, geslacht, initialen, functie, fractielabel, geboortedatum, overlijdensdatum FROM persoon
UNION ALL BY NAME SELECT '-1' AS persoon_id, 'Onbekend' AS achternaam""")
_star("z_contacts_dim_kanaal", _contacts, "dim_kanaal", ("persoon_contactinformatie",), """
SELECT dense_rank() OVER (ORDER BY soort) AS channel_key, soort AS kanaal FROM (SELECT DISTINCT soort FROM persoon_contactinformatie WHERE soort IS NOT NULL) UNION ALL SELECT -1, 'Onbekend'""")
_star("z_contacts_dim_soort", _contacts, "dim_soort", ("persoon_contactinformatie",), """
SELECT dense_rank() OVER (ORDER BY soort NULLS LAST, waarde NULLS LAST, gewicht NULLS LAST) AS soort_id, waarde, soort, CAST(gewicht AS BIGINT) AS gewicht FROM (SELECT DISTINCT soort, waarde, gewicht FROM persoon_contactinformatie)
UNION ALL SELECT -1, 'Onbekend', 'Onbekend', NULL""")
_star("z_contacts_fact", _contacts, "fact_contactgegevens_persoon", ("persoon", "persoon_contactinformatie"), """,
k AS (SELECT dense_rank() OVER (ORDER BY soort) AS channel_key, soort AS kanaal FROM (SELECT DISTINCT soort FROM persoon_contactinformatie WHERE soort IS NOT NULL)),
s AS (SELECT dense_rank() OVER (ORDER BY soort NULLS LAST, waarde NULLS LAST, gewicht NULLS LAST) AS soort_id, waarde, soort, gewicht FROM (SELECT DISTINCT soort, waarde, gewicht FROM persoon_contactinformatie))
SELECT row_number() OVER (ORDER BY c.gewijzigd_op DESC NULLS LAST, c.persoon_id NULLS LAST, c.id) AS contactgegeven_persoon_key, coalesce(p.id, '-1') AS persoon_id,
  coalesce(CAST(strftime(c.gewijzigd_op, '%Y%m%d') AS BIGINT), -1) AS date_key, coalesce(channel_key, -1) AS channel_key, coalesce(soort_id, -1) AS soort_id, CAST(1 AS BIGINT) AS contact_count
FROM persoon_contactinformatie c LEFT JOIN persoon p ON p.id = c.persoon_id LEFT JOIN k ON k.kanaal = c.soort
  LEFT JOIN s ON s.soort IS NOT DISTINCT FROM c.soort AND s.waarde IS NOT DISTINCT FROM c.waarde AND s.gewicht IS NOT DISTINCT FROM c.gewicht""")
_star("z_contacts_fact_zetel", _contacts, "fact_fractie_zetel_persoon", ("persoon", "fractie", "fractie_zetel", "fractie_zetel_persoon"), f"""
SELECT row_number() OVER (ORDER BY zp.van DESC NULLS LAST, zp.id) AS fractie_zetel_persoon_key, coalesce(p.id, '-1') AS persoon_id, coalesce(f.id, '-1') AS fractie_id,
  coalesce(CAST(strftime(zp.van, '%Y%m%d') AS BIGINT), -1) AS van_date_key, CASE WHEN zp.tot_en_met IS NULL THEN 99991231 ELSE CAST(strftime(zp.tot_en_met, '%Y%m%d') AS BIGINT) END AS tot_en_met_date_key,
  z.id AS fractie_zetel_id, CAST(z.gewicht AS BIGINT) AS zetel_gewicht, zp.functie, date_diff('day', zp.van, coalesce(zp.tot_en_met, {_DAY})) AS aantal_dagen, CAST(1 AS BIGINT) AS zetel_count
FROM fractie_zetel_persoon zp LEFT JOIN fractie_zetel z ON z.id = zp.fractie_zetel_id LEFT JOIN fractie f ON f.id = z.fractie_id LEFT JOIN persoon p ON p.id = zp.persoon_id""")
_star("z_contacts_dim_datum", _contacts, "dim_datum", ("persoon_contactinformatie", "fractie_zetel_persoon"), f""",
b AS (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT CAST(gewijzigd_op AS DATE) AS d FROM persoon_contactinformatie UNION ALL SELECT van FROM fractie_zetel_persoon UNION ALL SELECT tot_en_met FROM fractie_zetel_persoon UNION ALL SELECT {_DAY}))
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS calendar_date, strftime(d, '%Y-%m') AS month, year(d) AS year FROM b, generate_series(lo, hi, INTERVAL 1 DAY) g(d)
UNION ALL SELECT -1, NULL, 'Onbekend', NULL UNION ALL SELECT 99991231, NULL, 'Nog actief', NULL""")

_star("z_contacts_dim_fractie", _contacts, "dim_fractie", ("fractie",), """
SELECT id AS fractie_id, nummer, afkorting, naam_nl, naam_en, CAST(aantal_zetels AS BIGINT) AS aantal_zetels, CAST(aantal_stemmen AS BIGINT) AS aantal_stemmen, datum_actief, datum_inactief, logo_url FROM fractie
UNION ALL BY NAME SELECT '-1' AS fractie_id, 'Onbekend' AS naam_nl, 'Unknown' AS naam_en""")

_PUB = """pub AS (SELECT d.id AS document_id, d.soort, m.document_type, d.organisatie, d.datum, m.publicatie_datum AS publicatiedatum, date_diff('day', d.datum, m.publicatie_datum) AS dagen_tot_publicatie, v.bestandsgrootte, v.versienummer
  FROM document d LEFT JOIN document_versie v ON d.huidige_document_versie_id = v.id LEFT JOIN document_publicatie_metadata m ON m.document_versie_id = v.id AND m.document_type = 'Metadata')"""
_DOCS = ("document", "document_versie", "document_publicatie_metadata")
_star("z_documents_fact", Z.documents, "fact_document_publicatie", _DOCS, f", {_PUB} SELECT * FROM pub")
_star("z_documents_citation", Z.documents, "fact_bronvermelding", ("document", "document_bron_document"), """
SELECT b.document_id, b.bron_document_id, d.soort AS document_soort, s.soort AS bron_document_soort, b.relatie_gewijzigd_op FROM document_bron_document b LEFT JOIN document d ON b.document_id = d.id LEFT JOIN document s ON b.bron_document_id = s.id""")
_star("z_documents_dim_organisatie", Z.documents, "dim_organisatie", ("document",), "SELECT DISTINCT organisatie FROM document WHERE organisatie IS NOT NULL")
_star("z_documents_dim_tijd", Z.documents, "dim_tijd", _DOCS, f""", {_PUB}, b AS (SELECT least(min(datum), min(publicatiedatum)) AS lo, greatest(max(datum), max(publicatiedatum)) AS hi FROM pub)
SELECT CAST(d AS DATE) AS datum, year(d) AS jaar, month(d) AS maand, day(d) AS dag, quarter(d) AS kwartaal, weekofyear(d) AS weeknummer, dayname(d) AS dagnaam, isodow(d) AS dagnr FROM b, generate_series(lo, hi, INTERVAL 1 DAY) g(d)""")


_star("z_documents_dim_soort", Z.documents, "dim_documentsoort", ("document",), "SELECT DISTINCT soort FROM document WHERE soort IS NOT NULL")
_star("z_documents_dim_type", Z.documents, "dim_documenttype", _DOCS, f", {_PUB} SELECT DISTINCT document_type FROM pub WHERE document_type IS NOT NULL")
_star("z_documents_dim_document", Z.documents, "dim_document", ("document",), "SELECT id AS document_id, titel FROM document")


def _history(c):
    return Z.seat_history(c, _AS_OF, 1990, 2005)


_SEATS = ("fractie", "fractie_zetel", "fractie_zetel_persoon")
_NORM = "CASE WHEN afkorting IN ('PvdA', 'GL', 'GroenLinks-PvdA', 'PRO') THEN 'PRO' ELSE afkorting END"
_EXIST = f"greatest(date_diff('day', datum_actief, coalesce(datum_inactief, {_DAY})) / 365.25, 0.01)"
_HELD = f"h AS (SELECT zp.persoon_id, f.id AS fractie_id, zp.van, zp.tot_en_met, {_NORM} AS fractie_norm, {_EXIST} AS jaren FROM fractie_zetel_persoon zp JOIN fractie_zetel z ON z.id = zp.fractie_zetel_id JOIN fractie f ON f.id = z.fractie_id)"
_star("z_seats_dim_fractie", _history, "dim_fractie", ("fractie",), f"SELECT id, afkorting, naam_nl, {_NORM} AS fractie_norm, CAST(aantal_zetels AS BIGINT) AS aantal_zetels, datum_actief, datum_inactief, round({_EXIST}, 1) AS jaren_bestaan FROM fractie")
_star("z_seats_yearly", _history, "agg_zetelbeeld_per_jaar", _SEATS, f""", {_HELD}, y AS (SELECT fractie_norm, jaar, count(DISTINCT persoon_id) AS zetels FROM h JOIN generate_series(1990, 2005) g(jaar) ON year(van) <= jaar AND (tot_en_met IS NULL OR year(tot_en_met) >= jaar) GROUP BY 1, 2)
SELECT fractie_norm, jaar, zetels, lag(zetels) OVER w AS zetels_vorig_jaar, zetels - lag(zetels) OVER w AS verandering FROM y WINDOW w AS (PARTITION BY fractie_norm ORDER BY jaar)""")
_star("z_seats_fact", _history, "fact_zetelwisseling", _SEATS, f""", {_HELD}, e AS (SELECT persoon_id, fractie_id, van AS datum_id, 'aanmelding' AS event_type, fractie_norm, jaren FROM h UNION ALL SELECT persoon_id, fractie_id, tot_en_met, 'vertrek', fractie_norm, jaren FROM h WHERE tot_en_met IS NOT NULL),
d AS (SELECT DISTINCT fractie_id, datum_id FROM e), n AS (SELECT d.fractie_id, d.datum_id, count(DISTINCT persoon_id) AS zetels FROM d JOIN h ON h.fractie_id = d.fractie_id AND van <= datum_id AND (tot_en_met IS NULL OR tot_en_met >= datum_id) GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY e.datum_id, persoon_id NULLS LAST, e.fractie_id, event_type) AS event_id, persoon_id, e.fractie_id, e.datum_id, event_type, fractie_norm, year(e.datum_id) AS jaar, round(jaren, 1) AS jaren_bestaan, coalesce(zetels, 0) AS zetels_op_datum
FROM e LEFT JOIN n ON n.fractie_id = e.fractie_id AND n.datum_id = e.datum_id""")


_star("z_seats_dim_persoon", _history, "dim_persoon", ("persoon",), "SELECT id, roepnaam, voornamen, tussenvoegsel, achternaam, geslacht, geboortedatum, fractielabel FROM persoon")
_star("z_seats_dim_tijd", _history, "dim_tijd", _SEATS, f""", {_HELD}, b AS (SELECT least(min(van), min(tot_en_met)) AS lo, greatest(max(van), max(tot_en_met)) AS hi FROM h)
SELECT CAST(d AS DATE) AS datum, year(d) AS jaar, month(d) AS maand, list_extract(['januari', 'februari', 'maart', 'april', 'mei', 'juni', 'juli', 'augustus', 'september', 'oktober', 'november', 'december'], month(d)) AS maandnaam,
  CASE WHEN month(d) >= 9 THEN year(d) || '-' || (year(d) + 1) ELSE (year(d) - 1) || '-' || year(d) END AS vergaderjaar FROM b, generate_series(lo, hi, INTERVAL 1 DAY) g(d)""")


def _committees(c):
    return Z.committees(c, _SITTING_DAY, date(1996, 1, 1))


_S = "DATE '1998-01-01'"
_ACTIVE = f"van <= {_S} AND (tot_en_met IS NULL OR tot_en_met >= {_S})"
_star("z_committees_sitting", _committees, "fact_commissie_zitting", ("commissie_zetel", "commissie_zetel_vast_persoon"), f"""
SELECT zp.id AS zitting_id, z.commissie_id, persoon_id, functie, CAST(strftime(van, '%Y%m%d') AS BIGINT) AS datum_id_van, CAST(strftime(tot_en_met, '%Y%m%d') AS BIGINT) AS datum_id_tot, commissie_zetel_id AS zetel_id,
  date_diff('day', van, coalesce(tot_en_met, {_S})) AS dagen_zitting, {_ACTIVE} AS is_huidig FROM commissie_zetel_vast_persoon zp JOIN commissie_zetel z ON z.id = zp.commissie_zetel_id WHERE persoon_id IS NOT NULL""")
_star("z_committees_vacancy", _committees, "fact_commissie_vacature", ("commissie_zetel", "commissie_zetel_vast_vacature"), f"""
SELECT v.id AS vacature_id, z.commissie_id, fractie_id, CAST(strftime(van, '%Y%m%d') AS BIGINT) AS datum_id_van, CAST(strftime(tot_en_met, '%Y%m%d') AS BIGINT) AS datum_id_tot, commissie_zetel_id AS zetel_id,
  date_diff('day', van, coalesce(tot_en_met, {_S})) AS dagen_open, {_ACTIVE} AS is_open FROM commissie_zetel_vast_vacature v JOIN commissie_zetel z ON z.id = v.commissie_zetel_id""")
_star("z_committees_activity", _committees, "fact_commissie_activiteit", ("activiteit",), """
SELECT id AS activiteit_id, voortouwcommissie_id AS commissie_id, CAST(strftime(datum, '%Y%m%d') AS BIGINT) AS datum_id, soort, status, status = 'Uitgevoerd' AS is_uitgevoerd FROM activiteit WHERE voortouwcommissie_id IS NOT NULL AND datum >= DATE '1996-01-01'""")
_CHAIN = "activiteit a JOIN agendapunt ap ON ap.activiteit_id = a.id JOIN besluit b ON b.agendapunt_id = ap.id JOIN besluit_zaak bz ON bz.besluit_id = b.id WHERE voortouwcommissie_id IS NOT NULL AND datum >= DATE '1996-01-01'"
_star("z_committees_case", _committees, "fact_commissie_zaak", ("activiteit", "agendapunt", "besluit", "besluit_zaak"), f"""
SELECT voortouwcommissie_id AS commissie_id, zaak_id, CAST(strftime(min(datum), '%Y%m%d') AS BIGINT) AS datum_id, count(DISTINCT b.id) AS aantal_besluiten FROM {_CHAIN} GROUP BY 1, 2""")
_star("z_committees_dim", _committees, "dim_commissie", ("commissie", "commissie_zetel", "commissie_zetel_vast_persoon"), f"""
SELECT c.id AS commissie_id, naam_nl, afkorting, soort, CASE WHEN lower(naam_nl) LIKE '%interparlementair%' THEN 'Interparlementair' WHEN lower(naam_nl) LIKE 'tijdelijke%' OR lower(naam_nl) LIKE '%enquête%' THEN 'Tijdelijk'
  WHEN lower(naam_nl) LIKE 'vaste commissie%' THEN 'Vast' ELSE 'Overig' END AS commissietype, datum_actief, datum_inactief, datum_inactief IS NULL OR datum_inactief > {_S} AS is_actief,
  (SELECT count(DISTINCT commissie_zetel_id) FROM commissie_zetel_vast_persoon zp JOIN commissie_zetel z ON z.id = zp.commissie_zetel_id WHERE z.commissie_id = c.id AND {_ACTIVE}) AS aantal_zetels FROM commissie c""")
_star("z_committees_dim_persoon", _committees, "dim_persoon", ("persoon", "commissie_zetel_vast_persoon"), f"""
SELECT id AS persoon_id, achternaam, geslacht, geboortedatum, date_diff('year', geboortedatum, {_S}) AS leeftijd FROM persoon WHERE id IN (SELECT persoon_id FROM commissie_zetel_vast_persoon WHERE persoon_id IS NOT NULL)""")
_star("z_committees_dim_zaak", _committees, "dim_zaak", ("zaak", "activiteit", "agendapunt", "besluit", "besluit_zaak"), f"""
SELECT id AS zaak_id, soort, substr(onderwerp, 1, 100) AS onderwerp, status, afgedaan FROM zaak WHERE id IN (SELECT bz.zaak_id FROM {_CHAIN})""")

_star("z_committees_dim_fractie", _committees, "dim_fractie", ("fractie",), "SELECT id AS fractie_id, afkorting, naam_nl FROM fractie")

_star("z_decisions_fact", Z.decisions, "fact_activiteit_besluit", ("activiteit", "agendapunt", "besluit", "besluit_zaak", "zaak"), """
SELECT a.id AS activiteit_id, z.id AS zaak_id, b.id AS besluit_id, date_diff('minute', aanvangstijd, eindtijd) AS duur_minuten FROM activiteit a LEFT JOIN agendapunt ap ON ap.activiteit_id = a.id
  LEFT JOIN besluit b ON b.agendapunt_id = ap.id LEFT JOIN besluit_zaak bz ON bz.besluit_id = b.id LEFT JOIN zaak z ON bz.zaak_id = z.id""")
_star("z_decisions_dim_besluit", Z.decisions, "dim_besluit", ("besluit",), """
SELECT id AS besluit_id, stemmings_soort, besluit_soort, CASE WHEN besluit_soort ILIKE '%aangenomen%' THEN 'aangenomen' WHEN besluit_soort ILIKE '%verworpen%' THEN 'verworpen' WHEN besluit_soort ILIKE '%aangehouden%' THEN 'aangehouden' END AS uitkomst FROM besluit""")
_star("z_decisions_dim_fractie", Z.decisions, "dim_fractie", ("fractie",), f"SELECT id AS fractie_id, afkorting, naam_nl, {_NORM} AS fractie_norm, datum_actief, datum_inactief FROM fractie")
_star("z_decisions_actor", Z.decisions, "bridge_zaak_actor", ("zaak_actor",), "SELECT id AS zaak_actor_id, zaak_id, fractie_id, actor_naam, actor_fractie, relatie FROM zaak_actor")
_star("z_decisions_activity", Z.decisions, "fact_activiteit", ("activiteit",), "SELECT id AS activiteit_id, datum, datum_soort, date_diff('minute', aanvangstijd, eindtijd) AS duur_minuten FROM activiteit")


_star("z_decisions_bridge", Z.decisions, "bridge_besluit_zaak", ("besluit_zaak",), "SELECT besluit_id, zaak_id FROM besluit_zaak")
_star("z_decisions_dim_activiteit", Z.decisions, "dim_activiteit", ("activiteit",), "SELECT id AS activiteit_id, soort, onderwerp, datum, datum_soort, aanvangstijd, eindtijd FROM activiteit")
_star("z_decisions_dim_zaak", Z.decisions, "dim_zaak", ("zaak",), "SELECT id AS zaak_id, soort, onderwerp FROM zaak")


def _votes(c):
    return Z.votes(c, date(1997, 1, 1), date(1998, 1, 1))


_VOTE_USES = ("stemming", "besluit", "agendapunt", "activiteit")
_VOTE = "v AS (SELECT s.id AS stemming_id, s.besluit_id, s.fractie_id, s.persoon_id, a.datum, s.soort, CAST(s.fractie_grootte AS BIGINT) AS fractie_grootte, s.vergissing FROM stemming s JOIN besluit b ON s.besluit_id = b.id JOIN agendapunt ap ON b.agendapunt_id = ap.id JOIN activiteit a ON ap.activiteit_id = a.id WHERE a.datum >= DATE '1997-01-01' AND a.datum < DATE '1998-01-01')"
_star("z_votes_fact", _votes, "fact_stemming", _VOTE_USES, f", {_VOTE} SELECT * FROM v")
_star("z_votes_dim_fractie", _votes, "dim_fractie", (*_VOTE_USES, "fractie"), f", {_VOTE} SELECT id AS fractie_id, naam_nl, afkorting, datum_actief, datum_inactief, CAST(aantal_zetels AS BIGINT) AS aantal_zetels FROM fractie WHERE id IN (SELECT fractie_id FROM v)")
_star("z_votes_dim_persoon", _votes, "dim_persoon", (*_VOTE_USES, "persoon"), f", {_VOTE} SELECT id AS persoon_id, achternaam, roepnaam, geslacht, geboortedatum, functie FROM persoon WHERE id IN (SELECT persoon_id FROM v WHERE persoon_id IS NOT NULL)")
_star("z_votes_dim_besluit", _votes, "dim_besluit", _VOTE_USES, f", {_VOTE} SELECT b.id AS besluit_id, besluit_soort, stemmings_soort, b.status, ap.onderwerp AS agendapunt_onderwerp, a.soort AS activiteit_soort, kamer FROM besluit b JOIN agendapunt ap ON b.agendapunt_id = ap.id JOIN activiteit a ON ap.activiteit_id = a.id WHERE b.id IN (SELECT besluit_id FROM v)")
_star("z_votes_dim_zaak", _votes, "dim_zaak", (*_VOTE_USES, "besluit_zaak", "zaak"), f", {_VOTE} SELECT id AS zaak_id, soort AS zaak_soort, onderwerp, titel, status, afgedaan, gestart_op FROM zaak WHERE id IN (SELECT zaak_id FROM besluit_zaak WHERE besluit_id IN (SELECT besluit_id FROM v))")
_star("z_votes_bridge", _votes, "brug_besluit_zaak", (*_VOTE_USES, "besluit_zaak"), f", {_VOTE} SELECT besluit_id, zaak_id FROM besluit_zaak WHERE besluit_id IN (SELECT besluit_id FROM v)")

_star("z_income_fact", Z.income, "feit_inkomen", ("persoon_nevenfunctie", "persoon_nevenfunctie_inkomsten", *_SEATS), """
SELECT nf.id AS nevenfunctie_id, nf.persoon_id, fz.fractie_id, jaar::BIGINT AS jaar_id, CAST(CASE WHEN lower(frequentie) LIKE '%maand%' THEN CAST(bedrag AS DECIMAL(18,2)) * 12 WHEN lower(frequentie) LIKE '%dag%' OR lower(frequentie) LIKE '%Vrije invoer%' THEN CAST(bedrag AS DECIMAL(18,2)) * 4 ELSE CAST(bedrag AS DECIMAL(18,2)) END AS DOUBLE) AS bedrag
FROM persoon_nevenfunctie_inkomsten ink JOIN persoon_nevenfunctie nf ON nf.id = ink.persoon_nevenfunctie_id
  LEFT JOIN (SELECT zp.persoon_id, z.fractie_id, van, tot_en_met FROM fractie_zetel_persoon zp JOIN fractie_zetel z ON z.id = zp.fractie_zetel_id JOIN fractie f ON f.id = z.fractie_id) fz
  ON fz.persoon_id = nf.persoon_id AND jaar BETWEEN year(van) AND coalesce(year(tot_en_met), 9999) WHERE bedrag > 0 AND jaar BETWEEN 2015 AND 2026""")
_star("z_income_dim_fractie", Z.income, "dim_fractie", ("fractie",), "SELECT id AS fractie_id, CASE WHEN lower(naam_nl) LIKE '%groenlinks%' THEN 'GroenLinks / Progressief Nederland' ELSE naam_nl END AS fractienaam, datum_actief AS opgericht_datum FROM fractie")


_star("z_income_dim_nevenfunctie", Z.income, "dim_nevenfunctie", ("persoon_nevenfunctie",), "SELECT id AS nevenfunctie_id, omschrijving, vergoeding_soort AS vergoedingssoort FROM persoon_nevenfunctie")
_star("z_income_dim_persoon", Z.income, "dim_persoon", ("persoon",), "SELECT id AS persoon_id, voornamen, achternaam FROM persoon")


def _travel(c):
    return Z.travel(c, date(1999, 6, 1))


_PARTY = "p AS (SELECT p.id, roepnaam, achternaam, overlijdensdatum, zp.van, coalesce(zp.tot_en_met, DATE '1999-06-01') AS tot, f.afkorting FROM persoon p JOIN fractie_zetel_persoon zp ON p.id = zp.persoon_id JOIN fractie_zetel z ON zp.fractie_zetel_id = z.id JOIN fractie f ON z.fractie_id = f.id)"
_star("z_travel_trips", _travel, "gold_fact_reis", ("persoon", "persoon_reis", *_SEATS), f""", {_PARTY}
SELECT r.id, r.persoon_id, roepnaam, achternaam, doel, bestemming, r.van, r.tot_en_met, betaald_door, afkorting AS fractielabel, CAST(sum(date_diff('day', r.van, r.tot_en_met)) AS BIGINT) AS reisduur, overlijdensdatum
FROM persoon_reis r JOIN p ON p.id = r.persoon_id AND r.van BETWEEN p.van AND p.tot GROUP BY ALL""")
_star("z_travel_gifts", _travel, "gold_fact_geschenk", ("persoon", "persoon_geschenk", *_SEATS), f""", {_PARTY}
SELECT g.id, g.persoon_id, roepnaam, achternaam, datum, CAST(gewicht AS BIGINT) AS gewicht, omschrijving, afkorting, overlijdensdatum FROM persoon_geschenk g JOIN p ON p.id = g.persoon_id AND g.datum BETWEEN p.van AND p.tot""")
_DOSSIERS = "ds AS (SELECT id, titel, CAST(nummer AS BIGINT) AS nummer, toevoeging, kamer FROM kamerstukdossier ORDER BY md5('0:' || id), id LIMIT 500)"
_DOSSIER_DOCS = f"""{_DOSSIERS}, dd AS (SELECT id, kamerstukdossier_id, document_nummer, titel, soort, vergaderjaar, datum, datum_registratie, datum_ontvangst FROM document WHERE kamerstukdossier_id IN (SELECT id FROM ds))"""
_star("z_legislation_sample", lambda c: Z.legislation(c), "kamerstukdossier", ("kamerstukdossier",), f", {_DOSSIERS} SELECT * FROM ds")
_star("z_legislation_document", lambda c: Z.legislation(c), "document", ("kamerstukdossier", "document"), f", {_DOSSIER_DOCS} SELECT * FROM dd")
_star("z_legislation_actor", lambda c: Z.legislation(c), "document_actor", ("kamerstukdossier", "document", "document_actor"), f", {_DOSSIER_DOCS} SELECT document_id, fractie_id, relatie FROM document_actor WHERE document_id IN (SELECT id FROM dd)")
_star("z_legislation_fractie", lambda c: Z.legislation(c), "fractie", ("document_actor", "fractie"), "SELECT id, afkorting FROM fractie WHERE id IN (SELECT fractie_id FROM document_actor)")
_star("z_planning", Z.planning, "planning", ("reservering", "activiteit", "zaal"), """
SELECT r.id AS reservering_id, r.activiteit_id, datum, a.soort AS activiteitssoort, a.onderwerp AS activiteit, a.status, a.besloten, z.naam AS vergaderzaal FROM reservering r LEFT JOIN activiteit a ON r.activiteit_id = a.id LEFT JOIN zaal z ON r.zaal_id = z.id""")


def _careers(c):
    staging = {n.removeprefix("stg_"): c[n] for n in ("stg_onderwijs", "stg_loopbaan", "stg_correcties", "stg_plaats", "stg_register")}
    return Z.careers(c, staging, date(2026, 10, 8))


_star("z_careers_dim_gemeente", _careers, "dim_gemeente", ("stg_register",), 'SELECT DISTINCT trim("Code_3") AS gemeentecode, trim("Naam_2") AS gemeente, trim("Code_5") AS provinciecode, trim("Naam_4") AS provincie, trim("Naam_6") AS landsdeel FROM stg_register')
_star("z_careers_education", _careers, "fact_opleiding", ("persoon", "persoon_onderwijs", "stg_onderwijs"), """
SELECT o.id AS opleiding_id, persoon_id, categorie AS niveau, bron AS niveau_bron, s.status AS voltooid_status, s.status = 'voltooid' AS is_voltooid, year(van) AS jaar_van, year(tot_en_met) AS jaar_tot, instelling
FROM persoon_onderwijs o JOIN stg_onderwijs s ON s.id = o.id WHERE persoon_id IN (SELECT id FROM persoon)""")
_star("z_careers_career", _careers, "fact_loopbaan", ("persoon", "persoon_loopbaan", "stg_loopbaan"), """
SELECT l.id AS loopbaan_id, persoon_id, sector, year(van) AS jaar_van, year(tot_en_met) AS jaar_tot, functie, werkgever FROM persoon_loopbaan l JOIN stg_loopbaan s ON s.id = l.id WHERE persoon_id IN (SELECT id FROM persoon)""")
_star("z_careers_dim_fractie", _careers, "dim_fractie", ("fractie",), "SELECT id AS fractie_id, afkorting, naam_nl FROM fractie")
_PERSON = (("persoon", "persoon_onderwijs", "stg_onderwijs", "persoon_loopbaan", "stg_loopbaan", "stg_correcties", "stg_plaats", *_SEATS), """,
niv(niveau, rang) AS (VALUES ('basisonderwijs', 0), ('vo', 1), ('mbo', 2), ('hbo', 3), ('wo', 4), ('promotie', 5)),
opl AS (SELECT o.id, persoon_id, categorie, bron, s.status FROM persoon_onderwijs o JOIN stg_onderwijs s ON s.id = o.id), hoog AS (SELECT persoon_id, categorie, bron, row_number() OVER (PARTITION BY persoon_id ORDER BY rang DESC, (bron = 'tekst') DESC, id) AS rn FROM opl JOIN niv ON niveau = categorie WHERE status = 'voltooid'),
n AS (SELECT persoon_id, count(*) AS n FROM opl GROUP BY 1), lb AS (SELECT persoon_id, count(*) AS n, count(*) FILTER (WHERE sector IN ('zorg', 'overheid', 'overig_onvoldoende_sectorcontext')) AS b, count(*) FILTER (WHERE sector IN ('zorg', 'overheid')) AS z FROM persoon_loopbaan l JOIN stg_loopbaan s ON s.id = l.id GROUP BY 1),
per AS (SELECT persoon_id, f.id AS fractie_id, van, row_number() OVER (PARTITION BY persoon_id ORDER BY van, tot_en_met NULLS LAST, f.id) AS a, row_number() OVER (PARTITION BY persoon_id ORDER BY van DESC, tot_en_met DESC NULLS FIRST, f.id DESC) AS z FROM fractie_zetel_persoon zp JOIN fractie_zetel fz ON fz.id = zp.fractie_zetel_id JOIN fractie f ON f.id = fz.fractie_id),
b AS (SELECT p.*, coalesce(p.geboortedatum, c.geboortedatum) AS g, c.id IS NOT NULL AS fix FROM persoon p LEFT JOIN stg_correcties c ON c.id = p.id)
SELECT b.id AS persoon_id, trim(concat_ws(' ', coalesce(roepnaam, initialen), tussenvoegsel, achternaam)) AS naam, geslacht, functie, functie = 'Eerste Kamerlid' AS is_eerste_kamerlid, g AS geboortedatum, year(g) AS geboortejaar, CAST(year(g) // 10 * 10 AS BIGINT) AS geboortedecennium,
  overlijdensdatum, fix AS handmatig_aangevuld, CASE WHEN overlijdensdatum IS NOT NULL THEN 'overleden (datum bekend)' WHEN g IS NULL THEN 'onbekend (geen geboortedatum)' WHEN year(g) >= 1930 THEN 'aangenomen in leven' ELSE 'onbekend' END AS levensstatus,
  CASE WHEN functie = 'Tweede Kamerlid' AND g IS NOT NULL THEN round(date_diff('day', g, DATE '2026-10-08') / 365.25, 1) END AS leeftijd_nu, year(e.van) AS start_jaar_fractie, year(e.van) - year(g) AS leeftijd_aantreden, e.persoon_id IS NOT NULL AS heeft_fractie,
  e.fractie_id AS fractie_eerste_id, la.fractie_id AS fractie_laatste_id, coalesce(n.n, 0) AS n_opleidingen, h.categorie AS opleiding_hoogste, h.bron AS opleiding_hoogste_bron,
  CASE WHEN h.categorie IS NOT NULL THEN 'niveau bepaald' WHEN coalesce(n.n, 0) > 0 THEN 'geregistreerd, geen voltooid niveau af te leiden' ELSE 'geen opleiding geregistreerd' END AS opleiding_status, coalesce(lb.n, 0) AS n_loopbaanrijen, coalesce(lb.b, 0) AS n_buiten_politiek, coalesce(lb.z, 0) AS n_buiten_zeker,
  geboorte_gemeentecode, CASE WHEN plaats_status IS NULL THEN 'niet bepaald' WHEN plaats_status LIKE 'gematcht%' THEN 'gematcht' WHEN plaats_status LIKE 'geen plaats%' THEN 'niet ingevuld' ELSE 'niet gevonden' END AS geboorte_status, woon_gemeentecode, woon_status, g IS NOT NULL AS heeft_geboortedatum,
  NOT (plaats_status IS NULL OR plaats_status LIKE 'geen plaats%') AS heeft_geboorteplaats, woon_status <> 'niet ingevuld' AS heeft_woonplaats, coalesce(n.n, 0) > 0 AS heeft_opleidingsrij, coalesce(lb.n, 0) > 0 AS heeft_loopbaanrij
FROM b LEFT JOIN per e ON e.persoon_id = b.id AND e.a = 1 LEFT JOIN per la ON la.persoon_id = b.id AND la.z = 1 LEFT JOIN n ON n.persoon_id = b.id LEFT JOIN hoog h ON h.persoon_id = b.id AND h.rn = 1 LEFT JOIN lb ON lb.persoon_id = b.id LEFT JOIN stg_plaats sp ON sp.id = b.id""")
_star("z_careers_dim_persoon", _careers, "dim_persoon", *_PERSON)


def _person(c):
    """The person dimension straight from its operator."""
    from plenaria.plans import people, seats

    education = c["persoon_onderwijs"].join(c["stg_onderwijs"], "id")
    career = c["persoon_loopbaan"].join(c["stg_loopbaan"], "id")
    held = seats.memberships(c["fractie_zetel_persoon"], c["fractie_zetel"], c["fractie"])
    places = Z.place_status(c["stg_plaats"])
    return {"dim": people.person_dimension(c["persoon"], c["stg_correcties"], held, education, career, places, date(2026, 10, 8))}


_star("a30_person_dim", _person, "dim", *_PERSON)
