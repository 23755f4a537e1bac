"""Seats over time on the membership stand-in."""

from datetime import date

from pyspark.sql import functions as F

from plenaria.plans import seats as S
from plenaria.queries import Tables, query
from plenaria.queries import standins as s

_AS_OF = date(2026, 10, 10)
# factions with a period of existence: first order day to last order day, the urgent one still active
_FACTIONS = """factions AS (SELECT fractie, min(van) AS datum_actief, CASE WHEN fractie > '2' THEN max(van) END AS datum_inactief FROM members GROUP BY 1)"""
_YEARS = "greatest(date_diff('day', datum_actief, coalesce(datum_inactief, DATE '2026-10-10')) / 365.25, 0.01)"


def _factions(t: Tables):
    return s.members(t).groupBy("fractie").agg(F.min("van").alias("datum_actief"), F.max("van").alias("_laatste")).select(
        "fractie", F.col("fractie").alias("fractie_id"), "datum_actief", F.when(F.col("fractie") > "2", F.col("_laatste")).alias("datum_inactief"))


def _members(t: Tables):
    return s.members(t).withColumn("fractie_id", F.col("fractie"))


def _with_period(t: Tables):
    return S.with_faction(_members(t), _factions(t).select("fractie_id", "datum_actief", "datum_inactief"))


@query("a9_switches", f"""WITH {s.MEMBERS_SQL} SELECT persoon_id, count(*) FILTER (WHERE fractie <> vorige) AS wissels FROM (SELECT *, lag(fractie) OVER (PARTITION BY persoon_id ORDER BY van, lid_id) AS vorige FROM members)
GROUP BY 1 HAVING count(*) FILTER (WHERE fractie <> vorige) > 0""")
def switches(t: Tables):
    return S.switch_counts(s.members(t), ("van", "lid_id"))


@query("a9_several_factions", """SELECT o_custkey AS persoon_id, count(DISTINCT o_orderpriority) AS aantal_fracties, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS fracties FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1""")
def several(t: Tables):
    return S.in_several_factions(s.members(t))


_SHARED = """e AS (SELECT a.f AS fractie_1, b.f AS fractie_2, count(*) AS gedeelde_leden FROM (SELECT DISTINCT l_suppkey AS p, s_nationkey * 100 + l_linenumber AS f FROM lineitem JOIN supplier ON l_suppkey = s_suppkey ) a
  JOIN (SELECT DISTINCT l_suppkey AS p, s_nationkey * 100 + l_linenumber AS f FROM lineitem JOIN supplier ON l_suppkey = s_suppkey ) b ON a.p = b.p AND a.f < b.f GROUP BY 1, 2)"""


def _shared(t: Tables):
    """Persons = suppliers, factions = nation and line number of their lines."""
    lines = t.lineitem.select("l_suppkey", "l_linenumber")
    joined = lines.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(F.col("l_suppkey").alias("persoon_id"), (F.col("s_nationkey") * 100 + F.col("l_linenumber")).cast("bigint").alias("fractie"))


@query("a10_edges", f"WITH {_SHARED} SELECT CAST(fractie_1 AS BIGINT) AS fractie_1, CAST(fractie_2 AS BIGINT) AS fractie_2, gedeelde_leden FROM e")
def edges(t: Tables):
    return S.shared_members(_shared(t))


@query("a10_components", f"""WITH RECURSIVE {_SHARED}, n AS (SELECT DISTINCT s_nationkey * 100 + l_linenumber AS f FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
u AS (SELECT fractie_1 AS a, fractie_2 AS b FROM e WHERE gedeelde_leden >= 3 UNION ALL SELECT fractie_2, fractie_1 FROM e WHERE gedeelde_leden >= 3),
r AS (SELECT f, f AS bereikt FROM n UNION SELECT r.f, u.b FROM r JOIN u ON r.bereikt = u.a), l AS (SELECT f, min(bereikt) AS groep FROM r GROUP BY 1)
SELECT CAST(f AS BIGINT) AS fractie, CAST(groep AS BIGINT) AS groep, count(*) OVER (PARTITION BY groep) AS grootte FROM l""")
def components(t: Tables):
    return S.faction_groups(_shared(t), 3)


@query("a11_seat_events", f"""WITH {s.MEMBERS_SQL}, {_FACTIONS}, e AS (SELECT persoon_id, fractie, van AS datum, 'aanmelding' AS event_type FROM members UNION ALL SELECT persoon_id, fractie, tot_en_met, 'vertrek' FROM members WHERE tot_en_met IS NOT NULL),
d AS (SELECT DISTINCT fractie, datum FROM e), z AS (SELECT d.fractie, d.datum, count(DISTINCT m.persoon_id) AS zetels FROM d LEFT JOIN members m ON m.fractie = d.fractie AND m.van <= d.datum AND (m.tot_en_met IS NULL OR m.tot_en_met >= d.datum) GROUP BY 1, 2)
SELECT persoon_id, e.fractie AS fractie_id, e.fractie, e.datum, event_type, year(e.datum) AS jaar, round({_YEARS}, 1) AS jaren_bestaan, zetels AS zetels_op_datum FROM e JOIN factions f ON e.fractie = f.fractie JOIN z ON z.fractie = e.fractie AND z.datum = e.datum""")
def seat_events(t: Tables):
    return S.seat_changes(_with_period(t), _AS_OF)


@query("a12_yearly_seats", f"""WITH {s.MEMBERS_SQL}, y AS (SELECT fractie, jaar, count(DISTINCT persoon_id) AS zetels FROM members JOIN generate_series(1990, 2005) g(jaar) ON year(van) <= jaar AND (tot_en_met IS NULL OR year(tot_en_met) >= jaar) GROUP BY 1, 2)
SELECT fractie, jaar, zetels, lag(zetels) OVER w AS zetels_vorig_jaar, zetels - lag(zetels) OVER w AS verandering FROM y WINDOW w AS (PARTITION BY fractie ORDER BY jaar)""")
def yearly(t: Tables):
    return S.yearly_seats(s.members(t), 1990, 2005)


@query("a13_turnover", f"""WITH {s.MEMBERS_SQL}, {_FACTIONS}, f AS (SELECT * FROM factions WHERE datum_actief <= DATE '1999-12-31' AND (datum_inactief IS NULL OR datum_inactief >= DATE '1996-01-01')),
e AS (SELECT fractie, van AS datum, 1 AS a FROM members UNION ALL SELECT fractie, tot_en_met, 0 FROM members WHERE tot_en_met IS NOT NULL)
SELECT e.fractie, count(*) AS wisselingen, count(*) FILTER (WHERE a = 1) AS aanmeldingen, count(*) FILTER (WHERE a = 0) AS vertrekken, round(any_value({_YEARS}), 1) AS jaren_bestaan, round(count(*) / any_value({_YEARS}), 2) AS per_jaar
FROM e JOIN f ON e.fractie = f.fractie WHERE datum BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY 1""")
def turnover(t: Tables):
    return S.turnover(_members(t), _factions(t), date(1996, 1, 1), date(1999, 12, 31), _AS_OF)


@query("a13_turnover_ratio", f"""WITH {s.MEMBERS_SQL}, y AS (SELECT fractie, jaar, count(DISTINCT persoon_id) AS n FROM members JOIN generate_series(1996, 1999) g(jaar) ON year(van) <= jaar AND (tot_en_met IS NULL OR year(tot_en_met) >= jaar) GROUP BY 1, 2),
z AS (SELECT fractie, avg(n) AS gem, count(*) AS k FROM y GROUP BY 1), e AS (SELECT fractie, count(*) AS n FROM (SELECT fractie, van AS d FROM members UNION ALL SELECT fractie, tot_en_met FROM members) WHERE d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY 1)
SELECT z.fractie, round(gem, 1) AS gem_zetels, k AS actieve_jaren, round(coalesce(n, 0) / k, 1) AS wisselingen_per_jaar, round(coalesce(n, 0) / k / gem, 2) AS verhouding FROM z LEFT JOIN e ON z.fractie = e.fractie""")
def turnover_ratio(t: Tables):
    return S.turnover_ratio(s.members(t), date(1996, 1, 1), date(1999, 12, 31))


@query("a14_extremes", f"""WITH {s.MEMBERS_SQL}, {_FACTIONS}, a AS (SELECT * FROM factions WHERE datum_inactief IS NULL)
SELECT 'oudste' AS welke, fractie, datum_actief AS start, round(date_diff('day', datum_actief, DATE '2026-10-10') / 365.2425, 1) AS jaren FROM (SELECT * FROM a ORDER BY datum_actief, fractie LIMIT 1)
UNION ALL SELECT 'jongste', fractie, datum_actief, round(date_diff('day', datum_actief, DATE '2026-10-10') / 365.2425, 1) FROM (SELECT * FROM a ORDER BY datum_actief DESC, fractie DESC LIMIT 1)""")
def extremes(t: Tables):
    return S.extremes(_factions(t), _AS_OF)


@query("a14_largest", f"""WITH {s.MEMBERS_SQL}, d AS (SELECT DISTINCT fractie, van AS datum FROM members UNION SELECT DISTINCT fractie, tot_en_met FROM members WHERE tot_en_met IS NOT NULL)
SELECT d.fractie AS fractie_id, d.datum, count(DISTINCT m.persoon_id) AS zetels_op_datum FROM d JOIN members m ON m.fractie = d.fractie AND m.van <= d.datum AND (m.tot_en_met IS NULL OR m.tot_en_met >= d.datum) GROUP BY 1, 2 ORDER BY 3 DESC, 2, 1 LIMIT 1""")
def largest(t: Tables):
    return S.largest_ever(S.seat_changes(_with_period(t), _AS_OF))
