"""Voting analyses on the vote stand-in."""

from pyspark.sql import functions as F

from plenaria.plans import votes as V
from plenaria.queries import Tables, query
from plenaria.queries import standins as s

_W = "CAST(coalesce(fractie_grootte, 1) AS DECIMAL(18,2))"
_POSITIONS = f"""{s.VOTES_SQL}, positions AS (SELECT besluit_id, fractie_id, soort, gewicht FROM (SELECT besluit_id, fractie_id, soort, sum({_W}) AS gewicht,
    row_number() OVER (PARTITION BY besluit_id, fractie_id ORDER BY sum({_W}) DESC, soort) AS rn FROM votes WHERE NOT vergissing AND soort IN ('Voor', 'Tegen') GROUP BY 1, 2, 3) WHERE rn = 1),
majority AS (SELECT besluit_id, soort AS meerderheid FROM (SELECT besluit_id, soort, row_number() OVER (PARTITION BY besluit_id ORDER BY sum(gewicht) DESC, soort) AS rn FROM positions GROUP BY 1, 2) WHERE rn = 1)"""
_AGAINST = "count(*) AS besluiten, count(*) FILTER (WHERE soort <> meerderheid) AS tegen, round(100.0 * count(*) FILTER (WHERE soort <> meerderheid) / count(*), 1) AS pct_tegen"


@query("a1_unanimity", f"""WITH {s.VOTES_SQL}, f AS (SELECT fractie_id, besluit_id, count(DISTINCT soort) AS o FROM votes WHERE NOT vergissing GROUP BY 1, 2)
SELECT fractie_id, count(*) AS besluiten, count(*) FILTER (WHERE o = 1) AS unaniem, round(100.0 * count(*) FILTER (WHERE o = 1) / count(*), 1) AS pct_unaniem FROM f GROUP BY 1""")
def unanimity(t: Tables):
    return V.unanimity(s.votes(t))


@query("a1_unanimity_several", f"""WITH {s.VOTES_SQL}, f AS (SELECT fractie_id, besluit_id, count(DISTINCT soort) AS o FROM votes WHERE NOT vergissing GROUP BY 1, 2 HAVING count(*) > 1)
SELECT fractie_id, count(*) AS besluiten, count(*) FILTER (WHERE o = 1) AS unaniem, round(100.0 * count(*) FILTER (WHERE o = 1) / count(*), 1) AS pct_unaniem FROM f GROUP BY 1 HAVING count(*) >= 5""")
def unanimity_several(t: Tables):
    return V.unanimity(s.votes(t), min_votes=2, min_decisions=5)


@query("a1_votes_per_faction", f"""WITH {s.VOTES_SQL} SELECT stemmen, count(*) AS aantal FROM (SELECT besluit_id, fractie_id, count(*) AS stemmen FROM votes GROUP BY 1, 2) GROUP BY 1""")
def votes_per_faction(t: Tables):
    return V.votes_per_faction_decision(s.votes(t))


@query("a2_position", f"WITH {_POSITIONS} SELECT besluit_id, fractie_id, soort, CAST(gewicht AS DOUBLE) AS gewicht FROM positions")
def position(t: Tables):
    return V.faction_position(s.votes(t))


@query("a3_majority", f"WITH {_POSITIONS} SELECT * FROM majority")
def majority(t: Tables):
    return V.majority(V.faction_position(s.votes(t)))


@query("a3_majority_members", f"""WITH {s.VOTES_SQL}, w AS (SELECT besluit_id, soort, sum(CASE WHEN persoon_id IS NULL THEN {_W} ELSE 1 END) AS g FROM votes WHERE coalesce(NOT vergissing, true) GROUP BY 1, 2)
SELECT besluit_id, soort AS meerderheid FROM w QUALIFY row_number() OVER (PARTITION BY besluit_id ORDER BY g DESC, soort) = 1""")
def majority_members(t: Tables):
    return V.majority(V.member_weighted(s.votes(t)))


@query("a4_against_majority", f"WITH {_POSITIONS} SELECT fractie_id, {_AGAINST} FROM positions JOIN majority USING (besluit_id) GROUP BY 1 HAVING count(*) >= 20")
def against(t: Tables):
    return V.against_majority(s.votes(t))


@query("a4_against_rows", f"""WITH {s.VOTES_SQL}, r AS (SELECT * FROM votes WHERE persoon_id IS NULL AND coalesce(NOT vergissing, true)),
m AS (SELECT besluit_id, soort AS meerderheid FROM (SELECT besluit_id, soort, row_number() OVER (PARTITION BY besluit_id ORDER BY sum({_W}) DESC, soort) AS rn FROM r GROUP BY 1, 2) WHERE rn = 1)
SELECT fractie_id, {_AGAINST}, round(CAST(sum(CAST(fractie_grootte AS DECIMAL(18,2))) AS DOUBLE) / count(fractie_grootte), 4) AS fractiegrootte FROM r JOIN m USING (besluit_id) WHERE fractie_id < 12 GROUP BY 1""")
def against_rows(t: Tables):
    return V.against_majority_rows(s.votes(t), factions=range(12))


@query("a5_dissent", f"""WITH {s.VOTES_SQL}, i AS (SELECT *, count(*) OVER (PARTITION BY besluit_id, fractie_id) AS n FROM votes WHERE NOT vergissing AND persoon_id IS NOT NULL),
m AS (SELECT besluit_id, fractie_id, soort AS meerderheid FROM (SELECT besluit_id, fractie_id, soort, row_number() OVER (PARTITION BY besluit_id, fractie_id ORDER BY count(*) DESC, soort) AS rn FROM i WHERE n > 1 GROUP BY 1, 2, 3) WHERE rn = 1)
SELECT fractie_id, persoon_id, {_AGAINST} FROM i JOIN m USING (besluit_id, fractie_id) WHERE n > 1 GROUP BY 1, 2 HAVING count(*) >= 10 ORDER BY pct_tegen DESC, fractie_id, persoon_id LIMIT 25""")
def dissent(t: Tables):
    """Top 25 members voting against their own faction (the top is the feature)."""
    return V.dissent_from_faction(s.votes(t))


@query("a5_dissent_chamber", f"""WITH {s.VOTES_SQL}, w AS (SELECT *, CASE WHEN persoon_id IS NULL THEN {_W} ELSE 1 END AS g FROM votes WHERE coalesce(NOT vergissing, true)),
m AS (SELECT besluit_id, soort AS meerderheid FROM (SELECT besluit_id, soort, row_number() OVER (PARTITION BY besluit_id ORDER BY sum(g) DESC, soort) AS rn FROM w GROUP BY 1, 2) WHERE rn = 1)
SELECT fractie_id, persoon_id, {_AGAINST} FROM w JOIN m USING (besluit_id) WHERE persoon_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5""")
def dissent_chamber(t: Tables):
    return V.dissent_from_chamber(s.votes(t))


@query("a6_size_dissent", f"""WITH {_POSITIONS}, g AS (SELECT fractie_id, count(*) AS stemmen, round(CAST(sum(CAST(fractie_grootte AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS gem_grootte
  FROM votes WHERE NOT vergissing AND fractie_grootte IS NOT NULL GROUP BY 1 HAVING count(*) >= 100), a AS (SELECT fractie_id, {_AGAINST} FROM positions JOIN majority USING (besluit_id) GROUP BY 1 HAVING count(*) >= 20)
SELECT * FROM g JOIN a USING (fractie_id)""")
def size_dissent(t: Tables):
    return V.size_and_dissent(s.votes(t))


@query("a7_agreement", f"""WITH {_POSITIONS}, g AS (SELECT * FROM positions WHERE fractie_id IN (SELECT fractie_id FROM positions GROUP BY 1 HAVING count(*) >= 100))
SELECT a.fractie_id AS fractie_1, b.fractie_id AS fractie_2, count(*) AS samen, count(*) FILTER (WHERE a.soort = b.soort) AS gelijk, round(100.0 * count(*) FILTER (WHERE a.soort = b.soort) / count(*), 1) AS overeenkomst
FROM g a JOIN g b ON a.besluit_id = b.besluit_id AND a.fractie_id < b.fractie_id GROUP BY 1, 2""")
def agreement(t: Tables):
    return V.agreement(s.votes(t), min_votes=100)


@query("a8_divided", f"""WITH {s.VOTES_SQL}, o AS (SELECT besluit_id, count(DISTINCT soort) AS o FROM votes WHERE NOT vergissing GROUP BY 1)
SELECT p_type AS zaaksoort, count(*) AS besluiten, count(*) FILTER (WHERE o > 1) AS verdeeld, round(100.0 * count(*) FILTER (WHERE o > 1) / count(*), 1) AS pct_verdeeld
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) JOIN o ON l_orderkey = besluit_id JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) >= 50""")
def divided(t: Tables):
    links = t.lineitem.select(F.col("l_orderkey").alias("besluit_id"), F.col("l_partkey").alias("zaak_id")).distinct()
    return V.divided_by_kind(s.votes(t), links, t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("soort")))
