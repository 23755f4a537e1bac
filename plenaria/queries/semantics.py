"""Semantic view over regions, nations, customers and orders."""

from pyspark.sql import functions as F

from plenaria.plans import semantic as S
from plenaria.queries import Tables, query


def _view(t: Tables) -> S.SemanticView:
    return S.SemanticView(
        {"n": (t.nation, "n_nationkey"), "c": (t.customer, "c_custkey"), "o": (t.orders, "o_orderkey"), "r": (t.region, "r_regionkey")},
        [S.Relationship("n", "n_regionkey", "r"), S.Relationship("c", "c_nationkey", "n"), S.Relationship("o", "o_custkey", "c")],
        {"Regio": ("r", "r_name"), "Land": ("n", "n_name"), "Segment": ("c", "c_mktsegment"), "Status": ("o", "o_orderstatus"), "Klant": ("c", "c_name")},
        {"Klanten": S.Metric("c", "count_distinct", "c_custkey"), "Landen": S.Metric("n", "count_distinct", "n_nationkey"),
         "Landsom": S.Metric("n", "sum", "n_nationkey"), "Orders": S.Metric("o", "count_distinct", "o_orderkey")})


@query("m2_semantic_query", """
SELECT r_name AS "Regio", (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS "Landen", CAST((SELECT sum(n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) AS BIGINT) AS "Landsom",
  (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey) AS "Klanten",
  (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey) AS "Orders" FROM region""")
def by_region(t: Tables):
    """Metrics of three grains by one dimension; sums of nations are not multiplied by customers."""
    return _view(t).query(["Regio"], ["Landen", "Landsom", "Klanten", "Orders"])


@query("m2_semantic_where", """
SELECT n_name AS "Land", c_mktsegment AS "Segment", count(DISTINCT c_custkey) AS "Klanten" FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('AFRICA', 'ASIA') AND c_mktsegment <> 'BUILDING' GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15""")
def filtered(t: Tables):
    return _view(t).query(["Land", "Segment"], ["Klanten"], where={"Regio": ["AFRICA", "ASIA"], "Segment": lambda c: c != "BUILDING"},
                          order_by=[("Klanten", False), ("Land", True), ("Segment", True)], limit=15)


@query("m2_semantic_total", """SELECT count(DISTINCT n_nationkey) AS "Landen", CAST(sum(n_nationkey) AS BIGINT) AS "Landsom" FROM nation""")
def totals(t: Tables):
    return _view(t).query([], ["Landen", "Landsom"])


@query("m2_semantic_facts", """SELECT n_name AS "Land", c_custkey, c_acctbal FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'MACHINERY'""")
def facts(t: Tables):
    return _view(t).query(["Land"], facts=["c.c_custkey", "c.c_acctbal"], where={"Segment": "MACHINERY"})


def _records(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "Tweede Kamerlid").otherwise("Oud Kamerlid").alias("functie"))
    seats = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("fractie_id"))
    held = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("persoon_id"), (F.col("o_orderkey") % 90).alias("fractie_zetel_id"),
                           F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date")).alias("tot_en_met"))
    return people, seats, held


@query("m3_current_members", """
WITH h AS (SELECT o_orderkey % 90 AS z FROM orders WHERE o_orderstatus <> 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS fractie_id, (SELECT count(*) FROM h) AS houders FROM supplier WHERE s_suppkey IN (SELECT z FROM h)""")
def members(t: Tables):
    people, seats, held = _records(t)
    holders = S.open_seat_holders(held, S.current_members(people))
    total = holders.agg(F.count(F.lit(1)).alias("n")).scalar()
    return S.held_seats(seats, holders).withColumn("houders", total)


@query("m3_faction_view", """
WITH h AS (SELECT DISTINCT o_orderkey % 90 AS z, o_custkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')),
z AS (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey IN (SELECT z FROM h)), f AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 3)
SELECT n_name AS "FractieNaam", count(DISTINCT s_suppkey) AS "AantalZetels", count(DISTINCT o_custkey) AS "AantalPersonen" FROM h LEFT JOIN z ON h.z = s_suppkey LEFT JOIN f ON s_nationkey = n_nationkey GROUP BY 1""")
def faction_view(t: Tables):
    """The ready view on stand-ins: factions = nations, seats = suppliers, holders = open orders."""
    people, seats, held = _records(t)
    factions = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("naam_nl"), F.col("n_name").alias("afkorting"),
                               F.lit("1990-01-01").cast("date").alias("datum_actief"), F.lit(1).alias("aantal_zetels"), F.lit(2).alias("aantal_stemmen"),
                               F.when(F.col("n_regionkey") == 3, F.lit("2000-01-01").cast("date")).alias("datum_inactief"))
    extra = {c: F.lit(None).cast("string") for c in ("achternaam", "roepnaam", "voornamen", "geslacht", "geboortedatum", "geboorteplaats", "woonplaats")}
    view = S.faction_view({"persoon": people.withColumns(extra), "fractie": factions, "fractie_zetel": seats.withColumn("gewicht", F.lit(1)),
                           "fractie_zetel_persoon": held.withColumns({"functie": F.lit("Lid"), "van": F.lit("2000-01-01").cast("date")})})
    return view.query(["FractieNaam"], ["AantalZetels", "AantalPersonen"])


@query("m4_params", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000")
def parameters(t: Tables):
    """A SQL text with bound parameters."""
    return t.spark.sql("SELECT c_custkey, c_name FROM {klanten} WHERE c_mktsegment = :segment AND c_acctbal > :grens",
                       args={"segment": "BUILDING", "grens": 9000}, klanten=t.customer)
