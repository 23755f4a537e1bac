"""Calendars, dimensions and facts with unknown members."""

from datetime import date

from pyspark.sql import functions as F

from plenaria.functions.dates import days_between
from plenaria.operators.quality import expected_counts, orphans
from plenaria.operators.sequence import surrogate_key
from plenaria.plans import calendar as C
from plenaria.queries import Tables, query
from plenaria.queries import standins as s
from plenaria.sources.files import catalog_counts, with_unknown


@query("c1_calendar_bounds", """
WITH b AS (SELECT least(min(o_orderdate), (SELECT min(l_shipdate) FROM lineitem)) AS lo, greatest(max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem), DATE '2003-01-31') AS hi FROM orders)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS calendar_date, strftime(d, '%Y-%m') AS month, year(d) AS year FROM b, generate_series(lo, hi, INTERVAL 1 DAY) g(d)
UNION ALL SELECT -1, NULL, 'Onbekend', NULL UNION ALL SELECT 99991231, NULL, 'Nog actief', NULL""")
def bounds(t: Tables):
    return C.with_special_days(C.calendar_over([(t.orders, ["o_orderdate"]), (t.lineitem, ["l_shipdate"])], [], [date(2003, 1, 31)]))


@query("c2_calendar_fixed", """
WITH d AS (SELECT CAST(d AS DATE) AS datum FROM generate_series(DATE '1992-01-01', DATE '2003-12-31', INTERVAL 1 DAY) g(d)), o AS (SELECT CAST(o_orderdate AS DATE) AS datum, count(*) AS n FROM orders GROUP BY 1)
SELECT d.datum, CAST(strftime(d.datum, '%Y%m%d') AS BIGINT) AS datum_id, year(d.datum) AS jaar, quarter(d.datum) AS kwartaal, month(d.datum) AS maand, coalesce(n, 0) AS orders FROM d LEFT JOIN o ON d.datum = o.datum""")
def fixed(t: Tables):
    """Orders per day over a fixed calendar, days without orders counting 0."""
    days = C.calendar(t.spark, date(1992, 1, 1), date(2003, 12, 31), ["datum_id", "jaar", "kwartaal", "maand"])
    counts = t.orders.groupBy(s.day("o_orderdate").alias("datum")).agg(F.count(F.lit(1)).alias("orders"))
    return days.join(counts, "datum", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("c3_year_dim", """
WITH y AS (SELECT CAST(y AS BIGINT) AS jaar, CAST(y // 10 * 10 AS BIGINT) AS decennium FROM range(1990, 2006) r(y))
SELECT jaar, decennium, count(o_orderkey) AS orders FROM y LEFT JOIN orders ON year(o_orderdate) = jaar GROUP BY 1, 2""")
def year_dim(t: Tables):
    counts = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("jaar")).agg(F.count(F.lit(1)).alias("orders"))
    joined = C.year_dimension(t.spark, 1990, 2005).join(counts, "jaar", "left")
    return joined.withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("c4_unknown_member_fact", """
WITH d AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'), f AS (SELECT coalesce(c_custkey, -1) AS klant_id FROM orders LEFT JOIN d ON o_custkey = c_custkey)
SELECT klant_id, CASE WHEN klant_id = -1 THEN 'Onbekend' ELSE max(c_name) END AS naam, count(*) AS orders FROM f LEFT JOIN customer ON klant_id = c_custkey GROUP BY 1""")
def unknown_fact(t: Tables):
    known = t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("klant_id"), F.col("c_name").alias("naam"))
    dim = with_unknown(known, klant_id=-1, naam="Onbekend")
    fact = t.orders.join(known.select("klant_id"), F.col("o_custkey") == F.col("klant_id"), "left").select(F.coalesce("klant_id", F.lit(-1)).alias("klant_id"))
    counts = fact.groupBy("klant_id").agg(F.count(F.lit(1)).alias("orders"))
    return counts.join(dim, "klant_id", "left").select("klant_id", "naam", "orders")


@query("c6_membership_fact", f"""WITH {s.MEMBERS_SQL}
SELECT row_number() OVER (ORDER BY van DESC NULLS LAST, lid_id) AS sleutel, lid_id, coalesce(c_custkey, -1) AS persoon_id, CAST(strftime(van, '%Y%m%d') AS BIGINT) AS van_key,
  CASE WHEN tot_en_met IS NULL THEN 99991231 ELSE CAST(strftime(tot_en_met, '%Y%m%d') AS BIGINT) END AS tot_key, date_diff('day', van, coalesce(tot_en_met, DATE '2026-10-10')) AS dagen, CAST(1 AS BIGINT) AS aantal
FROM members LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON persoon_id = c_custkey""")
def membership_fact(t: Tables):
    people = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey")
    rows = s.members(t).join(people, F.col("persoon_id") == F.col("c_custkey"), "left").select(
        "van", "lid_id", F.coalesce("c_custkey", F.lit(-1)).alias("persoon_id"), C.day_or_unknown(F.col("van")).alias("van_key"),
        C.day_or_open(F.col("tot_en_met")).alias("tot_key"), days_between(F.col("van"), F.coalesce("tot_en_met", F.lit(date(2026, 10, 10)))).alias("dagen"), F.lit(1).alias("aantal"))
    return surrogate_key(rows, [F.col("van").desc_nulls_last(), F.col("lid_id").asc()], "sleutel").drop("van")


@query("c7_star_check", """
SELECT 'wezen' AS naam, count(*) AS werkelijk, CAST(0 AS BIGINT) AS verwacht, count(*) = 0 AS ok FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'landen', count(*), 25, count(*) = 25 FROM nation UNION ALL SELECT 'orders', count(*), NULL, NULL FROM orders""")
def star_check(t: Tables):
    found = catalog_counts({"wezen": orphans(t.orders, "o_custkey", t.customer, "c_custkey"), "landen": t.nation, "orders": t.orders})
    return expected_counts(found.select(F.col("tabel").alias("naam"), F.col("rijen").alias("werkelijk")), {"wezen": 0, "landen": 25})


@query("a16_inflow_outflow", f"""WITH {s.MEMBERS_SQL}, a AS (SELECT year(van) AS jaar, count(*) AS n FROM members GROUP BY 1), z AS (SELECT year(tot_en_met) AS jaar, count(*) AS n FROM members WHERE tot_en_met IS NOT NULL GROUP BY 1)
SELECT coalesce(a.jaar, z.jaar) AS jaar, coalesce(a.n, 0) AS nieuwe_leden, coalesce(z.n, 0) AS vertrokken_leden FROM a FULL JOIN z ON a.jaar = z.jaar""")
def inflow(t: Tables):
    from plenaria.plans.committees import inflow_outflow

    return inflow_outflow(s.members(t))
