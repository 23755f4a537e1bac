"""Filters and joins."""

from datetime import date

from pyspark.sql import functions as F

from plenaria.operators import filters as L
from plenaria.operators import intervals as I
from plenaria.operators import references as R
from plenaria.operators.aggregates import iqr_filter, quantile_cut
from plenaria.queries import Tables, query
from plenaria.queries import standins as s


@query("f1_filters", """
SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01' AND o_orderstatus IN ('F', 'O')
  AND o_totalprice BETWEEN 50000 AND 300000 AND nullif(o_orderpriority, '5-LOW') IS NOT NULL""")
def filters(t: Tables):
    return t.orders.where((F.col("o_orderdate") >= F.lit(date(1997, 1, 1))) & (F.col("o_orderdate") < F.lit(date(1998, 1, 1)))
                          & F.col("o_orderstatus").isin("F", "O") & F.col("o_totalprice").between(50000, 300000)
                          & F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).isNotNull()).select("o_orderkey")


@query("f2_parametric", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice BETWEEN 100000 AND 200000)""")
def parametric(t: Tables):
    orders = L.parametric(t.orders, {"o_orderpriority": "1-URGENT", "o_orderstatus": None, "o_totalprice": (100000, 200000)})
    lines = L.parametric(t.lineitem, {"l_returnflag": ["A", "N"], "l_linestatus": None})
    return L.linked(lines, "l_orderkey", orders, "o_orderkey").select("l_orderkey", "l_linenumber", "l_quantity")


_CROSS = """keep AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))"""


@query("f3_cross_filter", f"""WITH {_CROSS}
SELECT 'feit' AS tabel, count(*) AS rijen FROM keep UNION ALL SELECT 'klant', count(*) FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM keep)
UNION ALL SELECT 'regel', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM keep)""")
def crossed(t: Tables):
    star = L.Star(t.orders.select("o_orderkey", "o_custkey"), {"klant": (t.customer, "c_custkey", "o_custkey")},
                  {"regel": (t.lineitem.select("l_orderkey"), "l_orderkey", "o_orderkey")})
    kept = L.cross_filter(star, {"klant": F.col("c_mktsegment") == "BUILDING"})
    from plenaria.sources.files import catalog_counts

    return catalog_counts({"feit": kept.fact, "klant": kept.dims["klant"][0], "regel": kept.bridges["regel"][0]})


@query("f6_iqr", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem)
SELECT l_orderkey, l_extendedprice FROM lineitem, q WHERE l_extendedprice > a - 1.5 * (b - a) AND l_extendedprice < b + 1.5 * (b - a)""")
def fences(t: Tables):
    return iqr_filter(t.lineitem.select("l_orderkey", "l_extendedprice"), "l_extendedprice")


@query("f6_quantile_cut", """
SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_extendedprice <= (SELECT quantile_cont(l_extendedprice, 0.95) FROM lineitem)""")
def cut_off(t: Tables):
    return quantile_cut(t.lineitem.select("l_orderkey", "l_extendedprice"), "l_extendedprice", 0.95)


@query("j1_chain", """
SELECT r_name, c_mktsegment, count(*) AS regels, count(DISTINCT o_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def chain(t: Tables):
    joined = (t.lineitem.select("l_orderkey").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
              .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return joined.groupBy("r_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("regels"), F.countDistinct("o_orderkey").alias("orders"))


@query("j2_left_chain", """
SELECT c_custkey, o_orderkey, l_partkey, p_name FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey
  LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey""")
def left_chain(t: Tables):
    orders = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    lines = t.lineitem.where("l_returnflag = 'R'").select("l_orderkey", "l_partkey")
    joined = (t.customer.select("c_custkey").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
              .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
              .join(t.part.where("p_size > 25").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left"))
    return joined.select("c_custkey", "o_orderkey", "l_partkey", "p_name")


_DATED = "dated AS (SELECT l_orderkey, l_partkey, o_custkey AS persoon_id, CAST(l_shipdate AS DATE) AS datum FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _dated(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey", s.day("l_shipdate").alias("datum"))
    return lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_partkey", F.col("o_custkey").alias("persoon_id"), "datum")


@query("j6_interval_join", f"""WITH {s.MEMBERS_SQL}, {_DATED}
SELECT l_orderkey, l_partkey, d.persoon_id, datum, fractie, lid_id FROM dated d JOIN members m ON d.persoon_id = m.persoon_id AND datum BETWEEN van AND coalesce(tot_en_met, DATE '9999-12-31')""")
def interval(t: Tables):
    return I.interval_join(_dated(t), s.members(t), ["persoon_id"], "datum", "van", "tot_en_met").drop("van", "tot_en_met")


@query("j6_interval_left", f"""WITH {s.MEMBERS_SQL}, {_DATED}
SELECT fractie, count(*) AS rijen FROM dated d LEFT JOIN (SELECT * FROM members WHERE fractie < '4') m ON d.persoon_id = m.persoon_id AND datum BETWEEN van AND coalesce(tot_en_met, DATE '9999-12-31') GROUP BY 1""")
def interval_left(t: Tables):
    joined = I.interval_join(_dated(t).select("persoon_id", "datum"), s.members(t).where("fractie < '4'"), ["persoon_id"], "datum", "van", "tot_en_met", "left")
    return joined.groupBy("fractie").agg(F.count(F.lit(1)).alias("rijen"))


@query("j7_year_membership", f"""WITH {s.MEMBERS_SQL}, {_DATED}, facts AS (SELECT DISTINCT persoon_id, l_orderkey, year(datum) AS jaar FROM dated)
SELECT l_orderkey, f.persoon_id, jaar, fractie FROM facts f LEFT JOIN members m ON f.persoon_id = m.persoon_id AND jaar BETWEEN year(van) AND coalesce(year(tot_en_met), 9999)
  AND NOT (year(van) > coalesce(year(tot_en_met), 9999))""")
def by_year(t: Tables):
    facts = _dated(t).select("persoon_id", "l_orderkey", F.year("datum").alias("jaar")).distinct()
    return I.year_membership(facts, s.members(t), ["persoon_id"], "jaar", "van", "tot_en_met").select("l_orderkey", "persoon_id", "jaar", "fractie")


@query("j8_null_safe", """
WITH a AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p, nullif(o_orderstatus, 'P') AS st, o_orderkey % 3 AS k FROM orders)
SELECT a.o_orderkey, (SELECT min(o_orderkey) FROM a x WHERE x.p IS NOT DISTINCT FROM a.p AND x.st IS NOT DISTINCT FROM a.st AND x.k IS NOT DISTINCT FROM a.k) AS eerste FROM a""")
def null_safe(t: Tables):
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"),
                           F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"), (F.col("o_orderkey") % 3).alias("k"))
    groups = rows.groupBy("p", "st", "k").agg(F.min("o_orderkey").alias("eerste"))
    return R.null_safe_join(rows, groups, ["p", "st", "k"]).select("o_orderkey", "eerste")


@query("j9_full_outer", """
WITH a AS (SELECT year(o_orderdate) AS jaar, count(*) AS nieuw FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT year(l_shipdate) AS jaar, count(*) AS weg FROM lineitem GROUP BY 1)
SELECT coalesce(a.jaar, b.jaar) AS jaar, coalesce(nieuw, 0) AS nieuw, coalesce(weg, 0) AS weg FROM a FULL JOIN b ON a.jaar = b.jaar""")
def full_outer(t: Tables):
    new = t.orders.where("o_orderstatus = 'F'").groupBy(F.year("o_orderdate").alias("jaar")).agg(F.count(F.lit(1)).alias("nieuw"))
    gone = t.lineitem.groupBy(F.year("l_shipdate").alias("jaar")).agg(F.count(F.lit(1)).alias("weg"))
    return R.full_outer_counts(new, gone, "jaar")


@query("j9_right", """
SELECT c_nationkey::BIGINT AS land, count(o_orderkey) AS reizen FROM (SELECT * FROM orders WHERE o_totalprice > 400000) RIGHT JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def right_counts(t: Tables):
    from plenaria.plans.people import counts_with_zero

    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("land"))
    return counts_with_zero(people, t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("persoon_id")), "land", "reizen")


@query("j10_semi", """
SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def semi(t: Tables):
    return L.linked(t.customer.select("c_custkey"), "c_custkey", t.orders.where("o_orderpriority = '1-URGENT'"), "o_custkey")


@query("j10_or_semi", """
SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount = 0)""")
def or_semi(t: Tables):
    return R.semi_any(t.part.select("p_partkey"), "p_partkey", t.lineitem.where("l_quantity > 49").select("l_partkey"), t.lineitem.where("l_discount = 0").select("l_partkey"))


@query("j11_anti", """
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def anti(t: Tables):
    return R.not_in(t.documents.select("doc_id"), "doc_id", t.labels.select("doc_id"))


@query("j11_not_in_sql", """
SELECT 'zonder null' AS geval, count(*) AS rijen FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'met null', count(*) FROM documents WHERE doc_id NOT IN (SELECT nullif(doc_id, 0) FROM labels)""")
def not_in_sql(t: Tables):
    docs, labels = t.documents.select("doc_id"), t.labels.select("doc_id")
    plain = R.not_in(docs, "doc_id", labels, "sql").agg(F.count(F.lit(1)).alias("rijen")).select(F.lit("zonder null").alias("geval"), "rijen")
    holes = labels.select(F.nullif(F.col("doc_id"), F.lit(0)).alias("doc_id"))
    return plain.unionByName(R.not_in(docs, "doc_id", holes, "sql").agg(F.count(F.lit(1)).alias("rijen")).select(F.lit("met null").alias("geval"), "rijen"))


@query("j12_active_count", f"""WITH {s.MEMBERS_SQL}, e AS (SELECT DISTINCT fractie, van FROM members)
SELECT fractie, van, count(DISTINCT persoon_id) AS actief FROM (SELECT e.fractie, e.van, m.persoon_id FROM e JOIN members m ON m.fractie = e.fractie AND m.van <= e.van
  AND (m.tot_en_met IS NULL OR m.tot_en_met >= e.van)) GROUP BY 1, 2
UNION ALL SELECT fractie, van, 0 FROM e WHERE NOT EXISTS (SELECT 1 FROM members m WHERE m.fractie = e.fractie AND m.van <= e.van AND (m.tot_en_met IS NULL OR m.tot_en_met >= e.van))""")
def active_count(t: Tables):
    held = s.members(t)
    events = held.select("fractie", "van").distinct()
    return I.count_active(events, held, ["fractie"], "van", "van", "tot_en_met", ["persoon_id"], "actief")


@query("j13_year_snapshot", f"""WITH {s.MEMBERS_SQL}, y AS (SELECT unnest(generate_series(1993, 2001)) AS jaar)
SELECT fractie, jaar, count(DISTINCT persoon_id) AS zetels FROM members JOIN y ON year(van) <= jaar AND (tot_en_met IS NULL OR year(tot_en_met) >= jaar) GROUP BY 1, 2""")
def snapshot(t: Tables):
    years = I.expand_years(s.members(t), "van", "tot_en_met", 1993, 2001)
    return years.groupBy("fractie", "jaar").agg(F.countDistinct("persoon_id").alias("zetels"))


@query("j14_scalar_max", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""")
def scalar_max(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return orders.where(F.col("o_totalprice") == orders.agg(F.max("o_totalprice").alias("m")).scalar())


@query("j15_pairs", """
SELECT a.s AS a, b.s AS b, count(*) AS samen FROM (SELECT DISTINCT o_custkey AS g, o_orderpriority AS s FROM orders) a JOIN (SELECT DISTINCT o_custkey AS g, o_orderpriority AS s FROM orders) b
  ON a.g = b.g AND a.s < b.s GROUP BY 1, 2""")
def pairs(t: Tables):
    from plenaria.operators.pairs import co_occurrence

    return co_occurrence(t.orders, "o_custkey", "o_orderpriority")


@query("j15_many_items", """
SELECT a.o AS a, b.o AS b, count(*) AS samen FROM (SELECT DISTINCT l_partkey AS g, l_orderkey AS o FROM lineitem) a
  JOIN (SELECT DISTINCT l_partkey AS g, l_orderkey AS o FROM lineitem) b ON a.g = b.g AND a.o < b.o GROUP BY 1, 2 HAVING count(*) >= 2""")
def many_items(t: Tables):
    """Orders that share two parts or more: as many items as there are orders."""
    from plenaria.operators.pairs import co_occurrence

    return co_occurrence(t.lineitem, "l_partkey", "l_orderkey", least=2)


@query("j16_lookup_default", """
SELECT o_orderkey, coalesce(c_name, 'Onbekend') AS klant FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def lookup_default(t: Tables):
    return R.lookup(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", t.customer.where("c_acctbal > 0"), "c_custkey", "c_name", "klant", "Onbekend").drop("o_custkey")
