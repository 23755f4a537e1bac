"""Pivots, cross tables and coverage."""

from pyspark.sql import functions as F

from plenaria.operators import reshape as R
from plenaria.queries import Tables, query

_STATUS = ["F", "O", "P"]
_PCT = ", ".join(f"round(100.0 * count(*) FILTER (WHERE o_orderstatus = '{x}') / count(*), 1) AS \"{x}\"" for x in _STATUS)


@query("r1_pivot", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'X') AS "X", count(*) AS totaal
FROM orders GROUP BY 1""")
def pivot(t: Tables):
    return R.pivot_counts(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "X"])


@query("r1_pivot_sums", """
SELECT o_custkey, coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(24,2))) FILTER (WHERE year(o_orderdate) = 1996) AS DOUBLE), 0) AS "1996",
  coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(24,2))) FILTER (WHERE year(o_orderdate) = 1997) AS DOUBLE), 0) AS "1997" FROM orders GROUP BY 1""")
def pivot_sums(t: Tables):
    rows = t.orders.withColumn("jaar", F.year("o_orderdate"))
    return R.pivot_sums(rows, ["o_custkey"], "jaar", [1996, 1997], F.col("o_totalprice").cast("decimal(24,2)"))


@query("r2_unpivot", """
SELECT l_returnflag, variabele, waarde FROM (UNPIVOT (SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS stuks, count(*) AS rijen FROM lineitem GROUP BY 1) ON stuks, rijen INTO NAME variabele VALUE waarde)""")
def unpivot(t: Tables):
    totals = t.lineitem.groupBy("l_returnflag").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("stuks"), F.count(F.lit(1)).alias("rijen"))
    return R.melt(totals, ["l_returnflag"], ["stuks", "rijen"])


@query("r4_crosstab", f"SELECT o_orderpriority, {_PCT} FROM orders GROUP BY 1")
def crosstab(t: Tables):
    return R.crosstab(t.orders, "o_orderpriority", "o_orderstatus", _STATUS)


@query("r4_margins", """
SELECT coalesce(o_orderpriority, 'totaal') AS o_orderpriority, coalesce(o_orderstatus, 'totaal') AS o_orderstatus, count(*) AS aantal FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def margins(t: Tables):
    return R.margins(t.orders, "o_orderpriority", "o_orderstatus")


@query("r5_coverage", """
WITH d AS (SELECT lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT lang, 'kwaliteit' AS variabele, count(*) AS n, count(quality) AS ingevuld, round(100.0 * count(quality) / count(*), 1) AS percentage FROM d GROUP BY 1
UNION ALL SELECT lang, 'toxisch', count(*), count(CASE WHEN toxic = 1 THEN 1 END), round(100.0 * count(CASE WHEN toxic = 1 THEN 1 END) / count(*), 1) FROM d GROUP BY 1""")
def coverage(t: Tables):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return R.coverage(joined, ["lang"], {"kwaliteit": F.col("quality").isNotNull(), "toxisch": F.col("toxic") == 1})
