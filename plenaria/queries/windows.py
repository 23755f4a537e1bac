"""Windows, sorting and set operations."""

from pyspark.sql import Window, functions as F

from plenaria.operators import aggregates as A
from plenaria.operators import sequence as Q
from plenaria.queries import Tables, query
from plenaria.queries import standins as s


@query("w1_first_last", f"""WITH {s.MEMBERS_SQL}
SELECT persoon_id, max(fractie) FILTER (WHERE a = 1) AS eerste, max(fractie) FILTER (WHERE z = 1) AS laatste, max(tot_en_met) FILTER (WHERE z = 1) AS tot FROM (SELECT *,
  row_number() OVER (PARTITION BY persoon_id ORDER BY van, tot_en_met NULLS LAST, lid_id) AS a, row_number() OVER (PARTITION BY persoon_id ORDER BY van DESC, tot_en_met DESC NULLS FIRST, lid_id DESC) AS z FROM members) GROUP BY 1""")
def first_last(t: Tables):
    """First and last membership per person as two aggregates in one pass, no window."""
    far = F.coalesce(F.col("tot_en_met"), F.lit("9999-12-31").cast("date"))
    order = F.struct("van", far, "lid_id")
    held = s.members(t)
    return held.groupBy("persoon_id").agg(F.min_by("fractie", order).alias("eerste"), F.max_by("fractie", order).alias("laatste"), F.max_by("tot_en_met", order).alias("tot"))


@query("w2_argmax", """
SELECT l_suppkey, l_returnflag AS vlag FROM (SELECT l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY sum(CAST(l_quantity AS DECIMAL(18,2))) DESC, l_returnflag) AS rn
  FROM lineitem GROUP BY 1, 2) WHERE rn = 1""")
def argmax(t: Tables):
    return A.argmax_by(t.lineitem, ["l_suppkey"], "l_returnflag", F.sum(F.col("l_quantity").cast("decimal(18,2)")), "vlag")


@query("w3_dense_rank_key", """
SELECT p_type, p_size::BIGINT AS p_size, dense_rank() OVER (ORDER BY p_type NULLS LAST, p_size NULLS LAST) AS sleutel FROM (SELECT DISTINCT nullif(p_type, 'PROMO') AS p_type, p_size FROM part)""")
def dense_rank(t: Tables):
    rows = t.part.select(F.nullif(F.col("p_type"), F.lit("PROMO")).alias("p_type"), "p_size")
    return Q.dense_key(rows, ["p_type", "p_size"], "sleutel")


@query("w4_global_row_number", """
SELECT row_number() OVER (ORDER BY ts DESC NULLS LAST, event_id) AS sleutel, event_id FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('day', ts) END AS ts FROM events)""")
def row_number(t: Tables):
    """Global numbers by range partitions and offsets; days repeat and errors have no time."""
    rows = t.events.select("event_id", F.when(F.col("event_type") != "error", F.date_trunc("day", "ts")).alias("ts"))
    return Q.surrogate_key(rows, [F.col("ts").desc_nulls_last(), F.col("event_id").asc()], "sleutel").drop("ts")


@query("w5_lag_delta", """
SELECT o_orderpriority, jaar, aantal, lag(aantal) OVER w AS vorig, aantal - lag(aantal) OVER w AS verandering
FROM (SELECT o_orderpriority, year(o_orderdate) AS jaar, count(*) AS aantal FROM orders GROUP BY 1, 2) WINDOW w AS (PARTITION BY o_orderpriority ORDER BY jaar)""")
def lag_delta(t: Tables):
    """Yearly counts against the previous row; a window group has one row per year."""
    counts = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("jaar")).agg(F.count(F.lit(1)).alias("aantal"))
    before = F.lag("aantal").over(Window.partitionBy("o_orderpriority").orderBy("jaar"))
    return counts.withColumn("vorig", before).withColumn("verandering", F.col("aantal") - F.col("vorig"))


@query("w6_lead_moves", f"""WITH {s.MEMBERS_SQL}, v AS (SELECT *, lead(fractie) OVER w AS naar, lead(van) OVER w AS start_volgende FROM members WINDOW w AS (PARTITION BY persoon_id ORDER BY van, lid_id))
SELECT persoon_id, fractie AS van_fractie, tot_en_met AS einde_vorige, naar, start_volgende FROM v WHERE naar IS NOT NULL AND naar <> fractie""")
def lead_moves(t: Tables):
    from plenaria.plans.seats import moves

    return moves(s.members(t), ("van", "lid_id"))


@query("w6_previous_event", """
SELECT event_id, lag(event_type) OVER w AS vorige_soort, lag(event_id) OVER w AS vorige FROM events WINDOW w AS (PARTITION BY event_type = 'click' ORDER BY ts, event_id)""")
def previous_event(t: Tables):
    """Previous row within two large groups, here taken as hot: their hours are separate window groups."""
    rows = t.events.select("event_id", "event_type", "ts", (F.col("event_type") == "click").alias("g"))
    seen = Q.neighbour(rows, ["g"], ["ts", "event_id"], F.date_trunc("hour", "ts"), {"vorige_soort": "event_type", "vorige": "event_id"})
    return seen.select("event_id", "vorige_soort", "vorige")


@query("w7_count_over", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders")
def count_over(t: Tables):
    """Group size on every row: counts joined back, so a hot group is never one window."""
    sizes = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t.orders.select("o_orderkey", "o_custkey").join(sizes, "o_custkey").drop("o_custkey")


@query("w7_distinct_over", "SELECT o_orderkey, count(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey) AS n FROM orders")
def distinct_over(t: Tables):
    sizes = t.orders.groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("n"))
    return t.orders.select("o_orderkey", "o_custkey").join(sizes, "o_custkey").drop("o_custkey")


@query("w8_running_sum", """
SELECT c_mktsegment, c_nationkey::BIGINT AS c_nationkey, aantal, CAST(sum(aantal) OVER (PARTITION BY c_mktsegment ORDER BY aantal DESC, c_nationkey) AS BIGINT) AS lopend,
  round(100.0 * aantal / sum(aantal) OVER (PARTITION BY c_mktsegment), 1) AS aandeel FROM (SELECT c_mktsegment, c_nationkey, count(*) AS aantal FROM customer GROUP BY 1, 2)""")
def running_sum(t: Tables):
    from plenaria.functions.numbers import percentage

    counts = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("aantal"))
    group = Window.partitionBy("c_mktsegment")
    running = group.orderBy(F.col("aantal").desc(), "c_nationkey").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("lopend", F.sum("aantal").over(running)).withColumn("aandeel", percentage(F.col("aantal"), F.sum("aantal").over(group)))


@query("o1_sort_nulls", """
SELECT row_number() OVER (ORDER BY st ASC NULLS LAST, n DESC) AS plaats, st, n FROM (SELECT nullif(o_orderstatus, 'F') AS st, year(o_orderdate) AS j, count(*) AS n FROM orders GROUP BY 1, 2)""")
def sort_nulls(t: Tables):
    """Mixed directions with stated null places; the position makes the order checkable."""
    counts = t.orders.groupBy(F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("st"), F.year("o_orderdate").alias("j")).agg(F.count(F.lit(1)).alias("n"))
    return Q.surrogate_key(counts, [F.col("st").asc_nulls_last(), F.col("n").desc()], "plaats").drop("j")


@query("o2_topk", "SELECT l_partkey, count(*) AS aantal FROM lineitem GROUP BY 1 ORDER BY aantal DESC, l_partkey LIMIT 20")
def topk(t: Tables):
    from plenaria.plans.documents import most_cited

    return most_cited(t.lineitem, 20, "l_partkey").withColumnRenamed("verwijzingen", "aantal")


@query("o3_topk_group", """
SELECT c_mktsegment, c_custkey, plaats FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS plaats FROM customer) WHERE plaats <= 3""")
def topk_group(t: Tables):
    top = A.top_per_group(t.customer, ["c_mktsegment"], [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], 3, "plaats")
    return top.select("c_mktsegment", "c_custkey", "plaats")


@query("o4_top_other", """
WITH n AS (SELECT n_name AS partij, count(*) AS aantal FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY aantal DESC, partij) AS p FROM n)
SELECT CASE WHEN p <= 8 THEN partij ELSE 'Overige partijen' END AS partij, CAST(sum(aantal) AS BIGINT) AS aantal FROM r GROUP BY 1""")
def top_other(t: Tables):
    counts = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("partij")).agg(F.count(F.lit(1)).alias("aantal"))
    return A.top_with_other(counts, "partij", "aantal", 8, "Overige partijen")


@query("o5_capped_star", """
WITH f AS (SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000)
SELECT 'feit' AS tabel, count(*) AS rijen FROM f UNION ALL SELECT 'klant', count(*) + 1 FROM customer WHERE c_custkey IN (SELECT o_custkey FROM f)""")
def capped(t: Tables):
    """Newest 1000 facts (the cap is the feature) with the dimension trimmed to them."""
    from plenaria.operators.filters import Star, capped_star
    from plenaria.sources.files import catalog_counts, with_unknown

    dim = with_unknown(t.customer.select("c_custkey", "c_name"), c_custkey=-1, c_name="Onbekend")
    star = capped_star(Star(t.orders, {"klant": (dim, "c_custkey", "o_custkey")}), [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()], 1000, -1)
    return catalog_counts({"feit": star.fact, "klant": star.dims["klant"][0]})


@query("u1_union_events", f"""WITH {s.MEMBERS_SQL}
SELECT lid_id, fractie, van AS datum, 'aanmelding' AS event_type FROM members UNION ALL SELECT lid_id, fractie, tot_en_met, 'vertrek' FROM members WHERE tot_en_met IS NOT NULL""")
def union_events(t: Tables):
    from plenaria.plans.seats import seat_events

    return seat_events(s.members(t)).select("lid_id", "fractie", "datum", "event_type")


@query("u2_unknown_member", """
SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation UNION ALL SELECT -1, 'Onbekend', NULL""")
def unknown(t: Tables):
    from plenaria.sources.files import with_unknown

    return with_unknown(t.nation, n_nationkey=-1, n_name="Onbekend")


@query("u3_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query("u4_labelled_union", """
SELECT 'besteld' AS reeks, year(o_orderdate) AS jaar, count(*) AS aantal FROM orders GROUP BY 2 UNION ALL SELECT 'verzonden', year(l_shipdate), count(*) FROM lineitem GROUP BY 2""")
def labelled(t: Tables):
    from plenaria.plans.documents import citations_per_year

    series = {"besteld": citations_per_year(t.orders, "o_orderdate"), "verzonden": citations_per_year(t.lineitem, "l_shipdate")}
    first, second = [df.select(F.lit(n).alias("reeks"), "jaar", F.col("vermeldingen").alias("aantal")) for n, df in series.items()]
    return first.unionByName(second)


@query("u5_except_intersect", """
SELECT 'verschil' AS soort, p_partkey AS k FROM (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 25) UNION ALL
SELECT 'doorsnede', p_partkey FROM (SELECT p_partkey FROM part INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity > 49)""")
def set_operations(t: Tables):
    parts = t.part.select(F.col("p_partkey").alias("k"))
    one = parts.subtract(t.lineitem.where("l_quantity > 25").select("l_partkey")).select(F.lit("verschil").alias("soort"), "k")
    return one.unionByName(parts.intersect(t.lineitem.where("l_quantity > 49").select("l_partkey")).select(F.lit("doorsnede").alias("soort"), "k"))


@query("u6_values_dim", """
SELECT o_orderpriority, rang, count(*) AS aantal FROM orders JOIN (VALUES ('1-URGENT', 1::BIGINT), ('2-HIGH', 2), ('3-MEDIUM', NULL)) v(p, rang) ON o_orderpriority = p GROUP BY 1, 2""")
def values_dim(t: Tables):
    ranks = t.spark.createDataFrame([("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", None)], "p string, rang int")
    # three literal rows, so the broadcast has a fixed size
    joined = t.orders.join(F.broadcast(ranks), F.col("o_orderpriority") == F.col("p"))
    return joined.groupBy("o_orderpriority", "rang").agg(F.count(F.lit(1)).alias("aantal"))
