"""Aggregations, shares and quantiles."""

from pyspark.sql import functions as F

from plenaria.functions.numbers import exact_mean, exact_sum, percentage
from plenaria.operators import aggregates as A
from plenaria.queries import Tables, query
from plenaria.queries import standins as s


@query("g1_basic", """
SELECT l_returnflag, l_linestatus, count(*) AS rijen, count(nullif(l_discount, 0)) AS met_korting, CAST(sum(CAST(l_quantity AS DECIMAL(24,2))) AS DOUBLE) AS som,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(24,2))) AS DOUBLE) / count(*), 4) AS gem, min(l_shipdate) AS eerste, max(l_shipdate) AS laatste FROM lineitem GROUP BY ALL""")
def basic(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rijen"), F.count(F.nullif(F.col("l_discount"), F.lit(0.0))).alias("met_korting"), exact_sum(F.col("l_quantity")).alias("som"),
        exact_mean(F.col("l_extendedprice")).alias("gem"), F.min("l_shipdate").alias("eerste"), F.max("l_shipdate").alias("laatste"))


@query("g2_distinct", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def distinct(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))


@query("g3_conditional", """
SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS klaar, CAST(sum(CASE WHEN o_totalprice > 200000 THEN CAST(o_totalprice AS DECIMAL(24,2)) END) AS DOUBLE) AS groot
FROM orders GROUP BY 1""")
def conditional(t: Tables):
    return t.orders.groupBy("o_orderpriority").agg(F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("klaar"),
                                                   exact_sum(F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice"))).alias("groot"))


@query("f4_agg_filter", """
SELECT c_nationkey::BIGINT AS land, count(*) AS aantal, count(*) FILTER (WHERE c_acctbal < 0) AS schuld, count(DISTINCT c_mktsegment) FILTER (WHERE c_acctbal > 5000) AS segmenten
FROM customer GROUP BY 1""")
def agg_filter(t: Tables):
    return t.customer.groupBy(F.col("c_nationkey").alias("land")).agg(
        F.count(F.lit(1)).alias("aantal"), F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("schuld"),
        F.countDistinct(F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment"))).alias("segmenten"))


@query("f5_having", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) >= 12")
def having(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).where("orders >= 12")


@query("g4_median_p90", """
SELECT l_returnflag, round(median(l_extendedprice), 4) AS mediaan, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1""")
def median_p90(t: Tables):
    """Exact quantiles of a wide value domain: bracketed by a sketch, then counted."""
    q = A.quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"mediaan": 0.5, "p90": 0.9})
    return q.select("l_returnflag", F.round("mediaan", 4).alias("mediaan"), F.round("p90", 4).alias("p90"))


@query("g4_describe", """
SELECT l_linenumber::BIGINT AS l_linenumber, count(l_quantity) AS aantal, round(avg(l_quantity), 4) AS gemiddelde, round(stddev_samp(l_quantity), 4) AS std, min(l_quantity) AS min, max(l_quantity) AS max,
  quantile_cont(l_quantity, 0.25) AS p25, median(l_quantity) AS mediaan, quantile_cont(l_quantity, 0.75) AS p75 FROM lineitem GROUP BY 1""")
def described(t: Tables):
    return A.describe(t.lineitem, ["l_linenumber"], "l_quantity", few_values=True)


@query("g4_describe_all", """
SELECT count(*) AS aantal, round(avg(o_totalprice), 2) AS gemiddelde, round(stddev_samp(o_totalprice), 2) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max,
  round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(median(o_totalprice), 4) AS mediaan, round(quantile_cont(o_totalprice, 0.75), 4) AS p75 FROM orders""")
def described_all(t: Tables):
    d = A.describe(t.orders, [], "o_totalprice", digits=2)
    return d.select(*[F.round(c, 4).alias(c) if c in ("p25", "mediaan", "p75") else F.col(c) for c in d.columns])


@query("g5_string_agg", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS prioriteiten, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1")
def strings(t: Tables):
    """Distinct values per group joined in order; a priority has five values, so texts stay short."""
    named = A.ordered_strings(t.orders, ["o_custkey"], "o_orderpriority", "prioriteiten")
    return named.withColumn("n", F.size(F.split("prioriteiten", ", ")))


@query("g7_two_level", """
SELECT o_custkey, count(*) AS jaren, round(avg(som), 2) AS gem_per_jaar FROM (SELECT o_custkey, year(o_orderdate) AS j, CAST(sum(CAST(o_totalprice AS DECIMAL(24,2))) AS DOUBLE) AS som FROM orders GROUP BY 1, 2) GROUP BY 1""")
def two_level(t: Tables):
    rows = t.orders.withColumn("j", F.year("o_orderdate"))
    return A.two_level(rows, ["o_custkey", "j"], [exact_sum(F.col("o_totalprice")).alias("som")], ["o_custkey"],
                       [F.count(F.lit(1)).alias("jaren"), F.round(F.avg("som"), 2).alias("gem_per_jaar")])


@query("g7_zero_inclusive", """
SELECT c_nationkey::BIGINT AS land, count(*) AS personen, round(avg(coalesce(n, 0)), 2) AS gem_contacten FROM customer
  LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""")
def zero_inclusive(t: Tables):
    from plenaria.plans.people import mean_contacts

    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("land"))
    return mean_contacts(people, t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("persoon_id")), "land")


@query("g8_shares", """
SELECT o_orderstatus, count(*) AS aantal, round(100.0 * count(*) / (SELECT count(*) FROM orders), 1) AS aandeel FROM orders GROUP BY 1""")
def shares(t: Tables):
    return A.share(t.orders, ["o_orderstatus"])


@query("g8_share_within", """
SELECT o_orderpriority, o_orderstatus, count(*) AS aantal, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 2) AS aandeel FROM orders GROUP BY 1, 2""")
def share_within(t: Tables):
    return A.share(t.orders, ["o_orderpriority", "o_orderstatus"], ["o_orderpriority"], digits=2)


@query("g9_conditional_pick", """
SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS retour FROM lineitem GROUP BY 1""")
def pick(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(F.max(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("retour"))


@query("g9_link_pick", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'click' THEN 'http://b/' || event_id END AS url FROM events""")
def link_pick(t: Tables):
    """The enclosure link out of an entity's nested links, without a join."""
    from plenaria.plans.conform import entity

    kind = F.when(F.col("event_type") == "click", "enclosure").otherwise("self")
    links = F.array(F.struct(F.lit("self").alias("rel"), F.lit("http://a").alias("href")),
                    F.struct(kind.alias("rel"), F.concat(F.lit("http://b/"), F.col("event_id").cast("string")).alias("href")))
    field, = entity("x", "url@").fields
    return t.events.select(F.col("event_id").cast("string").alias("id"), links.alias("atom_links")).select("id", *field.columns())


@query("g10_collapse", "SELECT doc_id, list_max(string_split(text, ' ')) AS woord FROM documents")
def collapse(t: Tables):
    """One reference of a relation kept in the parent row: the highest."""
    from plenaria.plans.conform import entity

    nested = t.documents.select("doc_id", F.transform(F.split("text", " "), lambda w: F.struct(w.alias("ref"))).alias("woord"))
    field, = entity("y", "woord>>woord").fields
    return nested.select("doc_id", *field.columns())


@query("g11_pair_latest", "SELECT l_orderkey, l_suppkey, max(l_shipdate) AS relatie_gewijzigd_op FROM lineitem GROUP BY 1, 2")
def pair_latest(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.max("l_shipdate").alias("relatie_gewijzigd_op"))


@query("g12_span", f"""WITH {s.FLOW_SQL} SELECT dossier, count(*) AS documenten, min(ontvangst) AS eerste, max(ontvangst) AS laatste, date_diff('day', min(ontvangst), max(ontvangst)) AS looptijd FROM flow GROUP BY 1""")
def span(t: Tables):
    from plenaria.plans.documents import dossier_span

    return dossier_span(s.flow(t), "dossier", "ontvangst").drop("klasse")


@query("g13_rate", """
SELECT o_orderpriority, round(100.0 * avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 1) AS pct FROM orders GROUP BY 1""")
def rate(t: Tables):
    return t.orders.groupBy("o_orderpriority").agg(percentage(F.count(F.when(F.col("o_orderstatus") == "F", 1)), F.count(F.lit(1))).alias("pct"))


@query("o6_drop_last", "SELECT year(o_orderdate) AS jaar, count(*) AS aantal FROM orders WHERE year(o_orderdate) < (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1")
def drop_last(t: Tables):
    counts = t.orders.groupBy(F.year("o_orderdate").alias("jaar")).agg(F.count(F.lit(1)).alias("aantal"))
    return A.drop_last_group(counts, "jaar")
