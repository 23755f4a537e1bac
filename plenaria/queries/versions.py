"""Versioned entities and bridges."""

from pyspark.sql import functions as F

from plenaria.operators.references import resolve_fk
from plenaria.operators.versioned import apply_corrections, drop_deleted, feed_order, latest_version
from plenaria.plans.conform import BridgeSpec, conform_bridge, conform_entity, current, current_children, entity
from plenaria.queries import Tables, query
from plenaria.queries import standins as s

_LATEST = """SELECT * FROM versions QUALIFY row_number() OVER (
  PARTITION BY id ORDER BY bijgewerkt DESC NULLS LAST, feed_updated DESC NULLS LAST, _row_id DESC) = 1"""


@query("d1_latest_version", f"WITH {s.VERSIONS_SQL} SELECT id, _row_id AS row_id, bijgewerkt, event_type, value FROM ({_LATEST})")
def latest(t: Tables):
    rows = latest_version(s.versions(t), ["id"], feed_order())
    return rows.select("id", F.col("_row_id").alias("row_id"), "bijgewerkt", "event_type", "value")


@query("d2_latest_not_deleted", f"WITH {s.VERSIONS_SQL} SELECT id, _row_id AS row_id, event_type FROM ({_LATEST}) WHERE NOT verwijderd")
def latest_not_deleted(t: Tables):
    return drop_deleted(latest_version(s.versions(t), ["id"], feed_order())).select("id", F.col("_row_id").alias("row_id"), "event_type")


# an order log as entity: the version of an order is its line, the reference its customer
_ORDER_LOG = """log AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, l_shipdate AS bijgewerkt, o_orderdate AS feed_updated,
    l_partkey * 1000000 + l_suppkey * 1000 + l_linenumber * 100 + CAST(l_quantity AS BIGINT) AS _row_id, l_returnflag = 'R' AS verwijderd,
    CAST(o_custkey AS VARCHAR) AS klant, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') END AS datum,
    l_linestatus AS status, CAST(l_linenumber AS VARCHAR) AS volgnummer
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _order_log(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    joined = lines.join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    code = F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 1000 + F.col("l_linenumber") * 100 + F.col("l_quantity").cast("bigint")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyy"))
    return joined.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("l_shipdate").cast("timestamp").alias("bijgewerkt"),
        F.col("o_orderdate").cast("timestamp").alias("feed_updated"), code.alias("_row_id"), (F.col("l_returnflag") == "R").alias("verwijderd"),
        F.struct(F.col("o_custkey").cast("string").alias("ref")).alias("klant"), text.alias("datum"), F.col("l_linestatus").alias("status"),
        F.col("l_linenumber").cast("string").alias("volgnummer"))


_CONFORMED = """conformed AS (
  SELECT id, CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_mktsegment <> 'BUILDING' AND CAST(c_custkey AS VARCHAR) = klant) THEN klant END AS klant_id,
    CASE WHEN length(datum) = 7 THEN last_day(CAST(datum || '-01' AS DATE)) ELSE CAST(datum || '-12-31' AS DATE) END AS datum, datum AS datum_ruw,
    CASE WHEN length(datum) = 7 THEN 'maand' ELSE 'jaar' END AS datum_precisie, status, CAST(volgnummer AS BIGINT) AS volgnummer
  FROM (SELECT * FROM log QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY bijgewerkt DESC, feed_updated DESC, _row_id DESC) = 1) WHERE NOT verwijderd)"""


def _parents(t: Tables):
    return t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("id"))


@query("d3_conform_entity", f"WITH {_ORDER_LOG}, {_CONFORMED} SELECT * FROM conformed")
def conformed_entity(t: Tables):
    spec = entity("order", "klant_id>klant datum~end status volgnummer:int")
    return conform_entity(_order_log(t), {"klant": _parents(t)}, spec).drop("gewijzigd_op", "api_gewijzigd_op")


@query("d4_conform_bridge", """
WITH log AS (SELECT user_id AS id, ts, event_id, event_type FROM events),
cur AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) = 1),
links AS (SELECT DISTINCT CAST(c.id AS VARCHAR) AS eigenaar_id, CAST(x.ref AS VARCHAR) AS deel_id, c.ts AS relatie_gewijzigd_op
  FROM cur c, LATERAL (SELECT unnest([c.event_id % 97, c.event_id % 97, c.event_id % 13, NULL]) AS ref) x
  WHERE c.event_type <> 'error' AND x.ref IS NOT NULL)
SELECT links.* FROM links WHERE deel_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 10)""")
def conformed_bridge(t: Tables):
    refs = F.array(*[F.struct(x.cast("string").alias("ref")) for x in
                     (F.col("event_id") % 97, F.col("event_id") % 97, F.col("event_id") % 13, F.lit(None))])
    log = t.events.select(F.col("user_id").cast("string").alias("id"), F.col("ts").alias("bijgewerkt"), F.col("ts").alias("feed_updated"),
                          F.col("event_id").alias("_row_id"), (F.col("event_type") == "error").alias("verwijderd"), refs.alias("deel"))
    parts = t.part.where("p_size > 10").select(F.col("p_partkey").cast("string").alias("id"))
    return conform_bridge(log, {"deel": parts}, BridgeSpec("b", "eigenaar", "deel", "eigenaar_id", {"deel_id": ("ref", "deel")}))


@query("d5_corrections", """
SELECT c_custkey, coalesce(nullif(round(c_acctbal, 0), 1000 * round(c_acctbal / 1000, 0)), s_acctbal) AS c_acctbal, s_suppkey IS NOT NULL AS handmatig
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def corrections(t: Tables):
    rounded = F.round("c_acctbal", 0)
    people = t.customer.select("c_custkey", F.nullif(rounded, 1000 * F.round(F.col("c_acctbal") / 1000, 0)).alias("c_acctbal"))
    fixes = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return apply_corrections(people, fixes, "c_custkey", ["c_acctbal"], "handmatig")


@query("j3_fk_null", """
SELECT o_orderkey, c_custkey AS o_custkey FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey""")
def fk_null(t: Tables):
    parents = t.customer.where("c_mktsegment <> 'BUILDING'")
    return resolve_fk(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


@query("j3_fk_drop_given", """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS klant FROM orders
WHERE o_orderpriority = '1-URGENT' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def fk_drop_given(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("klant"))
    return resolve_fk(rows, "klant", t.customer.where("c_mktsegment <> 'BUILDING'"), "c_custkey", mode="drop_given")


@query("j4_current_children", f"""
WITH {s.VERSIONS_SQL}, parents AS ({_LATEST})
SELECT event_id AS kind_id, id AS ouder_id FROM events e JOIN parents p ON e.event_id - e.event_id % 3 = p._row_id WHERE NOT p.verwijderd""")
def children(t: Tables):
    links = t.events.select(F.col("event_id").alias("kind_id"), (F.col("event_id") - F.col("event_id") % 3).alias("_parent_id"))
    return current_children(links, current(s.versions(t))).select("kind_id", "ouder_id")


@query("j5_both_ends", """
SELECT DISTINCT l_orderkey, l_partkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def both_ends(t: Tables):
    pairs = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    kept = resolve_fk(pairs, "l_partkey", t.part.where("p_size > 10"), "p_partkey", mode="drop")
    return resolve_fk(kept, "l_orderkey", t.orders.where("o_orderstatus <> 'P'"), "o_orderkey", mode="drop")
