"""Increments, merges, cascades and streams."""

from pyspark.sql import Column, Window, functions as F

from plenaria.operators import merge as M
from plenaria.operators.versioned import feed_order, latest_version
from plenaria.queries import Tables, query
from plenaria.queries import standins as s
from plenaria.session import scratch_path
from plenaria.streaming import jobs

_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@query("k1_stream_append", _EVENTS)
def stream_append(t: Tables):
    """Events landed as several files and streamed into a sink in two resumed runs."""
    root = scratch_path(t.spark, "k1")
    hours = t.events.withColumn("h", F.hour("ts") % 4)
    hours.where("h < 2").drop("h").repartition(2).write.mode("append").parquet(f"{root}/landed")
    jobs.stream_append(t.spark, f"{root}/landed", t.events.schema, f"{root}/sink", f"{root}/cursor").awaitTermination()
    hours.where("h >= 2").drop("h").repartition(2).write.mode("append").parquet(f"{root}/landed")
    jobs.stream_append(t.spark, f"{root}/landed", t.events.schema, f"{root}/sink", f"{root}/cursor").awaitTermination()
    return t.spark.read.parquet(f"{root}/sink")


@query("k1_feed_stream", """
SELECT 'zaal' AS tabel, CAST(n_nationkey AS VARCHAR) AS id, n_name AS naam FROM nation WHERE n_regionkey <> 0
UNION ALL SELECT 'zaal', 'c' || c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def feed_stream(t: Tables):
    """Rooms written as feed pages in XML, streamed into the version log, then conformed."""
    from plenaria.plans.catalog import ENTITIES
    from plenaria.plans.conform import conform_entity
    from plenaria.sources import feed

    root = scratch_path(t.spark, "k1-feed")
    # pages hold at most 100 rooms
    rooms = (t.nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("naam"), (F.col("n_regionkey") == 0).alias("weg"), F.lit(0).cast("bigint").alias("p"))
             .unionByName(t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("naam"),
                                            (F.col("c_mktsegment") == "BUILDING").alias("weg"), (F.floor(F.col("c_custkey") / 100) + 1).alias("p"))))
    # an older live version of every room, and a newer one that may be deleted
    both = rooms.withColumn("versie", F.explode(F.array(F.lit(1), F.lit(2))))
    stamp = F.concat(F.lit("2024-01-0"), F.col("versie").cast("string"), F.lit("T00:00:00Z"))
    flag = F.when(F.col("weg") & (F.col("versie") == 2), "True").otherwise("False")
    entry = F.struct(
        F.concat(F.lit("urn:"), F.col("id")).alias("id"), F.lit("Zaal").alias("title"), stamp.alias("updated"), F.struct(F.lit("Zaal").alias("_term")).alias("category"),
        F.struct(F.struct(F.col("id").alias("_id"), flag.alias("_verwijderd"), stamp.alias("_bijgewerkt"), F.col("naam")).alias("zaal")).alias("content"))
    page = (both.groupBy("p", "versie").agg(F.collect_list(entry).alias("entry"))
            .select(F.struct(F.array(F.struct(F.lit("next").alias("_rel"), F.concat(F.lit("https://host/Feed?skiptoken="), (F.col("p") * 2 + F.col("versie")).cast("string")).alias("_href"))).alias("link"), "entry").alias("feed")))
    page.select(F.to_xml("feed", {"rowTag": "feed"}).alias("value")).write.option("maxRecordsPerFile", 1).text(f"{root}/pages")
    jobs.stream_feed(t.spark, f"{root}/pages", f"{root}/log", f"{root}/cursor", entities=("zaal",)).awaitTermination()
    log = feed.entity_log(t.spark.read.parquet(f"{root}/log"), "zaal")
    return conform_entity(log, {}, ENTITIES["zaal"]).select(F.lit("zaal").alias("tabel"), "id", "naam")


#: Page files that a task writes; a file costs more than its rows.
_FILES_A_TASK = 50


def _room_pages(rows, page: str, number: str, stamp: Column, code: Column, key: Column, term: Column, next_token: Column, *others: str):
    """Feed pages in XML, one row each, with the rows of a page as its entries."""
    entry = F.struct(
        F.concat(F.lit("urn:"), F.col(number)).alias("id"), F.lit("Zaal").alias("title"), F.lit("2024-01-01T00:00:00Z").alias("updated"), F.struct(term.alias("_term")).alias("category"),
        F.struct(F.struct(key.alias("_id"), F.lit("False").alias("_verwijderd"), stamp.alias("_bijgewerkt"), F.col(number).cast("string").alias("naam"), code.alias("sysCode")).alias("zaal")).alias("content"))
    pages = rows.groupBy(*others, page).agg(F.collect_list(entry).alias("entry"))
    link = F.array(F.struct(F.lit("next").alias("_rel"), F.concat(F.lit("https://host/Feed?skiptoken="), next_token.cast("string")).alias("_href")))
    return pages.select(*others, page, F.to_xml(F.struct(link.alias("link"), "entry"), {"rowTag": "feed"}).alias("value"))


@query("s1_quarantine", """
WITH e AS (SELECT event_id // 100 AS p, concat_ws('; ', CASE WHEN event_id % 130 = 7 THEN 'category: unknown' ELSE
    concat_ws('; ', CASE WHEN event_id % 77 = 0 THEN 'id: missing' END, CASE WHEN event_id % 50 = 0 THEN 'bijgewerkt: no timestamp' END, CASE WHEN event_id % 91 = 0 THEN 'sys_code: no int' END) END) AS r FROM events)
SELECT CASE WHEN r = '' THEN 'zaal' ELSE 'afgekeurd' END AS tabel, nullif(r, '') AS reden, count(*) AS rijen FROM e GROUP BY 1, 2
UNION ALL SELECT 'afgekeurd', 'page: no XML', count(DISTINCT p) FROM e WHERE p % 7 = 3""")
def quarantine(t: Tables):
    """Events as entries of feed pages, some wrong and some pages broken off, streamed into the log in two runs."""
    root, number = scratch_path(t.spark, "s1-quarantine"), F.col("event_id")
    rows = t.events.select("event_id", F.floor(number / 100).alias("p"))
    pages = _room_pages(rows, "p", "event_id", F.when(number % 50 == 0, "geen tijd").otherwise("2024-01-01T00:00:00Z"), F.when(number % 91 == 0, "x").otherwise("5"),
                        F.when(number % 77 != 0, number.cast("string")), F.when(number % 130 == 7, "Raar").otherwise("Zaal"), F.col("p") + 1)
    broken = F.when(F.col("p") % 7 == 3, F.regexp_replace("value", "</feed>$", "<entry>")).otherwise(F.col("value"))
    writers = rows.select("p").distinct().count() // _FILES_A_TASK + 1
    for rest in (0, 1):
        pages.where(F.col("p") % 2 == rest).repartition(writers, "p").select(broken.alias("value")).write.option("maxRecordsPerFile", 1).mode("append").text(f"{root}/pages")
        jobs.stream_feed(t.spark, f"{root}/pages", f"{root}/log", f"{root}/cursor", strict=False, entities=("zaal",)).awaitTermination()
    return t.spark.read.parquet(f"{root}/log").groupBy("tabel", F.col("reason").alias("reden")).agg(F.count(F.lit(1)).alias("rijen"))


@query("s1_source_resume", """
WITH p AS (SELECT event_type, event_id // 1000 AS p, row_number() OVER (PARTITION BY event_type ORDER BY event_id // 1000) AS n FROM events GROUP BY 1, 2)
SELECT e.event_type AS categorie, event_id::VARCHAR AS id, CASE WHEN n <= 3 THEN 'eerste' ELSE 'tweede' END AS lading FROM events e JOIN p ON p.event_type = e.event_type AND p.p = e.event_id // 1000""")
def source_resume(t: Tables):
    """Events as a feed of a chain of pages per category: a run of three pages each, and one that goes on from there."""
    root, number = scratch_path(t.spark, "s1-source").replace("file:///", "/").replace("file:/", "/"), F.col("event_id")
    order = Window.partitionBy("event_type").orderBy("p")
    chain = t.events.select("event_type", F.floor(number / 1000).alias("p")).distinct().select(
        "event_type", "p", F.lag("p").over(order).alias("own"), F.coalesce(F.lead("p").over(order), F.col("p")).alias("onward"))
    # a page is asked for with the token that the page before names, and names its own number to go on
    rows = t.events.withColumn("p", F.floor(number / 1000)).join(chain, ["event_type", "p"]).withColumn("token", F.when(F.col("own").isNull(), -1).otherwise(F.col("p")))
    pages = _room_pages(rows, "onward", "event_id", F.lit("2024-01-01T00:00:00Z"), F.lit("5"), F.concat_ws(":", "event_type", number.cast("string")), F.lit("Zaal"),
                        F.col("onward"), "event_type", "token")
    writers = chain.count() // _FILES_A_TASK + 1
    pages.select("value", "event_type", "token").repartition(writers, "event_type", "token").write.partitionBy("event_type", "token").text(f"file://{root}/pages")
    categories = [r[0] for r in t.events.select("event_type").distinct().orderBy("event_type").collect()]
    folder = f"file://{root}/pages/event_type={{category}}"
    options = {"url": folder + "/token={token}/part-*", "first_url": folder + "/token=-1/part-*", "categories": ",".join(categories)}
    for load, pages_a_run in (("eerste", 3), ("tweede", 1_000_000)):
        jobs.stream_source(t.spark, {**options, "pages": str(pages_a_run)}, f"{root}/log", f"{root}/cursor", entities=("zaal",), load_id=load).awaitTermination()
    key = F.split(F.col("content.zaal.id"), ":")
    return t.spark.read.parquet(f"{root}/log").select(key[0].alias("categorie"), key[1].alias("id"), F.col("_load_id").alias("lading"))


@query("k2_high_water", """
SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'purchase' AND value < 20)""")
def high_water(t: Tables):
    target = t.events.where("event_type = 'purchase' AND value < 20").select("ts")
    return M.increment(t.events.select("event_id", "ts"), target, "ts").select("event_id")


@query("k3_retrigger", """
WITH m AS (SELECT max(o_orderdate) AS m FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < DATE '1998-01-01')
SELECT o_orderkey FROM orders, m WHERE o_orderdate > m OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate > m)""")
def retrigger(t: Tables):
    target = t.orders.where("o_orderstatus = 'F' AND o_orderdate < DATE '1998-01-01'").select("o_orderdate")
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return M.retrigger(rows, target, "o_orderdate", "o_orderkey", t.lineitem, "l_orderkey", "l_shipdate").select("o_orderkey")


_SOURCE = "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS st, o_totalprice FROM orders WHERE o_orderdate >= DATE '1996-01-01'"
_TARGET = "SELECT o_orderkey, o_orderstatus AS st, o_totalprice FROM orders WHERE o_orderdate < DATE '1998-01-01'"


def _merge_sides(t: Tables):
    target = t.orders.where("o_orderdate < DATE '1998-01-01'").select("o_orderkey", F.col("o_orderstatus").alias("st"), "o_totalprice")
    status = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus"))
    return target, t.orders.where("o_orderdate >= DATE '1996-01-01'").select("o_orderkey", status.alias("st"), "o_totalprice")


@query("k4_merge", f"""WITH s AS ({_SOURCE}), t AS ({_TARGET}), d AS (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)
SELECT o_orderkey, st, o_totalprice, CASE WHEN o_orderkey NOT IN (SELECT o_orderkey FROM t) THEN 'new' WHEN EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey AND t.st IS DISTINCT FROM s.st) THEN 'changed' ELSE 'same' END AS wat
FROM s WHERE o_orderkey NOT IN (SELECT l_orderkey FROM d)
UNION ALL SELECT o_orderkey, st, o_totalprice, 'same' FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) AND o_orderkey NOT IN (SELECT l_orderkey FROM d)""")
def merge(t: Tables):
    target, source = _merge_sides(t)
    deleted = t.lineitem.where("l_quantity = 50").select(F.col("l_orderkey").alias("o_orderkey"))
    return M.merge_versions(target, source, ["o_orderkey"], deleted, status="wat")


@query("k4_merge_delete_missing", _SOURCE)
def merge_missing(t: Tables):
    target, source = _merge_sides(t)
    return M.merge_versions(target, source, ["o_orderkey"], delete_missing=True)


@query("k5_cascade", """
WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1), c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT * FROM n)),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT * FROM c)), s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT * FROM n))
SELECT 'customer' AS tabel, count(*) AS rijen FROM customer WHERE c_custkey NOT IN (SELECT * FROM c) UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT * FROM o) AND l_suppkey NOT IN (SELECT * FROM s)
UNION ALL SELECT 'nation', count(*) FROM nation WHERE n_nationkey NOT IN (SELECT * FROM n) UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT * FROM o)
UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT * FROM s)""")
def cascade(t: Tables):
    """Nations of one region are deleted with all customers, suppliers, orders and lines below."""
    from plenaria.sources.files import catalog_counts

    keys = [M.ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"), M.ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
            M.ForeignKey("orders", "o_custkey", "customer", "c_custkey"), M.ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"), M.ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey")]
    frames = {"nation": t.nation, "customer": t.customer, "supplier": t.supplier, "orders": t.orders.select("o_orderkey", "o_custkey"), "lineitem": t.lineitem.select("l_orderkey", "l_suppkey")}
    left = M.cascade_delete(frames, keys, "nation", t.nation.where("n_regionkey = 1").select("n_nationkey"), "n_nationkey",
                            {"customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey"})
    return catalog_counts(left)


@query("k5_deep_chain", """
WITH RECURSIVE n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 25 <> 0 THEN c_custkey - 1 END AS ouder FROM customer),
gone AS (SELECT k FROM n WHERE k % 100 = 50 UNION SELECT n.k FROM n JOIN gone ON n.ouder = gone.k)
SELECT 'klant' AS tabel, count(*) AS rijen FROM n WHERE k NOT IN (SELECT k FROM gone) UNION ALL SELECT 'order', count(*) FROM orders WHERE o_custkey NOT IN (SELECT k FROM gone)""")
def deep_chain(t: Tables):
    """Customers in chains of 25 that refer to the one before; the first of some chains goes, and all behind it."""
    from plenaria.sources.files import catalog_counts

    number = F.col("c_custkey")
    nodes = t.customer.select(number.alias("k"), F.when(number % 25 != 0, number - 1).alias("ouder"))
    keys = [M.ForeignKey("klant", "ouder", "klant", "k"), M.ForeignKey("order", "o_custkey", "klant", "k")]
    left = M.cascade_delete({"klant": nodes, "order": t.orders.select("o_orderkey", "o_custkey")}, keys, "klant", nodes.where("k % 100 = 50").select("k"), "k", {"order": "o_orderkey"})
    return catalog_counts(left)


@query("k6_stream_latest", f"""WITH {s.VERSIONS_SQL}
SELECT id, _row_id AS row_id, event_type FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY bijgewerkt DESC, _row_id DESC) = 1""")
def stream_latest(t: Tables):
    """Versions arriving out of order in four batches give the same table as one batch run."""
    root = scratch_path(t.spark, "k6")
    rows = s.versions(t).withColumn("_row", F.xxhash64("_row_id"))
    rows.repartition(4, "_row").drop("_row").write.parquet(f"{root}/landed")
    landed = t.spark.read.parquet(f"{root}/landed")
    source = t.spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
    jobs.stream_latest(t.spark, source, f"{root}/table", f"{root}/cursor", ["id"], ["bijgewerkt", "_row_id"], buckets=8).awaitTermination()
    return jobs.current_version(t.spark, f"{root}/table").select("id", F.col("_row_id").alias("row_id"), "event_type")


@query("k6_late_bucketed", f"""WITH {s.VERSIONS_SQL}
SELECT id, _row_id AS row_id, event_type FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY bijgewerkt DESC, _row_id DESC) = 1""")
def late_bucketed(t: Tables):
    """Newer versions first, older ones in a later run, and a part of them once more: still the newest of each id."""
    root, versions = scratch_path(t.spark, "k6-late"), s.versions(t)
    number = F.pmod(F.xxhash64("_row_id"), F.lit(10))
    parts = [versions.where(F.month("bijgewerkt") > 6), versions.where((F.month("bijgewerkt") <= 6) | (number < 3))]
    for part in parts:
        part.repartition(2).write.mode("append").parquet(f"{root}/landed")
        source = t.spark.readStream.schema(versions.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
        jobs.stream_latest(t.spark, source, f"{root}/table", f"{root}/cursor", ["id"], ["bijgewerkt", "_row_id"], buckets=8, repeats_within="2 hours").awaitTermination()
    return jobs.current_version(t.spark, f"{root}/table").select("id", F.col("_row_id").alias("row_id"), "event_type")


@query("k6_batch_latest", f"""WITH {s.VERSIONS_SQL}
SELECT id, bijgewerkt, value FROM versions WHERE event_type <> 'view' QUALIFY row_number() OVER (PARTITION BY id ORDER BY bijgewerkt DESC, _row_id DESC) = 1""")
def batch_latest(t: Tables):
    """A late batch merged into an earlier table: the newest version wins whatever came last."""
    rows = s.versions(t).where("event_type <> 'view'")
    early, late = rows.where("event_type = 'error'"), rows.where("event_type <> 'error'")
    fresh = latest_version(late.unionByName(latest_version(early, ["id"], feed_order())), ["id"], feed_order())
    return M.merge_versions(latest_version(early, ["id"], feed_order()), fresh, ["id"]).select("id", "bijgewerkt", "value")
