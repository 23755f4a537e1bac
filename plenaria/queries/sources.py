"""Sources, sinks and relations."""

from pyspark.sql import functions as F

from plenaria.functions.text import normalize_bool, resource_url, snake_case
from plenaria.queries import TABLE_NAMES, Tables, query
from plenaria.session import scratch_path
from plenaria.sources import feed, files

_PAGE = 100
_CURSOR = 2500


@query("s1_feed_cursor", f"""
SELECT event_id, event_type, event_id // {_PAGE} AS pagina FROM events
WHERE (event_id // {_PAGE} + 1) * {_PAGE} > {_CURSOR} AND event_id // {_PAGE} IN (
  SELECT DISTINCT event_id // {_PAGE} AS p FROM events WHERE (event_id // {_PAGE} + 1) * {_PAGE} > {_CURSOR} ORDER BY p LIMIT 20)""")
def feed_cursor(t: Tables):
    """Events as pages of 100; reads 20 pages past a cursor (the page limit is the feature)."""
    page = F.floor(F.col("event_id") / _PAGE)
    entry = F.struct("event_id", "event_type")
    pages = t.events.groupBy(page.alias("pagina")).agg(F.collect_list(entry).alias("entry"))
    pages = pages.withColumn("token", (F.col("pagina") + 1) * _PAGE)
    return (feed.select_pages(pages, cursor=_CURSOR, max_pages=20)
            .select("pagina", F.explode("entry").alias("e")).select("e.event_id", "e.event_type", "pagina"))


@query("s2_xml_decode", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment = 'BUILDING' AS verwijderd, c_name AS naam, CAST(c_nationkey AS BIGINT) AS land FROM customer")
def xml_decode(t: Tables):
    """Customers written as XML elements and decoded with a declared schema, failing on bad rows."""
    text = F.to_xml(F.struct(
        F.col("c_custkey").alias("_id"), F.when(F.col("c_mktsegment") == "BUILDING", "True").otherwise("False").alias("_verwijderd"),
        F.col("c_name").alias("naam"), F.col("c_nationkey").alias("land")), {"rowTag": "klant"})
    decoded = F.from_xml(text, "_id string, _verwijderd string, naam string, land int", {"mode": "FAILFAST"})
    rows = t.customer.select(decoded.alias("x")).select("x.*").select(
        F.col("_id").alias("ns1:id"), F.col("_verwijderd").alias("@verwijderd"), F.col("naam").alias("ns1:naam"), "land", F.lit("x").alias("@xmlns:ns1"))
    return feed.clean_names(rows).withColumn("verwijderd", normalize_bool(F.col("verwijderd")))


@query("s4_normalize_bool", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS verwijderd FROM orders""")
def bool_text(t: Tables):
    text = F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "False").otherwise("maybe")
    return t.orders.select("o_orderkey", normalize_bool(text).alias("verwijderd"))


@query("s5_snake_case", r"""
SELECT lower(regexp_replace(regexp_replace(c, '(.)([A-Z][a-z]+)', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS tabel, count(*) AS rijen
FROM (SELECT upper(p_name[1]) || lower(split_part(p_name, ' ', 1)[2:]) || upper(split_part(p_name, ' ', 2)[1]) || lower(split_part(p_name, ' ', 2)[2:])
  || upper(p_type[1]) || lower(p_type[2:]) AS c FROM part) GROUP BY 1""")
def routed(t: Tables):
    name = F.concat(F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.initcap(F.lower("p_type")))
    return feed.route(t.part.select(name.alias("category"))).groupBy("tabel").agg(F.count(F.lit(1)).alias("rijen"))


@query("s6_split_children", """
SELECT doc_id AS ouder, CAST(i - 1 AS BIGINT) AS idx, regels[i] AS waarde FROM (SELECT doc_id, regels, unnest(range(1, len(regels) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS regels FROM documents))""")
def children(t: Tables):
    """The lines of a document as its repeated element."""
    nested = t.documents.select("doc_id", F.split("text", "\n").alias("regels"))
    return files.split_children(nested, "doc_id", "regels", "waarde").select(
        F.col("_parent_id").alias("ouder"), F.col("_list_idx").alias("idx"), "waarde")


@query("s7_page_links", r"""
SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages""")
def page_links(t: Tables):
    links = t.pages.select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)).alias("links"))
    return files.relation(links, "page_id", "links", None, "href", "page_id")


@query("s8_row_id", "SELECT count(*) AS rijen, count(DISTINCT event_id) AS ids, CAST(64 AS BIGINT) AS lengte, count(*) AS zelfde FROM events")
def row_ids(t: Tables):
    """Appends events to a log and reads them back: ids are complete, distinct and repeatable."""
    path = scratch_path(t.spark, "s8-log")
    rows = feed.route(t.events.select("event_id", "user_id", "value", F.initcap("event_type").alias("category")))
    feed.append_log(rows, path, "load-1")
    again = rows.select(feed.row_id(rows).alias("_again"))
    log = t.spark.read.parquet(path)
    found = log.join(again, F.col("_row_id") == F.col("_again"), "left_semi").agg(F.count(F.lit(1)).alias("zelfde"))
    return log.agg(F.count(F.lit(1)).alias("rijen"), F.countDistinct("_row_id").alias("ids"), F.max(F.length("_row_id")).alias("lengte")).select(
        "*", found.scalar().alias("zelfde"))


@query("s9_csv_roundtrip", "SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(t: Tables):
    path = scratch_path(t.spark, "s9-csv")
    files.write_csv(t.customer, path)
    return files.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_nationkey string, c_acctbal double, c_mktsegment string")


@query("s11_release_manifest", """
SELECT CAST(2 AS BIGINT) AS release, 'orders' AS tabel, count(*) AS rijen FROM orders
UNION ALL SELECT 2, 'klanten', count(*) FROM customer WHERE c_acctbal > 0""")
def release(t: Tables):
    """Publishes two releases; readers see all tables of the newest one."""
    root = scratch_path(t.spark, "s11-release")
    files.publish({"orders": t.orders, "klanten": t.customer}, root, 1)
    files.publish({"orders": t.orders, "klanten": t.customer.where("c_acctbal > 0")}, root, 2)
    return files.manifest(t.spark, root).select("release", "tabel", "rijen")


@query("s11_republish", """
SELECT CAST(1 AS BIGINT) AS release, 'orders' AS tabel, count(*) AS rijen, count(*) FILTER (WHERE o_orderstatus = 'F') AS gelezen, true AS geweigerd FROM orders""")
def republish(t: Tables):
    """A number that is published again is refused, and a reader that follows it reads on undisturbed."""
    root = scratch_path(t.spark, "s11-again")
    files.publish({"orders": t.orders}, root, 1)
    reader = files.read_release(t.spark, root)["orders"].where("o_orderstatus = 'F'")
    try:
        files.publish({"orders": t.orders.limit(1)}, root, 1)
        refused = False
    except ValueError:
        refused = True
    read = reader.agg(F.count(F.lit(1)).alias("n")).scalar()
    return files.manifest(t.spark, root).select("release", "tabel", "rijen", read.alias("gelezen"), F.lit(refused).alias("geweigerd"))


@query("s12_explode_relation", """
SELECT doc_id AS parent_id, unnest(string_split(text, ' ')) AS woord FROM documents WHERE lang <> 'en'""")
def relation_pairs(t: Tables):
    """The words of a document as its relation; documents in English count as deleted."""
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("id")))
    owners = t.documents.select("doc_id", (F.col("lang") == "en").alias("verwijderd"), words.alias("woorden"))
    return files.relation(owners, "doc_id", "woorden", "id", "woord", deleted="verwijderd")


@query("s13_entity_view", """
SELECT o_orderkey AS "Id", o_orderpriority AS "Soort", CAST(o_orderdate AS DATE) AS "Datum" FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '2-HIGH'""")
def view(t: Tables):
    rows = t.orders.withColumn("verwijderd", F.col("o_orderstatus") == "P").withColumn("datum", F.col("o_orderdate").cast("date"))
    return files.entity_view(rows, {"o_orderkey": "Id", "o_orderpriority": "Soort", "datum": "Datum"}, where=F.col("o_orderpriority") == "2-HIGH")


@query("s14_resource_url", """
SELECT doc_id, CASE WHEN n_chars - 200 > 0 THEN 'https://host/document/' || doc_id || '/resource' END AS url FROM documents""")
def urls(t: Tables):
    return t.documents.select("doc_id", resource_url("https://host/document/", F.col("doc_id"), F.col("n_chars") - 200).alias("url"))


@query("s15_named_batch", """
SELECT 'klanten_per_land' AS naam, CAST(count(DISTINCT c_nationkey) AS BIGINT) AS rijen FROM customer
UNION ALL SELECT 'orders_per_status', count(DISTINCT o_orderstatus) FROM orders""")
def batch(t: Tables):
    definitions = {
        "klanten_per_land": lambda x: x["customer"].groupBy("c_nationkey").count(),
        "orders_per_status": lambda x: x["orders"].groupBy("o_orderstatus").count(),
    }
    paths = files.named_batch(definitions, {"customer": t.customer, "orders": t.orders}, scratch_path(t.spark, "s15-batch"))
    return files.catalog_counts({n: t.spark.read.parquet(p) for n, p in paths.items()}).withColumnRenamed("tabel", "naam")


@query("s16_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS tabel, count(*) AS rijen FROM {n}" for n in TABLE_NAMES))
def row_counts(t: Tables):
    return files.catalog_counts({n: getattr(t, n) for n in TABLE_NAMES})


@query("s5_category_names", "SELECT DISTINCT lower(event_type) || '_' || 'entity' AS tabel FROM events")
def category_names(t: Tables):
    return t.events.select(snake_case(F.concat(F.initcap("event_type"), F.lit("Entity"))).alias("tabel")).distinct()
