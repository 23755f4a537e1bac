"""Projections and scalar functions."""

from pyspark.sql import functions as F

from plenaria.functions import numbers as N
from plenaria.functions import text as T
from plenaria.operators.sampling import distinct_sample, one_in, smallest_hashes
from plenaria.queries import Tables, query
from plenaria.rules.fixed import INCOME_FACTORS


@query("p1_project_cast", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS datum, CAST(round(o_totalprice) AS BIGINT) AS bedrag,
  trim(o_orderpriority) AS prioriteit FROM orders""")
def project_cast(t: Tables):
    return t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").cast("date").alias("datum"),
                           F.round("o_totalprice").cast("bigint").alias("bedrag"), F.trim("o_orderpriority").alias("prioriteit"))


@query("p2_except", "SELECT * EXCLUDE (props, value) FROM events")
def all_but(t: Tables):
    return t.events.drop("props", "value")


@query("p3_case_status", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'afgedaan' WHEN o_orderstatus = 'O' THEN 'open' END AS label,
  CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 'Besloten' WHEN NOT (nullif(o_orderstatus, 'P') = 'F') THEN 'Openbaar' ELSE 'Onbekend' END AS type
FROM orders""")
def case_labels(t: Tables):
    from plenaria.rules.classifiers import openness

    status = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", T.first_match([(status == "F", "afgedaan"), (status == "O", "open")]).alias("label"),
                           openness(F.nullif(status, F.lit("P")) == "F").alias("type"))


@query("p4_try_cast", """
SELECT doc_id, TRY_CAST(split_part(lang || n_chars, 'e', 2) AS BIGINT) AS getal, TRY_CAST(source AS DATE) AS datum FROM documents""")
def safe_cast(t: Tables):
    text = F.split_part(F.concat(F.col("lang"), F.col("n_chars").cast("string")), F.lit("e"), F.lit(2))
    return t.documents.select("doc_id", text.try_cast("bigint").alias("getal"), F.col("source").try_cast("date").alias("datum"))


@query("p5_nulls", """
SELECT d.doc_id, coalesce(CAST(quality AS BIGINT), -1) AS kwaliteit, nullif(lang, 'en') AS taal, coalesce(nullif(source, ''), 'Onbekend') AS bron
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_functions(t: Tables):
    labels = t.labels.select(F.col("doc_id").alias("_d"), "quality")
    joined = t.documents.select("doc_id", "lang", "source").join(labels, F.col("doc_id") == F.col("_d"), "left")
    return joined.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("kwaliteit"), F.nullif(F.col("lang"), F.lit("en")).alias("taal"),
                         F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("Onbekend")).alias("bron"))


@query("p6_concat_ws", """
SELECT c_custkey, trim(concat_ws(' ', coalesce(nullif(c_mktsegment, 'BUILDING'), c_name), CASE WHEN c_acctbal < 0 THEN 'van' END, c_name)) AS naam
FROM customer""")
def names(t: Tables):
    first = F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.col("c_name"))
    return t.customer.select("c_custkey", T.person_name(first, F.when(F.col("c_acctbal") < 0, "van"), F.col("c_name")).alias("naam"))


@query("p7_numeric", """
SELECT p_partkey, round(p_retailprice / 7, 2) AS prijs, greatest(p_size, 10) + 0.0::DOUBLE AS hoogste, CAST(least(p_size, 40) AS BIGINT) AS laagste,
  CAST(p_size // 10 * 10 AS BIGINT) AS decennium FROM part""")
def numeric(t: Tables):
    from plenaria.functions.dates import decade

    size = F.col("p_size")
    return t.part.select("p_partkey", F.round(F.col("p_retailprice") / 7, 2).alias("prijs"), F.greatest(size, F.lit(10)).cast("double").alias("hoogste"),
                         F.least(size, F.lit(40)).alias("laagste"), decade(size).alias("decennium"))


@query("p9_ratio", """
SELECT c_nationkey::BIGINT AS land, round(count(*) / nullif(count(*) FILTER (WHERE c_acctbal < 0), 0), 4) AS verhouding FROM customer GROUP BY 1""")
def ratios(t: Tables):
    return t.customer.groupBy(F.col("c_nationkey").alias("land")).agg(
        N.ratio(F.count(F.lit(1)), F.count(F.when(F.col("c_acctbal") < 0, 1)), 4).alias("verhouding"))


@query("p11_flags", """
SELECT o_orderkey, o_orderstatus = 'F' AS is_klaar, o_totalprice > 100000 AND o_orderpriority = '1-URGENT' AS is_groot,
  nullif(o_orderstatus, 'P') IS NOT NULL AS heeft_status FROM orders""")
def flags(t: Tables):
    return t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_klaar"),
                           ((F.col("o_totalprice") > 100000) & (F.col("o_orderpriority") == "1-URGENT")).alias("is_groot"),
                           F.nullif(F.col("o_orderstatus"), F.lit("P")).isNotNull().alias("heeft_status"))


_FREQUENCY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Per maand' WHEN '2-HIGH' THEN 'Per dag' WHEN '3-MEDIUM' THEN 'Vrije invoer' ELSE 'Per jaar' END"""


@query("p12_annualise", f"""
SELECT o_orderkey, o_totalprice * CASE WHEN lower(f) LIKE '%maand%' THEN 12 WHEN lower(f) LIKE '%dag%' OR lower(f) LIKE '%Vrije invoer%' THEN 4 ELSE 1 END AS bedrag
FROM (SELECT *, {_FREQUENCY} AS f FROM orders)""")
def annual(t: Tables):
    names = {"1-URGENT": "Per maand", "2-HIGH": "Per dag", "3-MEDIUM": "Vrije invoer"}
    frequency = T.map_values(F.col("o_orderpriority"), names, "Per jaar")
    return t.orders.select("o_orderkey", N.annualise(F.col("o_totalprice"), frequency, INCOME_FACTORS).alias("bedrag"))


@query("p13_cut_bins", """
SELECT CASE WHEN d > -1 AND d <= 30 THEN '1. < 1 mnd' WHEN d > 30 AND d <= 182 THEN '2. 1-6 mnd' WHEN d > 182 AND d <= 365 THEN '3. 6-12 mnd'
  WHEN d > 365 AND d <= 1826 THEN '4. 1-5 jaar' WHEN d > 1826 AND d <= 100000 THEN '5. > 5 jaar' END AS klasse, count(*) AS aantal
FROM (SELECT date_diff('day', o_orderdate, l_shipdate) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""")
def cut_bins(t: Tables):
    from plenaria.functions.dates import days_between
    from plenaria.rules.fixed import LIFESPAN_EDGES, LIFESPAN_LABELS

    joined = t.lineitem.select("l_orderkey", "l_shipdate").join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = joined.select(days_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("d"))
    return days.groupBy(N.cut(F.col("d"), LIFESPAN_EDGES, LIFESPAN_LABELS).alias("klasse")).agg(F.count(F.lit(1)).alias("aantal"))


@query("p13_hist", "SELECT CAST(floor(l_extendedprice / 10000) * 10000 AS BIGINT) AS vanaf, count(*) AS aantal FROM lineitem GROUP BY 1")
def histogram(t: Tables):
    return t.lineitem.groupBy(N.fixed_bin(F.col("l_extendedprice"), 10000).cast("bigint").alias("vanaf")).agg(F.count(F.lit(1)).alias("aantal"))


@query("p14_hash_sample", "SELECT * FROM orders WHERE CAST('0x' || md5(CAST(o_orderkey AS VARCHAR))[1:8] AS BIGINT) % 50 = 0")
def hash_sample(t: Tables):
    """One in fifty orders by key hash (the sample is the feature)."""
    return one_in(t.orders, F.col("o_orderkey"), 50)


@query("p14_mod_sample", """
SELECT doc_id, source FROM documents WHERE CAST('0x' || md5(CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) % 5 = 0""")
def md5_sample(t: Tables):
    return one_in(t.documents.select("doc_id", "source"), F.col("doc_id"), 5)


@query("p15_review_sample", "SELECT p_name, p_type FROM (SELECT DISTINCT p_name, p_type FROM part) ORDER BY md5('1:' || p_name || ':' || p_type), p_name, p_type LIMIT 50")
def review_sample(t: Tables):
    """Fifty distinct part descriptions in seeded random order (the sample is the feature)."""
    return distinct_sample(t.part, ["p_name", "p_type"], 50, seed=1)


@query("p15_smallest_hashes", "SELECT * FROM orders ORDER BY md5('0:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 500")
def dossier_sample(t: Tables):
    return smallest_hashes(t.orders, F.col("o_orderkey"), 500)


@query("p16_substring", """
SELECT p_partkey, p_name[1:5] AS kort, left(replace(p_brand, 'Brand#', ''), 40) AS merk, CAST(strftime(DATE '2000-01-01' + p_size, '%Y-%m-%d')[1:4] AS BIGINT) AS jaar FROM part""")
def substrings(t: Tables):
    text = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd")
    return t.part.select("p_partkey", F.substring("p_name", 1, 5).alias("kort"),
                         F.substring(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")), 1, 40).alias("merk"),
                         F.substring(text, 1, 4).cast("int").alias("jaar"))
