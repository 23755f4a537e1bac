"""Contracts, constraint checks and profiles."""

from datetime import date

from pyspark.sql import functions as F, types as T

from plenaria.operators import quality as Q
from plenaria.queries import Tables, query
from plenaria.queries import standins as s


@query("q1_contract", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def contract(t: Tables):
    """A frame with columns in another order is put in contract order with its comments."""
    schema = T.StructType([T.StructField("c_custkey", T.LongType(), metadata={"comment": "sleutel"}), T.StructField("c_name", T.StringType()), T.StructField("c_mktsegment", T.StringType())])
    return Q.enforce_contract(t.customer.select("c_mktsegment", "c_custkey", "c_name"), schema)


@query("q1_metadata", """
SELECT 1::BIGINT AS volgnummer, 'c_custkey' AS kolom, 'bigint' AS type, 'sleutel' AS toelichting, true AS aanwezig, true AS type_ok, true AS metadata_ok, count(*) AS rijen FROM customer
UNION ALL SELECT 2, 'c_name', 'string', 'naam', true, true, false, count(*) FROM customer UNION ALL SELECT 3, 'c_nationkey', 'bigint', 'land', true, false, false, count(*) FROM customer
UNION ALL SELECT 4, 'c_leeg', 'string', NULL, false, false, false, count(*) FROM customer""")
def contract_metadata(t: Tables):
    """What a frame keeps of a contract: one column as declared, one that lost its comment, one of another type and one missing."""
    def field(name, kind, **more):
        return T.StructField(name, kind, metadata=more)

    declared = T.StructType([field("c_custkey", T.LongType(), comment="sleutel", key=True), field("c_name", T.StringType(), comment="naam"),
                             field("c_nationkey", T.LongType(), comment="land", references="nation"), field("c_leeg", T.StringType())])
    rows = Q.enforce_contract(t.customer.select("c_custkey", "c_name"), T.StructType(declared.fields[:2]))
    rows = rows.join(t.customer.select(F.col("c_custkey").alias("k"), "c_nationkey"), F.col("c_custkey") == F.col("k")).withColumn("c_name", F.upper("c_name"))
    return Q.contract_report(rows, declared).withColumn("rijen", rows.agg(F.count(F.lit(1)).alias("n")).scalar())


@query("q2_null_unique", """
SELECT 'not_null:orders.st' AS controle, count(*) FILTER (WHERE o_orderstatus = 'P') AS fouten, count(*) FILTER (WHERE o_orderstatus = 'P') = 0 AS ok FROM orders
UNION ALL SELECT 'unique:orders.o_orderkey', count(*), count(*) = 0 FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique:orders.o_custkey', count(*), count(*) = 0 FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def null_unique(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"))
    return Q.run_checks({"orders": rows}, [Q.Check("orders", "not_null", ("st",)), Q.Check("orders", "unique", ("o_orderkey",)), Q.Check("orders", "unique", ("o_custkey",))])


@query("q3_orphans", """
SELECT 'relationship:orders.o_custkey' AS controle, count(*) AS fouten, count(*) = 0 AS ok FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
UNION ALL SELECT 'relationship:lineitem.l_orderkey', count(*), count(*) = 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def orphan_counts(t: Tables):
    tables = {"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer.where("c_mktsegment <> 'BUILDING'")}
    return Q.run_checks(tables, [Q.Check("orders", "relationship", ("o_custkey",), parent="customer", parent_key="c_custkey"),
                                 Q.Check("lineitem", "relationship", ("l_orderkey",), parent="orders", parent_key="o_orderkey")])


@query("q4_accepted", """
SELECT 'accepted:orders.o_orderstatus' AS controle, count(*) AS fouten, count(*) = 0 AS ok FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'accepted:orders.o_orderpriority', count(*), count(*) = 0 FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""")
def accepted(t: Tables):
    return Q.run_checks({"orders": t.orders}, [
        Q.Check("orders", "accepted", ("o_orderstatus",), values=("F", "O")),
        Q.Check("orders", "accepted", ("o_orderpriority",), values=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))])


@query("q5_pk_dups", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS aantal FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t: Tables):
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q6_check_report", """
SELECT 'klanten zonder order' AS naam, count(*) AS werkelijk, CAST(0 AS BIGINT) AS verwacht, count(*) = 0 AS ok FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'regio', count(*), 5, count(*) = 5 FROM region""")
def report(t: Tables):
    from plenaria.sources.files import catalog_counts

    found = catalog_counts({"klanten zonder order": t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti"), "regio": t.region})
    return Q.expected_counts(found.select(F.col("tabel").alias("naam"), F.col("rijen").alias("werkelijk")), {"klanten zonder order": 0, "regio": 5})


@query("q7_anomalies", f"""WITH {s.MEMBERS_SQL}
SELECT 'einde_voor_start' AS controle, count(*) FILTER (WHERE tot_en_met < van) AS aantal FROM members UNION ALL SELECT 'na_peildatum', count(*) FILTER (WHERE van > DATE '1998-06-01') FROM members
UNION ALL SELECT 'nog_open', count(*) FILTER (WHERE tot_en_met IS NULL) FROM members UNION ALL SELECT 'geen_guid', count(*) FILTER (WHERE NOT regexp_full_match(fractie, '[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}')) FROM members""")
def anomalies(t: Tables):
    guid = F.col("fractie").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return Q.anomalies(s.members(t), {"einde_voor_start": F.col("tot_en_met") < F.col("van"), "na_peildatum": F.col("van") > F.lit(date(1998, 6, 1)),
                                      "nog_open": F.col("tot_en_met").isNull(), "geen_guid": ~guid})


@query("q8_profile", " UNION ALL ".join(f"""
SELECT '{c}' AS kolom, count(*) AS n, count(*) - count({c}) AS leeg, {p} AS placeholder, count(DISTINCT {c}) AS uniek, round(100.0 * (count({c}) - {p}) / count(*), 1) AS pct_gevuld FROM d"""
    .replace("FROM d", "FROM (SELECT doc_id, lang, CASE WHEN lang = 'en' THEN '-' WHEN lang <> 'de' THEN source END AS bron, quality FROM documents LEFT JOIN labels USING (doc_id))")
    for c, p in (("doc_id", "0"), ("lang", "0"), ("bron", "count(*) FILTER (WHERE bron = '-')"), ("quality", "0"))))
def profiled(t: Tables):
    source = F.when(F.col("lang") == "en", "-").when(F.col("lang") != "de", F.col("source"))
    rows = t.documents.select("doc_id", "lang", source.alias("bron")).join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return Q.profile(rows)


@query("q9_dominant", """
SELECT 'dag' AS kolom, dag AS waarde, aantal, round(100.0 * aantal / (SELECT count(*) FROM events), 1) AS aandeel, aantal >= 0.8 * (SELECT count(*) FROM events) AS dominant
FROM (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'massa' ELSE event_type END AS dag, count(*) AS aantal FROM events GROUP BY 1) ORDER BY aantal DESC, dag LIMIT 1""")
def dominant(t: Tables):
    kind = F.when(F.col("event_type").isin("view", "click"), "massa").otherwise(F.col("event_type"))
    return Q.dominant_value(t.events.select(kind.alias("dag")), "dag")


@query("q10_dup_candidates", """
SELECT md5(text) AS tekst, lang, count(DISTINCT doc_id) AS aantal, min(doc_id) AS eerste, max(doc_id) AS laatste FROM documents GROUP BY text, lang HAVING count(DISTINCT doc_id) > 1""")
def duplicates(t: Tables):
    found = Q.duplicate_candidates(t.documents, ["text", "lang"], "doc_id")
    return found.select(F.md5("text").alias("tekst"), "lang", "aantal", "eerste", "laatste")


@query("q11_unique_guard", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def guarded(t: Tables):
    """A lookup join behind a check that its right-hand key is unique."""
    people = Q.assert_unique(t.customer.select("c_custkey", "c_name"), ["c_custkey"])
    return t.orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("q12_ambiguous", "SELECT p_name, count(DISTINCT p_brand) AS aantal FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def ambiguous(t: Tables):
    return Q.ambiguous_keys(t.part, "p_name", "p_brand")


@query("q12_alias_targets", """
SELECT DISTINCT p_name AS doel FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_type = 'ECONOMY' AND p_size > 45)""")
def alias_targets(t: Tables):
    """Alias targets (part names) that a smaller lookup does not know."""
    known = t.part.where("p_type = 'ECONOMY' AND p_size > 45").select(F.col("p_name").alias("k"))
    return t.part.select(F.col("p_name").alias("doel")).distinct().join(known, F.col("doel") == F.col("k"), "left_anti")
