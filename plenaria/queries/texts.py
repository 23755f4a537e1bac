"""Text cleaning, keys and classifiers over documents, parts and nations."""

from pyspark.sql import functions as F

from plenaria.functions import text as T
from plenaria.queries import Tables, query
from plenaria.rules import classifiers as C
from plenaria.rules import fixed


@query("x1_ilike", """
SELECT doc_id, text ILIKE '%LICENSE%' AS licentie, lower(text) LIKE '%und%' AS duits FROM documents""")
def ilike(t: Tables):
    return t.documents.select("doc_id", F.col("text").ilike("%LICENSE%").alias("licentie"), F.contains(F.lower("text"), F.lit("und")).alias("duits"))


@query("x2_like_classifier", """
SELECT p_partkey, CASE WHEN lower(n) LIKE '%ring%' OR lower(n) LIKE '%bolt%' THEN 'Metaal' WHEN lower(n) LIKE '%widget%' OR lower(n) LIKE '%promo%' THEN 'Actie'
  WHEN lower(n) LIKE '%standard%' THEN 'Standaard' ELSE 'Overig' END AS groep FROM (SELECT p_partkey, p_name || ' ' || p_type AS n FROM part)""")
def like_classifier(t: Tables):
    groups = {"Metaal": ("ring", "bolt"), "Actie": ("widget", "promo"), "Standaard": ("standard",)}
    return t.part.select("p_partkey", T.classify_like(F.concat_ws(" ", "p_name", "p_type"), groups, "Overig").alias("groep"))


_TYPES = "CASE WHEN naam LIKE '%interparlementair%' THEN 'Interparlementair' WHEN naam LIKE 'tijdelijke%' OR naam LIKE '%enquête%' THEN 'Tijdelijk' WHEN naam LIKE 'vaste commissie%' THEN 'Vast' ELSE 'Overig' END"
_TYPES2 = "CASE WHEN naam LIKE '%enquête%' OR naam LIKE '%tijdelijke%' THEN 'tijdelijk' WHEN naam LIKE 'vaste commissie%' OR naam LIKE 'algemene commissie%' OR naam LIKE 'commissie voor%' THEN 'vast' WHEN naam LIKE 'delegatie%' OR naam LIKE '%groep%' THEN 'interparlementair' ELSE 'overig' END"


@query("x2_committee_types", f"""
SELECT {_TYPES} AS type, {_TYPES2} AS type2, count(*) AS aantal FROM (SELECT lower(CASE o_orderpriority WHEN '1-URGENT' THEN 'Tijdelijke commissie ' WHEN '2-HIGH' THEN 'Vaste commissie voor '
  WHEN '3-MEDIUM' THEN 'Contactgroep interparlementair ' WHEN '4-NOT SPECIFIED' THEN 'Enquêtecommissie ' ELSE 'Delegatie ' END || o_orderstatus) AS naam FROM orders) GROUP BY 1, 2""")
def committee_types(t: Tables):
    openings = {"1-URGENT": "Tijdelijke commissie ", "2-HIGH": "Vaste commissie voor ", "3-MEDIUM": "Contactgroep interparlementair ", "4-NOT SPECIFIED": "Enquêtecommissie "}
    name = F.concat(T.map_values(F.col("o_orderpriority"), openings, "Delegatie "), F.col("o_orderstatus"))
    return t.orders.groupBy(C.committee_type_star(name).alias("type"), C.committee_type_analysis(name).alias("type2")).agg(F.count(F.lit(1)).alias("aantal"))


# rules whose words occur in the documents; the source column is the fallback
_RULES = [("recht", r"license|copyright"), ("mail", r"[a-z0-9]+@[a-z0-9]+\.[a-z]+"), ("getal", r"[0-9]{4,}"), ("frans", r"ç|ê"), ("duits", r"sch|ü")]
_PLACES = [("web", r"web|crawl"), ("boek", r"book|wiki")]


@query("x3_regex_rules", r"""
SELECT doc_id, coalesce(tekst, plek, 'niet_ingedeeld') AS categorie, CASE WHEN tekst IS NOT NULL THEN 'tekst' WHEN plek IS NOT NULL THEN 'instelling' ELSE 'geen' END AS bron,
  CASE WHEN regexp_matches(c, '([0-9]+ jaar)|stop|http') THEN 'niet_voltooid' ELSE 'voltooid' END AS status
FROM (SELECT doc_id, c, CASE WHEN regexp_matches(c, 'license|copyright') THEN 'recht' WHEN regexp_matches(c, '[a-z0-9]+@[a-z0-9]+\.[a-z]+') THEN 'mail'
    WHEN regexp_matches(c, '[0-9]{4,}') THEN 'getal' WHEN regexp_matches(c, 'ç|ê') THEN 'frans' WHEN regexp_matches(c, 'sch|ü') THEN 'duits' END AS tekst,
    CASE WHEN regexp_matches(s, 'web|crawl') THEN 'web' WHEN regexp_matches(s, 'book|wiki') THEN 'boek' END AS plek
  FROM (SELECT doc_id, replace(replace(lower(text), '.', ''), '"', '') AS c, replace(lower(source), '.', '') AS s FROM documents))""")
def regex_rules(t: Tables):
    level = C.education_level(F.col("text"), F.col("source"), _RULES, _PLACES, r"([0-9]+ jaar)|stop|http")
    return t.documents.select("doc_id", level.alias("x")).select("doc_id", "x.*")


@query("x3_education_rules", r"""
SELECT doc_id, CASE WHEN i % 8 = 0 THEN 'cursus' WHEN i % 8 = 1 THEN 'promotie' WHEN i % 8 = 2 THEN 'hbo' WHEN i % 8 = 3 THEN 'wo' WHEN i % 8 = 4 THEN 'mbo' WHEN i % 8 = 5 THEN 'vo'
  WHEN i % 8 = 6 THEN 'wo' ELSE 'onbekend' END AS categorie, CASE WHEN i % 8 = 6 THEN 'instelling' WHEN i % 8 = 7 THEN 'geen' ELSE 'tekst' END AS bron,
  CASE WHEN i % 8 = 5 THEN 'niet_voltooid' ELSE 'voltooid' END AS status,
  CASE WHEN i % 8 = 6 THEN 'Universiteit van Amsterdam' WHEN i % 8 = 7 THEN NULL ELSE 'Radboud Universiteit' END AS instelling
FROM (SELECT doc_id, doc_id AS i FROM documents)""")
def education_rules(t: Tables):
    """The built-in education rules on texts that hit each step, one per document."""
    i = F.col("doc_id") % 8
    texts = ["Cursus bestuur", "Ph.D. economie", "University of Applied Sciences", "Doctoraal recht", "M.T.S. bouwkunde", "V.W.O. (2 jaar)", "Studie recht", "-"]
    text, place = F.lit(None).cast("string"), F.when(i == 6, "UvA").when(i == 7, "onbekend").otherwise(" Radboud Universiteit ")
    for n, value in enumerate(texts):
        text = F.when(i == n, value).otherwise(text)
    return (t.documents.select("doc_id", C.education_level(text, place).alias("x"), C.canonical_institution(place).alias("instelling"))
            .select("doc_id", "x.*", "instelling"))


@query("x4_regex_guarded", """
SELECT doc_id, CASE WHEN regexp_matches(c, 'kamerlid|license') AND NOT (regexp_matches(f, 'adviseur|assistent') AND NOT regexp_matches(f, 'kamerlid')) THEN 'kamerlidmaatschap'
  WHEN regexp_matches(c, 'assistent') AND regexp_matches(c, 'fractie|partij') THEN 'politiek_ondersteuning' WHEN regexp_matches(c, 'user') THEN 'overheid'
  WHEN regexp_matches(c, '.+') THEN 'overig_onvoldoende_sectorcontext' ELSE 'niet_ingedeeld' END AS sector
FROM (SELECT doc_id, f, f || ' | ' || lower(text) AS c FROM (SELECT doc_id, text,
  CASE lang WHEN 'en' THEN 'assistent fractie' WHEN 'fr' THEN 'kamerlid adviseur' WHEN 'de' THEN 'adviseur' ELSE 'user' END AS f FROM documents))""")
def guarded_rules(t: Tables):
    """Sector rules with both exceptions: context for support staff, staff is no member."""
    rules = [("kamerlidmaatschap", "kamerlid|license"), ("politiek_ondersteuning", "assistent"), ("overheid", "user"), ("overig_onvoldoende_sectorcontext", ".+")]
    job = T.map_values(F.col("lang"), {"en": "assistent fractie", "fr": "kamerlid adviseur", "de": "adviseur"}, "user")
    return t.documents.select("doc_id", C.career_sector(job, F.col("text"), rules).alias("sector"))


@query("x5_canonical", """
SELECT n_nationkey::BIGINT AS n_nationkey, CASE WHEN regexp_matches(lower(n_name), 'nation_1') THEN 'Eerste' WHEN regexp_matches(lower(n_name), 'nation_2') THEN 'Tweede' ELSE trim(n_name) END AS naam FROM nation""")
def canonical(t: Tables):
    rules = [T.Rule("Eerste", "nation_1"), T.Rule("Tweede", "nation_2")]
    return t.nation.select("n_nationkey", T.classify(T.clean_text(F.col("n_name")), rules, F.trim("n_name")).alias("naam"))


@query("x6_clean_text", r"""
SELECT doc_id, md5(trim(regexp_replace(replace(replace(lower(text), '.', ''), '"', ''), '[\s\x0b\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) AS schoon FROM documents""")
def cleaned(t: Tables):
    return t.documents.select("doc_id", F.md5(T.clean_text(F.col("text"))).alias("schoon"))


@query("x7_fold_key", r"""
SELECT doc_id, md5(regexp_replace(strip_accents(lower(text)), '[^\x00-\x7F]+', '', 'g')) AS gevouwen FROM documents""")
def folded(t: Tables):
    return t.documents.select("doc_id", F.md5(T.fold_ascii(F.col("text"))).alias("gevouwen"))


@query("x7_place_key", r"""
SELECT sleutel, count(*) AS aantal FROM (SELECT nullif(trim(regexp_replace(regexp_replace(strip_accents(lower(w)), '[^\x00-\x7F]+', '', 'g'), '[^a-z0-9]+', ' ', 'g')), '') AS sleutel
  FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
  WHERE trim(regexp_replace(replace(replace(lower(w), '.', ''), '"', ''), '\s+', ' ', 'g')) NOT IN ('', '-', 'onbekend', 'n.v.t.', 'nan', 'none', 'geen opgave', 'geen') AND w NOT LIKE '%(%') GROUP BY 1""")
def place_keys(t: Tables):
    """Words are counted first, so each different word is looked at once."""
    words = t.documents.select(F.explode(F.split("text", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("_n"))
    kept = words.where(~T.is_placeholder(T.clean_text(F.col("w"))) & ~F.contains(F.col("w"), F.lit("(")))
    return kept.groupBy(T.place_key(F.col("w")).alias("sleutel")).agg(F.sum("_n").alias("aantal"))


@query("x8_alias", """
SELECT p_partkey, CASE split_part(p_name, ' ', 2) WHEN 'ring' THEN 'bolt' WHEN 'widget' THEN 'gadget' ELSE split_part(p_name, ' ', 2) END AS sleutel FROM part""")
def aliases(t: Tables):
    word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    return t.part.select("p_partkey", T.map_values(word, {"ring": "bolt", "widget": "gadget"}).alias("sleutel"))


@query("x9_label_map", """
SELECT groep, count(*) AS aantal FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Motie' WHEN '2-HIGH' THEN 'Brief' WHEN '3-MEDIUM' THEN 'Verslag overleg' ELSE 'Overig' END AS groep FROM orders) GROUP BY 1""")
def label_map(t: Tables):
    kinds = {"1-URGENT": "Motie (gewijzigd/nader)", "2-HIGH": " Brief regering", "3-MEDIUM": "Verslag van een notaoverleg"}
    kind = T.map_values(F.col("o_orderpriority"), kinds, "iets anders")
    return t.orders.groupBy(C.document_group(kind).alias("groep")).agg(F.count(F.lit(1)).alias("aantal"))


@query("x10_normalise", """
SELECT n_nationkey::BIGINT AS n_nationkey, CASE WHEN n_name IN ('NATION_1', 'NATION_2', 'NATION_3') THEN 'PRO' ELSE n_name END AS norm,
  CASE WHEN n_regionkey = 0 THEN 'PRO' WHEN n_regionkey = 1 THEN 'CDA' ELSE 'SP' END AS fractie,
  CASE WHEN n_regionkey = 0 THEN 'GroenLinks / Progressief Nederland' ELSE n_name END AS naam, CASE WHEN n_regionkey < 2 THEN 'X (Twitter)' ELSE n_name END AS kanaal,
  CASE WHEN n_regionkey = 0 THEN 'merged-pro' ELSE n_name END AS sleutel FROM nation""")
def normalised(t: Tables):
    region = F.col("n_regionkey")
    short = F.when(region == 0, "GroenLinks-PvdA").when(region == 1, "CDA").otherwise("SP")
    name = F.when(region == 0, "Fractie GroenLinks-PvdA").otherwise(F.col("n_name"))
    kind = F.when(region == 0, " Twitter").when(region == 1, "x").otherwise(F.col("n_name"))
    return t.nation.select(
        "n_nationkey", C.normalise_faction(F.col("n_name"), ["NATION_1", "NATION_2", "NATION_3"]).alias("norm"), C.normalise_faction(short).alias("fractie"),
        C.normalise_faction_name(name).alias("naam"), C.channel(kind).alias("kanaal"), C.merged_party_key(F.col("n_name"), F.lit(None).cast("string"), short).alias("sleutel"))


@query("x11_extract", """
SELECT doc_id, nullif(regexp_extract(text, '(http[a-z]?)', 1), '') AS gevonden,
  CASE WHEN lang = 'en' THEN 'aangenomen' WHEN lang = 'fr' THEN 'verworpen' END AS uitkomst FROM documents""")
def extracted(t: Tables):
    kind = F.when(F.col("lang") == "en", "Stemmen - aangenomen").when(F.col("lang") == "fr", "verworpen na aangehouden").otherwise("Aangenomen?")
    return t.documents.select("doc_id", T.extract_first(F.col("text"), "(http[a-z]?)").alias("gevonden"), C.outcome_by_regex(kind).alias("uitkomst"))


@query("x12_placeholder", """
SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('F') THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN lower(trim(substr(o_orderpriority, 3))) NOT IN ('low') THEN substr(o_orderpriority, 3) END AS o_orderpriority FROM orders""")
def placeholders(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.expr("substr(o_orderpriority, 3)").alias("o_orderpriority"))
    return T.placeholder_to_null(rows, ["f", "low"])


@query("x14_any_keyword", """
SELECT doc_id FROM documents WHERE text LIKE '%the%' OR text LIKE '%queque%' OR text LIKE '%sch %'""")
def any_word(t: Tables):
    from plenaria.plans.people import mentions_party

    return mentions_party(t.documents, ["the", "queque", "sch "], "text").select("doc_id")


@query("x2_side_job_sector", """
SELECT CASE WHEN i < 3 THEN 'Zorg' WHEN i < 7 THEN 'Onderwijs' WHEN i < 11 THEN 'Financieel' WHEN i < 16 THEN 'Overheid' WHEN i < 21 THEN 'Maatschappelijk' ELSE 'Overig' END AS sector, count(*) AS aantal
FROM (SELECT p_partkey % 22 AS i FROM part) GROUP BY 1""")
def side_jobs(t: Tables):
    """The built-in side-job groups, each word embedded in a description."""
    words = [w for group in fixed.SIDE_JOB_SECTORS.values() for w in group] + ["iets"]
    text = F.concat(F.lit("Lid "), F.upper(F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % len(words) + 1).cast("int"))), F.lit("en"))
    return t.part.groupBy(C.side_job_sector(text).alias("sector")).agg(F.count(F.lit(1)).alias("aantal"))
