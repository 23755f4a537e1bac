from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from plenaria.operators.quality import run_checks
from plenaria.plans import semantic, stars
from plenaria.plans.catalog import BRIDGES, ENTITIES
from plenaria.plans.conform import conform_all, conform_entity
from plenaria.sources import checked, feed, files, pages as source
from plenaria.streaming import jobs

NS = 'xmlns:ns1="http://host/xsd/v1-0" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"'


def entry(kind, key, day, body="", deleted="False", links="", updated=None):
    element = kind[0].lower() + kind[1:]
    return (f'<entry><id>urn:{kind}:{key}:{day}</id><title>{kind}</title><updated>2024-01-{updated or day:02d}T00:00:00Z</updated><category term="{kind}"/>{links}'
            f'<content><ns1:{element} {NS} id="{key}" ns1:verwijderd="{deleted}" ns1:bijgewerkt="2024-01-{day:02d}T00:00:00Z">{body}</ns1:{element}></content></entry>')


def page(folder, name, entries, token):
    link = "" if token is None else f'<link rel="next" href="https://host/Feed?category=x&amp;skiptoken={token}"/>'
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.xml").write_text(f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">{link}{"".join(entries)}</feed>')


def ref(name, key, more=""):
    return f'<ns1:{name} ref="{key}"{more}/>'


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    page(folder, "p1", [entry("Zaal", "z1", 1, "<ns1:naam>A</ns1:naam><ns1:sysCode>7</ns1:sysCode>"), entry("Zaal", "z2", 1, '<ns1:naam>B</ns1:naam><ns1:sysCode xsi:nil="true"/>')], 102)
    page(folder, "p2", [entry("Zaal", "z1", 2, deleted="True"), entry("Fractie", "f1", 2, "<ns1:afkorting>AA</ns1:afkorting><ns1:datumActief>1990</ns1:datumActief>", links='<link rel="self" href="s"/><link rel="enclosure" href="logo"/>')], 104)
    page(folder, "p3", [entry("Zaal", "z3", 3, "<ns1:naam>C</ns1:naam>")], None)
    return folder


def test_decode_and_cursor(spark, pages, rows):
    everything = feed.read_feed(spark, str(pages))
    assert rows(everything, "tabel", "feed_id") == sorted([("zaal", "urn:Zaal:z1:1"), ("zaal", "urn:Zaal:z2:1"), ("zaal", "urn:Zaal:z1:2"), ("fractie", "urn:Fractie:f1:2"), ("zaal", "urn:Zaal:z3:3")])
    assert feed.next_cursor(everything).first()[0] == 104
    newer = feed.read_feed(spark, str(pages), cursor=102)
    assert newer.count() == 3 and feed.next_cursor(newer, 102).first()[0] == 104
    assert feed.read_feed(spark, str(pages), max_pages=1).count() == 2
    assert feed.read_feed(spark, str(pages), category="Fractie").count() == 1
    last = feed.read_feed(spark, str(pages), cursor=104)
    assert last.count() == 1 and feed.next_cursor(last, 104).first()[0] == 104


def test_log_to_entity(spark, pages, tmp_path, rows):
    log = str(tmp_path / "log")
    feed.append_log(feed.read_feed(spark, str(pages), max_pages=1), log, "one")
    feed.append_log(feed.read_feed(spark, str(pages), cursor=102), log, "two")
    stored = spark.read.parquet(log)
    assert {r[0] for r in stored.select("_load_id").distinct().collect()} == {"one", "two"}
    room = feed.entity_log(stored, "zaal")
    assert rows(conform_entity(room, {}, ENTITIES["zaal"]), "id", "naam", "sys_code") == [("z2", "B", None), ("z3", "C", None)]
    faction = conform_entity(feed.entity_log(stored, "fractie"), {}, ENTITIES["fractie"])
    assert rows(faction, "afkorting", F.col("datum_actief").cast("string"), "datum_actief_precisie", "logo_url") == [("AA", "1990-01-01", "jaar", "logo")]


def test_stream_resumes_where_it_stopped(spark, pages, tmp_path, rows):
    log, cursor = str(tmp_path / "log"), str(tmp_path / "cursor")
    jobs.stream_feed(spark, str(pages), log, cursor, entities=("zaal", "fractie")).awaitTermination()
    assert spark.read.parquet(log).count() == 5
    jobs.stream_feed(spark, str(pages), log, cursor, entities=("zaal", "fractie")).awaitTermination()
    assert spark.read.parquet(log).count() == 5
    page(pages, "p4", [entry("Zaal", "z4", 4, "<ns1:naam>D</ns1:naam>")], None)
    jobs.stream_feed(spark, str(pages), log, cursor, entities=("zaal", "fractie")).awaitTermination()
    live = conform_entity(feed.entity_log(spark.read.parquet(log), "zaal"), {}, ENTITIES["zaal"])
    assert [r[0] for r in rows(live, "id")] == ["z2", "z3", "z4"]


def test_strict_reading_fails_on_bad_values(spark, tmp_path):
    folder = tmp_path / "bad"
    page(folder, "p", [entry("Zaal", "z1", 1).replace("2024-01-01T00:00:00Z\">", "geen tijd\">")], 1)
    with pytest.raises(Exception):
        feed.read_feed(spark, str(folder), entities=("zaal",)).collect()


def test_tolerant_reading_keeps_all_decodable_entries(spark, tmp_path):
    folder = tmp_path / "mixed"
    page(folder, "good", [entry("Zaal", "z1", 1), entry("Zaal", "z2", 1)], 1)
    page(folder, "value", [entry("Zaal", "z3", 1), entry("Zaal", "z4", 1).replace("2024-01-01T00:00:00Z", "geen tijd"), entry("Zaal", "z5", 1)], 2)
    page(folder, "cut", [entry("Zaal", "z6", 1)], 3)
    cut = next(p for p in folder.iterdir() if p.stem == "cut")
    cut.write_text(cut.read_text().replace("</feed>", "<entry></feed>"))
    found = feed.read_feed(spark, str(folder), entities=("zaal",), strict=False).select("content.zaal.id", "feed_updated").collect()
    assert sorted(r.id for r in found) == ["z1", "z2", "z3", "z4", "z5"]
    rejected = feed.rejected_pages(spark, str(folder), ("zaal",)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in rejected] == [cut.name] and "z6" in rejected[0].page and rejected[0].entries <= 0


def test_repeated_batch_leaves_the_table_whole(spark, tmp_path):
    root = str(tmp_path / "table")
    spark.createDataFrame([(1, 1), (2, 1), (1, 2)], "id int, at int").write.parquet(str(tmp_path / "in"))
    for run in ("first", "again"):
        source = spark.readStream.schema("id int, at int").parquet(str(tmp_path / "in"))
        jobs.stream_latest(spark, source, root, str(tmp_path / run), ["id"], ["at"], buckets=2).awaitTermination()
    assert sorted(tuple(r) for r in jobs.current_version(spark, root).collect()) == [(1, 2), (2, 1)]


def test_xsd_validation(spark, tmp_path, rows):
    xsd = tmp_path / "zaal.xsd"
    xsd.write_text('<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="zaal"><xs:complexType><xs:sequence><xs:element name="naam" type="xs:string"/>'
                   '<xs:element name="code" type="xs:int" minOccurs="0"/></xs:sequence><xs:attribute name="id" type="xs:string" use="required"/></xs:complexType></xs:element></xs:schema>')
    folder = tmp_path / "x"
    folder.mkdir()
    (folder / "a.xml").write_text('<r><zaal id="1"><naam>A</naam><code>5</code></zaal><zaal id="2"><code>x</code></zaal></r>')
    schema = T.StructType().add("id", "string").add("naam", "string").add("code", "integer")
    kept = feed.read_entity_xml(spark, str(folder), "zaal", schema, str(xsd), strict=False).cache()
    assert rows(kept.where("_corrupt_record is null"), "id", "naam", "code") == [("1", "A", 5)] and kept.where("_corrupt_record is not null").count() == 1
    with pytest.raises(Exception):
        feed.read_entity_xml(spark, str(folder), "zaal", schema, str(xsd)).collect()


def test_clean_names(spark):
    df = spark.createDataFrame([((1, ("x", [("r",)])),)], "`ns1:a` struct<`@id`:int,`ns1:b`:struct<`@xmlns:q`:string,`ns1:c`:array<struct<`@ref`:string>>>>")
    assert feed.clean_names(df).schema.simpleString() == "struct<a:struct<id:int,b:struct<c:array<struct<ref:string>>>>>"


def test_row_ids_repeat(spark):
    df = spark.range(50).withColumn("x", F.lit("a"))
    one, two = ({r[0] for r in d.select(feed.row_id(d)).collect()} for d in (df, df.repartition(3)))
    assert one == two and len(one) == 50


@pytest.fixture(scope="module")
def conformed(spark, tmp_path_factory):
    """A small parliament as feed pages, through the log and the whole conform layer."""
    folder = tmp_path_factory.mktemp("feed") / "pages"
    name = lambda t, v: f"<ns1:{t}>{v}</ns1:{t}>"
    seat = lambda z, who, a, b="": ref(z[0], z[1]) + ref("persoon", who) + name("functie", "Lid") + name("van", a) + (name("totEnMet", b) if b else "")
    page(folder, "p1", [
        entry("Persoon", "p1", 1, name("achternaam", "Jansen") + name("roepnaam", "Jo") + name("geslacht", "vrouw") + name("functie", "Tweede Kamerlid") + name("geboortedatum", "1980-05")),
        entry("Persoon", "p2", 1, name("achternaam", "Vos") + name("geslacht", "man") + name("functie", "Oud Kamerlid") + name("geboortedatum", "1950")),
        entry("Persoon", "p3", 1, name("achternaam", "Weg") + name("geslacht", "man") + name("functie", "Oud Kamerlid")), entry("Persoon", "p3", 2, deleted="True"),
        entry("Fractie", "f1", 1, name("afkorting", "GL") + name("naamNl", "GroenLinks") + name("aantalZetels", 8) + name("aantalStemmen", 900) + name("datumActief", "1990")),
        entry("Fractie", "f2", 1, name("afkorting", "CDA") + name("naamNl", "CDA") + name("aantalZetels", 5) + name("aantalStemmen", 500) + name("datumActief", "1980-W11")),
        entry("FractieZetel", "fz1", 1, ref("fractie", "f1") + name("gewicht", 1)), entry("FractieZetel", "fz2", 1, ref("fractie", "f2") + name("gewicht", 2)), entry("FractieZetel", "fz3", 1, ref("fractie", "weg")),
        entry("FractieZetelPersoon", "m1", 1, seat(("fractieZetel", "fz2"), "p1", "2010-01-01", "2012-12-31")), entry("FractieZetelPersoon", "m2", 1, seat(("fractieZetel", "fz1"), "p1", "2013-01-01")),
        entry("FractieZetelPersoon", "m3", 1, seat(("fractieZetel", "fz2"), "p2", "2011", "2011-06")), entry("FractieZetelPersoon", "m4", 1, seat(("fractieZetel", "fz1"), "p3", "2011"))], 1)
    page(folder, "p2", [
        entry("Commissie", "c1", 1, name("naamNl", "Vaste commissie voor Zorg")), entry("CommissieZetel", "cz1", 1, ref("commissie", "c1")),
        entry("CommissieZetelVastPersoon", "cp1", 1, seat(("commissieZetel", "cz1"), "p1", "2015-01-01")),
        entry("CommissieZetelVastVacature", "cv1", 1, ref("commissieZetel", "cz1") + ref("fractie", "f1") + name("van", "2014-01-01") + name("totEnMet", "2014-12-31")),
        entry("Activiteit", "a1", 1, name("soort", "Debat") + name("datum", "2024-03-01T00:00:00") + name("aanvangstijd", "2024-03-01T10:00:00") + name("eindtijd", "2024-03-01T11:30:00") + name("besloten", "false") + name("status", "Uitgevoerd") + ref("voortouwcommissie", "c1")),
        entry("Activiteit", "a2", 1, name("soort", "Debat") + ref("voortouwcommissie", "weg") + ref("vervangenVanuit", "a1") + ref("vervangenVanuit", "weg")),
        entry("Agendapunt", "ap1", 1, ref("activiteit", "a1") + name("onderwerp", "Punt") + name("volgorde", 3)), entry("Besluit", "b1", 1, ref("agendapunt", "ap1") + name("besluitSoort", "Stemmen - aangenomen") + ref("zaak", "z1") + ref("zaak", "z1") + ref("zaak", "weg")),
        entry("Kamerstukdossier", "k1", 1, name("titel", "Dossier") + name("nummer", 12) + name("afgesloten", "false")), entry("Zaak", "z1", 1, name("soort", "Motie") + name("afgedaan", "true") + name("gestartOp", "2024-01-05T09:00:00Z") + ref("kamerstukdossier", "k1") + ref("activiteit", "a1") + ref("gerelateerdVanuit", "z1")),
        entry("Stemming", "s1", 1, ref("besluit", "b1") + name("soort", "Voor") + name("fractieGrootte", 8) + name("vergissing", "false") + ref("fractie", "f1")),
        entry("Stemming", "s2", 1, ref("besluit", "b1") + name("soort", "Tegen") + name("fractieGrootte", 5) + name("vergissing", "false") + ref("fractie", "f2") + ref("persoon", "p3")),
        entry("Document", "d1", 1, name("soort", "Motie") + name("datum", "2024-02-01T00:00:00") + ref("huidigeDocumentVersie", "dv1") + ref("kamerstukdossier", "k1") + ref("zaak", "z1") + ref("bronDocument", "d2")),
        entry("Document", "d2", 1, name("soort", "Brief regering") + ref("huidigeDocumentVersie", "weg")), entry("DocumentVersie", "dv1", 1, name("versienummer", 1) + ref("document", "d1")),
        entry("Toezegging", "t1", 1, ref("activiteit", "a1") + name("status", "Voldaan") + "<ns1:toegezegdAan>" + ref("persoon", "p1") + "</ns1:toegezegdAan><ns1:toegezegdAan>" + ref("persoon", "p3") + "</ns1:toegezegdAan><ns1:toegezegdAan>" + ref("fractie", "f1") + "</ns1:toegezegdAan>"
              + ref("isHerhalingVan", "t2", ' ns1:bijgewerkt="2024-01-07T00:00:00Z"')), entry("Toezegging", "t2", 1, name("status", "Onzin")),
        entry("PersoonNevenfunctie", "n1", 1, ref("persoon", "p1") + name("isActief", "true") + "<ns1:periode><ns1:van>2014</ns1:van></ns1:periode><ns1:vergoeding><ns1:soort>Bezoldigd</ns1:soort></ns1:vergoeding>"),
        entry("PersoonNevenfunctieInkomsten", "i1", 1, ref("persoonNevenfunctie", "n1") + name("jaar", 2020) + name("bedrag", "100.50") + name("frequentie", "Per maand")),
        entry("PersoonReis", "r1", 1, ref("persoon", "p1") + name("bestemming", "Parijs") + name("van", "2012-06-01") + name("totEnMet", "2012-06-04")),
        entry("Zaal", "za1", 1, name("naam", "Klompézaal")), entry("Reservering", "re1", 1, ref("zaal", "za1") + ref("activiteit", "a1") + ref("activiteit", "a0"))], 2)
    rows = feed.read_feed(spark, str(folder))
    path = str(tmp_path_factory.mktemp("log") / "log")
    feed.append_log(rows, path, "x")
    log = spark.read.parquet(path)
    store = tmp_path_factory.mktemp("silver")

    def keep(table, df):
        df.write.parquet(f"{store}/{table}")
        return spark.read.parquet(f"{store}/{table}")

    return conform_all({n: feed.entity_log(log, n) for n in ENTITIES}, ENTITIES, BRIDGES, keep)


def test_conform_layer(conformed, rows):
    assert set(conformed) == set(ENTITIES) | set(BRIDGES)
    for name, spec in ENTITIES.items():
        assert [(f.name, f.dataType) for f in conformed[name].schema.fields] == [(f.name, f.dataType) for f in spec.schema.fields]
    assert rows(conformed["fractie_zetel_persoon"], "id", "persoon_id") == [("m1", "p1"), ("m2", "p1"), ("m3", "p2"), ("m4", None)]
    assert rows(conformed["besluit_zaak"], "besluit_id", "zaak_id") == [("b1", "z1")]
    assert rows(conformed["activiteit_vervangen_vanuit"], "activiteit_id", "vervangen_vanuit_id") == [("a2", "a1")]
    assert rows(conformed["toezegging_toegezegd_aan"], "volgorde", "persoon_id", "fractie_id") == [(0, "p1", None), (2, None, "f1")]
    assert rows(conformed["toezegging_is_herhaling_van"]) == [("t1", "t2", datetime(2024, 1, 7))]
    assert rows(conformed["document"], "id", "huidige_document_versie_id") == [("d1", "dv1"), ("d2", None)]
    assert rows(conformed["zaak_gerelateerd_vanuit"], "zaak_id", "gerelateerd_vanuit_id") == [("z1", "z1")]
    assert rows(conformed["persoon_nevenfunctie"], F.col("periode_van").cast("string"), "periode_van_precisie", "vergoeding_soort", "is_actief") == [("2014-01-01", "jaar", "Bezoldigd", True)]
    # the highest reference of the relation, then checked: a0 sorts before a1
    assert rows(conformed["reservering"], "activiteit_id", "zaal_id") == [("a1", "za1")]


def test_declared_checks(conformed):
    checks = [c for n in ("toezegging", "fractie_zetel_persoon", "stemming") for c in ENTITIES[n].checks()] + BRIDGES["toezegging_toegezegd_aan"].checks()
    failed = {r.controle: r.fouten for r in run_checks(conformed, checks).where("not ok").collect()}
    assert failed == {"accepted:toezegging.status": 1}


def test_stars_on_conformed_tables(conformed, rows):
    from datetime import date

    as_of = date(2024, 6, 1)
    held = stars.contacts(conformed, as_of)["fact_fractie_zetel_persoon"]
    assert rows(held, "fractie_zetel_persoon_key", "persoon_id", "fractie_id", "van_date_key", "tot_en_met_date_key") == [
        (1, "p1", "f1", 20130101, 99991231), (2, "p2", "f2", 20110101, 20110630), (3, "-1", "f1", 20110101, 99991231), (4, "p1", "f2", 20100101, 20121231)]
    changes = stars.seat_history(conformed, as_of)["fact_zetelwisseling"]
    assert rows(changes.where("event_type = 'vertrek'"), "persoon_id", "fractie_norm", "zetels_op_datum") == [("p1", "CDA", 1), ("p2", "CDA", 2)]
    assert rows(stars.committees(conformed, as_of)["fact_commissie_zaak"], "commissie_id", "zaak_id", "datum_id", "aantal_besluiten") == [("c1", "z1", 20240301, 1)]
    assert rows(stars.committees(conformed, as_of)["dim_commissie"], "commissietype", "aantal_zetels", "is_actief") == [("Vast", 1, True)]
    assert rows(stars.decisions(conformed)["fact_activiteit_besluit"], "activiteit_id", "zaak_id", "duur_minuten") == [("a1", "z1", 90), ("a2", None, None)]
    assert rows(stars.votes(conformed)["fact_stemming"], "stemming_id", "persoon_id") == [("s1", None), ("s2", None)]
    assert rows(stars.income(conformed)["feit_inkomen"], "fractie_id", "bedrag") == [("f1", 1206.0)]
    assert rows(stars.travel(conformed, as_of)["gold_fact_reis"], "fractielabel", "reisduur", "achternaam") == [("CDA", 3, "Jansen")]
    assert rows(stars.planning(conformed)["planning"], "activiteit_id", "vergaderzaal") == [("a1", "Klompézaal")]
    view = semantic.faction_view(conformed)
    assert rows(view.query(["FractieNaam"], ["AantalZetels", "AantalPersonen", "AantalStemmen"]), "FractieNaam", "AantalZetels", "AantalPersonen") == [("CDA", None, None), ("GroenLinks", 1, 1)]


def test_release_switches_as_a_whole(spark, tmp_path, rows):
    root = str(tmp_path / "gold")
    files.publish({"a": spark.range(3), "b": spark.range(1)}, root, 1)
    # an interrupted release writes tables but no manifest
    spark.range(99).write.parquet(f"{root}/release=2/a")
    assert {n: d.count() for n, d in files.read_release(spark, root).items()} == {"a": 3, "b": 1}
    files.publish({"a": spark.range(5)}, root, 3)
    assert {n: d.count() for n, d in files.read_release(spark, root).items()} == {"a": 5}
    reader = files.read_release(spark, root)["a"]
    with pytest.raises(ValueError):
        files.publish({"a": spark.range(9)}, root, 3)
    assert reader.count() == 5 and {n: d.count() for n, d in files.read_release(spark, root).items()} == {"a": 5}


@pytest.mark.parametrize("buckets", [1, 7])
def test_latest_stream_ignores_late_versions(spark, tmp_path, rows, buckets):
    landed, schema = tmp_path / "landed", "id string, bijgewerkt int, n int"
    batches = [[("a", 5, 1), ("b", 1, 1)], [("a", 3, 2), ("c", 1, 2)], [("b", 9, 3), ("a", 5, 0)]]
    root, cursor, by = str(tmp_path / "table"), str(tmp_path / "cursor"), (["id"], ["bijgewerkt", "n"])
    assert jobs.current_version(spark, root) is None
    for data in batches:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(landed))
        source = spark.readStream.schema(schema).parquet(str(landed))
        jobs.stream_latest(spark, source, root, cursor, *by, buckets=buckets).awaitTermination()
    assert rows(jobs.current_version(spark, root)) == [("a", 5, 1), ("b", 9, 3), ("c", 1, 2)]
    assert rows(jobs.current_version(spark, root, before=1)) == [("a", 5, 1), ("b", 1, 1)]


def test_latest_stream_writes_touched_buckets_only(spark, tmp_path, rows):
    root, cursor = str(tmp_path / "table"), str(tmp_path / "cursor")
    for data in ([(k, 1) for k in range(400)], [(7, 2), (7, 2), (8, 1)]):
        spark.createDataFrame(data, "id int, at int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.stream_latest(spark, spark.readStream.schema("id int, at int").parquet(str(tmp_path / "in")), root, cursor, ["id"], ["at"], buckets=16, repeats_within="1 hour").awaitTermination()
    attempts = spark.read.parquet(f"{root}/commits").groupBy("volgnummer").agg(F.count("emmer").alias("n"), F.first("poging").alias("p")).orderBy("volgnummer").collect()
    # the second batch holds two keys, and (8, 1) arrives again within the hour: one bucket is written, a sixteenth of the rows
    assert [r.n for r in attempts] == [16, 1] and spark.read.parquet(f"{root}/data").where(F.col("poging") == attempts[1].p).count() < 60
    assert rows(jobs.current_version(spark, root).where("at = 2")) == [(7, 2)] and jobs.current_version(spark, root).count() == 400
    # a batch that ran to its commit but is run again changes nothing
    files_before = spark.read.parquet(f"{root}/data").count()
    jobs.stream_latest(spark, spark.readStream.schema("id int, at int").parquet(str(tmp_path / "in")), root, cursor, ["id"], ["at"], buckets=16, repeats_within="1 hour").awaitTermination()
    assert spark.read.parquet(f"{root}/data").count() == files_before


def test_catalog_and_relations(spark, rows):
    df = spark.createDataFrame([("a", ["x", "y"], False), ("b", [], False), ("c", ["z"], True), ("d", None, False)], "id string, rel array<string>, weg boolean")
    assert rows(files.relation(df, "id", "rel", None, "r", deleted="weg")) == [("a", "x"), ("a", "y")]
    assert rows(files.split_children(df, "id", "rel", "r")) == [("a", 0, "x"), ("a", 1, "y"), ("c", 0, "z")]
    assert rows(files.catalog_columns(spark, {"t": df}), "kolom", "type") == [("id", "string"), ("rel", "array<string>"), ("weg", "boolean")]
    assert files.to_spark(spark, [(1, "a")], "i int, s string").count() == 1
    with pytest.raises(ValueError):
        files.to_spark(spark, range(10), "i int", max_rows=5)


XSD = ('<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns="http://host/xsd/v1-0" targetNamespace="http://host/xsd/v1-0" elementFormDefault="qualified">'
       '<xs:attribute name="verwijderd" type="xs:boolean"/><xs:attribute name="bijgewerkt" type="xs:dateTime"/><xs:element name="zaal"><xs:complexType><xs:sequence>'
       '<xs:element name="naam" type="xs:string" minOccurs="0"/><xs:element name="sysCode" type="xs:int" nillable="true" minOccurs="0"/></xs:sequence>'
       '<xs:attribute name="id" type="xs:string"/><xs:attribute ref="verwijderd"/><xs:attribute ref="bijgewerkt"/></xs:complexType></xs:element></xs:schema>')


def test_checked_entries_are_good_or_rejected_with_a_reason(spark, tmp_path):
    folder = tmp_path / "mixed"
    page(folder, "a", [entry("Zaal", "z1", 1, "<ns1:naam>A &amp; B &lt;c&gt;</ns1:naam>"), entry("Zaal", "z2", 1, "<ns1:sysCode>x</ns1:sysCode>", deleted="Perhaps"), entry("Raar", "r1", 1)], 1)
    page(folder, "b", [entry("Zaal", "z3", 1).replace('bijgewerkt="2024-01-01T00:00:00Z"', 'bijgewerkt="geen tijd"').replace('id="z3"', ""), entry("Zaal", "z4", 2, "<ns1:naam>D<ns1:naam>")], 2)
    page(folder, "c", [entry("Zaal", "z5", 1), entry("Zaal", "z6", 1, "<ns1:onbekend>1</ns1:onbekend>"), "<entry><id>urn:leeg</id><category term=\"Zaal\"/></entry>"], 3)
    cut = folder / "c.xml"
    cut.write_text(cut.read_text().replace("</feed>", "<entry><id>cut"))
    found = {r.feed_id: r for r in checked.read_checked(spark, str(folder), entities=("zaal",)).collect()}
    assert {k: r.reason for k, r in found.items() if k} == {
        "urn:Zaal:z1:1": None, "urn:Zaal:z2:1": "verwijderd: no boolean; sys_code: no int", "urn:Raar:r1:1": "category: unknown", "urn:Zaal:z3:1": "id: missing; bijgewerkt: no timestamp",
        "urn:Zaal:z5:1": None, "urn:Zaal:z6:1": None, "urn:leeg": "content: missing"}
    # the entry that is no XML has no readable id; it and the rest of the broken page are rows of their own
    everything = checked.read_checked(spark, str(folder), entities=("zaal",)).collect()
    assert len(everything) == 9 and {"entry: no XML", "page: no XML"} <= {r.reason for r in everything}
    assert found["urn:Zaal:z1:1"].content.zaal.naam == "A & B <c>" and found["urn:Zaal:z1:1"].entry is None and "Perhaps" in found["urn:Zaal:z2:1"].entry
    xsd = tmp_path / "zaal.xsd"
    xsd.write_text(XSD)
    valid = {r.feed_id: r.reason for r in checked.read_checked(spark, str(folder), entities=("zaal",), xsd={"zaal": str(xsd)}).collect()}
    assert valid["urn:Zaal:z1:1"] is None and valid["urn:Zaal:z6:1"] == "schema: not valid" and valid["urn:Zaal:z2:1"].endswith("; schema: not valid")
    # past the cursor only
    assert {r.path.rsplit("/", 1)[1] for r in checked.read_checked(spark, str(folder), cursor=2, entities=("zaal",)).collect()} == {"c.xml"}


def test_checked_stream_equals_checked_batch(spark, pages, tmp_path, rows):
    page(pages, "p4", [entry("Zaal", "z8", 4, "<ns1:sysCode>x</ns1:sysCode>"), entry("Zaal", "z9", 4)], 110)
    names = ("zaal", "fractie")
    jobs.stream_feed(spark, str(pages), str(tmp_path / "log"), str(tmp_path / "cursor"), strict=False, entities=names, load_id="s").awaitTermination()
    checked.append_checked(checked.read_checked(spark, str(pages), entities=names), str(tmp_path / "batch"), "b")
    streamed, batch = spark.read.parquet(str(tmp_path / "log")), spark.read.parquet(str(tmp_path / "batch"))
    assert rows(streamed, "tabel", "feed_id", "reason", "_row_id") == rows(batch, "tabel", "feed_id", "reason", "_row_id") and streamed.count() == 7
    assert rows(checked.rejected(streamed), "feed_id", "reason", "_load_id") == [("urn:Zaal:z8:4", "sys_code: no int", "s")]
    assert {r[0] for r in batch.select("_load_id").collect()} == {"b"}
    # good rows have the same ids as the strict load gives them, and conform alike
    strict = feed.read_feed(spark, str(pages), entities=names)
    ids = {r[0] for r in strict.select(feed.row_id(strict)).collect()}
    assert {r[0] for r in streamed.where("reason IS NULL").select("_row_id").collect()} <= ids
    assert rows(conform_entity(feed.entity_log(streamed, "zaal"), {}, ENTITIES["zaal"]), "id") == [("z2",), ("z3",), ("z9",)]


def chain(folder, category, token, onward, keys):
    folder.mkdir(exist_ok=True)
    link = "" if onward is None else f'<link rel="{"next" if onward > token else "resume"}" href="https://host/Feed?category=x&amp;skiptoken={onward}"/>'
    body = "".join(entry("Zaal", k, 1, links='<link rel="next" href="u?skiptoken=999"/>') for k in keys)
    (folder / f"{category}-{'' if token < 0 else token}.xml").write_text(f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">{link}{body}</feed>')


def test_source_follows_the_chain_and_stops(spark, tmp_path):
    folder = tmp_path / "chain"
    chain(folder, "A", -1, 10, ["a1", "a2"])
    chain(folder, "A", 10, 20, ["a3"])
    chain(folder, "A", 20, None, ["a4"])     # the last page leads nowhere
    chain(folder, "B", -1, 5, ["b1"])
    chain(folder, "B", 5, 5, ["b2"])         # or to itself
    chain(folder, "C", -1, 7, ["c1"])
    chain(folder, "C", 7, 9, [])             # a page without entries ends the chain
    source.register(spark)
    options = {"url": f"file://{folder}/{{category}}-{{token}}.xml", "categories": "A,B,C,D"}
    tokens = lambda **more: sorted((r.category, r.token) for r in spark.read.format("feed_pages").options(**options, **more).load().collect())
    assert tokens() == [("A", -1), ("A", 10), ("A", 20), ("B", -1), ("B", 5), ("C", -1)]
    assert tokens(pages="1") == [("A", -1), ("B", -1), ("C", -1)] and tokens(token="10") == [("A", 10), ("A", 20)]


def test_source_resumes_from_its_offset(spark, tmp_path):
    folder, log = tmp_path / "chain", str(tmp_path / "log")
    chain(folder, "A", -1, 10, ["a1"])
    chain(folder, "A", 10, 20, ["a2"])
    chain(folder, "A", 20, 30, ["a3"])
    chain(folder, "A", 30, None, ["a4"])
    chain(folder, "B", -1, None, ["b1"])
    options = {"url": f"file://{folder}/{{category}}-{{token}}.xml", "categories": "A,B", "pages": "2"}

    def load(name):
        jobs.stream_source(spark, options, log, str(tmp_path / "cursor"), entities=("zaal",), load_id=name).awaitTermination()
        return sorted((r.feed_id.split(":")[2], r._load_id) for r in spark.read.parquet(log).collect())
    assert load("1") == [("a1", "1"), ("a2", "1"), ("b1", "1")]
    assert load("2") == [("a1", "1"), ("a2", "1"), ("a3", "2"), ("a4", "2"), ("b1", "1")]
    assert load("3") == [("a1", "1"), ("a2", "1"), ("a3", "2"), ("a4", "2"), ("b1", "1")]
    # the last page has grown and now leads on: it is read again, since its entries may be new
    chain(folder, "A", 30, 40, ["a4", "a5"])
    chain(folder, "A", 40, None, ["a6"])
    assert [k for k in load("4") if k[1] == "4"] == [("a4", "4"), ("a5", "4"), ("a6", "4")]


def test_pages_share_tasks(tmp_path):
    """A task fetches several pages, and the chain that was followed for an offset is not followed again to plan it."""
    from plenaria.sources import pages as S

    number = 70
    for token in range(-1, number):
        (tmp_path / f"{token}.xml").write_text(f'<feed><link rel="next" href="?skiptoken={token + 1}"/><entry><id>{token}</id></entry></feed>')
    feed = S.Feed({"url": f"file://{tmp_path}/{{token}}.xml", "first_url": f"file://{tmp_path}/-1.xml"})
    reader, looked = S.FeedStreamReader(feed), []
    look = feed.look
    feed.look = lambda category, token: looked.append(token) or look(category, token)
    start, end = reader.initialOffset(), reader.latestOffset()
    parts = reader.partitions(start, end)
    assert sorted(looked) == list(range(-1, number + 1)) and len(parts) == 3
    assert [r[3] for part in parts for r in reader.read(part)] == list(range(-1, number))


def test_small_pages_share_a_batch(spark, tmp_path):
    """Pages are batched by their bytes, so many small ones are one batch."""
    from plenaria.streaming.jobs import stream_feed

    (tmp_path / "pages").mkdir()
    for i in range(130):
        (tmp_path / "pages" / f"{i}.xml").write_text(
            f'<feed><entry><id>urn:{i}</id><title>Zaal</title><updated>2024-01-01T00:00:00Z</updated><category _term="Zaal"/><content>'
            f'<zaal id="{i}" verwijderd="False" bijgewerkt="2024-01-01T00:00:00Z"><naam>z</naam></zaal></content></entry></feed>')
    run = stream_feed(spark, str(tmp_path / "pages"), str(tmp_path / "log"), str(tmp_path / "cursor"), strict=False, entities=("zaal",))
    run.awaitTermination()
    assert len(list((tmp_path / "cursor" / "commits").glob("[0-9]*"))) == 1
    assert spark.read.parquet(str(tmp_path / "log")).count() == 130
