from pyspark.sql import functions as F

from plenaria.functions import text as T
from plenaria.plans import people as P
from plenaria.rules import classifiers as C
from plenaria.rules import fixed


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def each(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_keys(spark):
    assert each(spark, ["Ommen (Ov.)", "'s-Gravenhage", "Klompézaal", "Sœur ﬁn ĳs", "-", None, "onbekend", "Ærø"], T.place_key) == [
        "ommen", "s gravenhage", "klompezaal", "sur fin ijs", None, None, None, "r"]
    assert each(spark, ["Klompézaal", "K4 zaal", "Straße (x)"], T.room_key) == ["klompezaal", "k4zaal", "strassex"]
    assert each(spark, ["V.W.O.  en \"M.T.S.\"  x "], T.clean_text) == ["vwo en mts x"]


def test_snake_case_and_bool(spark):
    assert each(spark, ["Verslag", "CommissieZetelVastPersoon", "HTTPPage"], T.snake_case) == ["verslag", "commissie_zetel_vast_persoon", "http_page"]
    assert each(spark, ["True", "false", "ja", None], T.normalize_bool) == [True, False, None, None]


def test_education_levels(spark):
    df = spark.createDataFrame([
        (0, "V.W.O.", "Universiteit Leiden"), (1, "Master rechten (2 jaar)", None), (2, "Bestuurskunde", "UvA"), (3, "University of Applied Sciences", None),
        (4, None, "-"), (5, "Iets", None), (6, "Cursus voor universitair docent", None)], "i int, o string, s string")
    got = [tuple(r[0]) for r in df.orderBy("i").select(C.education_level(F.col("o"), F.col("s"))).collect()]
    assert got == [("vo", "tekst", "voltooid"), ("wo", "tekst", "niet_voltooid"), ("wo", "instelling", "voltooid"), ("hbo", "tekst", "voltooid"),
                   ("onbekend", "geen", "voltooid"), ("niet_ingedeeld", "geen", "voltooid"), ("cursus", "tekst", "voltooid")]
    assert each(spark, ["Vrije Universiteit Brussel", "VU", " ROC Midden ", "Onbekend."], C.canonical_institution) == [
        "Vrije Universiteit Brussel", "Vrije Universiteit Amsterdam", "ROC Midden", None]


def test_career_guards(spark):
    rules = [("kamerlidmaatschap", "kamerlid|tweede kamer"), ("politiek_ondersteuning", "medewerk|assistent"), ("zorg", "arts"), ("overig_onvoldoende_sectorcontext", ".+")]
    df = spark.createDataFrame([(0, "Kamerlid", "Tweede Kamer"), (1, "Beleidsmedewerker", "Tweede Kamer"), (2, "Assistent arts", "Ziekenhuis"), (3, "Medewerker", "VVD"),
                                (4, None, None), (5, "Bakker", None)], "i int, f string, w string")
    got = [r[0] for r in df.orderBy("i").select(C.career_sector(F.col("f"), F.col("w"), rules)).collect()]
    assert got == ["kamerlidmaatschap", "politiek_ondersteuning", "zorg", "politiek_ondersteuning", "onbekend", "overig_onvoldoende_sectorcontext"]


def test_rules_from_table_keep_their_order(spark):
    table = spark.createDataFrame([(2, "b", "y"), (1, "a", "x")], "volgorde int, label string, patroon string")
    assert C.rules_from(table) == [("a", "x"), ("b", "y")]


def test_labels(spark):
    assert each(spark, ["PvdA", "CDA", None], C.normalise_faction) == ["PRO", "CDA", None]
    assert each(spark, [" X ", "Twitter", "LinkedIn", None], C.channel) == ["X (Twitter)", "X (Twitter)", "LinkedIn", None]
    assert each(spark, ["Stemmen - Aangenomen", "verworpen", "x", None], C.outcome_by_like) == ["aangenomen", "verworpen", None, None]
    assert each(spark, ["Motie ", "Iets", None], C.document_group) == ["Motie", "Overig", "Overig"]
    assert each(spark, [True, False, None], C.openness, "boolean") == ["Besloten", "Openbaar", "Onbekend"]
    assert each(spark, ["Vaste commissie voor Zorg", "Tijdelijke commissie X", None], lambda c: C.committee_label(c, F.lit("AB"))) == ["Zorg", "Tijdelijk X", "AB"]


def test_places(spark, rows):
    register = spark.createDataFrame([("Bergen", "Bergen (NH.)", "1", "NH"), ("Bergen", "Bergen (L.)", "2", "L"), ("'s-Gravenhage", "'s-Gravenhage", "3", "ZH"), ("Aadorp", "Almelo", "4", "OV")],
                                     "woonplaats string, gemeente string, gemeentecode string, provincie string")
    lookup = P.place_lookup(register)
    people = spark.createDataFrame([(1, "Den Haag"), (2, "BERGEN"), (3, "Almelo"), (4, "Parijs"), (5, None)], "id int, plaats string")
    got = rows(P.match_places(people, "plaats", lookup), "id", "gemeentecode", "plaats_status")
    assert got == [(1, "3", "gematcht"), (2, None, "niet eenduidig"), (3, "4", "gematcht"), (4, None, "niet gevonden"), (5, None, "niet ingevuld")]
    missing = {r[0] for r in P.alias_targets_missing(spark, lookup).collect()}
    assert "s gravenhage" not in missing and "breda" in missing


def test_highest_level(spark, rows):
    df = spark.createDataFrame([("p", "1", "wo", "instelling", "voltooid"), ("p", "2", "wo", "tekst", "voltooid"), ("p", "3", "promotie", "tekst", "niet_voltooid"), ("q", "4", "cursus", "tekst", "voltooid")],
                               "persoon_id string, id string, categorie string, bron string, status string")
    assert rows(P.highest_level(df)) == [("p", "wo", "tekst")]
    people = spark.createDataFrame([("p",), ("q",), ("r",)], "id string")
    assert rows(P.education_summary(people, df), "persoon_id", "n_opleidingen", "opleiding_status") == [
        ("p", 3, "niveau bepaald"), ("q", 1, "geregistreerd, geen voltooid niveau af te leiden"), ("r", 0, "geen opleiding geregistreerd")]


def test_sector_flags(spark):
    flags = {r.sector: (r.telt_buiten_bovengrens, r.telt_buiten_zeker) for r in P.sectors_table(spark).collect()}
    assert len(flags) == len(fixed.SECTORS)
    assert flags["zorg"] == (True, True) and flags["overig_onvoldoende_sectorcontext"] == (True, False)
    assert flags["kamerlidmaatschap"] == flags["onbekend"] == flags["niet_ingedeeld"] == (False, False)
