from datetime import datetime

from pyspark.sql import functions as F

from plenaria.operators.references import not_in, resolve_fk
from plenaria.operators.versioned import apply_corrections, drop_deleted, feed_order, latest_version
from plenaria.plans.conform import BridgeSpec, conform_bridge, conform_entity, current, current_children, entity

LOG = "id string, bijgewerkt timestamp, feed_updated timestamp, _row_id string, verwijderd boolean, naam string"


def at(day):
    return datetime(2024, 1, day)


def log(spark, data):
    return spark.createDataFrame(data, LOG)


def test_latest_and_deleted(spark, rows):
    df = log(spark, [
        ("a", at(1), at(1), "1", False, "old"), ("a", at(2), at(1), "2", True, "gone"),
        ("b", at(1), at(1), "3", True, "gone"), ("b", at(2), at(2), "4", False, "back"),
        ("c", at(1), at(1), "5", False, "first feed"), ("c", at(1), at(2), "6", False, "second feed"),
        ("d", at(1), at(1), "7", False, "row 7"), ("d", at(1), at(1), "8", False, "row 8"),
        ("e", None, at(3), "9", False, "no time"), ("e", at(1), at(1), "0", False, "timed"),
        ("f", at(1), at(1), "x", None, "no flag")])
    latest = latest_version(df, ["id"], feed_order())
    assert rows(latest, "id", "naam") == [("a", "gone"), ("b", "back"), ("c", "second feed"), ("d", "row 8"), ("e", "timed"), ("f", "no flag")]
    # the older live version of a must not come back, and a missing flag counts as deleted
    assert [r[0] for r in rows(drop_deleted(latest), "id")] == ["b", "c", "d", "e"]


def test_one_row_per_key_and_subset(spark):
    df = spark.range(2000).select((F.col("id") % 37).cast("string").alias("id"), F.lit(at(1)).alias("bijgewerkt"), F.lit(at(1)).alias("feed_updated"),
                                  F.col("id").alias("_row_id"), (F.col("id") % 5 == 0).alias("verwijderd"))
    latest = latest_version(df, ["id"], feed_order())
    assert latest.count() == 37 == latest.select("id").distinct().count()
    assert drop_deleted(latest).join(latest, "_row_id", "left_anti").count() == 0


def test_corrections_only_fill_gaps(spark, rows):
    people = spark.createDataFrame([("a", None), ("b", "1950"), ("c", None)], "id string, jaar string")
    fixes = spark.createDataFrame([("a", "1998"), ("b", "1999")], "id string, jaar string")
    assert rows(apply_corrections(people, fixes, "id", ["jaar"])) == [("a", "1998", True), ("b", "1950", True), ("c", None, False)]


def test_resolve_fk_modes(spark, rows):
    child = spark.createDataFrame([(1, "p"), (2, "gone"), (3, None)], "nr int, fk string")
    parent = spark.createDataFrame([("p",), ("q",)], "id string")
    assert rows(resolve_fk(child, "fk", parent)) == [(1, "p"), (2, None), (3, None)]
    assert rows(resolve_fk(child, "fk", parent, mode="drop")) == [(1, "p")]
    assert rows(resolve_fk(child, "fk", parent, mode="drop_given")) == [(1, "p"), (3, None)]
    twice = parent.unionByName(parent)
    assert resolve_fk(child, "fk", twice, unique=False).count() == 3


def test_not_in_null_rules(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some, none = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([], "k int")
    assert rows(not_in(df, "k", some)) == [(2,), (None,)]
    assert rows(not_in(df, "k", some, "sql")) == []
    assert rows(not_in(df, "k", spark.createDataFrame([(1,)], "k int"), "sql")) == [(2,)]
    assert not_in(df, "k", none, "sql").count() == 3


def test_conform_entity(spark, rows):
    spec = entity("lid", "naam van~ tot~end persoon_id>persoon url@ zaken_id>>zaak aantal:int")
    data = [("1", False, at(2), at(2), "r1", "A", "2020-02", "2020-02", ("p",), [("self", "s"), ("enclosure", "e")], [("z1",), ("z2",)], "5"),
            ("2", False, at(1), at(1), "r2", "B", "2021-W01", "x", ("gone",), [], None, None),
            ("2", True, at(0 + 1), at(1), "r0", "B0", None, None, None, None, None, None)]
    df = spark.createDataFrame(data, "id string, verwijderd boolean, bijgewerkt timestamp, feed_updated timestamp, _row_id string, naam string, van string, tot string, "
                                     "persoon struct<ref:string>, atom_links array<struct<rel:string,href:string>>, zaken array<struct<ref:string>>, aantal string")
    persons, cases = spark.createDataFrame([("p",)], "id string"), spark.createDataFrame([("z2",)], "id string")
    out = conform_entity(df, {"persoon": persons, "zaak": cases}, spec)
    assert out.schema.names == spec.schema.names
    got = rows(out, "id", F.col("van").cast("string"), "van_precisie", F.col("tot").cast("string"), "tot_ruw", "persoon_id", "url", "zaken_id", "aantal")
    assert got == [("1", "2020-02-01", "maand", "2020-02-29", "2020-02", "p", "e", "z2", 5), ("2", "2021-01-04", "week", None, "x", None, None, None, None)]


def test_conform_bridges(spark, rows):
    base = "id string, verwijderd boolean, bijgewerkt timestamp, feed_updated timestamp, _row_id string, "
    owners = spark.createDataFrame([("a", False, at(1), at(1), "1", [("x",), ("y",)]), ("a", False, at(2), at(2), "2", [("y",), ("y",), (None,), ("a",)]), ("b", True, at(1), at(1), "3", [("y",)])],
                                   base + "rel array<struct<ref:string>>")
    live = spark.createDataFrame([("y",), ("a",)], "id string")
    spec = BridgeSpec("b", "o", "rel", "o_id", {"doel_id": ("ref", "t")})
    # only the current version's references, once each, self references included
    assert rows(conform_bridge(owners, {"t": live}, spec), "o_id", "doel_id") == [("a", "a"), ("a", "y")]

    dated = spark.createDataFrame([("a", False, at(1), at(1), "1", [("y", at(1)), ("y", at(5)), ("gone", at(1))])], base + "rel array<struct<ref:string,bijgewerkt:timestamp>>")
    spec = BridgeSpec("b", "o", "rel", "o_id", {"doel_id": ("ref", "t")}, stamp="item")
    assert rows(conform_bridge(dated, {"t": live}, spec)) == [("a", "y", at(5))]

    ordered = spark.createDataFrame([("a", False, at(1), at(1), "1", [(("p",), None), (("gone",), None), (None, ("f",)), (None, None)])],
                                    base + "rel array<struct<persoon:struct<ref:string>,fractie:struct<ref:string>>>")
    spec = BridgeSpec("b", "o", "rel", "o_id", {"persoon_id": ("persoon.ref", "persoon"), "fractie_id": ("fractie.ref", "fractie")}, ordered=True)
    got = conform_bridge(ordered, {"persoon": spark.createDataFrame([("p",)], "id string"), "fractie": spark.createDataFrame([("f",)], "id string")}, spec)
    # a given reference that does not resolve drops the row, an absent one does not
    assert rows(got, "volgorde", "persoon_id", "fractie_id") == [(0, "p", None), (2, None, "f"), (3, None, None)]


def test_children_of_old_versions_vanish(spark, rows):
    parents = log(spark, [("a", at(1), at(1), "1", False, ""), ("a", at(2), at(2), "2", False, "")])
    links = spark.createDataFrame([("1", "old"), ("2", "new")], "_parent_id string, ref string")
    assert rows(current_children(links, current(parents)), "ouder_id", "ref") == [("a", "new")]
