import pytest
from pyspark.sql import functions as F, types as T

from plenaria.operators import quality as Q
from plenaria.plans import semantic as S
from plenaria.plans.catalog import BRIDGES, ENTITIES, foreign_keys


def test_contract(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType(), metadata={"comment": "eerste"}), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    out = Q.enforce_contract(df, schema)
    assert out.columns == ["a", "b"] and out.schema["a"].metadata == {"comment": "eerste"}
    for wrong in ("b string", "b string, a bigint", "b string, a int, c int"):
        with pytest.raises(Q.ContractError):
            Q.enforce_contract(spark.createDataFrame([], wrong), schema)


def test_checks(spark, rows):
    t = spark.createDataFrame([(1, "a", "p"), (1, None, "gone"), (None, "z", None), (None, "a", "p")], "id int, soort string, fk string")
    p = spark.createDataFrame([("p",)], "id string")
    checks = [Q.Check("t", "not_null", ("id",)), Q.Check("t", "unique", ("id",)), Q.Check("t", "accepted", ("soort",), values=("a",)),
              Q.Check("t", "relationship", ("fk",), parent="p"), Q.Check("t", "primary_key", ("soort", "fk")), Q.Check("t", "rule", ("groot",), condition=F.col("id") > 0)]
    got = {r.controle: (r.fouten, r.ok) for r in Q.run_checks({"t": t, "p": p}, checks).collect()}
    assert got == {"not_null:t.id": (2, False), "unique:t.id": (1, False), "accepted:t.soort": (1, False), "relationship:t.fk": (1, False), "primary_key:t.soort+fk": (1, False), "rule:t.groot": (2, False)}


def test_profile(spark, rows):
    df = spark.createDataFrame([("-", 1), ("a", None), (None, 1), (" Onbekend ", 2)], "t string, n int")
    assert rows(Q.profile(df)) == [("n", 4, 1, 0, 2, 75.0), ("t", 4, 1, 2, 3, 25.0)]


def test_dominant_and_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "x"), (5, "y")], "id int, v string")
    assert rows(Q.dominant_value(df, "v")) == [("v", "x", 4, 80.0, True)]
    assert rows(Q.duplicate_candidates(df, ["v"], "id")) == [("x", 4, 1, 4)]
    with pytest.raises(Q.ContractError):
        Q.assert_unique(df, ["v"])
    assert Q.assert_unique(df, ["id"]) is df


def test_catalog_is_complete():
    assert len(ENTITIES) == 37 and len(BRIDGES) == 16
    columns = sum(len(s.schema.fields) for s in ENTITIES.values()) + sum(len(b.targets) + 2 + b.ordered for b in BRIDGES.values())
    assert columns == 534
    known = set(ENTITIES)
    assert all(k.parent in known for k in foreign_keys())
    # parents come first, but for the document's current version
    seen, late = set(), []
    for name, spec in ENTITIES.items():
        late += [(name, p) for p in spec.references.values() if p not in seen]
        seen.add(name)
    assert late == [("document", "document_versie")]
    assert sum(c.kind == "unique" for s in ENTITIES.values() for c in s.checks()) == 37


@pytest.fixture(scope="module")
def view(spark):
    f = spark.createDataFrame([(1, "A", 10), (2, "B", 20), (3, "C", 5)], "id int, naam string, stemmen int")
    z = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id int, fractie int")
    h = spark.createDataFrame([(1, 1, "p"), (2, 1, "q"), (3, 2, "p"), (4, 3, "r")], "id int, zetel int, wie string")
    return S.SemanticView({"f": (f, "id"), "z": (z, "id"), "h": (h, "id")}, [S.Relationship("z", "fractie", "f"), S.Relationship("h", "zetel", "z")],
                          {"Fractie": ("f", "naam"), "Wie": ("h", "wie")},
                          {"Stemmen": S.Metric("f", "sum", "stemmen"), "Zetels": S.Metric("z", "count_distinct", "id"), "Personen": S.Metric("h", "count_distinct", "wie")})


def test_metrics_do_not_fan_out(view, rows):
    got = view.query(["Fractie"], ["Stemmen", "Zetels", "Personen"])
    assert rows(got) == [("A", 10, 2, 2), ("B", 20, 1, 1), ("C", 5, None, None)]
    assert rows(view.query([], ["Stemmen"])) == [(35,)]
    # a parent's metric by a child's dimension counts each parent once per value
    assert rows(view.query(["Wie"], ["Stemmen"])) == [("p", 10), ("q", 10), ("r", 20)]


def test_view_filters_and_order(view, rows):
    assert rows(view.query(["Fractie"], ["Zetels"], where={"Wie": ["q", "r"]})) == [("A", 1), ("B", 1)]
    top = view.query(["Fractie"], ["Stemmen"], order_by=[("Stemmen", False)], limit=1)
    assert rows(top) == [("B", 20)]
    assert rows(view.query(["Fractie"])) == [("A",), ("B",), ("C",)]
    assert rows(view.query(["Fractie"], facts=["h.wie"])) == [("A", "p"), ("A", "p"), ("A", "q"), ("B", "r")]


def test_view_rejects_bad_names(view, spark):
    for call in ({}, {"dimensions": ["Nee"]}, {"metrics": ["Nee"]}, {"dimensions": ["Wie"], "where": {"Nee": 1}}, {"metrics": ["Stemmen"], "facts": ["h.wie"]}):
        with pytest.raises(ValueError):
            view.query(**call)
    df = spark.range(1)
    with pytest.raises(ValueError):
        S.SemanticView({"a": (df, "id"), "b": (df, "id")}, [S.Relationship("a", "id", "b"), S.Relationship("b", "id", "a")], {}, {})
    with pytest.raises(ValueError):
        S.SemanticView({"a": (df, "id")}, [], {"X": ("a", "zz")}, {})


def test_profile_and_duplicates_shuffle_no_text(spark):
    """Whole texts are neither a shuffle key of the profile nor of the search for duplicates."""
    df = spark.range(200).select("id", F.concat(F.lit("text "), (F.col("id") % 90).cast("string")).alias("v"), F.when(F.col("id") % 3 == 0, "a").alias("w"))
    for found in (Q.profile(df), Q.duplicate_candidates(df, ["v", "w"], "id")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and not any(f"{name}#" in line.split("hashpartitioning(")[1].split(")")[0] for line in exchanges for name in ("_v", "v", "w"))
    got = {(r.v, r.w): (r.aantal, r.eerste, r.laatste) for r in Q.duplicate_candidates(df, ["v", "w"], "id").collect()}
    want = {}
    for i in range(200):
        want.setdefault((f"text {i % 90}", "a" if i % 3 == 0 else None), []).append(i)
    assert got == {k: (len(v), v[0], v[-1]) for k, v in want.items() if len(v) > 1}


def test_null_and_empty_are_told_apart_by_digests(spark):
    rows = spark.createDataFrame([("x", None), (None, "x"), ("", "x"), (None, None)], "a string, b string")
    assert rows.select(*Q.digests(F.col("a"), F.col("b"))).distinct().count() == 4


def test_entity_columns_carry_their_metadata(spark):
    from plenaria.plans.catalog import ENTITIES
    spec = ENTITIES["fractie_zetel_persoon"]
    named = {f.name: f.metadata for f in spec.schema.fields}
    assert named["id"]["key"] and named["persoon_id"]["references"] == "persoon" and named["van_precisie"]["accepted"][0] == "dag"
    assert all(f.metadata.get("comment") for e in ENTITIES.values() for f in e.schema.fields)
    empty = spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema.fields]))
    kept = Q.contract_report(Q.enforce_contract(empty, spec.schema), spec.schema).collect()
    lost = Q.contract_report(empty, spec.schema).collect()
    assert all(r.metadata_ok for r in kept) and not any(r.metadata_ok for r in lost) and all(r.type_ok for r in lost)
