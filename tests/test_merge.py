from pyspark.sql import functions as F

from plenaria.operators import merge as M


def frame(spark, data):
    return spark.createDataFrame(data, "id int, naam string, n int")


def test_merge(spark, rows):
    target = frame(spark, [(1, "a", 1), (2, None, 2), (3, "c", 3), (4, "d", 4)])
    source = frame(spark, [(1, "a", 1), (2, "b", 2), (5, "e", None)])
    gone = spark.createDataFrame([(3,), (9,)], "id int")
    merged = M.merge_versions(target, source, ["id"], gone, status="wat")
    assert rows(merged) == [(1, "a", 1, "same"), (2, "b", 2, "changed"), (4, "d", 4, "same"), (5, "e", None, "new")]
    only = M.merge_versions(target, source, ["id"], delete_missing=True)
    assert rows(only) == [(1, "a", 1), (2, "b", 2), (5, "e", None)]
    # merging the same source twice changes nothing more
    once = M.merge_versions(target, source, ["id"], gone)
    assert rows(M.merge_versions(once, source, ["id"], gone)) == rows(once)


def test_merge_can_empty_a_value(spark, rows):
    merged = M.merge_versions(frame(spark, [(1, "a", 1)]), frame(spark, [(1, None, 1)]), ["id"], status="wat")
    assert rows(merged) == [(1, None, 1, "changed")]


def test_increment(spark, rows):
    df = frame(spark, [(1, "a", 1), (2, "b", 5), (3, "c", 9)])
    assert rows(M.increment(df, frame(spark, [(7, "x", 5)]), "n"), "id") == [(3,)]
    assert M.increment(df, frame(spark, []), "n").count() == 3


def test_retrigger(spark, rows):
    df = spark.createDataFrame([(1, "v1", 1), (2, "v2", 1), (3, "v3", 9)], "id int, fk string, n int")
    versions = spark.createDataFrame([("v1", 9), ("v2", 2)], "v string, changed int")
    target = spark.createDataFrame([(5,)], "n int")
    assert rows(M.retrigger(df, target, "n", "fk", versions, "v", "changed"), "id") == [(1,), (3,)]


def pair(spark, *data):
    return spark.createDataFrame(data, "id string, fk string")


def test_cascade_three_levels_and_bridge(spark, rows):
    tables = {"a": spark.createDataFrame([("1",), ("2",)], "id string"), "b": pair(spark, ("b1", "1"), ("b2", "2"), ("b3", None)), "c": pair(spark, ("c1", "b1"), ("c2", "b2")),
              "link": spark.createDataFrame([("c1", "x"), ("c2", "b1"), ("c2", "b2")], "c_id string, b_id string"), "other": pair(spark, ("o", "zz"))}
    keys = [M.ForeignKey("b", "fk", "a"), M.ForeignKey("c", "fk", "b"), M.ForeignKey("link", "c_id", "c"), M.ForeignKey("link", "b_id", "b")]
    left = M.cascade_delete(tables, keys, "a", spark.createDataFrame([("1",)], "id string"))
    assert rows(left["a"]) == [("2",)] and rows(left["b"], "id") == [("b2",), ("b3",)] and rows(left["c"], "id") == [("c2",)]
    assert rows(left["link"]) == [("c2", "b2")] and left["other"].count() == 1


def test_cascade_back_edge_is_emptied(spark, rows):
    # a document points at its current version, a version points at its document
    tables = {"version": pair(spark, ("v1", "d1"), ("v2", "d2")), "document": pair(spark, ("d1", "v1"), ("d2", "v2")), "note": pair(spark, ("n1", "d1"), ("n2", "d2"))}
    keys = [M.ForeignKey("version", "fk", "document"), M.ForeignKey("document", "fk", "version"), M.ForeignKey("note", "fk", "document")]
    left = M.cascade_delete(tables, keys, "document", spark.createDataFrame([("d1",)], "id string"))
    assert rows(left["document"]) == [("d2", "v2")] and rows(left["version"], "id") == [("v2",)] and rows(left["note"], "id") == [("n2",)]
    # the version v3 of a kept document may go; the document then loses its pointer only
    tables["document"] = pair(spark, ("d1", "v1"), ("d3", "v1"))
    left = M.cascade_delete(tables, keys, "document", spark.createDataFrame([("d1",)], "id string"))
    assert rows(left["document"]) == [("d3", None)]


def test_cascade_diamond_and_self_reference(spark, rows):
    tables = {"a": spark.createDataFrame([("1", None), ("2", "1"), ("3", "2"), ("4", None)], "id string, ouder string"), "b": pair(spark, ("b1", "3"), ("b4", "4")), "c": pair(spark, ("c1", "4"), ("c2", "b1")),
              "d": spark.createDataFrame([("d1", "b4", "c1"), ("d2", "b4", "cx")], "id string, b_id string, c_id string")}
    keys = [M.ForeignKey("a", "ouder", "a"), M.ForeignKey("b", "fk", "a"), M.ForeignKey("d", "b_id", "b"), M.ForeignKey("d", "c_id", "c")]
    left = M.cascade_delete(tables, keys, "a", spark.createDataFrame([("1",)], "id string"))
    assert rows(left["a"], "id") == [("4",)] and rows(left["b"], "id") == [("b4",)] and left["d"].count() == 2


def test_delete_order_is_parents_first():
    keys = [M.ForeignKey("d", "x", "b"), M.ForeignKey("d", "y", "c"), M.ForeignKey("c", "x", "b"), M.ForeignKey("b", "x", "a"), M.ForeignKey("a", "x", "d")]
    assert M._delete_order(keys, "a") == (["b", "c", "d"], True)
    order, acyclic = M._delete_order([M.ForeignKey("b", "x", "a"), M.ForeignKey("b", "y", "c"), M.ForeignKey("c", "x", "b")], "a")
    assert set(order) == {"b", "c"} and not acyclic


def test_cascade_follows_chains_of_any_length(spark, rows):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(20)] + [(100, None)], "id int, parent int")
    left = M.cascade_delete({"node": chain}, [M.ForeignKey("node", "parent", "node")], "node", spark.createDataFrame([(0,)], "id int"))
    assert rows(left["node"], "id") == [(100,)]


def test_cascade_reads_fewer_links_every_round(spark, rows, monkeypatch):
    # chains of 10 in one table take 4 rounds of jumps, and chains over two tables that refer to each other 10 rounds
    chains = spark.createDataFrame([(i, i - 1 if i % 10 else None) for i in range(1000)], "id int, parent int")
    sizes, real = [], M.stored

    def counted(df):
        out = real(df)
        if out.columns == ["_gone", "_to"]:
            sizes.append(out.count())
        return out
    monkeypatch.setattr(M, "stored", counted)
    start = chains.where("parent IS NULL AND id < 500").select("id")
    left = M.cascade_delete({"node": chains}, [M.ForeignKey("node", "parent", "node")], "node", start)
    assert left["node"].count() == 500 and len(sizes) <= 6 and sizes == sorted(sizes, reverse=True) and sizes[-1] == 0
    sizes.clear()
    even, odd = (chains.where(f"id % 2 = {k}") for k in (0, 1))
    keys = [M.ForeignKey("odd", "parent", "even"), M.ForeignKey("even", "parent", "odd"), M.ForeignKey("even", "id", "first")]
    left = M.cascade_delete({"first": chains.where("parent IS NULL").select("id"), "even": even, "odd": odd}, keys, "first", start)
    assert left["even"].count() + left["odd"].count() == 500 and sum(sizes) < 10 * 1000 and sizes[-1] < sizes[0]


def test_cascade_ends_on_a_circle_of_rows(spark, rows):
    nodes = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (10, None), (11, 10), (12, 11), (20, 99)], "id int, parent int")
    left = M.cascade_delete({"node": nodes}, [M.ForeignKey("node", "parent", "node")], "node", spark.createDataFrame([(10,)], "id int"))
    assert {r.id for r in left["node"].collect()} == {1, 2, 3, 20}
    left = M.cascade_delete({"node": nodes}, [M.ForeignKey("node", "parent", "node")], "node", spark.createDataFrame([(2,)], "id int"))
    assert {r.id for r in left["node"].collect()} == {10, 11, 12, 20}


def test_cascade_over_a_circle_of_tables(spark, rows):
    # person -> seat -> person: every kept or lost row is reached over both references
    tables = {"root": spark.createDataFrame([("r1",), ("r2",)], "id string"),
              "p": spark.createDataFrame([("p1", "r1", None), ("p2", "r2", "s1"), ("p3", "r2", "s2"), ("p4", "r2", None)], "id string, root_id string, s_id string"),
              "s": spark.createDataFrame([("s1", "p1"), ("s2", "p2"), ("s3", "p4")], "id string, p_id string")}
    keys = [M.ForeignKey("p", "root_id", "root"), M.ForeignKey("p", "s_id", "s"), M.ForeignKey("s", "p_id", "p")]
    left = M.cascade_delete(tables, keys, "root", spark.createDataFrame([("r1",)], "id string"))
    assert rows(left["p"], "id") == [("p4",)] and rows(left["s"], "id") == [("s3",)]
