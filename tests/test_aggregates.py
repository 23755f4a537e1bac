import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plenaria.operators import aggregates as A
from plenaria.operators import filters as L
from plenaria.operators import graph as G
from plenaria.operators import pairs as P
from plenaria.operators import reshape as R
from plenaria.operators import sampling as S
from plenaria.plans import seats, votes as V


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.6 else rng.choice("abc"), rng.choice([0.0, 1.0, rng.lognormvariate(3, 2), rng.lognormvariate(0, 1)])) for _ in range(20000)]
    data += [("one", 5.0), ("two", 1.0), ("two", 2.0), ("empty", None), (None, 3.0), (None, 9.0), ("const", 4.0), ("const", 4.0)]
    return data, spark.createDataFrame(data, "g string, v double")


@pytest.mark.parametrize("few", [True, False])
def test_quantiles_equal_numpy(numbers, few):
    data, df = numbers
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    groups = defaultdict(list)
    for g, v in data:
        if v is not None:
            groups[g].append(v)
    got = {r.g: r for r in A.quantiles(df, ["g"], "v", probs, few_values=few).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-9), (g, name)


def test_quantiles_without_groups_over_few_and_many_ranges(numbers):
    data, df = numbers
    values = [v for _, v in data if v is not None]
    for ranges in (1, 7, 60):
        row = A.quantiles(df, [], "v", {"a": 0.1, "b": 0.75}, ranges=ranges).first()
        assert (row.a, row.b) == pytest.approx((np.quantile(values, 0.1), np.quantile(values, 0.75)))


def test_fences(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "v double")
    assert rows(A.iqr_filter(df, "v")) == [(1.0,), (2.0,), (3.0,), (4.0,)]
    flat = spark.createDataFrame([(2.0,)] * 4, "v double")
    # both fences fall on the constant, and values on a fence are dropped
    assert A.iqr_filter(flat, "v").count() == 0
    assert rows(A.quantile_cut(df, "v", 0.5)) == [(1.0,), (2.0,), (3.0,)]


def test_argmax_ties(spark, rows):
    df = spark.createDataFrame([("x", "b", 1), ("x", "a", 1), ("y", "b", 3), ("y", "a", 1)], "g string, v string, w int")
    assert rows(A.argmax_by(df, ["g"], "v", F.sum("w"))) == [("x", "a"), ("y", "b")]


def test_shares_sum_to_hundred(spark):
    df = spark.range(777).withColumn("k", F.col("id") % 7)
    assert A.share(df, ["k"], digits=6).agg(F.sum("aandeel")).first()[0] == pytest.approx(100, abs=1e-4)


def test_top_with_other(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 3), ("d", 2)], "k string, n bigint")
    assert rows(A.top_with_other(df, "k", "n", 2, "rest")) == [("a", 5), ("b", 4), ("rest", 5)]
    assert rows(A.top_with_other(df, "k", "n", 4, "rest")) == [("a", 5), ("b", 4), ("c", 3), ("d", 2)]


def test_margins_and_pivot(spark, rows):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "p")], "a string, b string")
    assert rows(R.margins(df, "a", "b")) == [("totaal", "p", 2), ("totaal", "q", 1), ("totaal", "totaal", 3), ("x", "p", 1), ("x", "q", 1), ("x", "totaal", 2), ("y", "p", 1), ("y", "totaal", 1)]
    assert rows(R.pivot_counts(df, ["a"], "b", ["p", "z"])) == [("x", 1, 0, 2), ("y", 1, 0, 1)]
    assert rows(R.crosstab(df, "a", "b", ["p", "q"])) == [("x", 50.0, 50.0), ("y", 100.0, 0.0)]


@pytest.mark.parametrize("part", [2, 256])
def test_co_occurrence_against_pairs(spark, part):
    rng = random.Random(5)
    groups = {g: {i: rng.choice([-1, 1]) for i in rng.sample(range(90), rng.randrange(1, 12))} for g in range(200)}
    df = spark.createDataFrame([(g, f"i{i:02d}", s) for g, items in groups.items() for i, s in items.items()] + [(None, "i01", 1)], "g int, i string, s int")
    want = defaultdict(lambda: [0, 0])
    for items in groups.values():
        for a in items:
            for b in items:
                if a < b:
                    want[(f"i{a:02d}", f"i{b:02d}")][0] += 1
                    want[(f"i{a:02d}", f"i{b:02d}")][1] += items[a] == items[b]
    got = {(r.a, r.b): [r.samen, r.gelijk] for r in P.co_occurrence(df, "g", "i", "s", part_items=part).collect()}
    assert got == dict(want)
    # repeated rows of an unsigned relation count once
    got = {(r.a, r.b): r.samen for r in P.co_occurrence(df.unionByName(df), "g", "i", part_items=part).collect()}
    assert got == {k: v[0] for k, v in want.items()}


def test_co_occurrence_of_a_large_group_and_many_items(spark):
    # one group holds 1,500 items and 9,000 more come in pairs: more items than any list on the driver should hold
    large = spark.range(1500).select(F.lit(-1).cast("long").alias("g"), F.col("id").alias("i"))
    small = spark.range(9000).select((F.col("id") % 4500).alias("g"), (F.col("id") + 10_000).alias("i"))
    twice = spark.createDataFrame([(-2, 3), (-2, 7), (-3, 3), (-3, 7), (-3, 9)], "g long, i long")
    df = large.unionByName(small).unionByName(twice)
    found = P.co_occurrence(df, "g", "i", part_items=100)
    assert found.where("samen = 1").count() == 1500 * 1499 // 2 - 3 + 4500 and found.where("samen = 3").collect() == [(3, 7, 3)]
    assert sorted(map(tuple, P.co_occurrence(df, "g", "i", least=2, part_items=100).collect())) == [(3, 7, 3), (3, 9, 2), (7, 9, 2)]
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_components(spark):
    nodes = spark.createDataFrame([(n,) for n in range(40)], "node int")
    # a long chain, a cycle and isolated nodes
    edges = [(i, i + 1) for i in range(20)] + [(25, 26), (26, 27), (27, 25)]
    got = {r.node: r.component for r in G.connected_components(nodes, spark.createDataFrame(edges, "a int, b int")).collect()}
    assert all(got[i] == 0 for i in range(21)) and got[25] == got[26] == got[27] == 25
    assert all(got[i] == i for i in [21, 24, 28, 39])


def test_components_of_a_long_path_and_a_hub(spark):
    path = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("a"), ((F.col("id") + 1) * 7919 % 100_003).alias("b"))
    hub = spark.range(1_000_000).select(F.lit(5_000_000).cast("long").alias("a"), (F.col("id") + 1_000_000).alias("b"))
    edges = path.unionAll(hub)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node"))
    found = G.connected_components(nodes, edges).groupBy("component").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r.component, r.n) for r in found) == [(0, 100_001), (1_000_000, 1_000_001)]


def test_components_against_brute_force(spark):
    rng = random.Random(9)
    for n, m in ((60, 40), (200, 190), (50, 300)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        root = list(range(n))
        for _ in range(n):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        got = {r.node: r.component for r in G.connected_components(spark.range(n).withColumnRenamed("id", "node"), spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert got == dict(enumerate(root))


VOTE = "besluit_id int, fractie_id string, persoon_id string, soort string, fractie_grootte int, vergissing boolean"


def test_vote_rules(spark, rows):
    df = spark.createDataFrame([
        (1, "A", None, "Voor", 10, False), (1, "B", None, "Tegen", 10, False), (1, "C", None, "Tegen", None, False),
        (2, "A", None, "Voor", 5, True), (3, "A", None, "Tegen", 3, None), (3, "B", None, "Voor", 2, False), (4, "A", None, "Niet deelgenomen", 9, False)], VOTE)
    positions = V.faction_position(df)
    # mistakes, unknown flags and other options do not count; a missing size weighs 1
    assert rows(positions, "besluit_id", "fractie_id", "soort") == [(1, "A", "Voor"), (1, "B", "Tegen"), (1, "C", "Tegen"), (3, "B", "Voor")]
    assert rows(V.majority(positions)) == [(1, "Tegen"), (3, "Voor")]
    # the row version keeps votes with an unknown flag
    assert rows(V.majority(V.member_weighted(df))) == [(1, "Tegen"), (3, "Tegen")]
    tie = spark.createDataFrame([(1, "A", None, "Voor", 4, False), (1, "B", None, "Tegen", 4, False)], VOTE)
    assert rows(V.majority(V.faction_position(tie))) == [(1, "Tegen")]
    filtered = V.against_majority(df, 1, ["A"])
    assert rows(filtered) == [("A", 1, 1, 100.0)]


def test_agreement_extremes(spark, rows):
    votes = [(b, f, None, s, 1, False) for b in range(4) for f, s in (("A", "Voor"), ("B", "Voor"), ("C", "Tegen"))] + [(9, "D", None, "Voor", 1, False)] * 1
    got = rows(V.agreement(spark.createDataFrame(votes, VOTE), 1))
    assert got == [("A", "B", 4, 4, 100.0), ("A", "C", 4, 0, 0.0), ("B", "C", 4, 0, 0.0)]


def test_switches(spark, rows):
    from datetime import date

    df = spark.createDataFrame([("p", "A", date(2000, 1, 1), 1), ("p", "B", date(2001, 1, 1), 2), ("p", "A", date(2002, 1, 1), 3), ("q", "A", date(2000, 1, 1), 4), ("q", "A", date(2001, 1, 1), 5)],
                               "persoon_id string, fractie string, van date, lid_id int")
    assert rows(seats.switch_counts(df, ("van", "lid_id"))) == [("p", 2)]
    assert rows(seats.in_several_factions(df)) == [("p", 2, "A, B")]


def test_previous_row_is_not_previous_year(spark, rows):
    from datetime import date

    df = spark.createDataFrame([("A", "p", date(2000, 1, 1), date(2000, 5, 1)), ("A", "p", date(2003, 1, 1), date(2003, 2, 1)), ("A", "q", date(2003, 1, 1), None)], "fractie string, persoon_id string, van date, tot_en_met date")
    assert rows(seats.yearly_seats(df, 2000, 2004)) == [("A", 2000, 1, None, None), ("A", 2003, 2, 1, 1), ("A", 2004, 1, 2, -1)]


def test_parametric_and_star(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "a", 9)], "k int, s string, n int")
    assert rows(L.parametric(df, {"s": "a", "n": (5, 8), "k": None}), "k") == [(1,)]
    assert rows(L.parametric(df, {"k": [2, 3]}), "k") == [(2,), (3,)]
    dim, bridge = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "s string, kind string"), spark.createDataFrame([(1, 7), (2, 8)], "k int, z int")
    star = L.cross_filter(L.Star(df, {"d": (dim, "s", "s")}, {"b": (bridge, "k", "k")}), {"d": F.col("kind") == "x"})
    assert rows(star.fact, "k") == [(1,), (3,)] and rows(star.dims["d"][0], "s") == [("a",)] and rows(star.bridges["b"][0], "z") == [(7,)]


def test_samples_repeat(spark):
    df = spark.range(1000)
    a, b = S.one_in(df, F.col("id"), 10), S.one_in(df.repartition(7), F.col("id"), 10)
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect()) and 50 < a.count() < 200
    assert S.smallest_hashes(df, F.col("id"), 20, 1).collect() != S.smallest_hashes(df, F.col("id"), 20, 2).collect()
    assert S.distinct_sample(df.withColumn("g", F.col("id") % 8), ["g"], 50).count() == 8


def test_argmax_puts_null_weights_last(spark, rows):
    df = spark.createDataFrame([("g", "a", 5), ("g", "b", None), ("h", "c", None)], "k string, v string, w int")
    assert rows(A.argmax_by(df, ["k"], "v", F.sum("w"))) == [("g", "a"), ("h", "c")]


def test_pair_tasks_grow_with_pairs(spark):
    """A task holds a bounded number of pairs: more pairs are expanded and counted by more tasks, with the same counts."""
    rows = [(g, (g * 7 + i * i) % 300) for g in range(60) for i in range(40)]
    df = spark.createDataFrame(rows, "g int, i int")
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few, many = P.co_occurrence(df, "g", "i"), P.co_occurrence(df, "g", "i", pairs_a_task=500)
    assert many.rdd.getNumPartitions() > 10 * usual
    want = {}
    for g in range(60):
        items = sorted({i for h, i in rows if h == g})
        for n, a in enumerate(items):
            for b in items[n + 1:]:
                want[a, b] = want.get((a, b), 0) + 1
    for found in (few, many):
        assert {(r.a, r.b): r.samen for r in found.collect()} == want
