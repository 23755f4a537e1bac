"""Interval operators against brute force on random data with a hot key, overlaps and open ends."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from plenaria.operators import intervals as I
from plenaria.operators import sequence as Q

BASE = date(2000, 1, 1)


def day(n):
    return BASE + timedelta(days=n)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    members = []
    for i in range(400):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(12)}"
        start = rng.randrange(900)
        end = None if rng.random() < 0.1 else start + rng.randrange(-5, 200)
        members.append((i, key, rng.choice("abcde"), day(start), None if end is None else day(end)))
    members.append((400, None, "a", day(0), None))
    members.append((401, "k1", None, day(0), None))
    points = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(14)}", day(rng.randrange(1000))) for i in range(300)] + [(300, None, day(5)), (301, "k1", None)]
    m = spark.createDataFrame(members, "m int, key string, wie string, van date, tot date")
    p = spark.createDataFrame(points, "p int, key string, d date")
    return members, points, m, p


def covers(start, end, d):
    return d is not None and start <= d and (end is None or d <= end)


def test_interval_join(data):
    members, points, m, p = data
    want = sorted((q[0], x[0]) for q in points for x in members if x[1] is not None and x[1] == q[1] and covers(x[3], x[4], q[2]))
    for width in (1, 31, 400):
        got = sorted((r.p, r.m) for r in I.interval_join(p, m, ["key"], "d", "van", "tot", slot_days=width).collect())
        assert got == want
    left = I.interval_join(p, m, ["key"], "d", "van", "tot", "left").collect()
    assert {r.p for r in left} == {q[0] for q in points}
    assert sorted((r.p, r.m) for r in left if r.m is not None) == want


def test_slots_of_an_interval(spark):
    """Slots cover an interval exactly, and their number does not grow with its length."""
    rng = random.Random(1)
    ends = sorted(rng.randrange(0, 1000) for _ in range(2)), [0, 0], [0, 1023], [5, 5], [32, 63], [31, 64], [256, 511], [-300, 700], [-1024, 1023]
    spans = spark.createDataFrame([tuple(e) for e in ends], "a long, b long").select("a", "b", I.cover(F.col("a"), F.col("b")).alias("s")).collect()
    for r in spans:
        width = lambda key: I.FAN ** (key % I.LEVELS)
        covered = [n for key in r.s for n in range(key // I.LEVELS * width(key), (key // I.LEVELS + 1) * width(key))]
        assert sorted(covered) == list(range(r.a, r.b + 1)) and len(r.s) <= I.MOST_SLOTS
    days = spark.createDataFrame([(date(1990, 1, 1) + timedelta(n), date(1990, 1, 1) + timedelta(n + 30 * 365)) for n in range(0, 600, 7)], "a date, z date")
    rows = days.select(F.size(I.cover(I._slot(F.col("a"), I.SLOT_DAYS), I._slot(F.col("z"), I.SLOT_DAYS))).alias("n"))
    most = rows.agg(F.max("n"), F.min("n")).first()
    assert most[0] <= 80 < 30 * 365 // I.SLOT_DAYS and I.MOST_SLOTS == 126


def test_interval_join_reads_each_input_once(spark, tmp_path):
    spark.createDataFrame([(k, date(1960 + k, 1, 1), None if k % 3 else date(1995 + k, 1, 1)) for k in range(30)], "m int, a date, z date").withColumn("key", F.lit("x")).write.parquet(f"{tmp_path}/m")
    spark.createDataFrame([(k, date(1800 + k, 6, 1)) for k in range(500)] + [(900, None)], "p int, d date").withColumn("key", F.lit("x")).write.parquet(f"{tmp_path}/p")
    points, members = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("p", "m"))
    joined = I.interval_join(points, members, ["key"], "d", "a", "z")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    brute = points.crossJoin(members.drop("key")).where("d >= a AND (z IS NULL OR d <= z)").select("p", "m")
    assert sorted(map(tuple, joined.select("p", "m").collect())) == sorted(map(tuple, brute.collect()))
    years = points.select("key", "p", F.year("d").alias("y"))
    found = I.year_membership(years, members, ["key"], "y", "a", "z")
    brute = years.crossJoin(members.drop("key")).where("y >= year(a) AND (z IS NULL OR y <= year(z))").select("p", "m")
    assert sorted(map(tuple, found.where("m IS NOT NULL").select("p", "m").collect())) == sorted(map(tuple, brute.collect()))
    assert found.select("p").distinct().count() == 501


def test_interval_join_latest(data):
    members, points, m, p = data
    want = {}
    for q in points:
        hits = [x for x in members if x[1] is not None and x[1] == q[1] and covers(x[3], x[4], q[2])]
        if hits:
            want[q[0]] = max(hits, key=lambda x: (x[3], x[0]))[0]
    got = I.interval_join(p, m, ["key"], "d", "van", "tot", on_overlap="latest", row_key=["p"], order=["m"]).collect()
    assert {r.p: r.m for r in got} == want


def test_year_membership(spark, data):
    members, _, m, _ = data
    facts = spark.createDataFrame([(i, k, 1999 + i % 6) for i, k in enumerate(["hot", "k1", "k2", "none"] * 6)], "f int, key string, jaar int")
    want = sorted((f.f, x[0]) for f in facts.collect() for x in members if x[1] == f.key and x[3].year <= f.jaar <= (9999 if x[4] is None else x[4].year))
    got = I.year_membership(facts, m, ["key"], "jaar", "van", "tot").collect()
    assert sorted((r.f, r.m) for r in got if r.m is not None) == want
    assert len({r.f for r in got}) == facts.count()


def test_count_active_counts_each_person_once(data):
    members, points, m, p = data
    got = {r.p: r.n for r in I.count_active(p, m, ["key"], "d", "van", "tot", ["wie"], "n").collect()}
    for q in points:
        want = len({x[2] for x in members if x[1] is not None and x[1] == q[1] and x[2] is not None and covers(x[3], x[4], q[2])})
        assert got[q[0]] == want


def test_merge_intervals_is_disjoint(data):
    members, _, m, _ = data
    merged = [tuple(r) for r in I.merge_intervals(m, ["key"], "van", "tot").where("key = 'hot'").orderBy("van").collect()]
    for (_, _, end), (_, start, _) in zip(merged, merged[1:]):
        assert end is not None and end < start
    days = {n for x in members if x[1] == "hot" for n in range(1200) if covers(x[3], x[4], day(n))}
    assert {n for _, a, z in merged for n in range(1200) if covers(a, z, day(n))} == days


@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbour(data, direction):
    members, _, m, _ = data
    out = Q.neighbour(m, ["key"], ["van", "m"], F.trunc("van", "MM"), {"bij": "m"}, direction)
    got = {r.m: r.bij for r in out.collect()}
    want = {}
    for key in {x[1] for x in members}:
        ordered = [x[0] for x in sorted((x for x in members if x[1] == key), key=lambda x: (x[3], x[0]))]
        if direction == "next":
            ordered.reverse()
        for previous, here in zip([None] + ordered, ordered):
            want[here] = previous if key is not None else None
    assert got == want


@pytest.mark.parametrize("direction", ["previous", "next"])
def test_neighbour_of_one_key_with_null_order(spark, direction):
    """One key has all rows, some without a day; the neighbour of a slot's edge stands in another one."""
    rows = [(n, None if n < 5 else day(n * 3)) for n in range(200)]
    df = spark.createDataFrame([("k", n, d) for n, d in rows], "key string, m int, van date").repartition(8)
    got = {r.m: r.bij for r in Q.neighbour(df, ["key"], ["van", "m"], F.trunc("van", "MM"), {"bij": "m"}, direction).collect()}
    step = -1 if direction == "previous" else 1
    assert got == {n: n + step if 0 <= n + step < 200 else None for n in range(200)}


def test_neighbour_runs_nothing_before_it_is_asked(spark):
    df = spark.range(1000).select(F.lit(1).alias("key"), F.col("id").alias("m"), F.date_add(F.lit(BASE), F.col("id").cast("int")).alias("van"))
    def jobs():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("neighbour"))
    spark.sparkContext.setJobGroup("neighbour", "none expected")
    try:
        Q.neighbour(df, ["key"], ["van", "m"], F.trunc("van", "MM"), {"bij": "m"})
        assert jobs() == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_surrogate_key_is_total_and_dense(spark):
    # one value holds most rows, so a partition per value would not do
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 8, F.lit(1)).when(F.col("id") % 10 == 8, F.col("id")).alias("v"), "id")
    got = Q.surrogate_key(df, [F.col("v").desc_nulls_last(), F.col("id").asc()], "nr").orderBy("nr").collect()
    assert [r.nr for r in got] == list(range(1, 5001))
    assert [r.id for r in got] == [r.id for r in sorted(got, key=lambda r: (r.v is None, -(r.v or 0), r.id))]


def test_dense_key(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string")
    assert rows(Q.dense_key(df, ["v"], "nr")) == [(1, "a"), (2, "b"), (3, None)]


def test_until_bounds_open_intervals_only(spark):
    points = spark.createDataFrame([(1, date(2020, m, d)) for m, d in ((1, 5), (1, 12), (6, 1))], "k int, at date")
    members = spark.createDataFrame([(1, "open", date(2020, 1, 1), None), (1, "closed", date(2020, 1, 1), date(2020, 12, 31))], "k int, name string, a date, z date")
    found = I.interval_join(points, members, ["k"], "at", "a", "z", until=date(2020, 1, 10)).select("at", "name").collect()
    assert sorted((r["at"].isoformat(), r["name"]) for r in found) == [
        ("2020-01-05", "closed"), ("2020-01-05", "open"), ("2020-01-12", "closed"), ("2020-06-01", "closed")]


def test_slots_are_not_broadcast(spark, data):
    """However few interval rows there are by estimate, their slots do not pass through the driver."""
    _, _, m, p = data
    for how in ("inner", "left"):
        joined = I.interval_join(p, m, ["key"], "d", "van", "tot", how)
        at = joined._jdf.queryExecution().executedPlan().toString()
        slots = [line for line in at.splitlines() if "_at_slot" in line and "Join" in line]
        assert slots and all("SortMergeJoin" in line for line in slots)


def test_left_join_stores_few_columns(data):
    """Dated rows are stored in columns, and only their number, keys and date are read to look for intervals."""
    _, _, m, p = data
    wide = p.withColumn("lang", F.lit("x" * 50))
    plan = I.interval_join(wide, m, ["key"], "d", "van", "tot", "left")._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(reads) == 2 and sum("lang" in line for line in reads) == 1


def test_groups_on_day(spark, data):
    """Equal rows and intervals are counted, far days share a chunk, and rows without key or date match nothing."""
    members, points, m, p = data
    closed = [(k, w, s, e or day(2000)) for _, k, w, s, e in members] + [("k1", "a", date(1500, 1, 1), date(9999, 12, 31)), ("k1", "a", day(3), day(3))] * 2
    dated = [(k, d) for _, k, d in points] * 2 + [("k1", date(1700, 5, 5)), ("k1", date(9999, 12, 31)), ("k1", day(3))]
    details = [(f"k{i}", f"name {i}") for i in range(10)] + [("hot", None), ("k2", "other"), (None, "nobody")]
    found = I.groups_on_day(spark.createDataFrame(dated, "key string, d date"), spark.createDataFrame(closed, "key string, wie string, van date, tot date"),
                            spark.createDataFrame(details, "key string, name string"), ["key"], "d", "wie", "van", "tot", "n")
    expected = {}
    for key, d in dated:
        for k, w, s, e in closed:
            for name in (n for i, n in details if key is not None and i == key and k == key and covers(s, e, d)):
                expected[key, d, w, name] = expected.get((key, d, w, name), 0) + 1
    rows = [tuple(r) for r in found.select("key", "d", "wie", "name", "n").collect()]
    got = {r[:4]: r[4] for r in rows}
    assert [(k, v) for k, v in expected.items() if got.get(k) != v] == [] and len(rows) == len(expected)


def test_trips_are_shuffled_once(spark):
    """After their own grouping trips are shuffled to their chunk of time alone, as one row each."""
    from plenaria.queries import registry

    trips = registry()["z_travel_trips"](spark, "/root/testdata/sf0.001")
    plan = trips._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    shuffled = [x for x in plan.split("\n\n") if x.lstrip().startswith("(") and ") Exchange" in x and "bestemming#" in x]
    assert len(shuffled) == 1
