from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plenaria.functions import dates as D
from plenaria.functions import numbers as N

CASES = [
    ("1980-03-14", "1980-03-14", "1980-03-14", "dag"), ("1980-03", "1980-03-01", "1980-03-31", "maand"),
    ("1980-02", "1980-02-01", "1980-02-29", "maand"), ("1980", "1980-01-01", "1980-12-31", "jaar"),
    ("1980-W11", "1980-03-10", "1980-03-16", "week"), ("1980-W11-4", "1980-03-13", "1980-03-13", "week_dag"),
    ("2020-W53", "2020-12-28", "2021-01-03", "week"), ("2023-W53", "2024-01-01", "2024-01-07", "week"),
    ("2021-W01", "2021-01-04", "2021-01-10", "week"), ("", None, None, None), (None, None, None, None),
    ("80-3-1", None, None, None), ("2023-02-30", None, None, "dag"), ("2023-13", None, None, "maand"),
]


def test_partial_dates(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "t string")
    out = df.select("t", D.parse_partial_date(F.col("t")).alias("a"), D.parse_partial_date(F.col("t"), True).alias("z")).collect()
    for (text, start, end, tag), row in zip(CASES, out):
        assert (row.a.datum and row.a.datum.isoformat()) == start, text
        assert (row.z.datum and row.z.datum.isoformat()) == end, text
        assert row.a.precisie == row.z.precisie == tag, text


def test_week_dates_agree_with_calendar(spark):
    df = spark.range(1, 53).select(D.iso_week_date(F.lit(2015), F.col("id").cast("int"), F.lit(3)).alias("d"), "id")
    assert all(r.d == date.fromisocalendar(2015, r.id, 3) for r in df.collect())


@pytest.mark.parametrize("day,expected", [(date(2023, 9, 1), "2023-2024"), (date(2023, 8, 31), "2022-2023")])
def test_session_year(spark, day, expected):
    assert spark.range(1).select(D.session_year(F.lit(day))).first()[0] == expected


def test_interval_ends_are_inclusive(spark):
    df = spark.createDataFrame([(date(2020, 1, 1), date(2020, 1, 31)), (date(2020, 1, 1), None)], "van date, tot date")

    def at(day):
        return [r[0] for r in df.select(D.active_at(F.col("van"), F.col("tot"), F.lit(day))).collect()]

    assert at(date(2020, 1, 1)) == [True, True] and at(date(2020, 1, 31)) == [True, True]
    assert at(date(2020, 2, 1)) == [False, True] and at(date(2019, 12, 31)) == [False, False]


def test_differences(spark):
    one = spark.range(1)
    a, b = F.lit(datetime(2024, 1, 1, 10, 0, 59)), F.lit(datetime(2024, 1, 1, 10, 1, 0))
    assert one.select(D.minutes_between(a, b)).first()[0] == 1
    assert one.select(D.minutes_between(b, a)).first()[0] == -1
    x, y = F.lit(date(2000, 12, 31)), F.lit(date(2001, 1, 1))
    assert one.select(D.year_boundaries(x, y), D.completed_years(x, y)).first() == (1, 0)
    assert one.select(D.date_key(F.lit(None).cast("date")), D.date_key(x)).first() == (-1, 20001231)


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 30, 31, 182, 183, None)], "v int")
    got = [r[0] for r in df.select(N.cut(F.col("v"), [-1, 30, 182], ["a", "b"])).collect()]
    assert got == [None, "a", "a", "b", "b", None, None]


def test_annualise_first_keyword_wins(spark):
    df = spark.createDataFrame([("Per maand", 10.0), ("Per dag", 10.0), ("Vrije invoer", 10.0), (None, 10.0)], "f string, b double")
    assert [r[0] for r in df.select(N.annualise(F.col("b"), F.col("f"), {"maand": 12, "dag": 4})).collect()] == [120.0, 40.0, 10.0, 10.0]
