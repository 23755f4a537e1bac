"""Dates, partial dates and interval predicates."""

from datetime import date

from pyspark.sql import functions as F

from plenaria.functions import dates as D
from plenaria.queries import Tables, query
from plenaria.queries import standins as s

# six text forms of the order date, the last one unreadable
_FORMS_SQL = """forms AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE o_orderkey % 6
  WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y')
  WHEN 3 THEN strftime(o_orderdate, '%G-W%V') WHEN 4 THEN strftime(o_orderdate, '%G-W%V-%u') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS ruw FROM orders)"""


def _forms(t: Tables):
    d = F.col("o_orderdate").cast("date")
    week = F.weekofyear(d)
    # the ISO year is the year of the week's Thursday
    iso_year = F.year(F.date_add(d, 3 - F.weekday(d)))
    iso = F.concat(iso_year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))
    form = F.col("o_orderkey") % 6
    text = (F.when(form == 0, F.date_format(d, "yyyy-MM-dd")).when(form == 1, F.date_format(d, "yyyy-MM")).when(form == 2, F.date_format(d, "yyyy"))
            .when(form == 3, iso).when(form == 4, F.concat(iso, F.lit("-"), D.iso_weekday(d).cast("string"))).otherwise(F.date_format(d, "dd/MM/yyyy")))
    return t.orders.select("o_orderkey", text.alias("ruw"))


_PRECISION = """CASE o_orderkey % 6 WHEN 0 THEN 'dag' WHEN 1 THEN 'maand' WHEN 2 THEN 'jaar' WHEN 3 THEN 'week' WHEN 4 THEN 'week_dag' END"""


@query("t1_partial_date", f"""WITH {_FORMS_SQL} SELECT o_orderkey, ruw, {_PRECISION} AS precisie, CASE o_orderkey % 6 WHEN 0 THEN d
  WHEN 1 THEN CAST(date_trunc('month', d) AS DATE) WHEN 2 THEN CAST(date_trunc('year', d) AS DATE)
  WHEN 3 THEN CAST(date_trunc('week', d) AS DATE) WHEN 4 THEN d END AS datum FROM forms""")
def partial_start(t: Tables):
    return _forms(t).withColumn("p", D.parse_partial_date(F.col("ruw"))).select("o_orderkey", "ruw", "p.datum", "p.precisie")


@query("t1_partial_date_end", f"""WITH {_FORMS_SQL} SELECT o_orderkey, ruw, {_PRECISION} AS precisie, CASE o_orderkey % 6 WHEN 0 THEN d
  WHEN 1 THEN last_day(d) WHEN 2 THEN make_date(year(d), 12, 31) WHEN 3 THEN CAST(date_trunc('week', d) AS DATE) + 6 WHEN 4 THEN d END AS datum FROM forms""")
def partial_end(t: Tables):
    return _forms(t).withColumn("p", D.parse_partial_date(F.col("ruw"), True)).select("o_orderkey", "ruw", "p.datum", "p.precisie")


@query("t2_iso_week_date", """
SELECT o_orderkey, CAST(make_date(y, 1, 4) - CAST((isodow(make_date(y, 1, 4)) - 1) - (w - 1) * 7 - (k - 1) AS INTEGER) AS DATE) AS datum
FROM (SELECT o_orderkey, year(o_orderdate) AS y, 1 + o_orderkey % 53 AS w, 1 + o_orderkey % 7 AS k FROM orders)""")
def week_dates(t: Tables):
    week, weekday = (1 + F.col("o_orderkey") % 53).cast("int"), (1 + F.col("o_orderkey") % 7).cast("int")
    return t.orders.select("o_orderkey", D.iso_week_date(F.year("o_orderdate"), week, weekday).alias("datum"))


@query("t3_datediff", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS dagen
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def day_difference(t: Tables):
    joined = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", D.days_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("dagen"))


@query("t4_minutes", f"WITH {s.ACTIVITIES_SQL} SELECT id, date_diff('minute', aanvangstijd, eindtijd) AS minuten FROM activities")
def minute_difference(t: Tables):
    return s.activities(t).select("id", D.minutes_between(F.col("aanvangstijd"), F.col("eindtijd")).alias("minuten"))


@query("t5_year_diff", """
SELECT o_orderkey, date_diff('year', CAST(o_orderdate AS DATE), DATE '2026-10-08') AS grenzen, date_sub('year', CAST(o_orderdate AS DATE), DATE '2026-10-08') AS voltooid FROM orders""")
def year_difference(t: Tables):
    d, until = s.day("o_orderdate"), F.lit(date(2026, 10, 8))
    return t.orders.select("o_orderkey", D.year_boundaries(d, until).alias("grenzen"), D.completed_years(d, until).alias("voltooid"))


@query("t6_years", """
SELECT o_orderkey, round(date_diff('day', CAST(o_orderdate AS DATE), DATE '2026-10-10') / 365.25, 1) AS jaren,
  round(greatest(date_diff('day', DATE '2026-10-10', CAST(o_orderdate AS DATE)) / 365.25, 0.01), 2) AS minstens FROM orders""")
def years(t: Tables):
    d, until = s.day("o_orderdate"), F.lit(date(2026, 10, 10))
    return t.orders.select("o_orderkey", D.years_between(d, until).alias("jaren"), D.years_between(until, d, digits=2, floor=0.01).alias("minstens"))


@query("t7_date_parts", """
SELECT o_orderkey, year(d) AS jaar, quarter(d) AS kwartaal, month(d) AS maand, day(d) AS dag, weekofyear(d) AS weeknummer, isodow(d) AS dagnr,
  strftime(d, '%A') AS dagnaam, strftime(d, '%Y-%m') AS jaar_maand, CAST(date_trunc('month', d) AS DATE) AS maand_start
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_parts(t: Tables):
    names = ["jaar", "kwartaal", "maand", "dag", "weeknummer", "dagnr", "dagnaam", "jaar_maand", "maand_start"]
    return t.orders.select("o_orderkey", *D.date_attributes(s.day("o_orderdate"), names))


@query("t8_date_key", f"""
WITH {s.MEMBERS_SQL} SELECT lid_id, coalesce(CAST(strftime(van, '%Y%m%d') AS BIGINT), -1) AS van_key, coalesce(CAST(strftime(tot_en_met, '%Y%m%d') AS BIGINT), 99991231) AS tot_key FROM members""")
def date_keys(t: Tables):
    return s.members(t).select("lid_id", D.date_key(F.col("van")).alias("van_key"), D.date_key(F.col("tot_en_met"), D.OPEN_END_KEY).alias("tot_key"))


@query("t9_session_year", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 9 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1)
  ELSE (year(o_orderdate) - 1) || '-' || year(o_orderdate) END AS vergaderjaar FROM orders""")
def session_years(t: Tables):
    return t.orders.select("o_orderkey", D.session_year(s.day("o_orderdate")).alias("vergaderjaar"))


@query("t10_month_name", """
SELECT o_orderkey, (['januari','februari','maart','april','mei','juni','juli','augustus','september','oktober','november','december'])[month(o_orderdate)] AS maand FROM orders""")
def month_names(t: Tables):
    return t.orders.select("o_orderkey", D.month_name(s.day("o_orderdate")).alias("maand"))


@query("t13_close_interval", f"WITH {s.MEMBERS_SQL} SELECT lid_id, date_diff('day', van, coalesce(tot_en_met, DATE '2026-10-10')) AS dagen FROM members")
def closed(t: Tables):
    return s.members(t).select("lid_id", D.days_between(F.col("van"), D.close_interval(F.col("tot_en_met"), date(2026, 10, 10))).alias("dagen"))


@query("t14_active_at", f"""
WITH {s.MEMBERS_SQL} SELECT lid_id, van <= DATE '1998-01-01' AND (tot_en_met IS NULL OR tot_en_met >= DATE '1998-01-01') AS is_huidig FROM members""")
def active(t: Tables):
    return s.members(t).select("lid_id", D.active_at(F.col("van"), F.col("tot_en_met"), F.lit(date(1998, 1, 1))).alias("is_huidig"))
