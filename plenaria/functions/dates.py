"""Dates, partial dates, intervals and calendar labels as Column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# The text forms of a partial date and the precision tag each form gets.
PARTIAL_DATE_FORMS = {
    "dag": r"^\d{4}-\d{2}-\d{2}$",
    "maand": r"^\d{4}-\d{2}$",
    "week_dag": r"^\d{4}-W\d{2}-\d$",
    "week": r"^\d{4}-W\d{2}$",
    "jaar": r"^\d{4}$",
}

# Month names used as labels.
MONTH_NAMES = ["januari", "februari", "maart", "april", "mei", "juni", "juli",
               "augustus", "september", "oktober", "november", "december"]

OPEN_END_KEY = 99991231
UNKNOWN_KEY = -1


def _int(text: Column) -> Column:
    return text.try_cast("int")


def iso_week_date(year: Column, week: Column, weekday: Column) -> Column:
    """Date of an ISO year, week and weekday (1 = Monday). Weeks past the year's end roll over."""
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(fourth, (week - 1) * 7 + (weekday - 1) - F.weekday(fourth))


def parse_partial_date(text: Column, is_end: bool = False) -> Column:
    """``struct(datum, precisie)`` of a day, month, year, week or week-day text.

    The missing part is filled from the start of the period, or from its end when ``is_end``.
    Text of another form, or a day that does not exist, gives a NULL date.
    """
    year = _int(F.substring(text, 1, 4))
    week = _int(F.substring(text, 7, 2))
    month_start = F.concat(text, F.lit("-01")).try_cast("date")
    filled = {
        "dag": text.try_cast("date"),
        "maand": F.last_day(month_start) if is_end else month_start,
        "week_dag": iso_week_date(year, week, _int(F.substring(text, 10, 1))),
        "week": iso_week_date(year, week, F.lit(7 if is_end else 1)),
        "jaar": F.make_date(year, F.lit(12 if is_end else 1), F.lit(31 if is_end else 1)),
    }
    tag, value = F.lit(None).cast("string"), F.lit(None).cast("date")
    for name, pattern in PARTIAL_DATE_FORMS.items():
        hit = text.rlike(pattern)
        tag = F.when(hit, F.lit(name)).otherwise(tag)
        value = F.when(hit, filled[name]).otherwise(value)
    return F.struct(value.alias("datum"), tag.alias("precisie"))


def date_key(day: Column, missing: int | None = UNKNOWN_KEY) -> Column:
    """``yyyymmdd`` integer of a date; ``missing`` replaces NULL unless it is None."""
    key = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return key if missing is None else F.coalesce(key, F.lit(missing))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed (negative when ``end`` is earlier)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def year_boundaries(start: Column, end: Column) -> Column:
    """Calendar-year difference: how many new-year boundaries lie between two dates."""
    return (F.year(end) - F.year(start)).cast("bigint")


def completed_years(start: Column, end: Column) -> Column:
    return F.timestamp_diff("YEAR", start, end)


def years_between(start: Column, end: Column, days_per_year: float = 365.25, digits: int | None = 1,
                  floor: float | None = None) -> Column:
    """Length in years by a fixed number of days per year, optionally floored and rounded."""
    years = F.datediff(end, start) / F.lit(days_per_year)
    if floor is not None:
        years = F.greatest(years, F.lit(floor))
    return years if digits is None else F.round(years, digits)


def close_interval(end: Column, as_of: Column | date) -> Column:
    return F.coalesce(end, as_of if isinstance(as_of, Column) else F.lit(as_of))


def active_at(start: Column, end: Column, day: Column) -> Column:
    """Both ends count; an empty end means the interval is still running."""
    return (start <= day) & (end.isNull() | (end >= day))


def session_year(day: Column) -> Column:
    """Parliamentary year ``Y-(Y+1)``, which starts in September."""
    first = F.year(day) - F.when(F.month(day) >= 9, 0).otherwise(1)
    return F.concat_ws("-", first.cast("string"), (first + 1).cast("string"))


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(day))


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("bigint")


DATE_ATTRIBUTES = {
    "jaar": lambda d: F.year(d),
    "kwartaal": lambda d: F.quarter(d),
    "maand": lambda d: F.month(d),
    "dag": lambda d: F.dayofmonth(d),
    "weeknummer": lambda d: F.weekofyear(d),
    "dagnr": iso_weekday,
    "dagnaam": lambda d: F.date_format(d, "EEEE"),
    "maandnaam": month_name,
    "jaar_maand": lambda d: F.date_format(d, "yyyy-MM"),
    "datum_id": lambda d: date_key(d, None),
    "vergaderjaar": session_year,
    "maand_start": lambda d: F.trunc(d, "MM"),
}


def date_attributes(day: Column, names: list[str]) -> list[Column]:
    """Named calendar attributes of a date as aliased columns."""
    columns = []
    for name in names:
        value = DATE_ATTRIBUTES[name](day)
        text = name in ("dagnaam", "maandnaam", "jaar_maand", "vergaderjaar", "maand_start")
        columns.append((value if text else value.cast("bigint")).alias(name))
    return columns
