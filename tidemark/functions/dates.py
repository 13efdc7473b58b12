"""Scalar date rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Countries of origin by hemisphere, for the official birthday of a profile (southern horses turn a year older
# on 1 August) and, a list of its own, for the feature that is derived from the country alone.
SOUTHERN = ("AUS", "NZ", "SAF", "ARG", "ZIM", "BRZ", "CHI")
NORTHERN = ("IRE", "GB", "USA", "FR", "JPN", "CAN", "GER")
DERIVED_NORTHERN = ("GB", "IRE", "FR", "USA", "CAN", "JPN", "GER", "ITY", "SPA", "GR")
DERIVED_SOUTHERN = ("AUS", "NZ", "SAF", "ARG", "BRZ", "CHI", "URU")


def parse_day(c: Column) -> Column:
    """A date, or the day of a timestamp, in ISO form; else null."""
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.to_date(F.try_to_timestamp(c)))


def parse_form_day(c: Column) -> Column:
    """d/m/Y, d-m-Y, Y-m-d, then d/m/y."""
    t = F.trim(c)
    return F.coalesce(*(F.when(t.rlike(p), F.try_to_date(t, f)) for p, f in (
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"))))


def hemisphere(country: Column) -> Column:
    """Southern, Northern, or Other for a country on neither list."""
    t = F.upper(F.trim(F.coalesce(country, F.lit(""))))
    return F.when(t.isin(*SOUTHERN), "Southern").when(t.isin(*NORTHERN), "Northern").otherwise("Other")


def derived_hemisphere(country: Column) -> Column:
    """Southern, Northern, or null for a country on neither list."""
    t = F.upper(F.trim(country))
    return F.when(t.isin(*DERIVED_NORTHERN), "Northern").when(t.isin(*DERIVED_SOUTHERN), "Southern")


def _birthday(year: Column, country: Column) -> Column:
    return F.make_date(year, F.when(hemisphere(country) == "Southern", 8).otherwise(1), F.lit(1))


def birth_year(age: Column, country: Column, known_on: Column) -> Column:
    """The year of birth of one that was ``age`` on the day ``known_on``, by the official birthday."""
    return F.year(known_on) - age - F.when(known_on < _birthday(F.year(known_on), country), 1).otherwise(0)


def age_on(age: Column, country: Column, known_on: Column, day: Column) -> Column:
    """The age on ``day``; null where it would be negative."""
    out = F.year(day) - birth_year(age, country, known_on) - F.when(day < _birthday(F.year(day), country), 1).otherwise(0)
    return F.when(out >= 0, out)


def date_parts(day: Column, prefix: str = "race_") -> dict[str, Column]:
    """Year, month, day, weekday (Monday 0), weekend, season month, and the year in which the season (from September) began."""
    return {
        f"{prefix}year": F.year(day), f"{prefix}month": F.month(day), f"{prefix}day": F.dayofmonth(day), f"{prefix}dayofweek": F.weekday(day),
        f"{prefix}is_weekend": F.weekday(day).isin(5, 6).cast("int"), f"{prefix}season_month": F.month(day),
        "hk_season_start_year": F.when(F.month(day) >= 9, F.year(day)).otherwise(F.year(day) - 1),
    }


def now_text() -> Column:
    """The time of the query as text, UTC."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
