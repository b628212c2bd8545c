"""ISO 8601 text, civil dates and month arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmetrics.spec import CIVIL_ZONE

# What Spark's own cast reads as it stands.
_PLAIN = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)
# The remaining ISO spellings: basic dates, week dates, any separator, basic time, comma.
_TIME = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
_ZONE = r"Z|[+-]\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?|\d{2}(?:\d{2})?)?"
_TAIL = rf"(?:[\s\S]({_TIME})({_ZONE})?)?$"
_CALENDAR = rf"^(?!0000)(?:(\d{{4}})-(\d{{2}})-(\d{{2}})|(\d{{4}})(\d{{2}})(\d{{2}})){_TAIL}"
_WEEK = rf"^(?!0000)(?:(\d{{4}})-W(\d{{2}})(?:-(\d))?|(\d{{4}})W(\d{{2}})(\d)?){_TAIL}"


def _clock(text: Column, pattern: str) -> Column:
    """The time and zone groups (7 and 8) of ``pattern`` in the spelling Spark reads."""
    digits = F.translate(F.regexp_extract(text, pattern, 7), ":", "")
    hhmmss = F.rpad(F.regexp_extract(digits, r"^\d*", 0), 6, "0")
    fraction = F.regexp_replace(F.regexp_extract(digits, r"[.,]\d+$", 0), ",", ".")
    zone = F.regexp_replace(F.regexp_extract(text, pattern, 8), r"(\d{2}):?(?=\d{2})", "$1:")
    clock = F.regexp_replace(hhmmss, r"^(\d{2})(\d{2})(\d{2})$", "$1:$2:$3")
    return F.concat(F.lit("T"), clock, fraction, zone)


def _week_date(text: Column) -> Column:
    """Civil date of an ISO week date; NULL for a week or weekday that does not exist."""
    part = lambda a, b: F.concat(F.regexp_extract(text, _WEEK, a), F.regexp_extract(text, _WEEK, b))
    year, week = part(1, 4).try_cast("int"), part(2, 5).try_cast("int")
    day = F.coalesce(F.nullif(part(3, 6), F.lit("")).try_cast("int"), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(fourth, F.weekday(fourth))
    date = F.date_add(monday, (week - 1) * 7 + day - 1)
    exists = week.between(1, 53) & day.between(1, 7) & (F.weekofyear(date) == week)
    return F.when(exists, date)


def iso_text(text: Column) -> Column:
    """Rewrite any ISO 8601 date or date-time to the spelling Spark casts; else NULL.

    The rare spellings are rewritten inside a lambda, which keeps their many expressions out of
    the generated method: that one stays short enough for the JVM to compile.
    """
    others = F.transform(F.array(text), _rewritten)
    return F.when(text.rlike(_PLAIN), text).otherwise(F.element_at(others, 1))


def _rewritten(text: Column) -> Column:
    calendar = F.concat(
        F.regexp_replace(text, _CALENDAR, "$1$4-$2$5-$3$6"), _clock(text, _CALENDAR)
    )
    week = F.concat(F.date_format(_week_date(text), "yyyy-MM-dd"), _clock(text, _WEEK))
    return F.when(text.rlike(_CALENDAR), calendar).when(text.rlike(_WEEK), week)


def instant(iso: Column) -> Column:
    """UTC instant of a text from :func:`iso_text`; NULL when the date does not exist."""
    return iso.try_cast("timestamp")


def written_date(iso: Column) -> Column:
    """The wall-clock date written in the text, whatever its offset."""
    return F.substring(iso, 1, 10).try_cast("date")


def civil_date(instant_utc: Column, zone: str = CIVIL_ZONE) -> Column:
    """Local calendar day of a UTC instant."""
    return F.to_date(F.from_utc_timestamp(instant_utc, zone))


def year_month(day: Column) -> Column:
    """``yyyy-MM`` partition value of a date or instant."""
    return F.date_format(day, "yyyy-MM")
