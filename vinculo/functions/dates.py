"""Dates, ages and decades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes of dates as regular expressions (fixed values). Text of a known shape is put in ISO
# order and cast, which is far cheaper than trying date patterns in turn.
DAY_FIRST = r"^([0-9]{2})([/-])([0-9]{2})\2([0-9]{4})$"
ISO_WITH_TIME = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})( ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9])?$"
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
COMPACT = r"^[0-9]{8}$"

# Age buckets: label and first age beyond it (fixed values).
AGE_BUCKETS = (("<18", 18), ("18-24", 25), ("25-34", 35), ("35-44", 45), ("45-54", 55), ("55-64", 65), ("65+", 200))
AGE_UNKNOWN = "IGNORADO"


def safe_date(value: Column) -> Column:
    """Cast to a date; what does not fit becomes null."""
    return value.try_cast("date")


def parse_roster_date(text: Column) -> Column:
    """Lenient, day-first date (slashes or dashes) or ISO date with optional time; else null."""
    iso = F.regexp_replace(F.trim(text), DAY_FIRST, "$4-$3-$1")
    return F.regexp_extract(iso, ISO_WITH_TIME, 1).try_cast("date")


def parse_registry_date(text: Column) -> Column:
    """ISO or compact date; zeros, blanks and impossible dates become null."""
    written = text.cast("string")
    spelled = F.concat_ws("-", F.substring(written, 1, 4), F.substring(written, 5, 2), F.substring(written, 7, 2))
    iso = F.when(written.rlike(COMPACT), spelled).when(written.rlike(ISO), written)
    return iso.try_cast("date")


def age_years(born: Column, at: Column) -> Column:
    """Completed years between two dates, truncated toward zero."""
    return (F.months_between(at, born) / 12).cast("int")


def age_bucket(age: Column) -> Column:
    """Label of the bucket holding ``age``; out of range is unknown, null stays null."""
    label = F.when(age.isNull(), None).when(age < 0, AGE_UNKNOWN)
    for name, beyond in AGE_BUCKETS:
        label = label.when(age < beyond, name)
    return label.otherwise(AGE_UNKNOWN)


def decade(date: Column) -> Column:
    """First year of the decade of a date."""
    return (F.floor(F.year(date) / 10) * 10).cast("int")


def day_gap(left: Column, right: Column) -> Column:
    """Whole days between two dates, regardless of their order."""
    return F.abs(F.datediff(left, right))
