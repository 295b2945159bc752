"""Dates in the many forms feeds write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.text import bound, filled, strip

_RFC = r"^[A-Za-z]{3}, (\d{1,2} [A-Za-z]{3} \d{4}) \d{1,2}:\d{2}:\d{2} [+-]\d{2}:?\d{2}$"


def _iso(text: Column) -> Column:
    valid = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].+)?$") & text.try_cast("timestamp").isNotNull()
    return F.when(valid, F.substring(text, 1, 10).try_cast("date"))


def iso_date(value: Column) -> Column:
    """Date of an ISO date or timestamp, as written (no zone shift); null if invalid."""
    return bound(strip(value), _iso)


def _any(text: Column) -> Column:
    epoch = F.when(text.rlike(r"^\d+(\.\d+)?$"), text.try_cast("double"))
    german = F.when(text.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), text)
    mail = F.nullif(F.regexp_extract(text, _RFC, 1), F.lit(""))
    return F.coalesce(
        F.when(epoch > 0, F.timestamp_seconds(epoch).cast("date")),
        _iso(text),
        F.try_to_timestamp(german, F.lit("d.M.yyyy")).cast("date"),
        F.try_to_timestamp(mail, F.lit("d MMM yyyy")).cast("date"),
    )


def any_date(value: Column) -> Column:
    """Date from epoch seconds, ISO, dd.MM.yyyy or mail-header form; null if none fits.

    Pass raw JSON scalars as strings; numbers and digit strings are epoch seconds.
    """
    return bound(strip(value), _any)


def any_date_text(value: Column) -> Column:
    """:func:`any_date` as yyyy-MM-dd, '' if none fits."""
    return F.coalesce(any_date(value).cast("string"), F.lit(""))


def published_on(*fields: Column) -> Column:
    """First field that holds an ISO date."""
    columns = fields or tuple(F.col(name) for name in fixed.DATE_FIELDS)
    return F.coalesce(*[iso_date(c) for c in columns])


def age_days(published: Column, as_of: Column) -> Column:
    """Whole days since publication, never negative; null if unknown."""
    days = F.datediff(as_of, published)
    return F.when(days >= 0, days).when(days < 0, F.lit(0))


def epoch_date_text(epoch: Column) -> Column:
    """Epoch seconds as yyyy-MM-dd (UTC), '' for none."""
    day = F.timestamp_seconds(F.nullif(epoch, F.lit(0))).cast("date").cast("string")
    return F.coalesce(day, F.lit(""))


def days_since(epoch: Column, as_of_epoch: Column) -> Column:
    """Whole days between two epoch seconds, 0 when the first is missing."""
    days = F.floor((as_of_epoch - F.nullif(epoch, F.lit(0))) / 86400)
    return F.coalesce(days, F.lit(0)).cast("int")


def partition_day(year: Column, month: Column, day: Column) -> Column:
    """Day of an archive partition; null for a malformed one."""
    return F.try_to_timestamp(
        F.format_string("%d-%d-%d", *[part.try_cast("int") for part in (year, month, day)]),
        F.lit("y-M-d"),
    ).cast("date")


def within_days(date_text: Column, days: int, as_of: Column) -> Column:
    """Not older than ``days``; an unknown date and a window of 0 pass."""
    if days <= 0:
        return F.lit(True)
    day = iso_date(filled(date_text))
    return day.isNull() | (F.datediff(as_of, day) <= days)
