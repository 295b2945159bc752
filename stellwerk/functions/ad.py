"""Fields read from an ad and its detail view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.text import filled, first_filled, strip


def source_name(source: Column) -> Column:
    """Portal of an ad; old rows carry none and came from the agency."""
    return F.coalesce(filled(source), F.lit(fixed.AGENCY))


def description(*candidates: Column) -> Column:
    """First candidate with text."""
    return first_filled(*candidates)


def requirement_text(title: Column, main: Column, all_jobs: Column, text: Column) -> Column:
    """Everything a requirement may stand in, one part per line."""
    parts = F.concat(
        F.array(strip(title), strip(main)),
        F.coalesce(F.transform(all_jobs, strip), F.array().cast("array<string>")),
        F.array(strip(text)),
    )
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n")


def ad_link(
    source: Column,
    ref: Column,
    external: Column,
    external_detail: Column | None = None,
) -> Column:
    """Where the ad can be read: the agency page, else the portal's own address."""
    urls = [external] if external_detail is None else [external, external_detail]
    url = F.coalesce(*[filled(u) for u in urls])
    agency = F.concat(F.lit(fixed.AGENCY_LINK), F.coalesce(ref, F.lit("")))
    return F.when(source_name(source) != fixed.AGENCY, F.coalesce(url, agency)).otherwise(agency)


def employer_name(own: Column, detail: Column) -> Column:
    return first_filled(own, detail)
