"""Filters over titles, employers, places and regions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.catalog import Catalog
from stellwerk.functions.text import CASED, CASELESS, casefold, filled, quoted


def starts_a_word(text: Column, term: str) -> Column:
    """``term`` occurs at the start of a word."""
    return text.rlike(CASED + r"\b" + quoted(term))


def _first_term(text: Column, terms: Iterable[str]) -> Column:
    hits = [F.when(starts_a_word(text, term), F.lit(term)) for term in terms]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def exclusion_reason(text: Column, terms: Iterable[str] = fixed.EXCLUDED_TERMS) -> Column:
    """First listed term at a word start of the lowered text; null if none."""
    return _first_term(F.lower(text), terms)


def employer_reason(employer: Column, terms: Iterable[str] = fixed.EXCLUDED_EMPLOYERS) -> Column:
    """First listed employer; null if none."""
    return _first_term(casefold(employer), terms)


def exclusion_text(title: Column, main: Column, all_jobs: Column) -> Column:
    """Everything an exclusion term may stand in, lowered."""
    blank = F.lit("")
    return F.lower(
        F.concat_ws(
            " ",
            F.coalesce(title, blank),
            F.coalesce(main, blank),
            F.array_join(F.coalesce(all_jobs, F.array().cast("array<string>")), " "),
        )
    )


def passes(
    employer: Column,
    text: Column,
    excluded: Iterable[str] = fixed.EXCLUDED_TERMS,
    required: Iterable[str] = (),
    employers: Iterable[str] = (),
) -> Column:
    """Employer not listed, no excluded term, and one required term if any are given."""
    checks = [
        F.coalesce(employer_reason(employer, employers), exclusion_reason(text, excluded)).isNull()
    ]
    required = tuple(required)
    if required:
        checks.append(_first_term(F.lower(text), required).isNotNull())
    return reduce(lambda a, b: a & b, checks)


def matches_search(title: Column, terms: Iterable[str], catalog: Catalog) -> Column:
    """At least one search term fits the title.

    A term that names a catalog label stands for that label's pattern; of any other
    term all words must occur, also inside longer words.  Label patterns see the title
    as written, so that case-sensitive ones can match.
    """
    lowered = casefold(title)
    checks = []
    for term in terms:
        entry = catalog.entry(term)
        if entry is not None:
            checks.append(title.rlike(CASELESS + entry.pattern))
            continue
        parts = [p for p in re.split(r"\W+", term.casefold()) if p]
        if parts:
            checks.append(reduce(lambda a, b: a & b, [lowered.contains(p) for p in parts]))
    hit = reduce(lambda a, b: a | b, checks, F.lit(False))
    return filled(title).isNotNull() & hit


def fits_place(remote_percent: Column, location: Column, place: str) -> Column:
    """Remote, or the location names the place."""
    near = casefold(F.coalesce(location, F.lit(""))).contains(place.casefold())
    return F.coalesce(remote_percent == 100, F.lit(False)) | near


def fits_region(region: Column, allowed: Iterable[str] = fixed.REMOTE_REGIONS) -> Column:
    """No region given, or one of the allowed names occurs in it."""
    text = casefold(F.coalesce(region, F.lit("")))
    return reduce(lambda a, b: a | b, [text.contains(a) for a in allowed], text == "")


def fully_remote(percent: Column, at_least: int = 100) -> Column:
    return F.coalesce(percent >= at_least, F.lit(False))
