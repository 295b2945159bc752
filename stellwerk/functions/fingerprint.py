"""Content fingerprint: the same job gets the same key on every portal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.text import bound, employer_form, filled, place_form, title_form


def first_place(locations: Column | str = "stellenlokationen") -> Column:
    """The first location that names a place, as written; null without one."""
    locations = F.col(locations) if isinstance(locations, str) else locations
    named = F.filter(
        F.transform(locations, lambda loc: loc["adresse"]["ort"]),
        lambda place: filled(place).isNotNull(),
    )
    return F.get(named, F.lit(0))


def content_fingerprint(employer: Column, title: Column, place: Column) -> Column:
    """24 hex digits over employer, title and place; null without employer or title."""
    parts = F.struct(
        employer_form(employer).alias("employer"),
        title_form(title).alias("title"),
        place_form(place).alias("place"),
    )

    def digest(p: Column) -> Column:
        text = F.concat_ws("|", p["employer"], p["title"], p["place"])
        whole = (p["employer"] != "") & (p["title"] != "")
        return F.when(whole, F.substring(F.sha2(text, 256), 1, fixed.FINGERPRINT_HEX))

    return bound(parts, digest)


def ad_fingerprint() -> Column:
    """Fingerprint of a row in ad shape."""
    return content_fingerprint(
        F.col("firma"), F.col("stellenangebotsTitel"), first_place("stellenlokationen")
    )


def claim_key(fingerprint: Column) -> Column:
    return F.concat(F.lit(fixed.CLAIM_PREFIX), fingerprint)


def is_claim_key(ref: Column) -> Column:
    return F.coalesce(F.startswith(ref, F.lit(fixed.CLAIM_PREFIX)), F.lit(False))
