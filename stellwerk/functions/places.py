"""Places and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.text import CASED, bound, filled, strip

_CODE_AND_PLACE = CASED + r"^\s*(\d{4,5})\s+(.*\S)\s*$"


def place_struct(text: Column) -> Column:
    """'20095 Hamburg, DE' as {adresse: {plz, ort}}; null for a blank place."""

    def address(head: Column) -> Column:
        coded = F.regexp_extract(head, _CODE_AND_PLACE, 2)
        place = F.when(coded != "", coded).otherwise(head)
        code = F.regexp_extract(head, _CODE_AND_PLACE, 1)
        parts = F.struct(code.alias("plz"), place.alias("ort"))
        return F.when(head != "", F.struct(parts.alias("adresse")))

    return bound(strip(F.substring_index(text, ",", 1)), address)


def place_structs(texts: Column) -> Column:
    """Location list of several place texts, blanks dropped."""
    return F.filter(F.transform(texts, place_struct), lambda p: p.isNotNull())


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance along the great circle, unrounded."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_lon), F.lit(2))
    return F.lit(2 * fixed.EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.bround(great_circle_km(lat1, lon1, lat2, lon2), 1)


def reported_km(
    own: tuple[str, ...] = fixed.DISTANCE_FIELDS,
    locations: Column | None = None,
) -> Column:
    """Shortest distance an ad states, for itself or any location; null if none."""
    locations = F.col("stellenlokationen") if locations is None else locations
    stated = F.array(*[F.col(name).cast("double") for name in own])
    per_place = F.flatten(
        F.transform(
            locations,
            lambda loc: F.array(*[loc[name].cast("double") for name in fixed.DISTANCE_FIELDS]),
        )
    )
    every = F.concat(stated, F.coalesce(per_place, F.array().cast("array<double>")))
    return F.bround(F.array_min(F.filter(every, lambda km: km >= 0)), 1)


def location_label(locations: Column, detail_places: Column | None = None) -> Column:
    """'plz place' of the first three places, distinct, joined by ' / '."""

    def labels(addresses: Column) -> Column:
        def label(a: Column) -> Column:
            text = F.concat_ws(" ", filled(a["plz"]), strip(a["ort"]))
            return F.when(filled(a["ort"]).isNotNull(), text)

        named = F.filter(F.transform(F.slice(addresses, 1, 3), label), lambda x: x.isNotNull())
        return F.array_join(F.array_distinct(named), " / ")

    own = F.nullif(labels(F.transform(locations, lambda loc: loc["adresse"])), F.lit(""))
    if detail_places is None:
        return F.coalesce(own, F.lit(""))
    return F.coalesce(own, labels(detail_places), F.lit(""))
