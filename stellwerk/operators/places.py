"""Looking up places in a city table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.fingerprint import first_place
from stellwerk.functions.places import distance_km, reported_km
from stellwerk.functions.text import map_place_form


def located(rows: DataFrame, place: str, cities: DataFrame) -> DataFrame:
    """Add the struct ``point`` (lat, lon), null for an unknown place.

    A place is its exact name, else the first city that extends it by a word or that it
    extends.  The "first word(s) equal" rule turns into equality on word prefixes, so no
    pair of place and city is ever compared that does not share a name.  Distinct places are
    resolved first, and only then joined back.
    """

    def prefixes(name: Column) -> Column:
        """Proper word prefixes of a name."""
        parts = F.split(name, " ")
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
            lambda n: F.array_join(F.slice(parts, F.lit(1), n), " "),
        )

    named = rows.withColumn("_place", map_place_form(F.col(place)))
    full = cities.withColumn("_name", map_place_form(F.col("name")))
    point = F.struct("lat", "lon").alias("point")
    names = full.select(F.col("_name").alias("_key"), "pos", point)
    longer = full.select(F.explode(prefixes(F.col("_name"))).alias("_key"), "_name", "pos", point)
    longer = longer.filter(F.col("_key") != F.col("_name"))
    places = named.select("_place").filter("_place <> ''").distinct()
    shorter = places.select("_place", F.explode(prefixes(F.col("_place"))).alias("_key"))
    shorter = shorter.filter(F.col("_key") != F.col("_place"))
    whole = places.withColumn("_key", F.col("_place"))

    def candidates(keys: DataFrame, table: DataFrame, rank: int) -> DataFrame:
        ranked = F.struct(F.lit(rank).alias("rank"), F.col("pos"), F.col("point"))
        return keys.join(table, "_key").select("_place", ranked.alias("hit"))

    best = (
        candidates(whole, names, 0)
        .unionAll(candidates(whole, longer.drop("_name"), 1))
        .unionAll(candidates(shorter, names, 1))
        .groupBy("_place")
        .agg(F.min("hit")["point"].alias("point"))
    )
    return named.join(best, "_place", "left").drop("_place")


def with_distance(
    ads: DataFrame, cities: DataFrame, search_place: str = fixed.DEFAULT_PLACE
) -> DataFrame:
    """Add ``entfernung_km``: as stated by the ad, else computed to the search place."""
    first = ads.withColumn("_first_place", first_place("stellenlokationen"))
    pointed = located(first, "_first_place", cities)
    origin = (
        located(
            ads.sparkSession.createDataFrame([(search_place,)], "place string"), "place", cities
        )
        .select("point.lat", "point.lon")
        .first()
    )
    if origin is None or origin.lat is None:
        computed = F.lit(None).cast("double")
    else:
        computed = distance_km(
            F.lit(origin.lat), F.lit(origin.lon), F.col("point.lat"), F.col("point.lon")
        )
    return pointed.withColumn("entfernung_km", F.coalesce(reported_km(), computed)).drop(
        "_first_place", "point"
    )
