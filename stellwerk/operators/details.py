"""Ads and their detail view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.ad import description, source_name
from stellwerk.functions.text import filled


def lacks_text(agency_only: bool = True) -> Column:
    """The ad carries no description of its own (and, for exports, is an agency ad)."""
    empty = description(*[F.col(f) for f in fixed.DESCRIPTION_FIELDS]) == ""
    return empty & (source_name(F.col("quelle")) == fixed.AGENCY) if agency_only else empty


def with_detail(
    ads: DataFrame, detail: DataFrame | None, needs: Column, ref: str = "referenznummer"
) -> DataFrame:
    """Add the struct ``detail``; null where the ad needs none or none is known.

    Only rows that need a detail can meet the detail table.  The others join under a key
    that matches nothing but still spreads by reference; null keys would all meet in one
    task.
    """
    if detail is None:
        return ads.withColumn("detail", F.lit(None).cast("struct<referenznummer:string>"))
    packed = detail.select(
        F.col(ref).alias("_ref"), F.struct(*[F.col(c) for c in detail.columns]).alias("detail")
    )
    key = F.when(needs, F.col(ref)).otherwise(F.concat(F.lit("\u0000"), F.col(ref)))
    return ads.join(packed, key == F.col("_ref"), "left").drop("_ref")


def missing_details(ads: DataFrame, detail: DataFrame, ref: str = "referenznummer") -> DataFrame:
    """References that need a detail view which was never fetched."""
    wanted = ads.filter(lacks_text()).select(ref).distinct()
    return wanted.join(detail.select(ref), ref, "left_anti")


def add_details(
    detail: DataFrame, fetched: DataFrame, refresh: bool = False, ref: str = "referenznummer"
) -> DataFrame:
    """Insert fetched details if absent - empty ones too - or replace on refresh.

    A reference that was fetched more than once is taken once; which answer counts depends
    on its content only.
    """
    whole = F.struct(*[F.col(c) for c in fetched.columns])
    once = fetched.groupBy(ref).agg(F.min_by(whole, F.xxhash64(*fetched.columns)).alias("_one"))
    fetched = once.select("_one.*")
    if refresh:
        kept = detail.join(fetched.select(ref).distinct(), ref, "left_anti")
        return kept.unionByName(fetched, allowMissingColumns=True)
    new = fetched.join(detail.select(ref), ref, "left_anti")
    return detail.unionByName(new, allowMissingColumns=True)


def withdrawn(fetched: DataFrame, ref: str = "referenznummer") -> DataFrame:
    """Fetched details in which nothing stands (kept, so they are not fetched again)."""
    others = [c for c in fetched.columns if c != ref]
    filled_any = F.coalesce(*[filled(F.col(c).cast("string")) for c in others])
    return fetched.filter(filled_any.isNull())
