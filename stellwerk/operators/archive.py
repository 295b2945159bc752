"""The raw archive: day partitions, first occurrence, nearest day, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.operators.dedup import last_per_key

# Days around the computed one that are looked at, in order of preference.
NEIGHBOUR_DAYS = (0, -1, 1)


def one_per_day(
    rows: DataFrame, ref: str = "referenznummer", day: str = "tag", seq: str = "seq"
) -> DataFrame:
    """Archive rule: the last arrival of a reference on a day replaces earlier ones."""
    return last_per_key(rows, [ref, day], seq)


def first_occurrences(
    archive: DataFrame,
    since: dt.date | Column | None = None,
    ref: str = "referenznummer",
    day: str = "tag",
) -> DataFrame:
    """Each ad once, as first archived in the period.

    The period applies before the choice, so an older copy outside it does not count.
    Needs one row per reference and day.  Only reference and day take part in finding
    the first day; the wide columns are touched once, by the semi-join.
    """
    if since is not None:
        archive = archive.filter(F.col(day) >= F.lit(since))
    firsts = archive.groupBy(ref).agg(F.min(day).alias(day))
    return archive.join(firsts, [ref, day], "left_semi")


def nearest_day(
    entries: DataFrame,
    archive: DataFrame,
    found_day: str = "found_day",
    ref: str = "referenznummer",
    day: str = "tag",
) -> DataFrame:
    """Left join of entries to the archive: same day, else the day before, else after.

    Each entry is looked up under its three days with an equality join on narrow rows, and
    the best of at most three hits stays.  The archive's wide rows are moved once, to the
    entry that wants their day.  Needs one archive row per reference and day and one entry
    per reference.
    """
    tries = F.array(
        *[F.struct(F.lit(i).alias("pref"), F.lit(d).alias("d")) for i, d in enumerate(NEIGHBOUR_DAYS)]
    )
    wanted = (
        entries.filter(F.col(found_day).isNotNull())
        .select(ref, found_day, F.explode(tries).alias("_try"))
        .select(
            ref,
            F.date_add(found_day, F.col("_try.d")).alias(day),
            F.col("_try.pref").alias("_pref"),
        )
    )
    present = wanted.join(archive.select(ref, day), [ref, day], "left_semi")
    best = (
        present.groupBy(ref)
        .agg(F.min(F.struct("_pref", day)).alias("_best"))
        .select(ref, F.col(f"_best.{day}").alias("_day"))
    )
    # An entry without a hit asks under a day that has none; its reference keeps it apart.
    dated = entries.join(best, ref, "left").withColumn("_day", F.coalesce("_day", found_day))
    return dated.join(archive.withColumn("_day", F.col(day)), [ref, "_day"], "left").drop("_day")


def within_retention(archive: DataFrame, as_of: Column, day: str = "tag") -> DataFrame:
    """Archive rows of the last 365 days."""
    return archive.filter(F.col(day) >= F.date_sub(as_of, fixed.ARCHIVE_DAYS))


def unexpired(seen: DataFrame, as_of_epoch: Column) -> DataFrame:
    """Seen entries still in force; anything decided upon never expires."""
    decided = F.coalesce(F.col("status"), F.lit(fixed.FOUND)) != fixed.FOUND
    expires = F.col("ablauf_zeitpunkt")
    return seen.filter(decided | expires.isNull() | (expires > as_of_epoch))
