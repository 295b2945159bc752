"""What the market asks for, and what of it a profile lacks.

Input to all functions is one row per ad with ``labels`` (see ``functions.catalog``).
A label counts once per ad.  Labels are few and ads are many, so every count combines
before its shuffle and no label can be too frequent.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.catalog import Catalog
from stellwerk.functions.score import Profile
from stellwerk.functions.terms import STOP_WORDS, candidate_words, is_unknown_term
from stellwerk.operators.sizes import total


def _count(ads: DataFrame, labels: Column, name: str = "label") -> DataFrame:
    return (
        ads.select(F.explode(labels).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("ads"))
    )


def _skills(profile: Profile) -> Column:
    return F.array(*[F.lit(s) for s in profile.skills]).cast("array<string>")


def with_share(counts: DataFrame, ads: DataFrame) -> DataFrame:
    """Add ``share``: counted ads by all ads (0 if there are none)."""
    return counts.withColumn(
        "share", F.coalesce(F.try_divide(F.col("ads"), total(ads)), F.lit(0.0))
    )


def demand(ads: DataFrame) -> DataFrame:
    """(label, ads): in how many ads each label occurs."""
    return _count(ads, F.array_distinct("labels"))


def gaps(ads: DataFrame, profile: Profile) -> DataFrame:
    """Demanded and not in the profile."""
    return _count(ads, F.array_except("labels", _skills(profile)))


def covered(ads: DataFrame, profile: Profile) -> DataFrame:
    """Demanded and in the profile."""
    return _count(ads, F.array_intersect("labels", _skills(profile)))


def top(counts: DataFrame, k: int = fixed.REPORT_ROWS, label: str = "label") -> DataFrame:
    """The k largest counts; ties by label."""
    return counts.orderBy(F.desc("ads"), label).limit(k)


def monthly(ads: DataFrame, day: str = "tag") -> DataFrame:
    """(month, label, ads)."""
    month = F.date_format(day, "yyyy-MM").alias("month")
    pairs = ads.select(month, F.explode(F.array_distinct("labels")).alias("label"))
    return pairs.groupBy("month", "label").agg(F.count(F.lit(1)).alias("ads"))


def history(ads: DataFrame, months: Sequence[str], k: int = fixed.HISTORY_ROWS) -> DataFrame:
    """One row per frequent label, one column per month."""
    leaders = top(demand(ads), k).select("label")  # at most k rows
    counts = monthly(ads).join(F.broadcast(leaders), "label")
    return counts.groupBy("label").pivot("month", list(months)).sum("ads").fillna(0)


def bars(ads: DataFrame, profile: Profile, k: int = fixed.REPORT_ROWS) -> DataFrame:
    """Both report lists on one scale: ``width`` is the share by the largest share shown."""
    lists = with_share(top(gaps(ads, profile), k), ads).withColumn("list", F.lit("gaps"))
    lists = lists.unionByName(
        with_share(top(covered(ads, profile), k), ads).withColumn("list", F.lit("covered"))
    )
    largest = lists.agg(F.max("share")).scalar()
    width = F.coalesce(F.try_divide(100 * F.col("share"), largest), F.lit(0.0))
    return lists.withColumn("width", width)


def grades(rated: DataFrame) -> DataFrame:
    """(stufe, ads)."""
    return rated.groupBy(F.col("rating.stufe").alias("stufe")).agg(F.count(F.lit(1)).alias("ads"))


def summary(rated: DataFrame, day: str = "tag") -> DataFrame:
    """One row: number of ads, period, rated ads, best grade, and if that is enough to tell."""
    grade = F.col("rating.stufe")
    return rated.agg(
        F.count(F.lit(1)).alias("ads"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count_if(grade != fixed.GRADE_D).alias("rated"),
        F.count_if(grade == fixed.GRADE_A).alias("grade_a"),
    ).withColumn("meaningful", F.col("ads") >= fixed.MIN_CORPUS)


def unknown_terms(
    texts: DataFrame,
    text: Column,
    catalog: Catalog,
    stop_words: tuple[str, ...] = STOP_WORDS,
) -> DataFrame:
    """(term, ads): technology-looking words the catalog lacks, by number of texts.

    Spelling decides per text; the catalog and the stop words are asked only once per
    distinct word, after counting.
    """
    counts = _count(texts, candidate_words(text), "term")
    return counts.filter(is_unknown_term(F.col("term"), catalog, stop_words))


def report_terms(counts: DataFrame, k: int = 12) -> DataFrame:
    """Unknown terms worth showing: among the k most frequent, those in enough ads."""
    return top(counts, k, "term").filter(F.col("ads") >= fixed.MIN_TERM_ADS)


# --- daily partials ---------------------------------------------------------------

PARTIAL = "label STRING, ads BIGINT, tag DATE"


def daily(ads: DataFrame, day: str = "tag") -> DataFrame:
    """(label, ads, tag): ads of a day with a label, and under a null label all ads of the day.

    Sums of these rows answer for any period what a run over its ads would.
    """
    each = F.array_union(F.array_distinct("labels"), F.array(F.lit(None).cast("string")))
    rows = ads.select(F.explode(each).alias("label"), F.col(day).alias("tag"))
    return rows.groupBy("label", "tag").agg(F.count(F.lit(1)).alias("ads")).select("label", "ads", "tag")


def refresh(ads: DataFrame, days: DataFrame, path: str) -> None:
    """Write the partials of the changed ``days`` (tag) anew; the partials of other days stay.

    ``ads`` need to hold all ads of these days; only they are read.  A day whose ads are
    gone keeps a row that says so.
    """
    days = days.select("tag").distinct()
    fresh = daily(ads.join(days, "tag", "left_semi"))
    empty = days.join(fresh, "tag", "left_anti").select(F.lit(None).cast("string").alias("label"), F.lit(0).cast("long").alias("ads"), "tag")
    (
        fresh.unionByName(empty)
        .repartition("tag")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("tag")
        .parquet(path)
    )


def read_partials(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The partials of a period; other days are not opened."""
    rows = spark.read.schema(PARTIAL).parquet(path)
    return rows if since is None else rows.filter(F.col("tag") >= F.lit(since))


def total_of(partials: DataFrame) -> Column:
    """Number of ads, as a scalar subquery."""
    return partials.filter("label is null").agg(F.coalesce(F.sum("ads"), F.lit(0))).scalar()


def demand_of(partials: DataFrame) -> DataFrame:
    """What :func:`demand` and :func:`with_share` say about the ads."""
    counts = partials.filter("label is not null").groupBy("label").agg(F.sum("ads").alias("ads"))
    return counts.withColumn("share", F.coalesce(F.try_divide(F.col("ads"), total_of(partials)), F.lit(0.0)))


def monthly_of(partials: DataFrame) -> DataFrame:
    """What :func:`monthly` says about the ads."""
    named = partials.filter("label is not null").withColumn("month", F.date_format("tag", "yyyy-MM"))
    return named.groupBy("month", "label").agg(F.sum("ads").alias("ads"))


def against(counts: DataFrame, profile: Profile, in_profile: bool) -> DataFrame:
    """Demand inside or outside of a profile, from counted labels."""
    own = F.col("label").isin(*profile.skills)
    return counts.filter(own if in_profile else ~own)
