"""Scores against what became of the applications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.score import score_band

_APPLIED = (*fixed.RUNNING, fixed.REJECTED)


def outcome_by_band(rated: DataFrame, points: str = "punkte", status: str = "status") -> DataFrame:
    """Applications per score band; the quota is over answered ones only."""
    state = F.col(status)
    counts = (
        rated.filter(state.isin(*_APPLIED))
        .groupBy(score_band(F.col(points)).alias("band"))
        .agg(
            F.count(F.lit(1)).alias("applied"),
            F.count_if(state == fixed.INTERVIEW).alias("interview"),
            F.count_if(state == fixed.OFFER).alias("offer"),
            F.count_if(state == fixed.REJECTED).alias("rejected"),
            F.count_if(state == fixed.APPLIED).alias("open"),
        )
    )
    good = F.col("interview") + F.col("offer")
    return counts.withColumn("quota", F.try_divide(good, good + F.col("rejected")))


def score_means(rated: DataFrame, points: str = "punkte", status: str = "status") -> DataFrame:
    """One row: mean scores of discarded and applied ads, and if the score misleads."""
    state = F.col(status)
    applied = state.isin(*_APPLIED)
    means = rated.agg(
        F.count_if(applied).alias("applied"),
        F.avg(F.when(applied, F.col(points))).alias("mean_applied"),
        F.count_if(state == fixed.DISCARDED).alias("discarded"),
        F.avg(F.when(state == fixed.DISCARDED, F.col(points))).alias("mean_discarded"),
        F.count_if(state.isin(fixed.INTERVIEW, fixed.OFFER, fixed.REJECTED)).alias("answered"),
    )
    return means.withColumns(
        {
            "misleading": F.coalesce(
                F.col("mean_discarded") > F.col("mean_applied"), F.lit(False)
            ),
            "too_few": F.col("answered") < fixed.MIN_ANSWERS,
        }
    )
