"""Salary rows by occupation and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.occupation import occupation_code, stated


def overall_rows(salaries: DataFrame, order: str = "pos") -> DataFrame:
    """Per occupation and region the first row not split by branch, age or gender."""
    overall = [F.col(f"{d}.id") == fixed.OVERALL for d in ("branche", "ageCategory", "gender")]
    rows = salaries.filter(overall[0] & overall[1] & overall[2])
    key = [F.col("kldb"), F.col("region.id").alias("region_id")]
    firsts = rows.groupBy(*key).agg(F.min(order).alias(order)).select(order)
    return rows.join(firsts, order, "left_semi").select(
        "kldb",
        F.col("region.id").alias("region_id"),
        F.coalesce("performanceLevel.bezeichnung", F.lit("unbekannt")).alias("niveau"),
        F.coalesce("region.bezeichnung", F.lit("unbekannt")).alias("region"),
        "entgelt",
        "entgeltQ25",
        "entgeltQ75",
        "besetzung",
    )


def pay_table(salaries: DataFrame, order: str = "pos") -> DataFrame:
    """Cleaned rows: a missing median drops the row, other missing figures become 0."""
    none = F.lit(0)
    return (
        overall_rows(salaries, order)
        .filter(stated(F.col("entgelt")).isNotNull())
        .select(
            "kldb",
            "region_id",
            "niveau",
            "region",
            F.col("entgelt").alias("median"),
            F.coalesce(stated(F.col("entgeltQ25")), none).alias("q25"),
            F.coalesce(stated(F.col("entgeltQ75")), none).alias("q75"),
            F.coalesce(stated(F.col("besetzung")), none).alias("fallzahl"),
        )
    )


def lookup(titles: DataFrame, title: str, region_id: Column, pay: DataFrame) -> DataFrame:
    """Left join of titles to the pay of their occupation in a region."""
    keyed = titles.withColumn("kldb", occupation_code(F.col(title))).withColumn(
        "region_id", region_id
    )
    return keyed.join(pay, ["kldb", "region_id"], "left")
