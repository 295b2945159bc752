"""Row counts, and numbering without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stellwerk.session import cut


def total(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Consecutive numbers from 1 in a total order.

    The sort is distributed; a row's number is its place in its own partition plus the
    rows of the partitions before.  The sorted rows are materialised, so that both parts
    of the sum see the same partitions.
    """
    per_partition = 1 << 33  # how monotonically_increasing_id counts
    placed = cut(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.floor(F.col("_id") / per_partition))
    # One row per partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    number = F.col("_before") + F.col("_id") % per_partition + 1
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, number.cast("long"))
        .drop("_id", "_part", "_before")
    )
