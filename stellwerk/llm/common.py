"""What several of the operators need: stored tables, bounded tables, components."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stellwerk.session import fresh_path

#: A word of the contracts: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def at_workers(spark: SparkSession) -> SparkSession:
    """Set up a session for work on texts in Python.

    Workers on this machine find the library (a cluster has it installed), and a batch that goes
    to a worker holds a few MB, so that several workers fit beside the memory of an executor.
    The shuffle files of a query are removed when it ends: each step is written to the shared
    folder, so no later query reads them.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    root, paths = str(Path(__file__).parents[2]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), root]))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps survive a lost executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(of: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(of).cast("string"), F.lit("")).cast("binary")) % modulus


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def extended(schema: StructType, ddl: str) -> StructType:
    """A schema with further columns."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def frequent(counts: DataFrame, n: str, most: int) -> tuple[DataFrame, float]:
    """The rows with the largest counts, ``most`` at the most, and the least count among them.

    All rows of one count band are in or out together, so ties never make a difference, and
    only a histogram of a few hundred rows reaches the driver.
    """
    band = F.floor(F.log2(F.col(n).cast("double")) * 16)
    sizes = {
        r["band"]: r["size"]
        for r in counts.groupBy(band.alias("band")).agg(F.count("*").alias("size")).collect()
    }
    room, least = most, None
    for at in sorted(sizes, reverse=True):
        if sizes[at] > room:
            break
        room, least = room - sizes[at], at
    if least is None:
        return counts.where(F.lit(False)), float("inf")
    return counts.where(band >= F.lit(least)), 2.0 ** (least / 16)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the links (a, b): rows (node, root), root being the smallest node.

    Alternating large and small stars: every round hangs the neighbours of a node below the
    smallest one among them, first those above the node, then those below it.  The number of
    rounds grows with the logarithm of the longest chain.  Only minima are kept per node, no
    neighbour list, so a node with very many links is no large group.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges, before = stored(edges.distinct(), name), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, name)
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
