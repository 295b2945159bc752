"""A skill profile from a corpus of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.catalog import Catalog, mentions_in
from stellwerk.functions.text import strip


def readable(text: Column) -> Column:
    """Enough text to count; shorter documents are probably scans."""
    return F.length(strip(text)) >= fixed.MIN_DOCUMENT_CHARS


def silent_documents(corpus: DataFrame, name: str = "path", text: str = "value") -> DataFrame:
    """Documents that were set aside."""
    return corpus.filter(~readable(F.col(text))).select(name)


def corpus_mentions(corpus: DataFrame, catalog: Catalog, text: str = "value") -> DataFrame:
    """(label, n): mentions of each label over all readable documents."""
    found = corpus.filter(readable(F.col(text))).select(
        F.inline(mentions_in(F.col(text), catalog))
    )
    return found.groupBy("label").agg(F.sum("n").cast("long").alias("n"))


def refreshed(mentions: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(label, n, own, excluded): new counts, hand-kept flags of the previous profile.

    ``previous`` has label, own, excluded.  A label that is only kept by hand stays with
    count null.
    """
    if previous is None:
        flags = mentions.select("label").limit(0).select(
            "label", F.lit(False).alias("own"), F.lit(False).alias("excluded")
        )
    else:
        flags = previous.select("label", "own", "excluded").filter("own or excluded")
    return mentions.join(flags, "label", "full").select(
        "label",
        "n",
        F.coalesce("own", F.lit(False)).alias("own"),
        F.coalesce("excluded", F.lit(False)).alias("excluded"),
    )


def skills(profile: DataFrame) -> DataFrame:
    """(label, n, focus): found or own, not excluded; focus is own or often mentioned."""
    focus = F.col("own") | F.coalesce(F.col("n") >= fixed.FOCUS_MENTIONS, F.lit(False))
    return profile.filter(~F.col("excluded")).select("label", "n", focus.alias("focus"))


def by_mentions(profile: DataFrame) -> DataFrame:
    """Most mentioned first, ties by label."""
    return profile.orderBy(F.desc_nulls_last("n"), "label")


def unknown_labels(profile: DataFrame, catalog: Catalog) -> DataFrame:
    """Hand-kept labels the catalog does not have."""
    known = catalog.to_table(profile.sparkSession).select("label")
    return profile.filter("own or excluded").select("label").join(known, "label", "left_anti")


def as_profile_row(profile: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """The single row of a profile table.  Has at most one item per catalog label."""
    counted = F.col("n").isNotNull()
    entry = F.struct("label", F.col("n").cast("int").alias("n"))
    return profile.agg(
        F.map_from_entries(F.array_compact(F.collect_list(F.when(counted, entry)))).alias(
            "faehigkeiten"
        ),
        F.sort_array(F.collect_list(F.when(F.col("own"), F.col("label")))).alias("eigene"),
        F.sort_array(F.collect_list(F.when(F.col("excluded"), F.col("label")))).alias(
            "ausgeschlossen"
        ),
    ).withColumn("quellen", F.array(*[F.lit(s) for s in sources or []]).cast("array<string>"))
