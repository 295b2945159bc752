"""The seen table: listing, decisions, overdue applications, exclusions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.dates import days_since
from stellwerk.functions.fingerprint import is_claim_key
from stellwerk.functions.predicates import employer_reason, exclusion_reason
from stellwerk.functions.status import is_tracked, status_from_cell, status_rank
from stellwerk.functions.text import filled, strip


def ads_only(seen: DataFrame, ref: str = "referenznummer") -> DataFrame:
    """Without the marker rows of the content claims, blank status read as found."""
    return seen.filter(~is_claim_key(F.col(ref))).withColumn(
        "status", F.coalesce(filled("status"), F.lit(fixed.FOUND))
    )


def with_status(seen: DataFrame, status: str | None = None) -> DataFrame:
    """All entries, or those of one status (a filter that reaches the scan)."""
    return seen if status is None else seen.filter(F.col("status") == status)


def listing(entries: DataFrame) -> DataFrame:
    """Life-cycle order, newest first."""
    return entries.orderBy(
        status_rank(F.col("status")), F.desc("erfasst_am"), "referenznummer"
    )


def oldest_first(entries: DataFrame) -> DataFrame:
    """In the order in which they were found; entries without a time come first."""
    return entries.orderBy(*found_order())


def found_order() -> list[Column]:
    return [F.coalesce("erfasst_am", F.lit(0)), F.col("referenznummer")]


def status_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("status").agg(F.count(F.lit(1)).alias("entries"))


def overdue(entries: DataFrame, as_of_epoch: Column, days: int = fixed.OVERDUE_DAYS) -> DataFrame:
    """Open applications without a change for at least ``days`` days; adds ``tage``."""
    changed = F.coalesce(F.nullif(F.col("geaendert_am"), F.lit(0)), F.col("erfasst_am"))
    waiting = entries.filter(F.col("status").isin(fixed.APPLIED, fixed.INTERVIEW))
    return waiting.withColumn("tage", days_since(changed, as_of_epoch)).filter(
        F.col("tage") >= days
    )


def by_waiting_time(waiting: DataFrame) -> DataFrame:
    return waiting.orderBy(F.desc("tage"), "referenznummer")


def shown(entries: DataFrame) -> DataFrame:
    """Without the entries marked as not interesting."""
    return entries.filter(F.col("status") != fixed.DISCARDED)


def title_reasons(
    entries: DataFrame, title: Column, terms: Iterable[str] = fixed.EXCLUDED_TERMS
) -> DataFrame:
    """Add ``reason``; only entries nobody has decided upon can be excluded."""
    found = F.col("status") == fixed.FOUND
    return entries.withColumn("reason", F.when(found, exclusion_reason(title, terms)))


def employer_reasons(
    rows: DataFrame, employer: Column, terms: Iterable[str] = fixed.EXCLUDED_EMPLOYERS
) -> DataFrame:
    """Add ``employer_reason`` under the same rule."""
    found = F.col("status") == fixed.FOUND
    return rows.withColumn("employer_reason", F.when(found, employer_reason(employer, terms)))


def split(rows: DataFrame, reason: str, enabled: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded) by a reason column."""
    if not enabled:
        return rows, rows.limit(0)
    return rows.filter(F.col(reason).isNull()), rows.filter(F.col(reason).isNotNull())


def reason_counts(rows: DataFrame, *reasons: str) -> DataFrame:
    """(reason, entries) over one or more reason columns, the first that applies."""
    reason = F.coalesce(*[F.col(r) for r in reasons]).alias("reason")
    return rows.select(reason).dropna().groupBy("reason").agg(F.count(F.lit(1)).alias("entries"))


def read_back(entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """Take over what the user chose in the table; adds ``changed`` and ``unknown``.

    ``decisions`` has referenznummer, cell and row (a later row of the same reference
    wins).  A blank cell means found, a wording nobody knows is reported, not guessed,
    and a reference the table does not have stays as it is.
    """
    latest = (
        decisions.select(strip("referenznummer").alias("referenznummer"), "cell", "row")
        .filter("referenznummer <> ''")
        .groupBy("referenznummer")
        .agg(F.max(F.struct("row", "cell"))["cell"].alias("cell"), F.lit(True).alias("_listed"))
    )
    chosen = status_from_cell(F.col("cell"))
    listed = F.coalesce(F.col("_listed"), F.lit(False))
    changed = F.coalesce(listed & (chosen != F.col("status")), F.lit(False))
    return (
        entries.join(latest, "referenznummer", "left")
        .withColumn("unknown", F.when(listed & chosen.isNull(), strip("cell")))
        .withColumn("changed", changed)
        .withColumn("status", F.when(changed, chosen).otherwise(F.col("status")))
        .drop("cell", "_listed")
    )


def unknown_wordings(read: DataFrame) -> DataFrame:
    """Distinct table wordings that are no status, sorted."""
    return read.select("unknown").dropna().distinct().orderBy("unknown")


def set_status(
    seen: DataFrame, changes: DataFrame, as_of_epoch: Column, order: Column | None = None
) -> DataFrame:
    """Apply (referenznummer, status): stamp the change; a decided entry never expires.

    Of several changes to a reference the last by ``order`` counts; without an order, or on
    a tie, the greatest status does.
    """
    new = F.col("_new")
    rank = F.struct(*([] if order is None else [order]), F.col("status"))
    changes = changes.groupBy("referenznummer").agg(F.max_by("status", rank).alias("status"))
    return (
        seen.join(
            changes.select("referenznummer", F.col("status").alias("_new")),
            "referenznummer",
            "left",
        )
        .withColumns(
            {
                "status": F.coalesce(new, F.col("status")),
                "geaendert_am": F.when(new.isNotNull(), as_of_epoch).otherwise(
                    F.col("geaendert_am")
                ),
                "ablauf_zeitpunkt": F.when(
                    F.coalesce(is_tracked(new), F.lit(False)), F.lit(None).cast("long")
                ).otherwise(F.col("ablauf_zeitpunkt")),
            }
        )
        .drop("_new")
    )


def unknown_refs(seen: DataFrame, changes: DataFrame) -> DataFrame:
    """Changes to references that do not exist."""
    return changes.join(seen.select("referenznummer"), "referenznummer", "left_anti")
