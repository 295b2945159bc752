"""How well an ad fits a skill profile."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.catalog import Catalog, labels_in
from stellwerk.functions.text import shortened_list


@dataclass(frozen=True)
class Profile:
    """Skills with mention counts, plus the two lists kept by hand."""

    counts: dict[str, int] = field(default_factory=dict)
    own: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()

    @property
    def skills(self) -> list[str]:
        return sorted((set(self.counts) | set(self.own)) - set(self.excluded))

    @property
    def focus(self) -> list[str]:
        often = {name for name, n in self.counts.items() if n >= fixed.FOCUS_MENTIONS}
        return sorted((often | set(self.own)) - set(self.excluded))

    def unknown_labels(self, catalog: Catalog) -> list[str]:
        """Hand-kept names the catalog does not have - probably typing errors."""
        return sorted((set(self.own) | set(self.excluded)) - set(catalog.labels))

    @classmethod
    def from_table(cls, table: DataFrame) -> Profile:
        """Read the single row of a profile table."""
        row = table.select("faehigkeiten", "eigene", "ausgeschlossen", "quellen").first()
        if row is None:
            raise ValueError("the profile table is empty")
        return cls(
            dict(row.faehigkeiten or {}),
            tuple(row.eigene or ()),
            tuple(row.ausgeschlossen or ()),
            tuple(row.quellen or ()),
        )


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def grade(points: Column, label_count: Column) -> Column:
    return (
        F.when(label_count < fixed.MIN_LABELS, fixed.GRADE_D)
        .when(points >= fixed.THRESHOLD_A, fixed.GRADE_A)
        .when(points >= fixed.THRESHOLD_B, fixed.GRADE_B)
        .otherwise(fixed.GRADE_C)
    )


def rating(labels: Column, title_labels: Column, profile: Profile) -> Column:
    """struct<stufe, punkte, treffer, luecken> from the labels of text and title.

    A label counts 1, in the title 3; the score is the covered share of that weight,
    damped by a constant in the denominator.  Fewer than three labels: grade D, score 0.
    """
    skills = _strings(profile.skills)
    extra = fixed.TITLE_WEIGHT - 1
    hits = F.array_intersect(labels, skills)
    in_title = F.array_intersect(title_labels, labels)
    title_hits = F.array_intersect(in_title, skills)
    reached = F.size(hits) + extra * F.size(title_hits)
    possible = F.size(labels) + extra * F.size(in_title)
    enough = F.size(labels) >= fixed.MIN_LABELS
    points = F.when(
        enough, F.bround(100 * reached / (possible + fixed.DAMPING), 0).cast("int")
    ).otherwise(0)
    return F.struct(
        grade(points, F.size(labels)).alias("stufe"),
        points.alias("punkte"),
        F.when(enough, hits).otherwise(F.array_sort(title_hits)).alias("treffer"),
        F.when(enough, F.array_except(labels, skills)).otherwise(_strings([])).alias("luecken"),
    )


def with_rating(
    ads: DataFrame, title: Column, text: Column, profile: Profile, catalog: Catalog
) -> DataFrame:
    """Add ``labels``, ``title_labels`` and ``rating``."""
    whole = F.concat_ws("\n", title, text)
    return with_rated_labels(ads, labels_in(whole, catalog), labels_in(title, catalog), profile)


def with_rated_labels(
    ads: DataFrame, labels: Column, title_labels: Column, profile: Profile
) -> DataFrame:
    """Add ``labels``, ``title_labels`` and ``rating``, the labels being known."""
    labelled = ads.withColumns({"labels": labels, "title_labels": title_labels})
    return labelled.withColumn(
        "rating", rating(F.col("labels"), F.col("title_labels"), profile)
    )


def shown_points(rating_column: Column) -> Column:
    """The score, null for grade D."""
    return F.when(rating_column["stufe"] != fixed.GRADE_D, rating_column["punkte"])


def focus_hits(hits: Column, profile: Profile) -> Column:
    return F.array_intersect(hits, _strings(profile.focus))


def hits_text(hits: Column, profile: Profile) -> Column:
    """Hits joined for display, focus labels with a star."""
    focus = profile.focus
    starred = F.transform(
        hits, lambda h: F.when(h.isin(*focus), F.concat(h, F.lit("*"))).otherwise(h)
    )
    return shortened_list(starred if focus else hits)


def gaps_text(gaps: Column) -> Column:
    return shortened_list(gaps)


def score_band(points: Column) -> Column:
    """'70-100', '55-69', '35-54' or '0-34'."""
    band = F.lit(None).cast("string")
    for low, high in fixed.SCORE_BANDS:
        band = F.coalesce(band, F.when(points.between(low, high), F.lit(f"{low}-{high}")))
    return band
