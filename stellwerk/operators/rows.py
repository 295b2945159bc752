"""From entries, archive and details to rows of the tracker table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.ad import ad_link, description, employer_name, requirement_text, source_name
from stellwerk.functions.catalog import Catalog, labels_in
from stellwerk.functions.contact import contact, contact_block, pay
from stellwerk.functions.dates import age_days, published_on
from stellwerk.functions.defaults import BENEFITS
from stellwerk.functions.fingerprint import ad_fingerprint, claim_key
from stellwerk.functions.places import location_label
from stellwerk.functions.predicates import exclusion_reason
from stellwerk.functions.score import Profile, gaps_text, hits_text, shown_points, with_rating
from stellwerk.functions.status import status_text
from stellwerk.functions.text import first_filled
from stellwerk.functions.workmodel import work_model
from stellwerk.operators.archive import nearest_day
from stellwerk.operators.details import lacks_text, with_detail
from stellwerk.operators.places import with_distance


def gathered(entries: DataFrame, archive: DataFrame, detail: DataFrame) -> DataFrame:
    """Entries with their archived ad and, where needed, their detail view.

    Adds ``text`` (the description), ``title`` (archive first, then the entry) and
    ``whole_text`` (everything a requirement may stand in).
    """
    found_day = F.timestamp_seconds(F.nullif("erfasst_am", F.lit(0))).cast("date")
    raw = nearest_day(entries.withColumn("found_day", found_day), archive)
    full = with_detail(raw, detail, lacks_text())
    old, new = fixed.DESCRIPTION_FIELDS[1], fixed.DESCRIPTION_FIELDS[0]
    text = description(
        F.col(f"detail.{new}"), F.col(f"detail.{old}"), F.col(new), F.col(old)
    )
    return (
        full.withColumn("text", text)
        .withColumn("title", first_filled("stellenangebotsTitel", "titel"))
        .withColumn(
            "whole_text",
            requirement_text(
                F.col("stellenangebotsTitel"),
                F.col("hauptberuf"),
                F.col("alleBerufe"),
                F.col("text"),
            ),
        )
    )


def tracker_rows(
    gathered_rows: DataFrame,
    cities: DataFrame,
    as_of: Column,
    profile: Profile | None = None,
    catalog: Catalog | None = None,
    search_place: str = fixed.DEFAULT_PLACE,
    benefits: Catalog = BENEFITS,
) -> DataFrame:
    """One row per entry with the 13 tracker columns (17 with a profile) and the key.

    All cells but the distance are drawn before places are looked up: many rows share a place,
    and the join by place moves none of their texts and leaves no work on texts behind it.
    """
    rows = gathered_rows
    if profile is not None:
        if catalog is None:
            raise ValueError("a profile needs the catalog it refers to")
        rows = with_rating(rows, F.col("title"), F.col("whole_text"), profile, catalog)
    d = lambda name: F.col(f"detail.{name}")
    text = F.col("text")
    block = contact_block(d("kontakt"), d("ansprechpartner"), d("arbeitgeberKontakt"))
    cells = {
        fixed.REF_COLUMN: F.col("referenznummer"),
        "Firma": employer_name(F.col("firma"), d("arbeitgeber")),
        "Position": F.col("title"),
        "Link zur Ausschreibung": ad_link(
            F.col("quelle"), F.col("referenznummer"), F.col("externeURL"), d("externeURL")
        ),
        "Standort": location_label(F.col("stellenlokationen"), d("arbeitsorte")),
        "Homeoffice-Modell": work_model(
            F.col("homeofficeprozent"),
            text,
            first_filled("homeofficetyp", d("homeofficetyp")),
            F.coalesce(F.col("homeofficemoeglich"), F.lit(False))
            | F.coalesce(d("homeofficemoeglich"), F.lit(False)),
        ),
        "Gehalt": pay(d("verguetung"), d("tarifvertrag"), F.col("tarifvertrag"), text),
        "Benefits": F.array_join(labels_in(text, benefits), ", "),
        "Kontakt": contact(block, text),
        "Status": status_text(F.col("status")),
        "Quelle": source_name(F.col("quelle")),
        "Alter (Tage)": age_days(published_on(), as_of),
    }
    if profile is not None:
        rating = F.col("rating")
        cells |= {
            "Passung": rating["stufe"],
            "Punkte": shown_points(rating),
            "Treffer": hits_text(rating["treffer"], profile),
            "Lücken": gaps_text(rating["luecken"]),
        }
    drawn = rows.select(*[value.alias(name) for name, value in cells.items()], "stellenlokationen", *fixed.DISTANCE_FIELDS)
    far = F.col("entfernung_km").alias("Entfernung (km)")
    after = list(cells).index("Alter (Tage)") + 1
    names = [F.col(f"`{name}`") for name in cells]
    return with_distance(drawn, cities, search_place).select(*names[:after], far, *names[after:])


def decision_trace(
    gathered_rows: DataFrame,
    claims: DataFrame,
    profile: Profile,
    catalog: Catalog,
    terms: Iterable[str] = fixed.EXCLUDED_TERMS,
) -> DataFrame:
    """Why an entry is (not) in the table, for all entries at once.

    ``duplicate_of`` is the reference that claimed the content first, if it is another
    one; ``reason`` the excluded term in the title; then grade and score.
    """
    claimed = claims.select(
        F.col("fp").alias("claim"), F.col("zuerst_gesehen_als").alias("first_seen_as")
    )
    # An ad without a fingerprint asks under a key of its own that no claim has.
    key = F.coalesce(claim_key(ad_fingerprint()), F.col("referenznummer"))
    rows = gathered_rows.withColumn("claim", key).join(claimed, "claim", "left")
    rated = with_rating(rows, F.col("title"), F.col("whole_text"), profile, catalog)
    first = F.col("first_seen_as")
    return rated.select(
        "referenznummer",
        status_text(F.col("status")).alias("status_text"),
        "title",
        source_name(F.col("quelle")).alias("source"),
        F.when(first != F.col("referenznummer"), first).alias("duplicate_of"),
        exclusion_reason(F.col("title"), terms).alias("reason"),
        F.col("rating.stufe").alias("grade"),
        shown_points(F.col("rating")).alias("points"),
        hits_text(F.col("rating.treffer"), profile).alias("hits"),
        gaps_text(F.col("rating.luecken")).alias("gaps"),
        (F.col("text") == "").alias("no_text"),
    )
