"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellwerk import fixed, schema
from stellwerk.functions.ad import ad_link, description, employer_name, requirement_text, source_name
from stellwerk.functions.catalog import by_category, labels_in, united
from stellwerk.functions.contact import contact, pay, pay_from_text
from stellwerk.functions.dates import age_days, epoch_date_text, published_on
from stellwerk.functions.defaults import BENEFITS
from stellwerk.functions.fingerprint import ad_fingerprint, claim_key, first_place
from stellwerk.functions.html import html_to_text
from stellwerk.functions.places import location_label
from stellwerk.functions.predicates import exclusion_text, passes
from stellwerk.functions.score import gaps_text, hits_text, shown_points, with_rated_labels
from stellwerk.functions.status import status_text
from stellwerk.functions.text import (
    ellipsis,
    employer_form,
    encoded_ref,
    pair_key,
    path_safe,
    place_form,
    title_form,
)
from stellwerk.functions.workmodel import from_text, work_model
from stellwerk.operators import (
    archive,
    backtest,
    batches,
    catalogs,
    dedup,
    details,
    entries,
    places,
    profile,
    rows,
    salary,
    tracker,
    trend,
)
from stellwerk.operators.sizes import number_rows
from stellwerk.plans.tables import (
    ADS_AS_OF,
    CATALOG,
    EVENTS_AS_OF,
    PROFILE,
    ads,
    extracted,
    postings,
    table,
    texts,
    title_of,
)
from stellwerk.session import fresh_path, tuned, written
from stellwerk.sources import feeds, messages, tables
from stellwerk.streaming import claims, digests, intake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of single queries; the oracle uses the same values.
IDLE_SECONDS = 7200
CHAIN_ROWS = 10_007
HISTORY_YEAR = 1996
CLAIM_DAYS = 5
ARCHIVE_SINCE = dt.date(2024, 1, 10)
ARCHIVE_AS_OF = dt.date(2025, 1, 15)
SEEN_AS_OF = dt.datetime(1999, 1, 1, tzinfo=dt.UTC)
SEARCH = feeds.Search(
    today=dt.date(1998, 6, 15),
    terms=("ring", "Bolt Senior", "widget"),
    place="NATION_1",
    max_age_days=28,
    catalog=CATALOG,
)


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(tuned(spark), sf_dir)

    QUERIES[f.__name__] = run
    return run


def _epoch(moment: dt.datetime) -> Column:
    return F.lit(int(moment.timestamp()))


def _narrow_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column, Column]:
    """Ads without their texts, and their labels: those of the text were found on its scan."""
    narrow = extracted(spark, sf_dir, text_labels=labels_in(F.col("text"), CATALOG))
    title = F.col("stellenangebotsTitel")
    rest = requirement_text(title, F.col("hauptberuf"), F.col("alleBerufe"), F.col("closing"))
    rest = F.concat_ws("\n", title, rest)
    return narrow, united(CATALOG, F.col("text_labels"), labels_in(rest, CATALOG)), labels_in(title, CATALOG)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow, labels, _ = _narrow_labels(spark, sf_dir)
    return narrow.select("referenznummer", "tag", labels.alias("labels"))


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow, labels, title_labels = _narrow_labels(spark, sf_dir)
    return with_rated_labels(narrow, labels, title_labels, PROFILE)


def judged_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated ads with an application status, for the ads that have labels."""
    marks = table(spark, sf_dir, "labels")
    return rated(spark, sf_dir).join(marks, "doc_id").withColumn("status", ad_status())


def ad_status() -> Column:
    state = F.col("o_orderstatus")
    return (
        F.when(F.col("toxic") == 1, fixed.DISCARDED)
        .when(state == "F", fixed.REJECTED)
        .when((state == "O") & (F.col("quality") == 1), fixed.OFFER)
        .when(state == "O", fixed.INTERVIEW)
        .when(F.col("quality") == 1, fixed.APPLIED)
        .otherwise(fixed.FOUND)
    )


def order_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as a seen table."""
    orders = table(spark, sf_dir, "orders")
    state, urgency = F.col("o_orderstatus"), F.col("o_orderpriority")
    found = F.unix_timestamp("o_orderdate")
    status = (
        F.when((state == "P") & (urgency == "1-URGENT"), fixed.APPLIED)
        .when((state == "P") & (urgency == "2-HIGH"), fixed.INTERVIEW)
        .when((state == "F") & (urgency == "1-URGENT"), fixed.DISCARDED)
        .when(state == "F", fixed.REJECTED)
        .when((state == "O") & (urgency == "5-LOW"), fixed.OFFER)
        .when((state == "O") & (urgency == "4-NOT SPECIFIED"), "ARCHIVIERT")
        .otherwise(fixed.FOUND)
    )
    customer = F.col("o_custkey")
    return orders.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("referenznummer"),
        F.concat(
            F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" with priority "),
            urgency, F.lit(" for customer number "), customer.cast("string"),
        ).alias("titel"),
        status.alias("status"),
        found.alias("erfasst_am"),
        F.when(customer % 2 == 0, found + 86400 * (customer % 30)).alias("geaendert_am"),
        F.when(customer % 5 != 0, found + 86400 * fixed.SEEN_DAYS).alias("ablauf_zeitpunkt"),
    )


# --- skill trend ---------------------------------------------------------------


@query
def trend_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labelled(spark, sf_dir)
    return trend.with_share(trend.demand(found), found)


@query
def trend_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labelled(spark, sf_dir)
    return trend.with_share(trend.top(trend.gaps(found, PROFILE)), found)


@query
def trend_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labelled(spark, sf_dir)
    return trend.with_share(trend.top(trend.covered(found, PROFILE)), found)


@query
def trend_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.monthly(labelled(spark, sf_dir))


@query
def trend_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.bars(labelled(spark, sf_dir), PROFILE, k=8)


@query
def trend_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.summary(rated(spark, sf_dir))


@query
def trend_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand from daily partials after three arrivals, each of which changes part of the days."""
    ads_now = labelled(spark, sf_dir).withColumn("part", F.substring("referenznummer", 2, 20).cast("long") % 3)
    ads_now = written(ads_now)
    path = fresh_path(spark, "partials")
    for part in range(3):
        days = ads_now.filter(F.col("part") == part).select("tag")
        trend.refresh(ads_now.filter(F.col("part") <= part), days, path)
    return trend.demand_of(trend.read_partials(spark, path))


@query
def trend_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most demanded labels with a column for each month of a year."""
    months = [f"{HISTORY_YEAR}-{m:02}" for m in range(1, 13)]
    return trend.history(labelled(spark, sf_dir), months)


@query
def catalog_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a catalog as large as the vocabulary of the benchmark texts.

    Every word of five letters or more is a rule: as a whole word, as the beginning of a word, or
    with four of its letters anywhere.
    """
    word = F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("label")
    found = table(spark, sf_dir, "benchmark").select(word).filter(F.length("label") >= 5).distinct()
    number = F.crc32(F.col("label").cast("binary"))
    pattern = (
        F.when(number % 3 == 0, F.concat(F.lit(r"\b"), "label", F.lit(r"\b")))
        .when(number % 3 == 1, F.concat(F.lit(r"\b"), F.substring("label", 1, 5)))
        .otherwise(F.substring("label", 2, 4))
    )
    rules = number_rows(found.select("label", pattern.alias("pattern")), [F.col("label")], "pos")
    labels = catalogs.labels_by_table(texts(spark, sf_dir, "documents"), rules, "doc_id", "text")
    listed = F.array_join(F.array_sort("labels"), ",")
    return labels.select("doc_id", F.size("labels").alias("n_labels"), F.md5(listed.cast("binary")).alias("digest"))


@query
def unknown_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.unknown_terms(texts(spark, sf_dir, "documents"), F.col("text"), CATALOG)


@query
def report_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = trend.unknown_terms(texts(spark, sf_dir, "documents"), F.col("text"), CATALOG)
    return trend.report_terms(counts)


# --- profile -------------------------------------------------------------------


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.corpus_mentions(texts(spark, sf_dir, "documents"), CATALOG, "text")


def _previous_profile(spark: SparkSession) -> DataFrame:
    kept = [(n, True, False) for n in PROFILE.own] + [(n, False, True) for n in PROFILE.excluded]
    kept.append(("handarbeit", True, False))
    return spark.createDataFrame(kept, "label STRING, own BOOLEAN, excluded BOOLEAN")


@query
def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.by_mentions(_mentions(spark, sf_dir))


@query
def profile_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = profile.refreshed(_mentions(spark, sf_dir), _previous_profile(spark))
    return profile.by_mentions(fresh)


@query
def profile_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = profile.refreshed(_mentions(spark, sf_dir), _previous_profile(spark))
    return profile.skills(fresh)


@query
def profile_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = by_category(_mentions(spark, sf_dir), CATALOG)
    return groups.select("category", F.array_join("labels", ", ").alias("labels"))


@query
def silent_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.silent_documents(texts(spark, sf_dir, "documents"), "doc_id", "text")


# --- score ---------------------------------------------------------------------


@query
def match_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("rating")
    return rated(spark, sf_dir).select(
        "referenznummer",
        r["stufe"].alias("grade"),
        shown_points(r).alias("points"),
        hits_text(r["treffer"], PROFILE).alias("hits"),
        gaps_text(r["luecken"]).alias("gaps"),
    )


@query
def grade_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.grades(rated(spark, sf_dir))


@query
def score_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = judged_entries(spark, sf_dir).select("status", F.col("rating.punkte").alias("punkte"))
    return backtest.outcome_by_band(scored).withColumn("quota", F.round("quota", 6))


@query
def score_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = judged_entries(spark, sf_dir).select("status", F.col("rating.punkte").alias("punkte"))
    means = backtest.score_means(scored)
    return means.withColumns(
        {c: F.round(c, 6) for c in ("mean_applied", "mean_discarded")}
    )


# --- fingerprint and repeats ---------------------------------------------------


@query
def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = first_place("stellenlokationen")
    return ads(spark, sf_dir).select(
        "referenznummer",
        employer_form("firma").alias("employer"),
        title_form("stellenangebotsTitel").alias("title"),
        place_form(place).alias("place"),
        claim_key(ad_fingerprint()).alias("claim"),
    )


@query
def cross_source_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cross_source_groups(postings(spark, sf_dir))


def _rejected() -> Column:
    text = exclusion_text(F.col("stellenangebotsTitel"), F.col("hauptberuf"), F.col("alleBerufe"))
    return ~passes(
        F.col("firma"), text, fixed.EXCLUDED_TERMS, (), fixed.EXCLUDED_EMPLOYERS
    )


@query
def claim_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.outcomes(postings(spark, sf_dir), _rejected()).select(
        "seq", "referenznummer", "outcome"
    )


@query
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = dedup.outcomes(postings(spark, sf_dir), _rejected())
    return judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("ads"))


@query
def new_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second half of the month against the references claimed in the first half."""
    every = postings(spark, sf_dir)
    earlier = every.filter(F.col("tag") < F.lit(ARCHIVE_SINCE))
    later = every.filter(F.col("tag") >= F.lit(ARCHIVE_SINCE))
    return dedup.outcomes(
        later, _rejected(), earlier.select("referenznummer"), earlier.select("fp").dropna()
    ).select("seq", "outcome")


@query
def two_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items compete by part and by supplier: chains of shared keys everywhere."""
    items = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("referenznummer"),
        F.when(
            F.col("l_returnflag") != "N", F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
        ).alias("fp"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )
    # The table has no row number, and comparing one is much cheaper than six columns.
    order = [
        F.col(c)
        for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  "l_extendedprice")
    ]
    kept = dedup.two_key_dedup(number_rows(items, order, "seq"))
    return kept.select("referenznummer", "fp", "l_orderkey", "l_linenumber")


@query
def two_key_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that share a reference with the one before and a fingerprint with the one after.

    Chains of some 10,000 rows each, in which the decision on a row depends on all rows before it.
    """
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        key.alias("seq"),
        F.concat(F.lit("p"), F.floor(key / 2).cast("string")).alias("referenznummer"),
        F.when(key % CHAIN_ROWS != 0, F.concat(F.lit("s"), F.floor((key + 1) / 2).cast("string"))).alias("fp"),
    )
    return dedup.two_key_dedup(rows).select("seq", "referenznummer", "fp")


@query
def exclusion_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.when(F.col("o_orderstatus") != "F", fixed.FOUND).otherwise(fixed.APPLIED)
    listed = ads(spark, sf_dir).withColumn("status", found)
    judged = entries.title_reasons(listed, F.col("stellenangebotsTitel"))
    judged = entries.employer_reasons(judged, F.col("firma"))
    return entries.reason_counts(judged, "reason", "employer_reason")


# --- archive -------------------------------------------------------------------


def _archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.one_per_day(postings(spark, sf_dir))


@query
def archive_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archive(spark, sf_dir).select("referenznummer", "tag", "seq")


@query
def archive_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = archive.first_occurrences(_archive(spark, sf_dir))
    return first.select("referenznummer", "tag", "seq", "stellenangebotsTitel")


@query
def archive_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = archive.first_occurrences(_archive(spark, sf_dir), ARCHIVE_SINCE)
    return first.select("referenznummer", "tag", "seq", "stellenangebotsTitel")


@query
def archive_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = archive.within_retention(_archive(spark, sf_dir), F.lit(ARCHIVE_AS_OF))
    return kept.groupBy("tag").agg(F.count(F.lit(1)).alias("ads"))


@query
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals written into shared days, read back from a day on, first occurrences."""
    posted = postings(spark, sf_dir).drop("ts", "prio", "ort", "fp")
    path = fresh_path(spark, "archive")
    for odd in (1, 0):
        tables.write_archive(posted.filter(F.col("seq") % 2 == odd), path)
    kept = tables.read_archive(spark, path, ARCHIVE_SINCE)
    first = archive.first_occurrences(kept)
    return first.select("referenznummer", "tag", "stellenangebotsTitel", "quelle")


@query
def landed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details landed as JSON lines in four folders: a part of the lines is cut short."""
    path = fresh_path(spark, "landed")
    doc = F.col("doc_id")
    ref = F.when(doc % 11 != 3, F.concat(F.lit("d"), doc.cast("string"))).otherwise(F.lit(""))
    line = F.to_json(F.struct(ref.alias("referenznummer"), F.col("text").alias("stellenangebotsBeschreibung")))
    line = F.when(doc % 50 == 7, F.substring(line, 1, 20)).otherwise(line)
    rows = table(spark, sf_dir, "documents").select(line.alias("value"), (doc % 4).alias("slice"))
    rows.write.partitionBy("slice").text(path)
    counts = tables.rejects(tables.landed(spark, path, schema.DETAIL))
    part = F.regexp_extract("file", r"slice=(\d+)", 1).cast("int").alias("slice")
    return counts.groupBy(part).agg(*[F.sum(c).alias(c) for c in ("lines", "rejected", "without_ref")])


@query
def seen_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = archive.unexpired(order_entries(spark, sf_dir), _epoch(SEEN_AS_OF))
    return kept.select("referenznummer", "status", "ablauf_zeitpunkt")


@query
def nearest_day_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reference is looked up at a day up to two days off its first posting."""
    posted = postings(spark, sf_dir)
    firsts = posted.groupBy("referenznummer").agg(
        F.min("tag").alias("first_day"), F.min("seq").alias("first_seq")
    )
    shift = (F.col("first_seq") % 4 - 1).cast("int")
    wanted = firsts.select(
        "referenznummer", F.date_add("first_day", shift).alias("found_day")
    )
    stored = archive.one_per_day(posted).select("referenznummer", "tag", "seq")
    return archive.nearest_day(wanted, stored)


# --- details -------------------------------------------------------------------


def _stored_ads(every: DataFrame) -> DataFrame:
    """Ads as archived: the agency's carry no text."""
    text = F.when(F.col("quelle") != fixed.AGENCY, F.col("stellenangebotsBeschreibung"))
    return every.withColumn("stellenangebotsBeschreibung", text)


def _detail(every: DataFrame) -> DataFrame:
    """Detail views of the agency's ads."""
    agency = every.filter(F.col("quelle") == fixed.AGENCY)
    given = {"referenznummer", "stellenangebotsBeschreibung", "externeURL"}
    return agency.select(
        *[
            F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(schema.DETAIL)
        ]
    )


def _doc_ref() -> Column:
    return F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("referenznummer")


def _known_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details fetched so far: those of labelled documents, some of them withdrawn."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.when(F.col("toxic") == 0, F.col("text")).alias("stellenangebotsBeschreibung")
    return table(spark, sf_dir, "labels").join(documents, "doc_id").select(_doc_ref(), text)


@query
def detail_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = texts(spark, sf_dir, "documents").select(
        _doc_ref(), F.lower("text").alias("stellenangebotsBeschreibung")
    )
    full = details.add_details(_known_details(spark, sf_dir), fetched)
    return full.select("referenznummer", F.md5("stellenangebotsBeschreibung").alias("digest"))


@query
def missing_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_ads(ads(spark, sf_dir))
    return details.missing_details(stored, _known_details(spark, sf_dir))


# --- text extraction -----------------------------------------------------------


@query
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


@query
def work_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("stellenangebotsBeschreibung")
    return ads(spark, sf_dir).select(
        "referenznummer",
        from_text(text).alias("from_text"),
        work_model(
            F.col("homeofficeprozent"), text, F.col("homeofficetyp"), F.col("homeofficemoeglich")
        ).alias("model"),
    )


@query
def benefit_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = extracted(spark, sf_dir, named=labels_in(F.col("text"), BENEFITS))
    found = united(BENEFITS, F.col("named"), labels_in(F.col("closing"), BENEFITS))
    return narrow.select("referenznummer", F.array_join(found, ", ").alias("benefits"))


@query
def contact_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads(spark, sf_dir).select(
        "referenznummer", contact(None, F.col("stellenangebotsBeschreibung")).alias("contact")
    )


@query
def stated_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact and pay where the detail view states them, else from the text."""
    good = F.col("quality") == 1
    mail = F.concat(F.lit("hr"), F.col("doc_id").cast("string"), F.lit("@firma.example"))
    block = F.when(
        good,
        F.struct(
            F.lit("Frau").alias("anrede"), F.lit("").alias("titel"), F.col("p_first").alias("vorname"),
            F.lit("Muster").alias("nachname"), F.lit(None).cast("string").alias("name"),
            F.when(F.col("toxic") == 0, mail).alias("email"), F.lit(None).cast("string").alias("mail"),
            F.lit(None).cast("string").alias("telefon"), F.lit(" 040 123 ").alias("telefonnummer"),
            F.lit(None).cast("string").alias("tel"), F.lit("x").alias("rufnummer"),
        ),
    )
    first = F.initcap(F.element_at(F.split("stellenangebotsTitel", " "), 1))
    stated = F.when(F.col("toxic") == 1, "nach Vereinbarung")
    marked = ads(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").withColumn("p_first", first)
    marked = marked.withColumn("block", block)
    text = F.col("stellenangebotsBeschreibung")
    return marked.select(
        "referenznummer",
        contact(F.col("block"), text).alias("contact"),
        pay(stated, F.lit(None).cast("string"), F.col("tarifvertrag"), text).alias("pay"),
        encoded_ref("referenznummer").alias("encoded"),
        path_safe(F.concat_ws("/", "quelle", "referenznummer")).alias("path"),
    )


@query
def document_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents").select(
        "doc_id", contact(None, F.col("text")).alias("contact")
    )


@query
def pay_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("stellenangebotsBeschreibung")
    none = F.lit(None).cast("string")
    return ads(spark, sf_dir).select(
        "referenznummer",
        pay_from_text(text).alias("from_text"),
        pay(none, none, F.col("tarifvertrag"), text).alias("pay"),
    )


@query
def age_and_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads(spark, sf_dir).select(
        "referenznummer",
        age_days(published_on(), F.lit(ADS_AS_OF)).alias("age_days"),
        source_name(F.col("quelle")).alias("source"),
        ad_link(F.col("quelle"), F.col("referenznummer"), F.col("externeURL")).alias("link"),
        location_label(F.col("stellenlokationen")).alias("location"),
        employer_name(F.col("firma"), F.lit("unbekannt")).alias("employer"),
        pair_key("firma", "stellenangebotsTitel").alias("pair"),
        F.length(
            description(F.col("stellenbeschreibung"), F.col("stellenangebotsBeschreibung"))
        ).alias("description_chars"),
    )


def _cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.alias("pos"),
        F.lower("n_name").alias("name"),
        (47.0 + key * 0.3).alias("lat"),
        (6.0 + key * 0.35).alias("lon"),
    )


@query
def place_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    far = places.with_distance(ads(spark, sf_dir), _cities(spark, sf_dir), "NATION_0")
    return far.select("referenznummer", "entfernung_km")


# --- feeds and messages --------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every ad as an answer of each portal."""
    base = ads(spark, sf_dir)
    doc = F.col("doc_id").cast("string")
    title, employer = F.col("stellenangebotsTitel"), F.col("firma")
    place = first_place("stellenlokationen")
    url, jobs = F.col("externeURL"), F.col("alleBerufe")
    day = F.col("tag").cast("timestamp")
    html = F.concat(
        F.lit("<div><b>"), title, F.lit("</b> &amp; mehr<br/>"), F.col("hauptberuf"),
        F.lit("<script>x()</script></div>"),
    )
    epoch = F.unix_timestamp(day)

    def answer(field: str | None, *columns: Column) -> DataFrame:
        items = F.array(F.struct(*columns))
        body = items if field is None else F.struct(items.alias(field))
        return base.select(F.to_json(body).alias("value"))

    return {
        "arbeitsagentur": answer(
            "ergebnisliste",
            F.col("referenznummer"), title, employer, F.col("stellenlokationen"),
            F.col("datumErsteVeroeffentlichung"), F.col("hauptberuf"), jobs, url,
            F.col("homeofficeprozent"),
        ),
        "arbeitnow": answer(
            "data",
            doc.alias("slug"), title.alias("title"), employer.alias("company_name"),
            place.alias("location"), html.alias("description"), epoch.alias("created_at"),
            url.alias("url"), jobs.alias("tags"),
            F.when(F.col("o_orderstatus") == "P", "True").otherwise("false").alias("remote"),
        ),
        "adzuna": answer(
            "results",
            F.col("doc_id").alias("id"), title.alias("title"),
            F.struct(employer.alias("display_name")).alias("company"),
            F.struct(F.concat(F.lit("20095 "), place).alias("display_name")).alias("location"),
            F.struct(F.col("hauptberuf").alias("label")).alias("category"),
            html.alias("description"),
            F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
            url.alias("redirect_url"),
        ),
        "remotive": answer(
            "jobs",
            F.col("doc_id").alias("id"), title.alias("title"), employer.alias("company_name"),
            F.when(F.col("o_orderstatus") == "F", "USA").otherwise("Europe, UK").alias(
                "candidate_required_location"
            ),
            html.alias("description"),
            F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("publication_date"),
            url.alias("url"), jobs.alias("tags"),
        ),
        "remoteok": answer(
            None,
            F.lit("").alias("id"), doc.alias("slug"), title.alias("position"),
            employer.alias("company"), F.lit("").alias("location"), html.alias("description"),
            F.lit("").alias("date"), epoch.alias("epoch"), F.lit("").alias("url"),
            url.alias("apply_url"), jobs.alias("tags"),
        ),
        "jobicy": answer(
            "jobs",
            doc.alias("jobSlug"), title.alias("jobTitle"), employer.alias("companyName"),
            place.alias("jobGeo"), html.alias("jobExcerpt"),
            F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss Z").alias("pubDate"),
            url.alias("url"), jobs.alias("jobIndustry"),
        ),
    }


@query
def feed_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {
        name: feeds.ads_of(feeds.parse_jobs(payload, name), name, SEARCH)
        for name, payload in _payloads(spark, sf_dir).items()
    }
    first = F.get("stellenlokationen", F.lit(0))["adresse"]
    return feeds.union_feeds(frames).select(
        "prio",
        "referenznummer",
        "quelle",
        "stellenangebotsTitel",
        "firma",
        first["plz"].alias("plz"),
        first["ort"].alias("ort"),
        F.col("datumErsteVeroeffentlichung").alias("datum"),
        "hauptberuf",
        F.size("alleBerufe").alias("n_jobs"),
        F.coalesce("stellenangebotsBeschreibung", F.lit("")).alias("text"),
        F.col("externeURL").alias("url"),
        F.col("homeofficeprozent").cast("int").alias("percent"),
    )


def _own_feed() -> dict[str, feeds.Feed]:
    """The known feeds, the nationwide pass of the agency, and a feed of our own."""
    item = "nr BIGINT, titel STRING, firma STRING, tag STRING"

    def mapped(jobs: DataFrame) -> DataFrame:
        nothing = F.lit("")
        place = F.array(F.lit("20095 Hamburg"))
        return jobs.select(*feeds.canonical("intern", F.col("nr").cast("string"), F.col("titel"), F.col("firma"), place, nothing, F.col("tag"), nothing))

    def wanted(found: DataFrame, search: feeds.Search) -> DataFrame:
        return found.filter(search.recent(F.col("datumErsteVeroeffentlichung")))

    own = feeds.Feed("intern", item, "stellen", mapped, wanted)
    agency = replace(feeds.FEEDS["arbeitsagentur"], item=schema.AD + ", ortsgebunden BOOLEAN")
    return {**feeds.FEEDS, "arbeitsagentur": agency, "intern": own}


@query
def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed answers of three feeds, one of them our own, each with up to 500 jobs a file."""
    base = extracted(spark, sf_dir).withColumn("file", F.floor(F.col("doc_id") / 500))
    root = fresh_path(spark, "feeds")

    def land(name: str, field: str | None, *columns: Column, notice: Column | None = None) -> None:
        items = F.collect_list(F.to_json(F.struct(*columns)))
        listed = items if notice is None else F.concat(F.array(notice), items)
        body = F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]"))
        whole = body if field is None else F.concat(F.lit(f'{{"{field}":'), body, F.lit("}"))
        answers = base.groupBy("file").agg(whole.alias("value")).select("value")
        answers.write.option("maxRecordsPerFile", 1).text(f"{root}/{name}")

    title, employer, day = F.col("stellenangebotsTitel"), F.col("firma"), F.col("tag").cast("string")
    doc = F.col("doc_id").cast("string")
    land(
        "remoteok", None, doc.alias("slug"), title.alias("position"), employer.alias("company"), day.alias("date"),
        F.col("externeURL").alias("url"), notice=F.lit('{"legal": "a notice without a position"}'),
    )
    land("arbeitsagentur", "ergebnisliste", F.col("referenznummer"), title, employer, F.col("homeofficeprozent"), F.lit(False).alias("ortsgebunden"))
    land("intern", "stellen", F.col("doc_id").alias("nr"), title.alias("titel"), employer.alias("firma"), day.alias("tag"))
    paths = {name: f"{root}/{name}" for name in ("intern", "remoteok", "arbeitsagentur", "jobicy")}
    found = feeds.collect(spark, paths, SEARCH, _own_feed())  # nothing has landed for jobicy
    return found.select("prio", "referenznummer", "quelle", "stellenangebotsTitel", "firma")


def _posting_messages(posted: DataFrame) -> DataFrame:
    """Postings as keyed messages in the shape of the raw topic."""
    location = F.struct(F.struct(F.lit("").alias("plz"), F.col("ort")).alias("adresse"))
    body = F.struct(
        "referenznummer", "quelle", "stellenangebotsTitel", "firma",
        F.array(location).alias("stellenlokationen"), "hauptberuf", "alleBerufe",
    )
    return posted.select(
        F.col("referenznummer").alias("key"),
        F.to_json(body).alias("value"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


@query
def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode(_posting_messages(postings(spark, sf_dir))).select(
        F.col("offset").alias("seq"),
        F.col("key").alias("referenznummer"),
        "stellenangebotsTitel",
        claim_key(ad_fingerprint()).alias("claim"),
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream, dealt out if it has fewer files than there are cores."""
    events = table(spark, sf_dir, "events")
    reader = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
    cores = spark.sparkContext.defaultParallelism
    stream = reader.parquet(sf_dir)
    return stream.repartition(cores) if len(events.inputFiles()) < cores else stream


@query
def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream of raw messages through the intake job."""
    source = _event_stream(spark, sf_dir)
    folders = intake.Folders(fresh_path(spark, "intake"))
    stream = _posting_messages(postings(spark, sf_dir, source))
    run = intake.start(stream, folders, intake.Rules(), available_now=True)
    run.awaitTermination()
    return spark.read.parquet(folders.table("outcomes")).select(
        F.col("seq"), "referenznummer", "outcome"
    )


@query
def stream_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream of ads to digest, one recipient per event type."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    source = _event_stream(spark, sf_dir).select(*events.columns)
    folders = digests.Folders(fresh_path(spark, "digests"))
    keys = {"key": "event_type", "ts": "ts", "seq": "event_id"}
    run = digests.start(source, folders, idle_seconds=IDLE_SECONDS, available_now=True, **keys)
    run.awaitTermination()
    sent = spark.read.parquet(folders.table("digests")).select("event_id", "event_type")
    rest = digests.flush(spark, folders, events, idle_seconds=IDLE_SECONDS, **keys)
    left = rest.select("event_id", "event_type", F.lit(True).alias("flushed"))
    return sent.withColumn("flushed", F.lit(False)).unionByName(left)


@query
def stream_forwarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both streams one behind the other: what the intake forwards is read from its topic."""
    folders = intake.Folders(fresh_path(spark, "intake"), buckets=8)
    stream = _posting_messages(postings(spark, sf_dir, _event_stream(spark, sf_dir)))
    intake.start(stream, folders, intake.Rules(), available_now=True).awaitTermination()
    topic = messages.consume(spark, folders.table(messages.MATCHED_TOPIC))
    arrived = messages.decode_matched(topic).select("seq", "ts", "quelle", "referenznummer")
    keys = {"key": "quelle", "ts": "ts", "seq": "seq"}
    sent_to = digests.Folders(fresh_path(spark, "digests"))
    digests.start(arrived, sent_to, idle_seconds=IDLE_SECONDS, available_now=True, **keys).awaitTermination()
    sent = digests.read_table(spark, sent_to.table("digests"), "seq BIGINT, quelle STRING, referenznummer STRING")
    like = spark.createDataFrame([], arrived.schema)
    rest = digests.flush(spark, sent_to, like, idle_seconds=IDLE_SECONDS, **keys)
    columns = ("seq", "quelle", "referenznummer")
    every = sent.select(*columns).withColumn("flushed", F.lit(False))
    return every.unionByName(rest.select(*columns).withColumn("flushed", F.lit(True)))


def _claim_messages(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """Postings, and as a second kind of message what was decided: some purchases apply for the
    job that others have viewed."""
    posted = postings(spark, sf_dir, events)
    ads_in = claims.ad_messages(posted, "referenznummer", F.col("seq"), "ts", F.col("fp"), _rejected())
    bought = events.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 0))
    bought = bought.withColumn("viewed", F.concat(F.lit("view:"), F.col("user_id").cast("string")))
    return ads_in.unionByName(claims.status_messages(bought, "viewed", F.lit(fixed.APPLIED), F.col("event_id"), "ts"))


@query
def stream_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims that end after some days, as keyed state over four micro-batches and a restart."""
    claims.with_store(spark)
    events = table(spark, sf_dir, "events")
    folder, work = fresh_path(spark, "arrivals"), fresh_path(spark, "claims")

    def run() -> None:
        source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        found = claims.outcomes(_claim_messages(spark, sf_dir, source), CLAIM_DAYS * 86400)
        sink = found.writeStream.format("parquet").option("path", f"{work}/out")
        sink.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    for week in range(4):
        part = events.filter(F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)) == week)
        part.coalesce(1).write.mode("append").parquet(folder)
        if week == 1:
            run()  # stops here and goes on below from its checkpoint
    run()
    return spark.read.schema(claims.OUTCOME).parquet(f"{work}/out")


# --- digests -------------------------------------------------------------------


@query
def idle_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return batches.count_or_idle(
        events, "event_type", "ts", "event_id", idle_seconds=IDLE_SECONDS
    ).drop("ts")


@query
def digest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    posted = postings(spark, sf_dir).select("seq", "ts", "quelle", "ort")
    cut = batches.count_or_idle(posted, "quelle", "ts", "seq", idle_seconds=IDLE_SECONDS)
    return batches.summaries(cut, "quelle", "ort")


@query
def digest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = intake.Rules(profile=PROFILE, catalog=CATALOG)
    rich = intake.enriched(ads(spark, sf_dir), rules, None, F.lit(ADS_AS_OF))
    # Batches depend on recipient and time only, so rows are put in order without their ratings.
    narrow = extracted(spark, sf_dir).select("quelle", "doc_id", F.col("tag").cast("timestamp").alias("ts"))
    cut = batches.count_or_idle(narrow, "quelle", "ts", "doc_id").drop("quelle", "ts")
    rows = rich.select("referenznummer", "quelle", "doc_id", "enrichment").join(cut, "doc_id")
    return batches.digest_rows(rows).select(
        "referenznummer",
        "quelle",
        "batch",
        F.col("digest_order.rank").alias("rank"),
        "rating_line",
        "margin_line",
    )


# --- seen table ----------------------------------------------------------------


@query
def status_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = entries.listing(entries.ads_only(order_entries(spark, sf_dir)))
    return listed.select(
        "status",
        epoch_date_text(F.col("erfasst_am")).alias("found"),
        ellipsis("titel", 52).alias("titel"),
        "referenznummer",
    )


@query
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries.status_counts(entries.shown(order_entries(spark, sf_dir)))


@query
def overdue(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = entries.overdue(order_entries(spark, sf_dir), _epoch(SEEN_AS_OF))
    return entries.by_waiting_time(late).select(
        "tage", status_text(F.col("status")).alias("status"), ellipsis("titel", 50).alias("titel"),
        "referenznummer",
    )


@query
def oldest_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries numbered in the order in which they were found."""
    found = order_entries(spark, sf_dir).select("referenznummer", "erfasst_am")
    return number_rows(found, entries.found_order(), "nr").select("nr", "referenznummer")


@query
def marker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content claims that stand among the entries are left out, a blank status is read as found;
    entries without a reference make no message."""
    blank = F.when(F.col("geaendert_am").isNull(), F.lit(" ")).otherwise(F.col("status"))
    listed = order_entries(spark, sf_dir).withColumn("status", blank)
    odd = F.substring("referenznummer", 2, 20).cast("long") % 10 == 3
    listed = listed.withColumn("referenznummer", F.when(odd, F.lit("")).otherwise(F.col("referenznummer")))
    marks = postings(spark, sf_dir).select("fp").dropna().distinct()
    marks = marks.select(F.col("fp").alias("referenznummer"), F.lit(fixed.FOUND).alias("status"))
    every = listed.unionByName(marks, allowMissingColumns=True)
    kept = entries.ads_only(every).select("referenznummer", "status", "erfasst_am")
    sent = messages.keyed(kept).select(F.col("key").alias("referenznummer"), F.get_json_object("value", "$.status").alias("status"))
    return entries.status_counts(sent)


@query
def status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items change the status of their order; the last one counts."""
    moved = F.when(F.col("l_linestatus") == "F", fixed.APPLIED).otherwise(fixed.FOUND)
    changes = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("referenznummer"), moved.alias("status"), "l_linenumber"
    )
    seen = order_entries(spark, sf_dir)
    after = entries.set_status(seen, changes, _epoch(SEEN_AS_OF), F.col("l_linenumber"))
    return after.select("referenznummer", "status", "geaendert_am", "ablauf_zeitpunkt")


@query
def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items carry the decisions; the last one of an order counts."""
    flag = F.col("l_returnflag")
    cell = (
        F.when(flag == "A", " Abgeschickt ")
        .when((flag == "R") & (F.col("l_linestatus") == "F"), "absage")
        .when(flag == "R", "Vielleicht")
        .otherwise("")
    )
    chosen = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("referenznummer"),
        cell.alias("cell"),
        F.struct(
            "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
        ).alias("row"),
    )
    read = entries.read_back(order_entries(spark, sf_dir), chosen)
    return read.select("referenznummer", "status", "changed", "unknown")


# --- tracker table -------------------------------------------------------------


def _gathered(every: DataFrame) -> DataFrame:
    # Found up to one day off the archive day, as around midnight.
    found = F.unix_timestamp(F.date_add("tag", (F.col("doc_id") % 3 - 1).cast("int")).cast("timestamp"))
    seen = every.select(
        "referenznummer",
        F.col("stellenangebotsTitel").alias("titel"),
        F.when(F.col("o_orderstatus") == "F", fixed.REJECTED).otherwise(fixed.FOUND).alias("status"),
        found.alias("erfasst_am"),
    )
    return rows.gathered(seen, _stored_ads(every), _detail(every))


@query
def tracker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.tracker_rows(
        _gathered(ads(spark, sf_dir)), _cities(spark, sf_dir), F.lit(ADS_AS_OF), PROFILE, CATALOG,
        "NATION_0",
    )


@query
def decision_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = ads(spark, sf_dir)
    keyed = every.select("doc_id", "referenznummer", claim_key(ad_fingerprint()).alias("fp"))
    claimed = (
        dedup.first_per_key(keyed.dropna(subset=["fp"]), ["fp"], "doc_id")
        .select("fp", F.col("referenznummer").alias("zuerst_gesehen_als"))
    )
    return rows.decision_trace(_gathered(every), claimed, PROFILE, CATALOG)


def _new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ads as freshly built table rows."""
    return ads(spark, sf_dir).select(
        F.col("doc_id").alias("_seq"),
        F.col("referenznummer").alias(fixed.REF_COLUMN),
        F.col("firma").alias("Firma"),
        F.col("stellenangebotsTitel").alias("Position"),
        F.concat(F.lit(fixed.AGENCY_LINK), F.col("referenznummer")).alias(tracker.LINK),
        location_label(F.col("stellenlokationen")).alias("Standort"),
        F.coalesce("tarifvertrag", F.lit("")).alias("Gehalt"),
        F.lit("").alias("Status"),
        F.col("entfernung").alias("Entfernung (km)"),
    )


def _table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was: ads with labels, some without reference, some without link."""
    marked = ads(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    link = F.concat(F.lit(fixed.AGENCY_LINK), F.col("referenznummer"))
    return marked.select(
        F.col("doc_id").alias(tracker.ROW),
        F.when(good & ~toxic, F.col("referenznummer")).otherwise("").alias(fixed.REF_COLUMN),
        F.upper("firma").alias("Firma"),
        F.col("stellenangebotsTitel").alias("Position"),
        F.when(~toxic, link).otherwise("").alias(tracker.LINK),
        F.lit("").alias("Standort"),
        F.when(good, "verhandelt").otherwise("").alias("Gehalt"),
        status_text(ad_status()).alias("Status"),
        F.lit(1.5).alias("Entfernung (km)"),
        F.concat(F.lit("Notiz "), F.col("doc_id").cast("string")).alias("Eigenes"),
    )


@query
def tracker_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracker.merge(_table_rows(spark, sf_dir), _new_rows(spark, sf_dir)).drop("_seq")


@query
def tracker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an export does: new, updated and removed rows."""
    merged = tracker.merge(_table_rows(spark, sf_dir), _new_rows(spark, sf_dir))
    return tracker.change_counts(tracker.with_removal(merged, *_unfit(spark, sf_dir)), F.col("removed"))


def _unfit(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """References to remove while untouched, and references to remove in any case."""
    listed = ads(spark, sf_dir).withColumn("status", F.lit(fixed.FOUND))
    unfit = entries.title_reasons(listed, F.col("stellenangebotsTitel")).dropna(subset=["reason"])
    ref = F.col("referenznummer").alias(fixed.REF_COLUMN)
    return unfit.select(ref), judged_refs(spark, sf_dir, fixed.DISCARDED).select(ref)


@query
def tracker_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = tracker.remove(_table_rows(spark, sf_dir), *_unfit(spark, sf_dir))
    return kept.select(tracker.ROW, fixed.REF_COLUMN, "Status")


def judged_refs(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    marked = ads(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return marked.filter(ad_status() == status).select("referenznummer")


@query
def tracker_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("rating")
    marks = table(spark, sf_dir, "labels")
    table_now = (
        rated(spark, sf_dir)
        .join(marks, "doc_id", "left")
        .select(
            F.col("referenznummer").alias(fixed.REF_COLUMN),
            r["stufe"].alias("Passung"),
            shown_points(r).alias("Punkte"),
            status_text(ad_status()).alias("Status"),
            age_days(published_on(), F.lit(ADS_AS_OF)).alias("Alter (Tage)"),
            F.col("firma").alias("Firma"),
        )
    )
    return tracker.ranked(table_now, [F.col(fixed.REF_COLUMN)])


@query
def table_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions read from the tracker table, put into the seen table; wordings nobody knows."""
    rows_ = _table_rows(spark, sf_dir)
    odd = F.when(F.col(tracker.ROW) % 7 == 0, F.concat(F.lit("wording "), (F.col(tracker.ROW) % 3).cast("string")))
    chosen = tracker.decisions(rows_.withColumn("Status", F.coalesce(odd, "Status")))
    seen = ads(spark, sf_dir).select("referenznummer", F.lit(fixed.FOUND).alias("status"))
    return entries.unknown_wordings(entries.read_back(seen, chosen))


@query
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _table_rows(spark, sf_dir).select(
        F.col(fixed.REF_COLUMN),
        F.col("Eigenes"),
        F.col("Firma").alias(" FIRMA "),
        F.col("Position"),
        F.lit("weg").alias("Notizen"),
        F.col("Gehalt"),
        F.col("Status").alias("status"),
    )
    return tracker.evolve(old, fixed.COLUMNS_PLAIN)


# --- salary --------------------------------------------------------------------


def _salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as salary records; a negative balance is a missing figure."""
    key = F.col("s_suppkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    def level(value: Column, name: Column | None = None) -> Column:
        label = F.lit("x") if name is None else name
        return F.struct(value.cast("int").alias("id"), label.alias("bezeichnung"))

    codes = F.array(
        *[F.lit(g + n) for g in (fixed.CODE_SOFTWARE, fixed.CODE_CONSULTING) for n in "234"]
    )
    pay = F.col("s_acctbal").cast("int")
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.get(codes, (key % 6).cast("int")).alias("kldb"),
            level(F.col("s_nationkey") % 3, F.col("n_name")).alias("region"),
            level(key % 2).alias("branche"),
            level(F.lit(1)).alias("ageCategory"),
            level(F.lit(1)).alias("gender"),
            level(key % 4, F.concat(F.lit("Niveau "), (key % 4).cast("string"))).alias(
                "performanceLevel"
            ),
            pay.alias("entgelt"),
            (pay - 2000).alias("entgeltQ25"),
            (pay + 2000).alias("entgeltQ75"),
            F.when(key % 3 == 0, F.lit(-42)).otherwise(key.cast("int")).alias("besetzung"),
            key.alias("pos"),
        )
    )


@query
def salary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = table(spark, sf_dir, "part").select("p_partkey", title_of().alias("titel"), "p_size")
    pay_rows = salary.pay_table(_salaries(spark, sf_dir))
    return salary.lookup(titles, "titel", F.col("p_size") % 3, pay_rows).drop("p_size")
