"""Portal feeds: six JSON shapes, one ad schema.

A feed is a name, a schema, a mapping to the ad shape and the checks the portal does
not make itself.  Adding one means adding a :class:`Feed` to the registry.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellwerk import fixed, schema
from stellwerk.functions.catalog import Catalog
from stellwerk.functions.dates import any_date_text, within_days
from stellwerk.functions.defaults import SKILLS
from stellwerk.functions.html import html_to_text
from stellwerk.functions.places import place_structs
from stellwerk.functions.predicates import fits_place, fits_region, fully_remote, matches_search
from stellwerk.functions.text import casefold, filled, strip

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Search:
    """What to look for.  ``today`` is a parameter so that a run can be repeated."""

    today: dt.date
    terms: tuple[str, ...] = (
        "Data Engineer", "Softwareentwickler", "Software Engineer", "Developer", "Java",
    )
    place: str = fixed.DEFAULT_PLACE
    max_age_days: int = 7
    remote_anywhere: bool = True
    remote_percent: int = 100
    catalog: Catalog = field(default=SKILLS, repr=False)

    def __post_init__(self) -> None:
        if not self.terms:
            raise ValueError("a search needs at least one term")
        if self.max_age_days not in fixed.ALLOWED_AGE_WINDOWS:
            raise ValueError(f"max_age_days must be one of {fixed.ALLOWED_AGE_WINDOWS}")

    def recent(self, date_text: Column) -> Column:
        return within_days(date_text, self.max_age_days, F.lit(self.today))

    def wants(self, title: Column) -> Column:
        return matches_search(title, self.terms, self.catalog)


def canonical(
    source: str,
    key: Column,
    title: Column,
    employer: Column,
    places: Column,
    html: Column,
    published: Column,
    url: Column,
    jobs: Column | None = None,
    remote_percent: Column | None = None,
) -> list[Column]:
    """The ad columns of one job.  Jobs without title or key are filtered by the caller."""
    trimmed = (
        F.array().cast("array<string>")
        if jobs is None
        else F.filter(
            F.coalesce(F.transform(jobs, strip), F.array().cast("array<string>")),
            lambda j: j != "",
        )
    )
    percent = F.lit(None) if remote_percent is None else remote_percent
    return [
        F.concat(F.lit(source + ":"), strip(key)).alias("referenznummer"),
        F.lit(source).alias("quelle"),
        strip(title).alias("stellenangebotsTitel"),
        strip(employer).alias("firma"),
        place_structs(places).alias("stellenlokationen"),
        any_date_text(published).alias("datumErsteVeroeffentlichung"),
        F.coalesce(F.get(trimmed, F.lit(0)), F.lit("")).alias("hauptberuf"),
        trimmed.alias("alleBerufe"),
        html_to_text(html).alias("stellenangebotsBeschreibung"),
        strip(url).alias("externeURL"),
        percent.cast("double").alias("homeofficeprozent"),
    ]


def true_flag_percent(flag: Column) -> Column:
    """100 for a true boolean or the text 'true' in any case, else null."""
    return F.when(casefold(strip(flag.cast("string"))) == "true", F.lit(100))


@dataclass(frozen=True)
class Feed:
    """``item`` is the DDL of one job, ``envelope`` the list field (None: a bare array)."""

    name: str
    item: str
    envelope: str | None
    mapped: Callable[[DataFrame], DataFrame]
    wanted: Callable[[DataFrame, Search], DataFrame]
    # Page limits are the portal's; landed files have as many rows as they have.
    max_pages: int = fixed.OTHER_MAX_PAGES


def _usable(jobs: DataFrame, key: Column, title: Column) -> DataFrame:
    return jobs.filter(filled(title).isNotNull() & filled(key).isNotNull())


def _agency_mapped(jobs: DataFrame) -> DataFrame:
    named = jobs.filter(F.length("referenznummer") > 0)
    return named.withColumn("quelle", F.lit(fixed.AGENCY))


def _agency_wanted(ads: DataFrame, search: Search) -> DataFrame:
    """The portal searches by place itself; a nationwide file holds fully remote jobs too.

    Files of the nationwide pass carry ``ortsgebunden`` = false.
    """
    if "ortsgebunden" not in ads.columns:
        return ads
    local = F.coalesce(F.col("ortsgebunden"), F.lit(True))
    remote = fully_remote(F.col("homeofficeprozent"), search.remote_percent)
    return ads.filter(local | (F.lit(search.remote_anywhere) & remote)).drop("ortsgebunden")


def _by_title_and_date(ads: DataFrame, search: Search) -> DataFrame:
    return ads.filter(
        search.recent(F.col("datumErsteVeroeffentlichung"))
        & search.wants(F.col("stellenangebotsTitel"))
    )


def _arbeitnow_mapped(jobs: DataFrame) -> DataFrame:
    percent = true_flag_percent(F.col("remote"))
    return _usable(jobs, F.col("slug"), F.col("title")).select(
        *canonical(
            "arbeitnow", F.col("slug"), F.col("title"), F.col("company_name"),
            F.array("location"), F.col("description"), F.col("created_at"), F.col("url"),
            F.col("tags"), percent,
        ),
        F.col("location").alias("_location"),
    )


def _arbeitnow_wanted(ads: DataFrame, search: Search) -> DataFrame:
    near = fits_place(F.col("homeofficeprozent"), F.col("_location"), search.place)
    return _by_title_and_date(ads, search).filter(near).drop("_location")


def _adzuna_mapped(jobs: DataFrame) -> DataFrame:
    return _usable(jobs, F.col("id"), F.col("title")).select(
        *canonical(
            "adzuna", F.col("id"), F.col("title"), F.col("company.display_name"),
            F.array("location.display_name"), F.col("description"), F.col("created"),
            F.col("redirect_url"), F.array("category.label"),
        )
    )


def _remotive_mapped(jobs: DataFrame) -> DataFrame:
    region = F.col("candidate_required_location")
    return _usable(jobs, F.col("id"), F.col("title")).select(
        *canonical(
            "remotive", F.col("id"), F.col("title"), F.col("company_name"), F.array(region),
            F.col("description"), F.col("publication_date"), F.col("url"), F.col("tags"),
            F.lit(100),
        ),
        region.alias("_region"),
    )


def _remotive_wanted(ads: DataFrame, search: Search) -> DataFrame:
    """The portal searches by term itself."""
    recent = search.recent(F.col("datumErsteVeroeffentlichung"))
    return ads.filter(fits_region(F.col("_region")) & recent).drop("_region")


def _remoteok_mapped(jobs: DataFrame) -> DataFrame:
    # The first element of the array is a notice without a position.
    key = F.coalesce(filled("id"), filled("slug"))
    return _usable(jobs, key, F.col("position")).select(
        *canonical(
            "remoteok", key, F.col("position"), F.col("company"), F.array("location"),
            F.col("description"), F.coalesce(filled("date"), filled("epoch")),
            F.coalesce(filled("url"), filled("apply_url")), F.col("tags"), F.lit(100),
        )
    )


def _jobicy_mapped(jobs: DataFrame) -> DataFrame:
    key = F.coalesce(filled("id"), filled("jobSlug"))
    return _usable(jobs, key, F.col("jobTitle")).select(
        *canonical(
            "jobicy", key, F.col("jobTitle"), F.col("companyName"), F.array("jobGeo"),
            F.coalesce(filled("jobDescription"), filled("jobExcerpt")), F.col("pubDate"),
            F.col("url"), F.col("jobIndustry"), F.lit(100),
        )
    )


FEEDS: dict[str, Feed] = {
    feed.name: feed
    for feed in (
        Feed(
            "arbeitsagentur", schema.AD, "ergebnisliste", _agency_mapped, _agency_wanted,
            fixed.AGENCY_MAX_PAGES,
        ),
        Feed(
            "arbeitnow",
            "slug STRING, title STRING, company_name STRING, location STRING,"
            " description STRING, created_at STRING, url STRING, remote STRING,"
            " tags ARRAY<STRING>",
            "data", _arbeitnow_mapped, _arbeitnow_wanted,
        ),
        Feed(
            "adzuna",
            "id STRING, title STRING, company STRUCT<display_name: STRING>,"
            " location STRUCT<display_name: STRING>, category STRUCT<label: STRING>,"
            " description STRING, created STRING, redirect_url STRING",
            "results", _adzuna_mapped, _by_title_and_date,
        ),
        Feed(
            "remotive",
            "id STRING, title STRING, company_name STRING,"
            " candidate_required_location STRING, description STRING,"
            " publication_date STRING, url STRING, tags ARRAY<STRING>",
            "jobs", _remotive_mapped, _remotive_wanted,
        ),
        Feed(
            "remoteok",
            "id STRING, slug STRING, position STRING, company STRING, location STRING,"
            " description STRING, date STRING, epoch STRING, url STRING, apply_url STRING,"
            " tags ARRAY<STRING>",
            None, _remoteok_mapped, _by_title_and_date,
        ),
        Feed(
            "jobicy",
            "id STRING, jobSlug STRING, jobTitle STRING, companyName STRING, jobGeo STRING,"
            " jobDescription STRING, jobExcerpt STRING, pubDate STRING, url STRING,"
            " jobIndustry ARRAY<STRING>",
            "jobs", _jobicy_mapped, _by_title_and_date,
        ),
    )
}


def feed(name: str, registry: Mapping[str, Feed] = FEEDS) -> Feed:
    if name not in registry:
        raise ValueError(f"unknown feed {name!r}; known: {', '.join(registry)}")
    return registry[name]


def read_jobs(
    spark: SparkSession, name: str, path: str | list[str], registry: Mapping[str, Feed] = FEEDS
) -> DataFrame:
    """Jobs of landed feed files; unreadable files give no rows."""
    f = feed(name, registry)
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", True)
    if f.envelope is None:
        return reader.schema(f.item).json(path)
    whole = reader.schema(T.StructType().add(f.envelope, _list_of(f.item))).json(path)
    return whole.select(F.inline(f.envelope))


def parse_jobs(
    payloads: DataFrame, name: str, value: str = "value", registry: Mapping[str, Feed] = FEEDS
) -> DataFrame:
    """Jobs of feed answers that are already a column of JSON texts."""
    f = feed(name, registry)
    items = _list_of(f.item)
    if f.envelope is None:
        return payloads.select(F.inline(F.from_json(value, items)))
    answer = F.from_json(value, T.StructType().add(f.envelope, items))
    return payloads.select(F.inline(answer[f.envelope]))


def _list_of(ddl: str) -> T.ArrayType:
    return T.ArrayType(T.StructType.fromDDL(ddl))


def ads_of(
    jobs: DataFrame, name: str, search: Search, registry: Mapping[str, Feed] = FEEDS
) -> DataFrame:
    """Wanted ads of one feed in ad shape."""
    f = feed(name, registry)
    return f.wanted(f.mapped(jobs), search)


def union_feeds(
    frames: Mapping[str, DataFrame], registry: Mapping[str, Feed] = FEEDS
) -> DataFrame:
    """All feeds in order of priority; ``prio`` says which copy of a job is preferred."""
    order = priorities(registry)
    parts = [frames[n].withColumn("prio", F.lit(order[n])) for n in sorted(frames, key=order.get)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def priorities(registry: Mapping[str, Feed]) -> dict[str, int]:
    """The known feeds in their fixed order, then what else is registered, in that order."""
    added = [n for n in registry if n not in fixed.FEED_ORDER]
    return {name: i for i, name in enumerate([*fixed.FEED_ORDER, *added])}


def collect(
    spark: SparkSession,
    paths: Mapping[str, str | list[str]],
    search: Search,
    registry: Mapping[str, Feed] = FEEDS,
) -> DataFrame | None:
    """Read several feeds; one whose files are not there is skipped, the others go on.

    Frames are lazy: a file that turns out to be unreadable while the job runs ends the job.
    """
    for name in paths:
        feed(name, registry)
    frames = {}
    for name, path in paths.items():
        try:
            frames[name] = ads_of(
                read_jobs(spark, name, path, registry), name, search, registry
            )
        except PySparkException as problem:
            log.warning("feed %s skipped: %s", name, problem)
    return union_feeds(frames, registry) if frames else None


def checked_names(
    names: Iterable[str] | None, registry: Mapping[str, Feed] = FEEDS
) -> tuple[str, ...]:
    """Names from a parameter, the default if blank; an unknown one raises."""
    chosen = tuple(n.strip().lower() for n in names or () if n.strip()) or fixed.DEFAULT_FEEDS
    for name in chosen:
        feed(name, registry)
    return chosen
