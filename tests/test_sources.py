import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.defaults import SKILLS
from stellwerk.sources import feeds, messages, tables

TODAY = dt.date(2026, 8, 25)


def search(**changes):
    return feeds.Search(today=TODAY, **{"terms": ("Data Engineer", "Java"), "place": "Hamburg", **changes})


def landed(tmp_path, name, content):
    path = tmp_path / f"{name}.json"
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(path)


def ads(spark, tmp_path, name, content, **changes):
    jobs = feeds.read_jobs(spark, name, landed(tmp_path, name, content))
    return feeds.ads_of(jobs, name, search(**changes)).collect()


def test_agency_rows_keep_their_reference(spark, tmp_path):
    rows = ads(spark, tmp_path, "arbeitsagentur", {"ergebnisliste": [
        {"referenznummer": "10001-1-S", "stellenangebotsTitel": "X", "firma": "M",
         "stellenlokationen": [{"adresse": {"plz": "1", "ort": "Kiel"}, "entfernung": 3.5}]},
        {"stellenangebotsTitel": "ohne Nummer"},
    ]})
    assert [(r.referenznummer, r.quelle, r.stellenlokationen[0].entfernung) for r in rows] == [
        ("10001-1-S", "arbeitsagentur", 3.5)
    ]


def test_arbeitnow(spark, tmp_path):
    def job(**changes):
        return {"slug": "s1", "title": "Data Engineer", "company_name": " M GmbH ", "location": "20095 Hamburg",
                "description": "<p>Wir &amp; du</p>", "created_at": 1787616000, "url": "https://u.example",
                "remote": False, "tags": ["IT", " "], **changes}

    rows = ads(spark, tmp_path, "arbeitnow", {"data": [
        job(), job(slug="old", created_at=1700000000), job(slug="other", title="Vertrieb"),
        job(slug="far", location="Berlin"), job(slug="remote", location="Berlin", remote="True"),
        job(slug="", title="Data Engineer"), job(slug="nodate", created_at=None),
    ]})
    found = {r.referenznummer: r for r in rows}
    assert set(found) == {"arbeitnow:s1", "arbeitnow:remote", "arbeitnow:nodate"}
    first = found["arbeitnow:s1"]
    assert (first.firma, first.hauptberuf, first.alleBerufe) == ("M GmbH", "IT", ["IT"])
    assert first.datumErsteVeroeffentlichung == "2026-08-25"
    assert first.stellenangebotsBeschreibung == "Wir & du"
    assert tuple(first.stellenlokationen[0].adresse) == ("20095", "Hamburg")
    assert (first.homeofficeprozent, found["arbeitnow:remote"].homeofficeprozent) == (None, 100.0)


def test_adzuna_reads_nested_fields(spark, tmp_path):
    rows = ads(spark, tmp_path, "adzuna", {"results": [
        {"id": 7, "title": "Java Dev", "company": {"display_name": "M"}, "location": {"display_name": "Kiel, DE"},
         "category": {"label": "IT"}, "description": "x", "created": "2026-08-24T10:00:00Z", "redirect_url": "u"},
        {"id": 8, "title": "JavaScript Dev", "created": "2026-08-24T10:00:00Z"},
    ]})
    assert [(r.referenznummer, r.firma, r.hauptberuf, r.datumErsteVeroeffentlichung) for r in rows] == [
        ("adzuna:7", "M", "IT", "2026-08-24")
    ]


def test_remotive_filters_by_region_only(spark, tmp_path):
    def job(i, region):
        return {"id": i, "title": "Anything", "candidate_required_location": region,
                "publication_date": "2026-08-24T10:00:00", "tags": []}

    rows = ads(spark, tmp_path, "remotive", {"jobs": [job(1, "Europe"), job(2, "USA"), job(3, "")]})
    assert {r.referenznummer for r in rows} == {"remotive:1", "remotive:3"}
    assert {r.homeofficeprozent for r in rows} == {100.0}


def test_remoteok_skips_the_notice(spark, tmp_path):
    rows = ads(spark, tmp_path, "remoteok", [
        {"legal": "notice"},
        {"slug": "s", "position": "Java Dev", "company": "M", "date": "", "epoch": 1787616000, "apply_url": "a"},
        {"id": 5, "position": "Java Dev", "date": "2026-08-20T00:00:00+00:00", "url": "u"},
    ])
    assert sorted((r.referenznummer, r.datumErsteVeroeffentlichung, r.externeURL) for r in rows) == [
        ("remoteok:5", "2026-08-20", "u"), ("remoteok:s", "2026-08-25", "a"),
    ]


def test_jobicy_falls_back_to_the_excerpt(spark, tmp_path):
    rows = ads(spark, tmp_path, "jobicy", {"jobs": [
        {"id": 1, "jobTitle": "Java Dev", "companyName": "M", "jobGeo": "Germany", "jobDescription": "",
         "jobExcerpt": "kurz", "pubDate": "Mon, 24 Aug 2026 10:00:00 +0000", "jobIndustry": ["IT"]},
    ]})
    assert [(r.stellenangebotsBeschreibung, r.datumErsteVeroeffentlichung, r.hauptberuf) for r in rows] == [
        ("kurz", "2026-08-24", "IT")
    ]


def test_union_keeps_priority_and_skips_a_broken_feed(spark, tmp_path):
    paths = {
        "jobicy": landed(tmp_path, "jobicy", {"jobs": [{"id": 1, "jobTitle": "Java Dev"}]}),
        "adzuna": landed(tmp_path, "adzuna", "{ not json"),
        "remotive": str(tmp_path / "missing.json"),
        "arbeitsagentur": landed(tmp_path, "arbeitsagentur", {"ergebnisliste": [
            {"referenznummer": "1-S", "stellenangebotsTitel": "x"}]}),
    }
    rows = feeds.collect(spark, paths, search()).orderBy("prio").collect()
    assert [(r.prio, r.referenznummer) for r in rows] == [(0, "1-S"), (5, "jobicy:1")]


def test_nationwide_agency_pass_keeps_remote_jobs_only(spark):
    found = spark.createDataFrame(
        [("a", True, None), ("b", False, 100.0), ("c", False, 40.0)],
        "referenznummer STRING, ortsgebunden BOOLEAN, homeofficeprozent DOUBLE",
    )
    def kept(**changes):
        return {r.referenznummer for r in feeds.ads_of(found, "arbeitsagentur", search(**changes)).collect()}

    assert kept() == {"a", "b"}
    assert kept(remote_percent=40) == {"a", "b", "c"}
    assert kept(remote_anywhere=False) == {"a"}


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        feeds.feed("monster")
    with pytest.raises(ValueError):
        search(max_age_days=5)
    with pytest.raises(ValueError):
        search(terms=())
    assert feeds.checked_names([" Jobicy ", ""]) == ("jobicy",)
    assert feeds.checked_names(None) == fixed.DEFAULT_FEEDS
    with pytest.raises(ValueError):
        feeds.checked_names(["monster"])
    assert search().catalog is SKILLS


# --- tables --------------------------------------------------------------------


def archive_rows(spark):
    return spark.createDataFrame(
        [(1, dt.date(2026, 7, 31), "a", "alt"), (2, dt.date(2026, 7, 31), "a", "neu"),
         (3, dt.date(2026, 8, 1), "a", "spaeter"), (4, dt.date(2025, 12, 31), "b/1", "b")],
        "seq LONG, tag DATE, referenznummer STRING, stellenangebotsTitel STRING",
    )


def test_archive_is_pruned_before_files_open(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.write_archive(archive_rows(spark), path)
    (tmp_path / "raw" / "jahr=2026" / "monat=08" / "tag=01").exists()
    everything = tables.read_archive(spark, path)
    assert sorted((r.tag, r.stellenangebotsTitel) for r in everything.collect()) == [
        (dt.date(2025, 12, 31), "b"), (dt.date(2026, 7, 31), "neu"), (dt.date(2026, 8, 1), "spaeter"),
    ]
    recent = tables.read_archive(spark, path, dt.date(2026, 8, 1))
    assert [r.stellenangebotsTitel for r in recent.collect()] == ["spaeter"]
    assert len(recent.inputFiles()) >= 1
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(jahr" in plan
    # The same reference and day again replaces only that ad.
    again = archive_rows(spark).filter("seq = 3").withColumn("stellenangebotsTitel", F.lit("ersetzt"))
    tables.write_archive(again, path)
    assert sorted(r.stellenangebotsTitel for r in tables.read_archive(spark, path).collect()) == ["b", "ersetzt", "neu"]


def test_archive_keeps_the_other_ads_of_a_day(spark, tmp_path):
    path, ddl = str(tmp_path / "raw"), "seq LONG, tag DATE, referenznummer STRING, stellenangebotsTitel STRING"
    day = dt.date(2026, 7, 31)
    tables.write_archive(spark.createDataFrame([(1, day, "a", "x"), (2, day, "b", "y")], ddl), path)
    tables.write_archive(spark.createDataFrame([(3, day, "c", "z"), (4, day, "b", "neu")], ddl), path)
    rows = tables.read_archive(spark, path).collect()
    assert sorted((r.referenznummer, r.stellenangebotsTitel) for r in rows) == [("a", "x"), ("b", "neu"), ("c", "z")]


def test_malformed_partition_is_read_only_without_a_period(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.write_archive(archive_rows(spark), path)
    odd = archive_rows(spark).limit(1).drop("seq", "tag")
    odd.write.parquet(f"{path}/jahr=2026/monat=99/tag=xx")
    assert tables.read_archive(spark, path).filter("tag is null").count() == 1
    assert tables.read_archive(spark, path, dt.date(2026, 1, 1)).filter("tag is null").count() == 0


def test_corpus_details_and_salaries(spark, tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    (folder / "lebenslauf.md").write_text("Java " * 60)
    (folder / "kurz.txt").write_text("Java")
    (folder / "bild.png").write_text("Java " * 60)
    readable, silent = tables.read_corpus(spark, str(folder))
    assert [r.path for r in readable.collect()] == ["lebenslauf.md"]
    assert [r.path for r in silent.collect()] == ["kurz.txt"]

    detail = landed(tmp_path, "detail", '{"referenznummer": "a", "verguetung": "gut", "kontakt": {"name": "Eva"}}\n')
    row = tables.read_details(spark, detail).first()
    assert (row.referenznummer, row.verguetung, row.kontakt.name) == ("a", "gut", "Eva")

    pay = landed(tmp_path, "pay", [{"kldb": "43413", "region": {"id": 5, "bezeichnung": "HH"}, "entgelt": 5000}])
    row = tables.read_salaries(spark, pay).first()
    assert (row.kldb, row.region.id, row.entgelt, row.pos) == ("43413", 5, 5000, 0)


# --- messages ------------------------------------------------------------------


def test_publish_counts_and_skips_rows_without_reference(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("", "y"), (None, "z"), ("b", "w")],
                                 "referenznummer STRING, stellenangebotsTitel STRING")
    path = str(tmp_path / "topic")
    assert messages.publish(rows, path) == {"published": 2, "skipped": 2}
    back = spark.read.parquet(path)
    assert {(r.key, json.loads(r.value)["stellenangebotsTitel"]) for r in back.collect()} == {("a", "x"), ("b", "w")}


def test_decode_reads_both_url_spellings_and_marks_broken_bodies(spark):
    bodies = ['{"stellenangebotsTitel": "t", "externeURL": "new"}', '{"externeUrl": "old"}', "kein json", None]
    frame = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "key STRING, value STRING")
    rows = messages.decode(frame).orderBy("key").collect()
    assert [r.externeURL for r in rows] == ["new", "old", None, None]
    assert [r.broken for r in rows] == [False, False, True, True]
    assert rows[0].stellenangebotsTitel == "t"
