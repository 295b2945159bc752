import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from stellwerk import schema
from stellwerk.functions.defaults import SKILLS
from stellwerk.functions.fingerprint import ad_fingerprint, claim_key
from stellwerk.functions.score import Profile
from stellwerk.operators.batches import count_or_idle
from stellwerk.sources.messages import consume, decode
from stellwerk.streaming import digests, intake

BEGIN = dt.datetime(2026, 1, 1)


def message(n, ref, title="Analyst", employer="Muster GmbH", place="Kiel", at=None, **more):
    ad = {"stellenangebotsTitel": title, "firma": employer,
          "stellenlokationen": [{"adresse": {"plz": "", "ort": place}}], **more}
    return (ref, json.dumps(ad), 0, n, at or BEGIN + dt.timedelta(minutes=n))


def write(spark, rows, path):
    spark.createDataFrame(rows, schema.MESSAGE).coalesce(1).write.mode("append").parquet(str(path))


def outcomes(spark, folders):
    rows = spark.read.parquet(folders.table("outcomes")).collect()
    return {r.seq: r.outcome for r in rows}


def run(spark, path, folders, rules=intake.Rules(), detail=None):
    stream = consume(spark, str(path), max_files=1)
    query = intake.start(stream, folders, rules, detail, available_now=True)
    assert query.awaitTermination(300)


def test_four_outcomes_over_several_batches(spark, tmp_path):
    folders = intake.Folders(str(tmp_path / "state"), buckets=2)
    topic = tmp_path / "topic"
    write(spark, [message(1, "a"), message(2, "b", title="Senior Analyst"), message(3, "a")], topic)
    run(spark, topic, folders)
    write(spark, [
        message(4, "x:1", employer="Muster AG"),  # the content of "a"
        message(5, "b"),
        message(6, "x:2", title="Senior Analyst (m/w/d)"),  # claimed by the excluded "b"
        message(7, "c", employer="NTT DATA SE"),
        message(8, "d", employer=None),
        message(9, "e", employer=""),
        message(10, None),
    ], topic)
    run(spark, topic, folders)
    assert outcomes(spark, folders) == {
        1: "weitergereicht", 2: "aussortiert", 3: "bekannt", 4: "doppelt", 5: "bekannt", 6: "doppelt",
        7: "aussortiert", 8: "weitergereicht", 9: "weitergereicht",
    }
    counts = {r.outcome: r.ads for r in intake.outcome_counts(spark, folders).collect()}
    assert counts == {"weitergereicht": 3, "aussortiert": 2, "bekannt": 2, "doppelt": 2}
    # Archived before any filter, under the day of arrival, once per reference and day.
    raw = [r.referenznummer for r in spark.read.parquet(folders.table("raw")).collect()]
    assert sorted(raw) == ["a", "b", "c", "d", "e", "x:1", "x:2"]
    claims = spark.read.parquet(folders.table("claims")).collect()
    assert {c.zuerst_gesehen_als for c in claims} == {"a", "b", "c"}


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    rows = [
        message(n, f"r{rng.randrange(12)}", title=rng.choice(["Analyst", "Senior X", "Dev", "QA"]),
                employer=rng.choice(["M GmbH", "N AG", "", None]), place=rng.choice(["Kiel", "Ulm"]))
        for n in range(40)
    ]
    topic, folders = tmp_path / "topic", intake.Folders(str(tmp_path / "state"), buckets=2)
    for start in range(0, 40, 14):
        write(spark, rows[start:start + 14], topic)
        run(spark, topic, folders)
    whole = decode(spark.createDataFrame(rows, schema.MESSAGE)).withColumn("referenznummer", F.col("key"))
    whole = whole.withColumn("seq", F.col("offset")).withColumn("fp", claim_key(ad_fingerprint()))
    batch = {r.seq: r.outcome for r in intake.judged(whole, intake.Rules(), None, None).collect()}
    assert outcomes(spark, folders) == batch


def test_a_batch_can_run_again(spark, tmp_path):
    folders = intake.Folders(str(tmp_path / "state"), buckets=2)
    rows = spark.createDataFrame([message(1, "a"), message(2, "b", title="Dev")], schema.MESSAGE)
    for _ in range(2):
        intake.process(rows, 0, folders, intake.Rules())
    assert outcomes(spark, folders) == {1: "weitergereicht", 2: "weitergereicht"}
    assert spark.read.parquet(folders.table("matched")).count() == 2
    assert spark.read.parquet(folders.table("seen")).count() == 2


def test_claims_expire_unless_decided(spark, tmp_path):
    folders = intake.Folders(str(tmp_path / "state"), buckets=2)
    frame = lambda *m: spark.createDataFrame(list(m), schema.MESSAGE)
    intake.process(frame(message(1, "a")), 0, folders, intake.Rules(keep_days=10))
    later = BEGIN + dt.timedelta(days=20)
    intake.process(frame(message(2, "a", at=later)), 1, folders, intake.Rules(keep_days=10))
    soon = later + dt.timedelta(days=5)
    intake.process(frame(message(3, "a", at=soon)), 2, folders, intake.Rules(keep_days=10))
    assert outcomes(spark, folders) == {1: "weitergereicht", 2: "weitergereicht", 3: "bekannt"}


def test_broken_messages_are_put_aside(spark, tmp_path):
    folders = intake.Folders(str(tmp_path / "state"), buckets=2)
    bad = ("z", "{nicht json", 0, 2, BEGIN)
    intake.process(spark.createDataFrame([message(1, "a"), bad], schema.MESSAGE), 0, folders, intake.Rules())
    assert outcomes(spark, folders) == {1: "weitergereicht"}
    assert [r.body for r in spark.read.parquet(folders.table("broken")).collect()] == ["{nicht json"]


def test_enrichment_uses_the_detail_only_where_needed(spark, tmp_path):
    folders = intake.Folders(str(tmp_path / "state"), buckets=2)
    rules = intake.Rules(profile=Profile({"Java": 3, "SQL": 1}), catalog=SKILLS)
    rows = spark.createDataFrame([
        message(1, "a", datumErsteVeroeffentlichung="2025-12-30", entfernung=8.25),
        message(2, "b", title="Dev", stellenangebotsBeschreibung="Java, Kafka, Docker"),
        message(3, "c", title="QA"),
    ], schema.MESSAGE)
    detail = spark.createDataFrame(
        [("a", "Java, SQL, Kafka, Docker"), ("b", "nicht lesen: SQL")],
        "referenznummer STRING, stellenangebotsBeschreibung STRING",
    ).withColumn("stellenbeschreibung", F.lit(None).cast("string"))
    intake.process(rows, 0, folders, rules, detail)
    found = {r.referenznummer: r.enrichment for r in spark.read.parquet(folders.table("matched")).collect()}
    assert (found["a"].alter_tage, found["a"].entfernung_km) == (2, pytest.approx(8.2, abs=0.11))
    assert (found["a"].treffer, found["a"].luecken, found["a"].schwerpunkte) == (["SQL", "Java"], ["Docker", "Kafka"], ["Java"])
    assert found["b"].luecken == ["Docker", "Kafka"]
    assert (found["c"].stufe[0], found["c"].punkte) == ("D", None)


def digest_rows(rng, n):
    t, rows = BEGIN, []
    for seq in range(n):
        t += dt.timedelta(seconds=rng.choice([1, 2, 30, 61]))
        rows.append((rng.choice("aab"), t, seq))
    return rows


def test_digest_stream_equals_batch(spark, tmp_path):
    ddl = "k STRING, ts TIMESTAMP, seq LONG"
    rows = digest_rows(random.Random(1), 60)
    folders = digests.Folders(str(tmp_path / "state"))
    keys = {"key": "k", "ts": "ts", "seq": "seq"}
    for start in range(0, 60, 20):
        spark.createDataFrame(rows[start:start + 20], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        query = digests.start(source, folders, max_rows=5, available_now=True, **keys)
        assert query.awaitTermination(300)
    frame = spark.createDataFrame(rows, ddl)
    sent = spark.read.parquet(folders.table("digests")).select("k", "seq", "batch", "batch_id")
    rest = digests.flush(spark, folders, frame, max_rows=5, **keys).select("k", "seq", "batch")
    groups = {}
    for r in sent.collect():
        groups.setdefault((r.k, r.batch_id, r.batch), set()).add(r.seq)
    for r in rest.collect():
        groups.setdefault((r.k, "rest", r.batch), set()).add(r.seq)
    expected = {}
    for r in count_or_idle(frame, "k", "ts", "seq", max_rows=5).collect():
        expected.setdefault((r.k, r.batch), set()).add(r.seq)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_open_rows_stay_open_until_idle(spark, tmp_path):
    ddl = "k STRING, ts TIMESTAMP, seq LONG"
    folders = digests.Folders(str(tmp_path / "state"))
    frame = spark.createDataFrame([("a", BEGIN, 1), ("a", BEGIN, 2)], ddl)
    now = lambda s: F.lit(BEGIN + dt.timedelta(seconds=s))
    digests.process(frame, 0, folders, "k", "ts", "seq", now(30))
    assert spark.read.parquet(folders.table("digests")).count() == 0
    digests.process(frame.limit(0), 1, folders, "k", "ts", "seq", now(60))
    assert spark.read.parquet(folders.table("digests")).count() == 2
    assert digests.flush(spark, folders, frame, "k", "ts", "seq").count() == 0


def test_idle_batch_closes_without_new_rows(spark, tmp_path):
    ddl = "k STRING, ts TIMESTAMP, seq LONG"
    folders = digests.Folders(str(tmp_path / "state"))
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    # A little in the future, so that the row is still open when it is first seen.
    row = spark.createDataFrame([("a", now + dt.timedelta(seconds=15), 1)], ddl)
    row.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
    query = digests.start(source, folders, "k", "ts", "seq", idle_seconds=5, interval="2 seconds")
    try:
        first_seen = sent_in = None
        for _ in range(30):
            if query.exception() is not None:
                raise query.exception()
            done = intake.read_table(spark, folders.table("open"), ddl + ", batch_id LONG")
            sent = intake.read_table(spark, folders.table("digests"), ddl + ", batch_id LONG")
            first_seen = first_seen if first_seen is not None else done.agg(F.min("batch_id")).first()[0]
            sent_in = sent.agg(F.min("batch_id")).first()[0]
            if sent_in is not None:
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert first_seen is not None and sent_in > first_seen
    assert spark.read.parquet(folders.table("digests")).count() == 1
