"""Catalog tables, daily partials, landed files, topics between streams, keyed state."""

import datetime as dt
import json
import os
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stellwerk import fixed, schema
from stellwerk.functions.catalog import Catalog, labels_in
from stellwerk.functions.defaults import SKILLS
from stellwerk.operators import catalogs, trend
from stellwerk.sources import messages, tables
from stellwerk.streaming import claims, digests, intake

# --- catalog tables --------------------------------------------------------------


@pytest.mark.parametrize(
    "pattern, found",
    [
        (r"\bjava\b", [("java", True, True)]),
        (r"\bagil", [("agil", True, False)]),
        (r"code[- ]?review\w*", [("code", False, False), ("review", False, False)]),
        (r"\bdata[- ]warehouse", [("data", True, True), ("warehouse", True, False)]),
        (r"(?-i:\bGo\b)(?!\W*live)", [("go", True, True)]),
        (r"\bc\+\+", [("c", True, True)]),
        (r"unit-tests?", [("unit", False, True), ("test", True, False)]),
        (r"ab+c(?:x|y)?d", [("ab", False, False), ("c", False, False), ("d", False, False)]),
        (r"\b(?:machine) learning\b", [("machine", True, True), ("learning", True, True)]),
        (r"[3-9]\d (?:tage )?urlaub", [("urlaub", False, False)]),
        (r"x{2,}yz", [("yz", False, False)]),
    ],
)
def test_literals_of_patterns(pattern, found):
    assert catalogs.literals(pattern) == found


def test_every_match_of_a_default_pattern_holds_a_literal_of_it():
    for entry in SKILLS:
        for part in catalogs.alternatives(entry.pattern):
            assert catalogs.literals(part), entry.pattern
    assert catalogs.alternatives(r"a|b(c|d)|[|]\||e") == ["a", "b(c|d)", r"[|]\|", "e"]


def test_labels_by_table_equal_the_static_form(spark):
    words = [w for e in SKILLS for w in re.findall(r"[A-Za-z+#.]{2,}", e.pattern.replace("\\b", " ")) if "?" not in w]
    draw = random.Random(3)
    texts = [(i, " ".join(draw.choice([*words, "und", "mit", "Go", "go", "go live", "C++", ".NET", "unit tests", "data lake", "R und Python"]) for _ in range(draw.randint(0, 25)))) for i in range(120)]
    texts += [(500, None), (501, "")]
    frame = spark.createDataFrame(texts, "id LONG, text STRING")
    want = {r.id: r.labels for r in frame.select("id", labels_in(F.col("text"), SKILLS).alias("labels")).collect()}
    got = {r.id: r.labels for r in catalogs.labels_by_table(frame, SKILLS.to_table(spark), "id", "text").collect()}
    assert got == want and sum(map(len, want.values())) > 200


def test_a_catalog_of_ten_thousand_rows(spark):
    """No part of it is in the plan, and no text meets all patterns."""
    draw = random.Random(4)
    stems = sorted({"".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(9000)})
    rules = [(i, "c", f"L{i}", [rf"\b{w}\b", rf"\b{w[:5]}", w[1:], rf"\b{w[:4]}\w*{w[5]}\b|\bzz{w}\b"][i % 4]) for i, w in enumerate(stems)]
    rules += [(len(rules) + i, "c", f"M{i}", rf"\bzzz{i}\b") for i in range(10_000 - len(rules))]
    texts = [(i, " ".join(draw.choice(stems) for _ in range(30))) for i in range(40)]
    catalog = spark.createDataFrame(rules, schema.CATALOG)
    out = catalogs.labels_by_table(spark.createDataFrame(texts, "id LONG, text STRING"), catalog, "id", "text")
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and len(plan) < 200_000
    compiled = [(label, re.compile(pattern)) for _, _, label, pattern in rules]
    assert {r.id: r.labels for r in out.collect()} == {i: [label for label, p in compiled if p.search(t)] for i, t in texts}


def test_rules_that_are_a_literal_move_no_text(spark):
    """The word that calls for such a rule settles it; the rest runs its expression."""
    rules = [r"\bjava\b", r"\bdata", "cloud", r"ing\b", r"\bgo\b|\brust", r"\bunit\s*tests?\b"]
    texts = [
        "Java and Databases", "javascript, metadata", "McCloudy", "testing Ring", "ringed golang", "Rusty go", "unit  test",
        "units test", "e\u0301data, da\u0301ta", "x\u203fdata testing\u0301", "\u0130data", "data\u0301base", "\u24d0data", None, "",
    ]
    catalog = Catalog.of([("c", f"L{i}", p) for i, p in enumerate(rules)])
    frame = spark.createDataFrame(list(enumerate(texts)), "id LONG, text STRING")
    want = {r.id: r.labels for r in frame.select("id", labels_in(F.col("text"), catalog).alias("labels")).collect()}
    out = catalogs.labels_by_table(frame, catalog.to_table(spark), "id", "text")
    assert {r.id: r.labels for r in out.collect()} == want and sum(map(len, want.values())) == 7
    literal = Catalog.of([("c", f"L{i}", p) for i, p in enumerate(rules[:5])]).to_table(spark)
    plan = catalogs.labels_by_table(frame.limit(8), literal, "id", "text")._jdf.queryExecution().toString()
    assert "RLIKE" not in plan.upper()


def test_patterns_without_a_literal_are_refused(spark):
    frame = spark.createDataFrame([(1, "a b")], "id LONG, text STRING")
    with pytest.raises(ValueError, match="no literal"):
        catalogs.labels_by_table(frame, Catalog.of([("c", "digits", r"\d+")]).to_table(spark), "id", "text")


# --- daily partials --------------------------------------------------------------


def test_partials_equal_a_full_run_after_every_change(spark, tmp_path):
    draw = random.Random(1)
    day = lambda: dt.date(2026, draw.choice([1, 2]), draw.randint(1, 9))
    rows = [(i, day(), draw.sample(["a", "b", "c"], draw.randint(0, 3)) * draw.randint(1, 2)) for i in range(60)]
    path = str(tmp_path / "partials")
    have: dict[int, tuple] = {}
    for step, part in enumerate((rows[:30], rows[30:], [])):
        gone = [r for r in have.values() if r[0] % 4 == 1] if step == 2 else []
        have = {r[0]: r for r in [*have.values(), *part] if r not in gone}
        ads = spark.createDataFrame(list(have.values()), "id INT, tag DATE, labels ARRAY<STRING>")
        changed = spark.createDataFrame([(r[1],) for r in [*part, *gone]], "tag DATE")
        trend.refresh(ads, changed, path)
        partials = trend.read_partials(spark, path)
        key = lambda r: str(r)
        assert sorted(trend.demand_of(partials).collect(), key=key) == sorted(trend.with_share(trend.demand(ads), ads).collect(), key=key)
        assert sorted(trend.monthly_of(partials).collect(), key=key) == sorted(trend.monthly(ads).collect(), key=key)
        late = dt.date(2026, 2, 1)
        since = trend.read_partials(spark, path, late)
        assert sorted(trend.demand_of(since).collect(), key=key) == sorted(trend.with_share(trend.demand(ads.filter(F.col("tag") >= late)), ads.filter(F.col("tag") >= late)).collect(), key=key)
    assert "PartitionFilters: [isnotnull(tag" in since._jdf.queryExecution().toString()


# --- landed files ----------------------------------------------------------------


def test_broken_lines_are_counted_per_file(spark, tmp_path):
    lines = {"a.json": ['{"referenznummer": "1"}', '{"referenznummer": ', '{"referenznummer": ""}'], "b.json": ["no json", "{}"], "c.json": ['{"referenznummer": "3", "verguetung": "x"}']}
    for name, content in lines.items():
        (tmp_path / name).write_text("\n".join(content) + "\n")
    rows = tables.landed(spark, str(tmp_path), schema.DETAIL)
    counts = {os.path.basename(r.file): (r.lines, r.rejected, r.without_ref) for r in tables.rejects(rows).collect()}
    assert counts == {"a.json": (3, 1, 1), "b.json": (2, 1, 1), "c.json": (1, 0, 0)}
    good = tables.accepted(rows)
    assert sorted(r.referenznummer or "" for r in good.collect()) == ["", "", "1", "3"] and "broken" not in good.columns


def test_archive_reads_only_the_days_asked_for(spark, tmp_path):
    ad = lambda n, ref, day, title: (n, ref, day, title)
    ddl = "seq LONG, referenznummer STRING, tag DATE, stellenangebotsTitel STRING"
    d = lambda n: dt.date(2026, 1, n)
    path = str(tmp_path / "archive")
    tables.write_archive(spark.createDataFrame([ad(1, "a", d(1), "old"), ad(2, "b/1", d(1), "b"), ad(3, "a", d(2), "x"), ad(4, "a", d(2), "y")], ddl), path)
    tables.write_archive(spark.createDataFrame([ad(5, "a", d(1), "new"), ad(6, "c", d(3), "c")], ddl), path)
    rows = tables.read_archive(spark, path)
    assert sorted((r.referenznummer, r.tag.day, r.stellenangebotsTitel) for r in rows.collect()) == [("a", 1, "new"), ("a", 2, "y"), ("b/1", 1, "b"), ("c", 3, "c")]
    late = tables.read_archive(spark, path, d(2))
    assert late.count() == 2 and "PartitionFilters: [" in late._jdf.queryExecution().toString()
    assert "PartitionFilters: []" not in late._jdf.queryExecution().toString()


# --- streams ---------------------------------------------------------------------

DAY = 86_400_000_000


def land(spark, rows, path):
    spark.createDataFrame(rows, claims.MESSAGE).coalesce(1).write.mode("append").parquet(str(path))


def judge(spark, folder, keep_days=5):
    claims.with_store(spark)
    stream = spark.readStream.schema(claims.MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    sink = claims.outcomes(stream, keep_days * 86400).writeStream.format("parquet").option("path", f"{folder}/out")
    query = sink.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    assert query.awaitTermination(200)
    rows = spark.read.schema(claims.OUTCOME).parquet(f"{folder}/out").collect()
    assert len(rows) == len({r.seq for r in rows})
    return {r.seq: r.outcome for r in rows}


def test_claims_end_unless_something_was_decided(spark, tmp_path):
    land(spark, [("a", None, 1, 0, "f1", False), ("b", None, 2, 1, "f1", False), ("c", None, 3, 2, None, True)], tmp_path / "in")
    land(spark, [("a", None, 4, DAY, "f1", False), ("b", "BEWORBEN", 5, DAY, None, False), ("d", None, 6, 2 * DAY, "f1", False)], tmp_path / "in")
    first = judge(spark, tmp_path)
    assert first == {1: "weitergereicht", 2: "doppelt", 3: "aussortiert", 4: "bekannt", 6: "doppelt"}
    # The last batch again, as after a crash before its commit: nothing is judged or written twice.
    commits = tmp_path / "checkpoint" / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for name in (last, commits / f".{last.name}.crc"):
        if name.exists():
            name.unlink()
    # "a" has ended and is new again, "b" was decided upon and stays known; its content has ended.
    land(spark, [("a", None, 7, 6 * DAY, "f1", False), ("b", None, 8, 6 * DAY, "f2", False), ("e", None, 9, 6 * DAY + 1, "f1", False)], tmp_path / "in")
    assert judge(spark, tmp_path) == first | {7: "weitergereicht", 8: "bekannt", 9: "doppelt"}


def test_forwarded_ads_reach_the_digest_by_the_topic(spark, tmp_path):
    def message(n, ref, employer):
        ad = {"stellenangebotsTitel": "Analyst", "firma": employer, "stellenlokationen": [{"adresse": {"plz": "", "ort": "Kiel"}}], "entfernung": 7.0}
        return (ref, json.dumps(ad), 0, n, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=n))

    folders = intake.Folders(str(tmp_path / "state"), buckets=2)
    topic_in = str(tmp_path / "in")
    for rows in ([message(1, "a", "M AG"), message(2, "a", "M AG")], [message(3, "b", "N AG"), message(4, "c", "NTT DATA SE"), message(5, "d", "O AG")]):
        spark.createDataFrame(rows, schema.MESSAGE).coalesce(1).write.mode("append").parquet(topic_in)
        query = intake.start(messages.consume(spark, topic_in, max_files=1), folders, intake.Rules(), available_now=True)
        assert query.awaitTermination(200)
    topic = spark.read.schema(schema.MESSAGE).parquet(folders.table(messages.MATCHED_TOPIC))
    found = {r.key: (json.loads(r.value)["enrichment"]["entfernung_km"], r.offset) for r in topic.collect()}
    assert found == {"a": (7.0, 1), "b": (7.0, 3), "d": (7.0, 5)}
    arrived = messages.decode_matched(messages.consume(spark, folders.table(messages.MATCHED_TOPIC)))
    ads = arrived.select("seq", "ts", "firma", "enrichment").withColumn("who", F.lit("me"))
    to = digests.Folders(str(tmp_path / "digests"))
    query = digests.start(ads, to, "who", "ts", "seq", max_rows=2, idle_seconds=60, available_now=True)
    assert query.awaitTermination(200)
    sent = spark.read.parquet(to.table("digests")).collect()
    assert [(r.seq, r.enrichment.entfernung_km) for r in sorted(sent, key=lambda r: r.seq)] == [(1, 7.0), (3, 7.0)]


class Entries:
    """A map of a state store, in memory."""

    def __init__(self):
        self.held, self.asked = {}, 0

    def getValue(self, key):  # noqa: N802
        self.asked += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        self.held.pop(key, None)


class Handle:
    def getMapState(self, name, key, value, ttlDurationMs=None):  # noqa: N802, N803
        return Entries()


def test_one_call_decides_the_messages_of_many_references():
    rng, keep = random.Random(3), 1000
    columns = ["ref", "status", "seq", "us", "fp", "rejected"]
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, None, None, "BEWORBEN", fixed.FOUND]), i, 150 * i, None, False) for i in range(60)]
    expected, ends, decided = {}, {}, {}
    for ref, status, seq, us, _, _ in rows:
        active = decided.get(ref, False) or ends.get(ref, -1) > us
        if status is None:
            expected[seq] = not active
            if not active:
                ends[ref] = us + keep
        elif active:
            decided[ref] = status != fixed.FOUND
    judge = claims.References(keep, 1)
    judge.init(Handle())
    got = {}
    for part in (rows[:25], rows[25:]):
        shuffled = pd.DataFrame(rng.sample(part, len(part)), columns=columns)
        for out in judge.handleInputRows((0,), iter([shuffled[:10], shuffled[10:]]), None):
            got |= dict(zip(out["seq"], out["fresh"]))
    assert got == expected and len(set(got.values())) == 2
    assert judge.claims.asked == 8  # once for each reference and micro-batch


def test_one_call_decides_the_ads_of_many_contents():
    columns = ["seq", "ref", "us", "fp", "rejected", "fresh"]
    first = [(1, "a", 0, "x", False, True), (2, "b", 5, "y", True, True), (3, "c", 10, "x", False, True), (4, "a", 20, None, False, False), (5, "d", 20, None, False, True)]
    second = [(6, "e", 900, "y", False, True), (7, "f", 1000, "x", False, True), (8, "g", 1001, "x", False, True)]
    judge = claims.Contents(1000, 1)
    judge.init(Handle())
    got = {}
    for part in (first, second):
        for out in judge.handleInputRows((0,), iter([pd.DataFrame(part, columns=columns)]), None):
            got |= dict(zip(out["seq"], out["outcome"]))
    forwarded, again = fixed.FORWARDED, fixed.DUPLICATE
    assert got == {1: forwarded, 2: fixed.EXCLUDED, 3: again, 4: fixed.KNOWN, 5: forwarded, 6: again, 7: forwarded, 8: again}
    assert judge.claims.asked == 4
