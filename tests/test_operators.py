import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.catalog import Catalog
from stellwerk.functions.score import Profile, gaps_text, hits_text, score_band, with_rating
from stellwerk.operators import (
    archive,
    backtest,
    batches,
    dedup,
    details,
    entries,
    profile,
    salary,
    sizes,
    tracker,
    trend,
)

SKILLS = Catalog.of(
    (c, n, rf"\b{n.lower()}\b")
    for c, n in [("a", "Java"), ("a", "Python"), ("a", "SQL"), ("b", "Kafka"), ("b", "Spark"),
                 ("b", "Airflow"), ("c", "Docker"), ("c", "Linux")]
)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- repeats -------------------------------------------------------------------


def greedy(rows):
    refs, fps, kept = set(), set(), set()
    for seq, ref, fp in sorted(rows):
        if not ref or ref in refs or (fp is not None and fp in fps):
            continue
        refs.add(ref)
        fps.update([fp] if fp is not None else [])
        kept.add(seq)
    return kept


def sequential(rows, rejected, known_refs=(), known_fps=()):
    refs, fps, result = set(known_refs), set(known_fps), {}
    for seq, ref, fp in sorted(rows):
        if ref in refs:
            result[seq] = fixed.KNOWN
            continue
        refs.add(ref)
        if fp is not None and fp in fps:
            result[seq] = fixed.DUPLICATE
            continue
        fps.update([fp] if fp is not None else [])
        result[seq] = fixed.EXCLUDED if seq in rejected else fixed.FORWARDED
    return result


def random_rows(rng, n):
    """Few keys, one of each holding a third of the rows."""
    def key(prefix):
        return f"{prefix}0" if rng.random() < 0.33 else f"{prefix}{rng.randrange(12)}"

    return [(i, key("r"), key("f") if rng.random() < 0.8 else None) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_two_key_dedup_equals_the_sequential_rule(spark, seed):
    rows = random_rows(random.Random(seed), 60) + [(999, "", "f1")]
    frame = spark.createDataFrame(rows, "seq LONG, referenznummer STRING, fp STRING")
    assert {r.seq for r in dedup.two_key_dedup(frame).collect()} == greedy(rows)


def test_a_rejected_row_claims_nothing(spark):
    rows = [(1, "a", "x"), (2, "b", "x"), (3, "b", "y")]
    frame = spark.createDataFrame(rows, "seq LONG, referenznummer STRING, fp STRING")
    assert {r.seq for r in dedup.two_key_dedup(frame).collect()} == {1, 3}
    judged = dedup.outcomes(frame, F.lit(False))
    assert rows_of(judged, "seq", "outcome") == [(1, "weitergereicht"), (2, "doppelt"), (3, "bekannt")]


def test_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], "seq LONG, referenznummer STRING, fp STRING")
    assert dedup.two_key_dedup(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_outcomes_equal_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 60)
    rejected = {i for i in range(60) if rng.random() < 0.4}
    frame = spark.createDataFrame(rows, "seq LONG, referenznummer STRING, fp STRING")
    known = spark.createDataFrame([("r3",)], "referenznummer STRING")
    claimed = spark.createDataFrame([("f5",)], "fp STRING")
    judged = dedup.outcomes(frame, F.col("seq").isin(*rejected), known, claimed)
    found = {r.seq: r.outcome for r in judged.collect()}
    assert found == sequential(rows, rejected, {"r3"}, {"f5"})


def test_first_last_and_cross_source(spark):
    frame = spark.createDataFrame(
        [(1, "a", "p", "x"), (2, "a", "q", "x"), (3, "b", "p", "y"), (4, "c", "p", "x")],
        "seq LONG, referenznummer STRING, quelle STRING, fp STRING",
    )
    assert rows_of(dedup.first_per_key(frame, ["referenznummer"], "seq"), "seq") == [(1,), (3,), (4,)]
    assert rows_of(dedup.last_per_key(frame, ["referenznummer"], "seq"), "seq") == [(2,), (3,), (4,)]
    assert rows_of(dedup.cross_source_groups(frame), "fp", "ads", "sources", "first_seen_as") == [
        ("x", 3, 2, "a")
    ]


# --- archive -------------------------------------------------------------------


def day(n):
    return dt.date(2026, 8, n)


def test_archive_rules(spark):
    frame = spark.createDataFrame(
        [(1, "a", day(1), "old"), (2, "a", day(1), "new"), (3, "a", day(3), "later"), (4, "b", day(2), "b")],
        "seq LONG, referenznummer STRING, tag DATE, t STRING",
    )
    stored = archive.one_per_day(frame)
    assert rows_of(stored, "seq") == [(2,), (3,), (4,)]
    assert rows_of(archive.first_occurrences(stored), "t") == [("b",), ("new",)]
    # The period applies before the choice of the first occurrence.
    assert rows_of(archive.first_occurrences(stored, day(2)), "t") == [("b",), ("later",)]
    assert rows_of(archive.within_retention(stored, F.lit(dt.date(2027, 8, 3))), "t") == [("later",)]


def test_nearest_day_prefers_same_then_before_then_after(spark):
    stored = spark.createDataFrame(
        [("a", day(10), 1), ("a", day(9), 2), ("a", day(11), 3), ("b", day(9), 4), ("b", day(11), 5),
         ("c", day(11), 6), ("d", day(12), 7), ("e", day(10), 8)],
        "referenznummer STRING, tag DATE, n INT",
    )
    wanted = spark.createDataFrame(
        [(r, day(10)) for r in "abcd"] + [("e", None), ("f", day(10))],
        "referenznummer STRING, found_day DATE",
    )
    found = archive.nearest_day(wanted, stored)
    assert rows_of(found, "referenznummer", "n") == [
        ("a", 1), ("b", 4), ("c", 6), ("d", None), ("e", None), ("f", None),
    ]


def test_unexpired(spark):
    seen = spark.createDataFrame(
        [("a", "GEFUNDEN", 99), ("b", "GEFUNDEN", 101), ("c", "BEWORBEN", 1), ("d", None, 1), ("e", None, None)],
        "referenznummer STRING, status STRING, ablauf_zeitpunkt LONG",
    )
    assert rows_of(archive.unexpired(seen, F.lit(100)), "referenznummer") == [("b",), ("c",), ("e",)]


def test_details_are_inserted_once_even_if_empty(spark):
    layout = "referenznummer STRING, verguetung STRING"
    known = spark.createDataFrame([("a", "gut"), ("b", None)], layout)
    fetched = spark.createDataFrame([("a", "neu"), ("b", "neu"), ("c", None)], layout)
    full = details.add_details(known, fetched)
    assert rows_of(full, "referenznummer", "verguetung") == [("a", "gut"), ("b", None), ("c", None)]
    fresh = details.add_details(known, fetched, refresh=True)
    assert rows_of(fresh, "referenznummer", "verguetung") == [("a", "neu"), ("b", "neu"), ("c", None)]
    assert rows_of(details.withdrawn(full), "referenznummer") == [("b",), ("c",)]


def test_detail_join_only_where_needed(spark):
    ads = spark.createDataFrame(
        [("a", None, None, ""), ("b", None, "own text", ""), ("c", "adzuna", None, None), ("d", " ", None, None)],
        "referenznummer STRING, quelle STRING, stellenangebotsBeschreibung STRING, stellenbeschreibung STRING",
    )
    detail = spark.createDataFrame([(r, f"text {r}") for r in "abc"], "referenznummer STRING, stellenbeschreibung STRING")
    joined = details.with_detail(ads, detail, details.lacks_text())
    assert rows_of(joined, "referenznummer", "detail.stellenbeschreibung") == [
        ("a", "text a"), ("b", None), ("c", None), ("d", None),
    ]
    assert rows_of(details.missing_details(ads, detail), "referenznummer") == [("d",)]
    # In the stream every ad without text may have a detail, whatever its portal.
    everyone = details.with_detail(ads, detail, details.lacks_text(agency_only=False))
    assert ("c", "text c") in rows_of(everyone, "referenznummer", "detail.stellenbeschreibung")


# --- score and trend -----------------------------------------------------------


def rate(spark, title, text, prof):
    ads = spark.createDataFrame([(title, text)], "title STRING, text STRING")
    return with_rating(ads, F.col("title"), F.col("text"), prof, SKILLS).select("rating.*").first()


def test_score_is_damped_and_titles_weigh_three(spark):
    prof = Profile({"Java": 1, "Python": 1, "SQL": 1, "Kafka": 1})
    full = rate(spark, "Stelle", "Java Python SQL Kafka", prof)
    assert (full.punkte, full.stufe) == (44, fixed.GRADE_B)  # 100 * 4 / 9
    titled = rate(spark, "Java", "Python SQL Spark", prof)
    assert titled.punkte == round(100 * 5 / 11)
    assert (titled.treffer, titled.luecken) == (["Java", "Python", "SQL"], ["Spark"])
    wrong_title = rate(spark, "Spark", "Java Python SQL", prof)
    assert wrong_title.punkte == round(100 * 3 / 11)


def test_few_labels_give_grade_d(spark):
    thin = rate(spark, "Java", "Python", Profile({"Java": 1}))
    assert (thin.stufe, thin.punkte, thin.treffer, thin.luecken) == (fixed.GRADE_D, 0, ["Java"], [])


def test_half_scores_round_to_even(spark, over):
    column = F.bround(F.col("x"), 0).cast("int")
    assert over(column, [44.5, 45.5, 0.5], "x DOUBLE") == [44, 46, 0]


def test_profile_sets():
    prof = Profile({"Java": 3, "SQL": 1, "Linux": 9}, own=("Kafka",), excluded=("Linux",))
    assert prof.skills == ["Java", "Kafka", "SQL"]
    assert prof.focus == ["Java", "Kafka"]
    assert Profile({}, ("Jva",), ("SQL",)).unknown_labels(SKILLS) == ["Jva"]


def test_shown_labels(spark):
    row = spark.createDataFrame([([f"l{i}" for i in range(12)], ["Java", "SQL"])], "g ARRAY<STRING>, h ARRAY<STRING>")
    prof = Profile({"Java": 3})
    shown = row.select(gaps_text(F.col("g")), hits_text(F.col("h"), prof)).first()
    assert shown[0] == ", ".join(f"l{i}" for i in range(10)) + " (+2)"
    assert shown[1] == "Java*, SQL"


def test_score_bands(over):
    assert over(score_band(F.col("x")), [100, 70, 69, 55, 54, 35, 34, 0], "x INT") == [
        "70-100", "70-100", "55-69", "55-69", "35-54", "35-54", "0-34", "0-34",
    ]


def labelled(spark):
    return spark.createDataFrame(
        [(day(1), ["Java", "SQL"]), (day(2), ["Java", "Kafka"]), (dt.date(2026, 9, 1), ["Kafka"]),
         (dt.date(2026, 9, 2), [])],
        "tag DATE, labels ARRAY<STRING>",
    )


def test_trend_counts_ads(spark):
    ads, prof = labelled(spark), Profile({"Java": 1})
    assert rows_of(trend.demand(ads), "label", "ads") == [("Java", 2), ("Kafka", 2), ("SQL", 1)]
    assert rows_of(trend.gaps(ads, prof), "label", "ads") == [("Kafka", 2), ("SQL", 1)]
    assert rows_of(trend.covered(ads, prof), "label", "ads") == [("Java", 2)]
    shares = trend.with_share(trend.top(trend.gaps(ads, prof), 1), ads)
    assert rows_of(shares, "label", "share") == [("Kafka", 0.5)]
    # Ties go by label.
    assert [r.label for r in trend.top(trend.demand(ads), 2).collect()] == ["Java", "Kafka"]
    assert ("2026-09", "Kafka", 1) in rows_of(trend.monthly(ads), "month", "label", "ads")
    table = trend.history(ads, ["2026-08", "2026-09"], k=2)
    assert rows_of(table, "label", "`2026-08`", "`2026-09`") == [("Java", 2, 0), ("Kafka", 1, 1)]
    bars = {r.label: round(r.width) for r in trend.bars(ads, prof).collect()}
    assert bars == {"Java": 100, "Kafka": 100, "SQL": 50}
    none = ads.limit(0)
    assert trend.with_share(trend.demand(none), none).count() == 0


def test_trend_summary_and_unknown_terms(spark):
    ads = spark.createDataFrame(
        [(day(1), "Java", "Python SQL"), (day(5), "Nichts", "Besonderes COBOL COBOL"), (day(2), "x", None)],
        "tag DATE, title STRING, text STRING",
    )
    rated = with_rating(ads, F.col("title"), F.col("text"), Profile({"Java": 1}), SKILLS)
    s = trend.summary(rated).first()
    assert (s.ads, s.first_day, s.last_day, s.rated, s.meaningful) == (3, day(1), day(5), 1, False)
    terms = trend.unknown_terms(ads, F.col("text"), SKILLS)
    # SQL is a label, COBOL is counted once per ad.
    assert rows_of(terms, "term", "ads") == [("COBOL", 1)]
    assert trend.report_terms(terms).count() == 0


def test_backtest(spark):
    rated = spark.createDataFrame(
        [(80, "INTERVIEW"), (75, "ABSAGE"), (60, "BEWORBEN"), (0, "ABSAGE"), (90, "UNINTERESSANT"), (50, "GEFUNDEN")],
        "punkte INT, status STRING",
    )
    bands = backtest.outcome_by_band(rated)
    assert rows_of(bands, "band", "applied", "open", "quota") == [
        ("0-34", 1, 0, 0.0), ("55-69", 1, 1, None), ("70-100", 2, 0, 0.5),
    ]
    m = backtest.score_means(rated).first()
    assert (m.applied, m.discarded, m.answered, m.misleading, m.too_few) == (4, 1, 3, True, True)
    nothing = backtest.score_means(rated.limit(0)).first()
    assert (nothing.mean_applied, nothing.misleading) == (None, False)


def test_profile_from_a_corpus(spark):
    long = "Java " * 3 + "SQL " + "x" * 200
    corpus = spark.createDataFrame([("a.md", long), ("b.txt", "Java"), ("c.txt", " " * 300)], "path STRING, value STRING")
    assert rows_of(profile.silent_documents(corpus), "path") == [("b.txt",), ("c.txt",)]
    found = profile.corpus_mentions(corpus, SKILLS)
    assert rows_of(found, "label", "n") == [("Java", 3), ("SQL", 1)]
    kept = spark.createDataFrame([("Kafka", True, False), ("SQL", False, True), ("Falsch", True, False)],
                                 "label STRING, own BOOLEAN, excluded BOOLEAN")
    fresh = profile.refreshed(found, kept)
    assert rows_of(profile.skills(fresh), "label", "focus") == [("Falsch", True), ("Java", True), ("Kafka", True)]
    assert rows_of(profile.unknown_labels(fresh, SKILLS), "label") == [("Falsch",)]
    back = Profile.from_table(profile.as_profile_row(fresh, ["a.md"]))
    assert (back.counts, back.own, back.excluded) == ({"Java": 3, "SQL": 1}, ("Falsch", "Kafka"), ("SQL",))
    assert rows_of(profile.refreshed(found), "label", "own") == [("Java", False), ("SQL", False)]


def test_catalog_table_round_trip(spark):
    assert Catalog.from_table(SKILLS.to_table(spark)) == SKILLS


# --- numbering and batches -----------------------------------------------------


def test_numbering_is_dense_and_ordered(spark):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    numbered = sizes.number_rows(frame, [F.desc("x")], "nr")
    assert all(r.nr == 1000 - r.x for r in numbered.collect())


def naive_batches(rows, max_rows, idle):
    result = {}
    for key in {r[0] for r in rows}:
        batch, last, start = [], None, 1
        for n, (_, ts, seq) in enumerate(sorted(r for r in rows if r[0] == key), 1):
            if batch and ((ts - last).total_seconds() >= idle or len(batch) >= max_rows):
                batch = []
            if not batch:
                start = n
            batch.append(seq)
            last = ts
            result[seq] = (n, start)
    return result


@pytest.fixture
def many_parts(spark):
    """Small partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("draw", [10, 60, 100_000])
def test_batches_equal_the_sequential_rule(spark, many_parts, draw):
    rng = random.Random(draw)
    begin = dt.datetime(2026, 1, 1)
    rows, t = [], begin
    for seq in range(150):
        t += dt.timedelta(seconds=rng.choice([0, 1, 5, 59, 60, 61, 400]) if seq % 10 == 0 else rng.choice([0, 1, 2]))
        rows.append((rng.choice("aaab"), t, seq))
    frame = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, seq INT")
    cut = batches.count_or_idle(frame, "k", "ts", "seq", max_rows=7, idle_seconds=60)
    assert {r.seq: (r.row_no, r.batch) for r in cut.collect()} == naive_batches(rows, 7, 60)


def test_batches_of_one_recipient_are_spread(spark, many_parts, monkeypatch):
    """All rows under one key: every partition gets its share, and the carry is right."""
    rng = random.Random(2)
    rows, t = [(None, dt.datetime(2026, 1, 1), -1)], dt.datetime(2026, 1, 1)
    for seq in range(4000):
        t += dt.timedelta(seconds=rng.choice([0, 1, 30, 59, 61] if seq % 900 == 5 else [0, 1, 2]))
        rows.append(("one", t, seq))
    sizes = []
    scanned = batches._scanned

    def watched(*args):
        out = scanned(*args)
        sizes.extend(r["count"] for r in out.groupBy("_part").count().collect())
        return out

    monkeypatch.setattr(batches, "_scanned", watched)
    frame = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, seq INT")
    cut = batches.count_or_idle(frame, "k", "ts", "seq", max_rows=25, idle_seconds=60)
    assert {r.seq: (r.row_no, r.batch) for r in cut.collect()} == naive_batches(rows[1:], 25, 60) | {-1: (1, 1)}
    assert len(sizes) == 4 and max(sizes) < 2 * sorted(sizes)[2]
    assert batches.count_or_idle(frame.limit(0), "k", "ts", "seq").count() == 0


def test_gap_of_exactly_the_idle_time_closes(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [("a", t, 1), ("a", t + dt.timedelta(seconds=60), 2), ("a", t + dt.timedelta(seconds=119), 3)]
    frame = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, seq INT")
    cut = batches.count_or_idle(frame, "k", "ts", "seq")
    assert rows_of(cut, "seq", "batch") == [(1, 1), (2, 2), (3, 2)]
    state = batches.closed_batches(cut, "k", "ts", F.lit(t + dt.timedelta(seconds=120)))
    assert rows_of(state, "batch", "closed") == [(1, True), (2, False)]


def test_digest_summary_and_order(spark):
    rows = spark.createDataFrame(
        [("k", 1, 1, "Kiel", 50), ("k", 1, 2, "", None), ("k", 3, 3, "Kiel", 9), ("k", 3, 4, "Ulm", 80)],
        "k STRING, batch INT, row_no INT, ort STRING, p INT",
    )
    assert rows_of(batches.summaries(rows, "k", "ort"), "batch", "rows", "place") == [
        (1, 2, "Kiel"), (3, 2, "Raum Hamburg"),
    ]
    empty = F.lit(None).cast("array<string>")
    rich = rows.withColumn(
        "enrichment",
        F.struct(F.lit(None).cast("int").alias("alter_tage"), F.lit(None).cast("double").alias("entfernung_km"),
                 F.lit("A").alias("stufe"), F.col("p").alias("punkte"), F.array(F.lit("x")).alias("treffer"),
                 empty.alias("luecken")),
    )
    lines = batches.digest_rows(rich).orderBy("batch", "digest_order")
    assert [r.rating_line for r in lines.collect()] == [
        "A | 50 Punkte | passt: x", "A | passt: x", "A | 80 Punkte | passt: x", "A | 9 Punkte | passt: x",
    ]


# --- seen table ----------------------------------------------------------------

DAY = 86400


def seen_table(spark):
    return spark.createDataFrame(
        [("a", "Senior X", "GEFUNDEN", 100 * DAY, None, 280 * DAY),
         ("b", "Senior X", "BEWORBEN", 10 * DAY, 50 * DAY, None),
         ("c", "Y", None, 90 * DAY, None, 270 * DAY),
         ("d", "Z", "INTERVIEW", 95 * DAY, 0, None),
         ("fp#12", None, None, 1, None, 2)],
        "referenznummer STRING, titel STRING, status STRING, erfasst_am LONG, geaendert_am LONG,"
        " ablauf_zeitpunkt LONG",
    )


def test_listing_overdue_and_exclusions(spark):
    ads = entries.ads_only(seen_table(spark))
    assert [r.referenznummer for r in entries.listing(ads).collect()] == ["a", "c", "b", "d"]
    assert rows_of(entries.with_status(ads, "BEWORBEN"), "referenznummer") == [("b",)]
    assert rows_of(entries.status_counts(ads), "status", "entries") == [
        ("BEWORBEN", 1), ("GEFUNDEN", 2), ("INTERVIEW", 1),
    ]
    late = entries.overdue(ads, F.lit(100 * DAY + 5), 5)
    assert [(r.referenznummer, r.tage) for r in entries.by_waiting_time(late).collect()] == [("b", 50), ("d", 5)]
    judged = entries.title_reasons(ads, F.col("titel"))
    kept, gone = entries.split(judged, "reason")
    assert rows_of(gone, "referenznummer", "reason") == [("a", "senior")]
    assert kept.count() == 3
    assert entries.split(judged, "reason", enabled=False)[0].count() == 4
    both = entries.employer_reasons(judged, F.lit("NTT DATA SE"))
    assert rows_of(entries.reason_counts(both, "reason", "employer_reason"), "reason", "entries") == [
        ("ntt data", 1), ("senior", 1),
    ]


def test_decisions_are_read_back(spark):
    ads = entries.ads_only(seen_table(spark))
    cells = spark.createDataFrame(
        [("a", "alt", 1), (" a ", "Abgeschickt", 2), ("b", "", 3), ("c", "Vielleicht", 4), ("", "Absage", 5)],
        "referenznummer STRING, cell STRING, row LONG",
    )
    read = entries.read_back(ads, cells)
    assert rows_of(read, "referenznummer", "status", "changed", "unknown") == [
        ("a", "BEWORBEN", True, None), ("b", "GEFUNDEN", True, None),
        ("c", "GEFUNDEN", False, "Vielleicht"), ("d", "INTERVIEW", False, None),
    ]
    assert [r.unknown for r in entries.unknown_wordings(read).collect()] == ["Vielleicht"]


def test_status_changes(spark):
    seen = seen_table(spark)
    changes = spark.createDataFrame([("a", "ABSAGE"), ("b", "GEFUNDEN"), ("zz", "ABSAGE")],
                                    "referenznummer STRING, status STRING")
    after = entries.set_status(seen, changes, F.lit(123))
    assert rows_of(after.filter("referenznummer in ('a', 'b')"), "referenznummer", "status", "geaendert_am",
                   "ablauf_zeitpunkt") == [("a", "ABSAGE", 123, None), ("b", "GEFUNDEN", 123, None)]
    assert rows_of(entries.unknown_refs(seen, changes), "referenznummer") == [("zz",)]


# --- tracker table -------------------------------------------------------------

LINK = fixed.AGENCY_LINK


def old_table(spark):
    return spark.createDataFrame(
        [(1, "R1", "Alt AG", "Dev", "", "viel", "Absage", "mein"),
         (2, "", "B AG", "Ops", LINK + "R2", "", "", ""),
         (3, "", "C AG", "QA", "", None, "Interview", ""),
         (4, "R9", "C AG", "QA", "", "", "", "")],
        "_row LONG, Referenz STRING, Firma STRING, Position STRING, `Link zur Ausschreibung` STRING,"
        " Gehalt STRING, Status STRING, Eigenes STRING",
    )


def new_rows(spark, rows):
    return spark.createDataFrame(
        rows, "_seq LONG, Referenz STRING, Firma STRING, Position STRING, Gehalt STRING, Status STRING"
    )


def test_merge_policies(spark):
    new = new_rows(spark, [
        (1, "R1", "Neu AG", "", "wenig", "Abgeschickt"),
        (2, "R2", "B AG", "Ops 2", "55", ""),
        (3, "R3", "c  ag", "qa", "66", ""),
        (4, "R4", "D AG", "UX", "77", ""),
        (5, "R5", "D AG", "UX", "88", "Absage"),
        (6, "R6", "", "", "", ""),
    ])
    merged = tracker.merge(old_table(spark), new)
    found = {r.Referenz or r._row: r for r in merged.collect()}
    r1 = found["R1"]
    assert (r1.Firma, r1.Position, r1.Gehalt, r1.Status, r1.Eigenes) == ("Neu AG", "Dev", "viel", "Abgeschickt", "mein")
    assert (found["R2"]._row, found["R2"].Position, found["R2"].Gehalt) == (2, "Ops 2", "55")
    # The first row with the pair, and an empty status replaces a filled one.
    assert (found["R3"]._row, found["R3"].Gehalt, found["R3"].Status) == (3, "66", "")
    # Two new rows of the same employer and position share one line.
    assert "R4" not in found and (found["R5"].change, found["R5"].updates) == ("neu", 1)
    assert (found["R5"].Gehalt, found["R5"].Status) == ("77", "Absage")
    assert found["R6"].change == "neu" and found["R9"].change is None
    counts = tracker.change_counts(merged).first()
    assert (counts.new, counts.updated) == (2, 4)
    forced = {r.Referenz: r for r in tracker.merge(old_table(spark), new, overwrite=True).collect()}
    assert forced["R1"].Gehalt == "wenig"


def test_merge_twice_changes_nothing_more(spark):
    new = new_rows(spark, [(1, "R1", "Neu AG", "Dev", "x", ""), (2, "R7", "E AG", "ML", "y", "")])
    once = tracker.merge(old_table(spark), new)
    table = once.withColumn("_row", F.coalesce("_row", F.col("_seq") + 100)).drop("_seq", "change", "updates")
    again = tracker.merge(table, new).drop("_seq", "change", "updates")
    assert rows_of(again, *[f"`{c}`" for c in table.columns]) == rows_of(table, *[f"`{c}`" for c in table.columns])


def test_removal(spark):
    refs = lambda *r: spark.createDataFrame([(x,) for x in r], "Referenz STRING")
    kept = tracker.remove(old_table(spark), refs("R1", "R9"), refs("R1x"))
    assert rows_of(kept, "_row") == [(1,), (2,), (3,)]
    assert rows_of(tracker.remove(old_table(spark), refs("R9"), refs("R1")), "_row") == [(2,), (3,)]


def test_table_order_and_numbers(spark):
    rows = spark.createDataFrame(
        [("absage", "A – x", 99, 1, "a", "Absage"), ("interview", "C – x", 1, 9, "a", "Interview"),
         ("zusage", None, None, None, "a", "Zusage"), ("b-old", "B – x", 50, 9, "a", ""),
         ("b-new", "B – x", 50, 2, "z", ""), ("a-top", "A – x", 90, None, "a", "unklar"),
         ("none", "", None, 1, "a", None)],
        "Referenz STRING, Passung STRING, Punkte INT, `Alter (Tage)` INT, Firma STRING, Status STRING",
    )
    ranked = tracker.ranked(rows, [F.col("Referenz")])
    order = [r.Referenz for r in sorted(ranked.collect(), key=lambda r: r["Nr."])]
    assert order == ["zusage", "interview", "a-top", "b-new", "b-old", "none", "absage"]
    plain = tracker.ranked(rows.drop("Passung", "Punkte"), [F.col("Referenz")])
    order = [r.Referenz for r in sorted(plain.collect(), key=lambda r: r["Nr."])]
    assert order == ["zusage", "interview", "a-top", "b-new", "b-old", "none", "absage"]


def test_layout_evolves(spark):
    present = [" FIRMA ", "Eigenes", "Notizen", "Status", "Referenz", "Noch eins"]
    layout = tracker.evolved_columns(present, ("Nr.", "Status", "Firma"))
    assert layout == [("Nr.", None), ("Status", "Status"), ("Firma", " FIRMA "), ("Referenz", "Referenz"),
                      ("Eigenes", "Eigenes"), ("Noch eins", "Noch eins")]
    table = spark.createDataFrame([tuple("abcdef")], present)
    once = tracker.evolve(table, ("Nr.", "Status", "Firma"))
    assert tracker.evolve(once, ("Nr.", "Status", "Firma")).columns == once.columns
    assert tuple(once.first()) == (None, "d", "a", "e", "b", "f")
    assert rows_of(tracker.decisions(old_table(spark)), "referenznummer", "cell", "row") == [
        ("R1", "Absage", 1), ("R9", "", 4),
    ]


# --- salary --------------------------------------------------------------------


def test_salary_lookup(spark):
    def level(i):
        return (i, f"n{i}")

    rows = [
        ("43413", level(5), level(1), level(1), level(1), level(3), 5000, 4000, -1, -42, 1),
        ("43413", level(5), level(1), level(1), level(1), level(3), 9999, 1, 1, 1, 2),
        ("43413", level(5), level(2), level(1), level(1), level(3), 1111, 1, 1, 1, 0),
        ("43414", level(5), level(1), level(1), level(1), None, -1, 1, 1, 1, 3),
    ]
    from stellwerk import schema

    table = spark.createDataFrame(rows, schema.SALARY + ", pos INT")
    pay = salary.pay_table(table)
    titles = spark.createDataFrame([("Developer",), ("Senior Developer",)], "titel STRING")
    found = salary.lookup(titles, "titel", F.lit(5), pay)
    assert rows_of(found, "kldb", "niveau", "median", "q25", "q75", "fallzahl") == [
        ("43413", "n3", 5000, 4000, 0, 0), ("43414", None, None, None, None, None),
    ]


# --- two keys ------------------------------------------------------------------


@pytest.mark.parametrize("fold", [100_000, 4])
def test_two_keys_in_any_order_equal_the_greedy_rule(spark, monkeypatch, fold):
    monkeypatch.setattr(dedup, "FOLD_ROWS", fold)
    rng = random.Random(fold)
    rows = [(i, f"a{rng.randrange(120)}", rng.choice([None, f"b{rng.randrange(120)}"])) for i in range(400)]
    rows += [(500 + i, f"c{i // 2}", f"d{(i + 1) // 2}") for i in range(40)] + [(900, "", "z"), (901, None, "z")]
    frame = spark.createDataFrame(rows, "seq LONG, referenznummer STRING, fp STRING")
    assert {r.seq for r in dedup.two_key_dedup(frame).collect()} == greedy([r for r in rows if r[1]])


def test_a_long_chain_takes_one_round_of_doubling(spark, monkeypatch):
    """10,000 rows in a row depend on each other; no rounds in their number are made."""
    monkeypatch.setattr(dedup, "FOLD_ROWS", 10)
    rounds, cuts = [], []
    chained, plain = dedup._chained, dedup.written
    monkeypatch.setattr(dedup, "_chained", lambda live: rounds.append(1) or chained(live))
    monkeypatch.setattr(dedup, "written", lambda df: cuts.append(1) or plain(df))
    key = F.col("id")
    frame = spark.range(10_000).select(
        key.alias("seq"),
        F.concat(F.lit("a"), F.floor(key / 2).cast("string")).alias("referenznummer"),
        F.concat(F.lit("b"), F.floor((key + 1) / 2).cast("string")).alias("fp"),
    )
    kept = dedup.two_key_dedup(frame)
    assert sorted(r.seq for r in kept.select("seq").collect()) == list(range(0, 10_000, 2))
    assert len(rounds) == 1 and len(cuts) < 30


def test_long_chains_move_few_bytes_a_row(spark, monkeypatch):
    """What the steps write stays in proportion to the rows, as no round passes all of them again."""
    from stellwerk.operators import graphs

    sizes, plain = [], dedup.written

    def counted(df):
        out = plain(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(dedup, "written", counted)
    monkeypatch.setattr(graphs, "written", counted)
    key, n = (F.col("id") * 7919) % 20_000, 20_000  # chains in no order of their rows' files
    frame = spark.range(n).select(
        key.alias("seq"),
        F.concat(F.lit("a"), F.floor(key / 2).cast("string")).alias("referenznummer"),
        F.when(key % 5000 != 0, F.concat(F.lit("b"), F.floor((key + 1) / 2).cast("string"))).alias("fp"),
    )
    kept = dedup.two_key_dedup(frame)
    assert sorted(r.seq for r in kept.select("seq").collect()) == list(range(0, n, 2))
    assert sum(sizes) < 16 * n


def test_components_of_paths_stars_and_pairs(spark):
    from stellwerk.operators.graphs import components

    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(5000, 5001), (5001, 5000), (6000, 6000)]
    found = components(spark.createDataFrame(random.Random(1).sample(edges, len(edges)), "a LONG, b LONG")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    assert all(root in nodes for root, nodes in groups.items())
    assert sorted(map(sorted, groups.values())) == [list(range(301)), list(range(1000, 1201)), [5000, 5001]]
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0
