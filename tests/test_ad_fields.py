import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stellwerk import fixed, schema
from stellwerk.functions import dates
from stellwerk.functions.ad import ad_link, requirement_text, source_name
from stellwerk.functions.contact import contact, contact_address, contact_person, pay, pay_from_text
from stellwerk.functions.defaults import BENEFITS, CITIES, SKILLS
from stellwerk.functions.catalog import Catalog, Entry, labels_in, mentions_in
from stellwerk.functions.digest import margin_line
from stellwerk.functions.html import html_to_text
from stellwerk.functions.occupation import occupation_code, stated
from stellwerk.functions.places import great_circle_km, location_label, place_structs, reported_km
from stellwerk.functions.predicates import (
    employer_reason,
    exclusion_reason,
    fits_place,
    fits_region,
    fully_remote,
    matches_search,
    passes,
)
from stellwerk.functions.status import (
    parse_status,
    status_code,
    status_from_cell,
    status_rank,
    status_text,
)
from stellwerk.functions.terms import candidate_words, is_unknown_term
from stellwerk.functions.workmodel import from_percent, from_text, work_model
from stellwerk.operators import rows
from stellwerk.operators.places import located

X = F.col("x")
DAY = dt.date(2026, 8, 25)


def test_dates_in_every_form(over):
    given = [
        "1756080000", "2025-08-25", "2025-08-25T23:30:00-05:00", "2025-08-25T10:00:00Z",
        "25.08.2025", "Mon, 25 Aug 2025 10:00:00 +0000", "", None, "gestern", "0", "2025-13-01",
    ]
    assert over(dates.any_date_text(X), given) == ["2025-08-25"] * 6 + [""] * 5


def test_published_takes_the_first_readable_field(over):
    column = dates.published_on(F.col("a"), F.col("b"))
    rows = [("x", "2025-08-25T01:02:03"), ("2025-08-24", "2025-08-25"), (None, None)]
    assert over(column, rows, "a STRING, b STRING") == [
        dt.date(2025, 8, 25), dt.date(2025, 8, 24), None,
    ]


def test_age_is_never_negative_and_unknown_stays_unknown(over):
    days = [dt.date(2026, 8, 20), dt.date(2026, 9, 1), None]
    assert over(dates.age_days(X, F.lit(DAY)), days, "x DATE") == [5, 0, None]


def test_age_window(over):
    given = ["2026-08-20", "2026-08-01", "", "unklar", None]
    assert over(dates.within_days(X, 7, F.lit(DAY)), given) == [True, False, True, True, True]
    assert over(dates.within_days(X, 0, F.lit(DAY)), ["1999-01-01"]) == [True]


def test_epoch_helpers(over):
    assert over(dates.epoch_date_text(X), [86400, 0, None], "x LONG") == ["1970-01-02", "", ""]
    assert over(dates.days_since(X, F.lit(10 * 86400 - 1)), [0, None, 86400], "x LONG") == [0, 0, 8]
    parts = over(
        dates.partition_day(F.col("y"), F.col("m"), F.col("d")),
        [("2026", "08", "05"), ("2026", "13", "05")],
        "y STRING, m STRING, d STRING",
    )
    assert parts == [dt.date(2026, 8, 5), None]


def test_html_to_text(over):
    given = [
        "<p>Ein <b>Satz</b></p><ul><li>eins</li><li>zwei &amp; drei</li></ul>"
        "<script>var x = '</p>';</script><style>p{}</style>Ende<br/>&nbsp;&#8364; &eacute;",
        None,
        "   ",
    ]
    assert over(html_to_text(X), given) == [
        "Ein Satz\neins\nzwei & drei\nEnde\n€ é", "", "",
    ]


def test_work_model_phrases(over):
    phrases = {
        "Arbeit zu 100 % aus dem Homeoffice": "100 % remote",
        "100%ige Home-Office Tätigkeit": "100 % remote",
        "100% Remote-Arbeit": "100 % remote",
        "Homeoffice bis zu 100 %": "100 % remote",
        "wir sind remote first": "100 % remote",
        "Ortsunabhängig arbeiten": "100 % remote",
        "vollstaendig remote": "100 % remote",
        "2 Tage pro Woche im Homeoffice": "hybrid, 2 Tage/Woche",
        "Homeoffice an 1 Tag pro Woche": "hybrid, 1 Tag/Woche",
        "5 Tage Homeoffice": "100 % remote",
        # Only the last digit is read.
        "10 Tage Homeoffice": "100 % remote",
        "ein hybrides Arbeitsmodell": "hybrid, Umfang offen",
        "eine hybride Cloud": "",
        "mobiles Arbeiten ist willkommen": "möglich, Umfang offen",
        "Home-Office-Option": "möglich, Umfang offen",
        "Möglichkeit zum Homeoffice": "möglich, Umfang offen",
        "keine Möglichkeit zum Homeoffice": "vor Ort",
        "100 % Präsenz": "vor Ort",
        "ausschliesslich vor Ort": "vor Ort",
        "Termine beim Kunden vor Ort": "",
        "Videopräsenzunterricht": "",
        "": "",
    }
    assert dict(zip(phrases, over(from_text(X), list(phrases)))) == phrases


def test_work_model_precedence(over):
    column = work_model(F.col("p"), F.col("t"), F.col("k"), F.col("m"))
    rows = [
        (40.0, "100 % Homeoffice", None, None),
        (None, "100 % remote", "NACH_VEREINBARUNG", True),
        (0.0, "", "nach_vereinbarung", True),
        (None, None, None, True),
        (None, None, None, None),
    ]
    assert over(column, rows, "p DOUBLE, t STRING, k STRING, m BOOLEAN") == [
        "hybrid, 40 % Homeoffice", "100 % remote", "nach Vereinbarung", "möglich, Umfang offen", "",
    ]
    assert over(from_percent(X), [100.0, 40.0, 0.0, None], "x DOUBLE") == [
        "100 % remote", "hybrid, 40 % Homeoffice", "", "",
    ]


def test_benefits(over):
    tags = F.array_join(labels_in(X, BENEFITS), ", ")
    given = {
        "JOBRAD und vermoegenswirksame Leistungen": "Dienstrad, Vermögensbildung",
        "30 Tage Urlaub": "Urlaub ab 30 Tagen",
        "45 Urlaubstage": "Urlaub ab 30 Tagen",
        "25 Urlaubstage": "",
        "Praemie, Prämie, Pramie": "Sonderzahlung",
        "Bezahlung nach TVöD": "Tarif",
        "flexible Arbeitszeiten": "Flexible Zeiten",
        "": "",
    }
    assert dict(zip(given, over(tags, list(given)))) == given


def test_a_search_by_literals_finds_what_the_whole_pattern_finds(over):
    """Every letter that a caseless pattern may take for another one stands in for it."""
    entries = [e for e in (*BENEFITS, *SKILLS) if not e.plain_parts and not e.whole_words]
    odd = ("/\\p{L}tv", r"(?-i)Bx|cy", r"(a|b)\1x", r"[a[b]|c]d")
    catalog = Catalog((*entries, *(Entry("odd", p, p) for p in odd)))
    words = ["prämie", "praemie", "13. monatsgehalt", "bav", "tv-l", "tvöd", "30 tage urlaub", "vwl", "bonus", "ci/cd", "Bx", "bx", "cy", "aax", "cd", "ötv"]
    swaps = {"s": "sSſ", "i": "iIıİ", "k": "kK\u212a", "ä": "äÄ", "ö": "öÖ", "u": "uU", "t": "tT", "a": "aAåÅ"}
    texts = [w.replace(c, x) for w in words for c, xs in swaps.items() for x in xs] + [x + "nach tarif" for x in ("", "ſ", " ")] + ["ßonus", "kein", "", None]
    whole = F.array_compact(F.array(*[F.when(F.coalesce(X, F.lit("")).rlike("(?iU)" + e.pattern), F.lit(e.label)) for e in catalog]))
    assert over(labels_in(X, catalog), texts) == over(whole, texts)


def test_patterns_are_tried_where_a_literal_of_theirs_occurs():
    """Only what is left of a pattern runs as a regular expression, each behind a literal."""
    for entry in BENEFITS:
        if not entry.plain_parts:
            assert all(literal for literal, _ in entry.searches)
            assert sum(1 for _, pattern in entry.searches if pattern) <= 8
    assert dict(BENEFITS.entry("Altersvorsorge").searches) == {"altersvorsorge": "", "bav": r"\bbav\b"}
    assert Entry("c", "l", r"x\p{L}|y").searches == (("", r"x\p{L}|y"),)


def test_skills_in_catalog_order(over):
    labels = F.array_join(labels_in(X, SKILLS), ",")
    given = {
        "SQL und Java, kein JavaScript-Kurs": "SQL,Java,JavaScript",
        "JavaScript": "JavaScript",
        "Go und go-live": "Go",
        "wir machen den go-live": "",
        "Rust": "Rust",
        "rust": "",
        "C# oder C++ oder .NET": "C#,C++",
        "CI/CD mit GitLab, k8s": "CI/CD,GitLab,Kubernetes",
        "agiles Arbeiten, Unit Tests": "Agile Arbeitsweise,Unit-Tests",
        "Datenpipelines und Data Warehouses": "Data Warehouse,ETL",
        "": "",
    }
    assert dict(zip(given, over(labels, list(given)))) == given


def test_mentions_are_counted_each_time(over):
    found = over(mentions_in(X, SKILLS), ["Java, Java und agil, agiler. JAVA"])[0]
    counts = {}
    for m in found:
        counts[m.label] = counts.get(m.label, 0) + m.n
    assert counts == {"Java": 3, "Agile Arbeitsweise": 2}


def test_unknown_terms(over):
    words = F.array_sort(F.filter(candidate_words(X), lambda w: is_unknown_term(w, SKILLS)))
    given = [
        "Erfahrung mit DB2, COBOL und gRPC; OpenTelemetry, F# und Kubernetes, PostgreSQL.",
        "DEINE AUFGABEN BEI UNS: GmbH, VWL, CI/CD, mit .NET und IT",
        "COBOL COBOL",
        "",
        None,
    ]
    assert over(words, given) == [
        ["COBOL", "DB2", "F#", "OpenTelemetry", "gRPC"], [], ["COBOL"], [], [],
    ]


def test_contact(spark, over):
    texts = [
        "Ihr Ansprechpartner ist Herr Dr. Kern. Wir freuen uns.",
        "Fragen an Frau Maria Meyer unter 040 / 123 456-78 oder jobs@haus.example.",
        "Hausnummer 12",
        None,
    ]
    none = None
    assert over(contact_person(none, X), texts) == ["Herr Dr. Kern", "Frau Maria Meyer", "", ""]
    assert over(contact_address(none, X), texts)[1] == "jobs@haus.example / 040 / 123 456-78"
    assert over(contact(none, X), texts)[2:] == ["", ""]
    block = spark.sql(
        "SELECT named_struct('anrede', 'Frau', 'titel', '', 'vorname', 'Eva', 'nachname', 'Kern',"
        " 'name', 'X', 'email', '', 'mail', 'e@k.example', 'telefon', '', 'telefonnummer', '',"
        " 'tel', '0123', 'rufnummer', '') AS b, 'a@b.example' AS t"
    )
    assert block.select(contact(F.col("b"), F.col("t"))).first()[0] == (
        "Frau Eva Kern · e@k.example / 0123"
    )


def test_pay(over):
    given = {
        "Gehalt 55.000 - 65.000 EUR": "55.000 - 65.000 EUR",
        "von 55 000 € bis 65 000 € im Jahr": "55 000 € bis 65 000 €",
        "ab 48.500 Euro": "48.500 Euro",
        "rund 70k €": "70k €",
        "Entgeltgruppe 11": "Entgeltgruppe 11",
        "TVöD-E 13": "TVöD-E 13",
        "EG 9": "EG 9",
        "Gehalt: 60": "",
        "": "",
    }
    assert dict(zip(given, over(pay_from_text(X), list(given)))) == given
    column = pay(F.col("s"), F.col("d"), F.col("o"), F.lit("48.500 €"))
    rows = [("viel", "X", "Y"), ("", "X", "Y"), (None, None, "Y"), (None, None, None)]
    assert over(column, rows, "s STRING, d STRING, o STRING") == [
        "viel", "nach Tarifvertrag (X)", "nach Tarifvertrag (Y)", "48.500 €",
    ]


def test_exclusion_reasons(over):
    given = {
        "Senior Analyst": "senior",
        "Sr. Analyst": "sr",
        "Analyst für Israel": None,
        "Team Lead": "lead",
        "Teamleiterin": "teamleiter",
        "Praktikumsstelle": "praktikum",
        "C++ Entwicklung": "c++",
        "Customer Success Manager": None,
        "": None,
        None: None,
    }
    assert dict(zip(given, over(exclusion_reason(X), list(given)))) == given
    assert over(employer_reason(X), ["NTT DATA Deutschland SE", "Muster", None]) == [
        "ntt data", None, None,
    ]


def test_pass_filter(over):
    column = passes(F.col("e"), F.col("t"), required=("data",), employers=("ntt data",))
    rows = [("Muster", "data engineer"), ("NTT DATA", "data engineer"), ("Muster", "java"),
            (None, "datawerk"), ("Muster", "senior data"), ("Muster", "metadata")]
    assert over(column, rows, "e STRING, t STRING") == [True, False, False, True, False, False]
    assert over(passes(F.col("e"), F.col("t")), [("x", "java")], "e STRING, t STRING") == [True]


def test_search_terms(over):
    def hits(terms, titles):
        return over(matches_search(X, terms, SKILLS), titles)

    assert hits(("Java",), ["Java Entwickler", "JavaScript Entwickler", ""]) == [True, False, False]
    assert hits(("Data Engineer",), ["Data Platform Engineer", "Engineer"]) == [True, False]
    assert hits(("entwickler",), ["Softwareentwickler"]) == [True]
    # Case-sensitive labels see the title as written.
    assert hits(("rust",), ["Rust Engineer", "Entrust"]) == [True, False]


def test_places_regions_and_remote(over):
    column = fits_place(F.col("p"), F.col("l"), "Hamburg")
    rows = [(100.0, None), (None, "20095 hamburg"), (None, "Berlin"), (50.0, None)]
    assert over(column, rows, "p DOUBLE, l STRING") == [True, True, False, False]
    assert over(fits_region(X), ["", None, "Europe only", "USA"]) == [True, True, True, False]
    assert over(fully_remote(X, 80), [100.0, 79.0, None], "x DOUBLE") == [True, False, False]


def test_place_lists_and_labels(spark):
    row = spark.createDataFrame([(["20095 Hamburg", "Kiel, DE", " ", None],)], "x ARRAY<STRING>")
    places = row.select(place_structs(X).alias("p"))
    assert [tuple(p.adresse) for p in places.first().p] == [("20095", "Hamburg"), ("", "Kiel")]
    assert places.select(location_label(F.col("p"))).first()[0] == "20095 Hamburg / Kiel"
    detail = spark.sql("SELECT array(named_struct('plz', '1', 'ort', 'Ulm')) AS d, p FROM VALUES"
                       " (cast(null as array<struct<adresse: struct<plz: string, ort: string>>>)) t(p)")
    assert detail.select(location_label(F.col("p"), F.col("d"))).first()[0] == "1 Ulm"


def test_reported_distance_is_the_shortest(spark):
    one = "named_struct('entfernung', 7.26D, 'distanz', null, 'entfernungKm', -1D)"
    row = spark.sql(
        f"SELECT 9D AS entfernung, null AS distanz, -3D AS entfernungKm, array({one}) AS stellenlokationen"
    )
    assert row.select(reported_km()).first()[0] == 7.3
    empty = row.selectExpr("null AS entfernung", "null AS distanz", "null AS entfernungKm",
                           "array_remove(stellenlokationen, stellenlokationen[0]) AS stellenlokationen")
    assert empty.select(reported_km()).first()[0] is None


def test_city_lookup(spark):
    cities = spark.createDataFrame(CITIES, "pos INT, name STRING, lat DOUBLE, lon DOUBLE")
    names = ["Hamburg", "20095 Hamburg, DE", "Frankfurt", "Halle (Saale)", "Raum München", "Freiburg im",
             "Nirgends", "", None, "EMEA"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i INT, place STRING")
    found = {r.i: r.point for r in located(rows, "place", cities).collect()}
    assert [found[i] is not None for i in range(10)] == [True] * 6 + [False] * 4
    assert found[2].lat == 50.11


def test_distance_is_symmetric(spark):
    points = spark.createDataFrame([(53.551, 9.993, 52.520, 13.405)], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    there, back = (F.col(c) for c in "ab"), (F.col(c) for c in "cd")
    a, b = there
    c, d = back
    row = points.select(great_circle_km(a, b, c, d), great_circle_km(c, d, a, b)).first()
    assert row[0] == pytest.approx(row[1]) and 240 < row[0] < 270


def test_status(over):
    assert over(status_from_cell(X), ["Abgeschickt", " interview ", "", None, "beworben", "Vielleicht"]) == [
        "BEWORBEN", "INTERVIEW", "GEFUNDEN", "GEFUNDEN", "BEWORBEN", None,
    ]
    assert over(status_code(X), ["zusage", "Nicht interessant", "?"]) == ["ZUSAGE", "UNINTERESSANT", None]
    assert over(status_text(X), ["BEWORBEN", "GEFUNDEN", "XY"]) == ["Abgeschickt", "", "XY"]
    assert over(status_rank(X), ["GEFUNDEN", "ABSAGE", "XY"]) == [0, 4, 99]
    assert parse_status(" absage ") == "ABSAGE"
    with pytest.raises(ValueError):
        parse_status("vielleicht")


def test_links_and_sources(over):
    column = ad_link(F.col("q"), F.col("r"), F.col("u"))
    agency = "https://www.arbeitsagentur.de/jobsuche/jobdetail/"
    rows = [(None, "1-S", "https://x.example"), ("arbeitnow", "a:1", " https://x.example "), ("jobicy", "j:1", "")]
    assert over(column, rows, "q STRING, r STRING, u STRING") == [
        agency + "1-S", "https://x.example", agency + "j:1",
    ]
    assert over(source_name(X), [None, " ", "adzuna"]) == ["arbeitsagentur", "arbeitsagentur", "adzuna"]


def test_requirement_text_leaves_blanks_out(over):
    column = requirement_text(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    rows = [(" T ", None, ["x", " "], "d"), ("T", "m", None, None)]
    assert over(column, rows, "a STRING, b STRING, c ARRAY<STRING>, d STRING") == ["T\nx\nd", "T\nm"]


def test_occupation_codes(over):
    given = {"Senior Data Engineer": "43414", "Junior Developer": "43412", "Developer": "43413",
             "SAP Berater": "43213", "Lead Consultant": "43214"}
    assert dict(zip(given, over(occupation_code(X), list(given)))) == given
    assert over(stated(X), [-1, -42, 0, 5], "x INT") == [None, None, 0, 5]


def test_digest_margin(over):
    column = margin_line(F.col("a"), F.col("k"))
    rows = [(0, 8.2), (3, 8.0), (None, None)]
    assert over(column, rows, "a INT, k DOUBLE") == [
        "heute veroeffentlicht · 8,2 km", "seit 3 Tagen online · 8 km", "",
    ]


def test_references_equal_the_standard_rule(over):
    import html
    import random
    from html.entities import html5

    from stellwerk.functions.html import decoded

    draw = random.Random(6)
    names = sorted(html5)
    texts = ["", "no reference", "&", "&&", "a & b", "&amp", "&ampx;", "&notit; &notin; &not", "&unknown; &x", "&#65;&#x41;&#X41", "&#0;&#13;&#128;&#x81;&#159;"]
    texts += ["&#xD800;&#xDFFF;&#x110000;&#99999999999999999999;&#1;&#11;&#x7f;&#xfdd0;&#x1ffff;&#x10ffff;", "&#;&#x;&#xg;", "&#x1F600; &euro;&nbsp;x", "&#00065;"]
    texts += [f"x&{draw.choice(names)}{draw.choice(['', ';', 'y', ' '])}&#{draw.randrange(70000)}{draw.choice(['', ';'])}" for _ in range(300)]
    assert over(decoded(F.col("x")), texts) == [html.unescape(t) for t in texts]
    assert over(decoded(F.col("x")), [None]) == [None]


def test_the_join_by_place_moves_no_text(spark):
    """Many rows share a place: what is drawn from their texts is drawn before."""
    given = [(f"r{i}", "Adzuna", "Entwickler", "Firma", [(("20095", place), None, None, None)], km, f"Kantine und Jobrad {i}") for i, (place, km) in enumerate([("Hamburg", None), ("Hamburg", 3.0), ("Bremen", None), (None, None), ("Nirgends", None)])]
    shape = ("referenznummer STRING, quelle STRING, stellenangebotsTitel STRING, firma STRING, stellenlokationen ARRAY<STRUCT<adresse: STRUCT<plz: STRING, ort: STRING>,"
             " entfernung: DOUBLE, distanz: DOUBLE, entfernungKm: DOUBLE>>, entfernung DOUBLE, stellenangebotsBeschreibung STRING")
    ads = spark.createDataFrame(given, shape)
    have = set(ads.columns)
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema.AD) if f.name not in have]
    archive = ads.select("*", *rest, F.lit(dt.date(2024, 1, 2)).alias("tag"))
    entries = ads.select("referenznummer", F.lit("").alias("titel"), F.lit(fixed.FOUND).alias("status"), F.lit(1704153600).alias("erfasst_am"))
    detail = spark.createDataFrame([], schema.DETAIL)
    cities = spark.createDataFrame([(0, "hamburg", 53.55, 9.99), (1, "bremen", 53.08, 8.8)], schema.CITIES)
    out = rows.tracker_rows(rows.gathered(entries, archive, detail), cities, F.lit(dt.date(2024, 1, 3)))
    assert out.columns == [
        "Referenz", "Firma", "Position", "Link zur Ausschreibung", "Standort", "Homeoffice-Modell", "Gehalt", "Benefits",
        "Kontakt", "Status", "Quelle", "Alter (Tage)", "Entfernung (km)",
    ]
    found = {r["Referenz"]: (r["Benefits"], r["Entfernung (km)"]) for r in out.collect()}
    food = "Dienstrad, Mittagstisch"
    far = found["r2"][1]
    assert 90 < far < 100 and found == {"r0": (food, 0.0), "r1": (food, 3.0), "r2": (food, far), "r3": (food, None), "r4": (food, None)}

    def joins(plan):
        kids = [plan.children().apply(i) for i in range(plan.children().size())]
        here = [kids[0].output().mkString(" ")] if plan.nodeName() == "Join" and "_place" in plan.condition().toString() else []
        return here + [x for kid in kids for x in joins(kid)]

    moved = [x for x in joins(out._jdf.queryExecution().optimizedPlan()) if "Referenz" in x or "referenznummer" in x]
    assert moved and not any("Beschreibung" in x or "text#" in x for x in moved)
