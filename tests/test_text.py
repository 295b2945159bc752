from pyspark.sql import functions as F

from stellwerk import sql
from stellwerk.functions import text
from stellwerk.functions.fingerprint import (
    claim_key,
    content_fingerprint,
    first_place,
    is_claim_key,
)

X = F.col("x")


def fingerprints(over, rows):
    column = content_fingerprint(F.col("e"), F.col("t"), F.col("p"))
    return over(column, rows, "e STRING, t STRING, p STRING")


def test_title_form_drops_gender_suffix_and_punctuation(over):
    same = ["Analyst (m/w/d)", "Analyst (w|m|d)", "ANALYST (all genders)", "Analyst  [gn]", "Analyst"]
    assert set(over(text.title_form(X), same)) == {"analyst"}
    assert over(text.title_form(X), ["Straße-Bau", None, ""]) == ["strasse bau", "", ""]
    # The suffix pattern has no word bounds, so it also bites inside words.
    assert over(text.title_form(X), ["Designer"]) == ["desi er"]


def test_employer_form_drops_legal_forms(over):
    same = ["Muster GmbH", "Muster GmbH & Co. KG", "Muster AG", "MUSTER Deutschland SE", "Muster e.V."]
    assert set(over(text.employer_form(X), same)) == {"muster"}
    # Only whole words are legal forms.
    assert over(text.employer_form(X), ["Agentur Seewald"]) == ["agentur seewald"]


def test_place_form(over):
    same = ["20095 Hamburg", "Hamburg, Deutschland", "hamburg"]
    assert set(over(text.place_form(X), same)) == {"hamburg"}
    assert over(text.map_place_form(X), ["Raum Köln", "22765 Hamburg, DE", "Region Henstedt-Ulzburg"]) == [
        "köln", "hamburg", "henstedt-ulzburg",
    ]


def test_fingerprint_ignores_noise_but_not_level_or_place(over):
    base, noisy, senior, elsewhere, no_place = fingerprints(
        over,
        [
            ("Muster GmbH & Co. KG", "Data Engineer (m/w/d)", "20095 Hamburg"),
            ("Muster GmbH", "Data Engineer (w/m/d)", "Hamburg, Deutschland"),
            ("Muster GmbH", "Senior Data Engineer", "Hamburg"),
            ("Muster GmbH", "Data Engineer", "Berlin"),
            ("Muster GmbH", "Data Engineer", None),
        ],
    )
    assert base == noisy and len(base) == 24
    assert len({base, senior, elsewhere, no_place}) == 4 and no_place is not None


def test_fingerprint_needs_employer_and_title(over):
    assert fingerprints(over, [("", "x", "y"), (None, "x", "y"), ("x", "", "y"), ("x", None, "y")]) == [
        None
    ] * 4


def test_claim_keys(over):
    assert over(claim_key(X), ["ab", None]) == ["fp#ab", None]
    assert over(is_claim_key(X), ["fp#ab", "10001-1-S", None]) == [True, False, False]


def test_first_place_skips_blank_ones(spark):
    rows = spark.sql(
        "SELECT array(named_struct('adresse', named_struct('plz', '1', 'ort', ' ')),"
        " named_struct('adresse', named_struct('plz', '2', 'ort', 'Kiel'))) AS stellenlokationen"
    )
    assert rows.select(first_place("stellenlokationen")).first()[0] == "Kiel"


def test_small_helpers(over):
    assert over(text.path_safe(X), ["a/b"]) == ["a_b"]
    assert over(text.encoded_ref(X), ["a-1"]) == ["YS0x"]
    assert over(text.ellipsis(X, 10), ["short", "0123456789", "0123456789a"]) == [
        "short", "0123456789", "0123456...",
    ]
    assert over(text.filled(X), ["  a\t", "  ", None]) == ["a", None, None]
    assert text.header_form(" Link zur\n Ausschreibung ") == "link zur ausschreibung"
    assert text.term_list(" A, ,b ", ("z",)) == ("a", "b")
    assert text.term_list("  ", ("z",)) == ("z",)
    link = "https://www.arbeitsagentur.de/jobsuche/jobdetail/10001-1-S"
    assert over(text.ref_from_link(X), [link, "https://other.example/1", None]) == [
        "10001-1-S", "", "",
    ]
    pairs = over(text.pair_key("a", "b"), [("A  b", "C"), ("", "C"), (None, "C")], "a STRING, b STRING")
    assert pairs == ["a b | c", "", ""]


def test_sql_functions_equal_the_column_functions(spark):
    sql.register(spark)
    rows = spark.createDataFrame(
        [
            ("Muster GmbH", "Analyst (m/w/d)", "20095 Kiel", "3 Tage pro Woche Homeoffice"),
            ("", "x", "y", "Präsenzpflicht"),
            ("Straße AG", "IT", None, "nichts"),
        ],
        "e STRING, t STRING, p STRING, w STRING",
    )
    from stellwerk.functions.workmodel import from_text

    both = rows.select(
        F.expr("content_fingerprint(e, t, p)").alias("a"),
        content_fingerprint(F.col("e"), F.col("t"), F.col("p")).alias("b"),
        F.expr("work_model(w)").alias("c"),
        from_text(F.col("w")).alias("d"),
    ).collect()
    assert all(r.a == r.b and r.c == r.d for r in both)
    row = spark.sql("SELECT match_score(12, 15, 15), round(haversine_km(0, 0, 0, 180), 0)").first()
    assert tuple(row) == (60, 20015.0)
