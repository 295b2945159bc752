"""Job ads and postings derived from the benchmark tables.

The benchmark tables hold no job ads, so two views give them the shape of some:

* ``ads``: one ad per document.  Title, employer, place and dates come from the part,
  order, customer and nation rows with matching keys; the description is the document
  text and a closing paragraph that states work model, benefits, pay and contact.
* ``postings``: one row per event - a portal (event type) reporting the job of a
  customer.  The same job is reported over and over and by several portals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.catalog import Catalog
from stellwerk.functions.fingerprint import claim_key, content_fingerprint
from stellwerk.functions.score import Profile
from stellwerk.session import spread

# Words that occur in the texts play the part of skills.
CATALOG = Catalog.of(
    [
        ("english", "the", r"\bthe\b"),
        ("english", "of", r"\bof\b"),
        ("english", "and", r"\band\b"),
        ("english", "to", r"\bto\b"),
        ("english", "that", r"\bthat\b"),
        ("english", "with", r"\bwith\b"),
        ("deutsch", "Artikel", r"\bder\b|\bdie\b|\bdas\b"),
        ("deutsch", "und", r"\bund\b"),
        ("deutsch", "von", r"\bvon\b"),
        ("deutsch", "mit", r"\bmit\b"),
        ("francais", "le", r"\ble\b"),
        ("francais", "la", r"\bla\b"),
        ("francais", "que", r"\bque\b"),
        ("francais", "Plural", r"\bdes\b|\bles\b"),
        ("espanol", "el", r"\bel\b"),
        ("espanol", "en", r"\ben\b"),
        ("produkt", "ring", r"\bring\b"),
        ("produkt", "bolt", r"\bbolt\b"),
        ("produkt", "plate", r"\bplate\b"),
        ("produkt", "rod", r"\brod\b"),
        ("produkt", "gear", r"\bgear\b"),
        ("produkt", "gizmo", r"\bgizmo\b"),
        ("produkt", "anvil", r"\banvil\b"),
        ("produkt", "widget", r"\bwidget\b"),
        ("stamm", "Tion", r"(?:^|[^\p{L}\p{N}_])tion"),
    ]
)
PROFILE = Profile(
    counts={
        "the": 5, "of": 3, "and": 2, "to": 1, "Artikel": 4, "la": 3, "ring": 1, "bolt": 3,
        "gear": 2, "Tion": 1,
    },
    own=("widget", "Plural"),
    excluded=("and",),
)
ADS_AS_OF = dt.date(2002, 1, 1)
EVENTS_AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are expensive to work on."""
    return spread(table(spark, sf_dir, name))


def _case(value: Column, texts: dict[object, str | Column], default: str = "") -> Column:
    result = F.lit(default)
    for key, text in texts.items():
        result = F.when(value == key, text).otherwise(result)
    return result


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 1 << 30))


def title_of() -> Column:
    """Part name with a level in front and a gender suffix behind."""
    level = _case(
        F.col("p_brand"),
        {"Brand#1": "Senior ", "Brand#2": "Team Lead ", "Brand#3": "Junior ",
         "Brand#4": "Consultant "},
    )
    suffix = _case(F.col("p_size") % 3, {0: " (m/w/d)", 1: " (w/m/d)"})
    return F.concat(level, F.col("p_name"), suffix)


def employer_of() -> Column:
    """Market segment with a legal form; one segment stays without a name."""
    form = _case(F.col("c_nationkey") % 4, {0: " GmbH", 1: " AG", 2: " GmbH & Co. KG"})
    named = F.concat(F.col("c_mktsegment"), form)
    ntt = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_nationkey") % 4 == 3)
    return (
        F.when(ntt, "NTT DATA Deutschland SE")
        .when(F.col("c_mktsegment") == "BUILDING", "")
        .otherwise(named)
    )


def place_of() -> Column:
    suffix = _case(F.col("c_nationkey") % 2, {0: ", Deutschland"})
    return F.concat(F.col("n_name"), suffix)


def closing_paragraph() -> Column:
    size = F.col("p_size")
    work = _case(
        F.col("p_type"),
        {
            "ECONOMY": "Wir arbeiten zu 100 % remote.",
            "SMALL": F.concat((size % 6).cast("string"), F.lit(" Tage pro Woche Homeoffice.")),
            "MEDIUM": "Ein hybrides Arbeitsmodell erwartet Sie.",
            "PROMO": "Mobiles Arbeiten nach Absprache.",
            "STANDARD": "Es gilt Präsenzpflicht.",
        },
    )
    benefits = _case(
        size % 5,
        {
            0: "Unbefristet, 30 Tage Urlaub, Jobticket.",
            1: "Betriebliche Altersvorsorge und Weiterbildung.",
            2: "Jobrad, Kantine, Vermoegenswirksame Leistungen.",
            3: "Gleitzeit und Prämie.",
        },
    )
    pay = _case(
        F.col("o_orderpriority"),
        {
            "1-URGENT": "Gehalt 55.000 - 65.000 EUR.",
            "2-HIGH": "Ab 48.500 € brutto.",
            "3-MEDIUM": "Entgelt TVöD E 13.",
            "4-NOT SPECIFIED": "Entgeltgruppe 11.",
        },
    )
    doc = F.col("doc_id").cast("string")
    adjective = F.substring_index("p_name", " ", 1)
    noun = F.substring_index("p_name", " ", -1)
    contact = _case(
        F.col("o_orderstatus"),
        {
            "P": F.concat(
                F.lit("Ansprechpartnerin: Frau Dr. "), _capital(noun), F.lit(", Tel. +49 40 "),
                F.lpad(doc, 7, "0"),
            ),
            "F": F.concat(F.lit("Ihr Ansprechpartner ist Herr "), _capital(adjective), F.lit(".")),
            "O": F.concat(F.lit("Bewerbung an jobs"), doc, F.lit("@example.com.")),
        },
    )
    return F.concat_ws("\n", work, benefits, pay, contact)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an ad holds besides the text of its document; narrow rows, one per document."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey"
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"
    )
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(parts, F.col("o_orderkey") == F.col("p_partkey"))
    )


def _ad_columns() -> list[Column]:
    """All columns of an ad but its description."""
    doc = F.col("doc_id").cast("string")
    size = F.col("p_size")
    none = F.lit(None)
    address = F.struct(
        (F.lit(10000) + size).cast("string").alias("plz"), place_of().alias("ort")
    )
    location = F.struct(
        address.alias("adresse"),
        none.cast("double").alias("entfernung"),
        none.cast("double").alias("distanz"),
        none.cast("double").alias("entfernungKm"),
    )
    return [
        F.col("doc_id"),
        F.concat(F.lit("d"), doc).alias("referenznummer"),
        F.when(F.col("source") == "src0", fixed.AGENCY).otherwise(F.col("source")).alias("quelle"),
        title_of().alias("stellenangebotsTitel"),
        employer_of().alias("firma"),
        F.array(location).alias("stellenlokationen"),
        F.col("o_orderdate").cast("date").cast("string").alias("datumErsteVeroeffentlichung"),
        none.cast("string").alias("aktuelleVeroeffentlichungsdatum"),
        none.cast("string").alias("modifikationsTimestamp"),
        F.when(F.col("o_orderpriority") == "1-URGENT", size.cast("double")).alias("entfernung"),
        none.cast("double").alias("distanz"),
        none.cast("double").alias("entfernungKm"),
        F.col("p_type").alias("hauptberuf"),
        F.array("p_type", "p_brand").alias("alleBerufe"),
        none.cast("string").alias("stellenbeschreibung"),
        F.concat(F.lit("https://jobs.example/"), doc).alias("externeURL"),
        F.when(size % 10 == 0, (size * 2).cast("double")).alias("homeofficeprozent"),
        F.when(F.col("o_orderstatus") == "F", fixed.BY_AGREEMENT_CODE).alias("homeofficetyp"),
        (F.col("o_orderstatus") == "O").alias("homeofficemoeglich"),
        F.when(F.col("p_brand") == "Brand#5", "IG Metall").alias("tarifvertrag"),
        F.col("o_orderdate").cast("date").alias("tag"),
        F.col("o_orderstatus"),
    ]


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ad per document, in ad shape, with ``doc_id``, ``tag`` and ``o_orderstatus``.

    Everything but the document text is joined first while rows are narrow; the text is
    shuffled once, on its own key.
    """
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    rows = documents.join(facts(spark, sf_dir), F.col("doc_id") == F.col("o_orderkey"))
    whole = F.concat(F.col("text"), F.lit("\n"), closing_paragraph())
    return rows.select(*_ad_columns(), whole.alias("stellenangebotsBeschreibung"))


def extracted(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    """Ads without a description, with what ``columns`` draw from the document text.

    The text is read on its scan and goes no further, so only narrow rows are joined.  The end
    of the description, which is no part of the document, comes along as ``closing``.
    """
    documents = texts(spark, sf_dir, "documents").select(
        "doc_id", "source", *[value.alias(name) for name, value in columns.items()]
    )
    rows = documents.join(facts(spark, sf_dir), F.col("doc_id") == F.col("o_orderkey"))
    return rows.select(*_ad_columns(), *columns, closing_paragraph().alias("closing"))


def postings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One row per event: seq, ts, tag, referenznummer, quelle, prio, title, firma, fp.

    The fingerprint is computed once per job, before the job meets its many postings.
    ``events`` may be a stream of the same rows.
    """
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    jobs = (
        customers.join(parts, F.col("c_custkey") == F.col("p_partkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            title_of().alias("stellenangebotsTitel"),
            employer_of().alias("firma"),
            place_of().alias("ort"),
            F.col("p_type").alias("hauptberuf"),
            F.array("p_type", "p_brand").alias("alleBerufe"),
        )
        .withColumn(
            "fp",
            claim_key(
                content_fingerprint(
                    F.col("firma"), F.col("stellenangebotsTitel"), F.col("ort")
                )
            ),
        )
    )
    if events is None:
        events = table(spark, sf_dir, "events")
    events = events.select("event_id", "ts", "user_id", "event_type")
    prio = _case(
        F.col("event_type"), {"click": "0", "view": "1", "signup": "2", "purchase": "3"}, "4"
    )
    return events.join(jobs, F.col("user_id") == F.col("c_custkey")).select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("ts").cast("date").alias("tag"),
        F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("referenznummer"),
        F.col("event_type").alias("quelle"),
        prio.cast("int").alias("prio"),
        "stellenangebotsTitel",
        "firma",
        "ort",
        "hauptberuf",
        "alleBerufe",
        "fp",
    )
