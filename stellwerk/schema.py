"""Explicit schemas (as DDL) of the tables the operators read and write.

Two upstream fields exist in two spellings that differ in case only
(``externeURL``/``externeUrl`` and ``email``/``eMail``).  Spark columns are not
case sensitive, so a table has one of them; the JSON readers in ``sources``
accept both.
"""

_LOCATION = (
    "STRUCT<adresse: STRUCT<plz: STRING, ort: STRING>, entfernung: DOUBLE,"
    " distanz: DOUBLE, entfernungKm: DOUBLE>"
)

# One ad, in the shape every feed is mapped to.
AD = f"""
    referenznummer STRING, quelle STRING, stellenangebotsTitel STRING, firma STRING,
    stellenlokationen ARRAY<{_LOCATION}>,
    datumErsteVeroeffentlichung STRING, aktuelleVeroeffentlichungsdatum STRING,
    modifikationsTimestamp STRING, entfernung DOUBLE, distanz DOUBLE, entfernungKm DOUBLE,
    hauptberuf STRING, alleBerufe ARRAY<STRING>,
    stellenangebotsBeschreibung STRING, stellenbeschreibung STRING,
    externeURL STRING, homeofficeprozent DOUBLE, homeofficetyp STRING,
    homeofficemoeglich BOOLEAN, tarifvertrag STRING
"""

_CONTACT = (
    "STRUCT<anrede: STRING, titel: STRING, vorname: STRING, nachname: STRING, name: STRING,"
    " email: STRING, mail: STRING, telefon: STRING, telefonnummer: STRING,"
    " tel: STRING, rufnummer: STRING>"
)

# The text view of one ad, fetched separately for the agency feed.
DETAIL = f"""
    referenznummer STRING, stellenangebotsBeschreibung STRING, stellenbeschreibung STRING,
    verguetung STRING, tarifvertrag STRING, arbeitgeber STRING, externeURL STRING,
    homeofficetyp STRING, homeofficemoeglich BOOLEAN,
    arbeitsorte ARRAY<STRUCT<plz: STRING, ort: STRING>>,
    kontakt {_CONTACT}, ansprechpartner {_CONTACT}, arbeitgeberKontakt {_CONTACT}
"""

SEEN = (
    "referenznummer STRING, titel STRING, status STRING, erfasst_am BIGINT,"
    " geaendert_am BIGINT, ablauf_zeitpunkt BIGINT"
)
CLAIM = "fp STRING, zuerst_gesehen_als STRING, erfasst_am BIGINT, ablauf_zeitpunkt BIGINT"
CATALOG = "pos INT, category STRING, label STRING, pattern STRING"
CITIES = "pos INT, name STRING, lat DOUBLE, lon DOUBLE"
ENRICHMENT = (
    "alter_tage INT, entfernung_km DOUBLE, stufe STRING, punkte INT,"
    " treffer ARRAY<STRING>, luecken ARRAY<STRING>, schwerpunkte ARRAY<STRING>"
)
PROFILE = (
    "faehigkeiten MAP<STRING, INT>, eigene ARRAY<STRING>, ausgeschlossen ARRAY<STRING>,"
    " quellen ARRAY<STRING>"
)
MESSAGE = "key STRING, value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

_LEVEL = "STRUCT<id: INT, bezeichnung: STRING>"
SALARY = (
    f"kldb STRING, region {_LEVEL}, branche {_LEVEL}, ageCategory {_LEVEL}, gender {_LEVEL},"
    f" performanceLevel {_LEVEL}, entgelt INT, entgeltQ25 INT, entgeltQ75 INT, besetzung INT"
)
