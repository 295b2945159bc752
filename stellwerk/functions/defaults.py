"""Default catalogs.

Callers bring their own catalogs as tables; these defaults name common technologies,
benefits and cities.  A catalog row lists spellings, and the pattern follows from them:

* ``java``      the whole word, any case
* ``agil*``     a word that starts like this
* ``=Rust``     the whole word in exactly this case
* ``/regex/``   a pattern as it stands
* a ``-`` stands for a hyphen, a blank or nothing
"""

from __future__ import annotations

import itertools
import re

from stellwerk.functions.catalog import Catalog, Entry


def _pattern(spelling: str) -> str:
    if spelling.startswith("/"):
        return spelling.strip("/")
    exact = spelling.startswith("=")
    start = spelling.endswith("*")
    body = spelling.strip("=*")
    body = "[- ]?".join(re.sub(r"([.+#])", r"\\\1", part) for part in body.split("-"))
    head = r"\b" if body[0].isalnum() else ""
    tail = r"\b" if body[-1].isalnum() and not start else ""
    whole = head + body + tail
    return f"(?-i:{whole})" if exact else whole


def _catalog(text: str) -> Catalog:
    entries = []
    category = ""
    for line in filter(None, map(str.strip, text.splitlines())):
        if line.startswith("# "):
            category = line[2:]
            continue
        label, _, spellings = line.partition(":")
        names = [s.strip() for s in spellings.split(";")] if spellings else [label.lower()]
        pattern = "|".join(_pattern(s) for s in names)
        entries.append(Entry(category, label.strip(), pattern))
    return Catalog(tuple(entries))


SKILLS = _catalog(
    r"""
    # Arbeitsweise
    Agile Arbeitsweise: agil*; kanban; safe
    Anforderungsanalyse: anforderungsanalyse*; fachkonzept*; requirements-engineering
    Datenschutz: datenschutz; dsgvo; gdpr
    DevOps
    Jira: jira; confluence
    Scrum: scrum; sprint
    Softwarearchitektur: softwarearchitektur*; architekturentwurf*; clean-code; verteilte-systeme
    # Qualität
    Code Review: code-review*; pull-request*; merge-request*
    JUnit
    Playwright: playwright; cypress
    Selenium
    Testautomatisierung: testautomat*; test-automation; automatisierte-tests
    Unit-Tests: unit-test; unit-tests; modultest; modultests; tdd
    # Betrieb
    AWS: aws; amazon-web-services
    Azure
    CI/CD: /\bci ?[\/-]? ?cd\b/; continuous-integration; continuous-delivery
    Docker: docker; container
    GCP: gcp; google-cloud
    Git: git; versionsverwaltung
    GitHub
    GitLab
    Jenkins
    Kubernetes: kubernetes; k8s; openshift
    Linux: linux; unix
    Monitoring: monitoring; logging; observability; grafana; prometheus
    Serverless: serverless; lambda; cloud-functions
    Terraform: terraform; iac; infrastructure-as-code
    # Datenbanken
    DynamoDB
    Elasticsearch: elasticsearch; opensearch
    MongoDB: mongodb; mongo
    MySQL: mysql; mariadb
    Oracle
    PostgreSQL: postgres*
    Redis
    # Daten
    Airflow
    BigQuery
    Databricks
    Data Warehouse: data-warehouse*; data-lake*; dwh; lakehouse
    dbt
    ETL: etl; elt; data-pipeline*; datenpipeline*
    Kafka
    Machine Learning: machine-learning; deep-learning; maschinelles-lernen; ml-modell*
    Pandas: pandas; numpy
    Power BI: power-bi
    Snowflake
    Spark: spark; pyspark
    SQL
    Tableau
    # Programmieren
    Bash: bash; powershell; shell-skript*
    C#: c#; c-sharp; dotnet; /\B\.net\b/
    C++: c++
    Go: /(?-i:\bGo\b)(?!\W*live)/; golang
    Java
    JavaScript: javascript; ecmascript
    Kotlin
    PHP
    Python
    R: /(?-i:\bR\b) ?(?:,|\/|und) ?python\b/; r-studio
    Rust: =Rust
    Scala
    TypeScript
    # Bausteine
    Angular
    Django
    FastAPI
    Gradle
    GraphQL
    Hibernate: hibernate; jpa
    Maven
    Microservices: microservice*; mikroservice*
    Node.js: node; node.js
    React
    REST-APIs: rest; restful; api-entwicklung
    Spring: spring; spring-boot
    Vue: vue; vue.js
    # Sprachen
    Deutsch: deutsch; deutschkenntnisse
    Englisch: englisch; englischkenntnisse; english
    """
)

_UMLAUTS = {"ä": ("ae", "ä", "a"), "ö": ("oe", "ö", "o"), "ü": ("ue", "ü", "u")}


def _spellings(text: str) -> str:
    """Every spelling of every umlaut: texts come with and without them."""
    choices = [_UMLAUTS.get(c, (c,)) for c in text]
    return "|".join("".join(letters) for letters in itertools.product(*choices))


def _benefits(rows: tuple[tuple[str, str], ...]) -> Catalog:
    return Catalog.of(
        ("benefit", label, "|".join(_spellings(p.strip()) for p in parts.split("|")))
        for label, parts in rows
    )


BENEFITS = _benefits(
    (
        ("Altersvorsorge", r"altersvorsorge|\bbav\b"),
        ("Auszeit", "sabbatical|sabbatjahr"),
        ("Dienstrad", "jobrad|job-rad|dienstrad|bikeleasing|bike-leasing|fahrradleasing"),
        ("Dienstwagen", "dienstwagen|firmenwagen|firmenfahrzeug"),
        ("Fahrkarte", r"jobticket|job-ticket|deutschlandticket|fahrkarte|fahrtkostenzuschuss|\böpnv"),
        ("Feste", "firmenevent|teamevent|betriebsausflug|sommerfest|weihnachtsfeier"),
        ("Flexible Zeiten", "gleitzeit|flexible arbeitszeit|arbeitszeitkonto|vertrauensarbeitszeit"),
        ("Fortbildung", "fortbildung|weiterbildung|weiterentwicklung|schulungsbudget|zertifizierung"),
        ("Gesundheit", "betriebssport|gesundheitskurs|gesundheitsförderung|fitnessstudio|urban sports|wellpass|hansefit"),
        ("Kinder", "kindergarten|kinderbetreuung|betriebskita|kitaplatz|kita-platz|kitazuschuss"),
        ("Mittagstisch", "kantine|betriebsrestaurant|essenszuschuss|essensgeld|kostenlose getränke"),
        ("Ohne Frist", "unbefristet"),
        ("Parkplatz", "parkplatz|parkplätze"),
        ("Rabatte", "mitarbeiterrabatt|personalrabatt|corporate benefits|mitarbeitervergünstigung"),
        ("Sonderzahlung", r"prämie|weihnachtsgeld|urlaubsgeld|sonderzahlung|gewinnbeteiligung|\bbonus|\b13\. ?monatsgehalt"),
        ("Tarif", r"tarifvertrag|\btvöd|\btv-l\b|nach tarif"),
        ("Teilzeit", "teilzeit"),
        ("Umzug", "umzugshilfe|umzugskosten|relocation"),
        ("Urlaub ab 30 Tagen", r"\b[3-9]\d (?:tage )?urlaub"),
        ("Vermögensbildung", r"vermögenswirksame leistungen|\bvwl\b"),
    )
)

# Cities and towns by size, then the surroundings of Hamburg: name, latitude, longitude.  The first
# that fits a short name wins.
_CITIES = """
    berlin 52.52 13.40; hamburg 53.55 9.99; münchen 48.14 11.58; köln 50.94 6.96; frankfurt am main 50.11 8.68;
    stuttgart 48.78 9.18; düsseldorf 51.23 6.77; leipzig 51.34 12.37; dortmund 51.51 7.47; essen 51.46 7.01;
    bremen 53.08 8.80; dresden 51.05 13.74; hannover 52.37 9.73; nürnberg 49.45 11.08; duisburg 51.43 6.76;
    bochum 51.48 7.22; wuppertal 51.26 7.15; bielefeld 52.02 8.53; bonn 50.73 7.10; münster 51.96 7.63;
    mannheim 49.49 8.47; karlsruhe 49.01 8.40; augsburg 48.37 10.90; wiesbaden 50.08 8.24; mönchengladbach 51.19 6.44;
    gelsenkirchen 51.52 7.09; aachen 50.78 6.08; braunschweig 52.27 10.52; chemnitz 50.83 12.92; kiel 54.32 10.14;
    halle 51.48 11.97; magdeburg 52.13 11.63; freiburg im breisgau 48.00 7.85; krefeld 51.33 6.56; mainz 50.00 8.27;
    lübeck 53.87 10.69; erfurt 50.98 11.03; oberhausen 51.47 6.85; rostock 54.09 12.10; kassel 51.31 9.48;
    hagen 51.36 7.47; potsdam 52.40 13.06; saarbrücken 49.24 7.00; hamm 51.68 7.82; ludwigshafen am rhein 49.48 8.44;
    oldenburg 53.14 8.21; mülheim an der ruhr 51.43 6.88; osnabrück 52.28 8.05; leverkusen 51.03 6.98; heidelberg 49.41 8.69;
    darmstadt 49.87 8.65; solingen 51.17 7.08; regensburg 49.02 12.10; herne 51.54 7.22; paderborn 51.72 8.75;
    neuss 51.20 6.69; ingolstadt 48.76 11.42; offenbach am main 50.10 8.77; fürth 49.48 10.99; ulm 48.40 9.99;
    würzburg 49.79 9.95; heilbronn 49.14 9.22; pforzheim 48.89 8.70; wolfsburg 52.42 10.79; göttingen 51.53 9.93;
    bottrop 51.52 6.92; reutlingen 48.49 9.21; koblenz 50.36 7.59; erlangen 49.60 11.00; bremerhaven 53.55 8.58;
    remscheid 51.18 7.19; recklinghausen 51.61 7.20; bergisch gladbach 50.99 7.13; jena 50.93 11.59; trier 49.76 6.64;
    salzgitter 52.15 10.33; moers 51.45 6.64; siegen 50.87 8.02; hildesheim 52.15 9.95; gütersloh 51.91 8.38;
    cottbus 51.76 14.33; kaiserslautern 49.44 7.77; witten 51.44 7.34; schwerin 53.63 11.41; esslingen am neckar 48.74 9.31;
    ludwigsburg 48.90 9.19; gera 50.88 12.08; iserlohn 51.37 7.70; düren 50.80 6.48; flensburg 54.78 9.44;
    zwickau 50.72 12.50; tübingen 48.52 9.06; villingen-schwenningen 48.06 8.49; ratingen 51.30 6.85; lünen 51.62 7.53;
    konstanz 47.66 9.18; worms 49.63 8.36; marburg 50.81 8.77; minden 52.29 8.92; bamberg 49.89 10.89;
    bayreuth 49.95 11.58; dessau-roßlau 51.84 12.24; wolfenbüttel 52.16 10.53; celle 52.62 10.08; gießen 50.58 8.68;
    norderstedt 53.70 10.00; pinneberg 53.66 9.80; wedel 53.58 9.70; ahrensburg 53.67 10.23; reinbek 53.52 10.25;
    geesthacht 53.43 10.38; elmshorn 53.75 9.65; buxtehude 53.47 9.69; stade 53.60 9.47; buchholz in der nordheide 53.33 9.87;
    seevetal 53.39 10.03; winsen 53.36 10.21; lüneburg 53.25 10.41; henstedt-ulzburg 53.79 9.98; quickborn 53.73 9.90;
    schenefeld 53.60 9.82; glinde 53.54 10.21; bargteheide 53.73 10.26; tornesch 53.70 9.72; uetersen 53.69 9.66;
    halstenbek 53.63 9.85; rellingen 53.65 9.82; barsbüttel 53.57 10.18; wentorf 53.49 10.25
"""
CITIES = tuple(
    (pos, name, float(lat), float(lon))
    for pos, (name, lat, lon) in enumerate(city.strip().rsplit(" ", 2) for city in _CITIES.split(";"))
)
