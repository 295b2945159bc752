"""The queries in SQL, for a second engine to check the results.

Written against the same tables with plain joins, windows and list functions.  Regular
expressions there know neither look-ahead nor back-references, and their word classes
are ASCII, so patterns are stated with explicit letter classes.
"""

from __future__ import annotations

import re

from stellwerk import fixed
from stellwerk.functions import contact
from stellwerk.functions.defaults import BENEFITS
from stellwerk.functions.terms import STOP_WORDS
from stellwerk.plans.tables import CATALOG, PROFILE

_WORD = r"\p{L}\p{N}_"


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _re(pattern: str, caseless: bool = True) -> str:
    """A pattern of the library as a literal, word characters spelled out."""
    inside = re.sub(r"\[([^\]]*)\\w", lambda m: f"[{m[1]}{_WORD}", pattern)
    outside = inside.replace(r"\w", f"[{_WORD}]")
    return _q(("(?i)" if caseless else "") + outside)


# --- views ---------------------------------------------------------------------

_TITLE = """
    CASE p_brand WHEN 'Brand#1' THEN 'Senior ' WHEN 'Brand#2' THEN 'Team Lead '
        WHEN 'Brand#3' THEN 'Junior ' WHEN 'Brand#4' THEN 'Consultant ' ELSE '' END
    || p_name ||
    CASE p_size % 3 WHEN 0 THEN ' (m/w/d)' WHEN 1 THEN ' (w/m/d)' ELSE '' END
"""
_EMPLOYER = """
    CASE WHEN c_mktsegment = 'MACHINERY' AND c_nationkey % 4 = 3 THEN 'NTT DATA Deutschland SE'
        WHEN c_mktsegment = 'BUILDING' THEN ''
        ELSE c_mktsegment || CASE c_nationkey % 4 WHEN 0 THEN ' GmbH' WHEN 1 THEN ' AG'
            WHEN 2 THEN ' GmbH & Co. KG' ELSE '' END END
"""
_PLACE = "n_name || CASE c_nationkey % 2 WHEN 0 THEN ', Deutschland' ELSE '' END"

ADS = f"""
ads AS (
    SELECT doc_id, 'd' || doc_id AS ref,
        CASE WHEN source = 'src0' THEN 'arbeitsagentur' ELSE source END AS quelle,
        {_TITLE} AS titel, {_EMPLOYER} AS firma, {_PLACE} AS ort,
        CAST(10000 + p_size AS VARCHAR) AS plz,
        CAST(o_orderdate AS DATE) AS tag, p_type, p_brand, p_size, c_nationkey,
        o_orderstatus, o_orderpriority,
        text || chr(10) || concat_ws(chr(10),
            CASE p_type WHEN 'ECONOMY' THEN 'Wir arbeiten zu 100 % remote.'
                WHEN 'SMALL' THEN (p_size % 6) || ' Tage pro Woche Homeoffice.'
                WHEN 'MEDIUM' THEN 'Ein hybrides Arbeitsmodell erwartet Sie.'
                WHEN 'PROMO' THEN 'Mobiles Arbeiten nach Absprache.'
                WHEN 'STANDARD' THEN 'Es gilt Präsenzpflicht.' ELSE '' END,
            CASE p_size % 5 WHEN 0 THEN 'Unbefristet, 30 Tage Urlaub, Jobticket.'
                WHEN 1 THEN 'Betriebliche Altersvorsorge und Weiterbildung.'
                WHEN 2 THEN 'Jobrad, Kantine, Vermoegenswirksame Leistungen.'
                WHEN 3 THEN 'Gleitzeit und Prämie.' ELSE '' END,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'Gehalt 55.000 - 65.000 EUR.'
                WHEN '2-HIGH' THEN 'Ab 48.500 € brutto.' WHEN '3-MEDIUM' THEN 'Entgelt TVöD E 13.'
                WHEN '4-NOT SPECIFIED' THEN 'Entgeltgruppe 11.' ELSE '' END,
            CASE o_orderstatus
                WHEN 'P' THEN 'Ansprechpartnerin: Frau Dr. ' || upper(substr(noun, 1, 1))
                    || substr(noun, 2) || ', Tel. +49 40 ' || lpad(CAST(doc_id AS VARCHAR), 7, '0')
                WHEN 'F' THEN 'Ihr Ansprechpartner ist Herr ' || upper(substr(adj, 1, 1))
                    || substr(adj, 2) || '.'
                WHEN 'O' THEN 'Bewerbung an jobs' || doc_id || '@example.com.' ELSE '' END
        ) AS beschreibung,
        CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(p_size AS DOUBLE) END AS entfernung,
        'https://jobs.example/' || doc_id AS url,
        CASE WHEN p_size % 10 = 0 THEN CAST(p_size * 2 AS DOUBLE) END AS prozent,
        CASE WHEN p_brand = 'Brand#5' THEN 'IG Metall' END AS tarif
    FROM documents
    JOIN orders ON o_orderkey = doc_id
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN (SELECT *, split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun
          FROM part) ON p_partkey = doc_id
)"""


def _normal(x: str) -> str:
    no_suffix = rf"regexp_replace({x}, '\s*\((m/w/d|w/m/d)\)', ' ', 'g')"
    letters = rf"regexp_replace({no_suffix}, '[^{_WORD}\s]', ' ', 'g')"
    return rf"trim(lower(regexp_replace({letters}, '\s+', ' ', 'g')))"


_EMPLOYER_FORM = _normal(
    r"regexp_replace(firma, '(?i)\b(gmbh|ag|se|co\.?\s*kg|co|kg|deutschland)\b\.?', ' ', 'g')"
)
_PLACE_FORM = _normal("split_part(ort, ',', 1)")
_TITLE_FORM = _normal("titel")
_CLAIM = f"""CASE WHEN {_EMPLOYER_FORM} <> '' AND {_TITLE_FORM} <> '' THEN
    'fp#' || substr(sha256({_EMPLOYER_FORM} || '|' || {_TITLE_FORM} || '|' || {_PLACE_FORM}), 1, 24)
    END"""

POSTINGS = f"""
postings AS (
    SELECT event_id AS seq, ts, CAST(ts AS DATE) AS tag, event_type || ':' || user_id AS ref,
        event_type AS quelle, titel, firma, ort, p_type, p_brand, {_CLAIM} AS fp
    FROM events JOIN (
        SELECT c_custkey, {_TITLE} AS titel, {_EMPLOYER} AS firma, {_PLACE} AS ort, p_type, p_brand
        FROM customer JOIN part ON p_partkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
    ) ON c_custkey = user_id
)"""

_WHOLE = (
    "concat_ws(chr(10), titel, p_type, p_type, p_brand,"
    r" nullif(trim(beschreibung, chr(10) || ' '), ''))"
)


def _labels(tokens: str, text: str) -> str:
    cases = []
    for e in CATALOG:
        if e.whole_words:
            test = f"list_has_any({tokens}, {_list(e.whole_words)})"
        else:
            test = f"regexp_matches({text}, {_q('(?i)' + e.pattern)})"
        cases.append(f"CASE WHEN {test} THEN {_q(e.label)} END")
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def _tokens(text: str) -> str:
    return f"string_split_regex(lower({text}), '[^{_WORD}]+')"


LABELLED = f"""
texts AS (SELECT *, {_WHOLE} AS whole FROM ads),
split AS (
    SELECT *, list_distinct({_tokens("whole")}) AS words, list_distinct({_tokens("titel")}) AS tw
    FROM texts
),
labelled AS (
    SELECT *, {_labels("words", "whole")} AS labels, {_labels("tw", "titel")} AS title_labels
    FROM split
)"""
_SKILLS = _list(PROFILE.skills)
_FOCUS = _list(PROFILE.focus)

RATED = f"""
weights AS (
    SELECT *, list_filter(labels, lambda x: list_contains({_SKILLS}, x)) AS hit_list,
        list_filter(labels, lambda x: NOT list_contains({_SKILLS}, x)) AS gap_list,
        list_filter(title_labels, lambda x: list_contains({_SKILLS}, x)) AS title_hits
    FROM labelled
),
scores AS (
    SELECT *, CASE WHEN len(labels) < 3 THEN 0 ELSE CAST(round_even(
        100.0 * (len(hit_list) + 2 * len(title_hits)) / (len(labels) + 2 * len(title_labels) + 5),
        0) AS INTEGER) END AS score
    FROM weights
),
rated AS (
    SELECT *, CASE WHEN len(labels) < 3 THEN '{fixed.GRADE_D}' WHEN score >= 55
        THEN '{fixed.GRADE_A}' WHEN score >= 35 THEN '{fixed.GRADE_B}'
        ELSE '{fixed.GRADE_C}' END AS grade,
        CASE WHEN len(labels) < 3 THEN list_sort(title_hits) ELSE hit_list END AS hits,
        CASE WHEN len(labels) < 3 THEN [] ELSE gap_list END AS gaps
    FROM scores
)"""


def _shown(x: str) -> str:
    return (
        f"CASE WHEN len({x}) > 10 THEN array_to_string({x}[1:10], ', ') || ' (+' ||"
        f" (len({x}) - 10) || ')' ELSE array_to_string({x}, ', ') END"
    )


_STARRED = (
    f"list_transform(hits, lambda x: CASE WHEN list_contains({_FOCUS}, x) THEN x || '*' ELSE x END)"
)
_POINTS = f"CASE WHEN grade <> '{fixed.GRADE_D}' THEN score END"
_STATUS = """CASE WHEN toxic = 1 THEN 'UNINTERESSANT' WHEN o_orderstatus = 'F' THEN 'ABSAGE'
    WHEN o_orderstatus = 'O' AND quality = 1 THEN 'ZUSAGE' WHEN o_orderstatus = 'O'
    THEN 'INTERVIEW' WHEN quality = 1 THEN 'BEWORBEN' ELSE 'GEFUNDEN' END"""


def _status_text(x: str) -> str:
    cases = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in fixed.STATUS_TEXT.items())
    return f"CASE {x} {cases} ELSE {x} END"


def _with(*views: str, select: str) -> str:
    return "WITH " + ",".join(views) + "\n" + select


def _trend(select: str) -> str:
    return _with(ADS, LABELLED, select=select)


def _rated(select: str) -> str:
    return _with(ADS, LABELLED, RATED, select=select)


def _count_of(condition: str) -> str:
    return f"""SELECT label, count(*) AS ads FROM (SELECT unnest(labels) AS label FROM labelled)
        WHERE {condition} GROUP BY label"""


_IN_PROFILE = f"list_contains({_SKILLS}, label)"
_SHARE = "ads / (SELECT count(*) FROM ads) AS share"


def _term_reason(text: str, terms) -> str:
    cases = []
    for term in terms:
        escaped = re.sub(r"([+.])", r"\\\1", term)
        cases.append(f"WHEN regexp_matches(lower({text}), {_q(r'\b' + escaped)}) THEN {_q(term)}")
    return f"CASE {' '.join(cases)} END"


_TITLE_REASON = _term_reason("titel", fixed.EXCLUDED_TERMS)
_EMPLOYER_REASON = _term_reason("firma", fixed.EXCLUDED_EMPLOYERS)
_REJECTED = (
    f"coalesce({_EMPLOYER_REASON}, "
    + _term_reason("concat_ws(' ', titel, p_type, p_type, p_brand)", fixed.EXCLUDED_TERMS)
    + ") IS NOT NULL"
)

OUTCOMES = f"""
by_ref AS (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY seq) AS nr FROM postings),
by_fp AS (
    SELECT seq, row_number() OVER (PARTITION BY fp ORDER BY seq) AS nf FROM by_ref
    WHERE nr = 1 AND fp IS NOT NULL
),
outcomes AS (
    SELECT by_ref.seq, ref, CASE WHEN nr > 1 THEN 'bekannt' WHEN nf > 1 THEN 'doppelt'
        WHEN {_REJECTED} THEN 'aussortiert' ELSE 'weitergereicht' END AS outcome
    FROM by_ref LEFT JOIN by_fp ON by_fp.seq = by_ref.seq
)"""

DAYS = """
per_day AS (
    SELECT * FROM postings QUALIFY row_number() OVER (PARTITION BY ref, tag ORDER BY seq DESC) = 1
)"""

_ORDER_FOUND = "CAST(epoch(o_orderdate) AS BIGINT)"
ENTRIES = f"""
entries AS (
    SELECT 'o' || o_orderkey AS ref,
        'Order ' || o_orderkey || ' with priority ' || o_orderpriority
            || ' for customer number ' || o_custkey AS titel,
        CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'BEWORBEN'
            WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'INTERVIEW'
            WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'UNINTERESSANT'
            WHEN o_orderstatus = 'F' THEN 'ABSAGE'
            WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'ZUSAGE'
            WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'ARCHIVIERT'
            ELSE 'GEFUNDEN' END AS status,
        {_ORDER_FOUND} AS found,
        CASE WHEN o_custkey % 2 = 0 THEN {_ORDER_FOUND} + 86400 * (o_custkey % 30) END AS changed,
        CASE WHEN o_custkey % 5 <> 0 THEN {_ORDER_FOUND} + 86400 * 180 END AS expires
    FROM orders
)"""
_AS_OF_1999 = "CAST(epoch(TIMESTAMP '1999-01-01') AS BIGINT)"


def _ellipsis(x: str, width: int) -> str:
    return f"CASE WHEN length({x}) > {width} THEN substr({x}, 1, {width - 3}) || '...' ELSE {x} END"


def _squeezed(x: str) -> str:
    return rf"nullif(trim(regexp_replace({x}, '\s+', ' ', 'g')), '')"


def _extract(x: str, pattern: str, group: int = 0, caseless: bool = False) -> str:
    return _squeezed(f"regexp_extract({x}, {_re(pattern, caseless)}, {group})")


def _contact(x: str) -> str:
    person = (
        f"coalesce({_extract(x, contact.NAMED_CONTACT, 1)}, {_extract(x, contact.SALUTATION)})"
    )
    address = (
        f"concat_ws(' / ', {_extract(x, contact.EMAIL)}, {_extract(x, contact.PHONE)})"
    )
    return f"concat_ws(' · ', {person}, nullif({address}, ''))"


def _pay(x: str) -> str:
    found = [
        _extract(x, p, 0, True) for p in (contact.PAY_RANGE, contact.PAY_AMOUNT, contact.PAY_GRADE)
    ]
    return f"coalesce({', '.join(found)}, '')"


def _work(x: str) -> str:
    days = " || ".join(f"regexp_extract({x}, {_re(fixed.DAYS_PHRASES)}, {i})" for i in (1, 2))
    match = lambda p: f"regexp_matches({x}, {_re(p)})"
    return f"""CASE WHEN {match(fixed.ON_SITE_PHRASES)} THEN 'vor Ort'
        WHEN {match(fixed.REMOTE_PHRASES)} THEN '100 % remote'
        WHEN {days} = '1' THEN 'hybrid, 1 Tag/Woche'
        WHEN {days} IN ('2', '3', '4') THEN 'hybrid, ' || {days} || ' Tage/Woche'
        WHEN {days} <> '' THEN '100 % remote'
        WHEN {match(fixed.HYBRID_PHRASES)} THEN 'hybrid, Umfang offen'
        WHEN {match(fixed.POSSIBLE_PHRASES)} THEN 'möglich, Umfang offen' ELSE '' END"""


def _work_model(x: str) -> str:
    return f"""coalesce(
        CASE WHEN prozent >= 100 THEN '100 % remote' WHEN prozent > 0
            THEN 'hybrid, ' || CAST(floor(prozent) AS INTEGER) || ' % Homeoffice' END,
        nullif({_work(x)}, ''),
        CASE WHEN o_orderstatus = 'F' THEN 'nach Vereinbarung'
            WHEN o_orderstatus = 'O' THEN 'möglich, Umfang offen' END, '')"""


_BENEFITS = "array_to_string(list_filter([{}], lambda x: x IS NOT NULL), ', ')".format(
    ", ".join(
        f"CASE WHEN regexp_matches(beschreibung, {_re(e.pattern)}) THEN {_q(e.label)} END"
        for e in BENEFITS
    )
)
_DISTANCE = """round(coalesce(entfernung, 2 * 6371.0 * asin(sqrt(
    power(sin(radians(c_nationkey * 0.3) / 2), 2) + cos(radians(47.0))
    * cos(radians(47.0 + c_nationkey * 0.3)) * power(sin(radians(c_nationkey * 0.35) / 2), 2)))), 1)"""
_AGE = "date_diff('day', tag, DATE '2002-01-01')"
_LINK = """CASE WHEN quelle = 'arbeitsagentur'
    THEN 'https://www.arbeitsagentur.de/jobsuche/jobdetail/' || ref ELSE url END"""
_LOCATION = "plz || ' ' || ort"
_AGENCY_LINK = "'https://www.arbeitsagentur.de/jobsuche/jobdetail/' || ref"


def _batches(view: str, key: str, seq: str, idle: str) -> str:
    return f"""
gaps AS (
    SELECT *, row_number() OVER w AS row_no,
        CASE WHEN ts - lag(ts) OVER w < INTERVAL {idle} THEN 0 ELSE 1 END AS opens
    FROM {view} WINDOW w AS (PARTITION BY {key} ORDER BY ts, {seq})
),
sessions AS (
    SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY ts, {seq}) AS session FROM gaps
),
batched AS (
    SELECT *, row_no - (row_number() OVER (PARTITION BY {key}, session ORDER BY ts, {seq}) - 1)
        % 25 AS batch
    FROM sessions
)"""


_MENTIONS = f"""
tokens AS (
    SELECT text, {_tokens("text")} AS words FROM documents
    WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) >= 200
),
counted AS (
    {" UNION ALL ".join(
        f"SELECT {_q(e.label)} AS label, "
        + (
            f"len(list_filter(words, lambda x: list_contains({_list(e.whole_words)}, x)))"
            if e.whole_words
            else f"len(regexp_extract_all(text, {_q('(?i)' + e.pattern)}))"
        )
        + " AS n FROM tokens"
        for e in CATALOG
    )}
),
mentions AS (
    SELECT label, CAST(sum(n) AS BIGINT) AS n FROM counted GROUP BY label HAVING sum(n) > 0
),
flags AS (
    SELECT unnest({_list([*PROFILE.own, *PROFILE.excluded, "handarbeit"])}) AS label
),
refreshed AS (
    SELECT coalesce(mentions.label, flags.label) AS label, n,
        flags.label IS NOT NULL AND flags.label <> 'and' AS own,
        coalesce(flags.label = 'and', false) AS excluded
    FROM mentions FULL JOIN flags ON flags.label = mentions.label
)"""

_TERM_PATTERN = r"^([a-z]?[A-Z]{2,6}[0-9]{0,2}|[A-Z][a-z]+([A-Z][a-z0-9]+)+)$"
_TERMS = f"""
candidates AS (
    SELECT DISTINCT doc_id, unnest(list_concat(
        list_filter(string_split_regex(text, '[^{_WORD}]+'),
            lambda x: regexp_matches(x, '{_TERM_PATTERN}')),
        list_transform(regexp_extract_all(text,
            '(^|[^{_WORD}])([A-Za-z][A-Za-z0-9]*(\\+\\+|#))($|[^{_WORD}])', 2),
            lambda x: x))) AS term
    FROM documents
),
terms AS (
    SELECT term, count(*) AS ads FROM candidates
    WHERE length(term) >= 2
        AND NOT list_contains({_list(STOP_WORDS)}, replace(replace(upper(term), '.', ''), '-', ''))
        AND NOT list_contains({_list([e.label.casefold() for e in CATALOG])}, lower(term))
        AND NOT list_has_any(string_split_regex(lower(term), '[^{_WORD}]+'),
            {_list([w for e in CATALOG for w in e.whole_words])})
        AND NOT regexp_matches(term, '(?i)^tion')
    GROUP BY term
)"""

# Lists of distances etc. are checked where they are used; details of the archive views:
GATHERED = """
gathered AS (SELECT ads.*, CASE WHEN o_orderstatus = 'F' THEN 'ABSAGE' ELSE 'GEFUNDEN' END AS status
    FROM ads)"""

TABLE_ROWS = f"""
old_rows AS (
    SELECT doc_id AS row_no,
        CASE WHEN quality = 1 AND toxic = 0 THEN ref ELSE '' END AS ref, upper(firma) AS firma,
        titel, CASE WHEN toxic = 0 THEN {_AGENCY_LINK} ELSE '' END AS link, '' AS standort,
        CASE WHEN quality = 1 THEN 'verhandelt' ELSE '' END AS gehalt,
        {_status_text("(" + _STATUS + ")")} AS status, 1.5 AS km, 'Notiz ' || doc_id AS eigenes
    FROM ads JOIN main.labels USING (doc_id)
),
new_rows AS (
    SELECT doc_id AS seq, ref, firma, titel, {_AGENCY_LINK} AS link, {_LOCATION} AS standort,
        coalesce(tarif, '') AS gehalt, '' AS status, entfernung AS km,
        CASE WHEN firma <> '' THEN lower(firma || ' | ' || titel) ELSE '' END AS pair
    FROM ads
),
ref_keys AS (
    SELECT key, min(row_no) AS row_no FROM (
        SELECT ref AS key, row_no FROM old_rows
        UNION ALL SELECT split_part(link, '/', -1), row_no FROM old_rows)
    WHERE key <> '' GROUP BY key
),
pair_keys AS (
    SELECT lower(firma || ' | ' || titel) AS key, min(row_no) AS row_no FROM old_rows
    WHERE firma <> '' GROUP BY 1
),
placed AS (
    SELECT n.*, coalesce(r.row_no, p.row_no) AS target,
        coalesce('r' || coalesce(r.row_no, p.row_no), 'p' || nullif(pair, ''), 'n' || ref) AS place
    FROM new_rows n LEFT JOIN ref_keys r ON r.key = n.ref LEFT JOIN pair_keys p ON p.key = n.pair
),
folded AS (
    SELECT place, min(target) AS target, count(*) AS n,
        arg_max(ref, seq) AS ref, arg_max(firma, seq) FILTER (firma <> '') AS firma,
        arg_max(titel, seq) AS titel, arg_max(link, seq) AS link,
        arg_max(standort, seq) AS standort,
        arg_min(gehalt, seq) FILTER (gehalt <> '') AS gehalt, arg_max(status, seq) AS status,
        arg_max(km, seq) FILTER (km IS NOT NULL) AS km
    FROM placed GROUP BY place
),
merged AS (
    SELECT o.row_no AS "_row", coalesce(f.ref, o.ref) AS "Referenz",
        coalesce(f.firma, o.firma) AS "Firma", coalesce(f.titel, o.titel) AS "Position",
        coalesce(f.link, o.link) AS "Link zur Ausschreibung",
        coalesce(f.standort, o.standort) AS "Standort",
        coalesce(nullif(o.gehalt, ''), f.gehalt, o.gehalt) AS "Gehalt",
        CASE WHEN f.place IS NOT NULL THEN f.status ELSE o.status END AS "Status",
        coalesce(f.km, o.km) AS "Entfernung (km)", o.eigenes AS "Eigenes",
        CASE WHEN o.row_no IS NULL THEN 'neu' WHEN f.place IS NOT NULL THEN 'aktualisiert' END
            AS change,
        CASE WHEN o.row_no IS NULL THEN n - 1 ELSE coalesce(n, 0) END AS updates
    FROM old_rows o FULL JOIN folded f ON f.target = o.row_no
)"""

_CELL = "array_to_string(list_filter([{0}], lambda x: x IS NOT NULL), '{1}')"


def _feed(prio: int, ref: str, source: str, **columns: str) -> str:
    given = {
        "stellenangebotsTitel": "titel", "firma": "firma", "plz": "''",
        "ort": "split_part(ort, ',', 1)", "datum": "CAST(tag AS VARCHAR)",
        "hauptberuf": "p_type", "n_jobs": "2",
        "text": "titel || ' & mehr' || chr(10) || p_type", "url": "url",
        "percent": "CAST(NULL AS INTEGER)", "keep": "true",
        **columns,
    }
    keep = given.pop("keep")
    cells = ", ".join(f"{v} AS {k}" for k, v in given.items())
    return (
        f"SELECT {prio} AS prio, {ref} AS referenznummer, '{source}' AS quelle, {cells}"
        f" FROM ads WHERE {keep}"
    )


_RECENT = "date_diff('day', tag, DATE '1998-06-15') <= 28"
_WANTED = (
    rf"{_RECENT} AND (regexp_matches(lower(titel), '\b(ring|widget)\b')"
    " OR (contains(lower(titel), 'bolt') AND contains(lower(titel), 'senior')))"
)

ORACLE: dict[str, str] = {
    "trend_demand": _trend(f"SELECT *, {_SHARE} FROM ({_count_of('true')})"),
    "trend_gaps": _trend(
        f"SELECT *, {_SHARE} FROM ({_count_of('NOT ' + _IN_PROFILE)} ORDER BY ads DESC, label LIMIT 20)"
    ),
    "trend_covered": _trend(
        f"SELECT *, {_SHARE} FROM ({_count_of(_IN_PROFILE)} ORDER BY ads DESC, label LIMIT 20)"
    ),
    "trend_monthly": _trend(
        "SELECT strftime(tag, '%Y-%m') AS month, label, count(*) AS ads"
        " FROM (SELECT tag, unnest(labels) AS label FROM labelled) GROUP BY ALL"
    ),
    "trend_bars": _trend(f"""
        SELECT *, 100 * share / max(share) OVER () AS width FROM (
            SELECT *, {_SHARE}, 'gaps' AS list FROM (
                {_count_of('NOT ' + _IN_PROFILE)} ORDER BY ads DESC, label LIMIT 8)
            UNION ALL SELECT *, {_SHARE}, 'covered' AS list FROM (
                {_count_of(_IN_PROFILE)} ORDER BY ads DESC, label LIMIT 8))"""),
    "trend_summary": _rated(f"""
        SELECT count(*) AS ads, min(tag) AS first_day, max(tag) AS last_day,
            count(*) FILTER (grade <> '{fixed.GRADE_D}') AS rated,
            count(*) FILTER (grade = '{fixed.GRADE_A}') AS grade_a,
            count(*) >= 10 AS meaningful FROM rated"""),
    "trend_incremental": _trend(f"SELECT *, {_SHARE} FROM ({_count_of('true')})"),
    "trend_history": _trend(
        "SELECT label, {} FROM (SELECT tag, unnest(labels) AS label FROM labelled)"
        " WHERE label IN (SELECT label FROM ({} ORDER BY ads DESC, label LIMIT {})) GROUP BY label"
        " HAVING count(*) > 0".format(
            ", ".join(
                f"count(*) FILTER (strftime(tag, '%Y-%m') = '1996-{m:02}') AS \"1996-{m:02}\""
                for m in range(1, 13)
            ),
            _count_of("true"),
            fixed.HISTORY_ROWS,
        )
    ),
    "catalog_labels": """
        WITH rules AS (
            SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS label FROM benchmark
        ),
        crc AS (
            SELECT label, list_reduce(list_prepend(4294967295::UBIGINT,
                list_transform(string_split(label, ''), lambda c: ord(c)::UBIGINT)),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::UBIGINT)),
                    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)) AS inverted
            FROM rules WHERE length(label) >= 5
        ),
        kinds AS (SELECT label, xor(inverted, 4294967295::UBIGINT) % 3 AS kind FROM crc),
        seen AS (
            SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+')) AS word FROM documents
        ),
        vocabulary AS (SELECT DISTINCT word FROM seen),
        hits AS (
            SELECT word, label FROM vocabulary JOIN kinds ON kind = 0 AND word = label
            UNION ALL
            SELECT word, label FROM vocabulary JOIN kinds ON kind = 1 AND substr(word, 1, 5) = substr(label, 1, 5)
            UNION ALL
            SELECT word, label FROM vocabulary JOIN kinds ON kind = 2 AND contains(word, substr(label, 2, 4))
        ),
        found AS (SELECT DISTINCT doc_id, label FROM seen JOIN hits USING (word))
        SELECT doc_id, count(label)::INTEGER AS n_labels,
            md5(coalesce(string_agg(label, ',' ORDER BY label), '')) AS digest
        FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id""".replace("\\\\", "\\"),
    "unknown_terms": _with(_TERMS, select="SELECT term, ads FROM terms"),
    "report_terms": _with(
        _TERMS,
        select="SELECT term, ads FROM (SELECT * FROM terms ORDER BY ads DESC, term LIMIT 12)"
        " WHERE ads >= 3",
    ),
    "corpus_profile": _with(_MENTIONS, select="SELECT label, n FROM mentions"),
    "profile_refresh": _with(_MENTIONS, select="SELECT label, n, own, excluded FROM refreshed"),
    "profile_skills": _with(
        _MENTIONS,
        select="SELECT label, n, own OR coalesce(n >= 3, false) AS focus FROM refreshed"
        " WHERE NOT excluded",
    ),
    "profile_categories": _with(
        _MENTIONS,
        select="SELECT category, string_agg(label, ', ' ORDER BY pos) AS labels FROM mentions"
        " JOIN (VALUES {}) c(pos, category, label) USING (label) GROUP BY category".format(
            ", ".join(f"({i}, {_q(e.category)}, {_q(e.label)})" for i, e in enumerate(CATALOG))
        ),
    ),
    "silent_documents": r"SELECT doc_id FROM documents"
    r" WHERE length(regexp_replace(text, '^\s+|\s+$', '', 'g')) < 200",
    "match_score": _rated(f"""
        SELECT ref AS referenznummer, grade, {_POINTS} AS points, {_shown(_STARRED)} AS hits,
            {_shown("gaps")} AS gaps FROM rated"""),
    "grade_distribution": _rated("SELECT grade AS stufe, count(*) AS ads FROM rated GROUP BY grade"),
    "score_backtest": _rated(f"""
        SELECT band, count(*) AS applied, count(*) FILTER (status = 'INTERVIEW') AS interview,
            count(*) FILTER (status = 'ZUSAGE') AS offer,
            count(*) FILTER (status = 'ABSAGE') AS rejected,
            count(*) FILTER (status = 'BEWORBEN') AS open,
            round(count(*) FILTER (status IN ('INTERVIEW', 'ZUSAGE')) / nullif(
                count(*) FILTER (status IN ('INTERVIEW', 'ZUSAGE', 'ABSAGE')), 0), 6) AS quota
        FROM (SELECT {_STATUS} AS status, CASE WHEN score >= 70 THEN '70-100'
                WHEN score >= 55 THEN '55-69' WHEN score >= 35 THEN '35-54' ELSE '0-34' END AS band
            FROM rated JOIN main.labels USING (doc_id))
        WHERE status NOT IN ('GEFUNDEN', 'UNINTERESSANT') GROUP BY band""".replace(
        "JOIN main.labels USING", "JOIN main.labels USING"
    )),
    "score_means": _rated(f"""
        SELECT applied, round(ma, 6) AS mean_applied, discarded, round(md, 6) AS mean_discarded,
            answered, coalesce(md > ma, false) AS misleading, answered < 10 AS too_few
        FROM (SELECT count(*) FILTER (ok) AS applied, avg(score) FILTER (ok) AS ma,
                count(*) FILTER (status = 'UNINTERESSANT') AS discarded,
                avg(score) FILTER (status = 'UNINTERESSANT') AS md,
                count(*) FILTER (status IN ('INTERVIEW', 'ZUSAGE', 'ABSAGE')) AS answered
            FROM (SELECT *, status NOT IN ('GEFUNDEN', 'UNINTERESSANT') AS ok
                FROM (SELECT score, {_STATUS} AS status FROM rated JOIN main.labels USING (doc_id))))"""),
    "content_fingerprint": _with(ADS, select=f"""
        SELECT ref AS referenznummer, {_EMPLOYER_FORM} AS employer, {_TITLE_FORM} AS title,
            {_PLACE_FORM} AS place, {_CLAIM} AS claim FROM ads"""),
    "cross_source_dups": _with(POSTINGS, select="""
        SELECT fp, count(*) AS ads, count(DISTINCT quelle) AS sources,
            arg_min(ref, seq) AS first_seen_as
        FROM postings WHERE fp IS NOT NULL GROUP BY fp HAVING count(DISTINCT quelle) > 1"""),
    "claim_outcomes": _with(
        POSTINGS, OUTCOMES, select="SELECT seq, ref AS referenznummer, outcome FROM outcomes"
    ),
    "outcome_counts": _with(
        POSTINGS, OUTCOMES, select="SELECT outcome, count(*) AS ads FROM outcomes GROUP BY outcome"
    ),
    "new_postings": _with(POSTINGS, select=f"""
        , earlier AS (SELECT * FROM postings WHERE tag < DATE '2024-01-10'),
        later AS (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY seq) = 1
                AND ref NOT IN (SELECT ref FROM earlier) AS fresh
            FROM postings WHERE tag >= DATE '2024-01-10'),
        fps AS (SELECT seq, row_number() OVER (PARTITION BY fp ORDER BY seq) = 1 AND fp NOT IN
                (SELECT fp FROM earlier WHERE fp IS NOT NULL) AS first
            FROM later WHERE fresh AND fp IS NOT NULL)
        SELECT later.seq, CASE WHEN NOT fresh THEN 'bekannt' WHEN NOT first THEN 'doppelt'
            WHEN {_REJECTED} THEN 'aussortiert' ELSE 'weitergereicht' END AS outcome
        FROM later LEFT JOIN fps ON fps.seq = later.seq"""),
    "two_key_dedup": """
        WITH RECURSIVE items AS (
            SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey,
                    l_suppkey, l_extendedprice) AS seq,
                'p' || l_partkey AS ref,
                CASE WHEN l_returnflag <> 'N' THEN 's' || l_suppkey END AS fp,
                l_orderkey, l_linenumber
            FROM lineitem
        ),
        rounds AS (
            SELECT seq, ref, fp, false AS won, 0 AS round FROM items
            UNION ALL
            SELECT seq, ref, fp, won, round FROM (
                SELECT *, bool_or(won) OVER (PARTITION BY ref) OR (fp IS NOT NULL
                    AND bool_or(won) OVER (PARTITION BY fp)) AS taken
                FROM (
                    SELECT seq, ref, fp, round + 1 AS round,
                        seq = min(seq) OVER (PARTITION BY ref) AND (fp IS NULL
                            OR seq = min(seq) OVER (PARTITION BY fp)) AS won
                    FROM rounds WHERE NOT won
                )
            ) WHERE won OR NOT taken
        )
        SELECT items.ref AS referenznummer, items.fp, l_orderkey, l_linenumber
        FROM items JOIN rounds ON rounds.seq = items.seq AND won""",
    "two_key_chain": """
        WITH linked AS (
            SELECT o_orderkey AS seq, 'p' || o_orderkey // 2 AS ref,
                CASE WHEN o_orderkey % 10007 <> 0 THEN 's' || (o_orderkey + 1) // 2 END AS fp
            FROM orders
        ),
        chains AS (
            SELECT *, sum(CASE WHEN lag_ref = ref OR lag_fp = fp THEN 0 ELSE 1 END) OVER (ORDER BY seq) AS chain
            FROM (SELECT *, lag(ref) OVER (ORDER BY seq) AS lag_ref, lag(fp) OVER (ORDER BY seq) AS lag_fp
                FROM linked)
        )
        SELECT seq, ref AS referenznummer, fp FROM chains
        QUALIFY row_number() OVER (PARTITION BY chain ORDER BY seq) % 2 = 1""",
    "exclusion_reasons": _with(ADS, select=f"""
        SELECT reason, count(*) AS entries FROM (
            SELECT coalesce({_TITLE_REASON}, {_EMPLOYER_REASON}) AS reason FROM ads
            WHERE o_orderstatus <> 'F') WHERE reason IS NOT NULL GROUP BY reason"""),
    "archive_days": _with(
        POSTINGS, DAYS, select="SELECT ref AS referenznummer, tag, seq FROM per_day"
    ),
    "archive_first_seen": _with(POSTINGS, DAYS, select="""
        SELECT ref AS referenznummer, tag, seq, titel AS "stellenangebotsTitel" FROM per_day
        QUALIFY row_number() OVER (PARTITION BY ref ORDER BY tag) = 1"""),
    "archive_since": _with(POSTINGS, DAYS, select="""
        SELECT ref AS referenznummer, tag, seq, titel AS "stellenangebotsTitel" FROM per_day
        WHERE tag >= DATE '2024-01-10'
        QUALIFY row_number() OVER (PARTITION BY ref ORDER BY tag) = 1"""),
    "archive_retention": _with(POSTINGS, DAYS, select="""
        SELECT tag, count(*) AS ads FROM per_day
        WHERE tag >= DATE '2025-01-15' - INTERVAL 365 DAY GROUP BY tag"""),
    "archive_roundtrip": _with(POSTINGS, select="""
        , stored AS (SELECT * FROM postings
            QUALIFY row_number() OVER (PARTITION BY ref, tag ORDER BY seq % 2, seq DESC) = 1)
        SELECT ref AS referenznummer, tag, titel AS "stellenangebotsTitel", quelle FROM stored
        WHERE tag >= DATE '2024-01-10'
        QUALIFY row_number() OVER (PARTITION BY ref ORDER BY tag) = 1"""),
    "landed_details": """
        SELECT CAST(doc_id % 4 AS INTEGER) AS slice, count(*) AS lines,
            count(*) FILTER (doc_id % 50 = 7) AS rejected,
            count(*) FILTER (doc_id % 50 <> 7 AND doc_id % 11 = 3) AS without_ref
        FROM documents GROUP BY 1""",
    "seen_retention": _with(ENTRIES, select=f"""
        SELECT ref AS referenznummer, status, expires AS ablauf_zeitpunkt FROM entries
        WHERE status <> 'GEFUNDEN' OR expires IS NULL OR expires > {_AS_OF_1999}"""),
    "nearest_day_join": _with(POSTINGS, DAYS, select="""
        , wanted AS (SELECT ref, min(tag) + CAST(min(seq) % 4 - 1 AS INTEGER) AS found_day
            FROM postings GROUP BY ref)
        SELECT ref AS referenznummer, found_day, tag, seq FROM wanted LEFT JOIN (
            SELECT w.ref, p.tag, p.seq FROM wanted w JOIN per_day p ON p.ref = w.ref
                AND abs(date_diff('day', w.found_day, p.tag)) <= 1
            QUALIFY row_number() OVER (PARTITION BY w.ref ORDER BY CASE
                date_diff('day', w.found_day, p.tag) WHEN 0 THEN 0 WHEN -1 THEN 1 ELSE 2 END) = 1
        ) USING (ref)"""),
    "detail_fill": """
        SELECT 'd' || doc_id AS referenznummer, md5(CASE WHEN toxic IS NULL THEN lower(text)
            WHEN toxic = 0 THEN text END) AS digest
        FROM documents LEFT JOIN main.labels USING (doc_id)""",
    "missing_details": _with(ADS, select="""
        SELECT ref AS referenznummer FROM ads WHERE quelle = 'arbeitsagentur'
            AND doc_id NOT IN (SELECT doc_id FROM labels)"""),
    "html_text": r"""
        SELECT page_id, array_to_string(list_filter(list_transform(string_split(
            regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html,
                '(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>', ' ', 'g'),
                '(?i)</(p|div|li|tr|h[1-6])\s*>|<br\s*/?>', chr(10), 'g'),
                '<[^>]+>', ' ', 'g'), '&middot;', '·'), '&copy;', '©'), '&quot;', '"'),
                '&amp;?', '&', 'g'), chr(10)),
            lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text
        FROM pages""",
    "work_models": _with(ADS, select=f"""
        SELECT ref AS referenznummer, {_work("beschreibung")} AS from_text,
            {_work_model("beschreibung")} AS model FROM ads"""),
    "benefit_tags": _with(
        ADS, select=f"SELECT ref AS referenznummer, {_BENEFITS} AS benefits FROM ads"
    ),
    "contact_extract": _with(
        ADS, select=f"SELECT ref AS referenznummer, {_contact('beschreibung')} AS contact FROM ads"
    ),
    "stated_details": _with(ADS, select=f"""
        SELECT ref AS referenznummer,
            CASE WHEN quality = 1 THEN 'Frau ' || upper(substr(first, 1, 1)) || lower(substr(first, 2)) || ' Muster · '
                || concat_ws(' / ', CASE WHEN toxic = 0 THEN 'hr' || doc_id || '@firma.example'
                    ELSE {_extract("beschreibung", contact.EMAIL)} END, '040 123')
                ELSE {_contact("beschreibung")} END AS contact,
            CASE WHEN toxic = 1 THEN 'nach Vereinbarung'
                ELSE coalesce('nach Tarifvertrag (' || tarif || ')', {_pay("beschreibung")}) END AS pay,
            base64(encode(ref)) AS encoded, replace(quelle || '/' || ref, '/', '_') AS path
        FROM (SELECT *, split_part(titel, ' ', 1) AS first FROM ads) JOIN main.labels USING (doc_id)"""),
    "document_contacts": f"SELECT doc_id, {_contact('text')} AS contact FROM documents",
    "pay_extract": _with(ADS, select=f"""
        SELECT ref AS referenznummer, {_pay("beschreibung")} AS from_text,
            coalesce('nach Tarifvertrag (' || tarif || ')', {_pay("beschreibung")}) AS pay
        FROM ads"""),
    "age_and_link": _with(ADS, select=rf"""
        SELECT ref AS referenznummer, {_AGE} AS age_days, quelle AS source, {_LINK} AS link,
            {_LOCATION} AS location, coalesce(nullif(firma, ''), 'unbekannt') AS employer,
            CASE WHEN firma <> '' THEN lower(firma || ' | ' || titel) ELSE '' END AS pair,
            length(regexp_replace(beschreibung, '^\s+|\s+$', '', 'g')) AS description_chars
        FROM ads"""),
    "place_distance": _with(
        ADS, select=f"SELECT ref AS referenznummer, {_DISTANCE} AS entfernung_km FROM ads"
    ),
    "feed_normalize": _with(ADS, select=" UNION ALL ".join([
        _feed(0, "ref", "arbeitsagentur", plz="plz", ort="ort", text="''",
              percent="CAST(prozent AS INTEGER)"),
        _feed(1, "'arbeitnow:' || doc_id", "arbeitnow",
              percent="CASE WHEN o_orderstatus = 'P' THEN 100 END",
              keep=f"{_WANTED} AND (o_orderstatus = 'P' OR contains(lower(ort), 'nation_1'))"),
        _feed(2, "'adzuna:' || doc_id", "adzuna", plz="'20095'", n_jobs="1", keep=_WANTED),
        _feed(3, "'remotive:' || doc_id", "remotive", ort="'Europe'", percent="100",
              keep=f"{_RECENT} AND o_orderstatus <> 'F'"),
        _feed(4, "'remoteok:' || doc_id", "remoteok", plz="NULL", ort="NULL", percent="100",
              keep=_WANTED),
        _feed(5, "'jobicy:' || doc_id", "jobicy", percent="100", keep=_WANTED),
    ])),
    "feed_files": _with(ADS, select=f"""
        SELECT 4 AS prio, 'remoteok:' || doc_id AS referenznummer, 'remoteok' AS quelle,
            titel AS "stellenangebotsTitel", firma FROM ads WHERE {_WANTED}
        UNION ALL SELECT 0, ref, 'arbeitsagentur', titel, firma FROM ads WHERE prozent >= 100
        UNION ALL SELECT 6, 'intern:' || doc_id, 'intern', titel, firma FROM ads WHERE {_RECENT}"""),
    "message_roundtrip": _with(POSTINGS, select="""
        SELECT seq, ref AS referenznummer, titel AS "stellenangebotsTitel", fp AS claim
        FROM postings"""),
    "stream_outcomes": _with(
        POSTINGS, OUTCOMES, select="SELECT seq, ref AS referenznummer, outcome FROM outcomes"
    ),
    "stream_digests": _with(_batches("events", "event_type", "event_id", "7200 SECOND").lstrip(),
        select="""
        SELECT event_id, event_type, batch = max(batch) OVER (PARTITION BY event_type)
            AND count(*) OVER (PARTITION BY event_type, batch) < 25
            AND (SELECT max(ts) FROM events) - max(ts) OVER (PARTITION BY event_type, batch)
                < INTERVAL 7200 SECOND AS flushed
        FROM batched"""),
    "stream_forwarded": _with(POSTINGS, OUTCOMES, """
        forwarded AS (SELECT seq, ts, quelle, ref FROM postings SEMI JOIN
            (SELECT seq FROM outcomes WHERE outcome = 'weitergereicht') USING (seq))""",
        _batches("forwarded", "quelle", "seq", "7200 SECOND"), select="""
        SELECT seq, quelle, ref AS referenznummer, batch = max(batch) OVER (PARTITION BY quelle)
            AND count(*) OVER (PARTITION BY quelle, batch) < 25
            AND (SELECT max(ts) FROM forwarded) - max(ts) OVER (PARTITION BY quelle, batch)
                < INTERVAL 7200 SECOND AS flushed
        FROM batched"""),
    "stream_claims": _with(POSTINGS, select=f"""
        , ads_in AS (SELECT *, epoch_us(ts) AS us FROM postings),
        decided AS (SELECT 'view:' || user_id AS ref, event_id AS seq, epoch_us(ts) AS us FROM events
            WHERE event_type = 'purchase' AND event_id % 3 = 0),
        ref_next AS (
            SELECT a.seq, a.ref, a.us, (SELECT arg_min(b.seq, (b.us, b.seq)) FROM ads_in b
                WHERE b.ref = a.ref AND b.us >= a.us + 432000000000) AS next,
                EXISTS (SELECT 1 FROM decided d WHERE d.ref = a.ref AND (d.us, d.seq) > (a.us, a.seq)
                    AND d.us < a.us + 432000000000) AS decided
            FROM ads_in a
        ),
        ref_walk(seq) AS (
            SELECT seq FROM (SELECT ref, arg_min(seq, (us, seq)) AS seq FROM ads_in GROUP BY ref)
            UNION ALL
            SELECT n.next FROM ref_walk w JOIN ref_next n ON n.seq = w.seq WHERE NOT n.decided AND n.next IS NOT NULL
        ),
        fresh AS (SELECT * FROM ads_in SEMI JOIN ref_walk USING (seq)),
        fp_next AS (
            SELECT a.seq, a.fp, (SELECT arg_min(b.seq, (b.us, b.seq)) FROM fresh b
                WHERE b.fp = a.fp AND b.us >= a.us + 432000000000) AS next
            FROM fresh a WHERE a.fp IS NOT NULL
        ),
        fp_walk(seq) AS (
            SELECT seq FROM (SELECT fp, arg_min(seq, (us, seq)) AS seq FROM fresh WHERE fp IS NOT NULL GROUP BY fp)
            UNION ALL
            SELECT n.next FROM fp_walk w JOIN fp_next n ON n.seq = w.seq WHERE n.next IS NOT NULL
        )
        SELECT p.seq, p.ref AS referenznummer, CASE WHEN f.seq IS NULL THEN 'bekannt'
            WHEN p.fp IS NOT NULL AND w.seq IS NULL THEN 'doppelt'
            WHEN {_REJECTED} THEN 'aussortiert' ELSE 'weitergereicht' END AS outcome
        FROM postings p LEFT JOIN (SELECT DISTINCT seq FROM ref_walk) f ON f.seq = p.seq
            LEFT JOIN (SELECT DISTINCT seq FROM fp_walk) w ON w.seq = p.seq""").replace("WITH \npostings", "WITH RECURSIVE \npostings", 1),
    "idle_batches": _with(_batches("events", "event_type", "event_id", "7200 SECOND").lstrip(),
        select="SELECT event_id, event_type, row_no, batch FROM batched"),
    "digest_summary": _with(POSTINGS, _batches("postings", "quelle", "seq", "7200 SECOND"),
        select="""
        SELECT quelle, batch, count(*) AS rows, CASE WHEN min(ort) = max(ort) THEN min(ort)
            ELSE 'Raum Hamburg' END AS place FROM batched GROUP BY quelle, batch"""),
    "digest_lines": _with(
        ADS, LABELLED, RATED,
        "dated AS (SELECT *, CAST(tag AS TIMESTAMP) AS ts FROM rated)",
        _batches("dated", "quelle", "doc_id", "60 SECOND").replace("gaps AS", "gapped AS").replace(
            "FROM gaps", "FROM gapped"
        ),
        select=f"""
        SELECT ref AS referenznummer, quelle, batch, -coalesce({_POINTS}, -1) AS rank,
            concat_ws(' | ', grade, {_POINTS} || ' Punkte',
                'passt: ' || nullif(array_to_string(hits[1:6], ', '), ''),
                'fehlt: ' || nullif(array_to_string(gaps[1:4], ', '), '')) AS rating_line,
            concat_ws(' · ', 'seit ' || {_AGE} || ' Tagen online',
                CAST(entfernung AS INTEGER) || ' km') AS margin_line
        FROM batched"""),
    "status_listing": _with(ENTRIES, select=f"""
        SELECT status, strftime(to_timestamp(found) AT TIME ZONE 'UTC', '%Y-%m-%d') AS found,
            {_ellipsis("titel", 52)} AS titel, ref AS referenznummer FROM entries"""),
    "status_distribution": _with(ENTRIES, select="""
        SELECT status, count(*) AS entries FROM entries WHERE status <> 'UNINTERESSANT'
        GROUP BY status"""),
    "overdue": _with(ENTRIES, select=f"""
        SELECT tage, {_status_text("status")} AS status, {_ellipsis("titel", 50)} AS titel,
            ref AS referenznummer
        FROM (SELECT *, CAST(floor(({_AS_OF_1999} - coalesce(changed, found)) / 86400.0) AS INTEGER)
                AS tage FROM entries WHERE status IN ('BEWORBEN', 'INTERVIEW'))
        WHERE tage >= 14"""),
    "oldest_found": _with(ENTRIES, select="""
        SELECT row_number() OVER (ORDER BY found, ref) AS nr, ref AS referenznummer FROM entries"""),
    "marker_rows": _with(ENTRIES, select="""
        SELECT CASE WHEN changed IS NULL THEN 'GEFUNDEN' ELSE status END AS status, count(*) AS entries
        FROM entries WHERE CAST(substr(ref, 2) AS BIGINT) % 10 <> 3 GROUP BY 1"""),
    "status_updates": _with(ENTRIES, select=f"""
        , moves AS (SELECT 'o' || l_orderkey AS ref,
                CASE WHEN l_linestatus = 'F' THEN 'BEWORBEN' ELSE 'GEFUNDEN' END AS status
            FROM lineitem WHERE l_returnflag = 'R'
            QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC,
                CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END DESC) = 1)
        SELECT e.ref AS referenznummer, coalesce(m.status, e.status) AS status,
            CASE WHEN m.ref IS NULL THEN changed ELSE {_AS_OF_1999} END AS geaendert_am,
            CASE WHEN coalesce(m.status, '') = 'BEWORBEN' THEN NULL ELSE expires END AS ablauf_zeitpunkt
        FROM entries e LEFT JOIN moves m USING (ref)"""),
    "read_back": _with(ENTRIES, select="""
        , cells AS (SELECT 'o' || l_orderkey AS ref, CASE WHEN l_returnflag = 'A'
                THEN 'BEWORBEN' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'ABSAGE'
                WHEN l_returnflag = 'R' THEN NULL ELSE 'GEFUNDEN' END AS chosen
            FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY
                l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                l_extendedprice DESC) = 1)
        SELECT entries.ref AS referenznummer,
            CASE WHEN cells.ref IS NULL OR chosen IS NULL THEN status ELSE chosen END AS status,
            cells.ref IS NOT NULL AND coalesce(chosen <> status, false) AS changed,
            CASE WHEN cells.ref IS NOT NULL AND chosen IS NULL THEN 'Vielleicht' END AS unknown
        FROM entries LEFT JOIN cells ON cells.ref = entries.ref"""),
    "tracker_rows": _rated(f"""
        SELECT ref AS "Referenz", firma AS "Firma", titel AS "Position",
            {_LINK} AS "Link zur Ausschreibung", {_LOCATION} AS "Standort",
            {_work_model("beschreibung")} AS "Homeoffice-Modell",
            coalesce('nach Tarifvertrag (' || tarif || ')', {_pay("beschreibung")}) AS "Gehalt",
            {_BENEFITS} AS "Benefits", {_contact("beschreibung")} AS "Kontakt",
            CASE WHEN o_orderstatus = 'F' THEN 'Absage' ELSE '' END AS "Status",
            quelle AS "Quelle", {_AGE} AS "Alter (Tage)", {_DISTANCE} AS "Entfernung (km)",
            grade AS "Passung", {_POINTS} AS "Punkte", {_shown(_STARRED)} AS "Treffer",
            {_shown("gaps")} AS "Lücken" FROM rated"""),
    "decision_trace": _rated(f"""
        , claimed AS (SELECT *, {_CLAIM} AS fp FROM rated),
        firsts AS (SELECT fp, arg_min(ref, doc_id) AS first FROM claimed WHERE fp IS NOT NULL
            GROUP BY fp)
        SELECT ref AS referenznummer, CASE WHEN o_orderstatus = 'F' THEN 'Absage' ELSE '' END
                AS status_text, titel AS title, quelle AS source, nullif(first, ref) AS duplicate_of,
            {_TITLE_REASON} AS reason, grade, {_POINTS} AS points, {_shown(_STARRED)} AS hits,
            {_shown("gaps")} AS gaps, false AS no_text
        FROM claimed LEFT JOIN firsts USING (fp)"""),
    "tracker_merge": _with(ADS, TABLE_ROWS, select="SELECT * FROM merged"),
    "tracker_counts": _with(ADS, TABLE_ROWS, select="""
        SELECT count(*) FILTER (change = 'neu') AS new, CAST(sum(updates) AS BIGINT) AS updated,
            count(*) FILTER ("Referenz" <> '' AND (
                "Referenz" IN (SELECT ref FROM ads JOIN main.labels USING (doc_id)
                    WHERE """ + _STATUS + """ = 'UNINTERESSANT')
                OR ("Status" = '' AND "Referenz" IN (SELECT ref FROM ads
                    WHERE """ + _TITLE_REASON + """ IS NOT NULL)))) AS removed
        FROM merged"""),
    "tracker_remove": _with(ADS, TABLE_ROWS, select=f"""
        SELECT row_no AS "_row", ref AS "Referenz", status AS "Status" FROM old_rows
        WHERE ref = '' OR NOT (
            ref IN (SELECT ref FROM ads JOIN main.labels USING (doc_id)
                WHERE {_STATUS} = 'UNINTERESSANT')
            OR (status = '' AND ref IN (SELECT ref FROM ads WHERE {_TITLE_REASON} IS NOT NULL)))"""),
    "tracker_rank": _rated(f"""
        SELECT ref AS "Referenz", grade AS "Passung", {_POINTS} AS "Punkte",
            {_status_text("st")} AS "Status", {_AGE} AS "Alter (Tage)", firma AS "Firma",
            row_number() OVER (ORDER BY CASE WHEN st IN ('BEWORBEN', 'INTERVIEW', 'ZUSAGE') THEN 0
                    WHEN st = 'ABSAGE' THEN 2 ELSE 1 END,
                CASE st WHEN 'ZUSAGE' THEN 0 WHEN 'INTERVIEW' THEN 1 WHEN 'BEWORBEN' THEN 2
                    ELSE 0 END,
                grade, coalesce({_POINTS}, -1) DESC, {_AGE}, lower(firma), ref) AS "Nr."
        FROM (SELECT rated.*, {_STATUS} AS st FROM rated LEFT JOIN main.labels USING (doc_id))"""),
    "table_decisions": _with(ADS, TABLE_ROWS, select="""
        SELECT DISTINCT 'wording ' || row_no % 3 AS unknown FROM old_rows WHERE row_no % 7 = 0 AND ref <> ''"""),
    "schema_evolve": _with(ADS, TABLE_ROWS, select="""
        SELECT {}, eigenes AS "Eigenes" FROM old_rows""".format(", ".join(
        {"Status": "status", "Firma": "firma", "Position": "titel", "Gehalt": "gehalt",
         "Referenz": "ref"}.get(c, "CAST(NULL AS VARCHAR)") + f' AS "{c}"'
        for c in (*fixed.COLUMNS_PLAIN, fixed.REF_COLUMN)
    ))),
    "salary_lookup": f"""
        WITH records AS (
            SELECT s_suppkey AS pos,
                {_list(["43412", "43413", "43414", "43212", "43213", "43214"])}[s_suppkey % 6 + 1]
                    AS kldb,
                s_nationkey % 3 AS region_id, n_name AS region, s_suppkey % 4 AS level,
                CAST(trunc(s_acctbal) AS INTEGER) AS pay
            FROM supplier JOIN nation ON n_nationkey = s_nationkey
            WHERE s_suppkey % 2 = 1
        ),
        firsts AS (SELECT * FROM records
            QUALIFY row_number() OVER (PARTITION BY kldb, region_id ORDER BY pos) = 1),
        titles AS (
            SELECT p_partkey, titel, p_size % 3 AS region_id,
                CASE WHEN contains(t, 'consultant') THEN '4321' ELSE '4341' END
                || CASE WHEN contains(t, 'senior') OR contains(t, 'lead') THEN '4'
                    WHEN contains(t, 'junior') THEN '2' ELSE '3' END AS kldb
            FROM (SELECT *, lower(titel) AS t FROM (SELECT *, {_TITLE} AS titel FROM part))
        )
        SELECT kldb, region_id, p_partkey, titel, niveau, region, median, q25, q75, fallzahl
        FROM titles LEFT JOIN (
            SELECT kldb, region_id, 'Niveau ' || level AS niveau, region, pay AS median,
                greatest(pay - 2000, 0) AS q25, greatest(pay + 2000, 0) AS q75,
                CASE WHEN pos % 3 = 0 THEN 0 ELSE pos END AS fallzahl
            FROM firsts WHERE pay >= 0
        ) USING (kldb, region_id)""",
}
