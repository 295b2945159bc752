"""The main column functions as SQL functions.

Spark SQL functions with a RETURN expression are expanded into the calling query, so
they cost no more than the expression itself.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from stellwerk import fixed
from stellwerk.functions import text


def _literal(pattern: str) -> str:
    """A raw string literal."""
    return 'r"' + pattern.replace('"', r"\x22") + '"'


def _normal(value: str) -> str:
    plain = f"regexp_replace({value}, {_literal(text.CASELESS + fixed.GENDER)}, ' ')"
    plain = f"regexp_replace({plain}, {_literal(text.CASED + text.NOT_WORD)}, ' ')"
    plain = f"regexp_replace({plain}, {_literal(text.CASED + r'\\s+')}, ' ')"
    return f"coalesce(replace(lower(trim({plain})), 'ß', 'ss'), '')"


def _rlike(pattern: str) -> str:
    return f"work_text rlike {_literal(text.CASELESS + pattern)}"


def _functions() -> dict[str, str]:
    employer = _normal(f"regexp_replace(employer, {_literal(text.CASELESS + text.LEGAL)}, ' ')")
    head = "substring_index(place, ',', 1)"
    place = _normal(f"regexp_replace({head}, {_literal(text.CASED + text.POSTCODE)}, ' ')")
    title = _normal("title")
    joined = f"concat_ws('|', {employer}, {title}, {place})"
    days = "concat(" + ", ".join(
        f"regexp_extract(work_text, {_literal(text.CASELESS + fixed.DAYS_PHRASES)}, {i})" for i in (1, 2)
    ) + ")"
    return {
        "content_fingerprint(employer STRING, title STRING, place STRING) RETURNS STRING": (
            f"CASE WHEN {employer} <> '' AND {title} <> ''"
            f" THEN substring(sha2({joined}, 256), 1, {fixed.FINGERPRINT_HEX}) END"
        ),
        "match_score(reached INT, possible INT, labels INT) RETURNS INT": (
            f"CASE WHEN labels < {fixed.MIN_LABELS} THEN 0"
            f" ELSE CAST(bround(100 * reached / (possible + {fixed.DAMPING}), 0) AS INT) END"
        ),
        "work_model(work_text STRING) RETURNS STRING": (
            f"CASE WHEN {_rlike(fixed.ON_SITE_PHRASES)} THEN '{fixed.ON_SITE}'"
            f" WHEN {_rlike(fixed.REMOTE_PHRASES)} THEN '{fixed.FULLY_REMOTE}'"
            f" WHEN {days} = '1' THEN 'hybrid, 1 Tag/Woche'"
            f" WHEN {days} IN ('2', '3', '4') THEN concat('hybrid, ', {days}, ' Tage/Woche')"
            f" WHEN {days} <> '' THEN '{fixed.FULLY_REMOTE}'"
            f" WHEN {_rlike(fixed.HYBRID_PHRASES)} THEN '{fixed.HYBRID_OPEN}'"
            f" WHEN {_rlike(fixed.POSSIBLE_PHRASES)} THEN '{fixed.POSSIBLE_OPEN}' ELSE '' END"
        ),
        "haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": (
            f"{2 * fixed.EARTH_RADIUS_KM} * asin(sqrt(power(sin(radians(lat2 - lat1) / 2), 2)"
            " + cos(radians(lat1)) * cos(radians(lat2))"
            " * power(sin(radians(lon2 - lon1) / 2), 2)))"
        ),
    }


def register(spark: SparkSession) -> None:
    """Create the functions for this session."""
    for head, body in _functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
