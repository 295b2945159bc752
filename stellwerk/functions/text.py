"""Normal forms and other small text functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed

# Regex flags: Unicode classes and boundaries, with or without case.
CASELESS = "(?iU)"
CASED = "(?U)"

# All white space characters, for trimming without a regex.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

LEGAL = r"\b(?:" + "|".join(fixed.LEGAL_FORMS) + r")\b\.?"
FILLER = r"\b(?:" + "|".join(fixed.PLACE_FILLERS) + r")\b"
POSTCODE = r"\b\d{4,5}\b"
NOT_WORD = r"[^\p{L}\p{N}_\s]"
WORD_BREAK = r"[^\p{L}\p{N}_]+"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def strip(value: Column | str) -> Column:
    """Without surrounding white space; null becomes ''."""
    return F.coalesce(F.trim(_col(value), F.lit(WHITE_SPACE)), F.lit(""))


def filled(value: Column | str) -> Column:
    """The stripped text, or null where nothing is left."""
    return F.nullif(strip(value), F.lit(""))


def first_filled(*values: Column | str) -> Column:
    """The first value with text in it, else ''."""
    return F.coalesce(*[filled(v) for v in values], F.lit(""))


def squeeze(value: Column | str) -> Column:
    """Every run of white space becomes one blank."""
    return F.trim(F.regexp_replace(_col(value), CASED + r"\s+", " "))


def casefold(value: Column | str) -> Column:
    return F.replace(F.lower(_col(value)), F.lit("ß"), F.lit("ss"))


def join_filled(separator: str, *values: Column | str) -> Column:
    """Join the values that hold text."""
    return F.concat_ws(separator, *[filled(v) for v in values])


def words(value: Column | str) -> Column:
    """Lower-case words in text order (may hold empty strings)."""
    return F.split(F.lower(_col(value)), WORD_BREAK)


def quoted(term: str) -> str:
    """``term`` as a literal inside a regex."""
    return "".join(c if c.isalnum() or c in "_ " else "\\" + c for c in term)


# --- normal forms ------------------------------------------------------------


def normal_form(value: Column | str) -> Column:
    """Without gender suffix and punctuation, squeezed and case folded."""
    plain = F.regexp_replace(_col(value), CASELESS + fixed.GENDER, " ")
    plain = F.regexp_replace(plain, CASED + NOT_WORD, " ")
    return F.coalesce(casefold(squeeze(plain)), F.lit(""))


def employer_form(value: Column | str) -> Column:
    """Employer name without legal form."""
    return normal_form(F.regexp_replace(_col(value), CASELESS + LEGAL, " "))


def title_form(value: Column | str) -> Column:
    return normal_form(value)


def place_form(value: Column | str) -> Column:
    """Place name without postcode and without anything after the first comma."""
    head = F.substring_index(_col(value), ",", 1)
    return normal_form(F.regexp_replace(head, CASED + POSTCODE, " "))


def map_place_form(value: Column | str) -> Column:
    """Place name in the form the city table uses (hyphens stay)."""
    head = F.substring_index(_col(value), ",", 1)
    head = F.regexp_replace(head, CASED + POSTCODE, " ")
    head = F.regexp_replace(head, CASELESS + FILLER, " ")
    head = F.regexp_replace(head, CASED + r"[^\p{L}\p{N}_\s-]", " ")
    return F.coalesce(casefold(squeeze(head)), F.lit(""))


def header_form(name: str) -> str:
    """Comparison form of a column heading."""
    return " ".join(name.split()).casefold()


def pair_key(employer: Column | str, position: Column | str) -> Column:
    """'employer | position', or '' unless both hold something."""
    parts = [casefold(squeeze(_col(v))) for v in (employer, position)]
    whole = (F.length(_col(employer)) > 0) & (F.length(_col(position)) > 0)
    return F.when(whole, F.concat(parts[0], F.lit(" | "), parts[1])).otherwise(F.lit(""))


def ref_from_link(link: Column | str) -> Column:
    """The reference at the end of an agency link, else ''."""
    link = _col(link)
    last = strip(F.substring_index(link, "/", -1))
    return F.when(link.contains(fixed.AGENCY_LINK), last).otherwise(F.lit(""))


def path_safe(ref: Column | str) -> Column:
    return F.replace(_col(ref), F.lit("/"), F.lit("_"))


def encoded_ref(ref: Column | str) -> Column:
    return F.base64(F.encode(_col(ref), "UTF-8"))


def ellipsis(value: Column | str, width: int) -> Column:
    """Cut to ``width`` characters, the last three being dots."""
    value = _col(value)
    short = F.concat(F.substring(value, 1, width - 3), F.lit("..."))
    return F.when(F.length(value) > width, short).otherwise(value)


def shortened_list(labels: Column, limit: int = fixed.CELL_LABELS) -> Column:
    """The first ``limit`` labels, then '(+n)' for the rest."""
    head = F.array_join(F.slice(labels, 1, limit), ", ")
    more = F.concat(head, F.lit(" (+"), (F.size(labels) - limit).cast("string"), F.lit(")"))
    return F.when(F.size(labels) > limit, more).otherwise(head)


def term_list(raw: str | None, default: Iterable[str]) -> tuple[str, ...]:
    """Comma separated terms, lower case; blank means the default."""
    terms = tuple(t.strip().lower() for t in (raw or "").split(",") if t.strip())
    return terms or tuple(default)
