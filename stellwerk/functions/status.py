"""Application status: codes, table wording, predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.text import casefold, filled, strip

_WORDING = {text.casefold(): code for code, text in fixed.STATUS_TEXT.items() if text}
_WORDING.update(fixed.STATUS_ALIASES)


def _lookup(key: Column, mapping: dict[str, str]) -> Column:
    result = F.lit(None).cast("string")
    for name, value in reversed(mapping.items()):
        result = F.when(key == name, F.lit(value)).otherwise(result)
    return result


def status_code(value: Column) -> Column:
    """Code for a code or a table wording; null if neither."""
    text = strip(value)
    code = F.when(F.upper(text).isin(*fixed.STATUSES), F.upper(text))
    return F.coalesce(code, _lookup(casefold(text), _WORDING))


def status_from_cell(cell: Column) -> Column:
    """Code for a table cell: blank means found, unknown wording null."""
    return F.when(filled(cell).isNull(), F.lit(fixed.FOUND)).otherwise(
        _lookup(casefold(strip(cell)), _WORDING)
    )


def status_text(code: Column) -> Column:
    return F.coalesce(_lookup(code, fixed.STATUS_TEXT), code)


def status_rank(code: Column) -> Column:
    """Place in the life cycle, 99 for anything unknown."""
    ranks = {code: str(i) for i, code in enumerate(fixed.STATUSES)}
    return F.coalesce(_lookup(code, ranks).cast("int"), F.lit(99))


def is_tracked(code: Column) -> Column:
    return code != fixed.FOUND


def parse_status(value: str) -> str:
    """Plan-time form of :func:`status_code`; raises on unknown input."""
    text = value.strip()
    code = text.upper() if text.upper() in fixed.STATUSES else _WORDING.get(text.casefold())
    if code is None:
        raise ValueError(f"unknown status {value!r}; known: {', '.join(fixed.STATUSES)}")
    return code
