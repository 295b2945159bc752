"""Occupation codes and salary fields."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed


def _names_any(text: Column, hints: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(h) for h in hints])


def occupation_code(title: Column) -> Column:
    """Four digits for the group, one for the level of requirement."""
    text = F.lower(F.coalesce(title, F.lit("")))
    group = F.when(_names_any(text, fixed.CONSULTING_HINTS), fixed.CODE_CONSULTING).otherwise(
        fixed.CODE_SOFTWARE
    )
    level = (
        F.when(_names_any(text, fixed.EXPERT_HINTS), "4")
        .when(_names_any(text, fixed.JUNIOR_HINTS), "2")
        .otherwise("3")
    )
    return F.concat(group, level)


def stated(value: Column) -> Column:
    """The value, null for the negative placeholders."""
    return F.when(value >= 0, value)
