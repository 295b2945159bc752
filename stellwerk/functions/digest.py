"""Lines of a digest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed


def rating_line(enrichment: Column) -> Column:
    """'grade | points | hits | gaps', '' without a grade."""
    def listed(prefix: str, labels: Column, limit: int) -> Column:
        text = F.concat(F.lit(prefix), F.array_join(F.slice(labels, 1, limit), ", "))
        return F.when(F.size(labels) > 0, text)

    grade = F.nullif(enrichment["stufe"], F.lit(""))
    points = F.concat(enrichment["punkte"].cast("string"), F.lit(" Punkte"))
    line = F.concat_ws(
        " | ",
        grade,
        points,
        listed("passt: ", enrichment["treffer"], fixed.DIGEST_HITS),
        listed("fehlt: ", enrichment["luecken"], fixed.DIGEST_GAPS),
    )
    return F.when(grade.isNotNull(), line).otherwise("")


def short_number(value: Column) -> Column:
    """A number without a needless '.0', with a decimal comma."""
    plain = F.regexp_replace(value.cast("string"), r"\.0$", "")
    return F.replace(plain, F.lit("."), F.lit(","))


def margin_line(age: Column, km: Column) -> Column:
    """Age and distance as far as known."""
    online = F.when(age == 0, "heute veroeffentlicht").when(
        age.isNotNull(), F.concat(F.lit("seit "), age.cast("string"), F.lit(" Tagen online"))
    )
    return F.concat_ws(" · ", online, F.concat(short_number(km), F.lit(" km")))
