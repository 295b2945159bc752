"""Words that look like a technology but are missing from the catalog."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.catalog import Catalog, labels_in
from stellwerk.functions.text import CASED, WORD_BREAK, casefold

_WHOLE = f"^(?:{fixed.ABBREVIATION}|{fixed.INNER_CAPITAL})$"

# Capitals that name no technology: short German words, and abbreviations of ads.
STOP_WORDS = tuple(
    """
    AM AN ALS AUCH AUF AUS BEI BIS DAS DEIN DEINE DEM DEN DER DES DICH DIE DIR DU EIN EINE FÜR FUER
    HABEN HAST IHR IHRE IM IN IST KANN MIT NACH ODER SIE SIND UND UNS UNSER UNSERE VON VOM WAS WER
    WIR ZU ZUM ZUR
    AG GBR GMBH KG MBH OHG SE UG
    BAV BGM BRUTTO CD CI EUR FAQ HR IT JOB MFD MWD NET NRW OPNV PDF TOP USW VWL WMD
    """.split()
)


def candidate_words(text: Column) -> Column:
    """Distinct words of ``text`` whose spelling suggests a technology."""
    text = F.coalesce(text, F.lit(""))
    plain = F.filter(F.split(text, WORD_BREAK), lambda w: w.rlike(_WHOLE))
    special = F.regexp_extract_all(text, F.lit(CASED + fixed.SPECIAL_NAME), F.lit(0))
    return F.array_union(plain, special)


def is_unknown_term(
    word: Column, catalog: Catalog, stop_words: tuple[str, ...] = STOP_WORDS
) -> Column:
    """Long enough, no stop word, and neither a label nor matched by one."""
    bare = F.translate(F.upper(word), ".-", "")
    return (
        (F.length(word) >= fixed.MIN_TERM_LENGTH)
        & ~bare.isin(*stop_words)
        & ~casefold(word).isin(*[label.casefold() for label in catalog.labels])
        & (F.size(labels_in(word, catalog)) == 0)
    )
