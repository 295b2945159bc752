"""Catalogs: ordered lists of (category, label, pattern), and the search for labels in text.

A catalog is small, caller supplied data that becomes part of the plan.  Labels whose
pattern is a list of whole words are found by splitting the text into words once and
intersecting that set with the catalog's words.  Alternatives of plain text are searched
as such.  Of the remaining patterns each alternative is first looked for by a literal that all of
its matches hold, and only where this occurs does it run as a regular expression, which is many
times slower when a text does not match.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellwerk import schema
from stellwerk.functions.patterns import alternatives, literals
from stellwerk.functions.text import CASELESS, bound, words


#: Entries that a plan may hold.
LARGEST = 500
_WHOLE_WORDS = re.compile(r"\\b\w+\\b(?:\|\\b\w+\\b)*")
_PLAIN = re.compile(r"[\w -]+(?:\|[\w -]+)*")
#: Patterns that are understood well enough to be taken apart.
_KNOWN = re.compile(
    r"(?:\\(?:[bBsSdDwW]|[^\w\[\]])|\[\^?(?:\\(?:[sSdDwW]|p\{[LN]\}|[^\w\[\]])|[^\\\[\]])+\]"
    r"|\((?:\?(?:[:!=]|-i:)|(?!\?))|[^\\\[\](])*"
)
#: Literals that a search in the folded text finds wherever a caseless pattern does.
_SAFE = re.compile(r"[a-z0-9äöüß_ -]+")
#: Letters that such a pattern takes for others, but lower case does not.
_ODD, _EVEN = "ſıİ", "sii"


@dataclass(frozen=True)
class Entry:
    category: str
    label: str
    pattern: str

    @cached_property
    def whole_words(self) -> tuple[str, ...]:
        r"""The words, if the pattern only lists whole words (``\bone\b|\btwo\b``)."""
        if not _WHOLE_WORDS.fullmatch(self.pattern):
            return ()
        return tuple(part[2:-2].lower() for part in self.pattern.split("|"))

    @cached_property
    def plain_parts(self) -> tuple[str, ...]:
        """The alternatives, if the pattern is only plain text (``one|other one``)."""
        if not _PLAIN.fullmatch(self.pattern):
            return ()
        return tuple(part.lower() for part in self.pattern.split("|"))

    @cached_property
    def searches(self) -> tuple[tuple[str, str], ...]:
        """(literal, pattern) of each alternative: what all matches hold in lower case, '' if none
        is known, and the regular expression, '' if it is nothing but the literal."""
        if not _KNOWN.fullmatch(self.pattern):
            return (("", self.pattern),)
        found = []
        for part in alternatives(self.pattern):
            if _SAFE.fullmatch(part.lower()):
                found.append((part.lower(), ""))
            else:
                held = [word for word, _, _ in literals(part) if _SAFE.fullmatch(word)]
                found.append((max(held, key=len, default=""), part))
        return tuple(found)


@dataclass(frozen=True)
class Catalog:
    entries: tuple[Entry, ...]

    @classmethod
    def of(cls, rows: Iterable[tuple[str, str, str]]) -> Catalog:
        return cls(tuple(Entry(*row) for row in rows))

    @classmethod
    def from_table(cls, table: DataFrame) -> Catalog:
        """Read a caller's small catalog table; its entries become part of the plans.

        A table of more than ``LARGEST`` rows is refused: ``operators.catalogs`` joins it instead.
        """
        rows = table.select("pos", "category", "label", "pattern").limit(LARGEST + 1).collect()
        if len(rows) > LARGEST:
            raise ValueError(f"more than {LARGEST} rows: use operators.catalogs.labels_by_table")
        return cls.of((r.category, r.label, r.pattern) for r in sorted(rows))

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, e.category, e.label, e.pattern) for i, e in enumerate(self)]
        return spark.createDataFrame(rows, schema.CATALOG)

    def __iter__(self) -> Iterator[Entry]:
        return iter(self.entries)

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(e.label for e in self)

    def entry(self, label: str) -> Entry | None:
        """Entry by label, whatever its case."""
        wanted = label.strip().casefold()
        return next((e for e in self if e.label.casefold() == wanted), None)

    def category_of(self) -> dict[str, str]:
        return {e.label: e.category for e in self}

    @cached_property
    def word_entries(self) -> dict[Entry, tuple[str, ...]]:
        """Entries found by words alone; a word two entries share is left to regexes."""
        uses = Counter(w for e in self for w in set(e.whole_words))
        return {
            e: e.whole_words
            for e in self
            if e.whole_words and all(uses[w] == 1 for w in e.whole_words)
        }

    @cached_property
    def all_words(self) -> list[str]:
        return [w for ws in self.word_entries.values() for w in ws]


def labels_in(text: Column, catalog: Catalog) -> Column:
    """Labels that occur in ``text``, once each, in catalog order."""
    text = F.coalesce(text, F.lit(""))
    seen = [F.lower(text).alias("lowered")]
    if catalog.all_words:
        known = F.array(*[F.lit(w) for w in catalog.all_words])
        seen.append(F.array_intersect(words(text), known).alias("words"))

    def collect(s: Column, folded: Column | None = None) -> Column:
        hits = []
        for e in catalog:
            if e in catalog.word_entries:
                tests = [F.array_contains(s["words"], w) for w in catalog.word_entries[e]]
            elif e.plain_parts:
                tests = [F.contains(s["lowered"], F.lit(part)) for part in e.plain_parts]
            else:
                tests = [_occurs(text, folded, *search) for search in e.searches]
            hits.append(F.when(reduce(lambda a, b: a | b, tests), F.lit(e.label)))
        return F.array_compact(F.array(*hits))

    if all(e in catalog.word_entries or e.plain_parts for e in catalog):
        return bound(F.struct(*seen), collect)
    odd = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in _ODD])
    even = F.lower(F.translate(text, _ODD, _EVEN))
    return bound(
        F.struct(*seen),
        lambda s: bound(F.when(odd, even).otherwise(s["lowered"]), lambda folded: collect(s, folded)),
    )


def _occurs(text: Column, folded: Column, literal: str, pattern: str) -> Column:
    """The pattern holds; where its literal is missing it is not tried."""
    tests = [F.contains(folded, F.lit(literal))] if literal else []
    if pattern:
        tests.append(text.rlike(CASELESS + pattern))
    return reduce(lambda a, b: a & b, tests)


def united(catalog: Catalog, *labels: Column) -> Column:
    """Labels found in several parts of an ad, once each, in catalog order.

    Equals the labels of the parts joined by line breaks, as no pattern goes beyond a line.
    """
    every = F.array(*[F.lit(label) for label in dict.fromkeys(catalog.labels)]).cast("array<string>")
    return F.array_intersect(every, reduce(F.array_union, labels))


def mentions_in(text: Column, catalog: Catalog) -> Column:
    """array<struct<label, n>>: mentions of each label; a label may stand there repeatedly."""
    text = F.coalesce(text, F.lit(""))
    counts = [
        F.struct(
            F.lit(e.label).alias("label"),
            F.regexp_count(text, F.lit(CASELESS + e.pattern)).alias("n"),
        )
        for e in catalog
        if e not in catalog.word_entries
    ]
    parts = []
    if counts:
        parts.append(F.filter(F.array(*counts), lambda c: c["n"] > 0))
    if catalog.all_words:
        pairs = [
            F.lit(x) for e, ws in catalog.word_entries.items() for w in ws for x in (w, e.label)
        ]
        label_of = F.create_map(*pairs)
        known = F.filter(words(text), lambda w: w.isin(catalog.all_words))
        parts.append(
            F.transform(known, lambda w: F.struct(label_of[w].alias("label"), F.lit(1).alias("n")))
        )
    return F.concat(*parts)


def by_category(labels: DataFrame, catalog: Catalog, label: str = "label") -> DataFrame:
    """(category, labels): distinct labels per category, in catalog order."""
    spark = labels.sparkSession
    rules = catalog.to_table(spark).select("pos", "category", "label")
    known = labels.select(F.col(label).alias("label")).distinct()
    # At most one row per catalog entry is left after this join, whatever the input size.
    placed = known.join(F.broadcast(rules), "label")
    return placed.groupBy("category").agg(
        F.min("pos").alias("pos"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda e: e["label"]
        ).alias("labels"),
    )
