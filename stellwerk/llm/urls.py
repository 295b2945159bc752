"""URL filters: pattern rules behind an index of their rarest literal token.

Every rule names words that a URL must hold for its pattern to match.  The rule is filed under
the one of these that the fewest URLs hold.  A URL looks up its own words and runs the regular
expressions of the rules found there, and of no others.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

words = re.compile(r"\w+").findall
_CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; both empty if it is missing or has no ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return host.translate(_CAPITALS), path


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host and path, written one after the other.

    ``tokens`` are whole words that every match holds; of several matching rules the one with the
    largest ``weight`` decides, of those with equal weight the one that comes first by name.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int


def site(name: str, verdict: str) -> Rule:
    """A rule ``host/path``: fits the host, its subdomains, and paths that start with the path."""
    host, slash, path = name.partition("/")
    path = slash + path
    whole = path[: path.rfind("/") + 1]  # behind it a word may go on in the URL
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    tokens = tuple(dict.fromkeys(words(host.lower()) + words(whole.lower())))
    return Rule(name, verdict, pattern, tokens, 1_000_000 + len(name))


def word(name: str, verdict: str) -> Rule:
    """A rule for a word of its own in host or path, in either case."""
    return Rule(f"*{name}*", verdict, rf"(?i)(?<!\w){re.escape(name)}(?!\w)", (name.lower(),), len(name))


#: The rules of the contract.
SITES = (
    site("com/", "allow"),
    site("example.com/en/", "block"),
    site("www.example.com/en/", "allow"),
    site("net/es/", "block"),
    site("net/fr/", "block"),
)
#: What decides where no rule of the contract fits.
UNWANTED = ("adserver", "banner", "casino", "malware", "phishing", "porn", "tracker", "xxx")
METHOD = tuple(word(x, "block") for x in UNWANTED)
DEFAULT = "allow"


def token_counts(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """In how many URLs the rules' tokens are found: as many numbers as the rules have tokens."""
    wanted = {t for rule in rules for t in rule.tokens}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for url in batch["url"].to_pylist():
                found.update(wanted.intersection(words("".join(parts(url)).lower())))
        yield pa.RecordBatch.from_pydict(
            {"token": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())}
        )

    rows = urls.select("url").mapInArrow(count, "token string, n long")
    return {r["token"]: r["n"] for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class Index:
    """Rules by their rarest token; those without a token are candidates everywhere."""

    def __init__(self, rules: tuple[Rule, ...], counts: dict[str, int]):
        self.everywhere: list[tuple[Rule, re.Pattern]] = []
        self.filed: dict[str, list[tuple[Rule, re.Pattern]]] = defaultdict(list)
        for rule in rules:
            own = rule, re.compile(rule.pattern)
            if rule.tokens:
                self.filed[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(own)
            else:
                self.everywhere.append(own)

    def candidates(self, text: str) -> list[tuple[Rule, re.Pattern]]:
        out = list(self.everywhere)
        for token in set(words(text.lower())):
            out += self.filed.get(token, ())
        return out

    def best(self, text: str) -> Rule | None:
        fitting = [rule for rule, pattern in self.candidates(text) if pattern.search(text)]
        return min(fitting, key=lambda r: (-r.weight, r.name), default=None)


def judged(urls: DataFrame, rules: tuple[Rule, ...], default: str = DEFAULT) -> DataFrame:
    """``urls`` (column ``url``) with host, path, rule and verdict.

    ``rule`` is the name of the rule that decides, null if none fits; then ``verdict`` is
    ``default``.  A URL that is missing or has no ``://`` has an empty host and path and fits
    rules without tokens only.  Rows are judged one by one without a shuffle, repeated ones alike; the
    rule list is a parameter of the job and goes to every worker once.  Other columns stay (those named
    host, path, rule or verdict are replaced).
    """
    shared = urls.sparkSession.sparkContext.broadcast((rules, token_counts(urls, rules)))
    built: list[Index] = []

    @F.arrow_udf("host string, path string, rule string, verdict string")
    def judge(column: pa.Array) -> pa.Array:
        if not built:
            built.append(Index(*shared.value))
        rows = []
        for url in column.to_pylist():
            host, path = parts(url)
            rule = built[0].best(host + path)
            rows.append((host, path, rule and rule.name, rule.verdict if rule else default))
        names = ("host", "path", "rule", "verdict")
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], pa.string()) for i in range(4)], list(names)
        )

    names = ("host", "path", "rule", "verdict")
    columns = [F.col(f"`{c}`") for c in urls.columns if c not in names]
    out = urls.select(F.struct(*columns).alias("kept"), judge(F.col("url")).alias("judged"))
    return out.select("kept.*", *[F.col(f"judged.{k}").alias(k) for k in names])


def rule_of(rule: Column, listed: tuple[Rule, ...] = SITES) -> Column:
    """``rule`` where it is one of ``listed``, else null."""
    return F.when(rule.isin([r.name for r in listed]), rule)
