"""Removing repeats by reference and by content.

A single reference or fingerprint may hold a large part of all rows, so no operator
here collects the rows of one key.  First rows are found with ``min`` (combined before
the shuffle) and joined back by the row's own sequence number, which is unique.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.operators.graphs import components
from stellwerk.session import written


def first_per_key(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The row with the smallest ``order`` (unique) of each key."""
    firsts = rows.groupBy(*key).agg(F.min(order).alias(order)).select(order)
    return rows.join(firsts, order, "left_semi")


def last_per_key(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` (unique) of each key."""
    lasts = rows.groupBy(*key).agg(F.max(order).alias(order)).select(order)
    return rows.join(lasts, order, "left_semi")


def new_keys(rows: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """Rows whose key nobody has claimed (insert if absent).

    Claims are made distinct first, which merges a frequent key before it is shuffled.
    """
    return rows.join(claims.select(key).distinct(), key, "left_anti")


def outcomes(
    rows: DataFrame,
    excluded: Column,
    known_refs: DataFrame | None = None,
    known_fps: DataFrame | None = None,
    seq: str = "seq",
    ref: str = "referenznummer",
    fp: str = "fp",
) -> DataFrame:
    """What a sequential consumer would do with each row; adds ``outcome``.

    In the order of ``seq``: a reference seen before is *known*; a fingerprint that an
    earlier new reference brought is a *duplicate*; then the filter decides between
    *excluded* and *forwarded*.  Reference and fingerprint are claimed by the first
    arrival even if that one is excluded.  ``known_refs`` and ``known_fps`` hold claims
    of earlier runs in columns named like ``ref`` and ``fp``.
    """
    narrow = rows.select(seq, ref, fp)
    first_ref = narrow.groupBy(ref).agg(F.min(seq).alias(seq))
    if known_refs is not None:
        first_ref = new_keys(first_ref, known_refs, ref)
    fresh = narrow.join(first_ref.select(seq), seq, "left_semi")
    first_fp = fresh.filter(F.col(fp).isNotNull()).groupBy(fp).agg(F.min(seq).alias(seq))
    if known_fps is not None:
        first_fp = new_keys(first_fp, known_fps, fp)
    first_fp = first_fp.select(seq, F.lit(True).alias("_first_fp"))
    marks = fresh.select(seq, F.lit(True).alias("_first_ref")).join(first_fp, seq, "left")
    outcome = (
        F.when(F.col("_first_ref").isNull(), fixed.KNOWN)
        .when(F.col(fp).isNotNull() & F.col("_first_fp").isNull(), fixed.DUPLICATE)
        .when(excluded, fixed.EXCLUDED)
        .otherwise(fixed.FORWARDED)
    )
    return (
        rows.join(marks, seq, "left")
        .withColumn("outcome", outcome)
        .drop("_first_ref", "_first_fp")
    )


#: Plain rounds before the structure of what is left is looked at, at the most.
PLAIN_ROUNDS = 6
#: Part of its rows that a plain round has to decide, or no other follows.
PLAIN_SHARE = 0.25
#: Rows of a component that one task decides in order.
FOLD_ROWS = 100_000


def two_key_dedup(
    rows: DataFrame, seq: str = "seq", ref: str = "referenznummer", fp: str = "fp"
) -> DataFrame:
    """Keep a row iff neither its reference nor its fingerprint is on a kept earlier row.

    Unlike :func:`outcomes`, a rejected row claims nothing, so acceptance depends on
    earlier acceptance and two passes of "first per key" do not give it.  Rounds do: a
    row that comes first among the remaining rows of both its keys is surely kept, and
    every row that shares a key with a kept row is surely out.  With keys in no special
    order a few rounds do; they go on as long as each decides a good part of its rows.  What is left
    then falls into components of rows that share keys.
    Components of up to ``FOLD_ROWS`` rows are decided in one pass each.  In larger ones a row that
    waits for a single earlier row is decided against it, so a chain of such rows is followed
    by doubling, and a round ends all chains at once.  Rows without fingerprint compete by
    reference only, rows without reference are dropped.

    Keys are texts only once: from then on a key goes by the number of its first row.
    """
    # Of equal (ref, fp) pairs only the first can be kept; copies end here.
    live = (
        rows.filter(F.length(ref) > 0)
        .groupBy(F.col(ref).alias("ref"), F.col(fp).alias("fp"))
        .agg(F.min(seq).cast("long").alias("seq"))
    )
    # Rows without fingerprint get a key of their own, or they would all meet in one task.
    unnamed = live.filter("fp is null").select("seq", "ref", F.col("seq").alias("fp"))
    named = written(live.filter("fp is not null"))
    live = written(_renamed(named, "fp").unionAll(unnamed))
    live = written(_renamed(live, "ref"))
    kept: list[DataFrame] = []
    n = live.count()
    for _ in range(PLAIN_ROUNDS):
        winners = live.filter("seq = ref and seq = fp").select("seq")
        if winners.isEmpty():
            break
        kept.append(winners)
        left = _without(live.filter("seq <> ref or seq <> fp"), winners.select(F.col("seq").alias("ref"), F.col("seq").alias("fp")))
        live = written(_renamed(_renamed(written(left), "fp"), "ref"))
        before, n = n, live.count()
        if n > (1 - PLAIN_SHARE) * before:
            kept += _structured(live)
            break
    else:
        kept += _structured(live)
    if not kept:
        return rows.limit(0)
    return rows.join(reduce(DataFrame.unionAll, kept).withColumnRenamed("seq", seq), seq, "left_semi")


def _renamed(live: DataFrame, key: str) -> DataFrame:
    """(seq, ref, fp) with the number of a key's first row in place of the key.

    Numbers tell the keys of one kind apart as well as the keys do, as a row has one of them.
    """
    first = live.groupBy(key).agg(F.min("seq").alias("_first"))
    return live.join(first, key).withColumn(key, F.col("_first")).select("seq", "ref", "fp")


def _without(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows that share no key with a kept one."""
    left = rows.select("seq", "ref", "fp").join(kept.select("ref"), "ref", "left_anti")
    return left.join(kept.select("fp"), "fp", "left_anti").select("seq", "ref", "fp")


def _structured(live: DataFrame) -> list[DataFrame]:
    """The kept rows (seq) of what plain rounds have left; keys are the numbers of first rows."""
    if live.isEmpty():
        return []
    to = lambda key: live.select(F.col("seq").alias("a"), F.col(key).alias("b"))
    root_of = components(to("ref").unionAll(to("fp")))
    # A row that shares no key is a component of its own.
    placed = live.join(root_of, F.col("seq") == F.col("node"), "left")
    placed = written(placed.select("seq", "ref", "fp", F.coalesce("root", "seq").alias("root")))
    # Of large components there are few, by their size.
    large = F.broadcast(placed.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FOLD_ROWS).select("root"))
    small = placed.join(large, "root", "left_anti").select("seq", "ref", "fp", "root")
    folded = small.repartition("root").sortWithinPartitions("root", "seq").mapInPandas(_fold, "seq long")
    kept = [written(folded)]
    live = written(placed.join(large, "root", "left_semi").select("seq", "ref", "fp"))
    while not live.isEmpty():
        decided = written(_chained(live))
        winners = live.join(decided.filter("keep").select("seq"), "seq", "left_semi")
        kept.append(decided.filter("keep").select("seq"))
        live = written(_without(live.join(decided.select("seq"), "seq", "left_anti"), winners))
    return kept


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Decide the rows of one component after the other, in their order."""
    now, refs, fps = None, set(), set()
    for batch in batches:
        out = []
        for row, ref, fp, root in zip(batch["seq"], batch["ref"], batch["fp"], batch["root"]):
            if root != now:
                now, refs, fps = root, set(), set()
            if ref not in refs and fp not in fps:
                refs.add(ref)
                fps.add(fp)
                out.append(row)
        yield pd.DataFrame({"seq": out}, dtype="int64")


def _chained(live: DataFrame) -> DataFrame:
    """(seq, keep): rows that wait for none, and all rows that depend on one of them by a chain.

    A row waits for the earlier rows of its keys.  If there is just one, the row is kept exactly
    if that one is not.  Following such rows back by doubling leads to a row that waits for
    none, or to one that waits for several and has to wait for another round.
    """
    for key in ("ref", "fp"):
        live = live.join(_first_two(live, key), "seq", "left")
    place = lambda key: F.coalesce(f"{key}_place", F.lit(2))
    many = place("ref") + place("fp")
    state = written(
        live.select(
            "seq",
            (many == 0).alias("free"),
            # Only a row that waits for exactly one row points back.
            F.when(many == 1, F.coalesce("ref_before", "fp_before")).alias("to"),
        )
    )
    ends = state.filter("to is null").select("seq", "free")
    end = ends.select(F.col("seq").alias("to"), F.lit(True).alias("_end"))
    links = written(
        state.filter("to is not null")
        .join(end, "to", "left")
        .select("seq", "to", F.lit(True).alias("odd"), F.col("_end").isNotNull().alias("arrived"))
    )
    while not links.filter("not arrived").isEmpty():
        onward = links.select(
            F.col("seq").alias("to"), F.col("to").alias("next"), F.col("odd").alias("more"), F.col("arrived").alias("there")
        )
        moved = links.filter("not arrived").join(onward, "to").select(
            "seq", F.col("next").alias("to"), (F.col("odd") != F.col("more")).alias("odd"), F.col("there").alias("arrived")
        )
        # Dealt out anew, as the partitions of a union add up from round to round.
        links = written(links.filter("arrived").unionAll(moved).repartition("seq"))
    free = ends.filter("free").select("seq")
    behind = links.join(free.withColumnRenamed("seq", "to"), "to", "left_semi")
    return free.withColumn("keep", F.lit(True)).unionAll(behind.select("seq", ~F.col("odd")))


def _first_two(live: DataFrame, key: str) -> DataFrame:
    """(seq, place, before): the first two rows of every key and the row before the second."""
    first = live.groupBy(key).agg(F.min("seq").alias("one"))
    rest = live.join(first.select(F.col("one").alias("seq")), "seq", "left_anti")
    second = rest.groupBy(key).agg(F.min("seq").alias("two")).join(first, key)
    return first.select(
        F.col("one").alias("seq"), F.lit(0).alias(f"{key}_place"), F.lit(None).cast("long").alias(f"{key}_before")
    ).unionAll(second.select("two", F.lit(1), "one"))


def cross_source_groups(
    rows: DataFrame,
    fp: str = "fp",
    source: str = "quelle",
    seq: str = "seq",
    ref: str = "referenznummer",
) -> DataFrame:
    """Fingerprints on more than one portal: rows, portals, and who came first."""
    # Two steps: the first one merges all copies of a portal before any distinct count.
    per_source = (
        rows.filter(F.col(fp).isNotNull())
        .groupBy(fp, source)
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(seq, ref)).alias("first"))
    )
    return (
        per_source.groupBy(fp)
        .agg(
            F.sum("n").alias("ads"),
            F.count(F.lit(1)).alias("sources"),
            F.min("first")[ref].alias("first_seen_as"),
        )
        .filter("sources > 1")
    )
