"""Mixing sources to target weights along a curriculum.

Every source has a share of the training tokens and a weight that changes over the training time
t in [0, 1].  Its demand up to t is its target times the integral of the weight; a document that
starts after so many tokens of its source is due when the demand reaches them, so its position
is the inverse of that integral.  Documents are then range-sorted by position.

Only DataFrame functions are used.  The order inside a source is that of a hash.  Its running
sums are taken in hash buckets of a bounded number of documents each, on top of the sums of the
buckets before, so a source of any size is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellwerk.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # of all words that the mix takes
MOST = 2  # times that a source may be repeated
#: Slopes of the weights over time, of the sources in order, repeating: later, steady, earlier.
SLOPES = (0.6, 0.0, -0.6)
#: Documents in one bucket of a source's order, on average; fewer in sources that need not split.
BUCKET = 20_000
LEAST_BUCKETS = 64


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 if it is missing."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``target`` and ``slope`` for rows (source, source_size, documents), one per source.

    The shares follow the weights.  A source stops at ``MOST`` times its size, and what it leaves
    goes to the others by weight: in order of the ratio of limit and weight, a source is at its
    limit as long as the rest, dealt to it and all that follow, exceeds it.  The table has a row
    per source; it is small enough for one task.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(in_order) - 1) % len(WEIGHTS)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), nth + 1)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = sizes.select("*", pick(WEIGHTS).alias("weight"), pick(SLOPES).alias("slope"))
    out = out.select(
        "*",
        (MOST * F.col("source_size")).alias("limit"),
        (F.lit(SHARE) * F.sum("source_size").over(everything)).alias("total"),
        F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0)).alias("limits_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights"),
    )
    dealt = (F.col("total") - F.col("limits_before")) * F.col("weight") / F.col("weights")
    out = out.withColumn("full", F.col("limit") <= dealt)
    # The first source below its limit fixes the rate for itself and all after it.
    open_ = F.when(~F.col("full"), F.struct("total", "limits_before", "weights"))
    first = F.first(open_, ignorenulls=True).over(everything)
    rate = (first["total"] - first["limits_before"]) * F.col("weight") / first["weights"]
    return out.select(
        "source", "source_size", "documents", "slope",
        F.when(F.col("full"), F.col("limit").cast("double")).otherwise(rate).alias("target"),
    )


def due(share: Column, slope: Column) -> Column:
    """Training time at which a share of a source's tokens is used up.

    The weight is 1 + slope * (2 t - 1), its integral (1 - slope) t + slope t^2.
    """
    root = F.sqrt(F.pow(1 - slope, 2) + 4 * slope * share)
    return F.when(slope == 0, share).otherwise((root - (1 - slope)) / (2 * slope))


def mixed(docs: DataFrame) -> DataFrame:
    """Every document with what the mix takes of it; columns of ``docs`` but ``text`` stay.

    Needs ``doc_id``, ``source`` and ``text``.  Adds size, source_size, target, ``takes`` (an
    array of (copy, words, position), one for each time the document is taken) and ``taken``, the
    sum of its words.  A source is read in the order of a hash, at most twice; the document in
    which the target is reached is taken in part, so each source's words sum up to its target,
    rounded down.  Documents without words are taken with no words (missing and empty texts have
    size 0).  Null is a source of its own, the last.  Repeated rows are documents of their own; which
    of two equal rows comes first makes no difference.  A row without a doc_id takes its turn by its
    text.  The same input gives the same mix.
    """
    added = ("size", "source_size", "target", "takes", "taken")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text" and c not in added]
    # Rows without an id are spread by their text.
    unnamed = F.coalesce(F.xxhash64("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*kept).alias("kept"),
        "source",
        words_in(F.col("text")).alias("size"),
        F.md5(F.concat_ws("|", F.coalesce("source", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), unnamed)).cast("binary")).alias("turn"),
        F.xxhash64("text").alias("tie"),
    )
    rows = stored(rows, "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    plan = targets(sizes)

    share = F.conv(F.substring("turn", 1, 8), 16, 10).cast("double") / 2**32
    buckets = F.greatest(F.lit(LEAST_BUCKETS), F.ceil(F.col("documents") / BUCKET))
    same_source = lambda a, b: a["source"].eqNullSafe(b["source"])
    plan, rows = plan.alias("p"), rows.alias("r")
    rows = rows.join(plan, same_source(rows, plan)).select(
        "r.*", "p.source_size", "p.target", "p.slope", F.floor(share * buckets).alias("bucket")
    )
    in_bucket = Window.partitionBy("source", "bucket").orderBy("turn", "size", "tie")
    rows = rows.withColumn("inside", F.sum("size").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("source").orderBy("bucket")
    sums = sums.select("source", "bucket", (F.sum("words").over(in_source) - F.col("words")).alias("before"))
    rows, sums = rows.alias("r"), sums.alias("s")
    rows = rows.join(sums, same_source(rows, sums) & (F.col("r.bucket") == F.col("s.bucket"))).select(
        "r.kept", "r.size", "r.source_size", "r.target", "r.slope", (F.col("s.before") + F.col("r.inside")).alias("start")
    )

    def take(copy: int) -> Column:
        """One reading of the source; copy 0 starts at 0, copy 1 after the whole source."""
        start = F.col("start") + copy * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - start)).cast("long")
        at = due(F.least(F.lit(1.0), start / F.greatest("target", F.lit(1.0))), F.col("slope"))
        return F.when((words > 0) | ((F.col("size") == 0) & F.lit(copy == 0)), F.struct(F.lit(copy).alias("copy"), words.alias("words"), at.alias("position")))

    return rows.select(
        "kept.*", "size", "source_size", "target",
        F.filter(F.array(*[take(i) for i in range(MOST)]), lambda x: x.isNotNull()).alias("takes"),
    ).withColumn("taken", F.aggregate("takes", F.lit(0).cast("long"), lambda s, x: s + x["words"]))


def in_order(mix: DataFrame) -> DataFrame:
    """One row for each take, range-sorted by its position."""
    columns = [F.col(f"`{c}`") for c in mix.columns if c != "takes"]
    takes = mix.select(*columns, F.explode("takes").alias("take")).select(*columns, "take.*")
    return takes.repartitionByRange("position", "doc_id", "copy").sortWithinPartitions("position", "doc_id", "copy")


def read(docs: DataFrame) -> DataFrame:
    """Every document with what the mix, made and put into the order of training, reads of it.

    Needs what ``mixed`` needs.  The takes are written in their order, a partition a file; taken,
    ``times`` and ``position`` (of the first take, null without one) are found in them.  A row is
    known by a number, as ids may repeat or be missing.
    """
    # ``mixed`` stores the rows it reads, and their numbers with them.
    mix = stored(mixed(docs.withColumn("row", F.monotonically_increasing_id())), "mixed")
    order = stored(in_order(mix.select("row", "doc_id", "takes")), "order")
    found = order.groupBy("row").agg(
        F.sum("words").alias("taken"), F.count(F.lit(1)).cast("int").alias("times"), F.min("position").alias("position")
    )
    return mix.drop("takes", "taken").join(found, "row", "left").drop("row").fillna(0, ["taken", "times"])
