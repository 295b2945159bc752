"""Count-or-idle batches and digests.

A batch closes when it holds ``max_rows`` rows, or when ``idle_seconds`` pass without a
new row.  One recipient may receive a large part of all rows, so the order within a
recipient is never established in one task: rows are range-partitioned by recipient and
time, every partition is scanned for itself, and what a partition needs to know of the ones
before it is a prefix scan over one small summary per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stellwerk import fixed
from stellwerk.functions.digest import margin_line, rating_line
from stellwerk.session import cut


def count_or_idle(
    rows: DataFrame,
    key: str,
    ts: str,
    seq: str,
    max_rows: int = fixed.DIGEST_ROWS,
    idle_seconds: int = fixed.DIGEST_IDLE_SECONDS,
) -> DataFrame:
    """Add ``row_no`` (place within the key) and ``batch`` (row_no of the batch's first row).

    ``seq`` makes the order of equal times unique.  A gap of exactly ``idle_seconds``
    closes the batch.

    A partition holds many keys or a part of one.  Only its first key can have begun in a
    partition before, so there is at most one thing to carry over per partition: how many rows
    of that key came before, whether a batch opens here, and where the open one began.
    """
    idle = idle_seconds * 1_000_000
    timed = rows.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    order = [key, "_us", seq]
    # Written once: the borders of the ranges must be the same for both uses.
    placed = cut(_scanned(timed.repartitionByRange(*order).sortWithinPartitions(*order), key, idle))
    summaries_ = placed.groupBy("_part", key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_us").alias("_first"),
        F.max("_us").alias("_last"),
        F.max("_start").alias("_last_start"),
    )
    over = Window.partitionBy(key).orderBy("_part")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    begun = F.col("_before") + F.coalesce(F.col("_last_start"), F.when(F.col("_opens"), F.lit(1)))
    carried = (
        summaries_.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_prev", F.lag("_last").over(over))
        .withColumn("_opens", F.col("_prev").isNull() | (F.col("_first") - F.col("_prev") >= idle))
        .withColumn("_carried", F.last(begun, ignorenulls=True).over(earlier))
        .filter("_before > 0")
        # No more than one row per partition.
        .select("_part", F.lit(True).alias("_head"), "_before", "_opens", "_carried")
    )
    before = F.coalesce("_before", F.lit(0))
    row_no = before + F.col("_n")
    session = F.coalesce(
        before + F.col("_start"),
        F.when(F.coalesce("_opens", F.lit(True)), before + 1),
        F.col("_carried"),
    )
    return (
        placed.join(F.broadcast(carried), ["_part", "_head"], "left")
        .withColumn("row_no", row_no)
        .withColumn("batch", row_no - (row_no - session) % max_rows)
        .select(*rows.columns, "row_no", "batch")
    )


def _scanned(placed: DataFrame, key: str, idle: int) -> DataFrame:
    """Add what one pass over a sorted partition tells.

    ``_part``, ``_head`` (the row has the partition's first key), ``_n`` (place among the
    key's rows here) and ``_start`` (place of the last row so far that came after a pause).
    """
    names = [*placed.columns, "_part", "_head", "_n", "_start"]
    layout = T.StructType.fromDDL("_part INT, _head BOOLEAN, _n BIGINT, _start BIGINT")
    layout = T.StructType([*placed.schema.fields, *layout.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen, last_key, last_us, n, start, head = False, None, 0, 0, 0, True
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            codes = batch[key].dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            us = batch["_us"].to_numpy(zero_copy_only=False).astype(np.int64)
            fresh = np.diff(codes, prepend=codes[0]) != 0
            fresh[0] = not seen or batch[key][0].as_py() != last_key
            pause = np.diff(us, prepend=last_us if seen else us[0]) >= idle
            at = np.arange(size)
            run = np.maximum.accumulate(np.where(fresh, at, -1))
            place = np.where(run >= 0, at - run + 1, at + n + 1)
            # The last row that opened a key (no pause of its own) or came after a pause.
            mark = np.maximum.accumulate(np.where(fresh | pause, at, -1))
            begun = np.where(mark >= 0, np.where(fresh[mark], 0, place[mark]), start)
            heads = np.full(size, head) & (np.cumsum(fresh) - (0 if seen else 1) == 0)
            seen, last_key, last_us = True, batch[key][size - 1].as_py(), int(us[-1])
            n, start, head = int(place[-1]), int(begun[-1]), bool(heads[-1])
            more = [
                pa.array(np.full(size, part, np.int32)),
                pa.array(heads),
                pa.array(place, pa.int64()),
                pa.array(begun, pa.int64(), mask=begun == 0),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    return placed.mapInArrow(scan, layout)


def closed_batches(
    batched: DataFrame,
    key: str,
    ts: str,
    as_of: Column,
    max_rows: int = fixed.DIGEST_ROWS,
    idle_seconds: int = fixed.DIGEST_IDLE_SECONDS,
) -> DataFrame:
    """(key, batch, closed): full, followed by another batch, or idle at ``as_of``."""
    sizes = batched.groupBy(key, "batch").agg(
        F.count(F.lit(1)).alias("rows"), F.max(ts).alias("_last")
    )
    newest = sizes.groupBy(key).agg(F.max("batch").alias("_newest"))
    idle = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("_last").cast("timestamp")) >= idle_seconds * 1_000_000
    return sizes.join(newest, key).select(
        key,
        "batch",
        ((F.col("rows") >= max_rows) | (F.col("batch") < F.col("_newest")) | idle).alias("closed"),
    )


def summaries(
    batched: DataFrame, key: str, place: str, default_place: str = fixed.DIGEST_DEFAULT_PLACE
) -> DataFrame:
    """(key, batch, rows, place): size and the one common place, else the default."""
    named = F.when(F.length(place) > 0, F.col(place))
    common = F.when(F.min(named) == F.max(named), F.min(named))
    return batched.groupBy(key, "batch").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(common, F.lit(default_place)).alias("place"),
    )


def digest_rows(batched: DataFrame, enrichment: str = "enrichment") -> DataFrame:
    """Add the two text lines of a digest entry and its sort key ``digest_order``.

    Best score first, unrated last, ties in order of arrival.
    """
    e = F.col(enrichment)
    points = F.coalesce(e["punkte"], F.lit(-1))
    return batched.withColumns(
        {
            "rating_line": rating_line(e),
            "margin_line": margin_line(e["alter_tage"], e["entfernung_km"]),
            "digest_order": F.struct((-points).alias("rank"), F.col("row_no")),
        }
    )
