"""The digest stream: collect ads per recipient, emit batches that are full or idle.

A micro-batch is put behind the rows still open from the one before, and the batch
operator cuts the whole into batches.  Closed batches are emitted; at most
``max_rows - 1`` rows per recipient stay open.  Both parts are written under the batch
id and replace an earlier attempt, so nothing is lost or sent twice after a failure.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stellwerk import fixed
from stellwerk.operators.batches import closed_batches, count_or_idle
from stellwerk.session import adaptive
from stellwerk.streaming.intake import Folders, read_table


def _open_rows(spark: SparkSession, folders: Folders, batch_id: int, like: DataFrame) -> DataFrame:
    """Rows that batch left open; batch numbers are consecutive."""
    return read_table(spark, folders.part("open", batch_id), like.schema)


def process(
    rows: DataFrame,
    batch_id: int,
    folders: Folders,
    key: str,
    ts: str,
    seq: str,
    as_of: Column,
    max_rows: int = fixed.DIGEST_ROWS,
    idle_seconds: int = fixed.DIGEST_IDLE_SECONDS,
) -> None:
    """One micro-batch; ``as_of`` is the fixed time against which idleness is measured."""
    spark = rows.sparkSession
    waiting = rows.unionByName(_open_rows(spark, folders, batch_id - 1, rows))
    batched = count_or_idle(waiting, key, ts, seq, max_rows, idle_seconds).persist()
    try:
        state = closed_batches(batched, key, ts, as_of, max_rows, idle_seconds)
        marked = batched.join(state, [key, "batch"])
        (
            marked.filter("closed")
            .drop("closed")
            .write.mode("overwrite")
            .parquet(folders.part("digests", batch_id))
        )
        (
            marked.filter("not closed")
            .select(*rows.columns)
            .write.mode("overwrite")
            .parquet(folders.part("open", batch_id))
        )
    finally:
        batched.unpersist()
    done = spark.range(1).select(F.lit(batch_id).cast("long").alias("done"))
    done.write.mode("overwrite").parquet(folders.part("done", batch_id))


def start(
    rows: DataFrame,
    folders: Folders,
    key: str,
    ts: str,
    seq: str,
    max_rows: int = fixed.DIGEST_ROWS,
    idle_seconds: int = fixed.DIGEST_IDLE_SECONDS,
    available_now: bool = False,
    interval: str = "30 seconds",
    heartbeat: bool = True,
) -> StreamingQuery:
    """Start the stream.

    Idle batches must also close while nothing arrives, so a live query gets a heartbeat:
    one null row per interval that only makes a micro-batch happen.  A finite run
    (``available_now``) measures idleness against the newest row and ends with open rows,
    which :func:`flush` sends.
    """
    spark = rows.sparkSession
    if heartbeat and not available_now:
        beat = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
        rows = rows.unionByName(beat.select(*nothing))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        real = batch.filter(F.col(key).isNotNull())
        # One moment for the whole batch: a row must not be open for one write and closed
        # for the other.
        clock = F.lit(dt.datetime.now(dt.timezone.utc))
        now = real.agg(F.max(ts)).scalar() if available_now else clock
        with adaptive(spark):
            process(real, batch_id, folders, key, ts, seq, now, max_rows, idle_seconds)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        rows.writeStream.foreachBatch(run)
        .option("checkpointLocation", folders.table("checkpoint"))
        .trigger(**trigger)
        .start()
    )


def flush(
    spark: SparkSession,
    folders: Folders,
    like: DataFrame,
    key: str,
    ts: str,
    seq: str,
    max_rows: int = fixed.DIGEST_ROWS,
    idle_seconds: int = fixed.DIGEST_IDLE_SECONDS,
) -> DataFrame:
    """What is still open when the stream stops, as last batches."""
    done = read_table(spark, folders.table("done"), "done BIGINT, batch_id BIGINT")
    newest = done.agg(F.max("done").alias("done")).first().done
    open_rows = like.limit(0) if newest is None else _open_rows(spark, folders, newest, like)
    return count_or_idle(open_rows, key, ts, seq, max_rows, idle_seconds)
