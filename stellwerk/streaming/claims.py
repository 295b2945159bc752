"""Who claims a reference or a content first, as keyed state of a stream.

``streaming.intake`` keeps claims in tables that each micro-batch looks up.  Here they live in
the state store of the stream, one entry per key: a reference is claimed by its first ad until the
claim ends, a content by the first new reference that brings it.  Status changes come as a second
kind of message under the same reference; what has been decided upon never ends.

Claims end by message time.  Behind that, the store drops an entry some time after its last
change (time to live), so it does not grow for ever; decisions are kept in an entry of their own
without an end.

A call into Python and its frames cost far more than the decision on a message.  So keys are dealt
to ``BUCKETS`` groups of which each holds a map of entries: a call decides all messages of a group
in one micro-batch, and asks the store once for each key in it.  These messages are put into order
in memory, as narrow rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stellwerk import fixed

#: The store that keeps states of any number on disk.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MESSAGE = "ref STRING, status STRING, seq BIGINT, us BIGINT, fp STRING, rejected BOOLEAN"
JUDGED = "seq BIGINT, ref STRING, us BIGINT, fp STRING, rejected BOOLEAN, fresh BOOLEAN"
OUTCOME = "seq BIGINT, referenznummer STRING, outcome STRING"
#: Groups of keys.  Part of what a checkpoint holds: a stream goes on with the number it began with.
BUCKETS = 256


def with_store(spark: SparkSession) -> SparkSession:
    """Streams that start from now on use the store on disk.

    They make no micro-batch without messages: entries whose time is over leave the store with the
    next messages, and a run over all that is there comes to an end.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return spark


def ad_messages(ads: DataFrame, ref: str, seq: Column, ts: str, fp: Column, rejected: Column) -> DataFrame:
    return ads.select(
        F.col(ref).alias("ref"), F.lit(None).cast("string").alias("status"), seq.cast("long").alias("seq"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), fp.alias("fp"), rejected.alias("rejected"),
    )


def status_messages(changes: DataFrame, ref: str, status: Column, seq: Column, ts: str) -> DataFrame:
    return changes.select(
        F.col(ref).alias("ref"), status.alias("status"), seq.cast("long").alias("seq"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), F.lit(None).cast("string").alias("fp"),
        F.lit(False).alias("rejected"),
    )


def _key(name: object) -> tuple[str]:
    """A reference or content as a key of the store; a missing one is a key of its own."""
    return ("" if pd.isna(name) else f"={name}",)


class References(StatefulProcessor):
    """Which ads are the first of their reference, with regard to what was decided."""

    def __init__(self, keep_us: int, store_ms: int) -> None:
        self.keep_us, self.store_ms = keep_us, store_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.claims = handle.getMapState("claims", "ref STRING", "ends BIGINT", ttlDurationMs=self.store_ms)
        self.decisions = handle.getMapState("decisions", "ref STRING", "status STRING")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        every = pd.concat(list(rows)).sort_values(["us", "seq"], kind="stable")
        ends, decided, changed, moved = {}, {}, set(), set()
        fresh = []
        for ref, us, status in zip(map(_key, every["ref"]), every["us"], every["status"]):
            if ref not in ends:
                held, said = self.claims.getValue(ref), self.decisions.getValue(ref)
                ends[ref], decided[ref] = (held[0] if held else None), (said[0] if said else None)
            active = decided[ref] is not None or (ends[ref] is not None and ends[ref] > us)
            if status is None or pd.isna(status):
                fresh.append(not active)
                if not active:
                    ends[ref] = int(us) + self.keep_us
                    changed.add(ref)
                continue
            fresh.append(False)
            if active and (status != fixed.FOUND or decided[ref] is not None):
                decided[ref] = status if status != fixed.FOUND else None
                moved.add(ref)
        for ref in changed:
            self.claims.updateValue(ref, (ends[ref],))
        for ref in moved:
            if decided[ref] is not None:
                self.decisions.updateValue(ref, (decided[ref],))
            else:
                self.decisions.removeKey(ref)
        out = every.assign(fresh=fresh)
        yield out[every["status"].isna()][["seq", "ref", "us", "fp", "rejected", "fresh"]]

    def close(self) -> None:
        pass


class Contents(StatefulProcessor):
    """Which of the fresh ads bring a content that nobody has claimed."""

    def __init__(self, keep_us: int, store_ms: int) -> None:
        self.keep_us, self.store_ms = keep_us, store_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.claims = handle.getMapState("claims", "fp STRING", "ends BIGINT", ttlDurationMs=self.store_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        every = pd.concat(list(rows)).sort_values(["us", "seq"], kind="stable")
        ends, changed = {}, set()
        outcomes = []
        for us, fp, fresh, rejected in zip(every["us"], every["fp"], every["fresh"], every["rejected"]):
            if not fresh:
                outcomes.append(fixed.KNOWN)
                continue
            if not pd.isna(fp):
                content = _key(fp)
                if content not in ends:
                    held = self.claims.getValue(content)
                    ends[content] = held[0] if held else None
                if ends[content] is not None and ends[content] > us:
                    outcomes.append(fixed.DUPLICATE)
                    continue
                ends[content] = int(us) + self.keep_us
                changed.add(content)
            outcomes.append(fixed.EXCLUDED if rejected else fixed.FORWARDED)
        for content in changed:
            self.claims.updateValue(content, (ends[content],))
        yield pd.DataFrame({"seq": every["seq"], "referenznummer": every["ref"], "outcome": outcomes})

    def close(self) -> None:
        pass


def outcomes(messages: DataFrame, keep_seconds: int, store_seconds: int | None = None) -> DataFrame:
    """(seq, referenznummer, outcome) for every ad of a stream of ``MESSAGE`` rows.

    ``store_seconds`` is the time to live in the store, by the clock of the machines; it is twice
    the time of a claim unless stated.
    """
    keep_us = keep_seconds * 1_000_000
    store_ms = 1000 * (2 * keep_seconds if store_seconds is None else store_seconds)
    bucket = lambda of: F.pmod(F.xxhash64(of), F.lit(BUCKETS)).cast("int")
    judged = messages.withColumn("bucket", bucket(F.col("ref"))).groupBy("bucket").transformWithStateInPandas(
        References(keep_us, store_ms), JUDGED, "append", "ProcessingTime"
    )
    # Ads that claim no content pass spread over the groups and leave no state.
    own = F.concat(F.lit("-"), F.col("seq").cast("string"))
    content = F.when(F.col("fresh") & F.col("fp").isNotNull(), F.col("fp")).otherwise(own)
    return (
        judged.withColumn("bucket", bucket(content))
        .groupBy("bucket")
        .transformWithStateInPandas(Contents(keep_us, store_ms), OUTCOME, "append", "ProcessingTime")
    )
