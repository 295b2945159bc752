"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  All are ordinary run-time settings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if that costs another shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

#: Setting with the number of partitions that a scan of texts is dealt out to; unset or 0: none.
SPREAD = "stellwerk.spread"


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a scan, dealt out as ``SPREAD`` says.

    A scan gives one task per row group.  A caller with few row groups and many cores sets the
    number of partitions; a large table has row groups enough and is never shuffled for this.
    """
    partitions = int(rows.sparkSession.conf.get(SPREAD, "0"))
    return rows.repartition(partitions) if partitions else rows


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else has made.

    Python workers on this machine find the library; on a cluster it is installed.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    root, paths = str(Path(__file__).parents[1]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), root]))
    return spark


@contextlib.contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the batch work inside a micro-batch.

    A stream switches it off for its own plan; joins and aggregations on the rows of one
    micro-batch are ordinary batch queries and need it as any other.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cpus: int | str = "*", memory: str = "16g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stellwerk")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Plans here are built from many small columns; do not record where each was made.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        # The tables of one machine have few row groups.
        .config(SPREAD, str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    A folder set on the context counts as well.  Only on one machine, where none is named, a
    fresh one is made and remembered for the rest of the session; on a cluster a folder of
    one machine would be lost with it, so there one has to be named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[[^-]*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="stellwerk-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later steps do not recompute it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, as a table in the shared folder.

    For loops: a checkpoint hands what is known of its columns on to the next plan, and that
    knowledge doubles with every round of a join with itself.
    """
    path = fresh_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
