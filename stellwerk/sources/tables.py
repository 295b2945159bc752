"""Archive, detail, seen, salary, corpus and tracker tables on files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellwerk import schema
from stellwerk.functions.dates import partition_day
from stellwerk.operators.archive import one_per_day
from stellwerk.operators.profile import readable
from stellwerk.session import fresh_path

# Partition columns of the archive.
DAY = ("jahr", "monat", "tag")


def write_archive(rows: DataFrame, path: str, day: str = "tag", seq: str = "seq") -> None:
    """Write ads under jahr=/monat=/tag=, the last arrival per reference and day.

    An ad that is there already under the same reference and day is replaced, all others of
    the day stay.  The days concerned are put together in the shared folder first, because a
    partition cannot be read while it is replaced.  Rows are spread by day and reference, so a
    large day becomes several files.
    """
    last = one_per_day(rows, day=day, seq=seq)
    dated = last.withColumns(
        {
            "jahr": F.date_format(day, "yyyy"),
            "monat": F.date_format(day, "MM"),
            "_tag": F.date_format(day, "dd"),
        }
    ).drop(day, seq)
    dated = dated.withColumnRenamed("_tag", "tag")
    spark = rows.sparkSession
    if exists(spark, path):
        staged = fresh_path(spark, "archive")
        dated.write.parquet(f"{staged}/new")
        dated = spark.read.schema(dated.schema).parquet(f"{staged}/new")
        layout = T.StructType([f for f in dated.schema if f.name not in DAY])
        for name in DAY:
            layout = layout.add(name, "string")
        there = spark.read.schema(layout).parquet(path)
        there = there.join(dated.select(*DAY).distinct(), list(DAY), "left_semi")
        kept = there.join(dated.select("referenznummer", *DAY), ["referenznummer", *DAY], "left_anti")
        dated.unionByName(kept).write.parquet(f"{staged}/all")
        dated = spark.read.schema(dated.schema).parquet(f"{staged}/all")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY)
        .parquet(path)
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, wherever Spark can read."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_archive(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The archive with its day as ``tag``; ``since`` prunes partitions before any file opens.

    A partition whose name is no date is read only if no period is asked for.
    """
    layout = T.StructType.fromDDL(schema.AD)
    for name in ("jahr", "monat", "tag"):
        layout = layout.add(name, "string")
    day = partition_day(F.col("jahr"), F.col("monat"), F.col("tag"))
    rows = spark.read.schema(layout).parquet(path)
    if since is not None:
        # Compared as the directory names are written: simple terms on partition columns.
        name = F.concat_ws("-", "jahr", "monat", "tag")
        rows = rows.filter((F.col("jahr") >= f"{since:%Y}") & (name >= f"{since:%Y-%m-%d}"))
        rows = rows.filter(day.isNotNull())
    return rows.withColumn("tag", day).drop("jahr", "monat")


def landed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Landed JSON lines with the file they came from and, if a line is none, the line (``broken``)."""
    layout = T.StructType.fromDDL(ddl).add("_broken", "string")
    rows = spark.read.schema(layout).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    return rows.withColumn("file", F.col("_metadata.file_path")).withColumnRenamed("_broken", "broken")


def accepted(rows: DataFrame) -> DataFrame:
    """The lines that could be read; ``file`` stays."""
    return rows.filter(F.col("broken").isNull()).drop("broken")


def rejects(rows: DataFrame, ref: str = "referenznummer") -> DataFrame:
    """(file, lines, rejected, without_ref): what of each file could be used."""
    good = F.col("broken").isNull()
    return rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~good).alias("rejected"),
        F.count_if(good & ~F.coalesce(F.length(ref) > 0, F.lit(False))).alias("without_ref"),
    )


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """Details landed as one JSON object per line."""
    return spark.read.schema(schema.DETAIL).option("mode", "PERMISSIVE").json(path)


def read_salaries(spark: SparkSession, path: str) -> DataFrame:
    """Salary answers (a JSON array per file); ``pos`` keeps the order of the rows."""
    rows = spark.read.schema(schema.SALARY).option("multiLine", True).json(path)
    return rows.withColumn("pos", F.monotonically_increasing_id())


def read_corpus(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(readable documents, silent documents) of the .txt and .md files of a folder."""
    files = spark.read.option("pathGlobFilter", "*.{txt,md}").text(folder, wholetext=True)
    named = files.withColumn("path", F.element_at(F.split(F.input_file_name(), "/"), -1))
    enough = readable(F.col("value"))
    return named.filter(enough), named.filter(~enough).select("path")
