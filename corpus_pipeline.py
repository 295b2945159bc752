"""A corpus pipeline: identify languages, drop near copies, replace personal data, mix, tokenize.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  :func:`run` writes the result of each stage to the shared folder and hands it on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellwerk.llm import bpe, jaccard, langid, mixing, pii
from stellwerk.llm.common import at_workers, fold, stored
from stellwerk.llm.queries import VOCABULARY

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: No SQL: language models, tokenizers and keyed surrogates.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    Those without a letter go, and those of which no language has more than half of the evidence.
    A missing ``lang`` is filled in; a stated one stays.
    """
    at_workers(spark)
    model = langid.fit(docs.where(fold("doc_id", 4) != 2))
    said = langid.identified(docs, model).where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") > 0.5))
    return said.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest id; one without an id comes last.

    Every row is a document of its own, so repeated rows and rows that share an id, or have none,
    are compared like all others.  Of rows without a word one stays for each id.
    """
    at_workers(spark)
    # A row is known by its file and its place in it, however a scan is split.
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("nth"))
    rows = scanned(docs).select(place.alias("row"), *COLUMNS)
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row").alias("doc_id")
    least = jaccard.grouped(rows.select(named, "text")).where(F.col("doc_id") == F.col("component_id"))
    same = F.when(F.col("n_shingles") > 0, F.col("doc_id.row")).alias("same")
    kept = least.groupBy("doc_id.unnamed", "doc_id.doc_id", same).agg(F.min("doc_id.row").alias("row"))
    return rows.join(kept.select("row"), "row", "left_semi").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data; n_chars follows the text."""
    out = pii.replaced(docs)
    changed = F.when(F.col("n_replaced") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training.

    Documents stay whole: the one in which a source's target is reached is taken if at least half
    of its words are.  The order is that of the partitions and of the rows in them.  Written by
    ``stored``, a partition is a file with its number in the name, and a row keeps its place in it.
    """
    # The documents are a stored table: a scan numbers its rows the same way each time.
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), *COLUMNS)
    mixed = mixing.mixed(numbered.select("row", "doc_id", "source", "text")).select("row", "size", "takes")
    mixed = mixed.withColumn("takes", F.filter("takes", lambda x: x["words"] * 2 >= F.col("size")))
    full = numbered.join(mixed.where(F.size("takes") > 0), "row").select(*COLUMNS, F.explode("takes").alias("take"))
    full = full.select(*COLUMNS, "take.position", "take.copy").repartitionByRange("position", "doc_id", "copy")
    return full.sortWithinPartitions("position", "doc_id", "copy").select(*COLUMNS)


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` as a scan of files: a stage's input is one; anything else is stored first."""
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = stored(docs, "ordered")
    return docs


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``, the place of each row: 0, 1, 2 ... along the files of a table.

    A scan packs files by size, so the order of its rows tells nothing.  Files follow each other by
    the number in their names.  What is no scan of files is stored first.
    """
    docs = scanned(docs).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("nth"))
    # A row for each file: small enough for one task.
    files = docs.groupBy("file").agg((F.max("nth") + 1).alias("rows"))
    number = F.regexp_extract("file", r"^part-(\d+)", 1).try_cast("long")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return docs.join(F.broadcast(files), "file").withColumn("position", F.col("start") + F.col("nth")).drop("file", "nth", "start")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids and its position in the order of training."""
    at_workers(spark)
    ids = bpe.encoded(F.col("text"), VOCABULARY, public_tokenizers.PATTERN)
    out = placed(docs).withColumn("token_ids", ids)
    return out.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "position")


STAGES = [
    ("language", language),
    ("deduplicate", deduplicate),
    ("personal_data", personal_data),
    ("mix", mix),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = at_workers(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
