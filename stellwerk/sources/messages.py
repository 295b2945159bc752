"""Keyed JSON messages on the two topics, on Kafka or in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellwerk import schema

RAW_TOPIC = "jobs.raw"
MATCHED_TOPIC = "jobs.matched"


def keyed(ads: DataFrame, ref: str = "referenznummer", more: tuple[str, ...] = ()) -> DataFrame:
    """(key, value): rows without a reference cannot be recognised later and are left out.

    The columns ``more`` stay beside the message instead of going into its body.
    """
    named = ads.filter(F.length(ref) > 0)
    body = F.struct(*[F.col(f"`{c}`") for c in ads.columns if c not in more])
    return named.select(F.col(ref).alias("key"), F.to_json(body).alias("value"), *more)


def publish(
    ads: DataFrame,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    topic: str = RAW_TOPIC,
    ref: str = "referenznummer",
) -> dict[str, int]:
    """Write messages and report how many were written and how many had no reference.

    The same key always goes to the same partition, which keeps the order per ad.
    """
    seen = Observation("published")
    has_ref = F.coalesce(F.length(ref) > 0, F.lit(False))
    counted = ads.observe(
        seen, F.count_if(has_ref).alias("published"), F.count_if(~has_ref).alias("skipped")
    )
    messages = keyed(counted, ref)
    if kafka is not None:
        options = {"kafka.acks": "all", **kafka}
        messages.write.format("kafka").options(**options).option("topic", topic).save()
    else:
        messages.write.mode("append").parquet(path)
    return {name: int(n) for name, n in seen.get.items()}


def consume(
    spark: SparkSession,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    topic: str = RAW_TOPIC,
    max_files: int | None = None,
) -> DataFrame:
    """Stream of (key, value, partition, offset, timestamp), from the earliest message on.

    Offsets are committed by the query's checkpoint once a micro-batch is complete.
    File messages bring partition, offset and timestamp as columns.
    """
    if kafka is not None:
        return (
            spark.readStream.format("kafka")
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .options(**kafka)
            .load()
            .select(
                F.col("key").cast("string"),
                F.col("value").cast("string"),
                "partition",
                "offset",
                "timestamp",
            )
        )
    reader = spark.readStream.schema(schema.MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def decode_matched(messages: DataFrame) -> DataFrame:
    """Ads of the matched topic with their ``enrichment``, seq (the offset) and ts."""
    known = F.from_json("value", f"enrichment STRUCT<{schema.ENRICHMENT}>")["enrichment"]
    ads = decode(messages.withColumn("enrichment", known))
    return ads.withColumnRenamed("offset", "seq").withColumnRenamed("timestamp", "ts").drop("key", "partition", "broken")


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Replace the message body by the ad's columns and ``broken``.

    A body that is no JSON object is marked broken, with all ad columns null.  Both
    spellings of the external address are read.
    """
    layout = T.StructType.fromDDL(schema.AD)
    whole = T.StructType([*layout.fields, T.StructField("_broken", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = messages.withColumn("_ad", F.from_json(value, whole, options))
    # A second look at the text is needed only where the older spelling occurs.
    older = F.when(
        F.contains(F.col(value), F.lit("externeUrl")), F.get_json_object(value, "$.externeUrl")
    )
    ad = F.col("_ad")
    columns = {
        f.name: F.coalesce(ad[f.name], older) if f.name == "externeURL" else ad[f.name]
        for f in layout
    }
    broken = ad.isNull() | ad["_broken"].isNotNull()
    others = [c for c in messages.columns if c != value]
    return parsed.select(
        *others, *[c.alias(name) for name, c in columns.items()], broken.alias("broken")
    )
