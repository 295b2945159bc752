"""The intake stream: archive, recognise, filter, enrich, forward.

Each micro-batch runs the batch operators.  What a batch has to remember - which
references and fingerprints are claimed - is kept in two tables of narrow rows.  Every
write of a batch goes to a folder named after the batch and replaces it, and claims of
the batch itself are not read, so a batch that is run again after a failure gives the
same result.

Claims are laid out in buckets of their key: a small batch reads only the buckets it can
hit, while a large one reads the table once for many rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stellwerk import fixed, schema
from stellwerk.functions.ad import description, requirement_text
from stellwerk.functions.catalog import Catalog
from stellwerk.functions.dates import age_days, published_on
from stellwerk.functions.defaults import SKILLS
from stellwerk.functions.fingerprint import ad_fingerprint, claim_key
from stellwerk.functions.places import reported_km
from stellwerk.functions.predicates import exclusion_text, passes
from stellwerk.functions.score import Profile, focus_hits, shown_points, with_rating
from stellwerk.operators.archive import unexpired
from stellwerk.operators.dedup import outcomes
from stellwerk.operators.details import lacks_text, with_detail
from stellwerk.session import adaptive
from stellwerk.sources.messages import MATCHED_TOPIC, decode, keyed
from stellwerk.sources.tables import write_archive


@dataclass(frozen=True)
class Rules:
    """What is filtered and how ads are rated.  Without a profile nothing is rated."""

    excluded: tuple[str, ...] = fixed.EXCLUDED_TERMS
    required: tuple[str, ...] = ()
    employers: tuple[str, ...] = fixed.EXCLUDED_EMPLOYERS
    profile: Profile | None = None
    catalog: Catalog = field(default=SKILLS, repr=False)
    keep_days: int = fixed.SEEN_DAYS

    def rejects(self) -> Column:
        text = exclusion_text(
            F.col("stellenangebotsTitel"), F.col("hauptberuf"), F.col("alleBerufe")
        )
        return ~passes(F.col("firma"), text, self.excluded, self.required, self.employers)


@dataclass(frozen=True)
class Folders:
    """Where the stream keeps its tables; all below one shared root.

    ``buckets`` is the number of parts of the claim tables.  It stays the same for the
    life of the tables; a bucket should be small enough to be read for a few keys.
    """

    root: str
    buckets: int = 32

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def part(self, name: str, batch_id: int) -> str:
        return f"{self.table(name)}/batch_id={batch_id}"


    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")


def read_table(spark: SparkSession, path: str, ddl: str | T.StructType) -> DataFrame:
    """A table of the stream, empty before its first batch."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


OUTCOMES = (fixed.KNOWN, fixed.DUPLICATE, fixed.EXCLUDED, fixed.FORWARDED)
# Columns of a message on its way that are no part of the ad.
HELPERS = ("key", "partition", "offset", "timestamp", "body", "broken", "seq", "fp", "erfasst_am", "outcome")
SEEN_TABLE = schema.SEEN + ", batch_id BIGINT, bucket INT"
CLAIM_TABLE = schema.CLAIM + ", batch_id BIGINT, bucket INT"


def _known(
    table: DataFrame, incoming: DataFrame, key: str, batch_id: int, folders: Folders
) -> DataFrame:
    """Keys of the batch that an earlier batch claimed.

    The numbers of the buckets the batch can hit (at most ``folders.buckets``) are looked
    up first, so that the scan leaves all other buckets out.
    """
    keys = incoming.select(key).dropna().distinct()
    keys = keys.withColumn("bucket", folders.bucket_of(F.col(key)))
    hit = [r.bucket for r in keys.select("bucket").distinct().collect()]
    earlier = table.filter(F.col("bucket").isin(hit) & (F.col("batch_id") != batch_id))
    return keys.join(earlier.select(key), key, "left_semi").select(key)


def enriched(ads: DataFrame, rules: Rules, detail: DataFrame | None, as_of: Column) -> DataFrame:
    """Add the struct ``enrichment``: age, distance, and the rating if there is a profile.

    No step drops a row; what cannot be read is null.
    """
    full = with_detail(ads, detail, lacks_text(agency_only=False))
    new, old = fixed.DESCRIPTION_FIELDS
    own = [F.col(new), F.col(old)]
    more = [] if detail is None else [F.col(f"detail.{new}"), F.col(f"detail.{old}")]
    age = age_days(published_on(), as_of).alias("alter_tage")
    km = reported_km().alias("entfernung_km")
    if rules.profile is None:
        return full.withColumn("enrichment", F.struct(age, km)).drop("detail")
    text = requirement_text(
        F.col("stellenangebotsTitel"),
        F.col("hauptberuf"),
        F.col("alleBerufe"),
        description(*more, *own),
    )
    rated = with_rating(full, F.col("stellenangebotsTitel"), text, rules.profile, rules.catalog)
    r = F.col("rating")
    return rated.withColumn(
        "enrichment",
        F.struct(
            age,
            km,
            r["stufe"].alias("stufe"),
            shown_points(r).alias("punkte"),
            r["treffer"].alias("treffer"),
            r["luecken"].alias("luecken"),
            focus_hits(r["treffer"], rules.profile).alias("schwerpunkte"),
        ),
    ).drop("detail", "rating", "labels", "title_labels")


def judged(
    ads: DataFrame, rules: Rules, known_refs: DataFrame | None, known_fps: DataFrame | None
) -> DataFrame:
    """Ads with ``seq`` and ``fp`` (the claim key) get their ``outcome``."""
    return outcomes(ads, rules.rejects(), known_refs, known_fps)


def process(
    messages: DataFrame,
    batch_id: int,
    folders: Folders,
    rules: Rules,
    detail: DataFrame | None = None,
) -> None:
    """One micro-batch.  ``messages`` has the message columns; time is message time."""
    spark = messages.sparkSession
    keyed = messages.filter(F.length("key") > 0)
    # Position in the batch: partitions one after the other, each in its own order.
    seq = F.shiftleft(F.col("partition").cast("long"), 44) + F.col("offset")
    # The message key is the reference, whatever the body says.
    decoded = (
        decode(keyed.withColumn("body", F.col("value")))
        .withColumn("referenznummer", F.col("key"))
        .withColumn("seq", seq)
        .withColumn("fp", claim_key(ad_fingerprint()))
        .withColumn("erfasst_am", F.unix_timestamp("timestamp"))
        .persist()
    )
    try:
        # What is no JSON object is put aside, not lost and not in the way.
        decoded.filter("broken").select("key", "body", "partition", "offset").write.mode(
            "overwrite"
        ).parquet(folders.part("broken", batch_id))
        ads = decoded.filter("not broken").drop("body", "broken")
        # Unfiltered and unchanged, before anything is decided.  The last arrival of a reference
        # on a day replaces the ones before it, of this batch and of earlier ones.
        raw = ads.withColumn("tag", F.col("timestamp").cast("date"))
        write_archive(raw.drop(*(h for h in HELPERS if h != "seq")), folders.table("raw"))
        begin = ads.agg(F.min("erfasst_am")).scalar()
        seen = unexpired(read_table(spark, folders.table("seen"), SEEN_TABLE), begin)
        claims = read_table(spark, folders.table("claims"), CLAIM_TABLE).filter(
            F.col("ablauf_zeitpunkt") > begin
        )
        result = judged(
            ads,
            rules,
            _known(seen, ads, "referenznummer", batch_id, folders),
            _known(claims, ads, "fp", batch_id, folders),
        ).persist()
        try:
            _write_batch(result, batch_id, folders, rules, detail)
        finally:
            result.unpersist()
    finally:
        decoded.unpersist()


def _write_batch(
    result: DataFrame, batch_id: int, folders: Folders, rules: Rules, detail: DataFrame | None
) -> None:
    ends = F.col("erfasst_am") + rules.keep_days * 86400
    fresh = result.filter(F.col("outcome") != fixed.KNOWN)
    forwarded = enriched(
        result.filter(F.col("outcome") == fixed.FORWARDED),
        rules,
        detail,
        F.col("timestamp").cast("date"),
    )
    forwarded.write.mode("overwrite").parquet(folders.part("matched", batch_id))
    # The matched topic: one keyed message per forwarded ad, what is known of it included.  A key
    # stays in its partition, and its messages in the order of arrival.
    body = [c for c in forwarded.columns if c not in HELPERS]
    topic = forwarded.select("seq", "timestamp", *body)
    topic = keyed(topic, more=("seq", "timestamp")).select(
        "key",
        "value",
        F.pmod(F.xxhash64("key"), F.lit(folders.buckets)).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        "timestamp",
    )
    topic.repartition("partition").sortWithinPartitions("partition", "offset").write.mode(
        "overwrite"
    ).parquet(folders.part(MATCHED_TOPIC, batch_id))
    # Counted on the way, so that nobody has to read the outcomes again for a sum.
    counted = Observation("outcomes")
    (
        result.select("referenznummer", "seq", "outcome")
        .observe(counted, *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
        .write.mode("overwrite")
        .parquet(folders.part("outcomes", batch_id))
    )
    counts = [(o, int(counted.get[o])) for o in OUTCOMES]
    (
        result.sparkSession.createDataFrame(counts, "outcome STRING, ads BIGINT")
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(folders.part("counts", batch_id))
    )
    seen = fresh.select(
        "referenznummer",
        F.coalesce("stellenangebotsTitel", F.lit("")).alias("titel"),
        F.lit(fixed.FOUND).alias("status"),
        "erfasst_am",
        F.lit(None).cast("long").alias("geaendert_am"),
        ends.alias("ablauf_zeitpunkt"),
        folders.bucket_of(F.col("referenznummer")).alias("bucket"),
    )
    claims = fresh.filter(
        F.col("fp").isNotNull() & (F.col("outcome") != fixed.DUPLICATE)
    ).select(
        "fp",
        F.col("referenznummer").alias("zuerst_gesehen_als"),
        "erfasst_am",
        ends.alias("ablauf_zeitpunkt"),
        folders.bucket_of(F.col("fp")).alias("bucket"),
    )
    for name, rows in (("seen", seen), ("claims", claims)):
        # One file per bucket; keys are unique here, so buckets are of even size.
        (
            rows.repartition("bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(folders.part(name, batch_id))
        )


def start(
    messages: DataFrame,
    folders: Folders,
    rules: Rules,
    detail: DataFrame | None = None,
    available_now: bool = False,
    interval: str = "1 minute",
    on_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the stream; message offsets are committed after a batch is written."""

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            process(batch, batch_id, folders, rules, detail)
        if on_batch is not None:
            on_batch(batch_id)

    writer = messages.writeStream.foreachBatch(run).option(
        "checkpointLocation", folders.table("checkpoint")
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def outcome_counts(spark: SparkSession, folders: Folders) -> DataFrame:
    """(outcome, ads) over all batches, from the counts that every batch has left."""
    rows = read_table(spark, folders.table("counts"), "outcome STRING, ads BIGINT, batch_id BIGINT")
    return rows.filter("ads > 0").groupBy("outcome").agg(F.sum("ads").alias("ads"))
