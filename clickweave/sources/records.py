"""Log records: reading them as a stream, and decoding payloads into event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.functions.columns import format_time, parse_time
from clickweave.schemas import CLICK_PAYLOAD, CLICK_TOPIC, RECORD, VIEW_PAYLOAD, VIEW_TOPIC
from clickweave.sources import changelog

CORRUPT = "_corrupt"

# Both payloads in one, so that each record is parsed once whatever its topic.
PAYLOAD = T.StructType([
    *VIEW_PAYLOAD.fields,
    *(field for field in CLICK_PAYLOAD.fields if field.name not in VIEW_PAYLOAD.names),
    T.StructField(CORRUPT, T.StringType()),
])


def read_records(
    spark: SparkSession,
    topics: tuple[str, ...] = (CLICK_TOPIC, VIEW_TOPIC),
    *,
    bootstrap_servers: str | None = None,
    path: str | None = None,
    per_trigger: int | None = None,
) -> DataFrame:
    """Stream records from the start of the log.

    From Kafka (the connector must be on the classpath), bounded per trigger by offsets; or from a folder of
    record-shaped parquet files, bounded by files.
    """
    if bootstrap_servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .option("kafka.isolation.level", "read_committed")
        )
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.load().select(
            "topic", "partition", "offset", F.col("value").cast("string").alias("value")
        )
    if path is None:
        raise ValueError("name either bootstrap_servers or path")
    reader = spark.readStream.schema(RECORD)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path).filter(F.col("topic").isin(*topics))


def read_batch(
    spark: SparkSession,
    topics: tuple[str, ...] = (CLICK_TOPIC, VIEW_TOPIC),
    *,
    bootstrap_servers: str | None = None,
    path: str | None = None,
    ends: changelog.Ends | None = None,
) -> DataFrame:
    """Records from the start of the log up to `ends`, which `changelog.captured` finds, as a batch."""
    if bootstrap_servers:
        reader = (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .option("kafka.isolation.level", "read_committed")
        )
        rows = reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    elif path is None:
        raise ValueError("name either bootstrap_servers or path")
    else:
        rows = spark.read.schema(RECORD).parquet(path).filter(F.col("topic").isin(*topics))
    return rows if ends is None else changelog.up_to(rows, ends)


def refused_counts(decoded: DataFrame) -> DataFrame:
    """How many records of each topic are not processed, by reason."""
    return decoded.filter("reason IS NOT NULL").groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n_refused"))


def encode() -> Column:
    """An event row's payload as JSON text."""
    time = format_time(F.col("event_time")).alias("event_time")
    view = F.struct("user_id", time, F.col("label").alias("url"), F.col("id").alias("event_id"))
    click = F.struct("user_id", time, F.col("label").alias("campaign_id"), F.col("id").alias("click_id"))
    return F.when(F.col("is_view"), F.to_json(view)).otherwise(F.to_json(click))


def decode(records: DataFrame) -> DataFrame:
    """Records as event rows, with `reason` set on those that must not be processed.

    Unknown fields are ignored. A record is refused when its text is not a JSON object or one of the four
    payload fields is missing or unreadable.
    """
    # Generated rather than projected: a filter on the fields then cannot pull the parser in once per field.
    parsed = records.select("*", F.inline(F.array(F.from_json(
        "value", PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ))))
    is_view = F.col("topic") == VIEW_TOPIC
    fields = parsed.select(
        *records.columns,
        is_view.alias("is_view"),
        "user_id",
        parse_time(F.col("event_time")).alias("event_time"),
        F.when(is_view, F.col("event_id")).otherwise(F.col("click_id")).alias("id"),
        F.when(is_view, F.col("url")).otherwise(F.col("campaign_id")).alias("label"),
        CORRUPT,
    )
    missing = [F.when(F.col(name).isNull(), F.lit(name)) for name in ("user_id", "event_time", "id", "label")]
    return fields.withColumn(
        "reason",
        F.when(F.col("value").isNull() | F.col(CORRUPT).isNotNull(), "malformed")
        .otherwise(F.concat(F.lit("missing "), F.nullif(F.concat_ws(",", *missing), F.lit("")))),
    ).drop(CORRUPT)


def good(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason", "value", "topic")


def quarantined(decoded: DataFrame) -> DataFrame:
    stamp = [name for name in ("processed_at",) if name in decoded.columns]
    return decoded.filter(F.col("reason").isNotNull()).select("topic", "partition", "offset", "value", "reason", *stamp)
