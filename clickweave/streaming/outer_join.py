"""Emit-once attribution from Spark's own streaming operators: a watermarked left outer join, then the latest click per view.

Coarser than the journal: there is one watermark for the whole query, the smaller of both topics' latest event times less the allowed
lateness. It moves between batches, and an event on it or before it is dropped. A view is written once the watermark is a
window past it.

The join's keys hold the time slice beside the user, so a user's state and work are spread over many keys: a click is sent to
its own slice and to the next one, which together hold all views it can reach. The join lists the click-view pairs of a slice before they are
aggregated, so a user with very many clicks within one window is better left to the journal.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.columns import micros
from clickweave.operators import attribution, lateness
from clickweave.schemas import CLICK_TOPIC, RECORD, VIEW_TOPIC
from clickweave.session import shuffled_into
from clickweave.sources import records

#: Event time of the records that close a finite input; no slice of real events reaches it.
END = "9000-01-01T00:00:00"


def _events(stream: DataFrame, views: bool, allowed_lateness: timedelta) -> DataFrame:
    delay = f"{micros(allowed_lateness) // 1000} milliseconds"
    events = records.good(records.decode(stream)).filter(F.col("is_view") == views)
    return events.withWatermark("event_time", delay)


def attributed(
    view_stream: DataFrame, click_stream: DataFrame,
    window: timedelta = attribution.WINDOW, allowed_lateness: timedelta = lateness.LATENESS,
) -> DataFrame:
    """The result rows of a record stream, for append mode. The stream is read twice, once for each topic."""
    width = micros(window) + 1
    slice_of = F.floor(F.unix_micros("event_time") / F.lit(width)).cast("bigint")
    views = _events(view_stream, True, allowed_lateness).select(
        "id", "user_id", "event_time", "label", slice_of.alias("slice"))
    clicks = _events(click_stream, False, allowed_lateness).select(
        F.col("user_id").alias("click_user"), F.col("event_time").alias("click_time"), F.col("id").alias("click_id"),
        F.col("label").alias("campaign_id"), "offset", "partition", F.explode(F.array(slice_of, slice_of + 1)).alias("click_slice"),
    )
    joined = views.join(
        clicks,
        (F.col("user_id") == F.col("click_user")) & (F.col("slice") == F.col("click_slice"))
        & (F.col("click_time") <= F.col("event_time")) & (F.col("click_time") >= F.col("event_time") - F.lit(window)),
        "leftOuter",
    )
    found = F.col("click_id").isNotNull()
    click = F.max_by(
        F.when(found, F.struct(F.col("click_id").alias("id"), F.col("campaign_id").alias("label"))),
        F.when(found, F.struct("click_time", "offset", "partition")),
    )
    return (
        joined.groupBy("event_time", "id", "user_id", "label").agg(click.alias("click"))
        .filter(F.col("event_time") < F.lit(END).cast("timestamp"))
        .select(*attribution.result_columns())
    )


def closing_records(spark: SparkSession) -> DataFrame:
    """A record for each topic beyond all others, which lets the watermark pass the last views of a finite input."""
    payload = '"user_id":"","event_time":"' + END + '"'
    rows = spark.range(0, 1, 1, 1).select(F.explode(F.array(
        F.struct(F.lit(VIEW_TOPIC).alias("topic"), F.lit(f'{{{payload},"url":"","event_id":""}}').alias("value")),
        F.struct(F.lit(CLICK_TOPIC).alias("topic"), F.lit(f'{{{payload},"campaign_id":"","click_id":""}}').alias("value")),
    )).alias("row")).select("row.topic", F.lit(-1).alias("partition"), F.lit(0).cast("bigint").alias("offset"), "row.value")
    return rows.select(*RECORD.names)


def start(
    result: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "1 minute", partitions: int | None = None,
):
    """Write the results to parquet files, each row once.

    `partitions`, of the state, is the session's number of shuffle partitions if not given; a checkpoint keeps its own.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with shuffled_into(result.sparkSession, partitions):
        return (
            result.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )
