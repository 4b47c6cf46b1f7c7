"""Watermarks per source partition and the strict lateness rule.

The watermark of a (topic, partition) is the latest event time seen so far in arrival order. An event
is late when it lies more than the allowed lateness before the watermark its predecessors left. Late
events lie below the watermark, so they never move it, and the running maximum over all earlier rows
equals the one over accepted rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.columns import topic, watermark_key
from clickweave.operators.scan import Fold, running
from clickweave.schemas import OFFSET_ORDER

LATENESS = timedelta(minutes=15)

SOURCE = ("is_view", "partition")


def is_late(lateness: timedelta) -> Column:
    """Strictly before the cutoff; an event on the cutoff, or the first of its partition, is kept."""
    return F.coalesce(F.col("event_time") < F.col("watermark_before") - F.lit(lateness), F.lit(False))


def judge(
    events: DataFrame,
    lateness: timedelta = LATENESS,
    order: Sequence[str] = OFFSET_ORDER,
    carried: DataFrame | None = None,
    **scan,
) -> DataFrame:
    """Add `watermark_before` and `late`.

    `carried` holds the watermarks earlier batches left (`is_view, partition, watermark`), one row per
    source partition.
    """
    judged = running(
        events, SOURCE, order, {"watermark_before": Fold("max", "event_time", before=True)}, **scan
    )
    if carried is not None:
        judged = (
            judged.join(F.broadcast(carried), list(SOURCE), "left")
            .withColumn("watermark_before", F.greatest("watermark_before", "watermark"))
            .drop("watermark")
        )
    return judged.withColumn("late", is_late(lateness))


def advances() -> Column:
    """Whether a judged event moves its partition's watermark."""
    return F.coalesce(F.col("event_time") > F.col("watermark_before"), F.lit(True))


def final_watermarks(events: DataFrame) -> DataFrame:
    """Watermark per source partition after the last event."""
    return events.groupBy(*SOURCE).agg(F.max("event_time").alias("watermark"))


def slowest_watermarks(final: DataFrame) -> DataFrame:
    """Minimum over the partitions seen, per topic."""
    return final.groupBy("is_view").agg(F.min("watermark").alias("watermark"))


def named(watermarks: DataFrame, of_topic: str | None = None) -> DataFrame:
    """Watermarks under their `topic:partition` keys, optionally those of one topic."""
    keyed = watermarks.select(watermark_key().alias("wm_key"), "watermark")
    return keyed if of_topic is None else keyed.filter(F.col("wm_key").startswith(f"{of_topic}:"))


def evictable(events: DataFrame, window: timedelta, lateness: timedelta) -> DataFrame:
    """How many accepted clicks and views no future event can need, at the end of the input.

    A click serves views up to `window` after it, so it goes once the slowest view partition is past
    that by the lateness. A view is needed until the slowest click partition is past it by the lateness.
    """
    keep_for = F.when(F.col("is_view"), F.lit(window + lateness)).otherwise(F.lit(lateness))
    cutoffs = slowest_watermarks(final_watermarks(events)).select(
        (~F.col("is_view")).alias("is_view"),  # each topic is held for the other one
        (F.col("watermark") - keep_for).alias("cutoff"),
    )
    gone = F.coalesce(F.col("event_time") < F.col("cutoff"), F.lit(False))
    return (
        events.filter(~F.col("late"))
        .join(F.broadcast(cutoffs), "is_view", "left")  # one row per topic
        .groupBy("is_view", "cutoff")
        .agg(F.count_if(gone).alias("evictable"), F.count_if(~gone).alias("retained"))
        .select(topic().alias("topic"), "cutoff", "evictable", "retained")
    )
