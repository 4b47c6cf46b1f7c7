"""Record layouts.

Both streams travel in one layout, the *event* row, so that a single scan, shuffle and sort serves
clicks and views together:

    is_view, partition, user_id, event_time, id, label, <arrival order columns>

`id` is the click or view id, `label` the campaign or url. The arrival order columns order the rows of
a topic: `offset` and then `partition` where a log supplies them, or any other unique ascending columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLICK_TOPIC = "ad_clicks"
VIEW_TOPIC = "page_views"

OFFSET_ORDER = ("offset", "partition")

CLICK_PAYLOAD = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("click_id", T.StringType()),
])

VIEW_PAYLOAD = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("event_id", T.StringType()),
])

# What a log source delivers: coordinates and an undecoded payload.
RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])

EVENT = T.StructType([
    T.StructField("is_view", T.BooleanType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("id", T.StringType()),
    T.StructField("label", T.StringType()),
])

ATTRIBUTED = T.StructType([
    T.StructField("page_view_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("url", T.StringType()),
    T.StructField("attributed_campaign_id", T.StringType()),
    T.StructField("attributed_click_id", T.StringType()),
])


def as_events(clicks: DataFrame, views: DataFrame) -> DataFrame:
    """Merge separate click and view tables into event rows; further columns (arrival order) are kept.

    Tables without `partition` come from one source partition.
    """
    merged = (
        clicks.withColumnsRenamed({"click_id": "id", "campaign_id": "label"})
        .withColumn("is_view", F.lit(False))
        .unionByName(
            views.withColumnsRenamed({"event_id": "id", "url": "label"}).withColumn("is_view", F.lit(True)),
            allowMissingColumns=True,
        )
    )
    return merged if "partition" in merged.columns else merged.withColumn("partition", F.lit(0))
