"""Click and view streams derived from the `events` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.operators.scan import Fold, running

# The table has no arrival time of its own: rows arrive up to an hour late, by a fixed rule.
ARRIVAL_ORDER = ("arrival", "seq")
ARRIVAL_FACTOR, ARRIVAL_SPREAD_S = 7919, 3600
PARTITIONS = 3

# Given rather than read from the files, which would take a job per query.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def _arrival() -> Column:
    delay = (F.col("event_id") * ARRIVAL_FACTOR) % ARRIVAL_SPREAD_S
    return F.col("ts") + F.make_dt_interval(secs=delay)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and views as event rows, in one pushed-down scan."""
    is_view = F.col("event_type") == "view"
    k = F.get_json_object("props", "$.k")
    return (
        spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
        .filter(F.col("event_type").isin("click", "view"))
        .select(
            is_view.alias("is_view"),
            (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("ts").alias("event_time"),
            F.col("event_id").cast("string").alias("id"),
            F.concat(F.when(is_view, "/k/").otherwise("campaign_"), k).alias("label"),
            _arrival().alias("arrival"),
            F.col("event_id").alias("seq"),
        )
    )


def with_offsets(rows: DataFrame, **scan) -> DataFrame:
    """Number each partition's rows in arrival order from 0, as a log would."""
    return running(
        rows, ("is_view", "partition"), ARRIVAL_ORDER,
        {"offset": Fold("sum", F.lit(1).cast("bigint"))}, **scan,
    ).withColumn("offset", F.col("offset") - 1)
