"""The log of accepted events, keeping source coordinates, and bounded reads of logs.

A write has a name and replaces what was written under it, so a retried one adds nothing. A bounded read first captures where each
source partition ends; what is added while it runs is left out, and everything before is read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.functions.columns import log_name, source_topic, topic
from clickweave.schemas import VIEW_TOPIC

#: Last position per topic and partition.
Ends = Mapping[tuple[str, int], int]


def write_log(accepted: DataFrame, path: str, write: str = "0") -> None:
    accepted.withColumn("log", log_name()).drop("is_view").write.mode("overwrite").partitionBy("log").parquet(f"{path}/write={write}")


def read_log(
    spark: SparkSession, path: str, schema: T.StructType, ends: Ends | None = None, position: str = "offset",
) -> DataFrame:
    """The log as event rows of `schema`, up to `ends` or whole."""
    stored = T.StructType([*(field for field in schema if field.name != "is_view"), T.StructField("log", T.StringType())])
    rows = spark.read.schema(stored).parquet(path).withColumn("is_view", source_topic("log") == VIEW_TOPIC)
    return (rows if ends is None else up_to(rows, ends, position)).select(*schema.names)


def _topic(rows: DataFrame) -> Column:
    return F.col("topic") if "topic" in rows.columns else topic()


def captured(rows: DataFrame, position: str = "offset") -> dict[tuple[str, int], int]:
    """Where each source partition ends now; one row per source partition is collected."""
    last = rows.groupBy(_topic(rows).alias("topic"), "partition").agg(F.max(position).alias("last")).collect()
    return {(row.topic, row.partition): row["last"] for row in last}


def up_to(rows: DataFrame, ends: Ends, position: str = "offset") -> DataFrame:
    """Rows at or before the captured ends; partitions that had none then are left out."""
    known = rows.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*(
        F.struct(F.lit(of_topic).alias("_topic"), F.lit(partition).alias("_partition"), F.lit(last).cast("bigint").alias("_last"))
        for (of_topic, partition), last in ends.items()
    )))) if ends else rows.sparkSession.createDataFrame([], "_topic string, _partition int, _last bigint")
    before = (_topic(rows) == F.col("_topic")) & (F.col("partition") == F.col("_partition")) & (F.col(position) <= F.col("_last"))
    return rows.join(F.broadcast(known), before, "left_semi")  # one row per source partition
