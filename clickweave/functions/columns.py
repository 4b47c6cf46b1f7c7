"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweave.schemas import CLICK_TOPIC, VIEW_TOPIC

# Fixed value: accepted spellings of event time; no zone means UTC.
TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]"

LOG_SUFFIX = "-changelog"


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def topic() -> Column:
    return F.when(F.col("is_view"), VIEW_TOPIC).otherwise(CLICK_TOPIC)


def watermark_key() -> Column:
    """`topic:partition`, the name a watermark is kept under."""
    return F.concat_ws(":", topic(), F.col("partition").cast("string"))


def log_name() -> Column:
    """Name of the accepted-event log of a row's topic."""
    return F.concat(topic(), F.lit(LOG_SUFFIX))


def source_topic(log: str) -> Column:
    return F.regexp_replace(log, f"{LOG_SUFFIX}$", "")


def parse_time(text: Column) -> Column:
    """Null when the text does not follow the pattern."""
    return F.try_to_timestamp(text, F.lit(TIME_PATTERN))


def format_time(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
