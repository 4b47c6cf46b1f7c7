"""Keyed and append-only result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.columns import format_time, parse_time
from clickweave.schemas import ATTRIBUTED

RESULT = [field.name for field in ATTRIBUTED]


def current(log: DataFrame, revision: Sequence[str]) -> DataFrame:
    """Last write per page view. The aggregate combines map side, so a view rewritten often stays cheap."""
    latest = F.max_by(F.struct(*RESULT[1:]), F.struct(*revision))
    return (
        log.groupBy("page_view_id").agg(latest.alias("row"))
        .select("page_view_id", *(F.col("row")[name].alias(name) for name in RESULT[1:]))
    )


def deduplicated(records: DataFrame) -> DataFrame:
    """One row per source coordinate; redelivered records carry the same payload."""
    coordinates = [name for name in ("topic", "is_view", "partition", "offset") if name in records.columns]
    return records.dropDuplicates(coordinates)


def json_lines(rows: DataFrame) -> DataFrame:
    """Each result row as one JSON text line; times as ISO text in UTC, nulls spelled out."""
    time = format_time(F.col("event_time"))
    shown = F.struct(*(time.alias(name) if name == "event_time" else name for name in RESULT))
    return rows.withColumn("line", F.to_json(shown, {"ignoreNullFields": "false"}))


def from_json_lines(rows: DataFrame, line: str = "line") -> DataFrame:
    """The result rows that `json_lines` wrote, beside the columns given."""
    schema = ", ".join(f"{name} string" for name in RESULT)
    parsed = rows.withColumn("_row", F.from_json(line, schema))
    return parsed.select(
        *(name for name in rows.columns if name != line),
        *((parse_time(F.col("_row.event_time")) if name == "event_time" else F.col("_row")[name]).alias(name) for name in RESULT),
    )
