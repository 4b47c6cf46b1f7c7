"""Audit feed and per-user views of a fully resolved run.

All functions take *resolved* events (judged and attributed, late rows kept): one pass over the data
has everything the audit feed needs, so the feed is a projection rather than a union of separate jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.columns import topic, watermark_key
from clickweave.operators.lateness import advances

FEED = {
    "type": "string", "event_ts": None, "processed_at": None, "seq": "bigint", "user_id": "string",
    "click_id": "string", "campaign_id": "string", "event_id": "string", "page_view_id": "string",
    "url": "string", "source_type": "string", "wm_key": "string", "watermark": None, "attributed": "boolean",
}


def _entry(time_type: str, kind: str, **fields: Column) -> Column:
    fields["type"] = F.lit(kind)
    return F.struct(*(
        fields.get(name, F.lit(None)).cast(column_type or time_type).alias(name)
        for name, column_type in FEED.items()
    ))


def _arrival_entries(time_type: str, processed: Column, seq: Column) -> list[Column]:
    """Entries a judged event gives rise to by itself: its arrival, and the watermark it moves."""
    is_view, late = F.col("is_view"), F.col("late")
    base = {"event_ts": F.col("event_time"), "processed_at": processed, "seq": seq}
    as_click = {**base, "user_id": F.col("user_id"), "click_id": F.col("id"), "campaign_id": F.col("label")}
    as_view = {**base, "user_id": F.col("user_id"), "event_id": F.col("id"), "url": F.col("label")}
    arrived = (
        F.when(late & is_view, _entry(time_type, "LATE_EVENT", source_type=F.lit("PAGE_VIEW"), **as_view))
        .when(late, _entry(time_type, "LATE_EVENT", source_type=F.lit("CLICK"), **as_click))
        .when(is_view, _entry(time_type, "PAGE_VIEW", **as_view))
        .otherwise(_entry(time_type, "CLICK", **as_click))
    )
    moved = F.when(
        ~late & advances(),
        _entry(time_type, "WATERMARK", wm_key=watermark_key(), watermark=F.col("event_time"), **base),
    )
    return [arrived, moved]


def _exploded(rows: DataFrame, entries: list[Column]) -> DataFrame:
    written = F.filter(F.array(*entries), lambda entry: entry.isNotNull())
    return rows.select(F.explode(written).alias("entry")).select("entry.*")


def _time_type(rows: DataFrame) -> str:
    return rows.schema["event_time"].dataType.simpleString()


def audit_events(resolved: DataFrame, arrival: str = "arrival", seq: str = "seq") -> DataFrame:
    """What happened to each event: CLICK or PAGE_VIEW or LATE_EVENT, then ATTRIBUTION, then WATERMARK."""
    time_type, click = _time_type(resolved), F.col("click")
    credited = F.when(
        ~F.col("late") & F.col("is_view"),
        _entry(
            time_type, "ATTRIBUTION", event_ts=F.col("event_time"), processed_at=F.col(arrival), seq=F.col(seq),
            user_id=F.col("user_id"), page_view_id=F.col("id"), attributed=click.isNotNull(),
            click_id=click["id"], campaign_id=click["label"],
        ),
    )
    return _exploded(resolved, [*_arrival_entries(time_type, F.col(arrival), F.col(seq)), credited])


def audit_log(judged: DataFrame, written: DataFrame) -> DataFrame:
    """The feed of a streaming run, from its journal and the result rows it wrote; `seq` is the batch.

    Both carry the processing time of their batch, so the newest entries are those of the last batch.
    """
    time_type = _time_type(judged)
    click_id = F.col("attributed_click_id")
    credited = _entry(
        time_type, "ATTRIBUTION", event_ts=F.col("event_time"), processed_at=F.col("processed_at"), seq=F.col("batch_id"), user_id=F.col("user_id"),
        page_view_id=F.col("page_view_id"), attributed=click_id.isNotNull(), click_id=click_id,
        campaign_id=F.col("attributed_campaign_id"),
    )
    return _exploded(judged, _arrival_entries(time_type, F.col("processed_at"), F.col("batch_id"))).unionByName(
        _exploded(written, [credited]))


def type_counts(audit: DataFrame) -> DataFrame:
    """Counts of the four types the feed counts; watermark moves are not counted."""
    return audit.filter(F.col("type") != "WATERMARK").groupBy("type").agg(F.count(F.lit(1)).alias("n_events"))


def newest(audit: DataFrame, n: int = 500) -> DataFrame:
    """The feed's newest `n` entries, without watermark moves."""
    return (
        audit.filter(F.col("type") != "WATERMARK")
        .orderBy(F.col("processed_at").desc(), F.col("seq").desc(), "type")
        .limit(n)
    )


def user_timeline(resolved: DataFrame, user_id: str | None = None) -> DataFrame:
    """Each user's clicks and views in time order, dropped ones marked, views with their credited click."""
    if user_id is not None:
        resolved = resolved.filter(F.col("user_id") == user_id)
    return resolved.select(
        "user_id", "position", topic().alias("topic"), "id", "event_time", "label",
        F.col("late").alias("dropped"), F.col("click.id").alias("attributed_click_id"),
    )


def timeline_ranges(resolved: DataFrame) -> DataFrame:
    """Time axis per user: from the first to the last of the user's events and all watermark moves, with a
    tenth of the range as margin on both sides, and where the user's own events lie on it in percent."""
    millis = F.unix_millis(F.col("event_time").cast("timestamp"))
    moves = resolved.filter(~F.col("late") & advances()).agg(
        F.struct(F.min(millis).alias("first"), F.max(millis).alias("last")).alias("moves")
    )
    users = resolved.groupBy("user_id").agg(F.min(millis).alias("first_ms"), F.max(millis).alias("last_ms"))
    low = F.least("first_ms", "moves.first")
    high = F.greatest("last_ms", "moves.last")
    spread = F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low")).otherwise(1)

    def percent(at: str) -> Column:
        return F.round((F.col(at) - F.col("axis_min")) / (F.col("axis_max") - F.col("axis_min")) * 100, 6)

    return (
        users.withColumn("moves", moves.scalar())
        .withColumn("low", low).withColumn("high", high)
        .withColumn("axis_min", F.col("low") - spread * 0.1)
        .withColumn("axis_max", F.col("high") + spread * 0.1)
        .select("user_id", "first_ms", "last_ms", "axis_min", "axis_max",
                percent("first_ms").alias("first_pct"), percent("last_ms").alias("last_pct"))
    )


def attribution_links(resolved: DataFrame) -> DataFrame:
    """Both ends of every credited view. The click's time travels with the attribution, so linking the
    result back to clicks and views by id takes no further join."""
    return resolved.filter(F.col("click").isNotNull()).select(
        "user_id",
        F.col("click.id").alias("click_id"), F.col("click.event_time").alias("click_time"),
        F.col("id").alias("page_view_id"), F.col("event_time").alias("view_time"),
    )


def distinct_users(events: DataFrame) -> DataFrame:
    return events.select("user_id").distinct().orderBy("user_id")


def by_campaign(results: DataFrame) -> DataFrame:
    return results.groupBy("attributed_campaign_id").agg(F.count(F.lit(1)).alias("n_views"))


def summary(results: DataFrame) -> DataFrame:
    hit = F.col("attributed_click_id").isNotNull()
    return results.agg(
        F.count(F.lit(1)).alias("n_views"),
        F.count_if(hit).alias("n_attributed"),
        F.count_if(~hit).alias("n_unattributed"),
    )
