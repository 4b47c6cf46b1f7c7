"""Batch queries over the `events` table, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.columns import topic, watermark_key
from clickweave.operators import activity, attribution, lateness, tables
from clickweave.schemas import VIEW_TOPIC
from clickweave.session import work_folder
from clickweave.sources import changelog, records
from clickweave.sources.tables import ARRIVAL_FACTOR, ARRIVAL_ORDER, ARRIVAL_SPREAD_S, events, with_offsets

Query = Callable[[SparkSession, str], DataFrame]

MIN_30 = timedelta(minutes=30)
HOURS_6 = timedelta(hours=6)
HOURS_24 = timedelta(hours=24)

# Small blocks: cuts groups of the test tables the way the default cuts groups of millions of rows.
SMALL_BLOCKS = {"rows_per_cut": 32}

RUN_ENDS = [datetime(2024, 1, day) for day in (8, 15, 22)]


def judged(spark: SparkSession, sf_dir: str, **scan) -> DataFrame:
    return lateness.judge(events(spark, sf_dir), order=ARRIVAL_ORDER, **scan)


def accepted(spark: SparkSession, sf_dir: str, **scan) -> DataFrame:
    return judged(spark, sf_dir, **scan).filter(~F.col("late")).drop("late", "watermark_before")


def strict(operator: Callable, window: timedelta, **scan) -> Query:
    """An attribution operator over the accepted events."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = accepted(spark, sf_dir, **scan)
        return operator(rows, window, ARRIVAL_ORDER, cuts_from=events(spark, sf_dir), **scan)
    return query


def resolved(spark: SparkSession, sf_dir: str, window: timedelta, **scan) -> DataFrame:
    """All events, judged and attributed; late ones neither credit nor are credited."""
    rows = attribution.resolve(
        judged(spark, sf_dir, **scan), window, ARRIVAL_ORDER, eligible=~F.col("late"),
        cuts_from=events(spark, sf_dir), **scan,
    )
    return rows.withColumn("click", F.when(~F.col("late"), F.col("click")))


def attributed(window: timedelta, **scan) -> Query:
    return lambda spark, sf_dir: attribution.attribute(
        events(spark, sf_dir), window, ARRIVAL_ORDER, **scan
    )


def attributed_strict(window: timedelta, **scan) -> Query:
    return strict(attribution.attribute, window, **scan)


def attributed_ties(window: timedelta) -> Query:
    """Times cut to the hour, so that many clicks of a user share theirs."""
    return lambda spark, sf_dir: attribution.attribute(
        events(spark, sf_dir).withColumn("event_time", F.date_trunc("hour", "event_time").cast("timestamp_ntz")),
        window, ARRIVAL_ORDER,
    )


def stream_offsets(**scan) -> Query:
    return lambda spark, sf_dir: with_offsets(
        events(spark, sf_dir), **scan
    ).select(topic().alias("topic"), "partition", "offset", "user_id", "event_time", "id")


def merged_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        topic().alias("topic"), "user_id", "event_time", "id", "label", "arrival"
    ).orderBy("arrival", F.col("id").cast("bigint"))


def watermark_history(**scan) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return judged(spark, sf_dir, **scan).select(
            watermark_key().alias("wm_key"), "id", "event_time", "arrival", "watermark_before",
            F.greatest("watermark_before", "event_time").alias("watermark_after"), "late",
        )
    return query


def watermark_advances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).filter(lateness.advances()).select(
        watermark_key().alias("wm_key"), F.col("event_time").alias("watermark")
    )


def watermark_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct points in time at which a topic's watermarks moved."""
    return judged(spark, sf_dir).filter(lateness.advances()).select(
        topic().alias("topic"), F.col("event_time").alias("watermark")
    ).distinct()


def watermark_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateness.named(lateness.final_watermarks(events(spark, sf_dir)))


def watermark_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lateness.named(lateness.final_watermarks(events(spark, sf_dir).filter("is_view")), VIEW_TOPIC)


def watermark_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    slowest = lateness.slowest_watermarks(lateness.final_watermarks(events(spark, sf_dir)))
    return slowest.select(topic().alias("topic"), "watermark")


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).filter("late").select(
        F.when(F.col("is_view"), "PAGE_VIEW").otherwise("CLICK").alias("source_type"),
        "user_id", "id", "event_time", "watermark_before",
    )


def accepted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(spark, sf_dir).select(
        topic().alias("topic"), "partition", "user_id", "event_time", "id", "label", "arrival"
    )


def evictable_state(window: timedelta) -> Query:
    return lambda spark, sf_dir: lateness.evictable(judged(spark, sf_dir), window, lateness.LATENESS)


def click_reach(window: timedelta, **scan) -> Query:
    return lambda spark, sf_dir: attribution.click_reach(
        events(spark, sf_dir), window, ARRIVAL_ORDER, **scan
    )


def reattribution(window: timedelta) -> Query:
    return strict(attribution.corrected, window)


def latest_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.latest_clicks(events(spark, sf_dir), ARRIVAL_ORDER)


def revision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view is written on arrival, and again by each run with a click whose window holds it, changed or not."""
    operator = partial(attribution.revisions, boundaries=RUN_ENDS, only_changes=False)
    return strict(operator, HOURS_24)(spark, sf_dir)


def rewrite_log(**scan) -> Query:
    """Arrival spread over ten days, so that clicks of later runs reach many views that are written already."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spread = F.make_dt_interval(secs=(F.col("seq") * ARRIVAL_FACTOR) % ARRIVAL_SPREAD_S * 240)
        slow = events(spark, sf_dir).withColumn("arrival", F.col("event_time") + spread)
        return attribution.revisions(slow, HOURS_24, ARRIVAL_ORDER, boundaries=RUN_ENDS, only_changes=False, **scan)
    return query


def emission_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.json_lines(revision_log(spark, sf_dir)).select("revision", "line")


def upsert_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.current(revision_log(spark, sf_dir), ["revision"])


def replay_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the accepted-event log, then rebuild the result from the log alone."""
    log, rows = work_folder(spark, "accepted-log"), accepted(spark, sf_dir)
    changelog.write_log(rows, log)
    return attribution.attribute(changelog.read_log(spark, log, rows.schema), MIN_30, ARRIVAL_ORDER)


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """Records in a folder, a fifth of them damaged, and where their partitions ended before the last week's were added."""
    value = records.encode()
    damaged = F.when(F.col("seq") % 5 == 0, F.substring(value, 1, 20)).otherwise(value)
    rows = with_offsets(events(spark, sf_dir)).select(
        topic().alias("topic"), "partition", "offset", damaged.alias("value"), (F.col("arrival") >= F.lit(RUN_ENDS[-1])).alias("later"))
    landing = work_folder(spark, "landing")
    rows.filter(~F.col("later")).drop("later").write.parquet(landing)
    ends = changelog.captured(records.read_batch(spark, path=landing))
    rows.filter("later").drop("later").write.mode("append").parquet(landing)
    return landing, ends


def replay_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild the result from the records up to captured ends, while more arrive; unreadable ones are skipped."""
    landing, ends = _landed(spark, sf_dir)
    rows = records.good(records.decode(records.read_batch(spark, path=landing, ends=ends)))
    found = attribution.attribute(rows, HOURS_24)
    return found.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def replay_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, ends = _landed(spark, sf_dir)
    return records.refused_counts(records.decode(records.read_batch(spark, path=landing, ends=ends)))


def output_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By user; the further columns only let a busy user's rows be sorted by several tasks."""
    return attributed_strict(HOURS_6)(spark, sf_dir).orderBy("user_id", "event_time", "page_view_id")


def attribution_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.summary(attributed_strict(HOURS_24)(spark, sf_dir))


def attribution_by_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.by_campaign(attributed_strict(HOURS_24)(spark, sf_dir))


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.audit_events(resolved(spark, sf_dir, HOURS_24))


def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.type_counts(audit_events(spark, sf_dir))


def recent_events_top500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.newest(audit_events(spark, sf_dir), 500)


def user_timeline(**scan) -> Query:
    return lambda spark, sf_dir: activity.user_timeline(
        resolved(spark, sf_dir, HOURS_24, **scan)
    )


def user_timeline_one_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.user_timeline(resolved(spark, sf_dir, HOURS_24), user_id="7")


def timeline_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.timeline_ranges(judged(spark, sf_dir))


def attribution_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.attribution_links(strict(attribution.resolve_views, HOURS_24)(spark, sf_dir))


def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.distinct_users(events(spark, sf_dir))


def dedup_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliver every view twice and drop the repeats by source coordinates."""
    rows = with_offsets(events(spark, sf_dir))
    delivered = rows.withColumn(
        "copy", F.explode(F.when(F.col("is_view"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).drop("copy")
    return tables.deduplicated(delivered).select(
        topic().alias("topic"), "partition", "offset", "user_id", "event_time", "id", "label"
    )


def _as_records(spark: SparkSession, sf_dir: str, value) -> DataFrame:
    return events(spark, sf_dir).select(
        topic().alias("topic"), "partition", F.col("seq").alias("offset"), value.alias("value")
    )


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = records.decode(_as_records(spark, sf_dir, records.encode()))
    return records.good(decoded).select(
        topic().alias("topic"), "partition", "offset", "user_id",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"), "id", "label",
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage every record in one of five ways, by its user, and list what decoding refuses."""
    value = records.encode()
    way = F.col("seq") % 5
    damaged = (
        F.when(way == 0, F.substring(value, 1, 20))
        .when(way == 1, F.regexp_replace(value, '"user_id":"[0-9]+",', ""))
        .when(way == 2, F.regexp_replace(value, '"event_time":"2024', '"event_time":"noon'))
        .when(way == 3, F.regexp_replace(value, r"\}$", ',"extra":1}'))
        .otherwise(value)
    )
    refused = records.quarantined(records.decode(_as_records(spark, sf_dir, damaged)))
    return refused.select("topic", "partition", "offset", "reason")


QUERIES: dict[str, Query] = {
    "attributed_30m": attributed(MIN_30),
    "attributed_6h": attributed(HOURS_6),
    "attributed_24h": attributed(HOURS_24),
    "attributed_24h_small_blocks": attributed(HOURS_24, **SMALL_BLOCKS),
    "attributed_ties": attributed_ties(HOURS_24),
    "attributed_strict_30m": attributed_strict(MIN_30),
    "attributed_strict_6h": attributed_strict(HOURS_6),
    "attributed_strict_24h": attributed_strict(HOURS_24),
    "attributed_strict_24h_small_blocks": attributed_strict(HOURS_24, **SMALL_BLOCKS),
    "stream_offsets": stream_offsets(),
    "stream_offsets_small_blocks": stream_offsets(**SMALL_BLOCKS),
    "merged_arrivals": merged_arrivals,
    "watermark_history": watermark_history(),
    "watermark_history_small_blocks": watermark_history(**SMALL_BLOCKS),
    "watermark_advances": watermark_advances,
    "watermark_marks": watermark_marks,
    "watermark_final": watermark_final,
    "watermark_views": watermark_views,
    "watermark_min": watermark_min,
    "late_events": late_events,
    "accepted_events": accepted_events,
    "evictable_state": evictable_state(MIN_30),
    "click_reach_30m": click_reach(MIN_30),
    "click_reach_24h": click_reach(HOURS_24),
    "click_reach_24h_small_blocks": click_reach(HOURS_24, **SMALL_BLOCKS),
    "reattribution_30m": reattribution(MIN_30),
    "reattribution_24h": reattribution(HOURS_24),
    "latest_clicks": latest_clicks,
    "emission_log": emission_log,
    "rewrite_log": rewrite_log(),
    "rewrite_log_small_blocks": rewrite_log(**SMALL_BLOCKS),
    "upsert_current": upsert_current,
    "replay_from_log": replay_from_log,
    "replay_bounded": replay_bounded,
    "replay_refused": replay_refused,
    "output_table": output_table,
    "attribution_summary": attribution_summary,
    "attribution_by_campaign": attribution_by_campaign,
    "audit_events": audit_events,
    "event_type_counts": event_type_counts,
    "recent_events_top500": recent_events_top500,
    "user_timeline": user_timeline(),
    "user_timeline_small_blocks": user_timeline(**SMALL_BLOCKS),
    "user_timeline_one_user": user_timeline_one_user,
    "timeline_range": timeline_range,
    "attribution_links": attribution_links,
    "distinct_users": distinct_users,
    "dedup_redelivered": dedup_redelivered,
    "json_decode": json_decode,
    "quarantine": quarantine,
}
