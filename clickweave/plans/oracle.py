"""The batch queries as plain SQL, formulated differently from the DataFrame plans: attribution as a
range join with a ranked pick, watermarks as one window per partition."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id AS seq, ts AS event_time, CAST(user_id AS VARCHAR) AS user_id,
         event_type = 'view' AS is_view,
         CASE WHEN event_type = 'view' THEN 'page_views' ELSE 'ad_clicks' END AS topic,
         CAST(user_id % 3 AS INTEGER) AS part,
         CAST(event_id AS VARCHAR) AS id,
         CASE WHEN event_type = 'view' THEN '/k/' ELSE 'campaign_' END
           || regexp_extract(props, '[0-9]+') AS label,
         ts + to_seconds((event_id * 7919) % 3600) AS arrival
  FROM events WHERE event_type IN ('click', 'view')
)"""

JUDGED = EVENTS + """,
wm AS (
  SELECT *, topic || ':' || part AS wm_key,
         max(event_time) OVER (PARTITION BY topic, part ORDER BY arrival, seq
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark_before
  FROM ev
),
judged AS (
  SELECT *, coalesce(event_time < watermark_before - INTERVAL 15 MINUTE, false) AS late,
         coalesce(event_time > watermark_before, true) AS advances
  FROM wm
),
acc AS (SELECT * FROM judged WHERE NOT late)"""

NUMBERED = EVENTS + """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY topic, part ORDER BY arrival, seq) - 1 AS "offset" FROM ev
)"""


def _joined(source: str, window: str, name: str = "hit", condition: str = "true") -> str:
    return f"""
{name} AS (
  SELECT v.*, c.id AS click_id, c.label AS campaign_id, c.event_time AS click_time,
         c.arrival AS click_arrival, c.seq AS click_seq
  FROM (SELECT * FROM {source} WHERE is_view) v
  LEFT JOIN (SELECT * FROM {source} WHERE NOT is_view AND {condition}) c
    ON c.user_id = v.user_id AND c.event_time BETWEEN v.event_time - INTERVAL {window} AND v.event_time
  QUALIFY row_number() OVER (PARTITION BY v.seq ORDER BY c.event_time DESC, c.arrival DESC, c.seq DESC) = 1
)"""


RESULT = """id AS page_view_id, user_id, event_time, label AS url,
       campaign_id AS attributed_campaign_id, click_id AS attributed_click_id"""


def _attributed(window: str) -> str:
    return f"WITH {EVENTS}, {_joined('ev', window)} SELECT {RESULT} FROM hit"


def _strict(window: str, select: str = RESULT, rest: str = "") -> str:
    return f"WITH {JUDGED}, {_joined('acc', window)} SELECT {select} FROM hit {rest}"


def _reach(window: str) -> str:
    return f"""
WITH {EVENTS}
SELECT c.user_id, c.id AS click_id, c.event_time,
       count(*) FILTER (WHERE v.event_time <= c.event_time) AS views_before,
       count(*) FILTER (WHERE v.event_time > c.event_time
                          AND v.event_time <= c.event_time + INTERVAL {window}) AS n_views
FROM (SELECT * FROM ev WHERE NOT is_view) c
LEFT JOIN (SELECT * FROM ev WHERE is_view) v ON v.user_id = c.user_id
GROUP BY c.user_id, c.id, c.event_time"""


def _revisions(judged: str = JUDGED) -> str:
    ends = ["TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-15'", "TIMESTAMP '2024-01-22'", "TIMESTAMP '9999-01-01'"]
    parts = [judged]
    selects = []
    for run, end in enumerate(ends):
        parts.append(_joined("acc", "24 HOUR", f"hit{run}", f"arrival < {end}"))
        columns = "h.id AS page_view_id, h.user_id, h.event_time, h.label AS url, " \
                  "h.campaign_id AS attributed_campaign_id, h.click_id AS attributed_click_id"
        begin = ends[run - 1] if run else "TIMESTAMP '0001-01-01'"
        selects.append(f"""SELECT {run} AS revision, {columns} FROM hit{run} h
          WHERE h.arrival < {end} AND (h.arrival >= {begin} OR EXISTS (
            SELECT 1 FROM acc c WHERE NOT c.is_view AND c.user_id = h.user_id AND c.arrival >= {begin} AND c.arrival < {end}
              AND c.event_time BETWEEN h.event_time - INTERVAL 24 HOUR AND h.event_time))""")
    parts.append(" log AS (" + " UNION ALL ".join(selects) + ")")
    return "WITH " + ",".join(parts)


def _text(value: str) -> str:
    return f"""coalesce('"' || {value} || '"', 'null')"""


AUDIT = f"""
WITH {JUDGED}, {_joined('acc', '24 HOUR')},
feed AS (
  SELECT CASE WHEN late THEN 'LATE_EVENT' WHEN is_view THEN 'PAGE_VIEW' ELSE 'CLICK' END AS type,
         event_time AS event_ts, arrival AS processed_at, seq, user_id,
         CASE WHEN NOT is_view THEN id END AS click_id, CASE WHEN NOT is_view THEN label END AS campaign_id,
         CASE WHEN is_view THEN id END AS event_id, CAST(NULL AS VARCHAR) AS page_view_id,
         CASE WHEN is_view THEN label END AS url,
         CASE WHEN late THEN CASE WHEN is_view THEN 'PAGE_VIEW' ELSE 'CLICK' END END AS source_type,
         CAST(NULL AS VARCHAR) AS wm_key, CAST(NULL AS TIMESTAMP) AS watermark, CAST(NULL AS BOOLEAN) AS attributed
  FROM judged
  UNION ALL
  SELECT 'ATTRIBUTION', event_time, arrival, seq, user_id, click_id, campaign_id, NULL, id, NULL, NULL, NULL,
         NULL, click_id IS NOT NULL
  FROM hit
  UNION ALL
  SELECT 'WATERMARK', event_time, arrival, seq, NULL, NULL, NULL, NULL, NULL, NULL, NULL, wm_key, event_time, NULL
  FROM acc WHERE advances
)"""

TIMELINE = f"""
WITH {JUDGED}, {_joined('acc', '24 HOUR')}
SELECT j.user_id, row_number() OVER (PARTITION BY j.user_id
                                     ORDER BY j.event_time, j.is_view, j.arrival, j.seq) AS position,
       j.topic, j.id, j.event_time, j.label, j.late AS dropped, h.click_id AS attributed_click_id
FROM judged j LEFT JOIN hit h ON h.seq = j.seq"""

HISTORY = f"""
WITH {JUDGED}
SELECT wm_key, id, event_time, arrival, watermark_before,
       greatest(coalesce(watermark_before, event_time), event_time) AS watermark_after, late
FROM judged"""

OFFSETS = f"""
WITH {NUMBERED}
SELECT topic, part AS "partition", "offset", user_id, event_time, id FROM numbered"""

REWRITES = _revisions(EVENTS.replace("ev AS", "timely AS") + """,
acc AS (SELECT * REPLACE (event_time + to_seconds((seq * 7919) % 3600 * 240) AS arrival) FROM timely)""") + """
SELECT * FROM log"""

ORACLE: dict[str, str] = {
    "rewrite_log": REWRITES,
    "rewrite_log_small_blocks": REWRITES,
    "attributed_30m": _attributed("30 MINUTE"),
    "attributed_6h": _attributed("6 HOUR"),
    "attributed_24h": _attributed("24 HOUR"),
    "attributed_24h_small_blocks": _attributed("24 HOUR"),
    "attributed_ties": f"""WITH {EVENTS.replace("ev AS", "exact AS")},
        ev AS (SELECT * REPLACE (date_trunc('hour', event_time) AS event_time) FROM exact),
        {_joined('ev', '24 HOUR')} SELECT {RESULT} FROM hit""",
    "attributed_strict_30m": _strict("30 MINUTE"),
    "attributed_strict_6h": _strict("6 HOUR"),
    "attributed_strict_24h": _strict("24 HOUR"),
    "attributed_strict_24h_small_blocks": _strict("24 HOUR"),
    "stream_offsets": OFFSETS,
    "stream_offsets_small_blocks": OFFSETS,
    "merged_arrivals": f"WITH {EVENTS} SELECT topic, user_id, event_time, id, label, arrival FROM ev",
    "watermark_history": HISTORY,
    "watermark_history_small_blocks": HISTORY,
    "watermark_advances": f"WITH {JUDGED} SELECT wm_key, event_time AS watermark FROM judged WHERE advances",
    "watermark_marks": f"WITH {JUDGED} SELECT DISTINCT topic, event_time AS watermark FROM judged WHERE advances",
    "watermark_final":
        f"WITH {JUDGED} SELECT wm_key, max(event_time) AS watermark FROM acc GROUP BY wm_key",
    "watermark_views": f"""WITH {JUDGED} SELECT wm_key, max(event_time) AS watermark FROM acc
        WHERE wm_key LIKE 'page_views:%' GROUP BY wm_key""",
    "watermark_min": f"""WITH {JUDGED}, final AS (
        SELECT topic, wm_key, max(event_time) AS watermark FROM acc GROUP BY topic, wm_key)
        SELECT topic, min(watermark) AS watermark FROM final GROUP BY topic""",
    "late_events": f"""WITH {JUDGED}
        SELECT CASE WHEN is_view THEN 'PAGE_VIEW' ELSE 'CLICK' END AS source_type, user_id, id, event_time,
               watermark_before FROM judged WHERE late""",
    "accepted_events": f"""WITH {JUDGED}
        SELECT topic, part AS "partition", user_id, event_time, id, label, arrival FROM acc""",
    "evictable_state": f"""WITH {JUDGED}, final AS (
          SELECT topic, wm_key, max(event_time) AS watermark FROM acc GROUP BY topic, wm_key),
        lowest AS (SELECT topic, min(watermark) AS watermark FROM final GROUP BY topic),
        cutoffs AS (
          SELECT 'ad_clicks' AS topic, watermark - INTERVAL 45 MINUTE AS cutoff FROM lowest WHERE topic = 'page_views'
          UNION ALL
          SELECT 'page_views', watermark - INTERVAL 15 MINUTE FROM lowest WHERE topic = 'ad_clicks')
        SELECT acc.topic, cutoff, count(*) FILTER (WHERE event_time < cutoff) AS evictable,
               count(*) FILTER (WHERE event_time >= cutoff) AS retained
        FROM acc JOIN cutoffs ON cutoffs.topic = acc.topic GROUP BY acc.topic, cutoff""",
    "click_reach_30m": _reach("30 MINUTE"),
    "click_reach_24h": _reach("24 HOUR"),
    "click_reach_24h_small_blocks": _reach("24 HOUR"),
    "reattribution_30m": _strict("30 MINUTE", rest="WHERE click_id IS NOT NULL AND (click_arrival, click_seq) > (arrival, seq)"),
    "reattribution_24h": _strict("24 HOUR", rest="WHERE click_id IS NOT NULL AND (click_arrival, click_seq) > (arrival, seq)"),
    "latest_clicks": f"""WITH {EVENTS}
        SELECT user_id, id AS click_id, label AS campaign_id, event_time FROM ev WHERE NOT is_view
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, arrival DESC, seq DESC) = 1""",
    "emission_log": _revisions() + f"""
        SELECT revision, '{{"page_view_id":"' || page_view_id || '","user_id":"' || user_id
          || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '","url":"' || url
          || '","attributed_campaign_id":' || {_text('attributed_campaign_id')}
          || ',"attributed_click_id":' || {_text('attributed_click_id')} || '}}' AS line
        FROM log""",
    "upsert_current": _strict("24 HOUR"),
    "replay_from_log": _strict("30 MINUTE"),
    "replay_bounded": f"""WITH {EVENTS}, acc AS (SELECT * FROM ev WHERE arrival < TIMESTAMP '2024-01-22' AND seq % 5 <> 0),
        {_joined('acc', '24 HOUR')} SELECT {RESULT} FROM hit""",
    "replay_refused": f"""WITH {EVENTS} SELECT topic, 'malformed' AS reason, count(*) AS n_refused FROM ev
        WHERE arrival < TIMESTAMP '2024-01-22' AND seq % 5 = 0 GROUP BY topic""",
    "stream_update_30m": _strict("30 MINUTE"),
    "stream_update_24h": _strict("24 HOUR"),
    "stream_emit_once_24h": _strict("24 HOUR"),
    "stream_emit_once_resumed": _strict("24 HOUR"),
    "output_table": _strict("6 HOUR"),
    "attribution_summary": _strict(
        "24 HOUR", "count(*) AS n_views, count(click_id) AS n_attributed, count(*) - count(click_id) AS n_unattributed"),
    "attribution_by_campaign": _strict(
        "24 HOUR", "campaign_id AS attributed_campaign_id, count(*) AS n_views", "GROUP BY campaign_id"),
    "audit_events": AUDIT + " SELECT * FROM feed",
    "event_type_counts": AUDIT + " SELECT type, count(*) AS n_events FROM feed WHERE type <> 'WATERMARK' GROUP BY type",
    "recent_events_top500": AUDIT + """ SELECT * FROM feed WHERE type <> 'WATERMARK'
        ORDER BY processed_at DESC, seq DESC, type LIMIT 500""",
    "user_timeline": TIMELINE,
    "user_timeline_one_user": f"SELECT * FROM ({TIMELINE}) WHERE user_id = '7'",
    "stream_jsonl_24h": _strict("24 HOUR"),
    # one watermark per batch: the smaller of both topics' latest times in all batches before, less the lateness
    "stream_outer_join_24h": f"""WITH {EVENTS},
        timed AS (SELECT *, CAST(arrival >= TIMESTAMP '2024-01-08' AS INTEGER) + CAST(arrival >= TIMESTAMP '2024-01-15' AS INTEGER)
                              + CAST(arrival >= TIMESTAMP '2024-01-22' AS INTEGER) AS batch FROM ev),
        marks AS (SELECT b.batch, least(max(event_time) FILTER (WHERE is_view), max(event_time) FILTER (WHERE NOT is_view))
                           - INTERVAL 15 MINUTE AS watermark
                  FROM (SELECT DISTINCT batch FROM timed) b JOIN timed t ON t.batch < b.batch GROUP BY b.batch),
        acc AS (SELECT timed.* FROM timed LEFT JOIN marks USING (batch) WHERE watermark IS NULL OR event_time > watermark),
        {_joined('acc', '24 HOUR')} SELECT {RESULT} FROM hit""",
    "stream_keyed_24h": _strict("24 HOUR"),
    "stream_compacted_24h": _strict("24 HOUR"),
    "stream_audit_counts": AUDIT + """ SELECT type, count(*) AS n_entries, count(processed_at) AS n_stamped,
        count(*) FILTER (WHERE attributed) AS n_attributed FROM feed GROUP BY type""",
    "user_timeline_small_blocks": TIMELINE,
    "timeline_range": f"""WITH {JUDGED},
        moves AS (SELECT min(epoch_us(event_time) // 1000) AS first, max(epoch_us(event_time) // 1000) AS last FROM acc WHERE advances),
        users AS (SELECT user_id, min(epoch_us(event_time) // 1000) AS first_ms, max(epoch_us(event_time) // 1000) AS last_ms
                  FROM judged GROUP BY user_id),
        span AS (SELECT *, least(first_ms, (SELECT first FROM moves)) AS low,
                        greatest(last_ms, (SELECT last FROM moves)) AS high FROM users),
        axis AS (SELECT user_id, first_ms, last_ms,
                        CAST(low AS DOUBLE) - CAST(greatest(high - low, 1) AS DOUBLE) * CAST(0.1 AS DOUBLE) AS axis_min,
                        CAST(high AS DOUBLE) + CAST(greatest(high - low, 1) AS DOUBLE) * CAST(0.1 AS DOUBLE) AS axis_max
                 FROM span)
        SELECT *, round((first_ms - axis_min) / (axis_max - axis_min) * 100, 6) AS first_pct,
               round((last_ms - axis_min) / (axis_max - axis_min) * 100, 6) AS last_pct
        FROM axis""",
    "attribution_links": _strict(
        "24 HOUR", "user_id, click_id, click_time, id AS page_view_id, event_time AS view_time",
        "WHERE click_id IS NOT NULL"),
    "distinct_users": f"WITH {EVENTS} SELECT DISTINCT user_id FROM ev",
    "dedup_redelivered": f"""WITH {NUMBERED}
        SELECT topic, part AS "partition", "offset", user_id, event_time, id, label FROM numbered""",
    "json_decode": f"""WITH {EVENTS}
        SELECT topic, part AS "partition", seq AS "offset", user_id, event_time, id, label FROM ev""",
    "quarantine": f"""WITH {EVENTS}
        SELECT topic, part AS "partition", seq AS "offset",
               CASE seq % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing user_id' ELSE 'missing event_time' END
                 AS reason
        FROM ev WHERE seq % 5 < 3""",
}
ORACLE["stream_metrics"] = ORACLE["evictable_state"]
