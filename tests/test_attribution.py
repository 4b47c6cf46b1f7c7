"""Attribution, lateness and result tables on hand-made events."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickweave.operators import activity, attribution, lateness, tables
from clickweave.schemas import EVENT, as_events
from clickweave.sources.scenario import EXPECTED, LATE, at, event_row, scenario


def frame(spark, *rows):
    """Rows of is_view, offset, user, time, id, label[, partition]."""
    return spark.createDataFrame([event_row(*row) for row in rows], EVENT)


def click(offset, user, time, id, partition=0):
    return (False, offset, user, time, id, f"campaign_{id}", partition)


def view(offset, user, time, id, partition=0):
    return (True, offset, user, time, id, f"https://example.com/{id}", partition)


def credited(results):
    return {row.page_view_id: row.attributed_click_id for row in results.collect()}


# The plain window, and every group cut at every row.
PLAIN, CUT = {}, {"rows_per_cut": 1, "max_cuts": 5000}


def strict(events, scan=PLAIN):
    accepted = lateness.judge(events, **scan).filter(~F.col("late")).drop("late", "watermark_before")
    return attribution.attribute(accepted, **scan)


@pytest.mark.parametrize("scan", [PLAIN, CUT], ids=["plain", "cut"])
@pytest.mark.parametrize("name, rows, expected", [
    ("click before view", [click(0, "u", "12:05:00", "c"), view(0, "u", "12:10:00", "v")], {"v": "c"}),
    ("latest of several",
     [click(0, "u", "12:20:00", "c1"), click(1, "u", "12:25:00", "c2"), view(0, "u", "12:30:00", "v")], {"v": "c2"}),
    ("outside the window", [click(0, "u", "12:35:00", "c"), view(0, "u", "13:10:00", "v")], {"v": None}),
    ("on the window's edge", [click(0, "u", "12:00:00", "c"), view(0, "u", "12:30:00", "v")], {"v": "c"}),
    ("a second past the edge", [click(0, "u", "12:00:00", "c"), view(0, "u", "12:30:01", "v")], {"v": None}),
    ("at the view's own time", [click(5, "u", "12:30:00", "c"), view(0, "u", "12:30:00", "v")], {"v": "c"}),
    ("after the view", [click(0, "u", "12:30:01", "c"), view(0, "u", "12:30:00", "v")], {"v": None}),
    ("no click", [view(0, "u", "13:20:00", "v")], {"v": None}),
    ("another user's click", [click(0, "w", "12:05:00", "c"), view(0, "u", "12:10:00", "v")], {"v": None}),
    ("equal times: higher offset",
     [click(7, "u", "12:05:00", "c7"), click(3, "u", "12:05:00", "c3"), view(0, "u", "12:10:00", "v")], {"v": "c7"}),
])
def test_cases(spark, name, rows, expected, scan):
    assert credited(attribution.attribute(frame(spark, *rows), **scan)) == expected


def test_scenario(spark):
    events = scenario(spark)
    judged = lateness.judge(events)
    assert {row.id for row in judged.filter("late").collect()} == LATE
    results = {row.page_view_id: (row.attributed_campaign_id, row.attributed_click_id)
               for row in strict(events).collect()}
    assert results == EXPECTED


def test_separate_tables(spark):
    clicks = spark.createDataFrame(
        [("u", at("12:05:00"), "camp", "c", 0)],
        "user_id string, event_time timestamp, campaign_id string, click_id string, offset bigint")
    views = spark.createDataFrame(
        [("u", at("12:10:00"), "/x", "v", 0)],
        "user_id string, event_time timestamp, url string, event_id string, offset bigint")
    row = attribution.attribute(as_events(clicks, views)).first()
    assert row == ("v", "u", at("12:10:00"), "/x", "camp", "c")


def test_late_click_is_dropped_by_another_users_event(spark):
    events = frame(spark, click(0, "other", "12:45:00", "c0"), click(1, "u", "12:20:00", "c1"),
                   view(0, "u", "12:45:00", "v"))
    assert credited(strict(events)) == {"v": None}


def test_late_view_has_no_result(spark):
    events = frame(spark, view(0, "u", "13:00:00", "v0"), view(1, "u", "12:44:59", "v1"), view(2, "u", "12:45:00", "v2"))
    assert set(credited(strict(events))) == {"v0", "v2"}  # exactly on the cutoff is kept


def test_watermarks_are_monotone_and_per_partition(spark):
    events = frame(
        spark, click(0, "a", "12:00:00", "c0"), click(1, "a", "12:20:00", "c1"), click(2, "a", "12:10:00", "c2"),
        click(3, "a", "12:20:00", "c3"), click(0, "b", "11:00:00", "d0", 1))
    before = {row.id: row.watermark_before for row in lateness.judge(events).collect()}
    assert before == {"c0": None, "c1": at("12:00:00"), "c2": at("12:20:00"), "c3": at("12:20:00"), "d0": None}
    final = lateness.final_watermarks(events)
    assert {tuple(row) for row in lateness.named(final).collect()} == {
        ("ad_clicks:0", at("12:20:00")), ("ad_clicks:1", at("11:00:00"))}
    assert lateness.slowest_watermarks(final).first().watermark == at("11:00:00")
    moved = lateness.judge(events).filter(lateness.advances())
    assert {row.id for row in moved.collect()} == {"c0", "c1", "d0"}


def test_carried_watermark(spark):
    events = frame(spark, click(9, "u", "12:00:00", "c"))
    carried = spark.createDataFrame([(False, 0, at("12:15:01"))], "is_view boolean, partition int, watermark timestamp")
    assert lateness.judge(events, carried=carried).first().late
    assert not lateness.judge(events, timedelta(minutes=16), carried=carried).first().late


def test_evictable(spark):
    events = frame(
        spark, click(0, "u", "12:00:00", "c0"), click(1, "u", "13:00:00", "c1"), view(0, "u", "12:44:59", "v0"),
        view(1, "u", "12:45:01", "v1"))
    counts = {row.topic: (row.evictable, row.retained) for row in
              lateness.evictable(lateness.judge(events), timedelta(minutes=30), timedelta(minutes=15)).collect()}
    assert counts == {"ad_clicks": (1, 1), "page_views": (1, 1)}


def test_one_hot_user(spark):
    rows = []
    for i in range(20):
        start = datetime(2024, 1, 1, 12) + timedelta(minutes=2 * i)
        rows.append(click(i, "hot", start.strftime("%H:%M:%S"), f"c{i}"))
        rows.append(view(i, "hot", (start + timedelta(minutes=1)).strftime("%H:%M:%S"), f"v{i}"))
    for scan in (PLAIN, {"rows_per_cut": 4}, CUT):
        found = credited(strict(frame(spark, *rows), scan))
        assert found == {f"v{i}": f"c{i}" for i in range(20)}


def test_partitions_and_layout_do_not_matter(spark):
    rows = []
    for partition in range(4):
        for i in range(50):
            start = datetime(2024, 1, 1, 12) + timedelta(minutes=i)
            user = f"u{partition}_{i}"
            rows.append(click(i, user, start.strftime("%H:%M:%S"), f"c{partition}_{i}", partition))
            rows.append(view(i, user, (start + timedelta(minutes=5)).strftime("%H:%M:%S"), f"v{partition}_{i}", partition))
    events = frame(spark, *rows)
    expected = {f"v{p}_{i}": f"c{p}_{i}" for p in range(4) for i in range(50)}
    for layout in (events.coalesce(1), events.repartition(13), events.orderBy(F.rand(1))):
        assert credited(strict(layout)) == expected


def simulate(arrivals):
    """Events one by one, as they arrive: late ones dropped, views written, clicks rewriting earlier views."""
    watermarks, clicks, views, result = {}, [], [], {}
    minute = timedelta(minutes=1)

    def write(seen):
        _, _, user, time, id, _, _ = seen
        fitting = [c for c in clicks if c[2] == user and at(time) - 30 * minute <= at(c[3]) <= at(time)]
        result[id] = max(fitting, key=lambda c: (c[3], c[1]))[4] if fitting else None

    for event in arrivals:
        is_view, _, user, time, _, _, partition = event
        watermark = watermarks.get((is_view, partition), at(time))
        if at(time) < watermark - 15 * minute:
            continue
        watermarks[is_view, partition] = max(watermark, at(time))
        if is_view:
            views.append(event)
            write(event)
        else:
            clicks.append(event)
            for earlier in views:
                if earlier[2] == user and at(time) <= at(earlier[3]) <= at(time) + 30 * minute:
                    write(earlier)
    return result


def test_random_arrivals_against_event_by_event_simulation(spark):
    """Coarse times make ties and exact edges common; each run has a source partition of its own."""
    arrivals, expected = [], {}
    for run in range(60):
        rng, offsets, own = random.Random(run), {False: -1, True: -1}, []
        for n in range(30):
            minutes = max(0, 2 * n + rng.choice([0, 0, 5, -10, -15, -16, -30]))
            is_view = rng.random() < 0.5
            offsets[is_view] += 1
            time = f"{10 + minutes // 60:02d}:{minutes % 60:02d}:00"
            make = view if is_view else click
            own.append(make(offsets[is_view], f"{run}_{rng.randrange(2)}", time, f"{run}_{n}", run))
        arrivals += own
        expected |= simulate(own)
    events = frame(spark, *arrivals)
    assert sum(click is not None for click in expected.values()) > 300 and len(expected) < 900
    assert credited(strict(events)) == expected
    assert credited(strict(events, CUT)) == expected


def test_redelivered_records_change_nothing(spark):
    events = scenario(spark)
    twice = tables.deduplicated(events.unionByName(events))
    assert twice.count() == events.count()
    assert sorted(strict(twice).collect()) == sorted(strict(events).collect())


def test_reach_holds_all_pairs(spark):
    events = frame(
        spark, view(0, "u", "12:00:00", "v0"), click(0, "u", "12:00:00", "c0"), view(1, "u", "12:30:00", "v1"),
        view(2, "u", "12:30:01", "v2"), click(1, "u", "12:20:00", "c1"), click(2, "w", "12:00:00", "c2"))
    for scan in (PLAIN, CUT):
        reach = {row.click_id: (row.views_before, row.n_views)
                 for row in attribution.click_reach(events, **scan).collect()}
        assert reach == {"c0": (1, 1), "c1": (1, 2), "c2": (0, 0)}


def test_corrected_views(spark):
    events = scenario(spark).withColumn("seq", F.col("offset"))
    order_of = {"pv_2": 1, "click_2": 2}
    seq = F.coalesce(*(F.when(F.col("id") == id, n) for id, n in order_of.items()), F.col("offset") * 10)
    found = attribution.corrected(events.withColumn("seq", seq), order=("seq",))
    assert credited(found)["pv_2"] == "click_2"


def test_revisions_and_current(spark):
    arrival = {"v": "12:11:00", "c1": "12:06:00", "c2": "12:12:00", "w": "12:20:00"}
    events = frame(
        spark, click(0, "u", "12:05:00", "c1"), view(0, "u", "12:10:00", "v"), click(1, "u", "12:08:00", "c2"),
        view(1, "u", "12:15:00", "w"))
    events = events.withColumn(
        "arrival", F.coalesce(*(F.when(F.col("id") == id, F.lit(at(time))) for id, time in arrival.items())))
    ends = [at("12:11:30"), at("12:30:00")]
    log = attribution.revisions(events, boundaries=ends)
    assert sorted((row.revision, row.page_view_id, row.attributed_click_id) for row in log.collect()) == [
        (0, "v", "c1"), (1, "v", "c2"), (1, "w", "c2")]
    everything = attribution.revisions(events, boundaries=ends, only_changes=False)
    assert sorted((row.revision, row.page_view_id, row.attributed_click_id) for row in everything.collect()) == [
        (0, "v", "c1"), (1, "v", "c2"), (1, "w", "c2")]
    assert credited(tables.current(log, ["revision"])) == {"v": "c2", "w": "c2"}
    line = tables.json_lines(log.filter("revision = 0")).first().line
    assert line == ('{"page_view_id":"v","user_id":"u","event_time":"2024-01-01T12:10:00.000000",'
                    '"url":"https://example.com/v","attributed_campaign_id":"campaign_c1","attributed_click_id":"c1"}')


@pytest.mark.parametrize("scan", [PLAIN, CUT], ids=["plain", "cut"])
def test_runs_rewrite_the_views_their_clicks_reach(spark, scan):
    """Also where nothing changes: an older click, one at either end of the window, several in one run."""
    rows = [
        (view(0, "u", "12:30:00", "v"), 0), (click(0, "u", "12:20:00", "best"), 0), (view(1, "w", "12:30:00", "other"), 0),
        (click(1, "u", "12:10:00", "older"), 1), (click(2, "u", "12:00:00", "edge"), 2), (click(3, "u", "11:59:59", "before"), 3),
        (click(4, "u", "12:30:01", "after"), 4), (click(5, "u", "12:30:00", "same"), 5), (click(6, "u", "12:05:00", "more"), 5),
    ]
    run_of = {row[4]: run for row, run in rows}
    events = frame(spark, *(row for row, _ in rows))
    minute = F.coalesce(*(F.when(F.col("id") == id, run) for id, run in run_of.items()))
    events = events.withColumn("arrival", F.lit(at("12:00:00")) + F.make_dt_interval(mins=minute))
    ends = [at(f"12:0{run}:00") for run in range(1, 6)]
    log = attribution.revisions(events, boundaries=ends, only_changes=False, **scan).collect()
    assert sorted((row.revision, row.page_view_id, row.attributed_click_id) for row in log) == [
        (0, "other", None), (0, "v", "best"), (1, "v", "best"), (2, "v", "best"), (5, "v", "same")]
    changes = attribution.revisions(events, boundaries=ends, **scan).collect()
    assert sorted((row.revision, row.page_view_id, row.attributed_click_id) for row in changes) == [
        (0, "other", None), (0, "v", "best"), (5, "v", "same")]


def audited(spark):
    rows = lateness.judge(scenario(spark), **PLAIN)
    rows = rows.withColumns({"arrival": F.col("event_time"), "seq": F.col("offset")})
    resolved = attribution.resolve(rows, eligible=~F.col("late"), **PLAIN)
    return resolved.withColumn("click", F.when(~F.col("late"), F.col("click")))


def test_audit_feed(spark):
    feed = activity.audit_events(audited(spark))
    counts = {row.type: row.n_events for row in activity.type_counts(feed).collect()}
    assert counts == {"CLICK": 6, "PAGE_VIEW": 6, "ATTRIBUTION": 6, "LATE_EVENT": 1}
    late = feed.filter("type = 'LATE_EVENT'").first()
    assert (late.source_type, late.click_id, late.user_id) == ("CLICK", "click_5_b", "user_5")
    marks = {(row.wm_key, row.watermark) for row in feed.filter("type = 'WATERMARK'").collect()}
    assert ("ad_clicks:0", at("12:58:00")) in marks and ("ad_clicks:0", at("12:40:00")) not in marks
    assert activity.newest(feed, 3).count() == 3


def test_user_views(spark):
    resolved = audited(spark)
    timeline = activity.user_timeline(resolved, "user_5").orderBy("position").collect()
    assert [(row.id, row.dropped) for row in timeline] == [
        ("click_5_b", True), ("pv_5", False), ("click_5_a", False)]
    links = {(row.click_id, row.page_view_id) for row in activity.attribution_links(resolved).collect()}
    assert links == {("click_1", "pv_1"), ("click_2", "pv_2"), ("click_3b", "pv_3")}
    axis = {row.user_id: row for row in activity.timeline_ranges(resolved).collect()}
    assert axis["user_6"].last_pct == pytest.approx(100 * 1.1 / 1.2, abs=1e-6)
    assert [row.user_id for row in activity.distinct_users(resolved).collect()] == [f"user_{n}" for n in range(1, 7)]
    assert tuple(activity.summary(strict(scenario(spark))).first()) == (6, 3, 3)
    assert {tuple(row) for row in activity.by_campaign(strict(scenario(spark))).collect()} == {
        ("campaign_A", 1), ("campaign_B", 1), ("campaign_D", 1), (None, 3)}


def test_latest_click(spark):
    latest = {row.user_id: row.click_id for row in attribution.latest_clicks(scenario(spark)).collect()}
    assert latest["user_3"] == "click_3b" and latest["user_5"] == "click_5_a"
