"""Streaming runs: restart, replay, out-of-order arrival, emit-once."""

import random
import time
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickweave.operators import attribution, lateness
from clickweave.schemas import EVENT
from clickweave.sources import records
from clickweave.sources.scenario import ARRIVALS, EXPECTED, LATE, event_row
from clickweave.streaming import journal, metrics


class Feed:
    """A landing folder fed batch by batch to a run that stops and restarts in between."""

    def __init__(self, spark, folder, **work):
        self.spark, self.folder = spark, folder
        self.work = journal.Attribution(f"{folder}/tables", **work)
        self.last = None

    def deliver(self, rows):
        events = self.spark.createDataFrame([event_row(*row) for row in rows], EVENT)
        self.send(events.select(
            F.when(F.col("is_view"), "page_views").otherwise("ad_clicks").alias("topic"), "partition", "offset",
            records.encode().alias("value")))

    def send(self, sent):
        sent.coalesce(1).write.mode("append").parquet(f"{self.folder}/landing")
        stream = records.read_records(self.spark, path=f"{self.folder}/landing")
        run = journal.start(stream, self.work, f"{self.folder}/checkpoint", available_now=True)
        run.awaitTermination()
        self.last = run.lastProgress["batchId"]
        self.run = str(run.id)

    def redo(self, batch, batch_id):
        """Hand the work a batch as the query would after a failure."""
        self.spark.sparkContext.setLocalProperty("sql.streaming.queryId", self.run)
        try:
            self.work(batch, batch_id)
        finally:
            self.spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)

    def results(self):
        return {row.page_view_id: (row.attributed_campaign_id, row.attributed_click_id)
                for row in self.work.current(self.spark).collect()}

    def writes(self, view):
        rows = self.work.revisions(self.spark).filter(F.col("page_view_id") == view).orderBy("batch_id").collect()
        return [row.attributed_click_id for row in rows]


@pytest.mark.parametrize("steps", [[13], [3, 10], [3, 5, 13]])
def test_scenario_with_restarts(spark, tmp_path, steps):
    feed = Feed(spark, tmp_path)
    start = 0
    for end in steps:
        feed.deliver([row[:6] for row in ARRIVALS[start:end]])
        start = end
    if start < 13:
        feed.deliver([row[:6] for row in ARRIVALS[start:]])
    assert feed.results() == EXPECTED
    judged = feed.work.journal(spark)
    assert {row.id for row in judged.filter("late").collect()} == LATE
    assert judged.count() == 13
    if steps[0] == 3:
        assert feed.writes("pv_2") == [None, "click_2"]


def test_batch_run_again_is_a_no_op(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([row[:6] for row in ARRIVALS[:3]])
    feed.deliver([row[:6] for row in ARRIVALS[3:]])
    before = set(feed.work.revisions(spark).collect())
    # A failure after the tables were written, before the batch was committed.
    sent = spark.read.parquet(f"{tmp_path}/landing")
    feed.redo(sent.limit(0), 1)
    assert set(feed.work.revisions(spark).collect()) == before


def test_unfinished_batch_is_redone(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([row[:6] for row in ARRIVALS[:3]])
    events = spark.createDataFrame([event_row(*row[:6]) for row in ARRIVALS[3:]], EVENT)
    batch = events.select(
        F.when(F.col("is_view"), "page_views").otherwise("ad_clicks").alias("topic"), "partition", "offset",
        records.encode().alias("value"))
    before = feed.work.state(spark, 0)
    feed.work._write_journal(batch, 1, before)  # crash after the journal
    feed.redo(batch, 1)
    assert feed.results() == EXPECTED
    assert feed.work.journal(spark).count() == 13


def test_quarantine(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    sent = spark.createDataFrame(
        [("ad_clicks", 0, 0, '{"user_id": "u"'),
         ("page_views", 0, 0, '{"user_id":"u","event_time":"2024-01-01T12:00:00","url":"/x","event_id":"v"}')],
        "topic string, partition int, offset bigint, value string")
    feed.send(sent)
    assert feed.results() == {"v": (None, None)}
    assert spark.read.parquet(f"{tmp_path}/tables/quarantine").count() == 1


def test_older_click_after_the_better_one_left_the_views_horizon(spark, tmp_path):
    """The view topic runs far ahead; a slow click partition still delivers an older click for an old view."""
    feed = Feed(spark, tmp_path)
    feed.deliver([
        (False, 0, "u", "12:10:00", "better", "b"), (True, 0, "u", "12:20:00", "v", "/x"),
        (True, 1, "w", "18:00:00", "ahead", "/y")])
    feed.deliver([(True, 2, "w", "18:01:00", "ahead2", "/y")])
    feed.deliver([(False, 1, "u", "12:05:00", "older", "o")])
    assert feed.results()["v"] == ("b", "better")


def random_arrivals(seed, n=90):
    rng = random.Random(seed)
    users = ["hot"] * 5 + [f"u{i}" for i in range(6)]
    drafts = []
    for i in range(n):
        minute = i * 2 + rng.random()
        drafts.append((minute + rng.expovariate(1 / 12), minute, rng.random() < 0.5, rng.choice(users), rng.randrange(2)))
    offsets, rows = {}, []
    for i, (_, minute, is_view, user, partition) in enumerate(sorted(drafts)):
        offset = offsets[is_view, partition] = offsets.get((is_view, partition), -1) + 1
        time = f"{8 + int(minute // 60):02d}:{int(minute % 60):02d}:{int(minute % 1 * 60):02d}"
        rows.append((is_view, offset, user, time, f"e{i}", f"l{i}", partition))
    return rows


def batch_result(spark, rows, window):
    events = spark.createDataFrame([event_row(*row) for row in rows], EVENT)
    accepted = lateness.judge(events).filter(~F.col("late"))
    return {row.page_view_id: (row.attributed_campaign_id, row.attributed_click_id)
            for row in attribution.attribute(accepted, window).collect()}


@pytest.mark.parametrize("seed, emit, rows_per_cut", [(1, "update", 1 << 20), (2, "update", 3), (3, "once", 1 << 20), (4, "once", 3)])
def test_any_batching_gives_the_batch_result(spark, tmp_path, seed, emit, rows_per_cut):
    rows = random_arrivals(seed)
    window = timedelta(minutes=30)
    feed = Feed(spark, tmp_path, window=window, emit=emit, rows_per_cut=rows_per_cut)
    for start in range(0, len(rows), 45):
        feed.deliver(rows[start:start + 45])
    if emit == "once":
        held_back = len(feed.results())
        feed.work.finish(spark, feed.last)
        written = feed.work.revisions(spark)
        assert held_back < written.count() == written.select("page_view_id").distinct().count()
    assert feed.results() == batch_result(spark, rows, window)


def test_old_batches_leave_the_working_set(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for n, hour in enumerate((8, 10, 12)):
        feed.deliver([(False, n, "u", f"{hour:02d}:00:00", f"c{n}", "x"), (True, n, "u", f"{hour:02d}:05:00", f"v{n}", "/x")])
    assert list(feed.work.state(spark, feed.last).batches) == [feed.last]


def test_settings_must_be_known(tmp_path):
    for setting in ({"emit": "twice"}, {"sink": "database"}):
        with pytest.raises(ValueError):
            journal.Attribution(str(tmp_path), **setting)


def test_tables_of_another_run_are_refused(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([row[:6] for row in ARRIVALS[:3]])
    sent = spark.read.parquet(f"{tmp_path}/landing")
    with pytest.raises(ValueError, match="another query"):
        feed.work(sent, 0)
    with pytest.raises(ValueError, match="lacks the batch"):
        feed.redo(sent, 7)


def test_batch_of_refused_records_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.send(spark.createDataFrame(
        [("ad_clicks", 0, 0, "{")], "topic string, partition int, offset bigint, value string"))
    feed.deliver([row[:6] for row in ARRIVALS])
    assert feed.results() == EXPECTED


def test_sinks(spark, tmp_path):
    lines = Feed(spark, tmp_path / "lines", sink="jsonl")
    lines.deliver([row[:6] for row in ARRIVALS[:3]])
    lines.deliver([row[:6] for row in ARRIVALS[3:]])
    assert lines.results() == EXPECTED
    text = [line for path in (tmp_path / "lines" / "tables" / "revisions").rglob("*.json")
            for line in path.read_text().splitlines()]
    assert len(text) == 7 and all('"attributed_click_id"' in line for line in text)

    taken = {}
    own = Feed(spark, tmp_path / "own", sink=lambda rows, batch_id: taken.update({batch_id: rows.count()}))
    own.deliver([row[:6] for row in ARRIVALS])
    assert taken == {0: 6}


def test_audit_of_a_run(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([row[:6] for row in ARRIVALS[:3]])
    feed.deliver([row[:6] for row in ARRIVALS[3:]])
    counts = {row.type: row["count"] for row in feed.work.audit(spark).groupBy("type").count().collect()}
    assert counts == {"CLICK": 6, "PAGE_VIEW": 6, "ATTRIBUTION": 7, "LATE_EVENT": 1, "WATERMARK": 12}


def test_source_must_be_named(spark):
    with pytest.raises(ValueError):
        records.read_records(spark)


SIX = [row[:6] for row in ARRIVALS]


def test_function_sink_keeps_its_last_batch_over_finish(spark, tmp_path):
    taken = {}

    def sink(rows, batch_id, tail=False):
        taken[batch_id, tail] = {row.page_view_id for row in rows.collect()}

    feed = Feed(spark, tmp_path, emit="once", sink=sink)
    feed.deliver(SIX)
    feed.work.finish(spark, feed.last)
    assert taken[0, False] and taken[0, True] and not taken[0, False] & taken[0, True]
    assert taken[0, False] | taken[0, True] == set(EXPECTED)
    feed.work.sink = lambda rows, batch_id: None
    with pytest.raises(ValueError, match="tail"):
        feed.work.finish(spark, feed.last)


def test_tables_agree_after_finish(spark, tmp_path):
    feed = Feed(spark, tmp_path, emit="once")
    feed.deliver(SIX)
    feed.work.finish(spark, feed.last)
    feed.work.finish(spark, feed.last)  # once more changes nothing
    assert feed.results() == EXPECTED
    assert {row.page_view_id for row in feed.work.revisions(spark).collect()} == set(EXPECTED)
    audit = feed.work.audit(spark)
    assert audit.filter("type = 'ATTRIBUTION'").count() == 6
    assert audit.filter("processed_at IS NULL").count() == 0


def test_other_settings_are_refused(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver(SIX[:3])
    for setting in ({"window": timedelta(minutes=31)}, {"allowed_lateness": timedelta(0)}, {"emit": "once"}, {"buckets": 2}):
        feed.work = journal.Attribution(f"{tmp_path}/tables", **setting)
        with pytest.raises(ValueError, match="other settings"):
            feed.redo(spark.read.parquet(f"{tmp_path}/landing"), 1)


def hourly(n):
    return [(False, n, "u", f"{8 + 2 * n:02d}:00:00", f"c{n}", "x"), (True, n, "u", f"{8 + 2 * n:02d}:05:00", f"v{n}", "/x")]


def test_redelivery_after_the_first_batch_was_let_go(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for n in range(3):
        feed.deliver(hourly(n))
    assert feed.work.state(spark, feed.last).first == 2
    before = feed.results()
    feed.deliver([*hourly(0), *hourly(1), *hourly(3)])
    assert feed.work.journal(spark).count() == 8
    assert feed.results() == before | {"v3": ("x", "c3")}


def test_a_batch_reads_the_buckets_of_its_users(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([(True, n, f"user_{n}", "12:00:00", f"v{n}", "/x") for n in range(20)])
    feed.deliver([(False, 0, "user_3", "12:00:00", "c", "x")])
    before = feed.work.state(spark, 0)
    own = feed.work.journal(spark, range(1, 2))
    assert own.count() == 1 and list(before.batches) == [0]
    plan = feed.work._resolve(spark, before, range(2), own.select("user_id"), [own.first().bucket], 1)._jdf.queryExecution().executedPlan().toString()
    bucket = own.first().bucket
    assert any("bucket" in line and f"= {bucket}" in line for line in plan.splitlines() if "PartitionFilters" in line)
    assert feed.results() == {f"v{n}": ("x", "c") if n == 3 else (None, None) for n in range(20)}


def test_compaction(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver(SIX[:3])
    feed.deliver(SIX[3:])
    feed.work.compact(spark)
    assert feed.results() == EXPECTED and feed.work.revisions(spark).count() == 6
    assert spark.read.schema(journal.REVISIONS).parquet(f"{tmp_path}/tables/revisions").count() == 0
    feed.deliver([(True, 90, "user_1", "13:10:00", "late_pv", "/x")])
    # stopped before the manifest is written: the new base does not count
    spark.createDataFrame([], journal.REVISIONS).write.parquet(f"{tmp_path}/tables/base-2")
    assert feed.results() == EXPECTED | {"late_pv": (None, None)}
    feed.work.compact(spark)
    assert feed.work.generation(spark) == 2
    assert feed.results() == EXPECTED | {"late_pv": (None, None)}
    with pytest.raises(ValueError):
        journal.Attribution(str(tmp_path), sink=print).compact(spark)


def test_views_are_rewritten_by_clicks_that_change_nothing(spark, tmp_path):
    batches = [
        [(False, 0, "u", "12:20:00", "best", "b"), (True, 0, "u", "12:30:00", "v", "/x"), (True, 1, "w", "12:30:00", "w", "/x")],
        [(False, 1, "u", "12:10:00", "older", "o")], [(False, 2, "u", "12:31:00", "after", "a")], [(False, 3, "u", "12:25:00", "new", "n")],
    ]
    for only_changes, expected in ((False, ["best", "best", "new"]), (True, ["best", "new"])):
        feed = Feed(spark, tmp_path / str(only_changes), only_changes=only_changes)
        for rows in batches:
            feed.deliver(rows)
        assert feed.writes("v") == expected and feed.writes("w") == [None]


def test_processing_time_is_kept_by_a_batch_that_is_redone(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    def stamps(batch):
        return {row.processed_at for row in feed.work.journal(spark, range(batch, batch + 1)).select("processed_at").collect()}

    feed.deliver(SIX[:3])
    write, feed.work._write_results = feed.work._write_results, None  # the batch fails after its journal
    with pytest.raises(StreamingQueryException):
        feed.deliver(SIX[3:])
    first = stamps(1)
    feed.work._write_results = write
    feed.deliver([(True, 6, "user_6", "13:25:00", "pv_7", "/x")])
    assert len(first) == 1 and stamps(1) == first and feed.work.state(spark, 2) is not None
    times = {row.batch_id: row.processed_at for row in feed.work.journal(spark).select("batch_id", "processed_at").distinct().collect()}
    assert sorted(times) == [0, 1, 2] and times[0] < times[1] < times[2]
    newest = feed.work.audit(spark).orderBy(F.desc("processed_at"), F.desc("seq")).first()
    assert newest.seq == 2


def test_progress_and_retained_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    log = metrics.ProgressLog(spark, f"{tmp_path}/metrics", feed.work)
    spark.streams.addListener(log)
    try:
        feed.deliver(SIX[:3])
        feed.deliver(SIX[3:])
        deadline = time.time() + 60
        while log.retained().count() < 4 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    events = spark.createDataFrame([event_row(*row) for row in SIX], EVENT)
    expected = {row.topic: (row.evictable, row.retained) for row in
                lateness.evictable(lateness.judge(events), attribution.WINDOW, lateness.LATENESS).collect()}
    found = {row.topic: (row.evictable, row.retained) for row in log.retained().filter("batch_id = 1").collect()}
    assert found == expected
    assert [row.input_rows for row in log.progress().orderBy("batch_id").collect()] == [3, 10]


def test_rows_per_trigger_and_interval(spark, tmp_path):
    for n in range(3):
        events = spark.createDataFrame([event_row(*row) for row in hourly(n)], EVENT)
        events.select(
            F.when(F.col("is_view"), "page_views").otherwise("ad_clicks").alias("topic"), "partition", "offset", records.encode().alias("value"),
        ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
    work = journal.Attribution(f"{tmp_path}/tables")
    stream = records.read_records(spark, path=f"{tmp_path}/landing", per_trigger=1)
    run = journal.start(stream, work, f"{tmp_path}/checkpoint", interval="100 milliseconds")
    try:
        deadline = time.time() + 90
        while time.time() < deadline and work.state(spark, 2) is None:
            time.sleep(0.5)
        assert run.isActive
    finally:
        run.stop()
    assert work.journal(spark).groupBy("batch_id").count().filter("count = 2").count() == 3
    assert work.current(spark).count() == 3
