"""Spark's own stateful operators: keyed state with timers, and the stock outer join."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickweave import session
from clickweave.plans import streams
from clickweave.schemas import ATTRIBUTED, EVENT
from clickweave.sources import records
from clickweave.sources.scenario import ARRIVALS, EXPECTED, event_row
from clickweave.sources.tables import EVENTS
from clickweave.streaming import keyed, outer_join
from test_stream import Feed, batch_result, random_arrivals


class KeyedFeed(Feed):
    def __init__(self, spark, folder, window=timedelta(minutes=30), buckets=2):
        super().__init__(spark, folder, window=window, emit="log")
        self.window, self.buckets = window, buckets

    def send(self, sent):
        super().send(sent)
        stream = keyed.changes(keyed.accepted_log(self.spark, self.work.root), self.window, self.buckets)
        keyed.start(stream, f"{self.folder}/changes", f"{self.folder}/keyed", available_now=True).awaitTermination()

    def results(self):
        return {row.page_view_id: (row.attributed_campaign_id, row.attributed_click_id)
                for row in keyed.current(self.spark, f"{self.folder}/changes").collect()}


def test_scenario(spark, tmp_path):
    feed = KeyedFeed(spark, tmp_path)
    feed.deliver([row[:6] for row in ARRIVALS[:3]])
    feed.deliver([row[:6] for row in ARRIVALS[3:]])
    assert feed.results() == EXPECTED


def test_random_arrivals_and_a_hot_user(spark, tmp_path):
    """A hot user's slices are keys of their own; slices behind the floor are let go with all they hold."""
    rows = random_arrivals(7)
    feed = KeyedFeed(spark, tmp_path, window=timedelta(minutes=20), buckets=1)
    for start in range(0, len(rows), 30):
        feed.deliver(rows[start:start + 30])
    assert feed.results() == batch_result(spark, rows, timedelta(minutes=20))
    changes = keyed.written(spark, f"{tmp_path}/changes")
    evicted = changes.filter("kind = 'evicted'")
    assert evicted.count() == evicted.select("bucket", "slice").distinct().count() > 2
    late_slice = evicted.agg(F.max("slice")).first()[0]
    gone = feed.work.journal(spark).filter(~F.col("late") & (F.unix_micros("event_time") < (late_slice + 1) * (20 * 60_000_000 + 1)))
    counted = evicted.agg(F.sum("n_clicks"), F.sum("n_views")).first()
    assert tuple(counted) == (gone.filter("NOT is_view").count(), gone.filter("is_view").count())
    hot = changes.filter("kind = 'result' AND user_id = 'hot'")
    assert hot.select("slice").distinct().count() > 3


def test_outer_join_drops_what_the_query_watermark_has_passed(spark, tmp_path):
    def send(rows):
        spark.createDataFrame([event_row(*row) for row in rows], EVENT).select(
            F.when(F.col("is_view"), "page_views").otherwise("ad_clicks").alias("topic"), "partition", "offset", records.encode().alias("value"),
        ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        run()

    def run():
        streams = (records.read_records(spark, path=f"{tmp_path}/landing") for _ in range(2))
        outer_join.start(outer_join.attributed(*streams), f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True).awaitTermination()

    def results():
        return {row.page_view_id: row.attributed_click_id for row in spark.read.schema(ATTRIBUTED).parquet(f"{tmp_path}/out").collect()}

    send([(False, 0, "u", "12:00:00", "c0", "x"), (True, 0, "u", "12:10:00", "v0", "/x"), (True, 1, "u", "12:50:00", "v1", "/x"),
          (False, 1, "w", "12:40:00", "c1", "x")])
    # the watermark is 12:25 now: a click on it is dropped, one after it still counts
    send([(False, 2, "u", "12:25:00", "on", "x"), (True, 2, "w", "12:26:00", "v2", "/x"), (False, 3, "u", "12:25:01", "c2", "x")])
    assert results().items() <= {"v0": "c0"}.items()  # written once the watermark is a window past it
    outer_join.closing_records(spark).write.mode("append").parquet(f"{tmp_path}/landing")
    run()
    assert results() == {"v0": "c0", "v1": "c2", "v2": None}


@pytest.mark.parametrize("name, checkpoint", [("stream_outer_join_24h", "checkpoint"), ("stream_keyed_24h", "keyed-checkpoint")])
def test_state_partitions_do_not_grow_with_the_shuffle_partitions(spark, tmp_path, monkeypatch, name, checkpoint):
    """The session's partitions follow the input; every state partition costs time in every batch, whatever it holds."""
    rows = [(2 * nth + view, datetime(2024, 1, day, 12, view), user, "view" if view else "click", 0.0, f'{{"k": {day}}}')
            for nth, (day, user) in enumerate((day, user) for day in (3, 10, 17, 24) for user in range(3)) for view in (0, 1)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(streams, "work_folder", lambda spark, purpose: f"{tmp_path}/work")
    cores = spark.sparkContext.defaultParallelism
    before = spark.conf.get(session.PARTITIONS)
    spark.conf.set(session.PARTITIONS, str(cores + 9))
    try:
        found = {row.page_view_id: row.attributed_click_id for row in streams.STREAMS[name](spark, f"{tmp_path}/sf").collect()}
        assert found == {str(row[0]): str(row[0] - 1) for row in rows if row[3] == "view"}
        stores = [folder for folder in Path(tmp_path, "work", checkpoint, "state", "0").iterdir() if folder.name.isdigit()]
        assert len(stores) == cores
        assert spark.conf.get(session.PARTITIONS) == str(cores + 9)
        assert session.state_partitions(spark, session.RECORDS_PER_STATE * (cores + 2)) == cores + 2
        assert session.state_partitions(spark, 10**12) == cores + 9
    finally:
        spark.conf.set(session.PARTITIONS, before)
