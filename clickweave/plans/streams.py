"""Streaming queries: the `events` table delivered in arrival order as a record stream."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.columns import topic
from clickweave.plans.batch import HOURS_24, MIN_30, RUN_ENDS, Query
from clickweave.schemas import ATTRIBUTED, RECORD
from clickweave.session import state_partitions, work_folder
from clickweave.sources import records
from clickweave.sources.tables import events, with_offsets
from clickweave.streaming import journal, keyed, outer_join


def deliveries(spark: SparkSession, sf_dir: str, root: str) -> Iterator[str]:
    """Append the records of each delivery period to a landing folder, one period per step."""
    numbered = with_offsets(events(spark, sf_dir)).select(
        topic().alias("topic"), "partition", "offset", records.encode().alias("value"),
        sum((F.col("arrival") >= F.lit(end)).cast("int") for end in RUN_ENDS).alias("period"),
    )
    numbered.write.partitionBy("period").parquet(f"{root}/periods")
    for period in range(len(RUN_ENDS) + 1):
        staged = spark.read.schema(RECORD).parquet(f"{root}/periods/period={period}")
        staged.write.mode("append").parquet(f"{root}/landing")
        yield f"{root}/landing"


def _partitions(spark: SparkSession, root: str) -> int:
    """State partitions for the records of all deliveries."""
    return state_partitions(spark, spark.read.schema(RECORD).parquet(f"{root}/periods").count())


def _deliver(spark: SparkSession, work: journal.Attribution, landing: str, root: str) -> int:
    """Run the journal over what has landed; the number of its last batch."""
    run = journal.start(records.read_records(spark, path=landing), work, f"{root}/checkpoint", available_now=True)
    run.awaitTermination()
    return run.lastProgress["batchId"]


def _plain_times(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names or ("event_time",)})


def outer_joined(window: timedelta) -> Query:
    """Spark's own streaming join, restarted for every delivery and closed in the end."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "stream-join")

        def run(landing: str, partitions: int) -> None:
            streams = (records.read_records(spark, path=landing) for _ in range(2))
            found = outer_join.attributed(*streams, window)
            outer_join.start(found, f"{root}/result", f"{root}/checkpoint", available_now=True, partitions=partitions).awaitTermination()

        partitions = None
        for landing in deliveries(spark, sf_dir, root):
            partitions = partitions or _partitions(spark, root)
            run(landing, partitions)
        outer_join.closing_records(spark).write.mode("append").parquet(f"{root}/landing")
        run(f"{root}/landing", partitions)
        return _plain_times(spark.read.schema(ATTRIBUTED).parquet(f"{root}/result"))
    return query


def keyed_state(window: timedelta) -> Query:
    """The log of accepted events, attributed by keyed state with timers after every delivery."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "stream-keyed")
        work = journal.Attribution(f"{root}/tables", window, emit="log")
        partitions = None
        for landing in deliveries(spark, sf_dir, root):
            partitions = partitions or _partitions(spark, root)
            _deliver(spark, work, landing, root)
            stream = keyed.changes(keyed.accepted_log(spark, work.root), window, buckets=4)
            keyed.start(
                stream, f"{root}/changes", f"{root}/keyed-checkpoint", available_now=True, partitions=partitions).awaitTermination()
        return _plain_times(keyed.current(spark, f"{root}/changes"))
    return query


def audit_counts(window: timedelta) -> Query:
    """The feed of an emit-once run, its tail included: entries by type, and whether all have a processing time."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "stream-audit")
        work = journal.Attribution(f"{root}/tables", window, emit="once")
        last = [_deliver(spark, work, landing, root) for landing in deliveries(spark, sf_dir, root)][-1]
        work.finish(spark, last)
        return work.audit(spark).groupBy("type").agg(
            F.count(F.lit(1)).alias("n_entries"), F.count("processed_at").alias("n_stamped"), F.count_if("attributed").alias("n_attributed"))
    return query


def running_metrics(window: timedelta) -> Query:
    """What a run reports after its last batch."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "stream-metrics")
        work = journal.Attribution(f"{root}/tables", window)
        last = [_deliver(spark, work, landing, root) for landing in deliveries(spark, sf_dir, root)][-1]
        return _plain_times(work.metrics(spark, last).drop("batch_id", "watermark"), "cutoff")
    return query


def compacted(window: timedelta) -> Query:
    """Update mode with every second batch compacted."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "stream-compacted")
        work = journal.Attribution(f"{root}/tables", window, compact_every=2, only_changes=False)
        for landing in deliveries(spark, sf_dir, root):
            _deliver(spark, work, landing, root)
        return _plain_times(work.current(spark))
    return query


def journaled(emit: str, window: timedelta, sink: str = "table", finish_early: bool = False) -> Query:
    """Run the stream one delivery at a time, stopping and restarting in between, and read the result.

    With `finish_early` every delivery is finished as if it were the last.
    """
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, f"stream-{emit}")
        work = journal.Attribution(f"{root}/tables", window, emit=emit, sink=sink)
        last = None
        for landing in deliveries(spark, sf_dir, root):
            last = _deliver(spark, work, landing, root)
            if finish_early:
                work.finish(spark, last)
        if emit == "once":
            work.finish(spark, last)
        return work.current(spark).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    return query


STREAMS: dict[str, Query] = {
    "stream_update_30m": journaled("update", MIN_30),
    "stream_update_24h": journaled("update", HOURS_24),
    "stream_emit_once_24h": journaled("once", HOURS_24),
    "stream_emit_once_resumed": journaled("once", HOURS_24, finish_early=True),
    "stream_jsonl_24h": journaled("update", HOURS_24, sink="jsonl"),
    "stream_outer_join_24h": outer_joined(HOURS_24),
    "stream_keyed_24h": keyed_state(HOURS_24),
    "stream_audit_counts": audit_counts(HOURS_24),
    "stream_metrics": running_metrics(MIN_30),
    "stream_compacted_24h": compacted(HOURS_24),
}
