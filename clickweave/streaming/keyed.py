"""Attribution with keyed state and timers, over the log of accepted events.

`journal.Attribution(emit="log")` judges the records; its journal is the stream read here. State is kept per user bucket and
time slice of one window's width: the views of the slice, and the clicks that can reach them, which lie in the slice or the one
before. So a busy user is many keys, processed by many tasks. Each call writes the views that arrived and those a click changed.

The watermark is the log's `floor`: no event accepted later lies before it. A slice is dropped by a timer when the floor has passed its
end. Events are judged already, so the watermark itself drops none.

State is a table in Arrow form per key. Redelivered log rows are recognised by their coordinates while the slice is kept.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from clickweave.functions.columns import micros
from clickweave.operators import attribution, tables
from clickweave.schemas import ATTRIBUTED
from clickweave.session import shuffled_into
from clickweave.streaming.journal import JOURNAL, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not find this package

BUCKETS = 64
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

CHANGES = T.StructType([
    T.StructField("kind", T.StringType()),
    *ATTRIBUTED.fields,
    T.StructField("bucket", T.IntegerType()),
    T.StructField("slice", T.LongType()),
    T.StructField("n_clicks", T.LongType()),
    T.StructField("n_views", T.LongType()),
])


def accepted_log(spark: SparkSession, root: str) -> DataFrame:
    """The accepted events of a journal as a stream."""
    return spark.readStream.schema(JOURNAL).parquet(f"{root}/journal").filter(~F.col("late"))


class Slices(StatefulProcessor):
    """The state of one user bucket and time slice."""

    def __init__(self, width: int, window: int):
        self.width, self.window = width, window

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "events binary")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)[["is_view", "partition", "offset", "user_id", "at", "id", "label"]]
        new["click"] = -1
        bucket, number = int(key[0]), int(key[1])
        known = self.held.get() if self.held.exists() else None
        if known is None:
            self.handle.registerTimer((number + 1) * self.width // 1000 + 1)
            events, fresh = new, np.ones(len(new), dtype=bool)
        else:
            events = pd.concat([pa.ipc.open_stream(known[0]).read_pandas(), new], ignore_index=True)
            fresh = np.arange(len(events)) >= len(events) - len(new)
        once = ~events.duplicated(["is_view", "partition", "offset"]).to_numpy()
        events, fresh = events[once].reset_index(drop=True), fresh[once]
        found = self.latest_clicks(events)
        is_view = events["is_view"].to_numpy(dtype=bool)
        # a click is known by its coordinates' place in the slice; places stay, as events are only added
        changed = is_view & (fresh | (found != events["click"].to_numpy()))
        events["click"] = found
        sink = pa.BufferOutputStream()
        table = pa.Table.from_pandas(events, preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.held.update((sink.getvalue().to_pybytes(),))
        views, clicks = events[changed], found[changed]
        hit = clicks >= 0
        credited = events.iloc[np.maximum(clicks, 0)]
        yield pd.DataFrame({
            "kind": "result", "page_view_id": views["id"].to_numpy(), "user_id": views["user_id"].to_numpy(),
            "event_time": pd.to_datetime(views["at"].to_numpy(), unit="us"), "url": views["label"].to_numpy(),
            "attributed_campaign_id": np.where(hit, credited["label"].to_numpy(), None),
            "attributed_click_id": np.where(hit, credited["id"].to_numpy(), None),
            "bucket": np.int32(bucket), "slice": number, "n_clicks": 0, "n_views": 0,
        })

    def latest_clicks(self, events: pd.DataFrame) -> np.ndarray:
        """For each row, the place of its user's latest click up to it, if in the window, else -1."""
        order = events.sort_values(["user_id", "at", "is_view", "offset", "partition"], kind="stable").index.to_numpy()
        is_view = events["is_view"].to_numpy(dtype=bool)[order]
        user = pd.factorize(events["user_id"].to_numpy()[order])[0]
        at = events["at"].to_numpy()[order]
        place = np.maximum.accumulate(np.where(is_view, -1, np.arange(len(order))))
        ok = (place >= 0) & is_view
        ok &= (user[np.maximum(place, 0)] == user) & (at[np.maximum(place, 0)] >= at - self.window)
        found = np.empty(len(order), dtype=np.int64)
        found[order] = np.where(ok, order[np.maximum(place, 0)], -1)
        return found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events = pa.ipc.open_stream(self.held.get()[0]).read_pandas()
        self.held.clear()
        # clicks of the slice before are evicted with that one
        own = events["at"].to_numpy() >= int(key[1]) * self.width
        is_view = events["is_view"].to_numpy(dtype=bool)
        row: dict = {name: [None] for name in CHANGES.names}
        row |= {"kind": ["evicted"], "bucket": [int(key[0])], "slice": [int(key[1])],
                "n_clicks": [int((own & ~is_view).sum())], "n_views": [int(is_view.sum())]}
        row["event_time"] = pd.to_datetime([None])
        yield pd.DataFrame(row).astype({"bucket": "int32"})


def changes(events: DataFrame, window: timedelta = attribution.WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """Result rows as they are written (`kind` result), and counts of the events each dropped slice held (`kind` evicted)."""
    width = micros(window) + 1
    at = F.unix_micros("event_time")
    own = F.floor(at / F.lit(width)).cast("bigint")
    keyed = (
        # above the watermark that a query starts with; the delay keeps it behind every floor, so that rows of an unmoved floor are not late
        events.withColumn("floor", F.greatest("floor", F.timestamp_seconds(F.lit(1)))).withWatermark("floor", "1 millisecond")
        .select(
            "floor", "is_view", "partition", "offset", "user_id", at.alias("at"), "id", "label",
            F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("user_bucket"),
            F.explode(F.when(F.col("is_view"), F.array(own)).otherwise(F.array(own, own + 1))).alias("slice_number"),
        )
    )
    return keyed.groupBy("user_bucket", "slice_number").transformWithStateInPandas(
        statefulProcessor=Slices(width, micros(window)), outputStructType=CHANGES, outputMode="Update", timeMode="EventTime")


def start(
    stream: DataFrame, root: str, checkpoint: str, available_now: bool = False, interval: str = "1 minute", partitions: int | None = None,
):
    """Write changes to `root`, a folder per batch; a repeated batch replaces its own.

    `partitions`, of the state, is the session's number of shuffle partitions if not given; a checkpoint keeps its own.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    with shuffled_into(stream.sparkSession, partitions):
        return (
            stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )


def written(spark: SparkSession, root: str) -> DataFrame:
    return stored(spark, T.StructType([*CHANGES.fields, T.StructField("batch_id", T.LongType())]), root)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The result table: the last write of every view."""
    return tables.current(written(spark, root).filter("kind = 'result'"), ["batch_id"])
