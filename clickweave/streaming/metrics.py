"""Progress of running queries, and what a journal retains, as tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from clickweave.streaming.journal import Attribution, _table, stored

PROGRESS = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("triggered_at", T.StringType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("rows_per_second", T.DoubleType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("behind", T.StringType()),
])


class ProgressLog(StreamingQueryListener):
    """Writes a row per batch to `root`, and with a journal what it retains and has let go after the batch.

    `behind` is what the sources tell of their lag, such as offsets behind the latest. Failures are logged; they must not
    stop the query that is watched.
    """

    def __init__(self, spark: SparkSession, root: str, work: Attribution | None = None) -> None:
        self.spark, self.root, self.work = spark, root, work

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        try:
            self.write(progress)
        except Exception:  # a listener that raises is only reported by the JVM
            logging.getLogger(__name__).exception("progress of batch %s was not written", progress.batchId)

    def write(self, progress) -> None:
        behind = {source.description: dict(source.metrics or {}) for source in progress.sources}
        row = (str(progress.id), progress.timestamp, progress.numInputRows, progress.processedRowsPerSecond, progress.batchDuration, str(behind))
        at = f"batch_id={progress.batchId}"
        _table(self.spark, [row], PROGRESS).write.mode("overwrite").parquet(f"{self.root}/progress/{at}")
        if self.work is not None and self.work.state(self.spark, progress.batchId) is not None:
            found = self.work.metrics(self.spark, progress.batchId).drop("batch_id")
            found.write.mode("overwrite").parquet(f"{self.root}/retained/{at}")

    def progress(self) -> DataFrame:
        return stored(self.spark, T.StructType([*PROGRESS.fields, T.StructField("batch_id", T.LongType())]), f"{self.root}/progress")

    def retained(self) -> DataFrame:
        """Per batch and topic: watermark, cutoff, events let go and retained, and by how much the watermark trails the clock."""
        schema = "topic string, watermark timestamp, cutoff timestamp, evictable bigint, retained bigint, batch_id bigint"
        rows = stored(self.spark, schema, f"{self.root}/retained")
        return rows.withColumn("lag", F.current_timestamp() - F.col("watermark"))
