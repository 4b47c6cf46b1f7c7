"""Update-mode and emit-once attribution of a record stream.

Each micro-batch runs the batch operators over its own events and the part of the journal that can
still matter, and writes folders that are all keyed by the batch:

    journal/batch_id=N      the batch's events, judged: late or accepted (the accepted-event log), by user bucket
    revisions/batch_id=N    result rows written by the batch
    state/batch_id=N        settings, watermarks and highest offsets per source partition, oldest journal batch still needed

A batch that is run again after a failure overwrites its own folders, so the result is the same as if
it had run once; a finished one is skipped. Nothing is held on a heap between batches, hot users and
hot source partitions are cut up by the running folds, and events leave the working set once the
slowest partition of the other topic has passed them.

`compact` replaces the revisions so far by the result table they amount to; see there.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.functions.columns import micros, topic
from clickweave.operators import activity, attribution, lateness, tables
from clickweave.schemas import ATTRIBUTED, EVENT, OFFSET_ORDER
from clickweave.sources import records

JOURNAL = T.StructType([
    *EVENT.fields,
    T.StructField("watermark_before", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("floor", T.TimestampType()),
    T.StructField("late", T.BooleanType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("batch_id", T.LongType()),
])
STAMP = T.StructField("processed_at", T.TimestampType())
REVISIONS = T.StructType([*ATTRIBUTED.fields, STAMP, T.StructField("batch_id", T.LongType())])

SOURCES = T.StructType([
    T.StructField("is_view", T.BooleanType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("micros", T.LongType()),
    T.StructField("last_offset", T.LongType()),
])
STATE = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("settings", T.StringType()),
    *(T.StructField(name, T.LongType()) for name in ("first", "last_click", "last_view", "n_clicks", "n_views")),
    *SOURCES.fields,
])
BATCH = "batch_id bigint"

COORDINATES = ("is_view", "partition", "offset")
#: Layout of the tables; a folder of another version is refused.
VERSION = 3
#: Parts of the journal by user: a batch reads those of its own users only.
BUCKETS = 16
#: Up to so many retained batches are read by their paths, more by a filter on the whole journal.
MOST_PATHS = 64
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}

Sink = Callable[..., None]


def _table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows (short ones end in nulls) as a DataFrame, made without starting Python workers."""
    text = json.dumps([dict(zip(schema.names, row)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), T.ArrayType(schema))))


def stored(spark: SparkSession, schema: T.StructType | str, path: str, kind: str = "parquet", **options: str) -> DataFrame:
    """The table in a folder; without rows if the folder is not there yet."""
    try:
        return spark.read.schema(schema).options(**options).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        return _table(spark, [], schema)


@dataclass
class Source:
    """What is known of a source partition: its watermark, in microseconds, and its highest offset."""

    micros: int | None
    last_offset: int


@dataclass
class State:
    """What a batch leaves to later ones: a row per source partition and the oldest journal batch still needed."""

    run: str
    settings: str
    batch: int = -1
    first: int = 0
    #: Latest accepted click and view of the batch itself, in microseconds.
    last_click: int | None = None
    last_view: int | None = None
    #: Accepted clicks and views so far.
    n_clicks: int = 0
    n_views: int = 0
    sources: dict[tuple[bool, int], Source] = field(default_factory=dict)

    @property
    def batches(self) -> range:
        """Journal batches that later ones may need."""
        return range(self.first, self.batch + 1)

    def slowest(self, of_views: bool) -> int | None:
        return min((source.micros for (is_view, _), source in self.sources.items()
                    if is_view == of_views and source.micros is not None), default=None)

    def views_from(self, allowed: timedelta) -> int | None:
        """The earliest time a click still to be accepted can have; None while the click topic is silent."""
        clicks = self.slowest(of_views=False)
        return None if clicks is None else clicks - micros(allowed)

    def clicks_from(self, window: timedelta, allowed: timedelta) -> int | None:
        """The earliest click needed by views still to come and by views a late click could reopen."""
        views, clicks = self.slowest(of_views=True), self.slowest(of_views=False)
        if views is None or clicks is None:
            return None
        return min(views, clicks) - micros(window + allowed)

    def floor(self, allowed: timedelta) -> int:
        """The earliest time an event still to be accepted can have, as far as the partitions seen tell; 0 while a topic is silent."""
        slowest = [self.slowest(of_views) for of_views in (False, True)]
        return 0 if None in slowest else max(0, min(slowest) - micros(allowed))


class Attribution:
    """The work of one micro-batch, to be passed to `foreachBatch`.

    `emit="update"` writes a view when it arrives and again when a later click changes it; without `only_changes`, also
    when a later click's window holds it, whatever that changes.
    `emit="once"` holds a view until no click that could still be accepted can precede it.
    `emit="log"` judges events and keeps the accepted-event log, but writes no results.

    `sink` is "table" (parquet) or "jsonl", where `current` reads the result back, or a function that is
    given each batch's result rows and the batch number and must be idempotent in the latter. To be able to `finish`, a
    function takes `tail` as well: rows of `tail=True` belong beside those of the same batch, not in their place.

    With `compact_every`, every so many batches the revisions are compacted.
    """

    def __init__(
        self,
        root: str,
        window: timedelta = attribution.WINDOW,
        allowed_lateness: timedelta = lateness.LATENESS,
        emit: str = "update",
        sink: str | Sink = "table",
        only_changes: bool = True,
        buckets: int = BUCKETS,
        compact_every: int | None = None,
        **scan,
    ) -> None:
        if emit not in ("update", "once", "log"):
            raise ValueError("emit must be 'update', 'once' or 'log'")
        if not callable(sink) and sink not in ("table", "jsonl"):
            raise ValueError("sink must be 'table', 'jsonl' or a function")
        self.root, self.window, self.lateness = root, window, allowed_lateness
        self.emit, self.sink, self.scan, self.buckets = emit, sink, scan, buckets
        self.only_changes, self.compact_every = only_changes, compact_every
        self._states: dict[int, State] = {}
        self.settings = json.dumps({
            "version": VERSION, "window": micros(window), "lateness": micros(allowed_lateness), "emit": emit,
            "only_changes": only_changes, "buckets": buckets, "sink": "function" if callable(sink) else sink,
        })

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The query keeps its id across restarts, in its checkpoint.
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if self._checked(self.state(spark, batch_id), run) is not None:
            return
        before = State(run, self.settings) if batch_id == 0 else self._checked(self._known(spark, batch_id - 1), run)
        if before is None:
            raise ValueError(f"{self.root} lacks the batch before {batch_id}; it does not belong to this checkpoint")
        stamp = self._write_journal(batch, batch_id, before)
        after, buckets = self._next_state(spark, batch_id, before)
        if self.emit != "log":
            users = None
            if self.emit == "update":
                users = self.journal(spark, range(batch_id, batch_id + 1)).select("user_id").distinct()
            resolved = self._resolve(spark, before, range(before.first, batch_id + 1), users, buckets, batch_id)
            self._write_results(resolved.filter(self._due(batch_id, before, after)), batch_id, stamp)
        self._write_state(spark, self._trimmed(spark, after), batch_id)
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact(spark)

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        """After the last batch of a finite input: write the views `once` still holds back.

        They go to a folder of their own, `tail`, which counts as long as no later batch has finished. If the
        stream goes on after all, later batches write these views when they are due, once.
        """
        state = self.state(spark, batch_id)
        if self.emit == "log":
            raise ValueError("a log has no results to finish")
        if state is None:
            raise ValueError(f"{self.root} has no finished batch {batch_id}")
        if callable(self.sink) and not _takes_tail(self.sink):
            raise ValueError("the sink function must take 'tail', or the tail would replace the last batch")
        resolved = self._resolve(spark, state, state.batches)
        self._write_results(resolved.filter(self._open(state)), batch_id, now(spark), "tail")

    def _checked(self, state: State | None, run: str) -> State | None:
        if state is not None and state.run != run:
            raise ValueError(f"{self.root} holds the tables of another query; use a new folder or its checkpoint")
        if state is not None and state.settings != self.settings:
            raise ValueError(f"{self.root} was written with other settings: {state.settings}, not {self.settings}")
        return state

    # ---- steps of a batch ----

    def _write_journal(self, batch: DataFrame, batch_id: int, before: State) -> datetime:
        """Returns the batch's processing time."""
        spark = batch.sparkSession
        if STAMP.name not in batch.columns:
            batch = batch.withColumn(STAMP.name, F.lit(now(spark)))
        sources = [(is_view, partition, source.micros, source.last_offset) for (is_view, partition), source in before.sources.items()]
        known = F.broadcast(_table(spark, sources, SOURCES))
        decoded = records.decode(batch).join(known.drop("micros"), list(lateness.SOURCE), "left").persist()
        try:
            # A record above the highest offset so far is new; only those below can have come before.
            old = F.col("reason").isNull() & (F.col("offset") <= F.col("last_offset"))
            counts = decoded.agg(F.count("reason").alias("refused"), F.count_if(old).alias("old"), F.max(STAMP.name).alias("stamp")).first()
            decoded_rows = decoded.drop("last_offset")
            if counts.refused:
                self._write(records.quarantined(decoded_rows), f"quarantine/batch_id={batch_id}")
            events = tables.deduplicated(records.good(decoded_rows))
            if counts.old:
                events = self._without_redelivered(events, decoded.filter(old), batch_id)
            carried = known.filter("micros IS NOT NULL").select(*lateness.SOURCE, F.timestamp_micros("micros").alias("watermark"))
            judged = lateness.judge(events, self.lateness, OFFSET_ORDER, carried, **self.scan).withColumns({
                "floor": F.timestamp_micros(F.lit(before.floor(self.lateness))), "bucket": self._bucket()})
            # gathered by bucket, so that files are few; large buckets are split
            self._write(judged.hint("rebalance", "late", "bucket"), f"journal/batch_id={batch_id}", "late", "bucket")
            return counts.stamp or now(spark)
        finally:
            decoded.unpersist()

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int")

    def _without_redelivered(self, events: DataFrame, old: DataFrame, batch_id: int) -> DataFrame:
        """Without events whose coordinates an earlier batch brought, however long ago."""
        spark = events.sparkSession
        span = old.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).first()
        seen = stored(spark, JOURNAL, f"{self.root}/journal").filter(
            (F.col("batch_id") < batch_id) & F.col("offset").between(span.low, span.high)).select(*COORDINATES)
        redelivered = old.select(*COORDINATES).join(seen, list(COORDINATES), "left_semi")
        return events.join(redelivered, list(COORDINATES), "left_anti")

    def _next_state(self, spark: SparkSession, batch_id: int, before: State) -> tuple[State, list[int]]:
        """State after the batch, with all batches `before` has, and the batch's user buckets. One row per source partition is collected."""
        accepted = ~F.col("late")
        seen = (
            self.journal(spark, range(batch_id, batch_id + 1)).groupBy(*lateness.SOURCE)
            .agg(F.max(F.when(accepted, F.unix_micros("event_time"))).alias("last"),
                 F.count_if(accepted).alias("n_events"), F.max("offset").alias("last_offset"),
                 F.collect_set("bucket").alias("buckets"))  # no more than there are buckets
            .collect()
        )
        after = State(before.run, before.settings, batch_id, before.first, n_clicks=before.n_clicks, n_views=before.n_views,
                      sources=dict(before.sources))
        for row in seen:
            past = before.sources.get((row.is_view, row.partition))
            times = [at for at in (row.last, past and past.micros) if at is not None]
            after.sources[row.is_view, row.partition] = Source(
                max(times, default=None), row.last_offset if past is None else max(row.last_offset, past.last_offset))
            if row.is_view:
                after.n_views += row.n_events
            else:
                after.n_clicks += row.n_events
        after.last_click, after.last_view = (
            max((row.last for row in seen if row.is_view == of_views and row.last is not None), default=None) for of_views in (False, True))
        return after, sorted({bucket for row in seen for bucket in row.buckets})

    def _trimmed(self, spark: SparkSession, state: State) -> State:
        """Without the oldest journal batches that no later batch can need. Each batch's own state is read once on the way."""
        views_from = state.views_from(self.lateness)
        clicks_from = state.clicks_from(self.window, self.lateness)

        def needed(last: int | None, since: int | None) -> bool:
            return last is not None and (since is None or last >= since)

        while state.first < state.batch:
            oldest = self._known(spark, state.first)
            if needed(oldest.last_click, clicks_from) or needed(oldest.last_view, views_from):
                break
            state.first += 1
        if state.first == state.batch and not (needed(state.last_click, clicks_from) or needed(state.last_view, views_from)):
            state.first += 1
        for batch in [batch for batch in self._states if batch < state.first - 1]:
            del self._states[batch]
        return state

    def _known(self, spark: SparkSession, batch_id: int) -> State | None:
        """The state a finished batch left; those of retained batches are remembered."""
        if batch_id not in self._states:
            state = self.state(spark, batch_id)
            if state is None:
                return None
            self._states[batch_id] = state
        return self._states[batch_id]

    def _resolve(
        self, spark: SparkSession, before: State, batches: range, users: DataFrame | None = None, buckets: Sequence[int] = (),
        batch_id: int = -1,
    ) -> DataFrame:
        """Views of these journal batches with the click they are credited to; with `users`, theirs only, who are in `buckets`.

        From batches before `batch_id`, only events that can still matter are read.
        """
        accepted = self.journal(spark, batches).filter(~F.col("late"))
        cutoffs = {True: before.views_from(self.lateness), False: before.clicks_from(self.window, self.lateness)}
        past = F.col("batch_id") != batch_id
        for is_view, since in cutoffs.items():
            if since is not None:
                gone = past & (F.col("is_view") == is_view) & (F.col("event_time") < F.timestamp_micros(F.lit(since)))
                accepted = accepted.filter(~gone)
        if users is not None:
            accepted = accepted.filter(F.col("bucket").isin(list(buckets))).join(users, "user_id", "left_semi")
        # when a click of this batch was last before the view, to tell which views it reached
        reached = self.emit == "update" and not self.only_changes
        latest = {"_latest": F.when(F.col("batch_id") == batch_id, F.col("event_time"))} if reached else {}
        return attribution.resolve_views(
            accepted.drop("processed_at", "floor", "bucket"), self.window, OFFSET_ORDER, keep=("batch_id",), latest=latest, **self.scan)

    def _due(self, batch_id: int, before: State, after: State) -> Column:
        """Which resolved views this batch writes."""
        arrived = F.col("batch_id") == batch_id
        if self.emit == "update":
            if not self.only_changes:
                return arrived | attribution.touched("_latest", self.window)
            return arrived | F.coalesce(F.col("click.batch_id") == batch_id, F.lit(False))
        return ~self._open(after) & (arrived | self._open(before))

    def _open(self, state: State) -> Column:
        """Whether a click that could still be accepted may precede a view."""
        since = state.views_from(self.lateness)
        return F.lit(True) if since is None else F.col("event_time") >= F.timestamp_micros(F.lit(since))

    # ---- tables ----

    def journal(self, spark: SparkSession, batches: range | None = None) -> DataFrame:
        """Judged events of the given batches, or of all."""
        root = f"{self.root}/journal"
        if batches is not None and not len(batches):
            return _table(spark, [], JOURNAL)
        reader = spark.read.schema(JOURNAL).option("basePath", root)
        if batches is None:
            return reader.parquet(root)
        if len(batches) > MOST_PATHS:
            return reader.parquet(root).filter(F.col("batch_id").between(batches[0], batches[-1]))
        return reader.parquet(*(f"{root}/batch_id={batch}" for batch in batches))

    def generation(self, spark: SparkSession) -> int:
        """How often the results were compacted."""
        last = stored(spark, "generation bigint", f"{self.root}/manifest").agg(F.max("generation")).first()[0]
        return last or 0

    def _folder(self, name: str, generation: int) -> str:
        return f"{self.root}/{name}" if not generation else f"{self.root}/{name}-{generation}"

    def revisions(self, spark: SparkSession) -> DataFrame:
        """Every result row written, with its batch and processing time, the tail of the last batch included if it has one.

        Of rows from before the last compaction, the last write of each view.
        """
        generation = self.generation(spark)
        written = self._results(spark, self._folder("revisions", generation))
        if generation:
            written = written.unionByName(spark.read.schema(REVISIONS).parquet(self._folder("base", generation)))
        last = stored(spark, BATCH, f"{self.root}/state").agg(F.max("batch_id")).first()[0]
        if last is None:
            return written
        return written.unionByName(self._results(spark, f"{self.root}/tail").filter(F.col("batch_id") == last))

    def _results(self, spark: SparkSession, folder: str) -> DataFrame:
        return stored(spark, REVISIONS, folder, "json", **JSON) if self.sink == "jsonl" else stored(spark, REVISIONS, folder)

    def current(self, spark: SparkSession) -> DataFrame:
        """The result table: the last write of every view, with the tail of the last batch if it has one."""
        return tables.current(self.revisions(spark), ["batch_id"])

    def compact(self, spark: SparkSession) -> None:
        """Replace the revisions so far by the rows that `current` has, so that its reads do not grow with the batches.

        The rows go to a new folder, `base-<n>`. One row in `manifest` then makes it count, and later batches write to `revisions-<n>`.
        Only after that the files of the generation before are removed. Stopped anywhere, `current` stays the same. Not to be
        called while a batch is running.
        """
        if callable(self.sink):
            raise ValueError("the rows of a sink function are its own to compact")
        generation = self.generation(spark)
        last = F.max_by(F.struct(*REVISIONS.names[1:]), "batch_id")
        rows = self._results(spark, self._folder("revisions", generation))
        if generation:
            rows = rows.unionByName(spark.read.schema(REVISIONS).parquet(self._folder("base", generation)))
        rows.groupBy("page_view_id").agg(last.alias("row")).select("page_view_id", "row.*").write.mode("overwrite").parquet(
            self._folder("base", generation + 1))
        self._write(spark.range(0, 1, 1, 1).select(F.lit(generation + 1).cast("bigint").alias("generation")), f"manifest/n={generation + 1}")
        for name in ("revisions", "base"):
            for past in {generation, max(0, generation - 1)}:  # the one before as well, if the last run was stopped here
                if name == "revisions" or past:
                    _table(spark, [], REVISIONS).write.mode("overwrite").format("parquet").save(self._folder(name, past))

    def audit(self, spark: SparkSession) -> DataFrame:
        """Everything that happened, in the audit feed's columns; `seq` is the batch."""
        return activity.audit_log(self.journal(spark), self.revisions(spark))

    def metrics(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Per topic after a finished batch: its watermark and cutoff, and how many accepted events lie before and after the cutoff."""
        state = self.state(spark, batch_id)
        kept = self.journal(spark, state.batches).filter(~F.col("late"))
        rows = []
        for of_views, total in ((False, state.n_clicks), (True, state.n_views)):
            other = state.slowest(not of_views)
            keep = micros(self.lateness if of_views else self.window + self.lateness)
            rows.append((of_views, state.slowest(of_views), None if other is None else other - keep, total))
        schema = "is_view boolean, watermark bigint, cutoff bigint, total bigint"
        topics = _table(spark, rows, T.StructType.fromDDL(schema))
        retained = F.count_if(F.col("cutoff").isNull() | (F.unix_micros("event_time") >= F.col("cutoff")))
        counts = kept.join(F.broadcast(topics), "is_view").groupBy("is_view").agg(retained.alias("counted"))
        return (
            topics.join(counts, "is_view", "left").withColumn("retained", F.coalesce("counted", F.lit(0)))
            .select(F.lit(batch_id).cast("bigint").alias("batch_id"), topic().alias("topic"), F.timestamp_micros("watermark").alias("watermark"),
                    F.timestamp_micros("cutoff").alias("cutoff"), (F.col("total") - F.col("retained")).alias("evictable"), "retained")
        )

    def _write_results(self, due: DataFrame, batch_id: int, stamp: datetime, folder: str = "revisions") -> None:
        spark = due.sparkSession
        # An id sent twice in one batch with different content keeps its latest coordinates.
        latest = tables.current(
            due.select(*attribution.result_columns(), "partition", "offset"), ["offset", "partition"])
        if callable(self.sink):
            self.sink(latest, batch_id, tail=True) if folder == "tail" else self.sink(latest, batch_id)
            return
        latest = latest.withColumn(STAMP.name, F.lit(stamp))
        path = f"{self.root}/tail" if folder == "tail" else self._folder(folder, self.generation(spark))
        writer = latest.write.mode("overwrite")
        if self.sink == "jsonl":
            writer.options(**JSON).json(f"{path}/batch_id={batch_id}")
        else:
            writer.parquet(f"{path}/batch_id={batch_id}")

    def state(self, spark: SparkSession, batch_id: int) -> State | None:
        """What a finished batch left behind; None if it did not finish. The state is one file, written last."""
        rows = stored(spark, STATE, f"{self.root}/state/batch_id={batch_id}").collect()
        if not rows:
            return None
        head = next(row for row in rows if row.partition is None)
        return State(
            head.run, head.settings, batch_id, head.first, head.last_click, head.last_view, head.n_clicks, head.n_views,
            {(row.is_view, row.partition): Source(row.micros, row.last_offset) for row in rows if row.partition is not None},
        )

    def _write_state(self, spark: SparkSession, state: State, batch_id: int) -> None:
        head = (state.run, state.settings, state.first, state.last_click, state.last_view, state.n_clicks, state.n_views)
        rows = [head] + [
            (state.run, *[None] * 6, is_view, partition, source.micros, source.last_offset)
            for (is_view, partition), source in state.sources.items()
        ]
        self._write(_table(spark, rows, STATE), f"state/batch_id={batch_id}")
        self._states[batch_id] = state

    def _write(self, rows: DataFrame, path: str, *partition_by: str) -> None:
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.root}/{path}")


def now(spark: SparkSession) -> datetime:
    return spark.sql("SELECT current_timestamp()").first()[0]


def _takes_tail(sink: Sink) -> bool:
    known = inspect.signature(sink).parameters.values()
    return any(p.name == "tail" or p.kind is p.VAR_KEYWORD for p in known)


def start(
    stream: DataFrame, work: Attribution, checkpoint: str, available_now: bool = False, interval: str = "1 minute"
):
    """Run the work on a record stream. Progress is kept in `checkpoint`, which restarts continue from.

    A record's processing time is that of its batch, which the checkpoint keeps too: a batch that is done again has the same.
    """
    stream = stream.withColumn(STAMP.name, F.current_timestamp())
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
