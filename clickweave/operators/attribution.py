"""Which click a page view is credited to: the same user's latest one within a look-back window.

The join is a backward as-of join. Clicks and views are sorted together per user, and every view takes
the last click before it, so there is one shuffle and no pairing of clicks with views. Both ends of the
window are included, and equal click times are decided by arrival order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.operators.scan import Fold, running
from clickweave.schemas import OFFSET_ORDER

WINDOW = timedelta(minutes=30)


def click_value(eligible: Column | None = None, keep: Sequence[str] = ()) -> Column:
    """The click on this row as one value; null on views and on clicks that are not eligible."""
    is_click = ~F.col("is_view") if eligible is None else ~F.col("is_view") & eligible
    return F.when(is_click, F.struct("event_time", "id", "label", *keep))


def within(click: str, window: timedelta) -> Column:
    """`click` if it is at most `window` before the row's own time, else null."""
    return F.when(F.col(click)["event_time"] >= F.col("event_time") - F.lit(window), F.col(click))


def arrived_in(run: Column) -> Column:
    """The time of a click that meets `run`, null on other rows; to be folded to its maximum."""
    return F.when(~F.col("is_view") & run, F.col("event_time"))


def touched(latest: str, window: timedelta) -> Column:
    """Whether a look-back window holds any of the clicks whose latest time before the row is `latest`.

    Of all clicks up to a view the latest one is the likeliest to lie in the window, so a fold over an unbounded range
    answers for the bounded one, also where a group is cut into blocks.
    """
    return F.coalesce(F.col(latest) >= F.col("event_time") - F.lit(window), F.lit(False))


def resolve(
    events: DataFrame,
    window: timedelta = WINDOW,
    order: Sequence[str] = OFFSET_ORDER,
    eligible: Column | None = None,
    keep: Sequence[str] = (),
    **scan,
) -> DataFrame:
    """All events with `click`, the click each view is credited to (null when there is none), and
    `position`, their number in the user's time order.

    Only clicks meeting `eligible` are candidates. `click` is a struct of the click's `event_time`, `id`,
    `label` and the columns named in `keep`; it is filled on view rows only.
    """
    by_time = ("event_time", "is_view", *order)
    folds = {"click": Fold("last", click_value(eligible, keep)), "position": Fold("sum", F.lit(1))}
    found = running(events, ["user_id"], by_time, folds, **scan)
    return found.withColumn("click", F.when(F.col("is_view"), within("click", window)))


def resolve_views(
    events: DataFrame,
    window: timedelta = WINDOW,
    order: Sequence[str] = OFFSET_ORDER,
    keep: Sequence[str] = (),
    latest: Mapping[str, Column] | None = None,
    **scan,
) -> DataFrame:
    """As `resolve`, but views only, which lets click rows travel as the click value alone.

    `latest` names columns to add: the maximum of a value over the clicks before the view, however long before.
    """
    lean = events.withColumns({
        "_click": click_value(keep=keep),
        "id": F.when(F.col("is_view"), F.col("id")),
        "label": F.when(F.col("is_view"), F.col("label")),
    })
    by_time = ("event_time", "is_view", *order)
    folds = {"click": Fold("last", "_click")}
    folds |= {name: Fold("max", F.when(~F.col("is_view"), value)) for name, value in (latest or {}).items()}
    found = running(lean, ["user_id"], by_time, folds, **scan)
    return found.filter("is_view").withColumn("click", within("click", window)).drop("_click")


def result_columns(click: str = "click") -> list[Column]:
    return [
        F.col("id").alias("page_view_id"),
        "user_id",
        "event_time",
        F.col("label").alias("url"),
        F.col(click)["label"].alias("attributed_campaign_id"),
        F.col(click)["id"].alias("attributed_click_id"),
    ]


def attribute(
    events: DataFrame, window: timedelta = WINDOW, order: Sequence[str] = OFFSET_ORDER, **scan
) -> DataFrame:
    """The result table: one row per view. Merge separate tables with `as_events` first."""
    return resolve_views(events, window, order, **scan).select(*result_columns())


def corrected(
    events: DataFrame, window: timedelta = WINDOW, order: Sequence[str] = OFFSET_ORDER, **scan
) -> DataFrame:
    """Views whose credited click arrived after them, so that their first result had to be rewritten.

    `order` must be comparable across partitions and topics (arrival time, say).
    """
    arrived = F.struct(*order)
    click_arrived = F.struct(*(F.col("click")[name].alias(name) for name in order))
    resolved = resolve_views(events, window, order, keep=order, **scan)
    return resolved.filter(click_arrived > arrived).select(*result_columns())


def revisions(
    events: DataFrame,
    window: timedelta = WINDOW,
    order: Sequence[str] = OFFSET_ORDER,
    *,
    boundaries: Sequence[datetime],
    arrival: str = "arrival",
    only_changes: bool = True,
    **scan,
) -> DataFrame:
    """The rows an incremental run writes when it stops at each of `boundaries` and at the end.

    A view is written by the run it arrives in, and again by every later run in which a click arrived whose window holds
    it: whatever that click changes, or with `only_changes` only if it changed the result. All runs are read off one pass
    over the data, through which a row travels with the number of its run.
    """
    run_of = sum((F.col(arrival) >= F.lit(end)).cast("int") for end in boundaries) if boundaries else F.lit(0)
    by_time = ("event_time", "is_view", *order)
    runs = range(len(boundaries) + 1)
    folds = {f"click_{run}": Fold("last", click_value(F.col("_run") <= run)) for run in runs}
    if not only_changes:
        folds |= {f"touched_{run}": Fold("max", arrived_in(F.col("_run") == run)) for run in runs}
    found = running(events.withColumn("_run", run_of), ["user_id"], by_time, folds, **scan).filter("is_view")
    found = found.withColumns({f"click_{run}": within(f"click_{run}", window) for run in runs})

    written = []
    for run in runs:
        again = F.lit(False)
        if run and only_changes:
            again = ~F.col(f"click_{run}").eqNullSafe(F.col(f"click_{run - 1}"))
        elif run:
            again = touched(f"touched_{run}", window)
        writes = (F.col("_run") == run) | ((F.col("_run") < run) & again)
        written.append(F.when(writes, F.struct(F.lit(run).alias("revision"), F.col(f"click_{run}").alias("click"))))
    return (
        found.withColumn("_write", F.explode(F.filter(F.array(*written), lambda w: w.isNotNull())))
        .withColumn("click", F.col("_write")["click"])
        .select(F.col("_write")["revision"].alias("revision"), *result_columns())
    )


def click_reach(
    events: DataFrame, window: timedelta = WINDOW, order: Sequence[str] = OFFSET_ORDER,
    **scan,
) -> DataFrame:
    """For every click, which of its user's views lie in the `window` after it: `(click, click + window]`.

    A user's views, numbered by time, make this a range: those after the first `views_before`, `n_views`
    of them. That holds every click-view pair in one row per click, where listing the pairs would grow
    with the square of a busy user's rows.
    """
    # A click stands at its own time and once more at the end of its window, after views of equal time.
    marks = events.withColumn(
        "mark",
        F.explode(
            F.when(F.col("is_view"), F.array(F.struct(F.lit(0).alias("kind"), F.col("event_time").alias("at"))))
            .otherwise(F.array(
                F.struct(F.lit(1).alias("kind"), F.col("event_time").alias("at")),
                F.struct(F.lit(2).alias("kind"), (F.col("event_time") + F.lit(window)).alias("at")),
            ))
        ),
    ).select("user_id", "id", "event_time", *order, "mark.kind", "mark.at")
    counted = running(
        marks, ["user_id"], ("at", "kind", *order),
        {"views": Fold("sum", F.when(F.col("kind") == 0, 1).otherwise(0))},
        **scan,
    )
    at_start = F.max(F.when(F.col("kind") == 1, F.col("views")))
    at_end = F.max(F.when(F.col("kind") == 2, F.col("views")))
    return (
        counted.filter(F.col("kind") > 0)
        .groupBy("user_id", F.col("id").alias("click_id"), "event_time")
        .agg(at_start.alias("views_before"), (at_end - at_start).alias("n_views"))
    )


def latest_clicks(events: DataFrame, order: Sequence[str] = OFFSET_ORDER) -> DataFrame:
    """Each user's most recent click."""
    latest = F.max_by(F.struct("id", "label", "event_time"), F.struct("event_time", *order))
    return (
        events.filter(~F.col("is_view")).groupBy("user_id").agg(latest.alias("click"))
        .select("user_id", F.col("click.id").alias("click_id"), F.col("click.label").alias("campaign_id"),
                F.col("click.event_time").alias("event_time"))
    )
