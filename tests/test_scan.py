"""Running folds against brute force, with and without cut points."""

import random

import pytest
from pyspark.sql import functions as F

from clickweave.operators import scan
from clickweave.operators.scan import Fold, cut_points, running

# A third of all rows belong to one group, and a third of those share one time.
RNG = random.Random(7)
ROWS = [
    ("hot" if n % 3 == 0 else f"g{RNG.randrange(20)}",
     500 if n % 9 == 0 else RNG.randrange(1000), n, RNG.choice([None, n]))
    for n in range(3000)
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "key string, at int, seq int, value int").repartition(5).cache()


def brute_force(before):
    expected, state = {}, {}
    for key, _, seq, value in sorted(ROWS, key=lambda row: (row[0], row[1], row[2])):
        last, largest, total = state.get(key, (None, None, None))
        old = (last, largest, total)
        if value is not None:
            last, largest, total = value, max(value, largest or 0), value + (total or 0)
        state[key] = new = (last, largest, total)
        expected[seq] = old if before else new
    return expected


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("rows_per_cut, max_cuts", [(1 << 20, 1000), (100, 1000), (1, 5000), (2, 13)])
def test_folds_do_not_depend_on_cuts(rows, before, rows_per_cut, max_cuts):
    folds = {"last": Fold("last", "value", before), "max": Fold("max", F.col("value"), before),
             "sum": Fold("sum", F.col("value"), before)}
    found = running(rows, ["key"], ["at", "seq"], folds, rows_per_cut=rows_per_cut, max_cuts=max_cuts)
    assert found.columns == ["key", "at", "seq", "value", "last", "max", "sum"]
    assert {row.seq: (row.last, row.max, row.sum) for row in found.collect()} == brute_force(before)


def test_cut_points_are_bounded_and_follow_group_size(rows):
    assert cut_points(rows, ["key"], ["at", "seq"], rows_per_cut=1 << 20).count() == 0
    sizes = {row.key: len(row._cuts) for row in cut_points(rows, ["key"], ["at", "seq"], 1, 60).collect()}
    assert 30 < sum(sizes.values()) <= 60
    assert sizes["hot"] > 10 and min(sizes.values()) > 1


def test_blocks_of_a_hot_group_are_small(rows):
    cuts = cut_points(rows, ["key"], ["at", "seq"], rows_per_cut=20)
    blocks = (
        scan._in_blocks(rows.join(cuts, "key"), ["at", "seq"], scan.MAX_CUTS).groupBy("key", "_block").count()
    )
    assert blocks.filter("key = 'hot'").count() > 20
    assert blocks.agg(F.max("count")).first()[0] < 250


def test_cuts_from_another_frame(rows):
    kept = rows.filter("seq % 2 = 0")
    found = running(kept, ["key"], ["at", "seq"], {"n": Fold("sum", F.lit(1))}, cuts_from=rows, rows_per_cut=4)
    plain = running(kept, ["key"], ["at", "seq"], {"n": Fold("sum", F.lit(1))})
    assert sorted(found.collect()) == sorted(plain.collect())


def test_large_groups_get_no_window_of_their_own(rows):
    """The final window is partitioned by block as well as by group."""
    found = running(rows, ["key"], ["at", "seq"], {"n": Fold("sum", F.lit(1))})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_block" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
