"""Running folds (last, max, sum) along an order within groups, for groups of any size.

A plain window puts each group into one task. That breaks down when one user or one source partition
holds a large share of all rows. Here large groups are cut into blocks along the sort order, and each
block starts from the fold of everything before it:

1. *Cut points.* Rows whose hash falls into one of `rows_per_cut` slots become block starts. They are
   counted, and if there are more than `max_cuts`, a second hash thins them to about that many, so
   nothing is sorted or gathered in one task. A group gets about one cut per `rows_per_cut` rows;
   groups that get fewer than two stay whole and cost nothing extra. Cut points only decide where
   work is divided; every row takes part in the result, wherever the cuts fall.
2. *Blocks.* Each row finds its block by binary search in its group's sorted cut points. The cut
   table has about `max_cuts` rows at most, whatever the input, which makes broadcasting it safe.
3. *Carries.* Per block of a cut group, the fold of its rows is aggregated (map side first), then
   folded across the group's blocks, of which there is one more than it has cut points.
4. *Window.* Carries join the rows as the first row of their block; one shuffle and sort on
   (keys, block) then yields the running values.

The plan is the same for every input size. Without cut points, steps 2 and 3 see an empty table and
adaptive execution removes them.

The cut table is computed from the input, so it is the same on every evaluation and a lost executor
cannot shift a block boundary between the two places where blocks are used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CUT = 1 << 18
MAX_CUTS = (1 << 17) - 1


@dataclass(frozen=True)
class Fold:
    """`kind` is last (latest non-null), max or sum; `before` leaves the current row out.

    A value is computed where it is needed, after the shuffle, so it takes no room in it. One given by column name is that
    column, which then also brings the carries.
    """

    kind: str
    value: Column | str
    before: bool = False

    def whole(self, position: Column) -> Column:
        """The fold over all rows of a block."""
        value = F.col(self.value) if isinstance(self.value, str) else self.value
        if self.kind == "last":
            return F.max_by(value, F.when(value.isNotNull(), position))
        return {"max": F.max, "sum": F.sum}[self.kind](value)

    def along(self, value: Column | str) -> Column:
        """The fold as a window function."""
        if self.kind == "last":
            return F.last(value, ignorenulls=True)
        return {"max": F.max, "sum": F.sum}[self.kind](value)


def cut_points(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_cut: int = ROWS_PER_CUT,
    max_cuts: int = MAX_CUTS,
) -> DataFrame:
    """Sorted block starts per group: `keys..., _cuts array<struct<order...>>`, about `max_cuts` in all at most."""
    candidates = (
        rows.select(*keys, F.struct(*order).alias("_at"), F.xxhash64(*keys, *order).alias("_hash"))
        .filter(F.pmod("_hash", F.lit(rows_per_cut)) == 0)
    )
    keep_one_in = F.greatest(F.lit(1), F.ceil(candidates.agg(F.count(F.lit(1))).scalar() / max_cuts))
    return (
        candidates.filter(F.pmod(F.xxhash64("_hash"), keep_one_in) == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))
        .filter(F.size("_cuts") > 1)
    )


def _in_blocks(rows: DataFrame, order: Sequence[str], max_cuts: int) -> DataFrame:
    """Replace `_cuts` by `_block`, the number of cut points at or before the row (0 without any), and
    `_is_cut`, whether the group has any.

    A binary search in halving steps (one more than `max_cuts` needs, as it is met on average only), each its own projection: these stay in one generated function, which
    reads the broadcast array in place. A higher-order function would be handed a copy of it per row.
    """
    position = ", ".join(f"`{name}`" for name in order)
    columns, found = [f"struct({position}) AS _at"], "0"
    for step in (1 << bit for bit in reversed(range(max_cuts.bit_length() + 1))):
        columns.append(f"{found} + if(get(_cuts, {found} + {step - 1}) <= _at, {step}, 0) AS _found{step}")
        found = f"_found{step}"
    kept = [name for name in rows.columns if name != "_cuts"]
    return rows.selectExpr("*", *columns).selectExpr(
        *(f"`{name}`" for name in kept), f"{found} AS _block", "_cuts IS NOT NULL AS _is_cut")


def running(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Mapping[str, Fold],
    *,
    cuts_from: DataFrame | None = None,
    rows_per_cut: int = ROWS_PER_CUT,
    max_cuts: int = MAX_CUTS,
) -> DataFrame:
    """Add one column per fold, its value along `order` within `keys`.

    `order` must be free of nulls and unique within a group. `cuts_from` may name a cheaper frame with about
    the same rows (say, the same data before a filter) to take cut points from.
    """
    keys, order = list(keys), list(order)
    carried = {name: fold.value if isinstance(fold.value, str) else f"_carry_{name}" for name, fold in folds.items()}
    source = rows if cuts_from is None else cuts_from
    cuts = F.broadcast(cut_points(source, keys, order, rows_per_cut, max_cuts))
    placed = _in_blocks(rows.join(cuts, keys, "left"), order, max_cuts)

    earlier_blocks = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carries = (
        placed.filter("_is_cut")
        .groupBy(*keys, "_block")
        .agg(*(fold.whole(F.struct(*order)).alias(carried[name]) for name, fold in folds.items()))
        .withColumns({carried[name]: fold.along(carried[name]).over(earlier_blocks) for name, fold in folds.items()})
    )
    is_row = F.col("_is_cut").isNotNull()
    inputs = {
        name: fold.value if isinstance(fold.value, str) else F.when(is_row, fold.value).otherwise(F.col(carried[name]))
        for name, fold in folds.items()
    }
    return (
        placed.unionByName(carries, allowMissingColumns=True)
        .withColumns(_along(folds, inputs, [*keys, "_block"], [is_row, *order]))
        .filter(is_row)
        .drop("_is_cut", "_block", *(set(carried.values()) - set(rows.columns)))
    )


def _along(
    folds: Mapping[str, Fold], values: Mapping[str, Column | str], keys: list, order: list
) -> dict[str, Column]:
    window = Window.partitionBy(*keys).orderBy(*order)
    return {
        name: fold.along(values[name]).over(
            window.rowsBetween(Window.unboundedPreceding, -1 if fold.before else Window.currentRow))
        for name, fold in folds.items()
    }
