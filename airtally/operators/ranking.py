"""Ranking, running and neighbour columns that survive a heavy partition.

Plain windows put a whole partition in one task. Here partitions above ``rows``
rows are cut into pieces along the order column (equal values stay together);
windows run inside a piece and totals of the pieces before it are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtally.operators.skew import HOT_ROWS, cut_groups, same_keys


def ranked(df: DataFrame, keys: list[str], order: str, tiebreak: list[str],
           descending: bool = True, rows: int = HOT_ROWS) -> DataFrame:
    """Add the window columns of the value column ``order`` within ``keys``:

    ``rank``, ``dense_rank``, ``row_number``; ``running_total`` (equal values share
    it); ``next_val`` and ``prev_val`` (0 at the ends); ``first_val`` and
    ``last_val``. Rows are ordered by ``order`` and then by ``tiebreak``.
    """
    value, zero = F.col(order), F.lit(0).cast(df.schema[order].dataType)
    cut = cut_groups(df, keys, [order], rows)
    if cut is None:
        local = _windows(df, keys, value, tiebreak, descending)
        return local.withColumns({"next_val": F.coalesce("next_val", zero),
                                  "prev_val": F.coalesce("prev_val", zero)})
    # Pieces ascend with the value; walk them in the direction of the sort.
    turned = F.transform("piece", lambda number: -number) if descending else F.col("piece")
    walked = cut.rows.withColumn("piece", turned)
    local = _windows(walked, [*keys, "piece"], value, tiebreak, descending)
    totals = _pieces_before(walked.filter("is_hot"), keys, order, descending)
    joined = local.alias("d").join(
        cut.sized(totals.alias("t")),
        same_keys("d", "t", keys) & (F.col("d.piece") == F.col("t.piece")), "left")

    def plus(column: str, before: str) -> Column:
        return (F.col(f"d.{column}") + F.coalesce(F.col(f"t.{before}"), F.lit(0))).alias(column)

    return joined.select(
        *[F.col(f"d.{c}") for c in df.columns],
        plus("rank", "rows_before"), plus("dense_rank", "values_before"),
        plus("row_number", "rows_before"), plus("running_total", "sum_before"),
        F.coalesce("d.next_val", "t.next_piece", zero).alias("next_val"),
        F.coalesce("d.prev_val", "t.prev_piece", zero).alias("prev_val"),
        F.coalesce("t.first_piece", "d.first_val").alias("first_val"),
        F.coalesce("t.last_piece", "d.last_val").alias("last_val"))


def _windows(df: DataFrame, keys: list[str], value: Column, tiebreak: list[str],
             descending: bool) -> DataFrame:
    """The window columns within ``keys``, over one sort."""
    by_value = value.desc() if descending else value.asc()
    inside = Window.partitionBy(*keys).orderBy(by_value)
    exact = Window.partitionBy(*keys).orderBy(by_value, *tiebreak)
    whole = exact.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({
        "rank": F.rank().over(inside).cast("bigint"),
        "dense_rank": F.dense_rank().over(inside).cast("bigint"),
        "row_number": F.row_number().over(exact).cast("bigint"),
        # The default frame is a range, so equal values share the total.
        "running_total": F.sum(value).over(inside),
        "next_val": F.lead(value).over(exact), "prev_val": F.lag(value).over(exact),
        "first_val": F.first(value).over(exact),
        # "From here to the end" and "whole partition" have the same last row, and
        # the second is computed once per partition instead of once per row.
        "last_val": F.last(value).over(whole)})


def _pieces_before(hot: DataFrame, keys: list[str], order: str, descending: bool) -> DataFrame:
    """Per piece of a hot partition: totals of the pieces before it and the values
    at its borders. Counted over distinct values first, so it combines early."""
    value = F.col(order)
    per_value = hot.groupBy(*keys, "piece", order).agg(F.count(F.lit(1)).alias("copies"))
    low, high = F.min(value), F.max(value)
    pieces = per_value.groupBy(*keys, "piece").agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("n_values"),
        F.sum(value * F.col("copies")).alias("total"),
        (high if descending else low).alias("head"), (low if descending else high).alias("tail"))
    walk = Window.partitionBy(*keys).orderBy("piece")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    every = walk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return pieces.select(
        *keys, "piece",
        F.sum("n").over(before).alias("rows_before"),
        F.sum("n_values").over(before).alias("values_before"),
        F.sum("total").over(before).alias("sum_before"),
        F.lead("head").over(walk).alias("next_piece"), F.lag("tail").over(walk).alias("prev_piece"),
        F.first("head").over(every).alias("first_piece"),
        F.last("tail").over(every).alias("last_piece"))
