"""Keeping one heavy key from becoming one heavy task.

A window or a collected list needs all rows of its key in one task. The helpers
here find the few keys that hold too many rows, cut the rows of those keys into
pieces along the sort order, and let the caller carry values between pieces.
Every other key stays in a single piece, and when no key is heavy the plan is the
plain one.

Heavy keys are found by a counting job over the key columns that runs when the
operator is called. Its answer has a fixed maximum length, so it may pass through
the driver and be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key above this many rows is cut into pieces of about this many rows.
HOT_ROWS = 2_000_000
# The list of hot keys is broadcast, so its length has a hard bound. The keys
# beyond it are the smaller ones and are handled unsplit: slower, never dropped.
HOT_KEYS = 10_000
# Tables with one row per piece are broadcast up to this many rows.
BROADCAST_PIECES = 200_000
# Cut points of one key at most; above it pieces grow with the key.
CUTS = 1024
# Types whose values can be cut into ranges.
RANGED = (T.NumericType, T.DatetimeType)


def order_number(order: Column, data_type: T.DataType) -> Column:
    """A double that grows with the order column, to cut it into ranges."""
    if isinstance(data_type, T.TimestampNTZType):
        order = order.cast("timestamp")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(order).cast("double")
    if isinstance(data_type, T.DateType):
        return F.unix_date(order).cast("double")
    return order.cast("double")


def _local(found: DataFrame) -> DataFrame | None:
    """A short result as literal rows, or None when it is empty."""
    rows = found.collect()
    return found.sparkSession.createDataFrame(rows, found.schema) if rows else None


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS, at_most: int = HOT_KEYS,
             extra: list[Column] | None = None) -> DataFrame | None:
    """``keys, slices`` and ``extra`` aggregates for every key above ``rows`` rows, or
    None when there is none.

    The count combines on the map side over the key columns only; the biggest
    ``at_most`` keys are kept as literal rows. A stream cannot be counted ahead, so
    there it is always None.
    """
    if df.isStreaming:
        return None
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"), *(extra or []))
    heavy = (counted.filter(F.col("key_rows") > rows)
             .withColumn("slices", F.ceil(F.col("key_rows") / F.lit(rows)).cast("int"))
             .orderBy(F.col("key_rows").desc(), *keys).limit(at_most).drop("key_rows"))
    return _local(heavy)


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality over several keys of two aliased sides."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return condition


@dataclass(frozen=True)
class Cut:
    """Rows with ``piece`` and ``is_hot``, and how many pieces hot keys have in all."""

    rows: DataFrame
    pieces: int

    def sized(self, per_piece: DataFrame) -> DataFrame:
        """A table with a row per hot piece, to be broadcast if it is short enough;
        otherwise Spark joins it as it sees fit."""
        return F.broadcast(per_piece) if self.pieces <= BROADCAST_PIECES else per_piece


def cut_groups(df: DataFrame, keys: list[str], order: list[str], rows: int = HOT_ROWS,
               at_most: int = HOT_KEYS) -> Cut | None:
    """Cut hot groups into pieces along the ``order`` columns; None when no key is hot.

    ``piece`` is an array of range numbers, all 0 for normal keys; pieces sort like
    their rows. One pass over the rows of the hot keys sketches the quantiles of the first order
    column; each cut point is a piece of its own, between two of them lies another, so even
    a burst is cut as finely as it is dense. A piece that is many copies of one
    value is cut in the same way along the next order column. Equal rows over all of ``order``
    share a piece.
    """
    cut, pieces = df.withColumns({"piece": F.array().cast("array<int>"), "is_hot": F.lit(False)}), 0
    for step, column in enumerate(order):
        if not isinstance(df.schema[column].dataType, RANGED):
            break  # text cannot be cut into ranges
        if step == 0:
            groups, hot = keys, hot_keys(df, keys, rows, at_most)
        else:
            groups, before = [*keys, "piece"], F.col(order[step - 1])
            hot = hot_keys(cut.filter("is_hot"), groups, 2 * rows, at_most,
                           [F.min(before).eqNullSafe(F.max(before)).alias("single")])
            # Only copies of one value may be told apart by the next column.
            hot = _local(hot.filter("single").drop("single")) if hot is not None else None
        if hot is None:
            break
        number = order_number(F.col(column), df.schema[column].dataType)
        cuts = _cut_points(cut, hot, groups, number)
        pieces += cuts.select(F.sum(2 * F.size("cuts") + 2)).first()[0]
        found = F.col("h.cuts")
        here = found.isNotNull()
        below = F.size(F.filter(found, lambda c: c < number))
        part = (F.when(here & F.col(column).isNull(), F.lit(-1))  # nulls sort first
                .when(here, 2 * below + F.array_contains(found, number).cast("int")).otherwise(F.lit(0)))
        cut = (cut.alias("d").join(F.broadcast(cuts.alias("h")), same_keys("d", "h", groups), "left")
               .select(*[F.col(f"d.{c}") for c in df.columns],
                       F.concat(F.col("d.piece"), F.array(part)).alias("piece"),
                       (F.col("d.is_hot") | here).alias("is_hot")))
    return Cut(cut, pieces) if pieces else None


def _cut_points(df: DataFrame, hot: DataFrame, groups: list[str], number: Column) -> DataFrame:
    """``groups, cuts``: sorted values that cut each hot group into about its number of slices.

    The sketches have a bounded size and combine on the map side; a key's cut points are
    at most CUTS, so with the bound on hot keys the literal rows are bounded too.
    """
    most = min(max(2, *(r[0] for r in hot.select("slices").collect())), CUTS)
    shares = [k / most for k in range(1, most)]
    rows = (df.alias("d").join(F.broadcast(hot.alias("h")), same_keys("d", "h", groups))
            .select(*[F.col(f"d.{k}").alias(k) for k in groups], F.col("h.slices").alias("slices"), number.alias("number")))
    sketch = rows.groupBy(*groups).agg(F.first("slices").alias("slices"),
                                       F.percentile_approx("number", shares, 10 * most).alias("points"))
    step = F.greatest(F.lit(1), F.floor(F.size("points") / F.col("slices")).cast("int"))
    chosen = F.filter("points", lambda p, i: (i + 1) % step == 0)
    return _local(sketch.select(*groups, F.array_distinct(F.coalesce(chosen, F.array().cast("array<double>"))).alias("cuts")))


def lead_rows(df: DataFrame, keys: list[str], order: list[str], values: list[str],
              prefix: str = "next_", rows: int = HOT_ROWS,
              at_most: int = HOT_KEYS) -> DataFrame:
    """``lead`` of several columns over ``keys`` ordered by ``order``.

    Without hot keys this is the ordinary window. Otherwise it runs inside pieces, and the last row of a
    piece takes the first row of the following piece; those first rows are gathered
    for hot keys only.
    """
    cut = cut_groups(df, keys, order, rows, at_most)
    if cut is None:
        ahead = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({prefix + v: F.lead(v).over(ahead) for v in values})
    ahead = Window.partitionBy(*keys, "piece").orderBy(*order)
    led = cut.rows.withColumns({**{prefix + v: F.lead(v).over(ahead) for v in values},
                           "led": F.lead(F.lit(True)).over(ahead)})
    row = F.struct(*[F.col(v) for v in values])
    heads = (cut.rows.filter("is_hot").groupBy(*keys, "piece")
             .agg(F.min_by(row, F.struct(*order)).alias("head")))
    after = heads.select(
        *keys, "piece",
        F.lead("head").over(Window.partitionBy(*keys).orderBy("piece")).alias("next_head"))
    joined = led.alias("d").join(
        cut.sized(after.alias("p")),
        same_keys("d", "p", keys) & (F.col("d.piece") == F.col("p.piece")), "left")
    return joined.select(
        *[F.col(f"d.{c}") for c in df.columns],
        *[F.when(F.col("d.led"), F.col(f"d.{prefix}{v}")).otherwise(F.col("p.next_head")[v])
          .alias(prefix + v) for v in values])


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                rows: int = HOT_ROWS, at_most: int = HOT_KEYS,
                hot: DataFrame | None = None) -> DataFrame:
    """Equi-join (``inner`` or ``left``) that spreads heavy keys of the left side.

    Left rows of a hot key get a slice from a hash of their content (a recomputed
    task gives the same answer); the right rows of that key are repeated once per
    slice. ``hot`` may be passed when the counts are known from a cheaper table.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left")
    hot = hot if hot is not None else hot_keys(left, keys, rows, at_most)
    if hot is None:
        return left.join(right, keys, how)
    content = F.xxhash64(*[F.col(f"l.{c}") for c in left.columns])
    spread = left.alias("l").join(F.broadcast(hot.alias("h")), same_keys("l", "h", keys), "left") \
        .select("l.*", F.coalesce(F.pmod(content, F.col("h.slices")), F.lit(0)).alias("slice"))
    copies = right.alias("r").join(F.broadcast(hot.alias("h")), same_keys("r", "h", keys), "left") \
        .select("r.*", F.explode(F.sequence(
            F.lit(0), F.coalesce(F.col("h.slices"), F.lit(1)) - 1)).alias("slice")) \
        .withColumn("slice", F.col("slice").cast("bigint"))
    return spread.withColumn("slice", F.col("slice").cast("bigint")) \
        .join(copies, keys + ["slice"], how).drop("slice")
