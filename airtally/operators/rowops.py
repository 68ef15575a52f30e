"""Row-level operators: SQL filters, sorts, samples, side effects."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def sql_filter(df: DataFrame, predicate: str) -> DataFrame:
    """Rows for which a SQL predicate holds."""
    return df.filter(F.expr(predicate))


def sql_on(df: DataFrame, statement: str) -> DataFrame:
    """Run a SQL statement whose ``{df}`` is this DataFrame."""
    return df.sparkSession.sql(statement, df=df)


def sort_top(df: DataFrame, column: str, size: int, tiebreak: list[str]) -> DataFrame:
    """The ``size`` rows with the greatest ``column``, as a top-n and not a full sort."""
    return df.orderBy(F.col(column).desc(), *tiebreak).limit(size)


def first_rows(df: DataFrame, size: int) -> DataFrame:
    """Any ``size`` rows."""
    return df.limit(size)


def stratified_sample(df: DataFrame, label: str, fractions: dict, seed: int) -> DataFrame:
    """A share of the rows for each label value."""
    return df.sampleBy(label, fractions, seed)


def split_rows(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Random split."""
    return df.randomSplit(weights, seed)


def draw(keys: list[str], seed: int) -> Column:
    """Eight hex digits that depend on the key columns and the seed only.

    A row's draw is the same in whatever task, order or engine it is computed, so a task that runs
    again, or a second reading of the table, cannot change what was drawn.
    """
    return F.substring(F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))), 1, 8)


def below(share: float) -> str:
    """The draws below this are a share of all."""
    return f"{min(round(share * (1 << 32)), (1 << 32) - 1):08x}" if share < 1 else "g"


def keyed_sample(df: DataFrame, label: str, fractions: dict, keys: list[str], seed: int) -> DataFrame:
    """A share of the rows for each label value, chosen by the draw of their keys; other labels go."""
    chosen = F.lit(False)
    for value, share in fractions.items():
        chosen = chosen | ((F.col(label) == F.lit(value)) & (draw(keys, seed) < F.lit(below(share))))
    return df.filter(chosen)


def keyed_split(df: DataFrame, share: float, keys: list[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """About ``share`` of the rows, and the others, by the draw of their keys. No sort, no shuffle."""
    first = draw(keys, seed) < F.lit(below(share))
    return df.filter(first), df.filter(~first)


def for_each_batch_of_rows(df: DataFrame, act: Callable[[Iterator[Row]], None]) -> None:
    """Run a side effect on the executors, once per partition with its rows."""
    df.foreachPartition(act)
