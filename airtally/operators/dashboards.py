"""Grouped counts, time windows and the dashboard panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Row count per group."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def sliding_event_stats(events: DataFrame, length: str = "5 minutes",
                        slide: str = "2 minutes") -> DataFrame:
    """Average, count and sum of amounts per sliding window and event type."""
    grouped = events.groupBy(F.window("event_ts", length, slide), "event_type")
    return grouped.agg(
        F.avg("event_amount").alias("avg"), F.count("event_amount").alias("count"),
        F.sum("event_amount").alias("sum"))


def device_place_stats(locations: DataFrame, window: Column | None = None) -> DataFrame:
    """Mean position and best visibility per device and place, in windows if given."""
    extra = [] if window is None else [window]
    return locations.groupBy(*extra, "device_id", "location").agg(
        F.avg("lon").alias("lon"), F.avg("lat").alias("lat"),
        F.max("visibility").alias("visibility"))


def device_place_tumbling(locations: DataFrame, ts: str, length: str = "10 seconds") -> DataFrame:
    """As ``device_place_stats`` in tumbling windows."""
    return device_place_stats(locations, F.window(ts, length))


def column_summary(df: DataFrame, name: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum in one pass."""
    return df.agg(F.count(name).alias("count"), F.avg(name).alias("mean"),
                  F.stddev(name).alias("stddev"), F.min(name).alias("min"),
                  F.max(name).alias("max"))


def contains_counts(lines: DataFrame, column: str, needles: list[str]) -> DataFrame:
    """Number of rows, and of rows containing each text, in one pass."""
    found = [F.count_if(F.col(column).contains(n)).alias(f"has_{i}") for i, n in enumerate(needles)]
    return lines.agg(F.count(F.lit(1)).alias("lines"), *found)


def classification_report(df: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Confusion matrix as fractions, precision, recall, F and accuracy, in one pass."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    total = F.count(F.lit(1))
    cells = df.agg(
        (F.count_if(y & p) / total).alias("true_pos"),
        (F.count_if(~y & ~p) / total).alias("true_neg"),
        (F.count_if(~y & p) / total).alias("false_pos"),
        (F.count_if(y & ~p) / total).alias("false_neg"))
    scored = cells.withColumns({
        "precision": F.try_divide("true_pos", F.col("true_pos") + F.col("false_pos")),
        "recall": F.try_divide("true_pos", F.col("true_pos") + F.col("false_neg")),
        "accuracy": F.col("true_pos") + F.col("true_neg")})
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f_measure", F.try_divide(2 * p * r, p + r))


def date_histogram(df: DataFrame, ts: str, unit: str = "day",
                   since: str | None = None, until: str | None = None) -> DataFrame:
    """Count per calendar unit, empty units left out, optionally in a time range."""
    return (_in_range(df, ts, since, until).groupBy(F.date_trunc(unit, ts).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("count")))


def _in_range(df: DataFrame, ts: str, since: str | None, until: str | None) -> DataFrame:
    kind = df.schema[ts].dataType
    if since:
        df = df.filter(F.col(ts) >= F.lit(since).cast(kind))
    if until:
        df = df.filter(F.col(ts) < F.lit(until).cast(kind))
    return df


def top_terms(df: DataFrame, column: str, size: int) -> DataFrame:
    """The ``size`` most frequent values; equal counts in order of the value."""
    known = df.filter(F.col(column).isNotNull())
    return count_by(known, column).orderBy(F.col("count").desc(), column).limit(size)


def terms_histogram(df: DataFrame, column: str, ts: str, unit: str = "month",
                    size: int = 5) -> DataFrame:
    """Counts per calendar unit for the globally most frequent values.

    The list of values has at most ``size`` rows, so it is broadcast.
    """
    best = F.broadcast(top_terms(df, column, size).select(column))
    return (df.join(best, column, "left_semi")
            .groupBy(column, F.date_trunc(unit, ts).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("count")))


def histogram_terms(df: DataFrame, column: str, ts: str, metric: Column, name: str,
                    order: list[Column], unit: str = "day", size: int = 5) -> DataFrame:
    """Per calendar unit, a metric for up to ``size`` values chosen inside the unit.

    The ranking runs over grouped rows, one per unit and value.
    """
    grouped = (df.filter(F.col(column).isNotNull())
               .groupBy(F.date_trunc(unit, ts).alias("bucket"), column).agg(metric.alias(name)))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(*order))
    return grouped.withColumn("place", place).filter(F.col("place") <= size).drop("place")


def median_by_status(df: DataFrame, ts: str, unit: str = "day", size: int = 5) -> DataFrame:
    """Median stars per unit and club status, statuses by name descending."""
    return histogram_terms(df, "club_status", ts, F.percentile("stars", F.lit(0.5)), "median_stars",
                           [F.col("club_status").desc()], unit, size)


def count_by_channel(df: DataFrame, ts: str, unit: str = "day", size: int = 5) -> DataFrame:
    """Row count per unit for the most frequent channels of that unit."""
    return histogram_terms(df, "channel", ts, F.count(F.lit(1)), "count",
                           [F.col("count").desc(), F.col("channel")], unit, size)
