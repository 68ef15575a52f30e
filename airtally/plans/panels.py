"""Aggregates, dashboard panels, window functions, sorts and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from airtally.operators import dashboards, ranking, rowops
from airtally.plans.registry import query
from airtally.plans.viewing import enriched
from airtally.plans.views import Views

NEEDLES = ["the", "a", "data"]
RANK_KEYS = ["o_orderpriority", "o_orderstatus"]


@query("text_contains_counts", sql="""
SELECT count(*) AS lines, count(*) FILTER (WHERE contains(text, 'the')) AS has_0,
       count(*) FILTER (WHERE contains(text, 'a')) AS has_1,
       count(*) FILTER (WHERE contains(text, 'data')) AS has_2 FROM documents""")
def text_contains_counts(v: Views):
    return dashboards.contains_counts(v.table("documents").select("text"), "text", NEEDLES)


@query("sql_between", sql="SELECT c_custkey, c_name FROM customer WHERE c_nationkey BETWEEN 13 AND 19")
def sql_between(v: Views):
    return rowops.sql_on(v.table("customer"),
                         "SELECT c_custkey, c_name FROM {df} WHERE c_nationkey BETWEEN 13 AND 19")


@query("predicate_filter", sql="""
SELECT event_id, user_id, event_type FROM events
WHERE event_type != 'view' AND user_id > 8 AND user_id < 10""")
def predicate_filter(v: Views):
    rows = rowops.sql_filter(v.table("events"), "event_type != 'view' and user_id > 8 and user_id < 10")
    return rows.select("event_id", "user_id", "event_type")


@query("count_by_name", sql="SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY 1")
def count_by_name(v: Views):
    return dashboards.count_by(v.table("customer"), "c_mktsegment")


@query("count_by_pair", ["reviews"], """
SELECT overall, CAST(CASE WHEN overall < 4 THEN 0 ELSE 1 END AS DOUBLE) AS label, count(*) AS count
FROM reviews WHERE overall != 3 GROUP BY ALL""")
def count_by_pair(v: Views):
    from airtally.operators.textmodel import label_bucket
    return dashboards.count_by(label_bucket(v.reviews().select("overall")), "overall", "label")


@query("sliding_event_stats", ["ev"], """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type,
       sum(event_amount)::DOUBLE / count(*) AS avg, count(*) AS count, CAST(sum(event_amount) AS BIGINT) AS sum
FROM (SELECT event_type, event_amount, unnest(
        [make_timestamp(((epoch_us(event_ts) // 120000000) - k) * 120000000) for k in [0, 1, 2]
         if epoch_us(event_ts) < ((epoch_us(event_ts) // 120000000) - k) * 120000000 + 300000000])
        AS window_start FROM ev) GROUP BY ALL""")
def sliding_event_stats(v: Views):
    stats = dashboards.sliding_event_stats(v.events())
    return stats.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        "event_type", "avg", "count", "sum")


@query("device_place_stats", ["locations"], """
SELECT device_id, location, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat,
       max(visibility) AS visibility FROM locations GROUP BY ALL""")
def device_place_stats(v: Views):
    return _rounded(dashboards.device_place_stats(v.locations()))


def _rounded(df):
    return df.withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


@query("device_place_tumbling", ["locations"], """
SELECT time_bucket(INTERVAL 10 SECOND, kdts) AS window_start, device_id, location,
       round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat, max(visibility) AS visibility
FROM locations GROUP BY ALL""")
def device_place_tumbling(v: Views):
    stats = _rounded(dashboards.device_place_tumbling(v.locations(), "kdts"))
    return stats.withColumn("window_start", F.col("window.start")).drop("window")


@query("column_summary", sql="""
SELECT count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max
FROM lineitem""")
def column_summary(v: Views):
    summary = dashboards.column_summary(v.table("lineitem"), "l_quantity")
    return summary.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("classification_report", sql="""
WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 0)::DOUBLE / count(*) AS tp,
                  count(*) FILTER (WHERE quality = 0 AND toxic = 1)::DOUBLE / count(*) AS tn,
                  count(*) FILTER (WHERE quality = 0 AND toxic = 0)::DOUBLE / count(*) AS fp,
                  count(*) FILTER (WHERE quality = 1 AND toxic = 1)::DOUBLE / count(*) AS fn FROM labels)
SELECT round(tp, 9) AS true_pos, round(tn, 9) AS true_neg, round(fp, 9) AS false_pos,
       round(fn, 9) AS false_neg, round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall,
       round(tp + tn, 9) AS accuracy,
       round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 9) AS f_measure
FROM c""")
def classification_report(v: Views):
    """Not-toxic taken as the prediction of quality."""
    judged = v.table("labels").withColumn("prediction", 1 - F.col("toxic"))
    report = dashboards.classification_report(judged, "quality", "prediction")
    return report.select([F.round(c, 9).alias(c) for c in report.columns])


@query("dash_total", sql="SELECT count(*) AS total FROM orders")
def dash_total(v: Views):
    return v.table("orders").agg(F.count(F.lit(1)).alias("total"))


@query("dash_by_month", sql="""
SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS bucket, count(*) AS count FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1""")
def dash_by_month(v: Views):
    return dashboards.date_histogram(v.table("orders"), "o_orderdate", "month",
                                     "1996-01-01", "2001-01-01")


@query("dash_by_day", sql="""
SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS bucket, count(*) AS count
FROM orders GROUP BY 1""")
def dash_by_day(v: Views):
    return dashboards.date_histogram(v.table("orders"), "o_orderdate", "day")


@query("dash_filtered_month", sql="""
SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS bucket, count(*) AS count
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def dash_filtered_month(v: Views):
    done = v.table("orders").filter(F.col("o_orderstatus") == "F")
    return dashboards.date_histogram(done, "o_orderdate", "month")


@query("dash_terms_month", sql="""
WITH best AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 5)
SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS bucket, count(*) AS count
FROM orders WHERE o_custkey IN (SELECT o_custkey FROM best) GROUP BY 1, 2""")
def dash_terms_month(v: Views):
    return dashboards.terms_histogram(v.table("orders"), "o_custkey", "o_orderdate", "month", 5)


@query("dash_top_terms", sql="""
SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 7""")
def dash_top_terms(v: Views):
    return dashboards.top_terms(v.table("orders"), "o_custkey", 7)


@query("dash_top_regions", sql="""
SELECT c_nationkey, count(*) AS count FROM customer GROUP BY 1 ORDER BY count(*) DESC, c_nationkey LIMIT 5""")
def dash_top_regions(v: Views):
    return dashboards.top_terms(v.table("customer"), "c_nationkey", 5)


@query("dash_median_by_status", ["enriched"], """
SELECT bucket, club_status, median_stars FROM (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY club_status DESC) AS place FROM (
    SELECT CAST(date_trunc('month', rated_ts) AS TIMESTAMP) AS bucket, club_status,
           CAST(median(stars) AS DOUBLE) AS median_stars FROM enriched GROUP BY 1, 2))
WHERE place <= 3""")
def dash_median_by_status(v: Views):
    return dashboards.median_by_status(enriched(v), "rated_ts", "month", 3)


@query("dash_channel_hist", ["enriched"], """
SELECT bucket, channel, count FROM (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY count DESC, channel) AS place FROM (
    SELECT CAST(date_trunc('month', rated_ts) AS TIMESTAMP) AS bucket, channel, count(*) AS count
    FROM enriched GROUP BY 1, 2))
WHERE place <= 3""")
def dash_channel_hist(v: Views):
    return dashboards.count_by_channel(enriched(v), "rated_ts", "month", 3)


@query("dash_top_people", ["enriched"], """
SELECT full_name, count(*) AS count FROM enriched GROUP BY 1 ORDER BY count(*) DESC, full_name LIMIT 5""")
def dash_top_people(v: Views):
    return dashboards.top_terms(enriched(v), "full_name", 5)


@query("dash_alerts_total", ["unhappy"], "SELECT count(*) AS total FROM unhappy")
def dash_alerts_total(v: Views):
    from airtally.operators.enrich import unhappy_premium
    return unhappy_premium(enriched(v), status="BUILDING").agg(F.count(F.lit(1)).alias("total"))


def _ranked(v: Views):
    priced = v.table("orders").select("o_orderkey", *RANK_KEYS,
                                      F.floor("o_totalprice").cast("bigint").alias("sal"))
    return ranking.ranked(priced, RANK_KEYS, "sal", ["o_orderkey"])


PRICED = ("(SELECT o_orderkey, o_orderpriority, o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) AS sal "
          "FROM orders)")
BY_SAL = "(PARTITION BY o_orderpriority, o_orderstatus ORDER BY sal DESC"


@query("window_ranking", sql=f"""
SELECT o_orderkey, sal, rank() OVER {BY_SAL}) AS rank, dense_rank() OVER {BY_SAL}) AS dense_rank,
       row_number() OVER {BY_SAL}, o_orderkey) AS row_number FROM {PRICED}""")
def window_ranking(v: Views):
    return _ranked(v).select("o_orderkey", "sal", "rank", "dense_rank", "row_number")


@query("window_running", sql=f"""
SELECT o_orderkey, sal, CAST(sum(sal) OVER {BY_SAL}) AS BIGINT) AS running_total FROM {PRICED}""")
def window_running(v: Views):
    return _ranked(v).select("o_orderkey", "sal", "running_total")


@query("window_offsets", sql=f"""
SELECT o_orderkey, sal, lead(sal, 1, 0) OVER {BY_SAL}, o_orderkey) AS next_val,
       lag(sal, 1, 0) OVER {BY_SAL}, o_orderkey) AS prev_val,
       first_value(sal) OVER {BY_SAL}, o_orderkey) AS first_val FROM {PRICED}""")
def window_offsets(v: Views):
    return _ranked(v).select("o_orderkey", "sal", "next_val", "prev_val", "first_val")


@query("window_last_value", sql=f"""
SELECT o_orderkey, sal, last_value(sal) OVER {BY_SAL}, o_orderkey
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS last_val FROM {PRICED}""")
def window_last_value(v: Views):
    return _ranked(v).select("o_orderkey", "sal", "last_val")


@query("sort_top", sql="""
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5""")
def sort_top(v: Views):
    rows = v.table("orders").select("o_orderkey", "o_orderdate")
    return rowops.sort_top(rows, "o_orderdate", 5, ["o_orderkey"])


@query("limit_rows")
def limit_rows(v: Views):
    return rowops.first_rows(v.ratings().filter("stars < 3"), 5)


@query("stratified_sample")
def stratified_sample(v: Views):
    return rowops.stratified_sample(v.table("labels"), "quality", {1: 0.1, 0: 1.0}, 36)


@query("random_split")
def random_split(v: Views):
    """Both parts of the random split together, numbered."""
    parts = rowops.split_rows(v.table("labels"), [0.8, 0.2], 5043)
    return parts[0].withColumn("part", F.lit(0)).unionByName(parts[1].withColumn("part", F.lit(1)))
