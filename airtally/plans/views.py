"""The pipeline's inputs derived from the test tables, as DataFrames and as SQL.

Every view is a projection of whole tables. Channels, devices and users grow with
the data, so groups keep their size when the tables get bigger.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.operators.schedule import shows_of
from airtally.operators.sessions import device_sessions
from airtally.operators.skew import hot_keys
from airtally.session import written

# Shows of one channel and day come in rows of at most this many (event ids are unique).
SHOWS_PER_ROW = 1000


class Views:
    """Test views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))

    def events(self) -> DataFrame:
        """Events with a zoned time, their channel and an amount in whole cents."""
        return self.table("events").select(
            "event_id", "user_id", "event_type", "value",
            F.col("ts").cast("timestamp").alias("event_ts"),
            channel_of().alias("channel_id"), cents().alias("event_amount"))

    def actions(self) -> DataFrame:
        kind = F.col("event_type")
        code = (F.when(kind == "view", 1).when(kind == "error", 2).when(kind == "click", 3)
                .otherwise(0))
        return self.events().select(
            "event_id", "user_id", F.col("user_id").alias("device_id"), "channel_id",
            code.alias("action"), F.col("event_ts").alias("action_ts"))

    def sessions(self) -> DataFrame:
        return device_sessions(self.actions(), tiebreak=["event_id"])

    def sessions_table(self) -> DataFrame:
        """Sessions computed once; the overlap joins read their inputs twice."""
        return written(self.sessions(), "sessions")

    def shows_table(self) -> DataFrame:
        return written(self.shows(), "shows")

    def channels(self) -> DataFrame:
        """Nested schedules: signup events are the show starts."""
        start = self.events().filter(F.col("event_type") == "signup").select(
            "channel_id", F.date_format("event_ts", "dd-MM-yyyy").alias("day"),
            F.floor(F.col("event_id") / SHOWS_PER_ROW).alias("block"),
            F.struct(F.concat(F.lit("show-"), "event_id").alias("program"),
                     F.col("event_id").alias("program_id"),
                     F.date_format("event_ts", "HH:mm:ss").alias("start")).alias("show"))
        rows = start.groupBy("channel_id", "day", "block").agg(F.collect_list("show").alias("shows"))
        return rows.select(F.concat(F.lit("channel-"), "channel_id").alias("channel"), "channel_id",
                           F.create_map("day", "shows").alias("schedule"))

    def shows(self) -> DataFrame:
        return shows_of(self.channels())

    def ad_starts(self) -> DataFrame:
        return self.events().filter(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("ad_id"), "channel_id", F.col("event_ts").alias("start_ts"),
            F.floor(F.col("value") * 10).cast("int").alias("duration_secs"))

    def users(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
            (18 + F.floor(F.abs("c_acctbal")) % 60).cast("int").alias("age"),
            F.col("c_mktsegment").alias("gender"))

    def locations(self) -> DataFrame:
        return self.events().select(
            F.col("user_id").alias("device_id"),
            F.concat(F.lit("place-"), (F.col("event_id") % 4).cast("string")).alias("location"),
            F.col("event_ts").alias("kdts"), F.col("value").alias("lon"),
            (F.col("value") / 4).alias("lat"), (F.col("event_id") % 10000).alias("visibility"))

    def hot_users(self) -> DataFrame:
        """Users with very many events, counted on the base table, not on a join."""
        return hot_keys(self.table("events"), ["user_id"])

    def typed_events(self) -> DataFrame:
        """Events with a numbered type 0 to 9; every 31st has no number."""
        number = F.when(F.col("event_id") % 31 == 0, F.lit("")) \
            .otherwise((F.col("event_id") * 7 % 10).cast("string"))
        return self.events().select("event_id", "user_id", "event_ts",
                                    F.concat(F.lit("type_"), number).alias("event_type"))

    def envelope(self) -> DataFrame:
        """Events as topic messages with a JSON key; every 97th value is not JSON."""
        body = F.to_json(F.struct("event_id", "user_id", "event_type", "event_amount"))
        broken = F.col("event_id") % 97 == 0
        return self.events().select(
            F.to_json(F.struct(F.col("user_id").alias("id"))).cast("binary").alias("key"),
            F.when(broken, F.lit("not json")).otherwise(body).cast("binary").alias("value"),
            F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"), F.col("event_ts").alias("timestamp"))

    def ratings(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("rating_id"), F.col("o_custkey").alias("user_id"),
            (1 + F.floor("o_totalprice") % 5).cast("int").alias("stars"),
            F.col("o_orderpriority").alias("channel"),
            F.concat(F.lit("status "), "o_orderstatus").alias("message"),
            F.col("o_orderdate").cast("timestamp").alias("rated_ts"))

    def customers(self) -> DataFrame:
        """Customers; every tenth has no first name."""
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_custkey") % 10 != 7, F.substring_index("c_name", "#", 1)).alias("first_name"),
            F.substring_index("c_name", "#", -1).alias("last_name"),
            F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.org")).alias("email"),
            F.col("c_mktsegment").alias("club_status"), F.col("c_nationkey").alias("nation"))

    def customer_changes(self) -> DataFrame:
        """Two versions of every customer; the later one carries the current status."""
        versions = self.customers().withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
        return versions.withColumn(
            "club_status", F.when(F.col("version") == 1, F.lit("none")).otherwise(F.col("club_status")))

    def changes(self) -> DataFrame:
        """Orders as change rows of their customer; every 50th is a delete."""
        gone = F.col("o_orderkey") % 50 == 0
        op = F.when(gone, "d").when(F.col("o_orderkey") % 2 == 0, "u").otherwise("c")
        after = F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"),
                         F.col("o_totalprice").alias("price"))
        return self.table("orders").select(
            F.col("o_custkey").alias("key"), op.alias("op"),
            F.when(~gone, after).alias("after"), F.col("o_orderkey").alias("offset"),
            F.lit("shop.orders").alias("topic"),
            F.col("o_orderdate").cast("timestamp").alias("timestamp"))

    def nested(self) -> DataFrame:
        """Line items as nested sensor records."""
        qty, line = F.col("l_quantity").cast("int"), F.col("l_linenumber")
        part, supp = (F.col("l_partkey") % 100).cast("int"), (F.col("l_suppkey") % 10).cast("int")

        def sensor(number, temps):
            return F.struct(number.alias("id"), F.concat(F.lit("10.0.0."), number).alias("ip"),
                            F.array(*temps).alias("temp"))
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("dc_id"), F.col("l_partkey").alias("part_id"), line.alias("line"),
            (F.unix_millis(F.col("l_shipdate").cast("timestamp"))
             + F.col("l_orderkey") % 86_400_000).alias("event_time"),
            F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 12:01:"),
                     F.lpad((qty % 70).cast("string"), 2, "0"), F.lit(".250")).alias("start_time_str"),
            F.array(qty, line, supp).alias("readings"),
            F.array(F.array(qty, line), F.array(part)).alias("readings_array"),
            F.array(F.struct(qty.alias("s"), line.alias("t")),
                    F.struct(part.alias("s"), supp.alias("t"))).alias("struct_array"),
            F.create_map(F.lit("sensor-igauge"), sensor(part, [qty, line, supp]),
                         F.lit("sensor-ipad"), sensor(supp, [line, part])).alias("source"),
            F.struct((F.col("l_partkey") / 64).alias("lat"), (F.col("l_suppkey") / 8).alias("long")).alias("geo"))

    def iot(self) -> DataFrame:
        """Line items as sensor maps with a nested position."""
        def sensor(number):
            return F.struct(
                F.concat(F.lit("10.0.0."), number).alias("ip"), number.alias("id"),
                (F.col("l_partkey") % 50).alias("temp"), (1000 + F.col("l_suppkey")).alias("c02_level"),
                F.struct((F.col("l_partkey") / 64).alias("lat"),
                         (F.col("l_suppkey") / 8).alias("long")).alias("geo"))
        return self.table("lineitem").select(
            F.concat(F.lit("dc-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("dc_id"),
            F.create_map(F.lit("sensor-igauge"), sensor(F.col("l_suppkey")),
                         F.lit("sensor-ipad"), sensor(F.col("l_partkey"))).alias("source"))

    def reviews(self) -> DataFrame:
        """Labelled documents as reviews rated 1 to 5."""
        rating = F.when(F.col("quality") == 1, 4 + F.col("doc_id") % 2).otherwise(1 + F.col("doc_id") % 3)
        return self.table("documents").join(self.table("labels"), "doc_id").select(
            "doc_id", rating.cast("double").alias("overall"), F.col("source").alias("summary"),
            F.col("text").alias("reviewText"), "quality", "toxic")


def channel_of():
    """Ten users share a channel; each switches between three."""
    return F.floor(F.col("user_id") / 10) + F.col("event_id") % 3


def cents():
    return F.round(F.col("value") * 100).cast("bigint")


# The same views in SQL. A view names the ones it needs.
CHANNEL = "(user_id // 10 + event_id % 3)"

SQL_VIEWS = {
    "ev": f"""SELECT event_id, user_id, event_type, value, ts AS event_ts, {CHANNEL} AS channel_id,
        CAST(round(value * 100) AS BIGINT) AS event_amount FROM events""",
    "actions": """SELECT event_id, user_id, user_id AS device_id, channel_id, event_ts AS action_ts,
        CASE event_type WHEN 'view' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 3 ELSE 0 END AS action
        FROM ev""",
    "sessions": """SELECT user_id, device_id, channel_id, action_ts AS start_ts, next_ts AS end_ts FROM (
        SELECT *, lead(action) OVER w AS next_action, lead(action_ts) OVER w AS next_ts
        FROM actions WHERE action IN (1, 2, 3)
        WINDOW w AS (PARTITION BY user_id, device_id ORDER BY action_ts, event_id))
        WHERE action IN (1, 3) AND next_action IN (2, 3)""",
    "flat": """SELECT event_id AS program_id, 'show-' || event_id AS program, channel_id,
        'channel-' || channel_id AS channel, strftime(event_ts, '%d-%m-%Y') AS day,
        CAST(event_ts AS DATE) AS day_date, date_trunc('second', event_ts) AS start_ts
        FROM ev WHERE event_type = 'signup'""",
    "shows": """SELECT channel_id, channel, program_id, program, day_date, start_ts,
        coalesce(lead(start_ts) OVER (PARTITION BY channel_id, day ORDER BY start_ts, program_id),
                 CAST(day_date + 1 AS TIMESTAMP)) AS end_ts FROM flat""",
    "ads": """SELECT event_id AS ad_id, channel_id, event_ts AS start_ts,
        CAST(floor(value * 10) AS INTEGER) AS duration_secs,
        event_ts + to_seconds(CAST(floor(value * 10) AS INTEGER)) AS end_ts
        FROM ev WHERE event_type = 'purchase'""",
    "users": """SELECT c_custkey AS user_id, c_name AS name,
        CAST(18 + CAST(floor(abs(c_acctbal)) AS BIGINT) % 60 AS INTEGER) AS age,
        c_mktsegment AS gender FROM customer""",
    "locations": """SELECT user_id AS device_id, 'place-' || (event_id % 4) AS location, event_ts AS kdts,
        value AS lon, value / 4 AS lat, event_id % 10000 AS visibility FROM ev""",
    "show_views": """SELECT sh.program_id, sh.program, sh.channel_id, sh.channel, s.user_id, s.device_id,
        greatest(s.start_ts, sh.start_ts) AS start_ts, least(s.end_ts, sh.end_ts) AS end_ts
        FROM sessions s JOIN shows sh ON s.channel_id = sh.channel_id
        AND s.start_ts <= sh.end_ts AND s.end_ts >= sh.start_ts""",
    "ad_views": """SELECT a.ad_id, a.channel_id, s.user_id, s.device_id,
        greatest(s.start_ts, a.start_ts) AS start_ts, least(s.end_ts, a.end_ts) AS end_ts
        FROM ads a JOIN sessions s ON s.channel_id = a.channel_id
        AND s.start_ts <= a.end_ts AND s.end_ts >= a.start_ts""",
    "show_people": """SELECT v.*, u.name, u.age, u.gender FROM show_views v JOIN users u USING (user_id)""",
    "ad_people": """SELECT v.*, u.name, u.age, u.gender FROM ad_views v JOIN users u USING (user_id)""",
    "typed": """SELECT event_id, user_id, event_ts, 'type_' || CASE WHEN event_id % 31 = 0 THEN ''
        ELSE CAST(event_id * 7 % 10 AS VARCHAR) END AS event_type FROM ev""",
    "numbered": """SELECT *, TRY_CAST(substr(event_type, 6) AS INTEGER) AS type_int FROM typed""",
    "ratings": """SELECT o_orderkey AS rating_id, o_custkey AS user_id,
        CAST(1 + CAST(floor(o_totalprice) AS BIGINT) % 5 AS INTEGER) AS stars, o_orderpriority AS channel,
        'status ' || o_orderstatus AS message, o_orderdate AS rated_ts FROM orders""",
    "customers": """SELECT c_custkey AS id,
        CASE WHEN c_custkey % 10 != 7 THEN split_part(c_name, '#', 1) END AS first_name,
        split_part(c_name, '#', 2) AS last_name,
        lower(replace(c_name, '#', '.')) || '@example.org' AS email,
        c_mktsegment AS club_status, c_nationkey AS nation FROM customer""",
    "enriched": """SELECT r.rating_id, r.message, r.stars, r.channel, c.id,
        c.first_name || ' ' || c.last_name AS full_name, c.club_status, c.email, r.rated_ts
        FROM ratings r JOIN customers c ON r.user_id = c.id WHERE c.first_name IS NOT NULL""",
    "unhappy": """SELECT full_name, club_status, email, stars, message FROM enriched
        WHERE stars < 3 AND club_status = 'BUILDING'""",
    "chg": """SELECT o_custkey AS key, CASE WHEN o_orderkey % 50 = 0 THEN 'd'
        WHEN o_orderkey % 2 = 0 THEN 'u' ELSE 'c' END AS op, o_custkey AS id, o_orderstatus AS status,
        o_totalprice AS price, o_orderkey AS msgoffset, o_orderdate AS msgtime FROM orders""",
    "li": """SELECT l_orderkey AS dc_id, l_partkey AS part_id, l_linenumber AS line,
        CAST(l_quantity AS INTEGER) AS qty, CAST(l_partkey % 100 AS INTEGER) AS part,
        CAST(l_suppkey % 10 AS INTEGER) AS supp, l_partkey, l_suppkey, l_shipdate,
        epoch_ms(l_shipdate) + l_orderkey % 86400000 AS event_time,
        strftime(l_shipdate, '%Y-%m-%d') || ' 12:01:'
          || lpad(CAST(CAST(l_quantity AS INTEGER) % 70 AS VARCHAR), 2, '0') || '.250' AS start_time_str
        FROM lineitem""",
    "reviews": """SELECT doc_id, CAST(CASE WHEN quality = 1 THEN 4 + doc_id % 2 ELSE 1 + doc_id % 3 END AS DOUBLE)
        AS overall, source AS summary, text AS reviewText, quality, toxic
        FROM documents JOIN labels USING (doc_id)""",
}

NEEDS = {
    "actions": ["ev"], "sessions": ["actions"], "flat": ["ev"], "shows": ["flat"], "ads": ["ev"],
    "locations": ["ev"], "show_views": ["sessions", "shows"], "ad_views": ["ads", "sessions"],
    "show_people": ["show_views", "users"], "ad_people": ["ad_views", "users"], "typed": ["ev"],
    "numbered": ["typed"], "enriched": ["ratings", "customers"], "unhappy": ["enriched"],
}


def with_views(views: list[str], body: str) -> str:
    """``body`` with the SQL of the views it uses, each after the ones it needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in ordered) + "\n" + body
