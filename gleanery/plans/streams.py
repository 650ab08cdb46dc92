"""Queries that run as streams over files of ``events`` until all is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import streaming
from ..sources.shared import shared_folder
from .registry import query, table


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return streaming.read_table(spark, sf_dir, "events", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(stream, spark, mode: str = "append"):
    """Everything the stream yields, from the sink's files."""
    at = shared_folder(spark, "stream")
    query_ = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{at}/out").option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start()
    query_.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS keys FROM events")
def stream_dedup(spark, sf_dir):
    """STM-02: every event delivered twice comes out once."""
    once = _events(spark, sf_dir).select("event_id", "ts")
    twice = once.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    # A table file is one batch, in no order of time: rows may be as late as the whole table is long.
    span = table(spark, sf_dir, "events").agg(F.ceil((F.unix_timestamp(F.max("ts").cast("timestamp")) - F.unix_timestamp(F.min("ts").cast("timestamp"))) / 3600)).first()[0]
    out = _drain(streaming.dedup(twice, ["event_id"], "ts", f"{(span or 0) + 1} hours"), spark)
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("keys"))


@query("SELECT user_id::VARCHAR AS listing_id, arg_max(event_type, event_id) AS title, max(value) FILTER (event_id = m) AS price_value FROM (SELECT *, max(CASE WHEN value <> 0 THEN event_id END) OVER (PARTITION BY user_id) AS m FROM events) GROUP BY user_id")
def stream_merge(spark, sf_dir):
    """STM-03: batches folded by foreachBatch, as deltas."""
    e = _events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("listing_id"), F.concat(F.lit("/en/ad/"), F.col("user_id").cast("string")).alias("url"),
        F.col("event_type").alias("title"), F.col("value").alias("price_value"), F.col("event_id").alias("seq"),
    )
    at = shared_folder(spark, "stream")
    return streaming.merge_stream(e, f"{at}/listings", f"{at}/log").select("listing_id", "title", "price_value")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    """An extension of ours: tumbling counts. A stream's last windows stay open, so this reads the table whole."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = streaming.windowed_counts(e, "ts", ["event_type"])
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("""
WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM o)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k
""")
def stream_sessions(spark, sf_dir):
    """An extension of ours: session counts, over the whole table."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = streaming.session_counts(e, "ts", ["user_id"])
    return out.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")

