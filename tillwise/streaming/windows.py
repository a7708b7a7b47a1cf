"""Totals per time window of events that arrive in files, some of them late.

Two jobs over the same stream:

* :func:`closed_windows` keeps state by watermark: it drops repeated events, and gives a window out once,
  when the watermark has passed its end.  Rows that come later than that are not in it.
* :func:`maintain_windows` loses none: every micro-batch adds its partial sums to a store, in a folder of its
  own that a batch which is run again replaces, and :func:`window_totals` merges them.  A late row amends
  its window, and is counted as late if the window was final before its batch arrived.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwise.session import ensure_checkpoint_dir

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
AMOUNT = "decimal(28,4)"
PARTIALS = f"window_start timestamp_ntz, window_end timestamp_ntz, event_type string, n bigint, total {AMOUNT}, latest timestamp_ntz, batch bigint"


def arriving(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """The events of the Parquet files in ``folder``, and of those still to come, a few files at a time."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _sums(events: DataFrame, length: str) -> DataFrame:
    return events.groupBy(F.window("ts", length).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast(AMOUNT).alias("total"),
        F.max("ts").alias("latest")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n", "total", "latest")


def closed_windows(events: DataFrame, length: str, delay: str) -> DataFrame:
    """Windows of a stream that are final, each once (append mode): the watermark follows the latest event
    by ``delay``; an event_id counts once within it; state is kept for open windows only.

    A watermark needs instants, so the times are read in the session's time zone (use one without
    daylight saving)."""
    dated = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    back = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return _sums(dated.dropDuplicatesWithinWatermark(["event_id"]), length).select(
        back("window_start"), back("window_end"), "event_type", "n", "total")


def maintain_windows(events: DataFrame, store: str, length: str) -> StreamingQuery:
    """Add what has arrived to ``store`` and stop; started again it goes on where it ended."""
    root = store.rstrip("/")

    def add(batch: DataFrame, number: int) -> None:
        _sums(batch.where(F.col("ts").isNotNull()), length).write.mode("overwrite").parquet(f"{root}/partials/batch={number}")

    query = (events.writeStream.foreachBatch(add).option("checkpointLocation", f"{root}/progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def window_totals(spark: SparkSession, store: str, delay: str) -> DataFrame:
    """Per window and event type: ``n_events`` and ``total_value`` of all that arrived, ``late_events`` (those
    whose batch came when their window was final), and ``is_final`` (the latest event is ``delay`` past its end).

    Merged from one row per window, type and batch; the window over batches holds one row per batch."""
    partials = spark.read.schema(PARTIALS).parquet(f"{store.rstrip('/')}/partials")
    batches = partials.groupBy("batch").agg(F.max("latest").alias("latest"))
    before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    seen = batches.select(F.col("batch").alias("b"), F.max("latest").over(before).alias("seen"))
    past = F.expr(f"INTERVAL {delay}")
    marked = partials.join(seen, partials.batch == seen.b)
    newest = partials.select(F.max("latest")).scalar()
    return marked.groupBy("window_start", "window_end", "event_type").agg(
        F.sum("n").cast("bigint").alias("n_events"), F.sum("total").cast(AMOUNT).alias("total_value"),
        F.sum(F.when(F.col("seen") - past >= F.col("window_end"), F.col("n")).otherwise(0)).cast("bigint").alias("late_events"),
    ).withColumn("is_final", newest - past >= F.col("window_end"))


def event_windows(spark: SparkSession, sf_dir: str, length: str = "6 hours", delay: str = "2 hours", files: int = 6) -> DataFrame:
    """The ``events`` table dealt into ``files`` files by time, which arrive one by one: totals per window
    of ``length`` and event type, and whether the window is final."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/event-windows-{uuid.uuid4().hex}"
    spark.read.schema(EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet").repartitionByRange(files, "ts").write.parquet(f"{root}/arrived")
    maintain_windows(arriving(spark, f"{root}/arrived"), f"{root}/store", length)
    return window_totals(spark, f"{root}/store", delay).drop("late_events")


SQL = """
WITH w AS (SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, value FROM events WHERE ts IS NOT NULL)
SELECT window_start, window_start + INTERVAL 6 HOURS AS window_end, event_type, COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS total_value,
       (SELECT MAX(ts) FROM events) - INTERVAL 2 HOURS >= window_start + INTERVAL 6 HOURS AS is_final
FROM w GROUP BY window_start, event_type"""
