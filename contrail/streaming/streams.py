"""Structured Streaming re-aims of batch operators (2.P).

P1  keep-first dedupe      -> withWatermark + dropDuplicatesWithinWatermark
P2  daily totals           -> event-time window aggregation (complete mode)
P3  staged upsert          -> foreachBatch writing a new table version per batch

Sources are the ``events`` parquet read as a file stream with an explicit
schema; every query uses ``trigger(availableNow=True)`` so it drains what is
there and stops.  Checkpoints and sinks live under the shared folder named by
``spark.checkpoint.dir`` (a fresh sub-folder per run), so a restarted driver
or a lost executor resumes from the committed offsets.

``ts`` is ``timestamp_ntz`` (wall-clock) in the test data.  Watermarks need
a ``timestamp`` column, so a cast copy ``event_time`` drives them, while
windows, minute buckets and ordering use the wall-clock ``ts`` itself: the
results do not depend on the session time zone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import checkpoint_dir
from contrail.sources.tables import table


def _run_dir(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{tag}-{uuid.uuid4().hex[:12]}"


def event_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # a file stream source watches a directory; the glob filter keeps only
    # the events files (new files landing there are picked up incrementally)
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
         .option("pathGlobFilter", "events*.parquet").parquet(sf_dir.rstrip("/")))
    return s.withColumn("event_time", F.col("ts").cast("timestamp"))


def _drain(df: DataFrame, base: str, mode: str = "append") -> str:
    """Run a streaming DataFrame to a parquet / memory-free sink and wait."""
    out = f"{base}/out"
    if mode == "complete":
        # file sinks only support append; complete-mode results are written
        # per micro-batch as a whole new snapshot of the result table
        def write(batch: DataFrame, epoch: int):
            batch.write.mode("overwrite").parquet(out)
        q = (df.writeStream.outputMode("complete").foreachBatch(write)
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    else:
        q = (df.writeStream.outputMode(mode).format("parquet").option("path", out)
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def p1_dedupe_within_watermark(spark: SparkSession, sf_dir: str, delay: str = "1 hour") -> DataFrame:
    """One event per (user, event type, minute) within the watermark delay."""
    s = event_stream(spark, sf_dir).withColumn(
        "minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    d = (s.withWatermark("event_time", delay)
         .dropDuplicatesWithinWatermark(["user_id", "event_type", "minute"]))
    out = _drain(d.select("user_id", "event_type", "minute"), _run_dir(spark, "p1"))
    return spark.read.parquet(out).select("user_id", "event_type", "minute")


def p2_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event-time windows (wall-clock days) per event type.  Complete
    mode: the whole result table is rewritten each batch, so every window is
    final once the stream is drained and no watermark is needed."""
    s = event_stream(spark, sf_dir)
    agg = (s.groupBy(F.window("ts", "1 day"), "event_type")
           .agg(F.count("*").alias("events"),
                F.sum(F.col("value").cast("decimal(28,2)")).alias("value_sum")))
    out = _drain(agg, _run_dir(spark, "p2"), mode="complete")
    return spark.read.parquet(out).select(F.to_date(F.col("window.start")).alias("day"), "event_type",
                                          "events", F.col("value_sum").cast("double").alias("value_sum"))


def p3_latest_event_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep, per user, the latest event: micro-batch ``e`` merges its rows
    into version ``e`` (latest by ts, then event_id) and writes version
    ``e + 1``.  The version number comes from the batch id, so a retried
    batch rewrites the same version and never the one it reads."""
    base = _run_dir(spark, "p3")
    tbl = f"{base}/table"
    cols = ["user_id", "event_id", "ts", "event_type", "value"]

    def upsert(batch: DataFrame, epoch: int):
        from pyspark.sql import Window
        cur = batch.select(*cols)
        if epoch > 0:
            cur = cur.unionByName(spark.read.parquet(f"{tbl}/v={epoch}").select(*cols))
        w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
        latest = cur.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
        latest.write.mode("overwrite").parquet(f"{tbl}/v={epoch + 1}")

    q = (event_stream(spark, sf_dir).writeStream.foreachBatch(upsert)
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    versions = spark.read.parquet(tbl)
    newest = versions.agg(F.max("v")).first()[0]
    return versions.filter(F.col("v") == newest).select("user_id", "event_id", "ts", "event_type", "value")
