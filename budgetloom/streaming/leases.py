"""Heartbeats as data: who still holds a lease, and how long leases lasted.

The scheduler replaces the lease files of a hand-made work queue; what is left
is the same question asked of an event table, in batch and as a stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from budgetloom.session import work_root

STALE = "30 minutes"


def status(events: DataFrame, stale_seconds: int = 1800) -> DataFrame:
    """(user_id, last_ts, last_type, age_seconds, stale): the last beat of each, against the latest of all."""
    latest = events.agg(F.max("ts").alias("now"))
    last = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("e"))
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    age = (at("now") - at("e.ts")) / 1_000_000
    return last.join(F.broadcast(latest)).select("user_id", F.col("e.ts").alias("last_ts"), F.col("e.event_type").alias("last_type"), F.round(age, 3).alias("age_seconds"), (age > stale_seconds).alias("stale"))


def sessions(events: DataFrame, gap: str = STALE) -> DataFrame:
    """(user_id, started, beats): runs of beats with no gap of ``gap`` or more."""
    return events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").cast("long").alias("beats")).select("user_id", F.col("w.start").alias("started"), "beats")


def stream_counts(spark: SparkSession, path: str, schema, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(day, event_type, beats): windowed counts of the event files, read as a stream until all are taken.

    State behind the watermark is dropped; a window's last count is its result.
    The query's checkpoint and its result lie in the shared work folder, so that
    a lost executor or a restart continues where it stopped.
    """
    at = f"{work_root(spark)}/stream-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    folder, _, name = path.rstrip("/").rpartition("/")
    if any(f.endswith("/" + name) for f in spark.read.parquet(path).inputFiles()[:1]):  # the table is one file
        reader, path = reader.option("pathGlobFilter", name), folder
    read = reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = read.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").cast("long").alias("beats"))

    def write(batch: DataFrame, number: int) -> None:
        # what a batch changed, under the batch's number: a batch that is repeated after a failure replaces itself
        batch.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "beats").write.mode("overwrite").parquet(f"{at}/out/batch={number}")

    query = counts.writeStream.outputMode("update").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.parquet(f"{at}/out").groupBy("day", "event_type").agg(F.max_by("beats", "batch").alias("beats"))


def rewrite_new(spark: SparkSession, source: str, schema, rewrite, out: str, checkpoint: str) -> None:
    """Rewrite the source shards that have not been rewritten yet, exactly once each.

    rewrite maps a DataFrame of (doc_id, text, ...) to its output.  Each batch of
    shards is written under its number and replaces what a failed try of it left;
    shards of committed batches are in the checkpoint and are not read again.
    """

    def write(batch: DataFrame, number: int) -> None:
        rewrite(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    read = spark.readStream.schema(schema).parquet(source)
    query = read.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()
    query.awaitTermination()
