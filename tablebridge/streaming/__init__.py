"""Event-time windows over streams of files, and the reading of unbounded endpoints."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def events_stream(spark: SparkSession, path: str, ts: str = "ts", watermark: str = "10 minutes", max_files: int = 64) -> DataFrame:
    """A stream of a Parquet folder or file, with its time column as an instant and a watermark on it."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(at).isDirectory():
        rows = reader.parquet(path)
    else:
        # Streams read folders only; the glob is matched with names of files, not of folders.
        rows = reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)


def tumbling(ts: str, size: str) -> Column:
    return F.window(ts, size)


def sliding(ts: str, size: str, slide: str) -> Column:
    return F.window(ts, size, slide)


def session(ts: str, gap: str) -> Column:
    return F.session_window(ts, gap)


def run_to_end(df: DataFrame, folder: str, mode: str = "complete") -> DataFrame:
    """Everything that is there now, through the stream's own plan, as a DataFrame: for tests and back-fills.

    Results are Parquet files under ``folder``, to which a batch adds or, in complete mode, whose place it takes; nothing
    comes to the driver.
    """
    out = f"{folder}/{uuid.uuid4().hex}"
    if mode == "append":
        run_to_files(df, f"{out}/rows", f"{out}/checkpoint")
        return df.sparkSession.read.schema(df.schema).parquet(f"{out}/rows")
    q = df.writeStream.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{out}/rows")).option("checkpointLocation", f"{out}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/rows")


def run_to_files(df: DataFrame, folder: str, checkpoint: str) -> None:
    """All that is there now, in append mode, to Parquet files: results stay off the driver, and state goes when the
    watermark passes it. Another run with the same checkpoint goes on from there."""
    q = df.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()


def append_days(spark: SparkSession, events: DataFrame, folder: str, ts: str = "ts") -> DataFrame:
    """Counts of whole days of ``events``; the same events come once more when their days are closed, and change nothing."""
    source, out, checkpoint = (f"{folder}/{n}" for n in ("events", "days", "checkpoint"))
    events.write.parquet(source)

    def run() -> None:
        days = events_stream(spark, source, ts, "1 hour").groupBy(tumbling(ts, "1 day").alias("w")).count()
        run_to_files(days.select(F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("count").alias("n")), out, checkpoint)

    run()
    closed = events.agg(F.max(ts).alias("last"))
    late = events.where(F.col(ts) < closed.first()["last"] - dt.timedelta(days=2))
    late.write.mode("append").parquet(source)
    run()
    return spark.read.parquet(out)


def upsert_stream(df: DataFrame, write, checkpoint: str):
    """Each micro-batch through ``write(batch, id)``; a batch that is tried again brings the same id."""
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
