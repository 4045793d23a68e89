"""Streaming daily counts and reports (S6, S8, ST1-ST7).

One streaming plan replaces the reference's single-threaded consumer loop:
messages -> parse (E7) -> counted kinds (F6) -> 1-day event-time windows with
a watermark (ST1, ST2) -> exactly-once sinks. Offsets and counts live in the
checkpoint (ST4), so a restart neither loses nor double-counts; ``availableNow``
or ``query.stop()`` end a run cleanly (ST5); source errors fail the query (ST7).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meeple.functions import events as ev
from meeple.operators import events as evops

# Day buckets, and the default allowed lateness.
DAY = "1 day"
WATERMARK = "1 day"


def daily_counts_stream(parsed: DataFrame, watermark: str = WATERMARK,
                        time_col: str = "timestamp") -> DataFrame:
    """ST1 + ST2: (date, kind, key, n) per closed UTC day.

    In append mode a day is emitted once, when the watermark passes its end
    (the reference also writes a day when the next one starts); rows older
    than the watermark are dropped. Use the record time for event-time days
    or an arrival-time column for processing-date days.
    """
    c = evops.countable(parsed.withColumn("timestamp", F.col(time_col)))
    return (c.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", DAY).alias("w"), "kind", "key")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(ev.day_text(F.col("w.start")).alias("date"), "kind", "key", "n"))


def running_totals_stream(parsed: DataFrame) -> DataFrame:
    """ST6: running totals per (kind, key), for an update-mode console/memory sink."""
    return evops.countable(parsed).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))


DAY_PARTS = 8  # files that one day's counts are spread over at most


def _replace_days(df: DataFrame):
    """A writer that replaces only the days it writes: a replay rewrites the same
    files. The option is the writer's own, the session is left alone."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date")


def write_reports(batch: DataFrame, batch_id: int, path: str) -> None:
    """S8 + ST3: one JSON document per day in ``path/date=<day>/``."""
    _replace_days(evops.report_json(evops.daily_report(batch))).text(path)


def write_daily(batch: DataFrame, batch_id: int, counts_path: str, reports_path: str) -> None:
    """S8 for one micro-batch: long-form counts (Parquet) and daily documents.

    In append mode a micro-batch holds whole closed days, so replacing the
    partitions of its days makes a replay idempotent. A day's counts are spread
    over several tasks; only its document, one JSON object, is made in one.
    """
    part = F.pmod(F.xxhash64("kind", "key"), F.lit(DAY_PARTS))
    days = batch.repartition("date", part).persist()
    try:
        _replace_days(days).parquet(counts_path)
        write_reports(days, batch_id, reports_path)
    finally:
        days.unpersist()


def start_dead_letter_sink(parsed: DataFrame, path: str, checkpoint: str,
                           available_now: bool = True) -> StreamingQuery:
    """Messages that no count takes, as they came (file sink: exactly-once)."""
    w = (evops.dead_letters(parsed).select("key", "value", "timestamp")
         .writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start(path)


def late_rows(query: StreamingQuery) -> int:
    """Rows behind the watermark that the query dropped, over its reported progress
    (counted after partial aggregation, so several late rows of one day and key in
    one task count once)."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p["stateOperators"])


def flush_open_days(messages: DataFrame, counts_path: str, reports_path: str) -> DataFrame:
    """End of a bounded run: the days that the watermark has not closed yet.

    ``messages`` is the whole input as a batch frame. Days that the stream wrote
    are left as they are; the others are counted and written to the same folders.
    Returns the counts that were added.
    """
    counts = evops.daily_counts(evops.parse_messages(messages))
    written = read_counts(messages.sparkSession, counts_path).select("date").distinct()
    rest = counts.join(written, "date", "left_anti").persist()
    write_daily(rest, -1, counts_path, reports_path)
    return rest


COUNTS = "kind string, key string, n long, date string"


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The written counts; no rows if no day was closed and the folder isn't there."""
    try:
        return spark.read.schema(COUNTS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COUNTS)


def start_daily_sinks(counts: DataFrame, counts_path: str, reports_path: str, checkpoint: str,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """One stateful query feeding both daily outputs through ``foreachBatch``."""
    w = (counts.writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: write_daily(df, bid, counts_path, reports_path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start()


def start_counts_sink(counts: DataFrame, path: str, checkpoint: str,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Long-form daily counts to parquet partitioned by date (file sink: exactly-once)."""
    w = (counts.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("date"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start(path)


def start_report_sink(counts: DataFrame, path: str, checkpoint: str,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Daily JSON documents through ``foreachBatch`` (see ``write_reports``)."""
    w = (counts.writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: write_reports(df, bid, path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start()


# --- sources ----------------------------------------------------------------------

def event_file_stream(spark: SparkSession, folder: str, file_glob: str = "events.parquet",
                      files_per_batch: int | None = None) -> DataFrame:
    """Event rows as a stream from parquet files landing in ``folder``
    (all new files per micro-batch unless ``files_per_batch`` caps it)."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{file_glob}").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


@dataclass
class StreamRun:
    counts: DataFrame
    game_views: DataFrame
    registrations: DataFrame
    reports_path: str


def run_test_stream(spark: SparkSession, sf_dir: str) -> StreamRun:
    """Run the daily-count stream over the test events once (availableNow) and
    read back what the sinks wrote."""
    from meeple.plans import fixtures
    from meeple.session import scratch_path
    base = scratch_path(spark, "daily-stream")
    msgs = fixtures.event_messages(event_file_stream(spark, sf_dir))
    counts = daily_counts_stream(evops.parse_messages(msgs))
    q = start_daily_sinks(counts, f"{base}/counts", f"{base}/reports", f"{base}/_ckpt")
    q.awaitTermination()
    out = read_counts(spark, f"{base}/counts")
    views = out.filter(F.col("kind") == ev.GAME_VIEWED).select(
        F.col("date").cast("string").alias("date"), F.col("key").cast("int").alias("game_id"), "n")
    regs = out.filter(F.col("kind") == ev.USER_CREATED).select(
        F.col("date").cast("string").alias("date"), "n")
    return StreamRun(out, views, regs, f"{base}/reports")
