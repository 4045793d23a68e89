"""ST2: daily counts that late rows correct.

A watermark drops what comes after its day was closed. Here every micro-batch enters
its counts into a ledger keyed by (date, batch); a replayed batch replaces its own
entries, so each row counts once however often its batch runs. When the stream's
time passes a day's end by the allowed delay, the day is published: the sum of its
ledger entries. A batch with rows of a published day publishes that day again, so
closed days are corrected, not left wrong, however late the rows are.

    base/ledger/date=<day>/batch=<id>/   (kind, key, n, late)
    base/marks/batch=<id>/               the latest record time up to that batch, in microseconds
    base/counts, base/reports            what is published (as ``daily.write_daily`` writes)

Micro-batches leave one file a day they touch; minutes, not seconds, between triggers
keep these few. All work is on counts: a batch's rows are reduced map-side first.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meeple.functions import events as ev
from meeple.operators import events as evops
from meeple.streaming import daily

DELAY = "1 day"  # how long after its end a day is closed
ENTRIES = "kind string, key string, n long, late boolean, date string, batch long"
MARKS = "latest long, batch long"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def entries(spark: SparkSession, base: str) -> DataFrame:
    """The ledger: (date, batch, kind, key, n, late); ``late`` marks corrections."""
    return _read(spark, f"{base}/ledger", ENTRIES)


def totals(spark: SparkSession, base: str) -> DataFrame:
    """(date, kind, key, n) of all days, open ones included."""
    return entries(spark, base).groupBy("date", "kind", "key").agg(F.sum("n").alias("n"))


def _replace(df: DataFrame, path: str, *parts: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _closed(spark: SparkSession, latest: int | None, delay: str) -> str | None:
    """The last day that is closed when the stream has come to ``latest``."""
    if latest is None:
        return None
    moment = F.timestamp_micros(F.lit(latest).cast("long")) - F.expr(f"INTERVAL {delay}")
    return spark.range(1).select(ev.day_text(moment - F.expr("INTERVAL 1 DAY"))).first()[0]


def apply_batch(rows: DataFrame, batch_id: int, base: str, delay: str = DELAY) -> None:
    """One micro-batch of countable rows (timestamp, kind, key) into ledger and output.

    The steps run in this order and each can run again: entries, mark, days to
    publish. Days come to the driver as a list (those open at the same time).
    """
    spark = rows.sparkSession
    marks = _read(spark, f"{base}/marks", MARKS).filter(F.col("batch") < batch_id)
    before = marks.agg(F.max("latest")).first()[0]
    was_closed = _closed(spark, before, delay)
    day = ev.day_text("timestamp")
    counts = rows.groupBy(day.alias("date"), "kind", "key").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.unix_micros("timestamp")).alias("latest")).persist()
    try:
        latest = counts.agg(F.max("latest")).first()[0]
        if latest is None:
            return
        late = F.lit(False) if was_closed is None else F.col("date") <= was_closed
        _replace(counts.select("kind", "key", "n", late.alias("late"), "date", F.lit(batch_id).cast("long").alias("batch"))
                 .repartition("date"), f"{base}/ledger", "date", "batch")
        latest = latest if before is None else max(before, latest)
        _replace(spark.createDataFrame([(latest, batch_id)], MARKS), f"{base}/marks", "batch")
        is_closed = _closed(spark, latest, delay)
        newly = F.lit(True) if was_closed is None else F.col("date") > was_closed
        days = {r.date for r in counts.select("date").distinct().union(
            entries(spark, base).filter(newly).select("date").distinct()).distinct()
            .filter(F.col("date") <= is_closed).collect()}
    finally:
        counts.unpersist()
    publish(spark, base, days, batch_id)


def publish(spark: SparkSession, base: str, days: set[str] | None = None, batch_id: int = -1) -> None:
    """Write the totals of some days (all, open ones too, if none are named)."""
    if days is None or days:
        found = totals(spark, base)
        if days is not None:
            found = found.filter(F.col("date").isin(sorted(days)))
        daily.write_daily(found, batch_id, f"{base}/counts", f"{base}/reports")


def start(parsed: DataFrame, base: str, checkpoint: str, delay: str = DELAY,
          available_now: bool = True, processing_time: str = "1 minute") -> StreamingQuery:
    """Parsed messages (a stream) into the ledger; ``base`` is a shared folder."""
    w = (evops.countable(parsed).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, batch_id: apply_batch(df, batch_id, base, delay)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
