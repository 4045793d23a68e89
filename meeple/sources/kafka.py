"""Event topic source and sink.

The Kafka connector is a separate package on the cluster's classpath; it is
not needed for anything else here. Without it and a broker, neither ``read_events`` nor
``write_events`` has ever run: only their message shaping and the stream code behind
them are tested, on a file source. Message shaping (key text, JSON value) is
done by ``meeple.operators.events`` so batch and stream share it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The topic and consumer group of the reference deployment.
TOPIC = "user-events"
GROUP = "analytics"


def read_events(spark: SparkSession, servers: str, topic: str = TOPIC,
                starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                group: str = GROUP) -> DataFrame:
    """The topic as a stream of (key, value, timestamp) text records.

    Consumer-group offsets are replaced by the query's checkpoint (ST4):
    ``startingOffsets`` applies only to the first start, and ``group`` only names
    the query's consumers on the broker.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("groupIdPrefix", group)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"),
                           F.col("timestamp"))


def write_events(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """S7 (batch): publish (key, value) messages to the topic."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())
