"""Kafka topics as DataFrames of JSON text.

Needs the Spark Kafka connector on the class path. Everything downstream only sees a ``value``
column, so files of JSON lines (``brookmart.sources.files``) stand in for topics in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from brookmart.functions.jsons import parse_once

RELIABLE = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def topic_options(servers: str, topic: str, group: str | None = None, offsets: str = "earliest",
                  discovery_ms: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """``fail_on_data_loss=False`` goes on where offsets have expired, and so skips records."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offsets,
               "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group:
        options["kafka.group.id"] = group
    if discovery_ms is not None:
        options["kafka.metadata.max.age.ms"] = str(discovery_ms)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """A streaming ``value STRING`` column (null values stay null) with the broker's ``timestamp``."""
    raw = spark.readStream.format("kafka").options(**topic_options(servers, topic, **kwargs)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "timestamp")


def json_table(lines: DataFrame, schema: T.StructType, view: str | None = None, event_ms: str | None = None,
               delay: str | None = None) -> DataFrame:
    """A JSON topic as a typed table with processing time and, if named, event time and watermark."""
    table = parse_once(lines, schema).withColumn("proc_time", F.current_timestamp())
    if event_ms:
        table = table.withColumn("et", F.timestamp_millis(event_ms))
        if delay and table.isStreaming:
            table = table.withWatermark("et", delay)
    if view:
        table.createOrReplaceTempView(view)
    return table


def as_records(df: DataFrame, keys: list[str] = (), topic: Column | None = None) -> DataFrame:
    """Rows as topic records: JSON ``value``, JSON ``key`` of the key columns, optional ``topic``."""
    value = F.col("value") if df.columns == ["value"] else F.to_json(F.struct("*"))
    columns = [value.alias("value")]
    if keys:
        columns.insert(0, F.to_json(F.struct(*keys)).alias("key"))
    if topic is not None:
        columns.append(topic.alias("topic"))
    return df.select(*columns)


def write_topic(df: DataFrame, servers: str, topic: str | None, checkpoint: str, keys: list[str] = (),
                topic_column: str | None = None) -> DataStreamWriter:
    """At-least-once writer; with ``keys`` the records are upserts, with ``topic_column`` each row picks its topic.

    A routed row keeps its other columns only. Readers of upserts take the newest record per key,
    which also absorbs replays.
    """
    if topic_column:
        rows = as_records_routed(df, topic_column, keys)
    else:
        rows = as_records(df, keys)
    writer = (rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .options(**RELIABLE).option("checkpointLocation", checkpoint))
    return writer if topic_column else writer.option("topic", topic)


def as_records_routed(df: DataFrame, topic_column: str, keys: list[str] = ()) -> DataFrame:
    payload = [c for c in df.columns if c != topic_column]
    value = F.to_json(F.col("payload")) if payload == ["payload"] else F.to_json(F.struct(*payload))
    columns = [value.alias("value"), F.col(topic_column).alias("topic")]
    if keys:
        columns.insert(0, F.to_json(F.struct(*keys)).alias("key"))
    return df.select(*columns)


def send_batch(df: DataFrame, servers: str, topic: str, keys: list[str] = ()) -> None:
    (as_records(df, keys).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .options(**RELIABLE).option("topic", topic).save())
