"""JSON-lines files: reading, and the day-partitioned sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from brookmart.functions.dates import DAY_NUMBER, epoch_to_millis
from brookmart.functions.jsons import is_json_object
from brookmart.sources.levels import TableGroup
from brookmart.streaming.runner import to_batches

ERROR_BUCKET = "error_bucket"
ROLL_INTERVAL = "10 minutes"
# About 128 MB of log lines; Spark rolls files by row count.
ROLL_RECORDS = 500_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.options(**options).text(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def day_bucket(value: Column, field: str) -> Column:
    """``yyyyMMdd`` from the record's epoch field (seconds or ms); a missing field counts as 0.

    A line that is not a JSON object, or whose field is not a number, goes to ``error_bucket``.
    """
    raw = F.get_json_object(value, f"$.{field}")
    epoch = F.when(raw.isNull(), F.lit(0)).otherwise(raw.try_cast("bigint"))
    day = F.date_format(F.timestamp_millis(epoch_to_millis(epoch)), DAY_NUMBER)
    return F.when(is_json_object(value), F.coalesce(day, F.lit(ERROR_BUCKET))).otherwise(F.lit(ERROR_BUCKET))


def write_by_day(lines: DataFrame, path: str, field: str, column: str = "value") -> None:
    """Batch form: ``day=…`` folders of text files."""
    (lines.select(F.col(column).alias("value"), day_bucket(F.col(column), field).alias("day"))
     .write.mode("append").option("maxRecordsPerFile", ROLL_RECORDS).partitionBy("day").text(path))


def stream_by_day(lines: DataFrame, path: str, checkpoint: str, field: str | None,
                  column: str = "value") -> DataStreamWriter:
    """Streaming form, exactly-once by the file sink's log; without ``field`` there are no folders."""
    value = F.col(column)
    out = lines.select(value.alias("value"), *([day_bucket(value, field).alias("day")] if field else []))
    writer = (out.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
              .option("maxRecordsPerFile", ROLL_RECORDS).trigger(processingTime=ROLL_INTERVAL))
    return writer.partitionBy("day") if field else writer


FILE_BYTES = 128 << 20


class DayFiles:
    """Text files by day that small deliveries write and ``roll`` packs into large ones.

    A batch writes one run of folders ``day=…``; the runs in force stand in a manifest, as in ``brookmart.sources.levels``. Rolling
    deals a day's lines over as many files as its bytes need and marks the new run before the old ones go.
    """

    def __init__(self, spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, roll_every: int = 0) -> None:
        self.spark, self.path, self.file_bytes, self.roll_every = spark, path, file_bytes, roll_every
        self.group = TableGroup(spark, path)

    def _runs(self) -> list[str]:
        return self.group.state()["runs"].get("lines", [])

    def read(self) -> DataFrame:
        runs = self._runs()
        if not runs:
            return self.spark.range(0).select(F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("day"))
        lines = self.spark.read.schema("value string, run string, day string").option("basePath", f"{self.path}/lines")
        return lines.text([f"{self.path}/lines/{r}" for r in runs]).select("value", "day")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Lines with their ``day``; idempotent per id."""
        state = self.group.state()
        if batch_id <= state["marks"].get("stream", -1):
            return
        run = f"run={batch_id}-0"
        batch.select("value", "day").write.mode("overwrite").partitionBy("day").text(f"{self.path}/lines/{run}")
        self.group.replace("lines", [*self._runs(), run], [], {"stream": batch_id})
        if self.roll_every and batch_id % self.roll_every == self.roll_every - 1:
            self.roll()

    def roll(self) -> None:
        """All runs as one. A day's lines go to one file for every ``file_bytes`` begun, by hash, so a long day is written by many tasks."""
        runs = self._runs()
        if len(runs) < 2:
            return
        lines = self.read()
        files = lines.groupBy("day").agg(F.ceil(F.sum(F.octet_length("value") + 1) / self.file_bytes).alias("files"))
        dealt = lines.join(files, "day").withColumn("file", F.pmod(F.xxhash64("value"), F.col("files")))
        run = f"run={runs[-1].split('=')[1].split('-')[0]}-{1 + max(int(r.split('-')[1]) for r in runs)}"
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt.repartition(tasks, "day", "file").select("value", "day").write.mode("overwrite").partitionBy("day").text(f"{self.path}/lines/{run}")
        self.group.replace("lines", [run], runs)

    def start(self, lines: DataFrame, checkpoint: str, field: str, once: bool = False) -> StreamingQuery:
        return to_batches(lines.select("value", day_bucket(F.col("value"), field).alias("day")), self.apply, checkpoint, once)
