"""Starting queries: checkpoints, triggers, and job templates."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from brookmart.session import fresh_dir, lean_batches, state_partitions
from brookmart.sources.levels import CODEC

# Exactly-once progress every five seconds.
INTERVAL = "5 seconds"


def _triggered(writer: DataStreamWriter, once: bool, interval: str) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)


def to_files(df: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = INTERVAL,
             partition_by: list[str] = ()) -> StreamingQuery:
    """Append to a parquet folder; the file sink's log makes a replayed batch count once."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint).option("compression", CODEC))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with state_partitions(df.sparkSession), lean_batches(df.sparkSession):
        return _triggered(writer, once, interval).start()


def to_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False,
               interval: str = INTERVAL, mode: str = "append", in_state: bool = False) -> StreamingQuery:
    """Hand every micro-batch to ``handle(batch, batch_id)``, which must be idempotent per id.

    ``in_state``: the frame itself keeps state, whose partitions are then as few as the cores need.
    """
    writer = df.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    with ExitStack() as settings:
        settings.enter_context(lean_batches(df.sparkSession))
        if in_state:
            settings.enter_context(state_partitions(df.sparkSession))
        return _triggered(writer, once, interval).start()


def batch_folders(path: str, partition_by: list[str] = (), form: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A sink with one folder per batch id, which a replayed batch overwrites."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").format(form)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{path}/batch={batch_id}")

    return write


def to_console(df: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    writer = df.writeStream.format("console").outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer, once, INTERVAL).start()


def drain(df: DataFrame, name: str = "out") -> DataFrame:
    """Run a streaming frame over what its source holds now and return the written result."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    to_files(df, f"{path}/data", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/data")


# A state that joins holds the rows of a micro-batch beside those that its bound keeps.
SLICE_ROWS = 4_000_000
MOST_SLICES = 32  # of one delivery


def _arrivals(feed: DataFrame, order: str, parts: int, closing: DataFrame | dict[str, Column] | None, name: str, cuts: list | None,
              slice_rows: int | None = None) -> Iterator[tuple[DataFrame, int, int]]:
    """The stream over what has come after every step, with the number of the step within its delivery and how many steps that has."""
    spark = feed.sparkSession
    path = fresh_dir(spark, name)
    slices = 1
    with lean_batches(spark):
        if cuts is None and slice_rows:
            fine = [i / (parts * MOST_SLICES) for i in range(1, parts * MOST_SLICES)]
            rows, found = feed.agg(F.count(F.lit(1)), F.percentile_approx(order, fine)).first()
            while slices < MOST_SLICES and rows > slice_rows * slices * parts:
                slices *= 2
            cuts = found and found[MOST_SLICES // slices - 1::MOST_SLICES // slices]
        elif cuts is None:
            cuts = feed.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)])).first()[0] if parts > 1 else []
        part = sum([(F.col(order) > c).cast("int") for c in cuts or []], F.lit(0))
        files = spark._jvm.org.apache.hadoop.fs.Path
        fs = files(path).getFileSystem(spark._jsc.hadoopConfiguration())
        writer = feed.withColumn("_part", part).where("_part is not null").write.partitionBy("_part").option("compression", CODEC)
        # all parts side by side, without sorting by them
        writer.option("maxConcurrentOutputFileWriters", max(16, parts * slices)).parquet(f"{path}-parts")
    fs.mkdirs(files(path))
    for i in range(len(cuts or []) + 1):
        written = files(f"{path}-parts/_part={i}")
        if not fs.exists(written):
            feed.where("false").write.parquet(f"{path}/part={i}")
        elif not fs.rename(written, files(f"{path}/part={i}")):
            raise OSError(f"could not deliver part {i} of {path}")
        yield spark.readStream.schema(feed.schema).parquet(f"{path}/*"), i % slices, slices
    if closing is not None:
        last = closing if isinstance(closing, DataFrame) else feed.limit(1).withColumns(closing)
        last.select(feed.columns).write.parquet(f"{path}/part={len(cuts or []) + 1}")
        yield spark.readStream.schema(feed.schema).parquet(f"{path}/*"), 0, 1


def deliveries(feed: DataFrame, order: str, parts: int = 2, closing: DataFrame | dict[str, Column] | None = None,
               name: str = "feed", cuts: list | None = None) -> Iterator[DataFrame]:
    """``feed`` as it would arrive: each step delivers the next of ``parts`` time-ordered parts (or those up to each of ``cuts``)
    and gives the stream over all delivered so far, for a query that starts again from its checkpoint. All parts are written in one
    pass, so that a feed that is a join is joined once.

    ``closing`` (rows, or new values for one row of the feed) comes last and pushes the watermark past
    every open window.
    """
    for stream, _, _ in _arrivals(feed, order, parts, closing, name, cuts):
        yield stream


def replay(feed: DataFrame, build: Callable[[DataFrame], DataFrame], order: str, name: str = "out", parts: int = 2,
           closing: DataFrame | dict[str, Column] | None = None, write: Callable[[DataFrame, str], None] | None = None,
           slice_rows: int | None = None) -> DataFrame:
    """The whole result of a stream over ``deliveries``; state and watermark come from the checkpoint every time.

    With ``slice_rows`` a delivery of more rows arrives in time-ordered slices of about so many while the query runs, each a micro-batch
    of its own: between them the watermark moves on and the state forgets, so that it never holds a whole delivery.
    """
    spark = feed.sparkSession
    path = fresh_dir(spark, name)
    out = query = None
    try:
        for stream, step, steps in _arrivals(feed, order, parts, closing, f"{name}-feed", None, slice_rows):
            if step == 0:
                out = build(stream)
                if write:
                    write(out, f"{path}/checkpoint")
                    continue
                query = to_files(out, f"{path}/data", f"{path}/checkpoint", once=steps == 1, interval="0 seconds")
            if steps == 1:
                query.awaitTermination()
            else:
                query.processAllAvailable()
            if step == steps - 1:
                query.stop()
    finally:
        if query:
            query.stop()
    return spark.read.schema(out.schema).parquet(f"{path}/data") if not write else None


@dataclass
class StreamJob:
    """A named job: ``build(source)`` gives the streaming frame, ``sink(batch, id)`` stores a micro-batch."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    sink: Callable[[DataFrame, int], None]
    interval: str = INTERVAL
    queries: list[StreamingQuery] = field(default_factory=list)

    def start(self, spark: SparkSession, source: DataFrame, root: str, once: bool = False) -> StreamingQuery:
        query = to_batches(self.build(source), self.sink, f"{root}/{self.name}/checkpoint", once, self.interval)
        self.queries.append(query)
        return query
