"""Jobs that write several outputs or keyed tables per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brookmart import schemas
from brookmart.functions.jsons import mark_objects, parse_once
from brookmart.operators import cdc, logs
from brookmart.plans.dims import dimension_cells
from brookmart.sources.tables import DimensionStore, MetricTable
from brookmart.streaming.first_visits import FirstVisits
from brookmart.streaming.runner import batch_folders, to_batches

Sink = Callable[[DataFrame, int], None]


def config_sync(config_changes: DataFrame, store: DimensionStore, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Routing configuration changes (envelopes) into the store: tables appear and vanish with them."""
    rows = cdc.config_rows(config_changes, "source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
    return to_batches(rows, store.apply_config, checkpoint, once)


def dimension_sync(changes: DataFrame, store: DimensionStore, database: str, checkpoint: str,
                   once: bool = False) -> StreamingQuery:
    """Business changes into dimension tables. Every batch reads the configuration first."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = cdc.route_dimensions(batch, store.config())
        store.apply_cells(dimension_cells(routed), batch_id)

    return to_batches(cdc.valid_changes(changes, database), handle, checkpoint, once)


def route_facts(changes: DataFrame, config: Callable[[], DataFrame], sink: Sink, checkpoint: str,
                once: bool = False) -> StreamingQuery:
    """Facts to the sink table their configuration names (``sink_table``, ``payload``)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        sink(cdc.route_facts(batch, config()), batch_id)

    return to_batches(changes, handle, checkpoint, once)


def routed_folders(path: str) -> Sink:
    """A sink for ``route_facts``: JSON lines in one folder per sink table, replay-safe."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select("sink_table", F.to_json("payload").alias("value"))
         .write.mode("overwrite").partitionBy("sink_table").text(f"{path}/batch={batch_id}"))

    return write


def split_logs(lines: DataFrame, dates: FirstVisits, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Log lines into text folders per batch and feed: err, start, page, display, action and dirty.

    The visitor's flag is repaired on the way by the stored first-visit dates. Lines that are no JSON object are dirty.
    """
    marked = mark_objects(lines.select("value"), mark="good")
    parsed = parse_once(marked, "common struct<mid string, is_new string>, ts bigint", keep=["value", "good"])
    flat = parsed.select("value", "good", F.when(F.col("good"), F.col("common.mid")).alias("mid"), "common.is_new",
                         F.timestamp_millis("ts").alias("et"))
    write = batch_folders(path, ["feed"], "text")

    def feeds(fixed: DataFrame, batch_id: int) -> None:
        clean = parse_once(fixed.where("good"), schemas.LOG, keep=["is_new"])
        clean = clean.withColumn("common", F.col("common").withField("is_new", F.col("is_new"))).drop("is_new")
        dirty = fixed.where("NOT good").select(F.lit("dirty").alias("feed"), "value")
        write(logs.to_feed(logs.tag_feeds(clean), "feed").unionByName(dirty), batch_id)

    return dates.start(flat, checkpoint, ["value"], feeds, once)


def enriched_metrics(sums: DataFrame, enrich: Callable[[DataFrame], DataFrame], table: MetricTable,
                     checkpoint: str, once: bool = False) -> StreamingQuery:
    """Window sums, joined to dimensions read afresh for every micro-batch, into a metric table."""
    return to_batches(sums, lambda batch, batch_id: table.apply(enrich(batch), batch_id), checkpoint, once, in_state=True)
