"""Dimension sync: resolving configured changes into dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension_cells(routed: DataFrame) -> DataFrame:
    """Routed changes → the newest write per cell, by (sink_table, row_key, column).

    A put writes its non-empty cells; an empty cell leaves the stored value. A delete writes a row
    marker under the empty column name. One partial aggregate over (time, sequence, value) resolves
    any number of versions, and hot rows are reduced before the shuffle. ``seq`` orders changes of one
    millisecond; where the feed has none, a delete counts as the last of them.
    """
    is_delete = F.col("op") == "d"
    marker = F.array(F.struct(F.lit("").alias("key"), F.lit(None).cast("string").alias("value")))
    puts = F.filter(F.map_entries(F.map_filter("payload", lambda k, _: k != "op")),
                    lambda e: F.coalesce(e["value"], F.lit("")) != "")
    long = routed.select("sink_table", "row_key", "ts_ms", "seq",
                         F.explode(F.when(is_delete, marker).otherwise(puts)).alias("cell"))
    return newest_cells(long.select("sink_table", "row_key", F.col("cell.key").alias("column"), "ts_ms", "seq",
                                    F.col("cell.value").alias("value")))


def newest_cells(cells: DataFrame) -> DataFrame:
    newest = cells.groupBy("sink_table", "row_key", "column").agg(F.max(F.struct("ts_ms", "seq", "value")).alias("m"))
    return newest.select("sink_table", "row_key", "column", "m.*")


def dimension_rows(cells: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension table with ``row_key`` and its columns from newest cells.

    Cells written before the row's last delete are gone, as is a row without later cells.
    """
    mine = cells.where(F.col("sink_table") == sink_table)
    latest = [F.max(F.when(F.col("column") == c, F.struct("ts_ms", "seq", "value"))).alias(c) for c in columns]
    deleted = F.max(F.when(F.col("column") == "", F.struct("ts_ms", "seq"))).alias("_deleted")
    wide = mine.groupBy("row_key").agg(deleted, *latest)

    def alive(c: str):
        newer = F.col("_deleted").isNull() | (F.struct(F.col(c)["ts_ms"].alias("ts_ms"), F.col(c)["seq"].alias("seq")) > F.col("_deleted"))
        return F.when(newer, F.col(c)["value"]).alias(c)

    rows = wide.select("row_key", *[alive(c) for c in columns])
    return rows.where(F.coalesce(*columns).isNotNull())
