"""Window sums over rows that come in several versions: each new version takes its predecessor back.

A micro-batch is compared with the stored versions of its keys, read in their buckets; the difference, new rows as they are and
replaced ones negated, goes to a table of sums as it is, from the tasks that compared it; merges and readers add it up, so
that it is exchanged by cell once, when it is read. Both tables become visible by one commit. All of it are joins and
aggregates; no row passes through Python and nothing waits for a watermark, so a version may come years after its
predecessor. Of several versions in one micro-batch the newest counts; the others would cancel out at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from brookmart.operators.versions import newest_per_key
from brookmart.operators.windows import labels, total
from brookmart.plans import metrics
from brookmart.sources.levels import BUCKETS, LevelledTable, TableGroup
from brookmart.streaming.runner import to_batches

LINES = "_lines"
VERSION_ORDER = ["ts", "order_id", "sku_id", "province_id", *metrics.AMOUNTS]


def difference(rows: DataFrame, stored: DataFrame, keys: list[str], order: list[str], amounts: list[str]) -> DataFrame:
    """Rows newer than the stored version of their key, and those stored versions with negated ``amounts``.

    Both frames have at most one row per key and the same columns.
    """
    old = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*rows.columns).alias("_old"))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    age = lambda row: F.struct(*[row[c] if row is not None else F.col(c) for c in order])
    newer = rows.join(old, same, "left").where(F.col("_old").isNull() | (age(None) > age(F.col("_old"))))
    taken_back = F.struct(*[(-F.col("_old")[c]).cast(rows.schema[c].dataType).alias(c) if c in amounts else F.col("_old")[c].alias(c) for c in rows.columns])
    both = F.array(F.struct(*rows.columns), F.when(F.col("_old").isNotNull(), taken_back))
    return newer.select(F.explode(F.array_compact(both)).alias("row")).select("row.*")


class RetractedSums:
    """Sums of ``amounts`` per ``cell`` over the newest versions of rows with the key ``keys``.

    ``measures`` makes rows of a batch. ``stamp`` gives a batch its arrival time instead of the rows' own (``et``); a batch that
    is done again keeps the stamp of its first attempt, so its rows fall into the same windows.
    """

    def __init__(self, spark: SparkSession, path: str, measures: Callable[[DataFrame], DataFrame], empty: DataFrame, keys: list[str], order: list[str],
                 amounts: list[str], cell: dict[str, Column], stamp: Callable[[], int] | None = None, buckets: int = BUCKETS) -> None:
        self.spark, self.measures, self.keys, self.order, self.amounts, self.cell, self.stamp = spark, measures, keys, order, [*amounts, LINES], cell, stamp
        self.group = TableGroup(spark, path)
        rows = self._rows(empty, 0)
        self.versions = LevelledTable(self.group, "versions", rows.schema, keys, order, buckets=buckets)
        wide = lambda f: T.StructField(f.name, T.DecimalType(38, f.dataType.scale) if isinstance(f.dataType, T.DecimalType) else T.LongType())
        cells = rows.select(*[c.alias(n) for n, c in cell.items()]).schema.fields
        self.sums = LevelledTable(self.group, "sums", T.StructType([*cells, *[wide(rows.schema[a]) for a in self.amounts]]), list(cell), sums=self.amounts, buckets=buckets)

    def _rows(self, batch: DataFrame, stamp: int) -> DataFrame:
        rows = self.measures(batch).withColumn(LINES, F.lit(1).cast("bigint"))
        return rows.withColumn("et", F.timestamp_millis(F.lit(stamp))) if self.stamp else rows

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        if self.group.done(batch_id):
            return
        stamp = self.group.note(batch_id, "stamp", self.stamp) if self.stamp else 0
        rows = newest_per_key(self._rows(batch, stamp), self.keys, self.order).select(*self.versions.schema.names).persist()
        try:
            changes = difference(rows, self.versions.read(rows.select(*self.keys)), self.keys, self.order, self.amounts)
            self.sums.stage(changes.select(*[c.alias(n) for n, c in self.cell.items()], *self.amounts), batch_id)
            self.versions.stage(rows, batch_id)
            self.group.commit(batch_id)
        finally:
            self.group.staged = {}
            rows.unpersist()

    def start(self, rows: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return to_batches(rows, self.apply, checkpoint, once)

    def read(self) -> DataFrame:
        """The sums as they stand; cells of which every row was taken back have zero lines."""
        return self.sums.read()


def _window(size: str) -> Column:
    return F.window("et", size)


def sku_sums(spark: SparkSession, path: str, empty: DataFrame, size: str = "10 seconds", stamp: Callable[[], int] | None = None) -> RetractedSums:
    """Amounts per window and sku; ``empty`` is a batch of the order-detail feed without rows."""
    return RetractedSums(spark, path, metrics.order_measures, empty, ["id"], VERSION_ORDER, metrics.AMOUNTS,
                         {"window": _window(size), "sku_id": F.col("sku_id")}, stamp)


def sku_windows(sums: RetractedSums, emptied: bool = False, labelled: bool = True) -> DataFrame:
    """Labelled windows; with ``emptied`` also those of which every line was taken back, as zeros.

    Not ``labelled`` they keep their ``window``, for joins that should not carry the labels.
    """
    rows = sums.read()
    rows = rows if emptied else rows.where(F.col(LINES) > 0)
    return rows.select(*(labels() if labelled else ["window"]), "sku_id", *metrics.AMOUNTS)


def order_sums(spark: SparkSession, path: str, empty: DataFrame, size: str = "10 seconds") -> RetractedSums:
    """Amount per window, province and order, from which orders are counted."""
    return RetractedSums(spark, path, metrics.order_measures, empty, ["id"], VERSION_ORDER, ["order_amount"],
                         {"window": _window(size), "province_id": F.col("province_id"), "order_id": F.col("order_id")})


def province_windows(sums: RetractedSums, emptied: bool = False) -> DataFrame:
    """Orders with a line left, and their amount, per window and province."""
    rows = sums.read().groupBy("window", "province_id").agg(F.count_if(F.col(LINES) > 0).alias("order_count"), total("order_amount"))
    rows = rows if emptied else rows.where(F.col("order_count") > 0)
    return rows.select(*labels(), "province_id", "order_count", "order_amount")
