"""The new-visitor flag on streams, in two steps.

Of a micro-batch, one row per visitor (the earliest, an aggregate with partial sums) decides about the stored first-visit date; the
rows whose flag may change then meet the dates in a join that Spark can split. A visitor with half of all rows is no task of its own,
and no row passes through Python. The dates are a table in hash buckets, read in the buckets of a batch's visitors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from brookmart.functions.dates import DATE
from brookmart.operators.joins import join_key_facts
from brookmart.sources.levels import BUCKETS, LevelledTable, TableGroup
from brookmart.streaming.runner import to_batches


class FirstVisits:
    """First-visit dates by visitor; the first micro-batch that has a visitor fixes the date."""

    def __init__(self, spark: SparkSession, path: str, key: str = "mid", is_new: str = "is_new", ts: str = "et", buckets: int = BUCKETS) -> None:
        self.key, self.is_new, self.ts = key, is_new, ts
        self.group = TableGroup(spark, path)
        schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("first_date", T.StringType())])
        self.dates = LevelledTable(self.group, "dates", schema, [key], buckets=buckets)

    def new_dates(self, batch: DataFrame) -> DataFrame:
        """Dates of the visitors that have none yet: of the earliest row, its day if it says new, else the day before."""
        day = F.when(F.col(self.is_new) == "1", F.date_format(self.ts, DATE)).otherwise(F.date_format(F.col(self.ts) - F.expr("interval 1 day"), DATE))
        firsts = batch.where(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull()).groupBy(self.key).agg(
            F.min(F.struct(F.col(self.ts), (F.col(self.is_new) != "1").alias("old"), day.alias("first_date"))).alias("m"))
        firsts = firsts.select(self.key, "m.first_date")
        return firsts.join(self.dates.read(firsts), self.key, "left_anti")

    def repaired(self, batch: DataFrame, spread_by: list[str]) -> DataFrame:
        """``batch`` with ``is_new`` set to 0 where it says 1 on another day than the visitor's first; dates as staged."""
        asked = batch.withColumn("_asked", F.when((F.col(self.is_new) == "1") & F.col(self.ts).isNotNull(), F.col(self.key)))
        dates = self.dates.read(asked.where("_asked is not null").select(F.col("_asked").alias(self.key))).withColumnRenamed(self.key, "_asked")
        joined = join_key_facts(asked, dates, "_asked", "first_date", spread_by=spread_by)
        stale = F.col("first_date").isNotNull() & (F.col("first_date") != F.date_format(self.ts, DATE))
        return joined.withColumn(self.is_new, F.when(stale, "0").otherwise(F.col(self.is_new))).drop("first_date", "_asked")

    def apply(self, batch: DataFrame, batch_id: int, spread_by: list[str], write: Callable[[DataFrame, int], None]) -> None:
        """Repair a batch and hand it to ``write``, which must be idempotent per id; the dates count once that is done."""
        if self.group.done(batch_id):
            return
        try:
            self.dates.stage(self.new_dates(batch), batch_id)
            write(self.repaired(batch, spread_by), batch_id)
            self.group.commit(batch_id)
        finally:
            self.group.staged = {}

    def start(self, rows: DataFrame, checkpoint: str, spread_by: list[str], write: Callable[[DataFrame, int], None], once: bool = False) -> StreamingQuery:
        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                self.apply(batch, batch_id, spread_by, write)
            finally:
                batch.unpersist()

        return to_batches(rows, handle, checkpoint, once)
