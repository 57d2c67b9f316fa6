"""Stored tables that micro-batches write into: by primary key, window metrics, and dimensions.

All are tables in levels (``brookmart.sources.levels``): a batch is visible as a whole, a replayed batch counts once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart import schemas
from brookmart.operators.cdc import live_config
from brookmart.plans.dims import dimension_rows
from brookmart.sources.levels import BUCKETS, FAN, LevelledTable, TableGroup


class UpsertTable(LevelledTable):
    """Rows with a primary key, a table by itself; the newest by ``order`` (which must break ties) wins."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str],
                 partition_by: list[str] = (), buckets: int = BUCKETS, fan: int = FAN) -> None:
        super().__init__(TableGroup(spark, path), "rows", schema, keys, order, (), partition_by, buckets, fan)

    def apply_next(self, batch: DataFrame) -> None:
        """A batch that no stream numbers."""
        self.apply(batch, self.group.state()["batch"] + 1)


class MetricTable:
    """Window results, by batch and day (``cur_date``). ``schema`` is needed to read while nothing is stored."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, fan: int = FAN) -> None:
        self.spark, self.path, self.fan, self.schema = spark, path, fan, schema
        self.group = TableGroup(spark, path)

    def _table(self) -> LevelledTable:
        if self.schema is None:
            known = self.group.state()["schemas"].get("rows")
            if known is None:
                raise ValueError(f"nothing is stored at {self.path} and no schema was given")
            self.schema = T.StructType.fromJson(json.loads(known))
        return LevelledTable(self.group, "rows", self.schema, partition_by=["cur_date"], fan=self.fan)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        self.schema = self.schema or batch.schema
        self._spread(batch, lambda df: self._table().apply(df, batch_id))

    def apply_json(self, batch: DataFrame, batch_id: int, hidden: tuple[str, ...] = ()) -> None:
        """JSON-lines form without the ``hidden`` columns."""
        self._spread(batch.drop(*hidden), lambda df: df.write.mode("overwrite").partitionBy("cur_date").json(f"{self.path}/batch={batch_id}"))

    def _spread(self, batch: DataFrame, save) -> None:
        """Write about as many files as shuffle partitions, or one per day if there are more days.

        A batch of one day is still written by all tasks: each day is spread over its share of them.
        """
        batch.persist()
        try:
            tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # of a stream: its own number
            days = batch.select("cur_date").distinct().count()
            spread = F.pmod(F.xxhash64(*batch.columns), F.lit(max(1, tasks // max(1, days))))
            save(batch.repartition(tasks, "cur_date", spread))
        finally:
            batch.unpersist()

    def read(self) -> DataFrame:
        return self._table().read()

    def compact(self) -> None:
        self._table().compact()


LAST = 2**63 - 1
_CELL = T.StructType([T.StructField(n, T.StringType()) for n in ("sink_table", "row_key", "column")]
                     + [T.StructField("ts_ms", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())])
_CONFIG = T.StructType(schemas.DIM_CONFIG.fields + [T.StructField("ts_ms", T.LongType())])


class DimensionStore:
    """All dimension tables of a namespace, with the routing configuration that defines them.

    Configuration changes: ``c`` and ``r`` create a table, ``d`` drops it, ``u`` drops and creates
    it anew. Cells written before a table's last drop are out of sight.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        def cells(name: str) -> UpsertTable:
            return UpsertTable(spark, f"{path}/{name}", _CELL, ["sink_table", "row_key", "column"], ["ts_ms", "seq", "value"], ["sink_table"])

        def config(name: str) -> UpsertTable:
            return UpsertTable(spark, f"{path}/{name}", _CONFIG, ["source_table", "ts_ms"], ["op", "sink_table"], buckets=1)

        self.spark = spark
        # Streams number their batches; commands are numbered as they come, in tables of their own.
        self.cells, self.cell_commands = cells("cells"), cells("cell_commands")
        self.changes, self.config_commands = config("config"), config("config_commands")

    def apply_config(self, rows: DataFrame, batch_id: int) -> None:
        self.changes.apply(rows, batch_id)

    def _config_changes(self) -> DataFrame:
        return self.changes.read().unionByName(self.config_commands.read())

    def config(self) -> DataFrame:
        """The routing rows in force."""
        return live_config(self._config_changes(), "source_table")

    def tables(self) -> list[str]:
        """Names of the live tables: as many as configuration rows."""
        return sorted(r[0] for r in self.config().select("sink_table").distinct().collect())

    def apply_cells(self, cells: DataFrame, batch_id: int) -> None:
        self.cells.apply(cells, batch_id)

    def read(self, sink_table: str) -> DataFrame:
        """One dimension table: ``row_key`` and its configured columns."""
        row = self.config().where(F.col("sink_table") == sink_table).select("sink_columns").first()
        if row is None:
            raise ValueError(f"no dimension table {sink_table}")
        dropped = (self._config_changes().where((F.col("sink_table") == sink_table) & F.col("op").isin("u", "d"))
                   .agg(F.max("ts_ms")).first()[0])
        cells = self.cells.read().unionByName(self.cell_commands.read()).where(F.col("sink_table") == sink_table)
        if dropped is not None:
            cells = cells.where(F.col("ts_ms") >= dropped)
        return dimension_rows(cells, sink_table, row[0].split(","))

    def scan(self, sink_table: str, limit: int) -> DataFrame:
        return self.read(sink_table).limit(limit)

    def count(self, sink_table: str) -> int:
        return self.read(sink_table).count()

    def delete_rows(self, sink_table: str, row_keys: DataFrame, ts_ms: int) -> None:
        """Delete the rows whose keys are in the first column of ``row_keys``."""
        marks = row_keys.select(F.lit(sink_table).alias("sink_table"), F.col(row_keys.columns[0]).alias("row_key"),
                                F.lit("").alias("column"), F.lit(ts_ms).cast("bigint").alias("ts_ms"),
                                F.lit(LAST).alias("seq"), F.lit(None).cast("string").alias("value"))
        self.cell_commands.apply_next(marks)

    def drop_all(self, ts_ms: int) -> None:
        """Drop every table."""
        gone = self.config().withColumns({"op": F.lit("d"), "ts_ms": F.lit(ts_ms).cast("bigint")})
        self.config_commands.apply_next(gone)
