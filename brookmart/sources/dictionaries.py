"""A dictionary that changes while streams read it: its versions with the time they hold.

The source is read again once the last reading is older than ``max_age_ms``; codes that are new, gone or named otherwise get a
version from then on. ``at`` gives the dictionary of a moment, so a batch that is done again sees the names of its first attempt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart.sources.levels import LevelledTable, TableGroup

HOUR_MS = 3_600_000


class DictionaryVersions:
    """``load`` gives rows (dic_code, info with dic_name); ``info`` is null in a version from which a code is gone."""

    def __init__(self, spark: SparkSession, path: str, load: Callable[[], DataFrame], max_age_ms: int = HOUR_MS) -> None:
        self.load, self.max_age_ms = load, max_age_ms
        self.group = TableGroup(spark, path)
        self.schema = load().select("dic_code", "info").schema
        versions = T.StructType([*self.schema.fields, T.StructField("valid_from", T.LongType())])
        self.table = LevelledTable(self.group, "versions", versions, ["dic_code", "valid_from"], buckets=1)

    def intervals(self) -> DataFrame:
        """dic_code, info, valid_from, valid_to (null: still)."""
        later = F.lead("valid_from").over(Window.partitionBy("dic_code").orderBy("valid_from"))
        return self.table.read().withColumn("valid_to", later)

    def refresh(self, now_ms: int) -> None:
        """Read the source again if its last reading is too old for ``now_ms``."""
        state = self.group.state()
        last = state["marks"].get("loaded")
        if last is not None and now_ms - last < self.max_age_ms:
            return
        held = self.intervals().where("valid_to is null and info is not null").select("dic_code", F.col("info").alias("old"))
        both = self.load().select("dic_code", "info").join(held, "dic_code", "full_outer").where(~F.col("info").eqNullSafe(F.col("old")))
        self.table.stage(both.select("dic_code", "info", F.lit(now_ms).cast("bigint").alias("valid_from")), state["batch"] + 1)
        self.group.commit(state["batch"] + 1, {"loaded": now_ms})

    def at(self, ms: int) -> DataFrame:
        """The dictionary as it was at ``ms``, read again first if that is due."""
        self.refresh(ms)
        return self.intervals().where((F.col("valid_from") <= ms) & (F.col("valid_to").isNull() | (F.col("valid_to") > ms)) & F.col("info").isNotNull()).select("dic_code", "info")

    def join(self, rows: DataFrame, code: str, ms: str, name: str, how: str = "left") -> DataFrame:
        """Add the name that ``code`` had at each row's own time ``ms``."""
        side = self.intervals().where("info is not null").select(
            F.col("dic_code").alias("_code"), F.col("info.dic_name").alias(name), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
        held = (F.col(code) == F.col("_code")) & (F.col(ms) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(ms) < F.col("_to")))
        return rows.join(side, held, how).drop("_code", "_from", "_to")
