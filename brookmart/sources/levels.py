"""Stored tables in levels, and one commit for all tables that a micro-batch writes.

A micro-batch writes one run per table: rows dealt into hash buckets of their key, each bucket a folder. ``FAN`` runs of one
level become one run of the next, so a row is rewritten a logarithmic number of times, whatever the number of batches. A
reader that knows the keys it wants reads their buckets only.

The runs in force stand in a manifest, one small file per batch, written last. Readers see what the newest manifest names, so
a crash between two tables shows nothing of the batch, and a batch that is replayed after its manifest was
written is not applied again. Batch ids of a group must grow: a query that starts with a new checkpoint needs a new group.
Runs that a merge replaced stay for ``KEEP`` batches, for readers that began earlier.

A table's rows carry the id of the batch that wrote them, which makes the table a source for other jobs: ``changes_since`` gives the
newest version of every key written after a batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart.operators.joins import as_numbers, as_texts
from brookmart.operators.versions import newest_per_key

BUCKETS = 16
FAN = 4
KEEP = 8
CODEC = "zstd"
BATCH = T.StructField("_batch", T.LongType())
BUCKET = T.StructField("_bucket", T.IntegerType())


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


class TableGroup:
    """The tables of one job below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.tables: dict[str, LevelledTable] = {}
        self.staged: dict[str, str] = {}

    def _fs(self):
        paths = self.spark._jvm.org.apache.hadoop.fs.Path
        return paths, paths(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _text(self, path) -> str:
        path_of, fs = self._fs()
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _manifests(self) -> list:
        path_of, fs = self._fs()
        return sorted((f.getPath() for f in fs.globStatus(path_of(f"{self.path}/_commits/*.json")) or []), key=lambda p: p.getName())

    def state(self) -> dict:
        """The newest manifest: batch, runs and schema of each table, replaced runs, and the job's own marks."""
        found = self._manifests()
        return json.loads(self._text(found[-1])) if found else {"batch": -1, "runs": {}, "schemas": {}, "retired": {}, "marks": {}}

    def done(self, batch_id: int) -> bool:
        return batch_id <= self.state()["batch"]

    def note(self, batch_id: int, name: str, value: Callable[[], object]) -> object:
        """``value()`` as it was when this batch asked first, also after a restart: written before it is used."""
        path_of, fs = self._fs()
        path = path_of(f"{self.path}/_notes/{batch_id:020d}-{name}.json")
        if not fs.exists(path):
            self._put(path, json.dumps(value()))
        return json.loads(self._text(path))

    def _put(self, path, text: str) -> None:
        """Complete or not there: written beside its place and renamed."""
        path_of, fs = self._fs()
        beside = path_of(f"{path.toString()}.part")
        out = fs.create(beside, True)
        try:
            out.write(text.encode())
        finally:
            out.close()
        fs.delete(path, False)
        if not fs.rename(beside, path):
            raise OSError(f"could not write {path.toString()}")

    def commit(self, batch_id: int, marks: dict | None = None) -> None:
        """Merge where levels are full, and make everything staged visible at once."""
        state = self.state()
        runs, retired = {**state["runs"]}, dict(state["retired"])
        for name, run in self.staged.items():
            kept, replaced = self.tables[name]._merged([*runs.get(name, []), run])
            runs[name] = kept
            retired |= {f"{name}/{r}": batch_id for r in replaced}
        path_of, fs = self._fs()
        gone = [r for r, since in retired.items() if since <= batch_id - KEEP]
        schemas = state["schemas"] | {n: t.schema.json() for n, t in self.tables.items()}
        self._put(path_of(f"{self.path}/_commits/{batch_id:020d}.json"), json.dumps({
            "batch": batch_id, "runs": runs, "schemas": schemas, "marks": state["marks"] | (marks or {}),
            "retired": {r: b for r, b in retired.items() if r not in gone}}))
        self.staged = {}
        for run in gone:
            fs.delete(path_of(f"{self.path}/{run}"), True)
        for old in self._manifests()[:-KEEP]:
            fs.delete(old, False)


    def replace(self, name: str, runs: list[str], replaced: list[str], marks: dict | None = None) -> None:
        """A commit of its own: ``runs`` of table ``name`` are in force from now on."""
        path_of, fs = self._fs()
        state = self.state()
        number = state["batch"] + 1
        retired = state["retired"] | {f"{name}/{r}": number for r in replaced}
        gone = [r for r, since in retired.items() if since <= number - KEEP]
        self._put(path_of(f"{self.path}/_commits/{number:020d}.json"), json.dumps(state | {
            "batch": number, "runs": state["runs"] | {name: runs}, "marks": state["marks"] | (marks or {}),
            "retired": {r: b for r, b in retired.items() if r not in gone}}))
        for run in gone:
            fs.delete(path_of(f"{self.path}/{run}"), True)
        for old in self._manifests()[:-KEEP]:
            fs.delete(old, False)


class LevelledTable:
    """One table of a group. Of rows with equal ``keys`` the newest by ``order`` wins, or their ``sums`` add up; without keys all rows stay."""

    def __init__(self, group: TableGroup, name: str, schema: T.StructType, keys: list[str] = (), order: list[str] = (), sums: list[str] = (),
                 partition_by: list[str] = (), buckets: int = BUCKETS, fan: int = FAN, bucket_by: list[str] = (),
                 numbers: dict[str, str] | None = None) -> None:
        """``bucket_by``: the keys that lie together in a bucket, all if not given.

        ``numbers``: texts, no keys, that cross the exchange of a read as numbers of these types (``joins.as_numbers``).
        """
        self.numbers = numbers or {}
        self.group, self.name, self.schema = group, name, schema
        self.bucket_by = list(bucket_by or keys)
        self.keys, self.order, self.sums, self.partition_by = list(keys), list(order), list(sums), list(partition_by)
        self.buckets, self.fan = buckets if keys else 0, fan
        group.tables[name] = self

    def bucket(self):
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def _stored(self) -> T.StructType:
        parts = [f for f in self.schema.fields if f.name in self.partition_by]
        plain = [f for f in self.schema.fields if f.name not in self.partition_by]
        return T.StructType([*plain, *([] if self.sums else [BATCH]), *parts, *([BUCKET] if self.buckets else [])])

    def _one_per_key(self, rows: DataFrame) -> DataFrame:
        if self.sums:
            total = rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums])
            return total.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return newest_per_key(rows, self.keys, [*self.order, BATCH.name]) if self.keys else rows

    def _write(self, rows: DataFrame, run: str) -> None:
        by = [*self.partition_by, *([BUCKET.name] if self.buckets else [])]
        if self.buckets:
            rows = rows.withColumn(BUCKET.name, self.bucket())
        # every task writes into all buckets: an exchange by bucket would bring fewer files only
        writer = rows.select(*[f.name for f in self._stored().fields]).write.mode("overwrite").option("compression", CODEC)
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.group.path}/{self.name}/{run}")

    def _scan(self, runs: list[str], buckets: list[int] | None = None) -> DataFrame:
        spark = self.group.spark
        if not runs:
            return no_rows(spark, self._stored())
        rows = spark.read.schema(self._stored()).option("basePath", f"{self.group.path}/{self.name}")
        rows = rows.parquet(*[f"{self.group.path}/{self.name}/{r}" for r in runs]).select(*self._stored().names)
        return rows if buckets is None else rows.where(F.col(BUCKET.name).isin(buckets))

    def runs(self) -> list[str]:
        """Runs in force, with what this batch has staged."""
        own = [self.group.staged[self.name]] if self.name in self.group.staged else []
        return [*self.group.state()["runs"].get(self.name, []), *own]

    def stage(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch, at most one row per key; it is visible to others once the group commits.

        Rows with ``sums`` are written as they come, whatever their keys, without an exchange: merges and readers add them up.
        """
        run = f"run={batch_id}-{batch_id}-0"
        if self.sums:
            self._write(batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]), run)
        else:
            self._write(self._one_per_key(batch.select(*self.schema.names).withColumn(BATCH.name, F.lit(batch_id).cast("bigint"))), run)
        self.group.staged[self.name] = run

    def staged(self) -> DataFrame:
        """What this batch has staged."""
        return self._scan([self.group.staged[self.name]]).select(*self.schema.names)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """A batch of its own, for a group of one table."""
        if not self.group.done(batch_id):
            self.stage(batch, batch_id)
            self.group.commit(batch_id)

    def _merged(self, runs: list[str]) -> tuple[list[str], list[str]]:
        """Runs after merging full levels, and those replaced."""
        replaced = []
        level = lambda r: int(r.split("-")[2])
        while len(runs) >= self.fan and len({level(r) for r in runs[-self.fan:]}) == 1:
            last = runs[-self.fan:]
            runs = [*runs[:-self.fan], self._join(last, level(last[0]) + 1)]
            replaced += last
        return runs, replaced

    def _join(self, runs: list[str], level: int) -> str:
        first, last = runs[0].split("=")[1].split("-")[0], runs[-1].split("-")[1]
        run = f"run={first}-{last}-{level}"
        rows = self._one_per_key(self._scan(runs).drop(BUCKET.name))
        self._write(rows if self.buckets or not self.partition_by else rows.repartition(*self.partition_by), run)
        return run

    def compact(self) -> None:
        """All runs as one, of the level above the highest."""
        state = self.group.state()
        runs = state["runs"].get(self.name, [])
        if len(runs) > 1:
            run = self._join(runs, 1 + max(int(r.split("-")[2]) for r in runs))
            path_of, _ = self.group._fs()
            state["runs"][self.name] = [run]
            state["retired"] |= {f"{self.name}/{r}": state["batch"] for r in runs}
            self.group._put(path_of(f"{self.group.path}/_commits/{state['batch']:020d}.json"), json.dumps(state))

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets of the keys in ``keys`` (columns named as the table's): at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect())

    def _versions(self, keys: DataFrame | None, as_they_travel: Callable[[DataFrame], DataFrame]) -> DataFrame:
        rows = as_they_travel(self._scan(self.runs(), None if keys is None else self.buckets_of(keys)).drop(BUCKET.name))
        if keys is None:
            return rows
        by = [k for k in self.keys if k in keys.columns]
        return rows.join(keys.select(*by).distinct(), by, "left_semi")

    def read(self, keys: DataFrame | None = None) -> DataFrame:
        """Every row in force; with ``keys`` (the columns of ``bucket_by`` at least) only theirs, from their buckets."""
        if not self.numbers:
            return self._one_per_key(self._versions(keys, lambda rows: rows)).select(*self.schema.names)
        rows = self._versions(keys, lambda rows: as_numbers(rows, **self.numbers))
        if set(self.order) & set(self.numbers):  # versions are compared as the texts they are, behind the exchange that brought them to their keys
            return self._one_per_key(as_texts(rows, *self.numbers)).select(*self.schema.names)
        return as_texts(self._one_per_key(rows), *self.numbers).select(*self.schema.names)

    def cells(self, keys: DataFrame, *columns: str) -> DataFrame:
        """``columns`` as any stored version of ``keys`` has them: which one is in force is not asked, so that no other column is read."""
        return self._versions(keys, lambda rows: rows).select(*columns).distinct()

    def changes_since(self, batch_id: int) -> DataFrame:
        """The newest version of every key that a batch after ``batch_id`` wrote. Runs that end before are not read."""
        runs = [r for r in self.runs() if int(r.split("-")[1]) > batch_id]
        rows = self._scan(runs).drop(BUCKET.name).where(F.col(BATCH.name) > batch_id)
        return self._one_per_key(rows).select(*self.schema.names)
