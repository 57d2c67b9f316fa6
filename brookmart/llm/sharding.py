"""Sharding by fixed virtual slots: records hash into slots, a versioned map sends slots to shards.

Only DataFrame functions touch rows. The driver sees one size per slot, a bounded number however large the input, and edits
the map: the first version places the largest slots first on the emptiest shard, later versions move as few slots as needed.

Law: ``bytes``, the shards' sizes are near equal (a record larger than a shard's share cannot be split). A slot that holds more
than a ``CROWDED``-th of a shard's share, as many repeated rows do, is dealt over ``PARTS`` further slots of its own; there are fewer
than ``CROWDED`` x shards of them, so the map stays bounded.
Places inside a shard count up from 0: slots follow each other, and rows are numbered within a slot only.

Defined results: a null text has no bytes (size 1, checksum 0) and any null id is hashed as such; rows that are equal in id
and text share a slot unless it is crowded, and are then dealt by their place in the input; extra columns take no part.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brookmart.llm.common import stored
from brookmart.session import fresh_dir

SLOTS = 8192
CROWDED = 16
PARTS = 64


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The id and the text decide, so that rows without an id spread too."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(slots)).cast("int")


def dealt() -> Column:
    """A part by the row's place in the input. Fixed once it is written."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")


def crowded_slots(sizes: dict[int, int], shards: int) -> list[int]:
    """The slots with more than a ``CROWDED``-th of a shard's share of the bytes: fewer than ``CROWDED`` x ``shards``."""
    total = sum(sizes.values())
    return sorted(slot for slot, size in sizes.items() if size * shards * CROWDED > total)


def parted(vslot: Column, part: Column, crowded: list[int], slots: int = SLOTS) -> Column:
    """The slot itself, or one of the ``PARTS`` further slots of a crowded one."""
    if not crowded:
        return vslot
    nth = F.array_position(F.array(*map(F.lit, crowded)), vslot).cast("int")
    return F.when(nth == 0, vslot).otherwise(slots + (nth - 1) * PARTS + part)


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Id, bytes, checksum, virtual slot and part of each record; no text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       virtual_slot(F.col("doc_id"), text, slots).alias("vslot"), dealt().alias("part"))


def place(sizes: dict[int, int], shards: int, slots: int = SLOTS, current: list[int] | None = None) -> list[int]:
    """Shard of each slot. With ``current`` only slots above an equal share move, to the emptiest shards."""
    load = [0] * shards
    pool = list(range(slots))
    where = [-1] * slots
    if current is not None:
        where, pool = list(current), []
        held: list[list[int]] = [[] for _ in range(max(shards, max(current) + 1))]
        for slot, shard in enumerate(current):
            held[shard].append(slot)
        share = sum(sizes.values()) / shards
        for shard, own in enumerate(held):
            total = sum(sizes.get(s, 0) for s in own)
            for slot in sorted(own, key=lambda s: -sizes.get(s, 0)):
                size = sizes.get(slot, 0)
                if shard >= shards or (size and total - size >= share):
                    pool.append(slot)
                    total -= size
            if shard < shards:
                load[shard] = total
    heap = [(total, shard) for shard, total in enumerate(load)]
    heapq.heapify(heap)
    for slot in sorted(pool, key=lambda s: (-sizes.get(s, 0), s)):
        total, shard = heapq.heappop(heap)
        where[slot] = shard
        heapq.heappush(heap, (total + sizes.get(slot, 0), shard))
    return where


class SlotMap:
    """Versions of the slot-to-shard map below ``root``; a version is never changed once written."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, version: int, shards: list[int], first: list[int]) -> None:
        cell = lambda values, kind: F.element_at(
            F.split(F.lit(",".join(map(str, values))), ","), F.col("id").cast("int") + 1).cast(kind)
        rows = self.spark.range(0, len(shards), 1, 1).select(
            F.col("id").cast("int").alias("vslot"), cell(shards, "int").alias("shard"), cell(first, "long").alias("first"))
        rows.write.parquet(f"{self.root}/version={version}")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema("vslot int, shard int, first long").parquet(f"{self.root}/version={version}")


def slot_sizes(records: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Bytes and rows per slot: one row per slot reaches the driver, with the parts of crowded slots."""
    rows = records.groupBy("vslot").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    return {r.vslot: r["size"] for r in rows}, {r.vslot: r.n for r in rows}


def starts(where: list[int], counts: dict[int, int]) -> list[int]:
    """Place of each slot's first row within its shard."""
    seen: dict[int, int] = {}
    first = []
    for slot, shard in enumerate(where):
        first.append(seen.get(shard, 0))
        seen[shard] = first[-1] + counts.get(slot, 0)
    return first


def assign(docs: DataFrame, shards: int = 8, slots: int = SLOTS, root: str | None = None) -> DataFrame:
    """Shard and place of every record: doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot."""
    spark = docs.sparkSession
    records = stored(sized(docs, slots), "shard-records")
    sizes, counts = slot_sizes(records)
    crowded = crowded_slots(sizes, shards)
    if crowded:
        records = records.withColumn("vslot", parted(F.col("vslot"), F.col("part"), crowded, slots))
        sizes, counts = slot_sizes(records)
    where = place(sizes, shards, slots + PARTS * len(crowded))
    maps = SlotMap(spark, root or fresh_dir(spark, "slot-map"))
    maps.write(1, where, starts(where, counts))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (records.withColumn("nth", F.row_number().over(inside) - 1)
            .join(F.broadcast(maps.read(1)), "vslot")  # a bounded number of slots, whatever the input
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "vslot"))


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, slots: int = SLOTS, crowded: list[int] = ()) -> None:
    """The whole rows, one folder per shard; rows of the slots that the map has ``crowded`` are dealt over their parts."""
    vslot = virtual_slot(F.col("doc_id"), F.coalesce("text", F.lit("")), slots)
    (docs.withColumn("vslot", vslot).withColumn("vslot", parted(F.col("vslot"), dealt(), list(crowded), slots))
     .join(F.broadcast(slot_map.select("vslot", "shard")), "vslot").drop("vslot").write.partitionBy("shard").parquet(path))
