"""Change-data envelopes: parsing, filtering, projection, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart import schemas
from brookmart.functions.jsons import parse_once

CHANGE_OPS = ("c", "u", "d", "r")


def parse_envelopes(lines: DataFrame, column: str = "value", tables: list[str] = (), seq: str | None = None) -> DataFrame:
    """JSON lines → envelope columns, each line parsed once.

    With ``tables`` only lines that mention one of the names are parsed at all, and only changes of
    those tables come out. ``seq`` names the column that orders lines (topic offset, log position),
    which comes out under that name.
    """
    keep = [F.col(seq).alias("seq")] if seq else []
    if not tables:
        return parse_once(lines, schemas.ENVELOPE, column, keep)
    mentioned = F.col(column).rlike("|".join(f'"{t}"' for t in tables))
    return parse_once(lines.where(mentioned), schemas.ENVELOPE, column, keep).where(F.col("source")["table"].isin(*tables))


def valid_changes(db: DataFrame, database: str) -> DataFrame:
    """Changes of one database that carry data.

    Deletes have no ``after``; they count when ``before`` has cells, so that they reach the sinks.
    """
    carried = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return db.where((F.col("source")["db"] == database)
                    & F.col("op").isin(*CHANGE_OPS)
                    & (F.coalesce(F.size(carried), F.lit(0)) > 0))


def current_cells() -> Column:
    """``before`` for deletes, else ``after``."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def cells(*fields: str, of: str = "after", **renamed: str) -> list[Column]:
    """Map entries as columns; keywords rename: ``cells('id', code='payment_type')``."""
    out = [F.col(of)[f].alias(f) for f in fields]
    return out + [F.col(of)[f].alias(name) for name, f in renamed.items()]


def changes_of(db: DataFrame, table: str, *ops: str) -> DataFrame:
    """The changes of one table, optionally of some ops only."""
    kept = db.where(F.col("source")["table"] == table)
    return kept.where(F.col("op").isin(*ops)) if ops else kept


def transition(db: DataFrame, table: str, field: str, to: str, before: str | None = None,
               ops: tuple[str, ...] = ("u",)) -> DataFrame:
    """Rows whose ``field`` became ``to`` — from ``before`` if given, else from any known value."""
    old = F.col("before")[field]
    was = old == before if before is not None else old.isNotNull()
    return changes_of(db, table, *ops).where(was & (F.col("after")[field] == to))


def keep_cells(row: Column, columns: Column) -> Column:
    """Only the cells named in the comma list; a null list keeps all."""
    listed = F.split(columns, ",")
    return F.when(columns.isNull(), row).otherwise(
        F.map_filter(row, lambda k, _: F.array_contains(listed, k)))


def config_rows(config_changes: DataFrame, *fields: str) -> DataFrame:
    """Configuration envelopes → flat rows with their ``op`` and ``ts_ms``."""
    cell = current_cells()
    return config_changes.select(*[cell[f].alias(f) for f in fields], "op", "ts_ms")


def live_config(rows: DataFrame, *keys: str) -> DataFrame:
    """The newest row per key, without keys whose newest change is a delete."""
    newest = rows.groupBy(*keys).agg(F.max(F.struct("ts_ms", F.struct(*rows.columns).alias("row"))).alias("m"))
    return newest.select("m.row.*").where(F.col("op") != "d")


def route_dimensions(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Join dimension changes to their routing row and prune the payload.

    → sink_table, sink_family, row_key, op, ts_ms, seq, payload (map of the configured cells plus
    ``op``). Changes of tables without a routing row drop out. ``seq`` is the changes' own or 0.
    """
    routes = config.select("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
    joined = changes.join(routes, changes["source"]["table"] == routes["source_table"])
    row = current_cells()
    return joined.select(
        "sink_table", "sink_family",
        row[F.col("sink_row_key")].alias("row_key"), "op", "ts_ms",
        (F.col("seq") if "seq" in changes.columns else F.lit(0)).cast("bigint").alias("seq"),
        F.map_concat(keep_cells(row, F.col("sink_columns")), F.create_map(F.lit("op"), F.col("op"))).alias("payload"))


SOURCE_TYPE_OPS = {"insert": ("c", "r"), "update": ("u",), "delete": ("d",)}


def route_facts(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Join fact changes to their routing row by table and change type.

    → sink_table, payload (map of the configured cells plus ``ts_ms``).
    """
    kind = F.create_map(*[F.lit(x) for t, ops in SOURCE_TYPE_OPS.items() for op in ops for x in (op, t)])
    typed = changes.withColumn("source_kind", kind[F.col("op")])
    routes = config.select("source_table", "source_type", "sink_table", "sink_columns")
    joined = typed.join(routes, (typed["source"]["table"] == routes["source_table"])
                        & (typed["source_kind"] == routes["source_type"]))
    stamp = F.create_map(F.lit("ts_ms"), F.col("ts_ms").cast("string"))
    return joined.select("sink_table",
                         F.map_concat(keep_cells(current_cells(), F.col("sink_columns")), stamp).alias("payload"))


def cart_increases(db: DataFrame) -> DataFrame:
    """Cart inserts, and updates whose quantity grew (as the increase)."""
    new = F.col("after")["sku_num"]
    old = F.col("before")["sku_num"]
    inserted = F.col("op").isin("c", "r")
    grew = (F.col("op") == "u") & old.isNotNull() & (new.try_cast("int") > old.try_cast("int"))
    amount = F.when(inserted, new).otherwise((new.try_cast("int") - old.try_cast("int")).cast("string"))
    return (changes_of(db, "cart_info").where(inserted | grew)
            .select(*cells("id", "user_id", "sku_id"), amount.alias("sku_num"), F.col("ts_ms").alias("ts")))
