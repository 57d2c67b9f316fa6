"""Application logs: dirty-record split, fan-out into feeds, page predicates and measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart import schemas
from brookmart.functions.jsons import mark_objects, parse_once


def split_dirty(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(lines that are one JSON object, the other lines). Where both go to one place, ``mark_objects`` reads the lines once."""
    marked = mark_objects(lines, column, "_good")
    return marked.where("_good").drop("_good"), marked.where("NOT _good").drop("_good")


def parse_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    return parse_once(lines, schemas.LOG, column)


def split_feeds(logs: DataFrame, action_ts: bool = False) -> dict[str, DataFrame]:
    """Fan parsed logs out into ``err``, ``start``, ``page``, ``display`` and ``action``.

    An error record goes to ``err`` whole and continues, without ``err``, as start or page record.
    Page records lose non-empty ``displays`` / ``actions``, which become rows of their own. Action
    rows carry no ``ts`` unless ``action_ts``.
    """
    clean = logs.drop("err")
    pages = clean.where(F.col("start").isNull()).drop("start")

    def unless_filled(name: str) -> Column:
        return F.when(F.size(name) > 0, None).otherwise(F.col(name)).alias(name)

    def fan_out(array: str, item: str, *rest: str) -> DataFrame:
        return pages.select("common", "page", F.explode(array).alias(item), *rest)

    return {
        "err": logs.where(F.col("err").isNotNull()),
        "start": clean.where(F.col("start").isNotNull()),
        "page": pages.select("common", "page", unless_filled("displays"), unless_filled("actions"), "ts"),
        "display": fan_out("displays", "display", "ts"),
        "action": fan_out("actions", "action", *(["ts"] if action_ts else [])),
    }


def tag_feeds(logs: DataFrame, action_ts: bool = False) -> DataFrame:
    """All feeds in one pass: the rows of ``split_feeds`` with their name in ``feed``.

    One generator per record instead of one scan per feed, for sinks that route by a column.
    """
    types = {f.name: f.dataType for f in logs.schema}
    types |= {"display": types["displays"].elementType, "action": types["actions"].elementType}
    no_start = F.col("start").isNull()

    def record(feed: str, **fields: Column) -> Column:
        cells = [fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()]
        return F.struct(F.lit(feed).alias("feed"), *cells)

    def own(*names: str) -> dict[str, Column]:
        return {n: F.col(n) for n in names}

    def unless_filled(name: str) -> Column:
        return F.when(F.size(name) > 0, None).otherwise(F.col(name))

    start = record("start", **own("common", "page", "start", "displays", "actions", "ts"))
    page = record("page", **own("common", "page", "ts"), displays=unless_filled("displays"),
                  actions=unless_filled("actions"))
    action_fields = own("common", "page", *(["ts"] if action_ts else []))
    parts = [
        F.when(F.col("err").isNotNull(), F.array(record("err", **own(*logs.columns)))),
        F.array(F.when(no_start, page).otherwise(start)),
        F.when(no_start, F.transform("displays", lambda d: record("display", **own("common", "page", "ts"), display=d))),
        F.when(no_start, F.transform("actions", lambda a: record("action", **action_fields, action=a))),
    ]
    return logs.select(F.explode(F.flatten(F.array_compact(F.array(*parts)))).alias("r")).select("r.*")


def to_feed(df: DataFrame, *keep: str) -> DataFrame:
    """Rows as JSON text in a ``value`` column after the columns to ``keep``; null fields are left out."""
    return df.select(*keep, F.to_json(F.struct(*[c for c in df.columns if c not in keep])).alias("value"))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """The page feed's nested fields as flat columns, with event time ``et``."""
    return pages.select("common.mid", "common.uid", "common.vc", "common.ch", "common.ar", "common.is_new",
                        "page.page_id", "page.last_page_id", "page.item", "page.item_type",
                        "page.during_time", "ts", F.timestamp_millis("ts").alias("et"))


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def home_or_detail() -> Column:
    return F.col("page_id").isin("home", "good_detail")


def login_visit() -> Column:
    """A logged-in page that follows the login page or starts a session."""
    return ~_blank("uid") & (_blank("last_page_id") | (F.col("last_page_id") == "login"))


def keyword_search() -> Column:
    return ((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & F.col("item").isNotNull())


def session_start() -> Column:
    """1 for a page without a previous page."""
    return F.when(_blank("last_page_id"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
