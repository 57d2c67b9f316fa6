"""Every registered query: (spark, sf_dir) → DataFrame. Money leaves as double, labels as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart import bindings as b
from brookmart import schemas
from brookmart.functions import dates, jsons, keys, numbers, text
from brookmart.operators import cdc, joins, keywords, logs, segmentation, visits, windows
from brookmart.plans import dims, facts, metrics, reports
from brookmart.session import fresh_dir, prepare, sort_in_memory
from brookmart.sources.dictionaries import HOUR_MS, DictionaryVersions
from brookmart.sources.files import DayFiles, day_bucket, stream_by_day
from brookmart.sources.tables import DimensionStore, MetricTable, UpsertTable
from brookmart.streaming import jobs, keyed, pipelines, retraction, state
from brookmart.streaming.first_visits import FirstVisits
from brookmart.streaming.runner import SLICE_ROWS, batch_folders, deliveries, replay, to_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register ``fn(spark, read)`` under its name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, b.batch_reader(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def stream_query(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register ``fn(spark, stream, read)``: it streams whole tables to the end and reads the result back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, b.stream_reader(spark, sf_dir), b.batch_reader(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else f.name
                       for f in df.schema])


# --- logs -----------------------------------------------------------------------------------------

@query
def dirty_split(spark, read):
    marked = jsons.mark_objects(b.damaged_lines(read))
    k = F.get_json_object(F.when(F.col("is_object"), F.col("value")), "$.k").cast("int")
    return marked.select("event_id", "event_type", k.alias("k"), F.col("is_object").cast("int").alias("valid"))


def _feed_rows(tagged: DataFrame) -> DataFrame:
    """What identifies a feed row, for comparison."""
    def items(name: str):
        return F.coalesce(F.size(name), F.lit(-1)).cast("string")

    page = F.concat_ws("/", "page.page_id", items("displays"), items("actions"))
    detail = (F.when(F.col("feed") == "err", F.col("err")["code"]).when(F.col("feed") == "start", F.col("start")["entry"])
              .when(F.col("feed") == "page", page).when(F.col("feed") == "display", F.col("display")["item"])
              .otherwise(F.col("action")["action_id"]))
    return tagged.select("feed", "common.mid", "common.is_new", "ts", detail.alias("detail"))


@query
def log_split(spark, read):
    lines = b.log_lines(read)
    flat = logs.parse_logs(lines).select("*", "common.mid", "common.is_new", F.timestamp_millis("ts").alias("et"))
    # the visits need three fields only
    brief = jsons.parse_once(lines, "common struct<mid string, is_new string>, ts bigint")
    firsts = visits.first_visits(brief.select("common.mid", "common.is_new", F.timestamp_millis("ts").alias("et")))
    fixed = visits.repair_is_new(flat, spread_by=["mid", "ts"], visits=firsts)
    fixed = fixed.withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
    return _feed_rows(logs.tag_feeds(fixed.drop("mid", "is_new", "et")))


@query
def log_explode(spark, read):
    feeds = logs.split_feeds(logs.parse_logs(b.log_lines(read)))
    return (feeds["display"].groupBy("page.page_id").agg(F.count(F.lit(1)).alias("displays"),
                                                         F.count_distinct(F.col("display")["item"]).alias("items")))


@query
def isnew_repair(spark, read):
    fixed = visits.repair_is_new(b.page_views(read).select("event_id", "mid", "is_new", "et"), spread_by=["event_id"])
    return fixed.select("event_id", "mid", "is_new")


@query
def first_of_day(spark, read):
    firsts = visits.first_of_day(b.page_views(read), ["mid"])
    return firsts.select("mid", "visit_date", F.unix_micros("et").alias("first_us"))


# --- change data ----------------------------------------------------------------------------------

@query
def cdc_project(spark, read):
    lines = b.order_changes(read).select(F.to_json(F.struct("*")).alias("value"))
    db = cdc.valid_changes(cdc.parse_envelopes(lines), "shop")
    return cdc.changes_of(db, "order_info").select(
        *cdc.cells("id", "user_id", "province_id", status="order_status"),
        F.col("before")["order_status"].alias("old_status"), "op", "ts_ms")


@query
def cdc_transition(spark, read):
    db = b.order_changes(read)
    moves = {"cancelled": cdc.transition(db, "order_info", "order_status", "1003", before="1001"),
             "refund_asked": cdc.transition(db, "order_info", "order_status", "1005"),
             "refunded": cdc.transition(db, "order_info", "order_status", "1006")}
    out = None
    for name, df in moves.items():
        part = df.select(F.lit(name).alias("move"), *cdc.cells("id", "operate_time"), "ts_ms")
        out = part if out is None else out.unionByName(part)
    return out


@query
def cart_delta(spark, read):
    return facts.cart_add(b.cart_changes(read))


@query
def config_prune_dim(spark, read):
    routed = cdc.route_dimensions(cdc.valid_changes(b.dimension_changes(read), "shop"), b.dimension_config(spark))
    return routed.select("sink_table", "row_key", "op", "ts_ms", F.to_json("payload").alias("payload"))


@query
def config_prune_fact(spark, read):
    routed = cdc.route_facts(b.order_changes(read), b.fact_config(spark))
    return routed.select("sink_table", F.to_json("payload").alias("payload"))


@query
def dim_upsert(spark, read):
    routed = cdc.route_dimensions(cdc.valid_changes(b.dimension_changes(read), "shop"), b.dimension_config(spark))
    cells = dims.dimension_cells(routed)
    return dims.dimension_rows(cells, "dim_user_info", ["id", "name", "segment"])


# --- facts ----------------------------------------------------------------------------------------

@query
def order_detail_fact(spark, read):
    sort_in_memory(spark)
    return facts.order_detail(b.order_detail_db(read))


@query
def cancel_fact(spark, read):
    return facts.order_cancel(b.order_changes(read), b.order_details(read))


@query
def pay_interval_join(spark, read):
    return facts.payment_success(b.payment_changes(read), b.paid_details(read), b.dictionary(spark))


@query
def refund_fact(spark, read):
    return facts.order_refund(b.refund_db(read), b.dictionary(spark))


@query
def refund_pay_fact(spark, read):
    return facts.refund_payment_success(b.refund_db(read), b.dictionary(spark))


@query
def comment_dic_left(spark, read):
    return facts.comment_info(b.comment_changes(read), b.dictionary(spark))


@query
def sensitive_flag(spark, read):
    tokens = keywords.explode_words(read("documents").select("doc_id", "text"), "text", "word")
    # one row per document and word: a frequent word is counted before the join
    counted = tokens.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    listed = keywords.explode_words(read("benchmark").select("text"), "text", "word")
    flagged = joins.flag_members(counted, listed, "word", flag="listed")
    return flagged.groupBy("doc_id").agg(
        F.sum("n").alias("words"), F.sum(F.when(F.col("listed"), F.col("n")).otherwise(0)).alias("listed_words"))


@query
def word_list_split(spark, read):
    """Membership as filter: words of the conversations by whether they are in the word list."""
    tokens = keywords.explode_words(read("conversations").select("role", "text"), "text", "word")
    counted = tokens.groupBy("role", "word").agg(F.count(F.lit(1)).alias("n"))
    listed = keywords.explode_words(read("benchmark").select("text"), "text", "word").distinct()
    kept = joins.members_only(counted, listed, "word").withColumn("listed", F.lit(1))
    dropped = joins.non_members(counted, listed, "word").withColumn("listed", F.lit(0))
    return kept.unionByName(dropped)


# --- windowed metrics -----------------------------------------------------------------------------

@query
def traffic_4key_10s(spark, read):
    return metrics.traffic_window(b.page_views(read))


@query
def home_detail_uv_3s(spark, read):
    return metrics.home_detail_window(b.page_views(read))


@query
def user_back_3h(spark, read):
    return metrics.login_window(b.page_views(read))


@query
def cart_uu_5s(spark, read):
    return metrics.cart_window(b.cart_adds(read))


@query
def keyword_10s(spark, read):
    return metrics.keyword_window(b.search_pages(read))


@query
def keyword_lattice(spark, read):
    """Words of all documents with their spaces taken away, cut by the cheapest path and into every listed word."""
    docs = read("documents").select("text")
    lattice = segmentation.trained(docs, "text")
    glued = docs.select(F.regexp_replace("text", "[ \t]", "").alias("text"))
    modes = [F.struct(F.lit(m).alias("mode"), segmentation.segmenter(lattice, m == "smart")("run").alias("words")) for m in ("smart", "fine")]
    cut = segmentation.counted_runs(glued, "text").select("times", F.inline(F.array(*modes)))
    return cut.select("times", "mode", F.explode("words").alias("word")).groupBy("mode", "word").agg(F.sum("times").alias("n"))


@query
def keyword_sql(spark, read):
    """The keyword window in SQL, with the word splitter as a temporary table function."""
    keywords.register_word_function(spark)
    b.search_pages(read).createOrReplaceTempView("search_page")
    return spark.sql("""
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
               date_format(window.start, 'yyyy-MM-dd') AS cur_date, keyword, count(*) AS keyword_count
        FROM (SELECT window(et, '10 seconds') AS window, w.word AS keyword
              FROM search_page, LATERAL split_words(item) AS w
              WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL)
        GROUP BY window, keyword""")


@query
def retract_dedup(spark, read):
    return plain(metrics.newest_details(b.order_details(read)).drop("et"))


@query
def sku_order_10s(spark, read):
    sums = metrics.sku_window(b.order_details(read))
    return plain(metrics.with_sku_dimensions(sums, b.sku_dimensions(read)))


def _province(read) -> DataFrame:
    return metrics.with_province_name(metrics.province_window(b.order_details(read)), b.provinces(read))


@query
def province_order_10s(spark, read):
    return plain(_province(read))


@query
def missing_dimension_rows(spark, read):
    sums = metrics.sku_window(b.order_details(read))
    named = metrics.with_sku_dimensions(sums, b.sku_dimensions(read))
    return metrics.missing_names(named, "sku_name", "trademark_name", "category3_name", "category1_name")


# --- reports --------------------------------------------------------------------------------------

@query
def gmv_day(spark, read):
    return plain(reports.gmv(_province(read)))


@query
def province_gmv_day(spark, read):
    return plain(reports.province_gmv(_province(read)))


@query
def channel_uv_topn(spark, read):
    return reports.channel_visitors(metrics.traffic_window(b.page_views(read)), limit=3)


@query
def chart_payload(spark, read):
    return reports.province_payload(reports.province_gmv(_province(read)))


@query
def channel_payload(spark, read):
    return reports.channel_payload(reports.channel_visitors(metrics.traffic_window(b.page_views(read)), limit=3))


# --- scalar functions -----------------------------------------------------------------------------

@query
def hash_bucket(spark, read):
    hot = list(keys.HOT_ADDRESS_BUCKETS)
    address = F.when(F.col("o_custkey") % 10 == 0,
                     F.upper(F.element_at(F.array(*map(F.lit, hot)), (F.col("o_custkey") % 7 + 1).cast("int")))
                     ).otherwise(F.concat(F.lit("0x"), b.text("o_custkey")))
    return read("orders").select("o_orderkey", keys.hash_bucket(F.col("o_custkey"), 100).alias("bucket"),
                                 keys.hash_bucket_with_overrides(address).alias("address_bucket"))


@query
def rowkey(spark, read):
    return read("orders").select(
        "o_orderkey", keys.row_key("o_custkey", "o_orderstatus", separator="_").alias("plain_key"),
        keys.row_key(keys.KeyPart("o_custkey", md5=True), "o_orderpriority", separator="|").alias("part_key"),
        keys.row_key("o_orderkey", "o_custkey", separator="-", md5=True).alias("hashed_key"))


@query
def hex_decimal(spark, read):
    n = F.col("o_orderkey") * 1000003 + 1
    # columns of their own, so that Spark computes each once however often it is used
    given = read("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("0x"), F.lower(F.hex(n)))).alias("digits"),
        F.concat(F.lit("0x"), F.lower(F.hex(F.col("o_custkey") + 1)), F.lpad(F.lower(F.hex(n)), 15, "0")).alias("many"),
        F.when(F.col("o_orderkey") % 2 == 0, "0x" + "f" * 64).otherwise(
            F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(n)), 64, "0"))).alias("word"),
        F.concat(n.cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "E+3").otherwise("e-3")).alias("power"),
        (F.col("o_orderkey").cast("decimal(20,0)") * F.lit(10**15).cast("decimal(16,0)")).cast("string").alias("wei"))
    return given.select(
        "o_orderkey", numbers.hex_to_decimal_text(F.col("digits")).alias("narrow"),
        numbers.hex_to_decimal_text(F.col("many")).alias("wide"),
        numbers.hex_to_decimal_text(F.col("word")).alias("word"),
        numbers.hex_to_decimal_text(F.col("power")).alias("power"),
        numbers.hex_to_decimal_text(F.col("wei"), to_ether=True).alias("ether"))


@query
def hex_words(spark, read):
    def word(c):
        return F.lpad(F.lower(F.hex(c)), 64, "0")

    data = (F.when(F.col("l_linenumber") == 1, F.lit(""))
            .when(F.col("l_linenumber") == 2, F.concat(F.lit("0x"), word("l_orderkey")))
            .otherwise(F.concat(F.lit("0x"), word("l_orderkey"), word("l_partkey"))))
    given = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", data.alias("data"))
    return given.withColumn("words", F.array_join(numbers.hex_words(F.col("data")), ",")).drop("data")


@query
def json_list_append(spark, read):
    old = F.when(F.col("p_size") % 3 == 0, None).otherwise(F.to_json(F.array("p_brand", "p_type")))
    return read("part").select("p_partkey", jsons.append_to_json_list(old, F.col("p_name")).alias("list"))


@query
def string_kit(spark, read):
    blank = F.when(F.col("p_size") % 4 == 0, None).when(F.col("p_size") % 4 == 1, "").when(
        F.col("p_size") % 4 == 2, "  ").otherwise(F.col("p_name"))
    items = F.array("p_name", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")), "p_type")
    return read("part").select(
        "p_partkey", text.to_csv_text(items).alias("csv"), text.join_list(items, "|").alias("joined"),
        text.capitalise_first(F.col("p_name")).alias("capital"), text.lowercase_first(F.col("p_type")).alias("lowered"),
        text.zeros((F.col("p_size") % 5).cast("int")).alias("zeros"),
        text.is_empty(blank).cast("int").alias("empty"), text.is_blank(blank).cast("int").alias("blank"))


@query
def charset_check(spark, read):
    words = read("documents").select("doc_id", F.explode(F.split("text", r"[ \n]+")).alias("w"))
    counted = words.groupBy("doc_id", text.only_allowed_characters(F.col("w")).alias("ok")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("doc_id", F.col("ok").cast("int").alias("ok"), "n")


@query
def day_range(spark, read):
    first = F.to_date("o_orderdate")
    last = F.date_add(first, (F.col("o_orderkey") % 6 - 1).cast("int"))
    return read("orders").select("o_orderkey", dates.day_number(first).alias("day"),
                                 F.array_join(dates.day_numbers(first, last).cast("array<string>"), ",").alias("days"))


@query
def epoch_pick(spark, read):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    block = F.when(F.col("event_id") % 3 == 0, seconds - 86400)
    batch = F.array(F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("window_start_time")))
    return read("events").select(
        "event_id", F.date_format(dates.pick_event_time(block, seconds), dates.DATETIME).alias("event_time"),
        F.date_format(dates.pick_window_start(batch), dates.DATETIME).alias("window_start"))


@query
def date_labels(spark, read):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    label = dates.millis_to_datetime(ms)
    return read("events").select(
        "event_id", dates.millis_to_date(ms).alias("day"), label.alias("second"),
        dates.millis_to_day_number(ms).alias("partition"), dates.datetime_to_millis(label).alias("second_ms"),
        dates.date_to_millis(dates.millis_to_date(ms)).alias("day_ms"),
        dates.text_millis_to_datetime(ms.cast("string")).alias("from_text"))


def _stamped_lines(read) -> DataFrame:
    lines = b.damaged_lines(read)
    stamp = F.when(F.col("event_id") % 2 == 0, F.col("ms")).otherwise(F.floor(F.col("ms") / 1000))
    field = F.when(F.col("event_id") % 11 == 0, F.lit('"later"')).otherwise(stamp.cast("string"))
    return lines.select(F.regexp_replace("value", r"^\{", F.concat(F.lit('{"at": '), field, F.lit(", "))).alias("value"))


@query
def file_partition_day(spark, read):
    return _stamped_lines(read).groupBy(day_bucket(F.col("value"), "at").alias("bucket")).agg(F.count(F.lit(1)).alias("lines"))


# --- streams --------------------------------------------------------------------------------------

FAR_MS = 7258118400000  # 2200: closes every window of the given tables


def _far():
    return F.timestamp_millis(F.lit(FAR_MS))


def _last_page():
    return {"mid": F.lit("closing"), "uid": F.lit("closing"), "page_id": F.lit("home"), "last_page_id": F.lit(None).cast("string"),
            "is_new": F.lit("0"), "et": _far(), "ts": F.lit(FAR_MS)}


def _into_table(spark, feed: DataFrame, build, order: str, closing, name: str) -> MetricTable:
    """Replay a metric stream into a stored table."""
    table = MetricTable(spark, fresh_dir(spark, name))

    def write(sums: DataFrame, checkpoint: str) -> None:
        table.schema = sums.schema
        to_batches(sums, table.apply, checkpoint, once=True, in_state=True).awaitTermination()

    replay(feed, build, order, f"{name}-job", closing=closing, write=write)
    return table


def _traffic_table(spark, read) -> MetricTable:
    return _into_table(spark, b.page_views(read), jobs.traffic_window, "et", _last_page(), "traffic")


@stream_query
def traffic_4key_10s_stream(spark, stream, read):
    return _traffic_table(spark, read).read()


@stream_query
def home_detail_uv_3s_stream(spark, stream, read):
    return replay(b.page_views(read), jobs.home_detail_window, "et", "home_detail", closing=_last_page())


@stream_query
def user_back_3h_stream(spark, stream, read):
    return replay(b.page_views(read), jobs.login_window, "et", "login", closing=_last_page())


@stream_query
def cart_uu_5s_stream(spark, stream, read):
    return replay(b.cart_adds(read), jobs.cart_window, "ts", "cart", closing={"user_id": F.lit("closing"), "ts": F.lit(FAR_MS)})


@stream_query
def keyword_10s_stream(spark, stream, read):
    return replay(b.search_pages(read), jobs.keyword_window, "et", "keyword", closing={"et": _far()})


@stream_query
def first_of_day_stream(spark, stream, read):
    firsts = replay(b.page_views(read), lambda s: state.first_of_day(s, ["mid"], "1 second"), "et", "first_of_day")
    return firsts.select("mid", F.date_format("et", dates.DATE).alias("visit_date"), F.unix_micros("et").alias("first_us"))


@stream_query
def isnew_repair_stream(spark, stream, read):
    path, rows = fresh_dir(spark, "isnew"), b.page_views(read).select("event_id", "mid", "is_new", "et")
    dates = FirstVisits(spark, f"{path}/dates")
    write = batch_folders(f"{path}/data")
    for part in deliveries(rows, "et", name="isnew-feed"):
        dates.start(part, f"{path}/checkpoint", ["event_id"], write, once=True).awaitTermination()
    return spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{path}/data").select("event_id", "mid", "is_new")


def _summed(spark, read, build, name: str, cuts: list | None = None, parts: int = 2) -> retraction.RetractedSums:
    """The order-detail feed into sums over newest versions, in deliveries."""
    path, details = fresh_dir(spark, name), b.order_details(read)
    sums = build(spark, f"{path}/tables", details.where("false"))
    for part in deliveries(details, "ts", parts, name=f"{name}-feed", cuts=cuts):
        sums.start(part, f"{path}/checkpoint", once=True).awaitTermination()
    return sums


@stream_query
def sku_order_10s_stream(spark, stream, read):
    sums = _summed(spark, read, retraction.sku_sums, "sku")
    return plain(metrics.with_sku_dimensions(retraction.sku_windows(sums, labelled=False), b.sku_dimensions(read)))


COMMENT_CUT = 100_000  # up to comment 100
INGEST_CUT, INGEST_STAMPS = 803347200000, (0, 3_600_000)  # 1995-06-17


@stream_query
def sku_ingest_stream(spark, stream, read):
    """Windows by arrival: two deliveries with a clock of their own; a line counts in the window of its newest version."""
    clock = iter(INGEST_STAMPS)
    sums = _summed(spark, read, lambda *a: retraction.sku_sums(*a, stamp=lambda: next(clock)), "sku_ingest", cuts=[INGEST_CUT])
    return plain(retraction.sku_windows(sums))


@stream_query
def province_order_10s_stream(spark, stream, read):
    sums = _summed(spark, read, retraction.order_sums, "province")
    return plain(metrics.with_province_name(retraction.province_windows(sums), b.provinces(read)))


@stream_query
def retract_stream(spark, stream, read):
    """What is left of every order line after all versions and retractions."""
    def per_line(spark, path, empty):
        return retraction.RetractedSums(spark, path, metrics.order_measures, empty, ["id"], retraction.VERSION_ORDER, metrics.AMOUNTS, {"id": F.col("id")})

    sums = _summed(spark, read, per_line, "retract", parts=3)
    return plain(sums.read().withColumnRenamed(retraction.LINES, "lines"))


@stream_query
def gmv_stored(spark, stream, read):
    """The last stored day of the windows that a stream keeps."""
    table = retraction.province_windows(_summed(spark, read, retraction.order_sums, "gmv"))
    day = table.agg(F.max("cur_date")).first()[0]
    return plain(reports.gmv(table, int((day or "0").replace("-", ""))))


@stream_query
def channel_uv_stored(spark, stream, read):
    table = _traffic_table(spark, read).read()
    day = table.agg(F.max("cur_date")).first()[0]
    return reports.channel_visitors(table, int((day or "0").replace("-", "")), limit=3)


@stream_query
def order_detail_fact_stream(spark, stream, read):
    """Joined in state: details, activities and coupons lie within the hour of their order here."""
    closing = b.closing_envelopes(spark, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    return replay(b.near_order_db(read), lambda s: facts.order_detail(s, within="1 hour"), "ts_ms", "order_detail", closing=closing, slice_rows=SLICE_ROWS)


def _keyed(fact: keyed.KeyedFact, feed: DataFrame, parts: int = 2) -> keyed.KeyedFact:
    """JSON lines of ``feed`` into a keyed fact, in deliveries."""
    for lines in deliveries(b.as_lines(feed), "ts_ms", parts, name="lines"):
        fact.start(lines, f"{fact.path}/checkpoint", once=True).awaitTermination()
    return fact


@stream_query
def order_detail_upsert_stream(spark, stream, read):
    """JSON lines into the keyed order-detail fact, without any time bound."""
    return _keyed(keyed.order_details(spark, fresh_dir(spark, "order_detail_upsert")), b.order_detail_db(read)).read()


@stream_query
def refund_upsert_stream(spark, stream, read):
    """JSON lines into the keyed refund fact: one row per refund, the newest."""
    return _keyed(keyed.refunds(spark, fresh_dir(spark, "refund_upsert"), lambda at: b.dictionary(spark)), b.refund_db(read)).read()


@stream_query
def refund_pay_upsert_stream(spark, stream, read):
    """Paid-out refunds first, the refunds and orders they belong to in two later deliveries."""
    fact = keyed.refund_payments(spark, fresh_dir(spark, "refund_pay_upsert"), lambda at: b.dictionary(spark))
    late = b.order_changes(read).unionByName(b.refund_changes(read))
    feed = b.refund_payment_changes(read).withColumn("step", F.lit(0)).unionByName(
        late.withColumn("step", F.when(F.col("source.table") == "order_info", 2).otherwise(1)))
    for lines in deliveries(b.as_lines(feed, "step"), "step", name="lines", cuts=[0, 1]):
        fact.start(lines, f"{fact.path}/checkpoint", once=True).awaitTermination()
    return fact.read()


@stream_query
def comment_upsert_stream(spark, stream, read):
    return _keyed(keyed.comments(spark, fresh_dir(spark, "comment_upsert"), lambda at: b.dictionary(spark)), b.comment_changes(read)).read()


@stream_query
def dictionary_refresh_stream(spark, stream, read):
    """Two deliveries of comments; between them the dictionary calls English otherwise, knows Spanish and forgets French."""
    path, ticks = fresh_dir(spark, "dictionary_refresh"), iter((0, 0, 2 * HOUR_MS))
    names = iter((b.dictionary(spark), b.dictionary(spark), b.changed_dictionary(spark)))
    versions = DictionaryVersions(spark, f"{path}/dictionary", lambda: next(names))
    fact = keyed.comments(spark, f"{path}/comments", versions.at, clock=lambda: next(ticks))
    for lines in deliveries(b.as_lines(b.comment_changes(read)), "ts_ms", name="lines", cuts=[COMMENT_CUT]):
        fact.start(lines, f"{path}/checkpoint", once=True).awaitTermination()
    return fact.read()


@stream_query
def cart_upsert_stream(spark, stream, read):
    return _keyed(keyed.cart(spark, fresh_dir(spark, "cart_upsert")), b.cart_changes(read)).read()


def _after_details(spark, fact: keyed.KeyedFact, details: keyed.KeyedFact, changes: DataFrame, feed: DataFrame) -> DataFrame:
    """A fact over the stored detail fact: each delivery of its own changes arrives before the details of the same time."""
    for lines, detail_lines in zip(deliveries(b.as_lines(changes), "ts_ms", name="lines"), deliveries(b.as_lines(feed), "ts_ms", name="detail_lines")):
        fact.start(lines, f"{fact.path}/checkpoint", once=True).awaitTermination()
        details.start(detail_lines, f"{details.path}/checkpoint", once=True).awaitTermination()
    fact.follow()
    return fact.read()


@stream_query
def cancel_upsert_stream(spark, stream, read):
    """Cancelled details from order changes and the change feed of the stored detail fact."""
    path = fresh_dir(spark, "cancel_upsert")
    details = keyed.order_details(spark, f"{path}/details")
    return _after_details(spark, keyed.cancels(spark, f"{path}/cancels", details), details, b.order_changes(read), b.order_detail_db(read))


@stream_query
def pay_upsert_stream(spark, stream, read):
    """Paid details from payments and the change feed of the stored detail fact."""
    path = fresh_dir(spark, "pay_upsert")
    details = keyed.order_details(spark, f"{path}/details")
    fact = keyed.payments(spark, f"{path}/payments", details, lambda at: b.dictionary(spark))
    return _after_details(spark, fact, details, b.payment_changes(read), b.near_order_db(read))


@query
def bad_amounts(spark, read):
    """Order lines of which some amounts are no numbers: what the windows sum, and what goes to the dirty feed."""
    broken = F.when(F.col("sku_id").cast("bigint") % 10 == 0, F.concat("split_total_amount", F.lit("x"))).otherwise(F.col("split_total_amount"))
    details = b.order_details(read).withColumn("split_total_amount", broken)
    good = metrics.order_measures(details).agg(F.count(F.lit(1)).alias("n"), F.sum("order_amount").cast("double").alias("order_amount"))
    bad = metrics.malformed_amounts(details).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("order_amount"))
    return good.select(F.lit("measured").alias("feed"), "*").unionByName(bad.select(F.lit("dirty").alias("feed"), "*"))


def _two_feeds(spark, left: DataFrame, left_ts: str, right: DataFrame, right_ts: str, build, name: str) -> DataFrame:
    """``build(left stream, right stream)`` over both feeds delivered together in order of time."""
    kind = lambda df: df.select(F.struct("*").alias("x")).schema["x"].dataType
    none = lambda df: F.lit(None).cast(kind(df))
    both = left.select(F.struct("*").alias("l"), none(right).alias("r"), F.col(left_ts).alias("at")).unionByName(
        right.select(none(left).alias("l"), F.struct("*").alias("r"), F.col(right_ts).alias("at")))
    return replay(both, lambda s: build(s.where("l is not null").select("l.*"), s.where("r is not null").select("r.*")), "at", name,
                  slice_rows=SLICE_ROWS)


@stream_query
def cancel_fact_stream(spark, stream, read):
    """Details within the hour of their order, and the cancel ten minutes after it."""
    return _two_feeds(spark, b.paid_details(read), "ts", b.order_changes(read), "ts_ms",
                      lambda details, changes: facts.order_cancel(changes, details, within="1 hour"), "cancel")


@stream_query
def pay_interval_join_stream(spark, stream, read):
    return _two_feeds(spark, b.paid_details(read), "ts", b.payment_changes(read), "ts_ms",
                      lambda details, changes: facts.payment_success(changes, details, b.dictionary(spark)), "pay")


@stream_query
def refund_fact_stream(spark, stream, read):
    """Refunds within the hour of their order, joined in state."""
    return replay(b.near_refund_db(read), lambda s: facts.order_refund(s, b.dictionary(spark), within="1 hour"), "ts_ms", "refund")


@stream_query
def refund_pay_fact_stream(spark, stream, read):
    return replay(b.near_refund_db(read), lambda s: facts.refund_payment_success(s, b.dictionary(spark), within="1 hour"), "ts_ms", "refund_pay")


@stream_query
def comment_dic_left_stream(spark, stream, read):
    return replay(b.comment_changes(read), lambda s: facts.comment_info(s, b.dictionary(spark)), "ts_ms", "comment")


@stream_query
def cart_delta_stream(spark, stream, read):
    return replay(b.cart_changes(read), facts.cart_add, "ts_ms", "cart_delta")


@stream_query
def log_split_stream(spark, stream, read):
    path = fresh_dir(spark, "log_split")
    dates = FirstVisits(spark, f"{path}/dates")
    lines = b.cut_log_lines(read)
    for part in deliveries(lines, "ts", name="log_lines"):
        pipelines.split_logs(part, dates, f"{path}/data", f"{path}/checkpoint", once=True).awaitTermination()
    written = spark.read.schema("value string, batch bigint, feed string").text(f"{path}/data").drop("batch")
    cells = "map<string,string>"  # of the feeds, what the rows are compared by
    schema = (f"common struct<mid string, is_new string>, page struct<page_id string>, start {cells}, err {cells}, displays array<{cells}>, "
              f"actions array<{cells}>, ts bigint, display {cells}, action {cells}")
    good = jsons.parse_once(written.where("feed != 'dirty'"), schema, keep=["feed"])
    nothing = F.lit(None).cast("string")
    bad = written.where("feed = 'dirty'").select("feed", nothing.alias("mid"), nothing.alias("is_new"),
                                                 nothing.cast("bigint").alias("ts"),
                                                 F.length("value").cast("string").alias("detail"))
    return _feed_rows(good).unionByName(bad)


def _dimension_store(spark, read, path: str) -> DimensionStore:
    """The dimension changes as JSON lines with their position, in two deliveries, into a store."""
    store = DimensionStore(spark, f"{path}/store")
    store.apply_config(b.dimension_config(spark).withColumn("ts_ms", F.lit(0).cast("bigint")), 0)
    for lines in deliveries(b.as_lines(b.dimension_changes(read)), "ts_ms", name="dimension_lines"):
        changes = cdc.parse_envelopes(lines, seq="ts_ms")
        pipelines.dimension_sync(changes, store, "shop", f"{path}/checkpoint", once=True).awaitTermination()
    return store


@stream_query
def dim_upsert_stream(spark, stream, read):
    return _dimension_store(spark, read, fresh_dir(spark, "dims")).read("dim_user_info")


@stream_query
def dim_scan_delete(spark, stream, read):
    """A dimension table after every third key was deleted, and its row count."""
    store = _dimension_store(spark, read, fresh_dir(spark, "dims_delete"))
    keys = store.read("dim_sku_info").where(F.col("row_key").cast("bigint") % 3 == 0).select("row_key")
    store.delete_rows("dim_sku_info", keys, FAR_MS)
    left = store.read("dim_sku_info")
    return left.withColumn("n_rows", F.lit(store.count("dim_sku_info")).cast("bigint"))


@stream_query
def dim_config_change_stream(spark, stream, read):
    """Configuration as a stream: one table is dropped and created anew between two changes, another appears late."""
    path = fresh_dir(spark, "dims_config")
    store = DimensionStore(spark, f"{path}/store")
    config = b.dimension_config_changes(spark, F.lit(0).cast("bigint"), read)
    for stream_part in deliveries(config, "ts_ms", name="config"):
        pipelines.config_sync(stream_part, store, f"{path}/config_checkpoint", once=True).awaitTermination()
    for lines in deliveries(b.as_lines(b.dimension_changes(read)), "ts_ms", name="dimension_lines"):
        pipelines.dimension_sync(cdc.parse_envelopes(lines), store, "shop", f"{path}/checkpoint", once=True).awaitTermination()
    return store.read("dim_user_info")


@stream_query
def config_prune_fact_stream(spark, stream, read):
    path = fresh_dir(spark, "routed")
    for part in deliveries(b.order_changes(read), "ts_ms", name="routed-feed"):
        pipelines.route_facts(part, lambda: b.fact_config(spark), pipelines.routed_folders(f"{path}/data"),
                              f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.text(f"{path}/data").select("sink_table", F.col("value").alias("payload"))


@stream_query
def file_partition_day_stream(spark, stream, read):
    path = fresh_dir(spark, "by_day")
    lines = _stamped_lines(read).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3)))
    for part in deliveries(lines, "part", name="by_day-feed", cuts=[0, 1]):
        writer = stream_by_day(part, f"{path}/data", f"{path}/checkpoint", "at")
        writer.trigger(availableNow=True).start().awaitTermination()
    written = spark.read.schema("value string, day string").text(f"{path}/data")
    return written.groupBy(F.col("day").alias("bucket")).agg(F.count(F.lit(1)).alias("lines"))


@stream_query
def file_rolled_day_stream(spark, stream, read):
    """Day files after five deliveries: the lines of each day, and no day in more files than its bytes need."""
    path = fresh_dir(spark, "rolled_day")
    table = DayFiles(spark, f"{path}/data")
    lines = _stamped_lines(read).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(5)))
    for part in deliveries(lines, "part", name="rolled-feed", cuts=[0, 1, 2, 3]):
        table.start(part, f"{path}/checkpoint", "at", once=True).awaitTermination()
    table.roll()
    per_file = table.read().groupBy("day", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(F.col("day").alias("bucket")).agg(F.sum("n").alias("lines"), F.count(F.lit(1)).alias("files"))


@stream_query
def upsert_detail_stream(spark, stream, read):
    """The order-detail feed into a keyed table."""
    path = fresh_dir(spark, "upsert")
    table = UpsertTable(spark, f"{path}/table", schemas.ORDER_DETAIL, ["id"],
                        ["ts", "sku_id", "split_original_amount", "split_total_amount", "split_coupon_amount", "sku_num"])
    details = b.order_details(read).withColumns({"date_id": F.lit(None).cast("string"),
                                                 "create_time": F.lit(None).cast("string")})
    for part in deliveries(details, "ts", 3, name="upsert-feed"):
        to_batches(part, table.apply, f"{path}/checkpoint", once=True).awaitTermination()
    return table.read().select("id", "sku_id", "sku_num", "split_original_amount", "split_total_amount", "ts")
