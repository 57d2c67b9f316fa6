"""The given star-schema tables in the roles of the shop's feeds.

Everything here is a row-wise mapping of whole tables, so the work of a query grows with them. Each
function takes ``read`` (table name → DataFrame, batch or streaming).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Reader = Callable[[str], DataFrame]

MINUTE = 60_000


def batch_reader(spark: SparkSession, sf_dir: str) -> Reader:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_reader(spark: SparkSession, sf_dir: str, **options) -> Reader:
    def read(name: str) -> DataFrame:
        path = f"{sf_dir}/{name}.parquet"
        schema = spark.read.parquet(path).schema
        # the stream source takes folders and patterns, and a table here may be a single file
        return spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[t]")

    return read


TASKS_PER_CORE = 4


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """The rows dealt over a few tasks per core by a hash: for a table whose few compressed splits turn into much text."""
    return rows.repartition(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism, *by)


def text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)")


def millis(c: str) -> Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


def row(**cells: Column) -> Column:
    return F.create_map(*[x for k, v in cells.items() for x in (F.lit(k), v.cast("string"))])


def envelope(table: str, op, ts_ms: Column, before: Column | None = None, after: Column | None = None,
             db: str = "shop") -> Column:
    def cells(c: Column | None) -> Column:
        return (F.lit(None) if c is None else c).cast("map<string,string>")

    return F.struct(cells(before).alias("before"), cells(after).alias("after"),
                    row(db=F.lit(db), table=F.lit(table)).alias("source"),
                    (F.lit(op) if isinstance(op, str) else op).alias("op"), ts_ms.alias("ts_ms"))


def _unfold(df: DataFrame, table: str, *envelopes: Column) -> DataFrame:
    """One output row per envelope expression and input row, without a union of scans.

    The source stays outside the generator: a filter on the table is then decided while planning,
    and branches of a union that hold other tables are not read.
    """
    parts = [F.struct(*[e[c].alias(c) for c in ("before", "after", "op", "ts_ms")]) for e in envelopes]
    rows = df.select(F.explode(F.array(*parts)).alias("e")).where(F.col("e.op").isNotNull())
    return rows.select("e.before", "e.after", row(db=F.lit("shop"), table=F.lit(table)).alias("source"), "e.op", "e.ts_ms")


# --- application log ------------------------------------------------------------------------------

# Fixed values of this mapping: event type → page.
PAGES = {"click": "home", "view": "good_detail", "purchase": "payment", "signup": "login", "error": "mine"}


def page_views(read: Reader) -> DataFrame:
    """``events`` as flat page views."""
    k = F.get_json_object("props", "$.k").cast("int")
    pages = F.create_map(*[F.lit(x) for pair in PAGES.items() for x in pair])
    last = (F.when(k < 20, None).when(k < 30, "").when(k < 50, "login").when(k < 70, "search").otherwise("home"))
    return read("events").select(
        "event_id", F.concat(F.lit("mid_"), text("user_id")).alias("mid"),
        F.when(k % 7 == 0, None).otherwise(text("user_id")).alias("uid"),
        F.concat(F.lit("v2."), text(k % 4)).alias("vc"), F.col("event_type").alias("ch"),
        text(F.col("user_id") % 34).alias("ar"),
        F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"),
        pages[F.col("event_type")].alias("page_id"), last.alias("last_page_id"),
        F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
        millis("ts").alias("ts"), F.col("ts").cast("timestamp").alias("et"))


def log_lines(read: Reader) -> DataFrame:
    """``events`` as JSON log lines: errors, starts, and pages with displays and actions."""
    v = page_views(read)
    number = F.col("event_id")
    common = F.struct("ar", "uid", "ch", "is_new", "mid", "vc")
    page = F.struct("page_id", "last_page_id", "during_time")

    def items(n: Column, field: str) -> Column:
        return F.transform(F.sequence(F.lit(1), n),
                           lambda i: F.create_map(F.lit(field), F.concat(text(number), F.lit("_"), text(i))))

    displays = F.when(number % 3 == 0, None).when(number % 3 == 1, F.array().cast("array<map<string,string>>")
                                                  ).otherwise(items((number % 4 + 1).cast("int"), "item"))
    actions = F.when(number % 2 == 1, items((number % 2 + 1).cast("int"), "action_id"))
    start = F.when((F.col("ch") == "signup") & (number % 5 == 0), F.create_map(F.lit("entry"), F.lit("icon")))
    err = F.when(F.col("ch") == "error", F.create_map(F.lit("code"), text(number % 10)))
    record = F.struct(common.alias("common"), page.alias("page"), start.alias("start"), err.alias("err"),
                      displays.alias("displays"), actions.alias("actions"), "ts")
    return v.select("event_id", "ts", F.to_json(record).alias("value"))


def cut_log_lines(read: Reader) -> DataFrame:
    """The log lines, every 13th cut short, beside their time."""
    cut = F.when(F.col("event_id") % 13 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    return log_lines(lambda name: spread(read(name), "event_id", "ts", "user_id")).select(cut.alias("value"), "ts")


def damaged_lines(read: Reader) -> DataFrame:
    """``events.props`` with every kind of damage, by row number."""
    n = F.col("event_id") % 8
    p = F.col("props")
    bad = (F.when(n == 1, F.substring(p, 1, 4)).when(n == 2, F.concat(p, F.lit("x{")))
           .when(n == 3, F.lit("")).when(n == 4, F.concat(F.lit("["), p, F.lit("]")))
           .when(n == 5, F.regexp_replace(p, '"', "'")).when(n == 6, F.concat(p, F.lit(","), p)).otherwise(p))
    return read("events").select("event_id", "event_type", millis("ts").alias("ms"), bad.alias("value"))


def search_pages(read: Reader) -> DataFrame:
    """``conversations`` as keyword searches, ten seconds of event time per conversation."""
    start = F.lit(1704067200)
    et = F.timestamp_seconds(start + F.col("conv_id") * 10 + F.col("turn") % 10)
    return read("conversations").select(
        et.alias("et"), F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type"),
        F.col("text").alias("item"))


def cart_adds(read: Reader) -> DataFrame:
    """Purchases as the cart-add feed."""
    return read("events").where(F.col("event_type") == "purchase").select(
        text("event_id").alias("id"), text("user_id").alias("user_id"), millis("ts").alias("ts"))


# --- change data ----------------------------------------------------------------------------------

def order_changes(read: Reader) -> DataFrame:
    """Each order's insert, its status update, and for refunded orders the second update."""
    t = millis("o_orderdate")
    base = dict(id=F.col("o_orderkey"), user_id=F.col("o_custkey"), province_id=F.col("o_custkey") % 25)
    to = (F.when(F.col("o_orderstatus") == "F", "1003").when(F.col("o_orderstatus") == "O", "1005").otherwise("1002"))
    later = t + 10 * MINUTE
    created = row(**base, order_status=F.lit("1001"))
    moved = row(**base, order_status=to, operate_time=later)
    done = row(**base, order_status=F.lit("1006"), operate_time=later + 10 * MINUTE)
    return _unfold(read("orders"), "order_info",
                  envelope("order_info", "c", t, after=created),
                  envelope("order_info", "u", later, created, moved),
                  F.when(to == "1005", envelope("order_info", "u", later + 10 * MINUTE, moved, done)))


def detail_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def detail_millis() -> Column:
    """Detail time: the ship date plus a second count spread over ten minutes."""
    return millis("l_shipdate") + (F.col("l_partkey") % 600) * 1000


def detail_row() -> Column:
    price = money("l_extendedprice")
    return row(id=detail_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
               sku_name=F.concat(F.lit("sku "), text("l_partkey")), create_time=detail_millis(),
               sku_num=F.col("l_quantity").cast("int"), order_price=price,
               split_total_amount=price - (price * money("l_discount")).cast("decimal(16,2)"),
               split_activity_amount=(price * money("l_discount")).cast("decimal(16,2)"),
               split_coupon_amount=(price * money("l_tax")).cast("decimal(16,2)"))


def detail_changes(read: Reader) -> DataFrame:
    return read("lineitem").select(envelope("order_detail", "c", detail_millis(), after=detail_row()).alias("e")).select("e.*")


def activity_changes(read: Reader) -> DataFrame:
    after = row(order_detail_id=detail_id(), activity_id=F.col("l_suppkey") % 5, activity_rule_id=F.col("l_suppkey") % 3)
    return (read("lineitem").where(F.col("l_discount") >= 0.05)
            .select(envelope("order_detail_activity", "c", detail_millis(), after=after).alias("e")).select("e.*"))


def coupon_changes(read: Reader) -> DataFrame:
    after = row(order_detail_id=detail_id(), coupon_id=F.col("l_partkey") % 9)
    return (read("lineitem").where(F.col("l_tax") >= 0.04)
            .select(envelope("order_detail_coupon", "c", detail_millis(), after=after).alias("e")).select("e.*"))


def order_detail_db(read: Reader) -> DataFrame:
    """The envelope feed that order details are assembled from."""
    return (order_changes(read).unionByName(detail_changes(read))
            .unionByName(activity_changes(read)).unionByName(coupon_changes(read)))


def order_details(read: Reader) -> DataFrame:
    """``lineitem`` as the order-detail feed: several versions of an order line, newest by ``ts``.

    The province is a function of the order, as a joined feed would carry it.
    """
    line = detail_row()
    fields = ("order_id", "sku_id", "sku_name", "sku_num", "split_activity_amount", "split_coupon_amount",
              "split_total_amount")
    return read("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), *[line[f].alias(f) for f in fields],
        text("l_orderkey").alias("user_id"), text(F.col("l_orderkey") % 27).alias("province_id"),
        line["order_price"].alias("split_original_amount"),
        text(F.lit(None)).alias("activity_id"), text(F.lit(None)).alias("activity_rule_id"),
        text(F.lit(None)).alias("coupon_id"), detail_millis().alias("ts"))


def near_order_db(read: Reader) -> DataFrame:
    """The feed of ``order_detail_db`` with every detail, activity and coupon within ten minutes of its order."""
    line, at = detail_row(), F.col("t") + (F.col("l_partkey") % 600) * 1000
    times = read("orders").select("o_orderkey", millis("o_orderdate").alias("t"))
    lines = read("lineitem").join(times, F.col("l_orderkey") == F.col("o_orderkey"))
    activity = row(order_detail_id=detail_id(), activity_id=F.col("l_suppkey") % 5, activity_rule_id=F.col("l_suppkey") % 3)
    coupon = row(order_detail_id=detail_id(), coupon_id=F.col("l_partkey") % 9)
    parts = [envelope("order_detail", "c", at, after=line),
             F.when(F.col("l_discount") >= 0.05, envelope("order_detail_activity", "c", at + 1000, after=activity)),
             F.when(F.col("l_tax") >= 0.04, envelope("order_detail_coupon", "c", at + 2000, after=coupon))]
    near = lines.select(F.explode(F.array_compact(F.array(*parts))).alias("e")).select("e.*")
    return order_changes(read).unionByName(near)


def closing_envelopes(spark: SparkSession, *tables: str) -> DataFrame:
    """One change per table in the year 2200, of ids that match nothing, to close what a stream holds open."""
    far = F.lit(7258118400000)
    rows = spark.range(1).select(F.explode(F.array(*[
        envelope(t, "c", far, after=row(id=F.lit(f"closing {t}"), order_id=F.lit("none"), order_detail_id=F.lit("none"))) for t in tables])).alias("e"))
    return rows.select("e.*")


def as_lines(changes: DataFrame, order: str = "ts_ms") -> DataFrame:
    """Envelopes as JSON text beside their time, or what else orders their delivery."""
    return changes.select(F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("value"), order)


def payment_changes(read: Reader) -> DataFrame:
    """Payments of orders in status P: from not paid to paid, five minutes after the order date.

    The payment type is the priority digit, so type 5 is in no dictionary.
    """
    t = millis("o_orderdate") + 5 * MINUTE
    before = row(payment_status=F.lit("1601"))
    after = row(user_id=F.col("o_custkey"), order_id=F.col("o_orderkey"), payment_status=F.lit("1602"),
                payment_type=F.concat(F.lit("110"), F.left("o_orderpriority", F.lit(1))), callback_time=t + 2000)
    return (read("orders").where(F.col("o_orderstatus") == "P")
            .select(envelope("payment_info", "u", t, before, after).alias("e")).select("e.*"))


def paid_details(read: Reader, orders: DataFrame | None = None) -> DataFrame:
    """Order details timed within an hour around their order's date, as a payment would meet them.

    ``orders`` may be given as a static table when ``read`` streams. The lines meet their orders as the numbers they are
    stored as; the texts are made of the joined rows, so that the exchange does not carry them.
    """
    orders = read("orders") if orders is None else orders
    orders = orders.select("o_orderkey", millis("o_orderdate").alias("t"))
    line = detail_row()
    wanted = ("id", "order_id", "sku_id", "sku_name", "sku_num", "split_activity_amount", "split_coupon_amount",
              "split_total_amount")
    near = F.col("t") - 40 * MINUTE + (F.col("l_partkey") % 3600) * 1000
    joined = read("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*[line[f].alias(f) for f in wanted], line["order_price"].alias("split_original_amount"), text("l_orderkey").alias("user_id"),
                         text(F.col("l_orderkey") % 27).alias("province_id"),
                         text(F.lit(None)).alias("activity_id"), text(F.lit(None)).alias("activity_rule_id"),
                         text(F.lit(None)).alias("coupon_id"), near.alias("ts"))


def _near_lines(read: Reader) -> DataFrame:
    """Lines with the time ``near_ms``, 15 to 25 minutes after their order."""
    orders = read("orders").select("o_orderkey", millis("o_orderdate").alias("t"))
    near = F.col("t") + 15 * MINUTE + (F.col("l_partkey") % 600) * 1000
    return read("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("near_ms", near)


def near_refund_db(read: Reader) -> DataFrame:
    """The feed of ``refund_db`` with refunds and their payments within the hour of the order."""
    lines = lambda name: _near_lines(read) if name == "lineitem" else read(name)
    return order_changes(read).unionByName(refund_changes(lines, F.col("near_ms"))).unionByName(refund_payment_changes(lines, F.col("near_ms")))


def refund_changes(read: Reader, at: Column | None = None) -> DataFrame:
    """Returned lines as refund requests: the insert and the update to "paid out"."""
    t = detail_millis() if at is None else at
    base = dict(id=detail_id(), user_id=F.col("l_suppkey"), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
                refund_type=F.concat(F.lit("150"), text(F.col("l_linenumber") % 3 + 1)),
                refund_reason_type=F.concat(F.lit("130"), text(F.col("l_partkey") % 4 + 1)),
                refund_reason_txt=F.lit("returned"), refund_num=F.col("l_quantity").cast("int"),
                refund_amount=money("l_extendedprice"), create_time=t)
    asked = row(**base, refund_status=F.lit("0702"))
    paid = row(**base, refund_status=F.lit("0705"))
    return _unfold(read("lineitem").where(F.col("l_returnflag") == "R"), "order_refund_info",
                   envelope("order_refund_info", "c", t, after=asked),
                   envelope("order_refund_info", "u", t + 2 * MINUTE, asked, paid))


def refund_payment_changes(read: Reader, at: Column | None = None) -> DataFrame:
    t = (detail_millis() if at is None else at) + 3 * MINUTE
    before = row(refund_status=F.lit("1601"))
    after = row(id=detail_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
                refund_status=F.lit("1602"), payment_type=F.concat(F.lit("110"), text(F.col("l_linenumber") % 5 + 1)),
                callback_time=t, total_amount=money("l_extendedprice"))
    return (read("lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
            .select(envelope("refund_payment", "u", t, before, after).alias("e")).select("e.*"))


def refund_db(read: Reader) -> DataFrame:
    return (order_changes(read).unionByName(refund_changes(read)).unionByName(refund_payment_changes(read)))


def cart_changes(read: Reader) -> DataFrame:
    """Lines as cart rows: an insert for line 1, else an update from an old quantity (missing for line 7)."""
    old = F.when(F.col("l_linenumber") == 7, None).otherwise((F.col("l_partkey") % 50).cast("int"))
    base = dict(id=detail_id(), user_id=F.col("l_suppkey"), sku_id=F.col("l_partkey"))
    after = row(**base, sku_num=F.col("l_quantity").cast("int"))
    before = F.when(F.col("l_linenumber") > 1, row(**base, sku_num=old))
    op = F.when(F.col("l_linenumber") == 1, "c").otherwise("u")
    return read("lineitem").select(envelope("cart_info", op, detail_millis(), before, after).alias("e")).select("e.*")


def comment_changes(read: Reader) -> DataFrame:
    """Documents as comments, appraised by language; ``id`` is missing for the shortest ones."""
    after = row(id=F.when(F.col("n_chars") >= 50, F.col("doc_id")), user_id=F.col("doc_id") % 100,
                sku_id=F.col("doc_id") % 35, appraise=F.col("lang"), comment_txt=F.col("text"))
    return read("documents").select(
        envelope("comment_info", "c", F.col("doc_id") * 1000, after=after).alias("e")).select("e.*")


def dimension_changes(read: Reader) -> DataFrame:
    """Customers and parts as dimension changes: insert, update with an empty cell, delete, insert again."""
    key = F.col("c_custkey")
    full = row(id=key, name=F.col("c_name"), segment=F.col("c_mktsegment"), nation=F.col("c_nationkey"))
    update = row(id=key, name=F.lit(""), segment=F.concat(F.col("c_mktsegment"), F.lit("_2")), nation=F.col("c_nationkey"))
    again = row(id=key, name=F.concat(F.col("c_name"), F.lit("_again")), segment=F.lit(""), nation=F.lit(None))
    t = key * 10
    customers = _unfold(read("customer"), "user_info",
                        envelope("user_info", "r", t, after=full),
                        F.when(key % 2 == 0, envelope("user_info", "u", t + 1, full, update)),
                        F.when(key % 7 == 0, envelope("user_info", "d", t + 2, before=full)),
                        F.when(key % 14 == 0, envelope("user_info", "c", t + 3, after=again)))
    parts = read("part").select(envelope("sku_info", "c", F.col("p_partkey") * 10, after=row(
        id=F.col("p_partkey"), sku_name=F.col("p_name"), tm_id=F.col("p_brand"), spu_id=F.col("p_type"),
        price=money("p_retailprice"))).alias("e")).select("e.*")
    nations = read("nation").select(envelope("base_nation", "c", F.col("n_nationkey").cast("bigint"), after=row(
        id=F.col("n_nationkey"), name=F.col("n_name"))).alias("e")).select("e.*")
    return customers.unionByName(parts).unionByName(nations)


# --- configuration and dimensions -----------------------------------------------------------------

def dictionary(spark: SparkSession) -> DataFrame:
    """Code names; payment type 1105, refund reason 1304 and the language "es" are missing."""
    return spark.sql("""
        SELECT code AS dic_code, named_struct('dic_name', name) AS info FROM VALUES
          ('1101', 'alipay'), ('1102', 'wechat'), ('1103', 'unionpay'), ('1104', 'card'),
          ('1501', 'money only'), ('1502', 'goods and money'), ('1503', 'exchange'),
          ('1301', 'quality'), ('1302', 'description'), ('1303', 'out of stock'),
          ('en', 'English'), ('fr', 'French'), ('de', 'German') AS t(code, name)""")


def changed_dictionary(spark: SparkSession) -> DataFrame:
    """The dictionary later on: English has another name, Spanish is known, French is not."""
    names = dictionary(spark).where("dic_code not in ('en', 'fr')")
    more = spark.sql("SELECT 'en' AS dic_code, named_struct('dic_name', 'British') AS info UNION ALL SELECT 'es', named_struct('dic_name', 'Spanish')")
    return names.unionByName(more.select(F.col("dic_code"), F.col("info").cast(names.schema["info"].dataType)))


def dimension_config(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT * FROM VALUES
          ('user_info', 'dim_user_info', 'id,name,segment', 'info', 'id', 'r'),
          ('sku_info', 'dim_sku_info', 'id,sku_name,tm_id', 'info', 'id', 'r')
        AS t(source_table, sink_table, sink_columns, sink_family, sink_row_key, op)""")


def dimension_config_changes(spark: SparkSession, first: Column, read: Reader) -> DataFrame:
    """Configuration envelopes: both tables appear, and the customers' is dropped and created anew with
    fewer columns in the middle of the customers' changes.
    """
    middle = read("customer").agg((F.max("c_custkey") * 5).alias("middle"))
    cells = lambda columns: row(source_table=F.lit("user_info"), sink_table=F.lit("dim_user_info"), sink_columns=F.lit(columns),
                                sink_family=F.lit("info"), sink_row_key=F.lit("id"))
    old, new = cells("id,name,segment"), cells("id,segment")
    rows = middle.select(F.explode(F.array(
        envelope("table_process_dim", "r", first, after=old),
        envelope("table_process_dim", "d", F.col("middle"), before=old),
        envelope("table_process_dim", "c", F.col("middle") + 1, after=new))).alias("e"))
    return rows.select("e.*")


def fact_config(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT * FROM VALUES
          ('order_info', 'insert', 'dwd_order_created', 'id,user_id', 'r'),
          ('order_info', 'update', 'dwd_order_changed', 'id,order_status,operate_time', 'r')
        AS t(source_table, source_type, sink_table, sink_columns, op)""")


def sku_dimensions(read: Reader) -> dict[str, DataFrame]:
    """The six dimensions of the sku chain; brand 2 has no trademark row and nation 24 no category."""
    part, nation, region = read("part"), read("nation"), read("region")
    return {
        "dim_sku_info": part.select(text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                                    F.col("p_type").alias("spu_id"), text(F.col("p_size") % 25).alias("category3_id"),
                                    F.col("p_brand").alias("tm_id")),
        "dim_spu_info": part.select(F.col("p_type").alias("id")).distinct().select("id", F.lower("id").alias("spu_name")),
        "dim_base_trademark": part.where(F.col("p_brand") != "Brand#2").select(F.col("p_brand").alias("id")).distinct()
            .select("id", F.upper("id").alias("tm_name")),
        "dim_base_category3": nation.where("n_nationkey < 24").select(
            text("n_nationkey").alias("id"), F.col("n_name").alias("name"), text("n_regionkey").alias("category2_id")),
        "dim_base_category2": region.select(text("r_regionkey").alias("id"), F.col("r_name").alias("name"),
                                            text(F.col("r_regionkey") % 2).alias("category1_id")),
        "dim_base_category1": region.groupBy(text(F.col("r_regionkey") % 2).alias("id")).agg(F.min("r_name").alias("name")),
    }


def provinces(read: Reader) -> DataFrame:
    """Nations as provinces; the feeds use 27 province ids, so two have no name."""
    return read("nation").select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))
