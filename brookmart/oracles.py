"""The same queries as plain SQL over the tables, written without looking at the Spark plans."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def sec(us: str) -> str:
    """Label of a microsecond epoch."""
    return f"strftime(make_timestamp(CAST({us} AS BIGINT)), '%Y-%m-%d %H:%M:%S')"


def day(us: str) -> str:
    return f"strftime(make_timestamp(CAST({us} AS BIGINT)), '%Y-%m-%d')"


def window(us: str, seconds: int) -> str:
    """stt, edt, cur_date of the window around a microsecond epoch."""
    size = seconds * 1_000_000
    start = f"(({us}) // {size}) * {size}"
    return f"{sec(start)} AS stt, {sec(f'{start} + {size}')} AS edt, {day(start)} AS cur_date"


M = "DECIMAL(16,2)"

PV = """
ev AS (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events),
pv AS (SELECT event_id, 'mid_' || user_id AS mid,
   CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS uid,
   'v2.' || (k % 4) AS vc, event_type AS ch, CAST(user_id % 34 AS VARCHAR) AS ar,
   CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
   CASE event_type WHEN 'click' THEN 'home' WHEN 'view' THEN 'good_detail' WHEN 'purchase' THEN 'payment'
        WHEN 'signup' THEN 'login' WHEN 'error' THEN 'mine' END AS page_id,
   CASE WHEN k < 20 THEN NULL WHEN k < 30 THEN '' WHEN k < 50 THEN 'login' WHEN k < 70 THEN 'search'
        ELSE 'home' END AS last_page_id,
   CAST(round(value * 100) AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us,
   strftime(ts, '%Y-%m-%d') AS d
 FROM ev)"""

# --- logs

ORACLES["dirty_split"] = """
WITH damaged AS (SELECT event_id, event_type, CASE event_id % 8
    WHEN 1 THEN substr(props, 1, 4) WHEN 2 THEN props || 'x{' WHEN 3 THEN '' WHEN 4 THEN '[' || props || ']'
    WHEN 5 THEN replace(props, '"', '''') WHEN 6 THEN props || ',' || props ELSE props END AS v FROM events),
checked AS (SELECT *, CASE WHEN json_valid(v) THEN CASE WHEN json_type(v) = 'OBJECT' THEN 1 ELSE 0 END ELSE 0 END AS valid
            FROM damaged)
SELECT event_id, event_type, CASE WHEN valid = 1 THEN CAST(v->>'$.k' AS INTEGER) END AS k, valid FROM checked"""

def repaired(kept: str = "true") -> str:
    return f"""{PV.replace(" FROM ev)", f" FROM ev WHERE {kept})")},
fv AS (SELECT mid, CASE WHEN arg_min(is_new, us) = '1' THEN strftime(make_timestamp(min(us)), '%Y-%m-%d')
        ELSE strftime(make_timestamp(min(us)) - INTERVAL 1 DAY, '%Y-%m-%d') END AS first_date FROM pv GROUP BY mid),
fixed AS (SELECT pv.* EXCLUDE (is_new), CASE WHEN is_new = '1' AND first_date <> d THEN '0' ELSE is_new END AS is_new
          FROM pv JOIN fv USING (mid))"""


ORACLES["isnew_repair"] = f"WITH {repaired()} SELECT event_id, mid, is_new FROM fixed"


def log_records(kept: str = "true") -> str:
    return f"""{repaired(kept)},
lg AS (SELECT *, event_id AS n, ch = 'error' AS is_err, ch = 'signup' AND event_id % 5 = 0 AS is_start,
   CASE event_id % 3 WHEN 0 THEN -1 WHEN 1 THEN 0 ELSE event_id % 4 + 1 END AS n_disp,
   CASE WHEN event_id % 2 = 1 THEN event_id % 2 + 1 ELSE -1 END AS n_act FROM fixed)"""

FEED_ROWS = """
SELECT 'err' AS feed, mid, is_new, ms AS ts, CAST(n % 10 AS VARCHAR) AS detail FROM lg WHERE is_err
UNION ALL SELECT 'start', mid, is_new, ms, 'icon' FROM lg WHERE is_start
UNION ALL SELECT 'page', mid, is_new, ms,
   page_id || '/' || CASE WHEN n_disp = 0 THEN '0' ELSE '-1' END || '/-1' FROM lg WHERE NOT is_start
UNION ALL SELECT 'display', mid, is_new, ms, n || '_' || i
   FROM lg, LATERAL (SELECT unnest(generate_series(1, n_disp)) AS i) WHERE NOT is_start AND n_disp > 0
UNION ALL SELECT 'action', mid, is_new, NULL, n || '_' || i
   FROM lg, LATERAL (SELECT unnest(generate_series(1, n_act)) AS i) WHERE NOT is_start AND n_act > 0"""

ORACLES["log_split"] = f"WITH {log_records()} {FEED_ROWS}"

ORACLES["log_explode"] = f"""
WITH {log_records()}
SELECT page_id, CAST(sum(n_disp) AS BIGINT) AS displays, CAST(sum(n_disp) AS BIGINT) AS items
FROM lg WHERE NOT is_start AND n_disp > 0 GROUP BY page_id"""

ORACLES["first_of_day"] = f"WITH {PV} SELECT mid, d AS visit_date, min(us) AS first_us FROM pv GROUP BY mid, d"

# --- change data

ORD = """
o1 AS (SELECT *, epoch_ms(o_orderdate) AS t, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
   CAST(o_custkey % 25 AS VARCHAR) AS province_id,
   CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'O' THEN '1005' ELSE '1002' END AS moved FROM orders),
oc AS (
  SELECT id, user_id, province_id, '1001' AS status, NULL AS old_status, 'c' AS op, t AS ts_ms, NULL AS operate_time FROM o1
  UNION ALL SELECT id, user_id, province_id, moved, '1001', 'u', t + 600000, CAST(t + 600000 AS VARCHAR) FROM o1
  UNION ALL SELECT id, user_id, province_id, '1006', '1005', 'u', t + 1200000, CAST(t + 1200000 AS VARCHAR)
            FROM o1 WHERE moved = '1005')"""

ORACLES["cdc_project"] = f"WITH {ORD} SELECT id, user_id, province_id, status, old_status, op, ts_ms FROM oc"

ORACLES["cdc_transition"] = f"""
WITH {ORD}
SELECT CASE status WHEN '1003' THEN 'cancelled' WHEN '1005' THEN 'refund_asked' ELSE 'refunded' END AS move,
       id, operate_time, ts_ms
FROM oc WHERE op = 'u' AND status IN ('1003', '1005', '1006')"""

LI = f"""
li AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS did,
   epoch_ms(l_shipdate) + (l_partkey % 600) * 1000 AS ms, CAST(l_extendedprice AS {M}) AS price,
   CAST(CAST(l_extendedprice AS {M}) * CAST(l_discount AS {M}) AS {M}) AS act_amount,
   CAST(CAST(l_extendedprice AS {M}) * CAST(l_tax AS {M}) AS {M}) AS cou_amount,
   CAST(l_quantity AS INTEGER) AS qty FROM lineitem)"""

ORACLES["cart_delta"] = f"""
WITH {LI},
c AS (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey % 50 AS INTEGER) END AS old FROM li)
SELECT did AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
       CAST(CASE WHEN l_linenumber = 1 THEN qty ELSE qty - old END AS VARCHAR) AS sku_num, ms AS ts
FROM c WHERE l_linenumber = 1 OR qty > old"""

CUST = """
cu AS (
  SELECT c_custkey AS k, 'r' AS op, c_custkey * 10 AS ts_ms, c_name AS name, c_mktsegment AS segment FROM customer
  UNION ALL SELECT c_custkey, 'u', c_custkey * 10 + 1, '', c_mktsegment || '_2' FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, 'd', c_custkey * 10 + 2, c_name, c_mktsegment FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT c_custkey, 'c', c_custkey * 10 + 3, c_name || '_again', '' FROM customer WHERE c_custkey % 14 = 0)"""

ORACLES["config_prune_dim"] = f"""
WITH {CUST}
SELECT 'dim_user_info' AS sink_table, CAST(k AS VARCHAR) AS row_key, op, ts_ms,
       '{{"id":"' || k || '","name":"' || name || '","segment":"' || segment || '","op":"' || op || '"}}' AS payload FROM cu
UNION ALL
SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'c', p_partkey * 10,
       '{{"id":"' || p_partkey || '","sku_name":"' || p_name || '","tm_id":"' || p_brand || '","op":"c"}}' FROM part"""

ORACLES["config_prune_fact"] = f"""
WITH {ORD}
SELECT 'dwd_order_created' AS sink_table,
       '{{"id":"' || id || '","user_id":"' || user_id || '","ts_ms":"' || ts_ms || '"}}' AS payload FROM oc WHERE op = 'c'
UNION ALL
SELECT 'dwd_order_changed', '{{"id":"' || id || '","order_status":"' || status || '","operate_time":"' || operate_time
       || '","ts_ms":"' || ts_ms || '"}}' FROM oc WHERE op = 'u'"""

ORACLES["dim_upsert"] = f"""
WITH {CUST},
live AS (SELECT cu.* FROM cu LEFT JOIN (SELECT k, max(ts_ms) AS del FROM cu WHERE op = 'd' GROUP BY k) d USING (k)
         WHERE op <> 'd' AND (del IS NULL OR ts_ms > del))
SELECT CAST(k AS VARCHAR) AS row_key, CAST(k AS VARCHAR) AS id,
       arg_max(name, ts_ms) FILTER (name <> '') AS name, arg_max(segment, ts_ms) FILTER (segment <> '') AS segment
FROM live GROUP BY k"""

# --- facts

ORACLES["order_detail_fact"] = f"""
WITH {LI},
act AS (SELECT did, CAST(l_suppkey % 5 AS VARCHAR) AS activity_id, CAST(l_suppkey % 3 AS VARCHAR) AS activity_rule_id
        FROM li WHERE l_discount >= 0.05),
cou AS (SELECT did, CAST(l_partkey % 9 AS VARCHAR) AS coupon_id FROM li WHERE l_tax >= 0.04)
SELECT li.did AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(l_partkey AS VARCHAR) AS sku_id, 'sku ' || l_partkey AS sku_name, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
       activity_id, activity_rule_id, coupon_id, {day('ms * 1000')} AS date_id, CAST(ms AS VARCHAR) AS create_time,
       CAST(qty AS VARCHAR) AS sku_num, CAST(CAST(qty AS {M}) * price AS VARCHAR) AS split_original_amount,
       CAST(act_amount AS VARCHAR) AS split_activity_amount, CAST(cou_amount AS VARCHAR) AS split_coupon_amount,
       CAST(CAST(price - act_amount AS {M}) AS VARCHAR) AS split_total_amount, ms AS ts
FROM li JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN act ON li.did = act.did LEFT JOIN cou ON li.did = cou.did"""

DETAIL = f"""
det AS (SELECT l_orderkey, l_partkey, l_orderkey || '-' || l_linenumber AS vid, did, CAST(l_orderkey AS VARCHAR) AS order_id,
   CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id, 'sku ' || l_partkey AS sku_name,
   CAST(l_orderkey % 27 AS VARCHAR) AS province_id, CAST(NULL AS VARCHAR) AS activity_id,
   CAST(NULL AS VARCHAR) AS activity_rule_id, CAST(NULL AS VARCHAR) AS coupon_id,
   CAST(qty AS VARCHAR) AS sku_num, CAST(price AS VARCHAR) AS split_original_amount,
   CAST(act_amount AS VARCHAR) AS split_activity_amount, CAST(cou_amount AS VARCHAR) AS split_coupon_amount,
   CAST(CAST(price - act_amount AS {M}) AS VARCHAR) AS split_total_amount,
   price AS original_amount, act_amount AS activity_reduce_amount, cou_amount AS coupon_reduce_amount,
   CAST(price - act_amount AS {M}) AS order_amount, ms FROM li)"""

KEYS = "order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id"
AMTS = "sku_num, split_original_amount, split_activity_amount, split_coupon_amount"

ORACLES["cancel_fact"] = f"""
WITH {LI}, {DETAIL},
oc AS (SELECT o_orderkey, epoch_ms(o_orderdate) + 600000 AS t FROM orders WHERE o_orderstatus = 'F')
SELECT vid AS id, {KEYS}, {day('t * 1000')} AS date_id, {sec('t * 1000')} AS cancel_time, {AMTS}, split_total_amount, t AS ts
FROM det JOIN oc ON l_orderkey = o_orderkey"""

ORACLES["pay_interval_join"] = f"""
WITH {LI}, {DETAIL},
o AS (SELECT *, epoch_ms(o_orderdate) AS t FROM orders),
paid AS (SELECT o_orderkey, t + 300000 AS pt, left(o_orderpriority, 1) AS p FROM o WHERE o_orderstatus = 'P'),
near AS (SELECT det.*, t - 2400000 + (l_partkey % 3600) * 1000 AS et FROM det JOIN o ON l_orderkey = o_orderkey)
SELECT did AS order_detail_id, {KEYS}, '110' || p AS payment_type_code,
       CASE p WHEN '1' THEN 'alipay' WHEN '2' THEN 'wechat' WHEN '3' THEN 'unionpay' ELSE 'card' END AS payment_type_name,
       CAST(pt + 2000 AS VARCHAR) AS callback_time, {AMTS}, split_total_amount AS split_payment_amount, pt AS ts
FROM paid JOIN near ON o_orderkey = l_orderkey AND et BETWEEN pt - 1800000 AND pt + 5000
WHERE p <> '5'"""

REFUND = """
ri AS (SELECT *, CAST(l_linenumber % 3 + 1 AS VARCHAR) AS rt, CAST(l_partkey % 4 + 1 AS VARCHAR) AS rr FROM li
       WHERE l_returnflag = 'R')"""

ORACLES["refund_fact"] = f"""
WITH {LI}, {REFUND},
oi AS (SELECT o_orderkey, CAST(o_custkey % 25 AS VARCHAR) AS province_id FROM orders WHERE o_orderstatus = 'O'),
both_ops AS (SELECT *, ms AS ts FROM ri UNION ALL SELECT *, ms + 120000 FROM ri)
SELECT did AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(l_partkey AS VARCHAR) AS sku_id, province_id, {day('ms * 1000')} AS date_id, {sec('ms * 1000')} AS create_time,
       '150' || rt AS refund_type_code,
       CASE rt WHEN '1' THEN 'money only' WHEN '2' THEN 'goods and money' ELSE 'exchange' END AS refund_type_name,
       '130' || rr AS refund_reason_type_code,
       CASE rr WHEN '1' THEN 'quality' WHEN '2' THEN 'description' ELSE 'out of stock' END AS refund_reason_type_name,
       'returned' AS refund_reason_txt, CAST(qty AS VARCHAR) AS refund_num, CAST(price AS VARCHAR) AS refund_amount, ts
FROM both_ops JOIN oi ON l_orderkey = o_orderkey WHERE rr <> '4'"""

ORACLES["refund_pay_fact"] = f"""
WITH {LI}, {REFUND},
oi AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id
       FROM orders WHERE o_orderstatus = 'O'),
rp AS (SELECT *, ms + 180000 AS t, CAST(l_linenumber % 5 + 1 AS VARCHAR) AS p FROM ri WHERE l_linestatus = 'F')
SELECT rp.did AS id, user_id, CAST(rp.l_orderkey AS VARCHAR) AS order_id, CAST(rp.l_partkey AS VARCHAR) AS sku_id, province_id,
       '110' || p AS payment_type_code,
       CASE p WHEN '1' THEN 'alipay' WHEN '2' THEN 'wechat' WHEN '3' THEN 'unionpay' ELSE 'card' END AS payment_type_name,
       {day('t * 1000')} AS date_id, {sec('t * 1000')} AS callback_time, CAST(ri.qty AS VARCHAR) AS refund_num,
       CAST(rp.price AS VARCHAR) AS refund_amount, t AS ts
FROM rp JOIN ri ON rp.l_orderkey = ri.l_orderkey AND rp.l_partkey = ri.l_partkey
JOIN oi ON rp.l_orderkey = o_orderkey WHERE p <> '5'"""

ORACLES["comment_dic_left"] = """
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(doc_id % 100 AS VARCHAR) AS user_id, CAST(doc_id % 35 AS VARCHAR) AS sku_id,
       lang AS appraise, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' END AS appraise_name,
       text AS comment_txt, doc_id * 1000 AS ts
FROM documents WHERE n_chars >= 50"""

TOKENS = "unnest(regexp_extract_all(lower(text), '[\\p{L}]+|[\\p{N}]+'))"

ORACLES["sensitive_flag"] = f"""
WITH t AS (SELECT doc_id, {TOKENS} AS word FROM documents),
     w AS (SELECT DISTINCT {TOKENS} AS word FROM benchmark)
SELECT doc_id, count(*) AS words, count(w.word) AS listed_words FROM t LEFT JOIN w ON t.word = w.word GROUP BY doc_id"""

ORACLES["word_list_split"] = f"""
WITH t AS (SELECT role, {TOKENS} AS word FROM conversations),
     w AS (SELECT DISTINCT {TOKENS} AS word FROM benchmark)
SELECT role, word, count(*) AS n, CASE WHEN word IN (SELECT word FROM w) THEN 1 ELSE 0 END AS listed
FROM t GROUP BY role, word"""

# --- windowed metrics

TRAFFIC = f"""{PV},
uv AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY mid, d ORDER BY us) = 1 THEN 1 ELSE 0 END AS u FROM pv),
tw AS (SELECT {window('us', 10)}, vc, ch, ar, is_new, CAST(sum(u) AS BIGINT) AS uv_ct,
   CAST(sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct, count(*) AS pv_ct,
   CAST(sum(during_time) AS BIGINT) AS dur_sum FROM uv GROUP BY ALL)"""

ORACLES["traffic_4key_10s"] = f"WITH {TRAFFIC} SELECT * FROM tw"

HOME = f"""{PV},
f AS (SELECT mid, page_id, d, min(us) AS us FROM pv WHERE page_id IN ('home', 'good_detail') GROUP BY mid, page_id, d)"""

ORACLES["home_detail_uv_3s"] = f"""
WITH {HOME}
SELECT {window('us', 3)}, count(*) FILTER (page_id = 'home') AS home_uv_ct,
       count(*) FILTER (page_id <> 'home') AS good_detail_uv_ct FROM f GROUP BY ALL"""

LOGIN = f"""{PV},
dd AS (SELECT uid, d, min(us) AS us FROM pv
       WHERE coalesce(uid, '') <> '' AND (coalesce(last_page_id, '') = '' OR last_page_id = 'login') GROUP BY uid, d),
g AS (SELECT *, date_diff('day', CAST(lag(d) OVER (PARTITION BY uid ORDER BY d) AS DATE), CAST(d AS DATE)) AS gap FROM dd)"""

ORACLES["user_back_3h"] = f"""
WITH {LOGIN}
SELECT {window('us', 10800)}, count(*) FILTER (gap >= 8) AS back_ct, count(*) AS uu_ct FROM g GROUP BY ALL"""

CART = """
f AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS d, min(epoch_us(ts) // 1000) * 1000 AS us FROM events
      WHERE event_type = 'purchase' GROUP BY ALL)"""

ORACLES["cart_uu_5s"] = f"WITH {CART} SELECT {window('us', 5)}, count(*) AS cart_add_uu_ct FROM f GROUP BY ALL"

KEYWORD = f"""
t AS (SELECT {TOKENS} AS keyword, (1704067200 + conv_id * 10 + turn % 10) * 1000000 AS us FROM conversations)"""

ORACLES["keyword_10s"] = f"WITH {KEYWORD} SELECT {window('us', 10)}, keyword, count(*) AS keyword_count FROM t GROUP BY ALL"
ORACLES["keyword_sql"] = ORACLES["keyword_10s"]

# costs are lists by word length for each place of a run; both folds go over a list whose first entry is the start value
ORACLES["keyword_lattice"] = r"""
WITH listed AS MATERIALIZED (
  SELECT w, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+|\p{N}+')) AS w FROM documents)
  WHERE length(w) <= 16 GROUP BY w ORDER BY freq DESC, w LIMIT 50000),
total AS (SELECT sum(freq)::DOUBLE AS t FROM listed),
costs AS MATERIALIZED (SELECT w, CAST(round_even(1000 * (ln(t) - ln(freq::DOUBLE)), 0) AS BIGINT) AS cost FROM listed, total),
alone AS (SELECT CAST(round_even(1000 * (ln(t) - ln(0.5)), 0) AS BIGINT) AS unknown FROM total),
runs AS MATERIALIZED (
  SELECT run, count(*) AS times FROM (
    SELECT unnest(regexp_extract_all(lower(regexp_replace(text, '[ \t]', '', 'g')), '\p{L}+|\p{N}+')) AS run FROM documents) GROUP BY run),
letters AS MATERIALIZED (
  SELECT run, times, i, string_agg(c, '') OVER (PARTITION BY run ORDER BY i ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING) AS ahead
  FROM (SELECT run, times, generate_subscripts(string_split(run, ''), 1) AS i, unnest(string_split(run, '')) AS c FROM runs)),
starts AS (SELECT run, times, i, s, ahead[:s] AS w FROM letters, range(1, 17) r(s) WHERE s <= length(ahead)),
edges AS MATERIALIZED (
  SELECT run, times, i, s, w, coalesce(cost, CASE WHEN s = 1 THEN unknown END) AS cost, cost IS NOT NULL AS known
  FROM starts LEFT JOIN costs USING (w), alone),
places AS (SELECT run, times, i, list(coalesce(cost, 1152921504606846976) ORDER BY s) AS by_size FROM edges GROUP BY ALL),
best AS (
  SELECT run, times, list(by_size ORDER BY i) AS places,
    list_reduce(list_prepend([CAST(0 AS BIGINT)], list(by_size ORDER BY i DESC)),
      lambda a, x: list_prepend(list_min(list_transform(x, lambda c, s: c + a[s])), a)) AS b
  FROM places GROUP BY run, times),
steps AS (
  SELECT run, times, unnest(places) AS x, unnest(b[1:len(b) - 1]) AS lowest, generate_subscripts(places, 1) AS i, b FROM best),
sized AS (
  SELECT run, times, i, list_max(list_filter(list_transform(x, lambda c, s: CASE WHEN c + b[i + s] = lowest THEN s END), lambda s: s IS NOT NULL)) AS step FROM steps),
cuts AS (
  SELECT run, times, list_reduce(list_prepend([CAST(1 AS BIGINT)], list([i, step] ORDER BY i)),
      lambda a, x: CASE WHEN a[1] = x[1] THEN list_prepend(x[1] + x[2], a) ELSE a END) AS marks FROM sized GROUP BY run, times),
smart AS (SELECT times, substr(run, i, til - i) AS word FROM (SELECT times, run, unnest(marks[2:len(marks)]) AS i, unnest(marks[1:len(marks) - 1]) AS til FROM cuts)),
reached AS (SELECT run, i, max(CASE WHEN known THEN i + s END) AS reach, bool_or(known) AS begins FROM edges GROUP BY ALL),
uncovered AS (
  SELECT run, i FROM (SELECT run, i, max(reach) OVER (PARTITION BY run ORDER BY i) AS far FROM reached) WHERE far IS NULL OR far <= i),
fine AS (
  SELECT times, w AS word FROM edges WHERE known
  UNION ALL SELECT times, w FROM edges JOIN uncovered USING (run, i) WHERE s = 1)
SELECT 'smart' AS mode, word, CAST(sum(times) AS BIGINT) AS n FROM smart GROUP BY word
UNION ALL SELECT 'fine', word, CAST(sum(times) AS BIGINT) FROM fine GROUP BY word"""

NEWEST = f"""{LI}, {DETAIL},
nw AS (SELECT * FROM det QUALIFY row_number() OVER (PARTITION BY vid ORDER BY ms DESC, order_id DESC, sku_id DESC,
   province_id DESC, original_amount DESC, activity_reduce_amount DESC, coupon_reduce_amount DESC, order_amount DESC) = 1)"""

ORACLES["retract_dedup"] = f"""
WITH {NEWEST}
SELECT vid AS id, order_id, sku_id, province_id, ms AS ts, CAST(original_amount AS DOUBLE) AS original_amount,
   CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
   CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount, CAST(order_amount AS DOUBLE) AS order_amount FROM nw"""

SKU = f"""{NEWEST},
sw AS (SELECT {window('ms * 1000', 10)}, sku_id, CAST(sum(original_amount) AS DOUBLE) AS original_amount,
   CAST(sum(activity_reduce_amount) AS DOUBLE) AS activity_reduce_amount,
   CAST(sum(coupon_reduce_amount) AS DOUBLE) AS coupon_reduce_amount,
   CAST(sum(order_amount) AS DOUBLE) AS order_amount FROM nw GROUP BY ALL),
sd AS (SELECT stt, edt, cur_date, p_brand AS trademark_id, CASE WHEN p_brand <> 'Brand#2' THEN upper(p_brand) END AS trademark_name,
   c1.id AS category1_id, c1.name AS category1_name, CAST(n_regionkey AS VARCHAR) AS category2_id, r_name AS category2_name,
   CAST(p_size % 25 AS VARCHAR) AS category3_id, n_name AS category3_name, sku_id, p_name AS sku_name, p_type AS spu_id,
   lower(p_type) AS spu_name, original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount
 FROM sw LEFT JOIN part ON sku_id = CAST(p_partkey AS VARCHAR)
 LEFT JOIN nation ON p_size % 25 = n_nationkey AND n_nationkey < 24
 LEFT JOIN region ON n_regionkey = r_regionkey
 LEFT JOIN (SELECT CAST(r_regionkey % 2 AS VARCHAR) AS id, min(r_name) AS name FROM region GROUP BY 1) c1
        ON CAST(r_regionkey % 2 AS VARCHAR) = c1.id)"""

ORACLES["sku_order_10s"] = f"WITH {SKU} SELECT * FROM sd"

ORACLES["missing_dimension_rows"] = f"""
WITH {SKU}
SELECT count(*) FILTER (sku_name IS NULL) AS missing_sku_name, count(*) FILTER (trademark_name IS NULL) AS missing_trademark_name,
       count(*) FILTER (category3_name IS NULL) AS missing_category3_name,
       count(*) FILTER (category1_name IS NULL) AS missing_category1_name FROM sd"""

PROVINCE = f"""{NEWEST},
pw AS (SELECT {window('ms * 1000', 10)}, province_id, count(DISTINCT order_id) AS order_count,
   sum(order_amount) AS amount FROM nw GROUP BY ALL),
pd AS (SELECT stt, edt, cur_date, province_id, n_name AS province_name, order_count, amount
   FROM pw LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR))"""

ORACLES["province_order_10s"] = f"""
WITH {PROVINCE}
SELECT stt, edt, cur_date, province_id, province_name, order_count, CAST(amount AS DOUBLE) AS order_amount FROM pd"""

# --- reports

ORACLES["gmv_day"] = f"WITH {PROVINCE} SELECT cur_date, CAST(sum(amount) AS DOUBLE) AS order_amount FROM pd GROUP BY cur_date"

ORACLES["province_gmv_day"] = f"""
WITH {PROVINCE}
SELECT cur_date, province_name, CAST(sum(amount) AS DOUBLE) AS order_amount FROM pd GROUP BY cur_date, province_name"""

TOP = f"""{TRAFFIC},
ch_uv AS (SELECT cur_date, ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct FROM tw GROUP BY cur_date, ch),
tops AS (SELECT * FROM ch_uv QUALIFY row_number() OVER (PARTITION BY cur_date ORDER BY uv_ct DESC, ch) <= 3)"""

ORACLES["channel_uv_topn"] = f"WITH {TOP} SELECT * FROM tops"

ORACLES["chart_payload"] = f"""
WITH {PROVINCE},
g AS (SELECT cur_date, province_name, sum(amount) AS a FROM pd GROUP BY cur_date, province_name)
SELECT cur_date, '{{"status":0,"data":{{"mapData":[' || string_agg(
   CASE WHEN province_name IS NULL THEN '{{"value":' || a || '}}'
        ELSE '{{"name":"' || province_name || '","value":' || a || '}}' END, ',' ORDER BY province_name NULLS FIRST)
   || '],"valueName":"交易额"}}}}' AS payload FROM g GROUP BY cur_date"""

ORACLES["channel_payload"] = f"""
WITH {TOP}
SELECT cur_date, '{{"status":0,"data":{{"categories":[' || string_agg('"' || ch || '"', ',' ORDER BY uv_ct DESC, ch)
   || '],"series":[{{"name":"渠道","data":[' || string_agg(CAST(uv_ct AS VARCHAR), ',' ORDER BY uv_ct DESC, ch) || ']}}]}}}}' AS payload
FROM tops GROUP BY cur_date"""

# --- scalar functions

ORACLES["hash_bucket"] = """
WITH o AS (SELECT o_orderkey, o_custkey, '0x' || o_custkey AS a FROM orders)
SELECT o_orderkey, lpad(CAST(CAST('0x' || right(md5(CAST(o_custkey AS VARCHAR)), 3) AS INTEGER) % 100 AS VARCHAR), 4, '0') AS bucket,
  CASE WHEN o_custkey % 10 = 0 THEN '900' || (o_custkey % 7 + 1)
       ELSE lpad(CAST(CAST('0x' || right(md5(a), 3) AS INTEGER) % 128 AS VARCHAR), 4, '0') END AS address_bucket FROM o"""

ORACLES["rowkey"] = """
SELECT o_orderkey, o_custkey || '_' || o_orderstatus AS plain_key,
       md5(CAST(o_custkey AS VARCHAR)) || '|' || o_orderpriority AS part_key,
       md5(o_orderkey || '-' || o_custkey) AS hashed_key FROM orders"""

ORACLES["hex_decimal"] = """
WITH o AS (SELECT *, o_orderkey * 1000003 + 1 AS n,
             CAST(CAST(o_custkey + 1 AS HUGEINT) * 1152921504606846976 + (o_orderkey * 1000003 + 1) AS VARCHAR) AS w FROM orders)
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '0' ELSE CAST(n AS VARCHAR) END AS narrow, w AS wide,
       CASE WHEN o_orderkey % 2 = 0 THEN '115792089237316195423570985008687907853269984665640564039457584007913129639935'
            ELSE CAST(n AS VARCHAR) END AS word,
       CASE WHEN o_orderkey % 2 = 0 THEN n || '000' WHEN n % 1000 = 0 THEN CAST(n // 1000 AS VARCHAR)
            ELSE (n // 1000) || '.' || rtrim(lpad(CAST(n % 1000 AS VARCHAR), 3, '0'), '0') END AS power,
       (o_orderkey // 1000) || CASE WHEN o_orderkey % 1000 = 0 THEN ''
          ELSE '.' || rtrim(lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), '0') END AS ether FROM o"""

ORACLES["hex_words"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber WHEN 1 THEN ''
   WHEN 2 THEN '0x' || lpad(printf('%x', l_orderkey), 64, '0')
   ELSE '0x' || lpad(printf('%x', l_orderkey), 64, '0') || ',0x' || lpad(printf('%x', l_partkey), 64, '0') END AS words
FROM lineitem"""

ORACLES["json_list_append"] = """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '["' || p_name || '"]'
   ELSE '["' || p_brand || '","' || p_type || '","' || p_name || '"]' END AS list FROM part"""

ORACLES["string_kit"] = """
WITH p AS (SELECT *, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE 'null' END AS b FROM part)
SELECT p_partkey, p_name || ', ' || b || ', ' || p_type AS csv, p_name || '|' || b || '|' || p_type AS joined,
       upper(p_name[1]) || p_name[2:] AS capital, lower(p_type[1]) || p_type[2:] AS lowered,
       repeat('0', p_size % 5) AS zeros, CASE WHEN p_size % 4 < 2 THEN 1 ELSE 0 END AS empty,
       CASE WHEN p_size % 4 < 3 THEN 1 ELSE 0 END AS blank FROM p"""

ORACLES["charset_check"] = """
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\n]+')) AS w FROM documents)
SELECT doc_id, CASE WHEN regexp_full_match(w, '[一-龥a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!—·~@#$%^&*(、，。；‘【】！￥…（）)"]+') THEN 1 ELSE 0 END AS ok,
       count(*) AS n FROM w GROUP BY ALL"""

ORACLES["day_range"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey % 6 - 1 AS INTEGER) AS n FROM orders)
SELECT o_orderkey, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS day,
       coalesce((SELECT string_agg(strftime(d + CAST(i AS INTEGER), '%Y%m%d'), ',' ORDER BY i)
                 FROM range(0, 6) r(i) WHERE i <= n), '') AS days FROM o"""

ORACLES["epoch_pick"] = f"""
SELECT event_id, {sec('(epoch_us(ts) // 1000000 - CASE WHEN event_id % 3 = 0 THEN 86400 ELSE 0 END) * 1000000')} AS event_time,
       {sec('epoch_us(ts)')} AS window_start FROM events"""

ORACLES["date_labels"] = f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second,
       strftime(ts, '%Y%m%d') AS "partition", epoch_us(ts) // 1000000 * 1000 AS second_ms,
       epoch_us(ts) // 86400000000 * 86400000 AS day_ms, strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_text FROM events"""

ORACLES["file_partition_day"] = """
SELECT CASE WHEN event_id % 8 IN (0, 7) AND event_id % 11 <> 0 THEN strftime(ts, '%Y%m%d') ELSE 'error_bucket' END AS bucket,
       count(*) AS lines FROM events GROUP BY 1"""

# --- streams: the same answers

for same in ("traffic_4key_10s", "home_detail_uv_3s", "user_back_3h", "cart_uu_5s", "keyword_10s", "sku_order_10s",
             "province_order_10s", "first_of_day", "isnew_repair", "comment_dic_left", "cart_delta",
             "pay_interval_join", "dim_upsert", "config_prune_fact", "file_partition_day"):
    ORACLES[f"{same}_stream"] = ORACLES[same]

ORACLES["cancel_fact_stream"] = ORACLES["cancel_fact"].replace("SELECT vid AS id", "SELECT did AS id")



def newest_by_id(sql: str, *ties: str) -> str:
    """One row per id; ids repeat in the given tables."""
    order = ", ".join(f"{c} DESC" for c in ("ts", *ties))
    return f"SELECT * FROM ({sql}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1"


NEAR_LI = LI.replace("epoch_ms(l_shipdate) + (l_partkey % 600)", "epoch_ms(o_orderdate) + 900000 + (l_partkey % 600)").replace(
    "FROM lineitem)", "FROM lineitem JOIN (SELECT o_orderkey AS k, o_orderdate FROM orders) ON l_orderkey = k)")
for near in ("refund_fact", "refund_pay_fact"):
    ORACLES[f"{near}_stream"] = ORACLES[near].replace(LI, NEAR_LI)
ORACLES["file_rolled_day_stream"] = ORACLES["file_partition_day"].replace("AS lines", "AS lines, 1 AS files")

ORACLES["order_detail_upsert_stream"] = newest_by_id(
    ORACLES["order_detail_fact"], "order_id", "sku_id", "sku_name", "create_time", "sku_num", "split_original_amount",
    "split_activity_amount", "split_coupon_amount", "split_total_amount")

NEAR_MS = "epoch_ms(o_orderdate) + (l_partkey % 600) * 1000"
ORACLES["order_detail_fact_stream"] = ORACLES["order_detail_fact"].replace("ms AS ts\n", f"{NEAR_MS} AS ts\n")

ORACLES["refund_upsert_stream"] = newest_by_id(
    ORACLES["refund_fact"], "user_id", "order_id", "sku_id", "refund_reason_txt", "refund_num", "refund_amount",
    "refund_type_code", "refund_reason_type_code", "create_time")

ORACLES["refund_pay_upsert_stream"] = newest_by_id(ORACLES["refund_pay_fact"].replace(  # of several refunds of an order and sku the newest
    "JOIN ri ON", "JOIN (SELECT * FROM ri QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY ms DESC, CAST(qty AS VARCHAR) DESC) = 1) ri ON"),
    "order_id", "sku_id", "payment_type_code", "callback_time", "refund_amount")
ORACLES["comment_upsert_stream"] = ORACLES["comment_dic_left"]
ORACLES["dictionary_refresh_stream"] = ORACLES["comment_dic_left"].replace(
    "CASE lang", "CASE WHEN doc_id > 100 THEN CASE lang WHEN 'en' THEN 'British' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END ELSE CASE lang").replace(
    "'German' END AS", "'German' END END AS")
ORACLES["cart_upsert_stream"] = newest_by_id(ORACLES["cart_delta"], "user_id", "sku_id", "sku_num")
ORACLES["cancel_upsert_stream"] = f"""
WITH d AS ({ORACLES["order_detail_upsert_stream"]}),
oc AS (SELECT CAST(o_orderkey AS VARCHAR) AS o, epoch_ms(o_orderdate) + 600000 AS t FROM orders WHERE o_orderstatus = 'F')
SELECT id, {KEYS}, {day('t * 1000')} AS date_id, {sec('t * 1000')} AS cancel_time, {AMTS}, split_total_amount, t AS ts FROM d JOIN oc ON order_id = o"""
ORACLES["pay_upsert_stream"] = f"""
WITH d AS ({newest_by_id(ORACLES["order_detail_fact_stream"], "order_id", "sku_id", "sku_name", "create_time", "sku_num", "split_original_amount",
                         "split_activity_amount", "split_coupon_amount", "split_total_amount")}),
paid AS (SELECT CAST(o_orderkey AS VARCHAR) AS o, epoch_ms(o_orderdate) + 300000 AS pt, left(o_orderpriority, 1) AS p FROM orders WHERE o_orderstatus = 'P')
SELECT id AS order_detail_id, {KEYS}, '110' || p AS payment_type_code,
       CASE p WHEN '1' THEN 'alipay' WHEN '2' THEN 'wechat' WHEN '3' THEN 'unionpay' ELSE 'card' END AS payment_type_name,
       CAST(pt + 2000 AS VARCHAR) AS callback_time, {AMTS}, split_total_amount AS split_payment_amount, pt AS ts
FROM d JOIN paid ON order_id = o AND ts BETWEEN pt - 1800000 AND pt + 5000 WHERE p <> '5'"""

ORACLES["sku_ingest_stream"] = f"""
WITH {NEWEST},
arrived AS (SELECT *, CASE WHEN ms <= 803347200000 THEN 0 ELSE 3600000000 END AS us FROM nw)
SELECT {window('us', 10)}, sku_id, CAST(sum(original_amount) AS DOUBLE) AS original_amount,
   CAST(sum(activity_reduce_amount) AS DOUBLE) AS activity_reduce_amount, CAST(sum(coupon_reduce_amount) AS DOUBLE) AS coupon_reduce_amount,
   CAST(sum(order_amount) AS DOUBLE) AS order_amount FROM arrived GROUP BY ALL"""

ORACLES["retract_stream"] = f"""
WITH {NEWEST}
SELECT vid AS id, CAST(original_amount AS DOUBLE) AS original_amount, CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
   CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount, CAST(order_amount AS DOUBLE) AS order_amount, 1 AS lines FROM nw"""

ORACLES["bad_amounts"] = f"""
WITH {LI}, {DETAIL}
SELECT 'measured' AS feed, count(*) AS n, CAST(sum(order_amount) AS DOUBLE) AS order_amount FROM det WHERE l_partkey % 10 <> 0
UNION ALL SELECT 'dirty', count(*), NULL FROM det WHERE l_partkey % 10 = 0"""

ORACLES["dim_scan_delete"] = """
SELECT CAST(p_partkey AS VARCHAR) AS row_key, CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, p_brand AS tm_id,
       count(*) OVER () AS n_rows FROM part WHERE p_partkey % 3 <> 0"""

ORACLES["dim_config_change_stream"] = f"""
WITH {CUST},
after AS (SELECT * FROM cu WHERE ts_ms >= (SELECT max(c_custkey) * 5 FROM customer)),
live AS (SELECT a.* FROM after a LEFT JOIN (SELECT k, max(ts_ms) AS del FROM after WHERE op = 'd' GROUP BY k) d USING (k)
         WHERE op <> 'd' AND (del IS NULL OR ts_ms > del))
SELECT CAST(k AS VARCHAR) AS row_key, CAST(k AS VARCHAR) AS id, arg_max(segment, ts_ms) FILTER (segment <> '') AS segment
FROM live GROUP BY k"""

ORACLES["gmv_stored"] = f"""
WITH {PROVINCE}
SELECT cur_date, CAST(sum(amount) AS DOUBLE) AS order_amount FROM pd WHERE cur_date = (SELECT max(cur_date) FROM pd) GROUP BY cur_date"""

ORACLES["channel_uv_stored"] = f"WITH {TOP} SELECT * FROM tops WHERE cur_date = (SELECT max(cur_date) FROM tw)"

ORACLES["log_split_stream"] = f"""
WITH {log_records('event_id % 13 <> 0')} {FEED_ROWS}
UNION ALL SELECT 'dirty', NULL, NULL, NULL, '20' FROM events WHERE event_id % 13 = 0"""

ORACLES["upsert_detail_stream"] = f"""
WITH {LI}, {DETAIL}
SELECT vid AS id, sku_id, sku_num, split_original_amount, split_total_amount, ms AS ts FROM det
QUALIFY row_number() OVER (PARTITION BY vid ORDER BY ms DESC, sku_id DESC, split_original_amount DESC,
   split_total_amount DESC, split_coupon_amount DESC, sku_num DESC) = 1"""
