"""The same results as plain SQL over the given tables, for an independent engine."""

from __future__ import annotations

from strataflow.catalog.views import dictionary_values

ORIGIN = "TIMESTAMP '1970-01-01'"


def _day(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d')"


def _second(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def _bounds(moment: str, size: str) -> str:
    start = f"time_bucket(INTERVAL '{size}', {moment}, {ORIGIN})"
    return f"{_second(start)} AS stt, {_second(f'{start} + INTERVAL {size!r}')} AS edt"


def _txt(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def _money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(16,2))"


LOG = """
log AS (
  SELECT *, CASE WHEN k % 2 = 1 THEN '1' ELSE '0' END AS is_new,
    CASE WHEN kind IN ('signup', 'view') THEN 'home' WHEN kind = 'click' THEN 'good_detail'
         WHEN kind = 'purchase' THEN 'payment' ELSE 'cart' END AS page_id,
    CASE kind WHEN 'view' THEN 'home' WHEN 'click' THEN 'search' WHEN 'purchase' THEN 'login'
         WHEN 'error' THEN 'cart' END AS last_page_id,
    kind = 'error' AND k % 2 = 0 AS is_start, strftime(ts, '%Y-%m-%d') AS day
  FROM (SELECT event_id AS log_id, epoch_us(ts) // 1000 AS ms, ts, CAST(user_id AS VARCHAR) AS mid,
          CAST(user_id % 3 AS VARCHAR) AS vc, CAST(user_id % 4 AS VARCHAR) AS ch, CAST(user_id % 5 AS VARCHAR) AS ar,
          event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
),
page AS (SELECT * FROM log WHERE NOT is_start),
fixed AS (
  SELECT * EXCLUDE (is_new, fd),
    CASE WHEN is_new = '1' AND day <> fd THEN '0' ELSE is_new END AS is_new
  FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN day ELSE strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') END)
          OVER (PARTITION BY mid ORDER BY ms, is_new DESC, log_id) AS fd FROM log)
),
uv AS (SELECT * FROM page QUALIFY row_number() OVER (PARTITION BY mid, day ORDER BY ms, log_id) = 1),
followed AS (
  SELECT *, lead(ms) OVER w AS next_ms, lead(coalesce(last_page_id, '') = '') OVER w AS next_entry
  FROM page WINDOW w AS (PARTITION BY mid ORDER BY ms, log_id)
),
uj AS (SELECT * FROM followed WHERE coalesce(last_page_id, '') = ''
         AND (next_ms IS NULL OR next_ms - ms >= 10800000 OR next_entry)),
uj_timeout AS (SELECT * FROM followed WHERE coalesce(last_page_id, '') = ''
         AND (next_ms IS NULL OR next_ms - ms >= 10800000))
"""

DIC = f"dic(code, name) AS (SELECT * FROM (VALUES {dictionary_values()}) AS v(code, name))"

LINES = f"""
raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, l.*, {_money('l_extendedprice')} AS price,
    {_txt('CAST(l_quantity AS INTEGER)')} AS num FROM lineitem l
),
od AS (
  SELECT id, {_txt('l_orderkey')} AS order_id, {_txt('l_partkey')} AS sku_id, 'sku ' || l_partkey AS sku_name,
    num AS sku_num, {_second('l_shipdate')} AS create_time, '240' || (l_linenumber % 4 + 1) AS source_type,
    {_txt('l_suppkey')} AS source_id, {_txt('price')} AS split_total_amount,
    {_txt(_money('price * ' + _money('l_discount')))} AS split_activity_amount,
    {_txt(_money('price * ' + _money('l_tax')))} AS split_coupon_amount,
    {_txt('price * ' + _money('num'))} AS split_original_amount, CAST(epoch(l_shipdate) AS BIGINT) AS od_ts
  FROM raw
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY od_ts DESC, sku_id DESC, sku_name DESC, sku_num DESC,
    create_time DESC, source_type DESC, source_id DESC, split_total_amount DESC) = 1
),
act AS (
  SELECT id AS act_id, {_txt('l_suppkey % 7')} AS activity_id, {_txt('l_partkey % 11')} AS activity_rule_id
  FROM raw WHERE l_discount > 0.05
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC, activity_id DESC, activity_rule_id DESC) = 1
),
cou AS (
  SELECT id AS cou_id, {_txt('l_suppkey % 13')} AS coupon_id FROM raw WHERE l_tax > 0.04
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC, coupon_id DESC) = 1
),
oi AS (
  SELECT {_txt('o_orderkey')} AS oi_id, {_txt('o_custkey')} AS user_id, {_txt('o_custkey % 25')} AS province_id,
    coalesce(st, '1001') AS order_status, CASE WHEN st IS NOT NULL THEN {_second('moment')} END AS operate_time,
    CASE WHEN st IS NULL THEN 'insert' ELSE 'update' END AS type,
    CASE WHEN st IS NOT NULL THEN '1001' END AS old_status, CAST(epoch(moment) AS BIGINT) AS oi_ts, moment
  FROM (
    SELECT o.*, s.st, o_orderdate + to_hours(s.h) AS moment FROM orders o
    JOIN (VALUES (NULL, 0, 'FPO'), ('1003', 1, 'F'), ('1005', 2, 'PO'), ('1006', 3, 'O')) AS s(st, h, kinds)
      ON contains(s.kinds, o.o_orderstatus))
),
{DIC},
pre AS (
  SELECT od.id, od.order_id, oi.user_id, oi.order_status, od.sku_id, od.sku_name, oi.province_id, act.activity_id,
    act.activity_rule_id, cou.coupon_id, substr(od.create_time, 1, 10) AS date_id, od.create_time,
    substr(oi.operate_time, 1, 10) AS operate_date_id, oi.operate_time, od.source_id, od.source_type,
    dic.name AS source_type_name, od.sku_num, od.split_original_amount, od.split_activity_amount,
    od.split_coupon_amount, od.split_total_amount, oi.type, oi.old_status, {_txt('od.od_ts')} AS od_ts,
    {_txt('oi.oi_ts')} AS oi_ts
  FROM od JOIN oi ON od.order_id = oi.oi_id JOIN dic ON od.source_type = dic.code
    LEFT JOIN act ON od.id = act.act_id LEFT JOIN cou ON od.id = cou.cou_id
),
detail AS (
  SELECT * EXCLUDE (order_status, operate_date_id, operate_time, type, old_status, oi_ts, source_type, od_ts),
    source_type AS source_type_code, od_ts AS ts FROM pre WHERE type = 'insert'
),
ri AS (
  SELECT id, {_txt('l_suppkey')} AS user_id, {_txt('l_orderkey')} AS order_id, {_txt('l_partkey')} AS sku_id,
    '150' || (l_linenumber % 3 + 1) AS refund_type_code, num AS refund_num, {_txt('price')} AS refund_amount,
    CASE WHEN l_linestatus = 'O' THEN '1301' ELSE '1302' END AS refund_reason_type_code,
    'line ' || id AS refund_reason_txt, {_second('l_shipdate')} AS create_time,
    CAST(epoch(l_shipdate) AS BIGINT) AS moment
  FROM raw WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY moment DESC, user_id DESC, order_id DESC, sku_id DESC,
    refund_num DESC, refund_amount DESC, refund_reason_txt DESC, create_time DESC, refund_type_code DESC,
    refund_reason_type_code DESC) = 1
),
asked AS (
  SELECT id, num AS refund_num, {_txt('l_orderkey')} AS ri_order, {_txt('l_partkey')} AS ri_sku
  FROM raw WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC, num DESC, ri_order DESC, ri_sku DESC) = 1
),
rp AS (
  SELECT id, {_txt('l_orderkey')} AS order_id, {_txt('l_partkey')} AS sku_id,
    {_second('l_shipdate + INTERVAL 1 DAY')} AS callback_time, '110' || (l_suppkey % 5 + 1) AS payment_type_code,
    {_txt('price')} AS refund_amount, CAST(epoch(l_shipdate + INTERVAL 1 DAY) AS BIGINT) AS moment
  FROM raw WHERE l_returnflag = 'R' AND l_linestatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY moment DESC, order_id DESC, sku_id DESC, callback_time DESC,
    payment_type_code DESC, refund_amount DESC) = 1
)
"""

ORDER_LINES = f"""
lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, l_orderkey AS order_id, {_txt('l_partkey')} AS sku_id,
    {_txt('o_custkey % 25')} AS province_id, l_shipdate, o_orderdate + to_seconds(l_linenumber) AS moment,
    {_money('l_extendedprice')} AS order_amount,
    {_money(_money('l_extendedprice') + ' * ' + _money('l_quantity'))} AS original_amount,
    {_money(_money('l_extendedprice') + ' * ' + _money('l_discount'))} AS activity_amount,
    CASE WHEN l_tax > 0.04 THEN {_money(_money('l_extendedprice') + ' * ' + _money('l_tax'))} ELSE 0 END AS coupon_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
)
"""

DIMS = f"""
sku AS (
  SELECT {_txt('p_partkey')} AS id, {_txt('p_partkey % 100')} AS spu_id, p_name AS sku_name,
    split_part(p_brand, '#', 2) AS tm_id, p_type AS category3_id FROM part WHERE p_partkey % 100 <> 99
),
tm AS (SELECT DISTINCT split_part(p_brand, '#', 2) AS id, p_brand AS tm_name FROM part),
c3 AS (SELECT DISTINCT p_type AS id, lower(p_type) AS name, {_txt('length(p_type) % 3')} AS category2_id FROM part),
c2 AS (SELECT DISTINCT {_txt('length(p_type) % 3')} AS id, 'group ' || (length(p_type) % 3) AS name,
         {_txt('length(p_type) % 3 % 2')} AS category1_id FROM part),
c1 AS (SELECT DISTINCT {_txt('length(p_type) % 3 % 2')} AS id, 'root ' || (length(p_type) % 3 % 2) AS name FROM part)
"""

CATEGORY_JOINS = """LEFT JOIN tm ON a.trademark_id = tm.id LEFT JOIN c3 ON a.category3_id = c3.id
  LEFT JOIN c2 ON c3.category2_id = c2.id LEFT JOIN c1 ON c2.category1_id = c1.id"""


def _amount(name: str) -> str:
    return f"round(CAST(sum({name}) AS DOUBLE), 2) AS {name}"


SKU_WINDOW = f"""
agg AS (
  SELECT {_bounds('moment', '7 days')}, sku_id, count(DISTINCT order_id) AS order_count,
    {', '.join(_amount(n) for n in ('original_amount', 'activity_amount', 'coupon_amount', 'order_amount'))}
  FROM lines GROUP BY ALL
),
sku_window AS (
  SELECT a.stt, a.edt, a.trademark_id, tm.tm_name AS trademark_name, c2.category1_id, c1.name AS category1_name,
    c3.category2_id, c2.name AS category2_name, a.category3_id, c3.name AS category3_name, a.sku_id, a.sku_name,
    a.spu_id, s_name AS spu_name, order_count, original_amount, activity_amount, coupon_amount, order_amount
  FROM (SELECT agg.*, sku.spu_id, sku.sku_name, sku.tm_id AS trademark_id, sku.category3_id
        FROM agg LEFT JOIN sku ON agg.sku_id = sku.id) a
  LEFT JOIN supplier ON a.spu_id = {_txt('s_suppkey')} {CATEGORY_JOINS}
)
"""

TRAFFIC = f"""
traffic AS (
  SELECT {_bounds('ts', '1 hour')}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
    CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct
  FROM (
    SELECT ts, vc, ch, ar, is_new, 0 AS uv, CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv, 1 AS pv,
      k * 100 AS dur, 0 AS uj FROM page
    UNION ALL SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM uv
    UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM uj)
  GROUP BY ALL
)
"""


def _first_ever(rows: str, unique: str, new: str) -> str:
    return f"""
    WITH rows AS ({rows}),
    days AS (SELECT u, {_day('moment')} AS day, min(moment) AS moment FROM rows GROUP BY ALL)
    SELECT {_bounds('moment', '1 hour')}, count(*) AS {unique}, CAST(sum(is_first) AS BIGINT) AS {new}
    FROM (SELECT *, CASE WHEN day = min(day) OVER (PARTITION BY u) THEN 1 ELSE 0 END AS is_first FROM days)
    GROUP BY ALL"""


REGISTERED = "to_timestamp(1704067200 + c_custkey * 7919 % 2592000)::TIMESTAMP"
REGISTERED = "make_timestamp((1704067200 + c_custkey * 7919 % 2592000) * 1000000)"

SKU_CHANGES = f"""
sku_rows AS (
  SELECT p.*, CASE WHEN later THEN 'update' ELSE 'insert' END AS kind,
    CASE WHEN later THEN p_name || ' v2' ELSE p_name END AS new_name
  FROM part p JOIN (VALUES (false), (true)) AS b(later) ON NOT later OR p_size > 25
)
"""

PAGE_FIELDS = "log_id, mid, mid AS uid, page_id, ms AS ts"

ORACLE: dict[str, str] = {
    "json_wellformed": """
      SELECT event_id AS log_id, true AS is_object FROM events
      UNION ALL SELECT -doc_id - 1, coalesce(json_valid(text) AND ltrim(text) LIKE '{%', false) FROM documents""",
    "json_fields": f"""WITH {LOG} SELECT log_id, mid, is_new, CASE WHEN NOT is_start THEN page_id END AS page_id,
      CASE WHEN NOT is_start THEN last_page_id END AS last_page_id, CASE WHEN NOT is_start THEN k * 100 END AS during_time,
      CASE WHEN kind = 'view' THEN 2 END AS displays, ms AS ts FROM log""",
    "cdc_table_filter": f"""SELECT {_txt('o_orderkey')} AS id, {_txt('o_custkey')} AS user_id,
      CAST(epoch(o_orderdate) AS BIGINT) AS ts FROM orders""",
    "cdc_upsert_filter": f"""WITH {LINES}, {SKU_CHANGES}
      SELECT 'order_info' AS "table", type, count(*) AS n FROM oi GROUP BY ALL
      UNION ALL SELECT 'base_province', 'bootstrap-insert', count(*) FROM nation
      UNION ALL SELECT 'sku_info', kind, count(*) FROM sku_rows GROUP BY ALL""",
    "cdc_changed_column": f"""WITH {LINES} SELECT oi_id AS id, operate_time AS cancel_time, old_status, oi_ts AS ts
      FROM oi WHERE order_status = '1003'""",
    "cdc_cart_delta": f"""WITH {LINES} SELECT * FROM (
      SELECT id, CASE WHEN l_linenumber = 1 THEN 'insert' ELSE 'update' END AS type,
        CASE WHEN l_linenumber = 1 THEN num
             WHEN l_linenumber < 7 AND CAST(num AS INTEGER) > l_partkey % 50 + 1
               THEN {_txt('CAST(num AS INTEGER) - (l_partkey % 50 + 1)')} END AS added,
        CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM raw) WHERE added IS NOT NULL""",
    "log_split_counts": f"""WITH {LOG}
      SELECT 'err' AS branch, count(*) AS n FROM log WHERE kind = 'error'
      UNION ALL SELECT 'start', count(*) FROM log WHERE is_start
      UNION ALL SELECT 'display', 2 * count(*) FROM log WHERE kind = 'view'
      UNION ALL SELECT 'action', count(*) FROM log WHERE kind IN ('click', 'purchase')
      UNION ALL SELECT 'page', count(*) FROM page""",
    "log_split_messages": f"""WITH {LOG}, m AS (
        SELECT *, 'os ' || (k % 3) AS os, CASE WHEN NOT is_start THEN page_id END AS pid, CASE WHEN NOT is_start THEN {_txt('k + 7')} END AS refer,
          CASE WHEN kind = 'click' THEN {_txt('k')} END AS own_item, {_txt('k')} AS kt, {_txt('ms')} AS mt FROM fixed),
      rows AS (
        SELECT 'err' AS branch, mid, is_new, os, pid AS page_id, refer, own_item AS item, NULL AS rank, NULL AS extra, kt AS sdk, kt AS error_code,
          CASE WHEN is_start THEN kt END AS loading_time, mt AS ts FROM m WHERE kind = 'error'
        UNION ALL SELECT 'start', mid, is_new, os, NULL, NULL, NULL, NULL, NULL, kt, NULL, kt, mt FROM m WHERE is_start
        UNION ALL SELECT 'page', mid, is_new, os, pid, refer, own_item, NULL, NULL, kt, NULL, NULL, mt FROM m WHERE NOT is_start
        UNION ALL SELECT 'display', mid, is_new, os, pid, refer, {_txt('k + n')}, {_txt('k + n')}, NULL, NULL, NULL, NULL, mt
          FROM m JOIN (VALUES (0), (1)) AS d(n) ON kind = 'view'
        UNION ALL SELECT 'action', mid, is_new, os, pid, refer, kt, NULL, kt, NULL, NULL, NULL, {_txt('ms - 1')}
          FROM m WHERE kind IN ('click', 'purchase'))
      SELECT branch, mid, is_new, os, page_id, refer, item, rank, extra, sdk, error_code, loading_time, ts, false AS has_arrays FROM rows""",
    "log_display_explode": f"""WITH {LOG} SELECT log_id, mid, is_new, page_id, 'promotion' AS display_type,
      {_txt('k + n')} AS item, {_txt('n')} AS "order", ms AS ts
      FROM fixed JOIN (VALUES (0), (1)) AS d(n) ON kind = 'view'""",
    "log_action_explode": f"""WITH {LOG} SELECT log_id, mid, is_new, page_id, kind AS action_id, {_txt('k')} AS item,
      ms - 1 AS ts FROM fixed WHERE kind IN ('click', 'purchase')""",
    "log_err_rows": f"""WITH {LOG} SELECT log_id, mid, is_new, {_txt('k')} AS error_code,
      CASE WHEN NOT is_start THEN page_id END AS page_id, is_start, ms AS ts FROM fixed WHERE kind = 'error'""",
    "log_start_rows": f"""WITH {LOG} SELECT log_id, mid, is_new, {_txt('k')} AS loading_time, ms AS ts
      FROM fixed WHERE is_start""",
    "log_page_rows": f"""WITH {LOG} SELECT log_id, mid, is_new, page_id, CASE WHEN kind = 'click' THEN {_txt('k')} END AS item,
      ms AS ts FROM fixed WHERE NOT is_start""",
    "visitor_flag_repair": f"WITH {LOG} SELECT log_id, mid, is_new FROM fixed",
    "unique_visitor_detail": f"WITH {LOG} SELECT {PAGE_FIELDS} FROM uv",
    "bounce_detail": f"WITH {LOG} SELECT {PAGE_FIELDS} FROM uj",
    "bounce_detail_entry_normal": f"WITH {LOG} SELECT {PAGE_FIELDS} FROM uj_timeout",
    "cart_add": f"""WITH {LINES} SELECT c.id, user_id, sku_id, sku_num, source_type, name AS source_type_name, ts FROM (
      SELECT id, {_txt('l_suppkey')} AS user_id, {_txt('l_partkey')} AS sku_id,
        CASE WHEN l_linenumber = 1 THEN num
             WHEN l_linenumber < 7 AND CAST(num AS INTEGER) > l_partkey % 50 + 1
               THEN {_txt('CAST(num AS INTEGER) - (l_partkey % 50 + 1)')} END AS sku_num,
        '240' || (l_linenumber % 4 + 1) AS source_type, CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM raw) c
      JOIN dic ON c.source_type = dic.code WHERE sku_num IS NOT NULL""",
    "order_pre_process": f"WITH {LINES} SELECT * FROM pre",
    "order_detail": f"WITH {LINES} SELECT * FROM detail",
    "order_cancel": f"""WITH {LINES} SELECT * EXCLUDE (order_status, operate_date_id, operate_time, type, old_status,
      oi_ts, source_type, od_ts, date_id, create_time), operate_date_id AS date_id, operate_time AS cancel_time,
      source_type AS source_type_code, oi_ts AS ts FROM pre WHERE order_status = '1003'""",
    "pay_detail": f"""WITH {LINES}, pay AS (
        SELECT {_txt('o_orderkey')} AS pay_order, '110' || substr(o_orderpriority, 1, 1) AS payment_type_code,
          o_orderdate + to_minutes(o_orderkey % 45) AS moment FROM orders WHERE o_orderstatus <> 'F')
      SELECT detail.id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id,
        activity_rule_id, coupon_id, payment_type_code, dic.name AS payment_type_name, {_second('pay.moment')} AS callback_time,
        source_id, source_type_code, source_type_name, sku_num, split_original_amount, split_activity_amount,
        split_coupon_amount, split_total_amount AS split_payment_amount, {_txt('CAST(epoch(pay.moment) AS BIGINT)')} AS ts
      FROM pay JOIN detail ON pay_order = order_id JOIN dic ON payment_type_code = dic.code""",
    "order_refund": f"""WITH {LINES} SELECT ri.id, ri.user_id, ri.order_id, ri.sku_id, oi.province_id,
        substr(ri.create_time, 1, 10) AS date_id, ri.create_time, ri.refund_type_code, d1.name AS refund_type_name,
        ri.refund_reason_type_code, d2.name AS refund_reason_type_name, ri.refund_reason_txt, ri.refund_num,
        ri.refund_amount, {_txt('ri.moment')} AS ts
      FROM ri JOIN oi ON ri.order_id = oi.oi_id AND oi.order_status = '1005'
      JOIN dic d1 ON ri.refund_type_code = d1.code JOIN dic d2 ON ri.refund_reason_type_code = d2.code""",
    "refund_pay": f"""WITH {LINES} SELECT rp.id, oi.user_id, rp.order_id, rp.sku_id, oi.province_id, rp.payment_type_code,
        dic.name AS payment_type_name, substr(rp.callback_time, 1, 10) AS date_id, rp.callback_time, asked.refund_num,
        rp.refund_amount, {_txt('rp.moment')} AS ts
      FROM rp JOIN oi ON rp.order_id = oi.oi_id AND oi.order_status = '1006'
      JOIN asked ON rp.order_id = asked.ri_order AND rp.sku_id = asked.ri_sku
      JOIN dic ON rp.payment_type_code = dic.code""",
    **{
        name: f"""SELECT {_txt('o_orderkey')} AS id, {_txt('o_orderkey % 13')} AS coupon_id, {_txt('o_custkey')} AS user_id,
          {_day(shown)} AS date_id, {_second(shown)} AS {column}, {_txt(f'CAST(epoch({at}) AS BIGINT)')} AS ts
          FROM orders WHERE {keep}"""
        for name, column, shown, at, keep in (
            ("coupon_get", "get_time", "o_orderdate", "o_orderdate", "true"),
            ("coupon_order", "using_time", "o_orderdate + INTERVAL 1 HOUR", "o_orderdate + INTERVAL 1 HOUR", "o_orderstatus = 'O'"),
            ("coupon_pay", "used_time", "o_orderdate + INTERVAL 2 HOUR", "o_orderdate + INTERVAL 2 HOUR", "o_orderstatus = 'F'"),
            ("coupon_pay_compat", "used_time", "o_orderdate", "o_orderdate + INTERVAL 2 HOUR", "o_orderstatus = 'F'"),
        )
    },
    "favor_add": f"""SELECT {_txt('event_id')} AS id, {_txt('user_id')} AS user_id, json_extract_string(props, '$.k') AS sku_id,
      {_day('ts')} AS date_id, {_second('ts')} AS create_time, {_txt('epoch_us(ts) // 1000000')} AS ts
      FROM events WHERE event_type = 'click'""",
    "comment_lookup": f"""WITH {DIC} SELECT {_txt('event_id')} AS id, {_txt('user_id')} AS user_id,
      json_extract_string(props, '$.k') AS sku_id, {_txt('event_id * 2')} AS order_id, {_day('ts')} AS date_id,
      {_second('ts')} AS create_time, dic.code AS appraise_code, dic.name AS appraise_name,
      {_txt('epoch_us(ts) // 1000000')} AS ts
      FROM events JOIN dic ON '120' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 + 1) = dic.code
      WHERE event_type = 'purchase'""",
    "user_register": f"""SELECT {_txt('c_custkey')} AS user_id, {_day(REGISTERED)} AS date_id,
      {_second(REGISTERED)} AS create_time, {_txt('1704067200 + c_custkey * 7919 % 2592000')} AS ts FROM customer""",
    "payment_within_hold": f"""SELECT o_orderkey AS order_key, {_second('o_orderdate + to_minutes(o_orderkey % 45)')} AS paid_at
      FROM orders WHERE o_orderkey % 45 <= 30""",
    "dim_route_counts": f"""WITH {SKU_CHANGES}
      SELECT 'dim_sku_info' AS sink_table, kind AS operate_type, count(*) AS n FROM sku_rows GROUP BY ALL
      UNION ALL SELECT 'dim_user_info', 'insert', count(*) FROM customer
      UNION ALL SELECT 'dim_base_province', 'bootstrap-insert', count(*) FROM nation
      UNION ALL SELECT 'dim_base_region', 'bootstrap-insert', count(*) FROM region""",
    "dim_route_sku": f"""SELECT {_txt('p_partkey')} AS id, {_txt('p_partkey % 100')} AS spu_id,
      {_txt(_money('p_retailprice'))} AS price, CASE WHEN p_size > 25 THEN p_name || ' v2' ELSE p_name END AS sku_name,
      CAST(NULL AS VARCHAR) AS sku_desc, CAST(NULL AS VARCHAR) AS weight, split_part(p_brand, '#', 2) AS tm_id,
      p_type AS category3_id, CAST(NULL AS VARCHAR) AS sku_default_img, CAST(NULL AS VARCHAR) AS is_sale,
      CAST(NULL AS VARCHAR) AS create_time FROM part""",
    "dim_column_select": f"""WITH {SKU_CHANGES}, wide AS (
      SELECT 'dim_sku_info' AS sink_table, {_txt('p_partkey')} AS id, kind AS operate_type, unnest([
        {{'name': 'id', 'value': {_txt('p_partkey')}}}, {{'name': 'spu_id', 'value': {_txt('p_partkey % 100')}}},
        {{'name': 'price', 'value': {_txt(_money('p_retailprice'))}}}, {{'name': 'sku_name', 'value': new_name}},
        {{'name': 'tm_id', 'value': split_part(p_brand, '#', 2)}}, {{'name': 'category3_id', 'value': p_type}}]) AS kv
      FROM sku_rows
      UNION ALL SELECT 'dim_base_province', {_txt('n_nationkey')}, 'bootstrap-insert', unnest([
        {{'name': 'id', 'value': {_txt('n_nationkey')}}}, {{'name': 'name', 'value': n_name}},
        {{'name': 'region_id', 'value': {_txt('n_regionkey')}}}]) FROM nation
      UNION ALL SELECT 'dim_base_region', {_txt('r_regionkey')}, 'bootstrap-insert', unnest([
        {{'name': 'id', 'value': {_txt('r_regionkey')}}}, {{'name': 'region_name', 'value': r_name}}]) FROM region
      UNION ALL SELECT 'dim_user_info', {_txt('c_custkey')}, 'insert', unnest([
        {{'name': 'id', 'value': {_txt('c_custkey')}}}, {{'name': 'login_name', 'value': lower(c_name)}},
        {{'name': 'name', 'value': c_name}}, {{'name': 'user_level', 'value': c_mktsegment}},
        {{'name': 'create_time', 'value': {_second(REGISTERED)}}}]) FROM customer)
      SELECT sink_table, id, operate_type, kv.name AS name, kv.value AS value FROM wide""",
    "dim_upsert_latest": f"""
      SELECT 'dim_sku_info' AS sink_table, {_txt('p_partkey')} AS id,
        CASE WHEN p_size > 25 THEN p_name || ' v2' ELSE p_name END AS name,
        CASE WHEN p_size > 25 THEN 'update' ELSE 'insert' END AS operate_type FROM part
      UNION ALL SELECT 'dim_user_info', {_txt('c_custkey')}, c_name, 'insert' FROM customer
      UNION ALL SELECT 'dim_base_province', {_txt('n_nationkey')}, n_name, 'bootstrap-insert' FROM nation
      UNION ALL SELECT 'dim_base_region', {_txt('r_regionkey')}, NULL, 'bootstrap-insert' FROM region""",
    "dim_missing_rows": f"""WITH {DIMS} SELECT {_txt('l_partkey')} AS sku_id, count(*) AS rows_missing
      FROM lineitem WHERE {_txt('l_partkey')} NOT IN (SELECT id FROM sku) GROUP BY ALL""",
    "keyword_window_count": f"""SELECT {_bounds('moment', '1 hour')}, 'search' AS source, keyword, count(*) AS keyword_count
      FROM (SELECT TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS moment,
              unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'))) AS keyword FROM documents)
      GROUP BY ALL""",
    # The longest word at each place of a run, then from one to the next: all runs walk together, each with its own list.
    "keyword_dictionary_count": f"""WITH RECURSIVE dic AS (
        SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM benchmark),
      searched AS (SELECT doc_id, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS moment,
          unnest(regexp_extract_all(lower(replace(text, ' ', '')), '[\\p{{L}}\\p{{N}}]+')) AS run FROM documents),
      runs AS (SELECT row_number() OVER () AS id, run FROM (SELECT DISTINCT run FROM searched)),
      places AS (SELECT id, run, unnest(range(1, length(run) + 1)) AS pos FROM runs),
      sizes AS (SELECT DISTINCT length(word) AS size FROM dic),
      starts AS (SELECT id, pos, size, substr(run, pos, size) AS word FROM places JOIN sizes ON pos + size - 1 <= length(run)),
      longest AS (SELECT id, pos, max(size) AS size FROM starts JOIN dic USING (word) GROUP BY id, pos),
      steps AS (SELECT id, list(coalesce(size, 1) ORDER BY pos) AS steps FROM (SELECT id, pos FROM places) LEFT JOIN longest USING (id, pos) GROUP BY id),
      walk AS (SELECT id, steps, CAST(1 AS BIGINT) AS pos FROM steps
        UNION ALL SELECT id, steps, pos + steps[pos] FROM walk WHERE pos + steps[pos] <= len(steps)),
      words AS (SELECT DISTINCT run, substr(run, pos, steps[pos]) AS keyword FROM walk JOIN runs USING (id))
      SELECT {_bounds('moment', '1 hour')}, 'search' AS source, keyword, count(DISTINCT doc_id) AS keyword_count
      FROM searched JOIN words USING (run) GROUP BY ALL""",
    "keyword_unicode_totals": """SELECT keyword, count(*) AS searches
      FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))) AS keyword FROM documents) GROUP BY ALL""",
    "traffic_window": f"WITH {LOG}, {TRAFFIC} SELECT * FROM traffic",
    "home_detail_uv": f"""WITH {LOG}, firsts AS (
        SELECT mid, page_id, day, min(ts) AS moment FROM page WHERE page_id IN ('home', 'good_detail') GROUP BY ALL)
      SELECT {_bounds('moment', '1 hour')}, count(*) FILTER (page_id = 'home') AS home_uv_ct,
        count(*) FILTER (page_id = 'good_detail') AS good_detail_uv_ct FROM firsts GROUP BY ALL""",
    "login_back": f"""WITH {LOG}, days AS (
        SELECT mid, day, min(ts) AS moment FROM page WHERE last_page_id IS NULL OR last_page_id = 'login' GROUP BY ALL),
      gaps AS (SELECT *, date_diff('day', CAST(lag(day) OVER (PARTITION BY mid ORDER BY day) AS DATE), CAST(day AS DATE)) AS gap
        FROM days)
      SELECT {_bounds('moment', '1 hour')}, count(*) FILTER (gap > 2) AS back_ct, count(*) AS uu_ct FROM gaps GROUP BY ALL""",
    "register_window": f"SELECT {_bounds(REGISTERED, '1 hour')}, count(*) AS register_ct FROM customer GROUP BY ALL",
    "cart_add_uu": f"""WITH days AS (
        SELECT user_id, {_day('ts')} AS day, min(ts) AS moment FROM events
        WHERE event_type IN ('click', 'purchase') GROUP BY ALL)
      SELECT {_bounds('moment', '1 hour')}, count(*) AS cart_add_uu_ct FROM days GROUP BY ALL""",
    "payment_uu": _first_ever(
        "SELECT o_custkey AS u, o_orderdate + to_minutes(o_orderkey % 45) AS moment FROM orders WHERE o_orderstatus <> 'F'",
        "payment_suc_unique_user_count", "payment_new_user_count",
    ),
    "order_uu": _first_ever(
        "SELECT o_custkey AS u, o_orderdate + to_seconds(o_orderkey % 86400) AS moment FROM orders",
        "order_unique_user_count", "order_new_user_count",
    ),
    "sku_order_window": f"WITH {ORDER_LINES}, {DIMS}, {SKU_WINDOW} SELECT * FROM sku_window",
    "province_order_window": f"""WITH {ORDER_LINES}
      SELECT a.stt, a.edt, a.province_id, n_name AS province_name, order_count, order_amount
      FROM (SELECT {_bounds('moment', '7 days')}, province_id, count(DISTINCT order_id) AS order_count,
              {_amount('order_amount')} FROM lines GROUP BY ALL) a
      LEFT JOIN nation ON a.province_id = {_txt('n_nationkey')}""",
    "brand_category_user_refund": f"""WITH {DIMS}, agg AS (
        SELECT {_bounds('l_shipdate', '7 days')}, tm_id AS trademark_id, category3_id, {_txt('o_custkey')} AS user_id,
          count(DISTINCT l_orderkey) AS refund_count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN sku ON {_txt('l_partkey')} = sku.id
        WHERE l_returnflag = 'R' GROUP BY ALL)
      SELECT a.stt, a.edt, a.trademark_id, tm.tm_name AS trademark_name, c2.category1_id, c1.name AS category1_name,
        c3.category2_id, c2.name AS category2_name, a.category3_id, c3.name AS category3_name, a.user_id, a.refund_count
      FROM agg a {CATEGORY_JOINS}""",
    "latest_in_burst": f"""WITH {ORDER_LINES} SELECT id, sku_id, {_txt('order_amount')} AS split_total_amount,
      {_second('l_shipdate')} AS row_op_ts FROM lines""",
    "dws_sink_columns": f"""SELECT {_bounds(REGISTERED, '7 days')}, count(*) AS "registerCt" FROM customer GROUP BY ALL""",
    "ads_daily_rollup": f"""WITH {LOG}, {TRAFFIC} SELECT substr(stt, 1, 10) AS day, ch,
      {', '.join(f'CAST(sum({n}) AS BIGINT) AS {n}' for n in ('uv_ct', 'sv_ct', 'pv_ct', 'dur_sum', 'uj_ct'))}
      FROM traffic GROUP BY ALL""",
    "ads_range_rollup": f"""WITH {ORDER_LINES}, {DIMS}, {SKU_WINDOW}
      , counted AS (SELECT tm_id, count(DISTINCT order_id) AS order_count
        FROM (SELECT {_bounds('moment', '7 days')}, order_id, sku.tm_id AS tm_id FROM lines LEFT JOIN sku ON lines.sku_id = sku.id)
        WHERE stt >= '1996-01-01 00:00:00' AND edt <= '1999-01-01 00:00:00' GROUP BY ALL)
      SELECT trademark_id, any_value(counted.order_count) AS order_count, round(sum(order_amount), 2) AS order_amount
      FROM sku_window JOIN counted ON trademark_id IS NOT DISTINCT FROM tm_id
      WHERE stt >= '1996-01-01 00:00:00' AND edt <= '1999-01-01 00:00:00' GROUP BY trademark_id""",
    "ads_distinct_orders": f"""WITH {ORDER_LINES}, spans AS (
        SELECT * FROM (SELECT {_bounds('moment', '7 days')}, order_id FROM lines) WHERE stt >= '1996-01-01 00:00:00' AND edt <= '1999-01-01 00:00:00')
      SELECT 'all' AS day, count(DISTINCT order_id) AS order_count FROM spans
      UNION ALL SELECT substr(stt, 1, 10), count(DISTINCT order_id) FROM spans GROUP BY ALL""",
    "stream_fresh_lookup": f"""WITH line AS (SELECT concat_ws('-', l_orderkey, l_linenumber) AS line, l_partkey, CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM lineitem)
      SELECT line, {_txt('l_partkey')} AS sku_id, ts,
        CASE WHEN p_size > 25 AND ts >= 883612800 + p_partkey % 365 * 86400 THEN p_name || ' v2' ELSE p_name END AS sku_name,
        p_partkey IS NULL AS missing
      FROM line LEFT JOIN (SELECT * FROM part WHERE p_partkey % 100 <> 99) ON l_partkey = p_partkey""",
    "stream_line_changelog": f"""WITH {LINES} SELECT id, order_id, sku_id, sku_num, create_time, split_total_amount, activity_id, activity_rule_id, coupon_id
      FROM od LEFT JOIN act ON id = act_id LEFT JOIN cou ON id = cou_id""",
    "stream_late_rows": f"""WITH rows AS (SELECT event_id AS log_id, epoch_us(ts) // 1000 AS ts, {_txt('user_id')} AS mid, event_id % 50 = 0 AS held, day(ts) AS d FROM events)
      SELECT log_id, ts, mid FROM rows WHERE held AND log_id % 700 <> 0 AND ts < (SELECT max(ts) FROM rows WHERE NOT held AND d <= 24) - 3000""",
}
# On the stream the versions of a line share the time of its order.
_PLACED = LINES.replace("ORDER BY od_ts DESC, sku_id DESC", "ORDER BY sku_id DESC").replace("ORDER BY l_shipdate DESC, activity_id", "ORDER BY activity_id")
_PLACED = _PLACED.replace("ORDER BY l_shipdate DESC, coupon_id", "ORDER BY coupon_id").replace(
    "CAST(epoch(l_shipdate) AS BIGINT) AS od_ts\n  FROM raw",
    "CAST(epoch(o_orderdate) AS BIGINT) + l_linenumber AS od_ts\n  FROM raw JOIN orders ON l_orderkey = o_orderkey",
)
for _key in ("order_pre_process", "order_cancel"):
    ORACLE[f"stream_{_key}"] = ORACLE[_key].replace(LINES, _PLACED)
for _key in ("order_pre_process", "cart_add"):
    ORACLE[f"landed_{_key}"] = ORACLE[_key]
ORACLE["keyword_sql_lateral"] = ORACLE["keyword_window_count"]
ORACLE["stream_pay_detail"] = f"SELECT * FROM ({ORACLE['pay_detail']}) WHERE CAST(order_id AS BIGINT) % 45 BETWEEN 1 AND 30"
ORACLE["stream_order_refund"] = f"SELECT * EXCLUDE (ts) FROM ({ORACLE['order_refund']})"
ORACLE["stream_refund_pay"] = f"SELECT * EXCLUDE (ts) FROM ({ORACLE['refund_pay']})"
