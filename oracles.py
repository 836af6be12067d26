"""DuckDB text for every query of `rillhouse.plans.queries`, written on its own terms."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id AS seq, user_id AS u, event_type AS kind, epoch_us(ts) // 1000 AS ms,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS spent,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events)"""

RECORDS = EVENTS + """,
rec AS (
  SELECT seq, 'mid_' || u AS mid, CASE WHEN k < 30 THEN '1' ELSE '0' END AS is_new,
         'v' || (u % 3) AS vc, 'c' || (k % 4) AS ch, 'a' || (u % 5) AS ar, kind, k,
         CASE WHEN kind = 'purchase' AND k % 9 = 0 THEN NULL ELSE kind END AS page_id,
         CASE WHEN (kind = 'purchase' AND k % 9 = 0) OR k % 10 < 4 THEN NULL
              WHEN k % 10 = 4 THEN '' ELSE 'page_' || (k % 7) END AS last_page_id,
         CASE WHEN (kind = 'purchase' AND k % 9 = 0) OR k % 11 = 0 THEN NULL
              ELSE spent END AS during_time,
         CASE WHEN kind <> 'signup' OR k % 5 = 1 THEN NULL
              WHEN k % 5 = 0 THEN '{}'
              ELSE '{"entry":"icon","ms":' || k || '}' END AS start,
         CASE WHEN kind = 'purchase' AND k % 9 = 0 THEN 1
              WHEN kind <> 'view' OR k % 4 = 3 THEN -1
              ELSE k % 4 END AS n_displays,
         ms AS ts
  FROM ev WHERE kind <> 'error')"""

FIXED = RECORDS + """,
fixed AS (
  SELECT * EXCLUDE (is_new), is_new AS raw_is_new,
         CASE WHEN is_new = '1' AND row_number() OVER (
                PARTITION BY mid, is_new ORDER BY ts, seq) > 1
              THEN '0' ELSE is_new END AS is_new
  FROM rec)"""


def _pages(source: str) -> str:
    return f"""
pages AS (
  SELECT *, coalesce(last_page_id, '') = '' AS entry,
         strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt
  FROM {source} WHERE start IS NULL)"""


SIX_HOURS = 6 * 3_600_000


def _marks(source: str, horizon: int = SIX_HOURS, late: str = ">=") -> str:
    return f"""{_pages(source)},
marks AS (
  SELECT *,
         entry AND row_number() OVER (PARTITION BY mid, dt, entry ORDER BY ts, seq) = 1
           AS is_visit,
         entry AND (next_ts IS NULL OR next_ts - ts {late} {horizon} OR next_entry)
           AS is_bounce
  FROM (SELECT *, lead(ts) OVER w AS next_ts, lead(entry) OVER w AS next_entry
        FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)))"""


def _shape(uv: str, pv: str, sv: str, uj: str, dur: str) -> str:
    cells = zip((uv, pv, sv, uj, dur), ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"))
    return "ar, ch, is_new, vc, " + ", ".join(
        f"CAST({v} AS BIGINT) AS {n}" for v, n in cells
    ) + ", ts"


UV = "SELECT " + _shape("1", "0", "0", "0", "0") + " FROM marks WHERE is_visit"
UJ = "SELECT " + _shape("0", "0", "0", "1", "0") + " FROM marks WHERE is_bounce"
PV = (
    "SELECT "
    + _shape("0", "1", "CASE WHEN entry THEN 1 ELSE 0 END", "0", "coalesce(during_time, 0)")
    + " FROM marks"
)


def _stats(width_ms: int, horizon: int) -> str:
    return f"""
WITH {FIXED}, {_marks("fixed", horizon)},
shaped AS ({UV} UNION ALL {UJ} UNION ALL {PV}),
binned AS (SELECT *, ts - ts % {width_ms} AS w FROM shaped)
SELECT strftime(make_timestamp(w * 1000), '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(make_timestamp((w + {width_ms}) * 1000), '%Y-%m-%d %H:%M:%S') AS edt,
       vc, ch, ar, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct,
       CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
       CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum,
       min(ts) AS ts
FROM binned GROUP BY w, vc, ch, ar, is_new"""


RAW_LINE = EVENTS + """,
parts AS (
  SELECT *,
    '{"mid":"mid_' || u || '","is_new":"' || CASE WHEN k < 30 THEN '1' ELSE '0' END
      || '","vc":"v' || (u % 3) || '","ch":"c' || (k % 4) || '","ar":"a' || (u % 5) || '"}'
      AS common,
    '"last_page_id":' || CASE WHEN k % 10 = 3 THEN 'null' WHEN k % 10 = 4 THEN '""'
      WHEN k % 10 < 3 THEN NULL ELSE '"page_' || (k % 7) || '"' END AS last_page,
    '"during_time":' || CASE WHEN k % 11 <> 0 THEN spent END AS during
  FROM ev WHERE kind = 'error'),
line AS (
  SELECT *, '{' || concat_ws(',',
      CASE WHEN k % 8 = 5 THEN NULL WHEN k % 8 = 6 THEN '"common":null'
           ELSE '"common":' || common END,
      '"page":{' || concat_ws(',', '"page_id":"error"', last_page, during) || '}',
      '"ts":' || CASE WHEN k % 8 = 7 THEN '"n/a"' ELSE CAST(ms AS VARCHAR) END) || '}' AS line
  FROM parts)
SELECT CASE k % 8 WHEN 0 THEN left(line, length(line) - 1) WHEN 1 THEN '[' || line || ']'
            WHEN 2 THEN 'null' WHEN 3 THEN '' WHEN 4 THEN line || ' x' ELSE line END AS value,
       seq,
       CASE WHEN k % 8 < 5 THEN 'not one JSON object' WHEN k % 8 < 7 THEN 'no device id'
            ELSE 'no event time' END AS reject_reason
FROM line"""

# Texts of a record and of its i-th display, as they leave the split.
LINE = """'{' || concat_ws(',',
    '"common":{"mid":"' || mid || '","is_new":"' || is_new || '","vc":"' || vc || '","ch":"' || ch || '","ar":"' || ar
      || '","os" : "x\\"{,"}',
    CASE WHEN page_id IS NOT NULL THEN '"page":{' || concat_ws(',', '"page_id":"' || kind || '"',
      CASE WHEN k % 10 = 3 THEN '"last_page_id":null' WHEN last_page_id IS NOT NULL THEN '"last_page_id":"' || last_page_id || '"' END,
      '"during_time":' || during_time) || '}' END,
    CASE WHEN kind = 'purchase' AND k % 9 = 0 THEN '"displays":[{"item":"i' || k || '"}]'
      WHEN kind <> 'view' OR k % 4 = 3 THEN NULL WHEN k % 4 = 0 THEN '"displays":[]'
      WHEN k % 4 = 1 THEN '"displays":[{"item":"i' || k || '","pos":1,"flag":true,"deep":{"a":[1.50,"}"]}}]'
      ELSE '"displays":[{"item":"i' || k || '","pos":1},{"page_id":"old","item":"i' || k || '","pos":2}]' END,
    CASE WHEN kind = 'signup' THEN '"start":' || coalesce(start, 'null') END,
    CASE WHEN k % 6 = 0 THEN '"extra":{"n": 1.50}, "extra":[1,{"d":null}]' END,
    '"ts":' || ts) || '}'"""
SHOWN = """'{"item":"i' || k || '"' || CASE WHEN kind = 'view' THEN ',"pos":' || i ELSE '' END
    || CASE WHEN kind = 'view' AND k % 4 = 1 THEN ',"flag":true,"deep":{"a":[1.50,"}"]}' ELSE '' END
    || ',"page_id":' || coalesce('"' || page_id || '"', 'null') || '}'"""

DISPLAYS = RECORDS + """,
shown AS (
  SELECT rec.*, i FROM rec, unnest(range(1, n_displays + 1)) AS t(i)
  WHERE start IS NULL AND n_displays > 0)"""

CHANGES = """
steps AS (
  SELECT c.*, s.step FROM customer c, (VALUES (0), (1), (2)) AS s(step)
  WHERE s.step = 0 OR (s.step = 1 AND c_custkey % 10 < 4) OR (s.step = 2 AND c_custkey % 10 = 0)),
chg AS (
  SELECT 'shop' AS database, 'customer' AS "tableName",
         CASE WHEN step = 0 THEN '{}' WHEN step = 1 THEN created ELSE renamed END AS before,
         CASE WHEN step = 0 THEN created WHEN step = 1 THEN renamed ELSE '{}' END AS after,
         CASE WHEN step = 2 THEN 'delete' WHEN step = 1 THEN 'update'
              WHEN c_custkey % 10 = 4 THEN 'read' ELSE 'insert' END AS type,
         c_custkey * 4 + step AS seq, c_custkey AS id,
         CASE WHEN step = 1 THEN 'new ' || c_name
              WHEN c_custkey % 17 <> 0 THEN c_name END AS name,
         c_mktsegment AS seg, NULL::BIGINT AS user_id, NULL::BIGINT AS cents
  FROM (SELECT *, '{"id":' || c_custkey || ',"name":'
               || CASE WHEN c_custkey % 17 = 0 THEN 'null' ELSE '"' || c_name || '"' END
               || tail AS created,
               '{"id":' || c_custkey || ',"name":"new ' || c_name || '"' || tail AS renamed
        FROM (SELECT *, ',"seg":"' || c_mktsegment || '","cents":'
                     || CAST(floor(c_acctbal * 100 + 0.5) AS BIGINT) || '}' AS tail
              FROM steps))
  UNION ALL
  SELECT 'shop', 'orders',
         CASE WHEN o_orderkey % 10 < 4 THEN body ELSE '{}' END,
         CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 23 <> 0 THEN '{}' ELSE body END,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 'delete'
              WHEN o_orderkey % 10 < 4 THEN 'update' ELSE 'insert' END,
         o_orderkey, o_orderkey, NULL, NULL, o_custkey,
         CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)
  FROM (SELECT *, '{"id":' || o_orderkey || ',"user_id":' || o_custkey || ',"status":"'
               || o_orderstatus || '","cents":'
               || CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) || '}' AS body
        FROM orders)),
kept AS (SELECT * FROM chg WHERE type IS DISTINCT FROM 'delete'),
rules AS (
  SELECT * FROM (VALUES
    ('customer', 'insert', 'hbase', 'dim_user_info', 'id,name,seg'),
    ('customer', 'update', 'hbase', 'dim_user_info', 'id,name,seg'),
    ('orders', 'insert', 'kafka', 'dwd_order_info', 'id,user_id,cents'),
    ('orders', 'update', 'clickhouse', 'ck_orders', 'id'))
  AS r(source_table, operate_type, sink_type, sink_table, sink_columns)),
routed AS (
  SELECT kept.*, sink_type, sink_table, sink_columns,
         CASE WHEN sink_type IS NULL THEN 'no rule'
              WHEN sink_type = 'clickhouse' THEN 'unknown sink type' END AS reject_reason,
         CASE WHEN sink_type = 'hbase'
              THEN '{' || concat_ws(',', '"id":' || id, '"name":"' || name || '"',
                                    '"seg":"' || seg || '"') || '}'
              ELSE '{"id":' || id || ',"user_id":' || user_id || ',"cents":' || cents || '}'
              END AS cut
  FROM kept LEFT JOIN rules ON "tableName" = source_table AND type = operate_type)"""


def _m(expr: str) -> str:
    """Whole cents to money as double."""
    return f"CAST(CAST({expr} AS DECIMAL(16, 0)) / 100 AS DOUBLE)"


def _clock(day: str, seconds: str) -> str:
    return f"({day} + to_seconds({seconds}))"


ORDERS = f"""
oi AS (
  SELECT o_orderkey AS id, o_custkey % 27 AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS total,
         o_orderkey % 500 AS act, o_orderkey % 300 AS cou, o_orderkey % 1000 AS fee,
         CASE WHEN o_orderkey % 29 <> 28 THEN {_clock("o_orderdate", "o_orderkey * 37 % 86400")}
              END AS et
  FROM orders),
od AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS total,
         CAST(l_quantity AS BIGINT) AS sku_num, 'sku ' || l_partkey AS sku_name,
         {_clock("l_shipdate", "l_orderkey * 37 % 86400 + l_linenumber % 3 - 1")} AS et
  FROM lineitem),
pay AS (
  SELECT *, CASE WHEN id % 17 = 0 THEN paid_at + INTERVAL 1 MINUTE ELSE paid_at END AS et
  FROM (SELECT o_orderkey AS id, o_custkey AS user_id,
               CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS total,
               {_clock("o_orderdate",
                       "o_orderkey * 37 % 86400 + (o_orderkey % 40 - 15) * 60")} AS paid_at
        FROM orders))"""

DIMS = """
users AS (
  SELECT CASE WHEN c_custkey % 13 = 0 THEN -c_custkey ELSE c_custkey END AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F'
         ELSE 'M' END AS gender,
         DATE '1960-01-01' + CAST(c_custkey * 17 % 24000 AS INTEGER) AS birthday
  FROM customer),
ages AS (
  SELECT *, CAST(trunc((epoch_ms(TIMESTAMP '2024-06-01 00:00:00')
                        - epoch_ms(CAST(birthday AS TIMESTAMP))) / 31536000000) AS INTEGER) AS age
  FROM users),
skus AS (
  SELECT CASE WHEN p_partkey % 31 = 0 THEN -p_partkey ELSE p_partkey END AS id, p_name AS sku_name, ascii(p_type) * 100 + length(p_type) AS cat,
         p_partkey // 20 AS spu,
         CASE WHEN p_partkey % 50 <> 7 THEN CAST(substr(p_brand, 7) AS BIGINT) END AS tm
  FROM part),
spus AS (SELECT CASE WHEN s_suppkey % 19 = 0 THEN -s_suppkey ELSE s_suppkey END AS id, s_name AS name
         FROM supplier),
tms AS (SELECT DISTINCT CASE WHEN n % 9 = 0 THEN -n ELSE n END AS id, name
        FROM (SELECT CAST(substr(p_brand, 7) AS BIGINT) AS n, 'tm ' || p_brand AS name FROM part)),
cats AS (SELECT DISTINCT ascii(p_type) * 100 + length(p_type) AS id, p_type AS name FROM part),
ids AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id,
         CASE WHEN l_partkey % 41 <> 0 THEN l_partkey END AS sku_id,
         'sku ' || l_partkey AS sku_name, l_orderkey % 28 AS province_id,
         l_orderkey // 10 AS user_id
  FROM lineitem),
ids_sku AS (
  SELECT ids.id, ids.sku_id, coalesce(skus.sku_name, ids.sku_name) AS sku_name,
         CAST(cat AS BIGINT) AS category3_id, CAST(spu AS BIGINT) AS spu_id, tm AS tm_id
  FROM ids LEFT JOIN skus ON skus.id = ids.sku_id)"""

SECONDS = "'%Y-%m-%d %H:%M:%S'"

JOINED = f"""
joined AS (
  SELECT od.id AS detail_id, oi.id AS order_id, sku_id, {_m("od.total")} AS order_price, sku_num,
         od.sku_name, province_id, order_status, user_id, {_m("oi.total")} AS total_amount,
         {_m("act")} AS activity_reduce_amount, {_m("cou")} AS coupon_reduce_amount,
         {_m("oi.total + act + cou")} AS original_total_amount, {_m("fee")} AS feight_fee,
         CAST(NULL AS DOUBLE) AS split_feight_fee,
         {_m("sku_id % 60")} AS split_activity_amount, {_m("sku_id % 40")} AS split_coupon_amount,
         {_m("od.total - sku_id % 100")} AS split_total_amount,
         CAST(NULL AS VARCHAR) AS expire_time, strftime(oi.et, {SECONDS}) AS create_time,
         CAST(NULL AS VARCHAR) AS operate_time, strftime(oi.et, '%Y-%m-%d') AS create_date,
         strftime(oi.et, '%H') AS create_hour, oi.et AS et
  FROM oi JOIN od ON oi.id = od.order_id
   AND od.et BETWEEN oi.et - INTERVAL 30 DAY AND oi.et + INTERVAL 30 DAY)"""

NO_DIMS = """CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS province_area_code,
  CAST(NULL AS VARCHAR) AS province_iso_code, CAST(NULL AS VARCHAR) AS province_3166_2_code,
  CAST(NULL AS INTEGER) AS user_age, CAST(NULL AS VARCHAR) AS user_gender,
  CAST(NULL AS BIGINT) AS spu_id, CAST(NULL AS BIGINT) AS tm_id,
  CAST(NULL AS BIGINT) AS category3_id, CAST(NULL AS VARCHAR) AS spu_name,
  CAST(NULL AS VARCHAR) AS tm_name, CAST(NULL AS VARCHAR) AS category3_name"""

WIDE = f"""{ORDERS}, {DIMS}, {JOINED},
wide AS (
  SELECT j.* REPLACE (coalesce(s.sku_name, j.sku_name) AS sku_name),
         n_name AS province_name, CAST(n_regionkey AS VARCHAR) AS province_area_code,
         'ISO' || n_nationkey AS province_iso_code, 'N-' || n_nationkey AS province_3166_2_code,
         age AS user_age, gender AS user_gender, CAST(spu AS BIGINT) AS spu_id, tm AS tm_id,
         CAST(cat AS BIGINT) AS category3_id, spus.name AS spu_name, tms.name AS tm_name,
         cats.name AS category3_name
  FROM joined j LEFT JOIN ages ON ages.id = j.user_id
  LEFT JOIN nation ON n_nationkey = j.province_id
  LEFT JOIN skus s ON s.id = j.sku_id LEFT JOIN spus ON spus.id = s.spu
  LEFT JOIN tms ON tms.id = s.tm LEFT JOIN cats ON cats.id = s.cat)"""


def oracle_sql() -> dict[str, str]:
    pages = f"WITH {RECORDS}, {_pages('rec')}"
    marks = f"WITH {RECORDS}, {_marks('rec')}"
    change = f"WITH {CHANGES}"
    ids = f"WITH {DIMS}"
    return {
        "log_parse": f"""WITH {RECORDS} SELECT seq, mid, is_new, vc, ch, ar, page_id,
            last_page_id, during_time, start, CAST(n_displays AS INTEGER) AS n_displays, ts
            FROM rec""",
        "log_dirty": f"WITH {RAW_LINE}",
        "new_visitor_fix": f"WITH {FIXED} SELECT seq, mid, ts, raw_is_new, is_new FROM fixed",
        "log_start": f"WITH {RECORDS} SELECT seq, mid, start, ts FROM rec WHERE start IS NOT NULL",
        "log_page": f"{pages} SELECT seq, mid, page_id, last_page_id, during_time, ts FROM pages",
        "log_display": f"""WITH {DISPLAYS} SELECT seq, 'i' || k AS item,
            CASE WHEN kind = 'view' THEN CAST(i AS VARCHAR) END AS pos, page_id,
            {SHOWN} AS display FROM shown""",
        "log_topics": f"""WITH {FIXED}, shown AS (
              SELECT fixed.*, i FROM fixed, unnest(range(1, n_displays + 1)) AS t(i)
              WHERE start IS NULL AND n_displays > 0)
            SELECT CASE WHEN start IS NULL THEN 'dwd_page_log' ELSE 'dwd_start_log' END AS topic,
                   seq, mid, is_new, ts, page_id AS page_page_id, NULL::VARCHAR AS item,
                   NULL::VARCHAR AS display_page_id, {LINE} AS value FROM fixed
            UNION ALL
            SELECT 'dwd_display_log', seq, NULL, NULL, NULL, NULL, 'i' || k, page_id, {SHOWN} FROM shown""",
        "entry_pages": f"{pages} SELECT seq, mid, ts FROM pages WHERE entry",
        "unique_visit": f"{marks} SELECT seq, mid, dt, ts, page_id FROM marks WHERE is_visit",
        "user_jump": f"{marks} SELECT seq, mid, ts, page_id FROM marks WHERE is_bounce",
        "user_jump_followed": f"""{marks} SELECT seq, mid, ts, page_id FROM marks
            WHERE is_bounce AND next_ts - ts < {SIX_HOURS}""",
        "user_jump_timed_out": f"""{marks} SELECT seq, mid, ts, page_id FROM marks
            WHERE is_bounce AND (next_ts IS NULL OR next_ts - ts >= {SIX_HOURS})""",
        "user_jump_union": f"""{marks}
            SELECT seq, mid, ts, 'followed' AS bounce_kind FROM marks
            WHERE entry AND next_entry AND next_ts - ts < {SIX_HOURS}
            UNION ALL
            SELECT seq, mid, ts, 'timed out' FROM marks
            WHERE entry AND (next_ts IS NULL OR next_ts - ts >= {SIX_HOURS})""",
        "user_jump_inclusive": f"""WITH {RECORDS},
            hourly AS (SELECT * REPLACE (ts - ts % 3600000 AS ts) FROM rec),
            {_marks('hourly', late='>')}
            SELECT seq, mid, ts, page_id FROM marks WHERE is_bounce""",
        "visit_flags": f"""WITH {FIXED}, {_marks('fixed')}
            SELECT seq, mid, ts, is_new, is_visit, is_bounce FROM marks""",
        "visitor_shape_uv": f"{marks} {UV}",
        "visitor_shape_uj": f"{marks} {UJ}",
        "visitor_shape_pv": f"{marks} {PV}",
        "visitor_union": f"{marks} {UV} UNION ALL {UJ} UNION ALL {PV}",
        "visitor_stats": _stats(SIX_HOURS, SIX_HOURS),
        "visitor_stats_layered": _stats(SIX_HOURS, SIX_HOURS),
        "visitor_stats_10s": _stats(10_000, 10_000),
        "cdc_envelope": f"""{change} SELECT database, "tableName", before, after, type, seq
            FROM chg""",
        "cdc_topic_roundtrip": f"""{change} SELECT seq, database, "tableName", type,
            json_extract_string(before, '$.id') AS before_id,
            json_extract_string(after, '$.id') AS after_id FROM chg""",
        "cdc_no_delete": f'{change} SELECT seq, "tableName", type FROM kept',
        "rule_match": f"""{change} SELECT seq, "tableName", type, sink_type, sink_table
            FROM routed WHERE sink_type IS NOT NULL""",
        "rule_match_as_of": f"""{change}, versions (source, operation, low, high, sink_type, sink_table, sink_columns) AS (VALUES
              ('customer', 'insert', 0, 120, 'hbase', 'dim_user_info', 'id,name'),
              ('customer', 'insert', 120, 240, 'hbase', 'dim_user_info', 'id,name,seg'),
              ('customer', 'insert', 400, NULL, 'kafka', 'dwd_customer', 'id,cents'),
              ('customer', 'update', 300, NULL, 'hbase', 'dim_user_info', 'id,name,seg'),
              ('orders', 'insert', 0, NULL, 'kafka', 'dwd_order_info', 'id,user_id,cents'),
              ('orders', 'update', 0, 700, 'kafka', 'dwd_order_info', 'id,status'))
            SELECT seq, "tableName", type,
              CASE v.sink_type WHEN 'kafka' THEN 'fact' WHEN 'hbase' THEN 'dimension' ELSE 'reject' END AS route,
              CASE WHEN v.sink_type IS NULL THEN 'no rule' END AS reject_reason, v.sink_table, v.sink_columns
            FROM kept LEFT JOIN versions v ON source = "tableName" AND operation = type
              AND seq >= low AND seq < coalesce(high, 9223372036854775807)""",
        "rule_rejects": f"""{change} SELECT seq, "tableName", type, reject_reason FROM routed
            WHERE reject_reason IS NOT NULL""",
        "rule_column_filter": f"""{change} SELECT seq, sink_table, cut AS after FROM routed
            WHERE reject_reason IS NULL""",
        "rule_config_latest": f"""{change} SELECT source_table, operate_type, sink_type,
            sink_table, sink_columns, count(seq) AS n_changes
            FROM rules LEFT JOIN kept ON "tableName" = source_table AND type = operate_type
            GROUP BY ALL""",
        "fact_topics": f"""{change} SELECT sink_table AS topic, cut AS value, seq FROM routed
            WHERE sink_type = 'kafka'""",
        "dim_upsert_fields": f"""{change} SELECT seq, upper(sink_table) AS sink_table,
            CASE WHEN name IS NULL THEN 'id,seg' ELSE 'id,name,seg' END AS fields,
            concat_ws(',', CAST(id AS VARCHAR), name, seg) AS values
            FROM routed WHERE sink_type = 'hbase'""",
        "dim_latest": f"""{change} SELECT CAST(id AS VARCHAR) AS "ID", name AS "NAME",
            seg AS "SEG" FROM routed WHERE sink_type = 'hbase'
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1""",
        **dict.fromkeys(("dim_store_restart", "dim_store_compacted"), f"""{change} SELECT CAST(id AS VARCHAR) AS "ID", name AS "NAME",
            seg AS "SEG" FROM routed WHERE sink_type = 'hbase'
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1"""),
        "dim_store_partial_update": """SELECT CAST(c_custkey AS VARCHAR) AS "ID",
            CASE WHEN c_custkey % 10 < 4 THEN 'new ' || c_name ELSE c_name END AS "NAME",
            CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS "SEG" FROM customer""",
        "dim_store_layout": f"""{change} SELECT 'dim_user_info' AS sink_table, 'id,name,seg' AS sink_columns,
            CAST(2 AS BIGINT) AS n_rules, count(DISTINCT id) AS n_keys FROM routed WHERE sink_type = 'hbase'""",
        "bean_parse": f"""WITH {ORDERS} SELECT id AS seq, id, province_id, order_status, user_id,
            {_m("total")} AS total_amount, {_m("act")} AS activity_reduce_amount,
            {_m("cou")} AS coupon_reduce_amount,
            {_m("total + act + cou")} AS original_total_amount, {_m("fee")} AS feight_fee,
            NULL::VARCHAR AS expire_time,
            coalesce(strftime(et, {SECONDS}), 'soon') AS create_time,
            NULL::VARCHAR AS operate_time,
            coalesce(strftime(et, '%Y-%m-%d'), 'soon') AS create_date,
            coalesce(strftime(et, '%H'), '') AS create_hour, epoch_ms(et) AS create_ts FROM oi""",
        "order_time_parts": f"""WITH {ORDERS} SELECT id,
            coalesce(strftime(et, {SECONDS}), 'soon') AS create_time,
            coalesce(strftime(et, '%Y-%m-%d'), 'soon') AS create_date,
            coalesce(strftime(et, '%H'), '') AS create_hour, epoch_ms(et) AS create_ts FROM oi""",
        "order_interval_join": f"""WITH {ORDERS}, {JOINED}
            SELECT * EXCLUDE (et), {NO_DIMS} FROM joined""",
        "lookup_user": f"""{ids} SELECT ids.id, sku_id, user_id, gender AS user_gender,
            age AS user_age FROM ids LEFT JOIN ages ON ages.id = user_id""",
        "lookup_province": f"""{ids} SELECT id, sku_id, province_id, n_name AS province_name,
            CAST(n_regionkey AS VARCHAR) AS province_area_code,
            'ISO' || n_nationkey AS province_iso_code,
            'N-' || n_nationkey AS province_3166_2_code
            FROM ids LEFT JOIN nation ON n_nationkey = province_id""",
        "lookup_sku": f"{ids} SELECT * FROM ids_sku",
        "lookup_spu": f"""{ids} SELECT i.id, sku_id, spu_id, name AS spu_name FROM ids_sku i
            LEFT JOIN spus ON spus.id = spu_id""",
        "lookup_trademark": f"""{ids} SELECT i.id, sku_id, tm_id, name AS tm_name FROM ids_sku i
            LEFT JOIN tms ON tms.id = tm_id""",
        "lookup_category": f"""{ids} SELECT i.id, sku_id, category3_id, name AS category3_name
            FROM ids_sku i LEFT JOIN cats ON cats.id = category3_id""",
        "point_lookup": """SELECT CAST(p_partkey AS VARCHAR) AS "ID", p_name AS "SKU_NAME",
            CAST(ascii(p_type) * 100 + length(p_type) AS VARCHAR) AS "CATEGORY3_ID",
            CAST(p_partkey // 20 AS VARCHAR) AS "SPU_ID", substr(p_brand, 7) AS "TM_ID"
            FROM part WHERE p_partkey = 18""",
        "order_wide": f"WITH {WIDE} SELECT * EXCLUDE (et) FROM wide",
        "payment_time_fallback": f"""WITH {ORDERS} SELECT id + 1000000000 AS id,
            CASE WHEN id % 17 = 0 THEN 'n/a' ELSE strftime(paid_at, {SECONDS}) END AS create_time,
            epoch_ms(et) AS event_ms FROM pay""",
        "payment_interval_join": f"""WITH {ORDERS} SELECT pay.id + 1000000000 AS payment_id,
            oi.id AS o_id, epoch_ms(pay.et) - epoch_ms(oi.et) AS lag_ms
            FROM pay JOIN oi ON oi.id = pay.id AND pay.id % 7 <> 0
             AND oi.et BETWEEN pay.et - INTERVAL 15 MINUTE AND pay.et + INTERVAL 5 SECOND""",
        "payment_wide": f"""WITH {WIDE}
            SELECT pay.id + 1000000000 AS payment_id, 'order ' || pay.id AS subject,
              'p' || (pay.id % 4) AS payment_type,
              CASE WHEN pay.id % 17 = 0 THEN 'n/a' ELSE strftime(paid_at, {SECONDS}) END
                AS payment_create_time,
              CASE WHEN pay.id % 3 = 0 THEN strftime(paid_at, {SECONDS}) END AS callback_time,
              wide.* EXCLUDE (create_time, create_date, create_hour, expire_time, operate_time, et)
                REPLACE (pay.id AS order_id, pay.user_id AS user_id,
                  CASE WHEN pay.id % 13 <> 0 THEN {_m("pay.total")} END AS total_amount),
              wide.create_time AS order_create_time
            FROM pay JOIN wide ON wide.order_id = pay.id AND pay.id % 7 <> 0
             AND wide.et BETWEEN pay.et - INTERVAL 15 MINUTE AND pay.et + INTERVAL 5 SECOND""",
        "coalesce_merge": f"""WITH {ORDERS} SELECT id AS detail_id, order_status, user_id,
            {_m("total")} AS total_amount,
            coalesce(strftime(et, '%Y-%m-%d'), 'soon') AS create_date,
            CASE WHEN id % 6 <> 0 THEN {_m("fee")} END AS split_total_amount,
            CASE WHEN id % 7 <> 0 THEN coalesce(strftime(et, '%H'), '') END AS create_hour
            FROM oi""",
        "stream_new_visitor_fix": f"""WITH {FIXED}
            SELECT seq, mid, raw_is_new, is_new FROM fixed""",
        "stream_unique_visit": f"{marks} SELECT mid, dt FROM marks WHERE is_visit",
        "stream_user_jump": f"{marks} SELECT seq FROM marks WHERE is_bounce",
        "stream_visitor_stats": _stats(SIX_HOURS, SIX_HOURS),
        "stream_order_user": """SELECT o_orderkey AS order_id,
            CASE WHEN o_orderkey % 3 = 2 AND c_custkey % 10 = 7 THEN NULL
                 WHEN o_orderkey % 3 = 2 AND c_custkey % 10 < 4 THEN 'new ' || c_name ELSE c_name END AS name,
            c_mktsegment AS seg
            FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND o_orderkey % 19 <> 0
              AND (c_custkey % 2 = 0 OR o_orderkey % 3 > 0)""",
        "stream_late_rows": f"""WITH {RECORDS}, marks AS (
              SELECT m.file, max(rec.ts) - 20 * 86400000 AS mark FROM (VALUES (1), (2), (3)) AS m(file)
              JOIN rec ON seq % 4 < m.file GROUP BY m.file)
            SELECT seq, coalesce(ts <= mark, false) AS late, ts, CASE WHEN ts <= mark THEN mark END AS missed_ms
            FROM rec LEFT JOIN marks ON file = seq % 4""",
        "stream_page_stats": f"""{marks}, shaped AS ({PV}),
            binned AS (SELECT *, ts - ts % {SIX_HOURS} AS w FROM shaped)
            SELECT strftime(make_timestamp(w * 1000), {SECONDS}) AS stt,
              strftime(make_timestamp((w + {SIX_HOURS}) * 1000), {SECONDS}) AS edt,
              vc, ch, ar, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct,
              CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
              CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum,
              min(ts) AS ts FROM binned GROUP BY w, vc, ch, ar, is_new""",
        "stream_order_interval_join": f"""WITH {ORDERS}, {JOINED}
            SELECT * EXCLUDE (et), {NO_DIMS} FROM joined""",
        "camel_rename": """SELECT n_nationkey AS "nNationkey", n_name AS "nName",
            n_regionkey AS "nRegionkey" FROM nation""",
        "drop_transient": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
        "time_formats": f"""SELECT event_id, strftime(ts, {SECONDS}) AS instant,
            strftime(ts, '%Y-%m-%d') AS day,
            epoch_ms(date_trunc('second', ts)) - 28800000 AS at_plus_8 FROM events""",
        "age_in_years": f"""{ids} SELECT CAST(id AS VARCHAR) AS "ID",
            strftime(birthday, '%Y-%m-%d') AS "BIRTHDAY", age FROM ages""",
    }
