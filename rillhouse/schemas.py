"""Declared layouts of every logical table. Streams never infer a schema."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DECIMAL(16_2)": MONEY,
}


def _struct(text: str) -> T.StructType:
    """`name TYPE, ...` to a schema; no session is needed at import."""
    fields = (part.split() for part in text.replace("(16,2)", "(16_2)").split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Times and durations are read as text so that both 12 and "12" are accepted.
LOG_RECORD = T.StructType(
    [
        T.StructField(
            "common", _struct("mid STRING, is_new STRING, vc STRING, ch STRING, ar STRING")
        ),
        T.StructField("page", _struct("page_id STRING, last_page_id STRING, during_time STRING")),
        T.StructField("start", T.StringType()),
        # Each display is a text of its own, so its values keep their types.
        T.StructField("displays", T.ArrayType(T.StringType())),
        T.StructField("ts", T.StringType()),
    ]
)

TOPIC_ROW = _struct("value STRING, seq BIGINT")

CHANGE_EVENT = _struct("topic STRING, before STRING, after STRING, op STRING")

ENVELOPE = _struct("database STRING, tableName STRING, before STRING, after STRING, type STRING")

RULE = _struct(
    "source_table STRING, operate_type STRING, sink_type STRING, sink_table STRING, "
    "sink_columns STRING, sink_pk STRING, sink_extend STRING"
)

ORDER_INFO = _struct(
    "id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, "
    "total_amount DECIMAL(16,2), activity_reduce_amount DECIMAL(16,2), "
    "coupon_reduce_amount DECIMAL(16,2), original_total_amount DECIMAL(16,2), "
    "feight_fee DECIMAL(16,2), expire_time STRING, create_time STRING, operate_time STRING, "
    "create_date STRING, create_hour STRING, create_ts BIGINT"
)

ORDER_DETAIL = _struct(
    "id BIGINT, order_id BIGINT, sku_id BIGINT, order_price DECIMAL(16,2), sku_num BIGINT, "
    "sku_name STRING, create_time STRING, split_total_amount DECIMAL(16,2), "
    "split_activity_amount DECIMAL(16,2), split_coupon_amount DECIMAL(16,2), create_ts BIGINT"
)

PAYMENT_INFO = _struct(
    "id BIGINT, order_id BIGINT, user_id BIGINT, total_amount DECIMAL(16,2), subject STRING, "
    "payment_type STRING, create_time STRING, callback_time STRING"
)

ORDER_WIDE = _struct(
    "detail_id BIGINT, order_id BIGINT, sku_id BIGINT, order_price DECIMAL(16,2), "
    "sku_num BIGINT, sku_name STRING, province_id BIGINT, order_status STRING, user_id BIGINT, "
    "total_amount DECIMAL(16,2), activity_reduce_amount DECIMAL(16,2), "
    "coupon_reduce_amount DECIMAL(16,2), original_total_amount DECIMAL(16,2), "
    "feight_fee DECIMAL(16,2), split_feight_fee DECIMAL(16,2), "
    "split_activity_amount DECIMAL(16,2), split_coupon_amount DECIMAL(16,2), "
    "split_total_amount DECIMAL(16,2), expire_time STRING, create_time STRING, "
    "operate_time STRING, create_date STRING, create_hour STRING, province_name STRING, "
    "province_area_code STRING, province_iso_code STRING, province_3166_2_code STRING, "
    "user_age INT, user_gender STRING, spu_id BIGINT, tm_id BIGINT, category3_id BIGINT, "
    "spu_name STRING, tm_name STRING, category3_name STRING"
)

PAYMENT_WIDE = _struct(
    "payment_id BIGINT, subject STRING, payment_type STRING, payment_create_time STRING, "
    "callback_time STRING, detail_id BIGINT, order_id BIGINT, sku_id BIGINT, "
    "order_price DECIMAL(16,2), sku_num BIGINT, sku_name STRING, province_id BIGINT, "
    "order_status STRING, user_id BIGINT, total_amount DECIMAL(16,2), "
    "activity_reduce_amount DECIMAL(16,2), coupon_reduce_amount DECIMAL(16,2), "
    "original_total_amount DECIMAL(16,2), feight_fee DECIMAL(16,2), "
    "split_feight_fee DECIMAL(16,2), split_activity_amount DECIMAL(16,2), "
    "split_coupon_amount DECIMAL(16,2), split_total_amount DECIMAL(16,2), "
    "order_create_time STRING, province_name STRING, province_area_code STRING, "
    "province_iso_code STRING, province_3166_2_code STRING, user_age INT, user_gender STRING, "
    "spu_id BIGINT, tm_id BIGINT, category3_id BIGINT, spu_name STRING, tm_name STRING, "
    "category3_name STRING"
)

VISITOR_STATS = _struct(
    "stt STRING, edt STRING, vc STRING, ch STRING, ar STRING, is_new STRING, uv_ct BIGINT, "
    "pv_ct BIGINT, sv_ct BIGINT, uj_ct BIGINT, dur_sum BIGINT, ts BIGINT"
)

# Topic and table names of the layers.
ODS_LOG = "ods_base_log"
ODS_DB = "ods_base_db"
DWD_START = "dwd_start_log"
DWD_PAGE = "dwd_page_log"
DWD_DISPLAY = "dwd_display_log"
DWD_DIRTY = "dwd_dirty_log"
DWD_REJECTED = "dwd_rejected_changes"
DWD_ORDER = "dwd_order_info"
DWD_DETAIL = "dwd_order_detail"
DWD_PAYMENT = "dwd_payment_info"
DWM_VISIT = "dwm_unique_visit"
DWM_JUMP = "dwm_user_jump_detail"
DWM_ORDER_WIDE = "dwm_order_wide"
DWM_PAYMENT_WIDE = "dwm_payment_wide"
DWS_VISITOR = "visitor_stats"
DIM_TABLES = (
    "DIM_USER_INFO",
    "DIM_BASE_PROVINCE",
    "DIM_SKU_INFO",
    "DIM_SPU_INFO",
    "DIM_BASE_TRADEMARK",
    "DIM_BASE_CATEGORY3",
)
