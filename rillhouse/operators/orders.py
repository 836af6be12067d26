"""Orders, their details, their dimensions and their payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions.times import (
    age_years,
    date_part,
    hour_part,
    text_time,
    text_time_or_record,
)
from rillhouse.functions.records import computed_once
from rillhouse.operators.joins import interval_join, lookup

ORDER_LOWER_MS, ORDER_UPPER_MS = -5_000, 5_000
PAYMENT_LOWER_MS, PAYMENT_UPPER_MS = -15 * 60_000, 5_000

FROM_ORDER = (
    "order_status", "create_time", "create_date", "create_hour", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "total_amount",
    "province_id", "user_id",
)
FROM_DETAIL = (
    "sku_id", "sku_name", "order_price", "sku_num", "split_activity_amount",
    "split_coupon_amount", "split_total_amount",
)
# Both rows carry these; the payment's value is the one kept, null or not.
PAYMENT_WINS = ("order_id", "user_id", "total_amount")
FROM_PAYMENT = ("subject", "payment_type", "callback_time")

MERGED = (
    "order_status", "create_time", "create_date", "coupon_reduce_amount",
    "activity_reduce_amount", "original_total_amount", "feight_fee", "total_amount", "user_id",
    "sku_id", "sku_name", "order_price", "sku_num",
)


def with_event_time(rows: DataFrame) -> DataFrame:
    """Add `et`, `create_ts` and the date and hour texts from `create_time`."""
    timed = computed_once(rows, *rows.columns, et=text_time(F.col("create_time")))
    return timed.select(
        *rows.columns,
        date_part(F.col("create_time")).alias("create_date"),
        hour_part(F.col("create_time")).alias("create_hour"),
        F.unix_millis("et").alias("create_ts"),
        "et",
    )


def _sided(df: DataFrame, side: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns))


def join_details(
    orders: DataFrame,
    details: DataFrame,
    lower_ms: int = ORDER_LOWER_MS,
    upper_ms: int = ORDER_UPPER_MS,
) -> DataFrame:
    """Order rows with their details, in the `order_wide` layout before dimensions."""
    pairs = interval_join(
        _sided(orders.select("id", *FROM_ORDER, "et"), "o"),
        _sided(details.select("id", "order_id", *FROM_DETAIL, "et"), "d"),
        "o_id", "d_order_id", "o_et", "d_et", lower_ms, upper_ms,
    )
    cells = {"order_id": F.col("o_id"), "detail_id": F.col("d_id")}
    cells |= {c: F.col(f"o_{c}") for c in FROM_ORDER}
    cells |= {c: F.col(f"d_{c}") for c in FROM_DETAIL}
    return pairs.select(
        *(
            cells.get(f.name, F.lit(None).cast(f.dataType.simpleString())).alias(f.name)
            for f in schemas.ORDER_WIDE
        )
    )


def _row_id(df: DataFrame) -> str | None:
    return next((c for c in ("detail_id", "id", "ID") if c in df.columns), None)


def _lookup(df: DataFrame, dim: DataFrame, key: str, take: dict[str, Column]) -> DataFrame:
    return lookup(df, dim, F.col(key), take, row_id=_row_id(df))


def add_user(df: DataFrame, users: DataFrame, as_of_ms: Column | None = None) -> DataFrame:
    take = {
        "user_gender": F.col("GENDER"),
        "user_age": age_years(F.col("BIRTHDAY"), as_of_ms),
    }
    return _lookup(df, users, "user_id", take)


def add_province(df: DataFrame, provinces: DataFrame) -> DataFrame:
    take = {
        "province_name": F.col("NAME"),
        "province_area_code": F.col("AREA_CODE"),
        "province_iso_code": F.col("ISO_CODE"),
        "province_3166_2_code": F.col("ISO_3166_2"),
    }
    return _lookup(df, provinces, "province_id", take)


def add_sku(df: DataFrame, skus: DataFrame) -> DataFrame:
    take = {
        "sku_name": F.col("SKU_NAME"),
        "category3_id": F.col("CATEGORY3_ID").try_cast("bigint"),
        "spu_id": F.col("SPU_ID").try_cast("bigint"),
        "tm_id": F.col("TM_ID").try_cast("bigint"),
    }
    return _lookup(df, skus, "sku_id", take)


def add_spu(df: DataFrame, spus: DataFrame) -> DataFrame:
    return _lookup(df, spus, "spu_id", {"spu_name": F.col("SPU_NAME")})


def add_trademark(df: DataFrame, marks: DataFrame) -> DataFrame:
    return _lookup(df, marks, "tm_id", {"tm_name": F.col("TM_NAME")})


def add_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    return _lookup(df, categories, "category3_id", {"category3_name": F.col("NAME")})


def flat_skus(dims: dict[str, DataFrame]) -> DataFrame:
    """The sku dimension with its spu, trademark and category names.

    Those three hang on ids the sku row gives, so they are looked up once per sku instead of
    once per order row.
    """
    sku, spu, mark, category = (dims[name] for name in schemas.DIM_TABLES[2:])
    ids = {
        "category3_id": F.col("CATEGORY3_ID").try_cast("bigint"),
        "spu_id": F.col("SPU_ID").try_cast("bigint"),
        "tm_id": F.col("TM_ID").try_cast("bigint"),
    }
    rows = sku.select("ID", F.col("SKU_NAME").alias("sku_name"), *(c.alias(n) for n, c in ids.items()))
    return add_category(add_trademark(add_spu(rows, spu), mark), category)


def add_dimensions(
    wide: DataFrame, dims: dict[str, DataFrame], as_of_ms: Column | None = None
) -> DataFrame:
    """All six lookups over an order row that has none of their columns filled yet."""
    user, province = (dims[name] for name in schemas.DIM_TABLES[:2])
    wide = add_province(add_user(wide, user, as_of_ms), province)
    of_sku = (
        "sku_name", "category3_id", "spu_id", "tm_id", "spu_name", "tm_name", "category3_name",
    )
    wide = _lookup(wide, flat_skus(dims), "sku_id", {c: F.col(c) for c in of_sku})
    return wide.select(*schemas.ORDER_WIDE.fieldNames())


def with_payment_time(payments: DataFrame, record_ms: str = "record_ms") -> DataFrame:
    """Add `et` from `create_time`, or the record's arrival when that cannot be read."""
    return computed_once(
        payments, *payments.columns,
        et=text_time_or_record(F.col("create_time"), F.col(record_ms)),
    )


def with_wide_time(wide: DataFrame, record_ms: str | None = None) -> DataFrame:
    if record_ms is None:
        return computed_once(wide, *wide.columns, et=text_time(F.col("create_time")))
    return with_payment_time(wide, record_ms)


def join_payments(
    payments: DataFrame,
    wide: DataFrame,
    lower_ms: int = PAYMENT_LOWER_MS,
    upper_ms: int = PAYMENT_UPPER_MS,
) -> DataFrame:
    """Payments with the order rows they pay for, in the `payment_wide` layout."""
    keep = ("id", *PAYMENT_WINS, *FROM_PAYMENT, "create_time", "et")
    pairs = interval_join(
        _sided(payments.select(*keep), "p"),
        _sided(wide, "w"),
        "p_order_id", "w_order_id", "p_et", "w_et", lower_ms, upper_ms,
    )
    cells = {c: F.col(f"w_{c}") for c in schemas.ORDER_WIDE.fieldNames()}
    cells |= {c: F.col(f"p_{c}") for c in (*PAYMENT_WINS, *FROM_PAYMENT)}
    cells |= {
        "payment_id": F.col("p_id"),
        "payment_create_time": F.col("p_create_time"),
        "order_create_time": F.col("w_create_time"),
    }
    return pairs.select(*(cells[n].alias(n) for n in schemas.PAYMENT_WIDE.fieldNames()))


def fill_from_other(wide: DataFrame, other: DataFrame, key: str = "detail_id") -> DataFrame:
    """Fill nulls of the mergeable fields from the other version of the row.

    The split amounts, and every field not named in `MERGED`, keep their own value.
    """
    theirs = other.select(F.col(key).alias("_other"), *(F.col(c).alias(f"_o_{c}") for c in MERGED))
    joined = wide.join(theirs, F.col(key) == F.col("_other"), "left")
    return joined.select(
        *(
            F.coalesce(F.col(c), F.col(f"_o_{c}")).alias(c) if c in MERGED else F.col(c)
            for c in wide.columns
        )
    )
