import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions import naming, times
from rillhouse.operators import columns, joins, orders
from tests.helpers import millis

ORDER = "id bigint, province_id bigint, order_status string, user_id bigint, " + ", ".join(
    f"{c} decimal(16,2)" for c in ("total_amount", "activity_reduce_amount", "coupon_reduce_amount",
                                   "original_total_amount", "feight_fee")
) + ", create_time string"
DETAIL = (
    "id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2), sku_num bigint, "
    "sku_name string, split_total_amount decimal(16,2), split_activity_amount decimal(16,2), "
    "split_coupon_amount decimal(16,2), create_time string"
)
PAYMENT = (
    "id bigint, order_id bigint, user_id bigint, total_amount decimal(16,2), subject string, "
    "payment_type string, create_time string, callback_time string, record_ms bigint"
)


def order(id_, at, user=7, province=1):
    m = Decimal("10.00")
    return (id_, province, "1001", user, m, m, m, m, m, at)


def detail(id_, order_id, at, sku=3):
    m = Decimal("5.00")
    return (id_, order_id, sku, m, 2, "own name", m, m, m, at)


def frames(spark, orders_, details):
    return (
        orders.with_event_time(spark.createDataFrame(orders_, ORDER)),
        orders.with_event_time(spark.createDataFrame(details, DETAIL)),
    )


def shift_ms(df, ms):
    return df.withColumn("et", F.col("et") + F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND"))


@pytest.mark.parametrize("ms, joins_", [(-5001, 0), (-5000, 1), (0, 1), (5000, 1), (5001, 0)])
def test_order_join_bounds_are_inclusive(spark, ms, joins_):
    o, d = frames(spark, [order(1, "2024-01-01 10:00:00")], [detail(1, 1, "2024-01-01 10:00:00")])
    assert orders.join_details(o, shift_ms(d, ms)).count() == joins_


@pytest.mark.parametrize("ms, joins_", [
    (-900_001, 0), (-900_000, 1), (0, 1), (5000, 1), (5001, 0)])
def test_payment_join_bounds(spark, ms, joins_):
    o, d = frames(spark, [order(1, "2024-01-01 10:00:00")], [detail(1, 1, "2024-01-01 10:00:00")])
    wide = shift_ms(orders.with_wide_time(orders.join_details(o, d)), ms)
    paid = spark.createDataFrame(
        [(9, 1, 7, None, "s", "t", "2024-01-01 10:00:00", None, 0)], PAYMENT
    )
    assert orders.join_payments(orders.with_payment_time(paid), wide).count() == joins_


def test_orders_without_detail_or_readable_time_do_not_join(spark):
    o, d = frames(
        spark,
        [order(1, "2024-01-01 10:00:00"), order(2, "2024-01-01 10:00:00"), order(3, "bad")],
        [detail(1, 1, "2024-01-01 10:00:01"), detail(2, 1, "2024-01-01 10:00:02"),
         detail(3, 3, "2024-01-01 10:00:00"), detail(4, 1, "bad")],
    )
    rows = orders.join_details(o, d).orderBy("detail_id").collect()
    assert [(r.order_id, r.detail_id) for r in rows] == [(1, 1), (1, 2)]
    first = rows[0]
    assert (first.create_time, first.create_date, first.create_hour) == (
        "2024-01-01 10:00:00", "2024-01-01", "10",
    )
    assert (first.split_feight_fee, first.expire_time, first.operate_time) == (None, None, None)
    assert list(first.asDict()) == schemas.ORDER_WIDE.fieldNames()


def test_interval_join_equals_nested_loop_under_a_hot_key(spark):
    rng = random.Random(11)
    left = [(0 if rng.random() < 0.4 else rng.randrange(9), rng.randrange(400_000)) for _ in range(500)]
    right = [(0 if rng.random() < 0.4 else rng.randrange(9), rng.randrange(400_000)) for _ in range(700)]
    lower, upper = -7_000, 3_000
    want = sorted(
        (i, j) for i, (k, t) in enumerate(left) for j, (k2, t2) in enumerate(right)
        if k == k2 and t + lower <= t2 <= t + upper
    )
    a = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "i bigint, k bigint, t bigint")
    b = spark.createDataFrame([(i, *r) for i, r in enumerate(right)], "j bigint, k2 bigint, t2 bigint")
    a = a.withColumn("lt", F.timestamp_millis("t"))
    b = b.withColumn("rt", F.timestamp_millis("t2"))
    got = joins.interval_join(a, b, "k", "k2", "lt", "rt", lower, upper)
    assert sorted((r.i, r.j) for r in got.collect()) == want


def dims(spark):
    def table(text, *rows):
        return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in text.split()))

    return {
        "DIM_USER_INFO": table("ID GENDER BIRTHDAY", ("7", "F", "2000-01-01"), ("8", None, "x")),
        "DIM_BASE_PROVINCE": table("ID NAME AREA_CODE ISO_CODE ISO_3166_2", ("1", "P", "10", "I", "N")),
        "DIM_SKU_INFO": table(
            "ID SKU_NAME CATEGORY3_ID SPU_ID TM_ID", ("3", "sku", "30", "300", "x"), ("4", None, "31", "1", "2")
        ),
        "DIM_SPU_INFO": table("ID SPU_NAME", ("300", "spu")),
        "DIM_BASE_TRADEMARK": table("ID TM_NAME", ("2", "tm")),
        "DIM_BASE_CATEGORY3": table("ID NAME", ("30", "cat")),
    }


def test_dimensions_fill_what_they_have(spark):
    at = "2024-01-01 10:00:00"
    o, d = frames(
        spark, [order(1, at), order(2, at, user=99, province=99)],
        [detail(1, 1, at), detail(2, 2, at, sku=4), detail(3, 2, at, sku=77), detail(4, 2, at, sku=None)],
    )
    as_of = F.lit(millis("2024-01-01 00:00:00"))
    got = {
        r.detail_id: r
        for r in orders.add_dimensions(orders.join_details(o, d), dims(spark), as_of).collect()
    }
    one = got[1]
    assert (one.user_gender, one.user_age, one.province_name, one.province_3166_2_code) == ("F", 24, "P", "N")
    assert (one.sku_name, one.spu_id, one.tm_id, one.category3_id) == ("sku", 300, None, 30)
    assert (one.spu_name, one.tm_name, one.category3_name) == ("spu", None, "cat")
    # A dimension row overwrites the name even with nothing; a missing row leaves it.
    assert (got[2].sku_name, got[2].tm_name, got[2].category3_name) == (None, "tm", None)
    assert (got[3].sku_name, got[3].spu_id) == ("own name", None)
    assert (got[4].sku_name, got[4].user_gender) == ("own name", None)


def test_one_by_one_lookups_equal_the_flat_form(spark):
    at = "2024-01-01 10:00:00"
    o, d = frames(spark, [order(1, at)], [detail(i, 1, at, sku=s) for i, s in enumerate((3, 4, 5, None))])
    joined, tables = orders.join_details(o, d), dims(spark)
    as_of = F.lit(millis("2024-01-01 00:00:00"))
    step = orders.add_province(orders.add_user(joined, tables["DIM_USER_INFO"], as_of), tables["DIM_BASE_PROVINCE"])
    # Only the columns not filled yet are dropped, so that the steps add them.
    step = step.drop("category3_id", "spu_id", "tm_id", "spu_name", "tm_name", "category3_name")
    step = orders.add_spu(orders.add_sku(step, tables["DIM_SKU_INFO"]), tables["DIM_SPU_INFO"])
    step = orders.add_trademark(step, tables["DIM_BASE_TRADEMARK"])
    step = orders.add_category(step, tables["DIM_BASE_CATEGORY3"]).select(*joined.columns)
    flat = orders.add_dimensions(joined, tables, as_of)
    assert sorted(map(str, step.collect())) == sorted(map(str, flat.collect()))


def test_rows_without_a_key_are_scattered(spark):
    left = spark.range(20_000).select("id", F.lit(None).cast("bigint").alias("sku_id"))
    dim = spark.createDataFrame([("1", "a")], "ID string, NAME string")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    conf = {name: spark.conf.get(name) for name in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.lookup(left, dim, F.col("sku_id"), {"name": F.col("NAME")})
        assert out.where("name IS NOT NULL").count() == 0
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 15_000 and out.count() == 20_000
    finally:
        for name, value in conf.items():
            spark.conf.set(name, value)


def test_payment_values_win_even_when_null(spark):
    at = "2024-01-01 10:00:00"
    o, d = frames(spark, [order(1, at)], [detail(5, 1, at)])
    wide = orders.with_wide_time(orders.join_details(o, d))
    paid = spark.createDataFrame([(9, 1, None, None, "s", "t", "n/a", "cb", millis(at) + 1000)], PAYMENT)
    row = orders.join_payments(orders.with_payment_time(paid), wide).first()
    assert (row.payment_id, row.order_id, row.user_id, row.total_amount) == (9, 1, None, None)
    assert (row.payment_create_time, row.order_create_time, row.callback_time) == ("n/a", at, "cb")
    assert list(row.asDict()) == schemas.PAYMENT_WIDE.fieldNames()


def test_fill_from_other(spark):
    at = "2024-01-01 10:00:00"
    o, d = frames(spark, [order(1, at)], [detail(5, 1, at)])
    whole = orders.join_details(o, d)
    gaps = whole
    for c in (*orders.MERGED, "split_total_amount", "create_hour"):
        gaps = gaps.withColumn(c, F.lit(None).cast(whole.schema[c].dataType))
    row, want = orders.fill_from_other(gaps, whole).first(), whole.first()
    assert all(row[c] == want[c] for c in orders.MERGED)
    assert (row.split_total_amount, row.create_hour) == (None, None)


@pytest.mark.parametrize("birthday, want", [
    ("2024-01-01", 0), ("2023-01-01", 1), ("2023-01-02", 0), ("2024-12-31", -1), ("2025-01-01", -1),
    ("2024-06-01", 0), ("x", None), (None, None),
])
def test_age_counts_whole_365_day_years(spark, birthday, want):
    df = spark.createDataFrame([(birthday,)], "b string")
    as_of = F.lit(millis("2024-01-01 00:00:00"))
    got = df.select(times.age_years(F.col("b"), as_of).alias("a")).first().a
    assert got == want


def test_time_helpers(spark):
    df = spark.createDataFrame([("2024-01-01 08:00:00", 5), ("bad", 7), (None, 9)], "t string, ms bigint")
    rows = df.select(
        times.text_millis_at_offset(F.col("t")).alias("a"),
        F.unix_millis(times.text_time_or_record(F.col("t"), F.col("ms"))).alias("b"),
        times.day_of(F.col("ms")).alias("d"),
        times.hour_part(F.col("t")).alias("h"),
    ).collect()
    assert [r.a for r in rows] == [millis("2024-01-01 00:00:00"), None, None]
    assert [r.b for r in rows] == [millis("2024-01-01 08:00:00"), 7, 9]
    assert rows[0].d == "1970-01-01" and rows[0].h == "08"


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2)], "ORDER_ID int, SKU_name int")
    assert naming.camel_columns(df).columns == ["orderId", "skuName"]
    assert naming.camel("a_b__c_d1") == "aBCD1"
    marked = columns.mark_transient(df, "SKU_name")
    assert marked.columns == df.columns and columns.drop_transient(marked).columns == ["ORDER_ID"]
