"""The given star-schema tables, read as the warehouse's own inputs.

Every mapping is a per-row projection, so inputs grow with the tables and no key is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions.times import SECONDS_FORMAT
from rillhouse.operators.orders import with_event_time

AS_OF = "2024-06-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(amount: Column) -> Column:
    return F.floor(amount * 100 + 0.5)


def _money(cents: Column) -> Column:
    # Multiplying decimals is much cheaper than dividing them.
    return (cents.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(schemas.MONEY)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _object(*fields: Column) -> Column:
    """JSON object text from `"name":value` texts; null ones are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value)


def load_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; the pattern lets one file stand where a folder is expected."""
    schema = load(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour log lines, `value, seq`, out of `events`, with every kind of broken line."""
    return log_lines(load(spark, sf_dir, "events"))


def log_lines(table: DataFrame) -> DataFrame:
    events = table.select(
        "event_id",
        "user_id",
        "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        _cents(F.col("value")).alias("spent"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    k, u, kind = F.col("k"), F.col("user_id"), F.col("event_type")

    def text(column: Column) -> Column:
        return column.cast("string")

    common = _object(
        _field("mid", _quoted(F.concat(F.lit("mid_"), text(u)))),
        _field("is_new", F.when(k < 30, '"1"').otherwise('"0"')),
        _field("vc", _quoted(F.concat(F.lit("v"), text(u % 3)))),
        _field("ch", _quoted(F.concat(F.lit("c"), text(k % 4)))),
        _field("ar", _quoted(F.concat(F.lit("a"), text(u % 5)))),
        # Fields that no schema declares, one of them repeated and spelled with blanks.
        F.when(kind != "error", F.lit('"os" : "x\\"{,"')),
    )
    extra = F.when((kind != "error") & (k % 6 == 0), F.lit('"extra":{"n": 1.50}, "extra":[1,{"d":null}]'))
    last_page = (
        F.when(k % 10 < 3, None)
        .when(k % 10 == 3, "null")
        .when(k % 10 == 4, '""')
        .otherwise(_quoted(F.concat(F.lit("page_"), text(k % 7))))
    )
    page = _object(
        _field("page_id", _quoted(kind)),
        _field("last_page_id", last_page),
        _field("during_time", F.when(k % 11 != 0, text(F.col("spent")))),
    )
    item = _field("item", _quoted(F.concat(F.lit("i"), text(k))))
    displays = (
        F.when((kind == "purchase") & (k % 9 == 0), F.concat(F.lit("["), _object(item), F.lit("]")))
        .when((kind != "view") | (k % 4 == 3), None)
        .when(k % 4 == 0, "[]")
        .when(k % 4 == 1, F.concat(F.lit("["), _object(item, F.lit('"pos":1,"flag":true,"deep":{"a":[1.50,"}"]}')), F.lit("]")))
        .otherwise(
            F.concat(
                F.lit("["),
                _object(item, F.lit('"pos":1')),
                F.lit(","),
                _object(F.lit('"page_id":"old"'), item, F.lit('"pos":2')),
                F.lit("]"),
            )
        )
    )
    start = F.when(kind == "signup", (
        F.when(k % 5 == 0, "{}")
        .when(k % 5 == 1, "null")
        .otherwise(_object(F.lit('"entry":"icon"'), _field("ms", text(k))))
    ))
    broken = kind == "error"
    line = _object(
        F.when(broken & (k % 8 == 5), None)
        .when(broken & (k % 8 == 6), '"common":null')
        .otherwise(_field("common", common)),
        F.when(~((kind == "purchase") & (k % 9 == 0)), _field("page", page)),
        _field("displays", displays),
        _field("start", start),
        extra,
        _field("ts", F.when(broken & (k % 8 == 7), '"n/a"').otherwise(text(F.col("ms")))),
    )
    value = (
        F.when(broken & (k % 8 == 0), F.expr("substring(_line, 1, length(_line) - 1)"))
        .when(broken & (k % 8 == 1), F.concat(F.lit("["), F.col("_line"), F.lit("]")))
        .when(broken & (k % 8 == 2), "null")
        .when(broken & (k % 8 == 3), "")
        .when(broken & (k % 8 == 4), F.concat(F.col("_line"), F.lit(" x")))
        .otherwise(F.col("_line"))
    )
    return events.withColumn("_line", line).select(value.alias("value"), F.col("event_id").alias("seq"))


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change events, `topic, before, after, op, seq`, for `customer` and `orders`.

    A customer is created, some are then renamed, some then deleted; an order comes once.
    """
    customer = load(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    key_text = key.cast("string")
    segment = _field("seg", _quoted(F.col("c_mktsegment")))
    cents = _field("cents", _cents(F.col("c_acctbal")).cast("string"))
    name = F.when(key % 17 == 0, "null").otherwise(_quoted(F.col("c_name")))
    created = _object(_field("id", key_text), _field("name", name), segment, cents)
    renamed = _object(
        _field("id", key_text),
        _field("name", _quoted(F.concat(F.lit("new "), F.col("c_name")))),
        segment,
        cents,
    )
    word = key % 2 == 0

    def step(when: Column, offset: int, before: Column, after: Column, name: str, letter: str):
        return F.when(
            when,
            F.struct(
                before.cast("string").alias("before"),
                after.cast("string").alias("after"),
                F.when(word, name).otherwise(letter).alias("op"),
                (key * 4 + offset).alias("seq"),
            ),
        )

    none = F.lit(None)
    steps = F.array_compact(
        F.array(
            step(key % 10 != 4, 0, none, created, "create", "c"),
            step(key % 10 == 4, 0, none, created, "READ", "r"),
            step(key % 10 < 4, 1, created, renamed, "update", "u"),
            step(key % 10 == 0, 2, renamed, none, "delete", "d"),
        )
    )
    customers = customer.select(
        F.lit("mysql.shop.customer").alias("topic"), F.inline(steps)
    )

    orders = load(spark, sf_dir, "orders")
    okey = F.col("o_orderkey")
    order = _object(
        _field("id", okey.cast("string")),
        _field("user_id", F.col("o_custkey").cast("string")),
        _field("status", _quoted(F.col("o_orderstatus"))),
        _field("cents", _cents(F.col("o_totalprice")).cast("string")),
    )
    op = (
        F.when(okey % 23 == 0, None)
        .when(okey % 10 == 0, "delete")
        .when(okey % 10 < 4, "update")
        .otherwise("create")
    )
    sales = orders.select(
        F.lit("mysql.shop.orders").alias("topic"),
        F.when(okey % 10 < 4, order).alias("before"),
        F.when(~op.eqNullSafe("delete"), order).alias("after"),
        op.alias("op"),
        okey.alias("seq"),
    )
    return customers.unionByName(sales)


def rules(spark: SparkSession) -> DataFrame:
    """A small rule table: dimensions, a fact, an unknown target, and one overridden rule."""
    rows = [
        ("customer", "insert", "kafka", "dwd_wrong", "id", None, None, 0),
        ("customer", "insert", "hbase", "dim_user_info", "id,name,seg", "id", None, 1),
        ("customer", "update", "hbase", "dim_user_info", "id,name,seg", None, None, 2),
        ("orders", "insert", "kafka", "dwd_order_info", "id,user_id,cents", None, None, 3),
        ("orders", "update", "clickhouse", "ck_orders", "id", None, None, 4),
    ]
    layout = ", ".join(f"{n} STRING" for n in schemas.RULE.fieldNames())
    return spark.createDataFrame(rows, f"{layout}, rule_seq BIGINT")


def rule_changes(spark: SparkSession) -> DataFrame:
    """The change log of the rules: one is widened, one deleted and back as a fact, one corrected at once."""
    rows = [
        ("customer", "insert", "hbase", "dim_user_info", "id,name", "id", None, 1, 0, False),
        ("customer", "insert", "hbase", "dim_user_info", "id,name,seg", "id", None, 2, 120, False),
        ("customer", "insert", None, None, None, None, None, 3, 240, True),
        ("customer", "insert", "kafka", "dwd_customer", "id,cents", None, None, 4, 400, False),
        ("customer", "update", "hbase", "dim_user_info", "id,name,seg", None, None, 5, 300, False),
        ("orders", "insert", "clickhouse", "ck_orders", "id", None, None, 6, 0, False),
        ("orders", "insert", "kafka", "dwd_order_info", "id,user_id,cents", None, None, 7, 0, False),
        ("orders", "update", "kafka", "dwd_order_info", "id,status", None, None, 8, 0, False),
        ("orders", "update", None, None, None, None, None, 9, 700, True),
    ]
    layout = ", ".join(f"{n} STRING" for n in schemas.RULE.fieldNames())
    return spark.createDataFrame(rows, f"{layout}, rule_seq BIGINT, valid_from BIGINT, deleted BOOLEAN")


def _clock(day: Column, seconds: Column) -> Column:
    """A whole day plus seconds, as text."""
    at = F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + seconds)
    return F.date_format(at, SECONDS_FORMAT)


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the `order_info` layout with `et`; every 29th has an unreadable time."""
    return order_rows(load(spark, sf_dir, "orders"))


def order_rows(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    created = _clock(F.col("o_orderdate"), (key * 37) % 86_400)
    total = _cents(F.col("o_totalprice"))
    rows = orders.select(
        key.alias("id"),
        (F.col("o_custkey") % 27).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        _money(total).alias("total_amount"),
        _money(key % 500).alias("activity_reduce_amount"),
        _money(key % 300).alias("coupon_reduce_amount"),
        _money(total + key % 500 + key % 300).alias("original_total_amount"),
        _money(key % 1000).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        F.when(key % 29 == 28, "soon").otherwise(created).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )
    return with_event_time(rows)


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the `order_detail` layout with `et`."""
    return detail_rows(load(spark, sf_dir, "lineitem"))


def detail_rows(lines: DataFrame) -> DataFrame:
    key, number = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
    total = _cents(F.col("l_extendedprice"))
    seconds = (key * 37) % 86_400 + number % 3 - 1
    rows = lines.select(
        (key * 10 + number).alias("id"),
        key.alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _money(total).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku "), F.col("l_partkey").cast("string")).alias("sku_name"),
        _clock(F.col("l_shipdate"), seconds).alias("create_time"),
        _money(total - F.col("l_partkey") % 100).alias("split_total_amount"),
        _money(F.col("l_partkey") % 60).alias("split_activity_amount"),
        _money(F.col("l_partkey") % 40).alias("split_coupon_amount"),
    )
    return with_event_time(rows)


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment per order with `record_ms`; some have no amount, no readable time or no order."""
    orders = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    seconds = (key * 37) % 86_400 + (key % 40 - 15) * 60
    paid = _clock(F.col("o_orderdate"), seconds)
    # Record time is the text's own instant plus a minute.
    arrived = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + (seconds + 60) * 1000
    return orders.select(
        (key + 1_000_000_000).alias("id"),
        _unmatched(key, key % 7 == 0).alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(key % 13 != 0, _money(_cents(F.col("o_totalprice")))).alias("total_amount"),
        F.concat(F.lit("order "), key.cast("string")).alias("subject"),
        F.concat(F.lit("p"), (key % 4).cast("string")).alias("payment_type"),
        F.when(key % 17 == 0, "n/a").otherwise(paid).alias("create_time"),
        F.when(key % 3 == 0, paid).alias("callback_time"),
        arrived.alias("record_ms"),
    )


def _unmatched(key: Column, gap: Column) -> Column:
    """The key, or where there is to be a gap its negative, which nothing refers to."""
    return F.when(gap, -key).otherwise(key)


def _text_columns(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six keyed dimension tables, all columns text, some keys unmatched on purpose."""
    customer = load(spark, sf_dir, "customer")
    ckey = F.col("c_custkey")
    users = customer.select(
        _unmatched(ckey, ckey % 13 == 0).alias("ID"),
        F.when(ckey % 11 == 0, None).when(ckey % 2 == 0, "F").otherwise("M").alias("GENDER"),
        F.date_add(F.lit("1960-01-01").cast("date"), (ckey * 17 % 24_000).cast("int")).alias("BIRTHDAY"),
    )
    nation = load(spark, sf_dir, "nation")
    nkey = F.col("n_nationkey").cast("string")
    provinces = nation.select(
        nkey.alias("ID"),
        F.col("n_name").alias("NAME"),
        F.col("n_regionkey").alias("AREA_CODE"),
        F.concat(F.lit("ISO"), nkey).alias("ISO_CODE"),
        F.concat(F.lit("N-"), nkey).alias("ISO_3166_2"),
    )
    part = load(spark, sf_dir, "part")
    pkey = F.col("p_partkey")
    brand = F.regexp_replace("p_brand", "Brand#", "")
    category = F.ascii(F.col("p_type")) * 100 + F.length("p_type")
    skus = part.select(
        _unmatched(pkey, pkey % 31 == 0).alias("ID"),
        F.col("p_name").alias("SKU_NAME"),
        category.alias("CATEGORY3_ID"),
        F.floor(pkey / 20).alias("SPU_ID"),
        F.when(pkey % 50 == 7, F.concat(F.lit("x"), brand)).otherwise(brand).alias("TM_ID"),
    )
    supplier = load(spark, sf_dir, "supplier")
    skey = F.col("s_suppkey")
    spus = supplier.select(
        _unmatched(skey, skey % 19 == 0).alias("ID"), F.col("s_name").alias("SPU_NAME")
    )
    marks = part.groupBy("p_brand").agg(F.min(brand).alias("ID"))
    number = F.col("ID").cast("int")
    marks = marks.select(
        _unmatched(number, number % 9 == 0).alias("ID"), F.concat(F.lit("tm "), F.col("p_brand")).alias("TM_NAME")
    )
    categories = part.groupBy("p_type").agg(F.min(category).alias("ID")).select(
        "ID", F.col("p_type").alias("NAME")
    )
    tables = (users, provinces, skus, spus, marks, categories)
    return {name: _text_columns(df) for name, df in zip(schemas.DIM_TABLES, tables)}
