"""One named query per operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas
from rillhouse.functions import naming, records, times
from rillhouse.operators import changes, columns, joins, logs, orders, stats, visitors
from rillhouse.plans import adapters, warehouse
from rillhouse.session import checkpoint_root
from rillhouse.sinks import dimensions

# The tables' own tempo: hours between a user's events, days between an order and its lines.
HORIZON_MS = 6 * 3_600_000
WINDOW = "6 hours"
DETAIL_BOUND_MS = 30 * times.DAY_MS

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name."""
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _doubles(df: DataFrame) -> DataFrame:
    """Money as double, for comparing engines."""
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _records(spark: SparkSession, d: str) -> DataFrame:
    return logs.clean_records(adapters.raw_log_lines(spark, d))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return logs.page_logs(_records(spark, d))


def _as_of():
    return F.unix_millis(F.lit(adapters.AS_OF).cast("timestamp"))


# Behaviour log


@query
def log_parse(spark, d):
    return _records(spark, d).select(
        "seq", "mid", "is_new", "vc", "ch", "ar", "page_id", "last_page_id", "during_time",
        "start", F.coalesce(F.size("displays"), F.lit(-1)).alias("n_displays"), "ts",
    )


@query
def log_dirty(spark, d):
    return logs.dirty_lines(adapters.raw_log_lines(spark, d))


@query
def new_visitor_fix(spark, d):
    fixed = visitors.fix_new_visitors(_records(spark, d))
    return fixed.select("seq", "mid", "ts", "raw_is_new", "is_new")


@query
def log_start(spark, d):
    return logs.start_logs(_records(spark, d)).select("seq", "mid", "start", "ts")


@query
def log_page(spark, d):
    return _pages(spark, d).select("seq", "mid", "page_id", "last_page_id", "during_time", "ts")


@query
def log_display(spark, d):
    shown = logs.display_logs(_records(spark, d), "seq")
    return shown.select(
        "seq",
        F.get_json_object("display", "$.item").alias("item"),
        F.get_json_object("display", "$.pos").alias("pos"),
        F.get_json_object("display", "$.page_id").alias("page_id"),
        "display",
    )


@query
def log_topics(spark, d):
    fixed = visitors.fix_new_visitors(_records(spark, d))
    lines = logs.routed_lines(fixed)

    def at(path):
        return F.get_json_object("value", path)

    return lines.select(
        "topic", "seq",
        at("$.common.mid").alias("mid"),
        at("$.common.is_new").alias("is_new"),
        at("$.ts").cast("bigint").alias("ts"),
        at("$.page.page_id").alias("page_page_id"),
        at("$.item").alias("item"),
        at("$.page_id").alias("display_page_id"),
        "value",
    )


@query
def entry_pages(spark, d):
    return logs.entry_pages(_pages(spark, d)).select("seq", "mid", "ts")


@query
def unique_visit(spark, d):
    visits = visitors.first_visits(_pages(spark, d))
    return visits.select("seq", "mid", "dt", "ts", "page_id")


@query
def user_jump(spark, d):
    jumps = visitors.bounces(_pages(spark, d), HORIZON_MS)
    return jumps.select("seq", "mid", "ts", "page_id")


@query
def user_jump_inclusive(spark, d):
    """Whole-hour times, so that pages exactly at the horizon occur."""
    hourly = _pages(spark, d).withColumn("ts", F.col("ts") - F.col("ts") % 3_600_000)
    jumps = visitors.bounces(hourly, HORIZON_MS, inclusive=True)
    return jumps.select("seq", "mid", "ts", "page_id")


@query
def user_jump_followed(spark, d):
    jumps = visitors.followed_bounces(_pages(spark, d), HORIZON_MS)
    return jumps.select("seq", "mid", "ts", "page_id")


@query
def user_jump_timed_out(spark, d):
    jumps = visitors.timed_out_bounces(_pages(spark, d), HORIZON_MS)
    return jumps.select("seq", "mid", "ts", "page_id")


@query
def user_jump_union(spark, d):
    """Both kinds from one pass, told apart by a column instead of a union of two outputs."""
    jumps = visitors.bounces(_pages(spark, d), HORIZON_MS, with_kind=True)
    return jumps.select("seq", "mid", "ts", "bounce_kind")


@query
def visit_flags(spark, d):
    flagged = visitors.visit_flags(_records(spark, d), HORIZON_MS)
    return flagged.select("seq", "mid", "ts", "is_new", "is_visit", "is_bounce")


# Visitor statistics


@query
def visitor_shape_uv(spark, d):
    return stats.shape_visits(visitors.first_visits(_pages(spark, d)))


@query
def visitor_shape_uj(spark, d):
    return stats.shape_bounces(visitors.bounces(_pages(spark, d), HORIZON_MS))


@query
def visitor_shape_pv(spark, d):
    return stats.shape_pages(_pages(spark, d))


@query
def visitor_union(spark, d):
    pages = _pages(spark, d)
    return stats.union_shaped(
        visitors.first_visits(pages), visitors.bounces(pages, HORIZON_MS), pages
    )


@query
def visitor_stats(spark, d):
    return warehouse.visitor_stats(adapters.raw_log_lines(spark, d), WINDOW, HORIZON_MS)


@query
def visitor_stats_layered(spark, d):
    fixed = warehouse.corrected_records(adapters.raw_log_lines(spark, d))
    return warehouse.visitor_stats_from_layers(logs.page_logs(fixed), WINDOW, HORIZON_MS)


@query
def visitor_stats_10s(spark, d):
    return warehouse.visitor_stats(adapters.raw_log_lines(spark, d))


# Changes and routing


@query
def cdc_envelope(spark, d):
    return changes.envelopes(adapters.change_events(spark, d), "seq")


@query
def cdc_topic_roundtrip(spark, d):
    """Envelopes written as topic text and read back."""
    envelopes = changes.envelopes(adapters.change_events(spark, d), "seq")
    back = changes.read_envelopes(changes.envelope_line(envelopes, "seq"), "seq")
    return back.select(
        "seq", "database", "tableName", "type",
        F.get_json_object("before", "$.id").alias("before_id"),
        F.get_json_object("after", "$.id").alias("after_id"),
    )


def _changes(spark, d):
    return changes.envelopes(adapters.change_events(spark, d), "seq")


def _routed(spark, d):
    return changes.route_changes(_changes(spark, d), adapters.rules(spark))


@query
def cdc_no_delete(spark, d):
    return changes.drop_deletes(_changes(spark, d)).select("seq", "tableName", "type")


@query
def rule_match(spark, d):
    matched = changes.match_rules(
        changes.drop_deletes(_changes(spark, d)), adapters.rules(spark)
    )
    return matched.where(F.col("sink_table").isNotNull()).select(
        "seq", "tableName", "type", "sink_type", "sink_table"
    )


@query
def rule_match_as_of(spark, d):
    """Each change by the rule that held at its position, while rules change, go and come back."""
    versions = changes.rule_versions(adapters.rule_changes(spark))
    routed = changes.match_rules(changes.drop_deletes(_changes(spark, d)), versions)
    return routed.select("seq", "tableName", "type", "route", "reject_reason", "sink_table", "sink_columns")


@query
def rule_rejects(spark, d):
    return changes.rejects(_routed(spark, d)).select("seq", "tableName", "type", "reject_reason")


@query
def rule_column_filter(spark, d):
    routed = _routed(spark, d).where(F.col("route") != "reject")
    return routed.select("seq", "sink_table", "after")


@query
def rule_config_latest(spark, d):
    """The rules in force and how many changes each one meets."""
    counts = changes.drop_deletes(_changes(spark, d)).groupBy("tableName", "type").agg(
        F.count(F.lit(1)).alias("n_changes")
    )
    active = changes.current_rules(adapters.rules(spark))
    on = (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type"))
    return active.join(counts, on, "left").select(
        "source_table", "operate_type", "sink_type", "sink_table", "sink_columns",
        F.coalesce("n_changes", F.lit(0).cast("bigint")).alias("n_changes"),
    )


@query
def fact_topics(spark, d):
    return changes.topic_rows(changes.facts(_routed(spark, d)))


@query
def dim_upsert_fields(spark, d):
    """Field names and values an upsert would carry, as comma text."""
    rows = changes.dimension_rows(_routed(spark, d))
    return rows.select(
        "seq", F.upper("sink_table").alias("sink_table"),
        changes.listed_fields(F.col("after")).alias("fields"),
        changes.listed_values(F.col("after")).alias("values"),
    )


@query
def dim_latest(spark, d):
    rows = changes.dimension_images(_routed(spark, d))
    schema = changes.dimension_schema("id,name,seg")
    return changes.dimension_table(rows, schema)


def _store(spark, table, columns, pk="id"):
    base = f"{checkpoint_root(spark)}/dims-{uuid.uuid4().hex}"
    dimensions.create_table(spark, base, table, columns, pk)
    return base


def _images(df, table, *fields):
    return df.select(records.json_line(*fields).alias("after"), F.lit(0).cast("bigint").alias("seq"), F.lit(table).alias("sink_table"), F.lit("id").alias("sink_pk"))


@query
def dim_store_restart(spark, d):
    """The user dimension when its job is restarted with a new checkpoint, whose batches count anew."""
    base = _store(spark, "dim_user_info", "id,name,seg")
    rows = changes.dimension_images(_routed(spark, d))
    first, second = rows.where("type = 'insert'"), rows.where("type = 'update'")
    for _ in range(2):
        dimensions.append_changes(first, 0, base, "one")
    dimensions.append_changes(first.where("false"), 1, base, "one")
    dimensions.compact(spark, base)
    for _ in range(2):
        dimensions.append_changes(second, 0, base, "two")
    return dimensions.read_table(spark, base, "dim_user_info")


@query
def dim_store_compacted(spark, d):
    """The user dimension out of many batches, merged on the way, with what was merged removed."""
    base = _store(spark, "dim_user_info", "id,name,seg")
    rows = changes.dimension_images(_routed(spark, d))
    steps = [rows.where(f"type = '{t}' and seq div 4 % 3 = {i}") for t in ("insert", "update") for i in range(3)]
    for batch, step in enumerate(steps):
        dimensions.append_changes(step, batch, base, "one")
        dimensions.merge(spark, base, fan_in=2)
    dimensions.vacuum(spark, base)
    return dimensions.read_table(spark, base, "dim_user_info")


@query
def dim_store_partial_update(spark, d):
    """Images of some columns: the others stay, a null overwrites, and a merge keeps both apart."""
    base = _store(spark, "dim_user_info", "id,name,seg")
    key = F.col("c_custkey")
    users = adapters.load(spark, d, "customer").select(key.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    renamed = users.where("id % 10 < 4").withColumn("name", F.concat(F.lit("new "), "name"))
    cleared = users.where("id % 5 = 0").select(
        F.concat(F.lit('{"id":'), "id", F.lit(',"seg":null}')).alias("after"), F.lit(0).cast("bigint").alias("seq"),
        F.lit("dim_user_info").alias("sink_table"), F.lit("id").alias("sink_pk"),
    )
    dimensions.append_changes(_images(users, "dim_user_info", "id", "name", "seg"), 0, base)
    dimensions.append_changes(_images(renamed, "dim_user_info", "id", "name"), 1, base)
    dimensions.append_changes(cleared, 2, base)
    dimensions.compact(spark, base, upto=1)
    return dimensions.read_table(spark, base, "dim_user_info")


@query
def dim_store_layout(spark, d):
    """The tables that the rules made, with what their rows hold."""
    base = f"{checkpoint_root(spark)}/dims-{uuid.uuid4().hex}"
    dimensions.create_tables(spark, base, adapters.rules(spark))
    dimensions.append_changes(changes.dimension_images(_routed(spark, d)), 0, base)
    names = dimensions.layouts(spark, base).groupBy("sink_table", "sink_columns").agg(F.count("*").alias("n_rules"))
    counts = dimensions.merged_images(dimensions.images(spark, base)).groupBy("sink_table").agg(F.count("*").alias("n_keys"))
    return names.join(counts, "sink_table", "left")


@query
def bean_parse(spark, d):
    """Order beans out of their JSON text."""
    rows = adapters.order_info(spark, d)
    fields = schemas.ORDER_INFO.fieldNames()
    lines = rows.select(records.json_line(*fields).alias("value"), F.col("id").alias("seq"))
    beans = records.parse_bean(lines, schemas.ORDER_INFO, "value", "seq")
    return _doubles(beans.select("seq", *fields))


# Orders


@query
def order_time_parts(spark, d):
    return adapters.order_info(spark, d).select(
        "id", "create_time", "create_date", "create_hour", "create_ts"
    )


def _joined(spark, d):
    return orders.join_details(
        adapters.order_info(spark, d), adapters.order_detail(spark, d),
        -DETAIL_BOUND_MS, DETAIL_BOUND_MS,
    )


@query
def order_interval_join(spark, d):
    return _doubles(_joined(spark, d))


def _ids(spark, d):
    """Every line item's and its order's keys: the left side of the lookups."""
    part = F.col("l_partkey")
    return adapters.load(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(part % 41 != 0, part).alias("sku_id"),
        F.concat(F.lit("sku "), part.cast("string")).alias("sku_name"),
        (F.col("l_orderkey") % 28).alias("province_id"),
        F.floor(F.col("l_orderkey") / 10).alias("user_id"),
    )


def _dims(spark, d):
    return adapters.dimensions(spark, d)


@query
def lookup_user(spark, d):
    dim = _dims(spark, d)["DIM_USER_INFO"]
    wide = orders.add_user(_ids(spark, d), dim, _as_of())
    return wide.select("id", "sku_id", "user_id", "user_gender", "user_age")


@query
def lookup_province(spark, d):
    wide = orders.add_province(_ids(spark, d), _dims(spark, d)["DIM_BASE_PROVINCE"])
    return wide.select(
        "id", "sku_id", "province_id", "province_name", "province_area_code",
        "province_iso_code", "province_3166_2_code",
    )


def _with_sku(spark, d):
    return orders.add_sku(_ids(spark, d), _dims(spark, d)["DIM_SKU_INFO"])


@query
def lookup_sku(spark, d):
    return _with_sku(spark, d).select(
        "id", "sku_id", "sku_name", "category3_id", "spu_id", "tm_id"
    )


@query
def lookup_spu(spark, d):
    wide = orders.add_spu(_with_sku(spark, d), _dims(spark, d)["DIM_SPU_INFO"])
    return wide.select("id", "sku_id", "spu_id", "spu_name")


@query
def lookup_trademark(spark, d):
    wide = orders.add_trademark(_with_sku(spark, d), _dims(spark, d)["DIM_BASE_TRADEMARK"])
    return wide.select("id", "sku_id", "tm_id", "tm_name")


@query
def lookup_category(spark, d):
    wide = orders.add_category(_with_sku(spark, d), _dims(spark, d)["DIM_BASE_CATEGORY3"])
    return wide.select("id", "sku_id", "category3_id", "category3_name")


@query
def point_lookup(spark, d):
    """One key of the stored sku dimension, in the key range that holds it."""
    base = _store(spark, "dim_sku_info", "id,sku_name,category3_id,spu_id,tm_id")
    skus = _dims(spark, d)["DIM_SKU_INFO"].toDF("id", "sku_name", "category3_id", "spu_id", "tm_id")
    for batch, part in enumerate((skus.where("id % 2 = 0"), skus.where("id % 2 <> 0"))):
        dimensions.append_changes(_images(part, "dim_sku_info", *skus.columns), batch, base)
    dimensions.compact(spark, base)
    return joins.point_lookup(dimensions.read_table(spark, base, "dim_sku_info"), "18")


def _order_wide(spark, d):
    return warehouse.order_wide(
        adapters.order_info(spark, d), adapters.order_detail(spark, d), _dims(spark, d),
        -DETAIL_BOUND_MS, DETAIL_BOUND_MS, _as_of(),
    )


@query
def order_wide(spark, d):
    return _doubles(_order_wide(spark, d))


@query
def payment_time_fallback(spark, d):
    timed = orders.with_payment_time(adapters.payment_info(spark, d))
    return timed.select("id", "create_time", F.unix_millis("et").alias("event_ms"))


@query
def payment_interval_join(spark, d):
    """Payments against bare orders, at the bounds the payment job uses."""
    pay = orders.with_payment_time(adapters.payment_info(spark, d)).select(
        F.col("id").alias("payment_id"), F.col("order_id").alias("p_order_id"),
        F.col("et").alias("p_et"),
    )
    order = adapters.order_info(spark, d).select(
        F.col("id").alias("o_id"), F.col("et").alias("o_et")
    )
    pairs = joins.interval_join(
        pay, order, "p_order_id", "o_id", "p_et", "o_et",
        orders.PAYMENT_LOWER_MS, orders.PAYMENT_UPPER_MS,
    )
    return pairs.select(
        "payment_id", "o_id",
        (F.unix_millis("p_et") - F.unix_millis("o_et")).alias("lag_ms"),
    )


@query
def payment_wide(spark, d):
    wide = _order_wide(spark, d)
    return _doubles(warehouse.payment_wide(adapters.payment_info(spark, d), wide))


@query
def coalesce_merge(spark, d):
    """Order rows with gaps, filled from the complete version of the same row."""
    whole = adapters.order_info(spark, d).select(
        F.col("id").alias("detail_id"),
        *(
            F.col(c) if c in schemas.ORDER_INFO.fieldNames() else F.lit(None).cast("bigint").alias(c)
            for c in orders.MERGED
        ),
        F.col("feight_fee").alias("split_total_amount"),
        "create_hour",
    )
    gaps = whole
    for step, name in enumerate(("order_status", "user_id", "total_amount", "create_date",
                                 "split_total_amount", "create_hour"), start=2):
        gaps = gaps.withColumn(name, F.when(F.col("detail_id") % step != 0, F.col(name)))
    filled = orders.fill_from_other(gaps, whole)
    return _doubles(filled.select(
        "detail_id", "order_status", "user_id", "total_amount", "create_date",
        "split_total_amount", "create_hour",
    ))


# Small column operators


@query
def camel_rename(spark, d):
    return naming.camel_columns(adapters.load(spark, d, "nation"))


@query
def drop_transient(spark, d):
    marked = columns.mark_transient(adapters.load(spark, d, "supplier"), "s_acctbal")
    return columns.drop_transient(marked)


@query
def time_formats(spark, d):
    """Instant to text and day, and text in a fixed offset back to milliseconds."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    text = times.format_instant(F.timestamp_millis(ms))
    events = adapters.load(spark, d, "events")
    return events.select(
        "event_id",
        text.alias("instant"),
        times.day_of(ms).alias("day"),
        times.text_millis_at_offset(text).alias("at_plus_8"),
    )


@query
def age_in_years(spark, d):
    users = _dims(spark, d)["DIM_USER_INFO"]
    return users.select("ID", "BIRTHDAY", times.age_years(F.col("BIRTHDAY"), _as_of()).alias("age"))
