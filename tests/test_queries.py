"""Every registered query against its DuckDB text on the smallest tables, and its plan."""

import re

import pytest

import __spark_entry__ as entry
import check
import oracles
from rillhouse.operators import visitors
from rillhouse.plans import adapters, lake, queries

TINY = "/root/testdata/sf0.001"
#: The library's own queries; those of the subpackage are tested beside it.
QUERIES = queries.all_queries()
ORACLE = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(TINY)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = check.compare(spark, con, TINY, name, QUERIES[name], ORACLE[name])
    assert ok and "differ" not in note, note


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plan_has_no_pairs_of_all_rows_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, TINY))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas", plan), plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["stt", "edt"] and df.count() > 0


def without_broadcast(spark, build):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        return plan_of(build())
    finally:
        spark.conf.set(conf, kept)


def test_statistics_shuffle_the_wide_rows_once(spark):
    plan = without_broadcast(spark, lambda: QUERIES["visitor_stats"](spark, TINY))
    join = plan.index("SortMergeJoin")
    left = plan[join:].split("\n                  +- Sort")[0]
    # Window and join use the one exchange by device and slice; no other on the wide side.
    assert left.count("Exchange hashpartitioning(mid") == 1, left
    assert plan.count("from_json(") == 2, plan


def test_first_visit_and_latest_row_rank_before_the_shuffle(spark):
    for name in ("unique_visit", "dim_latest"):
        plan = plan_of(QUERIES[name](spark, TINY))
        top = plan[plan.index("WindowGroupLimit"):]
        assert top.index("Final") < top.index("Exchange hashpartitioning") < top.index("Partial")


def test_scan_reads_only_what_is_asked(spark):
    plan = plan_of(queries.lookup_province(spark, TINY))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    plan = plan_of(queries.camel_rename(spark, TINY).where("nNationkey = 3"))
    assert "PushedFilters: [IsNotNull(n_nationkey), EqualTo(n_nationkey,3)]" in plan


def test_stored_layers_equal_the_direct_plan(spark, folder):
    stored = lake.build_log_layers(
        adapters.raw_log_lines(spark, TINY), folder, queries.WINDOW, queries.HORIZON_MS
    )
    direct = queries.visitor_stats(spark, TINY)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))
    jumps = spark.read.parquet(f"{folder}/dwm_user_jump_detail")
    pages = queries._pages(spark, TINY)
    assert jumps.count() == visitors.bounces(pages, queries.HORIZON_MS).count()
    assert lake.topic_lines(spark, folder, "start").count() == queries.log_start(spark, TINY).count()


def test_stored_orders_equal_the_direct_plan(spark, folder):
    bound = queries.DETAIL_BOUND_MS
    stored = lake.build_order_layers(
        adapters.order_info(spark, TINY), adapters.order_detail(spark, TINY),
        adapters.payment_info(spark, TINY), adapters.dimensions(spark, TINY), folder,
        -bound, bound, queries._as_of(),
    )
    assert stored.count() == queries.payment_wide(spark, TINY).count()
