import json
import random

import pytest
from pyspark.sql import functions as F

from rillhouse.operators import changes

RULE = (
    "source_table string, operate_type string, sink_type string, sink_table string, "
    "sink_columns string, sink_pk string, sink_extend string, rule_seq bigint"
)
EVENT = "topic string, before string, after string, op string, seq bigint"


def rules(spark, *rows):
    return spark.createDataFrame([(*r, None, None, i) for i, r in enumerate(rows)], RULE)


def envelopes(spark, *rows):
    return changes.envelopes(spark.createDataFrame(list(rows), EVENT), "seq")


@pytest.mark.parametrize("op, want", [
    ("create", "insert"), ("CREATE", "insert"), ("c", "insert"), ("u", "update"),
    ("UPDATE", "update"), ("d", "delete"), ("r", "read"), ("read", "read"),
    ("truncate", "truncate"), (None, None),
])
def test_operation_names(spark, op, want):
    row = envelopes(spark, ("s.db.t", None, '{"id":1}', op, 0)).first()
    assert row.type == want
    assert (row.database, row.tableName, row.before, row.after) == ("db", "t", "{}", '{"id":1}')


def test_envelope_text_nests_the_images(spark):
    df = envelopes(spark, ("s.db.t", None, '{"id":1,"n":null,"p":12.50}', "c", 7))
    line = changes.envelope_line(df, "seq").first()
    assert json.loads(line.value) == {
        "database": "db", "tableName": "t", "before": {},
        "after": {"id": 1, "n": None, "p": 12.5}, "type": "insert",
    }
    back = changes.read_envelopes(changes.envelope_line(df, "seq"), "seq").first()
    assert json.loads(back.after) == {"id": 1, "n": None, "p": 12.5}
    assert (back.before, back.type, back.seq) == ("{}", "insert", 7)


def test_only_deletes_are_dropped(spark):
    df = envelopes(
        spark, *(("s.d.t", None, "{}", op, i) for i, op in enumerate(["c", "d", None, "delete", "u"]))
    )
    assert sorted(r.seq for r in changes.drop_deletes(df).collect()) == [0, 2, 4]


def test_routing(spark):
    table = rules(
        spark,
        ("a", "insert", "kafka", "wrong", "id"),
        ("a", "insert", "kafka", "facts_a", "id,v"),
        ("b", "update", "hbase", "dim_b", "id, v"),
        ("c", "insert", "clickhouse", "ck", "id"),
    )
    image = '{"id":1,"v":"x","w":2.50}'
    df = envelopes(
        spark,
        ("s.d.a", None, image, "c", 0),
        ("s.d.b", None, image, "u", 1),
        ("s.d.c", None, image, "c", 2),
        ("s.d.a", None, image, "u", 3),
        ("s.d.a", None, image, "d", 4),
        ("s.d.a", None, image, None, 5),
    )
    got = {r.seq: r for r in changes.route_changes(df, table).collect()}
    assert {s: r.route for s, r in got.items()} == {
        0: "fact", 1: "dimension", 2: "reject", 3: "reject", 5: "reject",
    }
    assert (got[0].sink_table, json.loads(got[0].after)) == ("facts_a", {"id": 1, "v": "x"})
    # Names are matched exactly: " v" is not "v".
    assert json.loads(got[1].after) == {"id": 1}
    assert (got[2].reject_reason, got[3].reject_reason) == ("unknown sink type", "no rule")
    assert got[2].after == image


def test_column_filter_keeps_types_and_drops_nulls(spark):
    image = '{"a":1,"b":"1","c":null,"d":true,"e":{"x":[1,2]},"f":9}'
    df = spark.createDataFrame([(image, "a,b,c,d,e")], "after string, cols string")
    out = df.select(changes.keep_listed(F.col("after"), F.col("cols")).alias("x")).first().x
    assert out == '{"a":1,"b":"1","d":true,"e":{"x":[1,2]}}'


def test_latest_rows_equal_replay(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 30 + [f"k{i}" for i in range(60)]), i, rng.random()) for i in range(2000)]
    rng.shuffle(rows)
    want = {}
    for key, seq, value in sorted(rows, key=lambda r: r[1]):
        want[key] = (seq, value)
    df = spark.createDataFrame(rows, "k string, seq bigint, v double").repartition(7)
    got = {r.k: (r.seq, r.v) for r in changes.latest_rows(df, "k").collect()}
    assert got == want


def test_old_versions_are_dropped_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    plan = changes.latest_rows(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_dimension_schema_needs_its_key(spark):
    schema = changes.dimension_schema("id,name")
    assert [(f.name, f.metadata["primary_key"]) for f in schema] == [("id", True), ("name", False)]
    assert changes.dimension_schema("code,name", "code").fields[0].metadata["primary_key"]
    with pytest.raises(ValueError):
        changes.dimension_schema("code,name")


def test_dimension_table_is_text_by_key(spark):
    rows = [('{"id":1,"name":"a"}', 1), ('{"id":1,"name":"b"}', 2), ('{"id":2}', 1), ('{"name":"z"}', 9)]
    df = spark.createDataFrame(rows, "after string, seq bigint")
    table = changes.dimension_table(df, changes.dimension_schema("id,name"))
    assert sorted(tuple(r) for r in table.collect()) == [("1", "b"), ("2", None)]
    assert table.columns == ["ID", "NAME"]
