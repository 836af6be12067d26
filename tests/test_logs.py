import json

from pyspark.sql import functions as F

from rillhouse.functions.records import text_fields
from rillhouse.operators import logs, visitors
from tests.helpers import T0, lines_frame, log_line

GOOD = log_line()
BROKEN = [
    GOOD[:-1], "[1]", "[" + GOOD + "]", "null", "", "1", GOOD + " x", GOOD + " " + GOOD,
    GOOD + "," + GOOD, '"text"',
]
UNKEYED = [
    '{"page":{"page_id":"p"},"ts":1}', '{"common":null,"ts":1}', '{"common":{"vc":"v"},"ts":1}',
    '{"common":"text","ts":1}',
]


def test_dirty_lines_are_kept_verbatim_with_a_reason(spark):
    untimed = [log_line(ts="soon"), log_line(ts=None)]
    frame = lines_frame(spark, [GOOD, *BROKEN, *UNKEYED, *untimed])
    got = {r.seq: (r.value, r.reject_reason) for r in logs.dirty_lines(frame).collect()}
    want = [(v, "not one JSON object") for v in BROKEN]
    want += [(v, "no device id") for v in UNKEYED]
    want += [(v, "no event time") for v in untimed]
    assert [got[i + 1] for i in range(len(want))] == want
    assert [r.seq for r in logs.clean_records(frame).collect()] == [0]


def test_null_line_is_dirty(spark):
    frame = spark.createDataFrame([(None, 1)], "value string, seq bigint")
    assert logs.dirty_lines(frame).count() == 1


def test_repeated_key_takes_the_last_and_numbers_may_be_quoted(spark):
    line = '{"common":{"mid":"a","mid":"b"},"page":{"during_time":"12"},"ts":"77"}'
    row = logs.clean_records(lines_frame(spark, [line])).first()
    assert (row.mid, row.ts, row.during_time) == ("b", 77, 12)


def test_empty_start_object_is_a_start_and_null_is_a_page(spark):
    frame = lines_frame(
        spark, [log_line(start={}), log_line(start=None), log_line(start={"a": 1}), log_line()]
    )
    records = logs.clean_records(frame)
    assert {r.seq: r.start for r in logs.start_logs(records).collect()} == {0: "{}", 2: '{"a":1}'}
    assert {r.seq for r in logs.page_logs(records).collect()} == {1, 3}


def test_displays_are_flattened_with_the_page_id(spark):
    frame = lines_frame(
        spark,
        [
            log_line(displays=[{"item": "1"}, {"item": "2", "page_id": "old"}]),
            log_line(displays=[]),
            log_line(displays=None),
            log_line(displays=[{"item": "9"}], start={"a": 1}),
            '{"common":{"mid":"m"},"displays":[{"item":"3"}],"ts":1}',
        ],
    )
    shown = logs.display_logs(logs.clean_records(frame), "seq").collect()
    got = sorted((r.seq, r.display) for r in shown)
    assert got == [
        (0, '{"item":"1","page_id":"home"}'), (0, '{"item":"2","page_id":"home"}'), (4, '{"item":"3","page_id":null}'),
    ]


def test_display_values_keep_their_types(spark):
    deep = '{"a":[1.50,{"b":"}]"}],"c":{"page_id":"inner"}}'
    shown = '[{"pos":1, "flag":true,"page_id":"old","deep":%s,"big":12345678901234567890.10}, 7, null, {}]' % deep
    line = '{"common":{"mid":"m"},"page":{"page_id":"a\\"b"},"displays":%s,"ts":1}' % shown
    got = [r.display for r in logs.display_logs(logs.clean_records(lines_frame(spark, [line])), "seq").collect()]
    want = '{"pos":1, "flag":true,"deep":%s,"big":12345678901234567890.10,"page_id":"a\\"b"}' % deep
    assert got == [want, '{"page_id":"a\\"b"}']


def test_a_corrected_record_keeps_all_else(spark):
    first = log_line(is_new="1")
    nested = "[" * 6 + '"x"' + "]" * 6
    second = '{"extra":1.50,"common" : {"mid":"m1","is_new" : "1","os":"\\"{,", "mid":"m1"},"page":{"page_id":"p"},"extra":[1,%s],"ts":%d}' % (nested, T0 + 1)
    deep = "[" * 12 + "1.0" + "]" * 12
    third = '{"common":{"mid":"m1","is_new":"1"},"page":{"page_id":"p"},"deep":%s,"ts":%d}' % (deep, T0 + 2)
    fixed = visitors.fix_new_visitors(logs.clean_records(lines_frame(spark, [first, second, third])))
    out = {r.seq: r.value for r in logs.routed_lines(fixed).collect()}
    assert out[1] == second.replace('"is_new" : "1"', '"is_new":"0"')
    want = json.loads(third)
    want["common"]["is_new"] = "0"
    assert json.loads(out[2]) == want


def test_entry_pages(spark):
    frame = lines_frame(spark, [log_line(), log_line(last=""), log_line(last="x")])
    assert {r.seq for r in logs.entry_pages(logs.clean_records(frame)).collect()} == {0, 1}


def test_split_passes_unknown_fields_and_rewrites_only_the_flag(spark):
    first = log_line(is_new="1", extra={"deep": [1, {"x": None}], "price": 12.25})
    second = log_line(ts=T0 + 1, is_new="1", extra={"deep": [1, {"x": None}], "price": 12.25})
    twice = '{"common":{"mid":"m1","mid":"m1","is_new":"1"},"page":{"page_id":"p"},"ts":%d}' % (T0 + 2)
    fixed = visitors.fix_new_visitors(logs.clean_records(lines_frame(spark, [first, second, twice])))
    out = {r.seq: r for r in logs.routed_lines(fixed).collect()}
    assert out[0].value == first
    want = json.loads(second)
    want["common"]["is_new"] = "0"
    assert json.loads(out[1].value) == want
    assert out[2].value == twice.replace('"is_new":"1"', '"is_new":"0"')
    assert {r.topic for r in out.values()} == {"dwd_page_log"}


def test_split_sends_each_line_to_its_topics(spark):
    frame = lines_frame(
        spark,
        [
            log_line(start={}, displays=[{"item": "9"}]),
            log_line(displays=[{"item": "1"}, {"item": "2", "page_id": "old"}]),
        ],
    )
    fixed = visitors.fix_new_visitors(logs.clean_records(frame))
    rows = logs.routed_lines(fixed).orderBy("seq", "topic").collect()
    assert [(r.seq, r.topic) for r in rows] == [
        (0, "dwd_start_log"), (1, "dwd_display_log"), (1, "dwd_display_log"), (1, "dwd_page_log"),
    ]
    shown = [json.loads(r.value) for r in rows if r.topic == "dwd_display_log"]
    assert sorted(d["item"] for d in shown) == ["1", "2"]
    assert {d["page_id"] for d in shown} == {"home"}


def test_line_is_parsed_once(spark):
    frame = lines_frame(spark, [GOOD])
    plan = logs.page_logs(logs.clean_records(frame)).select("mid", "ts")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1, text
    assert plan.where(F.col("mid") == "m1").count() == 1


def test_text_that_ends_the_array_early_is_dirty(spark):
    from pyspark.sql import types as T

    from rillhouse.functions.records import strict_records

    good = ['{"a":1}', ' {"a":2} ', "{}"]
    bad = ['{"a":1}] junk', '{"a":1}] , [', '{"a":1}],[{"a":1}', '{"a":1},{"a":2}', '{"a":1} x', "[1]", "null", "", "7", '{"a":1', '{"_mark":"1"}]']
    df = spark.createDataFrame([(v,) for v in [*good, *bad]], "value string")
    read = strict_records(df, T.StructType([T.StructField("a", T.IntegerType())])).collect()
    assert {r.value for r in read if r._r is not None} == set(good)
    assert read[0]._r.asDict() == {"a": 1}


def test_fields_of_a_text_are_walked_once(spark):
    texts = ['{"a" : "x\\"{,", "b":[1.50,{"d":"}]"}]}', " {} ", '{"a":1', "[1]", None, '{"a":"\\\\","b":{"c":""}}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    found = df.select(text_fields(F.col("value")).alias("f"))
    want = [['"a" : "x\\"{,"', ' "b":[1.50,{"d":"}]"}]'], [], None, None, None, ['"a":"\\\\"', '"b":{"c":""}']]
    assert [r.f for r in found.collect()] == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
