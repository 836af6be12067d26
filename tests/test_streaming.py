import json
import random
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.operators import logs, stats, visitors
from rillhouse.plans import stream_queries, warehouse
from rillhouse.sinks import dimensions
from rillhouse.sinks.topics import write_topics
from rillhouse.sources.topics import Topics, read_topic
from rillhouse.streaming import jobs, operators, processors
from tests.helpers import T0, log_line

ROW = "topic string, value string, seq bigint, record_ms bigint"
FAR = 400 * 86_400_000


@pytest.fixture
def job(spark, folder):
    return jobs.Job(spark, Topics(f"{folder}/topics"), f"{folder}/dims", f"{folder}/checkpoints", max_files=1)


def finish(query):
    query.awaitTermination(180)
    assert query.exception() is None and not query.isActive
    return query


def publish(spark, job, topic, group, values, files, first_seq=0, record_ms=0):
    """Values in order, cut into files, one file per later micro-batch."""
    size = -(-len(values) // files)
    for at in range(0, len(values), size):
        rows = [
            (topic, v, first_seq + at + i, record_ms) for i, v in enumerate(values[at:at + size])
        ]
        write_topics(spark.createDataFrame(rows, ROW).coalesce(1), job.topics, group)


def values(spark, job, topic):
    return read_topic(spark, job.topics, topic)


def seqs(df):
    return sorted(r.seq for r in df.collect())


def walk(seed, count, devices=6, step=4000):
    """Log lines with rising times; every sixth is a start, some lines are broken."""
    rng = random.Random(seed)
    out, ts = [], T0
    for i in range(count):
        ts += rng.randrange(1, step)
        mid = "hot" if rng.random() < 0.34 else f"m{rng.randrange(devices)}"
        more = {"start": {"at": i}} if rng.random() < 0.15 else {}
        if rng.random() < 0.2:
            more["displays"] = [{"item": str(i)}]
        line = log_line(mid, ts, None if rng.random() < 0.6 else "p", rng.choice("011"), **more)
        out.append(line if rng.random() > 0.05 else line[:-1])
    return out, ts


def frame(spark, lines):
    return spark.createDataFrame([(v, i, 0) for i, v in enumerate(lines)], "value string, seq bigint, record_ms bigint")


def test_split_logs_equals_the_batch_and_restarts(spark, job):
    lines, _ = walk(1, 240)
    publish(spark, job, schemas.ODS_LOG, "ods_log", lines[:120], 2)
    finish(jobs.split_logs(job))
    half = values(spark, job, schemas.DWD_PAGE).count()
    assert half > 0
    publish(spark, job, schemas.ODS_LOG, "ods_log", lines[120:], 2, first_seq=120)
    finish(jobs.split_logs(job))

    fixed = warehouse.corrected_records(frame(spark, lines))
    want = {}
    for r in logs.routed_lines(fixed).collect():
        want.setdefault(r.topic, []).append((r.seq, json.loads(r.value)))
    for topic in (schemas.DWD_PAGE, schemas.DWD_START, schemas.DWD_DISPLAY):
        got = [(r.seq, json.loads(r.value)) for r in values(spark, job, topic).collect()]
        assert sorted(got, key=str) == sorted(want[topic], key=str)
    dirty = values(spark, job, schemas.DWD_DIRTY)
    want_dirty = {
        r.seq: {"value": r.value, "reject_reason": r.reject_reason}
        for r in logs.dirty_lines(frame(spark, lines)).collect()
    }
    assert {r.seq: json.loads(r.value) for r in dirty.collect()} == want_dirty


def page_stream(spark, job, lines, files):
    publish(spark, job, schemas.DWD_PAGE, "dwd_log", lines, files)


def clean_pages(spark, lines):
    return logs.page_logs(logs.clean_records(frame(spark, lines)))


@pytest.mark.parametrize("files", [1, 7])
def test_bounces_stream_equals_batch(spark, job, files):
    lines, last = walk(2, 300)
    flush = [log_line("zz", last + FAR, "p"), log_line("zz", last + FAR + 60_000, "p")]
    page_stream(spark, job, lines, files)
    publish(spark, job, schemas.DWD_PAGE, "dwd_log", flush, 2, first_seq=10_000)
    finish(jobs.user_jumps(job))
    got = values(spark, job, schemas.DWM_JUMP)
    want = visitors.bounces(clean_pages(spark, lines))
    assert seqs(got) == seqs(want)
    assert {r.value for r in got.collect()} == {r.value for r in want.collect()}


def test_bounces_put_late_but_allowed_rows_in_order(spark, job):
    """Files out of order within the delay; a row behind the watermark is dropped."""
    t = T0 + 3_600_000
    first = [log_line("a", t), log_line("b", t)]
    second = [log_line("a", t + 8000, "p"), log_line("b", t + 8000)]
    third = [log_line("a", t + 6500)]
    # The watermark of the third batch, 6 s, holds against the rows of the fourth.
    fourth = [log_line("b", t + 1000, "p")]
    flush = [log_line("z", t + FAR, "p")]
    for i, chunk in enumerate((first, second, third, fourth, flush)):
        publish(spark, job, schemas.DWD_PAGE, "dwd_log", chunk, 1, first_seq=10 * i)
    publish(spark, job, schemas.DWD_PAGE, "dwd_log", [log_line("z", t + FAR + 99_000, "p")], 1, first_seq=99)
    query = finish(jobs.user_jumps(job, delay="2 seconds"))
    # a: E@0 E@6.5 N@8 bounces at 0 only; b: E@0 E@8 both bounce, the row at 1 is gone.
    assert seqs(values(spark, job, schemas.DWM_JUMP)) == [0, 1, 11]
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped >= 1


def test_unique_visits_stream_equals_batch_and_restarts(spark, job):
    lines, _ = walk(3, 300, step=1_200_000)
    page_stream(spark, job, lines[:150], 3)
    finish(jobs.unique_visits(job))
    publish(spark, job, schemas.DWD_PAGE, "dwd_log", lines[150:], 3, first_seq=150)
    finish(jobs.unique_visits(job))
    want = visitors.first_visits(clean_pages(spark, lines))
    assert seqs(values(spark, job, schemas.DWM_VISIT)) == seqs(want)


def test_visitor_stats_stream_equals_batch(spark, job, folder):
    lines, last = walk(4, 200)
    pages = clean_pages(spark, lines)
    visits, jumps = visitors.first_visits(pages), visitors.bounces(pages)
    flush = log_line("zz", last + FAR, "p")
    for topic, group, df in (
        (schemas.DWD_PAGE, "dwd_log", pages),
        (schemas.DWM_VISIT, "dwm_unique_visit", visits),
        (schemas.DWM_JUMP, "dwm_user_jump_detail", jumps),
    ):
        rows = [r.value for r in df.orderBy("ts", "seq").collect()]
        publish(spark, job, topic, group, [*rows, flush], 1)
    publish(spark, job, schemas.DWD_PAGE, "dwd_log", [log_line("zz", last + 2 * FAR, "p")], 1)
    finish(jobs.visitor_stats(job, f"{folder}/stats", delay="13 seconds"))
    got = spark.read.parquet(f"{folder}/stats").where(F.col("ts") <= last)
    want = stats.window_stats(stats.union_shaped(visits, jumps, pages))
    columns = schemas.VISITOR_STATS.fieldNames()
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.collect()))


RULES = [
    ("order_info", "insert", "kafka", "dwd_order_info",
     "id,province_id,order_status,user_id,total_amount,create_time", 1),
    ("order_detail", "insert", "kafka", "dwd_order_detail",
     "id,order_id,sku_id,order_price,sku_num,sku_name,create_time", 2),
    ("payment_info", "insert", "kafka", "dwd_payment_info",
     "id,order_id,user_id,total_amount,subject,payment_type,create_time,callback_time", 3),
]
DIMENSIONS = {
    "user_info": ("dim_user_info", "id,gender,birthday"),
    "base_province": ("dim_base_province", "id,name,area_code,iso_code,iso_3166_2"),
    "sku_info": ("dim_sku_info", "id,sku_name,category3_id,spu_id,tm_id"),
    "spu_info": ("dim_spu_info", "id,spu_name"),
    "base_trademark": ("dim_base_trademark", "id,tm_name"),
    "base_category3": ("dim_base_category3", "id,name"),
}


def write_rules(spark, path, rows):
    layout = (
        "source_table string, operate_type string, sink_type string, sink_table string, "
        "sink_columns string, rule_seq bigint"
    )
    spark.createDataFrame(rows, layout).coalesce(1).write.mode("overwrite").json(path)


def envelope(table, type_="insert", **after):
    return json.dumps({"database": "shop", "tableName": table, "before": {}, "after": after, "type": type_})


def test_changes_to_order_and_payment_rows(spark, job, folder):
    rules_path = f"{folder}/rules"
    rows = list(RULES)
    for i, (source, (sink, cols)) in enumerate(DIMENSIONS.items()):
        rows += [(source, t, "hbase", sink, cols, 10 + 2 * i + j) for j, t in enumerate(("insert", "update"))]
    write_rules(spark, rules_path, rows)
    at = "2024-01-01 10:00:0"
    first = [
        envelope("user_info", id=7, gender="F", birthday="2000-01-01", secret="x"),
        envelope("base_province", id=1, name="P", area_code="10", iso_code="I", iso_3166_2="N"),
        envelope("sku_info", id=3, sku_name="old", category3_id=30, spu_id=300, tm_id=2),
        envelope("sku_info", "update", id=3, sku_name="new", category3_id=30, spu_id=300, tm_id=2),
        envelope("spu_info", id=300, spu_name="spu"),
        envelope("base_trademark", id=2, tm_name="tm"),
        envelope("base_category3", id=30, name="cat"),
        envelope("coupon", id=1),
        envelope("user_info", "delete"),
    ]
    second = [
        envelope("order_info", id=1, province_id=1, order_status="1", user_id=7, total_amount=10.5, create_time=at + "0"),
        envelope("order_info", id=2, province_id=9, order_status="1", user_id=8, total_amount=1, create_time=at + "0"),
        envelope("order_detail", id=5, order_id=1, sku_id=3, order_price=5.25, sku_num=2, sku_name="own", create_time=at + "5"),
        envelope("order_detail", id=6, order_id=1, sku_id=3, order_price=5.25, sku_num=2, sku_name="own", create_time=at + "6"),
        envelope("order_detail", id=7, order_id=2, sku_id=4, order_price=1, sku_num=1, sku_name="own", create_time=at + "1"),
        envelope("payment_info", id=90, order_id=1, user_id=7, subject="s", payment_type="p", create_time="2024-01-01 10:15:00"),
        envelope("payment_info", id=91, order_id=2, user_id=8, subject="s", payment_type="p", create_time="2024-01-01 10:15:01"),
    ]
    publish(spark, job, schemas.ODS_DB, "ods_db", first, 1)
    publish(spark, job, schemas.ODS_DB, "ods_db", second, 1, first_seq=100)
    finish(jobs.route_changes(job, rules_path))
    sku = dimensions.read_table(spark, job.dims, "dim_sku_info").collect()
    assert [(r.ID, r.SKU_NAME, r.SPU_ID) for r in sku] == [("3", "new", "300")]
    user = dimensions.read_table(spark, job.dims, "dim_user_info")
    assert user.columns == ["ID", "GENDER", "BIRTHDAY"] and user.count() == 1
    rejected = [json.loads(r.value) for r in values(spark, job, schemas.DWD_REJECTED).collect()]
    assert [(r["tableName"], r["reject_reason"]) for r in rejected] == [("coupon", "no rule")]

    as_of = F.unix_millis(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    finish(jobs.order_wide(job, delay="1 minute", as_of_ms=as_of))
    wide = {
        r.detail_id: r
        for r in values(spark, job, schemas.DWM_ORDER_WIDE)
        .select(F.from_json("value", schemas.ORDER_WIDE).alias("r")).select("r.*").collect()
    }
    assert sorted(wide) == [5, 7]
    assert (wide[5].user_age, wide[5].sku_name, wide[5].tm_name, wide[5].category3_name) == (24, "new", "tm", "cat")
    assert (wide[5].province_name, wide[5].spu_name, str(wide[5].total_amount)) == ("P", "spu", "10.50")
    assert (wide[7].user_gender, wide[7].sku_name, wide[7].spu_id) == (None, "own", None)

    finish(jobs.payment_wide(job, delay="30 minutes"))
    paid = (
        values(spark, job, schemas.DWM_PAYMENT_WIDE)
        .select(F.from_json("value", schemas.PAYMENT_WIDE).alias("r")).select("r.*").collect()
    )
    assert [(r.payment_id, r.detail_id, r.total_amount) for r in paid] == [(90, 5, None)]
    assert paid[0].order_create_time == at + "0" and paid[0].tm_name == "tm"


def test_rules_are_read_again_for_each_batch(spark, job, folder):
    path = f"{folder}/rules"
    write_rules(spark, path, [("t", "insert", "kafka", "topic_one", "id", 1)])
    publish(spark, job, schemas.ODS_DB, "ods_db", [envelope("t", id=1, v=2)], 1)
    finish(jobs.route_changes(job, path))
    write_rules(spark, path, [("t", "insert", "kafka", "topic_two", "v", 1)])
    publish(spark, job, schemas.ODS_DB, "ods_db", [envelope("t", id=3, v=4)], 1, first_seq=1)
    finish(jobs.route_changes(job, path))
    write_rules(spark, path, [("x", "insert", "kafka", "topic_two", "v", 1)])
    publish(spark, job, schemas.ODS_DB, "ods_db", [envelope("t", id=5, v=6)], 1, first_seq=2)
    finish(jobs.route_changes(job, path))
    assert [r.value for r in values(spark, job, "topic_one").collect()] == ['{"id":1}']
    assert [r.value for r in values(spark, job, "topic_two").collect()] == ['{"v":4}']
    assert values(spark, job, schemas.DWD_REJECTED).count() == 1


def test_capture_writes_envelopes(spark, job, folder):
    layout = "topic string, before string, after string, op string, seq bigint"
    raw = f"{folder}/raw"
    spark.createDataFrame([("s.shop.t", None, '{"id":1}', "c", 3)], layout).write.parquet(raw)
    events = spark.readStream.schema(layout).parquet(raw)
    finish(jobs.capture_changes(job, events))
    row = values(spark, job, schemas.ODS_DB).first()
    assert row.seq == 3
    assert json.loads(row.value) == {
        "database": "shop", "tableName": "t", "before": {}, "after": {"id": 1}, "type": "insert",
    }


class Held:
    """A list and timer state in memory that counts its calls."""

    def __init__(self):
        self.list, self.timers, self.calls = [], set(), 0

    def _called(self, out=None):
        self.calls += 1
        return out

    def getListState(self, *_):
        return self

    def exists(self):
        return self._called(bool(self.list))

    def get(self):
        return self._called(iter(self.list))

    def put(self, rows):
        self.list = self._called(list(rows))

    def appendList(self, rows):
        self.list += self._called(list(rows))

    def clear(self):
        self.list = self._called([])

    def listTimers(self):
        return self._called(iter(sorted(self.timers)))

    def registerTimer(self, at):
        self._called(self.timers.add(at))


class At:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_devices_of_a_bucket_share_their_state_calls():
    state, watch = Held(), processors.BounceWatch(10)
    watch.init(state)
    rows = [Row(mid=f"m{i}", ts=t, seq=2 * i + t, entry=t == 0, emits=t == 0, value=f"v{i}") for i in range(2500) for t in ((0, 1) if i % 2 else (0,))]
    assert list(watch.handleInputRows((0, 0), iter(rows), At(-1))) == []
    assert len(state.list) == 3750 and state.timers == {1} and state.calls < 12
    assert list(watch.handleExpiredTimer((0, 0), At(1), None)) == []
    # A page that no entry is leaves with its follower; the others wait for their horizon.
    assert {r[0] for r in state.list} == {f"m{i}" for i in range(0, 2500, 2)} and state.timers == {1, 10}
    assert sorted(r.seq for r in watch.handleExpiredTimer((0, 0), At(20), None)) == list(range(0, 5000, 4))
    assert state.list == [] and state.calls < 30


class HeldValue(Held):
    """A value state; calls are counted."""

    def __init__(self):
        super().__init__()
        self.value = None

    def getValueState(self, *_):
        return self

    def get(self):
        return self._called(self.value)

    def update(self, value):
        self.value = self._called(value)


def test_images_of_a_bucket_share_their_state_calls():
    state, latest = HeldValue(), processors.LatestImages()
    latest.init(state)
    stored = [{"key": f"k{i}", "image": f'{{"id":{i},"name":"né"}}'} for i in range(2000)]
    latest.handleInitialState((0, 0), Row(rows=stored), None)
    rows = [Row(key=f"k{i}", value=f"v{i}", seq=i, image=None) for i in range(1990, 2002)]
    rows += [Row(key=f"k{i}", value=None, seq=s, image=f'{{"name":{t}}}') for i in (1999, 2000) for s, t in ((2, '"b"'), (1, "null"))]
    found = {r.seq: r.image for r in latest.handleInputRows((0, 0), iter(rows), None)}
    assert found.pop(1999) == '{"id":1999,"name":"b"}' and found.pop(2000) == '{"name":"b"}' and found.pop(2001) is None
    assert found == {i: stored[i]["image"] for i in range(1990, 1999)}
    again = latest.handleInputRows((0, 0), iter([Row(key="k1999", value="v", seq=1, image=None)]), None)
    assert [r.image for r in again] == ['{"id":1999,"name":"b"}']
    assert state.calls <= 4


def test_changing_lookup_with_few_buckets(spark, folder):
    users = [("a", 0, '{"name":"A"}'), ("b", 0, '{"name":"B"}'), ("c", 0, None), (None, 0, '{"name":"N"}')]
    stored = spark.createDataFrame(users, "key string, seq bigint, image string")
    changes = stored.where("false").union(spark.createDataFrame([("c", 1, '{"name":"C"}'), ("b", 1, '{"age":1}')], stored.schema))
    facts = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("c", "3", 3), ("d", "4", 4), (None, "5", 5)], "key string, value string, seq bigint")
    changes.write.parquet(f"{folder}/images")
    facts.write.parquet(f"{folder}/facts")
    streams = [spark.readStream.schema(df.schema).parquet(f"{folder}/{n}") for n, df in (("facts", facts), ("images", changes))]
    found = operators.lookup_changing(*streams, stored, salts=2, buckets=1)
    query = found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck")
    query.trigger(availableNow=True).start().awaitTermination()
    got = {r.seq: r.image for r in spark.read.schema(found.schema).parquet(f"{folder}/out").collect()}
    assert got == {1: '{"name":"A"}', 2: '{"name":"B","age":1}', 3: '{"name":"C"}', 4: None, 5: None}


def test_streams_upload_state_changes_in_any_session(spark, folder, monkeypatch):
    name = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    kept = spark.conf.get(name)
    monkeypatch.setattr(stream_queries, "_folder", lambda spark: folder)
    spark.conf.set(name, "false")
    try:
        assert stream_queries.stream_order_interval_join(spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.set(name, kept)
    assert list(Path(folder).rglob("*.changelog"))
