import pytest

from rillhouse import schemas
from rillhouse.operators import columns
from rillhouse.sinks import dimensions, results
from rillhouse.sinks.topics import write_topics, write_topics_once
from rillhouse.sources import tables
from rillhouse.sources.topics import Topics, kafka_options, read_topic, text_lines

ROW = "topic string, value string, seq bigint"
CHANGE = "after string, seq bigint, sink_table string, sink_pk string"


def test_topics_share_a_folder_and_read_apart(spark, folder):
    topics = Topics(folder)
    rows = [(schemas.DWD_PAGE, "a", 1), (schemas.DWD_START, "b", 2), (schemas.DWD_PAGE, "c", 3)]
    write_topics(spark.createDataFrame(rows, ROW), topics, "dwd_log")
    got = read_topic(spark, topics, schemas.DWD_PAGE).orderBy("seq").collect()
    assert [(r.value, r.seq, r.record_ms) for r in got] == [("a", 1, None), ("c", 3, None)]
    plan = read_topic(spark, topics, schemas.DWD_PAGE)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_repeated_batch_replaces_itself(spark, folder):
    topics = Topics(folder)
    rows = spark.createDataFrame([(schemas.DWD_ORDER, "a", 1), ("facts_x", "b", 2)], ROW)
    for batch in (0, 1, 1):
        write_topics_once(rows, batch, topics, "dwd_db")
    assert read_topic(spark, topics, schemas.DWD_ORDER).count() == 2
    assert read_topic(spark, topics, "facts_x").count() == 2


def test_kafka_options():
    got = kafka_options(Topics("b1:9092", "kafka", {"maxOffsetsPerTrigger": "5"}), "t", "latest", "g")
    assert got == {
        "kafka.bootstrap.servers": "b1:9092", "subscribe": "t", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5", "groupIdPrefix": "g",
    }


def test_text_folder(spark, folder):
    spark.createDataFrame([("x",), ("y",)], "value string").write.mode("append").text(f"{folder}/in")
    rows = text_lines(spark, f"{folder}/in").collect()
    assert {r.value for r in rows} == {"x", "y"} and all(r.record_ms for r in rows)


def changes_frame(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def test_dimension_upserts_replay_and_compact(spark, folder):
    dimensions.create_table(spark, folder, "dim_a", "id,name")
    assert dimensions.read_table(spark, folder, "dim_a").collect() == []
    first = changes_frame(
        spark,
        ('{"id":1,"name":"a"}', 5, "dim_a", None),
        ('{"id":1,"name":"b"}', 6, "dim_a", None),
        ('{"id":2,"name":"c"}', 7, "dim_a", None),
        ('{"code":2,"name":"other"}', 8, "dim_b", "code"),
    )
    second = changes_frame(spark, ('{"id":1,"name":"z"}', 1, "dim_a", None))

    def now():
        return sorted(tuple(r) for r in dimensions.read_table(spark, folder, "dim_a").collect())

    dimensions.append_changes(first, 0, folder)
    dimensions.append_changes(first, 0, folder)
    assert now() == [("1", "b"), ("2", "c")]
    dimensions.append_changes(second, 1, folder)
    # A later batch wins over a larger sequence number of an earlier one.
    assert now() == [("1", "z"), ("2", "c")]
    dimensions.compact(spark, folder, 0)
    assert now() == [("1", "z"), ("2", "c")]
    dimensions.compact(spark, folder, 1)
    assert dimensions.images(spark, folder).count() == 3
    dimensions.append_changes(changes_frame(spark, ('{"id":3}', 1, "dim_a", None)), 2, folder)
    assert now() == [("1", "z"), ("2", "c"), ("3", None)]


def test_a_new_run_counts_batches_anew(spark, folder):
    """After a restart with a new checkpoint batches start at 0 again; repeated ones of a run add nothing."""
    dimensions.create_table(spark, folder, "dim_a", "id,name")

    def put(run, batch, key, name):
        image = f'{{"id":{key},"name":"{name}"}}'
        return dimensions.append_changes(changes_frame(spark, (image, 1, "dim_a", None)), batch, folder, run)

    def now():
        return sorted(tuple(r) for r in dimensions.read_table(spark, folder, "dim_a").collect())

    assert put("one", 0, 1, "a") and put("one", 1, 2, "b") and not put("one", 1, 2, "x")
    dimensions.compact(spark, folder)
    assert put("two", 0, 2, "c") and not put("two", 0, 2, "y")
    assert now() == [("1", "a"), ("2", "c")]
    dimensions.compact(spark, folder)
    assert dimensions.vacuum(spark, folder) == 4
    assert not put("two", 0, 2, "y") and not put("one", 1, 2, "x") and put("two", 1, 3, "d")
    assert now() == [("1", "a"), ("2", "c"), ("3", "d")]
    assert dimensions.vacuum(spark, folder) == 0


def test_merging_reads_only_what_came_since(spark, folder):
    dimensions.create_table(spark, folder, "dim_a", "id,name")
    for batch in range(9):
        image = f'{{"id":{batch % 4},"name":"n{batch}"}}'
        dimensions.append_changes(changes_frame(spark, (image, 1, "dim_a", None)), batch, folder, "r")
        dimensions.merge(spark, folder, fan_in=3)
    # Nine commits: three merges of the first level, and their three into one of the second.
    live = dimensions.live_commits(spark, folder)
    assert [(r.number, r.level) for r in live] == [(8, 2)]
    assert dimensions.images(spark, folder).count() == 4
    got = sorted(tuple(r) for r in dimensions.read_table(spark, folder, "dim_a").collect())
    assert got == [("0", "n8"), ("1", "n5"), ("2", "n6"), ("3", "n7")]


def test_an_unfinished_batch_is_not_read(spark, folder):
    dimensions.create_table(spark, folder, "dim_a", "id,name")
    rows = changes_frame(spark, ('{"id":1,"name":"a"}', 1, "dim_a", None))
    dimensions.append_changes(rows, 0, folder, "r")
    lost = rows.selectExpr("'{\"id\":1,\"name\":\"lost\"}' AS after", "9L AS seq", "'1' AS pk", "1L AS number", "sink_table")
    lost.write.partitionBy("sink_table").parquet(f"{folder}/images/commit=000000000001-crashed")
    assert [r.NAME for r in dimensions.read_table(spark, folder, "dim_a").collect()] == ["a"]


def test_upsert_touches_only_its_columns(spark, folder):
    """A narrower rule leaves the other columns; null overwrites; layouts add up; compaction changes nothing."""
    dimensions.create_table(spark, folder, "dim_a", "id,name,seg")
    dimensions.create_table(spark, folder, "dim_a", "id,name,level", "id", "ttl=1")
    steps = ['{"id":1,"name":"a","seg":"s"}', '{"id":1,"name":"b"}', '{"id":1,"seg":null,"level":{"x":1}}', '{"name":"lost"}']
    for batch, image in enumerate(steps):
        dimensions.append_changes(changes_frame(spark, (image, 9 - batch, "dim_a", None)), batch, folder)
        row = dimensions.read_table(spark, folder, "dim_a").first()
        if batch == 1:
            assert row.asDict() == {"ID": "1", "NAME": "b", "SEG": "s", "LEVEL": None}
    want = {"ID": "1", "NAME": "b", "SEG": None, "LEVEL": '{"x":1}'}
    for upto in (1, 3):
        assert [r.asDict() for r in dimensions.read_table(spark, folder, "dim_a").collect()] == [want]
        dimensions.compact(spark, folder, upto)
    found = dimensions.read_table(spark, folder, "dim_a").where("ID = '1'")
    assert [r.asDict() for r in found.collect()] == [want]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pk,1)" in plan


def test_rules_create_their_dimensions_once(spark, folder):
    layout = (
        "source_table string, operate_type string, sink_type string, sink_table string, "
        "sink_columns string, sink_pk string, sink_extend string, rule_seq bigint"
    )
    rows = [
        ("u", "insert", "hbase", "dim_u", "id,name", None, None, 1),
        ("u", "update", "hbase", "dim_u", "id,name", "id", None, 2),
        ("o", "insert", "kafka", "facts", "id", None, None, 3),
    ]
    rules = spark.createDataFrame(rows, layout)
    for _ in range(2):
        dimensions.create_tables(spark, folder, rules)
        assert sorted(r.sink_pk or "" for r in dimensions.layouts(spark, folder).collect()) == ["", "id"]
    assert dimensions.read_table(spark, folder, "dim_u").columns == ["ID", "NAME"]
    bad = spark.createDataFrame([("x", "insert", "hbase", "dim_x", "a,b", None, None, 1)], layout)
    with pytest.raises(ValueError):
        dimensions.create_tables(spark, folder, bad)


def test_rules_are_a_snapshot(spark, folder):
    path = f"{folder}/rules"
    row = spark.createDataFrame([("u", "insert", "kafka", "t", "id", 1), ("o", "insert", "kafka", "t", "id", 2)],
                                "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, rule_seq bigint")
    row.write.json(path)
    assert tables.read_rules(spark, path).count() == 2
    row.where("rule_seq = 2").write.mode("overwrite").json(path)
    got = tables.read_rules(spark, path).first()
    assert (got.source_table, got.sink_pk) == ("o", None)


def test_result_files_leave_out_transient_columns(spark, folder):
    df = columns.mark_transient(spark.createDataFrame([(1, "a", 2.0)], "b int, a string, t double"), "t")
    results.write_files(df, 3, folder)
    results.write_files(df, 3, folder)
    back = spark.read.parquet(folder)
    assert back.columns == ["b", "a", "batch_id"] and back.count() == 1


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:x", "select 1", "d", "id", (0, 100), 4)
    assert got["dbtable"] == "(select 1) q" and got["numPartitions"] == "4"
    assert (got["lowerBound"], got["upperBound"], got["driver"]) == ("0", "100", "d")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "select 1", partition_column="id")
    assert results.jdbc_writer_options("jdbc:x", "t", batch_size=5)["batchsize"] == "5"


def test_first_load_as_inserts(spark):
    df = spark.createDataFrame([(4, "a")], "id bigint, name string")
    row = tables.as_inserts(df, "shop", "u", "id").first()
    assert (row.database, row.tableName, row.before, row.type, row.seq) == ("shop", "u", "{}", "insert", 4)
    assert row.after == '{"id":4,"name":"a"}'
