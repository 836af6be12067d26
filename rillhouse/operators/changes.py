"""Database change events to envelopes, and rule-driven routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import schemas
from rillhouse.functions.records import comma_join, in_list, json_line

# One-letter operation codes and target kinds.
OPERATIONS = {"c": "create", "u": "update", "d": "delete", "r": "read"}
TO_TOPIC = "kafka"
TO_DIMENSION = "hbase"
DEFAULT_KEY = "id"


def change_type(op: Column) -> Column:
    """Operation name, lower case, with `create` called `insert`."""
    name = F.lower(op)
    names = F.create_map(*(F.lit(x) for pair in OPERATIONS.items() for x in pair))
    name = F.coalesce(F.element_at(names, name), name)
    return F.when(name == "create", "insert").otherwise(name)


def envelopes(events: DataFrame, *keep: str) -> DataFrame:
    """`topic, before, after, op` change events to envelope columns; a missing image is `{}`."""
    return events.select(
        F.split_part("topic", F.lit("."), F.lit(2)).alias("database"),
        F.split_part("topic", F.lit("."), F.lit(3)).alias("tableName"),
        F.coalesce("before", F.lit("{}")).alias("before"),
        F.coalesce("after", F.lit("{}")).alias("after"),
        change_type(F.col("op")).alias("type"),
        *keep,
    )


def envelope_line(df: DataFrame, *keep: str) -> DataFrame:
    """Envelope columns to the topic's JSON text, the images as nested objects."""
    image = {c: F.parse_json(F.col(c)) for c in ("before", "after")}
    text = json_line("database", "tableName", image["before"].alias("before"),
                     image["after"].alias("after"), "type")
    return df.select(text.alias("value"), *keep)


def read_envelopes(lines: DataFrame, *keep: str) -> DataFrame:
    """Topic text to envelope columns; nested images come back as their JSON text."""
    record = F.from_json("value", schemas.ENVELOPE)
    return lines.select(record.alias("_r"), *keep).select("_r.*", *keep)


def drop_deletes(changes: DataFrame) -> DataFrame:
    """Everything but deletes; a change without a type stays."""
    return changes.where(~F.col("type").eqNullSafe("delete"))


def current_rules(rules: DataFrame) -> DataFrame:
    """One rule per source table and operation, the last one by `rule_seq`."""
    order = Window.partitionBy("source_table", "operate_type").orderBy(F.col("rule_seq").desc())
    return rules.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def keep_listed(after: Column, columns: Column, nulls: bool = False) -> Column:
    """The image with only the listed fields, value types kept; fields that are null stay on demand."""
    fields = F.from_json(after, T.MapType(T.StringType(), T.VariantType()))
    kept = F.map_filter(
        fields,
        lambda k, v: in_list(k, columns)
        if nulls
        else in_list(k, columns) & v.isNotNull() & ~F.is_variant_null(v),
    )
    return F.to_json(kept)


def rule_versions(rule_changes: DataFrame) -> DataFrame:
    """Rules with the positions they hold for, `[valid_from, valid_to)`, out of their own change log.

    The log has a rule's columns, `deleted`, the position `valid_from` of the change stream from
    which it holds, and `rule_seq`, which settles two changes of one position. A version ends where
    the next one of its table and operation begins; a deletion leaves a gap until the rule is back.
    """
    key = ("source_table", "operate_type")
    spot = Window.partitionBy(*key, "valid_from").orderBy(F.col("rule_seq").desc())
    last = rule_changes.withColumn("_rank", F.row_number().over(spot)).where("_rank = 1").drop("_rank")
    following = F.lead("valid_from").over(Window.partitionBy(*key).orderBy("valid_from"))
    return last.withColumn("valid_to", following).where(~F.coalesce("deleted", F.lit(False))).drop("deleted")


def match_rules(changes: DataFrame, rules: DataFrame, position: str = "seq") -> DataFrame:
    """Attach the rule of each change; the rule columns are null where none matches.

    Rules with `valid_from` and `valid_to`, as `rule_versions` gives them, are matched as of the
    change's `position`, so a replay routes as the first run did; others are the rules of now. The
    planner broadcasts a small rule table and shuffles a large one.
    """
    dated = "valid_to" in rules.columns
    active = (rules if dated else current_rules(rules)).select(
        F.col("source_table").alias("_source"),
        F.col("operate_type").alias("_operation"),
        "sink_type",
        "sink_table",
        "sink_columns",
        "sink_pk",
        *([F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")] if dated else []),
    )
    same = (F.col("tableName") == F.col("_source")) & (F.col("type") == F.col("_operation"))
    if dated:
        same &= (F.col(position) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(position) < F.col("_to")))
    return changes.join(active, same, "left").withColumn(
        "route",
        F.when(F.col("_source").isNull(), "reject")
        .when(F.col("sink_type") == TO_TOPIC, "fact")
        .when(F.col("sink_type") == TO_DIMENSION, "dimension")
        .otherwise("reject"),
    ).withColumn(
        "reject_reason",
        F.when(F.col("_source").isNull(), "no rule").when(
            F.col("route") == "reject", "unknown sink type"
        ),
    ).drop("_source", "_operation", "_from", "_to")


def route_changes(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Matched changes with `after` cut to the rule's columns, all routes in one frame.

    `route` is fact, dimension or reject; a reject keeps its whole image and says why. A dimension
    image without its key is a reject. `image` of a dimension row is its `after` with nulls: they
    overwrite a value, which a field that is absent does not.
    """
    matched = match_rules(drop_deletes(changes), rules)
    key = F.coalesce("sink_pk", F.lit(DEFAULT_KEY))
    named = matched.withColumn("_path", F.concat(F.lit("$."), key))
    keyless = (F.col("route") == "dimension") & ~F.coalesce(
        in_list(key, F.col("sink_columns")) & F.expr("get_json_object(after, _path) is not null"),
        F.lit(False),
    )
    reason = F.when(keyless, "no key").otherwise(F.col("reject_reason"))
    routed = named.withColumn("reject_reason", reason).drop("_path")
    routed = routed.withColumn("route", F.when(F.col("reject_reason") == "no key", "reject").otherwise(F.col("route")))
    cut = F.when(F.col("route") == "reject", F.col("after")).otherwise(
        keep_listed(F.col("after"), F.col("sink_columns"))
    )
    image = F.when(
        F.col("route") == "dimension", keep_listed(F.col("after"), F.col("sink_columns"), nulls=True)
    )
    return routed.withColumn("image", image).withColumn("after", cut)


def facts(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "fact")


def dimension_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "dimension")


def dimension_images(routed: DataFrame) -> DataFrame:
    """Dimension rows as an upsert needs them: `after` tells a field set to null from an absent one."""
    return dimension_rows(routed).withColumn("after", F.col("image")).drop("image")


def rejects(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "reject")


def topic_rows(facts_: DataFrame) -> DataFrame:
    """Facts as `topic, value, seq`: the target comes from the row, the payload is the image."""
    return facts_.select(F.col("sink_table").alias("topic"), F.col("after").alias("value"), "seq")


def dimension_schema(columns: str, pk: str | None = None) -> T.StructType:
    """Text columns of a dimension from a rule's comma list; the key must be one of them."""
    names = columns.split(",")
    key = pk or DEFAULT_KEY
    if key not in names:
        raise ValueError(f"key {key!r} is not among the columns {names}")
    return T.StructType(
        [T.StructField(n, T.StringType(), True, {"primary_key": n == key}) for n in names]
    )


def listed_fields(after: Column) -> Column:
    """Field names of an image, comma separated."""
    return comma_join(F.json_object_keys(after))


def listed_values(after: Column) -> Column:
    """Field values of an image in the order of `listed_fields`, comma separated; a null is an empty text."""
    fields = F.from_json(after, "map<string,string>")
    return F.array_join(F.transform(F.json_object_keys(after), lambda k: F.coalesce(fields[k], F.lit(""))), ",")


def latest_rows(changelog: DataFrame, key: Column | str, order: str = "seq") -> DataFrame:
    """The last version of each key.

    Only rank 1 is kept, so Spark discards older versions inside each map task and a key with
    very many versions does not gather in one place.
    """
    by = F.col(key) if isinstance(key, str) else key
    ranked = changelog.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(by).orderBy(F.col(order).desc()))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def last_columns(images: DataFrame, names: list[str], key: str, order: Column) -> DataFrame:
    """One row per `pk`: for each column the value of the last image that has the column.

    Columns are upper-case text and the key column is `pk` itself, so a filter on it reaches the
    scan. Each map task keeps one value per key and column before the shuffle.
    """
    rows = images.where(F.col("pk").isNotNull()).select(
        "pk", order.alias("_order"), F.from_json("after", "map<string,string>").alias("_fields")
    )
    values = (
        F.max_by(F.col("_fields")[n], F.when(F.map_contains_key("_fields", n), F.col("_order"))).alias(n.upper())
        for n in names
        if n != key
    )
    # A row of a table that has only its key still needs an aggregate.
    latest = rows.groupBy("pk").agg(F.max("_order").alias("_order"), *values)
    return latest.select(*(F.col("pk" if n == key else n.upper()).alias(n.upper()) for n in names))


def dimension_table(changelog: DataFrame, schema: T.StructType) -> DataFrame:
    """Current rows of one dimension out of its `after` images, columns as upper-case text."""
    key = next(f.name for f in schema.fields if f.metadata.get("primary_key"))
    pk = F.get_json_object("after", f"$.{key}")
    return last_columns(changelog.select(pk.alias("pk"), "after", "seq"), schema.fieldNames(), key, F.col("seq"))
