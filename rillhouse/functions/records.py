"""JSON text to typed rows and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def computed_once(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """`keep` columns and computed ones, in a step that later filters are not pushed through.

    A filter on a plain computed column is pushed below it with the expression copied, null
    checks of join keys included, so that a parse runs once per filter on top of its own run.
    """
    cells = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select(*keep, F.inline(F.array(cells)))


def strict_records(df: DataFrame, schema: T.StructType, into: str = "_r") -> DataFrame:
    """Read `value` as exactly one JSON object; `into` is null for anything else.

    The text is read as the first of two array elements; the second holds a hash of the text and
    must come back, so the text cannot end the array early, go on after its object, or be a bare
    array, scalar, `null` or empty. Plain reading lets most of those through. Unpacking the array
    with explode also keeps later filters on the record above the parse, so that a line is parsed
    once and not once per filter.
    """
    mark = F.xxhash64("value").cast("string")
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit(',{"_mark":"'), mark, F.lit('"}]'))
    marked = T.StructType([*schema.fields, T.StructField("_mark", T.StringType())])
    read = df.withColumn("_rows", F.from_json(wrapped, T.ArrayType(marked)))
    first, second = F.get("_rows", F.lit(0)), F.get("_rows", F.lit(1))
    whole = (F.size("_rows") == 2) & first.isNotNull() & (second["_mark"] == mark)
    one = F.when(whole, F.slice("_rows", 1, 1))
    out = read.select(*df.columns, F.explode_outer(one).alias(into))
    return out.withColumn(into, F.col(into).dropFields("_mark"))


def parse_bean(df: DataFrame, schema: T.StructType, value: str = "value", *keep: str) -> DataFrame:
    """Replace a JSON text column by the columns of `schema`; `keep` columns stay."""
    rows = computed_once(df, *keep, _record=F.from_json(F.col(value), schema))
    return rows.select(*keep, "_record.*")


def json_line(*columns: str | Column) -> Column:
    """Row to one JSON text; null fields are left out."""
    return F.to_json(F.struct(*(columns or ("*",))))


def is_blank(text: Column) -> Column:
    """Null or empty."""
    return text.isNull() | (F.length(text) == 0)


def whole_number(text: Column) -> Column:
    return text.try_cast("bigint")


def in_list(item: Column, comma_text: Column) -> Column:
    """Exact membership in a comma list; blanks around names are significant."""
    return F.array_contains(F.split(comma_text, ",", -1), item)


def comma_join(items: Column) -> Column:
    return F.array_join(items, ",")


#: How deep a field's value may be nested for its text to be walked; deeper ones are read as variants.
DEPTH = 8
_TEXT = r'"(?:[^"\\]++|\\.)*+"'
_INSIDE = rf'(?:[^"{{}}\[\]]++|{_TEXT})*+'
for _ in range(DEPTH - 1):
    _INSIDE = rf'(?:[^"{{}}\[\]]++|{_TEXT}|[{{\[]{_INSIDE}[}}\]])*+'
_VALUE = rf'(?:{_TEXT}|[{{\[]{_INSIDE}[}}\]]|[^\s",:{{}}\[\]]++)'
_NAME = rf"\s*+{_TEXT}\s*+:\s*+"


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spelled(value: Column, opened: str, closed: str, part: str) -> Column:
    """The parts between the brackets of a JSON text; null where they are not all found."""

    def parts(bare: Column) -> Column:
        def whole(inside: Column) -> Column:
            framed = bare.startswith(opened) & bare.endswith(closed)
            found = F.regexp_extract_all(inside, F.lit(part), F.lit(0))
            empty = F.when(F.trim(inside) == "", F.array().cast("array<string>"))
            return with_value(found, lambda f: F.when(framed & (F.array_join(f, ",") == inside), f).otherwise(empty))

        return with_value(F.substring(bare, F.lit(2), F.length(bare) - 2), whole)

    return with_value(F.btrim(value, F.lit(" \t\n\x0b\f\r")), parts)


def text_fields(value: Column) -> Column:
    """The fields of one JSON object text as they are spelled, `"name":value`, in order.

    Quantifiers are possessive: a field is walked once and never backtracks. Null for a text whose
    fields are not all found, such as one that is nested too deep.
    """
    return _spelled(value, "{", "}", rf"{_NAME}{_VALUE}\s*+")


def array_items(value: Column) -> Column:
    """The items of one JSON array text as they are spelled; null as for `text_fields`."""
    return _spelled(value, "[", "]", rf"\s*+{_VALUE}\s*+")


def field_text(value: Column, field: str) -> Column:
    """The value of a field of an object text as it is spelled, the last one of a repeated name."""
    own = F.element_at(F.filter(text_fields(value), lambda f: _named(f, field)), -1)
    return F.regexp_replace(own, rf"\A{_NAME}", "")


def _named(field_text: Column, name: str) -> Column:
    return F.regexp_extract(field_text, rf"\A\s*+({_TEXT})", 1) == f'"{name}"'


def _object_text(fields: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))


def put_text_field(value: Column, field: str, new: Column) -> Column:
    """An object text with `field` last and as given; one of that name that it has already goes."""
    others = F.filter(text_fields(value), lambda f: ~_named(f, field))
    return _object_text(F.concat(others, F.array(F.concat(F.lit(f'"{field}":'), new))))


def set_text_field(value: Column, parent: str, field: str, new: str) -> Column:
    """Set one string field of one nested object in a JSON text; all else stays as it is spelled.

    The field is written over where it stands, and where a name is repeated, in each place. A text
    that is nested too deep is edited as a variant, which may print numbers shorter; null when the
    text cannot be held as one either.
    """

    def edited(outer: Column) -> Column:
        name = F.regexp_extract(outer, rf"\A{_NAME}", 0)
        inner = text_fields(F.substring(outer, F.length(name) + 1, F.length(outer)))
        done = F.transform(inner, lambda f: F.when(_named(f, field), f'"{field}":"{new}"').otherwise(f))
        return F.when(_named(outer, parent), F.concat(name, _object_text(done))).otherwise(outer)

    fields = F.transform(text_fields(value), edited)
    spelled = F.when(~F.exists(fields, lambda f: f.isNull()), _object_text(fields))
    return F.coalesce(spelled, _set_in_variant(value, parent, field, new))


def _set_in_variant(value: Column, parent: str, field: str, new: str) -> Column:
    parsed = F.try_parse_json(value)
    top = F.try_variant_get(parsed, "$", "map<string,variant>")
    inner = F.try_variant_get(parsed, f"$.{parent}", "map<string,variant>")
    others = F.map_filter(inner, lambda k, _: k != F.lit(field))
    replaced = F.map_concat(others, F.create_map(F.lit(field), F.parse_json(F.lit(f'"{new}"'))))
    rest = F.map_filter(top, lambda k, _: k != F.lit(parent))
    return F.to_json(
        F.map_concat(rest, F.create_map(F.lit(parent), F.to_variant_object(replaced)))
    )
