"""Fill-in-middle forms of whole texts: one counted match cuts prefix, middle and suffix.

A text is a row of units, words of ASCII letters or other single characters. Its number of units
comes from `regexp_count`; two hashed cuts turn it into a pattern of its own,
`(unit{a})(unit{b-a})(rest)`, and one replacement writes the three parts in the order of the form.
The counted groups are possessive: they are walked in a loop, never backtrack, and need no stack,
however many units a text has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100: texts that stay plain, and those of the rest whose suffix comes first.
PLAIN, SUFFIX_FIRST = 10, 20


def hash_group(doc_id: Column, number: int, seed: str) -> Column:
    """The `number`th group of 8 hex digits of the id's sha256, as an unsigned integer; a null id is an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(name.cast("binary"), 256), 8 * number - 7, 8), 16, 10).cast("bigint")


def restored(output: Column, form: Column) -> Column:
    """The text that an output and its form stand for."""
    first, second = f"{PREFIX}|{SUFFIX}", f"{SUFFIX}|{PREFIX}"
    parts = F.lit(f"(?s)\\A(?:{first})(.*?)(?:{second})(.*?){MIDDLE}(.*)\\z")
    order = F.when(form == "psm", "$1$3$2").otherwise("$2$3$1")
    return F.when(form == "plain", output).otherwise(F.regexp_replace(output, parts, order))


def fill_in_middle(
    docs: DataFrame, text: str = "text", seed: str = "1", plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """One row per row of `docs`: `doc_id, n, form, output, prefix_chars, middle_chars`.

    `n` is the number of units. Null and empty texts, texts that hold a marker, and `plain` of 100
    others keep their text (`plain`); the rest is `psm` or, for `suffix_first` of 100, `spm`. Cuts
    and form follow from `doc_id` alone, so equal rows give equal rows. Other columns are ignored.
    """
    h1, h2, h3, h4 = (hash_group(F.col("doc_id"), i, seed) for i in (1, 2, 3, 4))
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select("doc_id", whole.alias("whole"), F.regexp_count(whole, F.lit(UNIT)).cast("bigint").alias("n"))
    marked = F.contains("whole", F.lit(PREFIX)) | F.contains("whole", F.lit(SUFFIX)) | F.contains("whole", F.lit(MIDDLE))
    one, two = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    form = F.when((F.col("n") == 0) | marked | (h3 % 100 >= 100 - plain), "plain").otherwise(
        F.when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    )
    cut = counted.select("*", form.alias("form"), F.least(one, two).alias("a"), (F.greatest(one, two) - F.least(one, two)).alias("m"))
    pattern = F.format_string(f"(?s)\\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*+)\\z", "a", "m")
    written = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("whole")).otherwise(F.regexp_replace("whole", pattern, written))
    cut = cut.select("doc_id", "n", "form", output.alias("output"))
    # Only markers written here stand in an output that is not plain; a marker is three characters.
    middle_at, suffix_at, prefix_at = (F.instr(F.col("output"), m) for m in (MIDDLE, SUFFIX, PREFIX))
    behind = F.when(F.col("form") == "psm", suffix_at).otherwise(middle_at)
    return cut.select(
        "*",
        F.when(F.col("form") != "plain", behind - prefix_at - 3).cast("bigint").alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.length("output") - middle_at - 2).cast("bigint").alias("middle_chars"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """`doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256` of every row."""
    done = fill_in_middle(docs)
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS whole, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), hashed AS (
  SELECT *, CAST(len(unit) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM base
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN whole = '' OR contains(whole, '<P>') OR contains(whole, '<S>') OR contains(whole, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), parts AS (
  SELECT doc_id, whole, n, form, array_to_string(unit[1:a], '') AS prefix,
         array_to_string(unit[a + 1:b], '') AS middle, array_to_string(unit[b + 1:n], '') AS suffix
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN whole WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(whole) AS restored_sha256
FROM parts
"""
