"""Stream forms of the stateful operators. Rows are topic rows: `value, seq, record_ms`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.functions.times import day_of
from rillhouse.operators import logs, slices
from rillhouse.operators.visitors import BOUNCE_HORIZON_MS
from rillhouse.streaming.processors import (
    BOUNCE_OUT, CLAIM_OUT, LOOKUP_OUT, BounceWatch, FirstClaim, LatestImages,
)

#: Copies of a dimension row in the state, between which the facts of its key are dealt.
SALTS = 4
#: Buckets of dimension rows; the rows of a bucket are held together.
KEY_BUCKETS = 1024
#: Buckets of devices; the rows of a bucket go through the state together.
DEVICE_BUCKETS = 256


def with_event_time(records: DataFrame, delay: str) -> DataFrame:
    return records.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", delay)


def fix_new_visitors(lines: DataFrame, keep_rejected: bool = False) -> DataFrame:
    """Records with the corrected `is_new` and the flag as it came in `raw_is_new`.

    Only records that claim to be new pass through the state; the others neither read nor set
    it and stay on the JVM. Rejected lines are left out, or kept with their `reject_reason`.
    """
    read = logs.read_lines(lines)
    clean = F.col("reject_reason").isNull()
    claims = clean & F.col("is_new").eqNullSafe("1")
    fixed = (
        read.where(claims)
        .select("mid", "value", "seq", "record_ms", "ts")
        .groupBy("mid")
        .transformWithState(FirstClaim(), CLAIM_OUT, "append", "None")
    )
    read_again = logs.read_lines(
        fixed.select("value", "seq", "record_ms", F.col("is_new").alias("fixed"))
    )
    columns = [c for c in read.columns if c != "is_new"]
    raw = F.col("is_new").alias("raw_is_new")
    changed = read_again.select(*columns, raw, F.col("fixed").alias("is_new"))
    same = read.where(~claims).select(*columns, raw, "is_new")
    records = changed.unionByName(same)
    return records if keep_rejected else records.where(clean).drop("reject_reason")


def first_visits(lines: DataFrame, delay: str = "24 hours") -> DataFrame:
    """The first entry page to arrive of each device and day.

    Repeats within a day are less than a day apart, so state older than the delay can go.
    """
    pages = logs.entry_pages(logs.page_logs(logs.clean_records(lines)))
    timed = with_event_time(pages.withColumn("dt", day_of(F.col("ts"))), delay)
    return timed.dropDuplicatesWithinWatermark(["mid", "dt"])


def bounces(
    lines: DataFrame,
    delay: str = "2 seconds",
    horizon_ms: int = BOUNCE_HORIZON_MS,
    inclusive: bool = False,
    slice_ms: int | None = None,
    buckets: int = DEVICE_BUCKETS,
) -> DataFrame:
    """Bounced entry pages as `value, seq`.

    State is kept per time slice, as in the batch form, and bucket of devices: a hot device
    spreads over its slices, and the state of a slice is gone once the watermark is past it.
    A batch reads the waiting rows of the buckets it touches, so more `buckets` suit streams
    with a long horizon and many devices.
    """
    within = horizon_ms + 1 if inclusive else horizon_ms
    width = slice_ms or slices.default_width(within)
    pages = logs.page_logs(logs.clean_records(lines))
    timed = with_event_time(pages.withColumn("entry", logs.is_entry()), delay)
    placed = slices.add_slice_with_reach(
        timed.select("mid", "ts", "seq", "entry", "value", "et"), within, width
    )
    emits = F.col("own") & F.col("entry")
    slim = placed.select(
        F.pmod(F.xxhash64("mid"), F.lit(buckets)).cast("int").alias("bucket"), "mid", "slice", "et", "ts", "seq", "entry", emits.alias("emits"),
        F.when(emits, F.col("value")).alias("value"),
    )
    return slim.groupBy("bucket", "slice").transformWithState(
        BounceWatch(within), BOUNCE_OUT, "append", "EventTime"
    )


def lookup_changing(
    facts: DataFrame, images: DataFrame, stored: DataFrame | None = None, salts: int = SALTS,
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """Facts `key, value, seq` with the `image` of their dimension row as of their micro-batch.

    `images` is the changelog as a stream, `key, seq, image`; `stored` the rows so far, `key,
    image`, which a new checkpoint starts from. The dimension lives in state by bucket of keys, and
    a batch reads the buckets that it has keys of: more `buckets` suit small batches on large
    dimensions. Each row is held once per salt and facts are dealt over the salts, so a hot key is
    no single task. Facts without a key get no image.
    """
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    none = F.lit(None).cast("string")
    keyed = facts.where(F.col("key").isNotNull())
    dealt = keyed.select(bucket, "key", F.pmod(F.xxhash64("value", "seq"), F.lit(salts)).cast("int").alias("salt"), "value", "seq", none.alias("image"))
    copies = images.where(F.col("key").isNotNull() & F.col("image").isNotNull()).select(bucket, "key", every, none.alias("value"), "seq", "image")
    first = None
    if stored is not None:
        known = stored.where(F.col("key").isNotNull() & F.col("image").isNotNull())
        whole = known.groupBy(bucket).agg(F.collect_list(F.struct("key", "image")).alias("rows"))
        first = whole.select("bucket", every, "rows").groupBy("bucket", "salt")
    found = dealt.unionByName(copies).groupBy("bucket", "salt").transformWithState(
        LatestImages(), LOOKUP_OUT, "append", "None", initialState=first
    )
    return found.unionByName(facts.where(F.col("key").isNull()).select("value", "seq", none.alias("image")))
