import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillhouse.operators import slices, visitors
from tests.helpers import T0, millis, replay_bounces, replay_claims, replay_visits

PAGE = (
    "mid string, ts bigint, seq bigint, last_page_id string, is_new string, start string, "
    "page_id string, vc string, ch string, ar string, during_time bigint"
)


def frame(spark, rows):
    """`(mid, ts, seq, entry, is_new[, start])` to flat records."""
    full = [
        (m, ts, seq, None if entry else "p", new, rest[0] if rest else None, "home", "v", "c", "a", 1)
        for m, ts, seq, entry, new, *rest in rows
    ]
    return spark.createDataFrame(full, PAGE)


def pages(spark, text, mid="m"):
    """`E@0 N@9.999` (seconds) to page rows."""
    out = []
    for seq, token in enumerate(text.split()):
        kind, at = token.split("@")
        out.append((mid, T0 + round(float(at) * 1000), seq, kind == "E", "0"))
    return frame(spark, out)


def seqs(df):
    return sorted(r.seq for r in df.collect())


@pytest.mark.parametrize(
    "text, want",
    [
        ("E@0 E@3 N@5", [0]),
        ("E@0 N@9.999", []),
        ("E@0 N@10", [0]),
        ("E@0", [0]),
        ("N@0 E@1", [1]),
        ("E@0 E@0 N@0", [0]),
        ("E@299 N@301", []),
        ("E@299 E@301 N@302", [0]),
        ("E@295 N@304.999 E@310", [2]),
    ],
)
def test_bounce_sequences(spark, text, want):
    assert seqs(visitors.bounces(pages(spark, text))) == want


def test_bounce_horizon_can_include_its_end(spark):
    late = pages(spark, "E@0 N@10")
    assert seqs(visitors.bounces(late, inclusive=True)) == []
    assert seqs(visitors.bounces(pages(spark, "E@0 N@10.001"), inclusive=True)) == [0]


def test_bounce_sees_across_midnight(spark):
    before = millis("2024-01-01 23:59:58")
    rows = [("m", before, 0, True, "0"), ("m", before + 4000, 1, False, "0")]
    assert seqs(visitors.bounces(frame(spark, rows))) == []


def test_slice_must_cover_the_horizon(spark):
    with pytest.raises(ValueError):
        visitors.bounces(pages(spark, "E@0"), horizon_ms=1000, slice_ms=999)


@pytest.mark.parametrize("flags, want", [("111", "100"), ("011", "010"), ("101", "100")])
def test_new_flag_sequences(spark, flags, want):
    rows = [("m", T0 + i, i, True, f) for i, f in enumerate(flags)]
    got = visitors.fix_new_visitors(frame(spark, rows)).orderBy("seq").collect()
    assert "".join(r.is_new for r in got) == want
    assert "".join(r.raw_is_new for r in got) == flags


def test_other_flags_pass_untouched(spark):
    rows = [("m", T0, 0, True, None), ("m", T0 + 1, 1, True, "x"), ("m", T0 + 2, 2, True, "1")]
    got = visitors.fix_new_visitors(frame(spark, rows)).orderBy("seq").collect()
    assert [r.is_new for r in got] == [None, "x", "1"]


def test_first_visit_starts_again_at_midnight(spark):
    times = ["2024-01-01 23:59:59", "2024-01-02 00:00:01", "2024-01-02 00:00:02"]
    rows = [("m", millis(t), i, True, "0") for i, t in enumerate(times)]
    rows += [("n", millis("2024-01-01 10:00:00"), 8, False, "0"),
             ("n", millis("2024-01-01 11:00:00"), 9, True, "0")]
    assert seqs(visitors.first_visits(frame(spark, rows))) == [0, 1, 9]


def random_events(seed, count=3000, devices=25, span=3 * 86_400_000, step=1):
    """A third of the rows are of one device; times repeat."""
    rng = random.Random(seed)
    rows = []
    for seq in range(count):
        mid = "hot" if rng.random() < 0.34 else f"m{rng.randrange(devices)}"
        ts = T0 + rng.randrange(span // step) * step
        start = "{}" if rng.random() < 0.15 else None
        rows.append((mid, ts, seq, rng.random() < 0.6, rng.choice("0111"), start))
    return rows


@pytest.mark.parametrize("seed, horizon, width, step", [
    (1, 600_000, None, 1), (2, 10_000, 60_000, 1000), (3, 3_600_000, 3_600_000, 60_000),
    (4, 5_000_000, 5_000_000, 1), (5, 6 * 3_600_000, None, 3_600_000),
])
def test_operators_equal_sequential_replay(spark, seed, horizon, width, step):
    rows = random_events(seed, step=step)
    records = frame(spark, rows).cache()
    page_rows = [r for r in rows if r[5] is None]
    pages_ = records.where("start IS NULL")
    bounced = replay_bounces([r[:4] for r in page_rows], horizon)
    visited = replay_visits([r[:4] for r in page_rows])
    claims = replay_claims([(r[0], r[1], r[2], r[4]) for r in rows])

    assert set(seqs(visitors.bounces(pages_, horizon, slice_ms=width))) == bounced
    assert set(seqs(visitors.first_visits(pages_))) == visited
    fixed = visitors.fix_new_visitors(records, width).collect()
    assert {r.seq: r.is_new for r in fixed} == claims

    flagged = visitors.visit_flags(records, horizon, slice_ms=width).collect()
    assert len(flagged) == len(page_rows)
    assert {r.seq for r in flagged if r.is_bounce} == bounced
    assert {r.seq for r in flagged if r.is_visit} == visited
    assert {r.seq: r.is_new for r in flagged} == {r[2]: claims[r[2]] for r in page_rows}
    records.unpersist()


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40), st.booleans()), max_size=25),
       st.sampled_from([1, 3, 7]), st.booleans())
def test_bounces_property(spark, steps, horizon, inclusive):
    rows = [(m, T0 + t, i, e, "0") for i, (m, t, e) in enumerate(steps)]
    df = frame(spark, rows)
    got = visitors.bounces(df, horizon, inclusive, slice_ms=max(8, horizon))
    want = replay_bounces([r[:4] for r in rows], horizon + (1 if inclusive else 0))
    assert set(seqs(got)) == want


def test_slices_hold_in_a_zone_with_clock_changes(spark):
    """25 h and 23 h days leave short slices at odd widths; answers must not change."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        start = millis("2024-10-26 12:00:00")
        rng = random.Random(9)
        rows = [
            (f"m{rng.randrange(3)}", start + rng.randrange(36) * 1_800_000 + rng.randrange(3), i,
             rng.random() < 0.6, "1")
            for i in range(400)
        ]
        hours = 3_600_000
        for width in (5 * hours, 12 * hours, 24 * hours):
            got = visitors.bounces(frame(spark, rows), 5 * hours, slice_ms=width)
            assert set(seqs(got)) == replay_bounces([r[:4] for r in rows], 5 * hours)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_device_is_spread_over_slices(spark):
    rows = [("hot", T0 + i * 1000, i, True, "0") for i in range(7200)]
    placed = slices.add_slice_with_reach(frame(spark, rows), 10_000, 300_000)
    sizes = [r["count"] for r in placed.groupBy("mid", "slice").count().collect()]
    # 24 slices of 300 rows, and the 10 first rows of each slice seen again by the one before.
    assert len(sizes) == 25 and max(sizes) == 310
    assert placed.where(F.col("own")).count() == 7200
