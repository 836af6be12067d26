"""Small input builders and the brute-force answers the operators are held against."""

from __future__ import annotations

import json
from datetime import datetime, timezone

LINES = "value string, seq bigint"
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def log_line(mid="m1", ts=T0, last=None, is_new="0", page="home", during=5, **more):
    record = {
        "common": {"mid": mid, "is_new": is_new, "vc": "v1", "ch": "c1", "ar": "a1"},
        "page": {"page_id": page, "during_time": during},
        "ts": ts,
        **more,
    }
    if last is not None:
        record["page"]["last_page_id"] = last
    return json.dumps(record, separators=(",", ":"))


def lines_frame(spark, lines):
    return spark.createDataFrame([(v, i) for i, v in enumerate(lines)], LINES)


def millis(text):
    at = datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    return int(at.timestamp() * 1000)


def replay_bounces(events, horizon):
    """`(mid, ts, seq, entry)` rows to the `seq` of bounces, one device at a time in order."""
    out, last = set(), {}
    for mid, ts, seq, entry in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        if mid in last:
            start_ts, start_seq = last.pop(mid)
            if ts - start_ts >= horizon or entry:
                out.add(start_seq)
        if entry:
            last[mid] = (ts, seq)
    return out | {seq for _, seq in last.values()}


def replay_claims(events):
    """`(mid, ts, seq, is_new)` rows to `{seq: corrected flag}`."""
    seen, out = set(), {}
    for mid, ts, seq, flag in sorted(events, key=lambda e: (e[1], e[2])):
        if flag == "1":
            out[seq] = "0" if mid in seen else "1"
            seen.add(mid)
        else:
            out[seq] = flag
    return out


def replay_visits(events):
    """`(mid, ts, seq, entry)` rows to the `seq` of first entries per device and UTC day."""
    seen, out = set(), set()
    for mid, ts, seq, entry in sorted(events, key=lambda e: (e[1], e[2])):
        day = (mid, ts // 86_400_000)
        if entry and day not in seen:
            seen.add(day)
            out.add(seq)
    return out
