"""The operators that need ordered or everlasting state per key."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Rows that are written to a list state together.
CHUNK = 1000

CLAIM_OUT = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("record_ms", T.LongType()),
        T.StructField("is_new", T.StringType()),
    ]
)

PENDING = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("entry", T.BooleanType()),
        T.StructField("emits", T.BooleanType()),
        T.StructField("value", T.StringType()),
    ]
)

BOUNCE_OUT = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("seq", T.LongType())]
)


LOOKUP_OUT = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("image", T.StringType()),
    ]
)


class LatestImages(StatefulProcessor):
    """Holds the latest images of a bucket of dimension rows and hands them to the facts of their keys.

    Images of a micro-batch come before its facts, in the order of `seq`; a field that an image
    lacks keeps its value, one set to null loses it. Facts of a bucket and salt are held until the
    batch's images are read, so salts bound what a hot key holds. The images of a bucket are read
    and written together, as one JSON object of key and text: a call per key costs many times the
    key's own work.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.images = handle.getValueState("images", T.StructType([T.StructField("texts", T.StringType())]))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._hold(dict(sorted((row["key"], row["image"]) for row in initialState.rows)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        facts, images = [], []
        for row in rows:
            if row.image is None:
                facts.append((row.key, row.value, row.seq))
            else:
                images.append((row.key, row.seq, row.image))
        held = self.images.get()
        texts = json.loads(held[0]) if held else {}
        if images:
            for name, changes in itertools.groupby(sorted(images), key=lambda r: r[0]):
                text = texts.get(name)
                fields = json.loads(text) if text else {}
                for _, _, image in changes:
                    fields |= json.loads(image)
                texts[name] = json.dumps(fields, ensure_ascii=False, separators=(",", ":"))
            self._hold(texts)
        for name, value, seq in facts:
            yield Row(value=value, seq=seq, image=texts.get(name))

    def _hold(self, texts: dict[str, str]) -> None:
        self.images.update((json.dumps(texts, ensure_ascii=False, separators=(",", ":")),))

    def close(self) -> None:
        pass


class FirstClaim(StatefulProcessor):
    """Lets the first record of a device that claims to be new keep its flag, for ever.

    Within a micro-batch first means smallest `(ts, seq)`. One row is held at a time.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            for row in rows:
                yield self._out(key, row, "0")
            return
        first = next(rows)
        for row in rows:
            if (row.ts, row.seq) < (first.ts, first.seq):
                row, first = first, row
            yield self._out(key, row, "0")
        self.seen.update((first.ts,))
        yield self._out(key, first, "1")

    def _out(self, key, row: Row, flag: str) -> Row:
        return Row(mid=key[0], value=row.value, seq=row.seq, record_ms=row.record_ms, is_new=flag)

    def close(self) -> None:
        pass


class BounceWatch(StatefulProcessor):
    """Finds bounces within one time slice of a bucket of devices, in event-time order per device.

    Rows wait until the watermark has passed them, so their order is final. The earliest
    waiting row of a device is settled by a final follower or by the end of its horizon. The
    waiting rows of a bucket are read and written together, and one timer wakes it for its
    earliest row: a call per device costs many times the device's own work.
    """

    def __init__(self, within_ms: int) -> None:
        self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", PENDING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        arrived = [(r.mid, r.ts, r.seq, r.entry, r.emits, r.value) for r in rows]
        yield from self._settle(arrived, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settle([], timerValues.getCurrentWatermarkInMs())

    def _settle(self, arrived: list[tuple], watermark: int) -> Iterator[Row]:
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        if not held and not arrived:
            return
        queue = sorted(held + arrived, key=lambda r: r[:3])
        left, wake = [], None
        for _, rows in itertools.groupby(queue, key=lambda r: r[0]):
            rows = list(rows)
            settled = 0
            for at, (_, ts, seq, entry, emits, value) in enumerate(rows):
                following = rows[at + 1] if at + 1 < len(rows) else None
                if ts > watermark:
                    break
                if following is not None and following[1] <= watermark:
                    bounce = following[3] or following[1] - ts >= self.within_ms
                elif ts + self.within_ms <= watermark or not emits:
                    bounce = True
                else:
                    break
                settled += 1
                if emits and bounce:
                    yield Row(value=value, seq=seq)
            rest = rows[settled:]
            if rest:
                left += rest
                due = rest[0][1] + (self.within_ms if rest[0][4] else 0)
                if len(rest) > 1:
                    due = min(due, rest[1][1])
                wake = due if wake is None else min(wake, due)
        if left:
            if arrived or len(left) < len(queue):
                self.waiting.put(left[:CHUNK])
                for low in range(CHUNK, len(left), CHUNK):
                    self.waiting.appendList(left[low : low + CHUNK])
            wake = max(wake, watermark + 1)
            if not any(watermark < t <= wake for t in self.handle.listTimers()):
                self.handle.registerTimer(wake)
        elif held:
            self.waiting.clear()

    def close(self) -> None:
        pass
