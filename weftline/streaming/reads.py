"""Bounded reads of chunk streams that wait for new chunks, over Structured Streaming.

Writes, ends and reads of a stream wait in the state for the watermark and are
worked off in the order of their times, so answers are those of
``streams.waiting_reads``. The end of a read's wait is a timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.streaming.cells import plain

#: What happens to a stream: a write (idx, size), an end (state) or a read.
ACTION = {
    "at_ms": "long", "seq": "long", "action": "string", "idx": "long", "size": "long", "state": "string", "request_id": "long", "start": "long", "max_chunks": "long",
    "max_bytes": "long", "wait_ms": "long",
}
ANSWER = {
    "request_id": "long", "start": "long", "answered_ms": "long", "timed_out": "boolean", "state": "string", "tail_index": "long", "n_chunks": "long", "bytes": "long",
}
_LATER = {c: t for c, t in ACTION.items() if c not in ("at_ms", "seq")}
#: At one time writes come before ends, and ends before reads and the ends of their waits.
_RANK = {"write": 0, "end": 1, "read": 2}


class ReadProcessor(StatefulProcessor):
    """One stream: sizes of its chunks by index, its count and state, reads that wait, and actions that wait for the watermark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", "count long, state string")
        self.sizes = handle.getMapState("sizes", "idx long", "size long")
        self.later = handle.getMapState("later", "at_ms long, seq long", ", ".join(f"{c} {t}" for c, t in _LATER.items()))
        self.open = handle.getMapState("open", "request_id long", "until_ms long, start long, max_chunks long, max_bytes long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for values in frame[list(ACTION)].itertuples(index=False, name=None):
                at, seq, *rest = map(plain, values, ACTION.values())
                self.later.updateValue((at, seq), tuple(rest))
                self.handle.registerTimer(at + 1)  # when all of that time are there
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs()
        ready = [(at, dict(zip(_LATER, v, strict=True)), seq) for (at, seq), v in self.later.iterator() if at < until]
        waiting = {k[0]: v for k, v in self.open.iterator()}
        count, state = self.meta.get() if self.meta.exists() else (0, "open")
        before = set(waiting)
        out: list[tuple] = []

        def answer(request: int, at: int, start: int, most: int, most_bytes: int, timed_out: bool) -> None:
            n = held = 0
            while n < most and start + n < count:
                size = self.sizes.getValue((start + n,))[0]
                if held + size > most_bytes:
                    break
                n, held = n + 1, held + size
            out.append((request, start, at, timed_out, state, count - 1, n, held))

        def wake(at: int, timed_out: bool, which: list[int]) -> None:
            for i in which:
                _, start, most, most_bytes = waiting.pop(i)
                answer(i, at, start, most, most_bytes, timed_out)

        def time_out(end: int) -> None:
            for i in sorted((i for i, w in waiting.items() if w[0] < end), key=lambda i: waiting[i][0]):
                wake(waiting[i][0], True, [i])

        ready.sort(key=lambda r: (r[0], _RANK[r[1]["action"]], r[2]))
        place = 0
        while place < len(ready):
            at = ready[place][0]
            time_out(at)
            changed = False
            while place < len(ready) and ready[place][0] == at and ready[place][1]["action"] != "read":
                a = ready[place][1]
                if state == "open" and a["action"] == "write":
                    self.sizes.updateValue((a["idx"],), (a["size"],))
                    count, changed = max(count, a["idx"] + 1), True
                elif state == "open":
                    state, changed = a["state"], True
                place += 1
            if changed:
                wake(at, False, sorted(waiting))
            while place < len(ready) and ready[place][0] == at:
                a = ready[place][1]
                if count > a["start"] or state != "open" or not a["wait_ms"] or not a["max_chunks"]:
                    answer(a["request_id"], at, a["start"], a["max_chunks"], a["max_bytes"], False)
                else:
                    waiting[a["request_id"]] = (at + a["wait_ms"], a["start"], a["max_chunks"], a["max_bytes"])
                    self.handle.registerTimer(at + a["wait_ms"] + 1)
                place += 1
        time_out(until)
        for at, _, seq in ready:
            self.later.removeKey((at, seq))
        for i in before - set(waiting):
            self.open.removeKey((i,))
        for i in set(waiting) - before:
            self.open.updateValue((i,), waiting[i])
        self.meta.update((count, state))
        if out:
            frame = pd.DataFrame(out, columns=list(ANSWER))
            frame.insert(0, "stream", key[0])
            yield frame

    def close(self) -> None:
        pass


def waiting_reads(actions: DataFrame, delay_ms: int) -> DataFrame:
    """Streaming actions (stream, ACTION) to answers (stream, ANSWER), up to the watermark.

    ``seq`` tells a stream's actions of one time apart; a write's chunks are one action each. ``delay_ms`` is how late an
    action may come. A stream is written in order by one owner, so it is one key's
    work; only the sizes that an answer needs are read from the state. Needs the RocksDB state store.
    """
    rows = actions.selectExpr("stream", *(f"cast({c} as {t}) as {c}" for c, t in ACTION.items()))
    rows = rows.withColumn("__at", F.timestamp_millis("at_ms")).withWatermark("__at", f"{delay_ms} milliseconds")
    schema = f"stream {actions.schema['stream'].dataType.simpleString()}, " + ", ".join(f"{c} {t}" for c, t in ANSWER.items())
    return rows.groupBy("stream").transformWithStateInPandas(ReadProcessor(), schema, "Append", "EventTime")
