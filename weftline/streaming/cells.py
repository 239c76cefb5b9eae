"""Queue cells over Structured Streaming: keyed state with timers, in event-time order.

Actions may come in any order within the watermark's delay. They wait in the
state under their time, each with a timer, and are worked off when the
watermark has passed them; a message's due time and a lease's end are timers of
the same kind. So the rows that come out are those of the batch operator over the
same actions, whatever the micro-batches were, also after a restart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.functions.cells import Cell
from weftline.operators.queue_life import ACTION, LIFE, bounds
from weftline.operators.queues import IN_FLIGHT, LEASE_MS, MAX_ATTEMPTS

#: The state store that keyed processors need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_WAITING = {c: t for c, t in ACTION.items() if c not in ("at_ms", "seq")}


def plain(value, kind: str):
    """A cell of a pandas frame as a Python value, missing as None; pandas has whole numbers with gaps as floats."""
    if value is None or value is pd.NA or value != value:
        return None
    return int(value) if kind in ("long", "int") else value


class CellProcessor(StatefulProcessor):
    """One cell's state: ``waiting`` actions by (time, seq), ``messages`` alive by id, ``holders`` of idempotency keys.

    What a step changes is written, nothing else; a cell's messages are read once for all
    actions that the watermark has passed at a time.
    """

    def __init__(self, cell: str, in_flight: int, lease_ms: int, max_attempts: int, alarms: bool):
        self.cell, self.settings, self.alarms = cell, (in_flight, lease_ms, max_attempts), alarms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at_ms long, seq long", ", ".join(f"{c} {t}" for c, t in _WAITING.items()))
        self.messages = handle.getMapState("messages", "message_id long", "idempotency_key string, attempt long, due_ms long, lease long, ends_ms long")
        self.holders = handle.getMapState("holders", "idempotency_key string", "message_id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for values in frame[["at_ms", "seq", *_WAITING]].itertuples(index=False, name=None):
                at, seq, *rest = map(plain, values, ("long", "long", *_WAITING.values()))
                self.waiting.updateValue((at, seq), tuple(rest))
                self.handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs()  # whatever it has passed is due, so one timer serves for the others
        ready = sorted((k, v) for k, v in self.waiting.iterator() if k[0] <= until)
        state = Cell(*self.settings, alarms=self.alarms)
        if not ready and not self.alarms:
            return
        state.messages = {k[0]: list(v) for k, v in self.messages.iterator()}
        state.keys = {k[0]: v[0] for k, v in self.holders.iterator()}
        out = []
        for (at, seq), rest in ready:
            out += state.act({"at_ms": at, "seq": seq, **dict(zip(_WAITING, rest, strict=True))})
            self.waiting.removeKey((at, seq))
        if self.alarms:
            out += state.advance(until)
            if (alarm := state.next_alarm()) is not None:
                self.handle.registerTimer(max(alarm, until + 1))
        for i in state.changed:
            if i in state.messages:
                self.messages.updateValue((i,), tuple(state.messages[i]))
            elif self.messages.containsKey((i,)):
                self.messages.removeKey((i,))
        for k in state.freed:
            if k in state.keys:
                self.holders.updateValue((k,), (state.keys[k],))
            elif self.holders.containsKey((k,)):
                self.holders.removeKey((k,))
        frame = pd.DataFrame(out, columns=list(LIFE)).astype({c: "Int64" for c, t in LIFE.items() if t == "long"})
        frame.insert(0, self.cell, key[0])
        yield frame

    def close(self) -> None:
        pass


def live_stream(
    actions: DataFrame, cell: str = "cell", in_flight: int = IN_FLIGHT, lease_ms: int = LEASE_MS, max_attempts: int = MAX_ATTEMPTS, delay_ms: int = 0, alarms: bool = False
) -> DataFrame:
    """Streaming actions (cell, ACTION) as ``queue_life.lives`` gives them, up to the watermark.

    ``delay_ms`` is how late an action may come; a later one is dropped by the
    watermark. With ``alarms`` cells wake by themselves. Needs the RocksDB state store (ROCKSDB).
    """
    bounds(in_flight, lease_ms, max_attempts)
    have = set(actions.columns)
    rows = actions.selectExpr(f"`{cell}`", *(f"cast({c if c in have else 'null'} as {t}) as {c}" for c, t in ACTION.items()))
    rows = rows.withColumn("__at", F.timestamp_millis("at_ms")).withWatermark("__at", f"{delay_ms} milliseconds")
    kind = actions.schema[cell].dataType.simpleString()
    schema = ", ".join([f"`{cell}` {kind}", *(f"{c} {t}" for c, t in LIFE.items())])
    processor = CellProcessor(cell, in_flight, lease_ms, max_attempts, alarms)
    return rows.groupBy(cell).transformWithStateInPandas(processor, schema, "Append", "EventTime")
