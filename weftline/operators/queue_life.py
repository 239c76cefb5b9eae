"""The whole life of queue messages over a table of actions: claims, leases, answers, retries and death in their order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.functions.cells import Cell
from weftline.operators.queues import IN_FLIGHT, IN_FLIGHT_CAP, LEASE_MS, MAX_ATTEMPTS

#: What an action says; absent columns count as null.
ACTION = {
    "seq": "long", "at_ms": "long", "action": "string", "message_id": "long", "idempotency_key": "string", "delay_s": "long", "lease": "long",
    "status": "int", "timeout_s": "int",
}
LIFE = {"seq": "long", "at_ms": "long", "message_id": "long", "what": "string", "original_id": "long", "attempt": "long", "lease": "long", "due_ms": "long"}
_ARROW = {"long": pa.int64(), "string": pa.string()}


def bounds(in_flight: int, lease_ms: int, max_attempts: int) -> None:
    if not 1 <= in_flight <= IN_FLIGHT_CAP or lease_ms < 1 or max_attempts < 1:
        raise ValueError(f"1 to {IN_FLIGHT_CAP} messages in flight, a lease of 1 ms or more and 1 attempt or more are needed")


def lives(actions: DataFrame, cell: str = "cell", in_flight: int = IN_FLIGHT, lease_ms: int = LEASE_MS, max_attempts: int = MAX_ATTEMPTS, alarms_until_ms: int | None = None) -> DataFrame:
    """What each action (cell, ACTION) does, in the order (at_ms, seq) of its cell: rows (cell, LIFE).

    An ``enqueue`` gives ``enqueued`` or ``deduped`` (with the holder's id), a
    ``tick`` one row for each lease that it finds ``lost`` and each message that is ``claimed``
    (due_ms: the lease's end), an ``answer`` ack, drop, redeliver, retry or dead, or
    ``late`` when its lease is no longer the message's. With
    ``alarms_until_ms`` cells also wake by themselves when a message is due or a lease ends, up to
    that time; such rows have no seq.

    A cell is a unit of concurrency with a bound on what is in flight, so it is
    worked off in sequence, in one task, of which only live messages are in memory; load
    is dealt over cells by the producers' shards. Rows without a cell are one cell.
    """
    bounds(in_flight, lease_ms, max_attempts)
    have = set(actions.columns)
    rows = actions.selectExpr(f"`{cell}`", *(f"cast({c if c in have else 'null'} as {t}) as {c}" for c, t in ACTION.items()))
    rows = rows.repartition(cell).sortWithinPartitions(cell, "at_ms", "seq")
    names = [cell, *LIFE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alarms = alarms_until_ms is not None
        state, current, begun = Cell(in_flight, lease_ms, max_attempts, alarms=alarms), None, False
        kind = None
        for batch in batches:
            out: list[tuple] = []
            kind = batch.schema.field(0).type
            for a in batch.to_pylist():
                if not begun or a[cell] != current:
                    if begun and alarms:
                        out += [(current, *r) for r in state.advance(alarms_until_ms)]
                    state, current, begun = Cell(in_flight, lease_ms, max_attempts, alarms=alarms), a[cell], True
                out += [(current, *r) for r in state.act(a)]
            yield arrow(out, kind)
        if begun and alarms:
            yield arrow([(current, *r) for r in state.advance(alarms_until_ms)], kind)

    def arrow(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
        types = [kind, *(_ARROW[t] for t in LIFE.values())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

    kind = actions.schema[cell].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"`{cell}` {kind}", *(f"{c} {t}" for c, t in LIFE.items())]))
