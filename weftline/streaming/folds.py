"""The event fold and the queue's dedup over Structured Streaming, with state by key.

The same transitions serve batch and stream; a stream keeps a run's guard state
as JSON between micro-batches and picks up after a restart from its checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weftline.functions.transitions import ENDS, decide, new_state

FOLDED = "run_id string, seq long, event_type string, corr string, at_us long, outcome string, n_appended int, slot long"


#: A time that no watermark reaches, in the year 9999.
NEVER_MS = 253_402_300_000_000


def fold_stream(events: DataFrame, keep_ended_ms: int | None = None, current_spec: int | None = None) -> DataFrame:
    """Streaming events (run_id, seq, event_type, corr, at_us and what guards need) with outcome and slot.

    Within a micro-batch a run's rows are put in order (at_us, seq); rows that
    come in a later batch are later, whatever their time. With ``keep_ended_ms``
    the state of an ended run goes when the newest event of the stream is so much
    later than the run's last one, so that the state holds live and lately ended
    runs and doesn't grow for ever; the stream then takes no events that are older
    than that behind the newest. Without it every run's state is kept.
    """
    timeout = GroupStateTimeout.NoTimeout
    if keep_ended_ms is not None:
        timeout = GroupStateTimeout.EventTimeTimeout
        events = events.withColumn("__at", F.timestamp_micros("at_us")).withWatermark("__at", f"{keep_ended_ms} milliseconds")

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = json.loads(state.get[0]) if state.exists else new_state()
        if state.hasTimedOut:
            if kept["run"] in ENDS.values():
                state.remove()
            else:  # a live run never times out for good
                state.update((json.dumps(kept),))
                state.setTimeoutTimestamp(NEVER_MS)
            return
        rows = pd.concat(frames).sort_values(["at_us", "seq"])
        out = []
        for e in rows.astype(object).where(rows.notna(), None).to_dict("records"):
            outcome, types = decide(kept, e, current_spec)
            out.append((key[0], e["seq"], e["event_type"], e["corr"], e["at_us"], outcome, len(types), kept["n"]))
        state.update((json.dumps(kept),))
        if keep_ended_ms is not None:
            last = max(int(rows["at_us"].max()) // 1000, state.getCurrentWatermarkMs()) + 1
            state.setTimeoutTimestamp(last if kept["run"] in ENDS.values() else NEVER_MS)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in FOLDED.split(", ")])

    return events.groupBy("run_id").applyInPandasWithState(step, FOLDED, "kept string", "append", timeout)


DEDUPED = "idempotency_key string, message_id long, action string, original_id long, accepted boolean"


def dedup_stream(actions: DataFrame) -> DataFrame:
    """Queue actions (idempotency_key, seq, action, message_id) with dedup while active.

    ``enqueue`` is accepted when no message holds its key, else it returns the
    holder's id; ``release`` (ack, drop or death of the holder) frees the key.
    Unlike time-bounded dedup a key is held for as long as its message lives.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        holder = state.get[0] if state.exists else None
        out = []
        for a in pd.concat(frames).sort_values("seq").itertuples():
            if a.action == "enqueue":
                accepted = holder is None
                holder = int(a.message_id) if accepted else holder
                out.append((key[0], int(a.message_id), a.action, holder, accepted))
            else:
                released = holder is not None and holder == int(a.message_id)
                out.append((key[0], int(a.message_id), a.action, holder if holder is not None else None, released))
                holder = None if released else holder
        if holder is None:
            state.remove() if state.exists else None
        else:
            state.update((holder,))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in DEDUPED.split(", ")]).astype({"original_id": "Int64"})

    return actions.groupBy("idempotency_key").applyInPandasWithState(step, DEDUPED, "holder long", "append", GroupStateTimeout.NoTimeout)
