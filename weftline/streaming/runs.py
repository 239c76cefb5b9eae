"""The event fold over Structured Streaming with typed state by entity, and creation with admission as chained operators.

A run's guard state is a value (status, version, slots) and a map for each kind
of entity. A micro-batch reads the entities that its events name and writes
those that they change, so state traffic grows with the events, not with the
run. A stream can start from the state that a batch log leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.functions.transitions import ENDS, Limits, decide
from weftline.operators.eventlog import FOLD_COLUMNS, GUARD_ROWS
from weftline.streaming.cells import plain

FOLDED = {"seq": "long", "event_type": "string", "corr": "string", "at_us": "long", "outcome": "string", "n_appended": "int", "slot": "long"}
#: Kinds of the columns that a fold reads; the others are strings.
_KINDS = {"seq": "long", "at_us": "long", "retry_after_us": "long", "spec_version": "int", "run_spec": "int", **dict.fromkeys(("has_input", "has_run_input", "claim_cancelled", "by_workflow", "allow_reserved"), "boolean")}
EVENT = {c: _KINDS.get(c, "string") for c in FOLD_COLUMNS}
#: What the state keeps of each entity.
ENTITIES = {
    "steps": "status string, retry_after_us long", "hooks": "live boolean", "marked": "seen boolean", "released": "gone boolean", "waits": "open boolean",
    "resumes": "hook_id string, digest string", "writes": "seen boolean", "attributes": "value string",
}


class Entities:
    """A dict over a map state: entities are read when asked for, and those set or deleted are written by ``flush``."""

    def __init__(self, state, width: int):
        self.state, self.width, self.known, self.dirty = state, width, {}, set()

    def get(self, key: str):
        if key not in self.known:
            found = self.state.getValue((key,)) if self.state.containsKey((key,)) else None
            self.known[key] = None if found is None else list(found) if self.width > 1 else found[0]
        return self.known[key]

    def __contains__(self, key: str) -> bool:
        return self.get(key) is not None

    __getitem__ = get

    def __setitem__(self, key: str, value) -> None:
        self.known[key] = value
        self.dirty.add(key)

    def __delitem__(self, key: str) -> None:
        self[key] = None

    def flush(self) -> None:
        for key in self.dirty:
            value = self.known[key]
            if value is not None:
                self.state.updateValue((key,), tuple(value) if self.width > 1 else (value,))
            elif self.state.containsKey((key,)):
                self.state.removeKey((key,))


class RunProcessor(StatefulProcessor):
    """The fold of one run's events. ``ordered`` events wait for the watermark and are folded in the order of (at_us, seq)."""

    def __init__(self, current_spec: int | None, keep_ended: bool, resume_ttl_ms: int | None, ordered: bool, limits: Limits = Limits()):  # noqa: B008
        self.limits = limits
        self.current_spec, self.keep_ended, self.resume_ttl_ms, self.ordered = current_spec, keep_ended, resume_ttl_ms, ordered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "status string, spec int, slots long, last_ms long, n_attributes int")
        self.maps = {}
        for name, schema in ENTITIES.items():
            ttl = self.resume_ttl_ms if name == "resumes" else None
            self.maps[name] = handle.getMapState(name, "id string", schema, ttl)
        if self.ordered:
            self.waiting = handle.getMapState("waiting", "at_us long, seq long", ", ".join(f"{c} {t}" for c, t in EVENT.items()))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        *run, n_attributes = self.run.get() if self.run.exists() else (None, None, 0, 0, 0)
        frames = [initialState] if isinstance(initialState, pd.DataFrame) else initialState
        for frame in frames:
            for kind, entity, a, b, n, m in frame[["kind", "id", "a", "b", "n", "m"]].itertuples(index=False, name=None):
                a, b, n, m = plain(a, "string"), plain(b, "string"), plain(n, "long"), plain(m, "long")
                if kind == "run":
                    run = (a, m, n, 0)
                else:
                    n_attributes += kind == "attributes"
                    value = {"steps": (a, n), "resumes": (a, b), "waits": (n == 1,), "attributes": (a,)}.get(kind, (True,))
                    self.maps[kind].updateValue((entity,), value)
        self.run.update((*run, n_attributes))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = []
        for frame in rows:
            for values in frame[list(EVENT)].itertuples(index=False, name=None):
                events.append({c: plain(v, t) for (c, t), v in zip(EVENT.items(), values, strict=True)})
        if self.ordered:
            for e in events:
                self.waiting.updateValue((e["at_us"], e["seq"]), tuple(e.values()))
            for at in {e["at_us"] // 1000 + 1 for e in events}:
                self.handle.registerTimer(at)
            return iter(())
        return iter([self.fold(key[0], events, timerValues)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs()
        if self.ordered:
            ready = [dict(zip(EVENT, v, strict=True)) for k, v in self.waiting.iterator() if k[0] // 1000 < until]
            if ready:
                for e in ready:
                    self.waiting.removeKey((e["at_us"], e["seq"]))
                yield self.fold(key[0], ready, timerValues)
        if self.keep_ended and self.run.exists():
            status, _, _, last, _ = self.run.get()
            if status in ENDS.values() and last < until:
                self.run.clear()
                for state in self.maps.values():
                    state.clear()

    def fold(self, run_id: str, events: list[dict], timerValues) -> pd.DataFrame:
        status, spec, n, last, n_attributes = self.run.get() if self.run.exists() else (None, None, 0, 0, 0)
        kept = {name: Entities(state, 1 + ENTITIES[name].count(",")) for name, state in self.maps.items()}
        state = {"run": status, "spec": spec, "n": n, "n_attributes": n_attributes, **kept}
        out = []
        for e in sorted(events, key=lambda e: (e["at_us"], e["seq"])):
            outcome, types = decide(state, e, self.current_spec, self.limits)
            out.append((run_id, e["seq"], e["event_type"], e["corr"], e["at_us"], outcome, len(types), state["n"]))
            last = max(last, e["at_us"] // 1000)
            for name in ("hooks", "waits"):
                if state[name] is not kept[name]:  # the run has ended, and they with it
                    self.maps[name].clear()
                    state[name] = kept[name] = Entities(self.maps[name], 1)
        for entities in kept.values():
            entities.flush()
        if self.keep_ended and state["run"] in ENDS.values():
            last = max(last, timerValues.getCurrentWatermarkInMs())
            self.handle.registerTimer(last + 1)
        self.run.update((state["run"], state["spec"], state["n"], last, state["n_attributes"]))
        frame = pd.DataFrame(out, columns=["run_id", *FOLDED])
        return frame.astype({"seq": "Int64", "at_us": "Int64", "slot": "Int64", "n_appended": "Int32"})

    def close(self) -> None:
        pass


def _events(events: DataFrame) -> DataFrame:
    have = set(events.columns)
    return events.selectExpr(*(f"cast({c if c in have else 'null'} as {t}) as {c}" for c, t in EVENT.items()))


def fold_runs(
    events: DataFrame, current_spec: int | None = None, keep_ended_ms: int | None = None, resume_ttl_ms: int | None = None, initial: DataFrame | None = None,
    limits: Limits = Limits(),  # noqa: B008  a constant
) -> DataFrame:
    """Streaming events (FOLD_COLUMNS) with outcome and slot, as ``eventlog.fold`` gives them. Needs the RocksDB state store.

    A micro-batch's events of a run are put in order; those of a later one are
    later. ``initial`` is the state to start from, as ``eventlog.guard_states`` leaves it. With
    ``keep_ended_ms`` an ended run's state goes when the newest event of the stream is that much
    later than its last; with ``resume_ttl_ms`` a resume id is forgotten that long (by
    the clock) after its use. One of the two can be had.
    """
    if keep_ended_ms is not None and resume_ttl_ms is not None:
        raise ValueError("ended runs go by event time, resume ids by the clock: a stream has one of them")
    rows = _events(events)
    mode = "EventTime" if keep_ended_ms is not None else "ProcessingTime" if resume_ttl_ms is not None else "None"
    if keep_ended_ms is not None:
        rows = rows.withColumn("__at", F.timestamp_micros("at_us")).withWatermark("__at", f"{keep_ended_ms} milliseconds")
    processor = RunProcessor(current_spec, keep_ended_ms is not None, resume_ttl_ms, False, limits)
    schema = "run_id string, " + ", ".join(f"{c} {t}" for c, t in FOLDED.items())
    start = None if initial is None else initial.select(*GUARD_ROWS).groupBy("run_id")
    return rows.groupBy("run_id").transformWithStateInPandas(processor, schema, "Append", mode, start)


# -- creation with admission ----------------------------------------------------------------------


class ClaimProcessor(StatefulProcessor):
    """First writer of one key: claims wait for the watermark, so that the earliest by (at_us, seq) holds the key."""

    def __init__(self, claimed: str, columns: dict[str, str]):
        self.claimed, self.columns = claimed, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.owner = handle.getValueState("owner", "name string")
        self.waiting = handle.getMapState("waiting", "at_us long, seq long", ", ".join(f"{c} {t}" for c, t in self.columns.items()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for values in frame[list(self.columns)].itertuples(index=False, name=None):
                e = {c: plain(v, t) for (c, t), v in zip(self.columns.items(), values, strict=True)}
                self.waiting.updateValue((e["at_us"], e["seq"]), tuple(e.values()))
                self.handle.registerTimer(e["at_us"] // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs()
        ready = sorted(((k, dict(zip(self.columns, v, strict=True))) for k, v in self.waiting.iterator() if k[0] // 1000 < until), key=lambda x: x[0])
        if not ready:
            return
        owner = self.owner.get()[0] if self.owner.exists() else None
        for k, e in ready:
            name = f"{e['run_id']}/{e['corr']}"
            if e["holder"] is None or e["holder"] == name:  # a claim that has lost before names no owner here
                if owner is None:
                    owner = name
                    self.owner.update((owner,))
                e["holder"] = owner
            self.waiting.removeKey(k)
        frame = pd.DataFrame([e for _, e in ready], columns=list(self.columns))
        numbers = {c: {"long": "Int64", "int": "Int32", "boolean": "boolean"}[t] for c, t in self.columns.items() if t != "string"}
        frame = frame.astype(numbers)
        frame["__at"] = pd.to_datetime((until + 1) * 1000, unit="us")  # nothing may be sent on behind the watermark; the order is by at_us
        yield frame

    def close(self) -> None:
        pass


def create_with_admission(events: DataFrame, delay_ms: int, current_spec: int | None = None) -> DataFrame:
    """Streaming raw events (FOLD_COLUMNS without holder, token) with outcome and slot: admission and fold in one job.

    Three stateful operators with the watermark between them: who holds a
    claim's token, who holds its hook id among those that hold their token,
    and the run's fold over the events with the holders found. All work in event-time
    order, so the rows are those of ``eventlog.create`` over the same events; ``delay_ms`` is how late
    an event may come. Needs the RocksDB state store.
    """
    columns = {**EVENT, "token": "string"}
    have = set(events.columns)
    rows = events.selectExpr(*(f"cast({c if c in have and c != 'holder' else 'null'} as {t}) as {c}" for c, t in columns.items()))
    rows = rows.withColumn("__at", F.timestamp_micros("at_us")).withWatermark("__at", f"{delay_ms} milliseconds")
    claim = (F.col("event_type") == "hook_created") & F.col("token").isNotNull()
    schema = ", ".join(f"{c} {t}" for c, t in columns.items()) + ", __at timestamp"

    def admitted(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).transformWithStateInPandas(ClaimProcessor(key, columns), schema, "Append", "EventTime", eventTimeColumnName="__at")

    claims = admitted(admitted(rows.where(claim), "token"), "corr")
    both = rows.where(~F.coalesce(claim, F.lit(False))).unionByName(claims)
    out = "run_id string, " + ", ".join(f"{c} {t}" for c, t in FOLDED.items())
    return both.groupBy("run_id").transformWithStateInPandas(RunProcessor(current_spec, False, None, True), out, "Append", "EventTime")
