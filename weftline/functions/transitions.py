"""Which events of one run are accepted: the guards as transitions over a small state.

The state holds only what guards look at. Entities (runs, steps, hooks, waits,
attributes) are not kept here; they are aggregations over the accepted events,
see ``weftline.operators.eventlog``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

#: Event types by what they do to the run.
ENDS = {"run_completed": "completed", "run_failed": "failed", "run_cancelled": "cancelled"}
STEP_ENDS = {"step_completed": "completed", "step_failed": "failed"}
CREATES = frozenset({"step_created", "hook_created", "wait_created"})
#: Event types that never look at the run.
RUN_BLIND = frozenset({"run_created", "step_completed", "step_retrying"})

APPENDED, REPLAY = "appended", "replay"


@dataclass(frozen=True)
class Limits:
    """What attributes may be. The limits of the public API aren't published, so all are parameters."""

    keys: int = 64
    key_bytes: int = 256
    value_bytes: int = 4096
    reserved: str = "$"


def new_state() -> dict:
    """run: status or None; spec: the run's version; steps: id to [status, retry_after]; hooks: live; marked, released: hook
    ids seen and disposed; waits: id to open; resumes: resume id to [hook, digest]; writes: attribute writes by correlation
    id; attributes: value by key, and how many there are; n: last slot. Sets are dicts to true, so that the state is plain JSON."""
    return {"run": None, "spec": None, "steps": {}, "hooks": {}, "marked": {}, "released": {}, "waits": {}, "resumes": {}, "writes": {}, "attributes": {}, "n_attributes": 0, "n": 0}


def _lazy(e: dict) -> bool:
    return e["event_type"] == "step_started" and e.get("step_name") is not None and e.get("has_input")


def _terminal(status: str | None) -> bool:
    return status in ENDS.values()


def _run_verdict(state: dict, e: dict) -> str | None:
    """What a terminal run says to an event before anything else is looked at."""
    kind, run = e["event_type"], state["run"]
    if not _terminal(run) or kind in RUN_BLIND:
        return None
    if kind == "run_started":
        return "RUN_EXPIRED"
    if kind in ENDS:
        return APPENDED if kind == "run_cancelled" and run == "cancelled" else "ENTITY_CONFLICT"
    return "ENTITY_CONFLICT" if kind in CREATES or kind == "attr_set" or _lazy(e) else None


def _step(state: dict, e: dict) -> str:
    kind, steps, corr = e["event_type"], state["steps"], e["corr"]
    known = steps.get(corr)
    if kind == "step_created" or _lazy(e):
        if known:
            return "ENTITY_CONFLICT"
        if state["run"] is None:
            return "RUN_NOT_FOUND"
        steps[corr] = ["pending", None] if kind == "step_created" else ["running", None]
        return APPENDED
    if known is None:
        return "STEP_NOT_FOUND"
    if known[0] in STEP_ENDS.values():
        return "ENTITY_CONFLICT"
    if kind not in RUN_BLIND:
        if _terminal(state["run"]) and known[0] != "running":
            return "RUN_EXPIRED"
        if state["run"] is None:
            return "RUN_NOT_FOUND"
    if kind == "step_started":
        if known[1] is not None and known[1] > e["at_us"]:
            return "TOO_EARLY"
        steps[corr] = ["running", None]
    else:
        steps[corr] = ["pending", e.get("retry_after_us")] if kind == "step_retrying" else [STEP_ENDS[kind], known[1]]
    return APPENDED


def _hook(state: dict, e: dict) -> str:
    kind, corr = e["event_type"], e["corr"]
    if kind == "hook_created":
        if state["run"] is None:
            return "RUN_NOT_FOUND"
        if e.get("claim_cancelled"):
            return "HOOK_CLAIM_CANCELLED"
        holder = e.get("holder")  # run and hook that own the token, resolved before the fold
        if holder is not None and holder != f"{e['run_id']}/{corr}":
            return "hook_conflict"
        if corr in state["marked"]:
            return REPLAY if corr in state["hooks"] and holder is None else "ENTITY_CONFLICT"
        state["marked"][corr] = state["hooks"][corr] = True
        return APPENDED
    resume = e.get("resume_id")
    if kind == "hook_received" and resume is not None and resume in state["resumes"]:
        hook, digest = state["resumes"][resume]
        differs = hook != corr or (digest is not None and e.get("digest") is not None and digest != e["digest"])
        return "ENTITY_CONFLICT" if differs else REPLAY
    if corr not in state["hooks"]:
        return REPLAY if kind == "hook_disposed" and corr in state["released"] else "HOOK_NOT_FOUND"
    if state["run"] is None:
        return "RUN_NOT_FOUND"
    if kind == "hook_disposed":
        del state["hooks"][corr]
        state["released"][corr] = True
    elif resume is not None:
        state["resumes"][resume] = [corr, e.get("digest")]
    return APPENDED


def _wait(state: dict, e: dict) -> str:
    waits, corr = state["waits"], e["corr"]
    if state["run"] is None:
        return "RUN_NOT_FOUND"
    if e["event_type"] == "wait_created":
        if corr in waits:
            return "ENTITY_CONFLICT"
        waits[corr] = True
        return APPENDED
    if corr not in waits:
        return "WAIT_NOT_FOUND"
    if not waits[corr]:
        return "ENTITY_CONFLICT"
    waits[corr] = False
    return APPENDED


def _spec(e: dict) -> int | None:
    """Version that a run is stored with: the one its creation states for it, else the event's own."""
    return e["run_spec"] if e.get("run_spec") is not None else e.get("spec_version")


def attribute_changes(state: dict, e: dict, limits: Limits) -> list | None:
    """Changes [key, value or None] of an event, a JSON list; None if one of them isn't allowed or too many keys would be there."""
    changes, there = json.loads(e["changes"]), {}
    for key, value in changes:
        wrong = not key or len(key.encode()) > limits.key_bytes or (value is not None and len(value.encode()) > limits.value_bytes)
        if wrong or (key.startswith(limits.reserved) and not e.get("allow_reserved")):
            return None
        there[key] = value is not None
    more = sum(now - (key in state["attributes"]) for key, now in there.items())
    return None if more > 0 and state["n_attributes"] + more > limits.keys else changes


def _set_attributes(state: dict, changes: list) -> None:
    for key, value in changes:
        known = key in state["attributes"]
        if value is not None:
            state["attributes"][key] = value
        elif known:
            del state["attributes"][key]
        state["n_attributes"] += (value is not None) - known


def _run(state: dict, e: dict, limits: Limits) -> str:
    kind = e["event_type"]
    if kind == "run_created":
        if state["run"] is not None:
            return REPLAY
        state["run"], state["spec"] = "pending", _spec(e)
        return APPENDED
    if state["run"] is None:
        if not (kind == "run_started" and e.get("has_run_input")):
            return "RUN_NOT_FOUND"
        state["run"], state["spec"] = "pending", _spec(e)
    if kind == "run_started":
        if state["run"] == "running":
            return REPLAY
        state["run"] = "running"
    elif kind == "attr_set":
        changes = attribute_changes(state, e, limits) if e.get("changes") is not None else []
        if changes is None:
            return "INVALID_ATTRIBUTES"
        if e.get("corr") is not None and e.get("by_workflow"):
            if e["corr"] in state["writes"]:
                return "ENTITY_CONFLICT"
            state["writes"][e["corr"]] = True
        _set_attributes(state, changes)
    elif kind in ENDS:
        state["run"] = ENDS[kind]
        state["hooks"], state["waits"] = {}, {}  # hooks and waits of an ended run are gone
    return APPENDED


_FAMILIES = {"step": _step, "hook": _hook, "wait": _wait}


def decide(state: dict, e: dict, current_spec: int | None = None, limits: Limits = Limits()) -> tuple[str, list[str]]:  # noqa: B008  a constant
    """Outcome of one event and the types it appends; advances the state.

    The outcome is "appended", "replay" (success without an event) or a reject
    code; rejected events append nothing and leave the state as it was. A start
    may append the creation it carries as well. With ``current_spec`` an event of
    another version is not supported, and neither is a run stored with another,
    for all event types that look at the run.
    """
    if current_spec is not None and e.get("spec_version") is not None and e["spec_version"] != current_spec:
        return "RUN_NOT_SUPPORTED", []
    kind = e["event_type"]
    bootstrap = kind == "run_started" and state["run"] is None and bool(e.get("has_run_input"))
    stored = _spec(e) if bootstrap else state["spec"]
    if current_spec is not None and kind not in RUN_BLIND and stored is not None and stored != current_spec:
        return "RUN_NOT_SUPPORTED", []
    verdict = _run_verdict(state, e)
    if verdict is None:
        family = kind.split("_", 1)[0]
        verdict = _run(state, e, limits) if family not in _FAMILIES else _FAMILIES[family](state, e)
    if verdict == "hook_conflict":
        state["n"] += 1
        return APPENDED, ["hook_conflict"]
    if verdict != APPENDED:
        return verdict, []
    types = (["run_created"] if bootstrap else ["step_created"] if _lazy(e) else []) + [kind]
    state["n"] += len(types)
    return APPENDED, types
