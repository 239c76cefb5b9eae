"""The guards of ``transitions`` over many whole runs at once, as arrays; ``decide`` is what they have to equal.

A run's own state changes three times at most (made, running, ended), so it follows from the places of the
first such events. Steps and waits then depend on their own events alone, hooks and resume ids on those of
their run: these go in rounds, the first events of all of them, then the second ones, and so on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from weftline.functions.transitions import CREATES, ENDS, RUN_BLIND

KINDS = (
    "run_created", "run_started", "run_completed", "run_failed", "run_cancelled", "step_created", "step_started", "step_retrying", "step_completed",
    "step_failed", "hook_created", "hook_received", "hook_disposed", "wait_created", "wait_completed", "attr_set", "hook_conflict",
)
OUTCOMES = (
    "appended", "replay", "RUN_NOT_SUPPORTED", "RUN_NOT_FOUND", "RUN_EXPIRED", "ENTITY_CONFLICT", "STEP_NOT_FOUND", "TOO_EARLY", "HOOK_NOT_FOUND",
    "HOOK_CLAIM_CANCELLED", "WAIT_NOT_FOUND", "hook_conflict",
)
_K, _O = ({name: i for i, name in enumerate(names)} for names in (KINDS, OUTCOMES))
_APPENDED, _REPLAY, _UNSUPPORTED, _NO_RUN, _EXPIRED, _CONFLICT, _NO_STEP, _EARLY, _NO_HOOK, _CANCELLED, _NO_WAIT, _HELD = range(len(OUTCOMES))
#: Rows of a round on average below which rounds aren't worth it, and rows above which that is asked.
LEAST, FEW = 24, 256


def _codes(*columns: np.ndarray) -> np.ndarray:
    """Running numbers of the distinct rows of some columns."""
    code = columns[0]
    for c in columns[1:]:
        code = np.unique(code * (int(c.max()) + 2) + c + 1, return_inverse=True)[1]
    return code


def _rounds(key: np.ndarray) -> list[np.ndarray]:
    """Places by their number within their key, in order."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    nth = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
    by = np.argsort(nth, kind="stable")
    return np.split(order[by], np.cumsum(np.bincount(nth))[:-1]) if len(key) else []


def decide_all(batch: pa.RecordBatch, starts: np.ndarray, current_spec: int | None):
    """(outcome, first type or -1, second or -1, slot, retry time or None) of the rows of whole runs, which begin at ``starts``.

    Types and outcomes are places in KINDS and OUTCOMES. None if there is something that only ``decide`` knows (attribute changes,
    other types, rows without a time), or that one run has so many of the rows that it is no faster.
    """
    n, names = batch.num_rows, batch.schema.names

    def column(name):
        return batch.column(names.index(name)) if name in names else pa.nulls(n)

    def dictionary(name):
        c = column(name)
        return np.full(n, -1) if c.null_count == n else pc.fill_null(pc.cast(pc.dictionary_encode(c).indices, pa.int64()), -1).to_numpy(zero_copy_only=False)

    def numbers(name):
        c = column(name)
        there = pc.is_valid(c).to_numpy(zero_copy_only=False)
        return (np.zeros(n, np.int64) if not there.any() else pc.fill_null(pc.cast(c, pa.int64()), 0).to_numpy(zero_copy_only=False)), there

    def flag(name):
        value, there = numbers(name)
        return there & (value != 0)

    kind = pc.fill_null(pc.index_in(column("event_type"), pa.array(KINDS[:-1])), -1).to_numpy(zero_copy_only=False)
    at, timed = numbers("at_us")
    if (kind < 0).any() or not timed.all() or column("changes").null_count < n:
        return None
    place = np.arange(n)
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    corr = dictionary("corr")

    def of(*kinds):
        wanted = np.zeros(len(KINDS), bool)
        wanted[[_K[k] for k in kinds]] = True
        return wanted[kind]

    def first(mask):
        found = np.full(len(starts), n)
        rows = np.flatnonzero(mask)[::-1]
        found[run[rows]] = rows
        return found

    blind, ends, begins = of(*RUN_BLIND), of(*ENDS), of("run_started")
    lazy = of("step_started") & pc.is_valid(column("step_name")).to_numpy(zero_copy_only=False) & flag("has_input")
    # The run: where it was made, with which version, when it began and ended.
    (spec, has_spec), (run_spec, has_run_spec) = numbers("spec_version"), numbers("run_spec")
    own, has_own = np.where(has_run_spec, run_spec, spec), has_run_spec | has_spec
    refused = np.zeros(n, bool) if current_spec is None else has_spec & (spec != current_spec)
    bad_own = np.zeros(n, bool) if current_spec is None else has_own & (own != current_spec)
    with_input = begins & flag("has_run_input")
    made = first(~refused & (of("run_created") | with_input & ~bad_own))
    made_bad = np.append(bad_own, False)[made]
    none = place < made[run]  # no run before this event; the event that makes it is told by place
    makes = place == made[run]
    refused |= ~blind & np.where(none, with_input & bad_own, made_bad[run] & ~makes)
    open_ = ~refused & ~none
    ended = first(open_ & ends)
    started = first(open_ & begins)
    none |= makes
    over = place > ended[run]
    status = np.append(kind, -1)[ended][run]

    out = np.full(n, -1)
    out[refused] = _UNSUPPORTED

    def say(mask, outcome):
        out[mask & (out < 0)] = outcome

    is_run = of("run_created", "run_started", *ENDS)
    say(of("run_created"), np.where(makes, _APPENDED, _REPLAY)[of("run_created") & (out < 0)])
    say(over & begins, _EXPIRED)
    say(over & of("run_cancelled") & (status == _K["run_cancelled"]), _APPENDED)
    say(over & (ends | of(*CREATES, "attr_set") | lazy), _CONFLICT)
    say(none & ~makes & (is_run | of("attr_set")), _NO_RUN)
    say(begins & (place > started[run]), _REPLAY)
    say(is_run, _APPENDED)

    # Attribute writes: the first of a correlation id counts.
    writes = np.flatnonzero((out < 0) & of("attr_set") & flag("by_workflow") & (corr >= 0))
    if len(writes):
        later = np.ones(len(writes), bool)
        later[np.unique(_codes(run[writes], corr[writes]), return_index=True)[1]] = False
        out[writes[later]] = _CONFLICT
    say(of("attr_set"), _APPENDED)

    retry_at, has_retry_at = np.zeros(n, np.int64), np.zeros(n, bool)
    steps = np.flatnonzero((out < 0) & of("step_created", "step_started", "step_retrying", "step_completed", "step_failed"))
    waits = np.flatnonzero((out < 0) & of("wait_created", "wait_completed"))
    hooks = np.flatnonzero((out < 0) & of("hook_created", "hook_received", "hook_disposed"))
    plans = [(rows, key, _rounds(key)) for rows, key in ((s, _codes(run[s], corr[s]) if len(s) else s) for s in (steps, waits))]
    plans.append((hooks, run[hooks], _rounds(run[hooks])))
    if any(len(rows) > FEW and len(rows) < LEAST * len(rounds) for rows, _, rounds in plans):
        return None

    rows, key, rounds = plans[0]
    if len(rows):
        # 0: unknown, 1: pending, 2: running, 3: completed or failed.
        state, retry, has_retry = np.zeros(key.max() + 1, np.int8), np.zeros(key.max() + 1, np.int64), np.zeros(key.max() + 1, bool)
        after, has_after = numbers("retry_after_us")
        creates, starts_, retries = lazy | of("step_created"), of("step_started"), of("step_retrying")
        for r in rounds:
            i, k = rows[r], key[r]
            s, new, begin = state[k], creates[i], starts_[i]
            early = begin & has_retry[k] & (retry[k] > at[i])
            o = np.select(
                [new & (s > 0), new & none[i], new, s == 0, s == 3, ~blind[i] & over[i] & (s != 2), ~blind[i] & none[i], early],
                [_CONFLICT, _NO_RUN, _APPENDED, _NO_STEP, _CONFLICT, _EXPIRED, _NO_RUN, _EARLY], _APPENDED,
            )
            out[i] = o
            retry_at[i[o == _EARLY]], has_retry_at[i[o == _EARLY]] = retry[k[o == _EARLY]], True
            ok = o == _APPENDED
            i, k, new, begin = i[ok], k[ok], new[ok], begin[ok]
            again = retries[i]
            state[k] = np.where(begin, 2, np.where(new | again, 1, 3))
            has_retry[k] = np.where(new | begin, False, np.where(again, has_after[i], has_retry[k]))
            retry[k] = np.where(again, after[i], retry[k])

    rows, key, rounds = plans[1]
    if len(rows):
        state, creates = np.zeros(key.max() + 1, np.int8), of("wait_created")  # 1: open, 2: completed
        for r in rounds:
            i, k = rows[r], key[r]
            s = np.where(over[i], 0, state[k])
            o = np.select([none[i], creates[i] & (s > 0), creates[i], s == 0, s == 2], [_NO_RUN, _CONFLICT, _APPENDED, _NO_WAIT, _CONFLICT], _APPENDED)
            out[i] = o
            ok = o == _APPENDED
            state[k[ok]] = np.where(creates[i[ok]], 1, 2)

    rows, _, rounds = plans[2]
    if len(rows):
        hook, resume, digest = _codes(run[rows], corr[rows]), dictionary("resume_id"), dictionary("digest")
        fenced, holder = flag("claim_cancelled"), column("holder")
        claimed, lost = pc.is_valid(holder).to_numpy(zero_copy_only=False), np.zeros(n, bool)
        held = np.flatnonzero(claimed & of("hook_created"))
        if len(held):
            said = zip(*(column(c).take(pa.array(held)).to_pylist() for c in ("holder", "run_id", "corr")), strict=True)
            lost[held] = [h != f"{r}/{c}" for h, r, c in said]
        resumed = of("hook_received") & (resume >= 0)
        known = _codes(run[rows], np.where(resumed, resume, -1)[rows])
        marked, live, released = (np.zeros(hook.max() + 1, bool) for _ in range(3))
        by, by_digest = np.full(known.max() + 1, -1), np.full(known.max() + 1, -1)
        creates, disposes = of("hook_created"), of("hook_disposed")
        for r in rounds:
            i, k, m = rows[r], hook[r], known[r]
            new, lives = creates[i], live[k] & ~over[i]
            seen = resumed[i] & (by[m] >= 0)
            differs = (by[m] != k) | (by_digest[m] >= 0) & (digest[i] >= 0) & (by_digest[m] != digest[i])
            o = np.select(
                [new & none[i], new & fenced[i], new & lost[i], new & marked[k] & lives & ~claimed[i], new & marked[k], new,
                 seen & differs, seen, ~lives & disposes[i] & released[k], ~lives],
                [_NO_RUN, _CANCELLED, _HELD, _REPLAY, _CONFLICT, _APPENDED, _CONFLICT, _REPLAY, _REPLAY, _NO_HOOK], _APPENDED,
            )
            out[i] = o
            ok = o == _APPENDED
            i, k, m, new = i[ok], k[ok], m[ok], new[ok]
            gone, came = disposes[i], resumed[i]
            marked[k] |= new
            live[k] = np.where(new, True, np.where(gone, False, live[k]))
            released[k] |= gone
            by[m[came]], by_digest[m[came]] = k[came], digest[i[came]]

    conflict, ok = out == _HELD, (out == _APPENDED) | (out == _HELD)
    two = ok & ~conflict & (lazy | begins & makes)
    before = np.where(begins, _K["run_created"], _K["step_created"])
    one = np.where(ok, np.where(conflict, _K["hook_conflict"], np.where(two, before, kind)), -1)
    out[conflict] = _APPENDED
    total = np.cumsum(ok.astype(np.int64) + two)
    slot = total - np.append(0, total)[starts][run]
    return out, one, np.where(two, kind, -1), slot, pa.array(retry_at, pa.int64(), mask=~has_retry_at)
