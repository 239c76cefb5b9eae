"""The event log: slots, acceptance, and entities as aggregations over accepted events.

Two paths decide acceptance. Guards that depend only on the first of something
(first creation, first terminal event, first use of a resume id) are expressions
over aggregates and windows. The general case, where a rejected event must not
influence later ones, goes through the transitions of
``weftline.functions.transitions``: rows are shuffled by run, sorted, and
streamed through Arrow batches. Runs that end in a batch are decided together, as arrays
(``weftline.functions.guards``); for others a task holds one run's state at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from weftline.functions.guards import KINDS, OUTCOMES, decide_all
from weftline.functions.transitions import Limits, decide, new_state
from weftline.sources.shared import path_of

DECIDED = "outcome string, appended array<string>, slot long, retry_at_us long"
#: What a general fold reads; absent columns count as null.
FOLD_COLUMNS = (
    "run_id", "seq", "event_type", "corr", "at_us", "step_name", "has_input", "has_run_input", "retry_after_us", "holder", "claim_cancelled",
    "resume_id", "digest", "by_workflow", "spec_version", "run_spec", "changes", "allow_reserved",
)
#: Columns that guards don't read and entities are made of; those that events have pass through the fold.
PAYLOAD = ("output", "error", "resume_at_us")


def slots(events: DataFrame, order: list[str], run: str = "run_id") -> DataFrame:
    """Events with ``slot``: 1, 2, 3... in commit order within each run."""
    return events.withColumn("slot", F.row_number().over(Window.partitionBy(run).orderBy(*order)).cast("long"))


def skipped_slots(events: DataFrame, seen: Column, run: str = "run_id") -> DataFrame:
    """(run, from_slot, to_slot) of the slots between what a client has and the newest one."""
    newest = events.groupBy(run).agg(F.max("slot").alias("newest"))
    return newest.withColumn("from_slot", seen + 1).withColumn("to_slot", F.col("newest") - 1).where("from_slot <= to_slot").select(run, "from_slot", "to_slot")


def first_accepted(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Events with ``outcome``: the first of a key is appended, later ones are ENTITY_CONFLICT."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return events.withColumn("outcome", F.when(n == 1, "appended").otherwise("ENTITY_CONFLICT"))


def first_terminal(events: DataFrame, run: str = "run_id", order: str = "slot") -> DataFrame:
    """(run, terminal_slot, terminal_type) of each run's first terminal event."""
    ends = events.where(F.col("event_type").isin("run_completed", "run_failed", "run_cancelled"))
    return ends.groupBy(run).agg(F.min(order).alias("terminal_slot"), F.min_by("event_type", order).alias("terminal_type"))


def terminal_guard(events: DataFrame, run: str = "run_id") -> DataFrame:
    """Run events with their outcome, for runs that exist and events of the run family only.

    Before the first terminal event the first start is appended and later ones
    are replays; after it starts are RUN_EXPIRED, ends ENTITY_CONFLICT, and a
    cancel on a cancelled run is appended again.
    """
    joined = events.join(first_terminal(events, run), run, "left")
    starts = F.sum(F.when(F.col("event_type") == "run_started", 1).otherwise(0)).over(Window.partitionBy(run).orderBy("slot"))
    after = F.coalesce(F.col("slot") > F.col("terminal_slot"), F.lit(False))
    kind = F.col("event_type")
    outcome = (
        F.when(after & (kind == "run_started"), "RUN_EXPIRED")
        .when(after & (kind == "run_cancelled") & (F.col("terminal_type") == "run_cancelled"), "appended")
        .when(after, "ENTITY_CONFLICT")
        .when((kind == "run_started") & (starts > 1), "replay")
        .otherwise("appended")
    )
    return joined.withColumn("outcome", outcome).drop("terminal_slot", "terminal_type")


def resume_dedup(events: DataFrame, order: list[str], run: str = "run_id") -> DataFrame:
    """Resumes with their outcome: the first of a resume id is appended, the same hook and digest replays, others conflict.

    Digests are compared only where both sides have one.
    """
    w = Window.partitionBy(run, "resume_id").orderBy(*order)
    first = {c: F.first(c).over(w) for c in ("corr", "digest")}
    differs = (first["corr"] != F.col("corr")) | F.coalesce(first["digest"] != F.col("digest"), F.lit(False))
    n = F.row_number().over(w)
    return events.withColumn("outcome", F.when(n == 1, "appended").when(differs, "ENTITY_CONFLICT").otherwise("replay"))


#: Columns that an event always has; others are absent where a batch has none.
_ALWAYS = frozenset(("run_id", "seq", "event_type", "corr", "at_us"))


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch as dicts of the columns that it has values in: most events say little."""
    names = [n for n, c in zip(batch.schema.names, batch.columns, strict=True) if n in _ALWAYS or c.null_count < len(c)]
    columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
    for values in zip(*columns, strict=True):
        yield dict(zip(names, values, strict=True))


def run_starts(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Where the runs of a batch, sorted by run (the first column), begin; null is a run."""
    ids = batch.column(0)
    a, b = ids.slice(1), ids.slice(0, len(ids) - 1)
    differs = pc.fill_null(pc.not_equal(a, b), True).to_numpy(zero_copy_only=False)
    both = pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.append(True, differs & ~both))


def tasks_of(df: DataFrame, task_bytes: int | None = None) -> int | None:
    """Tasks for a shuffle of rows made from files, where these are more than the session's partitions are meant for."""
    spark, total = df.sparkSession, 0
    for name in df.inputFiles():
        path, fs = path_of(spark, name)
        total += fs.getFileStatus(path).getLen()
    n = -(-total // (task_bytes or TASK_BYTES))
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def by_run(rows: DataFrame) -> DataFrame:
    """Rows dealt by run over ``tasks_of`` them, so that joins and groups by run, or by run and more, have no larger tasks as the input grows."""
    n = tasks_of(rows)
    return rows.repartition(n, "run_id") if n else rows


def dealt(rows: DataFrame, first: Column) -> DataFrame:
    """Rows that stand for several events of a run each, dealt by run and sorted by it and by ``first``, the earliest time of a row's events.

    ``fold`` takes the lists of events that are made from them, or makes the events itself (``Made``), so that the rows are
    shuffled and not what is made from them. Tasks are small, as each row becomes many.
    """
    return in_order(dealt_alone(rows), first)


def dealt_alone(rows: DataFrame) -> DataFrame:
    """Rows dealt as by ``dealt``, for what has to be done by run before ``in_order``."""
    n = tasks_of(rows, DEALT_BYTES)
    return rows.repartition(n, "run_id") if n else rows.repartition("run_id")


def in_order(rows: DataFrame, first: Column) -> DataFrame:
    """Rows that are dealt by run, sorted as by ``dealt``."""
    return rows.withColumn("first", first).sortWithinPartitions(F.xxhash64("run_id"), "run_id", "first")  # ids often begin alike, which hashes don't


@dataclass(frozen=True)
class Made:
    """Events that each row of (run_id, first, ...) stands for: for each event where its fields come from, and the flag without which there is none.

    A field comes from a column, given as (name,) or (name, what is added to it), or is the same for all rows, given by itself.
    ``kinds`` has the fields' types. Rows carry only what differs from row to row, and the events are made of them in the tasks of ``fold``.
    """

    kinds: dict[str, pa.DataType]
    events: Sequence[dict]
    when: Sequence[str | None]

    def of(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The events of a batch, row by row."""
        n = batch.num_rows
        there = np.ones((n, len(self.events)), bool)
        for i, name in enumerate(self.when):
            if name is not None:
                there[:, i] = pc.fill_null(batch.column(name), False).to_numpy(zero_copy_only=False)
        row, event = np.nonzero(there)
        fields = [batch.column("run_id").take(pa.array(row))]
        for name, kind in self.kinds.items():
            said = [e[name] for e in self.events]
            columns = list(dict.fromkeys(v[0] for v in said if isinstance(v, tuple)))
            fixed = [v for v in said if not isinstance(v, tuple)]
            pool = pa.concat_arrays([*(batch.column(c) for c in columns), pa.array(fixed, kind)])
            varies = np.array([isinstance(v, tuple) for v in said])
            begin = np.where(varies, 0, len(columns) * n + np.cumsum(~varies) - 1)
            begin[varies] = [columns.index(v[0]) * n for v in said if isinstance(v, tuple)]
            values = pool.take(pa.array(begin[event] + varies[event] * row))
            more = np.array([v[1] if isinstance(v, tuple) and len(v) > 1 else 0 for v in said])
            fields.append(pc.add(values, pa.array(more[event])) if more.any() else values)
        return pa.RecordBatch.from_arrays(fields, names=["run_id", *self.kinds])


def _listed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The events of (run_id, first, events), row by row; null is no event."""
    run_id, _, lists = batch.columns
    flat = lists.flatten()
    events = pa.RecordBatch.from_arrays([run_id.take(pc.list_parent_indices(lists)), *flat.flatten()], names=["run_id", *(f.name for f in flat.type)])
    return events.filter(flat.is_valid()) if flat.null_count else events


def opened(batches: Iterator[pa.RecordBatch], made: Callable[[pa.RecordBatch], pa.RecordBatch] = _listed) -> Iterator[pa.RecordBatch]:
    """Events of rows (run_id, first, events, or what events are ``made`` of) of ``dealt``, in order of (run_id, at_us, seq), nulls first.

    The last events of a batch wait until no later row can have an earlier one.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        first, events = batch.column(1), made(batch)
        if held is not None:
            events = pa.Table.from_batches([held, events]).combine_chunks()
            events = events.to_batches()[0] if len(events) else held
        if not events.num_rows:
            continue
        starts = run_starts(events)
        keys = [np.repeat(np.arange(len(starts)), np.diff(np.append(starts, events.num_rows)))]
        for name in ("at_us", "seq"):
            c = events.column(events.schema.get_field_index(name))
            keys += [c.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(c, 0).to_numpy(zero_copy_only=False)]
        order = np.lexsort([k for k in keys[::-1] if k is keys[0] or not (k.dtype == bool and k.all())])
        if (np.diff(order) != 1).any():
            events = events.take(pa.array(order))
        since, cut = first[-1].as_py(), int(starts[-1])
        if since is not None:
            cut += int((~keys[1][order[cut:]] | (keys[2][order[cut:]] < since)).sum())
        for at in range(0, cut, LONG_RUN):
            yield events.slice(at, min(LONG_RUN, cut - at))
        held = events.slice(cut)
    if held is not None and held.num_rows:
        yield held


#: Rows of a run up to which it is held until it is whole, and bytes of files that a task's rows, and rows of many events, are made from.
LONG_RUN, TASK_BYTES, DEALT_BYTES = 50_000, 8 << 20, 2 << 20


def fold(
    events: DataFrame, partitions: int | None = None, current_spec: int | None = None, carry: Sequence[str] = (), limits: Limits = Limits(),  # noqa: B008  a constant
    listed: bool | Made = False, only: Sequence[str] = (), steps: bool = False,
) -> DataFrame:
    """Events (FOLD_COLUMNS, PAYLOAD) with outcome, the event types they appended and the last slot of their run.

    ``carry`` names fold columns that come out as well. A start that is TOO_EARLY has the time from which it may come (retry_at_us).
    With ``listed`` they come as lists, (run_id, first, events) made from ``dealt`` rows, in which null is no event, or are made here
    of such rows as ``listed`` says; these aren't shuffled or sorted as rows. All events are decided; with ``only`` those of these
    outcomes come out. With ``steps`` the steps come out that ``step_states`` would make of the log (``folded_steps``).

    Order within a run is (at_us, seq). Rows with a null run are one run of
    their own. A run is one task's work in sequence by nature; runs are bounded
    by the engine's limit on events per run.
    """
    made = listed if isinstance(listed, Made) else None
    if made:
        element = from_arrow_schema(pa.schema(list(made.kinds.items())))
    else:
        element = events.schema["events"].dataType.elementType if listed else events.schema
    have = {*element.names, "run_id"}
    carried = [c for c in ("retry_after_us", *PAYLOAD) if c in have]
    payload = [c for c in PAYLOAD if c in have]
    if listed:
        rows = events.select("run_id", "first", *([c for c in events.columns if c not in ("run_id", "first")] if made else ["events"]))
        types = {"run_id": events.schema["run_id"].dataType, **{f.name: f.dataType for f in element}}
    else:
        # Columns that events don't have aren't shuffled and sorted either.
        used = [c for c in FOLD_COLUMNS if c in have or c in _ALWAYS or c in carry]
        rows = events.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in used), *payload)
        partitions = partitions or tasks_of(events)
        rows = rows.repartition(partitions, "run_id") if partitions else rows.repartition("run_id")
        rows = rows.sortWithinPartitions("run_id", "at_us", "seq")
        types = {f.name: f.dataType for f in rows.schema}
    kept = ["run_id", "seq", "event_type", "corr", "at_us", *carried, *(c for c in carry if c not in carried)]
    schema = ", ".join(f"{c} {types[c].simpleString()}" for c in kept)
    wanted = [i for i, o in enumerate(OUTCOMES) if o in only]

    def given(batch: pa.RecordBatch, arrays: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *arrays], names=[*kept, "outcome", "appended", "slot", "retry_at_us"])

    def together(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch | None:
        found = decide_all(batch, starts, current_spec)
        if found is None:
            return None
        outcome, one, two, slot, retry = found
        if only:
            rows = np.flatnonzero(np.isin(outcome, wanted))
            batch, retry = batch.take(pa.array(rows)), retry.take(pa.array(rows))
            outcome, one, two, slot = (x[rows] for x in (outcome, one, two, slot))
        kinds = np.stack((one, two), 1)
        offsets = np.append(0, np.cumsum((kinds >= 0).sum(1))).astype(np.int32)
        names = pa.array(KINDS).take(pa.array(kinds[kinds >= 0]))
        return given(batch, [pa.array(OUTCOMES).take(pa.array(outcome)), pa.ListArray.from_arrays(pa.array(offsets), names), pa.array(slot, pa.int64()), retry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current = new_state(), object()

        def one_by_one(batch):
            nonlocal state, current
            out = []
            for e in rows_of(batch):
                if e["run_id"] != current:
                    state, current = new_state(), e["run_id"]
                outcome, types = decide(state, e, current_spec, limits)
                out.append((outcome, types, state["n"], state["steps"][e["corr"]][1] if outcome == "TOO_EARLY" else None))
            if only:
                rows = [i for i, o in enumerate(out) if o[0] in only]
                batch, out = batch.take(pa.array(rows, pa.int64())), [out[i] for i in rows]
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            return given(batch, [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64()), strict=True)])

        held = None  # rows of a run that may go on in the next batch
        for batch in opened(batches, made.of if made else _listed) if listed else batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch, held = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0], None
            starts = run_starts(batch)
            if current == batch.column(0)[0].as_py():  # a long run that is already under way goes on
                end = int(starts[1]) if len(starts) > 1 else batch.num_rows
                yield one_by_one(batch.slice(0, end))
                batch = batch.slice(end)
                if not batch.num_rows:
                    continue
                starts = starts[1:] - end
            last = int(starts[-1])
            if last:
                whole = batch.slice(0, last)
                done = together(whole, starts[:-1])
                yield one_by_one(whole) if done is None else done
            rest = batch.slice(last)
            if rest.num_rows > LONG_RUN:
                yield one_by_one(rest)
            else:
                held = rest
        if held is not None:
            done = together(held, np.zeros(1, np.int64))
            yield one_by_one(held) if done is None else done

    if steps:
        more = [f"{c} {types[c].simpleString()}" for c in ("output", "error", "retry_after_us") if c in have]
        run_type, step_type, at_type = (types[c].simpleString() for c in ("run_id", "corr", "at_us"))
        schema = ", ".join([f"run_id {run_type}, step_id {step_type}, status string, attempt long, started_us {at_type}, completed_us {at_type}", *more])
        return rows.mapInArrow(lambda batches: _steps_of(run(batches)), schema)
    return rows.mapInArrow(run, f"{schema}, {DECIDED}")


#: Kinds of step events (places in KINDS), those of them whose last one gives a step's payload, and the status that each leaves.
_STARTS, _RETRIES, _COMPLETES, _FAILS = (KINDS.index(f"step_{k}") for k in ("started", "retrying", "completed", "failed"))
_LAST = {"output": (_COMPLETES,), "error": (_RETRIES, _FAILS), "retry_after_us": (_RETRIES, _STARTS)}
_STEP_STATUS = {k: s for k, s in zip(range(KINDS.index("step_created"), _FAILS + 1), ("pending", "running", "pending", "completed", "failed"), strict=True)}


def _steps_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps from the batches of a fold, as ``step_states`` makes them of its log; those of a run that may go on are held.

    Rows are parts of steps: an event is one, and what some events make of a step is another.
    """
    held = []  # of one run, in order, each part larger than the next, so that a long run's parts are merged few times
    for batch in batches:
        part = _step_parts(batch)
        if not part.num_rows:
            continue
        if held and len(run_starts(part)) == 1 and held[0].column(0)[0].as_py() == part.column(0)[0].as_py():
            held.append(_merged(part))
            while len(held) > 1 and held[-1].num_rows >= held[-2].num_rows:
                held[-2:] = [_merged(pa.concat_tables(held[-2:]))]
            continue
        part = _merged(pa.concat_tables([*held, part]))
        last = int(run_starts(part)[-1])
        if last:
            yield _step_rows(part.slice(0, last))
        held = [part.slice(last)]
    if held:
        yield _step_rows(_merged(pa.concat_tables(held)))


def _step_parts(batch: pa.RecordBatch) -> pa.Table:
    """(run_id, corr, kind of the last event, starts, first start, last end, payload with whether there is one) of appended step events, in order."""
    lists = batch.column("appended")
    kind = pc.fill_null(pc.index_in(lists.flatten(), pa.array(KINDS)), -1).to_numpy(zero_copy_only=False)
    row = pc.list_parent_indices(lists).to_numpy()
    wanted = np.isin(kind, list(_STEP_STATUS))
    kind, row = kind[wanted], pa.array(row[wanted])
    at = batch.column("at_us").take(row)
    null = pa.scalar(None, at.type)
    begins, ends = kind == _STARTS, (kind == _COMPLETES) | (kind == _FAILS)
    out = {
        "run_id": batch.column("run_id").take(row), "corr": batch.column("corr").take(row), "kind": pa.array(kind), "attempt": pa.array(begins.astype(np.int64)),
        "started_us": pc.if_else(pa.array(begins), at, null), "completed_us": pc.if_else(pa.array(ends), at, null),
    }
    for name, kinds in _LAST.items():
        if name in batch.schema.names:
            value = batch.column(name).take(row)
            if name == "retry_after_us":
                value = pc.if_else(pa.array(kind == _RETRIES), value, pa.scalar(None, value.type))
            out |= {name: value, f"has_{name}": pa.array(np.isin(kind, kinds))}
    return pa.table(out)


def _merged(part: pa.Table) -> pa.Table:
    """One row for each (run_id, corr) of rows sorted by run; of two rows of one the first is the earlier."""
    part = part.combine_chunks()
    n, column = part.num_rows, lambda c: part.column(c).chunk(0)
    starts = run_starts(part)
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    corr = pc.fill_null(pc.cast(pc.dictionary_encode(column("corr")).indices, pa.int64()), -1).to_numpy(zero_copy_only=False)
    key = run * (int(corr.max()) + 2) + corr + 1
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    place = np.arange(n)

    def last(mask):
        """Places of the last rows of a mask in each group, null where there is none."""
        found = np.maximum.reduceat(np.where(mask, place, -1), begin)
        return pa.array(order[found], mask=found < 0)

    def least(c, sign):
        value, empty = column(c), np.iinfo(np.int64).max
        there = pc.is_valid(value).to_numpy(zero_copy_only=False)[order]
        number = pc.fill_null(pc.cast(value, pa.int64()), 0).to_numpy(zero_copy_only=False)[order]
        found, some = np.minimum.reduceat(np.where(there, sign * number, empty), begin), np.logical_or.reduceat(there, begin)
        return pa.array(np.where(some, sign * found, 0), value.type, mask=~some)

    newest = last(np.ones(n, bool))
    out = {c: column(c).take(newest) for c in ("run_id", "corr", "kind")}
    out["attempt"] = pa.array(np.add.reduceat(column("attempt").to_numpy()[order], begin))
    out |= {"started_us": least("started_us", 1), "completed_us": least("completed_us", -1)}
    for name in _LAST:
        if name in part.column_names:
            found = last(column(f"has_{name}").to_numpy(zero_copy_only=False)[order])
            out |= {name: column(name).take(found), f"has_{name}": found.is_valid()}
    return pa.table(out)


def _step_rows(part: pa.Table) -> pa.RecordBatch:
    kind = part.column("kind").to_numpy()
    status = pa.array(list(_STEP_STATUS.values())).take(pa.array(kind - min(_STEP_STATUS)))
    names = [c for c in _LAST if c in part.column_names]
    columns = [part.column(c).combine_chunks() for c in ("run_id", "corr", "attempt", "started_us", "completed_us", *names)]
    return pa.RecordBatch.from_arrays([*columns[:2], status, *columns[2:]], names=["run_id", "step_id", "status", "attempt", "started_us", "completed_us", *names])


def folded_steps(events: DataFrame, listed: bool | Made = False) -> DataFrame:
    """``step_states`` of the log that a fold of these events appends, made in the fold's own tasks: all of a step is where its run is."""
    return fold(events, listed=listed, only=["appended"], steps=True)


def appended(folded: DataFrame) -> DataFrame:
    """The log itself: one row for each appended event with its own slot, and what payload the events carry."""
    carried = [c for c in ("retry_after_us", *PAYLOAD) if c in folded.columns]
    rows = folded.where(F.size("appended") > 0)
    exploded = rows.select("*", F.posexplode("appended").alias("__i", "type"))
    slot = F.col("slot") - F.size("appended") + F.col("__i") + 1
    return exploded.select("run_id", slot.cast("long").alias("slot"), F.col("type").alias("event_type"), "corr", "at_us", "seq", *carried)


#: Rows of a run's guard state: what kind of entity (a map of the fold's state, or the run), its id and what is known of it.
GUARD_ROWS = ("run_id", "kind", "id", "a", "b", "n", "m")
#: What ``fold`` has to carry for them.
GUARD_CARRY = ("retry_after_us", "resume_id", "digest", "by_workflow", "spec_version", "run_spec", "changes")


def guard_states(folded: DataFrame) -> DataFrame:
    """The state (GUARD_ROWS) that guards are left with by a fold that carries GUARD_CARRY: where a stream can go on."""
    rows = folded.where(F.size("appended") > 0)
    kind, corr, ends = F.col("event_type"), F.col("corr"), ("run_completed", "run_failed", "run_cancelled")
    order = F.struct("slot")
    made = F.array_contains("appended", "run_created")
    status = F.when(kind == "run_created", "pending").when(kind == "run_started", "running")
    for event in ends:
        status = status.when(kind == event, event.removeprefix("run_"))
    runs = rows.groupBy("run_id").agg(
        F.max_by(status, F.when(status.isNotNull(), F.col("slot"))).alias("a"), F.max("slot").alias("n"),
        F.max(F.when(made, F.coalesce("run_spec", "spec_version"))).cast("long").alias("m"),
    )
    ended = runs.where(F.col("a").isin("completed", "failed", "cancelled")).select("run_id")

    def row(df: DataFrame, what: str, a: str | None = None, b: str | None = None, n: str | None = None) -> DataFrame:
        null = {"a": a, "b": b, "n": n}
        values = [(F.col(c) if c else F.lit(None)).cast("long" if k == "n" else "string").alias(k) for k, c in null.items()]
        return df.select("run_id", F.lit(what).alias("kind"), "id", *values, F.lit(None).cast("long").alias("m"))

    def last(what: str, **carried: Column) -> DataFrame:
        return rows.where(kind.startswith(what)).groupBy("run_id", corr.alias("id")).agg(F.max_by(F.struct(*(c.alias(n) for n, c in carried.items())), order).alias("x")).select("run_id", "id", "x.*")

    state = F.when(kind.isin("step_created", "step_retrying"), "pending").when(kind == "step_started", "running").otherwise(F.expr("substring(event_type, 6)"))
    steps = last("step_", status=state, retry=F.when(kind == "step_retrying", F.col("retry_after_us")))
    hooks = rows.where(F.array_contains("appended", "hook_created") | (kind == "hook_disposed")).groupBy("run_id", corr.alias("id")).agg(F.max(kind == "hook_disposed").alias("gone"))
    waits = last("wait_", open=F.when(kind == "wait_created", 1).otherwise(0))
    resumes = rows.where((kind == "hook_received") & F.col("resume_id").isNotNull()).groupBy("run_id", F.col("resume_id").alias("id")).agg(F.min_by(F.struct(corr.alias("hook"), "digest"), order).alias("x"))
    writes = rows.where((kind == "attr_set") & F.col("by_workflow").cast("boolean") & corr.isNotNull()).select("run_id", corr.alias("id")).distinct()
    values = attributes(rows).select("run_id", F.col("key").alias("id"), "value")
    parts = [
        runs.select("run_id", F.lit("run").alias("kind"), F.lit(None).cast("string").alias("id"), "a", F.lit(None).cast("string").alias("b"), "n", "m"),
        row(steps, "steps", a="status", n="retry"), row(hooks, "marked"), row(hooks.where("gone"), "released"),
        row(hooks.where("not gone").join(ended, "run_id", "left_anti"), "hooks"), row(waits.join(ended, "run_id", "left_anti"), "waits", n="open"),
        row(resumes.select("run_id", "id", "x.*"), "resumes", a="hook", b="digest"), row(writes, "writes"), row(values, "attributes", a="value"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def attributes(folded: DataFrame) -> DataFrame:
    """(run_id, key, value) after all changes of a fold that carries them: the last change of each key, where it isn't a removal."""
    sets = folded.where((F.col("event_type") == "attr_set") & (F.size("appended") > 0) & F.col("changes").isNotNull())
    each = sets.select("run_id", "slot", F.posexplode(F.from_json("changes", "array<array<string>>")).alias("i", "c"))
    return latest_attributes(each.select("run_id", "slot", "i", F.col("c")[0].alias("key"), F.col("c")[1].alias("value")), ["slot", "i"])


def create(events: DataFrame, current_spec: int | None = None) -> DataFrame:
    """Raw events (FOLD_COLUMNS without holder, token) folded with the holders of their claims: token first, then hook id.

    A claim holds its token if it is the token's earliest by (at_us, seq), and its hook id if it is the earliest of
    those that hold their token, whatever its own run says to it; the claims of one run and hook are one
    owner's. Other claims name the holder and become conflicts in the fold. Owners come from aggregations with partial
    results, so a token that a third of all hooks claim is no task of its own.
    """
    claim = (F.col("event_type") == "hook_created") & F.col("token").isNotNull()
    named = events.withColumn("__name", F.concat_ws("/", F.col("run_id").cast("string"), "corr"))
    claims = named.where(claim).select("run_id", "seq", "at_us", "token", "corr", "__name")
    first = claims.groupBy("token").agg(F.min_by("__name", F.struct("at_us", "seq")).alias("__token_holder"))
    won = claims.join(first, "token").where("__name = __token_holder")
    ids = won.groupBy("corr").agg(F.min_by("__name", F.struct("at_us", "seq")).alias("__id_holder"))
    joined = named.where(claim).join(first, "token", "left").join(ids, "corr", "left")
    holder = F.when(F.col("__token_holder") != F.col("__name"), F.col("__token_holder")).otherwise(F.col("__id_holder"))
    held = joined.withColumn("holder", holder).drop("__name", "__token_holder", "__id_holder")
    rest = named.where(~F.coalesce(claim, F.lit(False))).withColumn("holder", F.lit(None).cast("string")).drop("__name")
    return fold(rest.unionByName(held), current_spec=current_spec)


def run_states(log: DataFrame) -> DataFrame:
    """Runs from the log: status, first start, end, and how many events."""
    kind = F.col("event_type")
    status = F.when(kind == "run_created", "pending").when(kind == "run_started", "running")
    for event, name in (("run_completed", "completed"), ("run_failed", "failed"), ("run_cancelled", "cancelled")):
        status = status.when(kind == event, name)
    order = F.when(status.isNotNull(), F.col("slot"))
    return log.groupBy("run_id").agg(
        F.max_by(status, order).alias("status"),
        F.min(F.when(kind == "run_created", F.col("at_us"))).alias("created_us"),
        F.min(F.when(kind == "run_started", F.col("at_us"))).alias("started_us"),
        F.max(F.when(kind.isin("run_completed", "run_failed", "run_cancelled"), F.col("at_us"))).alias("completed_us"),
        F.count(F.lit(1)).alias("n_events"),
    )


def step_states(log: DataFrame) -> DataFrame:
    """Steps from the log: status, attempts, first start and end; output, error and retry time where the log has them.

    A start counts as an attempt and clears the retry time; a retry keeps the
    attempts and sets error and retry time; a completion sets the output and
    leaves an earlier error as it is.
    """
    has = set(log.columns)
    steps = log.where(F.col("event_type").startswith("step_"))
    kind = F.col("event_type")
    status = F.when(kind.isin("step_created", "step_retrying"), "pending").when(kind == "step_started", "running").when(kind == "step_completed", "completed").otherwise("failed")
    more = []
    if "output" in has:
        more.append(F.max_by("output", F.when(kind == "step_completed", F.col("slot"))).alias("output"))
    if "error" in has:
        more.append(F.max_by("error", F.when(kind.isin("step_retrying", "step_failed"), F.col("slot"))).alias("error"))
    if "retry_after_us" in has:
        waits = F.when(kind == "step_retrying", F.col("retry_after_us"))
        more.append(F.max_by(waits, F.when(kind.isin("step_retrying", "step_started"), F.col("slot"))).alias("retry_after_us"))
    return steps.groupBy("run_id", F.col("corr").alias("step_id")).agg(
        F.max_by(status, "slot").alias("status"),
        F.count(F.when(kind == "step_started", 1)).alias("attempt"),
        F.min(F.when(kind == "step_started", F.col("at_us"))).alias("started_us"),
        F.max(F.when(kind.isin("step_completed", "step_failed"), F.col("at_us"))).alias("completed_us"),
        *more,
    )


def wait_states(log: DataFrame) -> DataFrame:
    """Waits from the log: open or completed, and when."""
    waits = log.where(F.col("event_type").isin("wait_created", "wait_completed"))
    done = F.col("event_type") == "wait_completed"
    return waits.groupBy("run_id", F.col("corr").alias("wait_id")).agg(
        F.when(F.max(done), "completed").otherwise("open").alias("status"), F.max(F.when(done, F.col("at_us"))).alias("completed_us")
    )


def live_hooks(log: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, hook_id) of hooks created and not disposed, of runs that have not ended."""
    state = log.where(F.col("event_type").isin("hook_created", "hook_disposed")).groupBy("run_id", F.col("corr").alias("hook_id"))
    open_ = state.agg(F.max_by("event_type", "slot").alias("last")).where("last = 'hook_created'").drop("last")
    return open_.join(runs.where("status in ('pending', 'running')").select("run_id"), "run_id", "left_semi")


def open_hooks(log: DataFrame) -> DataFrame:
    """(run_id, hook_id, created_us) of the same hooks as ``live_hooks`` with the log's own runs, from one pass over the log."""
    kind, ends = F.col("event_type"), ("run_completed", "run_failed", "run_cancelled")
    rows = log.where(kind.isin("hook_created", "hook_disposed", *ends)).withColumn("ends", kind.isin(*ends))
    state = rows.groupBy("run_id", "ends", F.when(~F.col("ends"), F.col("corr")).alias("hook_id")).agg(
        F.max_by("event_type", "slot").alias("last"), F.min(F.when(kind == "hook_created", F.col("at_us"))).alias("created_us")
    )
    ended = F.max("ends").over(Window.partitionBy("run_id"))
    return state.withColumn("ended", ended).where("not ended and last = 'hook_created'").select("run_id", "hook_id", "created_us")


def latest_attributes(changes: DataFrame, order: list[str], run: str = "run_id") -> DataFrame:
    """(run, key, value) after all changes; a null value deletes its key."""
    last = changes.groupBy(run, "key").agg(F.max_by(F.struct("value"), F.struct(*order)).alias("v"))
    return last.select(run, "key", F.col("v.value").alias("value")).where("value is not null")
