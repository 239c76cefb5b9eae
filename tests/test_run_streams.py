import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions.transitions import Limits
from weftline.operators import eventlog
from weftline.streaming.runs import EVENT, create_with_admission, fold_runs

COLUMNS = {**EVENT, "token": "string"}
SCHEMA = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
OUT = ("run_id", "seq", "event_type", "corr", "at_us", "outcome", "n_appended", "slot")
LIMITS = Limits(keys=3)


def some_events(seed, n=400, runs=5):
    """Events of all types over few ids, so that every guard is met; a run ends now and then."""
    rng, rows = random.Random(seed), []
    kinds = ["step_created", "step_started", "step_started", "step_completed", "step_failed", "step_retrying", "hook_created", "hook_received", "hook_disposed",
             "wait_created", "wait_completed", "attr_set", "attr_set", "run_started", "run_created"]
    for seq in range(n):
        kind = "run_completed" if rng.random() < 0.01 else "run_cancelled" if rng.random() < 0.01 else rng.choice(kinds)
        e = dict.fromkeys(COLUMNS)
        e |= {"run_id": f"r{rng.randrange(runs)}", "seq": seq, "event_type": kind, "corr": f"c{rng.randrange(6)}", "at_us": 10_000 * (seq + 1), "has_run_input": True}
        if kind == "step_started" and rng.random() < 0.3:
            e |= {"step_name": "n", "has_input": True}
        if kind == "step_retrying":
            e["retry_after_us"] = e["at_us"] + rng.choice([0, 200_000])
        if kind == "hook_received":
            e |= {"resume_id": f"q{rng.randrange(5)}", "digest": rng.choice([None, "d1", "d2"])}
        if kind == "hook_created":
            e["token"] = rng.choice([None, "t1", "t2", f"own{seq}"])
        if kind == "attr_set":
            e |= {"by_workflow": rng.random() < 0.5, "changes": json.dumps([[rng.choice("abcd$"), rng.choice([None, "x", "y"])]])}
        rows.append(tuple(e.values()))
    return rows


def decided(df):
    rows = df.withColumn("n_appended", F.size("appended")) if "appended" in df.columns else df
    return sorted((tuple(r[c] for c in OUT) for r in rows.collect()), key=repr)


def streamed(spark, where, batches, make):
    """Rows of a stream that is started anew for each batch, and its progress."""
    progress = []
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{where}/in/{n}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{where}/in")
        query = make(stream).writeStream.format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/check").trigger(availableNow=True).start()
        assert query.awaitTermination(240)
        progress.append(query.recentProgress)
    return decided(spark.read.parquet(f"{where}/out")), progress


def test_stream_equals_batch_over_restarts(spark, keyed_state, tmp_path):
    rows = some_events(1)
    want = decided(eventlog.fold(spark.createDataFrame(rows, SCHEMA), limits=LIMITS))
    assert len({r[5] for r in want}) >= 8
    got, progress = streamed(spark, tmp_path, [rows[:200], rows[200:380], rows[380:]], lambda s: fold_runs(s, limits=LIMITS))
    assert got == want
    written = [sum(o["numRowsUpdated"] for p in run for o in p["stateOperators"]) for run in progress]
    held = eventlog.guard_states(eventlog.fold(spark.createDataFrame(rows, SCHEMA), carry=eventlog.GUARD_CARRY, limits=LIMITS)).count()
    assert 0 < written[2] < held / 2  # by the batch's events, not by what runs hold


def test_stream_goes_on_from_a_batch_log(spark, keyed_state, tmp_path):
    rows = some_events(2)
    events = spark.createDataFrame(rows, SCHEMA)
    want = [r for r in decided(eventlog.fold(events, limits=LIMITS)) if r[1] >= 250]
    before = eventlog.fold(events.where("seq < 250"), carry=eventlog.GUARD_CARRY, limits=LIMITS)
    initial = eventlog.guard_states(before).cache()
    assert {r[0] for r in initial.select("kind").distinct().collect()} >= {"run", "steps", "hooks", "marked", "waits", "resumes", "writes", "attributes"}
    got, _ = streamed(spark, tmp_path, [rows[250:330], rows[330:]], lambda s: fold_runs(s, initial=initial, limits=LIMITS))
    assert got == want


def test_state_of_ended_runs_goes(spark, keyed_state, tmp_path):
    def event(seq, run, kind, at):
        return tuple({**dict.fromkeys(COLUMNS), "run_id": run, "seq": seq, "event_type": kind, "at_us": 10**9 + at, "has_run_input": True, "corr": "c"}.values())

    first = [event(0, "a", "run_started", 0), event(1, "a", "run_completed", 1), event(2, "b", "run_started", 0)]
    later = [event(3, "x", "run_started", 60_000_000)]
    last = [event(4, "a", "run_started", 60_000_001), event(5, "b", "run_started", 60_000_001)]
    got, _ = streamed(spark, tmp_path, [first, later, last], lambda s: fold_runs(s, keep_ended_ms=10_000))
    assert {(r[1], r[5]) for r in got} == {(0, "appended"), (1, "appended"), (2, "appended"), (3, "appended"), (4, "appended"), (5, "replay")}


def test_admission_and_fold_in_one_job_equal_batch(spark, keyed_state, tmp_path):
    rows = some_events(3, n=240)
    want = decided(eventlog.create(spark.createDataFrame(rows, SCHEMA)))
    assert any(r[2] == "hook_created" and r[5] == "ENTITY_CONFLICT" for r in want)
    shuffled = sorted(rows, key=lambda r: r[1] + random.Random(r[1]).randrange(20))  # late by up to 0.2 s
    end = tuple({**dict.fromkeys(COLUMNS), "run_id": "end", "seq": 10**6, "event_type": "run_started", "at_us": 10**9, "corr": "c"}.values())
    claim = tuple({**dict.fromkeys(COLUMNS), "run_id": "end", "seq": 10**6 + 1, "event_type": "hook_created", "at_us": 10**9, "corr": "end", "token": "end"}.values())
    further = [tuple({**dict.fromkeys(COLUMNS), "run_id": "end", "seq": 2 * 10**6, "event_type": "run_started", "at_us": 2 * 10**9, "corr": "c"}.values())]
    got, _ = streamed(spark, tmp_path, [shuffled[:120], shuffled[120:], [end, claim], further], lambda s: create_with_admission(s, 300))
    assert [r for r in got if r[0] != "end"] == want


def test_one_way_of_forgetting(spark):
    with pytest.raises(ValueError):
        fold_runs(spark.createDataFrame([], SCHEMA), keep_ended_ms=1, resume_ttl_ms=1)
