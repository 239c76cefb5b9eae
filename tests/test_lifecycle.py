"""Keys, versions, releases, cleanup phases and the state of streams, on small cases told by hand."""

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from weftline.functions import scalars
from weftline.functions.transitions import decide, new_state
from weftline.operators import eventlog, listing, ownership, queues, retention, streams
from weftline.plans import queries
from weftline.plans.config import Settings, World
from weftline.sources import fixtures
from weftline.streaming import folds


def fnv(units):
    h = 0x811C9DC5
    for u in units:
        h = (h ^ u) * 0x01000193 % 2**32
    return h


def test_hashes_of_any_text(spark):
    texts = ["", "same", "café/東京", "😀", "x" * 3000, None, "a\x00b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    rows = df.select("t", scalars.fnv1a_bytes(F.col("t")).alias("b"), scalars.fnv1a_utf16(F.col("t")).alias("u")).collect()
    for r in rows:
        if r["t"] is None:
            assert r["b"] is None and r["u"] is None
            continue
        wide = r["t"].encode("utf-16-le")
        assert r["b"] == fnv(r["t"].encode()) and r["u"] == fnv(int.from_bytes(wide[i : i + 2], "little") for i in range(0, len(wide), 2))
    by_text = {r["t"]: r["b"] for r in rows}
    assert by_text["same"] == 0xCD0C4A3B and by_text["café/東京"] == 0xB1A7FDC8


def test_key_components_are_encoded(spark):
    texts = ["plain", "a b+c", "é/東?&=:", "-_.!~*'()", "%20", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.uri_component(F.col("t")).alias("k")).collect()
    assert all(r["k"] == quote(r["t"], safe="-_.!~*'()") for r in rows)


def event(kind, **more):
    return {"run_id": "r", "event_type": kind, "corr": "s", "at_us": 0, **more}


def test_the_runs_own_version_is_asked_for_by_events_that_look_at_the_run():
    state = new_state()
    assert decide(state, event("run_created", run_spec=5), 6)[0] == "appended" and state["spec"] == 5
    assert [decide(state, event(k), 6)[0] for k in ("run_started", "step_created", "attr_set", "step_failed", "hook_received")] == ["RUN_NOT_SUPPORTED"] * 5
    assert [decide(state, event(k), 6)[0] for k in ("run_created", "step_completed", "step_retrying")] == ["replay", "STEP_NOT_FOUND", "STEP_NOT_FOUND"]
    assert decide(state, event("run_started"))[0] == "appended"  # no version asked for
    fresh = new_state()
    assert decide(fresh, event("run_started", has_run_input=True, run_spec=5), 6) == ("RUN_NOT_SUPPORTED", []) and fresh == new_state()
    assert decide(fresh, event("run_started", has_run_input=True, spec_version=6), 6)[1] == ["run_created", "run_started"] and fresh["spec"] == 6


def test_every_reject_code_has_an_error(spark):
    error, status = scalars.error_of(F.col("c"))
    rows = spark.createDataFrame([(c,) for c in [*scalars.ERRORS, "appended", None]], "c string").select("c", error.alias("e"), status.alias("s")).collect()
    assert {r["c"]: (r["e"], r["s"]) for r in rows} == {**scalars.ERRORS, "appended": (None, None), None: (None, None)}


def test_a_key_is_held_until_its_holder_is_released(spark):
    rows = [("k", 1, 0, 10), ("k", 2, 5, 100), ("k", 3, 10, None), ("k", 4, 11, 12), ("k", 5, 99, None), ("j", 6, 3, 3), ("j", 7, 3, 9), (None, 8, 1, None), (None, 9, 2, 3)]
    df = spark.createDataFrame(rows, "idempotency_key string, message_id long, enqueued_us long, released_us long")
    got = {r["message_id"]: (r["original_id"], r["accepted"]) for r in queues.dedup_while_active(df).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (3, False), 5: (3, False), 6: (6, True), 7: (7, True), 8: (8, True), 9: (8, False)}
    assert queues.dedup_while_active(df.limit(0)).count() == 0


def test_batches_are_cut_over_arrow_batches(spark):
    rows = [("s", i, 5 if i % 7 else 40) for i in range(25_000)] + [("t", 0, 1000)]
    df = spark.createDataFrame(rows, "stream string, idx int, size int").repartition(3)
    got = {(r["stream"], r["idx"]): r["batch"] for r in streams.split_batches(df, 4, 60).collect()}
    batch, n, held = 0, 0, 0
    for _, i, size in rows[:-1]:
        if n and (n >= 4 or held + size > 60):
            batch, n, held = batch + 1, 0, 0
        n, held = n + 1, held + size
        assert got["s", i] == batch
    assert got["t", 0] == 0


def test_writes_after_an_end_are_refused(spark):
    changes = spark.createDataFrame([("a", 5, "closed"), ("a", 3, "errored"), ("b", 4, "open")], "stream string, seq long, state string")
    writes = spark.createDataFrame([("a", 2), ("a", 3), ("a", 4), ("b", 9), ("c", 1)], "stream string, seq long")
    got = {(r["stream"], r["seq"]): r["refused"] for r in streams.refused(writes, changes).collect()}
    assert got == {("a", 2): None, ("a", 3): None, ("a", 4): "errored", ("b", 9): None, ("c", 1): None}


def test_purge_lease_acknowledgement_and_compaction(spark):
    dead = spark.createDataFrame([(i % 2, i, i) for i in range(9)], "shard int, message_id long, failed long")
    got = {(r["message_id"], r["has_more"]) for r in queues.purge_dead(dead, "shard", ["failed"], 4).collect()}
    assert got == {(0, True), (2, True), (4, True), (6, True), (1, False), (3, False), (5, False), (7, False)}
    leases = spark.createDataFrame([(1, "1/2"), (2, "2/0")], "message_id long, lease string")
    answers = spark.createDataFrame([(1, "1/1"), (1, "1/2"), (2, "2/0"), (3, "3/0")], "message_id long, lease string")
    assert sorted((r["lease"], r["counts"]) for r in queues.settle(answers, leases).collect()) == [("1/1", False), ("1/2", True), ("2/0", True), ("3/0", False)]
    markers = spark.createDataFrame([("a", 3), ("b", 4)], "run string, n_deleted long")
    receipts = spark.createDataFrame([("a", 3), ("b", 5), ("c", 1)], "run string, n_deleted long")
    told = {r["run"]: (r["acknowledged"], r["compact_us"]) for r in queues.acknowledge(receipts, markers, 100, 10, "run").collect()}
    assert told == {"a": (True, 110), "b": (False, None), "c": (True, None)}
    deadlines = spark.createDataFrame([("a", 110), ("b", 90), ("d", 500)], "run string, compact_us long")
    kept = spark.createDataFrame([("a", 110), ("b", 95), ("d", 500)], "run string, compact_us long")
    assert [r["run"] for r in queues.compactable(deadlines, kept, 200, "run").collect()] == ["a"]


def test_cleanup_stops_where_it_fails_and_goes_on_from_there(spark):
    schema = "run_id string, due_us long, phase string, reason string, attempts long, payload_keys_deleted long, streams_deleted long, messages_deleted long"
    records = spark.createDataFrame([("a", 5, "retained", "x", 0, 0, 0, 0), ("b", 5, "retained", "x", 0, 0, 0, 0), ("c", 5, "queues", "x", 2, 0, 1, 0)], schema)
    count = lambda *rows: spark.createDataFrame(list(rows), "run_id string, n long")
    counts = {"streams": count(("a", 2), ("b", 2), ("c", 7)), "queues": count(("b", 3), ("c", 4)), "payload": count(("a", 1), ("a", 1), ("b", 9))}
    failures = spark.createDataFrame([("b", "payload", "late"), ("b", "queues", "late"), ("c", "streams", "long ago")], "run_id string, phase string, error string")
    out = {r["run_id"]: r for r in retention.run_phases(records, counts, failures, 1000).collect()}
    assert [(out[k]["phase"], out[k]["attempts"], out[k]["last_error"]) for k in "abc"] == [("tombstoned", 0, None), ("queues", 1, "late"), ("tombstoned", 2, None)]
    assert [(out[k]["streams_deleted"], out[k]["messages_deleted"], out[k]["payload_keys_deleted"]) for k in "abc"] == [(2, 0, 2), (2, 0, 0), (1, 4, 0)]
    assert out["b"]["due_us"] == 1000 + 1_000_000 and out["a"]["due_us"] == 5
    status = {r["run_id"]: r["phase"] for r in retention.cleanup_status(spark.createDataFrame([("a", "queues")], "run_id string, phase string"), spark.createDataFrame([("a", "x"), ("z", "tombstoned")], "run_id string, phase string"), ["phase"]).collect()}
    assert status == {"a": "queues", "z": "tombstoned"}


def test_claims_releases_and_late_writes(spark):
    claims = spark.createDataFrame([("r", "h", "t"), ("r", "g", "t"), ("x", "h", "u")], "run_id string, hook_id string, token string")
    hooks, tokens = claims.where("hook_id = 'h'").select("run_id", "hook_id"), claims.where("run_id = 'r'").select("run_id", "token")
    gone = spark.createDataFrame([("x",)], "run_id string")
    assert [r["state"] for r in ownership.resolve(claims, hooks, tokens, gone).orderBy("run_id", "hook_id").collect()] == ["cancelled", "committed", "expired"]
    counts = {r["shard"]: (r["n_released"], r["n_left"]) for r in ownership.release_counts(claims, hooks.limit(1), ["run_id", "hook_id"], F.length("run_id")).collect()}
    assert counts == {1: (1, 2), None: (1, 2)}
    assert sorted((r["run_id"], r["rejected"]) for r in listing.late_writes(claims, gone).collect()) == [("r", False), ("r", False), ("x", True)]


def test_a_point_read_and_a_page_reach_the_scan(spark, small, capsys):
    queries.QUERIES["run_get"](spark, small).explain("formatted")
    assert "EqualTo(o_orderkey,7)" in capsys.readouterr().out
    fixtures.runs(spark, small, created_from_us=10**15).explain("formatted")
    assert "GreaterThanOrEqual(o_orderdate" in capsys.readouterr().out
    assert fixtures.runs(spark, small, run="no such run").count() == 0 and fixtures.key_of("wrun_0000000012") == 12


def test_the_facade_gates_versions_names_errors_and_deals_messages(spark):
    world = World(spark, "/nowhere", Settings(spec_version=6, queue_shards=4))
    events = spark.createDataFrame([("r", 0, "run_created", None, 0, 6), ("r", 1, "run_started", None, 1, 5), ("r", 2, "step_failed", "s", 2, 6)], "run_id string, seq long, event_type string, corr string, at_us long, spec_version int")
    log, rejected = world.append_events(events)
    assert [(r["slot"], r["event_type"]) for r in log.collect()] == [(1, "run_created")]
    assert sorted((r["seq"], r["outcome"], r["error_name"], r["error_status"]) for r in rejected.collect()) == [(1, "RUN_NOT_SUPPORTED", "RunNotSupportedError", None), (2, "STEP_NOT_FOUND", "StatusError", 404)]
    messages = spark.createDataFrame([(1, "k", 0, 200, None), (2, None, 0, 500, None)], "message_id long, idempotency_key string, attempt long, status int, timeout_s int")
    got = {r["message_id"]: (r["outcome"], r["shard"]) for r in world.deliver(messages, 0).collect()}
    assert got == {1: ("ack", fnv(b"k") % 4), 2: ("retry", fnv(b"2") % 4)}
    due = spark.createDataFrame([("a", "completed", 0, 5)], "run_id string, status string, created_us long, due_us long")
    assert world.sweep(due, due.limit(0), 10).count() == 0  # no retention, nothing is swept


@pytest.mark.parametrize("keep_ms", [1, 10**11, None])
def test_state_of_ended_runs_goes(spark, tmp_path, keep_ms):
    schema = "run_id string, seq long, event_type string, corr string, at_us long, has_run_input boolean"
    parts = [[("r", 0, "run_started", None, 10**9, True), ("r", 1, "run_completed", None, 10**9, None), ("q", 0, "run_started", None, 10**9, True)], [("other", 0, "run_started", None, 10**13, True)], [("r", 2, "run_failed", None, 2 * 10**13, None), ("q", 1, "run_failed", None, 2 * 10**13, None)]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = folds.fold_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), keep_ms)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
    got = {(r["run_id"], r["seq"]): r["outcome"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["r", 2] == ("RUN_NOT_FOUND" if keep_ms == 1 else "ENTITY_CONFLICT") and got["q", 1] == "appended" and got["other", 0] == "appended"


def test_guards_over_arrays_equal_decide():
    """Whole runs decided together give what each event gives by itself, for all kinds, versions, holders and resumes."""
    import random

    import numpy as np
    import pyarrow as pa

    from weftline.functions import guards
    from weftline.functions.transitions import decide, new_state

    schema = pa.schema([("run_id", pa.string()), ("event_type", pa.string()), ("corr", pa.string()), ("at_us", pa.int64()), ("step_name", pa.string()), ("has_input", pa.bool_()), ("has_run_input", pa.bool_()),
                        ("retry_after_us", pa.int64()), ("holder", pa.string()), ("claim_cancelled", pa.bool_()), ("resume_id", pa.string()), ("digest", pa.string()), ("by_workflow", pa.bool_()), ("spec_version", pa.int32()), ("run_spec", pa.int32())])
    rng = random.Random(3)
    weights = [3, 3, 1, 1, 1, *[4] * 11]
    seen = set()
    for case in range(300):
        rows, starts = [], []
        for r in range(rng.randrange(1, 30)):
            starts.append(len(rows))
            early = rng.random() < 0.7
            for i in range(rng.randrange(1, 40)):
                kind = rng.choices(guards.KINDS[:-1], weights)[0] if i or not early else rng.choice(("run_created", "run_started"))
                some = lambda *x: rng.choice((None, *x))
                rows.append({"run_id": None if r == 0 else f"r{r}", "event_type": kind, "corr": some("a", "b", "c"), "at_us": i + rng.randrange(3), "step_name": some("n"), "has_input": some(True, False), "has_run_input": some(True, True, False),
                             "retry_after_us": some(i, i + 3, i + 9), "holder": some(None, None, f"r{r}/a", "x/y"), "claim_cancelled": rng.random() < 0.1, "resume_id": some("p", "q"), "digest": some("1", "2"),
                             "by_workflow": some(True, False), "spec_version": rng.choice([None] * 8 + [5, 6]), "run_spec": rng.choice([None] * 4 + [5, 6])})
        spec = 6 if case % 3 == 0 else None
        names = schema.names if case % 2 else [n for n in schema.names if n not in ("resume_id", "holder", "run_spec")]
        rows = [{n: x[n] for n in names} for x in rows]
        batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema([schema.field(n) for n in names]))
        want, state = [], None
        for i, e in enumerate(rows):
            state = new_state() if i in starts else state
            outcome, types = decide(state, e, spec)
            want.append((outcome, types, state["n"], state["steps"][e["corr"]][1] if outcome == "TOO_EARLY" else None))
            seen.add(outcome)
        saved, guards.LEAST = guards.LEAST, 0
        try:
            found = guards.decide_all(batch, np.array(starts), spec)
        finally:
            guards.LEAST = saved
        got = [(guards.OUTCOMES[o], [guards.KINDS[k] for k in (a, b) if k >= 0], int(s), t) for o, a, b, s, t in zip(*found[:4], found[4].to_pylist(), strict=True)]
        for i, (g, w) in enumerate(zip(got, want, strict=True)):
            assert g == w, (case, i, rows[i])
    assert seen == set(guards.OUTCOMES) - {"hook_conflict"}


def test_open_hooks_read_the_log_once(spark):
    """Hooks of the log's own runs as live_hooks gives them, from one fold; a hook without a name is one as well."""
    log = spark.createDataFrame(
        [("a", 1, "run_created", None, 1), ("a", 2, "hook_created", "h", 2), ("a", 3, "hook_created", "g", 3), ("a", 4, "hook_disposed", "g", 4), ("a", 5, "hook_created", None, 5),
         ("b", 1, "run_created", None, 1), ("b", 2, "hook_created", "h", 2), ("b", 3, "run_failed", None, 3), (None, 1, "run_created", None, 1), (None, 2, "hook_created", "h", 7)],
        "run_id string, slot long, event_type string, corr string, at_us long",
    )
    got = eventlog.open_hooks(log)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [("a", "h", 2), ("a", None, 5), (None, "h", 7)]))
    named = sorted(tuple(r) for r in eventlog.live_hooks(log, eventlog.run_states(log)).where("run_id is not null and hook_id is not null").collect())
    assert named == [("a", "h")]
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_folds_over_larger_files_have_more_tasks(spark, small, tmp_path, monkeypatch):
    """A shuffle's tasks follow the bytes that its rows are made from, not only the session's setting."""
    monkeypatch.setattr(eventlog, "TASK_BYTES", 1024)
    orders = spark.read.parquet(f"{small}/orders.parquet")
    assert eventlog.tasks_of(orders) > 4 and eventlog.tasks_of(spark.range(3)) is None
    monkeypatch.setattr(eventlog, "TASK_BYTES", 8 << 20)
    assert eventlog.tasks_of(orders) is None
    monkeypatch.setattr(eventlog, "TASK_BYTES", 1024)
    assert eventlog.by_run(orders.withColumn("run_id", F.col("o_orderkey"))).rdd.getNumPartitions() > 4


def test_listed_events_come_in_order_and_few_wait():
    """Events of rows dealt by run come as one sort gives them, whatever the batches are, and a long run's are not held until it ends."""
    import random

    import pyarrow as pa

    event = pa.struct([("seq", pa.int64()), ("event_type", pa.string()), ("at_us", pa.int64())])
    schema = pa.schema([("run_id", pa.string()), ("first", pa.int64()), ("events", pa.list_(event))])
    rng = random.Random(5)
    for case in range(200):
        rows = []
        for i in range(rng.randrange(1, 60)):
            at = [rng.choice((None, *range(9))) if rng.random() < 0.1 else rng.randrange(i, i + 9) for _ in range(rng.randrange(1, 4))]
            made = [{"seq": rng.randrange(-2, 5), "event_type": "wait_created", "at_us": a} for a in at]
            events = [rng.choice((e, e, None)) for e in made]  # null is no event; it counts for the earliest time all the same
            rows.append({"run_id": rng.choice((None, "a", "b")), "first": None if None in at else min(at), "events": events})
        nulls_first = lambda *x: [(y is not None, y if y is not None else 0) for y in x]
        rows.sort(key=lambda r: [nulls_first(r["run_id"])[0][0], r["run_id"] or "", *nulls_first(r["first"])])
        size = rng.randrange(1, 8)
        batches = [pa.RecordBatch.from_pylist(rows[i : i + size], schema=schema) for i in range(0, len(rows), size)]
        got = [(e["run_id"], e["at_us"], e["seq"]) for b in eventlog.opened(iter(batches)) for e in b.to_pylist()]
        every = [(r["run_id"], e["at_us"], e["seq"]) for r in rows for e in r["events"] if e]
        assert got == sorted(every, key=lambda x: [x[0] is not None, x[0] or "", *nulls_first(*x[1:])]), case
    asked = 0

    def long_run():
        nonlocal asked
        for i in range(100):
            asked += 1
            yield pa.RecordBatch.from_pylist([{"run_id": "a", "first": i, "events": [{"seq": i, "event_type": "wait_created", "at_us": i + k} for k in (0, 2)]}], schema=schema)

    for _ in zip(range(20), eventlog.opened(long_run()), strict=False):
        assert asked < 30


def test_lists_fold_as_their_events_do(spark):
    """Lists of events give what the events give as rows, also where several rows make one run's; only rows of wanted outcomes come out."""
    event = "struct<seq: bigint, event_type: string, corr: string, at_us: bigint, retry_after_us: bigint, output: string, has_run_input: boolean>"
    rows = spark.range(4000).selectExpr("if(id % 7 = 0, null, concat('r', id % 90)) run_id", "id", "id % 40 at")
    made = F.expr(f"""array(cast(named_struct('s', id * 9, 't', 'run_started', 'c', null, 'a', at - 5, 'r', null, 'o', null, 'i', true) as {event}),
     if(id % 3 = 0, null, cast(named_struct('s', id * 9 + 1, 't', 'step_created', 'c', string(id % 11), 'a', at, 'r', null, 'o', null, 'i', null) as {event})),
     cast(named_struct('s', id * 9 + 2, 't', 'step_retrying', 'c', string(id % 11), 'a', at + 1, 'r', at + id % 9, 'o', null, 'i', null) as {event}),
     cast(named_struct('s', id * 9 + 3, 't', 'step_started', 'c', string(id % 11), 'a', at + 3, 'r', null, 'o', null, 'i', null) as {event}),
     if(id % 5 > 0, null, cast(named_struct('s', id * 9 + 4, 't', 'step_completed', 'c', string(id % 11), 'a', at + 9, 'r', null, 'o', string(id), 'i', null) as {event})))""")
    listed = eventlog.dealt(rows, F.col("at") - 5).select("run_id", "first", made.alias("events"))
    flat = rows.select("run_id", F.explode(made).alias("e")).where("e is not null").select("run_id", "e.*")
    result = lambda df: sorted(map(repr, map(tuple, df.select("run_id", "seq", "outcome", "appended", "slot", "retry_at_us", "output", "retry_after_us").collect())))
    want = result(eventlog.fold(flat))
    assert result(eventlog.fold(listed, listed=True)) == want != []
    for outcome in ("appended", "TOO_EARLY"):
        some = eventlog.fold(flat).where(F.col("outcome") == outcome)
        assert result(eventlog.fold(listed, listed=True, only=[outcome])) == result(some) != []


def test_rows_are_shuffled_before_events_are_made(spark, small):
    """The queries on the fold shuffle what events are made from, and no events: there are up to twenty times as many."""
    from weftline.plans import lifecycle, lives  # noqa: F401  they register their queries

    for name in ("wait_results", "live_hooks", "hooks_page", "step_results", "early_starts"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[-1]
        assert "Exchange" in plan and "event_type" not in plan.split("Exchange", 1)[1], name


def test_steps_made_in_the_fold_are_those_of_its_log(spark):
    """Steps from the fold's own tasks are those that the log's aggregation gives: null runs and ids, events without a time, runs over many batches, steps that end after a long while."""
    event = "struct<seq: bigint, event_type: string, corr: string, at_us: bigint, retry_after_us: bigint, output: string, error: string, has_run_input: boolean>"
    kinds = "array('step_created', 'step_created', 'step_started', 'step_retrying', 'step_started', 'step_completed', 'step_failed', 'hook_created', 'wait_created')"
    rows = spark.range(80_000).selectExpr("case when id < 60000 then 'long' when id % 7 > 0 then concat('r', id % 90) end run_id", "id", "if(id % 30000 = 29999, null, id) at")
    one = f"""cast(named_struct('s', id, 't', element_at({kinds}, 1 + pmod(hash(id), 9)), 'c', if(id % 101 = 0, null, string(id * 31 % if(run_id = 'long', 9001, 400))), 'a', at,
     'r', if(id % 3 = 0, at + id % 50, null), 'o', if(id % 4 > 0, string(id), null), 'e', if(id % 5 > 0, string(-id), null), 'i', null) as {event})"""
    begin = f"if(id % 500 = 0, cast(named_struct('s', -1, 't', 'run_started', 'c', null, 'a', at - 1, 'r', null, 'o', null, 'e', null, 'i', true) as {event}), null)"
    listed = eventlog.dealt(rows, F.col("at") - 1).select("run_id", "first", F.expr(f"array({begin}, {one})").alias("events"))
    states, steps = eventlog.step_states(eventlog.appended(eventlog.fold(listed, listed=True))), eventlog.folded_steps(listed, listed=True)
    assert steps.columns == states.columns and [f.dataType for f in steps.schema] == [f.dataType for f in states.schema]
    got = steps.collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, states.collect()))) and len(got) > 3_000
    assert {r.status for r in got} == {"pending", "running", "completed", "failed"} and None in {r.run_id for r in got}
    counts = [sum(map(bool, x)) for x in zip(*((r.attempt > 1, r.output, r.error, r.output and r.error, r.retry_after_us) for r in got), strict=True)]
    assert min(counts) > 20, counts
    assert eventlog.folded_steps(listed.limit(0), listed=True).collect() == []


def test_events_made_in_the_fold_are_those_of_lists(spark):
    """Events that the fold makes of rows are those that lists of them hold: columns with nulls, sums, fixed values and flags that are null."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({
        "run_id": ["a", None, "b"], "first": [0, 1, 2], "at": pa.array([5, None, 7]), "id": ["x", "y", None], "some": [True, None, False],
    })
    kinds = {"seq": pa.int64(), "event_type": pa.string(), "corr": pa.string(), "at_us": pa.int64(), "digest": pa.string()}
    events = [
        {"seq": 0, "event_type": "step_created", "corr": ("id",), "at_us": ("at", 0), "digest": None},
        {"seq": 1, "event_type": ("id",), "corr": None, "at_us": ("at", 3), "digest": "d"},
        {"seq": ("at",), "event_type": "run_started", "corr": "c", "at_us": -9, "digest": None},
    ]
    got = eventlog.Made(kinds, events, [None, "some", None]).of(batch).to_pylist()
    rows = [
        ("a", 0, "step_created", "x", 5, None), ("a", 1, "x", None, 8, "d"), ("a", 5, "run_started", "c", -9, None), (None, 0, "step_created", "y", None, None),
        (None, None, "run_started", "c", -9, None), ("b", 0, "step_created", None, 7, None), ("b", 7, "run_started", "c", -9, None),
    ]
    assert got == [dict(zip(("run_id", *kinds), r, strict=True)) for r in rows]


def test_step_results_shuffles_rows_once(spark, small):
    """Lines and runs are shuffled once; neither steps nor their events are shuffled or sorted as rows after the fold, which would cost more than the fold itself."""
    from weftline.plans import lifecycle  # noqa: F401  registers the query

    plan = queries.QUERIES["step_results"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan
    assert "Exchange" not in plan.split("MapInArrow")[0] and "step_retrying" not in plan
