"""Workflow operators: transitions by guard, fold in batch and stream, codecs, plans, and the SQL of every query."""

import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import codecs, scalars
from weftline.functions.transitions import decide, new_state
from weftline.operators import eventlog, handlers, listing, queues, retention, streams
from weftline.plans import lifecycle, queries, upkeep  # noqa: F401  the others register their queries
from weftline.plans.config import Settings, World
from weftline.streaming import folds


def play(*events):
    """Outcomes of (type, corr, extras) in order; time counts up."""
    state, out = new_state(), []
    for i, e in enumerate(events):
        kind, corr, extra = (*e, None, {})[:3] if isinstance(e, tuple) and len(e) == 1 else (*e, {})[:3] if isinstance(e, tuple) else (e, None, {})
        outcome, types = decide(state, {"run_id": "r", "event_type": kind, "corr": corr, "at_us": i, **extra})
        out.append(outcome if len(types) < 2 and "hook_conflict" not in types else "+".join(types))
    return out


MADE = ("run_created", "run_started")


@pytest.mark.parametrize(
    ("events", "last"),
    [
        ((*MADE, "run_completed", "run_started"), "RUN_EXPIRED"),  # G1
        ((*MADE, "run_completed", "run_failed"), "ENTITY_CONFLICT"),
        ((*MADE, "run_failed", ("step_created", "s")), "ENTITY_CONFLICT"),
        ((*MADE, "run_failed", "attr_set"), "ENTITY_CONFLICT"),
        ((*MADE, "run_cancelled", "run_cancelled"), "appended"),  # G2
        ((*MADE, "run_completed", "run_cancelled"), "ENTITY_CONFLICT"),
        ((*MADE, "run_completed", "run_created"), "replay"),  # G3
        ((*MADE, "run_started"), "replay"),  # G4
        ((*MADE, ("step_created", "s"), "run_completed", ("step_completed", "s")), "appended"),  # G5
        ((*MADE, ("step_created", "s"), "run_completed", ("step_failed", "s")), "RUN_EXPIRED"),
        ((*MADE, ("step_created", "s"), "run_completed", ("step_started", "s")), "RUN_EXPIRED"),
        ((*MADE, ("step_created", "s"), ("step_started", "s"), "run_completed", ("step_failed", "s")), "appended"),
        ((*MADE, ("step_created", "s"), ("step_completed", "s")), "appended"),  # G6
        ((*MADE, ("step_created", "s"), ("step_completed", "s"), ("step_retrying", "s")), "ENTITY_CONFLICT"),  # G7
        ((*MADE, ("step_created", "s"), ("step_retrying", "s", {"retry_after_us": 4}), ("step_started", "s")), "appended"),  # G8: equal
        ((*MADE, ("step_created", "s"), ("step_retrying", "s", {"retry_after_us": 5}), ("step_started", "s")), "TOO_EARLY"),
        ((*MADE, ("hook_created", "h", {"holder": "x/y"})), "hook_conflict"),  # G11
        ((*MADE, ("hook_created", "h"), ("hook_disposed", "h"), ("hook_created", "h")), "ENTITY_CONFLICT"),  # G12
        ((*MADE, ("hook_created", "h"), ("hook_created", "h")), "replay"),  # G13
        ((*MADE, ("hook_created", "h"), ("hook_created", "h", {"holder": "r/h"})), "ENTITY_CONFLICT"),
        ((*MADE, ("hook_created", "h"), ("hook_disposed", "h"), ("hook_disposed", "h")), "replay"),  # G14
        ((*MADE, ("hook_received", "h")), "HOOK_NOT_FOUND"),
        ((*MADE, ("hook_created", "h"), ("hook_received", "h", {"resume_id": "q", "digest": "a"}), ("hook_received", "g", {"resume_id": "q"})), "ENTITY_CONFLICT"),  # G15
        ((*MADE, ("hook_created", "h"), ("hook_received", "h", {"resume_id": "q", "digest": "a"}), ("hook_received", "h", {"resume_id": "q"})), "replay"),
        ((*MADE, ("hook_created", "h"), ("hook_received", "h", {"resume_id": "q", "digest": "a"}), ("hook_received", "h", {"resume_id": "q", "digest": "b"})), "ENTITY_CONFLICT"),
        ((*MADE, ("hook_created", "h", {"claim_cancelled": True})), "HOOK_CLAIM_CANCELLED"),
        ((*MADE, ("wait_created", "w"), ("wait_completed", "w"), ("wait_completed", "w")), "ENTITY_CONFLICT"),  # E17
        ((*MADE, ("wait_completed", "w")), "WAIT_NOT_FOUND"),
        (("run_started",), "RUN_NOT_FOUND"),  # E23
        ((("run_started", None, {"has_run_input": True}),), "run_created+run_started"),  # G18, E03
        ((*MADE, ("step_started", "s", {"step_name": "n", "has_input": True})), "step_created+step_started"),  # E10
        ((*MADE, ("step_created", "s"), ("step_started", "s", {"step_name": "n", "has_input": True})), "ENTITY_CONFLICT"),
        ((("step_completed", "s"),), "STEP_NOT_FOUND"),
        ((*MADE, ("attr_set", "a", {"by_workflow": True}), ("attr_set", "a", {"by_workflow": True})), "ENTITY_CONFLICT"),  # E07
        ((*MADE, ("attr_set", "a"), ("attr_set", "a")), "appended"),
    ],
)
def test_guards(events, last):
    assert play(*events)[-1] == last


def test_rejected_events_leave_no_trace_and_slots_stay_dense():
    state = new_state()
    for kind in ("run_started", "run_created", "run_failed", "run_started", "run_cancelled"):
        before = json.dumps(state)
        outcome, types = decide(state, {"run_id": 1, "event_type": kind, "corr": None, "at_us": 0})
        assert types or json.dumps(state) == before
    assert state["n"] == 2 and decide(state, {"event_type": "run_created", "spec_version": 5}, 6) == ("RUN_NOT_SUPPORTED", [])


EVENT = "run_id string, seq long, event_type string, corr string, at_us long, step_name string, has_input boolean, has_run_input boolean"


def log(n=400, seed=1):
    rng = random.Random(seed)
    kinds = ["run_started", "step_created", "step_started", "step_completed", "step_retrying", "hook_created", "hook_received", "wait_created", "wait_completed", "attr_set", "run_cancelled"]
    rows = []
    for i in range(n):
        kind = rng.choices(kinds, [4, 6, 6, 4, 2, 4, 4, 3, 3, 2, 1])[0]
        lazy = kind == "step_started" and rng.random() < 0.3
        rows.append((f"r{rng.randrange(12)}", i, kind, f"c{rng.randrange(4)}", i * 10, "n" if lazy else None, lazy, kind == "run_started"))
    return rows


def by_hand(rows):
    states, out = {}, []
    for r in sorted(rows, key=lambda r: (r[0], r[4], r[1])):
        e = dict(zip([c.split()[0] for c in EVENT.split(", ")], r, strict=True))
        outcome, types = decide(states.setdefault(r[0], new_state()), e)
        out.append((r[0], r[1], outcome, len(types), states[r[0]]["n"]))
    return sorted(out)


def test_fold_over_partitions_equals_one_by_one(spark):
    rows = log()
    folded = eventlog.fold(spark.createDataFrame(rows, EVENT)).cache()
    got = sorted((r["run_id"], r["seq"], r["outcome"], len(r["appended"]), r["slot"]) for r in folded.collect())
    assert got == by_hand(rows)
    entries = eventlog.appended(folded).cache()
    for run, slots in entries.groupBy("run_id").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert slots == list(range(1, len(slots) + 1)), run
    runs = {r["run_id"]: r["status"] for r in eventlog.run_states(entries).collect()}
    assert set(runs.values()) <= {"running", "cancelled"}
    steps = eventlog.step_states(entries).collect()
    assert steps and all(r["attempt"] >= (r["status"] == "running") for r in steps)
    assert {r["run_id"] for r in eventlog.live_hooks(entries, eventlog.run_states(entries)).collect()} <= {k for k, v in runs.items() if v == "running"}
    assert eventlog.fold(spark.createDataFrame([], EVENT)).count() == 0


def test_stream_with_a_restart_equals_batch(spark, tmp_path):
    rows = log(200, 2)
    first, second = rows[:90], rows[90:]
    source, sink, check = (str(tmp_path / d) for d in ("in", "out", "check"))
    for part in (first, second):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(source)
        stream = folds.fold_stream(spark.readStream.schema(EVENT).parquet(source))
        query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", check).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
    got = sorted((r["run_id"], r["seq"], r["outcome"], r["n_appended"], r["slot"]) for r in spark.read.parquet(sink).collect())
    assert got == by_hand(rows)


def test_dedup_lasts_as_long_as_the_message(spark, tmp_path):
    rows = [("k", 1, "enqueue", 10), ("k", 2, "enqueue", 11), ("k", 3, "release", 10), ("k", 4, "enqueue", 12), ("j", 5, "enqueue", 13), ("k", 6, "release", 99)]
    spark.createDataFrame(rows, "idempotency_key string, seq long, action string, message_id long").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = folds.dedup_stream(spark.readStream.schema("idempotency_key string, seq long, action string, message_id long").parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    got = {(r["message_id"], r["action"]): (r["original_id"], r["accepted"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[10, "enqueue"] == (10, True) and got[11, "enqueue"] == (10, False) and got[12, "enqueue"] == (12, True)
    assert got[13, "enqueue"] == (13, True) and got[10, "release"] == (10, True) and got[99, "release"] == (12, False)


def test_hashes_on_known_values(spark):
    rows = {r["v"]: (r["a"], r["b"]) for r in spark.createDataFrame([("same",), ("café/東京",), ("",)], "v string").select("v", scalars.fnv1a_bytes(F.col("v")).alias("a"), scalars.fnv1a_utf16(F.col("v")).alias("b")).collect()}
    assert rows["same"] == (0xCD0C4A3B, 0xCD0C4A3B) and rows["café/東京"][0] == 0xB1A7FDC8 != rows["café/東京"][1] and rows[""] == (0x811C9DC5,) * 2


def test_codecs_go_round_and_refuse_broken_frames(spark):
    chunks = [[b"", b"\x00\xff" * 300, "é".encode()], [b"x"], [bytes([i]) for i in range(32)]]
    df = spark.createDataFrame([(i, c, "errored", "Näme", "m" * 50) for i, c in enumerate(chunks)], "i long, c array<binary>, s string, n string, m string")
    w = df.select("i", "c", codecs.encode_write(F.col("c")).alias("w"), codecs.encode_read(F.col("i"), F.lit(-1), F.col("c"), F.col("s"), F.lit(True), F.col("n"), F.col("m")).alias("r"), codecs.encode_ack(F.col("i"), F.size("c")).alias("a"))
    got = w.select("c", "w", codecs.decode_write(F.col("w")).alias("dw"), codecs.decode_read(F.col("r")).alias("dr"), codecs.decode_ack(F.col("a")).alias("da"), codecs.decode_write(F.expr("substring(w, 1, octet_length(w) - 1)")).alias("cut"), codecs.decode_read(F.col("w")).alias("other")).collect()
    for i, row in enumerate(got):
        want = [bytes(x) for x in chunks[i]]
        assert bytes(row["w"]) == b"\x57\x43\x53\x57\x00\x01" + len(want).to_bytes(2, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in want)
        assert [bytes(x) for x in row["dw"]] == want and row["cut"] is None and row["other"] is None
        read = row["dr"]
        assert ([bytes(x) for x in read["chunks"]], read["start"], read["tail"], read["state"], read["timed_out"], read["name"], read["message"]) == (want, i, -1, "errored", True, "Näme", "m" * 50)
        assert tuple(row["da"]) == (i, len(want), i + len(want) - 1)
    name, message = codecs.bounded_error(F.lit("n"), F.repeat(F.lit("😀"), F.lit(5000)))
    row = spark.range(1).select(F.octet_length(name) + F.octet_length(message), codecs.untagged(codecs.tagged(F.lit(b"\x00\x01"), "bytes"), "bytes"), codecs.untagged(codecs.tagged(F.lit(1234), "date"), "date")).first()
    assert row[0] <= 16 * 1024 and bytes(row[1]) == b"\x00\x01" and row[2] == 1234


def test_handlers_become_statuses(spark):
    def handler(body, meta):
        if body == "gone":
            raise handlers.PermanentError(410)
        if body == "boom":
            raise RuntimeError
        return 30 if body == "later" else None if meta["attempt"] == 1 else 1

    rows = [(1, "q_a", "ok", 0), (2, "q_a", "gone", 0), (3, "q_a", "boom", 0), (4, "q_a", "later", 2), (5, "x", "ok", 0)]
    df = spark.createDataFrame(rows, "message_id long, queue_name string, body string, attempt long")
    got = {r["message_id"]: (r["status"], r["timeout_s"]) for r in handlers.handle(df, handler, "q_").collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 200, 2: 410, 3: 500, 4: 503, 5: 400} and got[4][1] == 30
    done = queues.deliver(handlers.handle(df, handler, "q_").withColumn("enqueued_us", F.lit(0)), 0)
    assert {r["message_id"]: r["outcome"] for r in done.collect()} == {1: "ack", 2: "drop", 3: "retry", 4: "redeliver", 5: "retry"}


def test_waits_between_attempts_and_the_fifth_failure(spark):
    rows = spark.createDataFrame([(a, a, 0, 500, None, a) for a in range(5)], "message_id long, idempotency_key long, enqueued_us long, status int, timeout_s int, attempt long")
    got = queues.deliver(rows, 0).orderBy("message_id").collect()
    assert [r["next_due_us"] for r in got] == [2_000_000, 4_000_000, 8_000_000, 16_000_000, None] and got[4]["outcome"] == "dead"
    plain = rows.where("attempt = 0").withColumn("status", F.lit(503))
    assert queues.deliver(plain, 0).first()["outcome"] == "retry"  # 503 without a time


def test_pages_put_together_are_the_whole_order(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.randrange(5), f"k{i}") for i in range(53)], "a long, b string").cache()
    for descending in (False, True):
        cursor, seen = None, []
        while True:
            rows = listing.page(df, ["a", "b"], 10, cursor, descending).collect()
            seen += rows[:10]
            if len(rows) <= 10:
                break
            cursor = tuple(rows[9])
        assert [tuple(r) for r in seen] == sorted(map(tuple, df.collect()), reverse=descending)
    assert [listing.page_limit(x) for x in (None, float("nan"), 0, 2.9, 10**6)] == [20, 20, 1, 2, 1000] and listing.page_limit(5000, "events", None) == 5000


def test_budgets_settings_and_bounds(spark):
    df = spark.createDataFrame([("s", i, 400) for i in range(5)] + [("big", 0, 5000), ("big", 1, 1)], "stream string, idx long, size long")
    assert {(r["stream"], r["idx"]) for r in streams.read(df, max_bytes=1000).collect()} == {("s", 0), ("s", 1)}
    assert {(r["stream"], r["idx"]) for r in streams.deletion_page(df, max_bytes=1000).collect()} == {("s", 0), ("s", 1), ("big", 0)}
    for bad in ({"queue_shards": 0}, {"retention_ms": -1}, {"call_ms": 300_001}, {"long_poll_ms": 30_000}):
        with pytest.raises(ValueError, match=next(iter(bad))):
            Settings(**bad)
    with pytest.raises(ValueError, match="maxChunks"):
        World(spark, "/nowhere").read_streams(df, max_chunks=33)
    runs = spark.createDataFrame([("a", "completed", 0, 10), ("b", "running", 0, None)], "run_id string, status string, created_us long, completed_us long")
    due = {r["run_id"]: r["due_us"] for r in retention.deadline(runs, 90, 50, 50).collect()}
    assert due == {"a": 50, "b": 50}  # the age deadline is inclusive and replaces only a later one
    assert {r["run_id"]: r["due_us"] for r in retention.deadline(runs, 30, 50, 49).collect()} == {"a": 40, "b": None}
    assert retention.sweep_state(retention.deadline(runs, 90, None, 0), runs.limit(0), 10, 20).count() == 0


def test_filters_and_columns_reach_the_scan_and_pages_are_top_k(spark, small, capsys):
    queries.QUERIES["runs_page_by_status"](spark, small).explain("formatted")
    plan = capsys.readouterr().out
    read = next(x for x in plan.splitlines() if x.startswith("ReadSchema"))
    assert "TakeOrderedAndProject" in plan and "o_totalprice" not in read and "o_orderdate" in read
    queries.QUERIES["queue_due_topk"](spark, small).explain("formatted")
    assert "WindowGroupLimit" in capsys.readouterr().out


@pytest.fixture(scope="module")
def duck(small):
    import duckdb

    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in "orders lineitem events conversations documents".split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, small, duck, name):
    df = queries.QUERIES[name](spark, small)
    want = duck.sql(queries.ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    place = [want.columns.index(c) for c in names]
    assert sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())


def test_every_query_is_registered():
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
