"""Registered queries of what keeps queues, hooks and runs in order: leases, purges, releases, fences, cleanup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import eventlog, listing, ownership, queues, retention, streams
from weftline.plans.queries import (
    DELIVERED,
    DUE,
    EVENTS,
    EVENTS_NOW_US,
    HOOKS,
    MESSAGES,
    QUEUE_AGE_US,
    RUNS,
    RUNS_NOW_US,
    STEPS,
    _due_runs,
    aged_keys,
    query,
)
from weftline.sources import fixtures as S

DAY_US = retention.DAY_US

# -- queue ----------------------------------------------------------------------------------------


def _released(spark, sf_dir) -> DataFrame:
    """Messages with the time at which their delivery, when due, lets go of their key (null: it is redelivered or retried)."""
    done = queues.deliver(S.messages(spark, sf_dir), EVENTS_NOW_US)
    due = queues.due_us(F.col("enqueued_us"), F.col("delay_s"))
    return done.withColumn("released_us", F.when(F.col("outcome").isin("ack", "drop", "dead"), due + 3_600_000_000))


@query(f"""WITH RECURSIVE {DELIVERED}, m AS (SELECT *, CASE WHEN outcome IN ('ack', 'drop', 'dead') THEN enqueued_us + greatest(0, delay_s) * 1000000 + 3600000000 END AS released_us,
 row_number() OVER (PARTITION BY idempotency_key ORDER BY enqueued_us, message_id) AS n FROM delivered),
 f AS (SELECT idempotency_key, n, message_id, message_id AS original_id, true AS accepted, released_us AS until FROM m WHERE n = 1 UNION ALL
 SELECT m.idempotency_key, m.n, m.message_id, CASE WHEN coalesce(f.until <= m.enqueued_us, false) THEN m.message_id ELSE f.original_id END,
 coalesce(f.until <= m.enqueued_us, false), CASE WHEN coalesce(f.until <= m.enqueued_us, false) THEN m.released_us ELSE f.until END
 FROM f JOIN m ON m.idempotency_key = f.idempotency_key AND m.n = f.n + 1)
 SELECT message_id, original_id, accepted FROM f""")
def enqueue_while_active(spark, sf_dir):
    """Idempotent enqueue: a key is held until its holder's delivery ends it."""
    return queues.dedup_while_active(_released(spark, sf_dir)).select("message_id", "original_id", "accepted")


@query(f"""WITH {DELIVERED}, l AS (SELECT *, attempt + CASE WHEN outcome IN ('retry', 'dead') THEN 1 ELSE 0 END AS now FROM delivered)
 SELECT message_id, CAST(message_id AS VARCHAR) || '/' || CAST(attempt AS VARCHAR) AS lease, attempt = now AS counts FROM l""")
def late_answers(spark, sf_dir):
    """Answers of deliveries whose lease is still theirs, or has passed to a later one."""
    done = queues.deliver(S.messages(spark, sf_dir), EVENTS_NOW_US)
    leases = done.select("message_id", queues.lease_id(F.col("message_id"), F.col("attempt_after")).alias("lease"))
    answers = done.select("message_id", queues.lease_id(F.col("message_id"), F.col("attempt")).alias("lease"))
    return queues.settle(answers, leases).select("message_id", "lease", "counts")


@query(f"""WITH {DELIVERED}, d AS (SELECT message_id, idempotency_key % 4 AS shard, row_number() OVER (PARTITION BY idempotency_key % 4 ORDER BY enqueued_us, message_id) AS n,
 count(*) OVER (PARTITION BY idempotency_key % 4) AS total FROM delivered WHERE outcome = 'dead') SELECT message_id, shard, total > {queues.PURGE_PAGE} AS has_more FROM d WHERE n <= {queues.PURGE_PAGE}""")
def dead_letter_purge(spark, sf_dir):
    """What one purge of each shard takes."""
    dead = queues.deliver(S.messages(spark, sf_dir), EVENTS_NOW_US).where("outcome = 'dead'").withColumn("shard", F.col("idempotency_key") % 4)
    return queues.purge_dead(dead, "shard", ["enqueued_us", "message_id"]).select("message_id", "shard", "has_more")


#: Markers of expired queues: some were compacted before (their first event is a sign-up), some were counted wrongly (they hold a purchase first).
_MARKERS = f"""{MESSAGES}, g AS (SELECT idempotency_key, count(*) AS n, arg_min(status, (enqueued_us, message_id)) AS s FROM messages GROUP BY 1 HAVING min(enqueued_us) + {QUEUE_AGE_US} <= {EVENTS_NOW_US})"""


def _markers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    m = S.messages(spark, sf_dir)
    _, receipts = queues.expire_runs(m, aged_keys(m), "idempotency_key")
    first = m.groupBy("idempotency_key").agg(F.min_by("status", F.struct("enqueued_us", "message_id")).alias("s"))
    marked = receipts.join(first, "idempotency_key").where("s <> 404")
    return receipts, marked.select("idempotency_key", F.when(F.col("s") == 0, F.col("n_deleted") + 1).otherwise(F.col("n_deleted")).alias("n_deleted"))


@query(f"""WITH {_MARKERS} SELECT idempotency_key, CAST(n AS BIGINT) AS n_deleted, s <> 0 AS acknowledged, CASE WHEN s NOT IN (0, 404) THEN {EVENTS_NOW_US + DAY_US} END AS compact_us FROM g""")
def expiry_acknowledged(spark, sf_dir):
    """Receipts acknowledged: equal to their marker, or without one."""
    return queues.acknowledge(*_markers(spark, sf_dir), EVENTS_NOW_US, DAY_US, "idempotency_key")


@query(f"""WITH {_MARKERS} SELECT idempotency_key FROM g WHERE s NOT IN (0, 404)""")
def expiry_markers_compacted(spark, sf_dir):
    """Markers that go when their own deadline is over; the deadline of a marker renewed since takes nothing."""
    receipts, markers = _markers(spark, sf_dir)
    deadlines = queues.acknowledge(receipts, markers, EVENTS_NOW_US, DAY_US, "idempotency_key").select("idempotency_key", F.coalesce("compact_us", F.lit(EVENTS_NOW_US)).alias("compact_us"))
    own = markers.select("idempotency_key", F.lit(EVENTS_NOW_US + DAY_US).alias("compact_us"))
    return queues.compactable(deadlines, own, EVENTS_NOW_US + DAY_US, "idempotency_key").select("idempotency_key")


# -- streams --------------------------------------------------------------------------------------


@query(f"""WITH {EVENTS}, e AS (SELECT run_id AS stream, min(event_id) AS ended, arg_min(CASE WHEN event_type = 'run_completed' THEN 'closed' ELSE 'errored' END, event_id) AS state
 FROM ev WHERE event_type IN ('run_completed', 'run_failed') GROUP BY 1) SELECT event_id AS seq, run_id AS stream, CASE WHEN ended < event_id THEN state END AS refused
 FROM ev LEFT JOIN e ON run_id = stream WHERE event_type = 'hook_received'""")
def stream_refused_writes(spark, sf_dir):
    """Writes that come after a stream has ended, with the state that refuses them."""
    e = S.run_events(spark, sf_dir).select(F.col("run_id").alias("stream"), F.col("event_id").alias("seq"), "event_type")
    ends = e.where("event_type in ('run_completed', 'run_failed')").withColumn("state", F.when(F.col("event_type") == "run_completed", "closed").otherwise("errored"))
    return streams.refused(e.where("event_type = 'hook_received'"), ends).select("seq", "stream", "refused")


# -- hooks ----------------------------------------------------------------------------------------


@query(f"WITH {HOOKS}, {RUNS} SELECT hook_id, token, h.run_id FROM hooks h JOIN runs r ON r.run_id = 'wrun_' || lpad(CAST(h.run_id AS VARCHAR), 10, '0') WHERE r.status <> 'completed'")
def hooks_by_id(spark, sf_dir):
    """Hooks by their id, of active runs only."""
    keyed = S.hooks(spark, sf_dir).withColumn("key", S.run_id(F.col("run_id")))
    return listing.active_only(keyed, S.runs(spark, sf_dir).withColumnRenamed("run_id", "key"), "key").select("hook_id", "token", "run_id")


_OWNERS = "o AS (SELECT token, arg_min(run_id, (at_us, hook_id)) AS owner FROM hooks GROUP BY token)"
_GONE = f"g AS (SELECT user_id AS run_id FROM events GROUP BY 1 HAVING min(epoch_us(ts)) + {QUEUE_AGE_US} <= {EVENTS_NOW_US})"


@query(f"""WITH {HOOKS}, {_OWNERS}, {_GONE} SELECT hook_id, CASE WHEN o.owner = h.run_id AND h.at_us <= {EVENTS_NOW_US} THEN 'committed' WHEN g.run_id IS NOT NULL THEN 'expired' ELSE 'cancelled' END AS state
 FROM hooks h JOIN o ON h.token = o.token LEFT JOIN g ON h.run_id = g.run_id""")
def claims_resolved(spark, sf_dir):
    """What became of claims whose answer was lost: hooks are published until now, tokens belong to first claims."""
    hooks = S.hooks(spark, sf_dir)
    tokens = ownership.owners(hooks, "token", ["at_us", "hook_id"], ["run_id"])
    expired = aged_keys(S.messages(spark, sf_dir)).select(F.col("idempotency_key").alias("run_id"))
    return ownership.resolve(hooks, hooks.where(F.col("at_us") <= EVENTS_NOW_US), tokens, expired).select("hook_id", "state")


@query(f"""WITH {HOOKS}, {_GONE}, c AS (SELECT hook_id % 32 AS shard, g.run_id IS NOT NULL AND h.at_us <= {EVENTS_NOW_US} AS gone FROM hooks h LEFT JOIN g ON h.run_id = g.run_id)
 SELECT shard, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_released, CAST(count(*) FILTER (WHERE NOT gone) AS BIGINT) AS n_left FROM c GROUP BY ROLLUP (shard)""")
def claim_releases(spark, sf_dir):
    """Claims released with their runs, by shard and in sum: owner and claim must both be the released ones."""
    hooks = S.hooks(spark, sf_dir)
    expired = aged_keys(S.messages(spark, sf_dir)).select(F.col("idempotency_key").alias("run_id"))
    released = hooks.where(F.col("at_us") <= EVENTS_NOW_US).join(expired, "run_id", "left_semi").select("run_id", "hook_id")
    return ownership.release_counts(hooks, released, ["run_id", "hook_id"], F.col("hook_id") % ownership_shards())


@query(f"""WITH {HOOKS}, {_GONE} SELECT hook_id FROM hooks h WHERE NOT (h.at_us <= {EVENTS_NOW_US} AND h.run_id IN (SELECT run_id FROM g))""")
def claims_left(spark, sf_dir):
    """Claims that a release leaves."""
    hooks = S.hooks(spark, sf_dir)
    expired = aged_keys(S.messages(spark, sf_dir)).select(F.col("idempotency_key").alias("run_id"))
    released = hooks.where(F.col("at_us") <= EVENTS_NOW_US).join(expired, "run_id", "left_semi").select("run_id", "hook_id")
    return ownership.release(hooks, released, ["run_id", "hook_id"]).select("hook_id")


def ownership_shards() -> int:
    from weftline.functions.scalars import HOOK_SHARDS

    return HOOK_SHARDS


@query(f"""WITH {DUE}, {STEPS} SELECT s.run_id, step_id, CAST(count(*) AS BIGINT) AS n, terminal_due_us IS NOT NULL AND terminal_due_us <= {RUNS_NOW_US} AS rejected
 FROM steps s JOIN dl ON s.run_id = dl.run_id GROUP BY ALL""")
def late_step_writes(spark, sf_dir):
    """Step writes with an answer: those of tombstoned runs are rejected, not lost."""
    runs = _due_runs(spark, sf_dir)
    gone = runs.where(retention.is_expired(F.col("due_us"), F.lit(RUNS_NOW_US)))
    judged = listing.late_writes(eventlog.by_run(S.step_events(spark, sf_dir).select("run_id", "step_id")), gone)
    return judged.groupBy("run_id", "step_id", "rejected").agg(F.count(F.lit(1)).alias("n"))


# -- cleanup --------------------------------------------------------------------------------------

#: Cleanups that fail: streams of one deployment, then payloads of another. Two failures in one run: the first phase stops it.
_FAILS = "CASE WHEN deployment_id = 'dep_3' THEN 'streams' WHEN deployment_id = 'dep_6' THEN 'payload' END"
_CLEANUP = f"""{DUE}, {STEPS}, {MESSAGES}, x AS (SELECT *, {_FAILS} AS f FROM dl WHERE terminal_due_us <= {RUNS_NOW_US}),
 s AS (SELECT run_id, count(*) AS n FROM steps GROUP BY 1), m AS (SELECT 'wrun_' || lpad(CAST(idempotency_key AS VARCHAR), 10, '0') AS run_id, count(*) AS n FROM messages GROUP BY 1),
 c AS (SELECT x.run_id, coalesce(f, 'tombstoned') AS phase, CAST(CASE WHEN f IS NULL THEN 0 ELSE 1 END AS BIGINT) AS attempts, CASE WHEN f IS NOT NULL THEN f || ' timed out' END AS last_error,
 CASE WHEN f IS NULL THEN terminal_due_us ELSE {RUNS_NOW_US} + 1000000 END AS due_us, CAST(CASE WHEN f = 'streams' THEN 0 ELSE 1 END AS BIGINT) AS streams_deleted,
 CAST(CASE WHEN f = 'streams' THEN 0 ELSE coalesce(m.n, 0) END AS BIGINT) AS messages_deleted, CAST(CASE WHEN f IS NULL THEN coalesce(s.n, 0) ELSE 0 END AS BIGINT) AS payload_keys_deleted
 FROM x LEFT JOIN s ON x.run_id = s.run_id LEFT JOIN m ON x.run_id = m.run_id)"""
_STATUS = ["phase", "attempts", "last_error", "due_us", "streams_deleted", "messages_deleted", "payload_keys_deleted"]


def _cleanup(spark, sf_dir) -> DataFrame:
    runs = _due_runs(spark, sf_dir)
    records = retention.cleanup_records(runs, RUNS_NOW_US)
    one = F.lit(1).alias("n")
    counts = {
        "streams": runs.select("run_id", one),
        "queues": S.messages(spark, sf_dir).select(S.message_run(F.col("idempotency_key")).alias("run_id"), one),
        "payload": S.step_events(spark, sf_dir).select("run_id", one),
    }
    bad = runs.select("run_id", F.explode(F.when(F.col("deployment_id") == "dep_3", F.array(F.lit("payload"), F.lit("streams"))).when(F.col("deployment_id") == "dep_6", F.array(F.lit("payload")))).alias("phase"))
    return retention.run_phases(records, counts, bad.withColumn("error", F.concat("phase", F.lit(" timed out"))), RUNS_NOW_US)


@query(f"WITH {_CLEANUP} SELECT * FROM c")
def cleanup_phases(spark, sf_dir):
    """Cleanups run through their phases, stopped where one fails, with attempts and backoff."""
    return _cleanup(spark, sf_dir).select("run_id", *_STATUS)


@query(f"WITH {_CLEANUP} SELECT * FROM c")
def cleanup_statuses(spark, sf_dir):
    """Cleanup status of each run: its live record, else its tombstone's copy."""
    done = _cleanup(spark, sf_dir)
    return retention.cleanup_status(done.where("phase <> 'tombstoned'"), done.where("phase = 'tombstoned'"), _STATUS)
