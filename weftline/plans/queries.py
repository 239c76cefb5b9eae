"""Registered queries over the workflow operators, each beside the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import scalars as X
from weftline.operators import eventlog, listing, ownership, queues, retention, streams
from weftline.sources import fixtures as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The moment that time-dependent queries take as now: 2001-08-02 for runs, 2024-01-16 for events (microseconds).
RUNS_NOW_US, EVENTS_NOW_US = 996_710_400_000_000, 1_705_363_200_000_000
RETENTION_US = 90 * retention.DAY_US
#: Age after which a run's messages expire: fourteen and a half days.
QUEUE_AGE_US = 29 * retention.DAY_US // 2

RUNS = """runs AS (SELECT 'wrun_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS run_id, o_orderpriority AS workflow_name,
 epoch_us(o_orderdate) AS created_us, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'pending' END AS status,
 'dep_' || CAST(o_custkey % 8 AS VARCHAR) AS deployment_id, o_totalprice AS input FROM orders)"""
STEPS = """steps AS (SELECT 'wrun_' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS run_id,
 CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS step_id, epoch_us(l_shipdate) AS at_us, * FROM lineitem)"""
STEP_ORDER = ", ".join(S.STEP_ORDER)
EVENTS = """ev AS (SELECT user_id AS run_id, event_id, epoch_us(ts) AS at_us,
 CASE WHEN event_type = 'error' AND value >= 100 THEN 'run_cancelled' WHEN event_type = 'error' THEN 'run_failed' WHEN event_type = 'signup' THEN 'run_started'
 WHEN event_type = 'view' THEN 'step_started' WHEN event_type = 'click' THEN 'hook_received' ELSE 'run_completed' END AS event_type,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events)"""
SLOTS = EVENTS + """, slots AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY at_us, event_id) AS slot FROM ev)"""
HOOKS = """hooks AS (SELECT event_id AS hook_id, user_id AS run_id, 'tok_' || json_extract_string(props, '$.k') AS token, epoch_us(ts) AS at_us
 FROM events WHERE event_type = 'click')"""
MESSAGES = """messages AS (SELECT event_id AS message_id, user_id AS idempotency_key, epoch_us(ts) AS enqueued_us,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS delay_s, CAST(json_extract_string(props, '$.k') AS BIGINT) % 6 AS attempt,
 CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 503 WHEN 'signup' THEN 404 WHEN 'error' THEN 500 ELSE 0 END AS status,
 CASE WHEN event_type = 'view' THEN 30 END AS timeout_s FROM events)"""
DELIVERED = MESSAGES + """, delivered AS (SELECT *, CASE WHEN status BETWEEN 200 AND 299 THEN 'ack' WHEN status IN (404, 409, 410, 422) THEN 'drop'
 WHEN status = 503 AND timeout_s IS NOT NULL THEN 'redeliver' WHEN attempt + 1 >= 5 THEN 'dead' ELSE 'retry' END AS outcome FROM messages)"""
CHUNKS = "chunks AS (SELECT conv_id AS stream, turn AS idx, role, text, strlen(text) AS size FROM conversations)"
DUE = RUNS + f""", due AS (SELECT *, CASE WHEN status = 'completed' THEN created_us + {retention.DAY_US} END AS completed_us FROM runs),
 dl AS (SELECT *, CASE WHEN status = 'completed' THEN completed_us + {RETENTION_US} END AS terminal_due_us FROM due)"""


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


# -- listings -------------------------------------------------------------------------------------

_RUN = ["run_id", "workflow_name", "created_us", "status", "deployment_id"]
_RUN_SQL = "run_id, workflow_name, created_us, status, deployment_id"


@query(f"WITH {RUNS} SELECT {_RUN_SQL} FROM runs WHERE status = 'completed' ORDER BY created_us DESC, run_id DESC LIMIT 21")
def runs_page_by_status(spark, sf_dir):
    """Newest completed runs: a page of 20 and one to peek, payload elided."""
    runs = listing.without_payload(S.runs(spark, sf_dir).where("status = 'completed'"))
    return listing.page(runs, ["created_us", "run_id"], listing.page_limit(None), descending=True).select(*_RUN)


@query(f"WITH {RUNS} SELECT {_RUN_SQL} FROM runs WHERE workflow_name = '1-URGENT' ORDER BY created_us, run_id LIMIT 21")
def runs_page_by_workflow(spark, sf_dir):
    """Oldest runs of one workflow, ascending."""
    runs = S.runs(spark, sf_dir).where("workflow_name = '1-URGENT'")
    return listing.page(runs, ["created_us", "run_id"], 20).select(*_RUN)


_CURSOR = f"""c AS (SELECT created_us, run_id FROM runs WHERE status = 'running' ORDER BY created_us, run_id LIMIT 1 OFFSET 19)"""


@query(f"""WITH {RUNS}, {_CURSOR} SELECT {', '.join('r.' + c for c in _RUN)} FROM runs r, c WHERE r.status = 'running'
 AND (r.created_us > c.created_us OR (r.created_us = c.created_us AND r.run_id > c.run_id)) ORDER BY r.created_us, r.run_id LIMIT 21""")
def runs_second_page(spark, sf_dir):
    """The page after the first one's last row."""
    runs = S.runs(spark, sf_dir).where("status = 'running'")
    last = listing.page(runs, ["created_us", "run_id"], 20, peek=False).select("created_us", "run_id").collect()  # a page: 20 rows
    if not last:
        return listing.page(runs, ["created_us", "run_id"], 20).select(*_RUN)
    rest = S.runs(spark, sf_dir, created_from_us=last[-1]["created_us"]).where("status = 'running'")
    return listing.page(rest, ["created_us", "run_id"], 20, tuple(last[-1])).select(*_RUN)


@query(f"""WITH {RUNS}, p AS (SELECT *, row_number() OVER (ORDER BY created_us, run_id) AS n FROM (SELECT * FROM runs WHERE status = 'pending'
 ORDER BY created_us, run_id LIMIT 11)) SELECT {_RUN_SQL}, (SELECT count(*) FROM p) > 10 AS has_more FROM p WHERE n <= 10""")
def runs_page_has_more(spark, sf_dir):
    """A page with its has-more flag."""
    runs = S.runs(spark, sf_dir).where("status = 'pending'")
    return listing.page_with_cursor(runs, ["created_us", "run_id"], 10).select(*_RUN, "has_more")


@query(f"WITH {RUNS} SELECT {_RUN_SQL}, input FROM runs WHERE run_id = 'wrun_0000000007'")
def run_get(spark, sf_dir):
    """Point read by key."""
    return S.runs(spark, sf_dir, run="wrun_0000000007").select(*_RUN, "input")


@query(f"WITH {RUNS} SELECT {_RUN_SQL} FROM runs WHERE run_id IN (SELECT DISTINCT 'wrun_' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') FROM lineitem WHERE l_quantity = 1)")
def runs_get_many(spark, sf_dir):
    """Multi-get: runs of the wanted keys, missing ones absent."""
    wanted = S.step_events(spark, sf_dir).where("l_quantity = 1").select("run_id")
    return listing.get_many(S.runs(spark, sf_dir), "run_id", wanted).select(*_RUN)


@query(f"""WITH {RUNS}, k AS (SELECT 'run:' || workflow_name || ':' || lpad(CAST(created_us // 1000 AS VARCHAR), 13, '0') || ':' || run_id AS key, run_id FROM runs)
 SELECT key, run_id FROM k WHERE starts_with(key, 'run:2-HIGH:') AND key > 'run:2-HIGH:0800000000000' AND key < 'run:2-HIGH:0850000000000' ORDER BY key LIMIT 50""")
def catalog_prefix_range(spark, sf_dir):
    """Prefix range scan with exclusive bounds over catalog keys."""
    runs = S.runs(spark, sf_dir)
    key, _ = X.run_keys({c: F.col(c) for c in runs.columns})
    keyed = runs.select(key.alias("key"), "run_id")
    found = listing.prefix_range(keyed, "key", "run:2-HIGH:", "run:2-HIGH:0800000000000", "run:2-HIGH:0850000000000")
    return found.orderBy("key").limit(50)


@query(f"""WITH {RUNS} SELECT run_id, 'run:' || workflow_name || ':' || lpad(CAST(created_us // 1000 AS VARCHAR), 13, '0') || ':' || run_id AS by_workflow,
 'runall:' || lpad(CAST(created_us // 1000 AS VARCHAR), 13, '0') || ':' || run_id AS by_time FROM runs""")
def catalog_keys(spark, sf_dir):
    """Both catalog keys of every run."""
    runs = S.runs(spark, sf_dir)
    first, second = X.run_keys({c: F.col(c) for c in runs.columns})
    return runs.select("run_id", first.alias("by_workflow"), second.alias("by_time"))


@query(f"""WITH {RUNS}, k AS (SELECT 'runall:' || lpad(CAST(created_us // 1000 AS VARCHAR), 13, '0') || ':' || run_id AS key, run_id FROM runs)
 SELECT key, run_id FROM k ORDER BY key DESC LIMIT 100""")
def catalog_merged_page(spark, sf_dir):
    """The merged catalog list, newest first: per-partition top-k, merged."""
    runs = S.runs(spark, sf_dir)
    _, key = X.run_keys({c: F.col(c) for c in runs.columns})
    return listing.page(runs.select(key.alias("key"), "run_id"), ["key"], 100, descending=True, peek=False)


@query(f"WITH {STEPS} SELECT run_id, step_id, min(at_us) AS created_us FROM steps WHERE run_id = 'wrun_0000000005' GROUP BY run_id, step_id ORDER BY 3, 2 LIMIT 21")
def steps_by_creation(spark, sf_dir):
    """Steps of a run by creation time."""
    steps = S.step_events(spark, sf_dir).where("run_id = 'wrun_0000000005'").groupBy("run_id", "step_id").agg(F.min("at_us").alias("created_us"))
    return listing.page(steps, ["created_us", "step_id"], listing.page_limit(None, "steps"))


@query(f"WITH {EVENTS} SELECT run_id, event_id, event_type, at_us, k FROM ev WHERE run_id = 3 AND k = 7 ORDER BY event_id LIMIT 101")
def events_by_correlation(spark, sf_dir):
    """Events of a run with one correlation id."""
    found = S.run_events(spark, sf_dir).where("run_id = 3 and k = 7").select("run_id", "event_id", "event_type", "at_us", "k")
    return listing.page(found, ["event_id"], listing.page_limit(None, "events", None))


@query(f"WITH {SLOTS} SELECT run_id, event_id, event_type, slot FROM slots WHERE run_id = 5 AND slot > 10 ORDER BY slot LIMIT 100")
def events_page_since(spark, sf_dir):
    """Events after a cursor slot, a page of 100."""
    events = S.run_events(spark, sf_dir).where("run_id = 5")
    numbered = eventlog.slots(events, ["at_us", "event_id"]).select("run_id", "event_id", "event_type", "slot")
    return listing.page(numbered, ["slot"], 100, (10,), peek=False)


@query(f"WITH {RUNS} SELECT run_id, CASE WHEN status = 'completed' AND created_us + {retention.DAY_US} + {RETENTION_US} <= {RUNS_NOW_US} THEN 'expired' WHEN status = 'completed' THEN 'terminal' ELSE 'active' END AS lifecycle FROM runs")
def lifecycle_status(spark, sf_dir):
    """expired, terminal or active for every run."""
    runs = _due_runs(spark, sf_dir)
    expired = runs.where(retention.is_expired(F.col("due_us"), F.lit(RUNS_NOW_US)))
    return listing.lifecycle_status(runs, expired)


@query(f"WITH {RUNS} SELECT status, r.requested, CAST(count(*) AS BIGINT) AS n, (status <> r.requested AND (status = 'completed' OR r.requested = 'pending')) AS excluded FROM runs, (VALUES ('pending'), ('running'), ('completed')) r(requested) GROUP BY status, r.requested")
def status_prefilter(spark, sf_dir):
    """What a stale index status may exclude, by status and request."""
    requested = F.explode(F.array(*map(F.lit, ("pending", "running", "completed"))))
    counted = S.runs(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("requested", requested)
    return counted.select("status", "requested", "n", listing.status_excludes(F.col("status"), F.col("requested")).alias("excluded"))


# -- aggregates, scalars --------------------------------------------------------------------------


@query(f"WITH {RUNS} SELECT status, CAST(count(*) AS BIGINT) AS n, min(created_us) AS first_us, max(created_us) AS last_us FROM runs GROUP BY status")
def runs_by_status(spark, sf_dir):
    """Counts and span by status."""
    return S.runs(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("created_us").alias("first_us"), F.max("created_us").alias("last_us"))


@query(f"""WITH {MESSAGES} SELECT status, CAST(quantile_disc(delay_s, 0.5) AS BIGINT) AS p50, CAST(quantile_disc(delay_s, 0.95) AS BIGINT) AS p95,
 CAST(quantile_disc(delay_s, 0.99) AS BIGINT) AS p99, CAST(max(delay_s) AS BIGINT) AS most FROM messages GROUP BY status""")
def latency_percentiles(spark, sf_dir):
    """Nearest-rank percentiles of delays by outcome."""
    p = [F.expr(f"cast(percentile_disc({q}) within group (order by delay_s) as bigint)").alias(n) for q, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))]
    return S.messages(spark, sf_dir).groupBy("status").agg(*p, F.max("delay_s").alias("most"))


@query(f"""WITH {MESSAGES}, g AS (SELECT status, list_sort(list(delay_s)) AS d FROM messages GROUP BY status)
 SELECT status, CAST(d[least(len(d), CAST(floor(len(d) * 0.95) AS BIGINT) + 1)] AS BIGINT) AS p95 FROM g""")
def latency_floor_percentile(spark, sf_dir):
    """Floor-index percentile (A13) from counts by value, so that no group's values meet in one list."""
    counts = S.messages(spark, sf_dir).groupBy("status", "delay_s").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("status")
    below = F.sum("n").over(w.orderBy("delay_s").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(w)
    at = F.least(total, F.floor(total * 0.95) + 1)
    ranked = counts.withColumn("below", below).withColumn("at", at).where("below >= at")
    return ranked.groupBy("status").agg(F.min("delay_s").alias("p95"))


@query(f"WITH {MESSAGES} SELECT status, CAST(count(*) AS BIGINT) AS n, round(count(*) / greatest((max(enqueued_us) - min(enqueued_us)) / 1000000.0, 0.001), 2) AS per_second FROM messages GROUP BY status")
def enqueue_rate(spark, sf_dir):
    """Rate of messages by outcome."""
    seconds = F.greatest((F.max("enqueued_us") - F.min("enqueued_us")) / 1_000_000.0, F.lit(0.001))
    n = F.count(F.lit(1))
    return S.messages(spark, sf_dir).groupBy("status").agg(n.alias("n"), F.round(n / seconds, 2).alias("per_second"))


_FNV = """recursive h AS (SELECT run_id, 2166136261::BIGINT AS h, 0 AS i FROM runs UNION ALL
 SELECT run_id, (xor(h, CAST(ascii(run_id[i + 1]) AS BIGINT)) * 16777619) & 4294967295, i + 1 FROM h WHERE i < length(run_id)),
 hashed AS (SELECT run_id, h FROM h WHERE i = length(run_id))"""


@query(f"WITH RECURSIVE {RUNS}, {_FNV.removeprefix('recursive ')} SELECT run_id, h AS hash, 'catalog:v1:' || lpad(lower(to_hex(h % 16)), 2, '0') AS shard FROM hashed")
def shard_names(spark, sf_dir):
    """Byte-wise FNV-1a hash and catalog shard of every run."""
    run = F.col("run_id")
    return S.runs(spark, sf_dir).select("run_id", X.fnv1a_bytes(run).alias("hash"), X.shard_name("catalog", run, X.CATALOG_SHARDS).alias("shard"))


@query(f"WITH RECURSIVE {RUNS}, {_FNV.removeprefix('recursive ')}, g AS (SELECT h % 16 AS s, count(*) AS n FROM hashed GROUP BY 1) SELECT CAST(count(*) AS BIGINT) AS shards, CAST(min(n) AS BIGINT) AS least, CAST(max(n) AS BIGINT) AS most, CAST(sum(n) AS BIGINT) AS total FROM g")
def shard_distribution(spark, sf_dir):
    """How evenly runs are dealt over shards."""
    g = S.runs(spark, sf_dir).groupBy((X.fnv1a_bytes(F.col("run_id")) % X.CATALOG_SHARDS).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("shards"), F.min("n").alias("least"), F.max("n").alias("most"), F.sum("n").alias("total"))


@query(f"WITH RECURSIVE {RUNS}, {_FNV.removeprefix('recursive ')} SELECT run_id, h % 4 AS shard FROM hashed")
def queue_shards(spark, sf_dir):
    """Queue shard by UTF-16 FNV-1a (equal to the byte hash on ASCII keys; for others see ``queue_shards_beyond_ascii``)."""
    return S.runs(spark, sf_dir).select("run_id", X.queue_shard(F.col("run_id"), 4).alias("shard"))


@query(f"WITH {MESSAGES} SELECT DISTINCT delay_s % 20 AS attempt, CAST(least(60, pow(2, delay_s % 20)) AS BIGINT) AS delivery_s, CAST(least(3600000, 1000 * pow(2, least(greatest(delay_s % 20, 1) - 1, 12))) AS BIGINT) AS cleanup_ms FROM messages")
def backoffs(spark, sf_dir):
    """Delivery and cleanup backoffs by the attempts that messages have."""
    attempts, a = S.messages(spark, sf_dir).select((F.col("delay_s") % 20).alias("attempt")).distinct(), F.col("attempt")
    return attempts.select("attempt", X.backoff_seconds(a).alias("delivery_s"), X.cleanup_backoff_ms(F.greatest(a, F.lit(1))).alias("cleanup_ms"))


@query(f"WITH {RUNS} SELECT run_id, strftime(make_timestamp(created_us), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(created_us // 1000 % 1000 AS VARCHAR), 3, '0') || 'Z' AS iso, lpad(CAST(created_us // 1000 AS VARCHAR), 13, '0') AS padded, created_us // 1000 AS back FROM runs")
def time_keys(spark, sf_dir):
    """ISO and padded time keys and their inverse."""
    ms = X.padded_ms(X.epoch_millis(F.col("created_at")))
    return S.runs(spark, sf_dir).select("run_id", X.iso_ms(F.col("created_at")).alias("iso"), ms.alias("padded"), X.ms_of_padded(ms).alias("back"))


@query(f"WITH {EVENTS} SELECT event_id, json_extract_string(props, '$.k') AS extracted, coalesce(CASE WHEN e.value < 20 THEN NULL ELSE CAST(e.event_type AS VARCHAR) END, 'Unknown error') AS message, CASE WHEN e.event_type = 'click' THEN props END AS payload FROM events e".replace("WITH " + EVENTS + " ", ""))
def event_projection(spark, sf_dir):
    """JSON extraction, error normalisation and payload stripped by type."""
    e = S.table(spark, sf_dir, "events")
    message = X.structured_error(F.when(F.col("value") >= 20, F.col("event_type")))
    payload = F.when(F.col("event_type") == "click", F.col("props"))
    return e.select("event_id", F.get_json_object("props", "$.k").alias("extracted"), message.alias("message"), payload.alias("payload"))


# -- event log ------------------------------------------------------------------------------------


@query(f"WITH {SLOTS} SELECT run_id, event_id, event_type, slot FROM slots")
def event_slots(spark, sf_dir):
    """Dense slots of every run's log."""
    return eventlog.slots(S.run_events(spark, sf_dir), ["at_us", "event_id"]).select("run_id", "event_id", "event_type", "slot")


@query(f"WITH {SLOTS} SELECT run_id, CAST(6 AS BIGINT) AS from_slot, max(slot) - 1 AS to_slot FROM slots GROUP BY run_id HAVING max(slot) - 1 >= 6")
def skipped_slots(spark, sf_dir):
    """Slots between a client that has five and the newest."""
    numbered = eventlog.slots(S.run_events(spark, sf_dir), ["at_us", "event_id"])
    return eventlog.skipped_slots(numbered, F.lit(5).cast("long"))


@query(f"WITH {STEPS}, n AS (SELECT run_id, step_id, row_number() OVER (PARTITION BY run_id, step_id ORDER BY {STEP_ORDER}) AS n FROM steps) SELECT run_id, step_id, CAST(count(*) FILTER (WHERE n = 1) AS BIGINT) AS accepted, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS rejected FROM n GROUP BY run_id, step_id")
def step_dedup(spark, sf_dir):
    """Step creations accepted and rejected as conflicts."""
    judged = eventlog.first_accepted(S.step_events(spark, sf_dir), ["run_id", "step_id"], list(S.STEP_ORDER))
    accepted = F.col("outcome") == "appended"
    return judged.groupBy("run_id", "step_id").agg(F.count(F.when(accepted, 1)).alias("accepted"), F.count(F.when(~accepted, 1)).alias("rejected"))


_ENDS = "('run_completed', 'run_failed', 'run_cancelled')"


@query(f"WITH {SLOTS} SELECT run_id, min(slot) AS terminal_slot, arg_min(event_type, slot) AS terminal_type FROM slots WHERE event_type IN {_ENDS} GROUP BY run_id")
def first_terminal(spark, sf_dir):
    """First terminal event of each run."""
    return eventlog.first_terminal(eventlog.slots(S.run_events(spark, sf_dir), ["at_us", "event_id"]))


_GUARD = f"""{EVENTS}, r AS (SELECT * FROM ev WHERE event_type LIKE 'run_%'), slots AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY at_us, event_id) AS slot FROM r),
 t AS (SELECT run_id, min(slot) AS ts, arg_min(event_type, slot) AS tt FROM slots WHERE event_type IN {_ENDS} GROUP BY run_id),
 j AS (SELECT s.*, coalesce(slot > ts, false) AS after, tt, sum(CASE WHEN event_type = 'run_started' THEN 1 ELSE 0 END) OVER (PARTITION BY s.run_id ORDER BY slot) AS starts FROM slots s LEFT JOIN t ON s.run_id = t.run_id),
 o AS (SELECT *, CASE WHEN after AND event_type = 'run_started' THEN 'RUN_EXPIRED' WHEN after AND event_type = 'run_cancelled' AND tt = 'run_cancelled' THEN 'appended'
 WHEN after THEN 'ENTITY_CONFLICT' WHEN event_type = 'run_started' AND starts > 1 THEN 'replay' ELSE 'appended' END AS outcome FROM j)"""


def _run_family(spark, sf_dir):
    return S.run_events(spark, sf_dir).where(F.col("event_type").startswith("run_"))


@query(f"WITH {_GUARD} SELECT run_id, event_id, event_type, outcome FROM o")
def terminal_guard(spark, sf_dir):
    """Outcome of every run event under the terminal guard."""
    numbered = eventlog.slots(_run_family(spark, sf_dir), ["at_us", "event_id"])
    return eventlog.terminal_guard(numbered).select("run_id", "event_id", "event_type", "outcome")


@query(f"WITH {_GUARD} SELECT run_id, CAST(count(*) AS BIGINT) AS n FROM o WHERE event_type = 'run_cancelled' AND outcome = 'appended' AND after GROUP BY run_id")
def cancelled_replay(spark, sf_dir):
    """Cancels appended again on cancelled runs."""
    numbered = eventlog.slots(_run_family(spark, sf_dir), ["at_us", "event_id"])
    ends = eventlog.first_terminal(numbered)
    again = eventlog.terminal_guard(numbered).where("event_type = 'run_cancelled' and outcome = 'appended'").join(ends, "run_id")
    return again.where("slot > terminal_slot").groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


def _fold_input(spark, sf_dir) -> DataFrame:
    """Events for the general fold: starts carry run input, step starts are lazy and reuse ids, hooks are never created."""
    e = S.run_events(spark, sf_dir)
    is_step = F.col("event_type") == "step_started"
    return e.select(
        "run_id", F.col("event_id").alias("seq"), "event_type", "at_us", F.concat(F.lit("c"), (F.col("k") % 7).cast("string")).alias("corr"),
        F.when(is_step, F.lit("step")).alias("step_name"), is_step.alias("has_input"), (F.col("event_type") == "run_started").alias("has_run_input"),
    )


_FOLD = f"""{SLOTS}, s AS (SELECT run_id, min(slot) AS start FROM slots WHERE event_type = 'run_started' GROUP BY run_id),
 t AS (SELECT x.run_id, min(x.slot) AS ts, arg_min(x.event_type, x.slot) AS tt FROM slots x JOIN s ON x.run_id = s.run_id WHERE x.slot > s.start AND x.event_type IN {_ENDS} GROUP BY x.run_id),
 j AS (SELECT x.*, 'c' || CAST(k % 7 AS VARCHAR) AS corr, coalesce(x.slot >= s.start, false) AS has, coalesce(x.slot > t.ts, false) AS after, tt, x.slot = s.start AS boots,
  x.slot > s.start AND coalesce(x.slot <= t.ts, true) AS live FROM slots x LEFT JOIN s ON x.run_id = s.run_id LEFT JOIN t ON x.run_id = t.run_id),
 f AS (SELECT *, min(CASE WHEN event_type = 'step_started' AND live THEN slot END) OVER (PARTITION BY run_id, corr) AS made FROM j),
 o AS (SELECT *, CASE WHEN event_type = 'hook_received' THEN 'HOOK_NOT_FOUND'
 WHEN event_type = 'step_started' AND after THEN 'ENTITY_CONFLICT' WHEN event_type = 'step_started' AND NOT has THEN 'RUN_NOT_FOUND'
 WHEN event_type = 'step_started' AND slot > made THEN 'ENTITY_CONFLICT' WHEN event_type = 'step_started' THEN 'appended'
 WHEN after AND event_type = 'run_started' THEN 'RUN_EXPIRED' WHEN after AND event_type = 'run_cancelled' AND tt = 'run_cancelled' THEN 'appended'
 WHEN after THEN 'ENTITY_CONFLICT' WHEN NOT has THEN 'RUN_NOT_FOUND' WHEN event_type = 'run_started' AND NOT boots THEN 'replay' ELSE 'appended' END AS outcome FROM f),
 a AS (SELECT *, CASE WHEN outcome <> 'appended' THEN 0 WHEN event_type = 'step_started' OR boots THEN 2 ELSE 1 END AS n FROM o)"""


@query(f"WITH {_FOLD} SELECT run_id, event_id AS seq, event_type, outcome, CAST(n AS BIGINT) AS n_appended, CAST(sum(n) OVER (PARTITION BY run_id ORDER BY slot) AS BIGINT) AS slot FROM a")
def fold_outcomes(spark, sf_dir):
    """General fold over a mix of starts with input, lazy steps, hooks and ends."""
    folded = eventlog.fold(_fold_input(spark, sf_dir))
    return folded.select("run_id", "seq", "event_type", "outcome", F.size("appended").cast("long").alias("n_appended"), "slot")


@query(f"""WITH {_FOLD} SELECT run_id, coalesce(CASE max(tt) WHEN 'run_completed' THEN 'completed' WHEN 'run_failed' THEN 'failed' WHEN 'run_cancelled' THEN 'cancelled' END, 'running') AS status,
 CAST(sum(n) AS BIGINT) AS n_events FROM a WHERE has GROUP BY run_id""")
def fold_runs(spark, sf_dir):
    """Runs as aggregations over the log that the fold wrote."""
    log = eventlog.appended(eventlog.fold(_fold_input(spark, sf_dir)))
    return eventlog.run_states(log).select("run_id", "status", "n_events")


@query(f"WITH {_FOLD} SELECT run_id, corr AS step_id, 'running' AS status, CAST(1 AS BIGINT) AS attempt, min(at_us) AS started_us FROM a WHERE event_type = 'step_started' AND outcome = 'appended' GROUP BY run_id, corr")
def fold_steps(spark, sf_dir):
    """Steps as aggregations over the log."""
    log = eventlog.appended(eventlog.fold(_fold_input(spark, sf_dir)))
    return eventlog.step_states(log).select("run_id", "step_id", "status", "attempt", "started_us")


@query(f"WITH {EVENTS}, r AS (SELECT *, 'r' || CAST(k % 10 AS VARCHAR) AS resume_id, 'h' || CAST(k % 2 AS VARCHAR) AS corr, CASE WHEN k % 3 = 0 THEN NULL ELSE 'd' || CAST(k % 4 AS VARCHAR) END AS digest FROM ev WHERE event_type = 'hook_received'), w AS (SELECT *, row_number() OVER p AS n, first_value(corr) OVER p AS c1, first_value(digest) OVER p AS d1 FROM r WINDOW p AS (PARTITION BY run_id, resume_id ORDER BY at_us, event_id)) SELECT run_id, event_id, CASE WHEN n = 1 THEN 'appended' WHEN c1 <> corr OR coalesce(d1 <> digest, false) THEN 'ENTITY_CONFLICT' ELSE 'replay' END AS outcome FROM w")
def resume_dedup(spark, sf_dir):
    """Resumes by id: first, replay or conflict."""
    k = F.col("k")
    e = S.run_events(spark, sf_dir).where("event_type = 'hook_received'").select(
        "run_id", "event_id", "at_us", F.concat(F.lit("r"), (k % 10).cast("string")).alias("resume_id"), F.concat(F.lit("h"), (k % 2).cast("string")).alias("corr"),
        F.when(k % 3 != 0, F.concat(F.lit("d"), (k % 4).cast("string"))).alias("digest"),
    )
    return eventlog.resume_dedup(e, ["at_us", "event_id"]).select("run_id", "event_id", "outcome")


@query(f"WITH {STEPS} SELECT run_id, l_returnflag AS key, arg_max(l_linestatus, (l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus)) AS value FROM steps GROUP BY run_id, l_returnflag")
def attributes_latest(spark, sf_dir):
    """Run attributes after all changes."""
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
    changes = S.step_events(spark, sf_dir).withColumns({"key": F.col("l_returnflag"), "value": F.col("l_linestatus")})
    return eventlog.latest_attributes(changes, order)


@query(f"WITH {SLOTS}, ends AS (SELECT DISTINCT run_id FROM ev WHERE event_type = 'run_cancelled') SELECT e.run_id, e.event_id FROM ev e WHERE event_type = 'hook_received' AND run_id NOT IN (SELECT run_id FROM ends)")
def unreleased_hooks(spark, sf_dir):
    """Hook events of runs that were not cancelled; which hooks live is in ``live_hooks``."""
    e = S.run_events(spark, sf_dir)
    ended = e.where("event_type = 'run_cancelled'").select("run_id").distinct()
    return listing.fenced(e.where("event_type = 'hook_received'"), ended).select("run_id", "event_id")


# -- ownership ------------------------------------------------------------------------------------


@query(f"WITH {HOOKS} SELECT token, arg_min(hook_id, (at_us, hook_id)) AS hook_id, arg_min(run_id, (at_us, hook_id)) AS run_id, CAST(count(*) AS BIGINT) AS n_claims FROM hooks GROUP BY token")
def hook_token_owners(spark, sf_dir):
    """Owner of each token: its first claim."""
    return ownership.owners(S.hooks(spark, sf_dir), "token", ["at_us", "hook_id"], ["hook_id", "run_id"])


@query(f"WITH {HOOKS}, o AS (SELECT token, arg_min(run_id, (at_us, hook_id)) AS holder FROM hooks GROUP BY token) SELECT h.hook_id, h.run_id, h.token, o.holder FROM hooks h JOIN o ON h.token = o.token WHERE o.holder <> h.run_id")
def hook_conflicts(spark, sf_dir):
    """Claims that become conflicts, with the run that holds the token."""
    return ownership.conflicts(S.hooks(spark, sf_dir), "token", ["at_us", "hook_id"], "run_id").select("hook_id", "run_id", "token", "holder")


@query(f"""WITH {HOOKS}, c AS (SELECT *, 'id_' || CAST(hook_id % 50 AS VARCHAR) AS wanted FROM hooks), o AS (SELECT token, arg_min(run_id, (at_us, hook_id)) AS holder FROM c GROUP BY token),
 a AS (SELECT c.*, o.holder FROM c JOIN o ON c.token = o.token), i AS (SELECT wanted, arg_min(run_id, (at_us, hook_id)) AS id_holder FROM a WHERE holder = run_id GROUP BY wanted)
 SELECT hook_id, a.run_id, token, CASE WHEN holder <> run_id THEN 'token_conflict' WHEN id_holder <> run_id THEN 'id_conflict' ELSE 'published' END AS outcome FROM a LEFT JOIN i ON a.wanted = i.wanted""")
def hook_admission(spark, sf_dir):
    """Two-domain admission: token, then hook id."""
    claims = S.hooks(spark, sf_dir).withColumn("wanted", F.concat(F.lit("id_"), (F.col("hook_id") % 50).cast("string")))
    return ownership.two_domain_admission(claims, "token", "wanted", ["at_us", "hook_id"], "run_id").select("hook_id", "run_id", "token", "outcome")


@query(f"WITH {HOOKS} SELECT hook_id, CASE WHEN at_us // 1000 + {ownership.HOOK_CLAIM_MS} > {EVENTS_NOW_US // 1000} THEN 'live' ELSE 'expired' END AS state FROM hooks WHERE at_us <= {EVENTS_NOW_US}")
def hook_claim_leases(spark, sf_dir):
    """Claims live or expired at a moment."""
    ms = F.floor(F.col("at_us") / 1000).cast("long")
    hooks = S.hooks(spark, sf_dir).where(F.col("at_us") <= EVENTS_NOW_US)
    return hooks.select("hook_id", ownership.claim_state(ms, F.lit(EVENTS_NOW_US // 1000)).alias("state"))


@query(f"WITH {RUNS} SELECT run_id, (created_us // 1000 > {RUNS_NOW_US // 1000 - 600000} AND created_us // 1000 <= {RUNS_NOW_US // 1000 - 600000} + 1200900) AS stored FROM runs WHERE created_us // 1000 BETWEEN {RUNS_NOW_US // 1000 - 10**9} AND {RUNS_NOW_US // 1000 + 10**9}")
def publication_leases(spark, sf_dir):
    """Which publications fall in their lease window."""
    now = RUNS_NOW_US // 1000
    ms = X.epoch_millis(F.col("created_at"))
    near = S.runs(spark, sf_dir).where(ms.between(now - 10**9, now + 10**9))
    return near.select("run_id", ownership.publication_allowed(ms, F.lit(now - 600_000)).alias("stored"))


@query(f"WITH {HOOKS}, {RUNS}, o AS (SELECT token, arg_min(hook_id, (at_us, hook_id)) AS hook_id, arg_min(run_id, (at_us, hook_id)) AS run_key FROM hooks GROUP BY token) SELECT token, hook_id, o.run_key AS run_id FROM o WHERE 'wrun_' || lpad(CAST(run_key AS VARCHAR), 10, '0') IN (SELECT run_id FROM runs WHERE status <> 'completed')")
def visible_hook_tokens(spark, sf_dir):
    """Tokens whose owner is an active run."""
    owned = ownership.owners(S.hooks(spark, sf_dir), "token", ["at_us", "hook_id"], ["hook_id", "run_id"])
    keyed = owned.withColumn("key", S.run_id(F.col("run_id")))
    return listing.active_only(keyed, S.runs(spark, sf_dir).withColumnRenamed("run_id", "key"), "key").select("token", "hook_id", "run_id")


# -- streams --------------------------------------------------------------------------------------


@query(f"WITH {CHUNKS}, c AS (SELECT *, row_number() OVER w AS n, sum(size) OVER w AS b FROM chunks WINDOW w AS (PARTITION BY stream ORDER BY idx)) SELECT stream, idx, CAST(size AS BIGINT) AS size FROM c WHERE n <= 32 AND b <= 1500")
def stream_read_budget(spark, sf_dir):
    """Bounded read of every stream: the prefix within 1,500 bytes."""
    return streams.read(S.stream_chunks(spark, sf_dir), max_bytes=1500).select("stream", "idx", "size")


@query(f"WITH {CHUNKS} SELECT stream, CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(size) AS BIGINT) AS bytes, CAST(count(*) - 1 AS BIGINT) AS tail_index, false AS done FROM chunks GROUP BY stream")
def stream_info(spark, sf_dir):
    """Count, bytes and tail of every stream."""
    return streams.info(S.stream_chunks(spark, sf_dir))


@query(f"WITH {CHUNKS}, t AS (SELECT stream, greatest(max(idx) + 1 - 2, 0) AS start FROM chunks GROUP BY stream) SELECT c.stream, c.idx FROM chunks c JOIN t ON c.stream = t.stream WHERE c.idx >= t.start")
def stream_tail(spark, sf_dir):
    """The last two chunks of every stream."""
    return streams.tail(S.stream_chunks(spark, sf_dir), -2).select("stream", "idx")


@query(f"WITH {CHUNKS} SELECT stream, idx, role FROM chunks WHERE stream = 4 AND idx >= 1 ORDER BY idx LIMIT 3")
def stream_page(spark, sf_dir):
    """A page of chunks of one stream."""
    return streams.page(S.stream_chunks(spark, sf_dir), 4, 3, 1).select("stream", "idx", "role")


@query(f"WITH {CHUNKS}, c AS (SELECT *, row_number() OVER w AS n, sum(size) OVER w AS b FROM chunks WINDOW w AS (PARTITION BY stream ORDER BY idx)) SELECT stream, idx FROM c WHERE n = 1 OR (n <= 64 AND b <= 700)")
def stream_delete_budget(spark, sf_dir):
    """What one deletion takes of every stream: the first chunk always."""
    return streams.deletion_page(S.stream_chunks(spark, sf_dir), max_bytes=700).select("stream", "idx")


@query(f"WITH {CHUNKS}, g AS (SELECT stream, count(*) AS n, max(size) AS largest, sum(size) AS total FROM chunks GROUP BY stream) SELECT stream, CAST(n AS BIGINT) AS n, CAST(largest AS BIGINT) AS largest, CAST(total AS BIGINT) AS total, n <= 32 AND largest <= 1048576 AND total <= 8388608 AS valid FROM g")
def stream_write_flags(spark, sf_dir):
    """Whether each write keeps its bounds."""
    return streams.write_flags(S.stream_chunks(spark, sf_dir), ["stream"])


@query(f"""WITH RECURSIVE {CHUNKS}, b AS (SELECT stream, idx, 0::BIGINT AS batch, 1::BIGINT AS n, size::BIGINT AS bytes FROM chunks WHERE idx = 0 UNION ALL
 SELECT c.stream, c.idx, CASE WHEN b.n >= 3 OR b.bytes + c.size > 600 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.n >= 3 OR b.bytes + c.size > 600 THEN 1 ELSE b.n + 1 END,
 CASE WHEN b.n >= 3 OR b.bytes + c.size > 600 THEN c.size ELSE b.bytes + c.size END FROM b JOIN chunks c ON c.stream = b.stream AND c.idx = b.idx + 1)
 SELECT stream, idx, batch FROM b""")
def stream_split_batches(spark, sf_dir):
    """Greedy cut of every stream into write batches."""
    return streams.split_batches(S.stream_chunks(spark, sf_dir), 3, 600)


@query(f"WITH {CHUNKS}, c AS (SELECT stream, count(*) AS n FROM chunks GROUP BY stream), a AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY idx) AS k FROM chunks WHERE role = 'user') SELECT a.stream, a.idx AS arrival, CAST(c.n + a.k - 1 AS BIGINT) AS idx FROM a JOIN c ON a.stream = c.stream")
def stream_append(spark, sf_dir):
    """Indexes given to appended chunks."""
    chunks = S.stream_chunks(spark, sf_dir)
    arrivals = chunks.where("role = 'user'").select("stream", F.col("idx").alias("arrival"))
    return streams.append(arrivals, streams.info(chunks), ["arrival"]).select("stream", "arrival", "idx")


@query(f"WITH {EVENTS}, c AS (SELECT run_id AS stream, event_id AS seq, CASE WHEN event_type = 'run_completed' THEN 'closed' ELSE 'errored' END AS state FROM ev WHERE event_type IN ('run_completed', 'run_failed')) SELECT stream, arg_min(state, seq) AS state, CAST(count(*) - 1 AS BIGINT) AS n_ignored FROM c GROUP BY stream")
def stream_final_state(spark, sf_dir):
    """First close or failure wins."""
    e = S.run_events(spark, sf_dir).where("event_type in ('run_completed', 'run_failed')")
    changes = e.select(F.col("run_id").alias("stream"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "run_completed", "closed").otherwise("errored").alias("state"))
    return streams.final_state(changes).withColumn("n_ignored", F.col("n_ignored").cast("long"))


@query(f"WITH {RUNS} SELECT DISTINCT run_id, 'str_' || lower(deployment_id) AS stream FROM runs")
def stream_registry(spark, sf_dir):
    """Registered streams of each run, distinct."""
    runs = S.runs(spark, sf_dir)
    return streams.register(runs.select("run_id", F.concat(F.lit("str_"), F.lower("deployment_id")).alias("stream")))


# -- queue ----------------------------------------------------------------------------------------


def _queued(spark, sf_dir):
    m = S.messages(spark, sf_dir)
    return m.withColumn("due_us", queues.due_us(F.col("enqueued_us"), F.col("delay_s"))).withColumn("shard", F.col("idempotency_key") % 4)


_QUEUED = MESSAGES + ", q AS (SELECT *, enqueued_us + greatest(0, delay_s) * 1000000 AS due_us, idempotency_key % 4 AS shard FROM messages)"


@query(f"WITH {DELIVERED}, a AS (SELECT *, CASE WHEN outcome IN ('retry', 'dead') THEN attempt + 1 ELSE attempt END AS attempt_after FROM delivered) SELECT message_id, outcome, CAST(attempt_after AS BIGINT) AS attempt_after, CAST({EVENTS_NOW_US} + 1000000 * CASE outcome WHEN 'redeliver' THEN timeout_s WHEN 'retry' THEN least(60, pow(2, attempt_after)) END AS BIGINT) AS next_due_us, outcome IN ('retry', 'redeliver') AS holds_key FROM a")
def delivery_outcomes(spark, sf_dir):
    """Every message after one delivery."""
    done = queues.deliver(S.messages(spark, sf_dir), EVENTS_NOW_US)
    return done.select("message_id", "outcome", "attempt_after", "next_due_us", "holds_key")


@query(f"WITH {DELIVERED} SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM delivered GROUP BY outcome")
def delivery_summary(spark, sf_dir):
    """Conservation: messages by outcome."""
    return queues.deliver(S.messages(spark, sf_dir), EVENTS_NOW_US).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {DELIVERED} SELECT message_id, enqueued_us AS failed_us FROM delivered WHERE outcome = 'dead' ORDER BY enqueued_us, message_id LIMIT 101")
def dlq_page(spark, sf_dir):
    """First page of dead letters by (failed, id)."""
    dead = queues.deliver(S.messages(spark, sf_dir), EVENTS_NOW_US).where("outcome = 'dead'")
    return listing.page(dead.select("message_id", F.col("enqueued_us").alias("failed_us")), ["failed_us", "message_id"], listing.page_limit(None, "dead_letters"))


@query(f"WITH {_QUEUED}, r AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY due_us, message_id) AS n FROM q WHERE due_us <= {EVENTS_NOW_US}) SELECT message_id, shard, due_us FROM r WHERE n <= 5")
def queue_due_topk(spark, sf_dir):
    """What each shard claims next: five due messages."""
    return queues.claim(_queued(spark, sf_dir), EVENTS_NOW_US, "shard").select("message_id", "shard", "due_us")


@query(f"""WITH {_QUEUED} SELECT shard, CAST(count(*) FILTER (WHERE attempt < 5) AS BIGINT) AS pending, CAST(count(*) FILTER (WHERE attempt < 5 AND due_us <= {EVENTS_NOW_US}) AS BIGINT) AS due,
 CAST(count(*) FILTER (WHERE attempt >= 5) AS BIGINT) AS dead_letters, greatest(min(due_us) FILTER (WHERE attempt < 5), {EVENTS_NOW_US + 1}) AS next_timer_us FROM q GROUP BY shard""")
def queue_stats(spark, sf_dir):
    """Stats and next timer by shard."""
    return queues.stats(_queued(spark, sf_dir), EVENTS_NOW_US, "shard")


@query(f"WITH {_QUEUED} SELECT message_id, {EVENTS_NOW_US // 1000} AS due_ms FROM q WHERE due_us // 1000 + 330000 <= {EVENTS_NOW_US // 1000} AND status = 0")
def expired_leases(spark, sf_dir):
    """Deliveries whose lease ran out, due again now."""
    flying = _queued(spark, sf_dir).where("status = 0").withColumn("claimed_ms", F.floor(F.col("due_us") / 1000).cast("long"))
    return queues.expired_leases(flying, EVENTS_NOW_US // 1000).select("message_id", "due_ms")


@query(f"WITH {MESSAGES}, f AS (SELECT idempotency_key, arg_min(message_id, (enqueued_us, message_id)) AS original_id FROM messages GROUP BY 1) SELECT m.message_id, f.original_id, m.message_id = f.original_id AS accepted FROM messages m JOIN f ON m.idempotency_key = f.idempotency_key")
def enqueue_dedup(spark, sf_dir):
    """Idempotent enqueue where first messages are held for good; ``enqueue_while_active`` releases them."""
    return queues.dedup(S.messages(spark, sf_dir)).select("message_id", "original_id", "accepted")


@query(f"WITH {MESSAGES}, g AS (SELECT message_id, enqueued_us - lag(enqueued_us) OVER (PARTITION BY idempotency_key ORDER BY enqueued_us, message_id) AS gap FROM messages) SELECT message_id, coalesce(gap >= 3600000000, true) AS accepted FROM g")
def inflight_by_staleness(spark, sf_dir):
    """In-flight claims refused while the last use is younger than an hour."""
    return queues.accepted_by_gap(S.messages(spark, sf_dir), 3_600_000_000).select("message_id", "accepted")


@query(f"""WITH {DELIVERED}, h AS (SELECT idempotency_key, min(message_id) AS holder FROM delivered WHERE outcome = 'redeliver' GROUP BY 1)
 SELECT d.message_id, h.holder IS NULL OR h.holder = d.message_id AS redriven, CAST(CASE WHEN h.holder IS NULL OR h.holder = d.message_id THEN 0 ELSE attempt END AS BIGINT) AS attempt,
 CASE WHEN h.holder IS NULL OR h.holder = d.message_id THEN {EVENTS_NOW_US} END AS due_us FROM delivered d LEFT JOIN h ON d.idempotency_key = h.idempotency_key WHERE outcome = 'dead'""")
def redrive(spark, sf_dir):
    """Dead letters redriven or refused because a live message owns the key."""
    done = queues.deliver(S.messages(spark, sf_dir), EVENTS_NOW_US)
    out = queues.redrive(done.where("outcome = 'dead'"), done.where("outcome = 'redeliver'"), EVENTS_NOW_US)
    return out.select("message_id", "redriven", "attempt", "due_us")


@query(f"WITH {MESSAGES} SELECT idempotency_key, CAST(count(*) AS BIGINT) AS n_deleted FROM messages GROUP BY 1 HAVING min(enqueued_us) + {QUEUE_AGE_US} <= {EVENTS_NOW_US}")
def queue_expiry_receipts(spark, sf_dir):
    """Receipts of messages deleted with the runs whose age is over."""
    m = S.messages(spark, sf_dir)
    _, receipts = queues.expire_runs(m, aged_keys(m), "idempotency_key")
    return receipts


def aged_keys(messages: DataFrame) -> DataFrame:
    """Keys whose first message is older than QUEUE_AGE_US."""
    first = messages.groupBy("idempotency_key").agg(F.min("enqueued_us").alias("first_us"))
    return first.where(F.col("first_us") + QUEUE_AGE_US <= EVENTS_NOW_US)


# -- retention ------------------------------------------------------------------------------------


def _due_runs(spark, sf_dir, age_us: int | None = None) -> DataFrame:
    runs = S.runs(spark, sf_dir).withColumn("completed_us", F.when(F.col("status") == "completed", F.col("created_us") + retention.DAY_US))
    return retention.deadline(runs, RETENTION_US, age_us, RUNS_NOW_US)


@query(f"WITH {DUE} SELECT run_id, terminal_due_us, least(terminal_due_us, CASE WHEN created_us + {4 * RETENTION_US} <= {RUNS_NOW_US} THEN created_us + {4 * RETENTION_US} END) AS due_us FROM dl")
def retention_due(spark, sf_dir):
    """Terminal and effective deadlines of every run."""
    return _due_runs(spark, sf_dir, 4 * RETENTION_US).select("run_id", "terminal_due_us", "due_us")


@query(f"WITH {DUE} SELECT run_id, status FROM dl WHERE terminal_due_us IS NULL OR terminal_due_us > {RUNS_NOW_US}")
def visible_runs(spark, sf_dir):
    """Runs that are not expired."""
    return retention.visible(_due_runs(spark, sf_dir), RUNS_NOW_US).select("run_id", "status")


_SWEEP = f"""{DUE}, sw AS (SELECT run_id, CASE WHEN terminal_due_us <= {RUNS_NOW_US - RETENTION_US} THEN 'expired' WHEN terminal_due_us <= {RUNS_NOW_US} THEN 'scheduled' ELSE 'not-due' END AS state
 FROM dl WHERE created_us <= {RUNS_NOW_US - RETENTION_US})"""


def _sweep(spark, sf_dir) -> DataFrame:
    runs = _due_runs(spark, sf_dir)
    gone = runs.where(retention.is_expired(F.col("due_us"), F.lit(RUNS_NOW_US - RETENTION_US)))
    return retention.sweep_state(runs, gone, RUNS_NOW_US, RETENTION_US)


@query(f"WITH {_SWEEP} SELECT run_id, state FROM sw")
def retention_sweep(spark, sf_dir):
    """State of every sweep candidate."""
    return _sweep(spark, sf_dir).select("run_id", "state")


@query(f"WITH {_SWEEP} SELECT state, CAST(count(*) AS BIGINT) AS n FROM sw GROUP BY state")
def retention_histogram(spark, sf_dir):
    """Sweep candidates by state."""
    return retention.histogram(_sweep(spark, sf_dir))


@query(f"""WITH {DUE}, {STEPS}, x AS (SELECT run_id, terminal_due_us AS due_us FROM dl WHERE terminal_due_us <= {RUNS_NOW_US}), s AS (SELECT run_id, count(*) AS n FROM steps GROUP BY 1),
 {MESSAGES}, m AS (SELECT 'wrun_' || lpad(CAST(idempotency_key AS VARCHAR), 10, '0') AS run_id, count(*) AS n FROM messages GROUP BY 1)
 SELECT x.run_id, due_us, 'tombstoned' AS phase, CAST(coalesce(s.n, 0) AS BIGINT) AS payload_keys_deleted, CAST(1 AS BIGINT) AS streams_deleted, CAST(coalesce(m.n, 0) AS BIGINT) AS messages_deleted,
 {RUNS_NOW_US} AS tombstoned_us FROM x LEFT JOIN s ON x.run_id = s.run_id LEFT JOIN m ON x.run_id = m.run_id""")
def tombstones(spark, sf_dir):
    """Tombstones with cleanup accounting."""
    runs = _due_runs(spark, sf_dir)
    records = retention.cleanup_records(runs, RUNS_NOW_US)
    messages = S.messages(spark, sf_dir).select(S.message_run(F.col("idempotency_key")).alias("run_id"))
    out = retention.account(records, S.step_events(spark, sf_dir), runs.select("run_id"), messages, RUNS_NOW_US)
    return out.select("run_id", "due_us", "phase", "payload_keys_deleted", "streams_deleted", "messages_deleted", "tombstoned_us")


@query(f"WITH {DUE}, {STEPS} SELECT run_id, step_id, CAST(count(*) AS BIGINT) AS n FROM steps WHERE run_id NOT IN (SELECT run_id FROM dl WHERE terminal_due_us <= {RUNS_NOW_US}) GROUP BY run_id, step_id")
def steps_after_purge(spark, sf_dir):
    """Steps that outlive their runs' retention."""
    runs = _due_runs(spark, sf_dir)
    gone = runs.where(retention.is_expired(F.col("due_us"), F.lit(RUNS_NOW_US)))
    return retention.purge(eventlog.by_run(S.step_events(spark, sf_dir).select("run_id", "step_id")), gone).groupBy("run_id", "step_id").agg(F.count(F.lit(1)).alias("n"))
