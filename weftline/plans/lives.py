"""Registered queries of what runs over a life: queue cells, ids, attributes, event forms, paged disposal."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import forms
from weftline.functions import scalars as X
from weftline.functions.transitions import Limits
from weftline.operators import disposal, eventlog, numbering, queue_life, queues, streams
from weftline.plans.lifecycle import _STEP_RESULTS, _STEPS, _lines, _step_log, _steps
from weftline.plans.queries import EVENTS, SLOTS, query
from weftline.sources import fixtures as S

# -- queue cells ----------------------------------------------------------------------------------

_MESSAGE = "STRUCT(id BIGINT, k VARCHAR, a BIGINT, due BIGINT, l BIGINT, e BIGINT)"
_ROW = "STRUCT(message_id BIGINT, what VARCHAR, original_id BIGINT, attempt BIGINT, lease BIGINT, due_ms BIGINT)"


def _m(id="z.id", k="z.k", a="z.a", due="z.due", l="z.l", e="z.e"):  # noqa: A002, E741
    return f"CAST(struct_pack(id := {id}, k := {k}, a := {a}, due := {due}, l := {l}, e := {e}) AS {_MESSAGE})"


def _row(message, what, original="NULL", attempt="NULL", lease="NULL", due="NULL"):
    return f"CAST(struct_pack(message_id := {message}, what := {what}, original_id := {original}, attempt := {attempt}, lease := {lease}, due_ms := {due}) AS {_ROW})"


_ACTIONS = """q AS (SELECT user_id AS cell, event_id, epoch_us(ts) // 1000 AS ts_ms, event_type IN ('signup', 'click', 'purchase') AS makes, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
 last_value(CASE WHEN event_type IN ('signup', 'click', 'purchase') THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS newest FROM events),
 acts AS (SELECT cell, 4 * event_id AS seq, ts_ms, 'enqueue' AS action, event_id AS msg, CASE WHEN k % 5 <> 0 THEN 'k' || CAST(k % 3 AS VARCHAR) END AS key, k % 4 AS delay, CAST(NULL AS BIGINT) AS lease, CAST(NULL AS BIGINT) AS status, CAST(NULL AS BIGINT) AS timeout FROM q WHERE makes
 UNION ALL SELECT cell, 4 * event_id + 1, ts_ms + 5000, 'tick', NULL, NULL, NULL, NULL, NULL, NULL FROM q
 UNION ALL SELECT cell, 4 * event_id + 2, ts_ms + 5000 + (k % 8) * 60000, 'answer', newest, NULL, NULL, 1 + k % 2, [200, 500, 503, 404, 0][k % 5 + 1], CASE WHEN k % 10 = 2 THEN 30 END FROM q WHERE newest IS NOT NULL),
 n AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ts_ms, seq) AS n FROM acts)"""
#: One action of each cell a round: g has the message that an enqueue or answer meets, r the messages after lost leases,
#: c those that are claimed, v what an answer is.
_ROUNDS = f"""f AS (
 SELECT DISTINCT cell, CAST(0 AS BIGINT) AS n, CAST([] AS {_MESSAGE}[]) AS m, CAST([] AS {_ROW}[]) AS rows, CAST(0 AS BIGINT) AS seq, CAST(0 AS BIGINT) AS ts_ms FROM acts
 UNION ALL SELECT cell, n, CASE WHEN action = 'enqueue' AND g IS NULL THEN list_append(m, {_m("msg", "key", "0", "ts_ms + greatest(0, delay) * 1000", "0", "NULL")}) WHEN action = 'tick' THEN
  list_transform(r, lambda z: CASE WHEN list_contains(c, z.id) THEN {_m(l="z.l + 1", e=f"ts_ms + {queues.LEASE_MS}")} ELSE z END)
  WHEN v IN ('ack', 'drop', 'dead') THEN list_filter(m, lambda z: z.id <> msg)
  WHEN v IN ('retry', 'redeliver') THEN list_transform(m, lambda z: CASE WHEN z.id = msg THEN {_m(a="z.a + CASE WHEN v = 'retry' THEN 1 ELSE 0 END", due="due", e="NULL")} ELSE z END) ELSE m END,
  CASE action WHEN 'enqueue' THEN [CASE WHEN g IS NULL THEN {_row("msg", "'enqueued'", "msg", "0", "0", "ts_ms + greatest(0, delay) * 1000")} ELSE {_row("msg", "'deduped'", "g.id", "g.a", "g.l", "g.due")} END]
  WHEN 'tick' THEN list_concat(list_transform(list_filter(m, lambda z: z.e <= ts_ms), lambda z: {_row("z.id", "'lost'", "NULL", "z.a", "z.l", "ts_ms")}),
   list_transform(list_filter(r, lambda z: list_contains(c, z.id)), lambda z: {_row("z.id", "'claimed'", "NULL", "z.a", "z.l + 1", f"ts_ms + {queues.LEASE_MS}")}))
  ELSE [CASE WHEN v = 'late' THEN {_row("msg", "v", "NULL", "NULL", "lease")} ELSE {_row("msg", "v", "NULL", "g.a + CASE WHEN v IN ('retry', 'dead') THEN 1 ELSE 0 END", "lease", "due")} END] END, seq, ts_ms
 FROM (SELECT *, CASE WHEN v = 'redeliver' THEN ts_ms + timeout * 1000 WHEN v = 'retry' THEN ts_ms + least(60, CAST(pow(2, g.a + 1) AS BIGINT)) * 1000 END AS due,
   list_transform(list_sort(list_transform(list_filter(r, lambda z: z.e IS NULL AND z.due <= ts_ms), lambda z: struct_pack(d := z.due, i := z.id)))[1:greatest(0, {queues.IN_FLIGHT} - len(list_filter(r, lambda z: z.e IS NOT NULL)))], lambda z: z.i) AS c
  FROM (SELECT *, CASE WHEN action <> 'answer' THEN NULL WHEN g IS NULL THEN 'late' WHEN status BETWEEN 200 AND 299 THEN 'ack' WHEN status IN (404, 409, 410, 422) THEN 'drop'
     WHEN status = 503 AND timeout IS NOT NULL THEN 'redeliver' WHEN g.a + 1 >= {queues.MAX_ATTEMPTS} THEN 'dead' ELSE 'retry' END AS v
   FROM (SELECT n.cell, n.n, n.seq, n.ts_ms, n.action, n.msg, n.key, n.delay, n.lease, n.status, n.timeout, f.m,
     CASE WHEN n.action = 'enqueue' THEN list_filter(f.m, lambda z: z.id = n.msg OR z.k = n.key)[1] ELSE list_filter(f.m, lambda z: z.id = n.msg AND z.l = n.lease AND z.e IS NOT NULL)[1] END AS g,
     list_transform(f.m, lambda z: CASE WHEN z.e <= n.ts_ms THEN {_m(due="n.ts_ms", e="NULL")} ELSE z END) AS r
    FROM f JOIN n ON f.cell = n.cell AND n.n = f.n + 1))))"""


@query(f"WITH RECURSIVE {_ACTIONS}, {_ROUNDS} SELECT cell, seq, ts_ms AS at_ms, unnest(rows, recursive := true) FROM f")
def queue_lives(spark, sf_dir):
    """Whole lives of queue messages: claims, leases that are lost, late answers, retries, death."""
    return queue_life.lives(S.queue_actions(spark, sf_dir))


# -- ids ------------------------------------------------------------------------------------------

#: Rows that are numbered together at most where times and ids are spread: a minute of one millisecond's group, so to say.
_BUCKET = 1 << 16


def _hex(text: str) -> str:
    return f"list_reduce(list_transform(string_split({text}, ''), lambda c: CAST(instr('0123456789abcdef', c) - 1 AS BIGINT)), lambda a, b: a * 16 + b)"


def _base32(number: str, digits: int) -> str:
    return " || ".join(f"substr('{numbering.DIGITS}', CAST((({number}) >> {5 * i}) & 31 AS INTEGER) + 1, 1)" for i in reversed(range(digits)))


_ULIDS = f"""t AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, event_type FROM events), d AS (SELECT *, row_number() OVER (PARTITION BY ms ORDER BY event_id) - 1 AS n, sha256(CAST(ms AS VARCHAR)) AS h FROM t),
 v AS (SELECT *, {_hex("substr(h, 1, 10)")} & {(1 << 39) - 1} AS hi, {_hex("substr(h, 11, 10)")} + n AS lo FROM d),
 u AS (SELECT event_id, ms, event_type, {_base32("ms", 10)} || {_base32("hi + (lo >> 40)", 8)} || {_base32("lo", 8)} AS id FROM v)"""


@query(f"WITH {_ULIDS} SELECT event_id, 'evnt_' || id AS id, ms FROM u")
def event_ulids(spark, sf_dir):
    """Ids of all events that sort by time, and the times read back from them."""
    rows = S.table(spark, sf_dir, "events").select("event_id", F.floor(X.epoch_micros(F.col("ts")) / 1000).cast("long").alias("at"))
    made = numbering.ulids(rows, "at", ["event_id"], F.floor(F.col("event_id") / _BUCKET), prefix="evnt_")
    return made.select("event_id", "id", numbering.ulid_ms(F.substring("id", 6, 26)).alias("ms"))


@query(f"WITH {_ULIDS} SELECT event_id AS message_id, 'msg_' || id AS id, '0' || CAST(row_number() OVER (PARTITION BY event_type ORDER BY id) AS VARCHAR) AS place FROM u")
def message_ids(spark, sf_dir):
    """Producers' message ids, and each message's place by id among those of its kind."""
    rows = S.table(spark, sf_dir, "events").select("event_id", "event_type", F.floor(X.epoch_micros(F.col("ts")) / 1000).cast("long").alias("at"))
    made = numbering.ulids(rows, "at", ["event_id"], F.floor(F.col("event_id") / _BUCKET), prefix="msg_")
    placed = numbering.numbered(made, F.col("event_type"), F.substring("id", 1, 13), ["id"], "place")  # a bucket is some hours
    return placed.select(F.col("event_id").alias("message_id"), "id", F.concat(F.lit("0"), F.col("place").cast("string")).alias("place"))


# -- paged disposal -------------------------------------------------------------------------------

_LEFT = f"""{EVENTS}, items AS (SELECT run_id % 10 AS run_id, CASE event_type WHEN 'hook_received' THEN 'hooks' WHEN 'step_started' THEN 'markers' ELSE 'waits' END AS phase, event_id AS key FROM ev WHERE event_type <> 'run_started'),
 runs AS (SELECT DISTINCT run_id % 10 AS run_id FROM ev WHERE event_type = 'run_completed' AND k = 7), sizes(phase, place, size) AS (VALUES {", ".join(f"('{p}', {i}, {n})" for i, (p, n) in enumerate(disposal.PAGES.items()))}),
 ranked AS (SELECT i.*, s.size, (row_number() OVER (PARTITION BY i.run_id, i.phase ORDER BY key) - 1) // s.size AS page FROM items i JOIN sizes s ON i.phase = s.phase),
 taken AS (SELECT run_id, phase, page, count(*) AS n, min(key) AS lo, max(key) AS hi FROM ranked GROUP BY ALL),
 every AS (SELECT r.run_id, s.phase, s.place, coalesce(t.page, 0) AS page, coalesce(t.n, 0) AS n, t.lo, t.hi FROM runs r JOIN sizes s ON true LEFT JOIN taken t ON t.run_id = r.run_id AND t.phase = s.phase)"""


@query(f"""WITH {_LEFT} SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY place, page) - 1 AS generation, phase, CAST(n AS BIGINT) AS n_taken, lo AS first_key, hi AS last_key,
 row_number() OVER (PARTITION BY run_id ORDER BY place DESC, page DESC) = 1 AS ends FROM every""")
def disposal_pages(spark, sf_dir):
    """What each page of an ended run's disposal takes: 64 hooks, 64 markers, 128 waits."""
    e = S.run_events(spark, sf_dir).withColumn("run_id", F.col("run_id") % 10)
    phase = F.when(F.col("event_type") == "hook_received", "hooks").when(F.col("event_type") == "step_started", "markers").otherwise("waits")
    items = e.where("event_type <> 'run_started'").select("run_id", phase.alias("phase"), F.col("event_id").alias("key"))
    ended = e.where("event_type = 'run_completed' and k = 7")
    return disposal.disposal_pages(ended, items, F.floor(F.col("key") / _BUCKET))


# -- attributes -----------------------------------------------------------------------------------

_LIMITS = Limits(keys=4, key_bytes=4, value_bytes=3)


def _attribute_log(spark, sf_dir):
    """Attribute changes of runs that begin with a sign-up and end with some purchases; keys may be reserved or too long, values absent or too long."""
    k = F.col("k")
    ends = (F.col("event_type") == "run_completed") & (k % 10 == 0)
    kind = F.when(F.col("event_type") == "run_started", "run_started").when(ends, "run_completed").otherwise("attr_set")
    key = F.when(k % 13 == 0, "$x").when(k % 17 == 0, "toolong").otherwise(F.concat(F.lit("a"), (k % 6).cast("string")))
    first = F.array(key, F.when(k % 7 != 0, F.concat(F.lit("v"), k.cast("string"))))
    second = F.array(F.concat(F.lit("b"), (k % 3).cast("string")), F.when(k % 5 != 0, F.concat(F.lit("w"), F.when(k == 99, 1000).otherwise(k).cast("string"))))
    return S.run_events(spark, sf_dir).select(
        "run_id", F.col("event_id").alias("seq"), kind.alias("event_type"), "at_us", F.concat(F.lit("c"), (k % 9).cast("string")).alias("corr"), F.lit(True).alias("has_run_input"),
        (k % 4 == 0).alias("by_workflow"), F.when(kind == "attr_set", F.to_json(F.array(first, second))).alias("changes"), (k % 2 == 0).alias("allow_reserved"),
    )


#: The live changes of each run one by one; a: attributes, w: correlation ids that a workflow has written.
_ATTRIBUTES = f"""{SLOTS}, s AS (SELECT run_id, min(slot) AS s FROM slots WHERE event_type = 'run_started' GROUP BY run_id),
 t AS (SELECT x.run_id, min(slot) AS t FROM slots x JOIN s ON x.run_id = s.run_id WHERE slot > s AND event_type = 'run_completed' AND k % 10 = 0 GROUP BY x.run_id),
 j AS (SELECT x.*, CASE WHEN s.s IS NULL OR slot < s.s THEN 'RUN_NOT_FOUND' WHEN slot > t.t THEN 'ENTITY_CONFLICT' END AS verdict, CASE WHEN k % 13 = 0 THEN '$x' WHEN k % 17 = 0 THEN 'toolong' ELSE 'a' || CAST(k % 6 AS VARCHAR) END AS k1,
  CASE WHEN k % 7 <> 0 THEN 'v' || CAST(k AS VARCHAR) END AS v1, 'b' || CAST(k % 3 AS VARCHAR) AS k2, CASE WHEN k % 5 <> 0 THEN 'w' || CAST(CASE WHEN k = 99 THEN 1000 ELSE k END AS VARCHAR) END AS v2
  FROM slots x LEFT JOIN s ON x.run_id = s.run_id LEFT JOIN t ON x.run_id = t.run_id WHERE NOT (event_type = 'run_started' OR event_type = 'run_completed' AND k % 10 = 0)),
 l AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY slot) AS n FROM j WHERE verdict IS NULL),
 f AS (SELECT DISTINCT run_id, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(k VARCHAR, v VARCHAR)[]) AS a, CAST([] AS VARCHAR[]) AS w, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS outcome FROM l
  UNION ALL SELECT run_id, n, CASE WHEN outcome = 'appended' THEN list_concat(list_filter(a, lambda z: z.k <> k1 AND z.k <> k2), list_filter([struct_pack(k := k1, v := v1), struct_pack(k := k2, v := v2)], lambda z: z.v IS NOT NULL)) ELSE a END,
   CASE WHEN outcome = 'appended' AND k % 4 = 0 THEN list_append(w, corr) ELSE w END, event_id, outcome
  FROM (SELECT *, CASE WHEN k1 = '$x' AND k % 2 <> 0 OR k1 = 'toolong' OR k = 99 OR coalesce(strlen(v1), 0) > 3 THEN 'INVALID_ATTRIBUTES' WHEN more > 0 AND len(a) + more > {_LIMITS.keys} THEN 'INVALID_ATTRIBUTES'
    WHEN k % 4 = 0 AND list_contains(w, corr) THEN 'ENTITY_CONFLICT' ELSE 'appended' END AS outcome
   FROM (SELECT l.run_id, l.n, l.event_id, l.k, l.k1, l.v1, l.k2, l.v2, 'c' || CAST(l.k % 9 AS VARCHAR) AS corr, f.a, f.w,
     (CASE WHEN l.v1 IS NULL THEN 0 ELSE 1 END) - len(list_filter(f.a, lambda z: z.k = l.k1)) + (CASE WHEN l.v2 IS NULL THEN 0 ELSE 1 END) - len(list_filter(f.a, lambda z: z.k = l.k2)) AS more
    FROM f JOIN l ON f.run_id = l.run_id AND l.n = f.n + 1)))"""


@query(f"WITH RECURSIVE {_ATTRIBUTES} SELECT run_id, event_id AS seq, verdict AS outcome FROM j WHERE verdict IS NOT NULL UNION ALL SELECT run_id, event_id, outcome FROM f WHERE n > 0")
def attribute_lives(spark, sf_dir):
    """Outcome of every attribute change: limits, reserved keys, repeated writes, ended runs."""
    return eventlog.fold(_attribute_log(spark, sf_dir), limits=_LIMITS).where("event_type = 'attr_set'").select("run_id", "seq", "outcome")


@query(f"WITH RECURSIVE {_ATTRIBUTES}, z AS (SELECT run_id, arg_max(a, n) AS a FROM f GROUP BY run_id) SELECT run_id, x.k AS key, x.v AS value FROM (SELECT run_id, unnest(a) AS x FROM z)")
def attribute_values(spark, sf_dir):
    """Attributes of runs after all accepted changes."""
    return eventlog.attributes(eventlog.fold(_attribute_log(spark, sf_dir), carry=["changes"], limits=_LIMITS))


# -- forms ----------------------------------------------------------------------------------------


@query(f"""WITH {EVENTS}, d AS (SELECT *, CASE WHEN k % 5 = 4 THEN NULL WHEN k % 5 = 3 THEN CAST(k AS VARCHAR) ELSE '{{"a":[' || CAST(k AS VARCHAR) || ',null],"input":{{"deep":"x"}},"stepName":"s"}}' END AS data FROM ev),
 s AS (SELECT *, CASE WHEN event_type = 'run_started' THEN NULL WHEN event_type = 'step_started' THEN replace(data, '"input":{{"deep":"x"}},', '') ELSE data END AS kept FROM d)
 SELECT event_id, '{{' || coalesce('"eventData":' || kept || ',', '') || '"eventType":"' || event_type || '"' || CASE WHEN event_type = 'hook_received' THEN ',"resumeId":"r' || CAST(k AS VARCHAR) || '"' ELSE '' END || ',"runId":"' || CAST(run_id AS VARCHAR) || '"}}' AS event FROM s""")
def event_forms(spark, sf_dir):
    """Events as they are stored: payload without what their type leaves out, resume ids of resumes alone, no absent fields."""
    e = S.run_events(spark, sf_dir)
    k = F.col("k").cast("string")
    data = F.when(F.col("k") % 5 == 3, k).when(F.col("k") % 5 != 4, F.concat(F.lit('{"stepName": "s", "input": {"deep": "x"}, "a": ['), k, F.lit(", null]}")))
    form = forms.stored_event(F.col("event_type"), data, F.concat(F.lit("r"), k), runId=F.col("run_id").cast("string"))
    return e.select("event_id", form.alias("event"))


@query("""SELECT event_id AS hook_id, CASE WHEN json_extract_string(props, '$.k')::BIGINT % 3 = 0 THEN NULL ELSE props END AS metadata FROM events WHERE event_type = 'click'""")
def hooks_shown(spark, sf_dir):
    """Hooks with their metadata, but where a reader wants no data."""
    click = S.table(spark, sf_dir, "events").where("event_type = 'click'")
    k = F.get_json_object("props", "$.k").cast("long")
    resolve = F.when(k % 3 == 0, "none").when(k % 3 == 1, "all")
    return click.select(F.col("event_id").alias("hook_id"), forms.shown_hook(resolve, F.col("props")).alias("metadata"))


# -- steps ----------------------------------------------------------------------------------------


@query(f"WITH {_STEPS}, e AS (SELECT b.*, i FROM b, range(3, 5) t(i)) SELECT run_id, step_id, CAST(i AS BIGINT) AS seq, CAST(3 + q3 - i AS BIGINT) AS retry_after_s FROM e WHERE NOT dead AND (i = 3 AND q3 > 0 OR i = 4 AND q3 > 1)")
def early_starts(spark, sf_dir):
    """Starts that come too early, and the seconds after which they may come again."""
    log, made = _step_log(spark, sf_dir)
    early = eventlog.fold(log, listed=made, only=["TOO_EARLY"])
    ms = [F.col(c) / 1000 for c in ("retry_at_us", "at_us")]
    return early.select("run_id", F.col("corr").alias("step_id"), "seq", X.retry_after_seconds(*ms).alias("retry_after_s"))


@query(f"WITH {_STEP_RESULTS}, first AS (SELECT run_id, step_id FROM results ORDER BY run_id, step_id LIMIT 1) SELECT run_id, step_id, status, attempt, output, error FROM results JOIN first USING (run_id, step_id)")
def step_by_id(spark, sf_dir):
    """Point read of a step that lives: the first by run and id."""
    ends = S.runs(spark, sf_dir).select("run_id", F.when(F.col("status") == "completed", F.col("created_us") + 43_200_000_000).alias("end"))
    alive = _steps(_lines(spark, sf_dir)).join(ends, "run_id").where("end is null or at <= end")
    key = F.broadcast(alive.orderBy("run_id", "step_id").select("run_id", "step_id").limit(1))  # one row
    log, made = _step_log(spark, sf_dir)
    steps = eventlog.folded_steps(log.join(key.select("run_id"), "run_id", "left_semi"), made)
    return steps.join(key, ["run_id", "step_id"], "left_semi").select("run_id", "step_id", "status", "attempt", "output", "error")


# -- creation with admission ----------------------------------------------------------------------

_ENDS = "('run_completed', 'run_failed', 'run_cancelled')"


def _raw_hooks(spark, sf_dir):
    """Raw events of runs whose clicks create hooks with a token, by the thousand for one token and none for some."""
    e, k = S.run_events(spark, sf_dir), F.col("k")
    kind = F.when(F.col("event_type") == "hook_received", "hook_created").otherwise(F.col("event_type"))
    makes = F.col("event_type") == "hook_received"
    token = F.when(makes & (k % 10 != 9), F.when(k % 3 == 0, F.lit("common")).otherwise(F.concat(F.lit("tok_"), k.cast("string"), F.lit("_"), (F.col("run_id") % 40).cast("string"))))
    corr = F.when(makes, F.concat(F.lit("h"), (k % 4).cast("string"), F.lit("_"), (F.col("run_id") % 30).cast("string"))).otherwise(F.lit("s"))
    return e.where("event_type <> 'step_started'").select(F.col("run_id").cast("string").alias("run_id"), F.col("event_id").alias("seq"), kind.alias("event_type"), corr.alias("corr"), "at_us", token.alias("token"), F.lit(True).alias("has_run_input"))


@query(f"""WITH {EVENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY at_us, event_id) AS slot, event_type = 'hook_received' AS makes,
  CASE WHEN event_type = 'hook_received' AND k % 10 <> 9 THEN CASE WHEN k % 3 = 0 THEN 'common' ELSE 'tok_' || CAST(k AS VARCHAR) || '_' || CAST(run_id % 40 AS VARCHAR) END END AS token,
  CASE WHEN event_type = 'hook_received' THEN 'h' || CAST(k % 4 AS VARCHAR) || '_' || CAST(run_id % 30 AS VARCHAR) ELSE 's' END AS corr FROM ev WHERE event_type <> 'step_started'),
 c AS (SELECT *, CAST(run_id AS VARCHAR) || '/' || corr AS name, first_value(CAST(run_id AS VARCHAR) || '/' || corr) OVER (PARTITION BY token ORDER BY at_us, event_id) AS th FROM r WHERE token IS NOT NULL),
 i AS (SELECT corr, arg_min(name, (at_us, event_id)) AS ih FROM c WHERE name = th GROUP BY corr),
 h AS (SELECT c.event_id, CASE WHEN th <> name THEN th ELSE ih END AS holder, name FROM c LEFT JOIN i ON c.corr = i.corr),
 s AS (SELECT run_id, min(slot) AS s FROM r WHERE event_type = 'run_started' GROUP BY run_id),
 t AS (SELECT r.run_id, min(slot) AS t, arg_min(event_type, slot) AS tt FROM r JOIN s ON r.run_id = s.run_id WHERE slot > s AND event_type IN {_ENDS} GROUP BY r.run_id),
 j AS (SELECT r.*, h.holder, coalesce(h.holder <> h.name, false) AS lost, coalesce(slot >= s.s, false) AS has, coalesce(slot > t.t, false) AS after, tt, slot = s.s AS boots FROM r LEFT JOIN h ON r.event_id = h.event_id LEFT JOIN s ON r.run_id = s.run_id LEFT JOIN t ON r.run_id = t.run_id),
 m AS (SELECT *, min(CASE WHEN makes AND has AND NOT after AND NOT lost THEN slot END) OVER (PARTITION BY run_id, corr) AS made FROM j)
 SELECT CAST(run_id AS VARCHAR) AS run_id, event_id AS seq, CASE WHEN event_type = 'hook_received' THEN 'hook_created' ELSE event_type END AS event_type,
 CASE WHEN after AND (makes OR event_type <> 'run_started' AND NOT (event_type = 'run_cancelled' AND tt = 'run_cancelled')) THEN 'ENTITY_CONFLICT' WHEN after AND event_type = 'run_started' THEN 'RUN_EXPIRED' WHEN after THEN 'appended'
 WHEN NOT has THEN 'RUN_NOT_FOUND' WHEN lost THEN 'hook_conflict' WHEN makes AND slot > made AND holder IS NULL THEN 'replay' WHEN makes AND slot > made THEN 'ENTITY_CONFLICT'
 WHEN event_type = 'run_started' AND NOT boots THEN 'replay' ELSE 'appended' END AS outcome FROM m""")
def hook_creations(spark, sf_dir):
    """Raw hook events from admission through the fold in one job; a lost claim appends a conflict."""
    folded = eventlog.create(_raw_hooks(spark, sf_dir))
    outcome = F.when(F.array_contains("appended", "hook_conflict"), "hook_conflict").otherwise(F.col("outcome"))
    return folded.select("run_id", "seq", "event_type", outcome.alias("outcome"))


# -- reads that wait ------------------------------------------------------------------------------


def _talk(spark, sf_dir):
    """Chunks written two at a time each ten seconds, ends of two streams in three, and a read for each chunk."""
    t, turn, conv = S.table(spark, sf_dir, "conversations"), F.col("turn"), F.col("conv_id")
    chunks = t.select(conv.alias("stream"), turn.alias("idx"), (F.octet_length("text").cast("long") * 3000).alias("size"), (conv * 1000 + F.floor(turn / 2) * 10_000).alias("at_ms"))
    ends = chunks.groupBy("stream").agg((F.max("at_ms") + 5_000).alias("at_ms")).where("stream % 3 < 2").select("stream", F.when(F.col("stream") % 3 == 0, "closed").otherwise("errored").alias("state"), "at_ms")
    requests = t.select(
        (conv * 100_000 + turn).alias("request_id"), conv.alias("stream"), (turn + turn % 3).alias("start"), F.when(turn % 7 == 5, 0).otherwise(1 + turn % 3 * 9).alias("max_chunks"),
        F.lit(streams.MAX_CHUNK_BYTES).cast("long").alias("max_bytes"), (turn % 4 * 5_000).alias("wait_ms"), (conv * 1000 + turn * 4_000).alias("at_ms"),
    )
    return requests, chunks, ends


@query(f"""WITH c AS (SELECT conv_id AS stream, turn AS idx, strlen(text) * 3000 AS size, conv_id * 1000 + turn // 2 * 10000 AS t FROM conversations),
 e AS (SELECT stream, max(t) + 5000 AS end_t, CASE WHEN stream % 3 = 0 THEN 'closed' ELSE 'errored' END AS end_state FROM c WHERE stream % 3 < 2 GROUP BY stream),
 r AS (SELECT conv_id * 100000 + turn AS request_id, conv_id AS stream, turn + turn % 3 AS start, CASE WHEN turn % 7 = 5 THEN 0 ELSE 1 + turn % 3 * 9 END AS most, turn % 4 * 5000 AS wait, conv_id * 1000 + turn * 4000 AS t0 FROM conversations),
 n AS (SELECT r.*, e.end_t, e.end_state, (SELECT count(*) FROM c WHERE c.stream = r.stream AND c.t <= r.t0) AS had, least((SELECT min(t) FROM c WHERE c.stream = r.stream AND c.t > r.t0), e.end_t) AS change FROM r LEFT JOIN e ON r.stream = e.stream),
 o AS (SELECT *, had > start OR coalesce(end_t <= t0, false) OR wait = 0 OR most = 0 AS once FROM n),
 a AS (SELECT *, NOT once AND coalesce(change > t0 + wait, true) AS timed_out, CASE WHEN once THEN t0 WHEN coalesce(change > t0 + wait, true) THEN t0 + wait ELSE change END AS at_t FROM o),
 g AS (SELECT a.request_id, c.size, sum(c.size) OVER (PARTITION BY a.request_id ORDER BY c.idx) AS b FROM a JOIN c ON a.stream = c.stream AND c.idx >= a.start AND c.idx < a.start + a.most AND c.t <= a.at_t),
 s AS (SELECT request_id, count(*) AS n, sum(size) AS bytes FROM g WHERE b <= {streams.MAX_CHUNK_BYTES} GROUP BY request_id)
 SELECT a.request_id, a.stream, a.start, a.at_t AS answered_ms, a.timed_out, CASE WHEN a.end_t <= a.at_t THEN a.end_state ELSE 'open' END AS state,
 (SELECT count(*) FROM c WHERE c.stream = a.stream AND c.t <= a.at_t) - 1 AS tail_index, CAST(coalesce(s.n, 0) AS BIGINT) AS n_chunks, CAST(coalesce(s.bytes, 0) AS BIGINT) AS bytes FROM a LEFT JOIN s ON a.request_id = s.request_id""")
def waiting_reads(spark, sf_dir):
    """Reads of streams that wait for chunks, within their bounds on time, chunks and bytes."""
    return streams.waiting_reads(*_talk(spark, sf_dir))
