"""Registered queries of wire formats, handlers, settings, horizons and requested cleanups."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import codecs
from weftline.functions import scalars as X
from weftline.operators import handlers, ownership, queues, retention
from weftline.plans.queries import DUE, MESSAGES, RUNS_NOW_US, _due_runs, query
from weftline.sources import fixtures as S
from weftline.sources.frames import frames

# -- wire formats ---------------------------------------------------------------------------------

_FRAMES = f"""c AS (SELECT conv_id AS stream, turn AS idx, text, strlen(text) AS size, turn // {codecs.MAX_CHUNKS} AS batch FROM conversations),
 f AS (SELECT stream, batch, count(*) AS n, sum(size) AS bytes, min(idx) AS start, string_agg(printf('%08X', size) || hex(encode(text)), '' ORDER BY idx) AS body FROM c GROUP BY stream, batch)"""


def _chunks(spark, sf_dir):
    return S.stream_chunks(spark, sf_dir).select("stream", "idx", F.encode("text", "UTF-8").alias("data"), "size")


@query(f"""WITH {_FRAMES} SELECT stream, batch, sha256('{codecs.WRITE_MAGIC:08X}' || '0001' || printf('%04X', n) || body) AS digest, CAST(8 + 4 * n + bytes AS BIGINT) AS size, CAST(n AS BIGINT) AS n_back, CAST(bytes AS BIGINT) AS bytes_back FROM f""")
def write_frames(spark, sf_dir):
    """All streams cut into write batches on the wire, and the chunks that are read back from them."""
    made = frames(_chunks(spark, sf_dir)).withColumn("back", codecs.decode_write(F.col("frame")))
    held = F.aggregate("back", F.lit(0).cast("long"), lambda t, c: t + F.octet_length(c))
    return made.select(
        "stream", "batch", F.sha2(F.hex("frame").cast("binary"), 256).alias("digest"), F.octet_length("frame").cast("long").alias("size"), F.size("back").cast("long").alias("n_back"), held.alias("bytes_back")
    )


@query(f"""WITH {_FRAMES} SELECT stream, batch, '{codecs.ACK_MAGIC:08X}' || '0001' || printf('%04X', n) || printf('%08X', start) || printf('%08X', start + n - 1) AS frame, start, CAST(n AS BIGINT) AS n, start + n - 1 AS tail FROM f""")
def write_acks(spark, sf_dir):
    """The answer to each write batch on the wire, and read back."""
    batches = _chunks(spark, sf_dir).groupBy("stream", F.floor(F.col("idx") / codecs.MAX_CHUNKS).cast("long").alias("batch")).agg(F.min("idx").alias("start"), F.count(F.lit(1)).alias("n"))
    made = batches.select("stream", "batch", codecs.encode_ack(F.col("start"), F.col("n")).alias("f")).withColumn("a", codecs.decode_ack(F.col("f")))
    return made.select("stream", "batch", F.hex("f").alias("frame"), F.col("a.start").alias("start"), F.col("a.count").alias("n"), F.col("a.tail").alias("tail"))


_STATE_SQL = "CASE stream % 4 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(codecs.STATES)) + " END"


@query(f"""WITH {_FRAMES}, r AS (SELECT *, stream % 4 AS w, {_STATE_SQL} AS state, CASE WHEN stream % 4 = 2 THEN 'Fehler' ELSE '' END AS name, CASE WHEN stream % 4 = 2 THEN 'é ' || CAST(stream AS VARCHAR) ELSE '' END AS message FROM f)
 SELECT stream, batch, sha256('{codecs.READ_MAGIC:08X}' || '01' || printf('%02X', w) || printf('%02X', stream % 2) || '00' || printf('%08X', start) || printf('%08X', start + n - 1) || printf('%08X', n)
  || printf('%08X', strlen(name)) || printf('%08X', strlen(message)) || body || hex(encode(name)) || hex(encode(message))) AS digest, state, stream % 2 = 1 AS timed_out, CASE WHEN w = 2 THEN name END AS name, CASE WHEN w = 2 THEN message END AS message, CAST(n AS BIGINT) AS n, start + n - 1 AS tail FROM r""")
def read_answers(spark, sf_dir):
    """Answers to reads on the wire with state, timeout and error, and read back (X11)."""
    cut = _chunks(spark, sf_dir).groupBy("stream", F.floor(F.col("idx") / codecs.MAX_CHUNKS).cast("long").alias("batch")).agg(F.array_sort(F.collect_list(F.struct("idx", "data"))).alias("c"))  # 32 at most
    state = F.array(*map(F.lit, codecs.STATES))[(F.col("stream") % 4).cast("int")]
    broken, start = F.col("stream") % 4 == 2, F.col("c")[0]["idx"]
    message = F.when(broken, F.concat(F.lit("é "), F.col("stream").cast("string")))
    frame = codecs.encode_read(start, start + F.size("c") - 1, F.transform("c", lambda x: x["data"]), state, F.col("stream") % 2 == 1, F.when(broken, "Fehler"), message)
    made = cut.select("stream", "batch", frame.alias("f")).withColumn("a", codecs.decode_read(F.col("f")))
    return made.select("stream", "batch", F.sha2(F.hex("f").cast("binary"), 256).alias("digest"), "a.state", "a.timed_out", "a.name", "a.message", F.size("a.chunks").cast("long").alias("n"), "a.tail")


@query("""SELECT event_id, '{"$type":"date","value":' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '}' AS day, '{"$type":"bytes","value":"' || base64(encode(props)) || '"}' AS bytes,
 epoch_us(ts) // 1000 AS day_back, props AS bytes_back, CAST(NULL AS BIGINT) AS other FROM events""")
def tagged_values(spark, sf_dir):
    """Dates and bytes as tagged JSON and back; another tag gives nothing."""
    e = S.table(spark, sf_dir, "events").select("event_id", F.floor(X.epoch_micros(F.col("ts")) / 1000).cast("long").alias("ms"), F.encode("props", "UTF-8").alias("data"))
    made = e.select("event_id", codecs.tagged(F.col("ms"), "date").alias("day"), codecs.tagged(F.col("data"), "bytes").alias("bytes"))
    return made.select(
        "event_id", "day", "bytes", codecs.untagged(F.col("day"), "date").alias("day_back"), F.decode(codecs.untagged(F.col("bytes"), "bytes"), "UTF-8").alias("bytes_back"), codecs.untagged(F.col("bytes"), "date").alias("other")
    )


# -- handlers -------------------------------------------------------------------------------------


def _handler(body: str, told: dict) -> float | None:
    """A user's handler: waits, permanent ends and errors, by the number in the body and the attempt."""
    number = int(body)
    if number % 5 == 1:
        return float(told["attempt"] * 10)
    if number % 5 == 2:
        raise handlers.PermanentError(410)
    if number % 5 == 3:
        raise handlers.PermanentError(418)
    if number % 5 == 4:
        raise RuntimeError(told["messageId"])
    return None


@query(f"""WITH {MESSAGES}, q AS (SELECT *, delay_s % 5 AS d, CASE WHEN message_id % 7 = 0 THEN 'other' ELSE 'wkf' END AS queue FROM messages),
 h AS (SELECT message_id, attempt, CASE WHEN queue = 'other' THEN 400 WHEN d = 1 THEN 503 WHEN d = 2 THEN 410 WHEN d > 2 THEN 500 ELSE 200 END AS status, CASE WHEN queue <> 'other' AND d = 1 THEN CAST((attempt + 1) * 10 AS DOUBLE) END AS timeout_s FROM q)
 SELECT message_id, status, timeout_s, CASE WHEN status = 200 THEN 'ack' WHEN status = 410 THEN 'drop' WHEN status = 503 THEN 'redeliver' WHEN attempt + 1 >= {queues.MAX_ATTEMPTS} THEN 'dead' ELSE 'retry' END AS outcome FROM h""")
def handler_outcomes(spark, sf_dir):
    """Deliveries through a Python handler, and what each makes of its message; other queues' names are refused."""
    m = S.messages(spark, sf_dir).drop("status", "timeout_s").withColumn("queue_name", F.when(F.col("message_id") % 7 == 0, "other:x").otherwise("wkf:x"))
    done = handlers.handle(m.withColumn("body", F.col("delay_s").cast("string")), _handler, "wkf:")
    return done.select("message_id", "status", "timeout_s", queues.outcome(F.col("status"), F.col("timeout_s"), F.col("attempt")).alias("outcome"))


# -- settings -------------------------------------------------------------------------------------


@query("""SELECT event_id, CAST(greatest(1, least(100, CASE WHEN value IS NULL OR event_id % 11 = 0 THEN 20 ELSE floor(value - 20) END)) AS BIGINT) AS page FROM events""")
def page_limits(spark, sf_dir):
    """Page sizes asked for, held within their bounds."""
    asked = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value") - 20)
    return S.table(spark, sf_dir, "events").select("event_id", X.bounded(asked, 20, 100).alias("page"))


_RAW = "CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || CAST(event_id AS VARCHAR) || ' ' WHEN 3 THEN CAST(event_id AS VARCHAR) || '.5' WHEN 4 THEN CAST(event_id % 40 AS VARCHAR) || 'e2' WHEN 5 THEN '-' || CAST(event_id AS VARCHAR) WHEN 6 THEN event_type WHEN 7 THEN CAST(event_id AS VARCHAR) || '.00' ELSE '  ' END"


@query(f"""WITH r AS (SELECT event_id, {_RAW} AS raw FROM events), n AS (SELECT event_id, CASE WHEN raw IS NULL OR raw = '' THEN 128 WHEN trim(raw) = '' THEN 0 ELSE TRY_CAST(trim(raw) AS DOUBLE) END AS v FROM r)
 SELECT event_id, CASE WHEN v = floor(v) AND v BETWEEN 1 AND 1000 THEN CAST(v AS BIGINT) END AS page FROM n""")
def sweep_settings(spark, sf_dir):
    """Settings from their texts: the fallback, a number within bounds, or none."""
    i = F.col("event_id").cast("string")
    k = F.col("event_id") % 9
    raw = (
        F.when(k == 1, "").when(k == 2, F.concat(F.lit(" "), i, F.lit(" "))).when(k == 3, F.concat(i, F.lit(".5"))).when(k == 4, F.concat((F.col("event_id") % 40).cast("string"), F.lit("e2")))
        .when(k == 5, F.concat(F.lit("-"), i)).when(k == 6, F.col("event_type")).when(k == 7, F.concat(i, F.lit(".00"))).when(k == 8, "  ")
    )
    return S.table(spark, sf_dir, "events").select("event_id", X.integer_setting(raw, retention.SWEEP_PAGE, 1, retention.SWEEP_LARGEST).alias("page"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS attempt, CAST(least(60, pow(2, CAST(json_extract_string(props, '$.k') AS BIGINT) % 20)) AS BIGINT) AS delivery_s,
 CAST(least(3600000, 1000 * pow(2, least(greatest(CAST(json_extract_string(props, '$.k') AS BIGINT) % 20, 1) - 1, 12))) AS BIGINT) AS cleanup_ms FROM events""")
def message_backoffs(spark, sf_dir):
    """Delivery and cleanup backoffs of all messages by their attempts."""
    a = F.get_json_object("props", "$.k").cast("long") % 20
    return S.table(spark, sf_dir, "events").select("event_id", a.alias("attempt"), X.backoff_seconds(a).alias("delivery_s"), X.cleanup_backoff_ms(F.greatest(a, F.lit(1))).alias("cleanup_ms"))


# -- horizons and requested cleanups --------------------------------------------------------------


@query(f"""WITH {DUE}, x AS (SELECT run_id, terminal_due_us // 1000 AS ms FROM dl WHERE terminal_due_us <= {RUNS_NOW_US}), k(kind, horizon) AS (VALUES ('catalog', 1200900), ('queue', 330000), ('hook', 2101800))
 SELECT run_id, kind, ms + horizon AS ends_ms, ms + horizon <= {RUNS_NOW_US // 1000} AS gone FROM x JOIN k ON true""")
def fence_horizons(spark, sf_dir):
    """When each fence of each expired run may go."""
    runs = _due_runs(spark, sf_dir)
    gone = runs.where(retention.is_expired(F.col("due_us"), F.lit(RUNS_NOW_US))).select("run_id", F.floor(F.col("due_us") / 1000).cast("long").alias("ms"))
    kinds = gone.select("run_id", "ms", F.explode(F.array(*map(F.lit, ownership.FENCES))).alias("kind"))
    ends = ownership.fence_ends(F.col("ms"), F.col("kind"))
    return kinds.select("run_id", "kind", ends.alias("ends_ms"), (ends <= RUNS_NOW_US // 1000).alias("gone"))


@query(f"""WITH {DUE}, r AS (SELECT run_id, terminal_due_us AS due_us, CASE WHEN deployment_id = 'dep_1' THEN 'tombstoned' ELSE 'retained' END AS phase FROM dl WHERE terminal_due_us <= {RUNS_NOW_US}),
 q AS (SELECT run_id FROM dl WHERE deployment_id IN ('dep_1', 'dep_2'))
 SELECT r.run_id, CASE WHEN q.run_id IS NOT NULL AND phase <> 'tombstoned' THEN {RUNS_NOW_US} ELSE due_us END AS due_us, phase, CAST(CASE WHEN q.run_id IS NOT NULL AND phase <> 'tombstoned' THEN 1 ELSE 0 END AS BIGINT) AS generation FROM r LEFT JOIN q ON r.run_id = q.run_id
 UNION ALL SELECT run_id, {RUNS_NOW_US}, 'retained', CAST(1 AS BIGINT) FROM q WHERE run_id NOT IN (SELECT run_id FROM r)""")
def requested_cleanups(spark, sf_dir):
    """Cleanups that are asked for at once, with and without a record from before."""
    runs = _due_runs(spark, sf_dir)
    tombstoned = F.when(F.col("deployment_id") == "dep_1", "tombstoned")
    records = retention.cleanup_records(runs, RUNS_NOW_US).join(runs.select("run_id", tombstoned.alias("__t")), "run_id").withColumn("phase", F.coalesce("__t", "phase")).drop("__t")
    asked = runs.where("deployment_id in ('dep_1', 'dep_2')").select("run_id")
    out = retention.clean_now(records.withColumn("generation", F.lit(0).cast("long")), runs, asked.unionByName(asked), RUNS_NOW_US)
    return out.select("run_id", "due_us", "phase", "generation")
