"""Workflow tables: readers, and adapters that present a star schema as workflow data.

Each adapter returns a DataFrame in the engine's model; columns are computed by
expressions, so filters and column choices still reach the parquet scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.scalars import epoch_micros


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_id(key) -> F.Column:
    return F.concat(F.lit("wrun_"), F.lpad(key.cast("string"), 10, "0"))


def key_of(run: str) -> int | None:
    """The order that a run id stands for, the inverse of run_id."""
    digits = run.removeprefix("wrun_")
    return int(digits) if run.startswith("wrun_") and digits.isdigit() else None


def runs(spark: SparkSession, sf_dir: str, run: str | None = None, created_from_us: int | None = None) -> DataFrame:
    """Runs from orders; completed runs finish one day after they were created.

    Run ids and creation times are expressions, which no scan can filter on. So a
    point read names its ``run``, and a page its first time: these become
    predicates on the table's own columns, which reach the scan.
    """
    orders = table(spark, sf_dir, "orders")
    if run is not None:
        orders = orders.where(F.col("o_orderkey") == F.lit(key_of(run)))
    if created_from_us is not None:
        since = datetime(1970, 1, 1) + timedelta(microseconds=created_from_us)
        orders = orders.where(F.col("o_orderdate") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("pending")
    return orders.select(
        run_id(F.col("o_orderkey")).alias("run_id"),
        F.col("o_orderpriority").alias("workflow_name"),
        F.col("o_orderdate").alias("created_at"),
        epoch_micros(F.col("o_orderdate")).alias("created_us"),
        status.alias("status"),
        F.concat(F.lit("dep_"), (F.col("o_custkey") % 8).cast("string")).alias("deployment_id"),
        F.col("o_totalprice").alias("input"),
    )


def step_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step creation events from lineitem; the same step id can come again, ordered by all columns."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        run_id(F.col("l_orderkey")).alias("run_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("step_id"),
        epoch_micros(F.col("l_shipdate")).alias("at_us"),
        *line.columns,
    )


STEP_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's events from the events table: user as run, numbered by (ts, event_id)."""
    kind = F.create_map(*[F.lit(x) for pair in EVENT_KINDS.items() for x in pair])
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        "event_id",
        epoch_micros(F.col("ts")).alias("at_us"),
        F.when((F.col("event_type") == "error") & (F.col("value") >= CANCEL_VALUE), "run_cancelled").otherwise(kind[F.col("event_type")]).alias("event_type"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "value",
    )


EVENT_KINDS = {"signup": "run_started", "view": "step_started", "click": "hook_received", "purchase": "run_completed", "error": "run_failed"}
#: Errors from this value up are cancellations.
CANCEL_VALUE = 100.0


def hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hook creations from clicks: the event is the hook, its owner the user, its token $.k."""
    click = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    return click.select(
        F.col("event_id").alias("hook_id"),
        F.col("user_id").alias("run_id"),
        F.concat(F.lit("tok_"), F.get_json_object("props", "$.k")).alias("token"),
        epoch_micros(F.col("ts")).alias("at_us"),
    )


#: What a delivery of each kind of message answers: HTTP status (0: transport failure).
OUTCOMES = {"click": 200, "view": 503, "signup": 404, "error": 500, "purchase": 0}


def message_run(key) -> F.Column:
    """The run that a message belongs to: the one of its idempotency key's number."""
    return run_id(key)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages from events: idempotency key is the user, delay and stored attempts come from $.k."""
    k = F.get_json_object("props", "$.k").cast("long")
    status = F.create_map(*[F.lit(x) for pair in OUTCOMES.items() for x in pair])[F.col("event_type")]
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("message_id"),
        F.col("user_id").alias("idempotency_key"),
        epoch_micros(F.col("ts")).alias("enqueued_us"),
        k.alias("delay_s"),
        (k % 6).alias("attempt"),
        status.alias("status"),
        F.when(status == 503, F.lit(30)).alias("timeout_s"),
    )


def queue_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What happens to queue cells, from events: a user is a cell; sign-ups, clicks and purchases are messages.

    Five seconds after each event the cell wakes, and up to seven minutes after that an answer comes for
    the first or second lease of the cell's newest message, some of them too late.
    """
    k, at = F.get_json_object("props", "$.k").cast("long"), F.floor(epoch_micros(F.col("ts")) / 1000).cast("long")
    makes = F.col("event_type").isin("signup", "click", "purchase")
    newest = F.last(F.when(makes, F.col("event_id")), ignorenulls=True).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    none, four = F.lit(None), 4 * F.col("event_id")
    status = F.array(*map(F.lit, (200, 500, 503, 404, 0)))[(k % 5).cast("int")]

    def action(name, seq, when, message=none, key=none, delay=none, lease=none, status=none, timeout=none):
        return F.struct(
            seq.alias("seq"), when.cast("long").alias("at_ms"), F.lit(name).alias("action"), message.cast("long").alias("message_id"), key.cast("string").alias("idempotency_key"),
            delay.cast("long").alias("delay_s"), lease.cast("long").alias("lease"), status.cast("int").alias("status"), timeout.cast("int").alias("timeout_s"),
        )

    enqueue = F.when(makes, action("enqueue", four, at, F.col("event_id"), F.when(k % 5 != 0, F.concat(F.lit("k"), (k % 3).cast("string"))), k % 4))
    tick = action("tick", four + 1, at + 5_000)
    answer = F.when(F.col("newest").isNotNull(), action("answer", four + 2, at + 5_000 + (k % 8) * 60_000, F.col("newest"), lease=1 + k % 2, status=status, timeout=F.when(k % 10 == 2, 30)))
    made = table(spark, sf_dir, "events").withColumn("newest", newest).select(F.col("user_id").alias("cell"), F.explode(F.array(enqueue, tick, answer)).alias("a"))
    return made.where("a is not null").select("cell", "a.*")


def stream_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream chunks from conversations: a conversation is a stream, a turn a chunk."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("stream"), F.col("turn").alias("idx"), "role", "text", F.octet_length("text").cast("long").alias("size")
    )
