"""The durable queue as relations: due times, deliveries and their outcomes, dead letters, redrive, stats.

Time never comes from the clock: every operator that depends on it takes
``now_us`` or ``now_ms``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.scalars import backoff_seconds

#: Deliveries before a message is dead, messages in flight by default and at most, milliseconds of a lease.
MAX_ATTEMPTS, IN_FLIGHT, IN_FLIGHT_CAP = 5, 5, 128
LEASE_MS = 330_000
#: Statuses that end a message without a retry.
PERMANENT = (404, 409, 410, 422)


def due_us(enqueued_us: Column, delay_s: Column) -> Column:
    """When a message may be delivered first; negative delays count as none."""
    return enqueued_us + F.greatest(F.lit(0), delay_s) * 1_000_000


def outcome(status: Column, timeout_s: Column, attempt: Column) -> Column:
    """What a delivery does: ack, drop (permanent), redeliver (503 with a time), dead or retry.

    A 503 without a time is an ordinary failure. ``attempt`` counts earlier failures.
    """
    return (
        F.when(status.between(200, 299), "ack")
        .when(status.isin(*PERMANENT), "drop")
        .when((status == 503) & timeout_s.isNotNull(), "redeliver")
        .when(attempt + 1 >= MAX_ATTEMPTS, "dead")
        .otherwise("retry")
    )


def deliver(messages: DataFrame, now_us: int) -> DataFrame:
    """Every message after one delivery: outcome, attempt afterwards and next due time (null when it ends).

    Ack, drop and dead release the idempotency key; redeliver keeps the attempt.
    """
    what = outcome(F.col("status"), F.col("timeout_s"), F.col("attempt"))
    out = messages.withColumn("outcome", what)
    failed = F.col("outcome").isin("retry", "dead")
    after = F.when(failed, F.col("attempt") + 1).otherwise(F.col("attempt"))
    out = out.withColumn("attempt_after", after.cast("long"))
    wait = F.when(F.col("outcome") == "redeliver", F.col("timeout_s")).when(F.col("outcome") == "retry", backoff_seconds(F.col("attempt_after")))
    return out.withColumn("next_due_us", F.lit(now_us) + wait.cast("long") * 1_000_000).withColumn("holds_key", F.col("outcome").isin("retry", "redeliver"))


def handler_status(result_timeout: Column, error_status: Column) -> Column:
    """Status that a handler's result becomes: a number of seconds is a 503, a permanent error keeps its status, others are 500."""
    return F.when(result_timeout.isNotNull(), 503).when(error_status.isNull(), 200).when(error_status.isin(*PERMANENT), error_status).otherwise(500)


def due(messages: DataFrame, now_us: int, due_col: str = "due_us") -> DataFrame:
    return messages.where(F.col(due_col) <= now_us)


def claim(messages: DataFrame, now_us: int, shard: str, free: int = IN_FLIGHT, due_col: str = "due_us") -> DataFrame:
    """Of each shard the first ``free`` (128 at most) due messages by (due, id).

    A rank filter on a window: Spark keeps a group limit before the shuffle, so
    each task sends ``free`` rows a shard.
    """
    order = Window.partitionBy(shard).orderBy(due_col, "message_id")
    free = max(0, min(IN_FLIGHT_CAP, free))
    return due(messages, now_us, due_col).withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= free).drop("__n")


def expired_leases(in_flight: DataFrame, now_ms: int, claimed_col: str = "claimed_ms") -> DataFrame:
    """Deliveries whose lease is over; each is due again now with its attempt unchanged."""
    return in_flight.where(F.col(claimed_col) + LEASE_MS <= now_ms).withColumn("due_ms", F.lit(now_ms).cast("long"))


def dedup(messages: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """Messages with ``original_id`` and ``accepted`` where every first message of a key is still held.

    Where outcomes release keys, ``dedup_while_active`` is meant.
    """
    first = messages.groupBy(key).agg(F.min_by("message_id", F.struct("enqueued_us", "message_id")).alias("original_id"))
    return messages.join(first, key).withColumn("accepted", F.col("original_id") == F.col("message_id"))


def dedup_while_active(messages: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """(key, message_id, original_id, accepted) for messages with ``enqueued_us`` and ``released_us`` (null: never).

    A message is accepted when no earlier accepted one of its key is still
    active; else it refers to that one. Which message holds a key depends on all
    before it, so keys are sorted within partitions and run through with one
    holder in hand.
    """
    rows = messages.select(key, *(F.col(c).cast("long").alias(c) for c in ("message_id", "enqueued_us", "released_us")))
    rows = rows.repartition(key).sortWithinPartitions(key, "enqueued_us", "message_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, holder, until = object(), None, None
        for batch in batches:
            original, accepted = [], []
            for k, message, at, released in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != current:
                    current, holder, until = k, None, None
                free = holder is None or (until is not None and until <= at)
                if free:
                    holder, until = message, released
                original.append(holder)
                accepted.append(free)
            arrays = [batch.column(0), batch.column(1), pa.array(original, pa.int64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "message_id", "original_id", "accepted"])

    kind = messages.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, message_id long, original_id long, accepted boolean")


def lease_id(message_id: Column, attempt: Column) -> Column:
    """Token of one delivery: a later delivery of the same message has another."""
    return F.concat_ws("/", message_id.cast("string"), attempt.cast("string"))


def settle(answers: DataFrame, leases: DataFrame) -> DataFrame:
    """Answers (message_id, lease, ...) with ``counts``: whether the lease is still the message's; a late answer of a lost one changes nothing."""
    current = leases.select("message_id", F.col("lease").alias("__lease"))
    joined = answers.join(current, "message_id", "left")
    return joined.withColumn("counts", F.coalesce(F.col("lease") == F.col("__lease"), F.lit(False))).drop("__lease")


#: Fixed value: dead letters that one purge takes.
PURGE_PAGE = 128


def purge_dead(dead: DataFrame, shard: str, order: list[str], limit: int = PURGE_PAGE) -> DataFrame:
    """Of each shard the dead letters that one purge takes, first by ``order``, with ``has_more``: whether some are left."""
    w = Window.partitionBy(shard).orderBy(*order)
    first = dead.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= limit + 1)
    return first.withColumn("has_more", F.max("__n").over(Window.partitionBy(shard)) > limit).where(F.col("__n") <= limit).drop("__n")


def acknowledge(receipts: DataFrame, markers: DataFrame, now_us: int, keep_us: int, key: str) -> DataFrame:
    """Receipts (key, n_deleted) with ``acknowledged`` and ``compact_us``.

    A receipt counts when it equals the marker's exactly, and then says when the
    marker may go; without a marker it has been acknowledged before, which is
    success as well.
    """
    known = markers.select(key, F.col("n_deleted").alias("__n"), F.lit(True).alias("__marked"))
    joined = receipts.join(known, key, "left")
    equal = F.col("__n") == F.col("n_deleted")
    out = joined.withColumn("acknowledged", F.when(F.col("__marked"), equal).otherwise(True))
    return out.withColumn("compact_us", F.when(F.col("__marked") & equal, F.lit(now_us + keep_us)).cast("long")).drop("__n", "__marked")


def compactable(deadlines: DataFrame, markers: DataFrame, now_us: int, key: str) -> DataFrame:
    """Markers that may go: a deadline (key, compact_us) is over and is the marker's own; an outdated deadline takes nothing."""
    over = deadlines.where(F.col("compact_us") <= now_us).select(key, "compact_us")
    return markers.join(over, [key, "compact_us"], "left_semi")


def accepted_by_gap(messages: DataFrame, hold_us: int, key: str = "idempotency_key") -> DataFrame:
    """In-flight claim by staleness: a key is taken when its previous use is at least ``hold_us`` ago."""
    w = Window.partitionBy(key).orderBy("enqueued_us", "message_id")
    gap = F.col("enqueued_us") - F.lag("enqueued_us").over(w)
    return messages.withColumn("accepted", F.coalesce(gap >= hold_us, F.lit(True)))


def stats(messages: DataFrame, now_us: int, by: str, due_col: str = "due_us") -> DataFrame:
    """Per shard: pending, due, dead letters and the next timer (least due, floored to a microsecond from now)."""
    live = F.col("attempt") < MAX_ATTEMPTS
    timer = F.greatest(F.min(F.when(live, F.col(due_col))), F.lit(now_us + 1))
    return messages.groupBy(by).agg(
        F.count(F.when(live, 1)).alias("pending"),
        F.count(F.when(live & (F.col(due_col) <= now_us), 1)).alias("due"),
        F.count(F.when(~live, 1)).alias("dead_letters"),
        F.when(F.min(F.when(live, F.col(due_col))).isNotNull(), timer).alias("next_timer_us"),
    )


def redrive(dead: DataFrame, live: DataFrame, now_us: int, key: str = "idempotency_key") -> DataFrame:
    """Dead letters with ``redriven``: refused while another live message owns the key; else attempt 0, due now."""
    held = live.select(key, F.col("message_id").alias("__holder")).groupBy(key).agg(F.min("__holder").alias("holder"))
    joined = dead.join(held, key, "left")
    ok = F.col("holder").isNull() | (F.col("holder") == F.col("message_id"))
    return joined.withColumn("redriven", ok).withColumn("attempt", F.when(ok, 0).otherwise(F.col("attempt")).cast("long")).withColumn(
        "due_us", F.when(ok, F.lit(now_us)).cast("long")
    )


def expire_runs(messages: DataFrame, expired: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Messages left after their runs' expiry, and the receipts (run, n_deleted)."""
    gone = expired.select(key).distinct()
    return messages.join(gone, key, "left_anti"), messages.join(gone, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n_deleted"))
