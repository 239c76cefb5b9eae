"""Retention: deadlines, visibility, sweeps and cleanup accounting, each a declarative step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import cleanup_backoff_ms
from weftline.operators.listing import TERMINAL

DAY_US = 86_400_000_000
#: Runs a sweep looks at by default and at most.
SWEEP_PAGE, SWEEP_LARGEST = 128, 1000


def terminal_due(runs: DataFrame, retention_us: int, completed: str = "completed_us") -> DataFrame:
    """Runs with ``terminal_due_us``: completion plus retention for terminal runs, else null."""
    due = F.when(F.col("status").isin(*TERMINAL), F.col(completed) + retention_us)
    return runs.withColumn("terminal_due_us", due)


def deadline(runs: DataFrame, terminal_retention_us: int, age_retention_us: int | None, scheduled_us: int, completed: str = "completed_us") -> DataFrame:
    """Runs with ``due_us``: the earlier of the terminal deadline and the age deadline where the age is over.

    An age deadline later than ``scheduled_us`` does not apply yet; one that is
    equal does. Later deadlines never extend earlier ones.
    """
    out = terminal_due(runs, terminal_retention_us, completed)
    if age_retention_us is None:
        return out.withColumn("due_us", F.col("terminal_due_us"))
    age = F.col("created_us") + age_retention_us
    return out.withColumn("due_us", F.least(F.col("terminal_due_us"), F.when(age <= scheduled_us, age)))


def is_expired(due_us: Column, now_us: Column) -> Column:
    """Expired from the due time on; no deadline never expires."""
    return F.coalesce(due_us <= now_us, F.lit(False))


def visible(runs_with_due: DataFrame, now_us: int) -> DataFrame:
    return runs_with_due.where(~is_expired(F.col("due_us"), F.lit(now_us)))


def sweep_state(runs_with_due: DataFrame, tombstones: DataFrame, scheduled_us: int, retention_us: int, key: str = "run_id") -> DataFrame:
    """Candidates of a fleet sweep with their state: expired, scheduled, not-due or missing.

    Candidates were created at least ``retention_us`` before; nothing is swept
    with no retention or a schedule earlier than it.
    """
    if retention_us <= 0 or scheduled_us < retention_us:
        return runs_with_due.limit(0).withColumn("state", F.lit(None).cast("string"))
    old = runs_with_due.where(F.col("created_us") <= scheduled_us - retention_us)
    gone = tombstones.select(key, F.lit(True).alias("__gone")).distinct()
    state = (
        F.when(F.col("__gone"), "expired").when(F.col("status").isNull(), "missing")
        .when(is_expired(F.col("due_us"), F.lit(scheduled_us)), "scheduled").otherwise("not-due")
    )
    return old.join(gone, key, "left").withColumn("state", state).drop("__gone")


def histogram(states: DataFrame) -> DataFrame:
    """(state, n) of a sweep."""
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def cleanup_records(runs_with_due: DataFrame, now_us: int, key: str = "run_id") -> DataFrame:
    """One record for each expired run, in its first phase with zero counters."""
    expired = runs_with_due.where(is_expired(F.col("due_us"), F.lit(now_us)))
    zeros = [F.lit(0).cast("long").alias(c) for c in ("attempts", "payload_keys_deleted", "streams_deleted", "messages_deleted")]
    return expired.select(key, F.col("due_us"), F.lit("retained").alias("phase"), F.lit("terminal-retention").alias("reason"), *zeros)


def account(records: DataFrame, steps: DataFrame, streams: DataFrame, messages: DataFrame, now_us: int, key: str = "run_id") -> DataFrame:
    """Tombstones: records with what was deleted, by kind. Each kind is counted before it is joined."""
    out = records.drop("payload_keys_deleted", "streams_deleted", "messages_deleted")
    for name, df in (("payload_keys_deleted", steps), ("streams_deleted", streams), ("messages_deleted", messages)):
        n = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
        out = out.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.withColumn("phase", F.lit("tombstoned")).withColumn("tombstoned_us", F.lit(now_us).cast("long"))


def clean_now(records: DataFrame, runs: DataFrame, requested: DataFrame, now_us: int, key: str = "run_id") -> DataFrame:
    """Records after immediate cleanups were asked for: due now, one generation on; runs without a record get one.

    A cleanup that has reached its tombstone stays as it is, and so do the others. Only runs that
    exist get a record; asking twice is asking once.
    """
    asked = requested.select(key).distinct()
    have = records.join(asked.withColumn("__asked", F.lit(True)), key, "left")
    moved = F.coalesce("__asked", F.lit(False)) & (F.col("phase") != "tombstoned")
    kept = have.withColumns({
        "due_us": F.when(moved, F.lit(now_us)).otherwise(F.col("due_us")).cast("long"),
        "generation": (F.col("generation") + F.when(moved, 1).otherwise(0)).cast("long"),
    }).drop("__asked")
    fresh = runs.join(asked, key, "left_semi").join(records.select(key), key, "left_anti").withColumn("due_us", F.lit(now_us).cast("long"))
    made = cleanup_records(fresh, now_us, key).withColumn("generation", F.lit(1).cast("long")).select(kept.columns)
    return kept.unionByName(made)


#: Phases of a cleanup in order, and the counter that each one fills (none: it only moves on).
PHASES = ("retained", "index", "streams", "queues", "payload", "tombstoned")
COUNTERS = {"streams": "streams_deleted", "queues": "messages_deleted", "payload": "payload_keys_deleted"}


def run_phases(records: DataFrame, counts: dict[str, DataFrame], failures: DataFrame, now_us: int, key: str = "run_id") -> DataFrame:
    """Records after a cleanup has gone as far as it gets: to a tombstone, or to the phase that fails.

    ``counts`` has (key, n) of what there is to delete by phase, ``failures``
    (key, phase, error). A failure adds an attempt, keeps its error and puts the
    record off; what earlier phases deleted stays counted. Each kind is joined once,
    counted before.
    """
    steps = F.array(*map(F.lit, PHASES))
    failed = failures.select(key, F.struct(F.array_position(steps, F.col("phase")).alias("at"), "phase", "error").alias("__f"))
    first = failed.groupBy(key).agg(F.min("__f").alias("__f"))
    out = records.join(first, key, "left")
    fails = F.col("__f").isNotNull() & (F.col("__f.at") > F.array_position(steps, F.col("phase")))
    reached = F.when(fails, F.col("__f.at")).otherwise(len(PHASES))
    out = out.withColumns({"__from": F.array_position(steps, F.col("phase")), "__to": reached})
    for phase, name in COUNTERS.items():
        out = out.join(counts[phase].groupBy(key).agg(F.sum("n").alias("__n")), key, "left")
        at = PHASES.index(phase) + 1
        done = (F.col("__from") <= at) & (F.col("__to") > at)
        out = out.withColumn(name, (F.col(name) + F.when(done, F.coalesce("__n", F.lit(0))).otherwise(0)).cast("long")).drop("__n")
    attempts = F.col("attempts") + F.when(fails, 1).otherwise(0)
    return out.withColumns({
        "due_us": F.when(fails, F.lit(now_us) + cleanup_backoff_ms(attempts) * 1000).otherwise(F.col("due_us")),
        "phase": F.element_at(steps, F.col("__to").cast("int")),
        "last_error": F.when(fails, F.col("__f.error")),
        "attempts": attempts.cast("long"),
    }).drop("__f", "__from", "__to")


def cleanup_status(live: DataFrame, tombstones: DataFrame, columns: list[str], key: str = "run_id") -> DataFrame:
    """Cleanup of each run: the live record, else the copy that its tombstone keeps."""
    old = tombstones.select(key, F.struct(*columns).alias("__old"))
    new = live.select(key, F.struct(*columns).alias("__new"))
    return old.join(new, key, "full_outer").select(key, F.coalesce("__new", "__old").alias("c")).select(key, "c.*")


def purge(df: DataFrame, tombstones: DataFrame, key: str = "run_id") -> DataFrame:
    """What is left of a table when the tombstoned runs' rows are gone."""
    return df.join(tombstones.select(key).distinct(), key, "left_anti")
