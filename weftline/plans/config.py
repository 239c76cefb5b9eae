"""Settings with their bounds, and the facade that puts tables and operators together."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.scalars import error_of, queue_shard
from weftline.operators import eventlog, queues, retention, streams

#: Bounds of a call's time, in milliseconds.
CALL_MS_MOST, LONG_POLL_MS = 300_000, 20_000


@dataclass(frozen=True)
class Settings:
    """Checked when made: a bad value raises ValueError naming the field."""

    queue_shards: int = 1
    retention_ms: int = 0
    call_ms: int = 30_000
    long_poll_ms: int = LONG_POLL_MS
    sweep_page: int = retention.SWEEP_PAGE
    spec_version: int | None = None  # events and runs of another version are not supported; None: not asked

    def __post_init__(self):
        checks = {
            "queue_shards": self.queue_shards >= 1,
            "retention_ms": self.retention_ms >= 0,
            "call_ms": 1 <= self.call_ms <= CALL_MS_MOST,
            "long_poll_ms": 0 <= self.long_poll_ms < self.call_ms,
            "sweep_page": 1 <= self.sweep_page <= retention.SWEEP_LARGEST,
            "spec_version": self.spec_version is None or self.spec_version >= 1,
        }
        for name, ok in checks.items():
            if not ok:
                raise ValueError(f"{name} is out of range: {getattr(self, name)}")


class World:
    """Event log, queue, streams and retention over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str, settings: Settings | None = None):
        self.spark, self.folder, self.settings = spark, folder, settings or Settings()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(str(PurePosixPath(self.folder) / f"{name}.parquet") if "://" not in self.folder else f"{self.folder}/{name}.parquet")

    def append_events(self, events: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Events decided in order: the log rows they append, and those rejected with their code and the caller's error."""
        folded = eventlog.fold(events, current_spec=self.settings.spec_version)
        error, status = error_of(F.col("outcome"))
        rejected = folded.where("outcome not in ('appended', 'replay')").withColumns({"error_name": error, "error_status": status})
        return eventlog.appended(folded), rejected

    def deliver(self, messages: DataFrame, now_us: int) -> DataFrame:
        """Messages after one delivery, dealt over the configured queue shards."""
        shard = queue_shard(F.coalesce(F.col("idempotency_key").cast("string"), F.col("message_id").cast("string")), self.settings.queue_shards)
        return queues.deliver(messages, now_us).withColumn("shard", shard)

    def read_streams(self, chunks: DataFrame, start: int = 0, max_chunks: int = streams.MAX_CHUNKS, max_bytes: int = streams.MAX_READ_BYTES) -> DataFrame:
        streams.check_read(start, max_chunks, max_bytes, 0)
        return streams.read(chunks, start, max_chunks, max_bytes)

    def sweep(self, runs_with_due: DataFrame, tombstones: DataFrame, scheduled_us: int) -> DataFrame:
        return retention.sweep_state(runs_with_due, tombstones, scheduled_us, self.settings.retention_ms * 1000)
