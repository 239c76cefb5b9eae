"""Deliveries and chunk tails as streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.operators import handlers, queues


def deliver_stream(messages: DataFrame, handler: Callable, sink: str, checkpoint: str, now_us: Callable[[], int], prefix: str = "", expired: DataFrame | None = None) -> StreamingQuery:
    """Deliver streaming messages through a handler and write their outcomes, a folder for each micro-batch.

    A batch that runs again after a failure overwrites its own folder, so an
    outcome is there once. Messages of expired runs (``expired``: run_id) are
    dropped before delivery. The trigger is "available now"; a scheduler calls
    it again.
    """

    def batch(df: DataFrame, number: int) -> None:
        alive = df if expired is None else df.join(expired.select("run_id"), "run_id", "left_anti")
        done = queues.deliver(handlers.handle(alive, handler, prefix), now_us())
        done.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tail_stream(spark: SparkSession, path: str, schema: str, stream, start: int = 0) -> DataFrame:
    """Chunks of one stream from an index on, as they are appended to a folder of parquet files."""
    return spark.readStream.schema(schema).parquet(path).where((F.col("stream") == F.lit(stream)) & (F.col("idx") >= start))
