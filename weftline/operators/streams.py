"""Append-only chunk streams: budgeted reads, pages, info, appends, states, deletion."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Chunks a write or read may hold, bytes of a chunk, of a batch and of a read, and of a deletion page.
MAX_CHUNKS, MAX_CHUNK_BYTES, MAX_BATCH_BYTES = 32, 1 << 20, 8 << 20
MAX_READ_BYTES, DELETE_ROWS, DELETE_BYTES = 8 << 20, 64, 16 << 20
MAX_WAIT_MS = 20_000


def _so_far(stream: str = "stream"):
    return Window.partitionBy(stream).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)


def check_read(start: int, max_chunks: int, max_bytes: int, wait_ms: int) -> None:
    """Bounds of a read request; raises ValueError naming the field."""
    for name, value, low, high in (
        ("startIndex", start, 0, None), ("maxChunks", max_chunks, 0, MAX_CHUNKS),
        ("maxBytes", max_bytes, MAX_CHUNK_BYTES, MAX_READ_BYTES), ("waitMs", wait_ms, 0, MAX_WAIT_MS),
    ):
        if value < low or (high is not None and value > high):
            raise ValueError(f"{name} must be at least {low}" + (f" and at most {high}" if high is not None else ""))


def read(chunks: DataFrame, start: int | Column = 0, max_chunks: int = MAX_CHUNKS, max_bytes: int = MAX_READ_BYTES) -> DataFrame:
    """Of each stream the chunks from ``start`` on, up to the first that breaks the count or byte budget.

    A prefix, not a best fit. A stream is bounded by its writers, and only
    indexes and sizes are sorted when the payload is not selected.
    """
    w = _so_far()
    tail = chunks.where(F.col("idx") >= start)
    counted = tail.withColumn("__n", F.row_number().over(Window.partitionBy("stream").orderBy("idx"))).withColumn("__bytes", F.sum("size").over(w))
    return counted.where((F.col("__n") <= max_chunks) & (F.col("__bytes") <= max_bytes)).drop("__n", "__bytes")


def waiting_reads(requests: DataFrame, chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """What each read that may wait gets: (request_id, stream, start, answered_ms, timed_out, state, tail_index, n_chunks, bytes).

    Requests are (request_id, stream, start, max_chunks, max_bytes, wait_ms, at_ms), within ``check_read``'s bounds; chunks (stream, idx, size,
    at_ms) are contiguous and never earlier than the ones before; ends are (stream, state, at_ms), the first of a stream counts. A read is answered at once if its
    stream has a chunk from ``start`` on, has ended, or the read neither waits nor wants chunks. Else
    the next change of the stream answers it, whatever that brings, or the end of its wait. The chunks of an
    answer are those from ``start`` as far as both budgets allow.

    A read looks its few indexes up by equality; how far its stream was comes from one running maximum over a stream's times.
    """
    written = chunks.select("stream", F.col("at_ms").alias("t"), F.lit(0).alias("r"), (F.col("idx") + 1).alias("count"), F.lit(None).cast(requests.schema["request_id"].dataType).alias("request_id"))
    asked = requests.select("stream", F.col("at_ms").alias("t"), F.lit(1).alias("r"), F.lit(0).cast("long").alias("count"), "request_id")
    so_far = Window.partitionBy("stream").orderBy("t", "r").rowsBetween(Window.unboundedPreceding, 0)
    there = written.unionByName(asked).withColumn("count", F.max("count").over(so_far)).where("r = 1").select("stream", "request_id", "count")
    last = ends.groupBy("stream").agg(F.min("at_ms").alias("end_ms"), F.min_by("state", "at_ms").alias("end_state"))
    coming = chunks.select("stream", F.col("idx").alias("count"), F.col("at_ms").alias("next_ms"))
    known = requests.join(there, ["stream", "request_id"]).join(last, "stream", "left").join(coming, ["stream", "count"], "left")
    ended = F.coalesce(F.col("end_ms") <= F.col("at_ms"), F.lit(False))
    at_once = (F.col("count") > F.col("start")) | ended | (F.col("wait_ms") == 0) | (F.col("max_chunks") == 0)
    change = F.least("next_ms", "end_ms")
    until = F.col("at_ms") + F.col("wait_ms")
    timed_out = ~at_once & F.coalesce(change > until, F.lit(True))
    known = known.withColumn("answered_ms", F.when(at_once, F.col("at_ms")).when(timed_out, until).otherwise(change)).withColumn("timed_out", timed_out)
    known = known.withColumn("state", F.when(F.col("end_ms") <= F.col("answered_ms"), F.col("end_state")).otherwise("open"))
    wanted = known.where("max_chunks > 0").select("stream", "request_id", "answered_ms", "max_bytes", F.explode(F.expr("sequence(start, start + max_chunks - 1)")).alias("idx"))
    met = wanted.join(chunks.select("stream", "idx", "size", F.col("at_ms").alias("t")), ["stream", "idx"]).where("t <= answered_ms")
    sums = met.withColumn("b", F.sum("size").over(Window.partitionBy("request_id").orderBy("idx"))).where("b <= max_bytes")
    given = sums.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("size").alias("bytes"))
    # An answer after a wait comes with all that is written at its time.
    tails = known.select("request_id", "stream", F.col("answered_ms").alias("t"), F.lit(1).alias("r"), F.lit(0).cast("long").alias("count"))
    tails = written.unionByName(tails).withColumn("count", F.max("count").over(so_far)).where("r = 1").select("request_id", F.col("count").alias("tail"))
    out = known.join(given, "request_id", "left").join(tails, "request_id")
    zero = F.lit(0).cast("long")
    return out.select(
        "request_id", "stream", "start", "answered_ms", "timed_out", "state", (F.col("tail") - 1).alias("tail_index"), F.coalesce("n_chunks", zero).alias("n_chunks"), F.coalesce("bytes", zero).cast("long").alias("bytes")
    )


def start_of(chunks: DataFrame, start: int) -> DataFrame:
    """(stream, start): a negative start counts from the end and is floored at 0."""
    if start >= 0:
        return chunks.select("stream").distinct().withColumn("start", F.lit(start).cast("long"))
    return chunks.groupBy("stream").agg(F.greatest(F.max("idx") + 1 + F.lit(start), F.lit(0)).alias("start"))


def tail(chunks: DataFrame, start: int) -> DataFrame:
    """All chunks of each stream from a start that may be negative."""
    return chunks.join(start_of(chunks, start), "stream").where(F.col("idx") >= F.col("start")).drop("start")


def page(chunks: DataFrame, stream, limit: int = MAX_CHUNKS, cursor: int = 0) -> DataFrame:
    """A page of one stream: up to ``limit`` (32 at most) chunks from index ``cursor``."""
    limit = max(1, min(MAX_CHUNKS, limit))
    return chunks.where((F.col("stream") == F.lit(stream)) & (F.col("idx") >= cursor)).orderBy("idx").limit(limit)


def info(chunks: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """(stream, n_chunks, bytes, tail_index, done): tail is count - 1; done when closed."""
    counted = chunks.groupBy("stream").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("size").alias("bytes"))
    if states is not None:
        counted = states.select("stream", "state").join(counted, "stream", "left")
    n = F.coalesce("n_chunks", F.lit(0)).cast("long")
    done = F.col("state") == "closed" if states is not None else F.lit(False)
    return counted.select("stream", n.alias("n_chunks"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), (n - 1).alias("tail_index"), done.alias("done"))


def append(arrivals: DataFrame, counts: DataFrame, order: list[str]) -> DataFrame:
    """Arrivals with contiguous indexes behind what each stream has (``counts``: stream, n_chunks)."""
    numbered = arrivals.withColumn("__n", F.row_number().over(Window.partitionBy("stream").orderBy(*order)))
    joined = numbered.join(counts.select("stream", "n_chunks"), "stream", "left")
    return joined.withColumn("idx", (F.coalesce("n_chunks", F.lit(0)) + F.col("__n") - 1).cast("long")).drop("__n", "n_chunks")


def write_flags(chunks: DataFrame, by: list[str]) -> DataFrame:
    """Whether each write batch keeps the bounds on count, chunk size and total size."""
    g = chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("largest"), F.sum("size").alias("total"))
    return g.withColumn("valid", (F.col("n").between(1, MAX_CHUNKS)) & (F.col("largest") <= MAX_CHUNK_BYTES) & (F.col("total") <= MAX_BATCH_BYTES))


def split_batches(chunks: DataFrame, max_chunks: int = MAX_CHUNKS, max_bytes: int = MAX_BATCH_BYTES) -> DataFrame:
    """(stream, idx, batch): a greedy cut of each stream, in order, at the count or byte bound.

    The cut is sequential, so streams are sorted within partitions and run
    through with one stream's counters in hand; a chunk larger than the bound is
    a batch of its own.
    """
    rows = chunks.select("stream", F.col("idx").cast("long").alias("idx"), F.col("size").cast("long").alias("size"))
    rows = rows.repartition("stream").sortWithinPartitions("stream", "idx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, cut, n, held = object(), 0, 0, 0
        for batch in batches:
            out = []
            for stream, size in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if stream != current:
                    current, cut, n, held = stream, 0, 0, 0
                if n and (n >= max_chunks or held + size > max_bytes):
                    cut, n, held = cut + 1, 0, 0
                n, held = n + 1, held + size
                out.append(cut)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64())], names=["stream", "idx", "batch"])

    return rows.mapInArrow(run, f"stream {chunks.schema['stream'].dataType.simpleString()}, idx long, batch long")


def refused(writes: DataFrame, changes: DataFrame, order: str = "seq") -> DataFrame:
    """Writes (stream, ``order``) with ``refused``: the state a stream had ended in before the write, else null.

    The first close, failure or expiry ends a stream; later ones change nothing.
    """
    ends = changes.where(F.col("state").isin("closed", "errored", "expired")).groupBy("stream")
    first = ends.agg(F.min(order).alias("__end"), F.min_by("state", order).alias("__state"))
    joined = writes.join(first, "stream", "left")
    return joined.withColumn("refused", F.when(F.col("__end") < F.col(order), F.col("__state"))).drop("__end", "__state")


def final_state(changes: DataFrame, order: str = "seq") -> DataFrame:
    """(stream, state, n_ignored): the first closed or errored change wins, later ones change nothing."""
    g = changes.where(F.col("state").isin("closed", "errored", "expired")).groupBy("stream")
    return g.agg(F.min_by("state", order).alias("state"), (F.count(F.lit(1)) - 1).alias("n_ignored"))


def deletion_page(chunks: DataFrame, max_rows: int = DELETE_ROWS, max_bytes: int = DELETE_BYTES) -> DataFrame:
    """Of each stream what one deletion takes: the first chunk always, then as far as both budgets allow."""
    w = Window.partitionBy("stream").orderBy("idx")
    counted = chunks.withColumn("__n", F.row_number().over(w)).withColumn("__bytes", F.sum("size").over(_so_far()))
    taken = (F.col("__n") == 1) | ((F.col("__n") <= max_rows) & (F.col("__bytes") <= max_bytes))
    return counted.where(taken).drop("__n", "__bytes")


def register(requests: DataFrame) -> DataFrame:
    """Distinct (run_id, stream): registering again changes nothing."""
    return requests.select("run_id", "stream").dropDuplicates()
