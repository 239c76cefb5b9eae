"""Stream write batches in their wire format: files of frames in, tables of frames out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import codecs
from weftline.operators import streams


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """(path, idx, data, size) of the chunks in files that hold one write batch each; idx is null for a broken file."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    opened = files.select("path", F.posexplode_outer(codecs.decode_write(F.col("content"))).alias("idx", "data"))
    return opened.select("path", F.col("idx").cast("long").alias("idx"), "data", F.octet_length("data").cast("long").alias("size"))


def frames(chunks: DataFrame, max_chunks: int = streams.MAX_CHUNKS, max_bytes: int = streams.MAX_BATCH_BYTES) -> DataFrame:
    """(stream, batch, frame): chunks (stream, idx, data, size) cut into write batches and encoded.

    A batch is bounded by the protocol (32 chunks, 8 MiB), so the list that is
    put together for one is too.
    """
    cut = streams.split_batches(chunks, max_chunks, max_bytes)
    listed = chunks.join(cut, ["stream", "idx"]).groupBy("stream", "batch").agg(F.array_sort(F.collect_list(F.struct("idx", "data"))).alias("c"))
    return listed.select("stream", "batch", codecs.encode_write(F.transform("c", lambda x: x["data"])).alias("frame"))
