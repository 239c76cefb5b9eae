"""What the corpus operators share: reading, the shared folder, Arrow mapping.

Conventions for every operator of this subpackage:

* a null text is an empty text; a null id stays null;
* an operator selects the columns it needs, or passes the others through
  untouched; an input column whose name equals one of the operator's output
  columns is replaced by the output;
* repeated rows each get their own result unless the docstring says otherwise;
* an empty input gives an empty result with the same schema.
"""

from __future__ import annotations

import atexit
import logging
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch that are in Python's hands at once.
ROWS_AT_ONCE = 500
#: Tables up to this many bytes (as written, compressed) and rows may be broadcast.
BROADCAST_BYTES, BROADCAST_ROWS = 8 << 20, 1_000_000
_log = logging.getLogger("weftline")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session names none, in local mode a temporary one is made and set,
    so that later calls find it. On a cluster that is an error: executors would
    each write to a disk of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not re.match(r"local(\[[^,]*(,\s*\d+)?\])?$", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    made = tempfile.mkdtemp(prefix="weftline-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return f"file://{made}"


def _path(spark: SparkSession, where: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Written:
    """A table written to the shared folder: cuts lineage and has a known size."""

    def __init__(self, df: DataFrame, partition_by: list[str] | None = None):
        self.spark = df.sparkSession
        self.where = f"{shared_dir(self.spark)}/weftline-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(self.where)
        self.df = self.spark.read.schema(df.schema).parquet(self.where)
        atexit.register(self.drop)

    def bytes(self) -> int:
        path, fs = _path(self.spark, self.where)
        return fs.getContentSummary(path).getLength()

    def small(self, most: int = BROADCAST_BYTES) -> bool:
        """Whether the table is within the size that may be broadcast."""
        written, fits = self.bytes(), False
        if written <= most:
            fits = self.df.count() <= BROADCAST_ROWS  # from the files' footers
        _log.info("%s: %d bytes, %s", self.where, written, "broadcast" if fits else "joined by shuffle")
        return fits

    def drop(self) -> None:
        try:
            path, fs = _path(self.spark, self.where)
            fs.delete(path, True)
        except Exception:  # noqa: BLE001  the session is gone; its owner clears the folder
            pass


def lookup_side(written: Written, most: int = BROADCAST_BYTES) -> DataFrame:
    """The table as a join side: broadcast when its written size allows, else as it is.

    Beyond the bound the join is an ordinary shuffled one, whose hot keys
    adaptive execution splits.
    """
    return F.broadcast(written.df) if written.small(most) else written.df


def fold(text: Column, *, to: str = "") -> Column:
    """Null text as an empty one."""
    return F.coalesce(text, F.lit(to))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def with_columns(
    df: DataFrame,
    fields: list[tuple[str, T.DataType]],
    rows: Callable[[pa.RecordBatch], Iterable[pa.Array]],
    keep: list[str] | None = None,
    setup: Callable[[], object] | None = None,
) -> DataFrame:
    """Add columns computed from Arrow batches; the others pass through.

    ``rows(batch)`` (or ``rows(batch, setup())`` with state made once a task)
    returns one array for each of ``fields``.
    """
    names = {name for name, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([*(df.schema[c] for c in kept), *(T.StructField(n, t) for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            got = rows(batch, state) if setup else rows(batch)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), *got],
                names=[*kept, *(n for n, _ in fields)],
            )

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of the texts of a batch, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(binary).to_pylist()]
