"""A written catalog: Parquet files sorted by key, with their bounds in a manifest, kept up batch by batch.

The files hold disjoint ranges of keys. A range read opens the files whose bounds it
meets, and Parquet's own statistics take it from there; point reads by another
column have Parquet's Bloom filters. A batch rewrites the files that its
keys fall into, and no others. Every change makes a new manifest; readers
see the newest one that is whole, so a batch that breaks off changes nothing
and can run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.listing import fenced, prefix_range
from weftline.sources.shared import path_of

#: Rows of a file.
FILE_ROWS = 1_000_000
#: The largest character: ends the range of a prefix.
_LAST = "\U0010ffff"
MANIFEST = "file string, low string, high string, n long"


class Catalog:
    """Rows with a unique string ``key`` under one folder; ``at`` names the column that tells a row's newest state."""

    def __init__(self, spark: SparkSession, where: str, at: str = "at_us", bloom: tuple[str, ...] = ("run_id",), file_rows: int = FILE_ROWS):
        self.spark, self.where, self.at, self.bloom, self.file_rows = spark, where, at, bloom, file_rows

    def version(self) -> int | None:
        """The newest whole manifest's number; None before the first."""
        path, fs = path_of(self.spark, f"{self.where}/manifest")
        if not fs.exists(path):
            return None
        made = [s.getPath() for s in fs.listStatus(path)]
        whole = [int(p.getName().partition("=")[2]) for p in made if p.getName().startswith("version=") and fs.exists(path_of(self.spark, f"{p}/_SUCCESS")[0])]
        return max(whole, default=None)

    def manifest(self) -> DataFrame:
        """(file, low, high, n) of the newest version, by which reads and merges are planned."""
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.where}/manifest/version={version}")

    def _commit(self, files: DataFrame, version: int) -> None:
        """One small file, which is there whole or not at all; a version that another writer has made is an error."""
        files.select("file", "low", "high", "n").coalesce(1).write.parquet(f"{self.where}/manifest/version={version}")

    def _write(self, rows: DataFrame) -> DataFrame:
        """Sorted rows as files of their own, and these files' bounds."""
        folder = f"{self.where}/data/{uuid.uuid4().hex}"
        writer = rows.write.option("maxRecordsPerFile", self.file_rows)
        for column in self.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"))

    def build(self, rows: DataFrame, files: int | None = None) -> None:
        """A first version from rows; of a key's rows the newest stays. ``files`` is how many ranges are written at once."""
        newest = self._newest(rows)
        dealt = newest.repartitionByRange(files, "key") if files else newest.repartitionByRange("key")
        self._commit(self._write(dealt.sortWithinPartitions("key")), 0 if (v := self.version()) is None else v + 1)

    def _newest(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.max_by(F.struct(*rows.columns), F.col(self.at)).alias("r")).select("r.*")

    def read(self, schema, prefix: str = "", start_after: str | None = None, end: str | None = None) -> DataFrame:
        """Rows whose key has the prefix and lies strictly between the bounds, from the files that may have some."""
        met = self.manifest().where((F.col("high") >= prefix) & (F.col("low") <= prefix + _LAST))
        if start_after is not None:
            met = met.where(F.col("high") > start_after)
        if end is not None:
            met = met.where(F.col("low") < end)
        files = [r["file"] for r in met.select("file").collect()]  # a name a file
        if not files:
            return self.spark.createDataFrame([], schema)
        return prefix_range(self.spark.read.schema(schema).parquet(*files), "key", prefix, start_after, end)

    def merge(self, changes: DataFrame, fences: DataFrame | None = None) -> int:
        """A new version after changes (the rows' columns, ``deleted``); the number of files that were rewritten.

        A key's newest state counts, of equal times the change. Changes of fenced runs (run_id) are
        refused. Keys beyond the last file make files of their own, dealt by range, so that a
        batch of new keys is as many tasks as it needs; the others go to the file whose range they fall into.
        """
        columns = [c for c in changes.columns if c != "deleted"]
        if fences is not None:
            changes = fenced(changes, fences)
        known = self.manifest().orderBy("low").toPandas()  # a row a file
        lows, last = np.array(known["low"], dtype=object), max(known["high"], default="")

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
                at = [-1 if not len(lows) or k > last else max(0, int(np.searchsorted(lows, k, "right")) - 1) for k in keys]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "place"])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changes.schema)
        dealt = changes.mapInArrow(placed, f"{kinds}, place int").withColumn("deleted", F.coalesce("deleted", F.lit(False)))
        touched = sorted(r["place"] for r in dealt.select("place").distinct().collect())  # as many as there are files at most
        parts = []
        if -1 in touched:
            fresh = self._alive(dealt.where("place = -1"), columns)
            parts.append(self._write(fresh.select(columns).repartitionByRange("key").sortWithinPartitions("key")))
        old = [i for i in touched if i >= 0]
        if old:
            name = F.element_at(F.create_map(*[F.lit(x) for i in old for x in (known["file"][i], i)]), F.col("_metadata.file_path"))
            slot = F.element_at(F.create_map(*[F.lit(x) for n, i in enumerate(old) for x in (i, n)]), F.col("place"))
            schema = dealt.select(columns).schema
            before = self.spark.read.schema(schema).parquet(*known["file"][old]).select(*columns, F.lit(False).alias("deleted"), name.alias("place"))
            both = before.withColumn("__new", F.lit(0)).unionByName(dealt.where("place >= 0").select(*columns, "deleted", "place").withColumn("__new", F.lit(1)))
            kept = self._alive(both, [*columns, "place"])
            parts.append(self._write(kept.repartitionById(len(old), slot).sortWithinPartitions("key").select(columns)))
        files = self.spark.createDataFrame(known.drop(index=old), MANIFEST) if len(known) > len(old) else self.spark.createDataFrame([], MANIFEST)
        for part in parts:
            files = files.unionByName(part)
        version = self.version()
        self._commit(files, 0 if version is None else version + 1)
        return len(old)

    def _alive(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """Each key's newest row, unless it is a deletion."""
        order = F.struct(self.at, "__new") if "__new" in rows.columns else F.col(self.at)
        return rows.groupBy("key").agg(F.max_by(F.struct(*columns, "deleted"), order).alias("r")).where("not r.deleted").select(*(f"r.{c}" for c in columns))
