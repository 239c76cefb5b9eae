"""Line dedup by how many distinct sites a line appears on.

A HyperLogLog sketch of sites is built for each line hash; sketches of the same
line merge by aggregation, so a line on every page costs one sketch a task.
Lines whose estimate is within the sketch's error of the threshold are counted
exactly. Lines on enough sites are boilerplate: they stay in the document with
the smallest id that has them and leave every other one, so that no content is
lost from a corpus whose documents are themselves copied across sites.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_BYTES, Written

#: Lines on at least this many distinct sites are boilerplate.
MIN_SITES = 3
#: log2 of the sketch's registers; the relative error is 1.04 / sqrt(2 ** LG_K).
LG_K = 8
SPREADS = 4


def normalised(line: Column) -> Column:
    """What counts as the same line: lower case, runs of white space as one space, trimmed."""
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def line_key(line: Column) -> Column:
    """128 bits of hash as two longs, so that equal keys mean equal lines at any corpus size."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"))


def doc_lines(docs: DataFrame, id_col: str, text_col: str, site_col: str | None) -> DataFrame:
    """(id, site, h1, h2) for each non-blank line of each document."""
    site = F.coalesce(F.col(site_col).cast("string"), F.lit("")) if site_col else F.lit("")
    lines = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), normalised)
    shown = docs.select(F.col(id_col).alias("id"), site.alias("site"), F.explode(F.filter(lines, lambda x: x != "")).alias("line"))
    return shown.select("id", "site", line_key(F.col("line")).alias("k")).select("id", "site", "k.h1", "k.h2")


def boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source"
) -> DataFrame:
    """(h1, h2, first) of the lines on ``min_sites`` or more distinct sites; first is the smallest id with the line.

    A null site is the site "". The estimate decides a line when it is more
    than four standard errors and one from the threshold; others are counted.
    """
    rows = doc_lines(docs, id_col, text_col, site_col)
    margin = 4 * 1.04 / math.sqrt(2**lg_k)
    high = math.ceil(min_sites * (1 + margin)) + 1
    low = math.floor(min_sites * (1 - margin)) - 1
    estimates = (
        rows.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.hll_sketch_agg("site", lg_k).alias("sketch"))
        # a line seen fewer than min_sites times is on fewer sites: the count is an exact bound
        .where(F.col("n") >= min_sites)
        .select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= low)
    )
    estimates = Written(estimates)
    sure = estimates.df.where(F.col("sites") > high).select("h1", "h2", "first")
    unsure = estimates.df.where(F.col("sites") <= high).select("h1", "h2", "first")
    if estimates.small(BROADCAST_BYTES):
        unsure = F.broadcast(unsure)
    pairs = rows.select("h1", "h2", "site").join(unsure, ["h1", "h2"]).distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"), F.min("first").alias("first"))
    return sure.unionByName(exact.where(F.col("sites") >= min_sites).select("h1", "h2", "first"))


def remove_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source"
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and n_lines, n_removed added.

    Lines are cut at the newline; blank ones stay and are not counted. A null
    text stays null. Documents that lose every line keep an empty text. Rows of
    the same id are one document; a null id is smaller than none, so its rows
    keep a line only where no id has it. Other columns pass through, whatever
    their names.

    Line keys are joined with the boilerplate keys (broadcast when that table is
    small, else dealt out with a salt so that a line of a third of all documents
    is spread). The positions of the lines that a document loses come back to it
    by 128 bits of hash of its id and text, and the lines between them are put
    together again, so the work is linear in the text.
    """
    common = Written(boilerplate(docs, min_sites, lg_k, id_col, text_col, site_col))
    row = [F.xxhash64(F.col(id_col), F.col(text_col)), F.xxhash64(F.lit("row"), F.col(id_col), F.col(text_col))]
    lines = F.transform(F.split(F.col(text_col), "\n"), normalised)
    placed = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), row[0].alias("r1"), row[1].alias("r2"), F.posexplode(lines).alias("at", "line")
    )
    keys = placed.where("line <> ''").select("id", "r1", "r2", "at", line_key(F.col("line")).alias("k")).select("id", "r1", "r2", "at", "k.h1", "k.h2")
    if common.small():
        met = keys.join(F.broadcast(common.df), ["h1", "h2"])
    else:
        salts = F.sequence(F.lit(0), F.lit(SPREADS - 1))
        spread = common.df.withColumn("salt", F.explode(salts))
        met = keys.withColumn("salt", F.pmod("r1", F.lit(SPREADS)).cast("int")).join(spread, ["h1", "h2", "salt"])
    met = met.where(~F.col("id").eqNullSafe(F.col("first")))
    # a document's positions: as many as it has lines; equal rows have equal ones
    dropped = Written(met.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("at")).alias("gone")))
    side = F.broadcast(dropped.df) if dropped.small() else dropped.df.hint("shuffle_hash")
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), row[0].alias("r1"), row[1].alias("r2"))
    joined = packed.join(side, ["r1", "r2"], "left").withColumn("lines", F.split(F.col("doc")[text_col], "\n"))

    # positions with one before the first line and one behind the last; what stays lies between neighbours
    bounds = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("lines")))
    joined = joined.withColumn("bounds", F.when(F.col("gone").isNotNull(), bounds))
    between = F.transform(
        F.sequence(F.lit(1), F.size("bounds") - 1),
        lambda i: F.slice("lines", F.get("bounds", i - 1) + 2, F.get("bounds", i) - F.get("bounds", i - 1) - 1),
    )
    text = F.when(F.col("gone").isNotNull(), F.array_join(F.flatten(between), "\n")).otherwise(F.col("doc")[text_col])
    counted = {
        "n_lines": F.coalesce(F.size(F.filter("lines", lambda x: x.rlike(r"\S"))), F.lit(0)),
        "n_removed": F.coalesce(F.size("gone"), F.lit(0)),
    }
    named = [c for c in docs.columns if c not in counted]
    return joined.select(
        *((text if c == text_col else F.col("doc")[c]).alias(c) for c in named),
        *(F.greatest(c, F.lit(0)).cast("long").alias(n) for n, c in counted.items()),
    )
