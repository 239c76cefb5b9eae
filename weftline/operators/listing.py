"""Point reads and keyset pages over ordered keys.

A page is a filter on the key, an order and a limit of one row more than asked,
which plans as a per-partition top-k that is merged once; nothing but the page
reaches one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import bounded  # noqa: F401  part of the page vocabulary

#: Default page sizes and the largest page.
PAGE = {"runs": 20, "events": 100, "steps": 20, "hooks": 100, "dead_letters": 100}
LARGEST_PAGE = 1000


def page_limit(limit: int | float | None, kind: str = "runs", most: int | None = LARGEST_PAGE) -> int:
    """Rows of a page: default for none or NaN, floored, at least 1, at most ``most`` (None: no bound, as for events)."""
    if limit is None or limit != limit:
        return PAGE[kind]
    return max(1, int(limit // 1) if most is None else min(most, int(limit // 1)))


def after(keys: Sequence[str], cursor: Sequence, descending: bool = False) -> Column:
    """Rows that come after the cursor in the order of ``keys`` (before it, when descending).

    Spelled out as comparisons of single columns, so that the first reaches the scan where it is a column of the table;
    where it is an expression over one, the reader takes a bound of its own (see ``fixtures.runs``).
    """
    steps = []
    for i, (key, value) in enumerate(zip(keys, cursor, strict=True)):
        same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], cursor[:i], strict=True)]
        beyond = F.col(key) < F.lit(value) if descending else F.col(key) > F.lit(value)
        steps.append(reduce(lambda a, b: a & b, [*same, beyond]))
    bound = F.col(keys[0]) <= F.lit(cursor[0]) if descending else F.col(keys[0]) >= F.lit(cursor[0])
    return bound & reduce(lambda a, b: a | b, steps)


def page(df: DataFrame, keys: Sequence[str], limit: int, cursor: Sequence | None = None, descending: bool = False, peek: bool = True) -> DataFrame:
    """``limit`` rows after the cursor, and one more when ``peek``, that tells whether there is a next page."""
    found = df if cursor is None else df.where(after(keys, cursor, descending))
    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    return found.orderBy(*order).limit(limit + peek)


def page_with_cursor(df: DataFrame, keys: Sequence[str], limit: int, cursor: Sequence | None = None, descending: bool = False) -> DataFrame:
    """The page's rows with ``has_more`` on each: whether a row beyond the page exists."""
    from pyspark.sql import Window

    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    rows = page(df, keys, limit, cursor, descending)  # limit + 1 rows at most: one task is enough for the window
    numbered = rows.withColumn("__n", F.row_number().over(Window.orderBy(*order)))
    total = F.max("__n").over(Window.partitionBy(F.lit(1)))
    return numbered.withColumn("has_more", total > limit).where(F.col("__n") <= limit).drop("__n")


def prefix_range(df: DataFrame, key: str, prefix: str = "", start_after: str | None = None, end: str | None = None) -> DataFrame:
    """Rows whose string key has the prefix and lies strictly between the bounds, in UTF-8 byte order."""
    found = df.where(F.col(key).startswith(prefix)) if prefix else df
    if start_after is not None:
        found = found.where(F.col(key) > start_after)
    return found.where(F.col(key) < end) if end is not None else found


def get_many(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted keys, each once however often it is wanted; keys without a row are absent."""
    return df.join(wanted.select(key), key, "left_semi")


def without_payload(df: DataFrame, columns: Sequence[str] = ("input", "output")) -> DataFrame:
    """Payload elision; columns that aren't there are left alone."""
    return df.drop(*columns)


def status_excludes(indexed: Column, requested: Column) -> Column:
    """Whether a stale index status may exclude a row: only if it is terminal, or a pending run was asked for."""
    return (indexed != requested) & (indexed.isin(*TERMINAL) | (requested == "pending"))


#: Terminal states of a run.
TERMINAL = ("completed", "failed", "cancelled")


def lifecycle_status(runs: DataFrame, tombstones: DataFrame, key: str = "run_id") -> DataFrame:
    """(run_id, lifecycle) for every run or tombstone: expired, then missing, then terminal or active."""
    gone = tombstones.select(key, F.lit(True).alias("__gone")).distinct()
    joined = runs.select(key, "status").join(gone, key, "full_outer")
    state = (
        F.when(F.col("__gone"), "expired").when(F.col("status").isNull(), "missing").when(F.col("status").isin(*TERMINAL), "terminal").otherwise("active")
    )
    return joined.select(key, state.alias("lifecycle"))


def active_only(df: DataFrame, runs: DataFrame, key: str = "run_id") -> DataFrame:
    """Rows whose run is active (exists and is not terminal)."""
    return df.join(runs.where(~F.col("status").isin(*TERMINAL)).select(key), key, "left_semi")


def late_writes(df: DataFrame, expired: DataFrame, key: str = "run_id") -> DataFrame:
    """Rows with ``rejected``: whether their run has a tombstone, so that a late write is answered and not lost."""
    gone = expired.select(key, F.lit(True).alias("__gone")).distinct()
    return df.join(gone, key, "left").withColumn("rejected", F.col("__gone").isNotNull()).drop("__gone")


def fenced(df: DataFrame, expired: DataFrame, key: str = "run_id") -> DataFrame:
    """Rows whose run has no tombstone."""
    return df.join(expired.select(key), key, "left_anti")
