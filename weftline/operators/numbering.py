"""Numbering in two passes, and ids that sort by time.

A running number within a group normally takes a window over the whole group, so a
group with a third of all rows is one task. Here a group is cut into buckets
that follow its order: rows are numbered within their bucket, and buckets get
their offsets from a running sum over their counts, which are few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the digits of base 32, without I, L, O and U.
DIGITS = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def numbered(rows: DataFrame, group: Column, bucket: Column, order: list[str], name: str = "n") -> DataFrame:
    """Rows with ``name``: 1, 2, 3... within their group in ``order``.

    ``bucket`` must not fall as the order rises (for example a part of its
    first column). Equal rows get numbers of their own, in no particular order. Null
    groups and buckets are groups and buckets like others; a null bucket comes first, as nulls do in the order.
    """
    keyed = rows.withColumns({"__g": group, "__b": bucket})
    counts = keyed.groupBy("__g", "__b").agg(F.count(F.lit(1)).alias("__m"))
    before = Window.partitionBy("__g").orderBy(F.col("__b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__g").alias("__g2"), F.col("__b").alias("__b2"), F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__g", "__b").orderBy(*order))
    joined = keyed.withColumn("__i", inside).join(offsets, F.col("__g").eqNullSafe(F.col("__g2")) & F.col("__b").eqNullSafe(F.col("__b2")))
    return joined.withColumn(name, (F.col("__before") + F.col("__i")).cast("long")).drop("__g", "__b", "__i", "__g2", "__b2", "__before")


def base32(number: Column, digits: int) -> Column:
    """The lowest 5 bits for each of ``digits`` digits of a long, highest first."""
    return F.concat(*(F.substring(F.lit(DIGITS), F.shiftright(number, 5 * i).bitwiseAND(31).cast("int") + 1, F.lit(1)) for i in reversed(range(digits))))


def from_base32(text: Column, start: int, digits: int) -> Column:
    """The number of so many digits, 12 at most, of a text from a place counted from 1; null for other characters."""
    values = [F.instr(F.lit(DIGITS), F.substring(text, start + i, 1)).cast("long") - 1 for i in range(digits)]
    valid = reduce(Column.__and__, [v >= 0 for v in values], F.length(F.substring(text, start, digits)) == digits)
    return F.when(valid, reduce(lambda a, v: a * 32 + v, values))


def ulids(rows: DataFrame, at_ms: str, order: list[str], bucket: Column, name: str = "id", prefix: str = "") -> DataFrame:
    """Rows with ``name``: a 26-digit id of 48 bits of time and 80 bits that rise within a millisecond.

    The first id of a millisecond has 79 bits of the time's SHA-256, each further one in ``order`` is one higher. So
    ids sort by (time, order), are unique, and are the same in every run. Times before 1970 are 0.
    """
    at = F.greatest(F.col(at_ms).cast("long"), F.lit(0))
    counted = numbered(rows, at, bucket, order, "__n")
    digest = F.sha2(at.cast("string").cast("binary"), 256)
    high = F.conv(F.substring(digest, 1, 10), 16, 10).cast("long").bitwiseAND((1 << 39) - 1)
    low = F.conv(F.substring(digest, 11, 10), 16, 10).cast("long") + F.col("__n") - 1
    made = F.concat(F.lit(prefix), base32(at, 10), base32(high + F.shiftright(low, 40), 8), base32(low, 8))
    return counted.withColumn(name, made).drop("__n")


def ulid_ms(ulid: Column) -> Column:
    """The time of an id; null if its digits are none."""
    return from_base32(ulid, 1, 10)
