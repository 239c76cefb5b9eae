"""How five filters interact: one mask a document, 32 cells a part, every order of the filters from the cells.

Built-in functions alone. A filter that fails a document sets its bit:

* A: under 200 words;
* B: fewer than half of the words are distinct;
* C: over 3 in 100 code points are capital letters A-Z;
* D: one of the characters ``#$%&*|`` stands in the text;
* E: a smaller id has the identical text, anywhere in the table.

A to D follow from the text alone, E from the text's smallest id, which a
grouping by the text's SHA-256 digest gives. Equal texts are merged before the
shuffle, so a group of copies of any size is a few rows to each task, and no
text travels. All counts of an order of filters then come from the cells: what
is left after a set of filters is the cells without any of their bits.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
CELLS = 1 << len(FILTERS)
_SPACE = r"[\x20\x09-\x0D]+"


def text_mask(text: Column, words: Column) -> Column:
    """Failure bits A to D of a text that is not null; ``words`` are its words."""
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }
    return sum((F.when(f, BIT[name]).otherwise(0) for name, f in failed.items()), F.lit(0))


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic) as 0 or 1; an id with several labels is good or toxic if any says so, nulls say nothing."""
    is_one = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return labels.where("doc_id is not null").groupBy("doc_id").agg(*is_one)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by language and five-bit failure mask, and how many of them the labels call good or toxic."""
    text = F.coalesce("text", F.lit(""))
    prepared = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    prepared = prepared.withColumn("words", F.array_remove(F.split("text", _SPACE), ""))
    rows = prepared.select("doc_id", "part", text_mask(F.col("text"), F.col("words")).alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    # A text's rows of one id and language are one row from here, so ids are compared once each.
    rows = rows.groupBy("digest", "part", "mask", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(label_flags(labels), "doc_id", "left")
    counts = {"n": F.col("n"), "good": F.col("n") * F.coalesce("good", F.lit(0)), "toxic": F.col("n") * F.coalesce("toxic", F.lit(0))}
    rows = rows.select("doc_id", "digest", "part", "mask", *(c.alias(name) for name, c in counts.items()))
    known = F.col("doc_id").isNotNull()
    texts = rows.groupBy("digest", "part", "mask").agg(
        F.min("doc_id").alias("least"),
        F.min_by(F.struct(*counts), "doc_id").alias("first"),
        *(F.sum(F.when(known, F.col(c))).alias(c) for c in counts),
        *(F.sum(F.when(~known, F.col(c))).alias(f"{c}_no_id") for c in counts),
    )
    # A text has one row for each language here.
    is_first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    zero = F.lit(0).cast("long")
    passed = [F.coalesce(F.when(is_first, F.col(f"first.{c}")), zero).alias(f"{c}_kept") for c in counts]
    judged = texts.select("part", "mask", *counts, *(f"{c}_no_id" for c in counts), *passed)
    kept = [(F.col(f"{c}_kept") + F.coalesce(f"{c}_no_id", zero)).alias(c) for c in counts]
    copies = [(F.coalesce(c, zero) - F.col(f"{c}_kept")).alias(c) for c in counts]
    both = F.array(
        F.struct(F.col("mask"), *kept),
        F.struct((F.col("mask") + BIT["E"]).alias("mask"), *copies),
    )
    cells = judged.select("part", F.explode(both).alias("cell")).select("part", "cell.*")
    return cells.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in counts))


def orders_from_cells(cells: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic)."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for i, name in enumerate(order):
            steps.append((f"'{''.join(order)}'", i + 1, before, BIT[name]))
            before |= BIT[name]
    table = F.expr("array(" + ",".join(f"named_struct('filter_order', {o}, 'step', {s}, 'before', {b}, 'bit', {f})" for o, s, b, f in steps) + ")")
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    rows = parts.select("part", "cells", F.explode(table).alias("s")).select("part", "cells", "s.*")

    def total(counted: str, where: str) -> Column:
        return F.expr(f"aggregate(filter(cells, c -> {where}), 0L, (t, c) -> t + c.{counted})")

    removed = "(c.mask & before) = 0 and (c.mask & bit) <> 0"
    # A document that k filters fail is removed by each of them in 120 / k orders.
    shapley = F.expr("aggregate(filter(cells, c -> (c.mask & bit) <> 0), 0L, (t, c) -> t + c.n * (120 div bit_count(c.mask)))")
    return rows.select(
        "part", "filter_order", "step",
        total("n", "(c.mask & (before | bit)) = 0").alias("kept"), total("n", removed).alias("removed"),
        total("n", "(c.mask & before) <> 0 and (c.mask & bit) <> 0").alias("redundant"), total("n", "c.mask = bit").alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"), shapley.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step: what the step keeps, removes and could have removed.

    Columns: part (the language, null as empty), filter_order, step (1 to 5),
    and the long counts kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley (its filter's removals over all 120 orders, in sum).

    A null text is empty. Rows with the same id and text don't remove each
    other, each is counted. A null id is smaller than none and has no label,
    so such rows never fail E. An id with several label rows is good or toxic if any
    of them says so. Other columns are ignored. An empty table has no parts
    and gives no rows.
    """
    return orders_from_cells(masks(docs, labels))
