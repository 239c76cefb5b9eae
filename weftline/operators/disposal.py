"""Paged disposal of what an ended run leaves: hooks, then hook markers, then waits, a bounded page at a time.

A page is a rank divided by the page size, so all pages of all runs are known
at once; rounds take the next ones by a table of progress and can stop and go on anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.numbering import numbered

#: Phases in their order, and how much a page of each takes.
PAGES = {"hooks": 64, "markers": 64, "waits": 128}


def disposal_pages(runs: DataFrame, items: DataFrame, bucket: Column, sizes: dict[str, int] | None = None) -> DataFrame:
    """(run_id, generation, phase, n_taken, first_key, last_key, ends): each page of each ended run, counted from 0.

    ``items`` (run_id, phase, key) are taken by key; ``bucket`` is monotone in
    the key and cuts large runs (see ``numbering``). A phase without items still
    takes one empty page, which finds that nothing is left; ``ends`` says that the page is its run's
    last. Items of runs that aren't in ``runs``, and of other phases, stay.
    """
    sizes = sizes or PAGES
    phases = F.explode(F.array(*(F.struct(F.lit(p).alias("phase"), F.lit(i).alias("place"), F.lit(n).alias("size")) for i, (p, n) in enumerate(sizes.items()))))
    frame = runs.select("run_id").distinct().select("run_id", phases.alias("p")).select("run_id", "p.*")
    ranked = numbered(items.select("run_id", "phase", "key"), F.struct("run_id", "phase"), bucket, ["key"], "n")
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("phase"))
    taken = ranked.where(F.col("phase").isin(*sizes)).groupBy("run_id", "phase", F.floor((F.col("n") - 1) / size).cast("long").alias("page")).agg(
        F.count(F.lit(1)).alias("n_taken"), F.min("key").alias("first_key"), F.max("key").alias("last_key")
    )
    counts = taken.groupBy("run_id", "phase").agg(F.count(F.lit(1)).alias("pages"))
    places = frame.join(counts, ["run_id", "phase"], "left").withColumn("pages", F.coalesce("pages", F.lit(1)))
    listed = places.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("place", "phase", "pages"))).alias("l"))  # as many as there are phases
    before = F.expr("aggregate(slice(l, 1, i), 0L, (t, x) -> t + x.pages)")
    total = F.expr("aggregate(l, 0L, (t, x) -> t + x.pages)")
    firsts = listed.select("run_id", total.alias("total"), "l", F.posexplode("l").alias("i", "x")).select("run_id", "total", F.col("x.phase").alias("phase"), before.alias("before"))
    pages = firsts.join(taken, ["run_id", "phase"], "left")
    generation = F.col("before") + F.coalesce("page", F.lit(0))
    return pages.select(
        "run_id", generation.alias("generation"), "phase", F.coalesce("n_taken", F.lit(0)).alias("n_taken"), "first_key", "last_key", (generation + 1 == F.col("total")).alias("ends")
    )


def next_pages(pages: DataFrame, progress: DataFrame, budget: int) -> DataFrame:
    """Of each run the next ``budget`` pages after its progress (run_id, generation: the next one to take; absent: 0)."""
    done = progress.select("run_id", F.col("generation").alias("__next"))
    joined = pages.join(done, "run_id", "left").withColumn("__next", F.coalesce("__next", F.lit(0)))
    return joined.where((F.col("generation") >= F.col("__next")) & (F.col("generation") < F.col("__next") + budget)).drop("__next")


def advance(progress: DataFrame, taken: DataFrame) -> DataFrame:
    """Progress after pages have been taken; a page that is taken twice counts once."""
    after = taken.groupBy("run_id").agg((F.max("generation") + 1).alias("generation"))
    return progress.select("run_id", "generation").unionByName(after).groupBy("run_id").agg(F.max("generation").alias("generation"))
