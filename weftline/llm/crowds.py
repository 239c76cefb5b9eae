"""Exact Jaccard links inside crowds, as products of dense blocks.

A crowd is a set of documents that some search has put together: whoever shares a
key, or a common n-gram, with another is in its crowd. A crowd is cut into blocks of rows, and each
pair of blocks is a task of its own, which multiplies the two blocks as dense
matrices over their common columns. Blocks are first multiplied with themselves and
with one other; pairs of blocks that have come to lie in one component are left out then. So
a family of any size is never one task, nor a list of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Written, lookup_side
from weftline.llm.components import connected_components, forest

#: Rows and n-grams of a block of a crowd, and columns and rows of the dense products.
BLOCK_ROWS, BLOCK_GRAMS, DENSE_COLUMNS, STRIP = 1024, 1_000_000, 4096, 256


def dense_links(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in x, in y) of sets that are similar enough; both lists ascend in size.

    Strips of rows whose sizes exclude each other are left out. The others are multiplied over the columns
    that both lists have, some thousands at a time, adding up overlaps.
    """

    def entries(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (gx, rx), (gy, ry) = entries(x), entries(y)
    shared = np.intersect1d(gx, gy)
    nx, ny = (np.array([len(s) for s in sets], np.int64) for sets in (x, y))

    def placed(g, r):
        at = np.searchsorted(shared, g)
        ok = at < len(shared)
        ok[ok] = shared[at[ok]] == g[ok]
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], r[ok][order]

    (cx, rx), (cy, ry) = placed(gx, rx), placed(gy, ry)
    overlap = np.zeros((len(x), len(y)), np.float32)
    strips = [
        (i, j)
        for i in range(0, len(x), STRIP)
        for j in range(0, len(y), STRIP)
        if 100 * nx[i : i + STRIP][-1] >= percent * ny[j] and 100 * ny[j : j + STRIP][-1] >= percent * nx[i]
    ]
    for lo in range(0, len(shared), DENSE_COLUMNS):
        dense = []
        for c, r, n in ((cx, rx, len(x)), (cy, ry, len(y))):
            part = slice(*np.searchsorted(c, (lo, lo + DENSE_COLUMNS)))
            m = np.zeros((n, min(DENSE_COLUMNS, len(shared) - lo)), np.float32)
            m[r[part], c[part] - lo] = 1
            dense.append(m)
        for i, j in strips:
            overlap[i : i + STRIP, j : j + STRIP] += dense[0][i : i + STRIP] @ dense[1][j : j + STRIP].T
    return np.nonzero((100 + percent) * overlap.astype(np.int64) >= percent * (nx[:, None] + ny))


def block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) between the components of two blocks: rows (lo, hi, block, node, part, grams) of one pair."""
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    block, node, part = (table.column(c).to_numpy() for c in ("block", "node", "part"))
    sets = [np.asarray(g.values).view(np.uint64) for g in table.column("grams")]
    order = np.array(sorted(range(len(sets)), key=lambda i: (len(sets[i]), node[i])))
    left, right = (order[block[order] == b] for b in (lo, hi))
    found = np.empty((2, 0), np.int64)
    if len(left) and len(right):
        u, v = dense_links([sets[i] for i in left], [sets[i] for i in right], percent)
        u, v = left[u], right[v]
        new = part[u] != part[v]
        names, place = np.unique(part, return_inverse=True)
        if new.any():
            # One link for each step between components is enough.
            a, b = forest(place[u[new]], place[v[new]], len(names))
            found = np.stack((names[a], names[b]))
    return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], names=["a", "b"])


def blocks_of(size: str) -> Column:
    """How many blocks a group's rows make."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum(size) / BLOCK_GRAMS))


def crowd_links(crowds: DataFrame, sets: DataFrame, percent: int, *, all_pairs: bool) -> Written:
    """Links of rows (node, crowd, size, part) with sets (node, size, grams): between components (``part``) of a crowd.

    Blocks are dealt by a hash of the node. Without ``all_pairs`` each block meets itself and the
    crowd's first one; with it, components of half a block or more have blocks of
    their own, as have classes of size, and all blocks meet but those of one component and those of
    classes that are not neighbours: sets of such sizes can't be similar enough.
    """
    rows, own, level = crowds, F.lit(None).cast("long"), F.lit(0)
    if all_pairs:
        large = rows.groupBy("crowd", "part").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= BLOCK_ROWS // 2).select("crowd", "part", F.col("part").alias("own"))
        rows = rows.join(lookup_side(Written(large)), ["crowd", "part"], "left")
        own = F.col("own")
        # A class is a little wider than the sizes that one set may be similar to.
        level = F.floor(F.ln(F.greatest("size", F.lit(1))) / (1.001 * max(math.log(100 / percent), 0.01))).cast("int")
    rows = rows.withColumn("own", own).withColumn("level", level)
    by_own = rows.groupBy("crowd", "own", "level").agg(blocks_of("size").alias("blocks"))
    # A crowd has few large components: one for each half block of its rows at most.
    listed = by_own.groupBy("crowd").agg(F.sort_array(F.collect_list(F.struct("own", "level", "blocks"))).alias("l"), F.sum("blocks").alias("total"))
    first = F.expr("transform(l, (x, i) -> struct(x.own as own, x.level as level, x.blocks as blocks, aggregate(slice(l, 1, i), 0L, (t, y) -> t + y.blocks) as first))")
    placed = listed.select("crowd", "total", first.alias("l")).select(F.col("crowd").alias("crowd2"), "total", "l", F.explode("l").alias("x"))
    meets = F.expr("filter(l, y -> abs(y.level - x.level) <= 1 and (x.own is null or not y.own <=> x.own))") if all_pairs else F.slice("l", 1, 1)
    placed = placed.select("crowd2", "total", F.col("x.own").alias("own2"), F.col("x.level").alias("level2"), "x.blocks", "x.first", meets.alias("meets"))
    rows = rows.join(lookup_side(Written(placed)), (F.col("crowd") == F.col("crowd2")) & F.col("own").eqNullSafe(F.col("own2")) & (F.col("level") == F.col("level2")))
    rows = rows.withColumn("block", F.col("first") + F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")))
    if all_pairs:
        others = F.expr("flatten(transform(meets, y -> sequence(y.first, y.first + y.blocks - 1)))")
    else:
        others = F.expr("case when block = 0 then sequence(0L, total - 1) else array(0L, block) end")
    rows = rows.withColumn("other", F.explode(others))
    sides = Written(rows.select("crowd", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "part"))
    met = sets.select("node", "grams").join(lookup_side(sides), "node")
    met = met.groupBy("crowd", "lo", "hi").applyInArrow(lambda t: block_links(t, percent), "a long, b long")
    met = Written(met.distinct())
    sides.drop()
    return met


def repeated_ids(rows: DataFrame, id_col: str = "id") -> Written | None:
    """The ids that several rows have; None if there are none."""
    found = Written(rows.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col(id_col).alias("node")))
    return found if found.df.take(1) else None


def texts_of(texts: DataFrame, nodes: Written, repeated: Written | None) -> DataFrame:
    """(node, text) of the given nodes among texts (node, text), each text of a node once."""
    rows = texts.join(lookup_side(nodes), "node", "left_semi")
    if repeated is None:
        return rows
    again = lookup_side(repeated)
    return rows.join(again, "node", "left_anti").unionByName(rows.join(again, "node", "left_semi").dropDuplicates())


def crowd_components(edges: DataFrame, sets_of: Callable[[Written], DataFrame], percent: int, found: Written | None = None, sizes: DataFrame | None = None) -> Written:
    """(node, component) by all links of ``percent`` hundredths inside the crowds that edges (a, b) make, and by ``found`` so far.

    ``sets_of`` gives (node, size, grams) for a table of nodes. An edge need not be a link. Without edges the result is ``found``, or empty.
    With ``sizes`` (node, size) known for all nodes, sets are made where they are compared and written nowhere.
    """
    found = found or Written(edges.sparkSession.createDataFrame([], "node long, component long"))
    members = Written(connected_components(edges).withColumnRenamed("component", "crowd"))
    if not members.df.take(1):
        members.drop()
        return found
    sets = Written(sets_of(members)) if sizes is None else None
    crowd = Written(members.df.join(sets.df.groupBy("node").agg(F.sum("size").alias("size")) if sets else sizes, "node"))
    members.drop()
    for all_pairs in (False, True):
        parted = Written(crowd.df.join(lookup_side(found), "node", "left").select("node", "crowd", "size", F.coalesce("component", "node").alias("part")))
        by_crowd = parted.df.groupBy("crowd").agg(F.min("part").alias("x"), F.max("part").alias("y"), blocks_of("size").alias("blocks"))
        # The first time, all pairs of up to two blocks have met.
        open_ = Written(by_crowd.where("x <> y" + (" and blocks > 2" if all_pairs else "")).select("crowd"))
        if open_.df.take(1):
            rows = parted.df.join(lookup_side(open_), "crowd", "left_semi")
            nodes = None if sets else Written(rows.select("node"))
            met = crowd_links(rows, sets.df if sets else sets_of(nodes), percent, all_pairs=all_pairs)
            stars = found.df.select(F.col("node").alias("a"), F.col("component").alias("b"))
            after = Written(connected_components(stars.unionByName(met.df)))
            for done in filter(None, (found, met, nodes)):
                done.drop()
            found = after
        for done in (parted, open_):
            done.drop()
    for done in filter(None, (crowd, sets)):
        done.drop()
    return found
