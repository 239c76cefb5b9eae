"""A trie over conversations, built by an LCP-aware merge sort.

Conversations are sequences of turns; those that start alike share nodes. A
sequence is a string of 22-byte tokens (a turn's digest and its length), so
sequences sort by bytes and no text travels after the first projection.

* Equal sequences become one row, with their ids' count, least id and digest.
* Each task sorts the rows it has into runs. A row carries the number of leading
  turns that it shares with its predecessor in the run (its LCP).
* Rows go to ranges of the sorted order. A range merges its runs in a loser
  tree: of two rows the one with the longer LCP to the last output comes first,
  and only equal LCPs make turns be compared, from there on.
* The merged stream with its LCPs walks the trie in depth-first order. An open
  path is a stack: the nodes below the LCP are finished, and are emitted with
  their subtree's sums once their parent is finished.
* Nodes on the path of a range's first or last row may go on in the next range.
  These few are put together by path: those in one range only are whole, the
  others add their ranges' sums and those of the nodes below that span ranges.

Nothing depends on where the ranges' bounds fall, so a first turn that a third
of all conversations share is split like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Written, lookup_side

#: Bytes of a token: 16 of the digest of role and text, 6 of the text's length.
TOKEN = 22
#: Rows and bytes of a run that a task sorts at once.
RUN_ROWS, RUN_BYTES = 20_000, 8 << 20
#: Bytes of distinct sequences (as written) that a range has.
RANGE_BYTES = 4 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- sequences ------------------------------------------------------------------------------------


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, tokens): each conversation's tokens in turn order.

    A null turn comes first; equal turns are put in order of role and token.
    Rows without a conversation are left out. A token is the start of the
    SHA-256 of role and text (null: empty) and the text's bytes, in hexadecimal.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text)
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    token = F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(size.cast("long")), 12, "0"))
    rows = turns.where("conv_id is not null").select("conv_id", F.struct("turn", role.alias("role"), token.alias("token")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.token").alias("tokens"))


def branched(seqs: DataFrame, siblings: int = 5, longest: int = 9) -> DataFrame:
    """Conversations rebuilt on the first turns of another.

    The first h turns of conversation c - c % siblings (none if it is absent)
    come before c's own turns after its first h; h is crc32(c) % longest.
    """
    base = F.col("conv_id") - F.col("conv_id") % siblings
    own = seqs.select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int").alias("h"), "tokens")
    heads = seqs.where(F.col("conv_id") % siblings == 0).select(F.col("conv_id").alias("base"), F.slice("tokens", 1, longest - 1).alias("head"))
    both = own.join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<string>"))
    tail = F.expr("slice(tokens, h + 1, greatest(size(tokens) - h, 0))")
    return both.select("conv_id", F.concat(head, tail).alias("tokens"))


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """(seq, n, least, ends): distinct sequences with their conversations' number, smallest id and ids' digest.

    A digest is sequential, so the ids of one sequence stream through one task
    in order; nothing but the digest's state is kept.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, least, state = None, 0, 0, None
        out: list[tuple] = []
        for batch in batches:
            for seq, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if seq != now:
                    if now is not None:
                        out.append((now, n, least, state.hexdigest()))
                    now, n, least, state = seq, 0, conv, hashlib.sha256()
                state.update(b",%d" % conv if n else b"%d" % conv)
                n += 1
            if len(out) >= 5000:
                yield _arrow(out, SEQUENCE)
                out = []
        if now is not None:
            out.append((now, n, least, state.hexdigest()))
        yield _arrow(out, SEQUENCE)

    flat = seqs.select(F.unhex(F.array_join("tokens", "")).alias("seq"), "conv_id").withColumn("h", F.xxhash64("seq"))
    dealt = flat.repartition("h").sortWithinPartitions("h", "seq", "conv_id")
    return dealt.select("seq", "conv_id").mapInArrow(rows, "seq binary, n long, least long, ends string")


SEQUENCE = [("seq", pa.binary()), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())]
RUN = [*SEQUENCE, ("run", pa.string()), ("at", pa.int64()), ("lcp", pa.int64())]


def _arrow(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


# -- sorting --------------------------------------------------------------------------------------


def lcp(a: bytes, b: bytes, known: int = 0) -> int:
    """Leading tokens that two sequences share; ``known`` of them are known to."""
    most = min(len(a), len(b)) // TOKEN
    while known < most and a[known * TOKEN : (known + 1) * TOKEN] == b[known * TOKEN : (known + 1) * TOKEN]:
        known += 1
    return known


def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (seq, n, least, ends) as sorted runs: (..., run, place in the run, LCP with the row before)."""
    held: list[tuple] = []
    size = 0

    def run():
        held.sort()
        digest = hashlib.sha256()
        for r in held:
            digest.update(r[0])
        name, before = digest.hexdigest()[:32], b""  # by its content, so that a task run again gives the same run
        rows = []
        for at, r in enumerate(held):
            rows.append((*r, name, at, lcp(before, r[0])))
            before = r[0]
        return _arrow(rows, RUN)

    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(r)
            size += len(r[0]) + 100
            if len(held) >= RUN_ROWS or size >= RUN_BYTES:
                yield run()
                held, size = [], 0
    if held:
        yield run()


def merged(runs: list[list[tuple]]) -> Iterator[tuple[int, tuple]]:
    """(LCP with the row before, row) of all rows in order; runs are rows (LCP with the row before, seq, ...).

    A loser tree: each inner place keeps the row that lost there and the turns
    it shares with the one it lost to. The new row of the winner's run meets the losers on its way up.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[Iterator] = [iter(r) for r in runs] + [iter(())] * (k - len(runs))

    def play(a, b):
        """(winner, loser) of two entries (LCP with the last output, row, run); the loser's LCP becomes that with the winner."""
        if a[1] is None or b[1] is None:
            return (b, a) if a[1] is None else (a, b)
        if a[0] != b[0]:
            return (a, b) if a[0] > b[0] else (b, a)
        x, y = a[1][1], b[1][1]
        shared = lcp(x, y, a[0])
        at = shared * TOKEN
        first, last = (a, b) if x[at : at + TOKEN] <= y[at : at + TOKEN] else (b, a)
        return first, (shared, last[1], last[2])

    def pull(run, start=False):
        row = next(heads[run], None)
        return (0 if start or row is None else row[0], row, run)

    losers: list = [None] * k
    level = [pull(i, True) for i in range(k)]
    width = k
    while width > 1:
        width //= 2
        following = []
        for i in range(width):
            winner, losers[width + i] = play(level[2 * i], level[2 * i + 1])
            following.append(winner)
        level = following
    top = level[0]
    while top[1] is not None:
        yield top[0], top[1]
        entry = pull(top[2])
        place = (k + top[2]) // 2
        while place:
            entry, losers[place] = play(entry, losers[place])
            place //= 2
        top = entry


# -- the walk -------------------------------------------------------------------------------------


class Node:
    """An open or finished node; sums are over what has been seen of its subtree."""

    __slots__ = ("depth", "path", "size", "n", "least", "ends", "children", "leaves", "saved", "waiting", "edge")

    def __init__(self, depth: int, path: bytes | None, size: int):
        self.depth, self.path, self.size = depth, path, size
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.ends, self.edge = None, NO_ENDS, False
        self.waiting: list[Node] = []


NODE = [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [("ends_sha256", pa.string())]
#: A node on the path of a range's first or last row: whole sums, the sums without children of this kind, and its path.
EDGE = [*NODE, ("kind", pa.string()), ("path", pa.binary()), ("own", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64())]
EDGE_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "kind string, path binary, own long, children long, leaves long, saved long"
)


def walk(stream: Iterator[tuple[int, tuple]]) -> Iterator[tuple]:
    """Finished nodes (see EDGE) of sorted rows (LCP with the row before, (…, seq, n, least, ends)).

    ``kind`` is ``inner`` for a finished node with its parent's id, ``hanging``
    for one whose parent (at ``path``) may go on in another range, ``edge`` for a
    node that may itself. For the latter ``children``, ``leaves`` and ``saved`` leave out its
    edge children and its own savings; ``own`` is its length.
    """
    stack = [Node(0, b"", 0)]
    last_seq = None
    first = True

    def close(final: bool) -> Iterator[tuple]:
        node = stack.pop()
        if final:
            node.edge = True
        leaf = not node.children
        children, leaves, saved = node.children, node.leaves + leaf, node.saved + (node.n - 1) * node.size
        if node.edge:
            inner = [w for w in node.waiting if not w.edge]
            yield (
                node.least, node.depth, None, node.n, children, leaves, saved, node.ends, "edge", node.path, node.size,
                len(inner), sum(w.leaves for w in inner), sum(w.saved for w in inner),
            )
        for w in node.waiting:
            if not w.edge:
                yield (w.least, w.depth, None if node.edge else node.least, w.n, w.children, w.leaves, w.saved, w.ends, "hanging" if node.edge else "inner", node.path if node.edge else None, None, None, None, None)
        node.waiting = []
        node.leaves, node.saved = leaves, saved
        if stack:
            up = stack[-1]
            up.children += 1
            up.leaves += leaves
            up.saved += saved
            up.waiting.append(node)

    for shared, row in stream:
        seq, n, least, ends = row[1:5]
        while len(stack) > shared + 1:
            yield from close(False)
        for depth in range(len(stack), len(seq) // TOKEN + 1):
            token = seq[(depth - 1) * TOKEN : depth * TOKEN]
            node = Node(depth, seq[: depth * TOKEN] if first else None, int.from_bytes(token[16:], "big"))
            node.edge = first
            stack.append(node)
        for node in stack:
            node.n += n
            node.least = least if node.least is None else min(node.least, least)
        stack[-1].ends = ends
        last_seq, first = seq, False
    if last_seq is not None:
        for node in stack:
            node.path = last_seq[: node.depth * TOKEN]
        while stack:
            yield from close(True)


def walk_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range from the pieces of runs that fall into it."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for seq, n, least, ends, run, at, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs.setdefault(run, []).append((at, shared, seq, n, least, ends))
    pieces = [[r[1:] for r in sorted(run)] for run in runs.values()]
    del runs
    out: list[tuple] = []
    for node in walk(merged(pieces)):
        out.append(node)
        if len(out) >= 5000:
            yield _arrow(out, EDGE)
            out = []
    yield _arrow(out, EDGE)


# -- the trie -------------------------------------------------------------------------------------


def joined_edges(edges: DataFrame) -> Written:
    """One row per node on ranges' bounds, whole, from the parts that ranges have of it.

    A node that one range alone has is whole already. Of the others, every sum
    is that of the ranges' finished nodes, of whole children on the bounds, and
    of the nodes below that span ranges: each of these is sent to its ancestors.
    """
    parts = edges.groupBy("path").agg(
        F.count(F.lit(1)).alias("ranges"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))).alias("ends"), F.first("own").alias("own"),
        *(F.first(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")), *(F.sum(c).alias(c) for c in ("children", "leaves", "saved")),
    )
    parts = Written(parts.withColumn("up", F.expr(f"case when depth > 0 then substring(path, 1, cast((depth - 1) * {TOKEN} as int)) end")))
    below = parts.df.where("up is not null").groupBy(F.col("up").alias("path")).agg(
        F.count(F.lit(1)).alias("c_children"), *(F.sum(F.when(F.col("ranges") == 1, F.col(c)).otherwise(0)).alias(f"c_{c}") for c in ("n_leaves", "saved_tokens")),
    )
    spanning = parts.df.where("ranges > 1").join(below, "path", "left").na.fill(0, ["c_children", "c_n_leaves", "c_saved_tokens"])
    spanning = spanning.withColumn("all_children", F.col("children") + F.col("c_children"))
    own_leaves = F.col("leaves") + F.col("c_n_leaves") + F.when(F.col("all_children") == 0, 1).otherwise(0)
    own_saved = F.col("saved") + F.col("c_saved_tokens") + (F.col("n_convs") - 1) * F.col("own")
    spanning = spanning.select("path", "depth", "all_children", own_leaves.alias("l"), own_saved.alias("s"))
    ancestors = F.expr(f"transform(sequence(0L, depth), d -> substring(path, 1, cast(d * {TOKEN} as int)))")
    sums = spanning.select(F.explode(ancestors).alias("path"), "l", "s").groupBy("path").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    sums = sums.join(spanning.select("path", "all_children"), "path")
    whole = parts.df.join(sums, "path", "left")
    picked = {"n_children": "all_children", "n_leaves": "l", "saved_tokens": "s"}
    whole = whole.select(
        "path", "up", "conv_id", "depth", "n_convs", *(F.coalesce(new, c).alias(c) for c, new in picked.items()), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    )
    done = Written(whole)
    parts.drop()
    return done


def trie(seqs: DataFrame, ranges: Callable[[Written], int] | None = None) -> DataFrame:
    """One row per node of the trie over sequences (conv_id, tokens).

    Columns: conv_id (the smallest member), depth, parent_conv_id (the
    parent's conv_id; null for the root), n_convs (members), n_children,
    n_leaves (childless nodes of the subtree, the node itself included),
    saved_tokens (over the subtree, bytes of a node's last text times its
    members but one) and ends_sha256 (digest of the ids of members that end at the node, ascending, with commas).

    Each conv_id counts once; an empty sequence ends at the root. No
    conversations give no nodes, not even a root.
    """
    distinct = Written(distinct_sequences(seqs))
    pieces = ranges(distinct) if ranges else max(1, min(distinct.bytes() // RANGE_BYTES + 1, 100_000))
    runs = distinct.df.mapInArrow(sorted_runs, "seq binary, n long, least long, ends string, run string, at long, lcp long")
    found = Written(runs.repartitionByRange(pieces, "seq").mapInArrow(walk_range, EDGE_SCHEMA))
    distinct.drop()
    names = [n for n, _ in NODE]
    edges = joined_edges(found.df.where("kind = 'edge'"))
    side = lookup_side(edges).select(F.col("path").alias("at"), F.col("conv_id").alias("parent"))
    inner = found.df.where("kind = 'inner'").select(names)
    hanging = found.df.where("kind = 'hanging'").join(side, F.col("path") == F.col("at")).withColumn("parent_conv_id", F.col("parent")).select(names)
    bounds = edges.df.join(side, F.col("up") == F.col("at"), "left").withColumn("parent_conv_id", F.col("parent")).select(names)
    return inner.unionByName(hanging).unionByName(bounds)


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text), rebuilt by ``branched``; see ``trie`` and ``sequences``.

    Null roles and texts are empty ones. Rows with a null conv_id are left out.
    Repeated rows are turns of their own. Other columns are ignored.
    """
    return trie(branched(sequences(turns)))
