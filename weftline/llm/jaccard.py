"""Documents linked by the Jaccard similarity of their word n-grams, as a blocked sparse product.

With one row a document and one column an n-gram, the product of the incidence
matrix with its transpose counts what documents have in common. It is never
formed in full:

* Documents with equal n-gram sets are one row, named by the set's hash.
* Seed columns. In any order of the n-grams, two sets of similarity s share one
  of the first n - ceil(s n) + 1 of theirs. Only these entries are multiplied
  at first, column by column (a shuffle by n-gram), and the counts of a pair are
  summed. A pair goes on only if its count and all that may still come reach what the two sizes
  ask for.
* What is left hangs together in crowds, in which all columns are multiplied, as dense blocks (``crowds``): the exact overlaps.
* Seeds are taken rare n-grams first: those that over ``COLUMN`` texts have among their seeds by hash
  are counted beforehand and go to the end of the order (a broadcast of bounded size).
* Columns of more than ``COLUMN`` entries aren't multiplied out. In the first column that two sets share, all
  they have in common stands in the rest of both, from that n-gram on. So the entries of such a column
  hang together only through those whose rests reach what their sizes ask for (``reaching``): families of near copies do,
  texts that have a passage in common and little else don't. What hangs together is a crowd as well.
* Seeds are shuffled packed: a lot's entries of one part of the hash range are one row, as byte planes.

The order of the n-grams decides about work alone, not about results; so does that columns
are told apart by the first 40 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import ROWS_AT_ONCE, Written, lookup_side, utf8, with_columns
from weftline.llm.components import connected_components, forest
from weftline.llm.crowds import crowd_components, repeated_ids, texts_of
from weftline.llm.simhash import label_rows

#: Similarity in hundredths, and words of an n-gram.
PERCENT, SIZE = 80, 5
#: Entries of a column that is multiplied out.
COLUMN = 32
#: Common n-grams that are told to all tasks (8 bytes each), the most frequent ones first.
COMMON = 1_000_000
#: Entries that a task looks at together before they are shuffled.
ENTRIES = 1_000_000
#: Bits of a hash that name its column, and those of them that name its part of the hash range.
COLUMN_BITS, PART_BITS = 40, 10
#: Classes of entries of a column that are compared with others at once.
CLASSES = 256

#: An odd multiplier for each place in an n-gram, unrelated to each other, so that repeated words that change places don't cancel out.
_MULTIPLIERS = [np.uint64(xxhash.xxh64_intdigest(b"%d" % i, 12) | 1) for i in range(64)]


# -- n-gram sets ----------------------------------------------------------------------------------


def ngrams(text: bytes, size: int = SIZE) -> np.ndarray:
    """Distinct 64-bit hashes of a text's word n-grams, ascending as unsigned numbers.

    A-Z are lower-cased; words are cut at space and the controls 9 to 13. Fewer
    words than ``size`` are one n-gram of their number; no words give none.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    k = min(size, n)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total += each[i : n - k + 1 + i] * _MULTIPLIERS[i]
    total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(32)))


def seed_size(n: int, percent: int) -> int:
    """How many of n n-grams, first in a common order, must meet those of any set similar enough."""
    return n + (-percent * n // 100) + 1


def seeds(grams: np.ndarray, percent: int, common: np.ndarray) -> np.ndarray:
    """The first n-grams of a set (of none: none): those that aren't common by hash, then the common ones (``common`` is sorted)."""
    p = seed_size(len(grams), percent) if len(grams) else 0
    at = np.searchsorted(common, grams)
    known = np.zeros(len(grams), bool)
    inside = at < len(common)
    known[inside] = common[at[inside]] == grams[inside]
    return np.concatenate((grams[~known], grams[known]))[:p]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.view(np.int64) for a in arrays], pa.list_(pa.int64()))


def enough(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether sets of sizes a and b with so large an overlap are similar enough."""
    return (100 + percent) * overlap >= percent * (a + b)


# -- packed rows ----------------------------------------------------------------------------------


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as byte planes, one after the other: what ascends or is small compresses well."""
    return b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)


def unpacked(rows: pa.ChunkedArray, *types: type) -> list[np.ndarray]:
    """The arrays of packed rows, row after row; null rows have none."""
    parts: list[list[np.ndarray]] = [[np.empty(0, t)] for t in types]
    width = sum(np.dtype(t).itemsize for t in types)
    for row in rows.drop_null():
        data = np.frombuffer(row.as_buffer(), np.uint8)
        n, at = len(data) // width, 0
        for part, t in zip(parts, types, strict=True):
            size = np.dtype(t).itemsize
            part.append(np.ascontiguousarray(data[at : at + n * size].reshape(size, n).T).view(t).ravel())
            at += n * size
    return [np.concatenate(p) for p in parts]


def columns_of(grams: np.ndarray) -> np.ndarray:
    """The names of the n-grams' columns; ascending if the n-grams are."""
    return grams & np.uint64((1 << 64) - (1 << (64 - COLUMN_BITS)))


def by_part(names: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The parts of ascending names, and where their names are."""
    part = (names >> np.uint64(64 - PART_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for i, start in enumerate(starts):
        yield int(part[start]), slice(start, starts[i + 1] if i + 1 < len(starts) else len(part))


# -- columns --------------------------------------------------------------------------------------


def entries(batches: Iterator[pa.RecordBatch], most: int, percent: int = PERCENT) -> Iterator[pa.RecordBatch]:
    """Entries (gram, node, size, null, rest) of rows (node, size, head), some ENTRIES at a time.

    The rest is the number of n-grams of a set that aren't before this one. Of an n-gram's entries among these that agree
    in size and rest, and whose rest is enough for two such sets, ``most + 1`` are given, as they tell that the column is large; the others are edges
    (node, node, size, first, rest) to the first of them. So a task never gets a large family in full. A node that comes again is left out there.
    """

    def given(rows):
        heads = [np.asarray(r.column(2).flatten()) for r in rows]
        lengths = np.concatenate([r.column(2).value_lengths().to_numpy(zero_copy_only=False) for r in rows])
        node, size = (np.repeat(np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]), lengths) for i in range(2))
        gram = np.concatenate(heads)
        rest = (size - (np.arange(len(gram)) - np.repeat(np.cumsum(lengths) - lengths, lengths))).astype(np.int32)
        order = np.argsort(gram, kind="stable")
        starts = _starts(gram[order])
        many = np.repeat(np.diff(np.append(starts, len(gram))) > most, np.diff(np.append(starts, len(gram))))
        few, order = order[~many], order[many]
        order = order[np.lexsort((node[order], rest[order], size[order], gram[order]))]
        fields = [x[order] for x in (gram, size, rest, node)]
        order = order[_starts(*fields)]
        large = np.bincount(_group(gram[order]), minlength=1)[_group(gram[order])] > most if len(order) else np.empty(0, bool)
        starts = _starts(gram[order], size[order], rest[order])
        start = np.repeat(starts, np.diff(np.append(starts, len(order))))
        enough_left = (100 + percent) * rest[order].astype(np.int64) >= 2 * percent * size[order].astype(np.int64)
        over = large & enough_left & (np.arange(len(order)) - start > most)
        first = np.append(np.zeros(len(few), np.int64), node[order][start])
        over, order = np.append(np.zeros(len(few), bool), over), np.append(few, order)
        gram, node, size, rest = (x[order] for x in (gram, node, size, rest))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.where(over, node, gram), pa.int64()), pa.array(node, pa.int64()), pa.array(size, pa.int32()), pa.array(first, pa.int64(), mask=~over), pa.array(rest, pa.int32())],
            names=["gram", "node", "size", "first", "rest"],
        )

    held, n = [], 0
    for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
        held.append(batch)
        n += len(batch.column(2).flatten())
        if n >= ENTRIES:
            yield given(held)
            held, n = [], 0
    if held:
        yield given(held)


def _starts(*sorted_fields: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    if not len(sorted_fields[0]):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in sorted_fields], axis=0)))


def _group(field: np.ndarray) -> np.ndarray:
    """The number of the run that each of the sorted values is in."""
    return np.cumsum(np.append(0, field[1:] != field[:-1])) if len(field) else np.empty(0, np.int64)


def reaching(size: np.ndarray, rest: np.ndarray, percent: int) -> np.ndarray:
    """For each entry of a column the place of the first entry that it hangs together with; its own if with none.

    Two sets that share no earlier column have their rests in common at most. So they hang together
    if the smaller rest is enough for their sizes: if either size is within the other's reach.
    """
    code, at, count = np.unique(size.astype(np.int64) << 32 | rest.astype(np.int64), return_inverse=True, return_counts=True)
    n, r = code >> 32, code & 0xFFFFFFFF
    reach = ((100 + percent) * r - percent * n) // percent
    linked = (count > 1) & (n <= reach)
    us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(0, len(n), CLASSES):
        j = min(i + CLASSES, len(n))
        lo = int(np.searchsorted(n, percent * n[i] // 100))  # smaller sets are too small for all of these
        ok = (n[None, lo:j] <= reach[i:j, None]) & (n[i:j, None] <= reach[None, lo:j])
        u, v = np.nonzero(ok)
        u, v = u + i, v + lo
        u, v = u[u != v], v[u != v]
        linked[u] = linked[v] = True
        if len(u):
            names, place = np.unique(np.concatenate((u, v)), return_inverse=True)
            a, b = forest(place[: len(u)], place[len(u) :], len(names))
            us.append(names[a])
            vs.append(names[b])
    a, b = forest(np.concatenate(us), np.concatenate(vs), len(n))
    label = np.arange(len(n))
    label[a] = b
    label = label[at]
    first = np.full(len(n), len(size))
    np.minimum.at(first, label, np.arange(len(size)))
    return np.where(linked[at], first[label], np.arange(len(size)))


def column_products(batches: Iterator[pa.RecordBatch], percent: int, most: int) -> Iterator[pa.RecordBatch]:
    """From entries (gram, node, size, first, rest) sorted by gram and size: products (a, b, na, nb, near) of columns of up to ``most`` entries.

    ``near`` tells whether the rests are enough for the sizes; without rests all are the whole sets. Each entry of a larger
    column is given as an edge (node, a node of the column that it hangs together with, or itself; null, null, null); edges pass through.
    """

    def emit(a, b, na=None, nb=None, near=None):
        sizes = [pa.nulls(len(a), pa.int32()) if n is None else pa.array(n, pa.int32()) for n in (na, nb)]
        near = pa.nulls(len(a), pa.bool_()) if near is None else pa.array(near, pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *sizes, near], names=["a", "b", "na", "nb", "near"])

    def solve(gram, node, size, rest):
        starts = _starts(gram)
        sizes = np.diff(np.append(starts, len(gram)))
        small = np.flatnonzero((sizes > 1) & (sizes <= most))
        for gap in range(1, most):
            wide = small[sizes[small] > gap]
            if not len(wide):
                break
            reps = sizes[wide] - gap
            u = np.repeat(starts[wide], reps) + np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
            u = u[(100 * size[u].astype(np.int64) >= percent * size[u + gap].astype(np.int64)) & (node[u] != node[u + gap])]
            if len(u):
                swap = node[u] > node[u + gap]
                x, y = np.where(swap, u + gap, u), np.where(swap, u, u + gap)
                near = (100 + percent) * np.minimum(rest[x], rest[y]).astype(np.int64) >= percent * (size[x].astype(np.int64) + size[y])
                yield emit(node[x], node[y], size[x], size[y], near)
        for i in np.flatnonzero(sizes > most):
            part = slice(starts[i], starts[i] + sizes[i])
            yield emit(node[part], node[part][reaching(size[part], rest[part], percent)])

    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)]
    for batch in batches:
        edges = batch.filter(batch.column(3).is_valid())
        if edges.num_rows:
            yield emit(edges.column(1), edges.column(3))
            batch = batch.filter(batch.column(3).is_null())
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4 if batch.num_columns > 4 else 2)]
        rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        last = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if last:
            yield from solve(*(r[:last] for r in rows))
        held = [r[last:] for r in rows]
    if len(held[0]):
        yield from solve(*held)


def packed_entries(lots: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, entries) of lots of entries: for each part (gram or first, node, size, place; an edge has place -1)."""
    for lot in lots:
        name, node, size, first, rest = (lot.column(i) for i in range(5))
        edge = first.is_valid().to_numpy(zero_copy_only=False)
        name, node, size, rest = (x.to_numpy(zero_copy_only=False) for x in (name, node, size, rest))
        order = np.argsort(name.view(np.uint64), kind="stable")
        sorted_names = name.view(np.uint64)[order]
        name = np.where(edge, first.fill_null(0).to_numpy(zero_copy_only=False), name)[order]
        node, size, place = node[order], size[order], np.where(edge, -1, size - rest).astype(np.int32)[order]
        parts = [(part, packed(name[at], node[at], size[at], place[at])) for part, at in by_part(sorted_names)]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([d for _, d in parts], pa.binary())], names=["part", "entries"])


def part_products(table: pa.Table, percent: int, most: int) -> pa.Table:
    """Products of all columns of a part, from rows (part, entries, prints); what rows say of prints (id, h1, h2, n_shingles) is given as it is."""
    name, node, size, place = unpacked(table.column("entries"), np.int64, np.int64, np.int32, np.int32)
    edge = place < 0
    kept = np.flatnonzero(~edge)
    kept = kept[np.argsort(name[kept], kind="stable")]
    same = name[kept][1:] == name[kept][:-1]
    kept = kept[np.append(False, same) | np.append(same, False)] if len(kept) else kept  # columns of one entry have no products
    kept = kept[np.lexsort((node[kept], place[kept], size[kept], name[kept]))]
    kept = kept[_starts(*(x[kept] for x in (name, size, place, node)))]  # copies are one node

    def batch(at, first):
        return pa.RecordBatch.from_arrays([pa.array(name[at]), pa.array(node[at]), pa.array(size[at]), first, pa.array(size[at] - place[at])], names=["gram", "node", "size", "first", "rest"])

    edges = np.flatnonzero(edge)
    found = list(column_products(iter([batch(edges, pa.array(name[edges])), batch(kept, pa.nulls(len(kept), pa.int64()))]), percent, most))
    known, ids, h1, h2, n = unpacked(table.column("prints"), np.uint8, np.int64, np.int64, np.int64, np.int64)
    prints = pa.table([pa.array(ids, mask=known == 0), pa.array(h1), pa.array(h2), pa.array(n)], names=["id", "h1", "h2", "n_shingles"])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("na", pa.int32()), ("nb", pa.int32()), ("near", pa.bool_())])
    return pa.concat_tables([pa.Table.from_batches(found, schema), prints], promote_options="default")


PRODUCTS = "a long, b long, na int, nb int, near boolean, id long, h1 long, h2 long, n_shingles long"


def seed_products(packs: DataFrame, percent: int) -> Written:
    """Products (a, b, na, nb, near) of the small columns of packed seeds, edges (a, b, null, null, null) of the entries of large ones, and the prints."""
    most = COLUMN
    return Written(packs.groupBy("part").applyInArrow(lambda t: part_products(t, percent, most), PRODUCTS))


def hopeful(products: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose counts and columns still to come reach what their sizes ask for.

    All seeds of the one set whose seeds end first are below those of the other
    in the order, so what they have in common is counted, but for large columns; the rest of that set may
    be in common. And where the first column that two sets share is a small one, their rests there are enough.
    """
    counted = products.where("na is not null").groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("met"), F.max("near").alias("near"))
    later = [F.ceil(percent * F.col(n) / 100) - 1 for n in ("na", "nb")]
    large = lookup_side(Written(products.where("a is not null and na is null").groupBy("a").agg(F.count(F.lit(1)).alias("la"))))
    both = counted.where("near").join(large, "a", "left").join(large.select(F.col("a").alias("b"), F.col("la").alias("lb")), "b", "left")
    more = F.least(F.coalesce("la", F.lit(0)), F.coalesce("lb", F.lit(0)))
    return both.where(enough(F.col("met") + F.greatest(*later) + more, F.col("na"), F.col("nb"), percent)).select("a", "b").distinct()


def seed_counts(batches: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (part, counts) of columns named by arrays, some ENTRIES at a time: for each part (the name's other bits, how often)."""
    shift = np.uint64(64 - COLUMN_BITS)

    def given(arrays):
        names, n = np.unique(np.concatenate(arrays), return_counts=True)
        low = ((names << np.uint64(PART_BITS)) >> np.uint64(PART_BITS) >> shift).astype(np.uint32)
        parts = [(part, packed(low[at], n[at].astype(np.uint32))) for part, at in by_part(names)]
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([d for _, d in parts], pa.binary())], names=["part", "counts"])

    held, n = [], 0
    for names in batches:
        held.append(names)
        n += len(names)
        if n >= ENTRIES:
            yield given(held)
            held, n = [], 0
    if held:
        yield given(held)


def common_columns(table: pa.Table, most: int) -> pa.Table:
    """(gram, m) of a part's columns of more than ``most`` seeds, from rows (part, counts)."""
    low, n = unpacked(table.column("counts"), np.uint32, np.uint32)
    order = np.argsort(low, kind="stable")
    low, n = low[order].astype(np.uint64), n[order].astype(np.int64)
    starts = _starts(low)
    total = np.add.reduceat(n, starts)
    large = total > most
    part = np.uint64(table.column("part")[0].as_py())
    gram = part << np.uint64(64 - PART_BITS) | low[starts][large] << np.uint64(64 - COLUMN_BITS)
    return pa.table([pa.array(gram.view(np.int64)), pa.array(total[large])], names=["gram", "m"])


def common_grams(counted: DataFrame) -> np.ndarray:
    """The large columns, at most COMMON of them: the most frequent ones, from packed counts of all seeds (part, counts)."""
    most = COLUMN
    counts = Written(counted.groupBy("part").applyInArrow(lambda t: common_columns(t, most), "gram long, m long"))
    by_size = counts.df.groupBy(F.floor(4 * F.log2("m")).alias("level")).count().orderBy(F.desc("level")).collect()  # some hundred rows
    least, total = None, 0
    for r in by_size:
        total += r["count"]
        if total > COMMON:
            break
        least = r["level"]
    found = np.empty(0, np.uint64)
    if least is not None:
        rows = counts.df.where(F.floor(4 * F.log2("m")) >= least).select("gram").toArrow()
        found = np.sort(rows.column(0).to_numpy().view(np.uint64))
    counts.drop()
    return found


# -- the operator ---------------------------------------------------------------------------------


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) per row: documents linked by n-gram sets of a Jaccard similarity of ``percent`` hundredths or more.

    A text of fewer than ``size`` words has all of them as its one n-gram. Null texts and texts without
    words have none and are linked with nothing: their component is their own
    id. Rows whose id is null get their set's component and never name one
    (null if the set has no id, or is empty). Rows of one id are one document, linked by any
    of its texts. Other columns are ignored. An empty table gives an empty result.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE))

    def first_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Seeds by hash alone, counted."""
        none = np.empty(0, np.uint64)
        return seed_counts(np.concatenate([seeds(columns_of(ngrams(t, size)), percent, none) for t in utf8(b)]) for b in sliced(batches) if b.num_rows)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    text_col, most = "text", COLUMN
    common = common_grams(texts.select("text").mapInArrow(first_seeds, "part int, counts binary"))

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (part, entries, null) of seeds and (part, null, prints) of prints."""
        prints: list[bytes] = []

        def headed():
            for batch in sliced(batches):
                found = [ngrams(t, size) for t in utf8(batch, text_col)]
                whole = [xxhash.xxh3_128_digest(g.tobytes()) for g in found]
                h = np.frombuffer(b"".join(whole), ">u8").reshape(len(found), 2)
                h1, h2 = (np.ascontiguousarray(h[:, k]).astype(np.uint64).view(np.int64) for k in (1, 0))
                n = np.array([len(g) for g in found], np.int64)
                ids = batch.column(batch.schema.get_field_index("id"))
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                prints.append(packed(known.astype(np.uint8), ids.fill_null(0).to_numpy(zero_copy_only=False), h1, h2, n))
                # Rows of no id name no set; sets without n-grams are linked with nothing.
                at = np.flatnonzero(known & (n > 0))
                heads = _lists([seeds(columns_of(found[i]), percent, common) for i in at])
                yield pa.RecordBatch.from_arrays([pa.array(h1[at]), pa.array(n[at].astype(np.int32)), heads], names=["node", "size", "head"])

        def said():
            part = [xxhash.xxh32_intdigest(p) % (1 << PART_BITS) for p in prints]
            rows = pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.nulls(len(prints), pa.binary()), pa.array(prints, pa.binary())], names=["part", "entries", "prints"])
            prints.clear()
            return rows

        for rows in packed_entries(entries(headed(), most, percent)):
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.nulls(rows.num_rows, pa.binary())], names=["part", "entries", "prints"])
            yield said()
        yield said()

    products = seed_products(texts.mapInArrow(packs, "part int, entries binary, prints binary"), percent)
    prints = Written(products.df.where("h1 is not null").select("id", "h1", "h2", "n_shingles"))
    some = prints.df.where("n_shingles > 0")
    groups = Written(some.groupBy("h1", "h2").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n")))
    crowded = products.df.where("na is null and a <> b").select("a", "b")
    pairs = Written(hopeful(products.df, percent).unionByName(crowded.distinct()))
    products.drop()

    def named_by(side: str) -> DataFrame:
        return groups.df.where("node is not null").select(F.col("h1").alias(side), F.col("node").alias(f"{side}_id"))

    # Products know sets by their hash; from here on a set is its least id.
    ids = pairs.df.join(named_by("a"), "a").join(named_by("b"), "b").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    every = Written(ids.distinct())
    pairs.drop()

    repeated, noded = repeated_ids(prints.df), texts.withColumnRenamed("id", "node")

    def sets_of(nodes: Written) -> DataFrame:
        """(node, size, grams) of the given nodes' texts."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(i, 200) for b in batches for i in range(0, b.num_rows, 200)):
                found = [ngrams(t, size) for t in utf8(batch, text_col)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(g) for g in found], pa.int64()), _lists(found)], names=["node", "size", "grams"])

        return texts_of(noded, nodes, repeated).mapInArrow(rows, "node long, size long, grams array<long>").where("size > 0")

    found = None
    if repeated is not None:
        rows = some.select("id", "h1", "h2").join(lookup_side(repeated).withColumnRenamed("node", "id"), "id", "left_semi").join(groups.df.select("h1", "h2", "node"), ["h1", "h2"])
        found = Written(connected_components(rows.select(F.col("id").alias("a"), F.col("node").alias("b")).distinct()))
    sizes = some.groupBy(F.col("id").alias("node")).agg(F.sum("n_shingles").alias("size"))
    found = crowd_components(every.df, sets_of, percent, found, sizes)

    named = prints.df.select("id", "h1", "h2", "n_shingles")
    labelled = label_rows(named.where("n_shingles > 0"), groups.df.select("h1", "h2", "node", "n"), found.df, ["h1", "h2"])
    alone = named.where("n_shingles = 0").withColumn("component_id", F.col("id"))
    both = labelled.select("id", "n_shingles", "component_id").unionByName(alone.select("id", "n_shingles", "component_id"))
    return both.withColumnRenamed("id", id_col)
