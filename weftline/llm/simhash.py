"""SimHash near-duplicates found through Golay-code keys.

A 64-bit fingerprint is cut into two halves. Of three differing bits at most
one lies in one of the halves, so two linked fingerprints have a half that
differs in at most one bit. A half is a 23-bit word and 9 bits more:

* the one bit lies in the 23-bit word: the word is decoded by the perfect
  binary Golay code to every codeword within 4 bits (1 or 6 of them). Words that
  differ in one bit share such a codeword, so (codeword, 9 bits) is a shared key;
* the one bit lies in the other 9: the 23-bit word itself is a shared key.

Fingerprints are first made distinct, so exact copies cost one row. Rows that
share a key are compared in full; only a spanning forest of the links inside a
key is passed on, and connected components follow.

Texts that share four fifths of their shingles differ in far more than 3 of 64
bits. For those, ``similar_documents`` takes wide fingerprints cut into many
such halves: two texts are in one crowd if any half agrees up to what its keys
tolerate, and inside a crowd texts are compared on the shingles themselves. A key of
a half has some 2^21 values, so in a large corpus unrelated texts would meet in
it; there a key also holds the least of the hashes that the half's bits were made
from, which similar texts mostly share, and which tells unrelated ones apart at
any corpus size. Short texts have few shingles and noisy fingerprints, so they
also get the keys of an exact prefix filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import Written, utf8, with_columns
from weftline.llm.components import connected_components, forest
from weftline.llm.crowds import crowd_components, repeated_ids, texts_of

RADIUS = 3
#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (a fixed value).
GOLAY_POLY = 0b101011100011
#: Keys with more distinct fingerprints than this are linked through shared neighbours instead.
KEY_CAP = 20_000
#: Keys up to this size are compared many at a time.
SMALL_KEY = 128


# -- fingerprints ---------------------------------------------------------------------------------


def fingerprint(text: bytes, size: int = 3) -> int:
    """64-bit SimHash over shingles of ``size`` lower-cased words, repeats included.

    A-Z are lower-cased, words are cut at space and the controls 9 to 13. Fewer
    words than ``size`` are one shingle; no words give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    parts = [words[i:] for i in range(size)] if len(words) >= size else [[b" ".join(words)]]
    total, n, step = np.zeros(64, np.int64), len(parts[-1]), 1 << 16
    digest, glue = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, step):
        hashes = [digest(glue(s), 42) for s in zip(*(p[at : at + step] for p in parts))]  # noqa: B905  cut to the shortest
        total += bit_counts(np.array(hashes, np.uint64)[:, None])
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set in rows of 64-bit words; rows are summed 255 at a time in bytes, then the sums."""
    rows = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8), axis=1, bitorder="little")
    whole = len(rows) // 255 * 255
    blocks = rows[:whole].reshape(-1, 255, rows.shape[1]).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return blocks + rows[whole:].sum(0, dtype=np.uint8)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp) for each row; a null or empty text has fingerprint 0."""

    def rows(batch: pa.RecordBatch):
        found = np.array([fingerprint(t, size) for t in utf8(batch, text_col)], np.uint64)
        return [pa.array(found.view(np.int64))]

    return with_columns(docs.select(id_col, text_col), [("fp", T.LongType())], rows, keep=[id_col])


# -- Golay keys -----------------------------------------------------------------------------------


@cache
def golay_patterns() -> np.ndarray:
    """For each of the 2048 syndromes the six 23-bit patterns to flip.

    The first is the error of at most 3 bits; a weight-3 error has five
    patterns of weight 4 besides, other rows repeat the first.
    """
    single = [0] * 23
    for i in range(23):
        r = 1 << i
        for b in range(22, 10, -1):
            if r >> b & 1:
                r ^= GOLAY_POLY << (b - 11)
        single[i] = r
    rows: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for where in combinations(range(23), weight):
            s = e = 0
            for i in where:
                s ^= single[i]
                e |= 1 << i
            if weight < 4 or rows[s][0].bit_count() == 3:
                rows[s].append(e)
    return np.array([(r + r[:1] * 6)[:6] for r in rows], np.int64)


@cache
def golay_syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word; a word's is their exclusive or."""
    patterns = golay_patterns()
    single = {int(p): s for s, row in enumerate(patterns) for p in row[:1] if int(p).bit_count() == 1}
    tables = []
    for start, width in ((0, 12), (12, 11)):
        table = np.zeros(1 << width, np.int64)
        for i in range(width):
            table[1 << i : 2 << i] = table[: 1 << i] ^ single[1 << (start + i)]
        tables.append(table)
    return tables[0], tables[1]


def golay_near(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices within 4 bits of each 23-bit word; where there is one, it repeats."""
    low, high = golay_syndromes()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ golay_patterns()[syndrome]) >> 11


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, one word each or (n, words), and for each key the position of its fingerprint."""
    at, out = [], []
    every = np.arange(len(fps))
    halves = np.ascontiguousarray(fps.reshape(len(fps), -1)).view(np.uint32).astype(np.int64)
    for half, value in enumerate(halves.T):
        word, rest = value & 0x7FFFFF, value >> 23
        near = golay_near(word)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :1]
        row, column = np.nonzero(new)
        out += [half << 40 | rest[row] << 12 | near[row, column], (half << 40 | 1 << 39) + word]
        at += [row, every]
    return np.concatenate(out), np.concatenate(at)


# -- links inside a key ---------------------------------------------------------------------------


def links_small(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of links within groups that begin at ``starts``; all pairs of small groups at once."""
    ends = np.append(starts[1:], len(fps))
    sizes = ends - starts
    end_of = np.repeat(ends, sizes)
    later = end_of - np.arange(len(fps)) - 1
    found_u, found_v = [], []
    bounds = np.searchsorted(np.cumsum(later), np.arange(4_000_000, int(later.sum()) + 4_000_000, 4_000_000)) + 1
    for lo, hi in zip(np.append(0, bounds[:-1]), bounds, strict=True):
        part = later[lo:hi]
        u = np.repeat(np.arange(lo, lo + len(part)), part)
        v = u + 1 + np.arange(len(u)) - np.repeat(np.cumsum(part) - part, part)
        near = np.bitwise_count(fps[u] ^ fps[v]) <= radius
        found_u.append(u[near])
        found_v.append(v[near])
    return forest(np.concatenate(found_u), np.concatenate(found_v), len(fps))


def links_large(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of links within one group, breadth first: each fingerprint meets the ones not yet reached."""
    rest = np.arange(len(fps))
    node, root = [], []
    while len(rest):
        start, rest = rest[0], rest[1:]
        front = [start]
        while front and len(rest):
            near = np.bitwise_count(fps[rest] ^ fps[front.pop()]) <= radius
            got, rest = rest[near], rest[~near]
            front += got.tolist()
            node.append(got)
            root.append(np.full(len(got), start))
    return (np.concatenate(node), np.concatenate(root)) if node else (np.empty(0, int), np.empty(0, int))


def links_of_sorted(batches: Iterator[pa.RecordBatch], radius: int, key_cap: int) -> Iterator[pa.RecordBatch]:
    """From rows (key, node, fp) sorted by key: links (a, b), or the rows of keys beyond the cap (fp not null)."""

    def emit(a, b, fp=None):
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(fp, pa.int64()) if fp is not None else pa.nulls(len(a), pa.int64())],
            names=["a", "b", "fp"],
        )

    def solve(key, node, fp):
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        several = (sizes > 1) & (sizes <= SMALL_KEY)
        if several.any():
            chosen = np.repeat(several, sizes)
            small = sizes[several]
            n, f = node[chosen], fp[chosen]
            u, v = links_small(f, np.cumsum(small) - small, radius)
            if len(u):
                yield emit(n[u], n[v])
        for at, size in zip(starts[sizes > SMALL_KEY], sizes[sizes > SMALL_KEY], strict=True):
            n, f = node[at : at + size], fp[at : at + size]
            if size > key_cap:
                yield emit(n, n, f.view(np.int64))
                continue
            u, v = links_large(f, radius)
            if len(u):
                yield emit(n[u], n[v])

    held: list[tuple[np.ndarray, ...]] = []
    streaming = None  # a key whose group has outgrown the cap: its rows go straight through
    for batch in batches:
        key, node, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        fp = fp.view(np.uint64)
        if streaming is not None and len(key):
            same = int(np.searchsorted(key, streaming, "right"))
            if same:
                yield emit(node[:same], node[:same], fp[:same].view(np.int64))
            key, node, fp = key[same:], node[same:], fp[same:]
            if len(key):
                streaming = None
        if not len(key):
            continue
        held.append((key, node, fp))
        key, node, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        last = int(np.searchsorted(key, key[-1], "left"))
        if last:
            yield from solve(key[:last], node[:last], fp[:last])
        held = [(key[last:], node[last:], fp[last:])]
        if len(key) - last > key_cap:
            yield emit(node[last:], node[last:], fp[last:].view(np.int64))
            streaming, held = key[-1], []
    if held:
        key, node, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        yield from solve(key, node, fp)


def links_beyond_cap(rows: DataFrame) -> DataFrame:
    """Links of fingerprints (node, fp) through shared neighbours, with work linear in the rows.

    Two fingerprints within 3 bits have a word between them that is within 1
    bit of the one and 2 of the other. Each fingerprint is sent to all words
    within 2 bits; at a word, everyone is linked to the smallest node within 1
    bit of it. At most 65 and 2080 distinct fingerprints can meet at a word.
    """

    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.array([0, *(1 << i for i in range(64))], np.uint64)
        two = np.array([1 << i | 1 << j for i, j in combinations(range(64), 2)], np.uint64)
        flips = np.concatenate((one, two))
        near = np.arange(len(flips)) < len(one)
        for batch in batches:
            node, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for at in range(0, len(node), 100):
                n, f = node[at : at + 100], fp[at : at + 100].view(np.uint64)
                word = (f[:, None] ^ flips).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word), pa.array(np.repeat(n, len(flips))), pa.array(np.tile(near, len(n)))], names=["word", "node", "near"]
                )

    sent = rows.mapInArrow(balls, "word long, node long, near boolean")
    hub = sent.where("near").groupBy("word").agg(F.min("node").alias("hub"))
    return sent.join(hub, "word").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


# -- the operator ---------------------------------------------------------------------------------


def link_components(nodes: DataFrame, radius: int = RADIUS, key_cap: int = KEY_CAP) -> DataFrame:
    """(node, component) for distinct fingerprints (node, fp) that are linked to another."""
    if not 0 <= radius <= RADIUS:
        raise ValueError("the keys find links up to 3 bits")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            key, at = keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node[at]), pa.array(fp[at])], names=["key", "node", "fp"])

    keyed = nodes.select("node", "fp").mapInArrow(spread, "key long, node long, fp long")
    met = (
        keyed.repartition("key")
        .sortWithinPartitions("key", "node")
        .mapInArrow(lambda b: links_of_sorted(b, radius, key_cap), "a long, b long, fp long")
    )
    met = Written(met)
    links = met.df.where("fp is null").select("a", "b")
    beyond = met.df.where("fp is not null").select(F.col("a").alias("node"), "fp").distinct()
    if beyond.take(1):
        links = links.unionByName(links_beyond_cap(beyond))
    found = connected_components(links)
    met.drop()
    return found


def label_rows(prints: DataFrame, groups: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """(id, by..., component_id) for rows (id, by...), from groups (by..., node, n) and components (node, component)."""
    named = groups.join(found, "node", "left").select(*by, "n", F.coalesce("component", "node").alias("component_id"))
    named = Written(named)
    total = named.df.agg(F.sum("n")).first()[0] or 0
    # Groups of a thousandth of all rows or more: a thousand at most, so they can be broadcast; the rest has no hot key.
    often = max(total // 1000, 1000)
    hot = F.broadcast(named.df.where(F.col("n") >= often).select(*by, "component_id"))
    rest = named.df.where(F.col("n") < often).select(*by, "component_id")
    return prints.join(hot, by).unionByName(prints.join(hot, by, "left_anti").join(rest, by))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = RADIUS, key_cap: int = KEY_CAP
) -> DataFrame:
    """Per row: id, fp (long), component_id (smallest id reachable through links of ``radius`` bits or fewer).

    Null and empty texts have fingerprint 0 and are linked like any other. Rows
    whose id is null get their fingerprint's component, and never name one; a
    group of null ids alone has a null component. Repeated ids are one node. An
    empty table gives an empty result.
    """
    prints = Written(fingerprints(docs, id_col, text_col, size).withColumnRenamed(id_col, "id"))
    groups = Written(prints.df.groupBy("fp").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n")))
    found = Written(link_components(groups.df.where("node is not null"), radius, key_cap))
    labelled = label_rows(prints.df, groups.df, found.df, ["fp"])
    return labelled.select(F.col("id").alias(id_col), "fp", "component_id")


# -- similar documents ----------------------------------------------------------------------------

#: 64-bit words of a wide fingerprint (two halves each), and odd multipliers that make them from one hash (from a rule).
WIDE_WORDS = 16
MULTIPLIERS = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) % 2**64 for i in range(1, WIDE_WORDS + 1)], np.uint64)
#: Texts of so many shingles or fewer are found by an exact prefix filter, and no bits are asked of them.
SHORT = 20

def shingle_hashes(text: bytes, size: int) -> tuple[np.ndarray, bytes]:
    """Distinct hashes of a text's shingles, and the words they were made from; few words are one shingle, none give none."""
    words = text.lower().split()
    parts = [words[i:] for i in range(size)] if len(words) >= size else [[b" ".join(words)]] if words else [[]]
    digest, glue = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.array([digest(glue(s), 42) for s in zip(*parts)], np.uint64)), b" ".join(words)  # noqa: B905


def wide_fingerprint(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of WIDE_WORDS words over distinct hashes, and for each word the least of the mixed hashes (32 bits)."""
    total, step = np.zeros(64 * WIDE_WORDS, np.int64), 1 << 14
    least = np.full(WIDE_WORDS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), step):
        mixed = hashes[at : at + step, None] * MULTIPLIERS
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, mixed.min(0))
        total += bit_counts(mixed)
    return np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64), (least >> np.uint64(32)).astype(np.uint32)


WIDE_BYTES, LEAST_BYTES = 8 * WIDE_WORDS, 4 * WIDE_WORDS


def packed_sketch(hashes: np.ndarray, similarity: float) -> bytes:
    """Wide fingerprint, least hashes, and of a short text the hashes of its prefix.

    Two sets of a Jaccard similarity s share one of the first n - ceil(s n) + 1
    of their n hashes, taken in one order for both.
    """
    wide, least = wide_fingerprint(hashes)
    n = len(hashes)
    prefix = hashes[: n - int(np.ceil(similarity * n - 1e-9)) + 1] if 0 < n <= SHORT else hashes[:0]
    return wide.tobytes() + least.tobytes() + prefix.tobytes()


def wide_words(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(s[:WIDE_BYTES] for s in sketches), np.uint64).reshape(-1, WIDE_WORDS)


def mixed_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit key from two numbers."""
    key = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ (key >> np.uint64(32))).view(np.int64)


def sketch_keys(sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of packed sketches, and for each key the position of its sketch: Golay keys with the word's least hash, and short prefixes."""
    least = np.frombuffer(b"".join(s[WIDE_BYTES : WIDE_BYTES + LEAST_BYTES] for s in sketches), np.uint32).reshape(-1, WIDE_WORDS)
    key, at = keys(wide_words(sketches))
    out = [mixed_key(key, least[at, key >> 41])]  # bits from 40 up count the halves, two to a word
    tails = [np.frombuffer(s[WIDE_BYTES + LEAST_BYTES :], np.uint64) for s in sketches]
    sizes = np.array([len(t) for t in tails])
    short = np.concatenate(tails) if tails else np.empty(0, np.uint64)
    out.append(mixed_key(short, np.full(len(short), 2**32, np.uint64)))
    return np.concatenate(out), np.concatenate((at, np.repeat(np.arange(len(sketches)), sizes)))


#: Rows whose shared keys a task looks for before the shuffle, some 25,000 bytes of work each.
CHUNK = 2_000


def first_of_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (node, wide): the keys of their sketches as (key, node, null), where rows of a chunk that hang together by keys are one node.

    The others are edges to that one, (any number, node, first). So a family of
    any size is one node of each chunk to the tasks behind the shuffle, and a key that very many rows have is few rows.
    """
    for batch in batches:
        for part in (batch.slice(i, CHUNK) for i in range(0, batch.num_rows, CHUNK)):
            node = part.column(0).to_numpy(zero_copy_only=False)
            key, at = sketch_keys(part.column(1).to_pylist())
            order = np.lexsort((at, key))
            key, at = key[order], at[order]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, int)
            lead = np.repeat(at[starts], np.diff(np.append(starts, len(key))))
            which, root = forest(at, lead, len(node))
            roots = np.arange(len(node))
            roots[which] = root
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((key[starts], node[which]))),
                    pa.array(np.concatenate((node[roots[at[starts]]], node[which]))),
                    pa.concat_arrays([pa.nulls(len(starts), pa.int64()), pa.array(node[root], pa.int64())]),
                ],
                names=["key", "node", "first"],
            )


def stars_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, node, first) sorted by key and node: edges (a, b) of each row to its key's first one, and those that are there already."""
    known, leader = None, None  # of the key that the next rows may continue
    for batch in batches:
        key, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        first = batch.column(2)
        is_edge = first.is_valid().to_numpy(zero_copy_only=False)
        a, b = [node[is_edge]], [first.drop_null().to_numpy(zero_copy_only=False)]
        key, node = key[~is_edge], node[~is_edge]
        if len(key):
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            leaders = node[starts].copy()
            if key[0] == known:
                leaders[0] = leader
            known, leader = key[-1], leaders[-1]
            whose = np.repeat(leaders, np.diff(np.append(starts, len(key))))
            a.append(node[node != whose])
            b.append(whose[node != whose])
        both = np.unique(np.stack((np.concatenate(a), np.concatenate(b))), axis=1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id) per row: groups of texts linked by a Jaccard similarity of word shingles from ``similarity`` up.

    Texts with the same words are one group from the start. Whoever shares a key of its wide
    fingerprint with another is in its crowd; pairs at similarity 0.8 itself share one in more than 98 of a
    hundred cases, short texts always (see tests), and a group needs only
    enough of its links to hang together. Inside a crowd all links are found, on 64-bit
    hashes of all shingles (``crowds``), so nothing less similar is linked. Null and empty texts are one group. Null
    ids get their group's component and never name one; repeated ids are one
    document. Ids are whole numbers.
    """

    def rows(batch: pa.RecordBatch):
        h1, h2, n, wide = [], [], [], []
        for text in utf8(batch, text_col):
            hashes, plain = shingle_hashes(text, size)
            whole = xxhash.xxh3_128_intdigest(plain)
            h1.append((whole & (2**64 - 1)) - 2**63)
            h2.append((whole >> 64) - 2**63)
            n.append(len(hashes))
            wide.append(packed_sketch(hashes, similarity))
        return [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(n, pa.int64()), pa.array(wide, pa.binary())]

    fields = [("h1", T.LongType()), ("h2", T.LongType()), ("size", T.LongType()), ("wide", T.BinaryType())]
    prints = Written(with_columns(docs.select(F.col(id_col).alias("id"), text_col), fields, rows, keep=["id"]))
    grouped = prints.df.groupBy("h1", "h2").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("n"), F.min("size").alias("size"), F.min("wide").alias("wide")
    )
    groups = Written(grouped)
    keyed = groups.df.where("node is not null and size > 0").select("node", "wide").mapInArrow(first_of_keys, "key long, node long, first long")
    edges = Written(keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(stars_of_sorted, "a long, b long").distinct())
    texts, repeated = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")), repeated_ids(prints.df)

    def sets_of(nodes: Written) -> DataFrame:
        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(i, 200) for b in batches for i in range(0, b.num_rows, 200)):
                found = [shingle_hashes(t, size)[0] for t in utf8(batch, "text")]
                sizes = pa.array([len(x) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], names=["node", "size", "grams"])

        return texts_of(texts, nodes, repeated).mapInArrow(sets, "node long, size long, grams array<long>").where("size > 0")

    found = crowd_components(edges.df, sets_of, round(100 * similarity))
    edges.drop()
    labelled = label_rows(prints.df.select("id", "h1", "h2"), groups.df.select("h1", "h2", "node", "n"), found.df, ["h1", "h2"])
    return labelled.select(F.col("id").alias(id_col), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group of ``similar_documents``, the one with the smallest id; columns unchanged.

    Rows with the same id count as one document, of which one row stays (the
    one whose columns, written as JSON, have the smallest hash); rows with a null id are all kept, as they name no group. Only ids travel: the
    rows that go are few against the corpus, and are taken out by a broadcast
    anti-join when their table is small.
    """
    found = Written(similar_documents(docs, id_col, text_col, **options).where(F.col(id_col).isNotNull()))
    per_id = found.df.groupBy(F.col(id_col).alias("__id")).agg(F.count(F.lit(1)).alias("__n"), F.min("component_id").alias("__first"))
    marked = Written(per_id.where((F.col("__n") > 1) | (F.col("__first") != F.col("__id"))))
    side = F.broadcast(marked.df) if marked.small() else marked.df
    untouched = docs.join(side, docs[id_col] == side["__id"], "left_anti")
    repeated = side.where(F.col("__first") == F.col("__id")).select("__id")
    again = docs.join(repeated, docs[id_col] == repeated["__id"], "left_semi")
    row = F.struct(*(again[c] for c in again.columns))
    one = again.groupBy(F.col(id_col).alias("__one")).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("__row")).select("__row.*")
    return untouched.unionByName(one)
