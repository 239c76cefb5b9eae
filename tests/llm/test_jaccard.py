import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm import crowds, jaccard


def shingle_set(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts, ids):
    """(id, n, component) of every row, from all pairs."""
    sets = [shingle_set(t) for t in texts]
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x in range(len(texts)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                i, j = sorted((root(ids[x]), root(ids[y])))
                up[j] = i
    return sorted((i, len(s), root(i) if s else i) for i, s in zip(ids, sets, strict=True))


def words(rng, n, of=5000):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def edited(rng, base, share):
    out = list(base)
    for _ in range(max(1, int(len(base) * share))):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def corpus(rng, family=70):
    base, passage = words(rng, 120), words(rng, 60)
    texts = [edited(rng, base, rng.choice([0.005, 0.02, 0.04])) for _ in range(family)]  # about the threshold
    texts += [" ".join(passage + words(rng, rng.choice([0, 5, 12, 200]))) for _ in range(family)]  # one passage in many
    texts += [" ".join(words(rng, n)) for n in (1, 3, 4, 5, 6, 40, 300) for _ in range(4)]
    for n in (5, 6, 9, 14, 30, 200):
        own = words(rng, n)
        texts += [" ".join(own), edited(rng, own, 0.01), " ".join([*own, "tail"]), " ".join(own).upper()]
    return texts + ["a b", "a  B\n", "a b c", None, "", " \t", "é x y z w v", "É x y z w v"]


@pytest.mark.parametrize("bounds", [{}, {"COLUMN": 4, "BLOCK_ROWS": 16, "STRIP": 8, "DENSE_COLUMNS": 64}, {"COLUMN": 6, "COMMON": 3, "BLOCK_ROWS": 32}])
def test_equals_brute_force(spark, make, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(jaccard if hasattr(jaccard, name) else crowds, name, value)
    rng = random.Random(11)
    texts = corpus(rng)
    ids = rng.sample(range(10_000), len(texts))
    got = jaccard.similar_documents(make(texts, ids))
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}
    assert sorted(tuple(r) for r in got.collect()) == brute(texts, ids)


def test_repeated_and_null_ids(spark):
    """Rows of one id are one document; a null id gets its set's component and names none."""
    one, two = (" ".join(f"{x}{i}" for i in range(30)) for x in "xy")
    rows = [(4, one, 1), (4, two, 2), (9, two + " z", 3), (4, one, 1), (None, two, 4), (None, "only me here", 5), (None, None, 6), (7, "", 7), (8, None, 8)]
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string, component_id long"))
    want = [(4, 26, 4), (4, 26, 4), (4, 26, 4), (9, 27, 4), (None, 26, 4), (None, 1, None), (None, 0, None), (7, 0, 7), (8, 0, 8)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_empty_table_and_long_text(spark, make):
    assert jaccard.similar_documents(make([])).collect() == []
    long = " ".join(f"w{i}" for i in range(40_000))
    got = jaccard.similar_documents(make([long, long + " end", "word " * 30_000, "other", long]))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 39_996, 1), (2, 39_997, 1), (3, 1, 3), (4, 1, 4), (5, 39_996, 1)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=20), min_size=1, max_size=30), st.sets(st.integers(0, 30), max_size=10))
def test_seeds_meet_and_dense_products_equal_sets(sets, common):
    arrays = sorted((np.array(sorted(s), np.uint64) for s in sets), key=len)
    known = np.array(sorted(common), np.uint64)
    near = set()
    for i, a in enumerate(arrays):
        for j, b in enumerate(arrays):
            x, y = set(a.tolist()), set(b.tolist())
            if 100 * len(x & y) >= 80 * len(x | y):
                near.add((i, j))
                for order in (known, known[:0]):
                    assert set(jaccard.seeds(a, 80, order).tolist()) & set(jaccard.seeds(b, 80, order).tolist())
    u, v = crowds.dense_links(arrays, arrays, 80)
    assert set(zip(u.tolist(), v.tolist(), strict=True)) == near


def test_ngrams_tell_orders_of_repeated_words_apart():
    rng = random.Random(5)
    for n in (4, 5, 6, 40, 400):
        text = " ".join(rng.choice("abc") for _ in range(n))
        assert len(jaccard.ngrams(text.encode())) == len(shingle_set(text))


def test_a_large_column_is_never_one_task(monkeypatch):
    """What a task has of a column beyond its bound goes as edges, dealt by node; the rest still tells that the column is large."""
    monkeypatch.setattr(jaccard, "ENTRIES", 1000)
    n, most = 900, 4
    heads = pa.array([[7, 1000 + i] for i in range(n)], pa.list_(pa.int64()))
    rows = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([50] * n, pa.int32()), heads], names=["node", "size", "head"])
    got = pa.Table.from_batches(list(jaccard.entries(iter([rows]), most))).to_pandas()
    kept = got[got["first"].isna()]
    assert len(got) == 2 * n and (kept["gram"] == 7).sum() == 2 * (most + 1)  # two lots of entries
    sent = pa.RecordBatch.from_pandas(got.sort_values(["gram", "size"]).astype({"first": "Int64"}), schema=pa.schema([("gram", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("first", pa.int64())]), preserve_index=False)
    out = pa.Table.from_batches(list(jaccard.column_products(iter([sent]), 80, most))).to_pandas()
    assert out["na"].isna().all() and set(out["a"]) == set(range(n))  # all hang together, no pair is listed
    up = {i: i for i in range(n)}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in zip(out["a"], out["b"], strict=True):
        up[root(a)] = root(b)
    assert len({root(i) for i in range(n)}) == 1


def test_blocks_of_sizes_too_far_apart_do_not_meet(spark, monkeypatch):
    """Rows of a crowd go only to the blocks of neighbouring size classes, and all links are found."""
    monkeypatch.setattr(crowds, "BLOCK_ROWS", 8)
    sizes = [10, 20, 40, 80, 160, 320]
    rows = [(100 * s + i, 1, s, 100 * s + i) for s in sizes for i in range(8)]
    sets = [(node, s, [1_000_000 * s + k for k in range(s - 1)] + [node]) for node, _, s, _ in rows]
    seen = spark.sparkContext.accumulator(0)
    real = crowds.block_links

    def counted(table, percent):
        seen.add(table.num_rows)
        return real(table, percent)

    monkeypatch.setattr(crowds, "block_links", counted)
    met = crowds.crowd_links(spark.createDataFrame(rows, "node long, crowd long, size long, part long"), spark.createDataFrame(sets, "node long, size long, grams array<long>"), 80, all_pairs=True)
    links = {frozenset((r["a"], r["b"])) for r in met.df.collect()}
    assert len(links) == 7 * len(sizes) and all(max(x) // 100 == min(x) // 100 for x in links)
    assert seen.value == len(rows)  # with all blocks meeting each other it was one row for each of six blocks
    met.drop()


def test_seeds_and_sets_are_in_no_table(spark, make, monkeypatch):
    """Seeds and whole sets go through one shuffle each and are written nowhere, also of texts that share a passage."""
    monkeypatch.setattr(jaccard, "COLUMN", 4)
    rng = random.Random(3)
    passage = words(rng, 40)
    texts = [" ".join([*(f"o{i}x{k}" for k in range(rng.choice([6, 9, 13]))), *passage]) for i in range(60)]
    texts += [" ".join([*passage, *passage, *(f"p{i}x{k}" for k in range(60))]) for i in range(8)]
    ids = rng.sample(range(1000), len(texts))
    written, real = set(), crowds.Written.__init__

    def init(self, df, *args, **kw):
        written.update(df.columns)
        real(self, df, *args, **kw)

    monkeypatch.setattr(crowds.Written, "__init__", init)
    assert sorted(tuple(r) for r in jaccard.similar_documents(make(texts, ids)).collect()) == brute(texts, ids)
    assert "h1" in written and not {"head", "grams"} & written


def test_a_common_passage_makes_no_crowd():
    """In a large column only those hang together whose rests are enough for their sizes; before, all did."""
    sizes, rests = [37] * 8 + [45] * 60 + [41] * 5, [36] * 8 + [36] * 60 + [40] * 5
    n = len(sizes)
    column = pa.RecordBatch.from_arrays(
        [pa.array([7] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(sizes, pa.int32()), pa.nulls(n, pa.int64()), pa.array(rests, pa.int32())], names=["gram", "node", "size", "first", "rest"]
    )
    out = pa.Table.from_batches(list(jaccard.column_products(iter([column]), 80, 32))).to_pydict()
    assert out["a"] == list(range(n)) and out["na"] == [None] * n
    assert out["b"] == [0] * 8 + list(range(8, 68)) + [0] * 5  # those of 45 could be similar to none of 36 in common


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(0, 14)), min_size=1, max_size=60), st.sampled_from([1, 3, 256]))
def test_reaching_equals_all_pairs(rows, classes):
    """Entries hang together as all pairs say whose smaller rest is enough for both sizes."""
    size = np.array([n for n, _ in rows], np.int32)
    rest = np.array([max(1, n - p) for n, p in rows], np.int32)
    up = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 180 * min(rest[i], rest[j]) >= 80 * (int(size[i]) + int(size[j])):
                a, b = up[i], up[j]
                up = [min(a, b) if x in (a, b) else x for x in up]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jaccard, "CLASSES", classes)
        assert jaccard.reaching(size, rest, 80).tolist() == up


def test_products_of_packed_lots():
    """Lots of entries, packed and dealt by part, give each pair as often as it shares seeds; a copy's entries count once."""
    rng = random.Random(8)
    rows = [(1000 + i, 20, [rng.randrange(2**64) // 2**58 * 2**58 - 2**63 for _ in range(5)]) for i in range(40)]
    rows += rows[:5]
    seen, prints = {}, jaccard.packed(np.array([1, 0], np.uint8), *(np.array([k, 7], np.int64) for k in range(4)))
    for some in (rows[:30], rows[30:]):
        node, size, head = zip(*some, strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(size, pa.int32()), pa.array(head, pa.list_(pa.int64()))], names=["node", "size", "head"])
        for pack in jaccard.packed_entries(jaccard.entries(iter([batch]), 32)):
            for r in pack.to_pylist():
                seen.setdefault(r["part"], []).append((r["entries"], None))
    met, known = {}, []
    for k, packs in enumerate(seen.values()):
        packs = [*packs, (None, prints)] if k == 0 else packs
        table = pa.table([pa.array([e for e, _ in packs], pa.binary()), pa.array([p for _, p in packs], pa.binary())], names=["entries", "prints"])
        for r in jaccard.part_products(table, 80, 1000).to_pylist():
            if r["a"] is None:
                known.append((r["id"], r["h1"], r["h2"], r["n_shingles"]))
            else:
                met[r["a"], r["b"]] = met.get((r["a"], r["b"]), 0) + 1
    assert known == [(0, 1, 2, 3), (None, 7, 7, 7)]
    want = {}
    for i in range(40):
        for j in range(i + 1, 40):
            n = sum(x == y for x in rows[i][2] for y in rows[j][2])
            if n:
                want[1000 + i, 1000 + j] = n
    assert met == want and len(seen) > 20
