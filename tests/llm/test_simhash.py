import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import components, crowds, simhash


def brute_print(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    label = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if label[a] < label[b] and (fps[i] ^ fps[j]).bit_count() <= 3:
                    label[b], changed = label[a], True
    return label


def test_fingerprints_and_the_hash_of_spark(spark, make, odd):
    texts = [*odd, "One two THREE four five", "É É é"]
    got = [r["fp"] for r in simhash.fingerprints(make(texts)).orderBy("doc_id").collect()]
    assert [g % 2**64 for g in got] == [brute_print(t) for t in texts]
    assert spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()["h"] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def test_keys_meet_up_to_three_bits():
    rng = random.Random(1)
    x = np.array([rng.getrandbits(64) for _ in range(3000)], np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.sample(range(64), rng.randint(0, 3)):
            y[i] ^= np.uint64(1 << b)

    def by_row(v):
        key, at = simhash.keys(v.view(np.int64))
        out = [set() for _ in v]
        for k, a in zip(key.tolist(), at.tolist(), strict=True):
            out[a].add(k)
        return out

    assert all(a & b for a, b in zip(by_row(x), by_row(y), strict=True))


@pytest.fixture(scope="module")
def prints():
    rng = random.Random(2)
    fps = []
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(6):
            w = v
            for b in rng.sample(range(64), rng.randint(0, 4)):
                w ^= 1 << b
            fps.append(w)
            v = w if rng.random() < 0.5 else v
    hot = fps[0]
    fps += [hot ^ (1 << a) ^ (1 << b) for a, b in (rng.sample(range(64), 2) for _ in range(200))]
    fps = sorted(set(fps))
    rng.shuffle(fps)
    return fps


@pytest.mark.parametrize("cap", [simhash.KEY_CAP, 150, 1])
def test_components_equal_brute_force_on_every_path(spark, prints, cap):
    want = brute_components(list(range(len(prints))), prints)
    signed = [(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "node long, fp long")
    got = {r["node"]: r["component"] for r in simhash.link_components(nodes, key_cap=cap).collect()}
    assert {i: got.get(i, i) for i in want} == want


def test_near_duplicates_with_nulls_repeats_and_copies(spark, make):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [base, base, base.replace("word7 ", "other "), None, "", "something else entirely here", "x y", base]
    ids = [9, 4, 6, 20, 21, 30, 31, None]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(make(texts, ids)).collect()}
    fps = [brute_print(t) for t in texts[:-1]]
    want = brute_components(sorted(ids[:-1]), [fps[ids.index(i)] for i in sorted(ids[:-1])])
    assert {k: v for k, v in got.items() if k is not None} == want
    assert got[None] == 4 and want[9] == 4 and want[20] == want[21] == 20
    kept = simhash.drop_near_duplicates(make(texts, ids))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(set(want.values()) | {None})
    assert kept.columns == make([]).columns
    assert simhash.near_duplicates(make([])).count() == 0


def test_connected_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(5, 5), (None, 3), (1, 0)]
    random.Random(3).shuffle(edges)
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_documents_are_the_verified_classes(spark, make):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randint(30, 400))
        for _ in range(6):
            copy = [w if rng.random() > 0.02 else rng.choice(vocabulary) for w in base]
            texts.append(" ".join(copy))
    hot = rng.choices(vocabulary, k=200)
    texts += [" ".join(w if rng.random() > 0.005 else rng.choice(vocabulary) for w in hot) for _ in range(150)]
    texts += ["", None, "a b", "a  B", "only four words here", *[texts[0]] * 3]
    sets = [frozenset(simhash.shingle_hashes((t or "").encode(), 5)[0].tolist()) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or (sets[i] & sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    docs = make(texts)
    got = [r["component_id"] - 1 for r in simhash.similar_documents(docs).orderBy("doc_id").collect()]
    assert all(label[g] == label[i] for i, g in enumerate(got))  # nothing less similar is linked
    assert sum(g == w for g, w in zip(got, label, strict=True)) >= 0.97 * len(texts)
    kept = {r["doc_id"] - 1 for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == set(got)


@pytest.mark.parametrize("size", [3, 7, 1000])
def test_stars_hold_every_key_together_whatever_the_batches(size):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, 60).astype(np.uint64)) for _ in range(40)]
    sets += [np.unique(np.append(sets[i % 5][rng.random(60) > 0.05], rng.integers(0, 2**63, 2).astype(np.uint64))) for i in range(200)]
    sketches = [simhash.packed_sketch(s, 0.8) for s in sets]
    whole = pa.RecordBatch.from_arrays([pa.array(range(240), pa.int64()), pa.array(sketches, pa.binary())], names=["node", "wide"])
    dealt = [b for i in range(0, 240, size) for b in simhash.first_of_keys(iter([whole.slice(i, size)]))]
    rows = sorted((r for b in dealt for r in b.to_pylist()), key=lambda r: (r["key"], r["node"]))
    table = pa.RecordBatch.from_pylist(rows, schema=dealt[0].schema)
    edges = [(r["a"], r["b"]) for b in simhash.stars_of_sorted(table.slice(i, size) for i in range(0, len(rows), size)) for r in b.to_pylist()]

    def labels(pairs):
        label = list(range(240))
        for a, b in pairs:
            x, y = sorted((label[a], label[b]))
            label = [x if v == y else v for v in label]
        return label

    key, at = simhash.sketch_keys(sketches)
    first = {}
    assert labels(edges) == labels([(int(i), first.setdefault(int(k), int(i))) for k, i in zip(key, at, strict=True)])
    assert len(edges) < len(key)


def test_lone_pairs_at_the_similarity_itself_share_a_key():
    rng = np.random.default_rng(6)
    recall = {}
    for shared, own in ((4, 1), (8, 2), (12, 3), (16, 4), (32, 8), (80, 20), (400, 100), (2000, 500)):
        found, least_found = 0, 60 if shared > 100 else 200
        for _ in range(least_found):  # of so many pairs; one set holds the shared hashes, the other some of its own
            every = np.unique(rng.integers(0, 2**63, shared + own).astype(np.uint64) * np.uint64(2))
            cut = rng.integers(0, own + 1)
            common = rng.permutation(every)
            a, b = np.sort(common[: shared + cut]), np.sort(np.concatenate((common[:shared], common[shared + cut :])))
            assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) == 0.8
            key, at = simhash.sketch_keys([simhash.packed_sketch(x, 0.8) for x in (a, b)])
            found += bool(np.intersect1d(key[at == 0], key[at == 1]).size)
        recall[shared + own] = found / least_found
    assert all(r == 1 for n, r in recall.items() if n <= simhash.SHORT) and min(recall.values()) >= 0.95
    assert sum(recall.values()) / len(recall) >= 0.98


def test_prefixes_find_every_pair_of_short_texts():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 2**63, 30).astype(np.uint64)
    bases = [np.unique(rng.choice(pool, rng.integers(4, simhash.SHORT + 1))) for _ in range(40)]
    sets = [np.unique(np.append(b[rng.random(len(b)) > 0.07], rng.choice(pool, rng.integers(0, 2)))) for b in bases for _ in range(8)]
    sets = [x for x in sets if 0 < len(x) <= simhash.SHORT]
    key, at = simhash.sketch_keys([simhash.packed_sketch(x, 0.8) for x in sets])
    keys = [set(key[at == i].tolist()) for i in range(len(sets))]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    assert len(near) > 50 and all(keys[i] & keys[j] for i, j in near)


def test_one_row_of_a_repeated_id_stays_whatever_the_order(spark):
    rows = [(1, "a b c d e f", "x"), (1, "g h i j k l", "y"), (1, "m n o p q r", "z"), (2, "s t u v w x", "x")]
    schema = "doc_id long, text string, `__id` string"
    kept = {tuple(sorted(map(tuple, simhash.drop_near_duplicates(spark.createDataFrame(r, schema)).collect()))) for r in (rows, rows[::-1])}
    assert len(kept) == 1 and [r[0] for r in kept.pop()] == [1, 2]


def test_crowds_of_many_blocks_lose_no_link(spark, monkeypatch):
    """A family around the similarity asked for, in one crowd with texts that are like none."""
    monkeypatch.setattr(crowds, "BLOCK_ROWS", 16)
    monkeypatch.setattr(crowds, "BLOCK_GRAMS", 1000)
    rng = np.random.default_rng(11)
    base = rng.integers(0, 2**40, 80)
    sets = {i: np.unique(np.append(base[rng.random(80) > rng.choice([0.04, 0.12])], rng.integers(0, 2**40, rng.integers(0, 9)))) for i in range(150)}
    sets |= {i: np.unique(rng.integers(0, 2**40, rng.integers(1, 90))) for i in range(150, 180)}
    label = list(range(180))
    for i in range(180):
        for j in range(i):
            if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
                x, y = sorted((label[i], label[j]))
                label = [x if v == y else v for v in label]
    table = spark.createDataFrame([(i, len(s), s.tolist()) for i, s in sets.items()], "node long, size long, grams array<long>")
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 180)], "a long, b long")
    found = crowds.crowd_components(edges, lambda nodes: table.join(nodes.df, "node", "left_semi"), 80)
    got = {r["node"]: r["component"] for r in found.df.collect()}
    assert [got.get(i, i) for i in range(180)] == label and 2 < len(set(label)) < 180
    none = crowds.crowd_components(edges.limit(0), lambda nodes: table, 80)
    assert none.df.count() == 0
