import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n long"


def rebuilt(rows):
    """conv_id to its list of (role, text), on the first turns of its base."""
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            key = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, role or "", key, text or ""))
    seqs = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, s in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = seqs.get(c - c % 5, [])[:h] + s[h:]
    return out


def brute(seqs):
    """Nodes by path: every count from its definition."""
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    rows = []
    for path, inside in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(inside) if len(seqs[c]) == len(path))
        rows.append((
            min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), sum(len(p) == len(path) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def talk(n, seed, words=3, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(["hé", "yes", None, "no " * 50][:words]), "clash", 1))
    return rows


@pytest.mark.parametrize("ranges", [1, 3, 12])
def test_trie_equals_brute_force(spark, ranges):
    rows = talk(120, 3) + [(5, 99, "user", "x" * 100_000, None, None), (None, 1, "user", "nobody's", None, None), (-7, 0, "user", "hé", None, None)]
    rows += [(c, t, "user", f"common {t}", None, None) for c in range(300, 360) for t in range(3)]  # a group with one start
    rows += rows[:9]  # repeated rows are turns
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    seqs = turns.branched(turns.sequences(df))
    got = turns.trie(seqs, ranges=lambda _: ranges)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rebuilt(rows))


def test_small_runs_and_bounds_inside_long_paths(spark, monkeypatch):
    """Ranges whose bounds fall inside one deep shared path, with and without ends on it."""
    rows = [(c, t, "r", f"t{t}" if t < 12 - (c % 4) else f"own {c}", None, None) for c in range(0, 200, 5) for t in range(14 - c % 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    seqs = turns.sequences(df)
    got = turns.trie(seqs, ranges=lambda _: 16)
    want = defaultdict(list)
    for c, t, role, text, *_ in sorted(rows, key=lambda r: r[:2]):
        want[c].append((role, text))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(want)


def test_no_conversations(spark):
    assert turns.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.lists(st.integers(0, 2), max_size=6), max_size=8), min_size=1, max_size=7))
def test_merge_carries_prefix_lengths(lists):
    seen = set()
    runs = []
    for run in lists:
        seqs = sorted({b"".join(bytes([x]) * turns.TOKEN for x in s) for s in run} - seen)
        seen |= set(seqs)
        runs.append([(turns.lcp(seqs[i - 1], s) if i else 0, s) for i, s in enumerate(seqs)])
    got = list(turns.merged(runs))
    assert [row[1] for _, row in got] == sorted(seen)
    for (shared, row), before in zip(got, [b"", *(r[1] for _, r in got)]):  # noqa: B905
        assert shared == turns.lcp(before, row[1])


def test_merge_compares_no_shared_turns_again(monkeypatch):
    """Turns that a row shares with the last output are never looked at again."""
    compared = []
    plain = turns.lcp

    def counting(a, b, known=0):
        got = plain(a, b, known)
        compared.append(got - known + 1)
        return got

    monkeypatch.setattr(turns, "lcp", counting)
    token = [bytes([x]) * turns.TOKEN for x in range(250)]
    deep = b"".join(token[:100])
    runs = [[(100 if i else 0, deep + token[100 + 8 * i + r]) for i in range(15)] for r in range(8)]
    assert len(list(turns.merged(runs))) == 120
    assert sum(compared) < 7 * 101 + 120 * 3 * 2
