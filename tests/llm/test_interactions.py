import re
from collections import defaultdict
from itertools import permutations

from pyspark.sql import types as T

from weftline.llm import interactions

SCHEMA = "doc_id long, text string, lang string, part string, mask int"
LABELS = "doc_id long, quality long, toxic long"


def brute(docs, labels):
    """Every order applied document by document."""
    good, toxic = defaultdict(bool), defaultdict(bool)
    for i, q, t in labels:
        good[i] |= q == 1
        toxic[i] |= t == 1
    failing = []
    for i, text, lang, *_ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in docs),
        }
        failing.append((lang or "", i, {f for f, bad in failed.items() if bad}))
    rows = {}
    for part in {p for p, _, _ in failing}:
        here = [(i, f) for p, i, f in failing if p == part]
        taken = defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(here)
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                earlier = len([1 for _, f in here if name in f]) - len(gone)
                left = [x for x in left if name not in x[1]]
                taken[name] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), earlier, sum(f == {name} for _, f in here),
                    sum(good[i] for i, _ in gone if i is not None), sum(toxic[i] for i, _ in gone if i is not None),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(taken[order[step - 1]])
    return rows


def audited(spark, docs, labels):
    out = interactions.audit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS))
    assert [f.dataType for f in out.schema][3:] == [T.LongType()] * 7
    rows = out.collect()
    assert len(rows) == len({r[:3] for r in rows})
    return {tuple(r[:3]): list(r[3:]) for r in rows}


def test_equals_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(230))
    texts = [None, "", "same text", "same text", "SHOUT " * 210, long, long, long + " #", "Ünï " * 300, "a\x0bb c " * 150, "x " * 20_000, "100% " + long]
    docs = [(i, t, ("de", "en", None, "")[i % 4], "clash", 7) for i, t in enumerate(texts)]
    docs += [(5, long, "fr", "clash", 7), (5, long, "fr", "clash", 7), (None, long, "en", "clash", 7), (None, "same text", None, None, None)]
    docs += [(2, "another text of the same id", "en", None, None), (50, "x", "only", None, None)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(12)]
    labels = [(i, int(q), int(t)) for i, q, t in labels] + [(4, 1, 1), (None, 1, 1), (5, None, None), (77, 1, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_copies_over_languages(spark):
    """The smallest id keeps its text, in whatever language it stands."""
    docs = [(9, "copy", "de", None, None), (3, "copy", "en", None, None), (4, "copy", "en", None, None), (3, "copy", "en", None, None)]
    got = audited(spark, docs, [])
    assert got == brute(docs, [])
    assert got["de", "EABCD", 1][1] == 1 and got["en", "EABCD", 1][1] == 1


def test_empty_table(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
