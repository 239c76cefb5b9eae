import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import forms
from weftline.functions.transitions import Limits, decide, new_state
from weftline.operators import disposal, eventlog, numbering


def test_numbering_over_buckets_equals_one_window(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x long, y long")
    got = numbering.numbered(df, F.col("g"), F.floor(F.col("x") / 7), ["x", "y"])
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    want = {r: i for g in ("a", "b", None) for i, r in enumerate(sorted((r for r in rows if r[0] == g), key=key), 1)}
    assert {tuple(r)[:3]: r["n"] for r in got.collect()} == want
    assert numbering.numbered(df.limit(0), F.col("g"), F.col("x"), ["y"]).collect() == []


def test_ids_sort_by_time_and_are_the_same_again(spark):
    rows = [(i, 1_700_000_000_000 + i // 50) for i in range(400)] + [(1000, 0), (1001, -5), (1002, (1 << 48) - 1)]
    df = spark.createDataFrame(rows, "seq long, at long")
    made = lambda d: {r["seq"]: r["id"] for r in numbering.ulids(d, "at", ["seq"], F.floor(F.col("seq") / 16)).collect()}
    ids = made(df.repartition(7))
    assert ids == made(df.repartition(2, "at"))
    assert len(set(ids.values())) == len(rows) and all(len(i) == 26 and set(i) <= set(numbering.DIGITS) for i in ids.values())
    order = [s for s, at in sorted(rows, key=lambda r: (max(0, r[1]), r[0]))]
    assert sorted(ids, key=ids.get) == order
    back = df.sparkSession.createDataFrame([(i,) for i in ids.values()] + [("U" * 26,), ("01",), (None,)], "id string").select("id", numbering.ulid_ms(F.col("id")).alias("ms"))
    found = {r["id"]: r["ms"] for r in back.collect()}
    assert all(found[ids[s]] == max(0, at) for s, at in rows) and found["U" * 26] is None and found["01"] is None and found[None] is None


def test_disposal_in_rounds_takes_every_page_once(spark):
    items = [(r, p, f"{k:04}") for r, p, n in (("a", "hooks", 129), ("a", "waits", 1), ("b", "markers", 64), ("live", "hooks", 9), ("a", "other", 3)) for k in range(n)]
    runs = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "run_id string")
    pages = disposal.disposal_pages(runs, spark.createDataFrame(items, "run_id string, phase string, key string"), F.substring("key", 1, 3)).cache()
    want = {("a", 0, "hooks", 64), ("a", 1, "hooks", 64), ("a", 2, "hooks", 1), ("a", 3, "markers", 0), ("a", 4, "waits", 1), ("b", 0, "hooks", 0), ("b", 1, "markers", 64),
            ("b", 2, "waits", 0), ("c", 0, "hooks", 0), ("c", 1, "markers", 0), ("c", 2, "waits", 0)}
    assert {tuple(r)[:4] for r in pages.collect()} == want
    assert {(r["run_id"], r["generation"]) for r in pages.where("ends").collect()} == {("a", 4), ("b", 2), ("c", 2)}
    progress, seen = spark.createDataFrame([], "run_id string, generation long"), []
    while (taken := disposal.next_pages(pages, progress, 2)).take(1):
        rows = taken.collect()
        seen += [tuple(r)[:4] for r in rows]
        progress = spark.createDataFrame(disposal.advance(progress, taken.unionByName(taken)).collect(), "run_id string, generation long")
    assert len(seen) == len(want) and set(seen) == want


@pytest.mark.parametrize(
    ("changes", "more", "outcome"),
    [
        ([["k", "v"]], {}, "appended"), ([["$k", "v"]], {}, "INVALID_ATTRIBUTES"), ([["$k", "v"]], {"allow_reserved": True}, "appended"), ([["", "v"]], {}, "INVALID_ATTRIBUTES"),
        ([["k" * 9, "v"]], {}, "INVALID_ATTRIBUTES"), ([["k", "v" * 9]], {}, "INVALID_ATTRIBUTES"), ([["é" * 4, None]], {}, "appended"), ([["é" * 5, None]], {}, "INVALID_ATTRIBUTES"),
        ([["a", "1"], ["b", "1"], ["c", "1"]], {}, "INVALID_ATTRIBUTES"), ([["a", "1"], ["x", None], ["b", "1"]], {}, "appended"), ([], {}, "appended"),
    ],
)
def test_attribute_changes(changes, more, outcome):
    state, limits = new_state(), Limits(keys=2, key_bytes=8, value_bytes=8)
    for kind in ("run_created", "run_started"):
        decide(state, {"event_type": kind, "corr": None}, None, limits)
    decide(state, {"event_type": "attr_set", "corr": None, "changes": '[["x", "0"]]'}, None, limits)
    before = dict(state["attributes"])
    got, types = decide(state, {"event_type": "attr_set", "corr": None, "changes": json.dumps(changes), **more}, None, limits)
    assert got == outcome and bool(types) == (outcome == "appended")
    want = {k: v for k, v in {**before, **dict(changes)}.items() if v is not None} if types else before
    assert state["attributes"] == want and state["n_attributes"] == len(want)


def test_attributes_of_nothing(spark):
    schema = "run_id string, seq long, event_type string, corr string, at_us long, changes string"
    assert eventlog.attributes(eventlog.fold(spark.createDataFrame([], schema), carry=["changes"])).collect() == []


def test_event_forms(spark):
    rows = [("run_started", '{"a": 1}', "r"), ("step_started", '{"input": 1, "b": [1, {"input": 2}], "a": null}', "r"), ("step_started", "[1]", None), ("hook_received", '{"input": 1}', "r"),
            ("step_started", "no json", "r"), ("attr_set", None, "r"), (None, '{"x": 1.5}', None)]
    df = spark.createDataFrame(rows, "t string, d string, r string")
    got = [r[0] for r in df.select(forms.stored_event(F.col("t"), F.col("d"), F.col("r"), runId=F.lit("w"))).collect()]
    assert [json.loads(g) for g in got] == [
        {"eventType": "run_started", "runId": "w"}, {"eventData": {"a": None, "b": [1, {"input": 2}]}, "eventType": "step_started", "runId": "w"},
        {"eventData": [1], "eventType": "step_started", "runId": "w"}, {"eventData": {"input": 1}, "eventType": "hook_received", "resumeId": "r", "runId": "w"},
        {"eventType": "step_started", "runId": "w"}, {"eventType": "attr_set", "runId": "w"}, {"eventData": {"x": 1.5}, "runId": "w"},
    ]
