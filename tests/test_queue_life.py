import random

import pytest

from weftline.operators.queue_life import ACTION, LIFE, lives
from weftline.streaming.cells import live_stream

SCHEMA = "cell string, " + ", ".join(f"{c} {t}" for c, t in ACTION.items())
SETTINGS = {"in_flight": 2, "lease_ms": 5_000, "max_attempts": 3}


def row(cell, seq, at, action, message=None, key=None, delay=None, lease=None, status=None, timeout=None):
    return cell, seq, at, action, message, key, delay, lease, status, timeout


def got(df):
    return sorted((tuple(r[c] for c in ("cell", *LIFE)) for r in df.collect()), key=repr)


def some_actions(seed, n=260):
    rng, rows = random.Random(seed), []
    for seq in range(n):
        cell, at = rng.choice("abc"), rng.randrange(60_000)
        what = rng.choice(["enqueue", "tick", "tick", "tick", "answer"])
        if what == "enqueue":
            rows.append(row(cell, seq, at, what, seq, rng.choice(["k1", "k2", None]), rng.choice([None, 0, 1, 3])))
        elif what == "tick":
            rows.append(row(cell, seq, at, what))
        else:
            rows.append(row(cell, seq, at, what, rng.randrange(n), None, None, rng.choice([1, 1, 2]), rng.choice([200, 404, 500, 503]), rng.choice([None, 2])))
    for r in list(rows):  # answers over some time, of which some meet the lease
        if r[3] == "enqueue":
            rows += [row(r[0], 1000 * r[1] + k, r[2] + 700 * k, "answer", r[4], None, None, rng.choice([1, 2, 3]), rng.choice([200, 500, 503, 503]), rng.choice([None, 2])) for k in range(1, 20)]
    return rows


def streamed(spark, tmp_path, batches, **settings):
    """Rows of a stream that gets one file a run, stopped and started again for each."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        out = live_stream(stream, **settings)
        query = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        assert query.awaitTermination(240)
    return got(spark.read.parquet(f"{tmp_path}/out"))


def test_a_message_through_leases_retries_and_death(spark):
    actions = [
        row("a", 1, 0, "enqueue", 7, "k"), row("a", 2, 10, "enqueue", 8, "k"), row("a", 3, 20, "tick"),
        row("a", 4, 4_000, "tick"),  # still in flight
        row("a", 5, 5_020, "tick"),  # the lease is over: lost, and claimed again
        row("a", 6, 5_030, "answer", 7, lease=1, status=200),  # late: changes nothing
        row("a", 7, 5_040, "answer", 7, lease=2, status=500), row("a", 8, 7_039, "tick"), row("a", 9, 7_040, "tick"),
        row("a", 10, 7_050, "answer", 7, lease=3, status=503, timeout=1), row("a", 11, 8_050, "tick"), row("a", 12, 8_060, "answer", 7, lease=4, status=0),
        row("a", 13, 12_060, "tick"), row("a", 14, 12_070, "answer", 7, lease=5, status=503), row("a", 15, 12_080, "enqueue", 9, "k", 2),
    ]
    what = [(r[1], r[4], r[3], r[6], r[7], r[8]) for r in sorted(got(lives(spark.createDataFrame(actions, SCHEMA), **SETTINGS)), key=lambda r: (r[1], r[4] != "lost"))]
    assert what == [
        (1, "enqueued", 7, 0, 0, 0), (2, "deduped", 8, 0, 0, 0), (3, "claimed", 7, 0, 1, 5_020), (5, "lost", 7, 0, 1, 5_020), (5, "claimed", 7, 0, 2, 10_020),
        (6, "late", 7, None, 1, None), (7, "retry", 7, 1, 2, 7_040), (9, "claimed", 7, 1, 3, 12_040), (10, "redeliver", 7, 1, 3, 8_050),
        (11, "claimed", 7, 1, 4, 13_050), (12, "retry", 7, 2, 4, 12_060), (13, "claimed", 7, 2, 5, 17_060), (14, "dead", 7, 3, 5, None), (15, "enqueued", 9, 0, 0, 14_080),
    ]


def test_no_more_in_flight_than_allowed(spark):
    actions = [row("a", i, 0, "enqueue", 100 - i) for i in range(5)] + [row("a", 9, 1, "tick"), row("a", 10, 2, "answer", 97, lease=1, status=410), row("a", 11, 3, "tick")]
    rows = [(r[1], r[3]) for r in got(lives(spark.createDataFrame(actions, SCHEMA), **SETTINGS)) if r[4] == "claimed"]
    assert sorted(rows) == [(9, 96), (9, 97), (11, 98)]


@pytest.mark.parametrize("alarms", [False, True])
def test_stream_with_restarts_equals_batch(spark, keyed_state, tmp_path, alarms):
    rows = some_actions(5)
    rows.sort(key=lambda r: r[2] + random.Random(r[1]).randrange(3_000))  # out of order by up to 3 s
    last = [row("z", 10**6, 10**6, "tick")]  # takes the watermark past everything
    batches = [rows[:500], rows[500:], last]
    until = 10**6 - 4_000 if alarms else None
    want = got(lives(spark.createDataFrame(rows, SCHEMA).repartition(3), **SETTINGS, alarms_until_ms=until))
    out = [r for r in streamed(spark, tmp_path, batches, **SETTINGS, delay_ms=4_000, alarms=alarms) if r[0] != "z"]
    assert {r[4] for r in want} >= {"enqueued", "deduped", "claimed", "lost", "late", "ack", "retry", "redeliver"}
    assert out == want


def test_no_actions_and_bad_bounds(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert lives(none).collect() == [] and lives(none, alarms_until_ms=5).collect() == []
    with pytest.raises(ValueError):
        lives(none, in_flight=129)
