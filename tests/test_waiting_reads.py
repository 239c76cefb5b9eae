import random

import pytest

from weftline.operators.streams import waiting_reads
from weftline.streaming import reads

REQUEST = "request_id long, stream string, start long, max_chunks long, max_bytes long, wait_ms long, at_ms long"
CHUNK, END = "stream string, idx long, size long, at_ms long", "stream string, state string, at_ms long"
COLUMNS = ("request_id", "stream", "start", "answered_ms", "timed_out", "state", "tail_index", "n_chunks", "bytes")


def answers(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def frames(spark, requests, chunks, ends):
    return spark.createDataFrame(requests, REQUEST), spark.createDataFrame(chunks, CHUNK), spark.createDataFrame(ends, END)


def test_answers_at_once_after_a_wait_and_in_vain(spark):
    chunks = [("s", 0, 5, 10), ("s", 1, 5, 10), ("s", 2, 5, 100)]
    requests = [
        (1, "s", 0, 9, 9, 50, 10), (2, "s", 0, 9, 99, 50, 5), (3, "s", 2, 9, 99, 80, 20), (4, "s", 2, 9, 99, 79, 20), (5, "s", 7, 9, 99, 500, 20), (6, "s", 2, 0, 99, 500, 20),
        (7, "s", 3, 9, 99, 500, 150), (8, "s", 3, 9, 99, 500, 200), (9, "none", 0, 9, 99, 7, 3),
    ]
    got = answers(waiting_reads(*frames(spark, requests, chunks, [("s", "closed", 200), ("s", "errored", 300)])))
    assert got == [
        (1, "s", 0, 10, False, "open", 1, 1, 5), (2, "s", 0, 10, False, "open", 1, 2, 10), (3, "s", 2, 100, False, "open", 2, 1, 5), (4, "s", 2, 99, True, "open", 1, 0, 0),
        (5, "s", 7, 100, False, "open", 2, 0, 0), (6, "s", 2, 20, False, "open", 1, 0, 0), (7, "s", 3, 200, False, "closed", 2, 0, 0), (8, "s", 3, 200, False, "closed", 2, 0, 0),
        (9, "none", 0, 10, True, "open", -1, 0, 0),
    ]
    assert answers(waiting_reads(*frames(spark, [], chunks, []))) == []


def test_stream_equals_batch_over_restarts(spark, keyed_state, tmp_path):
    rng = random.Random(4)
    chunks, requests, ends = [], [], []
    for stream in "abc":
        at = 1_000
        for idx in range(25):
            at += rng.choice([0, 0, 300, 900])
            chunks.append((stream, idx, rng.choice([1, 5, 9]), at))
        requests += [(1000 * ord(stream) + i, stream, rng.randrange(28), rng.choice([0, 1, 3, 32]), rng.choice([10, 40]), rng.choice([0, 100, 700]), 1_000 + rng.randrange(12_000)) for i in range(60)]
        if stream != "c":
            ends += [(stream, "closed", at + 500), (stream, "errored", at + 900)]
    want = answers(waiting_reads(*frames(spark, requests, chunks, ends)))
    assert {r[4] for r in want} == {True, False} and {r[5] for r in want} == {"open", "closed"}
    schema = "stream string, " + ", ".join(f"{c} {t}" for c, t in reads.ACTION.items())
    none = (None,) * 5
    rows = [(s, at, i, "write", i, size, None, *none) for s, i, size, at in chunks] + [(s, at, 900 + i, "end", None, None, state, *none) for i, (s, state, at) in enumerate(ends)]
    rows += [(s, at, i, "read", None, None, None, i, start, most, most_bytes, wait) for i, s, start, most, most_bytes, wait, at in requests]
    rows.sort(key=lambda r: r[1] + random.Random(r[2]).randrange(400))
    last = [("z", 10**6, 1, "read", None, None, None, 1, 0, 1, 10, 0)]
    for n, part in enumerate([rows[:120], rows[120:], last]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        out = reads.waiting_reads(stream, 500).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check")
        assert out.trigger(availableNow=True).start().awaitTermination(240)
    assert answers(spark.read.parquet(f"{tmp_path}/out").where("stream <> 'z'")) == want


@pytest.mark.parametrize("bad", [{"start": -1}, {"max_chunks": 33}, {"max_bytes": 5}, {"wait_ms": 20_001}])
def test_bounds_of_a_read(bad):
    from weftline.operators.streams import check_read

    with pytest.raises(ValueError):
        check_read(**{"start": 0, "max_chunks": 1, "max_bytes": 1 << 20, "wait_ms": 0, **bad})
