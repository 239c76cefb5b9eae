"""Wire files and streaming deliveries."""

from pyspark.sql import functions as F

from weftline.sources import frames
from weftline.streaming import delivery


def test_frames_written_and_read_again(spark, tmp_path):
    rows = [("s", i, bytes([i]) * (i + 1)) for i in range(7)] + [("t", 0, b"")]
    chunks = spark.createDataFrame(rows, "stream string, idx long, data binary").withColumn("size", F.octet_length("data").cast("long"))
    made = frames.frames(chunks, 3, 1000).collect()
    assert {(r["stream"], r["batch"]) for r in made} == {("s", 0), ("s", 1), ("s", 2), ("t", 0)}
    (tmp_path / "in").mkdir()
    for r in made:
        (tmp_path / "in" / f"{r['stream']}{r['batch']}.bin").write_bytes(bytes(r["frame"]))
    (tmp_path / "in" / "broken.bin").write_bytes(b"nothing")
    got = frames.read_frames(spark, str(tmp_path / "in")).collect()
    assert sorted(bytes(r["data"]) for r in got if r["idx"] is not None) == sorted(r[2] for r in rows)
    assert [r["path"].rsplit("/", 1)[1] for r in got if r["idx"] is None] == ["broken.bin"]


def test_deliveries_are_written_once_and_expired_runs_dropped(spark, tmp_path):
    schema = "message_id long, run_id string, queue_name string, body string, attempt long, idempotency_key long, enqueued_us long"
    rows = [(i, f"r{i % 3}", "q_x", "ok" if i % 2 else "later", 0, i, 0) for i in range(30)]
    expired = spark.createDataFrame([("r0",)], "run_id string")
    for part in (rows[:12], rows[12:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = delivery.deliver_stream(stream, lambda b, m: 30 if b == "later" else None, str(tmp_path / "out"), str(tmp_path / "c"), lambda: 5_000_000, "q_", expired)
        assert query.awaitTermination(120)
    got = {r["message_id"]: (r["outcome"], r["next_due_us"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {i: ("ack", None) if i % 2 else ("redeliver", 35_000_000) for i in range(30) if i % 3}


def test_tail_from_an_index(spark, tmp_path):
    schema = "stream string, idx long"
    spark.createDataFrame([("a", i) for i in range(6)] + [("b", 9)], schema).write.parquet(str(tmp_path / "in"))
    query = delivery.tail_stream(spark, str(tmp_path / "in"), schema, "a", 3).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert sorted(r["idx"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [3, 4, 5]
