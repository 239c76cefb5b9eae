import pytest
from pyspark.sql import functions as F

from weftline.functions.scalars import integer_setting
from weftline.operators import ownership, retention


@pytest.mark.parametrize(
    ("raw", "value"),
    [(None, 5), ("", 5), ("7", 7), (" 7\n", 7), ("7.0", 7), ("7.5", None), ("1e1", 10), ("x", None), ("  ", None), ("-1", None), ("11", None), ("+2", 2), (".5e1", 5), ("7x", None), ("Infinity", None), ("NaN", None)],
)
def test_integer_settings(spark, raw, value):
    df = spark.createDataFrame([(raw,)], "raw string").select(integer_setting(F.col("raw"), 5, 1, 10))
    assert df.first()[0] == value


def test_blanks_are_zero_where_zero_is_allowed(spark):
    assert spark.createDataFrame([("  ",)], "raw string").select(integer_setting(F.col("raw"), 5, 0)).first()[0] == 0


def test_horizons():
    assert ownership.HORIZONS == {"call": 900_900, "publication": ownership.PUBLICATION_MS, "lease": 330_000, "claim": ownership.HOOK_CLAIM_MS}


def test_cleanups_asked_for(spark):
    runs = spark.createDataFrame([("a", 50), ("b", 9), ("c", None), ("d", 5)], "run_id string, due_us long")
    records = retention.cleanup_records(runs, 20).withColumn("generation", F.lit(3).cast("long"))  # of b and d
    records = records.withColumn("phase", F.when(F.col("run_id") == "d", "tombstoned").otherwise(F.col("phase")))
    asked = spark.createDataFrame([("b",), ("b",), ("c",), ("d",), ("none",)], "run_id string")
    got = {r["run_id"]: (r["due_us"], r["phase"], r["generation"]) for r in retention.clean_now(records, runs, asked, 30).collect()}
    assert got == {"b": (30, "retained", 4), "c": (30, "retained", 1), "d": (5, "tombstoned", 3)}
