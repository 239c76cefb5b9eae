import random

import pytest

from weftline.operators.catalog import Catalog

SCHEMA = "key string, run_id string, status string, at_us long"


def catalog(spark, tmp_path, **more):
    return Catalog(spark, f"file://{tmp_path}/catalog", **more)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_batches_equal_the_full_recomputation(spark, tmp_path):
    rng = random.Random(3)
    cat = catalog(spark, tmp_path, file_rows=40)
    want = {}
    first = [(f"run:{i:04}", f"r{i}", "pending", 0) for i in range(300)]
    cat.build(spark.createDataFrame(first, SCHEMA), files=6)
    want = {r[0]: r for r in first}
    for n in range(1, 4):
        picked = rng.sample(range(280, 330 + 60 * n), 30) if n == 2 else rng.sample(range(330 + 60 * n), 40)
        changes = [(f"run:{i:04}", f"r{i}", f"s{n}", rng.choice([n, n, -1]), rng.random() < 0.2) for i in picked]
        fences = [("r7",), (f"r{picked[0]}",)]
        for key, run, status, at, deleted in changes:
            if (run,) in fences or (key in want and want[key][3] > at):
                continue
            want.pop(key, None)
            if not deleted:
                want[key] = (key, run, status, at)
        before = cat.manifest().count()
        rewritten = cat.merge(spark.createDataFrame(changes, SCHEMA + ", deleted boolean"), spark.createDataFrame(fences, "run_id string"))
        assert rewritten < before if n == 2 else True  # a batch of late keys leaves the early files alone
        assert rows_of(cat.read(SCHEMA)) == sorted(want.values())
    files = sorted((r["low"], r["high"]) for r in cat.manifest().collect())
    assert all(a[1] < b[0] for a, b in zip(files, files[1:], strict=False))  # ranges stay disjoint
    got = cat.read(SCHEMA, "run:", "run:0100", "run:0140")
    assert rows_of(got) == [r for k, r in sorted(want.items()) if "run:0100" < k < "run:0140"]
    assert 0 < len(got.inputFiles()) < len(files) / 3
    assert rows_of(cat.read(SCHEMA, "run:02")) == [r for k, r in sorted(want.items()) if k.startswith("run:02")]


def test_a_broken_batch_changes_nothing(spark, tmp_path):
    cat = catalog(spark, tmp_path)
    cat.build(spark.createDataFrame([("a", "r", "s", 1)], SCHEMA))
    spark.createDataFrame([("x", "r", "s", 1)], SCHEMA).write.parquet(f"{cat.where}/data/torn")  # files without a manifest
    (tmp_path / "catalog/manifest/version=1").mkdir()  # a manifest that was never finished
    assert cat.version() == 0 and rows_of(cat.read(SCHEMA)) == [("a", "r", "s", 1)]
    (tmp_path / "catalog/manifest/version=1").rmdir()
    cat.merge(spark.createDataFrame([("a", "r", "t", 2, False)], SCHEMA + ", deleted boolean"))
    assert rows_of(cat.read(SCHEMA)) == [("a", "r", "t", 2)]
    with pytest.raises(Exception, match="(?i)exist"):  # another writer has made this version
        cat._commit(cat.manifest(), 1)


def test_an_empty_catalog_and_an_empty_batch(spark, tmp_path):
    cat = catalog(spark, tmp_path)
    assert cat.version() is None and cat.read(SCHEMA, "a").collect() == []
    none = spark.createDataFrame([], SCHEMA + ", deleted boolean")
    cat.merge(none)
    cat.merge(spark.createDataFrame([("b", "r", "s", 1, False), ("c", "q", "s", 1, True)], SCHEMA + ", deleted boolean"))
    assert rows_of(cat.read(SCHEMA)) == [("b", "r", "s", 1)]
    cat.merge(none)
    assert rows_of(cat.read(SCHEMA)) == [("b", "r", "s", 1)]
