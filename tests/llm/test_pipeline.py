"""The corpus pipeline as a whole: odd rows through all stages, and an empty table."""

import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
OUT = {"doc_id": "bigint", "n_tokens": "bigint", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) + (". " if rng.random() < 0.1 else "") for _ in range(n))


def folder(spark, where, docs, labels, items, extra=""):
    spark.createDataFrame(docs, DOCS + extra).coalesce(1).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").coalesce(1).write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{where}/benchmark.parquet")
    return f"file://{where}"


def test_odd_rows_through_all_stages(spark, tmp_path):
    rng = random.Random(8)
    item = "which river runs through the old town of " + prose(rng, 25)
    good = [prose(rng, rng.randint(80, 200)) for _ in range(60)]
    junk = [" ".join(rng.choices("!!! $$$ ||| ### 1 2".split(), k=120)) for _ in range(40)]
    line = "the very same line of boilerplate on every site"
    docs = [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(good + junk)]
    docs += [(200 + i, good[i] + " tail", "de", None, None) for i in range(5)]  # near copies
    docs += [(300 + i, f"{line}\n{prose(rng, 90)}", None, f"s{i}", 1) for i in range(6)]
    docs += [(400, f"{prose(rng, 60)} {item} {prose(rng, 60)}", "en", "s1", 1), (3, good[3], "en", "s3", len(good[3])), (None, good[7], "en", "s", 1), (401, None, None, None, None), (402, "", "", "", 0)]
    rows = [(*d, "x", 1.5, 9) for d in docs]
    labels = [(i, int(i < 60), 0) for i in range(100)] + [(None, 1, 1), (5, None, None)]
    where = folder(spark, tmp_path, rows, labels, [(1, item), (1, item), (2, None), (None, "short")], ", score string, predicted double, n_removed long")
    out = corpus_pipeline.run(spark, where)
    assert dict(out.dtypes) == OUT
    ids = [r["doc_id"] for r in out.collect()]
    known = {i for i in ids if i is not None}
    assert len([i for i in ids if i is not None]) == len(known)  # an id is there once
    assert set(range(60)) - known == set() and not known & set(range(60, 100))
    assert not known & set(range(200, 205)) and 400 not in known and set(range(300, 306)) <= known


def test_no_documents(spark, tmp_path):
    where = folder(spark, tmp_path, [], [(1, 1, 0)], [(1, "an item of the benchmark")])
    out = corpus_pipeline.run(spark, where)
    assert dict(out.dtypes) == OUT and out.count() == 0
