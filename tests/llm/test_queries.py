"""Every registered query of the corpus operators: columns, folds, digests, and SQL on a fixture of odd documents."""

import textwrap
import zlib

import duckdb
import pytest

from weftline.llm import licenses, queries

COLUMNS = {
    "op1_quality_gam": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op3_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4_line_spread": {"doc_id": "bigint", "n_lines": "bigint", "n_removed": "bigint"},
    "op5_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op6_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op7_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op8_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_rule_ledger": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op11_filter_audit": {"part": "string", "filter_order": "string", "step": "int", **dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint")},
    "op12_ngram_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op13_conversation_trie": {**dict.fromkeys(("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "bigint"), "ends_sha256": "string"},
}
NOT_BY_ROW = ("op2_decontamination", "op11_filter_audit", "op13_conversation_trie")
PAGES = ("op6_html_extraction", "op7_url_filter")


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_keeps_its_contract(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in COLUMNS[name]} == COLUMNS[name]
    rows = df.collect()
    if name not in NOT_BY_ROW:
        table = spark.read.parquet(f"{small}/{'pages' if name in PAGES else 'documents'}.parquet")
        key = "page_id" if name in PAGES else "doc_id"
        assert sorted(r[key] for r in rows) == sorted(r[0] for r in table.select(key).collect())
    modulus, held = (5, 0) if name == "op1_quality_gam" else (4, 2)
    for r in rows:
        if "held_out" in COLUMNS[name]:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held)
            assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if name == "op8_simhash":
            assert len(r["fingerprint"]) == 16 and set(r["fingerprint"]) <= set("0123456789abcdef") and r["component_id"] <= r["doc_id"]
        if name == "op7_url_filter":
            assert r["verdict"] in ("allow", "block")
        if name == "op6_html_extraction":
            assert r["n_chars"] == len(r["text"])
        if name == "op10_rule_ledger":
            assert not (r["base_failed"] and r["kept"])


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    """Documents with nulls, blank and wrapped texts, repeated lines on several sites, and repeated rows."""
    where = tmp_path_factory.mktemp("odd")
    wrapped = ["\n".join(textwrap.wrap(f"foo {t} bar", 25, break_long_words=False, break_on_hyphens=False)) for _, t in licenses.NOTICES]
    lines = ["Shared LINE  here\nown {}\n\n \t\nshared line here", "shared line here\r\nx {} y", "no license {}"]
    texts = [None, "", " \n ", "é東😀 ß mit LICENSE", *wrapped, *(x.format(i) for i in range(4) for x in lines), "a b c " * 40, "MIT\nLicense general public license"]
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{where}/documents.parquet")
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, len(texts), 2)]
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").coalesce(1).write.parquet(f"{where}/labels.parquet")
    talk = [(c, None if t == 1 and c == 3 else t, "user" if t % 2 else None, None if t == c else f"say {t % (c + 1)} {c // 8}é") for c in range(40) for t in range(c % 9)]
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{where}/conversations.parquet")
    return str(where)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_its_sql_on_odd_documents(spark, fixture_dir, name):
    con = duckdb.connect()
    for name_ in ("documents", "labels", "conversations"):
        con.sql(f"CREATE VIEW {name_} AS SELECT * FROM '{fixture_dir}/{name_}.parquet/*.parquet'")
    df = queries.QUERIES[name](spark, fixture_dir)
    want = con.sql(queries.ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    place = [want.columns.index(c) for c in names]
    assert sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())
