import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TABLE = pieces.ChunkTable(MODEL)


def coded(text, table=TABLE):
    chunks = pieces.marked(text)
    table.learn({c for c in chunks if len(c) <= pieces.KEPT_CHARS})
    ids, decoded = table.code(chunks)
    return [int(i) for i in ids.split(",")] if ids else [], decoded


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t▁abcéß東😀́\x00\xa0​ﬁ<s>the  ")), max_size=20) | st.text(max_size=30))
def test_chunks_equal_the_library(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    want = LIBRARY.encode(text)
    assert coded(text) == (want, LIBRARY.decode(want))


def test_whole_texts_equal_the_library(spark, make, odd):
    texts = [*odd, "The  quick brown\nfox. " * 50, "<s> </s> <unk>"]
    got = pieces.encode_decode(make(texts), MODEL, with_ids=True, with_text=True).orderBy("doc_id").collect()
    for row, text in zip(got, texts, strict=True):
        ids = LIBRARY.encode(text or "")
        decoded = LIBRARY.decode(ids)
        assert (row["ids"], row["decoded"], row["n_tokens"]) == (ids, decoded, len(ids))
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
        assert row["text"] == text


def test_a_full_table_changes_nothing():
    table = pieces.ChunkTable(MODEL, own_entries=3)
    for text in ("one two three four five", "six seven one two", "x " * 40):
        ids = LIBRARY.encode(text)
        assert coded(text, table)[0] == ids


def test_the_corpus_table_has_the_frequent_chunks_and_its_size_changes_nothing(spark, make):
    texts = ["one two three four", "one two three", "one two  <s> odd\u200bness", "one <s> odd\u200bness", "one ﬁ ﬁ ﬁ", None]
    docs = make(texts * 3 + ["once"])
    counts = {r["chunk"]: r["n"] for r in pieces.chunk_counts(docs).collect()}
    assert counts["▁one"] == 15 and counts["▁two"] == counts["▁ﬁ"] == 9 and counts["▁four"] == 3 and counts["▁once"] == 1
    for entries, least in ((1000, 2), (3, 8), (1, 16), (0, 64)):
        table = pieces.corpus_table(docs, MODEL, entries=entries)
        assert set(table.column("chunk").to_pylist()) == {c for c, n in counts.items() if n >= least} and table.num_rows <= entries
        rows = pieces.encode_decode(docs, MODEL, with_ids=True, with_text=True, entries=entries, own_entries=2).collect()
        assert all((r["ids"], r["decoded"]) == (LIBRARY.encode(r["text"] or ""), LIBRARY.decode(LIBRARY.encode(r["text"] or ""))) for r in rows)


def test_empty_table_and_clashing_columns(spark, make):
    empty = pieces.encode_decode(make([]), MODEL)
    assert empty.count() == 0 and "ids_sha256" in empty.columns
    clash = make(["a"]).withColumnRenamed("lang", "n_tokens")
    assert pieces.encode_decode(clash, MODEL).first()["n_tokens"] == 1


def test_portions_keep_every_text():
    items = ["a" * 10, "b" * 600_000, "", "c"]
    assert [x for p in pieces.portions(items) for x in p] == items
    with pytest.raises(StopIteration):
        next(pieces.portions([]))
