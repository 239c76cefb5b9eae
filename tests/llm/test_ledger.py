import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.llm import ledger


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é\n\t#\x1c\xa0|")), max_size=60))
def test_measures_equal_brute_force(text):
    assert ledger.measure(text.encode())[:5] == brute(text)


def test_many_distinct_words_take_the_other_numbering(monkeypatch):
    words = [b"%d" % (i % 7) for i in range(50)]
    want = ledger.repeat_words(words)
    assert want[0] == brute(b" ".join(words).decode())[4]


def test_ledger_policies_and_ablations(spark, make, odd):
    texts = [*odd, " ".join(f"w{i}" for i in range(60)), "same thing here " * 30]
    led = ledger.ledger(make(texts)).cache()
    rows = ledger.apply_policy(led, ledger.POLICIES[1]).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        n, chars, symbols, dup, repeats = brute(text)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, chars, symbols, dup, repeats)
        assert bool(row["failed_rules"] & ledger.BASE) == (n < 50 or 100 * repeats > 50 * n)
        assert row["kept"] == (row["failed_rules"] == 0)
    assert rows[len(odd)]["kept"] and not rows[len(odd) + 1]["kept"]
    masks = [r["failed_rules"] for r in rows]
    for r in ledger.ablations(led).collect():
        policy = next(p for p in ledger.POLICIES if p.version == r["version"])
        bit = 1 << [x.name for x in ledger.RULES].index(r["rule"])
        assert r["fails"] == sum(bool(m & bit) for m in masks)
        assert r["only_by"] == sum(m & policy.mask == bit for m in masks)


def test_empty_and_clashing(spark, make):
    assert ledger.ledger(make([])).count() == 0
    assert all(r["fails"] == 0 for r in ledger.ablations(ledger.ledger(make([]))).collect())
    clash = make(["a b"]).withColumn("n_words", F.lit("mine"))
    assert ledger.ledger(clash).first()["n_words"] == 2
