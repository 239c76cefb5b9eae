"""Quality rules as a bitmask ledger.

Every rule is measured once per document. The ledger keeps the measurements
and one integer whose bit *b* says that rule *b* failed. A policy is a version
name with the rules it enforces, as a mask; applying it, comparing versions and
ablating single rules are then bitwise operations on the ledger, with no second
look at any text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import utf8, with_columns

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "max_run")
SYMBOLS = bytes(c for c in range(128) if chr(c) not in "#*$%&|<>")


@dataclass(frozen=True)
class Rule:
    """A rule fails where its SQL condition over the measurements is true."""

    name: str
    fails: str


#: Bit b of the ledger belongs to rule b. Rules are only ever appended.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_heavy", "100 * n_symbols > 25 * n_words and n_symbols > 10"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 and 100 * n_dup_lines > 60 * n_lines"),
    Rule("stuck_word", "max_run >= 12"),
)
BASE = 0b11


@dataclass(frozen=True)
class Policy:
    """A version: the mask of the rules that reject."""

    version: str
    mask: int


POLICIES = (Policy("v1-base", BASE), Policy("v2-full", (1 << len(RULES)) - 1))


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words inside 3-word windows found twice or more, and the longest run of one word."""
    n = len(words)
    if n < 3:
        return 0, (2 if n == 2 and words[0] == words[1] else min(n, 1))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    size = len(seen)
    same = np.flatnonzero(np.diff(ids))
    run = int(np.diff(np.concatenate(([-1], same, [n - 1]))).max())
    if size < 2_000_000:
        keys = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # three ids no longer fit one integer: number the pairs first
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * size + ids[2:]
    _, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    hit = counts[where] > 1
    covered = np.zeros(n, bool)
    covered[:-2] |= hit
    covered[1:-1] |= hit
    covered[2:] |= hit
    return int(covered.sum()), run


def measure(text: bytes) -> tuple[int, ...]:
    """All measurements of one text, in the order of MEASURES.

    Words are runs of anything but space and the controls 9 to 13, which is
    what bytes.split() cuts at; lines are cut at the newline alone.
    """
    words = text.split()
    word_chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text.translate(None, SYMBOLS + bytes(range(128, 256))))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats, run = repeat_words(words)
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeats, len(lines), run


def mask_of(rules: tuple[Rule, ...] = RULES) -> Column:
    """The failure bits of a row of measurements."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << b)).otherwise(F.lit(0)).cast("long") for b, r in enumerate(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def ledger(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the measurements and ``failed_rules`` to each row.

    Null and empty texts have zero in every measurement, so they fail
    ``few_words``. Other columns pass through. Rows are independent, so there is
    no shuffle, and a batch is the largest thing held.
    """

    def rows(batch: pa.RecordBatch):
        got = [measure(t) for t in utf8(batch, text_col)]
        return [pa.array(list(c), pa.int64()) for c in zip(*got, strict=True)]

    measured = with_columns(docs, [(m, T.LongType()) for m in MEASURES], rows)
    return measured.withColumn("failed_rules", mask_of(rules))


def apply_policy(ledger_df: DataFrame, policy: Policy, out: str = "kept") -> DataFrame:
    """Whether the policy keeps each row: none of its rules is among the failed ones."""
    return ledger_df.withColumn(out, F.col("failed_rules").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(ledger_df: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each policy and rule: rows failing it, and rows that only it rejects.

    ``only_by`` counts the rows that would come back if the rule were dropped
    from the policy. One aggregation over distinct masks; a row for each policy
    and rule, also over an empty ledger (zeros).
    """
    masks = ledger_df.groupBy("failed_rules").agg(F.count(F.lit(1)).alias("n"))
    cells = [
        F.struct(
            F.lit(p.version).alias("version"),
            F.lit(r.name).alias("rule"),
            F.coalesce(F.sum(F.when(F.col("failed_rules").bitwiseAND(F.lit(p.mask & (1 << b))) != 0, F.col("n"))), F.lit(0)).alias("fails"),
            F.coalesce(F.sum(F.when(F.col("failed_rules").bitwiseAND(F.lit(p.mask)) == (1 << b), F.col("n"))), F.lit(0)).alias("only_by"),
        )
        for p in policies
        for b, r in enumerate(rules)
        if p.mask >> b & 1
    ]
    return masks.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")
